"""All cohorts of a study in one plan.

Each event table is read once for all cohorts. Event days are counted before the
first shuffle; a second shuffle by person brings them to the observation periods,
and rules, exits and eras reuse that partitioning.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, functions as F

from cohortloom.model import RULES_PER_WORD, CohortDefinition, rule_words, word_names
from cohortloom.operators.eras import collapse_eras
from cohortloom.operators.events import DEATH, PushedCodes, tagged_event_days
from cohortloom.operators.exits import first_exit
from cohortloom.operators.rules import (
    ASKED, NEXT_DEATH, NO_CODESET, answered, criterion_codesets, mask_of_answers, meets_all_rules, questions, targets,
)
from cohortloom.operators.timeline import has_look_back, keep_first, observation_spans, person_parts, place_in_periods
from cohortloom.session import local_frame
from cohortloom.sources.tables import Tables


@dataclass(frozen=True)
class Codes:
    """Resolved codesets: vocabulary concepts and local source codes.

    ``small`` says that both are known to be few enough to broadcast. ``pushed`` has, for concepts (false)
    and source codes (true), what scans of events may be limited to.
    """

    concepts: DataFrame | None = None
    sources: DataFrame | None = None
    small: bool = False
    pushed: Mapping[bool, PushedCodes] = field(default_factory=dict)


def _full_masks(definition: CohortDefinition, words: int) -> list[int]:
    everything = (1 << len(definition.rules)) - 1
    return [everything >> w * RULES_PER_WORD & (1 << RULES_PER_WORD) - 1 for w in range(words)]


def _roles(spark, definitions: Sequence[CohortDefinition]) -> DataFrame:
    """What the events of a codeset are to the study: counted by rules, or entries of a cohort.

    An entry has one row per question its cohort asks. As long as the study's settings, so broadcast.
    """
    codesets = criterion_codesets(definitions)
    rows = [(domain, codeset, None, about, 0, *(None,) * 4) for about, (domain, codeset) in enumerate(codesets)]
    asked = 0
    for d in definitions:
        asks = list(enumerate(targets(d, codesets), start=asked))
        asked += len(asks)
        rows += [
            (c.domain, c.codeset_id, number, about, reach, c.start_from, c.start_to, d.prior_days, d.post_days)
            for c in d.primary
            for number, (about, reach) in asks
        ]
    schema = (
        "domain string, codeset_id bigint, asked int, about int, reach bigint, start_from date, start_to date, "
        "prior_days int, post_days int"
    )
    return F.broadcast(local_frame(spark, rows, schema))


def _settings(spark, definitions: Sequence[CohortDefinition]) -> DataFrame:
    """What a cohort's index events keep of its settings, one row per cohort."""
    words = word_names("full_mask", rule_words(definitions))
    schema = ["cohort_id int", *(f"{w} bigint" for w in words), "first_only boolean, exit_days int, censored boolean, era_pad int"]
    rows = [
        (d.cohort_id, *_full_masks(d, len(words)), d.first_only, d.exit_days, d.censor_at_death, d.era_pad)
        for d in definitions
    ]
    return F.broadcast(local_frame(spark, rows, ", ".join(schema)))


def _codesets_by_domain(definitions: Sequence[CohortDefinition]) -> dict[str, set[int]]:
    used: dict[str, set[int]] = {}
    for definition in definitions:
        for criterion in (*definition.primary, *definition.rules):
            used.setdefault(criterion.domain, set()).add(criterion.codeset_id)
    return used


def qualified_events(tables: Tables, codes: Codes, definitions: Sequence[CohortDefinition]) -> DataFrame:
    """Index events of all cohorts by day and observation period, with rule mask and next death.

    ``n_events`` is the number of source events behind a row. All cohorts and all
    their rules are answered by one running count (see ``operators.rules``).
    """
    spark = tables["observation_period"].sparkSession
    days = tagged_event_days(
        tables, _codesets_by_domain(definitions), codes.concepts, codes.sources, codes.small, codes.pushed
    )
    parts = person_parts(days, tables["observation_period"])
    placed = place_in_periods(days, observation_spans(tables["observation_period"], parts), parts)
    codesets = F.when(F.col("domain") == DEATH, F.array(F.lit(NO_CODESET).cast("bigint"))).otherwise(F.col("codesets"))
    met = (
        placed.select("*", F.explode(codesets).alias("codeset_id"))
        .drop("codesets")
        .join(_roles(spark, definitions), ["domain", "codeset_id"])
    )
    in_dates = F.col("start_date").between(
        F.coalesce("start_from", "start_date"), F.coalesce("start_to", "start_date")
    )
    counted = F.col("asked").isNull()
    n = F.when(counted, F.col("n_events")).otherwise(F.col("n_events") * F.col("copies"))
    answers = answered(met.where(counted | (in_dates & has_look_back())).withColumn("n", n)).join(
        F.broadcast(local_frame(spark, questions(definitions), ASKED)), "asked"
    )
    # Each index event asks for its next death once, which tells how many events it stands for.
    base = F.col("ask") == NEXT_DEATH
    qualified = answers.groupBy("cohort_id", "person_id", "start_date", "op_start_date", "op_end_date").agg(
        F.max(F.when(base, F.col("censor_date"))).alias("censor_date"),
        F.sum(F.when(base, F.col("n"))).alias("n_events"),
        *[mask.alias(name) for name, mask in mask_of_answers(rule_words(definitions)).items()],
    ).join(_settings(spark, definitions), "cohort_id")
    if any(d.first_only for d in definitions):
        qualified = keep_first(qualified)
    return qualified


def cohorts_of(qualified: DataFrame) -> DataFrame:
    """Cohort rows ``(cohort_definition_id, subject_id, cohort_start_date, cohort_end_date)``."""
    stays = meets_all_rules(qualified).select(
        F.col("cohort_id").alias("cohort_definition_id"),
        F.col("person_id").alias("subject_id"),
        F.col("start_date").alias("cohort_start_date"),
        first_exit(F.col("exit_days"), F.col("censored")).alias("cohort_end_date"),
        "era_pad",
    )
    return collapse_eras(
        stays,
        ["cohort_definition_id", "subject_id"],
        "cohort_start_date",
        "cohort_end_date",
        F.col("era_pad"),
    )


def build_cohorts(tables: Tables, codes: Codes, definitions: Sequence[CohortDefinition]) -> DataFrame:
    """Cohort rows straight from the source tables."""
    return cohorts_of(qualified_events(tables, codes, definitions))
