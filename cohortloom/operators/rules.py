"""Inclusion rules: how many events of another codeset surround the index event.

Criterion events and index events travel in the same frame. An index event asks
for counts: it is one row per rule of its cohort, placed among the events of the
rule's codeset where the rule's window ends. One running count per person, period
and codeset then answers every rule, however many there are; no pairs of events
are built.
"""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window, functions as F

from cohortloom.model import AT_LEAST, RULES_PER_WORD, CohortDefinition, word_names
from cohortloom.operators.events import DEATH

# The codeset of deaths, which have none, and the number of the question for the next one.
NO_CODESET = 0
NEXT_DEATH = -1
# Deaths come first among what questions are about.
DEATHS = 0

#: A question of a cohort: columns of a row of settings, looked up by ``asked`` once the question is answered.
ASKED = "asked int, cohort_id int, ask int, at_least boolean, occurrences int, word int, bit bigint"


def criterion_codesets(definitions: Iterable[CohortDefinition]) -> list[tuple[str, int]]:
    """Domains and codesets that questions are about; a question names one by its place in this list."""
    rules = {(rule.domain, rule.codeset_id) for definition in definitions for rule in definition.rules}
    return [(DEATH, NO_CODESET), *sorted(rules - {(DEATH, NO_CODESET)})]


def questions(definitions: Iterable[CohortDefinition]) -> list[tuple]:
    """Rows of ``ASKED``: for each cohort the next death, and each rule with its bit of the mask."""
    asked: list[tuple] = []
    for definition in definitions:
        asked.append((len(asked), definition.cohort_id, NEXT_DEATH, None, None, None, None))
        for number, rule in enumerate(definition.rules):
            word, bit = divmod(number, RULES_PER_WORD)
            asked.append(
                (
                    len(asked), definition.cohort_id, number, rule.kind == AT_LEAST, rule.occurrences, word, 1 << bit,
                )
            )
    return asked


def targets(definition: CohortDefinition, codesets: list[tuple[str, int]]) -> list[tuple[int, int | None]]:
    """What a cohort's questions are about and how far they reach beyond the event's ``day_key``, in their order.

    Rules reach over deaths of their window's last day; a window that ends with the period has no reach.
    """
    rules = (
        (codesets.index((r.domain, r.codeset_id)), None if r.days_after is None else 2 * r.days_after + 1)
        for r in definition.rules
    )
    return [(DEATHS, 0), *rules]


def answered(rows: DataFrame) -> DataFrame:
    """Each question with ``found``, the events it counts, and ``censor_date``, the next death.

    ``rows`` are criterion events (``asked`` null) and questions of index events, both within a person's period,
    with what they are ``about``, ``day_key`` and ``reach``, and their events ``n``. They are sorted, so they hold
    numbers only; what else is known of a question is looked up by ``asked`` afterwards.
    """
    same = ["person_id", "op_start_date", "op_end_date", "about"]
    # A window without reach is past all days.
    place = F.coalesce(F.col("day_key") + F.col("reach"), F.lit((1 << 63) - 1))
    placed = rows.select(*same, "start_date", "asked", "n", place.alias("place"))
    so_far = Window.partitionBy(*same).orderBy("place", "asked").rowsBetween(Window.unboundedPreceding, 0)
    following = F.expr(
        f"lead(CASE WHEN asked IS NULL AND about = {DEATHS} THEN start_date END) IGNORE NULLS "
        f"OVER (PARTITION BY {', '.join(same)} ORDER BY place, asked)"
    )
    counted = F.sum(F.when(F.col("asked").isNull(), F.col("n"))).over(so_far)
    return placed.withColumns({"found": F.coalesce(counted, F.lit(0)), "censor_date": following}).where(
        "asked IS NOT NULL"
    )


def holds() -> Column:
    """Whether an answered question's rule is met."""
    return F.when(F.col("at_least"), F.col("found") >= F.col("occurrences")).otherwise(
        F.col("found") == F.col("occurrences")
    )


def mask_of_answers(words: int) -> dict[str, Column]:
    """Aggregates that put the answers to an event's questions into words: bit i is set when rule i holds."""
    return {
        name: F.coalesce(
            F.bit_or(F.when((F.col("word") == word) & holds(), F.col("bit"))), F.lit(0).cast("bigint")
        )
        for word, name in enumerate(word_names("rule_mask", words))
    }


def mask_columns(df: DataFrame, name: str) -> list[str]:
    """The columns of a mask in a frame, in the order of their words."""
    return word_names(name, sum(c == name or c.startswith(f"{name}_") for c in df.columns))


def meets_all_rules(qualified: DataFrame) -> DataFrame:
    """Index events whose mask has every bit of their cohort's rules."""
    words = zip(mask_columns(qualified, "rule_mask"), mask_columns(qualified, "full_mask"))
    return qualified.where(reduce(and_, (F.col(mask) == F.col(full) for mask, full in words)))
