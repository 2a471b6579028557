"""Incidence and prevalence proportions for cohorts and cohort pairs.

Each subject and period is reduced to the set of cohorts entered in it, held as
bits, and the set entered for the first time. Those sets are counted by stratum;
every analysis then reads the small table of counted sets, so six analyses share
one pass over the cohort rows and no disease row ever meets a drug row.

Which bit a cohort has, and which drugs a disease is paired with, are rows of small
tables that are broadcast, so plans don't grow with the number of cohorts but for
one word per 62 of them. (Spark's own bitmaps would take 4 KB for each set.)
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from cohortloom.functions.dates import as_date
from cohortloom.functions.strata import band_label
from cohortloom.session import local_frame

YEAR, MONTH = "year", "month"
ANY, FIRST = "any", "first"

# Names of the analyses, and what stands in for an absent cohort.
INCIDENCE_OF_DISEASE = "Incidence of Disease"
PREVALENCE_OF_DISEASE = "Prevalence of Disease"
INCIDENCE_OF_DRUG = "Incidence of Drug"
PREVALENCE_OF_DRUG = "Prevalence of Drug"
PREVALENCE_OF_DRUG_IN_DISEASE = "Prevalence of Drug in Disease Cohort"
INCIDENCE_OF_DRUG_IN_DISEASE = "incidence of Drug in Disease Cohort"
ABSENT = "Nil"

# For each analysis, which entries of diseases and drugs it counts.
ANALYSES = {
    INCIDENCE_OF_DISEASE: (FIRST, None),
    PREVALENCE_OF_DISEASE: (ANY, None),
    INCIDENCE_OF_DRUG: (None, FIRST),
    PREVALENCE_OF_DRUG: (None, ANY),
    PREVALENCE_OF_DRUG_IN_DISEASE: (ANY, ANY),
    INCIDENCE_OF_DRUG_IN_DISEASE: (ANY, FIRST),
}

_BITS_PER_WORD = 62


def within_months(prepared: DataFrame, month_from: dt.date | str, month_to: dt.date | str) -> DataFrame:
    """Rows whose start month lies in the window. Yearly results use it as well."""
    first, last = as_date(month_from).replace(day=1), as_date(month_to).replace(day=1)
    return prepared.where(F.col("start_month").between(F.lit(first), F.lit(last)))


@dataclass(frozen=True)
class Profiles:
    """Counted sets of cohorts per stratum: ``calDate, age_band, gender, n_subjects`` and set words."""

    counted: DataFrame
    cohort_ids: tuple[int, ...]

    @property
    def words(self) -> range:
        return range(-(-len(self.cohort_ids) // _BITS_PER_WORD))

    def members(self, kind: str) -> Column:
        """Places in ``cohort_ids`` of the cohorts that are in a row's set, as an array."""
        bits = F.sequence(F.lit(0), F.lit(_BITS_PER_WORD - 1))

        def of_word(word: int) -> Column:
            def is_set(bit: Column) -> Column:
                return F.call_function("shiftright", F.col(f"{kind}_{word}"), bit).bitwiseAND(F.lit(1)) == 1

            return F.transform(F.filter(bits, is_set), lambda bit: bit + word * _BITS_PER_WORD)

        return F.concat(F.array().cast("array<int>"), *[of_word(word) for word in self.words])


def stratum_profiles(prepared: DataFrame, cohort_ids: Sequence[int], grain: str) -> Profiles:
    """Sets of cohorts entered, and entered first, per period and stratum.

    A first entry is a bit that no earlier period of the subject has.
    """
    cohort_ids = tuple(cohort_ids)
    words = range(-(-len(cohort_ids) // _BITS_PER_WORD))
    period = "start_year" if grain == YEAR else "start_month"
    places = [
        (cohort_id, place // _BITS_PER_WORD, 1 << place % _BITS_PER_WORD) for place, cohort_id in enumerate(cohort_ids)
    ]
    bits = F.broadcast(local_frame(prepared.sparkSession, places, "cohort_definition_id int, word int, bit bigint"))
    prepared = prepared.join(bits, "cohort_definition_id")

    def own_bit(word: int) -> Column:
        return F.when(F.col("word") == word, F.col("bit")).otherwise(F.lit(0).cast("bigint"))

    any_words = [f"{ANY}_{w}" for w in words]
    first_words = [f"{FIRST}_{w}" for w in words]
    subjects = prepared.groupBy("subject_id", "gender", "age_band", F.col(period).alias("calDate")).agg(
        *[F.bit_or(own_bit(w)).alias(any_words[w]) for w in words]
    )
    earlier = Window.partitionBy("subject_id").orderBy("calDate").rowsBetween(Window.unboundedPreceding, -1)
    subjects = subjects.withColumns(
        {
            first: F.col(entered).bitwiseAND(
                F.bitwise_not(F.coalesce(F.bit_or(entered).over(earlier), F.lit(0).cast("bigint")))
            )
            for entered, first in zip(any_words, first_words)
        }
    )
    counted = subjects.groupBy("calDate", "age_band", "gender", *any_words, *first_words).agg(
        F.count(F.lit(1)).alias("n_subjects")
    )
    return Profiles(counted, cohort_ids)


_STRATUM = ["calDate", "age_band", "gender"]
_IDS = ["analysis", "diseaseId", "drugId"]


def _unique(values) -> list:
    return list(dict.fromkeys(values))


def _diseases(pairs: Sequence[tuple[int, int]]) -> list[int]:
    return _unique(disease for disease, _ in pairs)


def _drugs(pairs: Sequence[tuple[int, int]]) -> list[int]:
    return _unique(drug for _, drug in pairs)


_OF_DISEASE, _OF_DRUG, _OF_PAIR = "disease", "drug", "pair"


def _role(analysis: str) -> str:
    of_disease, of_drug = ANALYSES[analysis]
    return _OF_DRUG if of_disease is None else _OF_DISEASE if of_drug is None else _OF_PAIR


def _roles_frame(profiles: Profiles, pairs: Sequence[tuple[int, int]], analyses: Sequence[str]) -> DataFrame:
    """What each cohort is to the analyses: by role and place, its id and the drugs it is paired with.

    Profiles needn't hold cohorts that no analysis is about.
    """
    place = {cohort_id: i for i, cohort_id in enumerate(profiles.cohort_ids)}
    paired: dict[int, list[int]] = {}
    for disease, drug in dict.fromkeys(pairs):
        paired.setdefault(disease, []).append(drug)
    rows_of = {
        _OF_DISEASE: lambda: [(_OF_DISEASE, place[d], d, None) for d in paired],
        _OF_DRUG: lambda: [(_OF_DRUG, place[g], g, None) for g in _drugs(pairs)],
        _OF_PAIR: lambda: [
            (_OF_PAIR, place[d], d, [{"place": place[g], "drug": g} for g in drugs]) for d, drugs in paired.items()
        ],
    }
    rows = [row for role in _unique(map(_role, analyses)) for row in rows_of[role]()]
    schema = "role string, place int, cohort int, partners array<struct<place: int, drug: int>>"
    return F.broadcast(local_frame(profiles.counted.sparkSession, rows, schema))


def analysis_counts(
    profiles: Profiles, pairs: Sequence[tuple[int, int]], analyses: Sequence[str]
) -> DataFrame:
    """Subjects per analysis, cohort or pair of cohorts, period and stratum.

    A counted set is unrolled to its members, and a disease's partners to those that are in the set
    too; what a member is to the study comes from a broadcast table.
    """

    def entered(analysis: str) -> Column:
        of_disease, of_drug = ANALYSES[analysis]
        others = profiles.members(of_drug) if of_disease and of_drug else F.lit(None).cast("array<int>")
        return F.transform(
            profiles.members(of_disease or of_drug),
            lambda place: F.struct(
                F.lit(analysis).alias("analysis"), F.lit(_role(analysis)).alias("role"), place.alias("place"),
                others.alias("others"),
            ),
        )

    members = profiles.counted.select(
        F.inline(F.concat(*[entered(a) for a in analyses])), *_STRATUM, "n_subjects"
    ).join(_roles_frame(profiles, pairs, analyses), ["role", "place"])
    present = F.filter("partners", lambda p: F.array_contains("others", p["place"]))
    drugs = F.when(F.col("role") == _OF_PAIR, F.transform(present, lambda p: p["drug"])).otherwise(
        F.array(F.when(F.col("role") == _OF_DRUG, F.col("cohort")))
    )
    return (
        members.select(
            "analysis", F.when(F.col("role") != _OF_DRUG, F.col("cohort")).alias("diseaseId"),
            F.explode(drugs).alias("drugId"), *_STRATUM, "n_subjects",
        )
        .groupBy(*_IDS, *_STRATUM)
        .agg(F.sum("n_subjects").alias("Counts"))
    )


def _for_each_stratum(population: DataFrame, identities: Sequence[tuple]) -> DataFrame:
    """Every stratum of the population for each of the analyses' cohorts, which are as many as the study's."""
    listed = local_frame(
        population.sparkSession, [(0, *x) for x in identities], "part int, analysis string, diseaseId int, drugId int"
    )
    # A part that all strata share, but not a constant: that would make the join a nested loop.
    return population.withColumn("part", F.pmod(F.hash(*_STRATUM), F.lit(1))).join(F.broadcast(listed), "part").select(
        *_IDS, *_STRATUM, "totalPatients"
    )


def _pairs_frame(spark: SparkSession, pairs: Sequence[tuple[int, int]]) -> DataFrame:
    return F.broadcast(local_frame(spark, pairs, "diseaseId int, drugId int"))


def compute_rates(
    population: DataFrame | None,
    profiles: Profiles,
    pairs: Sequence[tuple[int, int]],
    analyses: Sequence[str] = tuple(ANALYSES),
) -> DataFrame:
    """Counts over denominators for each analysis.

    Cohorts are set against every stratum of the observed population, with zero
    where nobody entered. Pairs are set against the subjects with an entry of the
    disease in the period, whichever drug entries they count. Unknown age matches
    unknown age.
    """
    single = [a for a in analyses if None in ANALYSES[a]]
    paired = [a for a in analyses if None not in ANALYSES[a]]
    needed = _unique([*analyses, *([PREVALENCE_OF_DISEASE] if paired else [])])
    counts = analysis_counts(profiles, pairs, needed)
    denominators = []
    if single:
        of_diseases = [(a, d, None) for a in single if _role(a) == _OF_DISEASE for d in _diseases(pairs)]
        of_drugs = [(a, None, g) for a in single if _role(a) == _OF_DRUG for g in _drugs(pairs)]
        denominators.append(_for_each_stratum(population, [*of_diseases, *of_drugs]))
    if paired:
        with_disease = counts.where(F.col("analysis") == PREVALENCE_OF_DISEASE)
        denominators.append(
            with_disease.select("diseaseId", *_STRATUM, F.col("Counts").alias("totalPatients"))
            .join(_pairs_frame(profiles.counted.sparkSession, pairs), "diseaseId")
            .select(
                F.explode(F.array(*[F.lit(a) for a in paired])).alias("analysis"),
                "diseaseId", "drugId", *_STRATUM, "totalPatients",
            )
        )
    denominator = denominators[0] if len(denominators) == 1 else denominators[0].unionByName(denominators[1])
    d, c = denominator.alias("d"), counts.alias("c")
    same = F.lit(True)
    for key in (*_IDS, *_STRATUM):
        same = same & F.col(f"d.{key}").eqNullSafe(F.col(f"c.{key}"))
    return (
        d.join(c, same, "left")
        .select("d.*", F.coalesce("c.Counts", F.lit(0)).alias("Counts"))
        .withColumn("rate", F.col("Counts") / F.col("totalPatients"))
    )


def registry_frame(spark: SparkSession, names: Sequence[tuple[int, str]]) -> DataFrame:
    """Cohort names for attaching to results, one row per cohort of the study."""
    return F.broadcast(local_frame(spark, names, "cohortId int, name string"))


def format_rates(rates: DataFrame, registry: DataFrame, database: str) -> DataFrame:
    """Result rows with names and labels, and ``Nil`` for the cohort an analysis does not have.

    Cohorts missing from the registry drop out.
    """
    named = rates
    for id_name, name in (("diseaseId", "diseaseCohortName"), ("drugId", "drugCohortName")):
        names = registry.select(F.col("cohortId").alias(id_name), F.col("name").alias(name))
        named = named.join(names, id_name, "left").where(F.col(id_name).isNull() | F.col(name).isNotNull())
    return named.select(
        F.lit(database).alias("database"),
        F.coalesce(F.col("diseaseId").cast("string"), F.lit(ABSENT)).alias("diseaseId"),
        F.coalesce("diseaseCohortName", F.lit(ABSENT)).alias("diseaseCohortName"),
        F.coalesce(F.col("drugId").cast("string"), F.lit(ABSENT)).alias("drugId"),
        F.coalesce("drugCohortName", F.lit(ABSENT)).alias("drugCohortName"),
        "calDate",
        band_label(F.col("age_band")).alias("ageGroup"),
        F.col("gender").alias("Gender"),
        "totalPatients",
        "Counts",
        "rate",
        "analysis",
    )


def combined_rates(
    population: DataFrame,
    profiles: Profiles,
    pairs: Sequence[tuple[int, int]],
    registry: DataFrame,
    database: str,
) -> DataFrame:
    """The six analyses of one grain in one frame."""
    return format_rates(compute_rates(population, profiles, pairs), registry, database)
