"""The example study on tables derived from order data.

Disease 1 is what brands 1 and 2 lead to, without one part; disease 2 what brand 3
leads to; disease 3 a plain list of parts, which is also the indication that the
drug cohorts ask for. Whatever brand 4 leads to excludes from them. The last digit
of a part number is its strength.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession, functions as F

from cohortloom.model import AT_LEAST, DISEASE, DRUG, EXACTLY, CohortDefinition, Criterion, Rule
from cohortloom.operators.concepts import concept_items, resolve_concept_sets
from cohortloom.operators.dose import Strength
from cohortloom.operators.events import CONDITION, DRUG_SOURCE
from cohortloom.plans.cohorts import Codes
from cohortloom.sources.retail import PART_BASE
from cohortloom.sources.tables import Tables

DATABASE = "retail"
WINDOW_START, WINDOW_END = dt.date(1995, 1, 1), dt.date(2001, 12, 31)

INDICATIONS, EXCLUSIONS = 3, 4
ANY_STRENGTH = 10
STRENGTHS = tuple(
    Strength(label, ANY_STRENGTH + digit, amount)
    for digit, (label, amount) in enumerate(
        [("12", 12.0), ("25", 25.0), ("375", 37.5), ("50", 50.0), ("75", 75.0), ("100", 100.0)], start=1
    )
)

DRUG_RULES = (
    Rule(CONDITION, INDICATIONS, AT_LEAST, 1, days_after=0),
    Rule(CONDITION, EXCLUSIONS, EXACTLY, 0),
)


def disease(cohort_id: int, name: str) -> CohortDefinition:
    return CohortDefinition(cohort_id, name, DISEASE, (Criterion(CONDITION, cohort_id),))


def drug(cohort_id: int, name: str) -> CohortDefinition:
    return CohortDefinition(cohort_id, name, DRUG, (Criterion(DRUG_SOURCE, cohort_id),), DRUG_RULES)


DISEASES = (disease(1, "disease one"), disease(2, "disease two"), disease(INDICATIONS, "indications"))
DRUGS = (drug(ANY_STRENGTH, "drug"), *(drug(s.cohort_id, f"drug {s.label}") for s in STRENGTHS))
DEFINITIONS = DISEASES + DRUGS
PAIRS = tuple((a.cohort_id, b.cohort_id) for a in DISEASES for b in DRUGS)


def items(spark: SparkSession, tables: Tables) -> DataFrame:
    """The written concept sets; the list of indications grows with the vocabulary."""
    indications = tables["concept"].where(
        (F.col("concept_id") >= PART_BASE) & (F.col("concept_id") % 4 == 0)
    ).select(
        F.lit(INDICATIONS).cast("bigint").alias("codeset_id"),
        "concept_id",
        F.lit(False).alias("include_descendants"),
        F.lit(False).alias("is_excluded"),
    )
    return (
        concept_items(spark, 1, [101, 102], exclude=[10001])
        .unionByName(concept_items(spark, 2, [103]))
        .unionByName(concept_items(spark, EXCLUSIONS, [104]))
        .unionByName(indications)
    )


def drug_codes(tables: Tables) -> DataFrame:
    """Each part number of a known strength, in that strength's codeset and in the common one."""
    part = F.col("concept_id") - PART_BASE
    return (
        tables["concept"]
        .where((F.col("concept_id") >= PART_BASE) & (part % 10).between(1, len(STRENGTHS)))
        .select(
            F.explode(
                F.array(F.lit(ANY_STRENGTH).cast("bigint"), ANY_STRENGTH + part % 10)
            ).alias("codeset_id"),
            part.cast("string").alias("source_code"),
        )
    )


def codes(spark: SparkSession, tables: Tables) -> Codes:
    return Codes(
        resolve_concept_sets(tables["concept"], tables["concept_ancestor"], items(spark, tables)),
        drug_codes(tables),
    )
