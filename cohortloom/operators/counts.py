"""Sizes of cohorts."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


def cohort_counts(cohort: DataFrame, registry: DataFrame) -> DataFrame:
    """Distinct subjects per cohort with its name; a cohort without rows has none here."""
    counted = cohort.groupBy(F.col("cohort_definition_id").alias("cohortDefinitionId")).agg(
        F.count_distinct("subject_id").alias("incidencecounts")
    )
    names = registry.select(F.col("cohortId").alias("cohortDefinitionId"), F.col("name").alias("cohortName"))
    return names.join(counted, "cohortDefinitionId").select(
        "cohortDefinitionId", "cohortName", "incidencecounts"
    )
