"""Totals over age and gender."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

ALL = "All"
FIXED = ["database", "diseaseId", "diseaseCohortName", "drugId", "drugCohortName", "calDate", "analysis"]


def add_margins(rates: DataFrame) -> DataFrame:
    """Rates together with their sums over age, over gender and over both.

    ``grouping`` tells a total from a stratum of unknown age, which stays null.
    """
    strata = ["ageGroup", "Gender"]
    sets = [FIXED + strata, FIXED + ["ageGroup"], FIXED + ["Gender"], FIXED]
    summed = rates.groupingSets(sets, *FIXED, *strata).agg(
        F.sum("totalPatients").alias("totalPatients"),
        F.sum("Counts").alias("Counts"),
        F.grouping("ageGroup").alias("all_ages"),
        F.grouping("Gender").alias("all_genders"),
    )
    return summed.select(
        "database", "diseaseId", "diseaseCohortName", "drugId", "drugCohortName", "calDate",
        F.when(F.col("all_ages") == 1, ALL).otherwise(F.col("ageGroup")).alias("ageGroup"),
        F.when(F.col("all_genders") == 1, ALL).otherwise(F.col("Gender")).alias("Gender"),
        "totalPatients",
        "Counts",
        (F.col("Counts") / F.col("totalPatients")).alias("rate"),
        "analysis",
    )
