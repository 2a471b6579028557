"""Diagnoses beside drug use, over the whole window."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F

from cohortloom.functions.strata import band_interval


def diagnosis_profile(
    prepared: DataFrame, drug_id: int, disease_ids: Sequence[int], restrict_to_drug: bool = False
) -> DataFrame:
    """Patients of each disease over patients of the drug, by age and gender.

    Both sides count whoever is in the stratum; the disease patients need not use
    the drug, so the rate may exceed one. With ``restrict_to_drug`` only those who
    use it, in whatever stratum, are counted.
    """
    entries = (
        prepared.where(F.col("cohort_definition_id").isin([drug_id, *disease_ids]))
        .select("cohort_definition_id", "age_band", "gender", "subject_id")
        .distinct()
    )
    if restrict_to_drug:
        uses = F.max(F.col("cohort_definition_id") == drug_id).over(Window.partitionBy("subject_id"))
        entries = entries.withColumn("uses_drug", uses).where("uses_drug")
    counts = (
        entries.groupBy("cohort_definition_id", "age_band", "gender")
        .agg(F.count(F.lit(1)).alias("patients"))
    )
    is_drug = F.col("cohort_definition_id") == drug_id
    by_stratum = counts.groupBy("age_band", "gender").agg(
        F.max(F.when(is_drug, F.col("patients"))).alias("totalPatients"),
        F.map_from_entries(
            F.collect_list(F.when(~is_drug, F.struct("cohort_definition_id", "patients")))
        ).alias("by_disease"),
    )
    return (
        by_stratum.where(F.col("totalPatients").isNotNull())
        .withColumn("diseaseId", F.explode(F.array(*[F.lit(i) for i in disease_ids])))
        .withColumn("Counts", F.coalesce(F.try_element_at("by_disease", F.col("diseaseId")), F.lit(0)))
        .select(
            "diseaseId",
            band_interval(F.col("age_band")).alias("ageGroup"),
            F.col("gender").alias("Gender"),
            "totalPatients",
            "Counts",
            (F.col("Counts") / F.col("totalPatients")).alias("rate"),
        )
    )
