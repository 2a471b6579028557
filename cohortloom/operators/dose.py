"""Dose dispensed per patient."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, functions as F

from cohortloom.functions.strata import band_interval


@dataclass(frozen=True)
class Strength:
    """A strength of the drug: column label, cohort holding its eras, amount per era."""

    label: str
    cohort_id: int
    amount: float


def dose_summary(
    prepared: DataFrame, any_strength: int, strengths: Sequence[Strength], fanout: bool = True
) -> DataFrame:
    """Patients, eras per strength and amount per patient, by year, age and gender.

    Eras count once per observation period of the patient, or just once without
    ``fanout``. Only strata with a
    patient of the any-strength cohort appear. Subjects are added up first, so the
    distinct count needs no second pass and a stratum is never one task.
    """
    cohort = F.col("cohort_definition_id")
    times = F.col("n_periods") if fanout else F.lit(1).cast("bigint")
    eras = {s.label: f"Counts_{s.label}" for s in strengths}
    per_subject = (
        prepared.where(cohort.isin([any_strength, *{s.cohort_id for s in strengths}]))
        .groupBy("subject_id", F.col("start_year").alias("calDate"), "age_band", "gender")
        .agg(
            F.max(F.when(cohort == any_strength, 1).otherwise(0)).alias("is_patient"),
            *[
                F.sum(F.when(cohort == s.cohort_id, times).otherwise(0)).alias(eras[s.label])
                for s in strengths
            ],
        )
    )
    by_stratum = per_subject.groupBy("calDate", "age_band", "gender").agg(
        F.sum("is_patient").alias("totalPatients"),
        *[F.sum(name).alias(name) for name in eras.values()],
    )
    amount = sum((F.col(eras[s.label]) * s.amount for s in strengths), F.lit(0.0))
    total = sum((F.col(name) for name in eras.values()), F.lit(0).cast("bigint"))
    return by_stratum.where(F.col("totalPatients") > 0).select(
        "calDate",
        band_interval(F.col("age_band")).alias("ageGroup"),
        F.col("gender").alias("Gender"),
        "totalPatients",
        total.alias("totalCounts"),
        *eras.values(),
        (amount / F.col("totalPatients")).alias("rate"),
    )
