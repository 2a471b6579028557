"""The observed population, its demographics, and how many were observed when."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, functions as F

from cohortloom.functions.dates import (
    age_in_year, as_date, birth_date, follow_up_years, month_index, month_start,
)
from cohortloom.functions.strata import age_band, band_interval, gender_label


def observed_population(
    person: DataFrame, observation_period: DataFrame, year_from: int, year_to: int
) -> DataFrame:
    """Observation periods overlapping the years, of persons with a known birth year.

    Equal periods of a person are one row with their number in ``n_periods``. The
    overlap is written as plain date bounds so that it reaches the scan. Periods are
    shuffled once, by person, for combining them and for the join.
    """
    periods = (
        observation_period.where(
            (F.col("observation_period_start_date") <= F.lit(dt.date(year_to, 12, 31)))
            & (F.col("observation_period_end_date") >= F.lit(dt.date(year_from, 1, 1)))
        )
        .repartition("person_id")
        .groupBy("person_id", "observation_period_start_date", "observation_period_end_date")
        .agg(F.count(F.lit(1)).alias("n_periods"))
    )
    known = person.where(F.col("year_of_birth").isNotNull()).select(
        "person_id",
        "gender_concept_id",
        gender_label(F.col("gender_concept_id")).alias("gender"),
        birth_date(F.col("year_of_birth"), F.col("month_of_birth"), F.col("day_of_birth")).alias("dob"),
    )
    start, end = F.col("observation_period_start_date"), F.col("observation_period_end_date")
    return periods.join(known, "person_id").select(
        F.col("person_id").alias("subject_id"),
        "gender_concept_id",
        "gender",
        "dob",
        start.alias("cohort_start_date"),
        end.alias("cohort_end_date"),
        F.year(start).alias("start_year"),
        F.year(end).alias("end_year"),
        month_start(start).alias("start_month"),
        month_start(end).alias("end_month"),
        "n_periods",
    )


def person_strata(population: DataFrame) -> DataFrame:
    """One row per subject, with the number of their observation periods."""
    return population.groupBy("subject_id", "gender", "dob").agg(F.sum("n_periods").alias("n_periods"))


def attach_demographics(cohort: DataFrame, population: DataFrame) -> DataFrame:
    """Cohort rows of observed subjects with gender, age and calendar columns.

    ``n_periods`` says how often a row counts when rows are counted per observation
    period; ``expand_periods`` turns it into that many rows.
    """
    start = F.col("cohort_start_date")
    return (
        cohort.join(person_strata(population), "subject_id")
        .withColumn("start_year", F.year(start))
        .withColumn("start_month", month_start(start))
        .withColumn("age", age_in_year(F.col("dob"), F.col("start_year")))
        .withColumn("age_band", age_band(F.col("age")))
        .select(
            "cohort_definition_id", "subject_id", "cohort_start_date", "cohort_end_date", "gender", "dob",
            "n_periods", "start_year", "start_month", "age", "age_band",
        )
    )


def expand_periods(prepared: DataFrame) -> DataFrame:
    """Prepared rows repeated once per observation period, with interval age labels."""
    return (
        prepared.withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("n_periods"))))
        .withColumn("age_group", band_interval(F.col("age_band")))
        .drop("_copy", "n_periods", "age_band")
    )


def _active_months(year: int) -> Column:
    """Bits 0..11 for the months of ``year`` touched by a period."""
    january = year * 12
    first = F.greatest(month_index(F.col("cohort_start_date")) - january, F.lit(0))
    last = F.least(month_index(F.col("cohort_end_date")) - january, F.lit(11))
    one = F.lit(1)
    bits = F.call_function("shiftleft", one, last + 1) - F.call_function("shiftleft", one, first)
    return F.when(first <= last, bits).otherwise(0)


def _strata_by_year(population: DataFrame, years: range) -> DataFrame:
    """Subjects per year, age band and gender, with a count for each month of the year.

    A subject's periods are combined into twelve bits per year before anything is
    exploded, so a subject is counted once per month however many periods cover it,
    and only one row per subject is shuffled.
    """
    subjects = population.groupBy("subject_id", "gender", "dob").agg(
        *[F.bit_or(_active_months(year)).alias(f"months_{year}") for year in years]
    )
    by_year = F.array(
        *[F.struct(F.lit(year).alias("year"), F.col(f"months_{year}").alias("months")) for year in years]
    )
    return (
        subjects.select("gender", "dob", F.inline(by_year))
        .where(F.col("months") != 0)
        .groupBy("year", age_band(age_in_year(F.col("dob"), F.col("year"))).alias("age_band"), "gender")
        .agg(
            F.count(F.lit(1)).alias("in_year"),
            *[
                F.sum(F.shiftright("months", month).bitwiseAND(F.lit(1))).alias(f"in_month_{month + 1}")
                for month in range(12)
            ],
        )
    )


def population_by_year(population: DataFrame, year_from: int, year_to: int) -> DataFrame:
    """Subjects observed in each calendar year, by age on 1 July and gender."""
    return _strata_by_year(population, range(year_from, year_to + 1)).select(
        F.col("year").alias("calDate"), "age_band", "gender", F.col("in_year").alias("totalPatients")
    )


def population_by_month(population: DataFrame, month_from: dt.date | str, month_to: dt.date | str) -> DataFrame:
    """Subjects observed in each calendar month, by age on 1 July of its year and gender."""
    first, last = as_date(month_from).replace(day=1), as_date(month_to).replace(day=1)
    months = F.array(
        *[
            F.struct(
                F.make_date(F.col("year"), F.lit(month), F.lit(1)).alias("calDate"),
                F.col(f"in_month_{month}").alias("totalPatients"),
            )
            for month in range(1, 13)
        ]
    )
    return (
        _strata_by_year(population, range(first.year, last.year + 1))
        .select("age_band", "gender", F.inline(months))
        .where((F.col("totalPatients") > 0) & F.col("calDate").between(F.lit(first), F.lit(last)))
        .select("calDate", "age_band", "gender", "totalPatients")
    )


def dataset_counts(population: DataFrame) -> DataFrame:
    """Distinct subjects, and follow-up years rounded per period and added up."""
    years = follow_up_years(F.col("cohort_start_date"), F.col("cohort_end_date"))
    per_subject = population.groupBy("subject_id").agg(F.sum(years * F.col("n_periods")).alias("years"))
    return per_subject.agg(
        F.count(F.lit(1)).alias("total_counts"),
        F.sum("years").cast("bigint").alias("total_followup_yr"),
    )
