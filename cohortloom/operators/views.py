"""Selections of results for display."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F, types as T

from cohortloom.operators.rates import INCIDENCE_OF_DISEASE, PREVALENCE_OF_DISEASE, PREVALENCE_OF_DRUG

# Results after this year or day are shown, rates as percentages to
# four places.
SHOWN_AFTER_YEAR = 2016
SHOWN_AFTER_DAY = dt.date(2016, 12, 31)
PERCENT_DIGITS = 4


def displayed(rates: DataFrame, after: int | dt.date | None = None) -> DataFrame:
    """Results late enough to be shown; the default depends on the grain."""
    if after is None:
        yearly = isinstance(rates.schema["calDate"].dataType, T.IntegerType)
        after = SHOWN_AFTER_YEAR if yearly else SHOWN_AFTER_DAY
    return rates.where(F.col("calDate") > F.lit(after))


def rates_view(
    rates: DataFrame,
    *,
    database: str,
    analysis: str,
    disease: str,
    drug: str,
    age_groups: Sequence[str] = ("All",),
    genders: Sequence[str] = ("All",),
    after: int | dt.date | None = None,
) -> DataFrame:
    """The rows of one analysis and cohort choice, as a table of percentages."""
    chosen = displayed(rates, after).where(
        (F.col("database") == database)
        & (F.col("analysis") == analysis)
        & (F.col("diseaseCohortName") == disease)
        & (F.col("drugCohortName") == drug)
        & F.col("ageGroup").isin(list(age_groups))
        & F.col("Gender").isin(list(genders))
    )
    measure = "Incidence(%)" if analysis == INCIDENCE_OF_DISEASE else "Prevalence(%)"
    return chosen.select(
        "diseaseCohortName", "drugCohortName", F.col("calDate").cast("string").alias("calDate"),
        "ageGroup", "Gender",
        F.bround(F.col("rate") * 100, PERCENT_DIGITS).alias(measure),
    )


def _shown(rates: DataFrame, analysis: str, after: int | dt.date | None) -> DataFrame:
    """Results of an analysis that are shown; choices without dates are shown whole."""
    chosen = rates.where(F.col("analysis") == analysis)
    return displayed(chosen, after) if "calDate" in rates.columns else chosen


def available_diseases(rates: DataFrame, analysis: str, after: int | dt.date | None = None) -> DataFrame:
    """Diseases to choose from: those with results that are shown."""
    return _shown(rates, analysis, after).select("diseaseCohortName").distinct()


def available_drugs(
    rates: DataFrame, analysis: str, disease: str, after: int | dt.date | None = None
) -> DataFrame:
    """Drugs to choose from; for some analyses they depend on the disease chosen."""
    matching = _shown(rates, analysis, after)
    if analysis not in (INCIDENCE_OF_DISEASE, PREVALENCE_OF_DISEASE, PREVALENCE_OF_DRUG):
        matching = matching.where(F.col("diseaseCohortName") == disease)
    return matching.select("drugCohortName").distinct()
