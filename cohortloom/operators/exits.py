"""When a person leaves the cohort."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def offset_exit(days: Column | int = 1) -> Column:
    """A fixed number of days after the start, not beyond the observation period."""
    offset = F.lit(days) if isinstance(days, int) else days
    return F.least(F.date_add("start_date", offset), F.col("op_end_date"))


def first_exit(days: Column | int = 1, censored: Column | bool = True) -> Column:
    """The earlier of the offset exit and, where censored, the next death."""
    censored = F.lit(censored) if isinstance(censored, bool) else censored
    return F.least(offset_exit(days), F.when(censored, F.col("censor_date")))
