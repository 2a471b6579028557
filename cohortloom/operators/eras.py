"""Merging of overlapping or touching intervals."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F


def collapse_eras(
    intervals: DataFrame, keys: list[str], start: str, end: str, pad: Column | int = 0
) -> DataFrame:
    """Eras of ``intervals`` within ``keys``: intervals at most ``pad`` days apart become one.

    Intervals with the same start are reduced to the longest first, so a key never
    has more rows to sort than there are calendar days. Where a start lies beyond
    all earlier ends an era opens, and those ends tell where the one before closed;
    the last era closes with the latest end of all.
    """
    pad = F.lit(pad) if isinstance(pad, int) else pad
    longest = intervals.groupBy(*keys, start).agg(F.max(end).alias(end), F.max(pad).alias("_pad"))
    ordered = Window.partitionBy(*keys).orderBy(start)
    opening = longest.withColumns(
        {
            "_reach": F.max(end).over(ordered.rowsBetween(Window.unboundedPreceding, -1)),
            "_latest": F.max(end).over(ordered.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)),
        }
    ).where(F.col("_reach").isNull() | (F.col(start) > F.date_add("_reach", F.col("_pad"))))
    closed = F.coalesce(F.lead("_reach").over(ordered), F.col("_latest"))
    return opening.select(*keys, start, closed.alias(end))
