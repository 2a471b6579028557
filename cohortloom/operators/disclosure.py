"""Masking of small cells."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


def mask_small_cells(rates: DataFrame, minimum: int) -> DataFrame:
    """Totals and counts below ``minimum`` read ``<minimum`` and their rate is zero.

    Under a masked total the count is zero as well. Totals and counts come back as
    strings; a minimum of zero masks nothing.
    """
    label = F.lit(f"<{minimum}")
    small_total = F.col("totalPatients") < minimum
    shown = F.when(small_total, 0).otherwise(F.col("Counts"))
    small_count = (shown > 0) & (shown < minimum)
    return rates.withColumns(
        {
            "totalPatients": F.when(small_total, label).otherwise(F.col("totalPatients").cast("string")),
            "Counts": F.when(small_count, label).otherwise(shown.cast("string")),
            "rate": F.when(small_total | small_count, F.lit(0.0)).otherwise(F.col("rate")),
        }
    )
