"""Places of rows within groups in a stated order, however large a group is."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from cohortloom.llm.common import fresh, partitions, written

PART_BITS = 33  # monotonically_increasing_id has the partition above so many bits


def numbered(rows: DataFrame, groups: list[str], order: list[str], place: str, size: str) -> DataFrame:
    """``rows`` with their place (from 0) within their group and the group's size.

    Nulls come first in ``order``; rows equal in it are placed in any order, the same at every reading of the
    result. ``groups`` hold no nulls. Rows are dealt by ranges of group, order and a number of their own and
    sorted there, so a group of any size, or a row given any number of times, is split; only a count for each
    group and range is put together over groups.
    """
    tie, at, part = fresh(rows, "tie"), fresh(rows, "at"), fresh(rows, "part")
    by = [*groups, *order, tie]
    stored = written(rows.withColumn(tie, F.monotonically_increasing_id()))
    dealt = written(
        stored.repartitionByRange(partitions(rows.sparkSession), *by)
        .sortWithinPartitions(*by)
        .drop(tie)
        .withColumn(at, F.monotonically_increasing_id())
    )
    dealt = dealt.withColumn(part, F.shiftright(at, PART_BITS))
    counted = dealt.groupBy(*groups, part).agg(F.min(at).alias("first_"), F.count("*").alias("n_"))
    group = Window.partitionBy(*groups)
    earlier = group.orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    runs = written(
        counted.select(
            *groups,
            part,
            (F.col("first_") - F.coalesce(F.sum("n_").over(earlier), F.lit(0))).alias("zero_"),
            F.sum("n_").over(group).alias(size),
        )
    )
    return (
        dealt.join(runs, [*groups, part])
        .withColumn(place, F.col(at) - F.col("zero_"))
        .select(*rows.columns, place, size)
    )
