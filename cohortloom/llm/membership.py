"""A bounded bitmap of keys, which says of most rows that they have none of them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from cohortloom.llm.common import fresh, written

BITS = 26  # the bitmap has 2 ** 26 bits, 8 MB
_MAP_BITS = 15  # Spark's bitmaps have 2 ** 15 bits


def _slot(key: list[Column]) -> Column:
    return F.shiftrightunsigned(F.xxhash64(F.lit("slot"), *key), 64 - BITS)


def with_possible(rows: DataFrame, key: list[Column], keys: DataFrame, name: str) -> DataFrame:
    """``rows`` with ``name``: false where a row's key is surely not among ``keys`` (all of its columns).

    Keys set bits of a bitmap that has 8 MB whatever their number, so it is broadcast. Of n keys a row of another key
    is taken for one of them with a chance of n / 2 ** 26 at most; such rows, and keys beyond
    number, only make what follows read more. Null parts of keys are equal.
    """
    of_keys = keys.select(_slot([F.col(c) for c in keys.columns]).alias("slot"))
    maps = written(
        of_keys.groupBy(F.shiftright("slot", _MAP_BITS).alias("map_"))
        .agg(F.bitmap_construct_agg(F.col("slot").bitwiseAND(F.lit((1 << _MAP_BITS) - 1))).alias("bits_"))
    )
    slot, number = fresh(rows, "slot"), fresh(rows, "number")
    found = rows.withColumn(slot, _slot(key))
    found = found.join(
        F.broadcast(maps.withColumnRenamed("map_", number)), F.shiftright(slot, _MAP_BITS) == F.col(number), "left"
    )
    at = F.col(slot).bitwiseAND(F.lit((1 << _MAP_BITS) - 1))
    byte = F.conv(F.hex(F.substring("bits_", (F.floor(at / 8) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
    bit = F.call_function("shiftright", byte, (at % 8).cast("int")).bitwiseAND(F.lit(1)) == 1
    return found.withColumn(name, F.coalesce(bit, F.lit(False))).select(*rows.columns, name)
