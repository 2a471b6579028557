"""Reproducible shuffle into shards: a Feistel permutation of global row numbers."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from cohortloom.llm.common import partitions, whole_text, written

ROUNDS = 6
LOCAL_BITS = 33  # monotonically_increasing_id() keeps a row's place in its partition here


def _mixed(x: np.ndarray) -> np.ndarray:
    """A 64-bit mixing step (the constants are those of splitmix64)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _half_bits(n: int) -> int:
    return (max(n - 1, 0).bit_length() + 1) // 2


def _keys(seed: int) -> np.ndarray:
    return _mixed(np.arange(1, ROUNDS + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(seed))


def _network(x: np.ndarray, half: int, keys) -> np.ndarray:
    mask, shift = np.uint64((1 << half) - 1), np.uint64(half)
    left, right = x >> shift, x & mask
    for key in keys:
        left, right = right, left ^ (_mixed(right + key) & mask)
    return (left << shift) | right


def _walked(x: np.ndarray, n: int, step) -> np.ndarray:
    """Apply ``step`` to each number until it is below ``n``: a permutation of 0..n-1."""
    x = step(x.astype(np.uint64))
    while (out := np.flatnonzero(x >= np.uint64(n))).size:
        x[out] = step(x[out])
    return x.astype(np.int64)


def permuted(numbers: np.ndarray, n: int, seed: int) -> np.ndarray:
    """Places of row numbers 0..n-1 after the shuffle."""
    half, keys = _half_bits(n), _keys(seed)
    return _walked(np.asarray(numbers), n, lambda x: _network(x, half, keys))


def restored(places: np.ndarray, n: int, seed: int) -> np.ndarray:
    """Row numbers of places: the inverse of :func:`permuted`."""
    half, keys = _half_bits(n), _keys(seed)[::-1]
    mask, shift = np.uint64((1 << half) - 1), np.uint64(half)

    def swapped(x):
        return (x << shift) & (mask << shift) | (x >> shift)

    # Read with its halves exchanged, the network run with the keys reversed undoes itself.
    return _walked(np.asarray(places), n, lambda x: swapped(_network(swapped(x), half, keys)))


def numbered(rows: DataFrame, order: list[str], name: str = "number") -> tuple[DataFrame, int]:
    """``rows`` with dense global numbers from 0 by ``order``, and how many there are.

    Rows are sorted over range partitions; the row's place in its partition plus the rows of
    earlier partitions is its number. Only one count for each partition reaches the driver. Rows
    equal in ``order`` are numbered by where they were read, so a large group of them is
    spread over partitions too.
    """
    spark, tie, part, local = rows.sparkSession, f"{name}_tie", f"{name}_part", f"{name}_local"
    keys = [*order, tie]
    placed = written(
        rows.withColumn(tie, F.monotonically_increasing_id())
        .repartitionByRange(partitions(spark), *keys)
        .sortWithinPartitions(*keys)
        .withColumn(part, F.spark_partition_id())
        .withColumn(local, F.monotonically_increasing_id().bitwiseAND(F.lit((1 << LOCAL_BITS) - 1)))
        .drop(tie)
    )
    before, total = [], 0
    for p, n in sorted((r[0], r[1]) for r in placed.groupBy(part).agg(F.count("*")).collect()):
        before.append((p, total))
        total += n
    starts = spark.createDataFrame(before, f"{part} int, {name}_before long")
    # One row for each partition, so the broadcast is bounded by their number.
    return (
        placed.join(F.broadcast(starts), part)
        .withColumn(name, F.col(f"{name}_before") + F.col(local))
        .drop(part, local, f"{name}_before"),
        total,
    )


def place_of(number: Column, n: int, seed: int) -> Column:
    @F.pandas_udf("long")
    def places(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for x in batches:
            yield pd.Series(permuted(x.to_numpy(np.int64), n, seed))

    return places(number)


def assign_shards(rows: DataFrame, order: list[str], shards: int, seed: int = 7) -> DataFrame:
    """``rows`` with columns ``number``, ``shard`` and ``slot``.

    The permuted number p goes to shard p mod ``shards``, slot p div ``shards``: shard sizes differ
    by one at most, slots have no gaps, and both can be computed from the number alone. Rows are
    never dropped; repeated rows and null keys are rows like others (nulls first), and an empty
    table stays empty.
    """
    with_numbers, n = numbered(rows, order)
    place = F.col("place_")
    return (
        with_numbers.withColumn("place_", place_of(F.col("number"), n, seed))
        .withColumn("shard", F.pmod(place, F.lit(shards)).cast("int"))
        .withColumn("slot", F.expr(f"place_ div {shards}"))
        .drop("place_")
    )


def shard_documents(docs: DataFrame, shards: int = 16, seed: int = 7) -> DataFrame:
    """Shard and slot of every document by the law of even row counts.

    Only ids, sizes and checksums move; texts stay where they are read. A null text is empty.
    Documents are numbered by doc_id, size and checksum, so the result doesn't depend on how the
    input is stored, but among rows equal in all three.
    """
    data = F.encode(whole_text("text"), "UTF-8")
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        (F.octet_length(data) + 1).cast("long").alias("size"),
        F.crc32(data).alias("text_crc32"),
    )
    return assign_shards(rows, ["doc_id", "size", "text_crc32"], shards, seed).select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
        "number",
    )
