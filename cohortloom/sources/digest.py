"""Digests of tables that don't depend on the order of their rows."""

from __future__ import annotations

import hashlib
from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

_DECIMAL = "decimal(38,0)"


def _row_hash(columns: list[str], second: bool = False) -> Column:
    """64 bits of hash of a row; nulls count, so that a value can't move between columns unseen."""
    values = [x for c in columns for x in (F.col(c), F.col(c).isNull())]
    return F.xxhash64(*([F.lit("second")] if second else []), *values)


def digest_columns(columns: list[str]) -> list[Column]:
    """Aggregates over rows: their number, and the sum and exclusive or of two hashes of each.

    A row given twice adds to number and sums, so multisets are told apart, not just sets.
    """
    one, two = _row_hash(columns), _row_hash(columns, second=True)
    return [
        F.count(F.lit(1)).alias("n"),
        F.coalesce(F.sum(one.cast(_DECIMAL)), F.lit(0).cast(_DECIMAL)).alias("sum_1"),
        F.coalesce(F.sum(two.cast(_DECIMAL)), F.lit(0).cast(_DECIMAL)).alias("sum_2"),
        F.coalesce(F.bit_xor(one), F.lit(0).cast("bigint")).alias("xor_1"),
    ]


def _digest(row) -> str:
    return hashlib.sha256(repr((row["n"], row["sum_1"], row["sum_2"], row["xor_1"])).encode()).hexdigest()


def table_digests(tables: Mapping[str, DataFrame]) -> dict[str, str]:
    """A digest of each table's rows, by name, from one job that reads each table once.

    Column names and types count too. Rows are hashed where they are read; one row for each table reaches the driver.
    """
    if not tables:
        return {}
    frames = [
        df.agg(*digest_columns(sorted(df.columns))).select(F.lit(name).alias("name"), "*")
        for name, df in sorted(tables.items())
    ]
    found = {r["name"]: _digest(r) for r in reduce(DataFrame.unionByName, frames).collect()}
    return {
        name: hashlib.sha256(f"{sorted(df.dtypes)}{found[name]}".encode()).hexdigest() for name, df in tables.items()
    }


def group_digests(df: DataFrame, key: str) -> dict:
    """A digest of the rows of each value of ``key``, of which there must be few (codesets, cohorts)."""
    columns = sorted(c for c in df.columns if c != key)
    return {r[key]: _digest(r) for r in df.groupBy(key).agg(*digest_columns(columns)).collect()}
