"""Stored tables in buckets of a key, so that what joins or groups by the key needs no exchange.

The files are plain Parquet and can be read as such. That they are in buckets is said in the session's
catalog, where a table is entered again by whoever opens its folder.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence
from contextlib import contextmanager
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from cohortloom.session import local_frame


@dataclass(frozen=True)
class BucketedTable:
    """A folder of files by the values of ``keys`` (none for one folder) and in buckets of ``key``."""

    spark: SparkSession
    path: str
    schema: T.StructType
    key: str
    buckets: int
    keys: tuple[str, ...] = ()

    @property
    def name(self) -> str:
        return f"bucketed_{hashlib.md5(f'{self.path}/{self.buckets}'.encode()).hexdigest()}"

    @property
    def columns(self) -> list[str]:
        return [*(f.name for f in self.schema if f.name not in self.keys), *self.keys]

    def create(self) -> None:
        """An empty table in place of whatever lies in the folder."""
        self.spark.sql(f"DROP TABLE IF EXISTS {self.name}")
        empty = local_frame(self.spark, [], self.schema).select(*self.columns)
        empty.write.mode("overwrite").partitionBy(*self.keys).parquet(self.path)
        if not self.keys:
            # Without folders for slices the empty file itself would be taken for a bucket.
            self._enter()
            self._fill(empty)

    def _enter(self) -> None:
        if self.spark.catalog.tableExists(self.name):
            return
        fields = {f.name: f.dataType.simpleString() for f in self.schema}
        columns = ", ".join(f"{c} {fields[c]}" for c in self.columns)
        parted = f"PARTITIONED BY ({', '.join(self.keys)})" if self.keys else ""
        self.spark.sql(
            f"CREATE TABLE {self.name} ({columns}) USING parquet {parted} CLUSTERED BY ({self.key}) "
            f"SORTED BY ({self.key}) INTO {self.buckets} BUCKETS LOCATION '{self.path}'"
        )
        if self.keys:
            self.spark.catalog.recoverPartitions(self.name)

    def _fill(self, rows: DataFrame) -> None:
        # A task holds one bucket, so a slice has one file for each.
        with _overwriting_slices(self.spark):
            rows.select(*self.columns).repartition(self.buckets, self.key).write.mode("overwrite").insertInto(self.name)

    def replace(self, rows: DataFrame, slices: Sequence[tuple] = ()) -> None:
        """Replaces the rows of the given key values, or all rows of a table without keys."""
        self._enter()
        if not self.keys:
            self._fill(rows)
            return
        here = [reduce(lambda a, b: a & b, [F.col(k) == v for k, v in zip(self.keys, values)]) for values in slices]
        for values in slices:  # those that have no rows now must lose theirs
            self._clear(values)
        self._fill(rows.where(reduce(Column.__or__, here)))

    def _clear(self, values: tuple) -> None:
        where = ", ".join(f"{k} = {v!r}" for k, v in zip(self.keys, values))
        nothing = ", ".join(
            f"CAST(NULL AS {f.dataType.simpleString()}) AS {f.name}" for f in self.schema if f.name not in self.keys
        )
        self.spark.sql(f"INSERT OVERWRITE TABLE {self.name} PARTITION ({where}) SELECT {nothing} WHERE false")

    def read(self) -> DataFrame:
        self._enter()
        return self.spark.table(self.name).select(*self.schema.names)


@contextmanager
def _overwriting_slices(spark: SparkSession) -> Iterator[None]:
    name = "spark.sql.sources.partitionOverwriteMode"
    before = spark.conf.get(name)
    spark.conf.set(name, "dynamic")
    try:
        yield
    finally:
        spark.conf.set(name, before)
