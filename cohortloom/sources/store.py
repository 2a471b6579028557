"""Stored cohorts and results."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F, types as T

from cohortloom.schemas import COHORT
from cohortloom.session import local_frame

COHORT_KEYS = ["cohort_definition_id"]
IMPACT_KEYS = ["cohort_definition_id", "mode_id"]
DISPLAY_KEYS = ["analysis", "diseaseCohortName"]


def create_table(spark: SparkSession, path: str, schema: T.StructType, keys: list[str]) -> None:
    """An empty partitioned table in place of whatever is at ``path``."""
    local_frame(spark, [], schema).write.mode("overwrite").partitionBy(*keys).parquet(path)


def create_cohort_table(spark: SparkSession, path: str) -> None:
    create_table(spark, path, COHORT, COHORT_KEYS)


def replace_slices(df: DataFrame, path: str, keys: list[str], slices: Sequence[tuple]) -> dict[tuple, int]:
    """Replaces the rows of the given key values, other slices stay; returns rows per slice.

    Slices with rows are overwritten as partitions. A slice that has none now
    would keep its old rows that way, so it is overwritten with an empty file.
    Rows are counted while they are written. A large slice is spread over several
    tasks and small ones share a task.
    """

    def in_slice(values: tuple) -> Column:
        return reduce(lambda a, b: a & b, [F.col(k) == v for k, v in zip(keys, values)])

    slices = [tuple(values) for values in slices]
    counted = Observation()
    counts = [F.count(F.when(in_slice(v), 1)).alias(f"slice_{i}") for i, v in enumerate(slices)]
    (
        df.where(reduce(lambda a, b: a | b, [in_slice(v) for v in slices]))
        .observe(counted, *counts)
        .hint("rebalance", *keys)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*keys)
        .parquet(path)
    )
    rows = {values: counted.get[f"slice_{i}"] for i, values in enumerate(slices)}
    for values in (v for v, n in rows.items() if n == 0):
        folder = "/".join(f"{key}={value}" for key, value in zip(keys, values))
        stored = T.StructType([f for f in df.schema if f.name not in keys])
        local_frame(df.sparkSession, [], stored).write.mode("overwrite").parquet(f"{path}/{folder}")
    return rows


def write_cohorts(cohort: DataFrame, path: str, cohort_ids: Sequence[int]) -> dict[tuple, int]:
    """Deletes and inserts the rows of the given cohorts."""
    return replace_slices(cohort.select(*COHORT.names), path, COHORT_KEYS, [(i,) for i in cohort_ids])


def read_cohorts(spark: SparkSession, path: str, cohort_ids: Sequence[int] | None = None) -> DataFrame:
    """Cohort rows, reading only the folders of the cohorts asked for."""
    rows = spark.read.schema(COHORT).parquet(path)
    return rows if cohort_ids is None else rows.where(F.col("cohort_definition_id").isin(list(cohort_ids)))


def write_display(shown: DataFrame, path: str) -> None:
    """Displayed results, clustered by analysis and disease: a view reads the folder of its choice.

    Results are as long as the study's cohorts, periods and strata; the slices of one analysis are spread over tasks.
    """
    (
        shown.hint("rebalance", *DISPLAY_KEYS)
        .sortWithinPartitions(*DISPLAY_KEYS, "drugCohortName", "calDate")
        .write.mode("overwrite")
        .partitionBy(*DISPLAY_KEYS)
        .parquet(path)
    )


def read_display(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Displayed results in their declared columns."""
    return spark.read.schema(schema).parquet(path).select(*schema.names)


def read_marks(spark: SparkSession, path: str) -> dict[str, str]:
    """What the parts of a stored study were made from, by part; nothing where no marks are."""
    try:
        found = spark.read.schema("part string, mark string").parquet(path).collect()
    except AnalysisException as problem:
        if problem.getCondition() != "PATH_NOT_FOUND":
            raise
        return {}
    return {r["part"]: r["mark"] for r in found}


def write_marks(spark: SparkSession, path: str, marks: dict[str, str]) -> None:
    """Replaces the marks, which are as many as the study has cohorts. If it is cut short, none are left."""
    local_frame(spark, sorted(marks.items()), "part string, mark string").coalesce(1).write.mode("overwrite").parquet(path)


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).csv(path)


def read_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    return spark.read.schema(schema).option("header", True).csv(path)


def _marked_with(spark: SparkSession, path: str) -> str | None:
    """The fingerprint beside a stored result, or None where there is none."""
    try:
        lines = spark.read.text(f"{path}.fingerprint").collect()
    except AnalysisException as problem:
        if problem.getCondition() != "PATH_NOT_FOUND":
            raise
        return None
    return lines[0][0] if lines else None


def reuse_or_write_csv(
    spark: SparkSession, path: str, schema: T.StructType, fingerprint: str, compute: Callable[[], DataFrame]
) -> DataFrame:
    """The stored result if it was made from the same settings, else the computed one, stored first.

    ``fingerprint`` stands for everything the result depends on. It is cleared first
    and written last, so a result without it wasn't finished. Either way the rows are read back with
    the declared schema, so later steps do not repeat the computation.
    """
    def mark(*lines: str) -> None:
        kept = local_frame(spark, [(line,) for line in lines], "value string")
        kept.coalesce(1).write.mode("overwrite").text(f"{path}.fingerprint")

    if _marked_with(spark, path) != fingerprint:
        mark()
        write_csv(compute().select(*schema.names), path)
        mark(fingerprint)
    return read_csv(spark, path, schema)
