"""Study settings kept in CSV files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from cohortloom.schemas import PAIRS, REGISTRY


def read_registry(spark: SparkSession, path: str) -> DataFrame:
    """The cohorts of a study: ids, names and types."""
    return spark.read.schema(REGISTRY).option("header", True).csv(path)


def read_pairs(spark: SparkSession, path: str) -> DataFrame:
    """The disease and drug cohorts to be combined."""
    return spark.read.schema(PAIRS).option("header", True).csv(path)


def registry_names(registry: DataFrame) -> DataFrame:
    """Ids and names, as results take them."""
    return registry.select(F.col("cohortId"), F.col("name"))
