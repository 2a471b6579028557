"""Connected components of an undirected graph by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from cohortloom.llm.common import written


def _signature(edges: DataFrame):
    return edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()


def components(edges: DataFrame, a: str, b: str) -> DataFrame:
    """Each node that has an edge, with the smallest node of its component: ``node``, ``component``.

    Every step is an aggregation and a join of the edge list; nothing but its count and checksum
    reaches the driver. Steps are written as tables, so lineage stays short. The number of steps grows
    with the logarithm of the longest path. Loops and repeated edges are allowed; no edges give no rows.
    """
    edges = written(
        edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where(F.col("u") > F.col("v")).distinct()
    )
    before = None
    while (now := _signature(edges)) != before:
        before = now
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        lowest = both.groupBy("u").agg(F.min("v").alias("least_")).select("u", F.least("u", "least_").alias("least_"))
        large = (
            both.where(F.col("v") > F.col("u"))
            .join(lowest, "u")
            .select(F.col("v").alias("u"), F.col("least_").alias("v"))
            .distinct()
        )
        lowest = large.groupBy("u").agg(F.min("v").alias("least_"))
        small = (
            large.join(lowest, "u")
            .where(F.col("v") != F.col("least_"))
            .select(F.col("v").alias("u"), F.col("least_").alias("v"))
            .unionByName(lowest.select("u", F.col("least_").alias("v")))
            .distinct()
        )
        edges = written(small)
    return (
        edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
        .unionByName(edges.select(F.col("v").alias("node"), F.col("v").alias("component")))
        .distinct()
    )
