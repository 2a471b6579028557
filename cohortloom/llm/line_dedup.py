"""Cross-site boilerplate lines: HyperLogLog sketches of sites, exact counts near the threshold."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, functions as F

from cohortloom.llm.common import fresh, whole_text, written

MIN_SITES = 10
LG_K = 10
SIGMAS = 4


def _lines(text: Column) -> Column:
    return F.split(text, "\n")


def _key(line: Column) -> Column:
    """96 bits of hash of a line without its outer spaces."""
    line = F.trim(line)
    return F.struct(F.xxhash64(line).alias("h1"), F.hash(line).alias("h2"))


def line_sites(docs: DataFrame, id_col: str, text_col: str, site_col: str) -> DataFrame:
    """Each document's different lines that aren't blank: id_, site_, text_, h1, h2."""
    text = whole_text(text_col)
    return (
        docs.select(
            F.col(id_col).alias("id_"),
            F.coalesce(F.col(site_col).cast("string"), F.lit("")).alias("site_"),
            F.xxhash64(text).alias("text_"),
            F.explode(
                F.array_distinct(F.transform(F.filter(_lines(text), lambda x: F.trim(x) != ""), _key))
            ).alias("key_"),
        )
        .select("id_", "site_", "text_", "key_.h1", "key_.h2")
    )


def boilerplate_lines(
    docs: DataFrame,
    min_sites: int = MIN_SITES,
    lg_k: int = LG_K,
    id_col: str = "doc_id",
    text_col: str = "text",
    site_col: str = "source",
) -> DataFrame:
    """Hashes of lines that stand on at least ``min_sites`` sites, with the first document of each.

    A sketch of the sites of each line is merged by aggregation, on the map side first, so a line that
    stands in a third of all documents is one small sketch per task. Estimates further from the
    threshold than ``SIGMAS`` standard errors decide; lines nearer to it (one site at least) get exact
    distinct counts, so the result is that of exact counting.
    """
    lines = line_sites(docs, id_col, text_col, site_col)
    sketched = lines.groupBy("h1", "h2").agg(
        F.hll_sketch_agg("site_", F.lit(lg_k)).alias("sketch"), F.min("id_").alias("first_")
    )
    margin = max(1, math.ceil(SIGMAS * 1.04 / math.sqrt(2**lg_k) * min_sites))
    estimated = sketched.select("h1", "h2", "first_", F.hll_sketch_estimate("sketch").alias("sites_")).where(
        F.col("sites_") >= min_sites - margin
    )
    near = estimated.where(F.col("sites_") <= min_sites + margin)
    # Sites are made distinct by task before they move, so a common line is a few rows in the join.
    exact = (
        lines.select("h1", "h2", "site_")
        .distinct()
        .join(near.select("h1", "h2", "first_"), ["h1", "h2"])
        .groupBy("h1", "h2", "first_")
        .agg(F.count("*").alias("sites_"))
        .where(F.col("sites_") >= min_sites)
    )
    far = estimated.where(F.col("sites_") > min_sites + margin)
    return far.select("h1", "h2", "first_", "sites_").unionByName(exact.select("h1", "h2", "first_", "sites_"))


def remove_boilerplate(
    docs: DataFrame,
    min_sites: int = MIN_SITES,
    lg_k: int = LG_K,
    id_col: str = "doc_id",
    text_col: str = "text",
    site_col: str = "source",
    count_col: str = "n_removed_lines",
) -> DataFrame:
    """``docs`` with lines of many sites removed from all documents but the first that holds them.

    The document of smallest id keeps the line, so text that stands on many sites isn't lost, and of a
    document copied to many sites one copy stays whole. All other columns are returned unchanged, next
    to ``text_col`` as it is after removal and a new last column ``count_col``, with underscores after its name
    where ``docs`` has a column of that name. Every row stays: a text
    can become empty, null stays null, blank lines stay. Rows given twice are treated alike. A null site
    counts as one site; rows of null id are never the first.
    """
    text, count_col = whole_text(text_col), fresh(docs, count_col)
    # Written, so that the join starts from files: a common line's partition can be split.
    flagged = written(boilerplate_lines(docs, min_sites, lg_k, id_col, text_col, site_col))
    removed = (
        line_sites(docs, id_col, text_col, site_col)
        .drop("site_")
        .join(flagged.drop("sites_"), ["h1", "h2"])
        .where(~F.col("id_").eqNullSafe(F.col("first_")))
        .groupBy("id_", "text_")
        .agg(F.collect_set(F.struct("h1", "h2")).alias("keys_"))
    )
    rows = docs.select(
        F.struct(*[F.col(c) for c in docs.columns]).alias("row_"),
        F.col(id_col).alias("own_id_"),
        F.xxhash64(text).alias("own_text_"),
    )
    joined = rows.join(
        removed, F.col("own_id_").eqNullSafe(F.col("id_")) & (F.col("own_text_") == F.col("text_")), "left"
    )
    before = _lines(F.col("row_").getField(text_col))
    kept = F.filter(before, lambda x: (F.trim(x) == "") | ~F.array_contains("keys_", _key(x)))
    after = F.when(F.col("keys_").isNull(), F.col("row_").getField(text_col)).otherwise(F.array_join(kept, "\n"))
    n_removed = F.when(F.col("keys_").isNull(), F.lit(0)).otherwise(F.size(before) - F.size(kept)).cast("long")
    return joined.select(
        *[(after if c == text_col else F.col("row_").getField(c)).alias(c) for c in docs.columns],
        n_removed.alias(count_col),
    )
