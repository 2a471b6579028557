"""Codesets: which codes make up a clinical idea."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession, functions as F

from cohortloom.schemas import CONCEPT_ITEM, SOURCE_CODE
from cohortloom.session import local_frame


def concept_items(
    spark: SparkSession,
    codeset_id: int,
    include: Iterable[int],
    exclude: Iterable[int] = (),
    descendants: bool = True,
) -> DataFrame:
    """The written form of one concept set: listed ids, each included or excluded."""
    rows = [(codeset_id, concept, descendants, False) for concept in dict.fromkeys(include)]
    rows += [(codeset_id, concept, descendants, True) for concept in dict.fromkeys(exclude)]
    return local_frame(spark, rows, CONCEPT_ITEM)


def resolve_concept_sets(concept: DataFrame, concept_ancestor: DataFrame, items: DataFrame) -> DataFrame:
    """Distinct ``(codeset_id, concept_id)`` of every concept set in ``items``, in one pass.

    A listed concept counts if it exists, even when invalid; a descendant only
    when valid. A concept reached by an excluded item is left out. Each candidate
    meets the vocabulary once, and one aggregate stands for include-minus-exclude.
    """
    listed = items.select("codeset_id", "concept_id", "is_excluded", F.lit(True).alias("is_listed"))
    expanding = items.where("include_descendants").select("codeset_id", "concept_id", "is_excluded")
    reached = (
        concept_ancestor.join(expanding, F.col("ancestor_concept_id") == F.col("concept_id"))
        .select(
            "codeset_id",
            F.col("descendant_concept_id").alias("concept_id"),
            "is_excluded",
            F.lit(False).alias("is_listed"),
        )
    )
    is_listed, is_excluded = F.col("is_listed"), F.col("is_excluded")
    candidates = (
        listed.unionByName(reached)
        .groupBy("codeset_id", "concept_id")
        .agg(
            F.max(is_listed & ~is_excluded).alias("listed_in"),
            F.max(~is_listed & ~is_excluded).alias("reached_in"),
            F.max(is_listed & is_excluded).alias("listed_out"),
            F.max(~is_listed & is_excluded).alias("reached_out"),
        )
    )
    valid = F.col("invalid_reason").isNull()
    included = F.col("listed_in") | (F.col("reached_in") & valid)
    excluded = F.col("listed_out") | (F.col("reached_out") & valid)
    return (
        candidates.join(concept.select("concept_id", "invalid_reason"), "concept_id")
        .where(included & ~excluded)
        .select("codeset_id", "concept_id")
    )


def source_codes(spark: SparkSession, codeset_id: int, codes: Iterable[str]) -> DataFrame:
    """A codeset of local source codes, which are strings outside the vocabulary."""
    return local_frame(spark, [(codeset_id, code) for code in dict.fromkeys(codes)], SOURCE_CODE)
