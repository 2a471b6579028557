"""A corpus pipeline: each stage works on all that the stage before kept.

Every stage takes documents (doc_id, text, lang, source, n_chars and whatever else they have) and returns
the columns it got, but for the last, which returns packed sequences. Rows of null id or text go through
as the stage's operator says; an empty table stays empty.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from cohortloom.llm import decontamination, line_dedup, near_dedup, packing, toxicity
from cohortloom.llm.common import fresh, table, text_hash, written
from cohortloom.llm.membership import with_possible
from cohortloom.llm.tokens import tokenizer_path

TOXIC = 0.5


def _without(docs: DataFrame, keys: DataFrame) -> DataFrame:
    """``docs`` but for the rows of these keys: doc_id and text_, the hash of the text."""
    apart, near = _parted(docs, keys)
    own, of = _key_matches(docs, keys)
    return apart.unionByName(near.join(own, of, "left_anti"))


def _parted(docs: DataFrame, keys: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``docs`` in two: rows that surely have none of the keys, whose texts needn't be shuffled, and the others."""
    possible = fresh(docs, "possible")
    key = [F.col("doc_id").cast("long"), text_hash("text")]
    told = with_possible(docs, key, keys.select("doc_id", "text_"), possible)
    return told.where(~F.col(possible)).drop(possible), told.where(possible).drop(possible)


def _key_matches(docs: DataFrame, keys: DataFrame) -> tuple[DataFrame, Column]:
    """The keys in columns that ``docs`` lacks, and when a row has one; null ids are equal."""
    i, t = fresh(docs, "key_id"), fresh(docs, "key_text")
    own = keys.select(F.col("doc_id").alias(i), F.col("text_").alias(t))
    return own, F.col("doc_id").cast("long").eqNullSafe(F.col(i)) & (text_hash("text") == F.col(t))


def _one_of_each(docs: DataFrame, keys: DataFrame) -> DataFrame:
    """One row for each of these keys, the first by its columns' JSON."""
    _, near = _parted(docs, keys)
    own, of = _key_matches(docs, keys)
    row = F.struct(*[F.col(c) for c in docs.columns])
    # Put together on the map side first, so that a key of many rows is one row per task.
    return (
        near.join(own, of, "left_semi")
        .select(F.col("doc_id").alias("key_id"), text_hash("text").alias("key_text"), row.alias("row"))
        .groupBy("key_id", "key_text")
        .agg(F.min_by("row", F.to_json("row")).alias("row"))
        .select(*[F.col("row").getField(c).alias(c) for c in docs.columns])
    )


def without_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the model finds toxic go. It is fitted on the folder's labels of the documents.

    Without usable labels of both kinds the model has no terms, and no document goes.
    """
    model = toxicity.train(docs, table(spark, sf_dir, "labels"))
    score = fresh(docs, "score")
    return toxicity.score_texts(docs, model, score_col=score).where(F.col(score) < TOXIC).drop(score)


def without_boilerplate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that stand on many sites go from all documents but the first that holds them."""
    cleaned = line_dedup.remove_boilerplate(docs, count_col=fresh(docs, "n_removed"))
    return cleaned.withColumn("n_chars", F.length("text").cast("long")).select(*docs.columns)


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each class of near copies one row stays.

    It is the one of smallest id, and of several texts under that id the one of smallest hash. Each row is
    judged by its own text, so other texts under a copy's id stay. Rows of null id are in no class and stay.
    """
    copies = written(near_dedup.copies(docs))
    return _without(docs, copies).unionByName(_one_of_each(docs, copies.where("first")))


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows whose text holds a benchmark item go, those of null id too; other texts under their ids stay."""
    return _without(docs, written(decontamination.leaked_rows(docs, table(spark, sf_dir, "benchmark"))))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The kept documents' tokens in sequences of 1024 at most."""
    return packing.pack(docs, tokenizer_path("byte_bpe_50k.json"))


STAGES = [
    ("toxicity", without_toxic),
    ("line dedup", without_boilerplate),
    ("near dedup", without_near_copies),
    ("decontamination", without_benchmark),
    ("packing", packed),
]

# The model's scores and the token ids can't be had in SQL; tests/llm tests the stages by brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the folder's documents, each one's result written as Parquet for the next."""
    docs = table(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = written(docs)
    return docs
