"""One query for each operator, over the whole of its table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from cohortloom.llm import (
    decontamination,
    feistel_sharding,
    license_scan,
    line_dedup,
    merkle_manifest,
    near_dedup,
    packing,
    prefix_trie,
    stream_dedup,
    substring_dedup,
    topk,
    toxicity,
    wavelet,
)
from cohortloom.llm.common import table
from cohortloom.llm.tokens import tokenizer_path


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    left = line_dedup.remove_boilerplate(table(spark, sf_dir, "documents"))
    return left.select(
        "doc_id",
        F.col(left.columns[-1]).alias("n_removed"),
        F.length("text").cast("long").alias("n_chars_left"),
        F.md5("text").alias("left_md5"),
    )


def op2_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0, k=10)


def op3_wavelet_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return wavelet.encode_and_read(docs, tokenizer_path("word_bpe_49k.json"), end_id=1, keep_null_ids=True)


def op4_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.remove_repeats(table(spark, sf_dir, "documents"), keep_text=False).drop("intervals")


def op5_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scan_licenses(table(spark, sf_dir, "documents"))


def op6_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.leaked_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op7_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return feistel_sharding.shard_documents(table(spark, sf_dir, "documents"))


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score_toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), tokenizer_path("byte_bpe_50k.json"), end_id=2)


def op10_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_duplicates(table(spark, sf_dir, "documents"))


def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    manifest = merkle_manifest.document_manifest(table(spark, sf_dir, "documents"))
    return merkle_manifest.proofs(manifest).withColumnRenamed("key", "doc_id").drop("tree", "pos")


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.prefix_trie(table(spark, sf_dir, "conversations"))


def op13_stream_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stream_dedup.deduplicate(spark, f"{sf_dir}/documents.parquet")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_line_dedup,
        op2_top_k,
        op3_wavelet_shards,
        op4_substring_dedup,
        op5_license_scan,
        op6_decontamination,
        op7_sharding,
        op8_toxicity,
        op9_packing,
        op10_near_dedup,
        op11_merkle_manifest,
        op12_prefix_trie,
        op13_stream_dedup,
    )
}
