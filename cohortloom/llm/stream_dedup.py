"""Exact dedup by a streaming query with keyed state on disk; full texts are compared on hits."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from cohortloom.llm.common import partitions, scratch, whole_text, written

SPACE = r"[\x20\x09-\x0D]+"
DIGITS = 64  # hexadecimal digits of SHA-256 that are the key of the state
#: Input that a micro-batch takes for each shuffle partition, of which the cluster's owner has as many as the
#: input asks for; a batch is a few dozenths of the input then.
BATCH_BYTES = 4_000_000
_STORE = "spark.sql.streaming.stateStore"
_STATE = {
    f"{_STORE}.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    # All stores of an executor share so much memory, however many partitions it holds.
    f"{_STORE}.rocksdb.boundedMemoryUsage": "true",
    f"{_STORE}.rocksdb.maxMemoryUsageMB": "256",
    # Else each store, however small, sets aside disk for its logs.
    f"{_STORE}.rocksdb.allowFAllocate": "false",
}


@contextmanager
def _settings(spark: SparkSession, values: dict[str, str]) -> Iterator[None]:
    """Session settings for what starts within, put back afterwards."""
    before = {k: spark.conf.get(k, None) for k in values}
    for k, v in values.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def _rows(docs: DataFrame, id_col: str, text_col: str, digits: int) -> DataFrame:
    """Of each row: key, text_sha256, doc_id, its place in the order of its class, its locator and its content."""
    about = docs.metadataColumn("_metadata")
    text = whole_text(docs[text_col])
    content = F.regexp_replace(text, SPACE, "")
    return docs.select(
        F.sha2(content, 256).alias("text_sha256"),
        content.alias("content"),
        F.struct(
            (-F.length(text)).alias("minus"),
            docs[id_col].isNull().alias("no_id"),
            docs[id_col].cast("long").alias("doc_id"),
            about["file_path"].alias("file"),
            about["row_index"].alias("row"),
        ).alias("entry"),
    ).withColumn("key", F.left("text_sha256", F.lit(digits)))


def update_state(
    spark: SparkSession,
    path: str,
    state: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    batch_bytes: int | None = None,
    digits: int = DIGITS,
) -> None:
    """Take all Parquet files at ``path`` that the state at ``state`` hasn't seen into it, in micro-batches.

    The state is RocksDB on the executors' disks, kept in the shared folder ``state``, and nothing in it
    expires. For each digest of a normalised text it retains the row to keep (its number of code points, its
    id, and the file and row where its content lies) and how many rows had that digest. A batch is
    aggregated by task before it meets the state, so copies of one text are one row for each task. A
    batch that fails is taken again from the last state committed.
    """
    known = spark.read.parquet(path).schema
    batch = batch_bytes or BATCH_BYTES * partitions(spark)
    # As a pattern, since streams don't take the path of a single file.
    pattern = f"{path.rstrip('/')[:-1]}[{path.rstrip('/')[-1]}]"
    docs = spark.readStream.schema(known).option("maxBytesPerTrigger", batch).parquet(pattern)
    kept = (
        _rows(docs, id_col, text_col, digits)
        .groupBy("key")
        .agg(F.min("entry").alias("entry"), F.count("*").alias("n"))
    )
    with _settings(spark, _STATE):
        query = (
            kept.writeStream.format("noop")
            .outputMode("update")
            .option("checkpointLocation", state)
            .trigger(availableNow=True)
            .start()
        )
        query.awaitTermination()


def entries(spark: SparkSession, state: str) -> DataFrame:
    """What the state retains: key, entry (minus, no_id, doc_id, file, row) and n."""
    with _settings(spark, _STATE):
        held = spark.read.format("statestore").load(state)
    return held.select("key.key", F.col("value.min").alias("entry"), F.col("value.count").alias("n"))


def mixed_keys(joined: DataFrame) -> DataFrame:
    """Keys under which not all rows have the retained row's content: key.

    Whole contents of rows whose key was hit are compared, which each task makes distinct before they move; the
    retained row is found among them by its locator. Unless digests collide there is no such key.
    """
    contents = joined.where(F.col("n") > 1).groupBy("key", "content").agg(F.max(_is_best()).alias("retained"))
    return contents.where(~F.col("retained")).select("key").distinct()


def _is_best() -> Column:
    """Whether a row is the one to stay, by where it lies."""
    return (F.col("entry.file") == F.col("best.file")) & (F.col("entry.row") == F.col("best.row"))


def deduplicate(
    spark: SparkSession,
    path: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    state: str | None = None,
    batch_bytes: int | None = None,
    digits: int = DIGITS,
) -> DataFrame:
    """One row per row of the Parquet files at ``path``: doc_id, keep_id, group_size, kept, text_sha256.

    Texts are equal if they are the same without white space (null is the empty text). Of equal texts the
    row with the most code points stays, then the one of smallest id (null ids last), then the first by
    file and row; so of rows given twice just one stays, and of rows of one id each is judged by its text.
    Other columns of the files, whatever their names, aren't read. Files without rows give none.

    A stream brings the files into the state (``update_state``). With a ``state`` folder of one's own, a later
    call reads only files that have come since, against all that came before. Rows whose digest was hit are
    then compared by their full contents; where digests collide, classes are made by the contents
    themselves. ``digits`` shortens the digest, for tests.
    """
    state = state or scratch(spark)
    update_state(spark, path, state, id_col, text_col, batch_bytes, digits)
    held = entries(spark, state).withColumnRenamed("entry", "best")
    rows = _rows(spark.read.parquet(path), id_col, text_col, digits)
    # Rows aren't sorted by key for this, as texts travel with them; of these only the hits' are stored.
    joined = written(
        rows.join(held.hint("shuffle_hash"), "key").withColumn("content", F.when(F.col("n") > 1, F.col("content")))
    )
    mixed = written(mixed_keys(joined))
    plain = joined.join(mixed, "key", "left_anti")
    # Empty unless digests collide.
    apart = joined.join(mixed, "key", "left_semi").drop("best", "n")
    by_content = apart.groupBy("key", "content").agg(F.min("entry").alias("best"), F.count("*").alias("n"))
    exact = apart.join(by_content, ["key", "content"])
    return plain.unionByName(exact).select(
        F.col("entry.doc_id").alias("doc_id"),
        F.col("best.doc_id").alias("keep_id"),
        F.col("n").alias("group_size"),
        _is_best().alias("kept"),
        "text_sha256",
    )
