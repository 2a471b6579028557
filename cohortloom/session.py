"""Session helpers: recommended settings, local frames, sizes of stored code lists."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterable

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, types as T
from pyspark.sql.pandas.types import to_arrow_schema

# Settings the plans are tuned for. Sizes such as shuffle partitions and
# executor memory belong to the cluster and are left alone.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # A study makes more generated classes than the default cache holds.
    "spark.sql.codegen.cache.maxEntries": "2000",
    "spark.ui.enabled": "false",
}

# Code lists have two narrow columns, about 40 bytes a row once hashed, so this
# keeps a broadcast below about 40 MB.
BROADCAST_MAX_ROWS = 1_000_000


def build_session(app_name: str, master: str | None = None, **settings) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **settings}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new folder below ``spark.checkpoint.dir``, which a cluster's driver and executors share.

    Where that is unset, a session within one process takes a temporary folder; a cluster must name one.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if spark.sparkContext.master.partition("[")[0] != "local":
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        root = tempfile.mkdtemp(prefix="shared-")
    return f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def fits_broadcast(stored: DataFrame, max_rows: int = BROADCAST_MAX_ROWS) -> bool:
    """Whether a table of codes that has been written is small enough to broadcast.

    The rows are counted from the footers of its files. Only the study, which stores its codes first,
    asks this; operators start no jobs and leave the choice of join to Spark.
    """
    return stored.count() <= max_rows


def bytes_read(df: DataFrame) -> int:
    """Bytes of all files and local rows that a frame is made from, by Spark's statistics of its sources.

    A source that is read twice counts twice. No job is started. Sources of unknown size, as databases are, count as nothing.
    """
    unknown = df._jdf.sparkSession().sessionState().conf().defaultSizeInBytes()
    leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
    sizes = (int(str(leaves.apply(i).stats().sizeInBytes())) for i in range(leaves.size()))
    return sum(size for size in sizes if size < unknown)


def beyond_broadcast(df: DataFrame) -> bool:
    """Whether a frame is made from more bytes than Spark broadcasts by itself. With broadcasts off, no frame is."""
    limit = df._jdf.sparkSession().sessionState().conf().autoBroadcastJoinThreshold()
    return 0 <= limit < bytes_read(df)


def parts_for(size: int, *frames: DataFrame, least: int = 1) -> int:
    """A number of partitions for rows made from frames: one for so many bytes read.

    It is at least ``least`` for each that the session has for shuffles.
    """
    own = least * int(frames[0].sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return max(own, -(-sum(map(bytes_read, frames)) // size))


def local_frame(spark: SparkSession, rows: Iterable[tuple], schema: T.StructType | str) -> DataFrame:
    """Settings as a local relation, which Catalyst can fold and broadcast without a job."""
    schema = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    table = pa.Table.from_pylist(
        [dict(zip(schema.names, row)) for row in rows], schema=to_arrow_schema(schema)
    )
    return spark.createDataFrame(table, schema)
