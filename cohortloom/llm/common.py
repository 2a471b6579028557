"""What the operators of this package share: tables, scratch tables, words."""

from __future__ import annotations

import ctypes
import tempfile
import uuid
from collections.abc import Callable
from typing import TypeVar

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

T = TypeVar("T")

# ASCII letters in lower case, digits and all bytes beyond ASCII stay; the rest becomes a space.
LETTERS_AND_DIGITS = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256)
)


# What a worker process holds from one task to the next.
_KEPT: dict[str, object] = {}


def kept(name: str, make: Callable[[], T]) -> T:
    """What ``make`` returns, made once for a worker and kept until other work lets go of it."""
    if name not in _KEPT:
        _KEPT[name] = make()
    return _KEPT[name]


def let_go() -> None:
    """Frees what the worker has kept; tasks that have no use for it begin with this, as workers outlive stages."""
    if _KEPT:
        _KEPT.clear()
        give_back()


def give_back() -> None:
    """Returns freed memory to the system, which the worker would else hold for as long as it lives."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc has it
    if trim:
        trim(0)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def partitions(spark: SparkSession) -> int:
    """Number of shuffle partitions, which the cluster's owner sizes to the input."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def scratch(spark: SparkSession) -> str:
    """A new folder below ``spark.checkpoint.dir``, which all executors share.

    Where that is unset and driver and executors are one process, as in tests, a temporary folder takes its
    place. A cluster without it is an error, since its executors would write to folders of their own.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.partition("[")[0] == "local":
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        root = tempfile.mkdtemp(prefix="llm-")
        spark.conf.set("spark.checkpoint.dir", root)
    return f"{root.rstrip('/')}/llm-{uuid.uuid4().hex}"


def written(df: DataFrame, **options) -> DataFrame:
    """Write ``df`` as a scratch table and read it back: ends lineage, survives lost executors."""
    path = scratch(df.sparkSession)
    df.write.options(**options).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def whole_text(text: str | Column) -> Column:
    """A text with null as the empty text."""
    return F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit(""))


def text_hash(text: str | Column) -> Column:
    """With the id, the key of a row: 64 bits of hash of its text, null as the empty text."""
    return F.xxhash64(whole_text(text))


def normal_words(text: str | None) -> list[bytes]:
    """Lower-case words of letters, digits and characters beyond ASCII; none for null."""
    return text.encode("utf-8", "surrogatepass").translate(LETTERS_AND_DIGITS).split() if text else []


def fresh(df: DataFrame, name: str) -> str:
    """``name``, with as many underscores after it as make it a new column of ``df``."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name
