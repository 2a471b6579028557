"""Token ids in wavelet matrices: one compressed file per shard with rank and select."""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from cohortloom.llm.common import partitions, scratch
from cohortloom.llm.tokens import encoder

MAGIC = b"WVM2"
NO_NULL_IDS = b"WVM1"  # files without the flags of ids, whose ids are all valid
SHARD_TOKENS = 1 << 20  # a shard is closed by the document that reaches this
RANK_BYTES = 64  # bytes of a bit-plane between entries of its rank directory
HEADER = struct.Struct("<4sBBQQ")  # magic, planes, width of a length, documents, tokens
SECTION = struct.Struct("<Q")
FILES = "part int, seq int, n_docs long, n_tokens long, file binary"


def build(
    doc_ids: np.ndarray, lengths: np.ndarray, ids: np.ndarray, planes: int, valid: np.ndarray | None = None
) -> bytes:
    """A shard's file: documents, then for each plane its zeros, bits and ranks, each section compressed.

    Documents are their ids, a bit each that says whether the id is ``valid`` (all are, if not given; else
    the document has none, and 0 stands in its place), and their lengths.
    Plane by plane from the highest bit, a stable partition puts ids with a zero before those with a
    one. The rank directory has the number of ones before every 64 bytes of a plane.
    """
    pack = zstandard.ZstdCompressor(level=1).compress
    out = [HEADER.pack(MAGIC, planes, 8, len(doc_ids), len(ids))]

    def section(data: bytes) -> None:
        small = pack(data)
        out.append(SECTION.pack(len(small)))
        out.append(small)

    section(doc_ids.astype("<i8").tobytes())
    section(np.packbits(np.ones(len(doc_ids), bool) if valid is None else valid.astype(bool)).tobytes())
    section(lengths.astype("<u8").tobytes())
    now = ids
    for plane in reversed(range(planes)):
        ones = (now >> plane & 1).astype(bool)
        bits = np.packbits(ones)
        zeros, others = np.flatnonzero(~ones), np.flatnonzero(ones)
        out.append(SECTION.pack(len(zeros)))
        section(bits.tobytes())
        section(_ranks(bits).astype("<u4").tobytes())
        now = np.concatenate([now[zeros], now[others]])  # by places: several times as fast as by a mask
    return b"".join(out)


def _ranks(bits: np.ndarray) -> np.ndarray:
    """Ones before every ``RANK_BYTES`` bytes."""
    starts = np.arange(0, len(bits), RANK_BYTES)
    counts = np.add.reduceat(np.bitwise_count(bits), starts, dtype=np.int64) if len(bits) else starts
    return np.cumsum(counts) - counts


class WaveletMatrix:
    """Reads a shard's file: tokens by place, counts and places of an id, and all documents."""

    def __init__(self, data: bytes):
        magic, self.planes, _, self.n_docs, self.n = HEADER.unpack_from(data)
        if magic not in (MAGIC, NO_NULL_IDS):
            raise ValueError("not a wavelet matrix file")
        unpack, at = zstandard.ZstdDecompressor().decompress, HEADER.size

        def number() -> int:
            nonlocal at
            at += SECTION.size
            return SECTION.unpack_from(data, at - SECTION.size)[0]

        def section() -> bytes:
            nonlocal at
            size = number()
            at += size
            return unpack(data[at - size : at])

        self.doc_ids = np.frombuffer(section(), "<i8")
        self.valid = np.ones(self.n_docs, bool)
        if magic == MAGIC:
            self.valid = np.unpackbits(np.frombuffer(section(), np.uint8), count=self.n_docs).astype(bool)
        self.lengths = np.frombuffer(section(), "<u8").astype(np.int64)
        self.zeros, self.bits, self.ranks = [], [], []
        for _ in range(self.planes):
            self.zeros.append(number())
            self.bits.append(np.frombuffer(section(), np.uint8))
            self.ranks.append(np.frombuffer(section(), "<u4"))

    def _bit(self, k: int, i: int) -> int:
        return int(self.bits[k][i >> 3] >> (7 - (i & 7)) & 1)

    def _ones(self, k: int, i: int) -> int:
        """Ones among the first ``i`` bits of a plane."""
        block, rest = i // (8 * RANK_BYTES), i % (8 * RANK_BYTES)
        if not rest:
            return int(self.ranks[k][block]) if block < len(self.ranks[k]) else self.n - self.zeros[k]
        part = self.bits[k][block * RANK_BYTES : block * RANK_BYTES + (rest + 7) // 8].copy()
        if rest & 7:
            part[-1] &= 0xFF << (8 - (rest & 7)) & 0xFF
        return int(self.ranks[k][block]) + int(np.bitwise_count(part).sum())

    def access(self, i: int) -> int:
        """The id at place ``i``."""
        if not 0 <= i < self.n:
            raise IndexError(i)
        value = 0
        for k in range(self.planes):
            bit, ones = self._bit(k, i), self._ones(k, i)
            value = value << 1 | bit
            i = self.zeros[k] + ones if bit else i - ones
        return value

    def _range(self, token: int, start: int, end: int) -> tuple[int, int]:
        """Where occurrences of an id among places [start, end) end up below the last plane."""
        if token >> self.planes:
            return 0, 0
        for k in range(self.planes):
            a, b = self._ones(k, start), self._ones(k, end)
            if token >> (self.planes - 1 - k) & 1:
                start, end = self.zeros[k] + a, self.zeros[k] + b
            else:
                start, end = start - a, end - b
        return start, end

    def count(self, token: int, start: int = 0, end: int | None = None) -> int:
        """How often an id occurs in [start, end)."""
        a, b = self._range(token, start, self.n if end is None else end)
        return b - a

    def select(self, token: int, nth: int) -> int:
        """The place of the ``nth`` occurrence of an id, from 0."""
        a, b = self._range(token, 0, self.n)
        if not 0 <= nth < b - a:
            raise IndexError(nth)
        i = a + nth
        for k in reversed(range(self.planes)):
            one = token >> (self.planes - 1 - k) & 1
            i = self._find(k, one, i - self.zeros[k] if one else i)
        return i

    def _find(self, k: int, one: int, nth: int) -> int:
        """Place of the ``nth`` one (or zero) of a plane."""
        ranks = self.ranks[k].astype(np.int64)
        before = ranks if one else np.arange(len(ranks)) * 8 * RANK_BYTES - ranks
        block = int(np.searchsorted(before, nth, side="right")) - 1
        part = np.unpackbits(self.bits[k][block * RANK_BYTES : (block + 1) * RANK_BYTES])
        return block * 8 * RANK_BYTES + int(np.flatnonzero(part == one)[nth - int(before[block])])

    def decode(self) -> np.ndarray:
        """All ids in order: partitions are undone from the last plane up."""
        value = np.zeros(self.n, np.uint16 if self.planes <= 16 else np.uint32)
        for k in reversed(range(self.planes)):
            ones = np.unpackbits(self.bits[k], count=self.n).view(bool)
            earlier = np.empty_like(value)
            earlier[np.flatnonzero(~ones)] = value[: self.zeros[k]]
            earlier[np.flatnonzero(ones)] = value[self.zeros[k] :] | value.dtype.type(1 << (self.planes - 1 - k))
            value = earlier
        return value.astype(np.uint32, copy=False)


def write_shards(
    docs: DataFrame,
    path: str,
    tokenizer: str,
    end_id: int = 1,
    id_col: str = "doc_id",
    text_col: str = "text",
    shard_tokens: int = SHARD_TOKENS,
    keep_null_ids: bool = False,
) -> None:
    """Encode whole texts and write them as shard files in ascending order of id below ``path``.

    Every document's ids end with ``end_id``; null and empty texts have just that. Documents are dealt by
    ranges of id and sorted; ties are ordered by a hash of the text, repeated rows stay. Rows of null id
    come first with ``keep_null_ids``, as the query has it; without, they are left out. Each task closes
    a shard when it holds ``shard_tokens``, so memory is bounded by that and the longest text. Spark's
    writer puts each shard into a file of its own and commits finished tasks only.
    """

    def shards(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encode, part, seq = encoder(tokenizer), TaskContext.get().partitionId(), 0
        planes = max(encode.tokenizer.get_vocab_size() - 1, end_id).bit_length()
        end = np.array([end_id], encode.dtype)
        ids, valid, lengths, held, total = [], [], [], [], 0

        def closed() -> pd.DataFrame:
            nonlocal ids, valid, lengths, held, total, seq
            data = build(np.array(ids, np.int64), np.array(lengths), np.concatenate(held), planes, np.array(valid))
            row = pd.DataFrame(
                {"part": [part], "seq": [seq], "n_docs": [len(ids)], "n_tokens": [total], "file": [data]}
            )
            ids, valid, lengths, held, total, seq = [], [], [], [], 0, seq + 1
            return row

        for batch in batches:
            for i, known, own in zip(batch["id"], batch["valid"], encode.each(batch["text"])):
                ids.append(i)
                valid.append(known)
                lengths.append(len(own) + 1)
                held += [own, end]
                total += len(own) + 1
                if total >= shard_tokens:
                    yield closed()
        if ids:
            yield closed()

    order = ["valid", "id", "tie"]
    (
        (docs if keep_null_ids else docs.where(F.col(id_col).isNotNull()))
        .select(
            F.coalesce(F.col(id_col).cast("long"), F.lit(0)).alias("id"),
            F.col(id_col).isNotNull().alias("valid"),
            F.col(text_col).alias("text"),
            F.xxhash64(text_col).alias("tie"),
        )
        .repartitionByRange(partitions(docs.sparkSession), *order)
        .sortWithinPartitions(*order)
        .select("id", "valid", "text")
        .mapInPandas(shards, FILES)
        .write.option("maxRecordsPerFile", 1)
        .option("compression", "uncompressed")
        .parquet(path)
    )


def read_shards(spark: SparkSession, path: str) -> DataFrame:
    """Per document of the files: doc_id, start, n_tokens, ids_crc32, part, seq.

    ``start`` counts the ids of all documents before. Shards' sizes are summed up by part, then over
    parts, without reading their files' contents.
    """

    def documents(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for part, seq, data in zip(batch["part"], batch["seq"], batch["file"]):
                matrix = WaveletMatrix(data)
                ids = matrix.decode().astype("<u4")
                ends = np.cumsum(matrix.lengths)
                starts = ends - matrix.lengths
                yield pd.DataFrame(
                    {
                        "part": np.int32(part),
                        "seq": np.int32(seq),
                        "doc_id": pd.arrays.IntegerArray(matrix.doc_ids.astype(np.int64), ~matrix.valid),
                        "local_start": starts,
                        "n_tokens": matrix.lengths,
                        "ids_crc32": [zlib.crc32(ids[a:b]) for a, b in zip(starts, ends)],
                    }
                )

    files = spark.read.schema(FILES).parquet(path)
    sizes = files.groupBy("part", "seq").agg(F.sum("n_tokens").alias("n"))
    # One row for each part, of which there are as many as shuffle partitions.
    parts = sizes.groupBy("part").agg(F.sum("n").alias("n"))
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select("part", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("part_start"))
    inside = Window.partitionBy("part").orderBy("seq").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        sizes.withColumn("shard_start", F.coalesce(F.sum("n").over(inside), F.lit(0)))
        .join(parts, "part")
        .select("part", "seq", (F.col("part_start") + F.col("shard_start")).alias("before"))
    )
    found = files.select("part", "seq", "file").mapInPandas(
        documents, "part int, seq int, doc_id long, local_start long, n_tokens long, ids_crc32 long"
    )
    return found.join(starts, ["part", "seq"]).select(
        "doc_id",
        (F.col("before") + F.col("local_start")).alias("start"),
        "n_tokens",
        "ids_crc32",
        "part",
        "seq",
    )


def encode_and_read(docs: DataFrame, tokenizer: str, **options) -> DataFrame:
    """Write shard files to the scratch folder and return what they hold per document."""
    path = scratch(docs.sparkSession)
    write_shards(docs, path, tokenizer, **options)
    return read_shards(docs.sparkSession, path)
