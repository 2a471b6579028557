"""Best-fit packing of documents into sequences: large-item matching on a histogram of lengths."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from cohortloom.llm.common import written
from cohortloom.llm.tokens import encoder

CAPACITY = 1024
PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long, part int, nth long"


def cut(n: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of ``n`` tokens: full ones but the first."""
    first = n % capacity or capacity
    return [(0, first), *((s, capacity) for s in range(first, n, capacity))]


def plan(counts: dict[int, int], capacity: int) -> list[tuple[list[tuple[int, int]], int]]:
    """Kinds of sequences for a histogram of lengths: (contents as (length, times), how many of it).

    Lengths above a third of the capacity stand at most two in a sequence: from the largest down, each is
    matched with the largest partner that fits. The rest, from the largest down, goes to the
    smallest gaps that take it, as often as it fits; without a gap new sequences are opened. Equal
    lengths are handled at once, and every step ends a length or a kind, so the work and the result
    depend on the capacity, not on the number of documents.
    """
    left = {n: c for n, c in counts.items() if c > 0}
    gaps: dict[int, list[tuple[list[tuple[int, int]], int]]] = {}

    def put(contents: list[tuple[int, int]], times: int) -> None:
        if times:
            gaps.setdefault(capacity - sum(n * k for n, k in contents), []).append((contents, times))

    large = sorted((n for n in left if 3 * n > capacity), reverse=True)
    for n in large:
        for partner in (p for p in large if p <= min(n, capacity - n)):
            times = left[n] // 2 if partner == n else min(left[n], left[partner])
            if times:
                put([(n, 2)] if partner == n else [(n, 1), (partner, 1)], times)
                left[n] -= times
                left[partner] -= times
            if not left[n]:
                break
        put([(n, 1)], left[n])
        left[n] = 0
    for n in sorted((n for n in left if 3 * n <= capacity), reverse=True):
        rest = left[n]
        while rest:
            gap = min((g for g in gaps if g >= n), default=None)
            if gap is None:
                contents, times, gap = [], rest, capacity
            else:
                contents, times = gaps[gap].pop()
                if not gaps[gap]:
                    del gaps[gap]
            fit = min(gap // n, rest)
            filled = min(times, rest // fit)
            put([*contents, (n, fit)], filled)
            if contents:
                put(contents, times - filled)
            rest -= filled * fit
    return [kind for kinds in gaps.values() for kind in kinds]


def places(kinds: list[tuple[list[tuple[int, int]], int]]) -> pd.DataFrame:
    """Ranges of places for each length: length, first, last + 1, sequence of the first, offset."""
    used: dict[int, int] = {}
    rows, sequence = [], 0
    for contents, times in kinds:
        offset = 0
        for n, k in contents:
            for _ in range(k):
                first = used.get(n, 0)
                rows.append((n, first, first + times, sequence, offset))
                used[n] = first + times
                offset += n
        sequence += times
    return pd.DataFrame(rows, columns=["length", "first", "end", "sequence", "offset"], dtype="int64").sort_values(
        ["length", "first"], ignore_index=True
    )


def token_pieces(
    docs: DataFrame, tokenizer: str, end_id: int, capacity: int, id_col: str, text_col: str
) -> DataFrame:
    """Pieces of every whole text's ids, numbered by length within the task that made them."""

    def pieces(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encode, part = encoder(tokenizer), TaskContext.get().partitionId()
        end, seen = np.array([end_id], "<u4").tobytes(), [0] * (capacity + 1)
        for batch in batches:
            rows = []
            for i, own in zip(batch["id"].astype("Int64"), encode.each(batch["text"])):
                ids = memoryview(own.astype("<u4").tobytes() + end)
                for piece, (start, length) in enumerate(cut(len(own) + 1, capacity)):
                    crc = zlib.crc32(ids[4 * start : 4 * (start + length)])
                    rows.append((i, piece, start, length, crc, part, seen[length]))
                    seen[length] += 1
            frame = pd.DataFrame(rows, columns=["doc_id", "piece", "start", "length", "ids_crc32", "part", "nth"])
            frame["doc_id"] = frame["doc_id"].astype("Int64")
            yield frame

    return docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text")).mapInPandas(
        pieces, PIECES
    )


def pack(
    docs: DataFrame,
    tokenizer: str,
    end_id: int = 2,
    capacity: int = CAPACITY,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """Per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset.

    A document's ids (null: the empty text) end with ``end_id``; longer ones than ``capacity`` are cut.
    Only the histogram of lengths (``capacity`` numbers) reaches the driver, where the kinds of sequences
    are planned; each piece then finds its place by its length and its number among pieces of that
    length. Every row is packed, repeated ones and those of null id too; no rows give no sequences.
    """
    pieces = written(token_pieces(docs, tokenizer, end_id, capacity, id_col, text_col))
    made = written(pieces.groupBy("part", "length").agg(F.count("*").alias("n")))
    counts = {r["length"]: r["n"] for r in made.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    table = places(plan(counts, capacity))
    # Bounded by the capacity, like the histogram it comes from.
    shared = docs.sparkSession.sparkContext.broadcast(
        {c: table[c].to_numpy() for c in table.columns}
    )
    earlier = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    before = made.select("part", "length", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))

    @F.pandas_udf("sequence_id long, offset long")
    def place(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        t = shared.value
        span = int(t["end"].max(initial=0)) + 1
        keys = t["length"] * span + t["first"]
        for length, nth in batches:
            at = np.searchsorted(keys, (length * span + nth).to_numpy(np.int64), side="right") - 1
            yield pd.DataFrame(
                {"sequence_id": t["sequence"][at] + nth.to_numpy() - t["first"][at], "offset": t["offset"][at]}
            )

    return (
        pieces.join(before, ["part", "length"])
        .withColumn("place", place(F.col("length"), F.col("before") + F.col("nth")))
        .select("doc_id", "piece", "start", "length", "ids_crc32", "place.sequence_id", "place.offset")
    )
