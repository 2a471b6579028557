"""Exact substring dedup: Rabin-Karp hashes of every word window, counted in Spark."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, functions as F

from cohortloom.llm.common import partitions

WINDOW = 20
BASE = np.uint64(0x5851F42D4C957F2D)  # odd, so that it has an inverse modulo 2**64
#: What leaves a chunk, and what comes back to it.
LISTS = "bucket int, chunk int, hashes binary"
FLAGS = "chunk int, bucket int, flags binary"


def split_words(text: str | None) -> list[bytes]:
    """Words between ASCII white space, unchanged; none for null."""
    return text.encode("utf-8", "surrogatepass").split() if text else []


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


#: Grows as texts ask for it: BASE**i and BASE**-i.
_POWERS: list[np.ndarray] = [np.zeros(0, np.uint64), np.zeros(0, np.uint64)]


def _powers_to(n: int) -> list[np.ndarray]:
    if len(_POWERS[0]) < n:
        size = max(n, 1 << 15)
        _POWERS[:] = [_powers(int(BASE), size), _powers(pow(int(BASE), -1, 1 << 64), size)]
    return _POWERS


def window_hashes(words: list[bytes], window: int = WINDOW) -> np.ndarray:
    """Rabin-Karp hash of each ``window`` consecutive words, modulo 2**64.

    With prefix sums P[i] of word hash times BASE**i, a window's hash is
    (P[i + window] - P[i]) * BASE**-i, the same wherever the window stands.
    """
    n = len(words) - window + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    up, down = _powers_to(len(words) + 1)
    each = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
    sums = np.zeros(len(words) + 1, np.uint64)
    np.cumsum(each * up[: len(words)], out=sums[1:])
    return (sums[window:] - sums[:-window]) * down[:n]


def _distinct(hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct hashes, and the place of the first of each."""
    return np.unique(hashes, return_index=True)


def _bucket_bounds(distinct: np.ndarray, buckets: int) -> np.ndarray:
    """Where each bucket of equal parts of the hash range begins in sorted hashes, and the end."""
    edges = np.array([(b << 64) // buckets for b in range(1, buckets)], np.uint64)
    return np.concatenate([[0], np.searchsorted(distinct, edges), [len(distinct)]])


def _packed(hashes: np.ndarray) -> bytes:
    """Sorted hashes byte plane by byte plane: the high planes hardly vary and compress well."""
    return np.ascontiguousarray(hashes.astype("<u8").view(np.uint8).reshape(-1, 8).T[::-1]).tobytes()


def _unpacked(data: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(8, -1)[::-1].T).view("<u8").ravel()


def intervals(removed: np.ndarray, window: int) -> list[tuple[int, int]]:
    """Maximal intervals of words that the marked windows cover, as (start, end)."""
    starts = np.flatnonzero(removed)
    if not len(starts):
        return []
    gap = np.flatnonzero(np.diff(starts) > window)
    begins = starts[np.concatenate([[0], gap + 1])]
    ends = starts[np.concatenate([gap, [len(starts) - 1]])] + window
    return list(zip(begins.tolist(), ends.tolist()))


def _chunk_texts(pdf: pd.DataFrame) -> pd.DataFrame:
    """A chunk's documents in the order that decides which window comes first."""
    return pdf.sort_values(["id_", "text_"], kind="stable", na_position="first", ignore_index=True)


def in_chunks(docs: DataFrame, id_col: str, text_col: str, chunks: int) -> DataFrame:
    """Documents with the number of the range of ids that they are in, ranges in ascending order.

    The range bounds are quantiles of the ids of all documents; only they reach the driver.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("id_"), F.col(text_col).alias("text_"))
    points = [k / chunks for k in range(1, chunks)]
    found = rows.agg(F.percentile_approx("id_", points, 20 * chunks)).first()[0] if points else []
    bounds = np.unique(np.array(found or [], np.int64))

    @F.pandas_udf("int")
    def chunk(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for ids in batches:
            known = ids.fillna(np.iinfo(np.int64).min).astype("int64").to_numpy()
            yield pd.Series(np.searchsorted(bounds, known, side="right").astype(np.int32))

    return rows.withColumn("chunk", chunk("id_"))


def repeated_windows(chunked: DataFrame, window: int, buckets: int) -> DataFrame:
    """For each chunk and bucket, one bit per distinct hash in order: stands in an earlier chunk too.

    A chunk sends each of its distinct hashes once, as packed arrays by ranges of the hash, so a
    window that stands in every document adds one hash per chunk to its bucket. Buckets are even, as
    hashes are. A bucket's lists are put in chunk order and sorted stably; what equals its predecessor
    has been seen before.
    """

    def lists(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = _chunk_texts(pdf)
        hashes = [window_hashes(split_words(t), window) for t in pdf["text_"]]
        distinct, _ = _distinct(np.concatenate(hashes))
        at = _bucket_bounds(distinct, buckets)
        own = [b for b in range(buckets) if at[b + 1] > at[b]]
        return pd.DataFrame(
            {
                "bucket": np.array(own, np.int32),
                "chunk": np.full(len(own), key[0], np.int32),
                "hashes": [_packed(distinct[at[b] : at[b + 1]]) for b in own],
            }
        )

    def seen_before(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("chunk", ignore_index=True)
        parts = [_unpacked(x) for x in pdf["hashes"]]
        ends = np.cumsum([len(x) for x in parts])
        hashes = np.concatenate(parts)
        order = np.argsort(hashes, kind="stable")
        hashes = hashes[order]
        flags = np.zeros(len(hashes), bool)
        flags[order[1:]] = hashes[1:] == hashes[:-1]
        return pd.DataFrame(
            {
                "chunk": pdf["chunk"].astype("int32"),
                "bucket": np.full(len(pdf), key[0], np.int32),
                "flags": [np.packbits(x).tobytes() for x in np.split(flags, ends[:-1])],
            }
        )

    sent = chunked.groupBy("chunk").applyInPandas(lists, LISTS)
    return sent.groupBy("bucket").applyInPandas(seen_before, FLAGS)


def remove_repeats(
    docs: DataFrame,
    window: int = WINDOW,
    id_col: str = "doc_id",
    text_col: str = "text",
    keep_text: bool = True,
) -> DataFrame:
    """Per document: id, n_words, n_removed, kept_sha256, intervals and, if asked for, the kept text.

    A word goes if a window of ``window`` words of its document covers it whose word sequence also
    starts earlier: in a document of smaller id, or before in the same one. Windows are judged on the
    input. Overlapping removed windows are merged into maximal intervals (start, end).

    Equal hashes of 64 bits count as equal windows. Null and empty texts have no words. Rows with the
    same id are ordered by text, and of equal rows the first stays whole; null ids come first. Texts
    cross the network once, as do 8 bytes (before compression) for each distinct window of a chunk.
    """
    chunks = buckets = partitions(docs.sparkSession)
    chunked = in_chunks(docs, id_col, text_col, chunks)
    flags = repeated_windows(chunked, window, buckets)
    out = "doc_id long, n_words long, n_removed long, kept_sha256 string, intervals array<struct<start:long,end:long>>"
    out += ", kept string" if keep_text else ""

    def cut(key: tuple, pdf: pd.DataFrame, told: pd.DataFrame) -> pd.DataFrame:
        pdf = _chunk_texts(pdf)
        hashes = [window_hashes(split_words(t), window) for t in pdf["text_"]]
        distinct, first = _distinct(np.concatenate(hashes) if hashes else np.zeros(0, np.uint64))
        at = _bucket_bounds(distinct, buckets)
        before = np.zeros(len(distinct), bool)
        for b, bits in zip(told["bucket"], told["flags"]):
            n = at[b + 1] - at[b]
            before[at[b] : at[b + 1]] = np.unpackbits(np.frombuffer(bits, np.uint8), count=n).astype(bool)
        ends = np.cumsum([len(x) for x in hashes])
        # Every window goes but the first of its hash in this chunk, unless an earlier chunk has it.
        removed = np.ones(ends[-1] if len(ends) else 0, bool)
        removed[first] = before
        rows = []
        for text, marks in zip(pdf["text_"], np.split(removed, ends[:-1])):
            words, spans = split_words(text), intervals(marks, window)
            kept, last = [], 0
            for start, end in spans:
                kept += words[last:start]
                last = end
            kept += words[last:]
            joined = b" ".join(kept)
            row = [len(words), len(words) - len(kept), hashlib.sha256(joined).hexdigest(), spans]
            rows.append(row + ([joined.decode("utf-8", "surrogatepass")] if keep_text else []))
        names = ["n_words", "n_removed", "kept_sha256", "intervals"] + (["kept"] if keep_text else [])
        result = pd.DataFrame(rows, columns=names)
        result["intervals"] = [[{"start": s, "end": e} for s, e in x] for x in result["intervals"]]
        result.insert(0, "doc_id", pdf["id_"].astype("Int64"))
        return result

    return chunked.groupBy("chunk").cogroup(flags.groupBy("chunk")).applyInPandas(cut, out)
