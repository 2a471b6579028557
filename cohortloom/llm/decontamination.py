"""Benchmark passages in documents: SimHash of windows, Hamming blocks, exact shingle similarity."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, functions as F

from cohortloom.llm.common import let_go, normal_words, text_hash, written

SHINGLE = 5
SIMILARITY = 0.8
RADIUS = 3
BLOCKS = RADIUS + 1  # with at most RADIUS bits off, one of the blocks is untouched
BLOCK_BITS = 64 // BLOCKS
GROWTH = 1.4  # window sizes grow by this factor
SHIFT = 2  # an item shorter than a shingle may begin so many words off
BLOCK_WORDS = 200_000  # words of benchmark items that are searched for in one pass over the documents
BATCH_WORDS = 1 << 16  # words whose windows are looked up at once; their bit counts take some 500 bytes a word


def word_hashes(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))


def _added(a: list[np.ndarray], b: list[np.ndarray]) -> list[np.ndarray]:
    """Sum of two bit-sliced counters (lowest plane first), for 64 bits of each position at once."""
    out, carry = [], None
    for k in range(max(len(a), len(b))):
        planes = [p for p in (a[k] if k < len(a) else None, b[k] if k < len(b) else None, carry) if p is not None]
        if len(planes) == 1:
            out.append(planes[0])
            carry = None
        elif len(planes) == 2:
            x, y = planes
            out.append(x ^ y)
            carry = x & y
        else:
            x, y, z = planes
            either = x ^ y
            out.append(either ^ z)
            carry = (x & y) | (either & z)
    return out if carry is None else [*out, carry]


def _over(planes: list[np.ndarray], limit: int) -> np.ndarray:
    """Bits whose counter exceeds ``limit``."""
    more, equal = np.zeros_like(planes[0]), np.full_like(planes[0], ~np.uint64(0))
    for k in reversed(range(max(len(planes), limit.bit_length()))):
        plane = planes[k] if k < len(planes) else np.zeros_like(planes[0])
        if limit >> k & 1:
            equal &= plane
        else:
            more |= equal & plane
            equal &= ~plane
    return more


class WindowSums:
    """Bit counts of all windows of a run of word hashes, built by doubling."""

    def __init__(self, hashes: np.ndarray):
        self.n, self.powers = len(hashes), [[hashes]]

    def _power(self, k: int) -> list[np.ndarray]:
        while len(self.powers) <= k:
            half, planes = 1 << (len(self.powers) - 1), self.powers[-1]
            self.powers.append(_added([p[:-half] for p in planes], [p[half:] for p in planes]))
        return self.powers[k]

    def sim_hashes(self, size: int) -> np.ndarray:
        """SimHash of each window of ``size`` words: the majority of its words' bits."""
        n = self.n - size + 1
        if n <= 0:
            return np.zeros(0, np.uint64)
        total, at = None, 0
        for k in reversed(range(size.bit_length())):
            if size >> k & 1:
                planes = [p[at : at + n] for p in self._power(k)]
                total = planes if total is None else _added(total, planes)
                at += 1 << k
        return _over(total, size // 2)


def window_size(length: int) -> int:
    """Window of an item: the largest size of the series at half its length, at least a shingle.

    So a word changed anywhere in an item leaves a window of it unchanged.
    """
    size = min(length, SHINGLE)
    while (following := max(size + 1, int(size * GROWTH))) <= length // 2:
        size = following
    return size


class ItemIndex:
    """Fingerprints of items' windows, by window size and block of bits."""

    def __init__(self, items: list[tuple[int, list[bytes]]]):
        self.items = [(i, w, _bag(word_hashes(w))) for i, w in items if w]
        by_size: dict[int, list[tuple[int, int, int]]] = {}
        for number, (_, words, _) in enumerate(self.items):
            size = window_size(len(words))
            prints = WindowSums(word_hashes(words)).sim_hashes(size)
            step = max(1, size // 4)
            for at in sorted({*range(0, len(prints), step), len(prints) - 1}):
                by_size.setdefault(size, []).append((int(prints[at]), number, at))
        self.classes = []
        for size, rows in sorted(by_size.items()):
            prints = np.array([r[0] for r in rows], np.uint64)
            blocks = []
            for b in range(BLOCKS):
                value = self._block(prints, b)
                order = np.argsort(value, kind="stable")
                ends = np.searchsorted(value[order], np.arange((1 << BLOCK_BITS) + 1))
                blocks.append((np.diff(ends) > 0, ends, order))
            self.classes.append((size, prints, np.array([r[1:] for r in rows], np.int64), blocks))

    @staticmethod
    def _block(prints: np.ndarray, b: int) -> np.ndarray:
        return (prints >> np.uint64(b * BLOCK_BITS) & np.uint64((1 << BLOCK_BITS) - 1)).astype(np.int64)

    def near(self, hashes: np.ndarray) -> np.ndarray:
        """(item number, word where the item would begin), for all windows within the radius."""
        sums, out = WindowSums(hashes), []
        for size, prints, rows, blocks in self.classes:
            own = sums.sim_hashes(size)
            for b, (known, ends, order) in enumerate(blocks):
                value = self._block(own, b)
                at = np.flatnonzero(known[value])
                value = value[at]
                many = ends[value + 1] - ends[value]
                at = np.repeat(at, many)
                within = np.arange(len(at)) - np.repeat(np.cumsum(many) - many, many)
                which = order[np.repeat(ends[value], many) + within]
                close = np.bitwise_count(own[at] ^ prints[which]) <= RADIUS
                out.append(np.stack([rows[which[close], 0], at[close] - rows[which[close], 1]], 1))
        return np.unique(np.concatenate(out), axis=0) if out else np.zeros((0, 2), np.int64)


def _bag(hashes: np.ndarray) -> Counter:
    """Shingles of five words with their counts as weights; fewer words are one shingle."""
    size = min(SHINGLE, len(hashes))
    raw, width = hashes.tobytes(), 8 * size
    return Counter(raw[k : k + width] for k in range(0, len(raw) - width + 1, 8)) if size else Counter()


def similarity(a: Counter, b: Counter) -> float:
    """Weighted Jaccard similarity."""
    common = (a & b).total()
    return common / (a.total() + b.total() - common) if a or b else 0.0


def best_place(item: Counter, length: int, hashes: np.ndarray, start: int, threshold: float) -> tuple[float, int, int]:
    """(similarity, start, number of words) of the part of a document most like an item, around ``start``.

    All parts that can be as similar as ``threshold`` are judged, however much shorter or longer than the
    item: those that begin and end with a shingle of the item, as what stands beyond the outermost one only adds
    to the part. Of equally similar parts the first, then the shortest counts. Without a part like that the
    similarity is 0.
    """
    if length < SHINGLE:  # one shingle of all words: only the same words are similar
        raw, width = hashes.tobytes(), 8 * length
        for begin in sorted(range(max(0, start - SHIFT), start + SHIFT + 1), key=lambda b: abs(b - start)):
            if raw[8 * begin : 8 * begin + width] in item and begin + length <= len(hashes):
                return 1.0, begin, length
        return 0.0, start, 0
    total = item.total()
    most = int(total / threshold + 1e-9)  # shingles that a similar part has at most
    around = most - total + 1
    low, high = max(0, start - around), min(len(hashes), start + length + around)
    raw, width = hashes[low:high].tobytes(), 8 * SHINGLE
    shingles = [raw[k : k + width] for k in range(0, len(raw) - width + 1, 8)]
    shared = [k for k, x in enumerate(shingles) if x in item]
    best = (0.0, start, 0)
    if len(shared) < threshold * total - 1e-9:
        return best
    for n, first in enumerate(shared):
        if len(shared) - n < threshold * total - 1e-9:
            break
        held, common = Counter(), 0
        for last in shared[n:]:
            size = last - first + 1
            if size > most:
                break
            held[shingles[last]] += 1
            common += held[shingles[last]] <= item[shingles[last]]
            found = common / (total + size - common)
            if found > best[0]:
                best = (found, low + first, size + SHINGLE - 1)
        if best[0] == 1.0:
            break
    return best


def places(index: ItemIndex, texts: list[list[bytes]], threshold: float) -> list[tuple[int, int, int, int, float]]:
    """(text number, item id, start, words, similarity) of all verified places in some texts."""
    ends = np.cumsum([len(w) for w in texts])
    hashes = word_hashes([w for words in texts for w in words])
    out: dict[tuple[int, int, int], tuple[int, float]] = {}
    for number, start in index.near(hashes).tolist():
        item_id, words, bag = index.items[number]
        # The text that holds the middle of the place.
        middle = min(max(start + len(words) // 2, 0), len(hashes) - 1)
        text = int(np.searchsorted(ends, middle, side="right"))
        first = int(ends[text]) - len(texts[text])
        found, at, n = best_place(bag, len(words), hashes[first : int(ends[text])], start - first, threshold)
        if found >= threshold:
            out[text, item_id, at] = max(out.get((text, item_id, at), (0, 0.0)), (n, found), key=lambda x: x[1])
    return [(text, item, at, n, found) for (text, item, at), (n, found) in sorted(out.items())]


def _item_blocks(benchmark: DataFrame, id_col: str, text_col: str, block_words: int) -> list[list[tuple[int, str]]]:
    """Items in groups of about ``block_words`` words, each collected by itself when its turn comes."""
    items = benchmark.where(F.col(text_col).isNotNull()).select(
        F.col(id_col).cast("long").alias("item"), F.col(text_col).alias("text")
    )
    chars = items.agg(F.sum(F.length("text"))).first()[0] or 0
    blocks = -(-chars // (6 * block_words))
    return [items.where(F.pmod(F.xxhash64("item", "text"), F.lit(blocks)) == b) for b in range(blocks)]


def find_leaks(
    docs: DataFrame,
    benchmark: DataFrame,
    threshold: float = SIMILARITY,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_id_col: str = "item_id",
    item_text_col: str = "text",
    block_words: int = BLOCK_WORDS,
) -> DataFrame:
    """Places of documents that hold a benchmark item: doc_id, item_id, start_word, n_words, similarity.

    All windows of each whole document get SimHash fingerprints, in the sizes that items ask for.
    Fingerprints of items are looked up by ``RADIUS`` + 1 blocks of bits, so that every window within the
    radius is found. Around each such window the weighted Jaccard similarity of five-word shingles
    decides exactly, over parts of whatever length. Words are lower-case letters, digits and characters beyond ASCII.

    Items are searched for in groups of about ``block_words`` words; each group is one pass over the
    documents and is sent to tasks, and its result stored, before the next one is read. Items without words match nothing; items of
    fewer than five words are one shingle. Null and empty texts hold nothing. Repeated documents and items
    are rows like others, and so are rows of null id, which are returned with a null id. Documents aren't shuffled.
    """
    found = _leaks(docs, benchmark, threshold, id_col, text_col, item_id_col, item_text_col, block_words)
    return found.drop("text_")


def leaked_rows(
    docs: DataFrame,
    benchmark: DataFrame,
    threshold: float = SIMILARITY,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_id_col: str = "item_id",
    item_text_col: str = "text",
    block_words: int = BLOCK_WORDS,
) -> DataFrame:
    """Keys of the rows that hold an item: doc_id (null if the row's is) and text_, the hash of its text."""
    found = _leaks(docs, benchmark, threshold, id_col, text_col, item_id_col, item_text_col, block_words)
    return found.select("doc_id", "text_").distinct()


def _leaks(
    docs: DataFrame,
    benchmark: DataFrame,
    threshold: float,
    id_col: str,
    text_col: str,
    item_id_col: str,
    item_text_col: str,
    block_words: int,
) -> DataFrame:
    """Rows of ``find_leaks`` with the hash of their document's text as last column, text_."""
    spark, out = docs.sparkSession, None
    schema = "doc_id long, item_id long, start_word long, n_words long, similarity double, text_ long"
    rows = docs.select(
        F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"), text_hash(text_col).alias("text_")
    )
    blocks = _item_blocks(benchmark, item_id_col, item_text_col, block_words)
    for block in blocks:
        shared = spark.sparkContext.broadcast([(r[0], normal_words(r[1])) for r in block.collect()])

        def search(batches: Iterator[pd.DataFrame], shared=shared) -> Iterator[pd.DataFrame]:
            let_go()
            index = ItemIndex(sorted(shared.value, key=lambda x: (x[0] is None, x[0], x[1])))

            def found(ids: list, own: list, texts: list[list[bytes]]) -> pd.DataFrame:
                hits = places(index, texts, threshold) if any(texts) else []
                frame = pd.DataFrame(hits, columns=["doc_id", "item_id", "start_word", "n_words", "similarity"])
                frame["text_"] = np.array([own[t] for t in frame["doc_id"]], np.int64)
                frame["doc_id"] = pd.array([ids[t] for t in frame["doc_id"]], "Int64")
                frame["item_id"] = frame["item_id"].astype("Int64")
                return frame

            for batch in batches:
                ids, own, texts, held = [], [], [], 0
                for i, text_, text in zip(batch["id"].astype("Int64"), batch["text_"], batch["text"]):
                    ids.append(i)
                    own.append(text_)
                    texts.append(normal_words(text))
                    held += len(texts[-1])
                    if held >= BATCH_WORDS:
                        yield found(ids, own, texts)
                        ids, own, texts, held = [], [], [], 0
                yield found(ids, own, texts)

        part = rows.mapInPandas(search, schema)
        if len(blocks) > 1:  # one block's items are held at a time
            part = written(part)
            shared.unpersist()
        out = part if out is None else out.unionByName(part)
    return out if out is not None else spark.createDataFrame([], schema)


def leaked_documents(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """One row per document and item it holds: the most similar place, and the number of places."""
    return (
        find_leaks(docs, benchmark, **options)
        .groupBy("doc_id", "item_id")
        .agg(
            F.count("*").alias("n_places"),
            F.max(F.struct("similarity", (-F.col("start_word")).alias("minus"), "n_words")).alias("best"),
        )
        .select(
            "doc_id",
            "item_id",
            "n_places",
            (-F.col("best.minus")).alias("start_word"),
            F.col("best.n_words").alias("n_words"),
            F.col("best.similarity").alias("similarity"),
        )
    )
