"""Near-duplicate documents: BagMinHash signatures of weighted shingles, bands, exact verification."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, functions as F

from cohortloom.llm.common import let_go, normal_words, partitions, text_hash, written
from cohortloom.llm.components import components
from cohortloom.llm.membership import with_possible

SHINGLE = 5
SIMILARITY = 0.8
BANDS, ROWS = 32, 8
WIDTH = BANDS * ROWS
BLOCK = 256  # members of a bucket that are compared with one another, or with another block, at once
# Signatures agree in a share of components whose standard deviation is 0.025 at 0.8; pairs that miss the
# threshold by this margin, nearly five of these, aren't verified.
MARGIN = 0.12
GOLDEN = np.uint64(0x9E3779B97F4A7C15)
BATCH_SHINGLES = 1 << 17


def _mixed(x: np.ndarray) -> np.ndarray:
    """A 64-bit mixing step (the constants are those of splitmix64)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingles(words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct hashed shingles of five words in order, and how often each occurs.

    Fewer words make one shingle of all of them; no words make none.
    """
    if not words:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    each = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
    size = min(SHINGLE, len(words))
    out = np.zeros(len(words) - size + 1, np.uint64)
    for k in range(size):
        out = _mixed(out * GOLDEN + each[k : len(words) - size + 1 + k])
    return np.unique(out, return_counts=True)


def multiset(words: list[bytes]) -> np.ndarray:
    """Sorted hashes of (shingle, number of its occurrence): overlaps of these sets are multiset overlaps."""
    found, counts = shingles(words)
    repeated = np.repeat(found, counts)
    nth = np.arange(len(repeated)) - np.repeat(np.cumsum(counts) - counts, counts)
    return np.sort(_mixed(repeated + nth.astype(np.uint64) * GOLDEN))


def similarity(a: np.ndarray, b: np.ndarray) -> float:
    """Weighted Jaccard similarity of two shingle multisets."""
    if not len(a) and not len(b):
        return 1.0
    both = np.concatenate([a, b])
    both.sort(kind="stable")
    common = int((both[1:] == both[:-1]).sum())
    return common / (len(both) - common)


def bag_min_hash(
    items: np.ndarray, weights: np.ndarray, owners: np.ndarray, n: int, width: int = WIDTH
) -> np.ndarray:
    """Signatures of ``n`` weighted sets; equal components are as likely as the sets are similar.

    Weights are cut into unit levels, and the levels of an item into nodes of 1, 2, 4, ... levels. Each
    node is a Poisson process: its points come in ascending order, with rate levels x width, each with a
    random level of the node and a random component. A point counts if its level is within the weight,
    so the points of a level are the same in every set that reaches it. A component keeps its smallest
    point. An item stops as soon as its points are beyond all that its set has kept.
    """
    kept = np.full(n * width, np.inf)
    depth = np.floor(np.log2(np.maximum(weights, 1))).astype(np.int64) + 1
    node = np.arange(depth.sum()) - np.repeat(np.cumsum(depth) - depth, depth)
    seed = _mixed(np.repeat(items, depth) + _mixed(node.astype(np.uint64) + np.uint64(1)))
    weight, owner = np.repeat(weights, depth), np.repeat(owners, depth)
    levels = (1 << node).astype(np.int64)
    at = np.zeros(len(seed))
    drawn, take = 0, 2
    while len(seed):
        step = np.arange(drawn + 1, drawn + take + 1, dtype=np.uint64) * GOLDEN
        first = _mixed(seed[:, None] + step)
        gaps = -np.log1p(-(first >> np.uint64(11)).astype(np.float64) * 2.0**-53)
        points = at[:, None] + np.cumsum(gaps, axis=1) / (levels[:, None] * float(width))
        highest = kept.reshape(n, width).max(axis=1)
        row, column = np.nonzero(points < highest[owner][:, None])
        second = _mixed(first[row, column] ^ GOLDEN)
        level = levels[row] + ((second >> np.uint64(40)).astype(np.int64) * levels[row] >> 24)
        within = level <= weight[row]
        row, column, second = row[within], column[within], second[within]
        component = (second & np.uint64(0xFFFFFFFF)).astype(np.int64) * width >> 32
        np.minimum.at(kept, owner[row] * width + component, points[row, column])
        at = points[:, -1]
        on = np.flatnonzero(at < kept.reshape(n, width).max(axis=1)[owner])
        seed, weight, owner, levels, at = seed[on], weight[on], owner[on], levels[on], at[on]
        drawn += take
        take *= 2
    return kept.reshape(n, width)


def band_keys(signatures: np.ndarray) -> np.ndarray:
    """One 64-bit key for each band of each signature; keys of different bands differ."""
    values = signatures.view(np.uint64).reshape(len(signatures), BANDS, ROWS)
    keys = np.broadcast_to(_mixed(np.arange(1, BANDS + 1, dtype=np.uint64)), values.shape[:2]).copy()
    for k in range(ROWS):
        keys = _mixed(keys * GOLDEN + values[:, :, k])
    return keys.view(np.int64)


def component_bytes(signatures: np.ndarray) -> np.ndarray:
    """A byte of hash of each component, to compare whole signatures by."""
    return (_mixed(signatures.view(np.uint64)) >> np.uint64(56)).astype(np.uint8)


SIGNED = "id long, text_ long, text_key binary, node long, n_shingles long, keys array<long>, signature binary"


def signed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Per document the hash of its text, a 128-bit key of its words, its number of shingles and its band keys."""

    def sign(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        let_go()
        for batch in batches:
            start, held, bags = 0, 0, []
            keys = []

            def out(end: int) -> pd.DataFrame:
                sizes = [len(x) for x, _ in bags]
                owners = np.repeat(np.arange(len(bags)), sizes)
                signatures = bag_min_hash(
                    np.concatenate([x for x, _ in bags]), np.concatenate([c for _, c in bags]), owners, len(bags)
                )
                bands, octets = band_keys(signatures), component_bytes(signatures)
                return pd.DataFrame(
                    {
                        "id": batch["id"].iloc[start:end].array,
                        "text_": batch["text_"].iloc[start:end].array,
                        "text_key": keys,
                        "node": np.array([_node(k) for k in keys], np.int64),
                        "n_shingles": [int(c.sum()) for _, c in bags],
                        "keys": [k if s else None for k, s in zip(bands, sizes)],
                        "signature": [x.tobytes() for x in octets],
                    }
                )

            for i, text in enumerate(batch["text"]):
                words = normal_words(text)
                keys.append(_text_key(words))
                bags.append(shingles(words))
                held += len(bags[-1][0])
                if held >= BATCH_SHINGLES:
                    yield out(i + 1)
                    start, held, bags, keys = i + 1, 0, [], []
            if bags:
                yield out(len(batch))

    return docs.select(
        F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"), text_hash(text_col).alias("text_")
    ).mapInPandas(sign, SIGNED)


def _text_key(words: list[bytes]) -> bytes:
    return xxhash.xxh3_128_digest(b" ".join(words))


def _node(text_key: bytes) -> int:
    """A text as a number: 64 bits of its key."""
    return int.from_bytes(text_key[:8], "little", signed=True)


def _multisets(docs: DataFrame, nodes: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Shingle multisets of texts that share a bucket with another, by the id of one row of each: node, bag."""

    def bags(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            texts = [normal_words(t) for t in batch["text"]]
            yield pd.DataFrame(
                {
                    "node": np.array([_node(_text_key(w)) for w in texts], np.int64),
                    "bag": [multiset(w).astype("<u8").tobytes() for w in texts],
                }
            )

    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    ids = nodes.select("id").distinct()
    # Most texts share no bucket; these aren't shuffled.
    near = with_possible(rows, [F.col("id")], ids, "near").where("near").drop("near")
    found = near.join(ids, "id", "left_semi").mapInPandas(bags, "node long, bag binary")
    # Rows given twice, and other texts of the same id.
    return found.join(nodes.select("node").distinct(), "node", "left_semi").dropDuplicates(["node"])


def verified(pairs: DataFrame, bags: DataFrame, threshold: float) -> DataFrame:
    """Pairs (a, b) with whether their multisets overlap enough."""

    def check(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            alike = [
                similarity(np.frombuffer(x, "<u8"), np.frombuffer(y, "<u8")) >= threshold
                for x, y in zip(batch["bag_a"], batch["bag_b"])
            ]
            yield pd.DataFrame({"a": batch["a"], "b": batch["b"], "linked": np.array(alike, bool)})

    return (
        pairs.join(bags.select(F.col("node").alias("b"), F.col("bag").alias("bag_b")), "b")
        .join(bags.select(F.col("node").alias("a"), F.col("bag").alias("bag_a")), "a")
        .mapInPandas(check, "a long, b long, linked boolean")
    )


def _sizes_allow(a, b, threshold: float):
    """Whether multisets of these sizes can be as similar as that; for columns or arrays."""
    return (a >= threshold * b - 1e-9) & (b >= threshold * a - 1e-9)


def _led_pairs(members: DataFrame, threshold: float) -> DataFrame:
    """Each bucket's smallest member with each other one."""
    leader = members.groupBy("key").agg(F.min(F.struct("node", "n_shingles")).alias("leader"))
    return (
        members.join(leader, "key")
        .where(F.col("node") != F.col("leader.node"))
        .where(_sizes_allow(F.col("n_shingles"), F.col("leader.n_shingles"), threshold))
        .select(F.col("leader.node").alias("a"), F.col("node").alias("b"))
        .distinct()
    )


def _open_buckets(members: DataFrame) -> DataFrame:
    """Buckets whose members are in several components, and how many these are."""
    return (
        members.groupBy("key")
        .agg(F.min("component").alias("low"), F.max("component").alias("high"), F.count("*").alias("size"))
        .where(F.col("low") != F.col("high"))
        .select("key", "size")
    )


class _Groups:
    """Components put together while links between their members are found."""

    def __init__(self):
        self.parent: dict[int, int] = {}

    def top(self, x: int) -> int:
        while (up := self.parent.get(x, x)) != x:
            x = up
        return x

    def join(self, x: int, y: int) -> bool:
        x, y = self.top(x), self.top(y)
        self.parent[x] = y
        return x != y


def _open_links(members: DataFrame, texts: DataFrame, bags: DataFrame, threshold: float) -> DataFrame:
    """Links between members of one bucket that are in different components, as many as join these.

    A bucket is dealt into blocks of about ``BLOCK`` members, and every two blocks of it meet in one
    task. All pairs of different components there are verified by their multisets unless their
    signatures rule them out; a pair that links found before have put together needs no look. Only links
    that join components become rows, fewer than members.
    """
    groups, floor = 4 * partitions(members.sparkSession), threshold - MARGIN
    several = _open_buckets(members).select("key", F.ceil(F.col("size") / BLOCK).cast("int").alias("blocks"))
    dealt = (
        members.join(several, "key")
        .withColumn("own", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .withColumn("i", F.least("own", "other"))
        .withColumn("j", F.greatest("own", "other"))
        .join(texts.select("node", "signature"), "node")
        .join(bags, "node")
        .withColumn("deal", F.pmod(F.xxhash64("key", "i", "j"), F.lit(groups)))
        .select("deal", "key", "i", "j", "own", "node", "n_shingles", "component", "signature", "bag")
    )

    def links(pdf: pd.DataFrame) -> pd.DataFrame:
        found = []
        for (_, i, j), rows in pdf.groupby(["key", "i", "j"], sort=False):
            octets = np.stack([np.frombuffer(x, np.uint8) for x in rows["signature"]])
            sets = [np.frombuffer(x, "<u8") for x in rows["bag"]]
            node, n, component, own = (rows[c].to_numpy() for c in ("node", "n_shingles", "component", "own"))
            together, two = _Groups(), np.flatnonzero(own == j)
            for x in np.flatnonzero(own == i).tolist():
                y = two[node[two] > node[x]] if i == j else two
                y = y[(component[y] != component[x]) & _sizes_allow(n[x], n[y], threshold)]
                y = y[(octets[y] == octets[x]).mean(axis=1) >= floor]
                for z in y.tolist():
                    a, b = int(component[x]), int(component[z])
                    if together.top(a) != together.top(b) and similarity(sets[x], sets[z]) >= threshold:
                        together.join(a, b)
                        found.append((node[x], node[z]))
        return pd.DataFrame(found, columns=["a", "b"]).astype("int64")

    return dealt.groupBy("deal").applyInPandas(links, "a long, b long")


def _component_of(rows: DataFrame, node: str, labels: DataFrame, name: str) -> DataFrame:
    """``rows`` with the component of a node, which is the node itself where it has no links."""
    found = labels.select(F.col("node").alias(node), F.col("component").alias(name))
    return rows.join(found, node, "left").withColumn(name, F.coalesce(name, node))


def _merged(labels: DataFrame, links: DataFrame) -> DataFrame:
    """Labels of nodes after more links: components are put together as the nodes of a smaller graph."""
    between = _component_of(_component_of(links, "a", labels, "c_a"), "b", labels, "c_b")
    joined = written(components(between, "c_a", "c_b"))
    wholes = joined.select(F.col("node").alias("part"), F.col("component").alias("whole"))
    old = (
        labels.withColumnRenamed("component", "part")
        .join(wholes, "part", "left")
        .select("node", F.coalesce("whole", "part").alias("component"))
    )
    return written(old.unionByName(joined.join(labels, "node", "left_anti")))


def near_duplicates(
    docs: DataFrame, threshold: float = SIMILARITY, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row per document: doc_id, class_id (the smallest id of its class), n_shingles.

    Classes are the connected groups of documents whose multisets of five-word shingles have a weighted
    Jaccard similarity of ``threshold`` at least. Words are lower-case letters, digits and
    characters beyond ASCII. Documents of the same words are one from the start, however many they are;
    that includes texts without words, null among them. Fewer than five words are one shingle. Each
    row is judged by its own text, also where ids repeat; rows of null id have no class and link nothing.

    Signatures find pairs at 0.8 with probability 0.997 (32 bands of 8), and closer ones almost surely;
    every pair is verified by its multisets. A bucket is never expanded into all pairs of rows. First its
    smallest member leads and is verified with each other one, which makes one component of most
    groups of copies. Where a bucket still has several components, its members meet in blocks, and all
    pairs of different components that signatures don't rule out are verified within the task, which
    gives back no more than the links that join components. Of the links that the bands show, only those are
    lost whose signatures agree in less than ``threshold`` - ``MARGIN`` of their components, nearly five standard
    deviations below it.
    """
    return classified(docs, threshold, id_col, text_col).select("doc_id", "class_id", "n_shingles")


def copies(
    docs: DataFrame, threshold: float = SIMILARITY, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Keys of rows that aren't all kept if one row of each class stays: doc_id, text_, first.

    The row of smallest id stays; of several texts under that id, the one of smallest hash. ``first`` is
    true for a key that several rows have and one of them is to stay, else none of the key's rows is.
    Rows of null id aren't among them.
    """
    return (
        classified(docs, threshold, id_col, text_col)
        .where(F.col("doc_id").isNotNull())
        .groupBy("doc_id", "text_")
        .agg(
            F.min((F.col("doc_id") == F.col("class_id")) & (F.col("text_") == F.col("class_text_"))).alias("first"),
            F.count("*").alias("n"),
        )
        .where(~F.col("first") | (F.col("n") > 1))
        .select("doc_id", "text_", "first")
    )


def classified(docs: DataFrame, threshold: float, id_col: str, text_col: str) -> DataFrame:
    """Rows of ``near_duplicates`` with the hashes of their own text and of their class's first: text_, class_text_."""
    every = written(signed(docs, id_col, text_col))
    texts = written(
        every.where(F.col("id").isNotNull())
        .groupBy("text_key", "node")
        .agg(
            F.min("id").alias("id"),
            F.min(F.struct("id", "text_")).alias("least"),
            F.first("n_shingles").alias("n_shingles"),
            F.first("keys").alias("keys"),
            F.first("signature").alias("signature"),
        )
    )
    banded = texts.select("node", "id", "n_shingles", F.explode("keys").alias("key"))
    shared = banded.groupBy("key").agg(F.count("*").alias("n")).where(F.col("n") > 1).select("key")
    members = written(banded.join(shared, "key").select("key", "node", "id", "n_shingles"))
    bags = written(_multisets(docs, members.select("node", "id"), id_col, text_col))

    checked = written(verified(_led_pairs(members, threshold), bags, threshold))
    labels = written(components(checked.where("linked"), "a", "b"))
    labelled = _component_of(members.drop("id"), "node", labels, "component")
    labels = _merged(labels, written(_open_links(labelled, texts, bags, threshold)))
    of_texts = _component_of(texts.select("text_key", "node", "least"), "node", labels, "component").drop("node")
    classes = of_texts.groupBy("component").agg(F.min("least").alias("least"))
    keyed = of_texts.drop("least").join(classes, "component").select(
        "text_key", F.col("least.id").alias("class_id"), F.col("least.text_").alias("class_text_")
    )
    return (
        every.drop("node")
        .join(keyed, "text_key", "left")
        .select(
            F.col("id").alias("doc_id"),
            F.when(F.col("id").isNotNull(), F.col("class_id")).alias("class_id"),
            "n_shingles",
            "text_",
            "class_text_",
        )
    )
