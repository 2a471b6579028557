import hashlib
import math
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

from cohortloom.llm import prefix_trie as pt
from cohortloom.llm.tree_sums import subtree_sums

COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def expected(rows):
    """Rows (conv_id, turn, role, text) to the nodes of the trie."""
    turns = {}
    for conv, turn, role, text in rows:
        if conv is not None:
            turns.setdefault(conv, []).append((turn is not None, turn or 0, role or "", text or ""))

    def key(t):
        return t[0], t[1], hashlib.sha256(f"{len(t[2].encode())}:{t[2]}{t[3]}".encode()).digest()

    own = {c: [t[2:] for t in sorted(ts, key=key)] for c, ts in turns.items()}
    members = {}
    ends = {}
    for c in own:
        h = zlib.crc32(str(c).encode()) % 4
        whole = own.get(c - int(math.fmod(c, 20)), [])[:h] + own[c][h:]  # as SQL's %
        for d in range(len(whole) + 1):
            members.setdefault(tuple(whole[:d]), []).append(c)
        ends.setdefault(tuple(whole), []).append(c)
    children = {}
    for path in members:
        if path:
            children.setdefault(path[:-1], []).append(path)
    out = []

    def totals(path):
        words = len(re.findall("[^\x20\x09-\x0d]+", path[-1][1])) if path else 0
        leaves, saved = int(path not in children), (len(members[path]) - 1) * words
        for child in children.get(path, []):
            a, b = totals(child)
            leaves, saved = leaves + a, saved + b
        over = min(members[path[:-1]]) if path else None
        digest = hashlib.sha256(",".join(map(str, sorted(ends.get(path, [])))).encode()).hexdigest()
        out.append((min(members[path]), len(path), over, len(members[path]), len(children.get(path, [])), leaves, saved, digest))
        return leaves, saved

    if members:
        totals(())
    return sorted(out, key=repr)


def result(conversations):
    return sorted(map(tuple, pt.prefix_trie(conversations).select(*COLUMNS).collect()), key=repr)


SCHEMA = "conv_id long, turn long, role string, text string"


def test_whole_table(spark, root):
    conversations = spark.read.parquet(f"{root}/conversations.parquet")
    rows = [tuple(r) for r in conversations.select("conv_id", "turn", "role", "text").collect()]
    assert result(conversations) == expected(rows)


def test_odd_rows(spark):
    long = " ".join(f"w{i}" for i in range(30_000))
    rows = [
        (0, 0, "user", "a b"), (0, 1, "bot", "c"), (0, None, "user", "first of all"), (1, 0, None, None), (1, 0, None, None),
        (2, 0, "user", long), (2, 1, "", ""), (3, None, None, "x\x0by\x1cz"), (None, 0, "user", "of none"),
        (21, 0, "user", "its base is absent"), (22, 5, "user", "a b"), (22, 5, "bot", "tie"), (23, 0, "u", "é ☃"),
        (-5, 0, "user", "a b"), (-5, 1, "bot", "c"), (19, 0, "user", "own"), (19, 1, "user", "own"),
    ]
    more = [(*r, 1, "p", "q") for r in rows]
    conversations = spark.createDataFrame(more, f"{SCHEMA}, depth int, place string, node string")
    assert result(conversations) == expected(rows)


def test_no_rows(spark):
    assert result(spark.createDataFrame([], SCHEMA)) == []
    assert result(spark.createDataFrame([(None, 0, "user", "x")], SCHEMA)) == []


def test_copies_and_a_long_conversation(spark, monkeypatch):
    """Prefixes go over blocks, ids over pieces."""
    monkeypatch.setattr(pt, "BLOCK", 8)
    monkeypatch.setattr(pt, "PIECE_BITS", 3)
    rows = [(c, t, "user", f"t{t}") for c in range(100, 160) for t in range(4)]
    rows += [(40, t, "user" if t % 2 else "bot", f"long {t % 3} " * (t % 4)) for t in range(150)]
    rows += [(60, t, "user" if t % 2 else "bot", f"long {t % 3} " * (t % 4)) for t in range(120)]
    assert result(spark.createDataFrame(rows, SCHEMA)) == expected(rows)


@pytest.mark.parametrize("kind", ["star", "random", "forest"])
def test_subtree_sums(spark, kind):
    rng = random.Random(5)
    n = 60
    parents = {
        "star": [None, *[0] * (n - 1)],
        "random": [None, *[rng.randrange(i) for i in range(1, n)]],
        "forest": [None, None, None, *[max(0, i - rng.randint(1, 3)) for i in range(3, n)]],
    }[kind]
    depth = []
    for p in parents:
        depth.append(0 if p is None else depth[p] + 1)
    value = [rng.randrange(100) for _ in parents]
    want = list(value)
    for i in reversed(range(n)):
        if parents[i] is not None:
            want[parents[i]] += want[i]
    rows = [(i, p, d, v, 1) for i, (p, d, v) in enumerate(zip(parents, depth, value))]
    nodes = spark.createDataFrame(rows, "node long, parent long, depth int, v long, one long")
    got = {r.node: r.v for r in subtree_sums(nodes, ["v", "one"]).collect()}
    assert got == dict(enumerate(want))


def test_rounds_grow_with_the_logarithm_of_a_chain(spark, monkeypatch):
    """A chain of 200 nodes is contracted in a few rounds, not in 200."""
    from cohortloom.llm import tree_sums

    rounds = []
    before = tree_sums._raked
    monkeypatch.setattr(tree_sums, "_raked", lambda *a: rounds.append(1) or before(*a))
    nodes = spark.range(200).select(
        F.col("id").alias("node"), F.when(F.col("id") > 0, F.col("id") - 1).alias("parent"),
        F.col("id").cast("int").alias("depth"), F.lit(1).cast("long").alias("v"),
    )
    got = {r.node: r.v for r in subtree_sums(nodes, ["v"]).collect()}
    assert got == {i: 200 - i for i in range(200)}
    assert len(rounds) <= 12
