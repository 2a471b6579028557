"""Near dedup: BagMinHash against weighted Jaccard, classes against brute force."""

import random

import numpy as np
import pytest
from cohortloom.llm import near_dedup as nd
from cohortloom.llm.common import normal_words
from cohortloom.llm.components import components
from cohortloom.llm.queries import QUERIES


def test_signatures_estimate_weighted_jaccard():
    rng = np.random.default_rng(1)
    a = {int(x): int(rng.integers(1, 9)) for x in rng.integers(1, 1 << 62, 60)}
    b = {x: max(1, w + int(rng.integers(-2, 3))) for x, w in list(a.items())[:45]}
    b |= {int(x): 3 for x in rng.integers(1, 1 << 62, 12)}
    exact = sum(min(a.get(x, 0), b.get(x, 0)) for x in a | b) / sum(max(a.get(x, 0), b.get(x, 0)) for x in a | b)
    bags = [a, b]
    signatures = nd.bag_min_hash(
        np.array([x for bag in bags for x in bag], np.uint64),
        np.array([w for bag in bags for w in bag.values()]),
        np.repeat([0, 1], [len(a), len(b)]),
        2,
        8192,
    )
    assert abs((signatures[0] == signatures[1]).mean() - exact) < 0.03


def test_signatures_do_not_depend_on_neighbours():
    items = np.arange(1, 40, dtype=np.uint64) * np.uint64(7919)
    ones = np.ones(39, np.int64)
    alone = nd.bag_min_hash(items, ones, np.zeros(39, np.int64), 1)
    pair = nd.bag_min_hash(
        np.concatenate([items[:3], items]), np.ones(42, np.int64), np.repeat([0, 1], [3, 39]), 2
    )
    assert (alone[0] == pair[1]).all()


@pytest.mark.parametrize("seed", range(3))
def test_components(spark, seed):
    rng = random.Random(seed)
    edges = [(rng.randint(0, 60), rng.randint(0, 60)) for _ in range(45)] + [(100 + i, 101 + i) for i in range(20)]
    parent = {x: x for e in edges for x in e}

    def top(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        parent[max(top(a), top(b))] = min(top(a), top(b))
    wanted = {(x, top(x)) for e in edges if e[0] != e[1] for x in e}
    got = components(spark.createDataFrame(edges, "a long, b long"), "a", "b")
    assert {tuple(r) for r in got.collect()} == wanted


def brute(rows):
    texts = {}
    for i, text in rows:
        if i is not None:
            texts.setdefault(tuple(normal_words(text)), []).append(i)
    keys = list(texts)
    bags = [nd.multiset(list(k)) for k in keys]
    parent = list(range(len(keys)))

    def top(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(keys)):
        for j in range(i):
            n, m = sorted((len(bags[i]), len(bags[j])))
            if n and n >= 0.8 * m and nd.similarity(bags[i], bags[j]) >= 0.8:
                parent[top(i)] = top(j)
    least = {}
    for k, key in enumerate(keys):
        least[top(k)] = min(least.get(top(k), min(texts[key])), min(texts[key]))
    of = {key: least[top(k)] for k, key in enumerate(keys)}
    return sorted(((i, None if i is None else of[tuple(normal_words(t))]) for i, t in rows), key=repr)


def got(df):
    return sorted(((r.doc_id, r.class_id) for r in df.collect()), key=repr)


def test_query_equals_brute_force(spark):
    root = "/root/testdata/sf0.01"
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{root}/documents.parquet").collect()]
    assert got(QUERIES["op10_near_dedup"](spark, root)) == brute(rows)


def test_odd_rows(odd, nothing):
    assert got(nd.near_duplicates(odd)) == brute([(r.doc_id, r.text) for r in odd.collect()])
    assert nd.near_duplicates(nothing).count() == 0


def test_groups_of_changed_copies(spark):
    rng = random.Random(4)
    words = [f"word{i}" for i in range(400)]
    rows = []
    for group in range(3):
        base = [rng.choice(words) for _ in range(120)]
        for k in range(25):
            changed = list(base)
            for _ in range(k % 4):
                changed[rng.randrange(120)] = rng.choice(words)
            rows.append((group * 100 + k, " ".join(changed)))
    rows += [(1000 + i, " ".join(rng.choice(words) for _ in range(120))) for i in range(20)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert got(nd.near_duplicates(df)) == brute(rows)


@pytest.mark.parametrize("block", [2, 256])
def test_buckets_of_many_unlike_texts(spark, monkeypatch, block):
    """With bands that all agree, every bucket holds all texts, most unlike its leader."""
    monkeypatch.setattr(nd, "BLOCK", block)
    monkeypatch.setattr(nd, "band_keys", lambda s: np.tile(np.arange(nd.BANDS, dtype=np.int64), (len(s), 1)))
    rng = random.Random(6)
    rows = []
    for group in range(5):
        base = [f"g{group}w{i}" for i in range(60)]
        for k in range(3):
            changed = list(base)
            changed[k] = f"new{rng.random()}"
            rows.append((group * 10 + k, " ".join(changed)))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert got(nd.near_duplicates(df)) == brute(rows)
