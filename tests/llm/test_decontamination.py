"""Decontamination: bit-sliced SimHash, and leaks against brute force."""

import random
from collections import Counter

import numpy as np
import pytest
from cohortloom.llm import decontamination as dec
from cohortloom.llm.common import normal_words
from cohortloom.llm.queries import QUERIES


def slow_sim_hash(hashes):
    ones = sum((int(h) >> np.arange(64, dtype=object) & 1) for h in hashes)
    return sum(1 << k for k in range(64) if ones[k] > len(hashes) // 2)


@pytest.mark.parametrize("size", [1, 2, 3, 5, 7, 8, 13, 20])
def test_window_fingerprints(size):
    hashes = np.random.default_rng(size).integers(0, 1 << 63, 40).astype(np.uint64) * np.uint64(2)
    fast = dec.WindowSums(hashes).sim_hashes(size)
    assert fast.tolist() == [slow_sim_hash(hashes[k : k + size]) for k in range(40 - size + 1)]


def test_all_fingerprints_within_the_radius_are_found():
    rng = np.random.default_rng(5)
    words = [b"w%d" % i for i in range(30)]
    index = dec.ItemIndex([(1, words)])
    size, prints, rows, blocks = index.classes[0]
    for _ in range(200):
        target = int(rng.integers(len(prints)))
        flipped = int(prints[target])
        for bit in rng.choice(64, dec.RADIUS, replace=False):
            flipped ^= 1 << int(bit)
        own = np.array([flipped], np.uint64)
        hits = set()
        for b, (known, ends, order) in enumerate(blocks):
            v = dec.ItemIndex._block(own, b)[0]
            hits |= {int(x) for x in order[ends[v] : ends[v + 1]] if bin(flipped ^ int(prints[x])).count("1") <= dec.RADIUS}
        assert target in hits


def bag_of(words):
    size = min(5, len(words))
    return Counter(tuple(words[k : k + size]) for k in range(len(words) - size + 1)) if words else Counter()


def alike(a, b):
    common = (a & b).total()
    return common / (a.total() + b.total() - common) if a or b else 0.0


def best_similarity(words, item):
    """The highest of all parts of a text, of all lengths that can reach 0.8."""
    bag, best = bag_of(item), 0.0
    for start in range(len(words)):
        for n in range(max(1, int(0.75 * len(item))), int(1.3 * len(item)) + 6):
            if start + n <= len(words):
                best = max(best, alike(bag, bag_of(words[start : start + n])))
    return best


def brute(docs, items):
    """Pairs with a part of the document, of whatever length, at 0.8 or more."""
    out = set()
    for i, text in docs:
        words = normal_words(text)
        own = bag_of(words)
        for j, item in items:
            other = normal_words(item)
            if not other or len(other) >= 5 and (bag_of(other) & own).total() < 0.8 * bag_of(other).total():
                continue
            if best_similarity(words, other) >= 0.8:
                out.add((i, j))
    return out


def test_query_equals_brute_force(spark, root, documents):
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{root}/benchmark.parquet").collect()]
    got = {(r.doc_id, r.item_id) for r in QUERIES["op6_decontamination"](spark, root).collect()}
    assert got == brute([(r.doc_id, r.text) for r in documents.collect()], items)
    assert got


def test_changed_passages(spark):
    item = " ".join(f"word{i}" for i in range(60))
    words = item.split()
    texts = [
        "before it " + item.upper() + ". after it",
        "x " + " ".join([*words[:20], "changed", *words[21:]]) + " y",
        "x " + " ".join([*words[:10], "put", "in", *words[10:]]) + " y",
        "x " + " ".join(words[3:]) + " y",
        "x " + " ".join(words[:20]) + " y",
        "x " + " ".join(reversed(words)) + " y",
        "far before it " + " ".join(words[:51]) + " and other words after it",
        "far before it " + " ".join(words[9:]) + " and other words after it",
        "x " + " ".join(words[:30]) + " four words put in " + " ".join(words[30:]) + " y",
    ]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    items = spark.createDataFrame([(7, item), (8, None), (9, ""), (7, item)], "item_id long, text string")
    got = {r.doc_id for r in dec.leaked_documents(docs, items).collect()}
    assert got == {0, 1, 2, 3, 6, 7, 8}
    assert got == {i for i, text in enumerate(texts) if best_similarity(normal_words(text), normal_words(item)) >= 0.8}
    assert got == {r.doc_id for r in dec.leaked_documents(docs, items, block_words=1).collect()}


def test_places_are_the_best_parts():
    rng = random.Random(2)
    for _ in range(60):
        item = [b"%d" % rng.randrange(12) for _ in range(rng.randrange(1, 30))]
        part = [w for w in item if rng.random() > 0.04]
        before, after = ([b"%d" % rng.randrange(12) for _ in range(20)] for _ in range(2))
        words = before + part + after
        bag = dec._bag(dec.word_hashes(item))
        found, at, n = dec.best_place(bag, len(item), dec.word_hashes(words), 20, 0.8)
        assert found == pytest.approx(alike(bag_of(item), bag_of(words[at : at + n])) if n else 0.0)
        # Parts near the place that are more similar than the threshold don't surpass it.
        around = words[max(0, 20 - len(item) // 3) : 20 + len(item) + len(item) // 3]
        best = best_similarity(around, item)
        assert best < 0.8 or found >= best - 1e-9


def test_odd_rows_and_no_rows(spark, odd, nothing):
    items = spark.createDataFrame([(1, "one"), (2, "another text under the same id"), (None, "endoftext")], "item_id long, text string")
    got = {(r.doc_id, r.item_id) for r in dec.find_leaks(odd, items).collect()}
    assert got == {(9, 1), (6, 2), (8, None)}
    assert dec.leaked_documents(nothing, items).count() == 0
    assert dec.leaked_documents(odd, nothing.selectExpr("doc_id item_id", "text")).count() == 0
