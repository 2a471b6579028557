"""Top-k against brute force."""

import math
import random

import numpy as np
import pandas as pd
import pytest
from cohortloom.llm import topk
from cohortloom.llm.queries import QUERIES
from pyspark.sql import functions as F


def long(x):
    return max(1 - 2**63, min(2**63 - 1, x))


def brute(rows, k, divisor):
    vectors = {}
    for i, v in rows:
        if i is None or v is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        vectors.setdefault(i, set()).add(tuple(long(math.floor(1024 * x)) for x in v))
    out = []
    for q, own in vectors.items():
        if q % divisor:
            continue
        a = min(own)
        scored = sorted(
            (-long(sum(x * y for x, y in zip(a, b))), i)
            for i, all_ in vectors.items()
            for b in all_
            if i != q and len(a) == len(b)
        )[:k]
        out += [(q, n + 1, i, -s) for n, (s, i) in enumerate(scored)]
    return sorted(out)


def run(df, k=10, divisor=100):
    return sorted(tuple(r) for r in topk.top_k(df, F.col("vec_id") % divisor == 0, k).collect())


def test_query_equals_brute_force(spark):
    root = "/root/testdata/sf0.01"
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{root}/embeddings.parquet").collect()]
    assert sorted(tuple(r) for r in QUERIES["op2_top_k"](spark, root).collect()) == brute(rows, 10, 100)


@pytest.mark.parametrize("block", [4096, 7])
def test_odd_vectors_ties_and_common_ones(spark, monkeypatch, block):
    monkeypatch.setattr(topk, "ROW_BLOCK", block)
    monkeypatch.setattr(topk, "QUERY_BLOCK", block)
    rng = random.Random(3)
    rows = [(i, [rng.choice([-1.0, 0.0, 0.5, 1.0]) for _ in range(5)]) for i in range(300)]
    rows += [(i, [0.5, 0.25, 0.0, -0.5, 1.0]) for i in range(300, 420)]  # one vector, many rows
    rows += [(500, None), (510, [None, 1.0, 1.0, 1.0, 1.0]), (520, [float("nan")] * 5), (530, [float("inf")] * 5)]
    rows += [(540, [1.0, 2.0]), (550, []), (560, [1e12, 1e12, -1e12, 0.3, 2.0]), (None, [0.0] * 5)]
    rows += [(10, rows[10][1]), (10, [0.1] * 5)]
    df = spark.createDataFrame([(*r, "x") for r in rows], "vec_id long, embedding array<float>, class string")
    real = [(r.vec_id, r.embedding) for r in df.collect()]
    assert run(df, 7, 10) == brute(real, 7, 10)


def test_large_components_stay_exact(spark):
    rows = [(0, [2.0**20 + 1, 3.0]), (1, [2.0**20, 5.0]), (2, [1.0, 2.0**21]), (3, [2.0**20, 5.25])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    assert run(df, 5, 1) == brute(rows, 5, 1)


@pytest.mark.parametrize("bits", [18, 19, 20, 40])
def test_scores_beyond_float64(spark, monkeypatch, bits):
    """More rows than k, so that there are cutoffs; neighbouring scores differ by less than a double shows."""
    monkeypatch.setattr(topk, "ROW_BLOCK", 32)
    rng = random.Random(bits)
    rows = [(i, [rng.choice([-1, 1]) * (2.0**bits + rng.randrange(64) / 1024) for _ in range(3)]) for i in range(120)]
    rows += [(i, [2.0**bits + (i % 3) / 1024, 2.0**bits, 2.0**bits]) for i in range(120, 160)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    assert run(df, 10, 20) == brute(rows, 10, 20)


def test_products_are_exact():
    rng = np.random.default_rng(1)
    for low, high in ((-(2**62), 2**62), (-5, 5), (0, 2**35), (-(2**63), -(2**63) + 9)):
        a, b = rng.integers(low, high, (4, 7)), rng.integers(low, high, (6, 7))
        products = topk.Products(a, b)
        found = sum(products.part(s) for s in products.slices)
        want = [[sum(int(x) * int(y) for x, y in zip(p, q)) for q in b] for p in a]
        assert found.tolist() == want


def test_entries_below_the_cutoff_are_not_resolved(monkeypatch):
    """Of the slices after the first, only entries that can reach the cutoff are scored."""
    rng = np.random.default_rng(2)
    rows = rng.integers(-50, 50, (400, 8)) * np.linspace(0.01, 20, 400)[:, None].astype(int).clip(1)
    queries = rng.integers(-50, 50, (3, 8))
    whole = queries @ rows.T
    cutoffs = np.sort(whole, axis=1)[:, -11]
    resolved = []
    real = topk.Products.part
    monkeypatch.setattr(
        topk.Products, "part", lambda self, s, *a: resolved.append(len(a[1]) if a else 0) or real(self, s, *a)
    )
    block = pd.DataFrame(
        [
            {
                "dim": 8, "classes": np.arange(400).tobytes(), "matrix": rows.astype("<i8").tobytes(),
                "q_classes": np.arange(3).tobytes(), "q_matrix": queries.astype("<i8").tobytes(),
                "cutoff": cutoffs.astype("<i8").tobytes(),
            }
        ]
    )
    (found,) = topk._sufficient(11)([block])
    assert sorted(found["score"]) == sorted(np.sort(whole, axis=1)[:, -11:].ravel())
    assert sum(resolved) < 600  # of 1200


def packed(spark, vectors, size, first=0):
    rows = [(first + i, [int(x) for x in v]) for i, v in enumerate(vectors)]
    return topk._packed_blocks(spark.createDataFrame(rows, "class long, vector array<long>").coalesce(1), size, [])


def test_every_pair_of_blocks_meets_in_one_cell_and_is_no_row(spark):
    rng = np.random.default_rng(4)
    row_blocks = packed(spark, rng.integers(-9, 9, (70, 4)), 10)
    query_blocks = packed(spark, rng.integers(-9, 9, (25, 4)), 5, 1000)
    dealt = topk._dealt(row_blocks, query_blocks, (3, 2)).withColumn("task", F.spark_partition_id()).collect()
    assert len(dealt) == 7 * 2 + 5 * 3  # and not 7 x 5
    met = []
    for cell in {r.cell for r in dealt}:
        here = [r for r in dealt if r.cell == cell]
        assert len({r.task for r in here}) == 1
        asked = [r.q_classes for r in here if r.q_classes is not None]
        assert [r.q_classes for r in here[: len(asked)]] == asked  # queries come first
        met += [(bytes(r.classes), bytes(q)) for r in here[len(asked) :] for q in asked]
    assert len(met) == len(set(met)) == 7 * 5


@pytest.mark.parametrize("scale, add", [(1, 0), (1 << 14, 1), (1 << 40, 1)])  # float32, float64 and Python's integers
@pytest.mark.parametrize("dense", [0, 16, 1 << 30])
def test_a_cell_sends_k_entries_of_a_query(monkeypatch, scale, add, dense):
    """However many blocks of rows a query meets in a task, its k best are all that is sorted later."""
    monkeypatch.setattr(topk, "DENSE", dense)
    monkeypatch.setattr(topk, "STRIP", 3)
    rng = np.random.default_rng(5)
    rows, queries = rng.integers(-50, 50, (400, 8)) * scale + add, rng.integers(-50, 50, (8, 8)) * scale - add
    whole = topk._longs(queries.astype(object) @ rows.T.astype(object))
    best = {(i, j, whole[i, j]) for i in range(8) for j in np.lexsort((np.arange(400), -whole[i]))[:11].tolist()}

    def stream(cutoffs):
        none = dict.fromkeys(("classes", "matrix", "q_classes", "q_matrix", "cutoff"))
        out = []
        for i in (slice(0, 4), slice(4, 8)):
            asked = {"q_classes": np.arange(8)[i].tobytes(), "q_matrix": queries[i].tobytes()}
            out.append({"cell": 0, "dim": 8} | none | asked | {"cutoff": cutoffs[i].tobytes()})
        for a in range(0, 400, 40):
            block = {"classes": np.arange(a, a + 40).tobytes(), "matrix": rows[a : a + 40].tobytes()}
            out.append({"cell": 0, "dim": 8} | none | block)
        return [pd.DataFrame(out[:5]), pd.DataFrame(out[5:])]

    def entries(found):
        return [tuple(r) for f in found for r in f.itertuples(index=False)]

    nothing = np.full(8, topk.NO_CUTOFF)
    lists = entries(topk._local_lists(11)(stream(nothing)))
    assert len(lists) == 8 * 11
    assert all(whole[q, c] == s for q, c, s in lists)
    low = np.array([min(s for q, _, s in lists if q == i) for i in range(8)])
    for cutoffs in (nothing, low, np.sort(whole, axis=1)[:, -11]):
        found = entries(topk._sufficient(11)(stream(cutoffs)))
        assert len(found) == 8 * 11
        assert set(found) == best


def test_blocks_are_bounded_and_narrow(spark, monkeypatch):
    monkeypatch.setattr(topk, "BLOCK_COMPONENTS", 64)
    vectors = [[i] * 32 for i in range(5)] + [[1 << 20, -i] for i in range(9)] + [[], []] + [[1 << 40] * 32]
    blocks = packed(spark, vectors, 4).collect()
    assert sorted((b.dim, len(b.classes) // 8, len(b.matrix)) for b in blocks) == [
        (0, 2, 0), (2, 1, 8), (2, 4, 32), (2, 4, 32), (32, 2, 128), (32, 2, 128), (32, 2, 512),
    ]
    found = {}
    for b in blocks:
        ids, block = topk._unpack(b.classes, b.matrix, b.dim)
        found |= dict(zip(ids.tolist(), block.matrix.tolist()))
    assert found == dict(enumerate(vectors))


def test_a_task_holds_bounded_queries(spark):
    classes = spark.range(1000)
    assert topk._grid(classes, 10, 10 * 100, 24) == (24, 1)
    lines, columns = topk._grid(classes, 10, 5 * topk.CELL_NUMBERS, 24)
    assert columns == 5 and lines == 4


def test_no_rows(spark):
    assert run(spark.createDataFrame([], "vec_id long, embedding array<float>")) == []
