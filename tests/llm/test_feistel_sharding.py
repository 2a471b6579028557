"""Sharding: the permutation, its inverse, and the law of even row counts."""

import zlib
from collections import Counter

import numpy as np
import pytest
from cohortloom.llm import feistel_sharding as fs
from cohortloom.llm.queries import QUERIES


@pytest.mark.parametrize("n", [1, 2, 3, 16, 17, 1000, 4097])
def test_permutation_and_inverse(n):
    there = fs.permuted(np.arange(n), n, 7)
    assert sorted(there.tolist()) == list(range(n))
    assert fs.restored(there, n, 7).tolist() == list(range(n))
    if n > 100:
        assert there.tolist() != fs.permuted(np.arange(n), n, 8).tolist()
        assert abs(np.corrcoef(there, np.arange(n))[0, 1]) < 0.2


def lawful(rows, shards):
    counts = Counter(r.shard for r in rows)
    assert set(counts) <= set(range(shards))
    sizes = [counts[s] for s in range(shards)]
    assert max(sizes) - min(sizes) <= 1
    for s in range(shards):
        assert sorted(r.slot for r in rows if r.shard == s) == list(range(sizes[s]))


def test_query(spark, root, documents):
    rows = QUERIES["op7_sharding"](spark, root).collect()
    lawful(rows, 16)
    wanted = {r.doc_id: ((r.text or "").encode()) for r in documents.collect()}
    assert {r.doc_id: (r.size, r.text_crc32) for r in rows} == {
        i: (len(t) + 1, zlib.crc32(t)) for i, t in wanted.items()
    }
    ordered = sorted(rows, key=lambda r: r.number)
    assert [r.doc_id for r in ordered] == sorted(wanted)
    place = fs.permuted(np.arange(len(rows)), len(rows), 7)
    assert [(r.shard, r.slot) for r in ordered] == [(p % 16, p // 16) for p in place.tolist()]


def test_odd_rows(odd, nothing):
    rows = fs.shard_documents(odd, 3).collect()
    assert sorted(map(repr, (r.doc_id for r in rows))) == sorted(map(repr, (r.doc_id for r in odd.collect())))
    lawful(rows, 3)
    assert fs.shard_documents(nothing).count() == 0
