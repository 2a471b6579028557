"""Packing: every piece once, no gaps, near the least number of sequences."""

import random
import zlib
from collections import Counter

import numpy as np
import pytest
from cohortloom.llm import packing
from cohortloom.llm.queries import QUERIES
from cohortloom.llm.tokens import tokenizer_path


def lawful(rows, capacity):
    sequences = {}
    for r in rows:
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity
    return len(sequences)


def brute(rows, capacity=1024):
    from tokenizers import Tokenizer

    plain, out = Tokenizer.from_file(tokenizer_path("byte_bpe_50k.json")), []
    for i, text in rows:
        ids = [*plain.encode(text or "", add_special_tokens=False).ids, 2]
        first = len(ids) % capacity or capacity
        cuts = [0, *range(first, len(ids) + 1, capacity)]
        for k, (a, b) in enumerate(zip(cuts, cuts[1:])):
            out.append((i, k, a, b - a, zlib.crc32(np.array(ids[a:b], "<u4").tobytes())))
    return sorted(out, key=repr)


def test_query(spark, root, documents):
    rows = QUERIES["op9_packing"](spark, root).collect()
    assert sorted((tuple(r)[:5] for r in rows), key=repr) == brute([(r.doc_id, r.text) for r in documents.collect()])
    least = -(-sum(r.length for r in rows) // 1024)
    assert lawful(rows, 1024) <= 1.01 * least + 1


def test_odd_rows(odd, nothing):
    path = tokenizer_path("byte_bpe_50k.json")
    rows = packing.pack(odd, path).collect()
    assert sorted((tuple(r)[:5] for r in rows), key=repr) == brute([(r.doc_id, r.text) for r in odd.collect()])
    lawful(rows, 1024)
    assert packing.pack(nothing, path).count() == 0


@pytest.mark.parametrize("seed", range(12))
def test_plans(seed):
    rng = random.Random(seed)
    capacity = rng.choice([1, 7, 10, 64, 100])
    counts = Counter(rng.randint(1, capacity) for _ in range(rng.choice([1, 20, 500])))
    kinds = packing.plan(counts, capacity)
    packed = Counter()
    for contents, times in kinds:
        assert times > 0 and sum(n * k for n, k in contents) <= capacity
        for n, k in contents:
            packed[n] += k * times
    assert packed == counts
    # First-fit decreasing, one by one, for comparison.
    gaps = []
    for n in sorted(counts.elements(), reverse=True):
        fit = [k for k, g in enumerate(gaps) if g >= n]
        if fit:
            gaps[min(fit, key=gaps.__getitem__)] -= n
        else:
            gaps.append(capacity - n)
    assert sum(times for _, times in kinds) <= len(gaps) + 1
