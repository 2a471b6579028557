"""Substring dedup against brute force."""

import hashlib

import pytest
from cohortloom.llm.queries import QUERIES
from cohortloom.llm.substring_dedup import remove_repeats, split_words


def brute(rows, window):
    texts = sorted(((i, t) for i, t in rows), key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or ""))
    seen, out = set(), []
    for i, text in texts:
        words = split_words(text)
        gone = [False] * len(words)
        for k in range(len(words) - window + 1):
            key = tuple(words[k : k + window])
            if key in seen:
                gone[k : k + window] = [True] * window
            seen.add(key)
        kept = [w for w, g in zip(words, gone) if not g]
        out.append((i, len(words), sum(gone), hashlib.sha256(b" ".join(kept)).hexdigest()))
    return sorted(out, key=repr)


def got(df, *columns):
    return sorted((tuple(r)[:4] for r in df.collect()), key=repr)


def test_query_equals_brute_force(spark, root, documents):
    rows = [(r.doc_id, r.text) for r in documents.collect()]
    assert got(QUERIES["op4_substring_dedup"](spark, root)) == brute(rows, 20)


@pytest.mark.parametrize("window", [3, 20])
def test_odd_rows(odd, window):
    rows = [(r.doc_id, r.text) for r in odd.collect()]
    result = remove_repeats(odd, window=window)
    assert got(result) == brute(rows, window)
    for r in result.collect():
        assert sum(x.end - x.start for x in r.intervals) == r.n_removed
        assert hashlib.sha256(r.kept.encode()).hexdigest() == r.kept_sha256


def test_repeats_within_a_text(spark):
    text = "a b c a b c a b c d a b c d"
    df = spark.createDataFrame([(1, text)], "doc_id long, text string")
    assert got(remove_repeats(df, window=4)) == brute([(1, text)], 4)


def test_no_rows(nothing):
    assert remove_repeats(nothing).count() == 0
