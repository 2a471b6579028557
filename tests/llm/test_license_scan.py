"""License scan against brute force."""

import re
import time

from cohortloom.llm.license_scan import BASE, scan_licenses
from cohortloom.llm.queries import QUERIES

UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(rows):
    out = []
    for i, text in rows:
        words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(UPPER))
        places, labels = [], set()
        for phrase, label in BASE.items():
            parts = phrase.split()
            for k in range(len(words) - len(parts) + 1):
                if words[k : k + len(parts)] == parts:
                    places.append(k)
                    labels.add(label)
        out.append((i, len(words), len(places), min(places, default=None), max(places, default=None), ",".join(sorted(labels))))
    return sorted(out, key=repr)


def got(df):
    rows = df.collect()
    for r in rows:
        assert 0 <= r.score <= 1 and set(filter(None, r.base_labels.split(","))) <= set(r.labels.split(","))
    return sorted((tuple(r)[:6] for r in rows), key=repr)


def test_query_equals_brute_force(spark, root, documents):
    assert got(QUERIES["op5_license_scan"](spark, root)) == brute([(r.doc_id, r.text) for r in documents.collect()])


def test_odd_rows(odd):
    assert got(scan_licenses(odd)) == brute([(r.doc_id, r.text) for r in odd.collect()])


def test_labels_of_changed_templates(spark):
    texts = [
        "licensed under the apache software license version 2 0",  # a word put in
        "licensed under the gnu general public version 3",  # a word left out
        "apache license version 3 or the mit license",  # too little of either
        "cc by nc cc by nc under the mit license apache license version 2",
        "Apache\x00License, VERSION-2",
    ]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = {r.doc_id: r for r in scan_licenses(df).collect()}
    assert [rows[i].labels for i in range(5)] == ["apache-2", "gpl-3", "", "apache-2,cc-by-nc,mit", "apache-2"]
    assert [rows[i].n_base for i in range(5)] == [0, 0, 0, 4, 1]
    assert rows[3].first_word == 0 and rows[3].last_word == 10 and rows[3].score == 1.0


def test_work_grows_with_the_length_of_a_text(spark):
    words = [f"w{i % 1000}" for i in range(320_000)]
    words[7:11], words[-4:] = "under the mit license".split(), "apache license version 2".split()
    docs = spark.createDataFrame([(1, " ".join(words))], "doc_id long, text string")
    began = time.monotonic()
    (row,) = scan_licenses(docs).collect()
    assert time.monotonic() - began < 60
    assert (row.n_words, row.n_base, row.first_word, row.last_word) == (320_000, 2, 7, 320_000 - 4)


def test_only_builtin_functions(spark, root):
    plan = QUERIES["op5_license_scan"](spark, root)._jdf.queryExecution().executedPlan().toString()
    assert not any(x in plan for x in ("Python", "Pandas", "Arrow"))


def test_no_rows(nothing):
    assert scan_licenses(nothing).count() == 0
