import hashlib
import re

import pytest
from pyspark.sql import functions as F

from cohortloom.llm import stream_dedup
from cohortloom.llm.common import scratch

SPACE = re.compile("[\x20\x09-\x0d]")


def expected(rows):
    """(doc_id, keep_id, group_size, kept, sha) of (doc_id, text) in file order."""
    classes = {}
    for n, (i, text) in enumerate(rows):
        classes.setdefault(SPACE.sub("", text or ""), []).append((-len(text or ""), i is None, i or 0, n, i))
    out = []
    for content, members in classes.items():
        best = min(members)
        sha = hashlib.sha256(content.encode()).hexdigest()
        out += [(m[4], best[4], len(members), m == best, sha) for m in members]
    return sorted(out, key=repr)


def result(df):
    return sorted(map(tuple, df.select("doc_id", "keep_id", "group_size", "kept", "text_sha256").collect()), key=repr)


@pytest.fixture
def stored(spark):
    def store(df, files=1):
        path = scratch(spark)
        df.repartition(files).write.parquet(path)
        return path

    return store


def test_odd_rows(spark, odd, stored):
    path = stored(odd.withColumnsRenamed({"chunk": "key", "words": "entry", "node": "content", "row_": "_metadata"}))
    rows = [(r.doc_id, r.text) for r in odd.collect()]
    got = result(stream_dedup.deduplicate(spark, path))
    # Of rows given twice either may be the first in its file, so their flags are compared as a multiset.
    assert got == expected(rows)


def test_no_rows(spark, nothing, stored):
    assert result(stream_dedup.deduplicate(spark, stored(nothing))) == []


def test_white_space_ties_and_code_points(spark, stored):
    rows = [
        (5, "a b"), (3, "ab"), (4, "a  b"), (2, "a b"), (9, "a\t\nb "), (8, "a b  "), (None, "ab   "), (None, None),
        (1, " "), (0, ""), (7, "é☃"), (6, "é ☃"), (10, "é ☃"),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = result(stream_dedup.deduplicate(spark, stored(docs)))
    assert got == expected(rows)
    assert {r[1] for r in got if r[0] == 3} == {8}


@pytest.mark.parametrize("digits", [0, 1])
def test_full_contents_part_rows_of_one_digest(spark, stored, digits):
    rows = [(i, f"text {i % 7}" + " " * (i % 3)) for i in range(60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert result(stream_dedup.deduplicate(spark, stored(docs), digits=digits)) == expected(rows)


def test_state_goes_on_over_batches_and_runs(spark, stored):
    path, state = scratch(spark), scratch(spark)
    schema = "doc_id long, text string"
    first = [(i, f"text {i % 10}") for i in range(40)]
    second = [(i, f"text  {i % 12}") for i in range(40, 80)]
    spark.createDataFrame(first, schema).repartition(4).write.parquet(path)
    # A byte a batch: one file each.
    assert result(stream_dedup.deduplicate(spark, path, state=state, batch_bytes=1)) == expected(first)
    commits = len(spark.read.text(f"{state}/commits").select(F.input_file_name()).distinct().collect())
    assert commits == 4
    spark.createDataFrame(second, schema).repartition(2).write.mode("append").parquet(path)
    assert result(stream_dedup.deduplicate(spark, path, state=state, batch_bytes=1)) == expected(first + second)
    commits = len(spark.read.text(f"{state}/commits").select(F.input_file_name()).distinct().collect())
    assert commits == 6


def test_whole_table_and_no_python_in_the_plan(spark, root, documents):
    got = stream_dedup.deduplicate(spark, f"{root}/documents.parquet")
    assert "Python" not in got._jdf.queryExecution().toString()
    rows = [(r.doc_id, r.text) for r in documents.select("doc_id", "text").collect()]
    assert result(got) == expected(rows)


def test_settings_are_put_back(spark, stored):
    name = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(name)
    stream_dedup.deduplicate(spark, stored(spark.createDataFrame([(1, "a")], "doc_id long, text string"))).collect()
    assert spark.conf.get(name) == before
