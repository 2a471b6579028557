"""The pipeline's stages, each judged on its own input."""

import corpus_pipeline
import pytest
from cohortloom.llm import decontamination, toxicity
from cohortloom.llm.common import normal_words, table, text_hash
from test_line_dedup import brute as brute_lines
from test_near_dedup import brute as brute_classes
from test_packing import brute as brute_pieces, lawful


@pytest.fixture(scope="module")
def states(spark, root, tmp_path_factory):
    docs, out = table(spark, root, "documents"), []
    for name, stage in corpus_pipeline.STAGES:
        path = str(tmp_path_factory.mktemp("stage") / "rows")
        stage(spark, docs, root).write.parquet(path)
        after = spark.read.parquet(path)
        out.append((name, docs, after))
        docs = after
    return out


def texts(df):
    return sorted(((r.doc_id, r.text) for r in df.collect()), key=repr)


def test_columns_and_order(states, documents):
    assert [s[0] for s in states] == ["toxicity", "line dedup", "near dedup", "decontamination", "packing"]
    for _, before, after in states[:-1]:
        assert after.columns == documents.columns and before.dtypes == after.dtypes


def test_toxic_documents_go(spark, root, states):
    _, before, after = states[0]
    model = toxicity.train(before, table(spark, root, "labels"))
    scores = model.scores([toxicity.term_ids(r.text) for r in before.orderBy("doc_id").collect()])
    kept = [r.doc_id for r, s in zip(before.orderBy("doc_id").collect(), scores) if s < 0.5]
    assert sorted(r.doc_id for r in after.collect()) == kept


def test_lines_go(states):
    _, before, after = states[1]
    assert texts(after) == brute_lines([(r.doc_id, r.text, r.source) for r in before.collect()], 10)
    assert all(r.n_chars == len(r.text) for r in after.collect())


def test_one_of_each_class_stays(states):
    _, before, after = states[2]
    classes = brute_classes([(r.doc_id, r.text) for r in before.collect()])
    assert sorted(r.doc_id for r in after.collect()) == sorted({c for _, c in classes})


def test_contaminated_documents_go(spark, root, states):
    _, before, after = states[3]
    items = [(r.item_id, decontamination.normal_words(r.text)) for r in table(spark, root, "benchmark").collect()]
    index = decontamination.ItemIndex(items)
    gone = {
        r.doc_id
        for r in before.collect()
        if (words := decontamination.normal_words(r.text)) and decontamination.places(index, [words], 0.8)
    }
    assert {r.doc_id for r in after.collect()} == {r.doc_id for r in before.collect()} - gone


def test_all_that_is_left_is_packed(states):
    _, before, after = states[4]
    rows = after.collect()
    assert sorted((tuple(r)[:5] for r in rows), key=repr) == brute_pieces([(r.doc_id, r.text) for r in before.collect()])
    lawful(rows, 1024)


def test_run_is_its_stages(spark, root, states):
    got = corpus_pipeline.run(spark, root)
    columns = ["doc_id", "piece", "ids_crc32"]
    assert sorted(map(tuple, got.select(columns).collect())) == sorted(map(tuple, states[-1][2].select(columns).collect()))


@pytest.mark.parametrize("which", ["odd", "nothing"])
def test_odd_rows_and_no_rows(spark, root, request, which, tmp_path):
    docs = request.getfixturevalue(which)
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, root).write.parquet(f"{tmp_path}/{k}")
        after = spark.read.parquet(f"{tmp_path}/{k}")
        if k < len(corpus_pipeline.STAGES) - 1:
            assert after.columns == docs.columns
        docs = after
    assert (docs.count() > 0) == (which == "odd")


def repeated_ids(odd):
    """The odd rows, and ids that stand on near copies, leaks and texts of their own, many times over."""
    base = [f"w{i}" for i in range(60)]
    near = [" ".join([*base[:k], "new", *base[k + 1 :]]) for k in (0, 1, 2)]
    rows = [(20, near[0]), (20, near[1]), (20, "a text that 20 alone has"), (20, near[0]), (21, near[2])]
    rows += [(21, "a text that 21 alone has"), (21, "a text that 21 alone has"), (None, near[0]), (None, None)]
    rows += [(30, f"unique text number {i} of one common id {i * i}") for i in range(30)] + [(30, near[1])]
    first = odd.first()
    more = [(i, t, "en", "z", k, *first[5:]) for k, (i, t) in enumerate(rows)]
    return odd.unionByName(odd.sparkSession.createDataFrame(more, odd.schema))


def test_each_row_is_judged_by_its_own_text_and_one_of_a_class_stays(spark, root, odd):
    docs = repeated_ids(odd)
    rows = docs.select("doc_id", "text", text_hash("text").alias("hash")).collect()
    # As if ids were unique: rows are numbered in order of id and hash, those of null id are in no class.
    rows = sorted(rows, key=lambda r: (r.doc_id is None, r.doc_id or 0, r.hash))
    classes = brute_classes([(None if r.doc_id is None else k, r.text) for k, r in enumerate(rows)])
    stay = {k for k, c in classes if k == c and k is not None}
    wanted = [(r.doc_id, r.text) for k, r in enumerate(rows) if r.doc_id is None or k in stay]
    after = corpus_pipeline.without_near_copies(spark, docs, root)
    got = [(i, t or "") for i, t in texts(after)]
    assert sorted(got, key=repr) == sorted(((i, t or "") for i, t in wanted), key=repr)
    assert after.columns == docs.columns and after.dtypes == docs.dtypes
    for row in [(6, "another text under the same id"), (20, "a text that 20 alone has")]:
        assert got.count(row) == 1
    assert sum(i == 30 for i, _ in got) == 30 and sum(i == 4 for i, _ in got) == 1


def test_a_leak_takes_no_other_text_of_its_id(spark, odd, tmp_path):
    docs = repeated_ids(odd)
    items = [(1, " ".join(f"w{i}" for i in range(60))), (2, "another text under the same id")]
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    after = texts(corpus_pipeline.without_benchmark(spark, docs, str(tmp_path)))
    index = decontamination.ItemIndex([(i, normal_words(t)) for i, t in items])

    def leaks(text):
        return bool((words := normal_words(text)) and decontamination.places(index, [words], 0.8))

    before = texts(docs)
    assert after == [(i, t) for i, t in before if not leaks(t)]
    gone = [i for i, t in before if leaks(t)]
    assert sorted(gone, key=repr) == [20, 20, 20, 21, 30, 6, None]
