"""Line dedup against exact counting."""

import __spark_entry__ as entry
import pytest
from checks.compare import connect, difference
from cohortloom.llm.line_dedup import remove_boilerplate


def brute(rows, min_sites):
    sites, first = {}, {}
    for i, text, site in rows:
        for line in {x.strip(" ") for x in (text or "").split("\n")} - {""}:
            sites.setdefault(line, set()).add(site or "")
            if i is not None:
                first[line] = min(first.get(line, i), i)
    out = []
    for i, text, _ in rows:
        if text is not None:
            keep = [
                x
                for x in text.split("\n")
                if x.strip(" ") == "" or len(sites[x.strip(" ")]) < min_sites or first.get(x.strip(" ")) == i
            ]
            text = "\n".join(keep)
        out.append((i, text))
    return sorted(out, key=repr)


@pytest.mark.parametrize("min_sites", [2, 3, 10])
def test_equals_exact_counts(documents, min_sites):
    rows = [(r.doc_id, r.text, r.source) for r in documents.collect()]
    got = remove_boilerplate(documents, min_sites=min_sites).select("doc_id", "text").collect()
    assert sorted((tuple(r) for r in got), key=repr) == brute(rows, min_sites)


def test_odd_rows_and_other_columns(odd):
    rows = [(r.doc_id, r.text, r.source) for r in odd.collect()]
    got = remove_boilerplate(odd, min_sites=2)
    assert got.columns == [*odd.columns, "n_removed_lines"]
    assert sorted(((r.doc_id, r.text) for r in got.collect()), key=repr) == brute(rows, 2)
    assert {(r.score, r.id_, r.row_, r.text_) for r in got.collect()} == {("s", "i", "r", "t")}


def test_a_column_of_the_name_of_the_count(spark, odd, tmp_path):
    clashing = odd.withColumnsRenamed({"words": "n_removed_lines", "node": "n_removed_lines_"})
    got = remove_boilerplate(clashing, min_sites=2)
    assert got.columns == [*clashing.columns, "n_removed_lines__"]
    assert {(r.n_removed_lines, r.n_removed_lines_) for r in got.collect()} == {("w", "o")}
    clashing.write.parquet(f"{tmp_path}/documents.parquet")
    rows = entry.queries()["op1_line_dedup"](spark, str(tmp_path)).collect()
    assert len(rows) == clashing.count() and all(isinstance(r.n_removed, int) for r in rows)


def test_many_sites_pass_by_their_sketch(spark):
    rows = [(i, f"common\nown {i}", f"site{i}") for i in range(300)] + [(1000, "common\nrare", "site0")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = {r.doc_id: r.text for r in remove_boilerplate(docs, min_sites=20).collect()}
    assert got[0] == "common\nown 0" and got[7] == "own 7" and got[1000] == "rare"


def test_no_rows(nothing):
    assert remove_boilerplate(nothing).count() == 0


def test_query_equals_its_sql(spark, root):
    assert difference(spark, connect(root), entry.queries()["op1_line_dedup"], entry.oracle_sql()["op1_line_dedup"], root) is None
