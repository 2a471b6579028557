"""Queries that SQL can express, against it: rows, names and types."""

import __spark_entry__ as entry
import pytest
from checks.compare import connect, difference
from cohortloom.llm.sql import SQL


def test_every_sql_is_of_a_query():
    assert set(SQL) <= set(entry.queries())


@pytest.mark.parametrize("name", ["op11_merkle_manifest", "op12_prefix_trie", "op13_stream_dedup"])
def test_rows_equal_those_of_the_sql(spark, root, name):
    assert difference(spark, connect(root), entry.queries()[name], SQL[name], root) is None
