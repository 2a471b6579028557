"""Queries over stored studies against their SQL."""

import os

import pytest

import __spark_entry__ as entry
from checks.compare import connect, difference
from helpers import rows

from cohortloom.plans.stored_queries import brand_study_cohorts, write_brand_study
from cohortloom.session import shared_folder
from cohortloom.sources.definitions import read_definitions, write_definitions
from cohortloom.sources.settings import read_pairs, read_registry

ROOT = "/root/testdata/sf0.001"
needs_tables = pytest.mark.skipif(not os.path.isdir(ROOT), reason="needs the generated tables")

COMPARED = [
    "inline_code_events", "stored_cohorts_replaced", "stored_cohort_by_id", "stored_study_resumed",
    "stored_rule_impact", "stored_file_study", "stored_registry_pairs", "stored_display_month",
]


def test_every_stored_query_has_its_sql():
    assert set(entry.STORED_QUERIES) == set(entry.STORED_SQL)
    assert not set(entry.STORED_QUERIES) & set(entry.QUERIES)


@needs_tables
@pytest.mark.parametrize("name", COMPARED)
def test_rows_equal_those_of_the_sql(spark, name):
    assert difference(spark, connect(ROOT), entry.queries()[name], entry.oracle_sql()[name], ROOT) is None


def test_settings_of_nineteen_cohorts_and_their_pairs(spark):
    files = write_brand_study(spark, shared_folder(spark, "files"))
    registry = read_registry(spark, files[0])
    assert rows(registry, "cohortId", "name", "cohortType") == sorted((i, n, k) for i, n, k, _ in brand_study_cohorts())
    assert read_pairs(spark, files[1]).distinct().count() == 84
    assert read_definitions(spark, files[2]).count() == 19


def test_documents_keep_their_names_and_text(spark):
    folder = shared_folder(spark, "documents")
    text = '{"ConceptSets": [],\n "QualifiedLimit": {"Type": "First"}}'
    documents = [("12", text), ("a/b c+d%", text), ("é", text)]
    write_definitions(spark.createDataFrame(documents, "name string, text string"), folder)
    found = read_definitions(spark, folder)
    assert rows(found, "name", "QualifiedLimit.Type") == [("12", "First"), ("a/b c+d%", "First"), ("é", "First")]


def test_a_cluster_must_name_its_shared_folder(spark):
    class Context:
        master = "spark://host:7077"

    class Session:
        conf = {"spark.checkpoint.dir": None}
        sparkContext = Context()

    with pytest.raises(ValueError, match="checkpoint"):
        shared_folder(Session(), "x")
