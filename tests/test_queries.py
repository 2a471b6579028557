"""Registered queries against their SQL, and the shape of their plans."""

import os
import re
from dataclasses import replace

import pytest

import __spark_entry__ as entry
from checks.compare import connect, difference
from cohortloom.operators import population as pop
from cohortloom.plans import retail_study as study
from cohortloom.plans.cohorts import build_cohorts
from cohortloom.schemas import SOURCE_TABLES
from cohortloom.sources.retail import retail_tables
from cohortloom.sources.tables import read_parquet_tables

ROOT = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(ROOT), reason="needs the generated tables")

COMPARED = [
    "codesets_union", "definition_concept_sets", "source_code_events", "multi_domain_events", "inclusion_mask",
    "first_exit", "era_collapse_padded", "cohort_all", "cohort_first_of_several_domains", "cohort_demographics",
    "population_by_month_narrow", "dataset_counts", "rates_combined_month", "masked_margins_year", "dose_summary",
    "diagnosis_profile", "best_events", "inclusion_stats", "rates_view_year", "available_choices",
    "cohort_from_definitions", "rates_sparse_pairs", "rates_floor_year", "dose_summary_per_person",
    "diagnosis_profile_in_drug",
]


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_every_query_has_its_sql():
    assert set(entry.QUERIES) == set(entry.SQL)
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", COMPARED)
def test_rows_equal_those_of_the_sql(spark, name):
    assert difference(spark, connect(ROOT), entry.queries()[name], entry.oracle_sql()[name], ROOT) is None


def test_entry_has_rows(spark):
    assert entry.entry(spark).count() > 0


@pytest.mark.parametrize("name", ["cohort_all", "rates_margins_month", "dose_summary", "inclusion_stats"])
def test_no_pairs_and_no_python_in_plans(spark, name):
    plan = plan_of(entry.queries()[name](spark, ROOT))
    for unwanted in ("CartesianProduct", "NestedLoopJoin", "EvalPython", "InPandas", "MapInArrow"):
        assert unwanted not in plan


@pytest.fixture
def shuffled_joins(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def ancestors(plan: str, marker: str) -> list[str]:
    """The operators above the first line with ``marker``, outermost first."""
    lines = plan.splitlines()
    at = next(i for i, line in enumerate(lines) if marker in line)

    def depth(line):
        return re.search(r"[A-Za-z*]", line).start()

    found, limit = [], depth(lines[at])
    for line in reversed(lines[:at]):
        if depth(line) < limit:
            limit = depth(line)
            found.append(line.strip(" :+-"))
    return found[::-1]


def test_one_shuffle_by_person_carries_rules_exits_and_eras(spark, shuffled_joins):
    tables = retail_tables(spark, ROOT)
    plan = plan_of(build_cohorts(tables, study.codes(spark, tables), study.DEFINITIONS))
    joined = next(line for line in plan.splitlines() if "SortMergeJoin [person_id" in line)
    above = ancestors(plan, joined.strip(" :+-"))
    assert not [line for line in above if line.startswith("Exchange")]
    assert len([line for line in above if line.startswith("Window")]) == 3
    assert len([line for line in above if line.startswith("Sort ")]) == 2


def test_codes_are_broadcast_and_only_needed_columns_are_read(spark, shuffled_joins):
    tables = retail_tables(spark, ROOT)
    few = replace(study.codes(spark, tables), small=True)
    plan = plan_of(build_cohorts(tables, few, study.DISEASES))
    assert "BroadcastHashJoin [condition_concept_id" in plan
    (read,) = {
        schema for schema in re.findall(r"ReadSchema: struct<([^>]*)>", plan) if "l_orderkey" in schema
    }
    assert {c.split(":")[0] for c in read.split(",")} == {"l_orderkey", "l_linenumber", "l_partkey"}


def test_study_years_reach_the_scan_of_periods(spark, make_tables, tmp_path):
    for name in SOURCE_TABLES:
        make_tables()[name].write.parquet(str(tmp_path / name))
    tables = read_parquet_tables(spark, str(tmp_path))
    plan = plan_of(pop.observed_population(tables["person"], tables["observation_period"], 2012, 2021))
    pushed = " ".join(re.findall(r"PushedFilters: \[[^\]]*\]", plan))
    assert "LessThanOrEqual(observation_period_start_date,2021-12-31)" in pushed
    assert "GreaterThanOrEqual(observation_period_end_date,2012-01-01)" in pushed
    assert "IsNotNull(year_of_birth)" in pushed


def test_subjects_are_shuffled_once_for_all_rates(spark, shuffled_joins):
    plan = plan_of(entry.queries()["rates_combined_year"](spark, ROOT))
    above = ancestors(plan, "SortMergeJoin [subject_id")
    shuffles = [line for line in above if line.startswith("Exchange")]
    assert not [line for line in shuffles if "subject_id" in line]


def test_no_job_runs_while_a_query_is_built(spark):
    """Queries of the text package, which write scratch tables, are not among these."""
    context = spark.sparkContext
    context.setJobGroup("building", "plans only")
    try:
        for name, query in entry.QUERIES.items():
            if name != "cohort_from_definitions":  # it reads the settings of its documents
                query(spark, ROOT)
        assert list(context.statusTracker().getJobIdsForGroup("building")) == []
    finally:
        context.setLocalProperty("spark.jobGroup.id", None)


def test_periods_are_shuffled_once_before_the_join_with_persons(spark, make_tables, shuffled_joins, tmp_path):
    for name in ("person", "observation_period"):
        make_tables()[name].write.parquet(str(tmp_path / name))
    tables = read_parquet_tables(spark, str(tmp_path), ("person", "observation_period"))
    plan = plan_of(pop.observed_population(tables["person"], tables["observation_period"], 2012, 2021))
    assert plan.count("Exchange hashpartitioning(person_id") == 2  # periods, and persons


@pytest.mark.parametrize("name", ["inclusion_result", "inclusion_stats", "attrition_summary"])
def test_rule_queries_build_their_events_once(spark, monkeypatch, name):
    from cohortloom.plans import retail_queries

    built = []
    real = retail_queries.qualified_events
    monkeypatch.setattr(retail_queries, "qualified_events", lambda *a: built.append(1) or real(*a))
    entry.queries()[name](spark, ROOT)
    assert len(built) == 1
