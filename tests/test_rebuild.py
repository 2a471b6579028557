"""Runs into the same folder: what is built again, and that it equals a full build."""

import logging
import os

import pytest

from helpers import day, rows
from pyspark.sql import functions as F

from cohortloom.model import AT_LEAST, DISEASE, DRUG, CohortDefinition, Criterion, Rule
from cohortloom.operators.concepts import concept_items, resolve_concept_sets, source_codes
from cohortloom.operators.events import CONDITION, DRUG_SOURCE
from cohortloom.plans.cohorts import Codes
from cohortloom.plans.study import StudyParameters, run_study
from cohortloom.schemas import RATES_YEAR
from cohortloom.session import local_frame
from cohortloom.sources import store
from cohortloom.sources.digest import group_digests, table_digests

PAIRS = [(1, 10), (2, 10)]


def definitions(exit_days=1):
    return [
        CohortDefinition(1, "one", DISEASE, (Criterion(CONDITION, 1),), prior_days=0, exit_days=exit_days),
        CohortDefinition(2, "two", DISEASE, (Criterion(CONDITION, 2),), prior_days=0),
        CohortDefinition(
            10, "drug", DRUG, (Criterion(DRUG_SOURCE, 10),), (Rule(CONDITION, 1, AT_LEAST, 1, days_after=0),), prior_days=0
        ),
    ]


def source(more_drugs=(), people=(1, 2, 3)):
    def ill(p, concept, start):
        return {"person_id": p, "condition_concept_id": concept, "condition_start_date": day(start)}

    def drug(p, start, code="a"):
        return {"person_id": p, "drug_source_value": code, "drug_exposure_start_date": day(start)}

    return {
        "person": [{"person_id": p, "gender_concept_id": 8507, "year_of_birth": 1970} for p in people],
        "observation_period": [
            {"person_id": p, "observation_period_start_date": day("2010-01-01"),
             "observation_period_end_date": day("2020-12-31")}
            for p in people
        ],
        "concept": [{"concept_id": c} for c in (100, 200, 201)],
        "condition_occurrence": [
            ill(1, 100, "2012-05-05"), ill(2, 100, "2013-05-05"), ill(2, 200, "2013-06-05"), ill(3, 201, "2014-01-01"),
        ],
        "drug_exposure": [drug(1, "2013-03-03"), drug(3, "2013-03-03"), *[drug(*d) for d in more_drugs]],
    }


def codes(spark, tables, second=(200,)):
    items = concept_items(spark, 1, [100]).unionByName(concept_items(spark, 2, list(second)))
    return Codes(
        resolve_concept_sets(tables["concept"], tables["concept_ancestor"], items), source_codes(spark, 10, ["a"])
    )


@pytest.fixture
def run(spark, make_tables, caplog):
    """Runs a study and says which parts it made."""
    caplog.set_level(logging.INFO, "cohortloom.plans.study")

    def go(path, data=None, defined=None, second=(200,), **parameters):
        caplog.clear()
        tables = make_tables(**(data or source()))
        parameters = StudyParameters(database="site", year_start="2010-01-01", rule_impact=True, **parameters)
        paths = run_study(
            spark, tables, codes(spark, tables, second), defined or definitions(), PAIRS, str(path), parameters
        )
        made = {r.args[0]: sorted(r.args[1]) for r in caplog.records if r.name == "cohortloom.plans.study"}
        return paths, made

    return go


RESULTS = ("by_year", "by_month", "dataset_counts")
STORED = ("cohort", "prepared", "population", "inclusion_result", "inclusion_stats", "summary_stats")


def everything(spark, paths):
    found = {}
    for name in STORED:
        df = spark.read.parquet(paths[name])
        found[name] = rows(df, *sorted(df.columns))
    for name in ("cohort_counts", *(RESULTS if os.path.exists(paths["by_year"]) else ())):
        found[name] = rows(spark.read.option("header", True).csv(paths[name]))
    return found


def test_a_run_without_changes_builds_nothing(spark, run, tmp_path):
    paths, made = run(tmp_path)
    assert made["cohort"] == made["qualified"] == made["prepared"] == [1, 2, 10] and made["impact"] == [10]
    before = everything(spark, paths)
    paths, made = run(tmp_path)
    assert made == {} and everything(spark, paths) == before


@pytest.mark.parametrize(
    "change, cohorts",
    [
        ({"defined": definitions(exit_days=5)}, [1]),
        ({"second": (201,)}, [2]),
        ({"data": source(more_drugs=[(1, "2013-03-03")])}, [10]),  # a row given twice
        ({"data": source(people=(1, 2, 3, 4))}, [1, 2, 10]),
        ({"defined": [definitions()[0], *definitions()[2:]]}, []),  # a cohort is no longer there
    ],
)
def test_only_changed_cohorts_are_built_and_equal_a_full_build(spark, run, tmp_path, change, cohorts):
    change = {**change, "run_prevalence": False}
    run(tmp_path / "a", run_prevalence=False)
    paths, made = run(tmp_path / "a", **change)
    assert made["cohort"] == made["qualified"] == cohorts
    assert made.get("impact", []) == [i for i in cohorts if i == 10]
    fresh, _ = run(tmp_path / "b", **change)
    assert everything(spark, paths) == everything(spark, fresh)


def test_one_changed_row_makes_results_anew(spark, run, tmp_path):
    paths, _ = run(tmp_path)
    before = store.read_csv(spark, paths["by_year"], RATES_YEAR)
    assert rows(before.where("analysis = 'Prevalence of Drug' AND calDate = 2015 AND Counts > 0")) == []
    paths, _ = run(tmp_path, data=source(more_drugs=[(2, "2015-01-01")]))
    after = store.read_csv(spark, paths["by_year"], RATES_YEAR)
    assert [r.Counts for r in after.where("analysis = 'Prevalence of Drug' AND calDate = 2015 AND Counts > 0").collect()] == [1]


def test_data_taken_as_they_were_are_not_read(spark, run, tmp_path):
    run(tmp_path, run_prevalence=False)
    more = source(more_drugs=[(2, "2015-01-01")])
    _, made = run(tmp_path, data=more, compare_data=False, run_prevalence=False)
    assert made == {}
    _, made = run(tmp_path, data=more, run_prevalence=False)
    assert made["cohort"] == [10]


def test_a_part_that_was_cut_short_is_made_again(spark, run, tmp_path, monkeypatch):
    from cohortloom.plans import study

    real = store.replace_slices

    def lost(df, path, *arguments):
        found = real(df, path, *arguments)
        if path.endswith("/cohort"):
            raise RuntimeError("lost")
        return found

    run(tmp_path, run_prevalence=False)
    monkeypatch.setattr(study.store, "replace_slices", lost)
    with pytest.raises(RuntimeError):
        run(tmp_path, defined=definitions(exit_days=5), run_prevalence=False)
    monkeypatch.setattr(study.store, "replace_slices", real)
    paths, made = run(tmp_path, run_prevalence=False)
    assert made["cohort"] == [1]
    fresh, _ = run(tmp_path / "fresh", run_prevalence=False)
    assert rows(store.read_cohorts(spark, paths["cohort"])) == rows(store.read_cohorts(spark, fresh["cohort"]))


def test_digests_tell_rows_apart(spark):
    schema = "a int, b string"

    def digest(*listed):
        return table_digests({"t": local_frame(spark, listed, schema)})["t"]

    one = digest((1, "x"), (2, None))
    assert one == digest((2, None), (1, "x"))
    others = [
        digest(), digest((1, "x")), digest((1, "x"), (2, None), (2, None)), digest((1, "x"), (1, "x"), (2, None)),
        digest((None, "x"), (2, None)), digest((1, "y"), (2, None)), digest((1, None), (2, "x")),
    ]
    assert len({one, *others}) == len(others) + 1
    renamed = local_frame(spark, [(1, "x"), (2, None)], schema).withColumnRenamed("b", "c")
    assert table_digests({"t": renamed})["t"] != one
    assert table_digests({}) == {}


def test_digests_of_groups(spark):
    first = local_frame(spark, [(1, "x"), (1, "y"), (2, "x")], "k int, v string")
    second = local_frame(spark, [(2, "x"), (1, "y"), (1, "z")], "k int, v string")
    a, b = group_digests(first, "k"), group_digests(second, "k")
    assert a[2] == b[2] and a[1] != b[1]


def test_each_table_is_read_once_for_its_digest(spark):
    """Adaptive execution runs the one shuffle of each table as a job, and one that ends them all."""
    tables = {f"t{i}": spark.range(10).withColumn("x", F.lit(i)) for i in range(4)}
    context = spark.sparkContext
    context.setJobGroup("digests", "counted")
    try:
        table_digests(tables)
        assert len(context.statusTracker().getJobIdsForGroup("digests")) <= len(tables) + 1
    finally:
        context.setLocalProperty("spark.jobGroup.id", None)
