"""Tables in buckets: rows as without, and plans without an exchange by subject."""

import pytest

from helpers import day, rows

from cohortloom.operators import population as pop, rates
from cohortloom.plans.study import StudyParameters, StudyPaths, run_study, stored_table
from cohortloom.schemas import COHORT, RATES_YEAR
from cohortloom.session import local_frame
from cohortloom.sources import store
from cohortloom.sources.buckets import BucketedTable
from test_rebuild import PAIRS, codes, definitions, source


def cohort(spark, *listed):
    return local_frame(spark, [(c, s, day("2012-01-01"), day("2012-01-02")) for c, s in listed], COHORT)


def test_slices_are_replaced_and_emptied(spark, tmp_path):
    path = str(tmp_path / "cohort")
    table = BucketedTable(spark, path, COHORT, "subject_id", 3, ("cohort_definition_id",))
    table.create()
    assert rows(table.read()) == []
    columns = ("cohort_definition_id", "subject_id")
    table.replace(cohort(spark, (1, 5), (1, 6), (2, 6), (3, 7)), [(1,), (2,), (3,)])
    assert rows(table.read(), *columns) == [(1, 5), (1, 6), (2, 6), (3, 7)]
    table.replace(cohort(spark, (1, 8), (1, 9), (3, 99)), [(1,), (2,)])
    assert rows(table.read(), *columns) == [(1, 8), (1, 9), (3, 7)]
    # The files are Parquet like others, and another session can enter the table again.
    assert rows(store.read_cohorts(spark, path), *columns) == [(1, 8), (1, 9), (3, 7)]
    spark.sql(f"DROP TABLE {table.name}")
    assert rows(table.read(), *columns) == [(1, 8), (1, 9), (3, 7)]
    table.create()
    assert rows(table.read()) == []


def test_a_table_without_slices(spark, tmp_path):
    table = BucketedTable(spark, str(tmp_path / "t"), COHORT, "subject_id", 3)
    table.create()
    assert rows(table.read()) == []
    for listed in ([(1, 5), (2, 6)], [(3, 7)], []):
        table.replace(cohort(spark, *listed))
        assert rows(table.read(), "cohort_definition_id", "subject_id") == listed


@pytest.fixture
def shuffled_joins(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def exchanges(df):
    plan = df._jdf.queryExecution().executedPlan().toString()
    return [line for line in plan.splitlines() if "Exchange hashpartitioning(subject_id" in line]


def test_a_study_in_buckets(spark, make_tables, tmp_path, shuffled_joins):
    tables = make_tables(**source())
    plain, bucketed = (
        run_study(
            spark, tables, codes(spark, tables), definitions(), PAIRS, str(tmp_path / name),
            StudyParameters(database="site", year_start="2010-01-01", buckets=buckets),
        )
        for name, buckets in (("plain", 0), ("bucketed", 4))
    )
    for name in ("by_year",):
        one, two = (store.read_csv(spark, paths[name], RATES_YEAR) for paths in (plain, bucketed))
        assert rows(one) == rows(two)

    def stored(paths, name, buckets):
        return stored_table(spark, StudyPaths(paths.output), name, buckets)

    for paths, buckets, several in ((plain, 0, True), (bucketed, 4, False)):
        joined = pop.attach_demographics(stored(paths, "cohort", buckets), stored(paths, "population", buckets))
        profiles = rates.stratum_profiles(stored(paths, "prepared", buckets), [1, 2, 10], rates.YEAR)
        assert bool(exchanges(joined)) == several and bool(exchanges(profiles.counted)) == several
        assert joined.count() == 4  # two ill of the first kind, one of the second, one on the drug

    again = run_study(
        spark, tables, codes(spark, tables), definitions(exit_days=5), PAIRS, str(tmp_path / "bucketed"),
        StudyParameters(database="site", year_start="2010-01-01", buckets=4, run_prevalence=False),
    )
    ends = stored(again, "cohort", 4).where("cohort_definition_id = 1")
    assert rows(ends, "subject_id", "cohort_end_date") == [(1, day("2012-05-10")), (2, day("2013-05-10"))]
