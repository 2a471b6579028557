"""Events placed inside observation periods, and the entry conditions on them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from cohortloom.operators.events import DEATH
from cohortloom.session import parts_for


# Behind the join with periods a day is a row for each question of each cohort it enters, so days are dealt into as many
# partitions for each that the session has for shuffles, and more where tables are large: one for so many bytes read.
SPREAD = 4
BYTES_READ = 8 << 20


def person_parts(days: DataFrame, observation_period: DataFrame) -> int:
    """How many partitions event days and periods are dealt into: a task sorts as much however large the tables are."""
    return parts_for(BYTES_READ, days, observation_period, least=SPREAD)


def by_person(df: DataFrame, parts: int) -> DataFrame:
    """Rows dealt by person, into partitions whose number is set.

    Adaptive execution would merge them by what the shuffle wrote, which is a small part of what tasks then sort.
    """
    return df.repartition(parts, "person_id")


def observation_spans(observation_period: DataFrame, parts: int) -> DataFrame:
    """One row per person with their observation periods in order, as one array.

    Equal periods are one, with their number in ``copies``. Periods are shuffled once, by person, as the join
    with events needs it.
    """
    distinct = by_person(observation_period, parts).groupBy(
        "person_id",
        F.col("observation_period_start_date").alias("op_start_date"),
        F.col("observation_period_end_date").alias("op_end_date"),
    ).agg(F.count(F.lit(1)).alias("copies"))
    return distinct.groupBy("person_id").agg(
        F.sort_array(F.collect_list(F.struct("op_start_date", "op_end_date", "copies"))).alias("periods")
    )


def place_in_periods(days: DataFrame, spans: DataFrame, parts: int) -> DataFrame:
    """Each event day once for every observation period of the person that covers it.

    Periods are looked through where the person's array meets the day, so that a person of many
    periods has no more rows than days that are covered. ``day_key`` orders the days of a period, with deaths after
    other events of their day; it grows by two from day to day.
    """
    start = F.col("start_date")
    covering = F.filter("periods", lambda p: start.between(p["op_start_date"], p["op_end_date"]))
    placed = by_person(days, parts).join(spans, "person_id").select(*days.columns, F.inline(covering))
    return placed.withColumn(
        "day_key", F.unix_date("start_date").cast("bigint") * 2 + (F.col("domain") == DEATH).cast("int")
    )


def has_look_back() -> Column:
    """Whether an event day has enough observed time before and after it in its period.

    That is ``prior_days`` and ``post_days``, columns beside it.
    """
    return (F.date_add("op_start_date", F.col("prior_days")) <= F.col("start_date")) & (
        F.date_add("start_date", F.col("post_days")) <= F.col("op_end_date")
    )


def keep_first(qualified: DataFrame) -> DataFrame:
    """Only the earliest event per person in cohorts that ask for it."""
    order = Window.partitionBy("cohort_id", "person_id").orderBy("start_date", "op_start_date", "op_end_date")
    return (
        qualified.withColumn("event_order", F.row_number().over(order))
        .where(~F.col("first_only") | (F.col("event_order") == 1))
        .withColumn("n_events", F.when(F.col("first_only"), F.lit(1)).otherwise(F.col("n_events")).cast("bigint"))
        .drop("event_order")
    )
