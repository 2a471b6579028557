"""Patient-level tables derived from order data.

Every customer is a person, every order line an event: odd line numbers are
conditions dated by the order, even ones drug exposures dated by the shipment.
Lines 3 and 2 also appear as observations and procedures. Parts and brands are
the vocabulary, with brands as ancestors. Attributes that order data lacks (birth
date, gender, validity) follow from the keys by arithmetic. All rows of the
tables take part.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from cohortloom.functions.strata import FEMALE_CONCEPT, MALE_CONCEPT
from cohortloom.session import parts_for
from cohortloom.sources.tables import Tables

PART_BASE = 10_000
BRAND_BASE = 100
# Bytes of lines and orders for each partition of their join.
BYTES_JOINED = 32 << 20
SPLIT_DAY = dt.date(1998, 7, 1)
DEATH_LEAD_DAYS = 200

# Columns in use; declaring them spares a job that would read the file footers.
_COLUMNS = {
    "customer": "c_custkey bigint, c_acctbal double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderdate timestamp_ntz",
    "lineitem": (
        "l_orderkey bigint, l_linenumber int, l_partkey bigint, l_quantity double, "
        "l_returnflag string, l_shipdate timestamp_ntz"
    ),
    "part": "p_partkey bigint, p_brand string, p_size int",
}


def retail_tables(spark: SparkSession, root: str) -> Tables:
    def scan(name: str) -> DataFrame:
        return spark.read.schema(_COLUMNS[name]).parquet(f"{root}/{name}.parquet")

    customer, orders, lineitem, part = (scan(n) for n in ("customer", "orders", "lineitem", "part"))
    orders = orders.select(
        F.col("o_orderkey"), F.col("o_custkey"), F.col("o_orderdate").cast("date").alias("order_date")
    )
    lines = lineitem.select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_quantity", "l_returnflag",
        F.col("l_shipdate").cast("date").alias("ship_date"),
    )
    lines = _joined_evenly(lines, "l_orderkey", orders, "o_orderkey")
    return {
        "person": _person(customer),
        "observation_period": _observation_period(orders),
        "condition_occurrence": _conditions(lines),
        "drug_exposure": _drugs(lines),
        "observation": _observations(lines),
        "procedure_occurrence": _procedures(lines),
        "death": _death(customer, orders),
        "concept": _concept(part),
        "concept_ancestor": _concept_ancestor(part),
    }


def _joined_evenly(lines: DataFrame, key: str, orders: DataFrame, order_key: str) -> DataFrame:
    """Lines with their order. Where tables are too large for the session's partitions, both are dealt into more."""
    parts = parts_for(BYTES_JOINED, lines, orders)
    if parts > int(lines.sparkSession.conf.get("spark.sql.shuffle.partitions")):
        lines, orders = lines.repartition(parts, key), orders.repartition(parts, order_key)
    return lines.join(orders, F.col(key) == F.col(order_key))


def _person(customer: DataFrame) -> DataFrame:
    key = F.col("c_custkey")
    return customer.select(
        key.alias("person_id"),
        F.when(key % 3 == 0, MALE_CONCEPT).when(key % 3 == 1, FEMALE_CONCEPT).otherwise(0)
        .alias("gender_concept_id"),
        (1925 + (key * 7) % 76).cast("int").alias("year_of_birth"),
        F.when(key % 5 != 0, 1 + key % 12).cast("int").alias("month_of_birth"),
        F.when(key % 4 != 0, 1 + key % 28).cast("int").alias("day_of_birth"),
    )


def _observation_period(orders: DataFrame) -> DataFrame:
    split = F.lit(SPLIT_DAY)
    spans = orders.groupBy("o_custkey").agg(
        F.min("order_date").alias("first_day"), F.max("order_date").alias("last_day")
    )
    whole = F.struct(F.col("first_day").alias("s"), F.col("last_day").alias("e"))
    before = F.struct(F.col("first_day").alias("s"), F.date_sub(split, 1).alias("e"))
    after = F.struct(split.alias("s"), F.col("last_day").alias("e"))
    divided = (F.col("o_custkey") % 10 == 0) & (F.col("first_day") < split) & (F.col("last_day") >= split)
    return spans.select(
        F.col("o_custkey").alias("person_id"),
        F.explode(F.when(divided, F.array(before, after)).otherwise(F.array(whole))).alias("span"),
    ).select(
        "person_id",
        F.col("span.s").alias("observation_period_start_date"),
        F.col("span.e").alias("observation_period_end_date"),
    )


def _end_unless_returned() -> Column:
    return F.when(F.col("l_returnflag") != "R", F.col("ship_date"))


def _conditions(lines: DataFrame) -> DataFrame:
    return lines.where(F.col("l_linenumber") % 2 == 1).select(
        F.col("o_custkey").alias("person_id"),
        (PART_BASE + F.col("l_partkey")).alias("condition_concept_id"),
        F.col("order_date").alias("condition_start_date"),
        _end_unless_returned().alias("condition_end_date"),
        F.col("l_orderkey").alias("visit_occurrence_id"),
    )


def _drugs(lines: DataFrame) -> DataFrame:
    return lines.where(F.col("l_linenumber") % 2 == 0).select(
        F.col("o_custkey").alias("person_id"),
        (PART_BASE + F.col("l_partkey")).alias("drug_concept_id"),
        F.col("l_partkey").cast("string").alias("drug_source_value"),
        F.col("ship_date").alias("drug_exposure_start_date"),
        _end_unless_returned().alias("drug_exposure_end_date"),
        F.col("l_quantity").cast("int").alias("days_supply"),
        F.col("l_orderkey").alias("visit_occurrence_id"),
    )


def _observations(lines: DataFrame) -> DataFrame:
    return lines.where(F.col("l_linenumber") == 3).select(
        F.col("o_custkey").alias("person_id"),
        (PART_BASE + F.col("l_partkey")).alias("observation_concept_id"),
        F.col("ship_date").alias("observation_date"),
        F.col("l_orderkey").alias("visit_occurrence_id"),
    )


def _procedures(lines: DataFrame) -> DataFrame:
    return lines.where(F.col("l_linenumber") == 2).select(
        F.col("o_custkey").alias("person_id"),
        (PART_BASE + F.col("l_partkey")).alias("procedure_concept_id"),
        F.col("order_date").alias("procedure_date"),
        F.col("l_orderkey").alias("visit_occurrence_id"),
    )


def _death(customer: DataFrame, orders: DataFrame) -> DataFrame:
    overdrawn = customer.where(F.col("c_acctbal") < 0).select("c_custkey")
    last = orders.groupBy("o_custkey").agg(F.max("order_date").alias("last_day"))
    return last.join(overdrawn, F.col("o_custkey") == F.col("c_custkey")).select(
        F.col("o_custkey").alias("person_id"),
        F.date_sub("last_day", DEATH_LEAD_DAYS).alias("death_date"),
    )


def _brand_concept() -> Column:
    return (BRAND_BASE + F.substring_index("p_brand", "#", -1).cast("bigint"))


def _concept(part: DataFrame) -> DataFrame:
    parts = part.select(
        (PART_BASE + F.col("p_partkey")).alias("concept_id"),
        F.when(F.col("p_partkey") % 17 == 0, "D").alias("invalid_reason"),
    )
    brands = part.select(
        _brand_concept().alias("concept_id"), F.lit(None).cast("string").alias("invalid_reason")
    ).distinct()
    return parts.unionByName(brands)


def _concept_ancestor(part: DataFrame) -> DataFrame:
    to_parts = part.select(
        _brand_concept().alias("ancestor_concept_id"),
        (PART_BASE + F.col("p_partkey")).alias("descendant_concept_id"),
    )
    to_itself = _concept(part).select(
        F.col("concept_id").alias("ancestor_concept_id"),
        F.col("concept_id").alias("descendant_concept_id"),
    )
    return to_parts.unionByName(to_itself)
