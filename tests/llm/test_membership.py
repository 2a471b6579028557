import pytest
from pyspark.sql import functions as F

from cohortloom.llm import membership


@pytest.mark.parametrize("bits", [20, 26])
def test_no_key_is_missed_and_few_others_are_taken(spark, monkeypatch, bits):
    monkeypatch.setattr(membership, "BITS", bits)
    rows = spark.range(20_000).select(
        F.when(F.col("id") % 1000 != 7, F.col("id")).alias("a"), F.concat(F.lit("t"), "id").alias("b"),
        F.lit("x").alias("slot"), F.lit("y").alias("number"),
    )
    keys = rows.where("b in ('t7', 't1007') or a % 40 = 3").select("a", "b")
    told = membership.with_possible(rows, [F.col("a"), F.col("b")], keys, "possible")
    assert told.columns == ["a", "b", "slot", "number", "possible"] and told.count() == 20_000
    wanted = F.col("b").isin("t7", "t1007") | (F.coalesce(F.col("a") % 40, F.lit(0)) == 3)
    assert told.where(wanted & ~F.col("possible")).count() == 0
    assert told.where(~wanted & F.col("possible")).count() < 30


def test_no_keys(spark):
    rows = spark.range(5).toDF("a")
    none = rows.where("a < 0")
    assert membership.with_possible(rows, [F.col("a")], none, "p").where("p").count() == 0
    assert membership.with_possible(none, [F.col("a")], rows, "p").count() == 0
