"""What each inclusion rule does to a cohort.

Everything here starts from qualified events with their rule masks and goes
through counts per mask, of which a cohort has few.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from cohortloom.model import RULES_PER_WORD, CohortDefinition
from cohortloom.operators.rules import mask_columns
from cohortloom.session import local_frame

ALL_EVENTS, BEST_EVENT = 0, 1


def rule_catalogue(spark: SparkSession, definitions: Iterable[CohortDefinition]) -> DataFrame:
    """One row per cohort and rule: as long as the study's settings."""
    rows = [
        (d.cohort_id, sequence, len(d.rules)) for d in definitions for sequence in range(len(d.rules))
    ]
    return local_frame(spark, rows, "cohort_definition_id int, rule_sequence int, total_rules int")


def _rule_count(masks: list[str]) -> Column:
    return sum((F.bit_count(mask) for mask in masks[1:]), F.bit_count(masks[0]))


def _lowest_rule(masks: list[str]) -> Column:
    """Number of the lowest set bit over all words, 0 for an empty mask."""
    lowest = F.when(F.lit(False), F.lit(0))
    for word, name in enumerate(masks):
        mask = F.col(name)
        below = mask.bitwiseAND(-mask) - 1
        lowest = lowest.when(mask != 0, F.bit_count(below) + word * RULES_PER_WORD)
    return lowest.otherwise(0)


def best_events(qualified: DataFrame) -> DataFrame:
    """One event per cohort and person: most rules, then earliest rule, then earliest start."""
    masks = mask_columns(qualified, "rule_mask")
    rank = F.struct(
        (-_rule_count(masks)).alias("fewer_rules"),
        _lowest_rule(masks).alias("min_rule_id"),
        "start_date", "op_start_date", "op_end_date", *masks,
    )
    best = qualified.groupBy("cohort_id", "person_id").agg(F.min(rank).alias("best"))
    return best.select(
        "cohort_id",
        "person_id",
        F.col("best.start_date").alias("start_date"),
        F.col("best.op_start_date").alias("op_start_date"),
        F.col("best.op_end_date").alias("op_end_date"),
        (-F.col("best.fewer_rules")).alias("rule_count"),
        F.col("best.min_rule_id").alias("min_rule_id"),
        *[F.col(f"best.{mask}").alias(mask) for mask in masks],
        F.lit(1).cast("bigint").alias("n_events"),
    )


def inclusion_result(qualified: DataFrame, mode: int) -> DataFrame:
    """Events, or best events, per cohort and rule mask."""
    events = best_events(qualified) if mode == BEST_EVENT else qualified
    return events.groupBy(
        F.col("cohort_id").alias("cohort_definition_id"),
        *[F.col(mask).alias(f"inclusion_{mask}") for mask in mask_columns(qualified, "rule_mask")],
    ).agg(F.sum("n_events").alias("person_count")).withColumn("mode_id", F.lit(mode))


def _ones(count: Column) -> Column:
    """A word with that many low bits set; none for less than one."""
    held = F.greatest(F.lit(0), F.least(count, F.lit(RULES_PER_WORD)))
    return F.call_function("shiftleft", F.lit(1).cast("bigint"), held) - 1


def _equal(result: DataFrame, wanted: Callable[[int], Column]) -> Column:
    """Whether every word of the mask is what ``wanted`` makes of its number."""
    masks = mask_columns(result, "inclusion_rule_mask")
    return reduce(and_, (F.col(mask) == wanted(word) for word, mask in enumerate(masks)))


def _counts_or_zero(condition: Column | None = None) -> Column:
    counted = F.col("person_count") if condition is None else F.when(condition, F.col("person_count"))
    return F.coalesce(F.sum(counted), F.lit(0))


def inclusion_stats(result: DataFrame, catalogue: DataFrame, mode: int) -> DataFrame:
    """Per rule: events meeting it, events it alone keeps out, and all events."""
    masks = mask_columns(result, "inclusion_rule_mask")
    total, rule = F.col("total_rules"), F.col("rule_sequence")

    def own_bit(word: int) -> Column:
        here = rule - word * RULES_PER_WORD
        bit = F.call_function("shiftleft", F.lit(1).cast("bigint"), F.greatest(here, F.lit(0)))
        return F.when(here.between(0, RULES_PER_WORD - 1), bit).otherwise(F.lit(0).cast("bigint"))

    meets = reduce(or_, (F.col(mask).bitwiseAND(own_bit(word)) != 0 for word, mask in enumerate(masks)))
    alone_out = _equal(result, lambda word: _ones(total - word * RULES_PER_WORD) - own_bit(word))
    return (
        catalogue.join(result.drop("mode_id"), "cohort_definition_id", "left")
        .groupBy("cohort_definition_id", "rule_sequence")
        .agg(
            _counts_or_zero(meets).alias("person_count"),
            _counts_or_zero(alone_out).alias("gain_count"),
            _counts_or_zero().alias("person_total"),
        )
        .withColumn("mode_id", F.lit(mode))
    )


def attrition_summary(result: DataFrame, catalogue: DataFrame, mode: int) -> DataFrame:
    """Events before and after all rules, per cohort."""
    cohorts = catalogue.select("cohort_definition_id", "total_rules").distinct()
    meets_all = _equal(result, lambda word: _ones(F.col("total_rules") - word * RULES_PER_WORD))
    return (
        cohorts.join(result.drop("mode_id"), "cohort_definition_id", "left")
        .groupBy("cohort_definition_id")
        .agg(_counts_or_zero().alias("base_count"), _counts_or_zero(meets_all).alias("final_count"))
        .withColumn("mode_id", F.lit(mode))
    )
