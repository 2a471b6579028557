"""Subtree sums of a forest by parallel tree contraction: rake leaves, compress chains, expand again."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from cohortloom.llm.common import written


@dataclass
class _Round:
    """Live nodes at the start of a round: node, parent, depth, n (live children), and numbers.

    ``own_x`` is a node's number with those of raked subtrees below it, ``edge_x`` what compressed nodes between
    it and its parent hold. A row also has the node that was compressed into its edge before this
    round (``freed``), if any, and what that node's subtree has beyond the row's own (``gap_x``).
    """

    live: DataFrame
    raked: DataFrame
    freed: DataFrame


def _is_candidate(k: int, bits: int) -> Column:
    """Whether a unary node would go in round ``k``: by a bit of its depth at first, then by a coin.

    Along a chain that nothing has touched, depths follow one another, so every round ends half of it.
    """
    if k < bits:
        return F.shiftright("depth", k).bitwiseAND(F.lit(1)) == 1
    return F.xxhash64("node", F.lit(k)).bitwiseAND(F.lit(1)) == 1


def subtree_sums(nodes: DataFrame, values: list[str]) -> DataFrame:
    """Per node: node, and for each of ``values`` its sum over the node's subtree, the node included.

    ``nodes`` has node (long, unique), parent (long, null for a root) and depth (int, more than the
    parent's). Values are longs without null. No nodes give no rows.

    Every round rakes all leaves, whose sums are then known and are added up by parent, and compresses
    chains: of nodes with one live child, some with no two in a row go, and their child takes their parent,
    with their number on its edge. So the number of rounds grows with the logarithm of the number of nodes, however deep the
    trees are. A compressed node's sum is its child's and what lay between; rounds are expanded in reverse to get it.
    Rounds are stored, each smaller than the one before; a parent of any number of leaves is one row for
    each task before they are added up.
    """
    own, edge, gap = ([f"{p}_{v}" for v in values] for p in ("own", "edge", "gap"))
    counted = nodes.where(F.col("parent").isNotNull()).groupBy(F.col("parent").alias("node")).agg(F.count("*").alias("n"))
    live = written(
        nodes.join(counted, "node", "left").select(
            "node", "parent", F.col("depth").cast("long").alias("depth"), F.coalesce("n", F.lit(0)).alias("n"),
            *[F.col(v).cast("long").alias(x) for v, x in zip(values, own)],
            *[F.lit(0).cast("long").alias(x) for x in edge],
            F.lit(None).cast("long").alias("freed"),
            *[F.lit(None).cast("long").alias(x) for x in gap],
        )
    )
    bits = int(live.agg(F.max("depth")).first()[0] or 0).bit_length()
    rounds: list[_Round] = []
    while not live.isEmpty():
        raked = live.where(F.col("n") == 0)
        rounds.append(
            _Round(
                live,
                raked.select("node", *[F.col(x).alias(v) for v, x in zip(values, own)]),
                live.where(F.col("freed").isNotNull()).select("freed", "node", *gap),
            )
        )
        live = written(_compressed(_raked(live, raked, own, edge), len(rounds) - 1, bits, own, edge, gap))
    known = None
    for step in reversed(rounds):
        # A round's compressed nodes hang on nodes that are live in the next round, whose sums are known.
        known = step.raked if known is None else known.unionByName(step.raked)
        expanded = step.freed.join(known, "node").select(
            F.col("freed").alias("node"), *[(F.col(v) + F.col(x)).alias(v) for v, x in zip(values, gap)]
        )
        known = written(known.unionByName(expanded))
    return known if known is not None else nodes.select("node", *values)


def _raked(live: DataFrame, raked: DataFrame, own: list[str], edge: list[str]) -> DataFrame:
    """Nodes that have children, with what raked children bring."""
    brought = raked.where(F.col("parent").isNotNull()).groupBy(F.col("parent").alias("node")).agg(
        F.count("*").alias("gone"), *[F.sum(F.col(o) + F.col(e)).alias(f"more_{o}") for o, e in zip(own, edge)]
    )
    rest = live.where(F.col("n") > 0).join(brought, "node", "left")
    return rest.select(
        "node", "parent", "depth", (F.col("n") - F.coalesce("gone", F.lit(0))).alias("n"),
        *[(F.col(o) + F.coalesce(f"more_{o}", F.lit(0))).alias(o) for o in own],
        *edge,
    )


def _compressed(
    rest: DataFrame, k: int, bits: int, own: list[str], edge: list[str], gap: list[str]
) -> DataFrame:
    """The next round's live nodes: a candidate whose parent is none goes, its child takes its place."""
    rest = written(rest.withColumn("candidate", (F.col("n") == 1) & F.col("parent").isNotNull() & _is_candidate(k, bits)))
    candidates = rest.where("candidate").select("node", "parent", *own, *edge)
    above = rest.where("candidate").select(F.col("node").alias("parent"))
    going = written(candidates.join(above, "parent", "left_anti"))
    # A candidate has one live child, so each row meets one going node at most.
    over = going.select(
        F.col("node").alias("freed"), F.col("parent").alias("over"), *[F.col(x).alias(f"over_{x}") for x in (*own, *edge)]
    )
    kept = rest.drop("candidate").join(going.select("node"), "node", "left_anti")
    met = kept.join(over, kept["parent"] == over["freed"], "left")
    there = F.col("freed").isNotNull()
    return met.select(
        "node",
        F.when(there, F.col("over")).otherwise(F.col("parent")).alias("parent"),
        "depth", "n", *own,
        *[
            (F.col(e) + F.coalesce(F.col(f"over_{o}") + F.col(f"over_{e}"), F.lit(0))).alias(e)
            for o, e in zip(own, edge)
        ],
        "freed",
        *[F.when(there, F.col(e) + F.col(f"over_{o}")).alias(g) for o, e, g in zip(own, edge, gap)],
    )
