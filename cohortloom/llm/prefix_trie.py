"""The trie of conversations' first turns, with totals of every subtree."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F

from cohortloom.llm.common import partitions, whole_text, written
from cohortloom.llm.ordered import numbered
from cohortloom.llm.tree_sums import subtree_sums

FAMILY = 20  # a conversation takes its first turns from the one whose id is the multiple of this at or below its own
MOST_TAKEN = 3  # turns that a conversation takes at most
BLOCK = 1024  # turns of a conversation whose prefixes are worked out together
PIECE_BITS = 16  # members' ids go through one text for each 2 ** 16 of them


def numbered_turns(conversations: DataFrame) -> DataFrame:
    """Turns in order: conv, place (from 0), n (turns of the conversation), key, words."""
    role, text = whole_text(F.col("role").cast("string")), whole_text("text")
    turns = conversations.where(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("long").alias("conv"),
        "turn",
        F.unhex(F.sha2(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text), 256)).alias("key"),
        F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")).cast("long").alias("words"),
    )
    return written(numbered(turns, ["conv"], ["turn", "key"], "place", "n").drop("turn"))


def taken(conv: Column) -> Column:
    """How many first turns a conversation takes from the first of its family."""
    return F.crc32(conv.cast("string").cast("binary")) % (MOST_TAKEN + 1)


def rebuilt(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Turns of rebuilt conversations (conv, depth from 1, key, words), and their lengths (conv, length)."""
    sizes = turns.groupBy("conv").agg(F.first("n").alias("n"))
    sizes = sizes.withColumn("base", F.col("conv") - F.col("conv") % FAMILY).withColumn("h", taken(F.col("conv")))
    bases = sizes.select(F.col("conv").alias("base"), F.col("n").alias("n_base"))
    convs = written(
        sizes.join(bases, "base", "left")
        .withColumn("k", F.least("h", F.coalesce("n_base", F.lit(0))))
        .select("conv", "base", "h", "k", (F.col("k") + F.greatest(F.col("n") - F.col("h"), F.lit(0))).alias("length"))
    )
    first = turns.where(F.col("place") < MOST_TAKEN).select(F.col("conv").alias("base"), "place", "key", "words")
    from_base = convs.join(first, "base").where(F.col("place") < F.col("k")).select(
        "conv", (F.col("place") + 1).alias("depth"), "key", "words"
    )
    own = turns.join(convs.select("conv", "h", "k"), "conv").where(F.col("place") >= F.col("h")).select(
        "conv", (F.col("k") + F.col("place") - F.col("h") + 1).alias("depth"), "key", "words"
    )
    return from_base.unionByName(own), convs.select("conv", "length")


def prefixes(turns: DataFrame) -> DataFrame:
    """Each turn with 128 bits for the turns up to it (p1, p2) and for those before it (q1, q2).

    A turn has 128 bits of hash of its depth and key, and a prefix the exclusive or of its turns'. So a long
    conversation's prefixes are worked out by blocks of ``BLOCK`` turns, and blocks put together.
    """
    mixed = turns.withColumns(
        {
            "x1": F.xxhash64("depth", "key"),
            "x2": F.xxhash64(F.lit("second"), "key", "depth"),
            "block": F.floor((F.col("depth") - 1) / BLOCK).cast("long"),
        }
    )
    within = Window.partitionBy("conv", "block").orderBy("depth")
    inside = written(
        mixed.withColumns({"i1": F.bit_xor("x1").over(within), "i2": F.bit_xor("x2").over(within)})
    )
    # Only conversations of several blocks have any before another.
    blocks = inside.where(F.col("depth") % BLOCK == 0).select(
        "conv", (F.col("block") + 1).alias("block"), F.col("i1").alias("b1"), F.col("i2").alias("b2")
    )
    over = Window.partitionBy("conv").orderBy("block")
    before = written(
        blocks.select("conv", "block", F.bit_xor("b1").over(over).alias("b1"), F.bit_xor("b2").over(over).alias("b2"))
    )
    joined = inside.join(before, ["conv", "block"], "left")
    found = {f"p{k}": F.col(f"i{k}").bitwiseXOR(F.coalesce(f"b{k}", F.lit(0))) for k in (1, 2)}
    rows = joined.withColumns(found)
    return rows.select(
        "conv", "depth", "words", "p1", "p2",
        F.col("p1").bitwiseXOR(F.col("x1")).alias("q1"), F.col("p2").bitwiseXOR(F.col("x2")).alias("q2"),
    )


def ids_digest(ends: DataFrame, keys: list[str]) -> DataFrame:
    """SHA-256 of the decimal ids (conv) of each group, ascending and comma-joined: keys, ends_sha256.

    Ids are dealt by ranges and joined into texts of 2 ** 16 ids at most. A group's texts are hashed one
    after the other, as the digest of a whole text asks for; a task holds one of them at a time.
    """
    by = [*keys, "conv"]
    dealt = written(
        ends.select(*by)
        .repartitionByRange(partitions(ends.sparkSession), *by)
        .sortWithinPartitions(*by)
        .withColumn("at", F.monotonically_increasing_id())
    )
    pieces = (
        dealt.groupBy(*keys, F.shiftright("at", PIECE_BITS).alias("piece"))
        .agg(F.array_join(F.transform(F.array_sort(F.collect_list("conv")), lambda x: x.cast("string")), ",").alias("ids"))
        .repartition(partitions(ends.sparkSession), *keys)
        .sortWithinPartitions(*keys, "piece")
    )

    def digests(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        now, state = None, None
        for batch in batches:
            done = []
            for row in batch[[*keys, "ids"]].itertuples(index=False):
                if row[:-1] != now:
                    if now is not None:
                        done.append((*now, state.hexdigest()))
                    now, state = row[:-1], hashlib.sha256()
                else:
                    state.update(b",")
                state.update(row[-1].encode())
            yield pd.DataFrame(done, columns=[*keys, "ends_sha256"])
        if now is not None:
            yield pd.DataFrame([(*now, state.hexdigest())], columns=[*keys, "ends_sha256"])

    types = dict(ends.dtypes)
    schema = ", ".join([*(f"{k} {types[k]}" for k in keys), "ends_sha256 string"])
    return pieces.mapInPandas(digests, schema)


NODE = ["depth", "p1", "p2"]


def prefix_trie(conversations: DataFrame) -> DataFrame:
    """One row per node of the trie of rebuilt conversations.

    Columns: conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256. A node
    is a distinct sequence of first turns (role and text, null as empty) and is named by its depth and its smallest
    member. Subtree totals are ``subtree_sums`` of childless nodes and of each node's (members - 1)
    times words of its last text.

    Turns are in order of ``turn``, null first; equal ones are ordered by a digest of role and text, and
    rows given twice are two turns. Rows of null conv_id belong to no conversation. Conversations without
    any turn left are members of the root alone. Without conversations there is no root. Other columns are ignored.

    Texts are read once and not shuffled: digests are. A conversation of any length is dealt by ranges of its turns
    (``numbered``) and its prefixes made by blocks; a turn that begins a third of all conversations is one
    row for each task before it is a node.
    """
    turns, lengths = rebuilt(numbered_turns(conversations))
    rows = written(prefixes(turns))
    whole = {"depth": F.lit(0).cast("long"), "p1": F.lit(0).cast("long"), "p2": F.lit(0).cast("long")}
    root = (
        lengths.agg(F.min("conv").alias("conv"), F.count("*").alias("n_convs"))
        .where(F.col("n_convs") > 0)
        .select(
            *[v.alias(c) for c, v in whole.items()], F.lit(None).cast("long").alias("q1"),
            F.lit(None).cast("long").alias("q2"), F.lit(0).cast("long").alias("words"), "conv", "n_convs",
        )
    )
    nodes = rows.groupBy(*NODE, "q1", "q2").agg(
        F.min("words").alias("words"), F.min("conv").alias("conv"), F.count("*").alias("n_convs")
    )
    nodes = written(root.unionByName(nodes).withColumn("node", F.monotonically_increasing_id()))
    parents = nodes.select(
        (F.col("depth") + 1).alias("depth"), F.col("p1").alias("q1"), F.col("p2").alias("q2"),
        F.col("node").alias("parent"), F.col("conv").alias("parent_conv_id"),
    )
    tree = written(nodes.join(parents, ["depth", "q1", "q2"], "left").select(
        "node", "parent", "depth", "p1", "p2", "conv", "parent_conv_id", "n_convs",
        ((F.col("n_convs") - 1) * F.col("words")).alias("saved"),
    ))
    children = tree.where(F.col("parent").isNotNull()).groupBy(F.col("parent").alias("node")).agg(
        F.count("*").alias("n_children")
    )
    tree = written(tree.join(children, "node", "left").withColumn("n_children", F.coalesce("n_children", F.lit(0))))
    sums = subtree_sums(
        tree.select("node", "parent", "depth", (F.col("n_children") == 0).cast("long").alias("n_leaves"),
                    F.col("saved").alias("saved_tokens")),
        ["n_leaves", "saved_tokens"],
    )
    ends = rows.join(lengths, "conv").where(F.col("depth") == F.col("length")).select(*NODE, "conv").unionByName(
        lengths.where(F.col("length") == 0).select(*[v.alias(c) for c, v in whole.items()], "conv")
    )
    told = tree.join(ids_digest(ends, NODE), NODE, "left").join(sums, "node")
    return told.select(
        F.col("conv").alias("conv_id"), "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
        F.coalesce("ends_sha256", F.sha2(F.lit(""), 256)).alias("ends_sha256"),
    )
