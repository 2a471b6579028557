"""Merkle manifests: parents keep copied hash states before each child slot, from which folding goes on."""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from cohortloom.llm.common import written
from cohortloom.llm.ordered import numbered

FAN_OUT = 2
LEVELS = 8  # levels of a tree that one group works out; a group has FAN_OUT ** LEVELS nodes at most
#: Nodes of one round: their tree, place in it, and how many nodes the tree has in this round.
NODES = "tree string, pos long, n long, digest binary"
#: Of a group of nodes: what lies above it. ``path`` has for each level a slot and its run's other digests.
ABOVE = "array<struct<slot: int, others: array<binary>>>"


class Parent:
    """A run of children: its digest, and a copy of the hash state from before each child was taken in."""

    def __init__(self, children: list[bytes]):
        state, self.states = hashlib.sha256(), []
        for child in children:
            self.states.append(state.copy())
            state.update(child.hex().encode())
        self.children, self.digest = children, state.digest()

    def folded(self, slot: int, replacement: bytes) -> bytes:
        """The digest with another child at ``slot``: only it and what stands right of it are hashed."""
        state = self.states[slot].copy()
        state.update(replacement.hex().encode())
        for child in self.children[slot + 1 :]:
            state.update(child.hex().encode())
        return state.digest()

    def others(self, slot: int) -> list[bytes]:
        return self.children[:slot] + self.children[slot + 1 :]

    @classmethod
    def above(cls, slot: int, others: list[bytes], child: bytes) -> Parent:
        return cls([*others[:slot], child, *others[slot:]])


def height(n: int, fan_out: int) -> int:
    """Levels above ``n`` nodes until one is left."""
    levels = 0
    while n > 1:
        n, levels = -(-n // fan_out), levels + 1
    return levels


def part_of_tree(digests: list[bytes], levels: int, fan_out: int) -> list[list[Parent]]:
    """Parents level by level above consecutive nodes, the first of which begins a run on every level."""
    out = []
    for _ in range(levels):
        out.append([Parent(digests[i : i + fan_out]) for i in range(0, len(digests), fan_out)])
        digests = [p.digest for p in out[-1]]
    return out


def line_of(parts: list[list[Parent]], i: int, fan_out: int) -> list[tuple[int, Parent]]:
    """(slot, parent) of the ``i``-th node and what lies above it."""
    out = []
    for parents in parts:
        out.append((i % fan_out, parents[i // fan_out]))
        i //= fan_out
    return out


def folded(line: list[tuple[int, Parent]], digest: bytes) -> bytes:
    """What a line of parents comes to above ``digest``."""
    for slot, parent in line:
        digest = parent.folded(slot, digest)
    return digest


def _sorted_nodes(pdf: pd.DataFrame, fan_out: int) -> tuple[pd.DataFrame, list[list[Parent]]]:
    pdf = pdf.sort_values("pos", ignore_index=True)
    levels = min(LEVELS, height(int(pdf["n"].iloc[0]), fan_out)) if len(pdf) else 0
    return pdf, part_of_tree(pdf["digest"].tolist(), levels, fan_out)


def _steps(line: list[tuple[int, Parent]]) -> list[dict]:
    return [{"slot": slot, "others": parent.others(slot)} for slot, parent in line]


def _line_above(path, digest: bytes) -> list[tuple[int, Parent]]:
    """Parents above a group whose own digest is ``digest``, from its path."""
    line = []
    for step in path:
        parent = Parent.above(step["slot"], list(step["others"]), digest)
        line.append((step["slot"], parent))
        digest = parent.digest
    return line


def _group(nodes: DataFrame, fan_out: int) -> DataFrame:
    return nodes.withColumn("group", F.floor(F.col("pos") / fan_out**LEVELS).cast("long"))


def climb(nodes: DataFrame, fan_out: int) -> list[DataFrame]:
    """Rounds of nodes of all trees, from ``nodes`` to one node for each tree.

    A round puts ``LEVELS`` levels of a tree into one row for each group of nodes, so there are as many rounds
    as eighths of the highest tree's levels; that number alone is asked for by the driver.
    """
    rounds = [nodes]
    most = nodes.agg(F.max("n")).first()[0] or 1
    span = fan_out**LEVELS

    def top(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf, parts = _sorted_nodes(pdf, fan_out)
        first = pdf.iloc[0]
        return pd.DataFrame(
            {
                "tree": [first["tree"]],
                "pos": [first["pos"] // span],
                "n": [-(-first["n"] // span)],
                "digest": [parts[-1][0].digest if parts else first["digest"]],
            }
        )

    while most > 1:
        above = _group(rounds[-1], fan_out).groupBy("tree", "group").applyInPandas(top, NODES)
        rounds.append(written(above))
        most = -(-most // span)
    return rounds


def descend(rounds: list[DataFrame], tops: DataFrame, fan_out: int) -> DataFrame:
    """For each group of the first round: tree, group and what lies above it.

    ``tops`` has a row for each tree: tree, path, subroot, root, the path being what lies above the tree.
    """
    above = tops.withColumn("group", F.lit(0).cast("long"))
    schema = f"tree string, group long, path {ABOVE}, subroot binary, root binary"
    for nodes in reversed(rounds[1:]):

        def spread(pdf: pd.DataFrame, over: pd.DataFrame) -> pd.DataFrame:
            pdf, parts = _sorted_nodes(pdf, fan_out)
            over = over.iloc[0]
            paths = [[*_steps(line_of(parts, i, fan_out)), *over["path"]] for i in range(len(pdf))]
            return pd.DataFrame(
                {"tree": pdf["tree"], "group": pdf["pos"], "path": paths, "subroot": over["subroot"], "root": over["root"]}
            )

        here = _group(nodes, fan_out).groupBy("tree", "group")
        above = written(here.cogroup(above.groupBy("tree", "group")).applyInPandas(spread, schema))
    return above


@dataclass(frozen=True)
class Manifest:
    """Leaves in order, with what they came from, and what lies above each group of them.

    ``leaves``: tree, pos, n, digest, replacement and key. ``above``: tree, group, path, subroot, root. All
    of it is stored in the shared folder, so proofs can be asked for again without the data.
    """

    leaves: DataFrame
    above: DataFrame
    fan_out: int


def leaf_digest(*columns: Column) -> Column:
    """Binary SHA-256 of values, each as ``-`` if null, else its UTF-8 byte count, ``:`` and the value."""
    parts = [
        F.coalesce(F.concat(F.octet_length(c.cast("string")).cast("string"), F.lit(":"), c.cast("string")), F.lit("-"))
        for c in columns
    ]
    return F.unhex(F.sha2(F.concat(*parts), 256))


def build(rows: DataFrame, fan_out: int = FAN_OUT) -> Manifest:
    """The manifest of rows with: tree (null allowed), key, digest and replacement (null where there is none).

    Leaves of a tree ascend by key, null first; rows of equal keys ascend by digest. While more than one node is left, every
    ``fan_out`` consecutive ones become the SHA-256 of their digests as hexadecimal text; the last run may be
    shorter, down to one node. Trees' own tops are the leaves of a last tree, by name, null first.

    Leaves are dealt by ranges of tree and key, so a tree with most of the rows, or rows given any number
    of times, is split. A group of ``fan_out ** LEVELS`` nodes is worked out at once, and only its digest goes on to the
    next round. No rows make an empty manifest.
    """
    # Null is before every name: a name is marked.
    named = rows.withColumn("tree", F.coalesce(F.concat(F.lit("="), F.col("tree")), F.lit("")))
    placed = numbered(named, ["tree"], ["key", "digest"], "pos", "n")
    leaves = written(placed.select("tree", "pos", "n", "digest", "replacement", "key"))
    rounds = climb(leaves.select("tree", "pos", "n", "digest"), fan_out)
    tops = rounds[-1].where(F.col("n") == 1).select(F.lit("").alias("tree"), F.col("tree").alias("key"), "digest")
    tops = written(numbered(tops, ["tree"], ["key"], "pos", "n"))
    last = climb(tops.select("tree", "pos", "n", "digest"), fan_out)
    root = last[-1].select(
        "tree", F.array().cast(ABOVE).alias("path"), F.lit(None).cast("binary").alias("subroot"), F.col("digest").alias("root")
    )

    def lines(pdf: pd.DataFrame, over: pd.DataFrame) -> pd.DataFrame:
        pdf, parts = _sorted_nodes(pdf, fan_out)
        over = over.iloc[0]
        paths = [[*_steps(line_of(parts, i, fan_out)), *over["path"]] for i in range(len(pdf))]
        return pd.DataFrame({"tree": pdf["key"], "path": paths, "subroot": pdf["digest"], "root": over["root"]})

    grouped = _group(tops, fan_out).groupBy("tree", "group")
    above_tops = descend(last, root, fan_out)
    tree_tops = written(
        grouped.cogroup(above_tops.groupBy("tree", "group")).applyInPandas(
            lines, f"tree string, path {ABOVE}, subroot binary, root binary"
        )
    )
    return Manifest(leaves, descend(rounds, tree_tops, fan_out), fan_out)


PROOFS = (
    "key long, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean, "
    f"tree string, pos long, path {ABOVE}"
)


def proofs(manifest: Manifest, keep_path: bool = False) -> DataFrame:
    """Per leaf: key, leaf, subroot, root, proof_sha256, folded_root, verified, tree, pos and, if asked for, path.

    ``proof_sha256`` is of the other digests of the leaf's runs, level by level, left to right.
    ``folded_root`` is what its replacement, or the leaf itself where it has none, comes to: on each level the
    state that the parent kept before the slot takes in the new digest and the right siblings. What
    lies above a group of leaves is hashed once for all of them.
    """
    fan_out = manifest.fan_out

    def told(pdf: pd.DataFrame, over: pd.DataFrame) -> pd.DataFrame:
        pdf, parts = _sorted_nodes(pdf, fan_out)
        over = over.iloc[0]
        own = parts[-1][0].digest if parts else pdf["digest"].iloc[0]
        higher = _line_above(over["path"], own)
        tail = "".join(x.hex() for step in over["path"] for x in step["others"]).encode()
        root, subroot = over["root"], over["subroot"].hex()
        rows = []
        for i, (digest, replacement) in enumerate(zip(pdf["digest"], pdf["replacement"])):
            line = line_of(parts, i, fan_out)
            near = "".join(x.hex() for slot, parent in line for x in parent.others(slot)).encode()
            found = folded([*line, *higher], digest if replacement is None else replacement)
            rows.append(
                (
                    digest.hex(), subroot, root.hex(), hashlib.sha256(near + tail).hexdigest(), found.hex(),
                    found == root, [*_steps(line), *over["path"]] if keep_path else None,
                )
            )
        names = ["leaf", "subroot", "root", "proof_sha256", "folded_root", "verified", "path"]
        out = pd.DataFrame(rows, columns=names)
        return out.assign(key=pdf["key"].astype("Int64"), tree=pdf["tree"], pos=pdf["pos"])

    leaves = _group(manifest.leaves, fan_out).groupBy("tree", "group")
    found = leaves.cogroup(manifest.above.groupBy("tree", "group")).applyInPandas(told, PROOFS)
    return found if keep_path else found.drop("path")


TAMPER_EVERY = 7


def document_manifest(docs: DataFrame, fan_out: int = FAN_OUT) -> Manifest:
    """The manifest of documents (doc_id, source, lang, n_chars, text), with one tree for each lang.

    Rows whose crc32 of the decimal doc_id is divisible by ``TAMPER_EVERY`` get as replacement the leaf with one
    more character counted; a null count stays, and rows of null id are never tampered with. Any
    column may be null and texts are hashed whole, where they are read; other columns are ignored.
    """
    before, after = [docs["doc_id"], docs["source"], docs["lang"]], docs["text"]
    tampered = F.crc32(docs["doc_id"].cast("string").cast("binary")) % TAMPER_EVERY == 0
    rows = docs.select(
        docs["lang"].alias("tree"),
        docs["doc_id"].cast("long").alias("key"),
        leaf_digest(*before, docs["n_chars"], after).alias("digest"),
        F.when(tampered, leaf_digest(*before, docs["n_chars"] + 1, after)).alias("replacement"),
    )
    return build(rows, fan_out)
