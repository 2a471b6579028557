"""Exact top-k by inner product: a three-phase uniform threshold over slices of the vectors."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import cached_property

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window, functions as F

from cohortloom.llm.common import partitions, written

SCALE = 1024
SLICES = 2  # lists that a whole score is the sum of
ROW_BLOCK = 4096
QUERY_BLOCK = 512
BLOCK_COMPONENTS = 1 << 18  # blocks of long vectors have fewer of them
CELL_NUMBERS = 1 << 23  # of the queries that a task holds, with their entries
STRIP = 64  # queries of a block whose entries are looked at together
DENSE = 16  # as many entries of one product cost what one entry does that is scored by itself
EXACT = {np.float32: 1 << 24, np.float64: 1 << 53}  # integers up to here are exact
# A scratch file's groups of rows are read at once, and Parquet would look at their size after 100 blocks only.
SMALL_GROUPS = {
    "parquet.block.size": 1 << 24, "parquet.block.size.row.check.min": 1, "parquet.page.size.row.check.min": 1
}
LIMB = 20  # bits of the parts that larger components are multiplied in
LARGEST = (1 << 63) - 1
NO_CUTOFF = -LARGEST - 1


def integer_vectors(rows: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """Ids with their vectors as integers floor(1024 x).

    Rows whose vector is null, or holds null or a component that isn't finite, take no part, nor do rows of null id. Integers
    beyond 64 bits are the largest or smallest long.
    """
    whole = F.transform(F.col(vector_col).cast("array<double>"), lambda x: F.floor(x * SCALE))
    finite = F.forall(
        F.col(vector_col).cast("array<double>"),
        lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")),
    )
    return rows.where(
        F.col(id_col).isNotNull() & F.col(vector_col).isNotNull() & F.coalesce(finite, F.lit(False))
    ).select(F.col(id_col).cast("long").alias("id"), whole.alias("vector"))


def vector_classes(vectors: DataFrame, k: int) -> DataFrame:
    """Distinct vectors with their k + 1 smallest ids, which are all that a top-k can need: vector, ids, class.

    However many rows share a vector, each task sends k + 1 of them at most. Classes are numbered in order of their
    smallest id, and those that share it, by rows of one id and several vectors, by a hash.
    """
    smallest = Window.partitionBy("vector").orderBy("id")
    found = (
        vectors.distinct()
        .withColumn("nth", F.row_number().over(smallest))
        .where(F.col("nth") <= k + 1)
        .groupBy("vector")
        .agg(F.sort_array(F.collect_list("id")).alias("ids"))
    )
    # Written first, as the ranges are found from a sample, which the driver gets.
    order = [F.col("ids")[0], F.xxhash64("vector")]
    return (
        written(found)
        .repartitionByRange(partitions(vectors.sparkSession), *order)
        .sortWithinPartitions(*order)
        .withColumn("class", F.monotonically_increasing_id())
    )


def _packed_blocks(classes: DataFrame, size: int, extra: list[str]) -> DataFrame:
    """Vectors of equal length as blocks of ``size`` at most: dim, block, classes, matrix of narrow integers."""
    schema = "dim int, block long, classes binary, matrix binary" + "".join(f", {x} binary" for x in extra)

    def block(dim: int, matrix: np.ndarray, numbers: np.ndarray, *more: np.ndarray) -> pa.RecordBatch:
        out = {
            "dim": pa.array([dim], pa.int32()),
            "block": pa.array(numbers[:1], pa.int64()),
            "classes": pa.array([numbers.astype("<i8").tobytes()], pa.binary()),
            "matrix": pa.array([_narrow(matrix).tobytes()], pa.binary()),
        }
        out |= {x: pa.array([m.astype("<i8").tobytes()], pa.binary()) for x, m in zip(extra, more)}
        return pa.RecordBatch.from_pydict(out)

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: dict[int, list[np.ndarray]] = {}
        for batch in batches:
            vectors, numbers = batch.column("vector"), [batch.column(c).to_numpy() for c in ("class", *extra)]
            lengths = pc.list_value_length(vectors).to_numpy()
            for dim in np.unique(lengths).tolist():
                at = np.flatnonzero(lengths == dim)
                matrix = vectors.take(pa.array(at)).flatten().to_numpy().reshape(len(at), dim)
                held = [matrix, *(x[at] for x in numbers)]
                if dim in waiting:
                    held = [np.concatenate(x) for x in zip(waiting.pop(dim), held)]
                most = max(1, min(size, BLOCK_COMPONENTS // max(1, dim)))
                whole = len(held[0]) // most * most
                for i in range(0, whole, most):
                    yield block(dim, *(x[i : i + most] for x in held))
                if whole < len(held[0]):
                    waiting[dim] = [x[whole:].copy() for x in held]
        for dim, held in waiting.items():
            yield block(dim, *held)

    return classes.mapInArrow(pack, schema)


def _narrow(a: np.ndarray) -> np.ndarray:
    """Integers in as few bytes as hold them all."""
    for kind in ("<i2", "<i4"):
        limits = np.iinfo(kind)
        if a.min(initial=0) >= limits.min and a.max(initial=0) <= limits.max:
            return a.astype(kind)
    return a.astype("<i8")


def _most(a: np.ndarray) -> int:
    return max(int(a.max(initial=0)), -int(a.min(initial=0)))


def _limbs(a: np.ndarray) -> list[tuple[int, np.ndarray]]:
    """(k, part k) of integers, parts of ``LIMB`` bits but for a signed last one; parts of zeros are left out."""
    parts = [a >> LIMB * k & (1 << LIMB) - 1 for k in range(3)] + [a >> 3 * LIMB]
    return [(k, x.astype(np.float64)) for k, x in enumerate(parts) if x.any()]


class Block:
    """Vectors of one length as integers, and what is worked out of them once for all blocks they meet."""

    def __init__(self, matrix: np.ndarray):
        self.matrix = matrix
        self._floats: dict[type, np.ndarray] = {}
        self._norms: dict[tuple[int, int], np.ndarray] = {}
        self._orders: dict[tuple[int, int], np.ndarray] = {}

    @cached_property
    def most(self) -> int:
        return _most(self.matrix)

    @cached_property
    def longest(self) -> float:
        return float(self.norms(slice(0, self.matrix.shape[1])).max(initial=0))

    def floats(self, kind: type) -> np.ndarray:
        if kind not in self._floats:
            self._floats[kind] = self.matrix.astype(kind)
        return self._floats[kind]

    def norms(self, s: slice) -> np.ndarray:
        """Norms of the vectors' parts in a slice, rounded up."""
        at = s.start, s.stop
        if at not in self._norms:
            norm = np.linalg.norm(self.matrix[:, s].astype(np.float64), axis=1)
            self._norms[at] = np.nextafter(norm * (1 + 1e-9) + 1e-9, np.inf)
        return self._norms[at]

    def order(self, s: slice) -> np.ndarray:
        """Places of the vectors in falling order of their norms in a slice."""
        at = s.start, s.stop
        if at not in self._orders:
            self._orders[at] = np.argsort(-self.norms(s), kind="stable")
        return self._orders[at]


class Products:
    """Exact inner products of integer queries and rows, slice by slice.

    Where no sum of products can pass 2 ** 24, or 2 ** 53, sums of float32, or float64, are exact: as products of norms bound
    the sums of any of their terms. Otherwise components are multiplied in parts of 20 bits, whose sums are exact, and put
    together as Python's integers. Either way the slices of a pair add up without rounding.
    """

    def __init__(self, queries: np.ndarray | Block, rows: np.ndarray | Block):
        self.queries, self.rows = (x if isinstance(x, Block) else Block(x) for x in (queries, rows))
        dim = self.rows.matrix.shape[1]
        small = self.queries.most * self.rows.most * max(dim, 1)
        bound = self.queries.longest * self.rows.longest if small < EXACT[np.float64] else small
        self.kind = next((x for x, limit in EXACT.items() if min(small, bound) < limit), object)
        edges = np.linspace(0, dim, min(SLICES, max(dim, 1)) + 1).astype(int)
        self.slices = [slice(int(a), int(b)) for a, b in zip(edges, edges[1:])]

    def part(self, s: slice, query=slice(None), row=slice(None)) -> np.ndarray:
        if self.kind is not object:
            return self.queries.matrix[query, s].astype(self.kind) @ self.rows.floats(self.kind)[row, s].T
        a, b = (x.astype(np.int64) for x in (self.queries.matrix[query, s], self.rows.matrix[row, s]))
        out = np.zeros((len(a), len(b)), object)
        for i, x in _limbs(a):
            for j, y in _limbs(b):
                # A slice of 2 ** 13 components at a time keeps these sums below 2 ** 53.
                for at in range(0, x.shape[1], 1 << 13):
                    cut = slice(at, at + (1 << 13))
                    found = (x[:, cut] @ y[:, cut].T).astype(np.int64).astype(object)
                    out = out + found * (1 << LIMB * (i + j))
        return out

    def bounds(self, s: slice) -> tuple[np.ndarray, np.ndarray]:
        """Norms of queries and rows in a slice: their products are no less than any score."""
        return self.queries.norms(s), self.rows.norms(s)


def _longs(scores: np.ndarray) -> np.ndarray:
    """Scores as longs; those beyond 64 bits are the largest or smallest."""
    if scores.dtype != object:
        return scores.astype(np.int64)
    return np.array([max(-LARGEST, min(LARGEST, x)) for x in scores.ravel()], np.int64).reshape(scores.shape)


def _best(queries: np.ndarray, classes: np.ndarray, scores: np.ndarray, k: int) -> np.ndarray:
    """Places of each query's k highest scores, ties to smaller classes, in order."""
    order = np.lexsort((classes, -scores, queries))
    sorted_queries = queries[order]
    start = np.flatnonzero(np.diff(sorted_queries, prepend=-1))
    nth = np.arange(len(order)) - np.repeat(start, np.diff(start, append=len(order)))
    return order[nth < k]


ENTRY = "query long, class long, score long"


def _grid(classes: DataFrame, asked: int, numbers: int, groups: int) -> tuple[int, int]:
    """How often rows are dealt apart, and queries: ``groups`` tasks, with the least that is copied.

    There are more if a task would have to hold more than ``CELL_NUMBERS`` of queries.
    """
    share = asked / max(1, classes.count())
    of_queries = min(groups, max(1, round((groups * share) ** 0.5)))
    of_queries = max(of_queries, -(-numbers // CELL_NUMBERS))
    return max(1, groups // of_queries), of_queries


def _dealt(row_blocks: DataFrame, query_blocks: DataFrame, grid: tuple[int, int]) -> DataFrame:
    """Blocks in the cells of a grid, a task for each: the queries of a length first, then the rows of that length.

    A row block goes to the cells of its line, a query block to those of its column. So each row block meets each
    query block in one cell, and no pair of blocks is ever a row.
    """

    def every(n: int) -> Column:
        return F.explode(F.sequence(F.lit(0), F.lit(n - 1)))

    def own(n: int) -> Column:
        return F.pmod(F.xxhash64("block"), F.lit(n)).cast("int")

    lines, columns = grid
    blocks = row_blocks.select("dim", "classes", "matrix", own(lines).alias("line"), every(columns).alias("column"))
    asked = query_blocks.select(
        "dim",
        F.col("classes").alias("q_classes"),
        F.col("matrix").alias("q_matrix"),
        *[F.col(c) for c in query_blocks.columns if c == "cutoff"],
        own(columns).alias("column"),
        every(lines).alias("line"),
    )
    return (
        blocks.unionByName(asked, allowMissingColumns=True)
        .withColumn("cell", F.col("line") * columns + F.col("column"))
        .drop("line", "column")
        .repartitionById(lines * columns, "cell")
        .sortWithinPartitions("cell", "dim", F.col("q_classes").isNull())
    )


def _unpack(classes: bytes, matrix: bytes, dim: int) -> tuple[np.ndarray, Block]:
    numbers = np.frombuffer(classes, "<i8")
    width = len(matrix) // (len(numbers) * dim) if dim else 8
    return numbers, Block(np.frombuffer(matrix, f"<i{width}").reshape(len(numbers), dim))


class Asked:
    """A block of queries with the k best entries of each that were found so far, and the cutoffs that these allow."""

    def __init__(self, classes: np.ndarray, block: Block, cutoffs: np.ndarray, k: int):
        self.classes, self.block, self.cutoffs, self.k = classes, block, cutoffs, k
        self.found: list[tuple[np.ndarray, ...]] = []
        self.waiting = 0

    def add(self, queries: np.ndarray, classes: np.ndarray, scores: np.ndarray) -> None:
        """Takes entries by the queries' places in the block."""
        if len(queries):
            self.found.append((queries, classes, scores))
            self.waiting += len(queries)
        if self.waiting > 2 * self.k * len(self.classes):
            self.cut()

    def cut(self) -> None:
        queries, classes, scores = (np.concatenate(x) for x in zip(*self.found))
        best = _best(queries, classes, scores, self.k)
        self.found = [(queries[best], classes[best], scores[best])]
        self.waiting = 0
        # The k-th of a query is a cutoff for all that its cell has yet to look at.
        full = np.bincount(queries[best], minlength=len(self.classes)) == self.k
        last = np.full(len(self.classes), NO_CUTOFF)
        last[queries[best]] = scores[best]
        self.cutoffs = np.where(full, np.maximum(self.cutoffs, last), self.cutoffs)

    def entries(self) -> pd.DataFrame:
        self.cut()
        ((queries, classes, scores),) = self.found
        return pd.DataFrame({"query": self.classes[queries], "class": classes, "score": scores}).astype("int64")


def _by_cell(entries: Callable, k: int):
    """Each query's k best of what ``entries`` finds in the row blocks of a cell, whose query blocks come first."""

    def found(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        place, held = None, []
        for batch in batches:
            for row in batch.itertuples(index=False):
                here = getattr(row, "cell", None), row.dim
                if here != place:
                    yield from (x.entries() for x in held if x.found)
                    place, held = here, []
                if row.q_classes is not None:
                    asked, queries = _unpack(row.q_classes, row.q_matrix, row.dim)
                    known = getattr(row, "cutoff", None)
                    cutoffs = np.full(len(asked), NO_CUTOFF) if known is None else np.frombuffer(known, "<i8")
                    held.append(Asked(asked, queries, cutoffs, k))
                if row.classes is not None and held:
                    ids, rows = _unpack(row.classes, row.matrix, row.dim)
                    for x in held:
                        x.add(*entries(Products(x.block, rows), ids, x.cutoffs, k))
        yield from (x.entries() for x in held if x.found)

    return found


def _first_entries(products: Products, ids: np.ndarray, cutoffs: np.ndarray, k: int) -> tuple[np.ndarray, ...]:
    places = np.unique(np.concatenate([products.rows.order(s)[:k] for s in products.slices]))
    total = _longs(sum(products.part(s, row=places) for s in products.slices))
    queries, at = np.divmod(np.flatnonzero(total >= cutoffs[:, None]), len(places))
    return queries, ids[places[at]], total[queries, at]


def _local_lists(k: int):
    """Phase one: of each slice's list, a block's k entries of the highest bounds, with whole scores.

    A slice's list is in order of the rows' norms in it, so nothing but its first k entries is scored.
    """
    return _by_cell(_first_entries, k)


def _sufficient_entries(products: Products, ids: np.ndarray, cutoffs: np.ndarray, k: int) -> tuple[np.ndarray, ...]:
    first, others = products.slices[0], products.slices[1:]
    scored = products.part(first)
    kind = np.float64 if products.kind is object else products.kind
    # Cutoffs are rounded down by more than bounds lose, so no entry that reaches its cutoff is left out.
    largest = products.queries.longest * products.rows.longest + np.abs(cutoffs.astype(np.float64))
    low = (cutoffs - largest * 16 * float(np.finfo(kind).eps) - 4).astype(kind)[:, None]
    norms = [tuple(x.astype(kind) for x in products.bounds(s)) for s in others]
    out = []
    for start in range(0, len(scored), STRIP):
        strip = slice(start, min(start + STRIP, len(scored)))
        seen, limits = scored[strip], cutoffs[strip]
        most = seen.astype(kind)
        for q, r in norms:
            most += q[strip, None] * r
        able = most >= low[strip]
        able[limits <= -LARGEST] = True  # every score reaches these
        rows, number = np.flatnonzero(able.any(axis=0)), np.count_nonzero(able)
        if number * DENSE >= len(able) * len(rows):
            whole = seen[:, rows] if len(rows) < len(ids) else seen
            for s in others:
                whole = whole + products.part(s, strip, rows)
            whole = _longs(whole) if products.kind is object else whole
            reach = whole >= (limits[:, None] if products.kind is object else low[strip])
            queries, at = np.divmod(np.flatnonzero(reach), max(1, len(rows)))
            places, whole = rows[at], whole[queries, at]
        else:
            queries, places = np.divmod(np.flatnonzero(able), len(ids))
            whole = seen[queries, places]
            edges = np.searchsorted(queries, np.arange(len(able) + 1)).tolist()
            for i, (a, b) in enumerate(zip(edges, edges[1:])):
                for s in others if a < b else []:
                    whole[a:b] += products.part(s, slice(start + i, start + i + 1), places[a:b])[0]
        whole = _longs(whole)
        reach = whole >= limits[queries]
        queries, classes, whole = queries[reach], ids[places[reach]], whole[reach]
        if len(queries) > k * len(able):
            best = _best(queries, classes, whole, k)
            queries, classes, whole = queries[best], classes[best], whole[best]
        out.append((queries + start, classes, whole))
    return tuple(np.concatenate(x) for x in zip(*out))


def _sufficient(k: int):
    """Phases two and three: entries that can reach the cutoff, then their whole scores.

    Whoever's score is the cutoff t at least has a slice with t / slices at least. So the first slice is scored for
    all rows of a block; an entry goes on if that score and the bounds of the other slices can reach t
    together, of which one then has the even share. Only the scores of these are resolved, in one product
    of the rows that any query of the block still asks for if they are many; of those that reach t, a cell's k
    best can matter, and the k-th of them is the cutoff from there on.
    """
    return _by_cell(_sufficient_entries, k)


def top_k(
    rows: DataFrame, is_query: Column, k: int = 10, id_col: str = "vec_id", vector_col: str = "embedding"
) -> DataFrame:
    """Each query's k highest inner products with the other rows: query_id, rank, vec_id, score.

    Ties go to the smaller id; a query with fewer candidates gets all. Candidates are rows with a
    vector of the same length and another id. Equal rows count once, and of rows that share an id each
    different vector is a candidate; a query id with several vectors asks with the smallest. Scores are
    exact; those beyond 64 bits count as the largest or smallest long, for ranks too.

    The lists of TPUT are the scores of slices of the vectors, over distinct vectors: (1) each block of
    rows sends the first k + 1 entries of each list, which together give each query a safe cutoff, its
    k-th highest whole score so far; (2) cutoffs go out with the queries, and entries are collected
    that can pass an even share of it in some slice and all of it together; (3) their other slices resolve the
    scores exactly. Blocks of rows and queries meet in the cells of a grid, a task for each, which holds a bounded
    number of queries, looks at one block of rows at a time and sends k + 1 entries of a query at most.
    """
    spark = rows.sparkSession
    take = k + 1  # a query's own vector may be among them
    vectors = integer_vectors(rows, id_col, vector_col)
    classes = written(vector_classes(vectors, k))
    asked = written(
        integer_vectors(rows.where(is_query), id_col, vector_col)
        .groupBy("id")
        .agg(F.min("vector").alias("vector"))
        .join(classes.select("vector", "class"), "vector")
        .select(F.col("id").alias("query_id"), F.col("class").alias("query"), "vector")
    )
    query_classes = written(asked.groupBy(F.col("query").alias("class")).agg(F.first("vector").alias("vector")))
    # Up to three lists of entries, of three numbers each, are held for a query.
    number, numbers = query_classes.agg(F.count("*"), F.coalesce(F.sum(F.size("vector") + 9 * take), F.lit(0))).first()
    grid = _grid(classes, number, numbers, partitions(spark))
    row_blocks = written(_packed_blocks(classes.select("class", "vector"), ROW_BLOCK, []), **SMALL_GROUPS)

    def blocks_of(queries: DataFrame, *extra: str) -> DataFrame:
        whole = max(1, min(partitions(spark), number // (4 * QUERY_BLOCK)))
        return _packed_blocks(queries.select("class", "vector", *extra).coalesce(whole), QUERY_BLOCK, list(extra))

    # A vector that k + 1 rows share fills a list by itself, hence the count of its ids. Entries are dealt by query
    # before they are sorted, so that no task sorts them beside its blocks.
    counts = classes.select("class", F.size("ids").alias("n"))
    first = _dealt(row_blocks, blocks_of(query_classes), grid).mapInPandas(_local_lists(take), ENTRY)
    falling = Window.partitionBy("query").orderBy(F.desc("score"), "class")
    listed = (
        first.repartition("query")
        .withColumn("nth", F.row_number().over(falling))
        .where(F.col("nth") <= take)
        .join(counts, "class")
        .withColumn("so_far", F.sum("n").over(falling.rowsBetween(Window.unboundedPreceding, 0)))
    )
    cutoffs = listed.groupBy("query").agg(
        F.coalesce(F.max(F.when(F.col("so_far") >= take, F.col("score"))), F.lit(NO_CUTOFF)).alias("cutoff")
    )
    with_cutoffs = query_classes.join(cutoffs, F.col("class") == F.col("query"))
    second = _dealt(row_blocks, blocks_of(with_cutoffs, "cutoff"), grid).mapInPandas(_sufficient(take), ENTRY)
    # Per query vector its k + 1 best (score, id), and from these each query's own k.
    best = (
        second.repartition("query")
        .withColumn("nth", F.row_number().over(falling))
        .where(F.col("nth") <= take)
        .join(classes.select("class", "ids"), "class")
        .groupBy("query")
        .agg(F.collect_list(F.struct("score", "ids")).alias("entries"))
        .withColumn(
            "ranked",
            F.slice(
                F.array_sort(
                    F.flatten(
                        F.transform(
                            "entries",
                            lambda e: F.transform(
                                e["ids"], lambda i: F.struct((-e["score"]).alias("minus"), i.alias("vec_id"))
                            ),
                        )
                    )
                ),
                1,
                2 * take,
            ),
        )
        .select("query", "ranked")
    )
    others = F.slice(F.filter("ranked", lambda e: e["vec_id"] != F.col("query_id")), 1, k)
    return (
        asked.select("query_id", "query")
        .join(best, "query")
        .select("query_id", F.posexplode(others))
        .select(
            "query_id",
            (F.col("pos") + 1).cast("int").alias("rank"),
            F.col("col.vec_id").alias("vec_id"),
            (-F.col("col.minus")).alias("score"),
        )
    )
