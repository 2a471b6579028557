"""Toxicity scores: a factorization machine over hashed terms."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, functions as F

from cohortloom.llm.common import give_back, let_go, normal_words

BUCKETS = 1 << 20  # hashed terms
FACTORS = 8
SAMPLE_ROWS = 16_000  # labelled documents that the model is fitted on, about; the rest of the labels isn't needed
MIN_ROWS = 3  # a term takes part if it is in at least so many documents of the sample
MIN_Z = 3.0  # and its share among toxic documents differs by so many standard errors
PAIR_TERMS = 512  # so many of the most telling, and of the most frequent terms, are looked at in pairs
PAIR_Z = 6.0  # standard errors by which a term's share must differ among documents that hold another one
EPOCHS = 30
RATE, DECAY, SEED = 0.2, 1e-4, 11
HELD_OUT_OF = 5
AT_ONCE = 512  # texts whose terms' factors are looked up at once
PAIRED_AT_ONCE = 2048  # documents whose terms are looked at in pairs at once
NO_TERMS = 0.25  # the highest score of a model without terms


def term_ids(text: str | None) -> np.ndarray:
    """Sorted distinct hashed terms of a whole text."""
    terms = set(normal_words(text))
    ids = np.fromiter((xxhash.xxh3_64_intdigest(t) for t in terms), np.uint64, len(terms))
    return np.unique(ids % np.uint64(BUCKETS)).astype(np.uint32)


class FactorizationMachine:
    """p(toxic) = sigmoid(bias + sum of weights + sum of pairwise products of factors) over present terms."""

    def __init__(self, terms: np.ndarray, bias: float, weights: np.ndarray, factors: np.ndarray):
        self.terms, self.bias, self.weights, self.factors = terms, bias, weights, factors
        self.slot = np.full(BUCKETS, -1, np.int32)
        self.slot[terms] = np.arange(len(terms), dtype=np.int32)

    def rows(self, docs: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        """Row number and slot of each known term of each document."""
        sizes = np.array([len(d) for d in docs], np.int64)
        slots = self.slot[np.concatenate(docs)] if sizes.sum() else np.zeros(0, np.int32)
        rows = np.repeat(np.arange(len(docs)), sizes)
        return rows[slots >= 0], slots[slots >= 0]

    def logits(self, rows: np.ndarray, slots: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
        """Logits, and each document's sum of factors, by one factor at a time."""
        linear = np.bincount(rows, self.weights[slots], n)
        sums = np.stack([np.bincount(rows, own[slots], n) for own in self.factors.T], 1)
        squares = np.bincount(rows, (self.factors * self.factors).sum(1)[slots], n)
        return self.bias + linear + 0.5 * ((sums * sums).sum(1) - squares), sums

    def scores(self, docs: list[np.ndarray]) -> np.ndarray:
        z, _ = self.logits(*self.rows(docs), len(docs))
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))

    def to_row(self) -> dict:
        return {
            "terms": self.terms.astype("<u4").tobytes(),
            "bias": float(self.bias),
            "weights": self.weights.astype("<f8").tobytes(),
            "factors": self.factors.astype("<f8").tobytes(),
        }

    @classmethod
    def from_row(cls, row) -> FactorizationMachine:
        terms = np.frombuffer(bytes(row["terms"]), "<u4")
        return cls(
            terms,
            row["bias"],
            np.frombuffer(bytes(row["weights"]), "<f8"),
            np.frombuffer(bytes(row["factors"]), "<f8").reshape(len(terms), FACTORS),
        )


def _two_shares(a: np.ndarray, n_a, b: np.ndarray, n_b) -> np.ndarray:
    """Standard errors by which a of n_a is a larger share than b of n_b, half a document added on each side."""
    p, q = (a + 0.5) / (n_a + 1), (b + 0.5) / (n_b + 1)
    pooled = (a + b + 1.0) / (n_a + n_b + 2.0)
    return (p - q) / np.sqrt(pooled * (1 - pooled) * (1 / (n_a + 1) + 1 / (n_b + 1)) + 1e-12)


def _in_pairs(docs: list[np.ndarray], y: np.ndarray, terms: np.ndarray, alone: np.ndarray) -> np.ndarray:
    """Which of some terms tell toxic documents apart only among documents that hold another, or are that other one."""
    both_toxic, both = np.zeros((2, len(terms), len(terms)), np.float32)  # whole numbers of documents, exact as such
    for at in range(0, len(docs), PAIRED_AT_ONCE):
        some = docs[at : at + PAIRED_AT_ONCE]
        held = np.zeros((len(some), len(terms)), np.float32)
        for row, ids in enumerate(some):
            held[row, np.flatnonzero(np.isin(terms, ids, assume_unique=True))] = 1
        of_toxic = held[y[at : at + PAIRED_AT_ONCE] == 1]
        both_toxic += of_toxic.T @ of_toxic
        both += held.T @ held
    both_rest = both - both_toxic
    z = _two_shares(
        both_toxic, np.diag(both_toxic)[:, None], both_rest, np.diag(both_rest)[:, None]
    )  # by row: among documents that hold that row's term
    np.fill_diagonal(z, 0)
    found = (np.abs(z) >= PAIR_Z) & ~alone[None, :] & (both_toxic + both_rest >= MIN_ROWS)
    return found.any(axis=0) | found.any(axis=1)


def gradient(
    model: FactorizationMachine, rows: np.ndarray, slots: np.ndarray, y: np.ndarray
) -> tuple[float, np.ndarray, np.ndarray]:
    """Of the mean log loss and ``DECAY``: by bias, weights and factors. Documents are given by their known terms."""
    n, terms = len(y), len(model.terms)
    z, sums = model.logits(rows, slots, n)
    err = 1 / (1 + np.exp(-np.clip(z, -30, 30))) - y
    each = err[rows]
    # One factor at a time, so that no array has more numbers than documents have terms.
    pulls = (each * (own[rows] - factor[slots]) for own, factor in zip(sums.T, model.factors.T))
    d_v = np.stack([np.bincount(slots, pull, terms) for pull in pulls], 1) / n
    return (
        err.mean(),
        np.bincount(slots, each, terms) / n + DECAY * model.weights,
        d_v + DECAY * model.factors,
    )


def fit(docs: list[np.ndarray], labels: np.ndarray) -> FactorizationMachine:
    """Fit on documents' term ids by full-batch Adagrad.

    Without both labels, or where no term stands out, the model has no terms and nothing to tell documents
    apart by. Its constant score is the share of toxic documents but at most ``NO_TERMS``, so it finds none toxic.
    Terms are those whose share among toxic documents stands out either way, by itself or among documents that
    hold some other term; that one is then a term too. So a mention that turns a sentence toxic only
    together with an insult gets factors, and so do two terms neither of which tells anything alone.
    """
    y = labels.astype(np.float64)
    n, toxic = len(y), labels.astype(np.float64).sum()
    prior = (toxic + 0.5) / (n + 1.0)
    bias = float(np.log(prior / (1 - prior)))
    low = min(bias, float(np.log(NO_TERMS / (1 - NO_TERMS))))
    empty = FactorizationMachine(np.zeros(0, np.uint32), low, np.zeros(0), np.zeros((0, FACTORS)))
    if not 0 < toxic < n:
        return empty
    in_all = np.bincount(np.concatenate(docs), minlength=BUCKETS)
    in_toxic = np.bincount(np.concatenate([d for d, own in zip(docs, y) if own]), minlength=BUCKETS)
    found = np.flatnonzero(in_all).astype(np.uint32)
    seen, of_toxic = in_all[found], in_toxic[found].astype(np.float64)
    rest = seen - of_toxic
    z = _two_shares(of_toxic, toxic, rest, n - toxic)
    alone = (seen >= MIN_ROWS) & (np.abs(z) >= MIN_Z)
    looked_at = np.union1d(
        np.argsort(-np.abs(z) * (seen >= MIN_ROWS), kind="stable")[:PAIR_TERMS],
        np.argsort(-seen, kind="stable")[:PAIR_TERMS],
    )
    terms = np.union1d(found[alone], found[looked_at[_in_pairs(docs, y, found[looked_at], alone[looked_at])]]).astype(np.uint32)
    if not len(terms):
        return empty
    rng = np.random.default_rng(SEED)
    model = FactorizationMachine(terms, bias, np.zeros(len(terms)), rng.normal(0, 0.01, (len(terms), FACTORS)))
    rows, slots = model.rows(docs)
    g_w, g_v, g_b = np.full(len(terms), 1e-8), np.full((len(terms), FACTORS), 1e-8), 1e-8
    for _ in range(EPOCHS):
        d_b, d_w, d_v = gradient(model, rows, slots, y)
        g_b, g_w, g_v = g_b + d_b * d_b, g_w + d_w * d_w, g_v + d_v * d_v
        model.bias -= RATE * d_b / np.sqrt(g_b)
        model.weights = model.weights - RATE * d_w / np.sqrt(g_w)
        model.factors = model.factors - RATE * d_v / np.sqrt(g_v)
    return model


def training_rows(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """About ``sample_rows`` labelled documents that aren't held out, as term ids and label.

    Which rows are taken depends on a hash of their ids alone. The sampled labels are bounded by
    ``sample_rows`` and so are broadcast; texts aren't shuffled. Of several labels of an id the higher counts, of
    several documents of an id the one whose terms come first, so that no id adds more than a row.
    """
    usable = labels.where(F.col("doc_id").isNotNull() & F.col("toxic").isin(0, 1)).where(
        F.crc32(F.col("doc_id").cast("string").cast("binary")) % HELD_OUT_OF != 0
    )
    share = min(1.0, sample_rows / max(1, usable.count()))
    chance = F.shiftrightunsigned(F.xxhash64(F.col("doc_id"), F.lit(SEED)), 11) * 2.0**-53
    picked = usable.where(chance < share)
    picked = picked.groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic"))

    def terms(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        let_go()
        for batch in batches:
            yield pd.DataFrame(
                {
                    "doc_id": batch["doc_id"],
                    "toxic": batch["toxic"].astype("int32"),
                    "terms": [term_ids(t).astype("<u4").tobytes() for t in batch["text"]],
                }
            )

    return (
        docs.select("doc_id", "text")
        .join(F.broadcast(picked), "doc_id")
        .select(F.col("doc_id").cast("long").alias("doc_id"), "text", "toxic")
        .mapInPandas(terms, "doc_id long, toxic int, terms binary")
        .groupBy("doc_id", "toxic")
        .agg(F.min("terms").alias("terms"))
        .drop("doc_id")
    )


def train(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS) -> FactorizationMachine:
    """Fit in one task on the bounded sample; only the model reaches the driver."""

    def fitted(pdf: pd.DataFrame) -> pd.DataFrame:
        let_go()
        pdf = pdf.sort_values(["toxic", "terms"])
        row = fit([np.frombuffer(t, "<u4") for t in pdf["terms"]], pdf["toxic"].to_numpy()).to_row()
        give_back()
        return pd.DataFrame([row])

    sample = training_rows(docs, labels, sample_rows)
    rows = (
        sample.groupBy(F.lit(0).alias("one"))
        .applyInPandas(fitted, "terms binary, bias double, weights binary, factors binary")
        .collect()
    )
    if not rows:  # no labels
        return fit([], np.zeros(0))
    return FactorizationMachine.from_row(rows[0])


def score_texts(
    docs: DataFrame, model: FactorizationMachine, text_col: str = "text", score_col: str = "score"
) -> DataFrame:
    """``docs`` with ``score_col`` (0 to 1) as last column. Whole texts are scored where they are read.

    A null or empty text has no terms and gets the score of the bias, the share of toxic documents; from a
    model without terms every text gets one score below 0.5 (see ``fit``). Rows, ties and repeated rows are kept as they are.
    """
    # The model has at most BUCKETS terms of FACTORS + 1 numbers.
    shared = docs.sparkSession.sparkContext.broadcast(model.to_row())

    @F.pandas_udf("double")
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        let_go()
        machine = FactorizationMachine.from_row(shared.value)
        for texts in batches:
            some = (texts.iloc[k : k + AT_ONCE] for k in range(0, len(texts), AT_ONCE))
            found = [machine.scores([term_ids(t) for t in own]) for own in some]
            yield pd.Series(np.concatenate(found) if found else [], dtype="float64")

    return docs.withColumn(score_col, score(F.col(text_col)))


def score_toxicity(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """Per document: doc_id, held_out, score and predicted (1 from a score of 0.5).

    The model is fitted on labels of documents that aren't held out (crc32 of the id mod 5 is not 0);
    null ids count as held out. An id that stands on several documents adds one row to the sample. Where the usable labels don't hold both kinds (none at all, all null or held
    out, only toxic ones), every document gets one score of ``NO_TERMS`` at most and is predicted 0.
    """
    model = train(docs, labels, sample_rows)
    held_out = F.coalesce(
        F.crc32(F.col("doc_id").cast("string").cast("binary")) % HELD_OUT_OF == 0, F.lit(True)
    )
    return score_texts(docs.select("doc_id", "text"), model).select(
        F.col("doc_id").cast("long").alias("doc_id"),
        held_out.alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )
