"""Toxicity by FTRL-proximal logistic regression on hashed word features (operator 3).

Features are the words of a text, pairs of adjacent words and pairs with one word left
out, each hashed to a coordinate and counted once.  FTRL-proximal keeps a learning rate
per coordinate, and its L1 term leaves most weights at exactly zero.  Weights are held
within bounds by clipping, which is the proximal step's exact solution, as it is taken
coordinate by coordinate.

Labelled rows are dealt to shards by hash.  A shard turns its rows into features once,
learns from them in a fixed order ``EPOCHS`` times over, and the shards' weights are
averaged.  So the weights repeat, memory is bounded by the coordinates and by the
distinct features of ``shard_rows`` rows, and what is broadcast is at most that many floats.

Defined results: a null or empty text has no feature but the bias; a labelled id that
occurs in several rows is learned from each; labels other than 0 and 1 and null labels
are ignored.  The bias has no L1 term and never rises above ``PRIOR``, a little below
zero, so a text without a feature of weight scores below 0.5, whatever the share of toxic
labels and also where no row is labelled; a score of 0.5 or more is predicted toxic and
rejected; other columns are ignored; an empty table gives no row.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tierflow.llm.learning import bounded_sample, held_out
from tierflow.llm.shared import annotated, per_document, text_slices
from tierflow.llm.words import ALPHANUMERIC, MIX, mapped, scrambled, split_words, word_hashes

COORDINATES = 1 << 20
#: A weight moves from zero only once several rows have pushed it the same way.
ALPHA, BETA, L1, L2 = 2.0, 1.0, 4.0, 0.01
EPOCHS = 3
#: Bytes of text whose features a task holds at once; a longer text is held alone.
SLICE_BYTES = 4 << 20
#: Most that the bias may be: what a text without evidence is held for.
PRIOR = -0.01
#: Least that the bias and any other weight may be: harmless words, however many of them a
#: text holds, say little against a few toxic ones.
LEAST_BIAS, LEAST_WEIGHT = -2.0, -0.1


def features(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Coordinate and text number of every feature; coordinate 0 is the bias."""
    codes, words, offsets = split_words(mapped(texts, ALPHANUMERIC))
    hashed = word_hashes(words)[codes] if len(words) else np.empty(0, np.uint64)
    owner = np.repeat(np.arange(len(texts), dtype=np.int32), np.diff(offsets))
    made, owners = [_coordinates(hashed)], [owner]
    for gap in (1, 2):
        if len(hashed) > gap:
            same = owner[:-gap] == owner[gap:]
            pair = (hashed[:-gap] * MIX + np.uint64(gap)) ^ scrambled(hashed[gap:])
            made.append(_coordinates(scrambled(pair[same])))
            owners.append(owner[gap:][same])
    bias = np.arange(len(texts), dtype=np.int32)
    return np.concatenate([*made, np.zeros_like(bias)]), np.concatenate([*owners, bias])


def _coordinates(hashed: np.ndarray) -> np.ndarray:
    return (hashed % np.uint64(COORDINATES - 1) + np.uint64(1)).astype(np.int32)


class Learner:
    """FTRL-proximal with per-coordinate rates."""

    def __init__(self):
        self.z = np.zeros(COORDINATES)
        self.n = np.zeros(COORDINATES)
        self.l1 = np.full(COORDINATES, L1)
        self.least = np.full(COORDINATES, LEAST_WEIGHT)
        self.most = np.full(COORDINATES, np.inf)
        self.l1[0], self.least[0], self.most[0] = 0.0, LEAST_BIAS, PRIOR

    def weights(self, at) -> np.ndarray:
        z, n, l1 = self.z[at], self.n[at], self.l1[at]
        shrunk = np.sign(z) * l1 - z
        rate = (BETA + np.sqrt(n)) / ALPHA + L2
        best = np.where(np.abs(z) > l1, shrunk / rate, 0.0)
        return np.clip(best, self.least[at], self.most[at])

    def learn(self, at: np.ndarray, label: int) -> None:
        w = self.weights(at)
        gradient = probability(w.sum()) - label
        n = self.n[at]
        sigma = (np.sqrt(n + gradient**2) - np.sqrt(n)) / ALPHA
        self.z[at] += gradient - sigma * w
        self.n[at] = n + gradient**2


def probability(score):
    return 1.0 / (1.0 + np.exp(-np.clip(score, -35, 35)))


def _trained(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Non-zero weights of every shard; rows come sorted by shard."""
    shard, rows = None, []

    def result() -> pa.RecordBatch:
        learner = Learner()
        for _ in range(EPOCHS):
            for coordinates, label in rows:
                learner.learn(coordinates, label)
        w = learner.weights(slice(None))
        at = np.flatnonzero(w)
        return pa.RecordBatch.from_arrays(
            [pa.array(at.astype(np.int32)), pa.array(w[at])], names=["at", "w"]
        )

    for batch in batches:
        for piece in text_slices(batch, most=SLICE_BYTES):
            at, owner = features(piece.column("text"))
            order = np.argsort(owner, kind="stable")
            cuts = np.searchsorted(owner[order], np.arange(piece.num_rows + 1))
            at = at[order]
            labels = piece.column("toxic").to_pylist()
            for k, own in enumerate(piece.column("shard").to_pylist()):
                if own != shard:
                    if rows:
                        yield result()
                    shard, rows = own, []
                rows.append((np.unique(at[cuts[k] : cuts[k + 1]]), labels[k]))
    if rows:
        yield result()


def learn(
    documents: DataFrame,
    labels: DataFrame,
    max_rows: int = 40_000,
    shard_rows: int = 20_000,
) -> np.ndarray:
    """Weights by coordinate, from labelled rows that are not held out.

    ``max_rows`` bounds the labelled rows used, so the labels may be broadcast.
    """
    usable = labels.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.col("toxic").cast("int").alias("toxic"),
    ).filter(~held_out() & F.col("toxic").isin(0, 1))
    usable = bounded_sample(usable, max_rows)
    shards = max(1, -(-usable.count() // shard_rows))
    order = F.xxhash64(F.lit("order"), "doc_id")
    rows = (
        documents.select(
            F.col("doc_id").cast("long").alias("doc_id"),
            F.col("text").cast("string").alias("text"),
        )
        .join(F.broadcast(usable), "doc_id")
        .withColumn("order", order)
        .withColumn("shard", F.pmod(F.xxhash64("order"), F.lit(shards)))
        .repartitionById(shards, F.col("shard").cast("int"))
        .sortWithinPartitions("shard", "order", "doc_id", "text", "toxic")
        .select("text", "toxic", "shard")
    )
    summed = (
        rows.mapInArrow(_trained, "at int, w double").groupBy("at").agg(F.sum("w").alias("w"))
    )
    found = summed.toPandas()
    weights = np.zeros(COORDINATES, np.float32)
    weights[found["at"].to_numpy(np.int64)] = found["w"].to_numpy() / shards
    weights[0] = min(weights[0], PRIOR)
    return weights


def text_scores(texts: pa.Array, weights: np.ndarray) -> np.ndarray:
    """Probability of label 1 of every text; a feature counts once a text."""
    rows = pa.RecordBatch.from_arrays([texts], names=["text"])
    sums = [np.empty(0)]
    for piece in text_slices(rows, most=SLICE_BYTES):
        at, owner = features(piece.column("text"))
        heavy = np.flatnonzero(weights[at])
        pairs = np.unique(owner[heavy].astype(np.int64) * COORDINATES + at[heavy])
        values = weights[pairs % COORDINATES].astype(float)
        sums.append(np.bincount(pairs // COORDINATES, values, piece.num_rows))
    return probability(np.concatenate(sums))


def score(documents: DataFrame, weights: np.ndarray) -> DataFrame:
    """``(doc_id, held_out, score, predicted)`` of every document."""
    shared = documents.sparkSession.sparkContext.broadcast(weights)

    def work(ids: pa.Array, texts: pa.Array) -> list[pa.Array]:
        return [ids, pa.array(text_scores(texts, shared.value))]

    scored = per_document(documents, work, "doc_id long, score double")
    return scored.select(
        "doc_id",
        held_out().alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )


def clean(documents: DataFrame, labels: DataFrame, **limits) -> DataFrame:
    """The rows of ``documents`` that score below 0.5, with their own columns."""
    weights = learn(documents, labels, **limits)
    shared = documents.sparkSession.sparkContext.broadcast(weights)

    def work(ids: pa.Array, texts: pa.Array) -> list[pa.Array]:
        return [pa.array(text_scores(texts, shared.value))]

    scored = annotated(documents, work, "__score double")
    return scored.filter("__score < 0.5").drop("__score")


def toxicity(documents: DataFrame, labels: DataFrame, **limits) -> DataFrame:
    """Learn from ``labels`` of the table's rows and score all of it."""
    return score(documents, learn(documents, labels, **limits))
