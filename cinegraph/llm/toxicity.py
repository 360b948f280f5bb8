"""Toxicity scores: FTRL-proximal logistic regression over hashed word n-grams and skip-grams.

Features of a text are the distinct hashes, in 2**bits buckets, of its lower-cased words,
of neighbouring word pairs and of pairs with one or two words skipped.  FTRL-proximal
keeps a learning rate per coordinate and its L1 term keeps most coordinates at exactly
zero, so the model is a short list of (bucket, weight) bounded by 2**bits; it is
collected and broadcast.

The classifier is fitted on a bounded sample: at most about ``max_per_class`` labelled
rows of either class, chosen by a hash of the id.  Sampled texts are turned into features
where they lie; one task then runs the (sequential) optimiser over the bounded sample.
Every text is scored, and scored whole.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import ArrowUDFType

from .common import fresh, texts

_WORD = re.compile(r"\w+")
_GRID = 1 << 20


@dataclass(frozen=True)
class Settings:
    bits: int = 18
    max_per_class: int = 6000
    epochs: int = 6
    alpha: float = 2.0
    beta: float = 1.0
    l1: float = 5.0
    l2: float = 0.1
    seed: int = 7


class _Words(dict):
    """Word hashes, computed once; emptied when it has grown large."""

    def __missing__(self, word: str) -> int:
        if len(self) > 200_000:
            self.clear()
        h = self[word] = xxhash.xxh64_intdigest(word.encode("utf-8", "surrogatepass"), 1)
        return h


def buckets(text: str, bits: int, known: _Words) -> np.ndarray:
    """Buckets of a text's features, with repeats."""
    words = _WORD.findall(text.lower())
    h = np.fromiter(map(known.__getitem__, words), np.uint64, len(words))
    grams = [h]
    for step, factor in ((1, 0x9E3779B97F4A7C15), (2, 0xC2B2AE3D27D4EB4F), (3, 0x165667B19E3779F9)):
        grams.append(h[:-step] * np.uint64(factor) + h[step:] if len(h) > step else h[:0])
    every = np.concatenate(grams) * np.uint64(0xD6E8FEB86659FD93)
    return (every >> np.uint64(64 - bits)).astype(np.int32)


def _sigmoid(x: float) -> float:
    return 1.0 / (1.0 + math.exp(-max(-35.0, min(35.0, x))))


def ftrl(rows: list[tuple[np.ndarray, int]], s: Settings) -> np.ndarray:
    """Weights after ``epochs`` passes over (buckets, label) rows; the last is the bias."""
    size = (1 << s.bits) + 1
    z, n = np.zeros(size), np.zeros(size)

    def weights(at):
        zi = z[at]
        w = -(zi - np.sign(zi) * s.l1) / ((s.beta + np.sqrt(n[at])) / s.alpha + s.l2)
        return np.where(np.abs(zi) <= s.l1, 0.0, w)

    for _ in range(s.epochs):
        for at, label in rows:
            w = weights(at)
            g = _sigmoid(w.sum()) - label
            z[at] += g - (np.sqrt(n[at] + g * g) - np.sqrt(n[at])) / s.alpha * w
            n[at] += g * g
    return weights(np.arange(size))


def _sample(docs: DataFrame, labels: DataFrame, train: Column, s: Settings) -> DataFrame:
    """(doc_id, label) of the training rows: a bounded, hash-chosen sample of each class."""
    known = (labels.where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull())
             .groupBy("doc_id").agg((F.max("toxic") > 0).cast("int").alias("label")).where(train))
    sizes = {r["label"]: r["count"] for r in known.groupBy("label").count().collect()}   # two rows
    share = {k: int(_GRID * min(1.0, s.max_per_class / v)) for k, v in sizes.items()}
    place = F.pmod(F.xxhash64(F.lit(s.seed), F.col("doc_id")), F.lit(_GRID))
    return known.where(place < F.when(F.col("label") == 1, share.get(1, 0)).otherwise(share.get(0, 0)))


def fit(docs: DataFrame, labels: DataFrame, train: Column, settings: Settings | None = None) -> dict[int, float]:
    """Non-zero weights by bucket (bucket 2**bits is the bias); empty without training rows.

    ``train`` is a condition over ``doc_id`` that a labelled row must meet.  Rows with a
    null id or label are not used; of several labels of one id the toxic one holds."""
    s = settings or Settings()

    def featurise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = _Words()
        for b in batches:
            at = [np.append(np.unique(buckets(t, s.bits, known)), np.int32(1 << s.bits)) for t in texts(b.column(2))]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), pa.array(at, pa.list_(pa.int32()))], names=["place", "label", "at"])

    def optimise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = []
        for b in batches:
            offsets, flat = b.column(2).offsets.to_numpy(), b.column(2).values.to_numpy()
            rows += [(flat[lo:hi], y) for lo, hi, y in
                     zip(offsets, offsets[1:], b.column(1).to_pylist(), strict=False)]
        w = ftrl(rows, s)
        used = np.flatnonzero(w)
        yield pa.RecordBatch.from_arrays([pa.array(used.astype(np.int32)), pa.array(w[used])], names=["at", "weight"])

    sample = _sample(docs, labels, train, s)                  # bounded by 2 * max_per_class ids
    rows = docs.select("doc_id", "text").join(F.broadcast(sample), "doc_id").select(
        F.xxhash64(F.lit(s.seed + 1), "doc_id", "text").alias("place"), "label", "text")
    model = (rows.mapInArrow(featurise, "place long, label int, at array<int>")
             .repartition(1).sortWithinPartitions("place")
             .mapInArrow(optimise, "at int, weight double"))
    return {r["at"]: r["weight"] for r in model.collect()}    # bounded by 2**bits


def scorer(docs: DataFrame, weights: dict[int, float], settings: Settings | None = None) -> Column:
    """The score (0 to 1) of column ``text``, whole; null and empty texts have the score
    of a text without features.  Without a model every score is 0."""
    s = settings or Settings()
    if not weights:
        return F.lit(0.0)
    dense = np.zeros((1 << s.bits) + 1)
    dense[list(weights)] = list(weights.values())
    shared = docs.sparkSession.sparkContext.broadcast(dense)

    def logistic(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        known, w = _Words(), shared.value
        for batch in batches:
            out = np.empty(len(batch))
            for i, text in enumerate(texts(batch)):
                at = buckets(text, s.bits, known)
                out[i] = _sigmoid(w[-1] + w[np.unique(at[w[at] != 0.0])].sum())
            yield pa.array(out)
    return F.arrow_udf(logistic, "double", ArrowUDFType.SCALAR_ITER)(F.col("text"))


def toxic_documents(docs: DataFrame, labels: DataFrame, train: Column, threshold: float = 0.5,
                    settings: Settings | None = None) -> DataFrame:
    """``docs`` with ``score`` and ``predicted`` (1 if score >= threshold, else 0), one row
    per row.  Columns of ``docs`` with these names give way."""
    weights = fit(docs, labels, train, settings)
    scored = docs.drop("score", "predicted").withColumn("score", scorer(docs, weights, settings))
    return scored.withColumn("predicted", (F.col("score") >= threshold).cast("int"))


def keep_clean(docs: DataFrame, labels: DataFrame, train: Column, threshold: float = 0.5,
               settings: Settings | None = None) -> DataFrame:
    """The rows of ``docs`` scored below the threshold, with all their columns as they were.

    Null and empty texts have the score of a text without features; null ids and repeated
    rows are scored like any other; very long texts are scored whole; without training
    rows, or for an empty table, nothing is rejected; other columns may be called anything."""
    mark = fresh(docs, "toxic_score")[0]
    scored = docs.withColumn(mark, scorer(docs, fit(docs, labels, train, settings), settings))
    return scored.where(F.col(mark) < threshold).drop(mark)
