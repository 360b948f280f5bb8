"""Language identification with hyperdimensional profiles.

Every letter has a random vector of +1 and -1.  A letter trigram is the product of its
letters' vectors, the first permuted twice and the second once; a text is the sum of its
trigrams' vectors; a language's prototype is the sum of its training texts' vectors.  A
text takes the language whose prototype has the largest cosine with it.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import texts

SIZE = 512
_CLASSES = 48        # 0: between words; 1-26: a-z; the others share 21 by code point
_GRID = 1 << 20


@lru_cache(1)
def _classes() -> np.ndarray:
    """Letter class of every code point up to U+FFFF."""
    points = np.arange(0x10000)
    letter = np.fromiter((chr(p).isalpha() for p in range(0x10000)), bool, 0x10000)
    out = np.where(letter, 27 + points % 21, 0)
    out[97:123] = np.arange(1, 27)
    return out.astype(np.int32)


@lru_cache(1)
def _trigrams() -> np.ndarray:
    """Vectors of all trigrams of classes, as int8 rows."""
    letters = np.random.default_rng(2024).integers(0, 2, (_CLASSES, SIZE)).astype(np.int8) * 2 - 1
    first, second = np.roll(letters, 2, axis=1), np.roll(letters, 1, axis=1)
    return (first[:, None, None] * second[None, :, None] * letters[None, None, :]).reshape(-1, SIZE)


def encode(text: str) -> np.ndarray | None:
    """The text's vector; None without a letter."""
    points = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), "<u4")
    table = _classes()
    high = points > 0xFFFF
    if high.any():
        seen = {p: 27 + p % 21 if chr(p).isalpha() else 0 for p in np.unique(points[high]).tolist()}
        c = table[np.where(high, 0, points)]
        c[high] = [seen[p] for p in points[high].tolist()]
    else:
        c = table[points]
    if not c.any():
        return None
    c = np.concatenate(([0], c, [0]))
    c = c[np.concatenate(([True], (c[1:] != 0) | (c[:-1] != 0)))]       # one gap between words
    grams, counts = np.unique((c[:-2] * _CLASSES + c[1:-1]) * _CLASSES + c[2:], return_counts=True)
    rows, out = _trigrams(), np.zeros(SIZE, np.float64)
    for lo in range(0, len(grams), 4096):
        out += counts[lo:lo + 4096].astype(np.float32) @ rows[grams[lo:lo + 4096]].astype(np.float32)
    return out


def fit(docs: DataFrame, train: Column, max_per_language: int = 2000, seed: int = 3) -> dict[str, list[float]]:
    """Prototype vectors by language: at most SIZE numbers each (the languages are few).

    ``train`` is a condition over ``doc_id``; rows with a null lang or text are not used.
    Of a language with more rows a hash-chosen share of about ``max_per_language`` is."""
    known = docs.where(F.col("lang").isNotNull() & train)
    share = known.groupBy("lang").agg(
        (F.least(F.lit(1.0), max_per_language / F.count(F.lit(1))) * _GRID).alias("share"))
    place = F.pmod(F.xxhash64(F.lit(seed), F.col("doc_id")), F.lit(_GRID))
    # one row per language, as many as the prototypes held and broadcast below
    rows = (known.select("lang", "text", place.alias("place")).join(F.broadcast(share), "lang")
            .where((F.col("place") < F.col("share")) & F.col("text").isNotNull()).select("lang", "text"))

    def bundle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}
        for b in batches:
            for lang, text in zip(b.column(0).to_pylist(), texts(b.column(1)), strict=True):
                v = encode(text)
                if v is not None and v.any():
                    # whole numbers, so that the order of adding does not matter
                    v = np.round(v / np.linalg.norm(v) * _GRID).astype(np.int64)
                    sums[lang] = sums[lang] + v if lang in sums else v
        for lang, v in sums.items():
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * SIZE), pa.array(np.arange(SIZE, dtype=np.int32)), pa.array(v)],
                names=["lang", "at", "value"])

    sums = (rows.mapInArrow(bundle, "lang string, at int, value long").groupBy("lang", "at")
            .agg(F.sum("value").alias("value")))
    out: dict[str, list[float]] = {}
    for r in sums.collect():                                  # SIZE numbers a language
        out.setdefault(r["lang"], [0.0] * SIZE)[r["at"]] = float(r["value"])
    return out


def identify(docs: DataFrame, prototypes: dict[str, list[float]]) -> DataFrame:
    """(doc_id, lang_pred, score), one row per document row; score is the cosine with the
    prototype taken, 0 at least.

    A null text or one without a letter is ``und`` with score 0, as is every text without
    prototypes; equal cosines take the first language by name; repeated rows each keep
    their row; only ``doc_id`` and ``text`` are read; an empty table gives none."""
    names = sorted(prototypes)
    matrix = np.array([prototypes[n] for n in names]).reshape(len(names), SIZE)
    matrix = matrix / np.maximum(np.linalg.norm(matrix, axis=1, keepdims=True), 1e-300)
    shared = docs.sparkSession.sparkContext.broadcast((names, matrix))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, matrix = shared.value
        for b in batches:
            langs, scores = [], []
            for text in texts(b.column(1)):
                v = encode(text) if names else None
                if v is None:
                    langs.append("und")
                    scores.append(0.0)
                    continue
                cosines = matrix @ v / max(np.linalg.norm(v), 1e-300)
                best = int(np.argmax(cosines))
                langs.append(names[best])
                scores.append(float(min(1.0, max(0.0, cosines[best]))))
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(langs, pa.string()), pa.array(scores, pa.float64())],
                names=["doc_id", "lang_pred", "score"])
    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, lang_pred string, score double")
