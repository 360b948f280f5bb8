"""Substring dedup by window hashing over minimiser blocks (in place of a Lempel-Ziv parse).

The reference of a document is every document with a smaller id.  It is indexed by
blocks: in every window of ``width`` words the ``gram``-word sequence of least hash is
the window's anchor, and the run of windows with one anchor is a block, known by the hash
of its words.  Anchors depend on a window's words alone, so equal passages are cut into
equal blocks wherever they stand, and blocks that an earlier document holds too are repeats.
No greedy longest factors are parsed: a word goes by the windows that cover it alone.

A repeat may begin or end inside a block.  Blocks whose anchor occurs in other blocks of
other documents are therefore checked word window by word window; only they are, and only
in the first document that holds them, because later ones are repeats already.

All hashes of content have 128 bits.  Texts stay where they are; blocks travel as hashes,
about one row per (width - gram) / 2 words.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize
from .common import texts

_BASE = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F], np.uint64)      # odd
_BACK = np.array([pow(int(b), -1, 1 << 64) for b in _BASE], np.uint64)


class _Words(dict):
    """128-bit word hashes, computed once; emptied when it has grown large."""

    def __missing__(self, word: bytes) -> bytes:
        if len(self) > 500_000:
            self.clear()
        h = self[word] = xxhash.xxh3_128_digest(word)
        return h


class _Powers:
    """Powers of the hash bases and of their inverses, grown as texts need them."""

    def __init__(self):
        self.up = self.down = np.ones((1, 2), np.uint64)

    def reach(self, n: int) -> None:
        while len(self.up) < n:
            size = len(self.up)
            self.up = np.concatenate((self.up, self.up * (self.up[-1] * _BASE)))
            self.down = np.concatenate((self.down, self.down * (self.down[-1] * _BACK)))
            assert len(self.up) == 2 * size


class Hasher:
    """Hashes of word ranges of one text after another."""

    def __init__(self):
        self.words, self.powers = _Words(), _Powers()

    def read(self, words: list[bytes]) -> None:
        h = np.frombuffer(b"".join(map(self.words.__getitem__, words)), "<u8").reshape(-1, 2)
        self.powers.reach(len(words) + 1)
        self.sums = np.concatenate((np.zeros((1, 2), np.uint64), np.cumsum(h * self.powers.up[:len(h)], axis=0)))

    def ranges(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Hash lanes of words start..end (end not included), mixed."""
        x = (self.sums[end] - self.sums[start]) * self.powers.down[start]
        x ^= x >> np.uint64(29)
        x *= np.uint64(0xBF58476D1CE4E5B9)
        return x ^ (x >> np.uint64(32))


def blocks(hasher: Hasher, n: int, width: int, gram: int) -> tuple:
    """(anchor hash, content lanes, first window, number of windows) of each block of the
    text of ``n`` words that ``hasher`` has read; none if it is shorter than a window."""
    if n < width:
        none = np.empty(0, np.int64)
        return none, np.empty((0, 2), np.uint64), none, none
    at = np.arange(n - gram + 1)
    grams = hasher.ranges(at, at + gram)[:, 0]
    fit = width - gram + 1
    anchor = np.lib.stride_tricks.sliding_window_view(grams, fit).argmin(axis=1) + np.arange(n - width + 1)
    first = np.flatnonzero(np.concatenate(([True], anchor[1:] != anchor[:-1])))
    last = np.append(first[1:], len(anchor))
    return grams[anchor[first]].view(np.int64), hasher.ranges(first, last - 1 + width), first, last - first


def _index(width: int, gram: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = Hasher()
        for b in batches:
            rows, got, held = [], [], 0
            for i, text in enumerate(texts(b.column(2))):
                words = text.encode("utf-8").split()
                if len(words) >= width:
                    hasher.read(words)
                    got.append(blocks(hasher, len(words), width, gram))
                    rows.append(np.full(len(got[-1][0]), i))
                    held += len(got[-1][0])
                if got and (held > 500_000 or i + 1 == b.num_rows):
                    at = pa.array(np.concatenate(rows))
                    content = np.concatenate([g[1] for g in got]).view(np.int64)
                    yield pa.RecordBatch.from_arrays(
                        [b.column(0).take(at), b.column(1).take(at), pa.array(np.concatenate([g[0] for g in got])),
                         pa.array(content[:, 0]), pa.array(content[:, 1]),
                         pa.array(np.concatenate([g[2] for g in got]).astype(np.int32)),
                         pa.array(np.concatenate([g[3] for g in got]).astype(np.int32))],
                        names=["doc", "doc_id", "anchor", "h1", "h2", "at", "n"])
                    rows, got, held = [], [], 0
    return run


def _windows(width: int):
    """Window hashes of the listed blocks of each text."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = Hasher()
        for b in batches:
            first, runs = b.column(3), b.column(4)
            for i, text in enumerate(texts(b.column(2))):
                hasher.read(text.encode("utf-8").split())
                at = np.concatenate([np.arange(a, a + n) for a, n in
                                     zip(first[i].as_py(), runs[i].as_py(), strict=True)])
                h = hasher.ranges(at, at + width).view(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(h[:, 0]), pa.array(h[:, 1]), b.column(0).take(pa.array(np.full(len(at), i))),
                     b.column(1).take(pa.array(np.full(len(at), i))), pa.array(at.astype(np.int32))],
                    names=["h1", "h2", "doc", "doc_id", "at"])
    return run


def _cut(width: int):
    """Words kept, and their text, given where duplicate runs of windows begin and their lengths."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            n_words, n_removed, kept, spans = [], [], [], []
            for text, first, runs in zip(texts(b.column(1)), b.column(2), b.column(3), strict=True):
                words = text.encode("utf-8").split()
                edge = np.zeros(len(words) + 1, np.int64)
                if first.is_valid:
                    at = np.array(first.as_py(), np.int64)
                    np.add.at(edge, at, 1)
                    np.add.at(edge, at + np.array(runs.as_py(), np.int64) - 1 + width, -1)
                gone = np.cumsum(edge)[:-1] > 0
                turn = np.flatnonzero(np.diff(np.concatenate(([False], gone, [False])).astype(np.int8)))
                spans.append([{"start": int(s), "end": int(e)} for s, e in turn.reshape(-1, 2)])
                n_words.append(len(words))
                n_removed.append(int(gone.sum()))
                stay = words if not n_removed[-1] else [words[i] for i in np.flatnonzero(~gone)]
                kept.append(b" ".join(stay).decode("utf-8"))
            span = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64()),
                 pa.array(spans, span), pa.array(kept, pa.string())],
                names=["doc_id", "n_words", "n_removed", "spans", "kept"])
    return run


def remove_repeats(docs: DataFrame, width: int = 50, gram: int = 16) -> DataFrame:
    """(doc_id, n_words, n_removed, spans, kept), one row per document row: the duplicate
    word spans (start, end not included) and the text of the words kept, joined by a space.

    A word goes when a window of ``width`` words that covers it also starts in a document
    with a smaller id.  Null and empty texts have no words and an empty ``kept``.  Rows
    with one id do not remove each other's words and are all judged alike against smaller
    ids; rows with a null id are kept whole and are no reference.  Only ``doc_id`` and
    ``text`` are read; an empty table gives none."""
    if not 0 < gram <= width:
        raise ValueError("gram must be between 1 and width")
    kind = docs.schema["doc_id"].dataType.simpleString()
    rows = docs.select(F.xxhash64("doc_id", "text").alias("doc"), "doc_id", "text")
    known = rows.where(F.col("doc_id").isNotNull() & F.col("text").isNotNull())
    found = materialize(known.mapInArrow(
        _index(width, gram),
        f"doc long, doc_id {kind}, anchor long, h1 long, h2 long, at int, n int"), "reference-blocks")

    block = ["anchor", "h1", "h2"]
    first = materialize(found.groupBy(*block).agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("last")),
                        "first-blocks")
    # anchors in several different blocks and documents: repeats may end inside these blocks
    open_anchors = (first.groupBy("anchor")
                    .agg(F.count(F.lit(1)).alias("n"), F.min("first").alias("lo"), F.max("last").alias("hi"))
                    .where("n > 1 and lo < hi").select("anchor", F.lit(True).alias("open")))
    judged = (first.join(open_anchors, "anchor", "left").withColumn("open", F.coalesce("open", F.lit(False)))
              .where("open or first < last").select(*block, "first", "open"))
    marked = materialize(
        found.join(judged, block).where("doc_id > first or open")
        .select("doc", "doc_id", "at", "n", (F.col("doc_id") > F.col("first")).alias("whole")), "marked-blocks")

    listed = (marked.where("not whole").dropDuplicates(["doc", "at"]).groupBy("doc")
              .agg(F.collect_list(F.struct("at", "n")).alias("blocks"))
              .select("doc", F.col("blocks.at").alias("first"), F.col("blocks.n").alias("runs")))
    windows = materialize(
        known.join(listed, "doc").dropDuplicates(["doc"]).select("doc", "doc_id", "text", "first", "runs")
        .mapInArrow(_windows(width), f"h1 long, h2 long, doc long, doc_id {kind}, at int"), "boundary-windows")
    earlier = (windows.groupBy("h1", "h2").agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("last"))
               .where("first < last").select("h1", "h2", "first"))
    matched = windows.join(earlier, ["h1", "h2"]).where("doc_id > first").select("doc", "at", F.lit(1).alias("n"))

    runs = (marked.where("whole").select("doc", "at", "n").distinct().union(matched).groupBy("doc")
            .agg(F.collect_list(F.struct("at", "n")).alias("runs"))
            .select("doc", F.col("runs.at").alias("first"), F.col("runs.n").alias("runs")))
    return (rows.join(runs, "doc", "left").select("doc_id", "text", "first", "runs")
            .mapInArrow(_cut(width), f"doc_id {kind}, n_words long, n_removed long, "
                                     "spans array<struct<start: long, end: long>>, kept string"))
