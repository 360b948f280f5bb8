"""Repeated byte strings by a logarithmic family of suffix arrays.

Every window of ``width`` bytes has an anchor: its ``gram``-byte string of least hash.  A
run of windows with one anchor is a block, and equal windows lie in blocks of one anchor,
at one distance from it.  So blocks whose anchor stands once in the corpus hold nothing
that repeats, and only the others are looked at, anchor by anchor.

A block that stands twice as a whole repeats as a whole.  Otherwise the blocks of an
anchor are dealt to one bucket, where they are indexed in batches: a batch's suffixes
(cut at ``width`` bytes) are sorted into a suffix array, merge-scanned against the arrays
of earlier batches for matches of the full width, and kept as a level; two levels of one
size merge into the next, so there are only logarithmically many.  An anchor with more
than ``hot`` different blocks would fill a task: its windows meet by their 128-bit hash
instead, spread over all tasks.

Whether a window repeats depends on its bytes alone, so copies of a text share one answer.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize

# odd multipliers of the anchor hash
_MIX = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB)]


def gram_hashes(text: np.ndarray, gram: int) -> np.ndarray:
    """A hash of the ``gram`` bytes (a multiple of 8) from each position on."""
    n = len(text) - gram + 1
    words = np.ndarray((len(text) - 7,), "<u8", text, 0, (1,)).astype(np.uint64)
    h = words[:n] * _MIX[0]
    for at in range(8, gram, 8):
        h ^= h >> np.uint64(29)
        h = h * _MIX[1] + words[at:at + n] * _MIX[2]
    h ^= h >> np.uint64(32)
    h *= _MIX[3]
    return h ^ (h >> np.uint64(29))


def blocks(text: np.ndarray, width: int, gram: int) -> tuple:
    """(anchor hash, first window, number of windows) of each block of a text."""
    grams = gram_hashes(text, gram)
    # the leftmost least hash: position in the low half, by doubling the span of minima
    least = (grams & np.uint64(0xFFFFFFFF00000000)) | np.arange(len(grams), dtype=np.uint64)
    span, fit = 1, width - gram + 1
    while 2 * span <= fit:
        least = np.minimum(least[:-span], least[span:])
        span *= 2
    if span < fit:
        least = np.minimum(least[:len(least) - (fit - span)], least[fit - span:])
    anchor = (least & np.uint64(0xFFFFFFFF)).astype(np.int64)
    first = np.flatnonzero(np.concatenate(([True], anchor[1:] != anchor[:-1])))
    return grams[anchor[first]].view(np.int64), first, np.diff(np.append(first, len(anchor)))


def _bytes(column: pa.Array) -> Iterator[np.ndarray]:
    """The values of a binary column without nulls, as byte arrays."""
    at = np.frombuffer(column.buffers()[1], np.int32)[column.offset:column.offset + len(column) + 1]
    data = np.frombuffer(column.buffers()[2] or b"", np.uint8)
    for lo, hi in zip(at[:-1].tolist(), at[1:].tolist(), strict=True):
        yield data[lo:hi]


def _index(width: int, gram: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows, got, content, held = [], [], [], 0
            for i, text in enumerate(_bytes(b.column(2))):
                if len(text) >= width:
                    found = blocks(text, width, gram)
                    view = memoryview(text)
                    content += [xxhash.xxh3_128_digest(view[lo:lo + n - 1 + width])
                                for lo, n in zip(found[1].tolist(), found[2].tolist(), strict=True)]
                    got.append(found)
                    rows.append(np.full(len(found[0]), i))
                    held += len(found[0])
                if got and (held > 200_000 or i + 1 == b.num_rows):
                    at = pa.array(np.concatenate(rows))
                    h = np.frombuffer(b"".join(content), np.int64).reshape(-1, 2)
                    yield pa.RecordBatch.from_arrays(
                        [b.column(0).take(at), b.column(1).take(at), pa.array(np.concatenate([g[0] for g in got])),
                         pa.array(h[:, 0]), pa.array(h[:, 1]), pa.array(np.concatenate([g[1] for g in got]).astype(np.int32)),
                         pa.array(np.concatenate([g[2] for g in got]).astype(np.int32))],
                        names=["doc_id", "t", "anchor", "h1", "h2", "at", "n"])
                    rows, got, content, held = [], [], [], 0
    return run


def _segments(width: int):
    """The bytes of the listed blocks of each text."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            lists = b.column(1)
            for i, text in enumerate(_bytes(b.column(0))):
                listed = lists[i].values
                view = memoryview(text)
                bytes_ = [bytes(view[lo:lo + n - 1 + width]) for lo, n in
                          zip(listed.field("at").to_pylist(), listed.field("n").to_pylist(), strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [*(listed.field(c) for c in ("anchor", "h1", "h2", "copies", "hot")), pa.array(bytes_, pa.binary())],
                    names=["anchor", "h1", "h2", "copies", "hot", "bytes"])
    return run


def suffixes(segment: bytes, width: int) -> np.ndarray:
    """The suffixes of at least ``width`` bytes, cut there."""
    return np.lib.stride_tricks.sliding_window_view(np.frombuffer(segment, np.uint8), width)


class Levels:
    """Suffix arrays of geometric sizes over batches of suffixes; ``repeated`` has a flag
    for each suffix added so far that was found equal to another."""

    def __init__(self, width: int):
        self.kind = np.dtype(f"S{width}")
        self.levels: list[tuple[int, np.ndarray, np.ndarray]] = []      # (rank, sorted suffixes, their numbers)
        self.repeated = np.zeros(0, bool)

    def add(self, rows: np.ndarray) -> None:
        """A batch: (suffixes, width) bytes."""
        keys = np.ascontiguousarray(rows).view(self.kind).ravel()
        number = np.arange(len(self.repeated), len(self.repeated) + len(keys))
        self.repeated = np.concatenate((self.repeated, np.zeros(len(keys), bool)))
        level = self.sorted(keys, number)
        for _, old, old_number in self.levels:
            at = np.minimum(np.searchsorted(old, level[0]), len(old) - 1)
            same = old[at] == level[0]
            self.repeated[level[1][same]] = True
            self.repeated[old_number[at[same]]] = True
        self.levels.append((0, *level))
        while len(self.levels) > 1 and self.levels[-1][0] == self.levels[-2][0]:
            (rank, *a), (_, *b) = self.levels.pop(), self.levels.pop()
            self.levels.append((rank + 1, *self.sorted(np.concatenate((b[0], a[0])), np.concatenate((b[1], a[1])))))

    def sorted(self, keys: np.ndarray, number: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The suffix array; equal suffixes are marked and stay once."""
        order = np.argsort(keys, kind="stable")
        keys, number = keys[order], number[order]
        same = keys[1:] == keys[:-1]
        self.repeated[number[1:][same]] = True
        self.repeated[number[:-1][same]] = True
        first = np.concatenate(([True], ~same)) if len(keys) else np.zeros(0, bool)
        return keys[first], number[first]


def _runs(flags: np.ndarray) -> np.ndarray:
    """(start, end) of the runs of true flags."""
    return np.flatnonzero(np.diff(np.concatenate(([False], flags, [False])).astype(np.int8))).reshape(-1, 2)


_FOUND = "anchor long, h1 long, h2 long, first array<int>, runs array<int>"


def _match(width: int, batch: int):
    """A bucket's blocks through the levels: the runs of repeated windows of each."""
    def run(group: pa.Table) -> pa.Table:
        levels, counts = Levels(width), []
        segments = group.column("bytes").to_pylist()
        for lo in range(0, len(segments), batch):
            some = [suffixes(s, width) for s in segments[lo:lo + batch]]
            counts += map(len, some)
            levels.add(np.concatenate(some))
        ends = np.cumsum(counts)
        rows, first, runs = [], [], []
        for i, copies in enumerate(group.column("copies").to_pylist()):
            if copies == 1:
                found = _runs(levels.repeated[ends[i] - counts[i]:ends[i]])
                if len(found):
                    rows.append(i)
                    first.append(found[:, 0].astype(np.int32))
                    runs.append((found[:, 1] - found[:, 0]).astype(np.int32))
        some = group.select(["anchor", "h1", "h2"]).take(pa.array(rows, pa.int64()))
        return some.append_column("first", pa.array(first, pa.list_(pa.int32()))).append_column(
            "runs", pa.array(runs, pa.list_(pa.int32())))
    return run


def _window_hashes(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i, segment in enumerate(b.column(4).to_pylist()):
                view, n = memoryview(segment), len(segment) - width + 1
                h = np.frombuffer(b"".join(xxhash.xxh3_128_digest(view[j:j + width]) for j in range(n)), np.int64)
                one = b.slice(i, 1).take(pa.array(np.zeros(n, np.int64)))
                yield pa.RecordBatch.from_arrays(
                    [*one.columns[:4], pa.array(np.arange(n, dtype=np.int32)), pa.array(h[::2]), pa.array(h[1::2])],
                    names=["anchor", "h1", "h2", "copies", "at", "w1", "w2"])
    return run


def _cut(width: int):
    """What stays of each text, given where repeated runs of windows begin and their lengths."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        span = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
        for b in batches:
            n_bytes, n_removed, kept, spans = [], [], [], []
            for text, first, runs in zip(_bytes(b.column(1)), b.column(2), b.column(3), strict=True):
                turn = np.zeros((0, 2), np.int64)
                if first.is_valid:
                    edge = np.zeros(len(text) + 1, np.int64)
                    at = first.values.to_numpy().astype(np.int64)
                    np.add.at(edge, at, 1)
                    np.add.at(edge, at + runs.values.to_numpy() - 1 + width, -1)
                    gone = np.cumsum(edge)[:-1] > 0
                    turn = _runs(gone)
                    text = text[~gone]
                n_removed.append(int((turn[:, 1] - turn[:, 0]).sum()))
                n_bytes.append(len(text) + n_removed[-1])
                spans.append([{"start": int(s), "end": int(e)} for s, e in turn])
                kept.append(text.tobytes())
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(n_bytes, pa.int64()), pa.array(n_removed, pa.int64()), pa.array(spans, span),
                 pa.array(kept, pa.binary())], names=["doc_id", "n_bytes", "n_removed", "spans", "kept"])
    return run


def remove_repeated_bytes(docs: DataFrame, width: int = 200, gram: int = 24, hot: int = 2000, batch: int = 64,
                          bucket_blocks: int = 2000) -> DataFrame:
    """(doc_id, n_bytes, n_removed, spans, kept), one row per document row: the removed byte
    spans (start, end not included, maximal) and the bytes that stay.

    A byte goes when a string of ``width`` bytes that covers it starts at another place too,
    in any row's text, the same one included.  Texts are UTF-8 bytes, null is empty; texts
    under ``width`` bytes stay whole; rows with a null id and rows repeated with one id are
    documents like others (a row that stands twice loses all, from ``width`` bytes on).  A
    cut may leave bytes that are no valid UTF-8, so ``kept`` is binary.  Only ``doc_id`` and
    ``text`` are read; an empty table gives none.  The result does not depend on ``gram``
    (a multiple of 8), ``hot``, ``batch`` and ``bucket_blocks``."""
    if gram % 8 or not 0 < gram <= width:
        raise ValueError("gram must be a multiple of 8, up to width")
    kind = docs.schema["doc_id"].dataType.simpleString()
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).cast("binary").alias("text"))
    rows = rows.select("doc_id", F.unhex(F.md5("text")).alias("t"), "text")
    found = materialize(rows.where(F.octet_length("text") >= width).mapInArrow(
        _index(width, gram), f"doc_id {kind}, t binary, anchor long, h1 long, h2 long, at int, n int"), "suffix-blocks")

    # written, so that the join below is one of its own and a frequent anchor's rows can be split
    shared = materialize(found.groupBy("anchor").agg(
        F.count(F.lit(1)).alias("c"), *[f(c).alias(f"{f.__name__}_{c}") for f in (F.min, F.max) for c in ("h1", "h2")])
        .where("c > 1").select("anchor", F.expr("min_h1 < max_h1 or min_h2 < max_h2").alias("open")), "shared-anchors")
    block = ["anchor", "h1", "h2"]
    known = materialize(found.join(shared, "anchor"), "shared-blocks")
    contents = materialize(known.groupBy(*block, "open").agg(
        F.count(F.lit(1)).alias("copies"), F.min(F.struct("doc_id", "t", "at", "n")).alias("one")), "block-contents")

    # anchors with a block that stands once: its windows may repeat inside other blocks
    unsure = (contents.where("open").groupBy("anchor")
              .agg(F.count(F.lit(1)).alias("k"), F.min("copies").alias("fewest")).where("fewest = 1")
              .select("anchor", (F.col("k") > hot).alias("hot")))
    listed = (contents.where("open").join(unsure, "anchor")
              .groupBy(F.col("one.doc_id").alias("one_id"), F.col("one.t").alias("t"))
              .agg(F.collect_list(F.struct(*block, F.least("copies", F.lit(2)).cast("int").alias("copies"), "hot",
                                           F.col("one.at").alias("at"), F.col("one.n").alias("n"))).alias("blocks")))
    # rows repeated as a whole give their blocks more than once
    segments = materialize(
        rows.join(listed.withColumnRenamed("t", "one_t"),
                  (F.col("t") == F.col("one_t")) & F.col("doc_id").eqNullSafe(F.col("one_id")))
        .select("text", "blocks").mapInArrow(
            _segments(width), "anchor long, h1 long, h2 long, copies int, hot boolean, bytes binary")
        .dropDuplicates(block), "open-blocks")

    cool = segments.where("not hot")
    buckets = max(1, cool.count() // bucket_blocks)
    matched = (cool.groupBy(F.pmod(F.xxhash64("anchor"), F.lit(buckets)).alias("bucket"))
               .applyInArrow(_match(width, batch), _FOUND))
    windows = materialize(segments.where("hot").select(*block, "copies", "bytes").mapInArrow(
        _window_hashes(width), "anchor long, h1 long, h2 long, copies int, at int, w1 long, w2 long"), "hot-windows")
    again = windows.groupBy("w1", "w2").agg(F.sum("copies").alias("c")).where("c > 1").select("w1", "w2")
    matched_hot = (windows.where("copies = 1").join(again, ["w1", "w2"]).groupBy(*block)
                   .agg(F.collect_list("at").alias("first")).withColumn("runs", F.transform("first", lambda x: F.lit(1))))
    whole = contents.where("copies > 1").select(
        *block, F.array(F.lit(0)).alias("first"), F.array(F.col("one.n")).alias("runs"))
    decided = materialize(matched.unionByName(matched_hot).unionByName(whole), "repeated-windows")

    runs = (known.join(decided, block).select("t", "at", F.arrays_zip("first", "runs").alias("z")).distinct()
            .groupBy("t").agg(F.flatten(F.collect_list(F.transform("z", lambda z: F.struct(
                (F.col("at") + z["first"]).alias("at"), z["runs"].alias("n"))))).alias("runs"))
            .select("t", F.col("runs.at").alias("first"), F.col("runs.n").alias("runs")))
    return (rows.join(runs, "t", "left").select("doc_id", "text", "first", "runs")
            .mapInArrow(_cut(width), f"doc_id {kind}, n_bytes long, n_removed long, "
                                     "spans array<struct<start: long, end: long>>, kept binary"))
