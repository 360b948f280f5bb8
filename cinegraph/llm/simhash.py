"""SimHash near-duplicates over a Gray-ordered hierarchical Hamming index.

Fingerprints: 64 bits over word shingles (XXH64, seed 42); a bit is set when more than
half of the shingle hashes set it.

Links (at most ``max_bits`` differing bits): the 64 bits are cut into ``blocks``
segments.  Two fingerprints within ``max_bits`` bits agree on at least
``blocks - max_bits`` whole segments, so each choice of that many segments is a *mask*,
and the (mask, masked bits) pattern is an upper node of the index that both share.
Fingerprints travel to their upper nodes (8 bytes each, not texts).  Below an upper
node they are sorted by Gray rank and cut into runs; a run keeps the bits that all its
members share, and runs of runs again.  A query walks down and adds up its differences
to the shared bits of a node; a node whose differences exceed ``max_bits`` is dropped
with its whole group.  What is left is compared exactly.

An upper node with more than ``chunk`` fingerprints is split into pairs of chunks, each
a group of its own, so no task holds a whole hot node.  A group returns a spanning
forest of its links, never all pairs.  Everything is exact: no candidate is dropped.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import materialize
from .common import LOWER, fresh, texts
from .components import components

SEED = 42
_BYTE_BITS = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1, bitorder="little").astype(np.int64)
_FAN = 16          # members of a run, and runs of a run


def fingerprint(text: str, shingle_words: int = 4) -> int:
    """Unsigned 64-bit SimHash of one text; zero for a text without words."""
    words = text.encode("utf-8", "surrogatepass").translate(LOWER).split()
    if not words:
        return 0
    joined = b" ".join(words)
    k = min(shingle_words, len(words))
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))[: len(words) - k + 1].tolist()
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter((digest(joined[s:e], SEED) for s, e in zip(starts, ends[k - 1:].tolist(), strict=True)),
                         np.uint64, len(starts))
    lanes = hashes.view(np.uint8).reshape(-1, 8)
    bits = np.concatenate([np.bincount(lanes[:, i], minlength=256) @ _BYTE_BITS for i in range(8)])
    return int(np.packbits(bits * 2 > len(starts), bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, shingle_words: int = 4) -> DataFrame:
    """(doc_id, place, fp): one row per document row; place is a hash of id and text, fp the
    fingerprint as a signed long."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fps = np.fromiter((fingerprint(t, shingle_words) for t in texts(b.column(2))), np.uint64, b.num_rows)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(fps.view(np.int64))],
                                             names=["doc_id", "place", "fp"])
    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", row_place(), "text").mapInArrow(run, f"doc_id {kind}, place long, fp long")


def row_place() -> Column:
    """What tells document rows apart: equal for rows of equal id and text."""
    return F.xxhash64("doc_id", "text").alias("place")


def masks(max_bits: int, blocks: int) -> list[int]:
    """One mask for each choice of ``blocks - max_bits`` of the segments."""
    if not 0 <= max_bits < blocks <= 64:
        raise ValueError("blocks must be above max_bits and at most 64")
    cut = [round(i * 64 / blocks) for i in range(blocks + 1)]
    segment = [((1 << (hi - lo)) - 1) << lo for lo, hi in zip(cut, cut[1:], strict=False)]
    return [sum(c) for c in combinations(segment, blocks - max_bits)]


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def _gray_rank(x: np.ndarray) -> np.ndarray:
    """Position of a code in Gray order (the inverse Gray code)."""
    for s in (1, 2, 4, 8, 16, 32):
        x = x ^ (x >> np.uint64(s))
    return x


class _Forest:
    """Union-find over positions; the smaller position is the root."""

    def __init__(self, n: int):
        self.root = np.arange(n)

    def add(self, a: np.ndarray, b: np.ndarray) -> None:
        root = self.root
        while len(a):
            ra, rb = root[a], root[b]
            apart = ra != rb
            a, b, ra, rb = a[apart], b[apart], ra[apart], rb[apart]
            np.minimum.at(root, np.maximum(ra, rb), np.minimum(ra, rb))
            while True:
                up = root[root]
                if np.array_equal(up, root):
                    break
                root[:] = up


def _levels(codes: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """From the lowest runs up: (shared bits' mask, their values) of each run."""
    ones, zeros, out = codes, ~codes, []
    while len(ones) > _FAN:
        at = np.arange(0, len(ones), _FAN)
        ones, zeros = np.bitwise_and.reduceat(ones, at), np.bitwise_and.reduceat(zeros, at)
        out.append((ones | zeros, ones))
    return out


def link_group(codes: np.ndarray, max_bits: int, tile: int = 512) -> np.ndarray:
    """For one group of distinct codes in Gray order: position of each code's root in a
    spanning forest of the links."""
    forest, n = _Forest(len(codes)), len(codes)
    tree = _levels(codes)
    for lo in range(0, n, tile):
        ask = codes[lo:lo + tile]
        q = np.repeat(np.arange(len(ask)), len(tree[-1][0]) if tree else n)
        node = np.tile(np.arange(len(tree[-1][0]) if tree else n), len(ask))
        for depth in range(len(tree) - 1, -1, -1):
            mask, value = tree[depth]
            near = np.bitwise_count((ask[q] ^ value[node]) & mask[node]) <= max_bits
            # a query needs partners before it only: each link is met once
            near &= node * _FAN ** (depth + 1) <= lo + q
            q, node = q[near], node[near]
            below = len(tree[depth - 1][0]) if depth else n
            q = np.repeat(q, _FAN)
            node = (node[:, None] * _FAN + np.arange(_FAN)).ravel()
            q, node = q[node < below], node[node < below]
        near = node < lo + q
        q, node = q[near], node[near]
        near = np.bitwise_count(ask[q] ^ codes[node]) <= max_bits
        forest.add(lo + q[near], node[near])
    return forest.root


def _small_groups(codes: np.ndarray, group: np.ndarray, max_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Links inside groups of at most _FAN members, all groups at once (sorted by group)."""
    a, b = [], []
    for step in range(1, _FAN):
        same = group[step:] == group[:-step]
        if not same.any():
            break
        at = np.flatnonzero(same)
        at = at[np.bitwise_count(codes[at] ^ codes[at + step]) <= max_bits]
        a.append(at + step)
        b.append(at)
    return (np.concatenate(a), np.concatenate(b)) if a else (np.empty(0, int), np.empty(0, int))


def _linker(max_bits: int):
    """mapInArrow over rows sorted by (mask, node, i, j): spanning links of each group."""
    def solve(keys: np.ndarray, codes: np.ndarray) -> pa.RecordBatch:
        if not len(codes):
            return pa.RecordBatch.from_arrays([pa.array([], pa.int64())] * 2, names=["a", "b"])
        first = np.concatenate(([True], (keys[1:] != keys[:-1]).any(axis=1)))
        group = np.cumsum(first) - 1
        order = np.lexsort((_gray_rank(codes), group))
        codes = codes[order]
        size = np.bincount(group)
        forest = _Forest(len(codes))
        small = size[group] <= _FAN
        at = np.flatnonzero(small)
        x, y = _small_groups(codes[at], group[at], max_bits)
        forest.add(at[x], at[y])
        starts = np.flatnonzero(first)
        for g in np.flatnonzero(size > _FAN):
            lo, hi = starts[g], starts[g] + size[g]
            forest.root[lo:hi] = lo + link_group(codes[lo:hi], max_bits)
        linked = np.flatnonzero(forest.root != np.arange(len(codes)))
        signed = codes.view(np.int64)
        return pa.RecordBatch.from_arrays([pa.array(signed[linked]), pa.array(signed[forest.root[linked]])],
                                          names=["a", "b"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keep_k, keep_c = np.empty((0, 4), np.int64), np.empty(0, np.uint64)
        for b in batches:
            if not b.num_rows:
                continue
            keys = np.stack([b.column(i).to_numpy(zero_copy_only=False).astype(np.int64) for i in range(4)], axis=1)
            codes = b.column(4).to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64)
            keys, codes = np.concatenate((keep_k, keys)), np.concatenate((keep_c, codes))
            # the last group may go on in the next batch
            open_at = len(keys) - np.argmax((keys[::-1] != keys[-1]).any(axis=1)) \
                if (keys != keys[-1]).any() else 0
            yield solve(keys[:open_at], codes[:open_at])
            keep_k, keep_c = keys[open_at:], codes[open_at:]
        yield solve(keep_k, keep_c)
    return run


def hamming_links(codes: DataFrame, max_bits: int = 4, blocks: int | None = None, chunk: int = 4096) -> DataFrame:
    """Spanning links (a, b) between the distinct codes (column ``fp``, long, distinct and
    not null) that differ in at most ``max_bits`` bits.

    ``blocks`` sets the upper nodes' width, 64 * (blocks - max_bits) / blocks bits, and
    their number per code, C(blocks, max_bits): more blocks for larger corpora.  The
    result is exact for any value."""
    chosen = masks(max_bits, blocks or max_bits + 2)
    nodes = codes.select("fp", F.posexplode(F.array(*[F.col("fp").bitwiseAND(F.lit(_signed(m))) for m in chosen]))
                         .alias("mask", "node"))
    hot = (nodes.groupBy("mask", "node").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > chunk)
           .select("mask", "node", F.ceil(F.col("n") / chunk).cast("int").alias("k")))
    spread = (nodes.join(hot, ["mask", "node"], "left")
              .withColumn("k", F.coalesce("k", F.lit(1)))
              .withColumn("c", F.pmod(F.xxhash64("fp"), F.col("k")).cast("int"))
              .withColumn("o", F.explode(F.sequence(F.lit(0), F.col("k") - 1)))
              .select("mask", "node", F.least("c", "o").alias("i"), F.greatest("c", "o").alias("j"), "fp"))
    keys = ["mask", "node", "i", "j"]
    return (spread.repartition(*keys).sortWithinPartitions(*keys)
            .mapInArrow(_linker(max_bits), "a long, b long"))


def near_duplicates(docs: DataFrame, shingle_words: int = 4, max_bits: int = 4, blocks: int | None = None,
                    chunk: int = 4096) -> DataFrame:
    """(doc_id, place, fp, component_id, kept), one row per document row.

    component_id is the smallest doc_id reachable over links of at most ``max_bits``
    differing bits.  kept marks one document of each group, the one with that id (of
    several, and without ids, the smallest ``place``; a row repeated as a whole is marked
    each time).  Null and empty texts have fingerprint zero and link like any other.  A
    null doc_id keeps its row and takes its component's smallest doc_id (null if there is
    none).  Only ``doc_id`` and ``text`` are read, so extra columns cannot clash.  An
    empty table gives none."""
    fps = materialize(fingerprints(docs, shingle_words), "fingerprints")
    choice = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "place")
    distinct = materialize(fps.groupBy("fp").agg(F.min(choice).alias("best")), "distinct-fingerprints")
    found = components(hamming_links(distinct.select("fp"), max_bits, blocks, chunk))
    joined = distinct.join(found, distinct.fp == found.node, "left").select(
        "fp", "best", F.coalesce("component", "fp").alias("component"))
    classes = joined.groupBy("component").agg(F.min("best").alias("least"))
    members = joined.join(classes, "component").select(
        "fp", F.col("least.doc_id").alias("component_id"), F.col("least.place").alias("first_place"))
    return fps.join(members, "fp").select(
        "doc_id", "place", "fp", "component_id", (F.col("place") == F.col("first_place")).alias("kept"))


def keep_one(docs: DataFrame, **how) -> DataFrame:
    """The kept document of each group of near duplicates, with all its columns; a row
    repeated as a whole (same id and text) stays once.

    Rows to drop are anti-joined by their place; only repeated rows are gathered."""
    found = materialize(near_duplicates(docs, **how), "near-duplicates")
    mark, of = fresh(docs, "row_place", "drop_place")
    rows = docs.withColumn(mark, row_place())
    repeated = (found.where("kept").groupBy("place").count().where("count > 1").select(F.col("place").alias(of)))
    repeated = materialize(repeated, "repeated-rows")
    drop = materialize(found.where("not kept").select(F.col("place").alias(of)).distinct().union(repeated), "dropped")
    single = rows.join(drop, F.col(mark) == F.col(of), "left_anti")
    again = rows.join(repeated, F.col(mark) == F.col(of), "left_semi").dropDuplicates([mark])
    return single.unionByName(again).drop(mark)
