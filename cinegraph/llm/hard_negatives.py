"""Hard negatives by Four-Russians scoring: full exact integer scores from table look-ups.

Components become integers and are stored as bit planes: plane b of eight dimensions is
one byte.  For an anchor and eight dimensions a table holds the sum of the anchor's
components over each of the 256 subsets; a candidate's byte picks one, and the planes are
added with a shift each (the highest is the sign and counts negative).  So a score is
dimensions / 8 look-ups a plane and no multiplication, and it is exact.

Candidates stay where they are, packed once.  Anchors go to them in blocks of bounded
size: a block is one pass for the positives and one for the negatives, each task keeps
the best of its own rows per anchor, and a ranking over tasks finishes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize, scratch_path

_TILE = 4096              # candidates ranked at once
_ROWS = 128               # candidates scored at once: their sums stay in the cache


def planes_for(most: int) -> int:
    """Bit planes that hold integers of at most ``most`` in size, and a sign."""
    return int(most).bit_length() + 1


def pack(x: np.ndarray, planes: int) -> np.ndarray:
    """(rows, planes, groups) bytes of integer rows; dimension 8 g + i is bit i of group g."""
    bits = ((x[:, None, :] >> np.arange(planes)[:, None]) & 1).astype(np.uint8)
    return np.packbits(bits, axis=2, bitorder="little")


def subset_tables(anchors: np.ndarray, kind: type) -> np.ndarray:
    """(groups, 256, anchors): sums of each anchor's components over subsets of eight dimensions."""
    m, size = anchors.shape
    groups = -(-size // 8)
    padded = np.zeros((m, groups * 8), kind)
    padded[:, :size] = anchors
    out = np.zeros((groups, 256, m), kind)
    for i in range(8):
        out[:, 1 << i:2 << i] = out[:, :1 << i] + padded.reshape(m, groups, 8)[:, :, i].T[:, None, :]
    return out


def scores(tables: np.ndarray, codes: np.ndarray) -> np.ndarray:
    """(candidates, anchors) inner products of packed rows with the tables' anchors."""
    n, planes, groups = codes.shape
    out = np.zeros((n, tables.shape[2]), tables.dtype)
    for lo in range(0, n, _ROWS):
        some, total = codes[lo:lo + _ROWS], out[lo:lo + _ROWS]
        for b in reversed(range(planes)):
            total <<= 1                               # shift, then add the plane's look-ups
            for g in range(groups):
                if b == planes - 1:
                    total -= tables[g][some[:, b, g]]
                else:
                    total += tables[g][some[:, b, g]]
    return out


def _integers(lists: pa.Array, scale: int, size: int) -> np.ndarray:
    flat = lists.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return np.floor(flat * scale).astype(np.int64).reshape(len(lists), size)


def _pack(scale: int, planes: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            sizes, codes = b.column(3).to_numpy(), [b""] * b.num_rows
            for size in np.unique(sizes):
                at = np.flatnonzero(sizes == size)
                packed = pack(_integers(b.column(4).take(pa.array(at)), scale, int(size)), planes)
                for i, code in zip(at, packed.reshape(len(at), -1), strict=True):
                    codes[i] = code.tobytes()
            yield pa.RecordBatch.from_arrays([*b.columns[:4], pa.array(codes, pa.binary())],
                                             names=["row", "vec_id", "label", "size", "code"])
    return run


class _Best:
    """The ``k`` highest (score, then smallest id) of each slot so far."""

    def __init__(self, slots: int, k: int):
        self.k, self.kept = k, [None] * slots

    def add(self, slot: int, score: np.ndarray, ids: np.ndarray) -> None:
        """Rows of one tile, in ascending order of ids."""
        if len(score) > self.k:
            at = np.flatnonzero(score >= np.partition(score, len(score) - self.k)[len(score) - self.k])
            at = at[np.argsort(-score[at], kind="stable")[:self.k]]
            score, ids = score[at], ids[at]
        if self.kept[slot] is not None:
            score = np.concatenate((self.kept[slot][0], score))
            ids = np.concatenate((self.kept[slot][1], ids))
            at = np.lexsort((ids, -score))[:self.k]
            score, ids = score[at], ids[at]
        self.kept[slot] = (score.copy(), ids.copy())

    def rows(self, key: np.ndarray, part: np.ndarray) -> pa.RecordBatch:
        n = np.array([0 if x is None else len(x[0]) for x in self.kept])
        full = [x for x in self.kept if x is not None]
        none = np.empty(0, np.int64)
        return pa.RecordBatch.from_arrays(
            [pa.array(np.repeat(key, n), pa.int64()), pa.array(np.repeat(part, n), pa.int32()),
             pa.array(np.concatenate([x[1] for x in full]) if full else none, pa.int64()),
             pa.array(np.concatenate([x[0] for x in full]).astype(np.int64) if full else none, pa.int64())],
            names=["anchor", "part", "vec_id", "score"])


def _tiles(batches: Iterator[pa.RecordBatch], size: int, planes: int) -> Iterator[tuple]:
    """Candidates of one vector length in tiles: rows, ids, labels, codes, ascending by id in each."""
    width = planes * -(-size // 8)
    for b in batches:
        for lo in range(0, b.num_rows, _TILE):
            t = b.slice(lo, _TILE)
            at = np.flatnonzero(t.column(3).to_numpy() == size)
            if len(at):
                at = at[np.argsort(t.column(1).to_numpy()[at], kind="stable")]
                code = np.frombuffer(b"".join(t.column(4).take(pa.array(at)).to_pylist()), np.uint8)
                yield (t.column(0).to_numpy()[at], t.column(1).to_numpy()[at], t.column(2).to_numpy()[at],
                       code.reshape(len(at), planes, width // planes))


def _positives(anchors: dict, size: int, planes: int, kind: type, k: int):
    """Each anchor's best rows of its own label, itself left out."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = _Best(len(anchors["row"]), k)
        labels = np.unique(anchors["label"])
        of = {x: np.flatnonzero(anchors["label"] == x) for x in labels}
        tables = {x: subset_tables(anchors["x"][of[x]], kind) for x in labels}
        for rows, ids, label, codes in _tiles(batches, size, planes):
            for x in np.intersect1d(labels, label):
                at = np.flatnonzero(label == x)
                found = scores(tables[x], codes[at])
                for j, a in enumerate(of[x]):
                    other = rows[at] != anchors["row"][a]
                    best.add(a, found[other, j], ids[at][other])
        yield best.rows(anchors["row"], np.zeros(len(anchors["row"]), np.int32))
    return run


def _negatives(anchors: dict, size: int, planes: int, kind: type, k: int):
    """For each anchor and positive the best rows of other labels inside its window of scores."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = subset_tables(anchors["x"], kind)
        slot_anchor, lo, hi = anchors["slot_anchor"], anchors["lo"], anchors["hi"]
        best = _Best(len(slot_anchor), k)
        first = np.searchsorted(slot_anchor, np.arange(len(anchors["row"]) + 1))
        for _, ids, label, codes in _tiles(batches, size, planes):
            found = np.ascontiguousarray(scores(tables, codes).T)
            for a in range(len(anchors["row"])):
                other = label != anchors["label"][a]
                mine, names = found[a][other], ids[other]
                for slot in range(first[a], first[a + 1]):
                    at = (mine >= lo[slot]) & (mine <= hi[slot])
                    if at.any():
                        best.add(slot, mine[at], names[at])
        yield best.rows(anchors["row"][slot_anchor], anchors["slot"].astype(np.int32))
    return run


def _best_rows(found: DataFrame, k: int) -> DataFrame:
    """The ``k`` best over all tasks, with their rank."""
    order = Window.partitionBy("anchor", "part").orderBy(F.col("score").desc(), F.col("vec_id"))
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def _block(rows: list, size: int, planes: int) -> dict:
    """Anchors of one block, unpacked."""
    code = np.frombuffer(b"".join(bytes(r["code"]) for r in rows), np.uint8)
    bits = np.unpackbits(code.reshape(len(rows), planes, -(-size // 8)), axis=2, bitorder="little")[:, :, :size].astype(np.int64)
    weight = np.left_shift(np.int64(1), np.arange(planes))
    weight[-1] = -weight[-1]
    return {"row": np.array([r["row"] for r in rows], np.int64), "label": np.array([r["label"] for r in rows], np.int64),
            "x": np.einsum("rbd,b->rd", bits, weight)}


def hard_negatives(vectors: DataFrame, anchors: Column, positives: int = 5, negatives: int = 10, low: int = 30,
                   high: int = 90, scale: int = 256, block: int = 1024) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score).

    ``vectors`` has ``vec_id``, ``label`` and ``embedding``; other columns are not read.
    Each row for which ``anchors`` (a condition on these columns) holds asks: its positives
    are the ``positives`` rows of its label with the highest scores; a positive's negatives
    are the ``negatives`` best rows of other labels whose score lies between ``low`` and
    ``high`` percent of the positive's.  A score is the inner product of floor(scale * x),
    ties go to the smaller id.  Only vectors of one length meet.

    Rows with a null id, label or vector, or a null or non-finite component, take no part;
    rows repeated with one id are rows of their own, as anchors too.  An empty vector scores
    0 with its like.  An empty table, or one without anchors, gives none.  Scores must fit
    63 bits: beyond, it raises.  ``block`` bounds the anchors that a task holds at once."""
    spark = vectors.sparkSession
    finite = F.forall("embedding", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < F.lit(float("inf"))))
    usable = F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("embedding").isNotNull() & finite
    rows = vectors.select("vec_id", "label", "embedding").where(usable)
    most = F.array_max(F.transform("embedding", lambda v: F.abs(F.floor(v.cast("double") * scale).cast("double"))))
    top, size_most = rows.agg(F.max(most), F.max(F.size("embedding"))).first()
    top, size_most = int(top or 0), size_most or 0
    if top * top * max(1, size_most) >= 2**62:
        raise ValueError("components too large for exact 64-bit scores")
    planes, kind = planes_for(top), np.int32 if top * top * max(1, size_most) < 2**30 else np.int64

    named = rows.select(F.monotonically_increasing_id().alias("row"), F.col("vec_id").cast("long"),
                        F.col("label").cast("long"), F.size("embedding").alias("size"), "embedding")
    packed = materialize(named.mapInArrow(_pack(scale, planes), "row long, vec_id long, label long, size int, code binary"),
                         "packed-vectors")           # row: fixed by being written
    asking = materialize(packed.where(anchors), "anchors")
    path = scratch_path(spark, "hard-negatives")
    result = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
    spark.createDataFrame([], result).write.parquet(path)
    sizes = asking.groupBy("size").count().collect()                    # one row per vector length
    for size, n in sorted((r["size"], r["count"]) for r in sizes):
        blocks = -(-n // block)
        part = F.pmod(F.xxhash64("row"), F.lit(blocks))
        mine = packed.where(F.col("size") == size)
        for k in range(blocks):
            # about ``block`` rows: the block's bound
            members = asking.where((F.col("size") == size) & (part == k))
            some = _block(members.orderBy("row").collect(), size, planes)
            if not len(some["row"]):
                continue
            schema = "anchor long, part int, vec_id long, score long"
            near = materialize(_best_rows(mine.mapInArrow(_positives(some, size, planes, kind, positives), schema),
                                          positives), "positives")
            at = {row: i for i, row in enumerate(some["row"].tolist())}
            pos = sorted((at[r["anchor"]], r["rank"], r["score"]) for r in near.collect())
            some["slot_anchor"] = np.array([p[0] for p in pos], np.int64)
            some["slot"] = np.array([p[1] for p in pos], np.int64)
            some["lo"] = np.array([-(-low * p[2] // 100) for p in pos], np.int64)
            some["hi"] = np.array([high * p[2] // 100 for p in pos], np.int64)
            far = _best_rows(mine.mapInArrow(_negatives(some, size, planes, kind, negatives), schema), negatives)
            names = members.select(F.col("row").alias("anchor"), F.col("vec_id").alias("anchor_id"))
            (far.select("anchor", F.col("part").alias("place"), "rank", F.col("vec_id").alias("negative_id"),
                        F.col("score").alias("negative_score"))
             .join(near.select("anchor", F.col("rank").alias("place"), F.col("vec_id").alias("positive_id"),
                               F.col("score").alias("positive_score")), ["anchor", "place"])
             .join(names, "anchor")
             .select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
             .write.mode("append").parquet(path))
    return spark.read.schema(result).parquet(path)
