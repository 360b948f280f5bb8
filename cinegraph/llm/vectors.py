"""Near-duplicate embeddings by collision counting on one-dimensional projections.

Unit vectors are projected on ``m`` random directions.  For two vectors at the cosine
threshold the difference of a projection is normal with a known spread, so a window of
``z`` spreads around the query holds the other with a known probability, and the number
of windows that do is binomial.  A pair is a candidate when at least ``least`` of its
``m`` projections collide; ``least`` is the largest count that keeps the wanted recall.
Candidates are verified by their cosine in double precision.

A candidate collides in at least one of the first ``m - least + 1`` projections, so only
those generate pairs: their axes are cut into cells as wide as the window, and a cell
meets itself and the next one.  Cells with more than ``chunk`` vectors are cut into
chunks that meet pairwise, so a task holds two chunks whatever the cell's size.  A task
counts links and returns them per vector with a spanning forest, never the pairs.  Equal
vectors travel once, with their number.

The windows of a fixed recall hold a fixed share of a label's vectors, so the work grows
with the square of a label's distinct vectors; it is spread evenly.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize
from .components import components
from .simhash import _Forest


def calibrate(m: int, z: float, recall: float) -> int:
    """The largest collision count that a pair at the threshold reaches with probability
    ``recall`` or more."""
    p = math.erf(z / math.sqrt(2))
    tail = 0.0
    for count in range(m, 0, -1):
        tail += math.comb(m, count) * p**count * (1 - p) ** (m - count)
        if tail >= recall:
            return count
    return 1


def _unit(rows: pa.ChunkedArray | pa.Array, n: int) -> np.ndarray:
    """The vectors of an Arrow list column as unit rows in double precision."""
    flat = rows.combine_chunks() if isinstance(rows, pa.ChunkedArray) else rows
    x = flat.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(n, -1)
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def _directions(size: int, m: int, seed: int) -> np.ndarray:
    return np.random.default_rng([seed, size]).standard_normal((size, m))


def _pairs(left: np.ndarray, right: np.ndarray, half: float, least: int, generator: int) -> tuple:
    """Positions of the pairs that ``generator`` is the first to find and that collide
    ``least`` times (rows: projections of vectors)."""
    m = left.shape[1]
    order = np.argsort(right[:, generator], kind="stable")
    sorted_right = right[order]
    axis = sorted_right[:, generator]
    lo = np.searchsorted(axis, left[:, generator] - half, "left")
    hi = np.searchsorted(axis, left[:, generator] + half, "right")
    n = hi - lo
    a = np.repeat(np.arange(len(left)), n)
    b = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(lo, n)
    missed = np.zeros(len(a), np.int16)
    for i in (*range(generator), *range(generator + 1, m)):
        miss = np.abs(left[a, i] - sorted_right[b, i]) > half
        # a pair found by an earlier projection belongs to that one
        missed += miss
        stay = (missed <= m - least) & (miss | (i > generator))
        a, b, missed = a[stay], b[stay], missed[stay]
    return a, order[b]


def _task(cosine: float, m: int, half: float, least: int, seed: int, tile: int = 128):
    def run(key: tuple, group: pa.Table) -> pa.Table:
        n = group.num_rows
        side = group.column("side").to_numpy()
        node, tag = group.column("node").to_numpy(), group.column("tag").to_numpy()
        weight = group.column("copies").to_numpy()
        x = _unit(group.column("embedding"), n)
        generator = key[2].as_py()
        p = x @ _directions(x.shape[1], m, seed)
        one, two = np.flatnonzero(side == 0), np.flatnonzero(side == 1)
        within = key[6].as_py() and key[4].as_py() == key[5].as_py()
        links, forest = np.zeros(n, np.int64), _Forest(n)
        for at in range(0, len(one), tile):
            ask = one[at:at + tile]
            other = one[at:] if within else two
            a, b = _pairs(p[ask], p[other], half, least, generator)
            a, b = ask[a], other[b]
            if within:
                a, b = a[a < b], b[a < b]
            good = np.einsum("ij,ij->i", x[a], x[b]) >= cosine
            a, b = a[good], b[good]
            np.add.at(links, a, weight[b])
            np.add.at(links, b, weight[a])
            forest.add(a, b)
        some = np.flatnonzero(links)
        root = forest.root[some]
        return pa.table({"node": node[some], "tag": tag[some], "links": links[some],
                         "root": node[root], "root_tag": tag[root]})
    return run


def _cells(nodes: DataFrame, axes: int, half: float, m: int, seed: int) -> DataFrame:
    """``nodes`` once per generating axis, with the cell of their projection on it."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            offsets = b.column("embedding").offsets.to_numpy()
            cells = np.empty((b.num_rows, axes), np.int64)
            for size in np.unique(np.diff(offsets)):
                rows = np.flatnonzero(np.diff(offsets) == size)
                x = _unit(b.column("embedding").take(pa.array(rows)), len(rows))
                cells[rows] = np.floor((x @ _directions(int(size), m, seed))[:, :axes] / half)
            yield pa.RecordBatch.from_arrays(
                [*b.columns, pa.array(list(cells), pa.list_(pa.int64()))], names=[*b.schema.names, "cells"])
    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in nodes.schema.fields)
    return (nodes.mapInArrow(run, f"{kinds}, cells array<bigint>")
            .select(*nodes.columns, F.posexplode("cells").alias("axis", "cell")))


def near_duplicate_vectors(vectors: DataFrame, cosine: float = 0.93, projections: int = 24, spreads: float = 3.0,
                           recall: float = 0.995, chunk: int = 2048, seed: int = 11) -> DataFrame:
    """(vec_id, n_links, component_id, kept), one row per row of ``vectors`` (``vec_id``,
    ``embedding``, ``label``; other columns are not read).

    Only vectors of equal non-null label and equal length are compared.  A null label or
    id and a vector that is null, empty, zero or holds a null or non-finite component
    link with nothing: no links, their own component (null for a null id).  Equal vectors
    link like any others; rows repeated with one id count as vectors of their own.  kept
    is vec_id = component_id (false for a null id).  An empty table gives none."""
    half = spreads * math.sqrt(max(2.0 - 2.0 * cosine, 1e-12))
    least = calibrate(projections, spreads, recall)
    rows = vectors.select("vec_id", "label", "embedding")
    finite = F.forall("embedding", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < F.lit(float("inf"))))
    usable = (F.col("vec_id").isNotNull() & F.col("label").isNotNull() & (F.size("embedding") > 0)
              & finite & F.exists("embedding", lambda v: v != 0))
    nodes = materialize(
        rows.where(usable).groupBy("label", "embedding")
        .agg(F.min("vec_id").alias("node"), F.count(F.lit(1)).alias("copies"))
        # the tag tells vectors of one id apart
        .withColumn("tag", F.xxhash64("embedding")).withColumn("size", F.size("embedding")), "distinct-vectors")

    placed = _cells(nodes, projections - least + 1, half, projections, seed)
    base = ["label", "size", "axis"]
    counts = materialize(placed.groupBy(*base, "cell").agg(
        F.ceil(F.count(F.lit(1)) / chunk).cast("int").alias("k")), "cells")
    before = counts.select(*base, (F.col("cell") + 1).alias("cell"), F.col("k").alias("k_before"))
    after = counts.select(*base, (F.col("cell") - 1).alias("cell"), F.col("k").alias("k_after"))
    keys = [*base, "cell"]
    known = materialize(counts.join(before, keys, "left").join(after, keys, "left"), "cell-neighbours")
    mine = placed.join(known, keys).withColumn("c", F.pmod(F.col("tag"), F.col("k")).cast("int"))

    def chunks(count: str):
        return F.when(F.col(count) > 0, F.sequence(F.lit(0), F.col(count) - 1)).otherwise(F.array().cast("array<int>"))

    def meeting(at, i, j, side, inner: bool):
        return F.struct(at.alias("at"), i.alias("i"), j.alias("j"), side.alias("side"), F.lit(inner).alias("inner"))
    c, cell = F.col("c"), F.col("cell")
    own = F.transform(chunks("k"), lambda o: meeting(cell, F.least(c, o), F.greatest(c, o), (o < c).cast("int"), True))
    first = F.transform(chunks("k_after"), lambda o: meeting(cell, c, o, F.lit(0), False))
    second = F.transform(chunks("k_before"), lambda o: meeting(cell - 1, o, c, F.lit(1), False))
    tasks = mine.select(*base, "node", "tag", "copies", "embedding", F.inline(F.concat(own, first, second)))
    found = materialize(
        tasks.groupBy(*base, "at", "i", "j", "inner")
        .applyInArrow(_task(cosine, projections, half, least, seed),
                      "node long, tag long, links long, root long, root_tag long"),
        "vector-links")

    sums = found.groupBy("node", "tag").agg(F.sum("links").alias("links"))
    classes = components(found.select(F.struct("node", "tag").alias("a"),
                                      F.struct(F.col("root").alias("node"), F.col("root_tag").alias("tag")).alias("b"))
                         .where("a <> b")).select("node.node", "node.tag", F.col("component.node").alias("least"))
    by_node = (nodes.join(sums, ["node", "tag"], "left").join(classes, ["node", "tag"], "left")
               .select("label", "embedding", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
                       F.coalesce("least", "node").alias("component_id")))
    linked = rows.where(usable).join(by_node, ["label", "embedding"]).select("vec_id", "n_links", "component_id")
    alone = rows.where(~F.coalesce(usable, F.lit(False))).select(
        "vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return linked.union(alone).withColumn(
        "kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))
