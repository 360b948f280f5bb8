"""Dense, zero-based ids in a given order, without a single-task window.

A global ``row_number()`` moves every row into one partition, and a window per
group moves a whole hot group into one task.  Instead rows are range-partitioned
on (group, order) -- which also splits a hot group over several partitions -- and
sorted inside each partition.  The partition index and the position inside it are
read off ``monotonically_increasing_id`` (partition index in the upper 31 bits,
position in the lower 33).  That layout is frozen by writing it to the shared
checkpoint folder (range sampling must not be re-run by a retried or re-planned
stage).  Places inside a partition's groups are counted while the sorted rows are written,
so no second shuffle is needed.  Each row then gets the number of its group's rows in
earlier partitions plus its place in its own; at most one group per partition has rows in
an earlier one, so the offsets are bounded by the number of partitions and are broadcast.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import materialize, scratch_path, write_once

_POS_BITS = 33


def _as_cols(order) -> list[Column]:
    return [F.col(c) if isinstance(c, str) else c for c in order]


def _places(group: list[str]):
    """Appends to sorted rows their place among the task's rows of the same group."""
    def differs(a: pa.Array, b: pa.Array) -> np.ndarray:
        """Where two columns of equal length hold different values; nulls are equal, and NaNs."""
        unlike = pc.fill_null(pc.not_equal(a, b), False)
        if pa.types.is_floating(a.type):
            unlike = pc.and_not(unlike, pc.fill_null(pc.and_(pc.is_nan(a), pc.is_nan(b)), False))
        return pc.or_(unlike, pc.xor(pc.is_null(a), pc.is_null(b))).to_numpy(zero_copy_only=False)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, seen = None, 0             # the row before this batch (its group), its group's rows so far
        for b in batches:
            if not b.num_rows:
                continue
            begins = np.zeros(b.num_rows, bool)
            for g in group:
                c = b.column(g)
                begins[1:] |= differs(c.slice(1), c.slice(0, b.num_rows - 1))
                begins[0] |= last is None or bool(differs(c.slice(0, 1), last[g])[0])
            at = np.arange(b.num_rows, dtype=np.int64)
            start = np.maximum.accumulate(np.where(begins, at, -seen if not begins[0] else 0))
            place = at - start
            last, seen = {g: pa.concat_arrays([b.column(g).slice(b.num_rows - 1)]) for g in group}, int(place[-1]) + 1
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(place)], names=[*b.schema.names, "_place"])
    return run


def dense_index(df: DataFrame, order, out: str = "id", num_partitions: int | None = None,
                start: int = 0, group=None, native: bool = False) -> DataFrame:
    """Add column ``out`` = start, start+1, ... following ``order`` (a total order
    inside each group); numbering restarts per ``group`` (list of column names).

    Places in groups are counted by Arrow batches in the writing tasks or, if ``native``, by a
    window over the written rows, which shuffles them again.

    Runs a range sample and a write (with ``group`` also the small table of offsets); the result
    reads what was written.
    """
    spark = df.sparkSession
    group = list(group or [])
    cols = _as_cols(group) + _as_cols(order)
    # without a count, adaptive execution joins small neighbouring ranges
    ranged = df.repartitionByRange(num_partitions, *cols) if num_partitions else df.repartitionByRange(*cols)
    ix, p, q = "_ix", "_p", "_q"
    staged = ranged.sortWithinPartitions(*cols).withColumn(ix, F.monotonically_increasing_id())
    if group and not native:
        placed = T.StructType([*staged.schema.fields, T.StructField("_place", T.LongType())])
        staged = staged.mapInArrow(_places(group), placed)
    path = scratch_path(spark, "dense-index")
    write_once(staged, path)
    frozen = (spark.read.schema(staged.schema).parquet(path)
                   .withColumn(p, F.shiftright(F.col(ix), _POS_BITS))
                   .withColumn(q, F.col(ix).bitwiseAND(F.lit((1 << _POS_BITS) - 1))))
    if not group:
        # one row per partition: bounded by the number of partitions
        sizes = frozen.groupBy(p).agg(F.count(F.lit(1)).alias("_n"))
        before = Window.orderBy(p).rowsBetween(Window.unboundedPreceding, -1)
        offsets = sizes.select(F.col(p).alias("_op"), F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_off"))
        joined = frozen.join(F.broadcast(offsets), F.col(p) == F.col("_op"))
        return joined.select(*df.columns, (F.col("_off") + F.col(q) + F.lit(start)).alias(out))
    if native:
        place = F.row_number().over(Window.partitionBy(p, *group).orderBy(q)) - 1
        frozen = frozen.withColumn("_place", place.cast("long"))
    # A group's rows lie together, so only the first group of a partition can have begun
    # in an earlier one, and it was the last group there: two rows per partition (its first
    # and its last one) tell the offsets, a broadcast bounded by the number of partitions.
    names = [f"_h{i}" for i in range(len(group))]
    held = [F.col(g).alias(h) for g, h in zip(group, names, strict=True)]
    ends = frozen.groupBy(p).agg(F.max(q).alias("_end")).withColumnRenamed(p, "_ep")
    tails = (frozen.join(F.broadcast(ends), (F.col(p) == F.col("_ep")) & (F.col(q) == F.col("_end")))
             .select(F.col(p).alias("_op"), F.lit(1).alias("_k"), (F.col("_place") + 1).alias("_n"), *held))
    heads = frozen.where(F.col(q) == 0).select(F.col(p).alias("_op"), F.lit(0).alias("_k"),
                                               F.lit(0).cast("long").alias("_n"), *held)
    before = Window.partitionBy(*names).orderBy("_op", "_k").rowsBetween(Window.unboundedPreceding, -1)
    offsets = materialize(heads.unionByName(tails).withColumn("_off", F.sum("_n").over(before))
                          .where((F.col("_k") == 0) & (F.col("_off") > 0)).select("_op", "_off", *names).coalesce(1),
                          "dense-offsets")     # every reader of the index needs them
    same = [F.col(g).eqNullSafe(F.col(h)) for g, h in zip(group, names, strict=True)]
    joined = frozen.join(F.broadcast(offsets), [F.col(p) == F.col("_op"), *same], "left")
    return joined.select(*df.columns, (F.coalesce("_off", F.lit(0)) + F.col("_place") + F.lit(start))
                         .cast("long").alias(out))
