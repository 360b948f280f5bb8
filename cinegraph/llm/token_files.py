"""Token ids in ORC: integer run-length encoded stripes, row indexes and Bloom filters.

Documents are range-partitioned by id and sorted, so files, stripes and rows ascend by
id.  Each task encodes its rows as they stream through and records where a document's
ids start inside its own file; starts over all files add the totals of the files before
(one small row per file).  Stripes are read in parallel, and a look-up of ids skips
files and stripes by their statistics, and row groups by row index and Bloom filter.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .pretokens import pre_tokens

def _encode(tokenizer: str, end_id: int, pieces: int):
    names = ["part", "doc_id", "local_start", "n_tokens", "ids"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens, part, at = pre_tokens(tokenizer, pieces), TaskContext.get().partitionId(), 0
        for b in batches:
            for lo, hi, n, ids in tokens.batches(b.column(1)):
                ends = np.cumsum(n + 1)
                ids = np.insert(ids, np.cumsum(n), end_id)
                lists = pa.ListArray.from_arrays(pa.array(np.append(0, ends), pa.int32()), pa.array(ids, pa.int32()))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(hi - lo, part, np.int32)), b.column(0).slice(lo, hi - lo),
                     pa.array(at + ends - n - 1), pa.array(n + 1), lists], names=names)
                at += int(ends[-1])
            pa.default_memory_pool().release_unused()      # what this batch took goes back
    return run


def write_tokens(docs: DataFrame, path: str, tokenizer: str, end_id: int, rows_per_index: int = 1000,
                 stripe_bytes: int = 32 << 20, pieces: int = 1_000_000) -> None:
    """Write ``docs`` (``doc_id``, ``text``; other columns are not read) to ``path``.

    Null and empty texts are written with the end id alone; rows repeated with one id
    each keep a row, next to each other; null ids come last; an empty table writes an
    empty folder of files.  Ids need less than 2**31 values.  ``pieces`` bounds a worker's
    table of pre-tokens (about 60 bytes each): more is faster, the files are the same."""
    order = [F.col("doc_id").asc_nulls_last(), F.col("place")]
    kind = docs.schema["doc_id"].dataType.simpleString()
    rows = (docs.select("doc_id", "text", F.xxhash64("text").alias("place"))
            .repartitionByRange(*order).sortWithinPartitions(*order).select("doc_id", "text")
            .mapInArrow(_encode(tokenizer, end_id, pieces),
                        f"part int, doc_id {kind}, local_start long, n_tokens long, ids array<int>"))
    (rows.write.mode("overwrite")
     .option("compression", "none").option("orc.create.index", "true")
     .option("orc.row.index.stride", str(rows_per_index)).option("orc.stripe.size", str(stripe_bytes))
     .option("orc.bloom.filter.columns", "doc_id").option("orc.bloom.filter.fpp", "0.01")
     .orc(path))


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids) in the files' order of ids; ``start`` counts the ids
    of all documents before.  One row per row written: null ids, empty texts and repeated
    rows as ``write_tokens`` wrote them; an empty folder of files gives none."""
    rows = spark.read.orc(path)
    # one row per file, so the single window task is bounded by the number of files
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    files = (rows.groupBy("part").agg(F.sum("n_tokens").alias("total"))
             .select("part", F.coalesce(F.sum("total").over(before), F.lit(0)).alias("before")))
    return rows.join(F.broadcast(files), "part").select(
        "doc_id", (F.col("before") + F.col("local_start")).alias("start"), "n_tokens", "ids")


def look_up(spark: SparkSession, path: str, doc_ids: list[int]) -> DataFrame:
    """The rows of some documents; the filter reaches the files' indexes and Bloom filters.
    A repeated id gives each of its rows; null ids and ids that were not written give none."""
    return spark.read.orc(path).where(F.col("doc_id").isin(list(doc_ids))).select("doc_id", "n_tokens", "ids")


def with_checksums(tokens: DataFrame) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32): the ids reduced to an unsigned crc32 of their
    little-endian unsigned 32-bit bytes; n_tokens is counted on the ids read.  One row per
    row, null ids and repeated rows included; no rows give none."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            lists = b.column(2)
            at = lists.offsets.to_numpy()
            data = lists.values.to_numpy(zero_copy_only=False).astype("<i4", copy=False)
            crc = [zlib.crc32(data[lo:hi]) for lo, hi in zip(at, at[1:], strict=False)]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), pa.array(np.diff(at).astype(np.int64)), pa.array(crc, pa.int64())],
                names=["doc_id", "start", "n_tokens", "ids_crc32"])
    kind = tokens.schema["doc_id"].dataType.simpleString()
    return tokens.select("doc_id", "start", "ids").mapInArrow(
        run, f"doc_id {kind}, start long, n_tokens long, ids_crc32 long")
