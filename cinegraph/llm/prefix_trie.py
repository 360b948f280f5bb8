"""Prefix trie of conversations by a splitter skeleton.

A conversation is a path: one 128-bit key per turn (role and text).  Paths are dealt to
shards by splitter paths, so a shard holds a range of the sorted paths.  A node whose
members lie in two shards is a prefix of the splitter between them; the prefixes of all
splitters are the *skeleton*.  It is small (at most ``splitter_turns`` nodes a splitter)
and known to every task.  A task walks its sorted paths once and finishes every other node
alone; of a skeleton node it knows a part, and the parts are summed by node.

Equal conversations are combined before they are dealt, so a conversation that a third of
the rows repeat is one path whose member ids travel in chunks.  Texts never travel.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_right
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize

#: bytes of a turn's key in a path
KEY = 16
#: member ids of one path that travel together: 2 ** CHUNK_BITS consecutive numbers
CHUNK_BITS = 12

NO_MEMBER_ENDS = hashlib.sha256(b"").hexdigest()


def turn_paths(turns: DataFrame, base: Column | None = None, kept: Column | None = None) -> DataFrame:
    """(conv_id, path, sizes): each conversation's turns as keys and as UTF-8 bytes of text.

    ``turns`` has ``conv_id``, ``turn``, ``role``, ``text``; other columns are not read.
    Turns are ordered by ``turn``, null first, ties by their keys; null roles and texts are
    empty; repeated rows are turns of their own; rows without a conv_id take no part.  An
    empty table gives none.

    With ``base`` and ``kept`` (columns of ``conv_id``) conversations branch: the first
    ``kept`` turns come from conversation ``base`` (all if fewer, none if absent), the rest
    are their own after as many.  A base must be its own base, so that a base and its few
    branches can be dealt together.  A conversation is held as one row, 24 bytes a turn."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    key = F.md5(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text))
    known = turns.where(F.col("conv_id").isNotNull()).select(
        "conv_id", (F.col("conv_id") if base is None else base).alias("base"), "turn", key.alias("key"),
        F.octet_length(text).cast("long").alias("size"))
    own = (known.repartition("base").groupBy("base", "conv_id")
           .agg(F.array_sort(F.collect_list(F.struct("turn", "key", "size"))).alias("turns")))
    if base is not None:
        first = F.first(F.when(F.col("conv_id") == F.col("base"), F.col("turns")), ignorenulls=True)
        none = F.slice("turns", 1, 0)
        own = (own.withColumn("from_base", F.coalesce(first.over(Window.partitionBy("base")), none))
               .withColumn("kept", kept.cast("int"))
               .withColumn("turns", F.concat(F.slice("from_base", F.lit(1), F.col("kept")),
                                             F.slice("turns", F.col("kept") + 1, F.size("turns") + 1))))
    return own.select("conv_id", F.unhex(F.array_join(F.col("turns.key"), "")).alias("path"),
                      F.col("turns.size").alias("sizes"))


def _skeleton(splitters: list[bytes]) -> dict[bytes, int]:
    """All prefixes of the splitter paths, numbered so that a parent comes before its children."""
    found = {s[:at] for s in splitters for at in range(0, len(s) + 1, KEY)} | {b""}
    return {p: i for i, p in enumerate(sorted(found))}


def _deal(splitters: list[bytes]):
    """The shard of each path."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            shard = [bisect_right(splitters, p) for p in b.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(shard, pa.int32())],
                                             names=[*b.schema.names, "shard"])
    return run


class _Node:
    __slots__ = ("skel", "size", "least", "n", "children", "leaves", "saved", "ends", "waiting")

    def __init__(self, skel: int | None, size: int):
        self.skel, self.size = skel, size
        self.least, self.n, self.children, self.leaves, self.saved = None, 0, 0, 0, 0
        self.ends, self.waiting = None, []        # waiting: output rows whose parent this is

    def count(self, least, n: int) -> None:
        self.n += n
        self.least = least if self.least is None else min(self.least, least)


#: of a walked node: skeleton number (null: finished here), parent's skeleton number, ...
_WALKED = ["skel", "up", "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
           "size", "ends_sha256"]


class _Walk:
    """One pass over sorted paths, with the nodes of the present path open."""

    def __init__(self, skeleton: dict[bytes, int], schema: pa.Schema):
        self.skeleton, self.schema = skeleton, schema
        self.path, self.open, self.rows, self.whole = b"", [], [], 0

    def close(self) -> None:
        node, depth = self.open.pop(), len(self.open)
        up = self.open[-1] if self.open else None
        ends = node.ends.hexdigest() if node.ends else None
        leaves, saved = node.leaves, node.saved
        if node.skel is None:
            leaves = leaves if node.children else 1
            saved += (node.n - 1) * node.size
            for i in node.waiting:
                self.rows[i][4] = node.least
        row = [node.skel, up.skel if up else None, node.least, depth, None, node.n, node.children, leaves, saved,
               node.size, ends]
        if up:
            up.count(node.least, node.n)
            up.children += node.skel is None      # the skeleton's own edges are counted once, later
            up.leaves += leaves
            up.saved += saved
            if up.skel is None:
                up.waiting.append(len(self.rows))
        self.rows.append(row)
        if up is None or up.skel is not None:
            self.whole = len(self.rows)           # nothing waits for a parent of this shard

    def read(self, path: bytes, sizes, least: int, n: int, ids: str) -> None:
        """A path, or more members of the same one."""
        if not self.open:
            self.open.append(_Node(self.skeleton[b""], 0))
        if path != self.path:
            same, most = 0, min(len(path), len(self.path))
            while same < most and path[same:same + KEY] == self.path[same:same + KEY]:
                same += KEY
            while (len(self.open) - 1) * KEY > same:
                self.close()
            turn_sizes = sizes.as_py()
            for at in range(same, len(path), KEY):
                self.open.append(_Node(self.skeleton.get(path[:at + KEY]), turn_sizes[at // KEY]))
            self.path = path
        end = self.open[-1]
        end.count(least, n)
        if end.ends is None:
            end.ends = hashlib.sha256(ids.encode())
        else:
            end.ends.update(b"," + ids.encode())

    def finish(self) -> None:
        while self.open:
            self.close()
        self.path = b""

    def take(self, at_least: int) -> Iterator[pa.RecordBatch]:
        if self.whole and self.whole >= at_least and self.whole == len(self.rows):
            columns = list(zip(*self.rows, strict=True))
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, f.type) for c, f in zip(columns, self.schema, strict=True)], schema=self.schema)
            self.rows, self.whole = [], 0


def _walk(skeleton: dict[bytes, int], schema: pa.Schema):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        walk, shard = _Walk(skeleton, schema), None
        for b in batches:
            shards, paths, sizes = b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2)
            least, n, ids = (b.column(i).to_pylist() for i in (3, 4, 5))
            for i, path in enumerate(paths):
                if shards[i] != shard:
                    walk.finish()
                    shard = shards[i]
                walk.read(path, sizes[i], least[i], n[i], ids[i])
                yield from walk.take(20_000)
        walk.finish()
        yield from walk.take(1)
    return run


def prefix_trie(paths: DataFrame, shards: int | None = None, splitter_turns: int = 32, sample: int = 20) -> DataFrame:
    """The nodes of the trie of ``paths`` (``conv_id``, ``path``, ``sizes``, one row per
    conversation): conv_id (smallest member), depth, parent_conv_id, n_convs, n_children,
    n_leaves, saved_tokens and ends_sha256 of the members that end there.

    ``shards`` (default: the session's shuffle partitions) bounds what tasks share: the
    splitters come from about ``sample`` paths a shard, each cut after ``splitter_turns``
    turns, so the skeleton has at most shards x splitter_turns nodes whatever the input.
    The sample decides only how even the shards are.  An empty table gives no node."""
    spark = paths.sparkSession
    shards = max(1, shards or int(spark.conf.get("spark.sql.shuffle.partitions")))
    combined = materialize(
        paths.groupBy("path", F.expr(f"shiftright(conv_id, {CHUNK_BITS})").alias("chunk"))
        .agg(F.first("sizes").alias("sizes"), F.min("conv_id").alias("least"), F.count(F.lit(1)).alias("n"),
             F.array_join(F.array_sort(F.collect_list("conv_id")), ",").alias("ids"))
        .select("path", "sizes", "chunk", "least", "n", "ids"), "distinct-paths")
    every = max(1, combined.count() // (sample * shards))
    drawn = (combined.where(F.pmod(F.xxhash64("path"), F.lit(every)) == 0)
             .select(F.substring("path", 1, KEY * splitter_turns).alias("path")).distinct())
    drawn = sorted(bytes(r["path"]) for r in drawn.collect())
    splitters = sorted({drawn[i * len(drawn) // shards] for i in range(1, shards)} - {b""}) if drawn else []
    skeleton = _skeleton(splitters)

    kind = paths.schema["conv_id"].dataType.simpleString()
    kinds = {"skel": "int", "up": "int", "conv_id": kind, "parent_conv_id": kind, "ends_sha256": "string"}
    schema = pa.schema([(c, {"int": pa.int32(), "string": pa.string()}.get(kinds.get(c, kind), pa.int64()))
                        for c in _WALKED])
    walked = materialize(
        combined.mapInArrow(_deal(splitters), f"path binary, sizes array<long>, chunk {kind}, least {kind}, n long, "
                                              "ids string, shard int")
        .repartitionById(len(splitters) + 1, "shard").sortWithinPartitions("shard", "path", "chunk")
        .select("shard", "path", "sizes", "least", "n", "ids")
        .mapInArrow(_walk(skeleton, schema), ", ".join(f"{c} {kinds.get(c, 'long')}" for c in _WALKED)), "trie-nodes")

    parts = walked.where("skel is not null").groupBy("skel").agg(
        F.min("conv_id").alias("conv_id"), F.max("depth").alias("depth"), F.max("up").alias("up"),
        F.sum("n_convs").alias("n_convs"), F.sum("n_children").alias("n_children"), F.sum("n_leaves").alias("n_leaves"),
        F.sum("saved_tokens").alias("saved_tokens"), F.max("size").alias("size"), F.max("ends_sha256").alias("ends_sha256"))
    edges = parts.groupBy(F.col("up").alias("skel")).agg(F.count(F.lit(1)).alias("more"))
    parts = materialize(parts.join(edges, "skel", "left").withColumn(
        "n_children", F.col("n_children") + F.coalesce("more", F.lit(0))).drop("more"), "skeleton-nodes")
    # every skeleton node with itself and the skeleton nodes above: bounded like the skeleton
    above = spark.createDataFrame(
        [(skeleton[p[:at]], i) for p, i in skeleton.items() for at in range(0, len(p) + 1, KEY)], "above int, skel int")
    rolled = (above.join(parts, "skel").groupBy(F.col("above").alias("skel"))
              .agg(F.sum((F.col("n_children") == 0).cast("long")).alias("leaves"),
                   F.sum((F.col("n_convs") - 1) * F.col("size")).alias("saved")))
    parents = F.broadcast(parts.select(F.col("skel").alias("up"), F.col("conv_id").alias("up_conv_id")))
    columns = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
               F.coalesce("ends_sha256", F.lit(NO_MEMBER_ENDS)).alias("ends_sha256")]
    inner = (walked.where("skel is null").join(parents, "up", "left")
             .withColumn("parent_conv_id", F.coalesce("parent_conv_id", "up_conv_id")).select(*columns))
    top = (parts.join(rolled, "skel").join(parents, "up", "left").withColumn("parent_conv_id", F.col("up_conv_id"))
           .withColumn("n_leaves", F.col("n_leaves") + F.col("leaves"))
           .withColumn("saved_tokens", F.col("saved_tokens") + F.col("saved")).select(*columns))
    return inner.unionByName(top)
