"""Mixing sources to target weights, in DataFrame functions only.

Words are counted per document, summed per source, and the target of every source found
by water filling: the total to take is shared by weight, a source that would pass its cap
is held there, and what it leaves over is shared again among the others.  Documents are
emitted floor(rate) times, rate = target / size of the source, plus one copy with the
probability of the fraction, drawn from a hash of id, source and text, and for rows that
repeat as a whole from their number among them: reruns agree, and rows that share an id
(or have none) draw each for itself.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.ids import dense_index
from ..session import materialize
from .common import WORD, fresh

# The weights of the sources in code-point order, repeating.
WEIGHTS = (3, 1, 2)


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def row_key(doc_id: Column, source: Column, text: Column) -> Column:
    """What a row draws by: an MD5 of its id, source and text (nulls have keys of their own)."""
    digests = [F.md5(F.coalesce(F.concat(F.lit("="), c), F.lit("null"))) for c in (source, text)]
    return F.md5(F.concat_ws(":", F.coalesce(doc_id.cast("string"), F.lit("null")), *digests))


def draw(key: Column, occurrence: Column, seed: int) -> Column:
    """A number in [0, 1): 52 bits of an MD5."""
    digest = F.md5(F.concat_ws(":", F.lit(str(seed)), key, occurrence.cast("string")))
    return F.conv(F.substring(digest, 1, 13), 16, 10).cast("double") / F.lit(float(1 << 52))


def with_occurrence(rows: DataFrame, key: str, out: str) -> DataFrame:
    """``rows`` with their number (from 0) among the rows of one ``key``.  Only repeated rows
    are numbered, and a key's rows may lie in many tasks."""
    of, place = fresh(rows, "repeated_key", "repeated_place")
    repeated = materialize(rows.groupBy(key).count().where("count > 1").select(F.col(key).alias(of)), "repeated-rows")
    if repeated.isEmpty():
        return rows.withColumn(out, F.lit(0).cast("long"))
    single = rows.join(repeated, F.col(key) == F.col(of), "left_anti").withColumn(out, F.lit(0).cast("long"))
    again = rows.join(repeated, F.col(key) == F.col(of), "left_semi").withColumn(place, F.monotonically_increasing_id())
    return single.unionByName(dense_index(again, [place], out=out, group=[key], native=True).drop(place))


def source_targets(sizes: DataFrame, weights=WEIGHTS, share: float = 1.5, cap: float = 2.0) -> DataFrame:
    """(source, source_size, target) from (source, size) rows, one row per source (null is
    a source, the last one).  The targets add up to share * all sizes and none exceeds
    cap * its source's size (share <= cap)."""
    if not 0 <= share <= cap:
        raise ValueError("share must not exceed cap")
    per_source = materialize(sizes.groupBy("source").agg(F.sum("size").alias("source_size")), "source-sizes")
    ranked = dense_index(per_source.withColumn("last", F.col("source").isNull()), ["last", "source"], out="rank")
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]),
                          (F.col("rank") % len(weights) + 1).cast("int"))
    sources = materialize(ranked.select("source", "source_size", weight.alias("weight"),
                                        (F.col("source_size") * F.lit(cap)).alias("most")), "source-weights")
    total = sources.agg(F.sum("source_size")).first()[0] or 0
    level, held = 0.0, -1
    while True:                                       # each round holds at least one more source
        over = F.col("weight") * F.lit(level) > F.col("most")
        got = sources.agg(F.count_if(over), F.sum(F.when(over, F.col("most")).otherwise(0.0)),
                          F.sum(F.when(over, 0.0).otherwise(F.col("weight")))).first()
        if got[0] is None or got[0] == held or not got[2]:
            break
        held, level = got[0], (share * total - got[1]) / got[2]
    return sources.select("source", "source_size", F.least("most", F.col("weight") * F.lit(level)).alias("target"))


def copies(source_size: Column, target: Column, drawn: Column) -> Column:
    """How often the mix takes a document."""
    rate = F.when(source_size > 0, target / source_size).otherwise(F.lit(0.0))
    return (F.floor(rate) + (drawn < rate - F.floor(rate)).cast("long")).cast("long")


def plan_mix(docs: DataFrame, weights=WEIGHTS, share: float = 1.5, cap: float = 2.0, seed: int = 20) -> DataFrame:
    """(doc_id, source, size, source_size, target, copies), one row per document row.

    Null and empty texts have size 0; null sources are one source; null and shared ids
    draw by source and text too, rows repeated as a whole by their number; only
    ``doc_id``, ``text`` and ``source`` are read; no rows give no rows."""
    key = row_key(F.col("doc_id"), F.col("source"), F.col("text"))
    sized = materialize(docs.select("doc_id", "source", word_count(F.col("text")).alias("size"), key.alias("key")),
                        "document-sizes")
    targets = source_targets(sized.select("source", "size"), weights, share, cap).withColumnRenamed("source", "of")
    # a written side of one row per source: broadcast only under the size threshold,
    # else a sort-merge join whose hot source adaptive execution splits
    return (with_occurrence(sized, "key", "nth").join(targets, F.col("source").eqNullSafe(F.col("of")))
            .select("doc_id", "source", "size", "source_size", "target",
                    copies(F.col("source_size"), F.col("target"), draw(F.col("key"), F.col("nth"), seed)).alias("copies")))


def mix(docs: DataFrame, weights=WEIGHTS, share: float = 1.5, cap: float = 2.0, seed: int = 20) -> DataFrame:
    """The mixed rows of ``docs`` with all their columns, each as often as it is taken.

    Nulls, empty texts, repeated rows and shared ids as in ``plan_mix`` (rows that repeat in
    id, source and text may differ in other columns); other columns may be called
    anything; very long texts are rows like others; no rows give no rows."""
    sizes = docs.select("source", word_count(F.col("text")).alias("size"))
    of, size, target, n, key, nth = fresh(docs, "mix_source", "mix_size", "mix_target", "mix_copy", "mix_key", "mix_nth")
    targets = source_targets(sizes, weights, share, cap).toDF(of, size, target)
    keyed = docs.withColumn(key, row_key(F.col("doc_id"), F.col("source"), F.col("text")))
    taken = copies(F.col(size), F.col(target), draw(F.col(key), F.col(nth), seed)).cast("int")
    return (with_occurrence(keyed, key, nth).join(targets, F.col("source").eqNullSafe(F.col(of)))
            .withColumn(n, F.explode(F.array_repeat(F.lit(1), taken)))
            .drop(of, size, target, n, key, nth))
