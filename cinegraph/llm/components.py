"""Connected components of a link table, by alternating large-star and small-star rounds.

Every round is one aggregation and one join on the node; a hub's rows are combined
map-side in the aggregation, and the join has the form that adaptive execution
splits when a key is hot.  Each round's links are written to the shared checkpoint
folder, so no round recomputes an earlier one and a lost executor re-reads files.
Only two numbers a round (row count and a checksum) reach the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize


def _with_min(pairs: DataFrame) -> DataFrame:
    """(u, v, m): m is the smallest node among u and u's neighbours in ``pairs``."""
    least = pairs.groupBy("u").agg(F.min("v").alias("m0"))
    return pairs.join(least, "u").select("u", "v", F.least("u", "m0").alias("m"))


def _large_star(links: DataFrame) -> DataFrame:
    both = links.select("u", "v").union(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    return (_with_min(both).where(F.col("v") > F.col("u"))
            .select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct())


def _small_star(links: DataFrame) -> DataFrame:
    """``links`` have u > v."""
    found = _with_min(links)
    return (found.select(F.col("v").alias("u"), F.col("m").alias("v"))
            .union(found.select("u", F.col("m").alias("v")))
            .where("u <> v").distinct())


def _state(links: DataFrame) -> tuple:
    row = links.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
    return row[0], row[1]


def components(links: DataFrame, max_rounds: int = 60) -> DataFrame:
    """(node, component) for every node of ``links`` (two columns of comparable ids);
    component is the smallest node reachable.  Nodes without links are not returned;
    self-links and repeated links count once; an empty table gives an empty table.
    ``max_rounds`` only guards against a fault: it raises, it does not cut."""
    a, b = links.columns[:2]
    now = (links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
           .where("u <> v").distinct())
    now = materialize(now, "links")
    state = _state(now)
    for _ in range(max_rounds):
        if not state[0]:
            break
        now = materialize(_small_star(_large_star(now)), "links")
        before, state = state, _state(now)
        if state == before:
            break
    else:
        raise RuntimeError(f"components did not converge in {max_rounds} rounds")
    return (now.select(F.col("u").alias("node"), F.col("v").alias("component"))
            .union(now.select(F.col("v").alias("node"), F.col("v").alias("component"))).distinct())
