"""The latest row per key, and A1/A4: the first row per key.

Both are aggregations with ``max_by`` / ``min_by`` over an ordering struct, so the
map side combines partially before the shuffle (a window would sort and ship
every row).  The ordering must be total inside a key for a deterministic answer.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _pick(df: DataFrame, keys, order, values, fn) -> DataFrame:
    keys = list(keys)
    values = [v for v in (values or [c for c in df.columns if c not in keys])]
    ordering = F.struct(*[F.col(c) for c in order])
    picked = df.groupBy(*keys).agg(fn(F.struct(*[F.col(v) for v in values]), ordering).alias("_v"))
    return picked.select(*keys, *[F.col(f"_v.{v}").alias(v) for v in values])


def latest_per_key(df: DataFrame, keys, order, values=None) -> DataFrame:
    """One row per ``keys``: the values of the row with the largest ``order``."""
    return _pick(df, keys, order, values, F.max_by)


def first_per_key(df: DataFrame, keys, order, values=None) -> DataFrame:
    """One row per ``keys``: the values of the row with the smallest ``order``
    (first row wins)."""
    return _pick(df, keys, order, values, F.min_by)
