"""Scalar column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: fixed values: display pattern for timestamps (minutes, not month, after the hour)
TIME_PATTERN = "yyyy-MM-dd HH:mm"


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def format_time(c) -> Column:
    """Timestamp -> 'yyyy-MM-dd HH:mm'."""
    return F.date_format(_c(c), TIME_PATTERN)


def star_percent(rating) -> Column:
    """Width of the star bar, rating x 10; not rated (null) -> 0."""
    return (F.coalesce(_c(rating), F.lit(0)) * 10).cast("bigint")


def try_int(c) -> Column:
    """Integer parse that yields null instead of failing."""
    return _c(c).try_cast("int")


def valid_rating(rating, lo: int = 1, hi: int = 10) -> Column:
    """A parsed rating is an integer in [lo, hi]."""
    r = try_int(rating)
    return r.isNotNull() & r.between(lo, hi)
