"""Delimited lists and ordered arrays."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def split_list(c, sep: str = "|") -> Column:
    """Split a delimited cell; empty tokens dropped; null or '' -> empty array."""
    c = F.col(c) if isinstance(c, str) else c
    parts = F.split(F.coalesce(c, F.lit("")), "\\" + sep if sep in "|.^$*+?()[]{}\\" else sep)
    return F.filter(parts, lambda x: x != "")


def join_list(c, sep: str = "|") -> Column:
    """Join an array with ``sep`` (no trailing separator); null -> ''."""
    c = F.col(c) if isinstance(c, str) else c
    return F.coalesce(F.array_join(F.transform(c, lambda x: x.cast("string")), sep), F.lit(""))


def ordered_values(pairs: Column, value: str) -> Column:
    """Array of structs sorted by their leading fields -> array of one field."""
    return F.transform(F.array_sort(pairs), lambda s: s[value])
