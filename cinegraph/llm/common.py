"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: white space of the word rules: space and 0x09-0x0D
WORD = r"[^\x20\x09-\x0D]+"

#: A-Z to a-z on UTF-8 bytes; other bytes stay
LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def fresh(df: DataFrame, *bases: str) -> list[str]:
    """Column names that ``df`` does not use yet (its own may be called anything)."""
    taken = {c.lower() for c in df.columns}
    out = []
    for base in bases:
        name, i = base, 0
        while name.lower() in taken:
            i += 1
            name = f"{base}_{i}"
        taken.add(name.lower())
        out.append(name)
    return out


def hashed_fold(doc_id: Column, folds: int) -> Column:
    """crc32(doc_id as text) mod folds; null ids are in no fold (null)."""
    return F.crc32(F.encode(doc_id.cast("string"), "UTF-8")) % F.lit(folds)


def texts(column: pa.Array) -> Iterator[str]:
    """The strings of an Arrow column one by one, null as empty."""
    for value in column:
        yield value.as_py() or ""
