"""Catalog tables and file sinks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import schemas
from ..operators.ids import dense_index
from ..session import measured


def use_database(spark: SparkSession, name: str) -> None:
    """Create the database when missing and make it current."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{name}`")
    spark.catalog.setCurrentDatabase(name)


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Cast and order columns to a target schema."""
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])


#: bytes of a published file, about
FILE_BYTES = 256 << 20


def publish(df: DataFrame, table: str, schema: T.StructType | None = None, key: str | None = "id",
            num_files: int | None = None, file_bytes: int = FILE_BYTES) -> DataFrame:
    """K1: full-refresh publish.  Rows are range-partitioned and sorted on ``key`` so
    each file holds a disjoint id range and point/range lookups prune row groups
    by their statistics.  The rows are written once before (the range bounds are sampled
    from there, not from the plan), which tells their size and so the number of files.
    Returns the table as read back."""
    spark = df.sparkSession
    out = conform(df, schema) if schema is not None else df
    if key:
        out, size = measured(out, "publish")
        out = out.repartitionByRange(num_files or max(1, -(-size // file_bytes)), key).sortWithinPartitions(key)
    out.write.mode("overwrite").format("parquet").saveAsTable(table)
    return spark.table(table)


def publish_all(frames: dict[str, DataFrame], prefix: str = "") -> dict[str, DataFrame]:
    """K2: publish several tables under their registered schemas."""
    return {name: publish(df, prefix + name, schemas.TABLES.get(name)) for name, df in frames.items()}


def scan(spark: SparkSession, table: str, *cols: str) -> DataFrame:
    """Projected table scan (only these columns are read)."""
    df = spark.table(table)
    return df.select(*cols) if cols else df


def preview(spark: SparkSession, table: str, n: int = 20, key: str = "id") -> DataFrame:
    """The first ``n`` rows by id."""
    return spark.table(table).orderBy(key).limit(n)


def refresh(spark: SparkSession, table: str) -> None:
    """Drop cached metadata/files of a table before reading it again."""
    spark.catalog.refreshTable(table)


def append_ratings(spark: SparkSession, table: str, new: DataFrame, as_of=None) -> DataFrame:
    """K3: append ratings (uid, mid, rating[, time]); ids continue after the table's
    max id in (time, uid, mid) order; a missing time is ``as_of`` or now (X6).
    One writer per table (ids are not safe under concurrent appends)."""
    cur = spark.table(table)
    start = F.lit(cur.agg(F.max("id")).first()[0])   # one scalar, read before the append
    now = F.lit(as_of).cast("timestamp_ntz") if as_of is not None else F.localtimestamp()
    rows = new.select("uid", "mid", "rating",
                      (F.col("time") if "time" in new.columns else now).cast("timestamp_ntz").alias("time"))
    with_ids = dense_index(rows, ["time", "uid", "mid"], out="_ix")
    out = with_ids.withColumn("id", F.coalesce(start, F.lit(-1)) + 1 + F.col("_ix"))
    conform(out, schemas.RATING).write.mode("append").format("parquet").saveAsTable(table)
    return spark.table(table)


def append_csv(df: DataFrame, path: str, header: bool = False) -> None:
    """K4: append rows to a header-less CSV folder."""
    df.write.mode("append").option("header", header).csv(path)
