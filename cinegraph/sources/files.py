"""Raw file scans.

File order matters to the catalog build (first row wins, first-seen ids).  CSV
rows carry no line number, so ``row_ord`` is read in the scan stage, before any
shuffle: (file name, split start, position in the task).  A task reads its
splits in order and ``monotonically_increasing_id`` increases inside a task, so
the triple orders rows as in the files (files by name).  Once the rows are staged the name
becomes the file's number, so that shuffles need not carry it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import schemas
from ..functions.lists import join_list
from ..session import materialize

CORRUPT = "_corrupt_record"


def _with_row_ord(df: DataFrame) -> DataFrame:
    return df.select(F.struct(F.input_file_name().alias("f"), F.input_file_block_start().alias("b"),
                              F.monotonically_increasing_id().alias("i")).alias("row_ord"), "*")


def _file_numbers(staged: DataFrame) -> DataFrame:
    """``staged`` with files' numbers (in order of their names) for their names in ``row_ord``."""
    # one row per file
    files = staged.select(F.col("row_ord.f").alias("_f")).distinct().withColumn(
        "_n", F.row_number().over(Window.orderBy("_f")).cast("long"))
    named = staged.join(F.broadcast(materialize(files, "csv-files")), F.col("row_ord.f") == F.col("_f"))
    return named.withColumn("row_ord", F.struct(F.col("_n").alias("f"), F.col("row_ord.b").alias("b"), F.col("row_ord.i").alias("i"))).drop("_f", "_n")


def _checked_csv(spark: SparkSession, path: str, fields: T.StructType, **options) -> tuple[DataFrame, DataFrame]:
    """(rows, malformed lines): lines with another number of cells than the schema, or a cell
    that does not parse, are kept aside with their text (PERMISSIVE mode + corrupt-record
    column).  The parse is staged once as parquet in the shared checkpoint folder: both
    outputs read it, and Spark does not allow queries on the corrupt column of a raw scan."""
    # a new schema: StructType.add would change the shared constant in place
    schema = T.StructType(fields.fields + [T.StructField(CORRUPT, T.StringType())])
    reader = (spark.read.schema(schema).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", CORRUPT)
              .options(**options))
    df = _file_numbers(materialize(_with_row_ord(reader.csv(path)), "csv-parsed"))
    return df.where(F.col(CORRUPT).isNull()).drop(CORRUPT), df.where(F.col(CORRUPT).isNotNull())


def read_movie_csv(spark: SparkSession, path: str, header: bool = True,
                   sep: str = ",") -> tuple[DataFrame, DataFrame]:
    """Raw movie rows -> (rows, malformed rows); the column names override any header
    (the header line, when present, is skipped)."""
    return _checked_csv(spark, path, schemas.RAW_MOVIE_CSV, header=header, sep=sep)


def read_rating_csv(spark: SparkSession, path: str, header: bool = True,
                    time_format: str | None = None) -> tuple[DataFrame, DataFrame]:
    """S2 + X4: raw rating rows with parsed timestamps -> (rows, malformed rows)."""
    formats = {"timestampNTZFormat": time_format} if time_format else {}
    return _checked_csv(spark, path, schemas.RAW_RATING_CSV, header=header, **formats)


def normalise_crawl(responses: DataFrame, body: str = "body") -> tuple[DataFrame, DataFrame]:
    """S3 (+X2, X10): crawl responses -> (one row per movie, rejected responses).

    ``responses`` has the request facets (form, Type, country, genres) and the
    response text in ``body`` ({"data": [{directors, rate, title, casts, cover}]}).
    Lists are joined with '|', a missing rate is 0 and an unreadable one null.  A body
    that is no such object (truncated, HTML, null) is a reject with all its columns;
    only an empty data list gives neither."""
    bad = "_malformed"
    schema = T.StructType(schemas.CRAWL_RESPONSE.fields + [T.StructField(bad, T.StringType())])
    parsed = responses.withColumn("_r", F.from_json(
        F.col(body), schema, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": bad}))
    broken = F.col("_r").isNull() | F.col(f"_r.{bad}").isNotNull() | F.col("_r.data").isNull()
    items = parsed.where(~broken).select("form", "Type", "country", "genres", F.explode("_r.data").alias("m"))
    rate = F.col("m.rate")
    rows = items.select(
        join_list(F.col("m.directors")).alias("directors"),
        F.when(rate.isNull() | (F.trim(rate) == ""), F.lit(0.0)).otherwise(rate.try_cast("double")).alias("rate"),
        F.col("m.title").alias("title"),
        join_list(F.col("m.casts")).alias("casts"),
        "form", "Type", "country", "genres")
    return rows, parsed.where(broken).drop("_r")


#: fixed value: the tokens of a payload, a one-decimal number or words joined by single separators
TOKEN_PATTERN = r"(?U)\d\.\d|\w+(?:[ ，\-：·！。？()]\w*)*"


def crawl_tokens(body) -> F.Column:
    """X3 raw form: a payload's tokens, as an array of matches (Unicode words)."""
    body = F.col(body) if isinstance(body, str) else body
    return F.regexp_extract_all(body, F.lit(TOKEN_PATTERN), 0)


def read_crawl_responses(spark: SparkSession, path: str) -> DataFrame:
    """Crawl responses stored as JSON lines {form, Type, country, genres, start, body}."""
    return spark.read.schema("form string, Type string, country string, genres string, start long, body string") \
        .json(path)
