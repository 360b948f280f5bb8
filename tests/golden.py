"""The golden set of FIXTURES.md section 1 as Spark frames."""

import datetime as dt

from pyspark.sql import types as T

CAST = "徐峥|王传君|周一围|谭卓|章宇"
MOVIE_ROWS = [
    (0, "剧情", CAST, "中国大陆", "文牧野", "经典", 8.9, "我不是药神"),
    (1, "剧情", CAST, "中国大陆", "文牧野", "感人", 8.9, "我不是药神"),
    (2, "喜剧", CAST, "中国大陆", "文牧野", "经典", 9.0, "我不是药神"),
    (3, "喜剧", CAST, "中国大陆", "文牧野", "搞笑", 9.0, "我不是药神"),
    (4, "喜剧", CAST, "中国大陆", "文牧野", "感人", 9.0, "我不是药神"),
    (5, "犯罪", CAST, "中国大陆", "文牧野", "感人", 9.0, "我不是药神"),
    (6, "犯罪", CAST, "中国大陆", "文牧野", "搞笑", 9.0, "我不是药神"),
    (7, "喜剧", "A|徐峥", "美国", "B", "经典", 7.0, "M2"),
    (8, "剧情", "C", "美国", "文牧野", "感人", 5.0, "M3"),
]
MOVIE_SCHEMA = T.StructType([T.StructField(n, t) for n, t in [
    ("row_ord", T.LongType()), ("genre", T.StringType()), ("actor", T.StringType()),
    ("district", T.StringType()), ("director", T.StringType()), ("trait", T.StringType()),
    ("rating", T.DoubleType()), ("name", T.StringType())]])

RATING_ROWS = [
    (0, 8, "ann", dt.datetime(2019, 1, 1), 77, "我不是药神"),
    (1, 3, "ann", dt.datetime(2019, 2, 1), 77, "我不是药神"),
    (2, 5, "bob", dt.datetime(2019, 1, 3), 12, "M2"),
    (3, 9, "bob", dt.datetime(2019, 1, 4), 12, "M3"),
    (4, 9, "cy", dt.datetime(2019, 1, 5), 30, "Unknown"),
    (5, 2, "dan", dt.datetime(2019, 1, 6), 31, "M2"),
]
RATING_SCHEMA = T.StructType([T.StructField(n, t) for n, t in [
    ("row_ord", T.LongType()), ("rating", T.LongType()), ("name", T.StringType()),
    ("time", T.TimestampNTZType()), ("uid", T.LongType()), ("movie", T.StringType())]])


def movie_raw(spark):
    return spark.createDataFrame(MOVIE_ROWS, MOVIE_SCHEMA)


def rating_raw(spark):
    return spark.createDataFrame(RATING_ROWS, RATING_SCHEMA)
