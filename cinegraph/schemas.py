"""Schemas of the published tables and the raw inputs (all fixed by the data model)."""

from pyspark.sql import types as T

L, S, D, TS = T.LongType(), T.StringType(), T.DoubleType(), T.TimestampNTZType()
ARR = T.ArrayType(T.LongType())


def _s(*fields):
    return T.StructType([T.StructField(n, t) for n, t in fields])


MOVIE = _s(("id", L), ("name", S), ("genres", ARR), ("actors", ARR), ("district", L),
           ("directors", ARR), ("traits", ARR), ("rating", D))
DIMENSION = _s(("id", L), ("name", S), ("movies", ARR))
RATING = _s(("id", L), ("uid", L), ("mid", L), ("time", TS), ("rating", L))
USER = DIMENSION

RAW_MOVIE_CSV = _s(("genre", S), ("actor", S), ("district", S), ("director", S), ("trait", S),
                   ("rating", D), ("name", S))
RAW_RATING_CSV = _s(("rating", L), ("name", S), ("time", TS), ("uid", L), ("movie", S))

CRAWL_ITEM = _s(("directors", T.ArrayType(S)), ("rate", S), ("title", S), ("casts", T.ArrayType(S)),
                ("cover", S))
CRAWL_RESPONSE = T.StructType([T.StructField("data", T.ArrayType(CRAWL_ITEM))])
CRAWL_ROW = _s(("directors", S), ("rate", D), ("title", S), ("casts", S), ("form", S), ("Type", S),
               ("country", S), ("genres", S))

#: table name -> schema, for publishing (K2)
TABLES = {"movie": MOVIE, "actor": DIMENSION, "director": DIMENSION, "genre": DIMENSION,
          "district": DIMENSION, "trait": DIMENSION, "rating": RATING, "user": USER}
