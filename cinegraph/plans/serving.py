"""The read side of the catalog, as set-oriented jobs over all keys.

The reference answers one id per request with an IN-list per lookup and a loop of
point queries.  Here each page type is one job over every key; a caller that needs
some keys semi-joins a request table (F1/F2), which has no list-size limit and an
empty request simply yields no rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.scalars import format_time, star_percent
from ..operators.ids import dense_index
from ..operators.latest import latest_per_key
from ..operators.select import permuted
from ..operators.topk import page
from .catalog import Catalog, dimension_rows

PAGE_SIZE = 20


def lookup(table: DataFrame, requests: DataFrame, key: str = "id", req_key: str | None = None) -> DataFrame:
    """rows of ``table`` whose key is requested (left semi join)."""
    req = requests.select(F.col(req_key or key).alias(key))
    return table.join(req, key, "left_semi")


def movie_detail(cat: Catalog) -> DataFrame:
    """Every movie with district name (J1) and, as arrays of (id, name), its actors
    and directors (list order), traits and genres (id order) (J3).  One tagged union and
    one aggregation on the movie; a movie's lists are bounded by its raw rows' cells."""
    bridges = {"actors": (cat.movie_actor, "aid", "pos", "actor"),
               "directors": (cat.movie_director, "did", "pos", "director"),
               "traits": (cat.movie_trait, "tid", None, "trait"),
               "genres": (cat.movie_genre, "gid", None, "genre")}
    tagged = None
    for kind, (bridge, idcol, pos, dim) in bridges.items():
        rows = bridge.join(cat.names[dim].withColumnRenamed("id", idcol), idcol).select(
            "mid", F.lit(kind).alias("kind"), (F.col(pos).cast("long") if pos else F.col(idcol)).alias("pos"),
            F.col(idcol).alias("id"), "name")
        tagged = rows if tagged is None else tagged.unionByName(rows)

    def listed(kind):
        found = F.array_sort(F.collect_list(F.when(F.col("kind") == kind, F.struct("pos", "id", "name"))))
        return F.transform(found, lambda s: F.struct(s["id"].alias("id"), s["name"].alias("name"))).alias(kind)
    lists = tagged.groupBy("mid").agg(*[listed(kind) for kind in bridges]).withColumnRenamed("mid", "_mid")
    district = cat.names["district"].select(F.col("id").alias("district"), F.col("name").alias("district_name"))
    none = F.array().cast("array<struct<id:bigint,name:string>>")
    return (cat.movie.join(district, "district", "left").join(lists, F.col("id") == F.col("_mid"), "left")
            .select("id", "name", "rating", F.col("district_name").alias("district"),
                    *[F.coalesce(F.col(kind), none).alias(kind) for kind in bridges]))


def latest_ratings(rating: DataFrame) -> DataFrame:
    """W1 on the rating table: newest (time, then id) per (uid, mid)."""
    return latest_per_key(rating, ["uid", "mid"], ["time", "id"], ["id", "time", "rating"])


def my_ratings(requests: DataFrame, rating: DataFrame) -> DataFrame:
    """F5 + W1 + X7: for requested (uid, mid) pairs, my latest rating (0 if none)
    and the star-bar width."""
    latest = latest_ratings(rating).select("uid", "mid", F.col("rating").alias("myrating"))
    req = requests.select("uid", "mid").distinct()
    out = req.join(latest, ["uid", "mid"], "left")
    return out.select("uid", "mid", F.coalesce("myrating", F.lit(0)).cast("bigint").alias("myrating"),
                      star_percent("myrating").alias("stars"))


def person_page(cat: Catalog, dim: str) -> DataFrame:
    """C4: each person (actor or director) with their movies by rating desc, id asc."""
    rows = dimension_rows(cat, dim)
    movies = cat.movie.select(F.col("id").alias("mid"), F.col("name").alias("movie"), "rating")
    return rows.join(movies, "mid").select("id", "name", "pos", "mid", "movie", "rating")


def user_history(rating: DataFrame, user: DataFrame, movie: DataFrame) -> DataFrame:
    """Each user with the latest rating per movie, newest first (time desc,
    mid asc), movie name and display time (X5)."""
    latest = latest_ratings(rating)
    ranked = dense_index(latest.select("uid", "mid", "time", "rating"),
                         [F.col("time").desc(), F.col("mid").asc()], out="pos", group=["uid"])
    movies = movie.select(F.col("id").alias("mid"), F.col("name").alias("movie"))
    users = user.select(F.col("id").alias("uid"), F.col("name").alias("user"))
    return (ranked.join(users, "uid").join(movies, "mid")
                  .select("uid", "user", "pos", "mid", "movie", "time", format_time("time").alias("time_text"),
                          "rating"))


def paged(table: DataFrame, cols, page_size: int = PAGE_SIZE) -> DataFrame:
    """Every row with its page (dense ids: page = id div size) and the
    page's navigation flags: previous when page > 0, next when the page is full."""
    t = table.select("id", *cols).withColumn("page", F.floor(F.col("id") / page_size).cast("bigint"))
    count = table.select(F.count(F.lit(1))).scalar()      # ids are dense: a page is full if the table reaches its end
    return t.select("page", "id", *cols, (F.col("page") > 0).alias("has_prev"),
                    ((F.col("page") + 1) * page_size <= count).alias("has_next"))


def page_of(table: DataFrame, page_no: int, cols, page_size: int = PAGE_SIZE) -> DataFrame:
    """one page as a half-open id range (pushed to the scan), ordered by id."""
    return page(table.select("id", *cols), page_no, page_size)


def home(cat: Catalog, per_kind: int = 4) -> DataFrame:
    """First ``per_kind`` rows of page 0 for movies (with their rating), actors
    and directors."""
    no_rating = F.lit(None).cast("double").alias("rating")
    parts = [("movie", cat.movie), ("actor", cat.names["actor"].select("*", no_rating)),
             ("director", cat.names["director"].select("*", no_rating))]
    frames = [page_of(df, 0, ["name", "rating"]).limit(per_kind).select(F.lit(k).alias("kind"), "id", "name", "rating")
              for k, df in parts]
    return frames[0].unionByName(frames[1]).unionByName(frames[2])


def random_users(user: DataFrame, n: int = 5, seed: int = 0) -> DataFrame:
    """(pos, id, name) of n different users in random order.  Ids are dense, so
    the positions of a seeded permutation are ids, looked up without sorting the users."""
    size = user.count()
    ids = [(k, permuted(k, size, seed)) for k in range(min(n, size))]
    chosen = user.sparkSession.createDataFrame(ids, "pos long, id long")          # n rows
    return F.broadcast(chosen).join(user.select("id", "name"), "id").select("pos", "id", "name")
