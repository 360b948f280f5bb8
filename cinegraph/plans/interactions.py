"""Raw rating rows -> rating + user tables.

 * movie names resolve to movie ids by an inner join (J4); rows naming an unknown
   movie go to a reject table (``strict=True`` raises instead) and give their user
   no id;
 * users get dense first-seen ids over resolved rows (W2);
 * the first row per (user, movie) wins (A4); rating ids are dense in the order of
   those first rows;
 * each user lists the distinct movies rated, by movie rating desc, id asc (A5),
   kept in row form (id, name, pos, mid).
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.lists import ordered_values
from ..operators.ids import dense_index
from ..operators.latest import first_per_key


class Interactions:
    """The tables of a resolved rating file, each built when first asked for.

    rating (id, uid, mid, time, rating); user (id, name); rejects: raw rows naming unknown
    movies or no user."""

    def __init__(self, raw: DataFrame, movie: DataFrame):
        self._raw = raw.select("row_ord", "rating", "name", "time", "uid", "movie")
        self._names = movie.select(F.col("id").alias("mid"), F.col("name").alias("movie"))

    @cached_property
    def rejects(self) -> DataFrame:
        named = self._raw.where(F.col("name").isNotNull())
        return named.join(self._names, "movie", "left_anti").unionByName(self._raw.where(F.col("name").isNull()))

    @cached_property
    def _numbered(self) -> DataFrame:
        """The first row of each (user, movie), numbered in file order: the only table of all
        ratings that is written."""
        resolved = self._raw.where(F.col("name").isNotNull()).join(self._names, "movie").select(
            "row_ord", F.col("name").alias("uname"), "mid", "time", F.col("rating").cast("long").alias("rating"))
        firsts = first_per_key(resolved, ["uname", "mid"], ["row_ord"], ["row_ord", "time", "rating"])
        return dense_index(firsts, ["row_ord"], out="id").select(
            F.col("id").cast("long").alias("id"), "uname", "mid", "time", "rating")

    @cached_property
    def user(self) -> DataFrame:
        # a user's first row is the first row of one of the user's movies
        seen = self._numbered.groupBy("uname").agg(F.min("id").alias("first"))
        return dense_index(seen, ["first"], out="id").select(F.col("id").cast("long").alias("id"), F.col("uname").alias("name"))

    @cached_property
    def rating(self) -> DataFrame:
        users = self.user.select(F.col("id").alias("uid"), F.col("name").alias("uname"))
        return self._numbered.join(users, "uname").select("id", "uid", "mid", "time", "rating")


class UnknownMovieError(ValueError):
    pass


def build_interactions(raw: DataFrame, movie: DataFrame, strict: bool = False) -> Interactions:
    """raw(row_ord, rating, name, time, uid, movie); movie(id, name, rating)."""
    found = Interactions(raw, movie)
    if strict and not found.rejects.isEmpty():
        raise UnknownMovieError("rating rows name no user, or movies missing from the catalog")
    return found


def user_rows(inter: Interactions, movie: DataFrame) -> DataFrame:
    """A5 in row form: (id, name, pos, mid), the user's distinct rated movies by
    movie rating desc, mid asc."""
    pairs = inter.rating.select("uid", "mid").distinct().join(
        movie.select(F.col("id").alias("mid"), "rating"), "mid")
    ranked = dense_index(pairs, [F.col("rating").desc(), F.col("mid").asc()], out="pos", group=["uid"])
    return ranked.join(inter.user.withColumnRenamed("id", "uid"), "uid").select(
        F.col("uid").alias("id"), "name", "pos", "mid")


def user_table(inter: Interactions, movie: DataFrame) -> DataFrame:
    """The published ``user`` schema (id, name, movies array); collects one row
    per user -- prefer ``user_rows`` at scale."""
    rows = user_rows(inter, movie)
    lists = rows.groupBy("id").agg(ordered_values(F.collect_list(F.struct("pos", "mid")), "mid").alias("movies"))
    return inter.user.join(lists, "id", "left").select(
        "id", "name", F.coalesce("movies", F.array().cast("array<bigint>")).alias("movies"))
