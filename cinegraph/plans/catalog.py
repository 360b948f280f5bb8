"""Raw, redundant movie rows -> movie table + five dimensions.

Semantics (file order = ``row_ord``):
 * a movie is a distinct name; its first row gives actors, directors, district and
   rating (A1); genres and traits are the union over all its rows (A2);
 * every id is dense, zero-based, in first-seen order (W2): movies by first row;
   districts, actors and directors by the first *movie-first* row that names them
   (actors/directors then by list position); genres and traits over all rows;
 * each dimension lists its distinct movies by movie rating desc, id asc (A3).

All lists are kept as bridge tables; the array-column tables of the published
schema are assembled from them (``movie_table``, ``dimension_table``).  Per-movie
arrays are bounded by one raw row's cells; a dimension's movie list is not (one
genre may hold a third of all movies), so the scalable form of a dimension is the
row form ``dimension_rows`` (id, name, pos, mid), positions assigned by a
range-partitioned dense index rather than a window per dimension.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.lists import ordered_values, split_list
from ..operators.ids import dense_index
from ..operators.latest import first_per_key
from ..session import materialize

#: bits of a place in a movie's list (a cell holds fewer than 2^24 names)
POS_BITS = 24

DIMENSIONS = ("actor", "director", "genre", "district", "trait")


@dataclass
class Catalog:
    movie: DataFrame          # id, name, district, rating
    movie_actor: DataFrame    # mid, pos, aid
    movie_director: DataFrame  # mid, pos, did
    movie_genre: DataFrame    # mid, gid
    movie_trait: DataFrame    # mid, tid
    names: dict               # dimension -> (id, name)
    rejects: DataFrame        # raw rows without a movie name

    def bridge(self, dim: str) -> DataFrame:
        """(id, mid) distinct pairs of a dimension."""
        if dim == "actor":
            return self.movie_actor.select(F.col("aid").alias("id"), "mid").distinct()
        if dim == "director":
            return self.movie_director.select(F.col("did").alias("id"), "mid").distinct()
        if dim == "genre":
            return self.movie_genre.select(F.col("gid").alias("id"), "mid")
        if dim == "trait":
            return self.movie_trait.select(F.col("tid").alias("id"), "mid")
        if dim == "district":
            return self.movie.select(F.col("district").alias("id"), F.col("id").alias("mid"))
        raise ValueError(dim)

    def people_bridge(self) -> DataFrame:
        """(mid, role, pid) over actors and directors, for recall."""
        return (self.movie_actor.select("mid", F.lit("a").alias("role"), F.col("aid").alias("pid"))
                .unionByName(self.movie_director.select("mid", F.lit("d").alias("role"),
                                                        F.col("did").alias("pid"))))


def build_catalog(raw: DataFrame, sep: str = "|") -> Catalog:
    """raw(row_ord, genre, actor, district, director, trait, rating, name);
    ``row_ord`` is any orderable column (long or struct) giving file order.

    Movies are numbered first.  The people and districts of movies are then numbered by
    (movie id, list position), one number that aggregates without sorting, genres and
    traits by file order."""
    staged = materialize(raw.select("row_ord", "genre", "actor", "district", "director", "trait",
                                    "rating", "name"), "catalog-raw")
    rejects = staged.where(F.col("name").isNull())
    raw = staged.where(F.col("name").isNotNull())
    # one row per movie (its first row), read by all branches below
    first = first_per_key(raw, ["name"], ["row_ord"], ["row_ord", "actor", "district", "director", "rating"])
    movies = dense_index(first, ["row_ord"], out="mid").withColumn("mid", F.col("mid").cast("long"))
    movie_ids = movies.select("mid", "name")

    def occurrences(col):
        return movies.select("mid", F.posexplode(split_list(col, sep)).alias("pos", "pname"))

    def first_seen(df, kind, col, k):
        return df.where(F.col(col).isNotNull()).groupBy(F.col(col).alias("name")).agg(F.min(k).alias("k")).select(
            F.lit(kind).alias("kind"), "name", "k")

    place = F.shiftleft("mid", POS_BITS) + F.col("pos")
    of_movies = (first_seen(movies, "district", "district", F.shiftleft("mid", POS_BITS))
                 .unionByName(first_seen(occurrences("actor"), "actor", "pname", place))
                 .unionByName(first_seen(occurrences("director"), "director", "pname", place)))
    of_rows = (first_seen(raw, "genre", "genre", F.col("row_ord"))
               .unionByName(first_seen(raw, "trait", "trait", F.col("row_ord"))))
    ids = {}
    for keys, kinds in ((of_movies, ("district", "actor", "director")), (of_rows, ("genre", "trait"))):
        numbered = dense_index(keys, ["k"], out="id", group=["kind"])
        ids |= {k: numbered.where(F.col("kind") == k).select("id", "name") for k in kinds}

    def names(kind):
        return ids[kind]

    def people(col, kind, idcol):
        return occurrences(col).join(names(kind).withColumnRenamed("name", "pname"), "pname").select(
            "mid", "pos", F.col("id").alias(idcol))

    def all_rows(col, kind, idcol):
        pairs = raw.select("name", col).distinct().join(movie_ids, "name")
        return pairs.join(names(kind).withColumnRenamed("name", col), col).select(
            "mid", F.col("id").alias(idcol))

    districts = names("district").select(F.col("id").alias("did"), F.col("name").alias("district"))
    movie = movies.join(districts, "district", "left").select(
        F.col("mid").alias("id"), "name", F.col("did").alias("district"), "rating")
    return Catalog(
        movie=movie, movie_actor=people("actor", "actor", "aid"),
        movie_director=people("director", "director", "did"),
        movie_genre=all_rows("genre", "genre", "gid"), movie_trait=all_rows("trait", "trait", "tid"),
        names={k: names(k) for k in DIMENSIONS},
        rejects=rejects,
    )


def movie_names(raw: DataFrame) -> DataFrame:
    """(id, name, rating) of every movie of raw(row_ord, name, rating), with the ids that
    ``build_catalog`` gives: all that resolving ratings by movie name needs."""
    first = first_per_key(raw.where(F.col("name").isNotNull()), ["name"], ["row_ord"], ["row_ord", "rating"])
    return dense_index(first, ["row_ord"], out="id").select(F.col("id").cast("long").alias("id"), "name", "rating")


def movie_table(cat: Catalog) -> DataFrame:
    """The published ``movie`` schema: id, name, genres, actors, district, directors,
    traits, rating.  Genres/traits ascending id; actors/directors in list order.
    One shuffle on mid builds all four arrays (null-skipping ``collect_list``)."""
    tagged = (cat.movie_actor.select("mid", F.lit("a").alias("k"), "pos", F.col("aid").alias("v"))
              .unionByName(cat.movie_director.select("mid", F.lit("d").alias("k"), "pos", F.col("did").alias("v")))
              .unionByName(cat.movie_genre.select("mid", F.lit("g").alias("k"), F.lit(0).alias("pos"), F.col("gid").alias("v")))
              .unionByName(cat.movie_trait.select("mid", F.lit("t").alias("k"), F.lit(0).alias("pos"), F.col("tid").alias("v"))))

    def arr(kind):
        return ordered_values(F.collect_list(F.when(F.col("k") == kind, F.struct("pos", "v"))), "v")

    lists = tagged.groupBy("mid").agg(arr("g").alias("genres"), arr("a").alias("actors"),
                                      arr("d").alias("directors"), arr("t").alias("traits"))
    empty = F.array().cast("array<bigint>")
    m = cat.movie.join(lists, cat.movie.id == lists.mid, "left")
    return m.select("id", "name",
                    *[F.coalesce(F.col(c).cast("array<bigint>"), empty).alias(c) for c in ("genres", "actors")],
                    F.col("district").cast("bigint").alias("district"),
                    *[F.coalesce(F.col(c).cast("array<bigint>"), empty).alias(c) for c in ("directors", "traits")],
                    "rating")


def dimension_rows(cat: Catalog, dim: str) -> DataFrame:
    """A3 in row form: (id, name, pos, mid), pos = place of the movie in the
    dimension's list (movie rating desc, mid asc)."""
    pairs = cat.bridge(dim).join(cat.movie.select(F.col("id").alias("mid"), "rating"), "mid")
    ranked = dense_index(pairs, [F.col("rating").desc(), F.col("mid").asc()], out="pos", group=["id"])
    return ranked.join(cat.names[dim], "id").select("id", "name", "pos", "mid")


def dimension_table(cat: Catalog, dim: str) -> DataFrame:
    """The published dimension schema (id, name, movies array) -- collects each
    dimension's movies into one row; prefer ``dimension_rows`` at scale."""
    rows = dimension_rows(cat, dim)
    lists = rows.groupBy("id").agg(ordered_values(F.collect_list(F.struct("pos", "mid")), "mid").alias("movies"))
    return cat.names[dim].join(lists, "id", "left").select(
        "id", "name", F.coalesce("movies", F.array().cast("array<bigint>")).alias("movies"))
