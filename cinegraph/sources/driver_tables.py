"""The driver's parquet tables mapped onto the recommender's inputs.

The driver tables hold no movies, so items, people and ratings are derived from
them (mapping fixed in FIXTURES.md section 2).  Every frame here is a lazy
projection of the parquet scans, so filters and column pruning reach the files.
Raw "file order" is expressed as an ordering column (``row_ord``, a struct), not a
dense row number: a global ``row_number()`` would pull all rows into one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _item_score(partkey: Column) -> Column:
    # score spread over 0.00-9.99 at every scale
    return (partkey * 37) % 1000 / F.lit(100.0)


def _movie_name(p_name: Column, partkey: Column) -> Column:
    return F.concat(p_name, F.lit("#"), partkey.cast("string"))


def _director(brand: Column, size: Column) -> Column:
    return F.concat(brand, F.lit("-"), size.cast("string"))


def _district(size: Column) -> Column:
    return F.concat(F.lit("D"), (size % 25).cast("string"))


def fx_item(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per movie: id, name, rating, director, genre, district."""
    p = table(spark, sf_dir, "part")
    return p.select(
        F.col("p_partkey").alias("id"),
        _movie_name(F.col("p_name"), F.col("p_partkey")).alias("name"),
        _item_score(F.col("p_partkey")).alias("rating"),
        _director(F.col("p_brand"), F.col("p_size")).alias("director"),
        F.col("p_type").alias("genre"),
        _district(F.col("p_size")).alias("district"),
    )


#: actors per supplier: the credit of a line is one of so many actors of its supplier
ACTORS_PER_SUPPLIER = 1000


def _credits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(mid, l_suppkey, code): every line credits one of its supplier's actors, told apart
    by order and quantity.  A movie whose key is a multiple of 5 has no cast (an item-side
    rule)."""
    code = (F.col("l_orderkey") % 20) * 50 + F.col("l_quantity").cast("bigint") - 1
    return table(spark, sf_dir, "lineitem").where(F.col("l_partkey") % 5 != 0).select(
        F.col("l_partkey").alias("mid"), "l_suppkey", code.alias("code"))


def credit_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(a_mid, actor_name), distinct."""
    s = table(spark, sf_dir, "supplier")
    return _credits(spark, sf_dir).distinct().join(s, F.col("l_suppkey") == s.s_suppkey).select(
        F.col("mid").alias("a_mid"),
        F.concat(F.col("s_name"), F.lit("/"), F.col("code").cast("string")).alias("actor_name"))


def fx_actor(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bridge (mid, aid); some movies have no actor."""
    return _credits(spark, sf_dir).select(
        "mid", (F.col("l_suppkey") * ACTORS_PER_SUPPLIER + F.col("code")).alias("aid")).distinct()


def fx_rating(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw interactions with repeats: uid, mid, time, rating plus the tie-break columns
    (okey, line, skey, price) that make "latest" well defined."""
    li = table(spark, sf_dir, "lineitem")
    o = table(spark, sf_dir, "orders")
    return li.join(o, li.l_orderkey == o.o_orderkey).select(
        F.col("o_custkey").alias("uid"),
        F.col("l_partkey").alias("mid"),
        F.col("o_orderdate").alias("time"),
        F.ceil(F.col("l_quantity") / 5).cast("bigint").alias("rating"),
        F.col("l_orderkey").alias("okey"),
        F.col("l_linenumber").alias("line"),
        F.col("l_suppkey").alias("skey"),
        F.col("l_extendedprice").alias("price"),
    )


#: order of "later" events in fx_rating (time, then the lineitem identity)
RATING_EVENT_ORDER = ["time", "okey", "line", "skey", "price"]


def fx_bridge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Movie-person bridge (mid, role, pid): actors ('a', actor key) and
    directors ('d', brand-size name).  pid is a string so both roles share a column."""
    actors = fx_actor(spark, sf_dir).select(
        "mid", F.lit("a").alias("role"), F.col("aid").cast("string").alias("pid"))
    directors = fx_item(spark, sf_dir).select(
        F.col("id").alias("mid"), F.lit("d").alias("role"), F.col("director").alias("pid"))
    return actors.unionByName(directors)


def fx_movie_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The names and ratings of ``fx_movie_raw``, without its other columns."""
    return _movie_rows(spark, sf_dir).select(*_movie_keys(), _movie_name(F.col("p_name"), F.col("p_partkey")).alias("name"))


def _movie_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "part")
    flags = table(spark, sf_dir, "lineitem").select("l_partkey", "l_returnflag", "l_linestatus").distinct()
    return p.join(flags, flags.l_partkey == p.p_partkey)


def _movie_keys() -> list[Column]:
    raised = F.when(F.col("l_linestatus") == "O", F.lit(0.5)).otherwise(F.lit(0.0))
    return [F.struct("p_partkey", "l_returnflag", "l_linestatus").alias("row_ord"),
            (_item_score(F.col("p_partkey")) + raised).alias("rating")]


def fx_movie_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Redundant raw movie rows for the catalog build (several rows per movie, the
    rating differs between them).  Columns as in the raw movie CSV plus ``row_ord``
    (struct ordering = file order)."""
    # the raw format carries a movie's whole cast in one '|'-joined cell
    casts = credit_names(spark, sf_dir).groupBy("a_mid").agg(
        F.array_join(F.array_sort(F.collect_list("actor_name")), "|").alias("actor"))
    rows = _movie_rows(spark, sf_dir).join(casts, F.col("a_mid") == F.col("p_partkey"), "left")
    row_ord, rating = _movie_keys()
    return rows.select(
        row_ord,
        F.concat(F.col("p_type"), F.lit("-"), F.col("l_linestatus")).alias("genre"),
        F.col("actor"),
        _district(F.col("p_size")).alias("district"),
        _director(F.col("p_brand"), F.col("p_size")).alias("director"),
        F.concat(F.lit("T"), F.col("l_returnflag")).alias("trait"),
        rating,
        _movie_name(F.col("p_name"), F.col("p_partkey")).alias("name"),
    )


def fx_rating_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw rating rows as in the rating CSV: rating, name (user), time, uid (ignored),
    movie (name), plus ``row_ord``.  Line 7 of an order names the movie without its
    '#key' suffix, which no catalog movie carries: those rows are the unknown-movie
    rejects."""
    li = table(spark, sf_dir, "lineitem")
    o = table(spark, sf_dir, "orders")
    c = table(spark, sf_dir, "customer")
    p = table(spark, sf_dir, "part")
    # names join the orders, not the lines: one shuffle of the lines less
    named = o.join(c, o.o_custkey == c.c_custkey).select("o_orderkey", "o_custkey", "o_orderdate", "c_name")
    rows = li.join(named, li.l_orderkey == named.o_orderkey).join(p, li.l_partkey == p.p_partkey)
    movie = F.when(F.col("l_linenumber") == 7, F.col("p_name")).otherwise(
        _movie_name(F.col("p_name"), F.col("p_partkey")))
    return rows.select(
        F.struct("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity").alias("row_ord"),
        F.ceil(F.col("l_quantity") / 5).cast("bigint").alias("rating"),
        F.col("c_name").alias("name"),
        F.col("o_orderdate").alias("time"),
        F.col("o_custkey").alias("uid"),
        movie.alias("movie"),
    )


def fx_event(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Live rating feed: every event as (event_id, ts, uid, mid, rating)."""
    e = table(spark, sf_dir, "events")
    return e.select(
        "event_id", "ts", F.col("user_id").alias("uid"),
        F.get_json_object("props", "$.k").cast("int").alias("mid"),
        F.least(F.lit(10), 1 + F.floor(F.col("value") / 50)).cast("int").alias("rating"),
    )
