"""Command-line jobs mirroring the original workflow, on published tables.

    python -m cinegraph etl --movies movies.csv --ratings ratings.csv --db films
    python -m cinegraph recall --db films                # table recall(uid, pos, mid)
    python -m cinegraph recommend --db films --model /shared/als   # table recommendation
    python -m cinegraph select --db films --results /shared/grid   # table model_report

Each command takes the session from the environment (spark-submit / local) and
writes tables into the given database; nothing is collected to the driver.
"""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from .plans import catalog as cg
from .plans import interactions as it
from .plans import models as md
from .plans import recall as rc
from .plans import serving as sv
from .session import checkpoint_dir, materialize, scratch_scope
from .sources import files as fl
from .sources import tables as tb


def etl(spark: SparkSession, movies: str, ratings: str, header: bool = True, strict: bool = False,
        arrays: bool = False) -> dict:
    """C1 + C2 + K2: raw CSVs -> movie and rating tables, (id, name) of every dimension
    and of the users, their movie lists in row form, and rejects.

    ``arrays`` publishes the dimensions and users in the original schema instead, one
    row with the array of all its movies each: a genre of a third of all movies is then
    one row, so it is for small catalogs only."""
    raw, bad_movies = fl.read_movie_csv(spark, movies, header=header)
    cat = cg.build_catalog(raw)
    rows, bad = fl.read_rating_csv(spark, ratings, header=header)
    inter = it.build_interactions(rows, cat.movie, strict=strict)
    out = tb.publish_all({"movie": cg.movie_table(cat), "rating": inter.rating})
    if arrays:
        lists = {"user": it.user_table(inter, cat.movie)} | {d: cg.dimension_table(cat, d) for d in cg.DIMENSIONS}
        out |= tb.publish_all(lists)
    else:
        out |= {"user": tb.publish(inter.user, "user")} | {d: tb.publish(cat.names[d], d) for d in cg.DIMENSIONS}
    for d in cg.DIMENSIONS:
        tb.publish(cg.dimension_rows(cat, d), f"{d}_movies", key="id")
    tb.publish(it.user_rows(inter, cat.movie), "user_movies", key="id")
    tb.publish(cat.rejects.drop("row_ord"), "movie_rejects", key=None)
    tb.publish(inter.rejects.drop("row_ord"), "rating_rejects", key=None)
    tb.publish(bad_movies.drop("row_ord"), "movie_malformed", key=None)
    tb.publish(bad.drop("row_ord"), "rating_malformed", key=None)
    return out


def people_bridge(spark: SparkSession):
    """(mid, role, pid) from the published movie arrays."""
    m = spark.table("movie")
    return (m.select(F.col("id").alias("mid"), F.lit("a").alias("role"), F.explode("actors").alias("pid"))
            .unionByName(m.select(F.col("id").alias("mid"), F.lit("d").alias("role"),
                                  F.explode("directors").alias("pid"))))


def recall_job(spark: SparkSession, size: int = 50):
    """C8 over the published tables -> table ``recall``."""
    latest = sv.latest_ratings(spark.table("rating"))
    lists = rc.recall(latest, spark.table("movie"), people_bridge(spark), rc.RecallParams(size=size))
    return tb.publish(lists, "recall", key="uid")


def recommend_job(spark: SparkSession, model_path: str, k: int = 3):
    """M9 + C9: load or train ALS, score every recall list -> table ``recommendation``."""
    rating = spark.table("rating")
    model = md.load_or_train(spark, model_path, rating)
    recs = md.recommend(model, spark.table("recall"), spark.table("movie"), k)
    return tb.publish(recs, "recommendation", key="uid")


def select_job(spark: SparkSession, results_path: str, als_grid=None, fm_grid=None):
    """M1 + F8 + M4 + M7 + C11: resumable grid searches -> table ``model_report``."""
    train, test = md.split(spark.table("rating"))
    test = md.warm_test(train, test)
    train, test = materialize(train, "select-train"), materialize(test, "select-test")
    als_pts = md.grid(spark, "als", *(als_grid or (md.ALS_RANKS, md.ALS_MAX_ITERS, md.ALS_REGS)))
    md.als_grid_search(spark, als_pts, results_path, train, test)
    fm_pts = md.grid(spark, "fm", *(fm_grid or (md.FM_RANKS, md.FM_EPOCHS, md.FM_LAMBDAS)))
    results = md.grid_search(spark, fm_pts, results_path, md.fm_evaluator(train, test))
    return tb.publish(md.model_report(results), "model_report", key=None)


def main(argv=None) -> None:
    ap = argparse.ArgumentParser(prog="cinegraph")
    ap.add_argument("command", choices=["etl", "recall", "recommend", "select"])
    ap.add_argument("--db", required=True)
    ap.add_argument("--movies")
    ap.add_argument("--ratings")
    ap.add_argument("--no-header", action="store_true")
    ap.add_argument("--strict", action="store_true")
    ap.add_argument("--arrays", action="store_true", help="dimensions and users with arrays of their movies")
    ap.add_argument("--model")
    ap.add_argument("--results")
    args = ap.parse_args(argv)
    spark = SparkSession.builder.appName(f"cinegraph-{args.command}").getOrCreate()
    checkpoint_dir(spark)
    tb.use_database(spark, args.db)
    with scratch_scope(spark):                 # results are published tables by then
        if args.command == "etl":
            etl(spark, args.movies, args.ratings, header=not args.no_header, strict=args.strict, arrays=args.arrays)
        elif args.command == "recall":
            recall_job(spark)
        elif args.command == "recommend":
            recommend_job(spark, args.model)
        else:
            select_job(spark, args.results)


__all__ = ["etl", "recall_job", "recommend_job", "select_job", "main"]
