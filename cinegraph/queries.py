"""Registered queries: one callable (spark, sf_dir) -> DataFrame per operator/job.

Every query reads the driver tables (through the fixture mapping) in full; array
results are also handed over as comma-joined strings so the value hash does not
depend on how an engine renders arrays.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import schemas
from .functions.lists import join_list
from .operators.ids import dense_index
from .operators.latest import latest_per_key
from .operators.topk import global_top_k
from .plans import catalog as cg
from .plans import fold_in as fi
from .plans import interactions as it
from .plans import models as md
from .plans import serving as sv
from .plans import recall as rc
from .session import materialize, remove, scratch_path, scratch_scope, shuffles_go, write_once
from .streaming import ratings as st
from .sources import crawl as cw
from .sources import driver_tables as dt
from .sources import files as fl
from .sources import tables as tb

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(name: str):
    def deco(fn):
        QUERIES[name] = fn
        return fn
    return deco


def fixture_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """W1 over the fixture ratings: (uid, mid, time, rating), one row per pair."""
    return latest_per_key(dt.fx_rating(spark, sf_dir), ["uid", "mid"], dt.RATING_EVENT_ORDER,
                          ["time", "rating"])


@query("latest_rating")
def q_latest_rating(spark, sf_dir):
    return fixture_latest(spark, sf_dir)


@query("related_movies")
def q_related_movies(spark, sf_dir):
    return rc.related_movies(fixture_latest(spark, sf_dir), dt.fx_bridge(spark, sf_dir))


@query("recall_stage1")
def q_recall_stage1(spark, sf_dir):
    s1 = rc.recall_stage1(fixture_latest(spark, sf_dir), dt.fx_item(spark, sf_dir),
                          dt.fx_bridge(spark, sf_dir))
    return s1.select("uid", F.col("pos").cast("long").alias("pos"), "mid")


@query("recall")
def q_recall(spark, sf_dir):
    r = rc.recall(fixture_latest(spark, sf_dir), dt.fx_item(spark, sf_dir), dt.fx_bridge(spark, sf_dir))
    return r.select("uid", F.col("pos").cast("long").alias("pos"), "mid")


@query("top_popular")
def q_top_popular(spark, sf_dir):
    best = global_top_k(dt.fx_item(spark, sf_dir), [F.col("rating").desc(), F.col("id").asc()], 50)
    place = F.row_number().over(Window.orderBy(F.col("rating").desc(), F.col("id").asc()))   # 50 rows
    return best.select(place.cast("long").alias("rank"), F.col("id").alias("mid"), "rating")


@query("recall_all_users")
def q_recall_all_users(spark, sf_dir):
    """C8 for every customer, also those without ratings (they get the global list)."""
    users = dt.table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("uid"))
    r = rc.recall(fixture_latest(spark, sf_dir), dt.fx_item(spark, sf_dir), dt.fx_bridge(spark, sf_dir), users=users)
    return r.select("uid", F.col("pos").cast("long").alias("pos"), "mid")


def fixture_catalog(spark: SparkSession, sf_dir: str) -> cg.Catalog:
    return cg.build_catalog(dt.fx_movie_raw(spark, sf_dir))


@query("catalog_movie")
def q_catalog_movie(spark, sf_dir):
    m = cg.movie_table(fixture_catalog(spark, sf_dir))
    return m.select("id", "name", *[join_list(c, ",").alias(c) for c in ("genres", "actors")],
                    "district", *[join_list(c, ",").alias(c) for c in ("directors", "traits")], "rating")


def _dimension_query(dim):
    def run(spark, sf_dir):
        return cg.dimension_rows(fixture_catalog(spark, sf_dir), dim)
    run.__name__ = f"q_catalog_{dim}"
    return run


for _dim in cg.DIMENSIONS:
    query(f"catalog_{_dim}")(_dimension_query(_dim))


def fixture_interactions(spark: SparkSession, sf_dir: str, cat: cg.Catalog | None = None):
    """(movies (id, name, rating), interactions); without a catalog only movies' names are built."""
    movie = cat.movie if cat else materialize(cg.movie_names(dt.fx_movie_names(spark, sf_dir)), "movie-names")
    return movie, it.build_interactions(dt.fx_rating_raw(spark, sf_dir), movie)


@query("interactions_rating")
def q_interactions_rating(spark, sf_dir):
    return fixture_interactions(spark, sf_dir)[1].rating


@query("interactions_user")
def q_interactions_user(spark, sf_dir):
    movie, inter = fixture_interactions(spark, sf_dir)
    return it.user_rows(inter, movie)


@query("rating_rejects")
def q_rating_rejects(spark, sf_dir):
    _, inter = fixture_interactions(spark, sf_dir)
    return inter.rejects.select("rating", "name", "time", "uid", "movie")


@query("etl_summary")
def q_etl_summary(spark, sf_dir):
    """The ETL's closing counts, one row per entity (plus raw CSV rows)."""
    cat = fixture_catalog(spark, sf_dir)
    _, inter = fixture_interactions(spark, sf_dir, cat)
    parts = [("movies", cat.movie), ("directors", cat.names["director"]), ("actors", cat.names["actor"]),
             ("users", inter.user), ("ratings", inter.rating), ("csv_rows", dt.fx_rating_raw(spark, sf_dir))]
    frames = [df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(k).alias("entity"), "n") for k, df in parts]
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


@query("movie_detail")
def q_movie_detail(spark, sf_dir):
    detail = sv.movie_detail(fixture_catalog(spark, sf_dir))
    pair = lambda p: F.concat(p["id"].cast("string"), F.lit(":"), p["name"])
    return detail.select("id", "name", "rating", "district", *[
        join_list(F.transform(c, pair)).alias(c) for c in ("actors", "directors", "traits", "genres")])


@query("movie_rejects")
def q_movie_rejects(spark, sf_dir):
    """C1's rejects: raw rows whose name is missing (here: of every 50th movie)."""
    raw = dt.fx_movie_raw(spark, sf_dir).withColumn(
        "name", F.when(F.col("row_ord.p_partkey") % 50 != 0, F.col("name")))
    return cg.build_catalog(raw).rejects.select("genre", "actor", "district", "director", "trait", "rating", "name")


@query("catalog_dense_ids")
def q_catalog_dense_ids(spark, sf_dir):
    """W2 with missing names, genres and districts in the raw rows: ids stay 0..n-1."""
    missing = F.col("row_ord.p_partkey") % 50 == 0
    raw = dt.fx_movie_raw(spark, sf_dir)
    raw = raw.select("row_ord", "actor", "director", "trait", "rating",
                     *[F.when(~missing, F.col(c)).alias(c) for c in ("genre", "district", "name")])
    cat = cg.build_catalog(raw)
    parts = [("movie", cat.movie.select("id", "name"))] + [(d, cat.names[d]) for d in ("genre", "district")]
    frames = [df.select(F.lit(k).alias("kind"), "id", "name") for k, df in parts]
    return frames[0].unionByName(frames[1]).unionByName(frames[2])


@query("movies_by_request")
def q_movies_by_request(spark, sf_dir):
    """movies named by the event feed's requests (semi join, no IN list)."""
    cat = fixture_catalog(spark, sf_dir)
    return sv.lookup(cat.movie, dt.fx_event(spark, sf_dir), "id", "mid")


@query("my_rating")
def q_my_rating(spark, sf_dir):
    """F5/W1/X7 for requested (uid, mid) pairs: the event feed's pairs and every rated pair."""
    _, inter = fixture_interactions(spark, sf_dir)
    req = dt.fx_event(spark, sf_dir).select("uid", "mid").unionByName(inter.rating.select("uid", "mid"))
    return sv.my_ratings(req, inter.rating)


@query("person_page_actor")
def q_person_page_actor(spark, sf_dir):
    return sv.person_page(fixture_catalog(spark, sf_dir), "actor")


@query("person_page_director")
def q_person_page_director(spark, sf_dir):
    return sv.person_page(fixture_catalog(spark, sf_dir), "director")


@query("user_history")
def q_user_history(spark, sf_dir):
    movie, inter = fixture_interactions(spark, sf_dir)
    return sv.user_history(inter.rating, inter.user, movie)


@query("page_movies")
def q_page_movies(spark, sf_dir):
    return sv.paged(fixture_catalog(spark, sf_dir).movie, ["name", "rating"])


@query("page_users")
def q_page_users(spark, sf_dir):
    _, inter = fixture_interactions(spark, sf_dir)
    return sv.paged(inter.user, ["name"])


@query("page_actors")
def q_page_actors(spark, sf_dir):
    return sv.paged(fixture_catalog(spark, sf_dir).names["actor"], ["name"])


@query("page_directors")
def q_page_directors(spark, sf_dir):
    return sv.paged(fixture_catalog(spark, sf_dir).names["director"], ["name"])


@query("home")
def q_home(spark, sf_dir):
    return sv.home(fixture_catalog(spark, sf_dir))


@query("random_users")
def q_random_users(spark, sf_dir):
    _, inter = fixture_interactions(spark, sf_dir)
    return sv.random_users(inter.user, 5)


def fixture_split(spark: SparkSession, sf_dir: str):
    movie, inter = fixture_interactions(spark, sf_dir)
    train, test = md.split(inter.rating)
    return movie, inter, train, md.warm_test(train, test)


@query("split_train")
def q_split_train(spark, sf_dir):
    return fixture_split(spark, sf_dir)[2]


@query("split_test_warm")
def q_split_test_warm(spark, sf_dir):
    return fixture_split(spark, sf_dir)[3]


@query("rmse_mean_baseline")
def q_rmse_mean_baseline(spark, sf_dir):
    """A8 over the warm test set for the train-mean predictor (the sanity floor a
    model must beat); rounded to 6 places."""
    _, _, train, test = fixture_split(spark, sf_dir)
    mean = train.select(F.avg("rating")).scalar()      # scalar subquery, no join
    out = md.rmse(test.withColumn("prediction", mean))
    return out.select(F.round("rmse", 6).alias("rmse"))


@query("als_scores")
def q_als_scores(spark, sf_dir):
    """M2 + M3 + M10: deployed ALS on train, scores for the warm test rows."""
    _, _, train, test = fixture_split(spark, sf_dir)
    model = md.fit_als(train)
    return md.score(model, test).select("id", "uid", "mid", "rating", "prediction")


@query("recommend")
def q_recommend(spark, sf_dir):
    """The recall lists of all users (as in ``recall``), scored by ALS trained on
    every rating row (superseded ones included, as the reference trains), best 3
    per user with movie name and rating."""
    items = dt.fx_item(spark, sf_dir)
    raw = dt.fx_rating(spark, sf_dir)
    latest = latest_per_key(raw, ["uid", "mid"], dt.RATING_EVENT_ORDER, ["rating"])
    lists = rc.recall(latest, items, dt.fx_bridge(spark, sf_dir))
    model = md.fit_als(raw.select("uid", "mid", "rating"))
    return md.recommend(model, lists, items, 3)


@query("fm_scores")
def q_fm_scores(spark, sf_dir):
    """M5 + M8 + K6: the train set exported as libsvm, a factorization machine fitted on
    that folder, scores for the warm test set."""
    _, _, train, test = fixture_split(spark, sf_dir)
    n_users, n_movies = md.id_space(train, test)
    path = scratch_path(spark, "fm-train")
    md.export_libsvm(train, path, n_users, n_movies)
    model = md.fit_fm_file(spark, path, n_users, rank=8, epochs=10, reg=0.01)
    return model.transform(test).select("id", "uid", "mid", "rating", "prediction")


@query("fm_mcmc_scores")
def q_fm_mcmc_scores(spark, sf_dir):
    """M6: the Bayesian trainer, scores for the warm test set averaged over its draws."""
    _, _, train, test = fixture_split(spark, sf_dir)
    return md.fm_mcmc_scores(train, test, rank=8, sweeps=12, burn_in=4).select("id", "uid", "mid", "rating", "prediction")


@query("fold_in")
def q_fold_in(spark, sf_dir):
    """The latest ratings folded into fixed factors of two numbers per id.  Every
    tenth movie and every fifth user is new to the model; all users are solved again."""
    latest = fixture_latest(spark, sf_dir)
    items = dt.fx_item(spark, sf_dir).where(F.col("id") % 10 != 0).select(
        F.col("id").cast("long").alias("id"), F.array(F.col("rating") / 5, 1 + F.col("id") % 7 / 7).alias("features"))
    users = latest.select("uid").distinct().where(F.col("uid") % 5 != 0).select(
        F.col("uid").cast("long").alias("id"), F.array(F.col("uid") % 11 / 11, 2 - F.col("uid") % 3 / 3).alias("features"))
    folded = fi.fold_in(fi.Factors(2, 0.1, users, items), latest)
    new_items = folded.items.where(F.col("id") % 10 == 0)
    parts = [df.select(F.lit(kind).alias("kind"), "id", *[F.round(F.col("features")[i], 6).alias(f"f{i + 1}") for i in (0, 1)])
             for kind, df in (("user", folded.users), ("movie", new_items))]
    return parts[0].unionByName(parts[1])


@query("recommend_by_score")
def q_recommend_by_score(spark, sf_dir):
    """W4 + J5 over the recall lists with a fixed score: best 3 per user, name and rating."""
    lists = q_recall(spark, sf_dir)
    scored = lists.select("uid", "mid", (((F.col("uid") * 31 + F.col("mid") * 17) % 1000) / 100.0).alias("prediction"))
    best = md.best_scored(scored, dt.fx_item(spark, sf_dir), 3)
    return best.select("uid", F.col("pos").cast("long").alias("pos"), "mid", "name", "rating", "prediction")


@query("model_report")
def q_model_report(spark, sf_dir):
    """C11 / A9 over the held-out RMSE (A8) of damped user and movie means, one run per
    damping value of the ALS grid."""
    _, _, train, test = fixture_split(spark, sf_dir)
    regs = sorted({float(r) for r in md.ALS_REGS})
    runs = None
    for first, (algo, key) in zip((0, len(regs)), (("movie_mean", "mid"), ("user_mean", "uid")), strict=True):
        sums = train.groupBy(key).agg(F.sum("rating").alias("s"), F.count(F.lit(1)).alias("n"))
        scored = (test.join(sums, key).select("rating", "s", "n", F.posexplode(F.array(*map(F.lit, regs))).alias("i", "reg"))
                  .withColumn("prediction", F.col("s") / (F.col("n") + F.col("reg"))))
        rows = scored.groupBy("i", "reg").agg(
            F.round(F.sqrt(F.avg(F.pow(F.col("rating") - F.col("prediction"), 2))), 9).alias("rmse"))
        part = rows.select(F.lit(algo).alias("algo"), F.lit(0).alias("rank"), F.lit(0).alias("max_iter"), "reg", "rmse",
                           (F.col("i") + first).cast("long").alias("run_ord"))
        runs = part if runs is None else runs.unionByName(part)
    return md.model_report(runs)


@query("als_grid")
def q_als_grid(spark, sf_dir):
    """M4 + K7 + C11: the whole ALS grid (364 points) fitted as one stacked job on the train
    set, RMSE on the warm test set, the best point marked (A9)."""
    _, _, train, test = fixture_split(spark, sf_dir)
    points = md.grid(spark, "als", md.ALS_RANKS, md.ALS_MAX_ITERS, md.ALS_REGS)
    results = md.als_grid_search(spark, points, scratch_path(spark, "als-grid"), train, test)
    best = md.best_of(results).select("algo", F.col("run_ord").alias("best"))
    return results.join(best, "algo").select("algo", "rank", "max_iter", "reg", "rmse", "run_ord",
                                             (F.col("run_ord") == F.col("best")).alias("best"))


@query("libsvm_roundtrip")
def q_libsvm_roundtrip(spark, sf_dir):
    """K6: the warm test set written as libsvm, the lines read back and taken apart."""
    _, _, train, test = fixture_split(spark, sf_dir)
    nu, nm = md.id_space(train, test)
    path = scratch_path(spark, "libsvm")
    md.export_libsvm(test, path, nu, nm)
    at = F.split("value", "[ :]")                     # label, user index, 1, movie index, 1
    return spark.read.text(path).select(
        at[0].cast("double").alias("label"), (at[1].cast("long") - 1).alias("uid"),
        (at[3].cast("long") - 1 - nu).alias("mid"), (at[2].cast("double") + at[4].cast("double")).alias("ones"))


CHECK_DB = "cinegraph_check"


@contextmanager
def _published(spark: SparkSession, name: str):
    """The name of a table of its own, dropped at the end: what is returned from it must be
    written by then."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {CHECK_DB}")
    table = f"{CHECK_DB}.{name}_{uuid.uuid4().hex}"
    try:
        yield table
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {table}")


@query("published_movies")
def q_published_movies(spark, sf_dir):
    """K1/K2 + S4/S6: the movie table published, refreshed and scanned back."""
    with _published(spark, "movie") as table:
        tb.publish(cg.movie_table(fixture_catalog(spark, sf_dir)), table, schemas.MOVIE)
        tb.refresh(spark, table)
        return materialize(tb.scan(spark, table, "id", "name", "district", "rating"), "published")


@query("published_preview")
def q_published_preview(spark, sf_dir):
    """The first 20 rows of a published table."""
    with _published(spark, "user_preview") as table:
        tb.publish(fixture_interactions(spark, sf_dir)[1].user, table)
        return materialize(tb.preview(spark, table, 20), "published")


@query("append_ratings")
def q_append_ratings(spark, sf_dir):
    """K3, batch form: the event feed appended to the published ratings."""
    with _published(spark, "rating") as table:
        tb.publish(fixture_interactions(spark, sf_dir)[1].rating, table, schemas.RATING)
        feed = dt.fx_event(spark, sf_dir).select("uid", "mid", "rating", F.col("ts").alias("time"))
        tb.append_ratings(spark, table, feed)
        return materialize(tb.scan(spark, table), "published")


@query("append_csv")
def q_append_csv(spark, sf_dir):
    """K4: the crawl rows appended twice to a header-less CSV folder and read back."""
    path, bodies = scratch_path(spark, "append-csv"), scratch_path(spark, "crawl")
    fixture_crawl_responses(spark, sf_dir).write.json(bodies)
    rows, _ = fl.normalise_crawl(fl.read_crawl_responses(spark, bodies))
    for _ in range(2):
        tb.append_csv(rows, path)
    back = spark.read.schema(schemas.CRAWL_ROW).option("emptyValue", "").option("nullValue", "\u0000").csv(path)
    return back.select(*[f.name for f in schemas.CRAWL_ROW.fields])


def fixture_raw_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rating input as text fields (as typed into a form), from every event."""
    e = dt.table(spark, sf_dir, "events")
    return e.select("event_id", "ts", F.col("user_id").alias("uid"),
                    F.get_json_object("props", "$.k").alias("mid_text"),
                    F.floor(F.col("value") / 25).cast("bigint").cast("string").alias("rating_text"))


def _event_files(df: DataFrame, name: str, rows_per_file: int = 1_000_000) -> str:
    """Write a derived event frame as parquet files by time range, newest first, to the
    shared scratch folder, to be streamed: four files, more when the data need them."""
    path = scratch_path(df.sparkSession, name)
    files = max(4, -(-df.count() // rows_per_file))
    df.repartitionByRange(files, F.col("ts").desc()).write.parquet(path)
    return path


@query("rating_input_valid")
def q_rating_input_valid(spark, sf_dir):
    """X8 on the batch side: the events that parse as a valid rating."""
    return st.validate(fixture_raw_events(spark, sf_dir))[0]


@query("stream_ingest")
def q_stream_ingest(spark, sf_dir):
    """ST1 + K3: stream the raw events, validate, append with ids (one batch)."""
    src = _event_files(fixture_raw_events(spark, sf_dir), "raw-events")
    out, rej, ck = (scratch_path(spark, n) for n in ("ingest-rating", "ingest-rejects", "ingest-ckpt"))
    st.ingest(spark, src, out, rej, ck)
    return spark.read.parquet(out).select("id", "uid", "mid", "ts", "rating", "event_id")


@query("stream_latest")
def q_stream_latest(spark, sf_dir):
    """ST2: latest rating per (uid, mid), files streamed newest first, one per batch."""
    src = _event_files(dt.fx_event(spark, sf_dir), "events")
    out, ck = scratch_path(spark, "latest-state"), scratch_path(spark, "latest-ckpt")
    st.run_latest(spark, src, out, ck, max_files=1)
    return st.current_latest(spark, out)


def _stream_refresh(spark: SparkSession, sf_dir: str, with_model: bool = False):
    """ST3 (+ C10) over the event files (one per batch): recall for the touched users
    from the base ratings plus the events seen so far and, with a model, their top-3
    recommendations (C9).  Returns the output folders (lists, recommendations)."""
    items, bridge = dt.fx_item(spark, sf_dir), dt.fx_bridge(spark, sf_dir)
    ranked, films = materialize(rc.rank_items(items), "ranked-items"), rc.good_films(items, bridge)
    raw = dt.fx_rating(spark, sf_dir)
    order = dt.RATING_EVENT_ORDER
    base = latest_per_key(raw, ["uid", "mid"], order, ["rating", *order]).select("uid", "mid", "rating", *order)
    base_path = scratch_path(spark, "base-ratings")
    st.write_by_user(base, base_path)                     # read by the touched users' buckets
    src = _event_files(dt.fx_event(spark, sf_dir), "events")
    out, recs, ck, log = (scratch_path(spark, n) for n in ("refresh", "refresh-recs", "refresh-ckpt", "event-log"))

    def latest_for(users: DataFrame, event_log: str) -> DataFrame:
        seen = st.read_users(spark, event_log, users, st.EVENT_SCHEMA)
        ev = seen.select("uid", F.col("mid").cast("long").alias("mid"), F.col("ts").alias("time"),
                         F.col("rating").cast("long").alias("rating"), F.col("event_id").alias("okey"),
                         F.lit(0).alias("line"), F.lit(0).cast("long").alias("skey"), F.lit(0.0).alias("price"))
        rows = st.read_users(spark, base_path, users, base.schema).unionByName(ev)
        return latest_per_key(rows, ["uid", "mid"], order, ["rating"])

    def recall_for(users: DataFrame, event_log: str) -> DataFrame:
        return rc.recall(latest_for(users, event_log), items, bridge, ranked=ranked, films=films)

    rescore = None
    if with_model:
        path, rows = scratch_path(spark, "als-model"), raw.select("uid", "mid", "rating")
        md.load_or_train(spark, path, rows)
        model = md.load_or_train(spark, path, rows)          # S7: loaded from what K5 saved
        factors = fi.of_model(model, md.ALS_DEPLOYED[2])

        def rescore(lists: DataFrame, users: DataFrame, event_log: str) -> DataFrame:
            folded = fi.fold_in(factors, latest_for(users, event_log))
            return md.best_scored(fi.score(folded, lists.select("uid", "mid")), items, 3)
    st.run_refresh(spark, src, out, ck, recall_for, log, rescore, recs)
    return out, recs


@query("stream_refresh")
def q_stream_refresh(spark, sf_dir):
    """ST3: recall lists of the users touched by the event stream, refreshed per batch
    from the base ratings plus the events seen so far."""
    out, _ = _stream_refresh(spark, sf_dir)
    lists = st.current_lists(spark, out)
    return lists.select("uid", F.col("pos").cast("long").alias("pos"), "mid")


@query("stream_recommend")
def q_stream_recommend(spark, sf_dir):
    """C10 / ST3 + M9 + C9: touched users' top-3 recommendations after each batch, scored by
    a loaded-or-trained ALS model into which their present ratings are folded: users that
    the model has not seen get lists too."""
    _, recs = _stream_refresh(spark, sf_dir, with_model=True)
    return st.current_lists(spark, recs).select("uid", "pos", "mid", "name", "rating", "prediction")


def fixture_crawl_responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Crawl responses derived from the part/supplier tables: each movie sits under
    one facet combination (country by size, tag by key), pages of 20 per
    combination in id order, then one empty page per combination (the crawler's
    stop signal).  A movie whose size is a multiple of 10 has no ``rate``."""
    p = dt.table(spark, sf_dir, "part")
    casts = dt.credit_names(spark, sf_dir).groupBy(F.col("a_mid").alias("mid")).agg(
        F.array_sort(F.collect_list("actor_name")).alias("casts"))
    countries = F.array(*[F.lit(x) for x in cw.CRAWL_COUNTRIES])
    tags = F.array(*[F.lit(x) for x in cw.GENRES_TAGS])
    movies = p.join(casts, casts.mid == p.p_partkey, "left").select(
        F.col("p_partkey").alias("id"),
        F.lit(cw.CRAWL_FORM).alias("form"), F.lit(cw.CRAWL_TYPE).alias("Type"),
        F.element_at(countries, (F.col("p_size") % 7 + 1).cast("int")).alias("country"),
        F.element_at(tags, (F.col("p_partkey") % 9 + 1).cast("int")).alias("genres"),
        F.struct(F.array(dt._director(F.col("p_brand"), F.col("p_size"))).alias("directors"),
                 F.when(F.col("p_size") % 10 != 0, dt._item_score(F.col("p_partkey")).cast("string")).alias("rate"),
                 dt._movie_name(F.col("p_name"), F.col("p_partkey")).alias("title"),
                 F.coalesce("casts", F.array().cast("array<string>")).alias("casts"),
                 F.concat(F.lit("cover/"), F.col("p_partkey").cast("string"), F.lit(".jpg")).alias("cover"),
                 ).alias("item"))
    facets = ["form", "Type", "country", "genres"]
    placed = dense_index(movies, ["id"], out="k", group=facets)
    pages = (placed.withColumn("start", (F.floor(F.col("k") / cw.PAGE_STEP) * cw.PAGE_STEP).cast("long"))
             .groupBy(*facets, "start")
             .agg(F.array_sort(F.collect_list(F.struct("k", "item"))).alias("items")))   # <= 20 per page
    full = pages.select(*facets, "start", F.to_json(F.struct(
        F.transform("items", lambda x: x["item"]).alias("data"))).alias("body"))
    ends = pages.groupBy(*facets).agg((F.max("start") + cw.PAGE_STEP).alias("start")).select(
        *facets, "start", F.lit('{"data":[]}').alias("body"))
    return full.unionByName(ends)


@query("crawl_normalised")
def q_crawl_normalised(spark, sf_dir):
    """S3: crawl responses (written as JSON lines, read back) -> movie rows."""
    path = scratch_path(spark, "crawl")
    fixture_crawl_responses(spark, sf_dir).write.json(path)
    return fl.normalise_crawl(fl.read_crawl_responses(spark, path))[0]


@query("crawl_rejects")
def q_crawl_rejects(spark, sf_dir):
    """S3's rejects: truncated and HTML bodies; good and empty ones are none."""
    key = F.col("p_partkey")
    good = F.to_json(F.struct(F.array(F.struct(F.array(F.col("p_brand")).alias("directors"), F.lit("7.0").alias("rate"),
                                               F.col("p_name").alias("title"))).alias("data")))
    body = (F.when(key % 10 == 3, F.lit('{"data":[{"directors":["x'))
            .when(key % 10 == 5, F.lit('{"data":[]}')).when(key % 10 == 7, F.lit("<html>busy</html>"))
            .when(key % 10 == 9, F.lit('{"message":"none"}')).otherwise(good))
    responses = dt.table(spark, sf_dir, "part").select(
        *[F.lit(v).alias(c) for c, v in (("form", cw.CRAWL_FORM), ("Type", cw.CRAWL_TYPE), ("country", "x"),
                                         ("genres", "y"))], key.alias("start"), body.alias("body"))
    path = scratch_path(spark, "crawl-bodies")
    responses.write.json(path)
    rows, rejects = fl.normalise_crawl(fl.read_crawl_responses(spark, path))
    return rejects.select("start", "body").unionByName(
        rows.groupBy().agg(F.count(F.lit(1)).alias("start")).select("start", F.lit("rows kept").alias("body")))


@query("crawl_tokens")
def q_crawl_tokens(spark, sf_dir):
    """The tokens of payload texts with Chinese words and inner separators."""
    p = dt.table(spark, sf_dir, "part")
    countries = F.array(*[F.lit(x) for x in cw.CRAWL_COUNTRIES])
    text = F.concat(F.lit("{'rate': '"), (F.col("p_size") % 10).cast("string"), F.lit(".5', 'title': '"),
                    F.element_at(countries, (F.col("p_size") % 7 + 1).cast("int")), F.lit("：经典 "), F.col("p_brand"),
                    F.lit(" "), F.col("p_partkey").cast("string"), F.lit("', 'casts': ['徐峥', '周-杰·伦']}"))
    return p.select(F.col("p_partkey").alias("id"), F.array_join(fl.crawl_tokens(text), "|").alias("tokens"))


@query("catalog_from_csv")
def q_catalog_from_csv(spark, sf_dir):
    """S1 + C1: the raw movie rows written as CSV in file order, scanned back (file
    order from the scan) and built into the movie table."""
    raw = dt.fx_movie_raw(spark, sf_dir)
    path = scratch_path(spark, "movie-csv")
    raw.orderBy("row_ord").drop("row_ord").select(*[f.name for f in fl.schemas.RAW_MOVIE_CSV.fields]) \
        .write.option("header", True).csv(path)
    m = cg.movie_table(cg.build_catalog(fl.read_movie_csv(spark, path)[0]))
    return m.select("id", "name", *[join_list(c, ",").alias(c) for c in ("genres", "actors")],
                    "district", *[join_list(c, ",").alias(c) for c in ("directors", "traits")], "rating")


@query("interactions_from_csv")
def q_interactions_from_csv(spark, sf_dir):
    """S2 + C2: the raw rating rows as CSV (timestamps as text), scanned back with
    timestamp parsing, resolved against the catalog."""
    movies, path = scratch_path(spark, "movies"), scratch_path(spark, "rating-csv")
    with scratch_scope(spark):                      # of the catalog only the movies are asked, the rest goes
        movie = fixture_catalog(spark, sf_dir).movie
        write_once(movie, movies)
    raw = dt.fx_rating_raw(spark, sf_dir)
    with shuffles_go(spark):
        raw.orderBy("row_ord").drop("row_ord").select(*[f.name for f in fl.schemas.RAW_RATING_CSV.fields]) \
            .write.option("header", True).option("compression", "gzip").csv(path)
    rows, _bad = fl.read_rating_csv(spark, path)
    remove(spark, path)                             # the parse is staged
    return it.build_interactions(rows, spark.read.schema(movie.schema).parquet(movies)).rating


@query("csv_malformed")
def q_csv_malformed(spark, sf_dir):
    """S1 + S2: lines of both raw files that are cut off, have a cell too many or hold what
    does not parse, kept aside with their text; good lines are counted."""
    part, orders = dt.table(spark, sf_dir, "part"), dt.table(spark, sf_dir, "orders")
    text = lambda *cells: F.concat_ws(",", *[c.cast("string") for c in cells])
    key = F.col("p_partkey")
    movie = text(F.col("p_type"), F.lit("A|B"), F.lit("D1"), F.col("p_brand"), F.lit("T"),
                 F.when(key % 20 == 3, F.lit("n/a")).otherwise((key % 10).cast("string")), key)
    movie = F.when(key % 20 == 7, F.concat(movie, F.lit(",more"))).when(key % 20 == 11, F.col("p_type")).otherwise(movie)
    okey = F.col("o_orderkey")
    rating = text(F.when(okey % 50 == 1, F.lit("7.5")).otherwise((okey % 10).cast("string")), F.col("o_custkey"),
                  F.when(okey % 50 == 2, F.lit("yesterday")).otherwise(F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss")),
                  F.col("o_custkey"), okey)
    parts = []
    for kind, lines, read in (("movie", part.select(movie.alias("line")), fl.read_movie_csv),
                              ("rating", orders.select(rating.alias("line")), fl.read_rating_csv)):
        path = scratch_path(spark, f"{kind}-lines")
        lines.write.text(path)
        rows, bad = read(spark, path, header=False)
        parts += [bad.select(F.lit(kind).alias("kind"), F.col(fl.CORRUPT).alias("line"), F.lit(1).cast("long").alias("n")),
                  rows.agg(F.count(F.lit(1)).alias("n")).select(F.lit(kind).alias("kind"), F.lit("good").alias("line"), "n")]
    return parts[0].unionByName(parts[1]).unionByName(parts[2]).unionByName(parts[3])


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    return q_recall(spark, sf_dir)
