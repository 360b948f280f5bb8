"""The command-line jobs on the golden rows: CSV -> published tables -> recall ->
recommendations."""

from cinegraph import cli
from cinegraph.session import scratch_path
from cinegraph.sources import files as fl
from cinegraph.sources import tables as tb
from golden import movie_raw, rating_raw


def test_etl_recall_recommend(spark):
    mpath, rpath = scratch_path(spark, "t-movies"), scratch_path(spark, "t-ratings")
    movie_raw(spark).orderBy("row_ord").drop("row_ord").coalesce(1).write.option("header", True).csv(mpath)
    rating_raw(spark).orderBy("row_ord").drop("row_ord").coalesce(1).write.option("header", True).csv(rpath)
    tb.use_database(spark, "cinegraph_cli_t")
    try:
        cli.etl(spark, mpath, rpath)
        assert spark.table("movie").schema == fl.schemas.MOVIE
        assert spark.table("user").columns == ["id", "name"] and spark.table("genre").columns == ["id", "name"]
        assert sorted((r["id"], r["mid"]) for r in spark.table("user_movies").collect()) == [(0, 0), (1, 1), (1, 2), (2, 1)]
        cli.etl(spark, mpath, rpath, arrays=True)
        assert spark.table("genre").schema == fl.schemas.DIMENSION
        assert sorted((r["id"], r["movies"]) for r in spark.table("user").collect()) == [(0, [0]), (1, [1, 2]),
                                                                                         (2, [1])]
        assert spark.table("rating_rejects").count() == 1
        got = {}
        for r in cli.recall_job(spark).orderBy("uid", "pos").collect():
            got.setdefault(r["uid"], []).append(r["mid"])
        assert got == {0: [1], 1: [0], 2: [0, 1, 2]}
        recs = cli.recommend_job(spark, scratch_path(spark, "t-model"), k=2)
        assert {r["uid"] for r in recs.collect()} <= {0, 1, 2}
    finally:
        spark.catalog.setCurrentDatabase("default")


def test_select_job_resumes(spark):
    import datetime as dt
    rows = [(i, i % 30, (i * 7) % 20, dt.datetime(2019, 1, 1), (i * 13) % 10 + 1) for i in range(900)]
    tb.use_database(spark, "cinegraph_sel_t")
    try:
        tb.publish(spark.createDataFrame(rows, fl.schemas.RATING), "rating")
        path = scratch_path(spark, "t-grid")
        grids = dict(als_grid=((2,), (3,), (0.1, 0.1)), fm_grid=((2,), (3,), (0.1,)))
        report = cli.select_job(spark, path, **grids)
        assert sorted(r["algo"] for r in report.collect()) == ["als", "fm"]
        cli.select_job(spark, path, **grids)          # resumed: nothing left to fit
        assert spark.read.parquet(path).count() == 2  # one ALS point (0.1 repeated) + one FM point
    finally:
        spark.catalog.setCurrentDatabase("default")
