"""Golden tests from the reference's sample rows (FIXTURES.md section 1)."""

import datetime as dt

from pyspark.sql import functions as F

from cinegraph.plans import catalog as cg
from cinegraph.plans import interactions as it
from cinegraph.plans import recall as rc
from cinegraph.plans import serving as sv
from golden import movie_raw, rating_raw


def _rows(df, *cols):
    return sorted(tuple(r[c] for c in cols) for r in df.collect())


def test_movie_table(spark):
    cat = cg.build_catalog(movie_raw(spark))
    got = {r["id"]: r for r in cg.movie_table(cat).collect()}
    assert got[0]["name"] == "我不是药神" and got[0]["rating"] == 8.9
    assert got[0]["genres"] == [0, 1, 2] and got[0]["actors"] == [0, 1, 2, 3, 4]
    assert got[0]["directors"] == [0] and got[0]["traits"] == [0, 1, 2] and got[0]["district"] == 0
    assert (got[1]["genres"], got[1]["actors"], got[1]["district"], got[1]["directors"], got[1]["traits"],
            got[1]["rating"]) == ([1], [5, 0], 1, [1], [0], 7.0)
    assert (got[2]["genres"], got[2]["actors"], got[2]["district"], got[2]["directors"], got[2]["traits"],
            got[2]["rating"]) == ([0], [6], 1, [0], [1], 5.0)


def test_dimensions(spark):
    cat = cg.build_catalog(movie_raw(spark))
    expect = {
        "genre": [(0, "剧情", [0, 2]), (1, "喜剧", [0, 1]), (2, "犯罪", [0])],
        "trait": [(0, "经典", [0, 1]), (1, "感人", [0, 2]), (2, "搞笑", [0])],
        "district": [(0, "中国大陆", [0]), (1, "美国", [1, 2])],
        "director": [(0, "文牧野", [0, 2]), (1, "B", [1])],
        "actor": [(0, "徐峥", [0, 1]), (1, "王传君", [0]), (2, "周一围", [0]), (3, "谭卓", [0]),
                  (4, "章宇", [0]), (5, "A", [1]), (6, "C", [2])],
    }
    for dim, rows in expect.items():
        got = sorted((r["id"], r["name"], r["movies"]) for r in cg.dimension_table(cat, dim).collect())
        assert got == rows, dim


def test_interactions_and_recall(spark):
    cat = cg.build_catalog(movie_raw(spark))
    inter = it.build_interactions(rating_raw(spark), cat.movie)
    assert _rows(inter.rejects, "name", "movie") == [("cy", "Unknown")]
    assert _rows(inter.rating, "id", "uid", "mid", "rating") == [(0, 0, 0, 8), (1, 1, 1, 5), (2, 1, 2, 9),
                                                                  (3, 2, 1, 2)]
    users = sorted((r["id"], r["name"], r["movies"]) for r in it.user_table(inter, cat.movie).collect())
    assert users == [(0, "ann", [0]), (1, "bob", [1, 2]), (2, "dan", [1])]

    lists = rc.recall(sv.latest_ratings(inter.rating), cat.movie, cat.people_bridge())
    got = {}
    for r in lists.orderBy("uid", "pos").collect():
        got.setdefault(r["uid"], []).append(r["mid"])
    assert got == {0: [1], 1: [0], 2: [0, 1, 2]}

    # after ann rates movie 0 with 3 (later), she likes nothing -> global top list
    extra = spark.createDataFrame([(4, 0, 0, dt.datetime(2019, 2, 1), 3)], inter.rating.schema)
    latest = sv.latest_ratings(inter.rating.unionByName(extra))
    assert _rows(latest.where("uid = 0"), "mid", "rating") == [(0, 3)]
    lists = rc.recall(latest, cat.movie, cat.people_bridge()).where("uid = 0").orderBy("pos")
    assert [r["mid"] for r in lists.collect()] == [0, 1, 2]


def test_my_rating_defaults_to_zero(spark):
    cat = cg.build_catalog(movie_raw(spark))
    inter = it.build_interactions(rating_raw(spark), cat.movie)
    req = spark.createDataFrame([(0, 0), (0, 2)], "uid long, mid long")
    got = _rows(sv.my_ratings(req, inter.rating), "uid", "mid", "myrating", "stars")
    assert got == [(0, 0, 8, 80), (0, 2, 0, 0)]


def test_strict_rejects(spark):
    import pytest
    cat = cg.build_catalog(movie_raw(spark))
    with pytest.raises(it.UnknownMovieError):
        it.build_interactions(rating_raw(spark), cat.movie, strict=True)


def test_rows_without_a_name_take_no_ids(spark):
    raw = movie_raw(spark)
    first = raw.orderBy("row_ord").first()["name"]
    broken = raw.withColumn("name", F.when(F.col("name") != first, F.col("name"))) \
        .withColumn("genre", F.when(F.col("genre") != "喜剧", F.col("genre")))
    cat = cg.build_catalog(broken)
    n = raw.select("name").distinct().count() - 1
    assert [r["id"] for r in cat.movie.orderBy("id").collect()] == list(range(n))
    assert cat.rejects.count() == raw.where(F.col("name") == first).count()
    for dim in cg.DIMENSIONS:
        rows = cat.names[dim].orderBy("id").collect()
        assert [r["id"] for r in rows] == list(range(len(rows))) and all(r["name"] is not None for r in rows), dim
    ratings = rating_raw(spark).withColumn("name", F.when(F.col("name") != "ann", F.col("name")))
    inter = it.build_interactions(ratings, cg.build_catalog(raw).movie)
    assert [r["id"] for r in inter.user.orderBy("id").collect()] == [0, 1]
    assert {r["name"] for r in inter.rejects.collect()} == {None, "cy"}


def test_empty_stage1_can_exclude_rated(spark):
    cat = cg.build_catalog(movie_raw(spark))
    inter = it.build_interactions(rating_raw(spark), cat.movie)
    p = rc.RecallParams(exclude_rated_when_empty=True)
    lists = rc.recall(sv.latest_ratings(inter.rating), cat.movie, cat.people_bridge(), p)
    dan = [r["mid"] for r in lists.where("uid = 2").orderBy("pos").collect()]
    assert dan == [0, 2]


def test_rejects_do_not_build_the_rating_table(spark):
    """The tables of the interactions are built when asked for, and users come from the numbered
    ratings: one table of all ratings is written."""
    cat = cg.build_catalog(movie_raw(spark))
    inter = it.build_interactions(rating_raw(spark), cat.movie)
    assert _rows(inter.rejects, "name", "movie") == [("cy", "Unknown")]
    assert "_numbered" not in vars(inter) and "rating" not in vars(inter)
    assert _rows(inter.user, "id", "name") == [(0, "ann"), (1, "bob"), (2, "dan")]
    assert "_numbered" in vars(inter) and "rating" not in vars(inter)


def test_split_hashes_each_row_once(spark):
    from cinegraph.plans import models as md
    rows = spark.range(1000).selectExpr("id", "id % 9 AS uid", "id % 7 AS mid", "id % 10 + 1 AS rating")
    train, test = md.split(rows)
    assert train.count() == 750 and test.count() == 250 and train.columns == ["id", "uid", "mid", "rating"]
    assert "md5" not in train._jdf.queryExecution().optimizedPlan().toString()


def test_catalog_stages_the_raw_rows_only(spark, monkeypatch):
    """Movies are numbered with their cells, so first rows and ids need no tables of their own."""
    staged = []
    kept = cg.materialize
    monkeypatch.setattr(cg, "materialize", lambda df, name="stage": staged.append(name) or kept(df, name))
    cat = cg.build_catalog(movie_raw(spark))
    assert staged == ["catalog-raw"]
    assert "name" not in [c for c in cat.movie_actor.columns]
    assert _rows(cat.movie_actor, "mid", "pos", "aid")[-1] == (2, 0, 6)
