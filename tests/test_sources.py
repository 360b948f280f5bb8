"""S3 crawl sample, facet grid, CSV scans, publish/append."""

import datetime as dt

from cinegraph.sources import crawl as cw
from cinegraph.sources import files as fl
from cinegraph.sources import tables as tb
from cinegraph.session import scratch_path


def test_crawl_sample(spark):
    body = '{"data":[{"directors":["B"],"rate":"7.0","title":"M2","casts":["A","徐峥"],"cover":"x"},' \
           '{"directors":[],"title":"M9","casts":[],"cover":"y"}]}'
    req = spark.createDataFrame([("电影", "喜剧", "美国", "经典", body), ("电影", "喜剧", "美国", "经典", '{"data":[]}')],
                                "form string, Type string, country string, genres string, body string")
    rows, rejects = fl.normalise_crawl(req)
    got = sorted(tuple(r) for r in rows.collect())
    assert rejects.count() == 0
    assert got == [("", 0.0, "M9", "", "电影", "喜剧", "美国", "经典"),
                   ("B", 7.0, "M2", "A|徐峥", "电影", "喜剧", "美国", "经典")]


def test_crawl_rejects_malformed_bodies(spark):
    bodies = ['{"data":[{"directors":["B"],"rate":"x","title":"M2","casts":[]}]}', '{"data":[{"directors":["B"', "<html/>",
              '{"data":[]}', None]
    req = spark.createDataFrame([("f", "T", "c", "g", b) for b in bodies],
                                "form string, Type string, country string, genres string, body string")
    rows, rejects = fl.normalise_crawl(req)
    assert [(r["title"], r["rate"]) for r in rows.collect()] == [("M2", None)]
    assert {r["body"] for r in rejects.collect()} == {bodies[1], bodies[2], None}


def test_facet_grid(spark):
    g = cw.facet_grid(spark)
    assert g.count() == 7 * 9
    assert cw.crawl_requests(g, 40).count() == 63 * 3


def test_movie_csv_order_and_header(spark):
    path = scratch_path(spark, "t-csv")
    rows = [("g", "a|b", "d", "x", "t", 1.0, f"m{i}") for i in range(50)]
    df = spark.createDataFrame(rows, fl.schemas.RAW_MOVIE_CSV)
    df.coalesce(1).write.option("header", True).csv(path)
    back = fl.read_movie_csv(spark, path)[0].orderBy("row_ord").collect()
    assert [r["name"] for r in back] == [f"m{i}" for i in range(50)]


def test_rating_csv_rejects_malformed(spark):
    path = scratch_path(spark, "t-rcsv")
    lines = ["rating,name,time,uid,movie", "8,ann,2019-01-01 00:00:00,1,M", "x,bob,not a time,2,M"]
    spark.createDataFrame([(s,) for s in lines], "v string").coalesce(1).write.text(path)
    good, bad = fl.read_rating_csv(spark, path)
    assert [(r["name"], r["time"]) for r in good.collect()] == [("ann", dt.datetime(2019, 1, 1))]
    assert bad.count() == 1


def test_publish_and_append(spark):
    tb.use_database(spark, "cinegraph_t")
    rating = spark.createDataFrame([(0, 0, 0, dt.datetime(2019, 1, 1), 8)], fl.schemas.RATING)
    tb.publish(rating, "rating")
    new = spark.createDataFrame([(0, 1, 3)], "uid long, mid long, rating long")
    tb.append_ratings(spark, "rating", new, as_of=dt.datetime(2019, 2, 1))
    tb.refresh(spark, "rating")
    got = sorted((r["id"], r["mid"], r["rating"]) for r in tb.scan(spark, "rating", "id", "mid", "rating").collect())
    assert got == [(0, 0, 8), (1, 1, 3)]
    assert tb.preview(spark, "rating", 1).first()["id"] == 0
    spark.catalog.setCurrentDatabase("default")


def test_crawl_tokens(spark):
    df = spark.createDataFrame([("{'rate': '7.0', 'title': 'M 2：续集', 'casts': ['徐峥', '周-杰·伦']}",)], "body string")
    assert df.select(fl.crawl_tokens("body").alias("t")).first()["t"] == [
        "rate", "7.0", "title", "M 2：续集", "casts", "徐峥", "周-杰·伦"]


def test_append_csv_and_publish_all(spark):
    path = scratch_path(spark, "t-append")
    rows = spark.createDataFrame([("B", 7.0, "M2", "A|徐峥", "电影", "喜剧", "美国", "经典")], fl.schemas.CRAWL_ROW)
    tb.append_csv(rows, path)
    tb.append_csv(rows, path)
    back = spark.read.schema(fl.schemas.CRAWL_ROW).csv(path)      # header-less
    assert back.count() == 2 and back.first()["casts"] == "A|徐峥"
    tb.use_database(spark, "cinegraph_t2")
    movie = spark.createDataFrame([(1, "M", [0], [1, 2], 0, [3], [], 7.5)],
                                  "id long, name string, genres array<bigint>, actors array<bigint>, "
                                  "district long, directors array<bigint>, traits array<bigint>, rating double")
    out = tb.publish_all({"movie": movie}, prefix="p_")
    assert out["movie"].schema == fl.schemas.MOVIE and out["movie"].count() == 1
    spark.catalog.setCurrentDatabase("default")
