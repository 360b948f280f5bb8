"""Properties of SURVEY section 5 on the sf0.001 driver tables: dense ids, array
foreign keys resolve, inverted index <=> forward lists, recall list rules, and
the same results for 1, 7 and 64 shuffle partitions."""

import pytest
from pyspark.sql import functions as F

from cinegraph import queries as Q
from cinegraph.plans import catalog as cg
from cinegraph.plans import recall as rc
from cinegraph.sources import driver_tables as dt
from conftest import SF001


@pytest.fixture(scope="module")
def catalog(spark):
    return Q.fixture_catalog(spark, SF001)


def test_ids_are_dense(catalog):
    frames = {"movie": catalog.movie, **catalog.names}
    for name, df in frames.items():
        ids = sorted(r["id"] for r in df.select("id").collect())
        assert ids == list(range(len(ids))), name


def test_forward_lists_match_inverted_index(catalog):
    movie = {r["id"]: r for r in cg.movie_table(catalog).collect()}
    for dim, col in (("actor", "actors"), ("director", "directors"), ("genre", "genres"), ("trait", "traits")):
        names = {r["id"] for r in catalog.names[dim].collect()}
        inv = {(r["id"], r["mid"]) for r in cg.dimension_rows(catalog, dim).collect()}
        fwd = {(i, m) for m, r in movie.items() for i in r[col]}
        assert fwd == inv, dim
        assert {i for i, _ in fwd} <= names, dim     # every array foreign key resolves
    # inverted lists are ordered by movie rating desc, id asc
    rows = cg.dimension_rows(catalog, "genre").collect()
    by_dim = {}
    for r in rows:
        by_dim.setdefault(r["id"], []).append((r["pos"], -movie[r["mid"]]["rating"], r["mid"]))
    for lst in by_dim.values():
        lst.sort()
        assert [p for p, _, _ in lst] == list(range(len(lst)))
        assert [(a, b) for _, a, b in lst] == sorted((a, b) for _, a, b in lst)


def test_recall_rules(spark):
    latest = Q.fixture_latest(spark, SF001)
    items, bridge = dt.fx_item(spark, SF001), dt.fx_bridge(spark, SF001)
    s1 = {(r["uid"], r["mid"]) for r in rc.recall_stage1(latest, items, bridge).collect()}
    lists = {}
    for r in rc.recall(latest, items, bridge).collect():
        lists.setdefault(r["uid"], {})[r["pos"]] = r["mid"]
    rated = {}
    for r in latest.collect():
        rated.setdefault(r["uid"], set()).add(r["mid"])
    n_items = items.count()
    for u, d in lists.items():
        mids = [d[i] for i in range(len(d))]                  # positions dense from 0
        assert len(mids) == len(set(mids)) == min(50, n_items)
        n = sum((u, m) in s1 for m in mids)
        assert all((u, m) in s1 for m in mids[:n])             # stage 1 first, then backfill
        if n:
            assert not (set(mids) & rated[u])                  # no rated movie unless stage 1 is empty


def test_partition_independence(spark):
    results = []
    old = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        for n in (1, 7, 64):
            spark.conf.set("spark.sql.shuffle.partitions", str(n))
            results.append(sorted(tuple(r) for r in Q.q_recall(spark, SF001).collect()))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
    assert results[0] == results[1] == results[2]
    assert F
