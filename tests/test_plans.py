"""Plan checks: no cartesian product and no Python UDF in the core jobs; filters
and column pruning reach the parquet scan."""

from cinegraph import queries as Q
from conftest import SF001


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_no_cartesian_or_python_udf(spark):
    for name in ("recall", "catalog_movie", "interactions_rating", "user_history"):
        plan = _plan(Q.QUERIES[name](spark, SF001))
        for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython"):
            assert bad not in plan, (name, bad)


def test_scan_pruning(spark):
    from cinegraph.sources import driver_tables as dt
    plan = dt.fx_actor(spark, SF001).select("mid")._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(l_partkey)]" in plan
    # distinct (mid, aid) needs the actor key's parts; nothing else of lineitem is read
    assert "ReadSchema: struct<l_orderkey:bigint,l_partkey:bigint,l_suppkey:bigint,l_quantity:double>" in plan


def test_recall_without_broadcasts_joins_persons_by_rank(spark):
    """The second hop joins on (role, person, rank), a key no prolific person makes hot."""
    from cinegraph.plans import recall as rc
    from cinegraph.sources import driver_tables as dt
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        latest = Q.fixture_latest(spark, SF001)
        _, hop = rc.good_hop(latest, dt.fx_item(spark, SF001), dt.fx_bridge(spark, SF001), rc.RecallParams())
        plan = _plan(hop)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert "SortMergeJoin" in plan and "CartesianProduct" not in plan and "NestedLoop" not in plan
    assert any("SortMergeJoin" in line and "role" in line and "pid" in line and "nth" in line
               for line in plan.splitlines())


def test_page_range_reaches_scan(spark):
    from cinegraph.plans import serving as sv
    from cinegraph.sources import tables as tb
    tb.use_database(spark, "cinegraph_plan_t")
    movies = spark.range(100).selectExpr("id", "concat('m', id) AS name", "cast(id % 10 AS double) AS rating")
    published = tb.publish(movies, "movie_pages", key="id", num_files=4)
    page = sv.page_of(published, 2, ["name"])
    plan = _plan(page)
    spark.catalog.setCurrentDatabase("default")
    assert "GreaterThanOrEqual(id,40)" in plan and "LessThan(id,60)" in plan
    assert [r["id"] for r in page.collect()] == list(range(40, 60))
