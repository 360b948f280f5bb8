"""ST1-ST2: stream = batch, files delivered newest first; ingest ids continue."""

import pytest
from pyspark.sql import functions as F

from cinegraph import queries as Q
from cinegraph.operators.latest import latest_per_key
from cinegraph.session import scratch_path
from cinegraph.sources import driver_tables as dt
from cinegraph.streaming import ratings as st
from conftest import SF001


def test_stream_latest_equals_batch(spark):
    ev = dt.fx_event(spark, SF001)
    src = scratch_path(spark, "t-events")
    ev.repartitionByRange(5, F.col("ts").desc()).write.parquet(src)
    out, ck = scratch_path(spark, "t-state"), scratch_path(spark, "t-ckpt")
    st.run_latest(spark, src, out, ck, max_files=1)
    got = sorted(tuple(r) for r in st.current_latest(spark, out).select("uid", "mid", "rating").collect())
    batch = latest_per_key(ev, ["uid", "mid"], ["ts", "event_id"], ["rating"])
    assert got == sorted(tuple(r) for r in batch.select("uid", "mid", "rating").collect())
    manifest = st.latest_table(spark, out).manifest()
    assert manifest["version"] == 5 and manifest["batch"] == 4 and len(manifest["folders"]) == 5    # a commit per file


def test_ingest_validates_and_numbers(spark):
    raw = Q.fixture_raw_events(spark, SF001)
    src = scratch_path(spark, "t-raw")
    raw.write.parquet(src)
    out, rej, ck = (scratch_path(spark, n) for n in ("t-r", "t-j", "t-c"))
    st.ingest(spark, src, out, rej, ck, base_max_id=lambda: 99)
    rows = spark.read.parquet(out)
    ids = sorted(r["id"] for r in rows.select("id").collect())
    assert ids == list(range(100, 100 + len(ids)))
    assert rows.where("rating < 1 OR rating > 10").count() == 0
    assert rows.count() + spark.read.parquet(rej).count() == raw.count()


def test_ids_go_on_over_batches_and_never_restart(spark, tmp_path):
    raw = Q.fixture_raw_events(spark, SF001)
    src, out = str(tmp_path / "src"), str(tmp_path / "rating")
    raw.repartition(3).write.parquet(src)
    st.ingest(spark, src, out, str(tmp_path / "bad"), str(tmp_path / "ck"), max_files=1)
    rows = spark.read.parquet(out)
    assert sorted(r["id"] for r in rows.select("id").collect()) == list(range(rows.count()))
    n = rows.count()
    assert st.next_id(spark, out, 3) == n and st.next_id(spark, out, 0, lambda: 41) == 42
    marks = tmp_path / "rating_marks"
    for f in (marks / "batch=2").glob("part-*"):
        f.write_bytes(b"broken")
    for f in (marks / "batch=2").glob(".part-*"):
        f.unlink()
    with pytest.raises(Exception):  # noqa: B017 - an unreadable mark is no empty one
        st.next_id(spark, out, 3)
    assert st.next_id(spark, str(tmp_path / "nothing"), 0) == 0
    marks.rename(tmp_path / "moved")
    with pytest.raises(RuntimeError):
        st.next_id(spark, out, 3)


def test_scratch_of_a_batch_goes_with_it(spark):
    from cinegraph.session import materialize, path_exists, scratch_scope
    with scratch_scope(spark):
        path = scratch_path(spark, "t-gone")
        materialize(spark.range(3), "t-inner")
        spark.range(3).write.parquet(path)
        assert path_exists(spark, path)
    assert not path_exists(spark, path)


def test_refresh_reads_only_the_touched_users_buckets(spark, tmp_path):
    rows = spark.range(2000).selectExpr("id % 200 AS uid", "id AS mid", "1L AS rating")
    path, users = str(tmp_path / "by-user"), spark.createDataFrame([(7,), (42,)], "uid long")
    st.write_by_user(rows, path)
    found = st.read_users(spark, path, users, rows.schema)
    assert sorted((r["uid"], r["mid"]) for r in found.collect()) == sorted(
        (i % 200, i) for i in range(2000) if i % 200 in (7, 42))
    files = {f.split("bucket=")[1].split("/")[0] for f in found.inputFiles()}
    touched = {str(r["bucket"]) for r in users.select(st.user_bucket()).collect()}
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [bucket" in plan and touched <= files and len(touched) <= 2
    scanned = spark.read.parquet(path).where(F.col("bucket").isin([int(b) for b in touched]))
    assert scanned.count() < rows.count() / 10
