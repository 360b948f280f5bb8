"""The log-structured state table: bounded folders, replays, stopped writers, snapshots."""

import random

import pytest

from cinegraph.session import scratch_path
from cinegraph.streaming.state_table import StateTable

SCHEMA = "k long, ts long, v long"


def table(spark, path, fan=3):
    return StateTable(spark, path, ["k"], ["ts"], fan)


def rows_of(t):
    return sorted(tuple(r) for r in t.current(SCHEMA).collect())


def test_bounded_folders_and_newest_rows(spark):
    rng, path, want = random.Random(1), scratch_path(spark, "t-state"), {}
    t = table(spark, path)
    assert rows_of(t) == []
    for batch in range(30):
        rows = [(k, rng.randint(0, 50) * 100 + batch, batch) for k in rng.sample(range(12), 4)]
        for k, ts, v in rows:                                   # a late, older row must not win
            want[k] = max(want.get(k, (-1, -1)), (ts, v))
        t.append(spark.createDataFrame(rows, SCHEMA).coalesce(1), batch)
        folders = t.manifest()["folders"]
        assert len(folders) <= 2 * 4                            # (fan - 1) * log_fan(30), rounded up
        if batch % 10 == 9:
            assert rows_of(table(spark, path)) == sorted((k, *x) for k, x in want.items())
    t.vacuum(keep=1)
    live = {f["name"] for f in t.manifest()["folders"]}
    left = {s.getPath().getName() for s in t._fs.listStatus(t._java(f"{path}/data"))}
    assert {f"data/{n}" for n in left} == live and len(t._versions()) == 1
    assert rows_of(t) == sorted((k, *x) for k, x in want.items())


def test_replay_changes_nothing(spark):
    t = table(spark, scratch_path(spark, "t-state"))
    rows = spark.createDataFrame([(1, 1, 1)], SCHEMA)
    t.append(rows, 0)
    before = t.manifest()
    t.append(rows, 0)
    assert t.manifest() == before


@pytest.mark.parametrize("step", ["_write", "_commit"])
def test_writer_stopped_between_steps(spark, monkeypatch, step):
    path = scratch_path(spark, "t-state")
    t = table(spark, path, fan=2)
    t.append(spark.createDataFrame([(1, 1, 1), (2, 1, 1)], SCHEMA), 0)
    calls, whole = [], getattr(StateTable, step)

    def stopped(self, *args):
        calls.append(1)
        if step == "_commit" or len(calls) == 2:                # the second write is the merge
            raise OSError("lost")
        return whole(self, *args)
    monkeypatch.setattr(StateTable, step, stopped)
    new = spark.createDataFrame([(1, 2, 7)], SCHEMA)
    with pytest.raises(OSError):
        t.append(new, 1)
    monkeypatch.undo()
    again = table(spark, path, fan=2)
    assert rows_of(again) == [(1, 1, 1), (2, 1, 1)]             # nothing of the lost batch
    again.append(new, 1)                                        # replayed
    assert rows_of(again) == [(1, 2, 7), (2, 1, 1)] and again.manifest()["folders"][0]["level"] == 1
    assert again.vacuum(keep=1) >= 1


def test_snapshot_outlives_later_commits_and_second_writer_raises(spark):
    path = scratch_path(spark, "t-state")
    t = table(spark, path)
    t.append(spark.createDataFrame([(1, 1, 1)], SCHEMA), 0)
    snapshot = t.current(SCHEMA)
    for batch in range(1, 4):
        t.append(spark.createDataFrame([(1, 1 + batch, batch)], SCHEMA), batch)
        t.vacuum(keep=10)
    assert [tuple(r) for r in snapshot.collect()] == [(1, 1, 1)]
    stale = t.manifest(3)
    with pytest.raises(RuntimeError):
        t._commit(stale)
    with pytest.raises(ValueError):
        table(spark, path, fan=1)
