"""Jobs of many steps keep the disk of one step, not of all."""

import os

import pytest

from cinegraph.plans import factorization as fz
from cinegraph.plans import models as md
from cinegraph.session import checkpoint_dir, materialize


def block_files(spark) -> int:
    return spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles().size()


def test_a_written_table_leaves_no_shuffle_files(spark):
    rows = spark.range(1000).selectExpr("id", "id % 7 AS k").repartition(5, "k")
    materialize(rows.groupBy("k").count(), "t-warm")
    before = block_files(spark)
    sums = materialize(rows.groupBy("k").count(), "t-sums")
    assert block_files(spark) <= before
    assert {(r["k"], r["count"]) for r in sums.collect()} == {(k, 143 if k < 6 else 142) for k in range(7)}
    # the setting is the write's own
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled") == "false"


def test_als_lets_the_shuffles_of_earlier_sweeps_go(spark):
    """Every sweep shuffles all factors; the files left must not grow with the sweeps."""
    rated = spark.createDataFrame([(u, m, float(1 + (u * m) % 9)) for u in range(30) for m in range(20) if (u + m) % 3],
                                  "uid long, mid long, rating double")
    left = []
    for sweeps in (2, 8):
        before = block_files(spark)
        md.fit_als(rated, 2, sweeps, 0.1)
        left.append(block_files(spark) - before)
    assert left[1] <= left[0] + 8


def scratch_folders(spark) -> int:
    base = checkpoint_dir(spark).removeprefix("file:")
    return len(os.listdir(f"{base}/cinegraph")) if os.path.isdir(f"{base}/cinegraph") else 0


def test_factorization_keeps_one_set_of_parameters(spark):
    """The scratch folders left do not grow with the sweeps, nor the result with the blocks."""
    rows = spark.createDataFrame([(i, float(i * 5 % 9), [i % 6, 6 + i * 7 % 5], [1.0, 1.0]) for i in range(60)],
                                 "row long, y double, idx array<long>, val array<double>")
    left, found = [], []
    for epochs, block_rows in ((1, 500_000), (2, 500_000), (2, 4)):
        before = scratch_folders(spark)
        model = fz.fit(rows, 2, epochs, 0.1, (0, 6), block_rows=block_rows)
        left.append(scratch_folders(spark) - before)
        found.append({r["feature"]: r["theta"] for r in model.params.collect()})
    assert len(set(left)) == 1
    assert found[1].keys() == found[2].keys() and all(found[1][j] == pytest.approx(found[2][j], abs=1e-9) for j in found[1])
