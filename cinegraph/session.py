"""Session helpers: defaults for local runs, and the shared scratch folder.

Library code never creates a session; it receives one.  ``local_session`` is for
tests, the bench and the command line.  ``scratch_path`` hands out folders below
the cluster's ``spark.checkpoint.dir`` (shared storage), which is where lineage is
cut with written tables; a local temporary folder is only used when the setting is
absent and the master is local (tests).
"""

from __future__ import annotations

import os
import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import SparkSession

DEFAULT_CONF = {
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


#: compression of scratch tables, which are written once and read a few times
SCRATCH_CODEC = "zstd"


def local_session(cores: int | None = None, shuffle_partitions: int | None = None,
                  app: str = "cinegraph", extra: dict | None = None) -> SparkSession:
    cores = cores or int(os.environ.get("BENCH_CPUS", "8"))
    builder = SparkSession.builder.master(f"local[{cores}]").appName(app)
    conf = dict(DEFAULT_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions or cores)
    conf.setdefault("spark.driver.memory", os.environ.get("CINEGRAPH_DRIVER_MEMORY", "16g"))
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    checkpoint_dir(spark)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder of this session (set one only if it is unset).

    Without a reachable SparkContext (a remote session) the folder must be given
    by ``spark.checkpoint.dir``."""
    try:
        sc = spark.sparkContext
    except Exception:  # noqa: BLE001 - remote session: configuration only
        conf = spark.conf.get("spark.checkpoint.dir", None)
        if not conf:
            raise RuntimeError("spark.checkpoint.dir must name a shared folder") from None
        return conf
    current = sc.getCheckpointDir()
    if current:
        return current
    conf = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if not conf:
        if not sc.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
        conf = tempfile.mkdtemp(prefix="cinegraph-ckpt-")
    sc.setCheckpointDir(conf)
    return sc.getCheckpointDir() or conf


_OWNED: list[list[str]] = []


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique folder under the shared checkpoint folder."""
    base = checkpoint_dir(spark).rstrip("/")
    path = f"{base}/cinegraph/{name}-{uuid.uuid4().hex}"
    if _OWNED:
        _OWNED[-1].append(path)
    return path


@contextmanager
def scratch_scope(spark: SparkSession):
    """Removes, at its end, the scratch folders handed out inside: for a job or a
    micro-batch whose results are written elsewhere by then."""
    _OWNED.append([])
    try:
        yield
    finally:
        for path in _OWNED.pop():
            remove(spark, path)


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a file or folder is there (one look at the store, no listing); any other
    trouble (permissions, an unreachable store) raises instead of looking like an absent path."""
    jpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    return jpath.getFileSystem(spark._jsc.hadoopConfiguration()).exists(jpath)


#: whether a query's shuffle files go when it ends instead of when the driver collects garbage
_SHUFFLES_GO = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_go(spark: SparkSession):
    """Queries run inside leave no shuffle files."""
    before = spark.conf.get(_SHUFFLES_GO, None)
    spark.conf.set(_SHUFFLES_GO, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(_SHUFFLES_GO)
        else:
            spark.conf.set(_SHUFFLES_GO, before)


def write_once(df, path: str) -> None:
    """Write ``df`` as a scratch table; the files of its shuffles are removed once it stands."""
    with shuffles_go(df.sparkSession):
        df.write.mode("overwrite").option("compression", SCRATCH_CODEC).parquet(path)


def remove(spark: SparkSession, path: str) -> None:
    """Remove a scratch folder that nothing reads any more."""
    jpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    jpath.getFileSystem(spark._jsc.hadoopConfiguration()).delete(jpath, True)


def materialize(df, name: str = "stage"):
    """Write ``df`` once to the shared checkpoint folder and read it back: cuts the
    lineage (a lost executor re-reads the files instead of re-running the plan) and
    lets several consumers share one computation."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    write_once(df, path)
    return spark.read.schema(df.schema).parquet(path)


def measured(df, name: str = "stage"):
    """``materialize``, with the bytes written."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    write_once(df, path)
    jpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    size = jpath.getFileSystem(spark._jsc.hadoopConfiguration()).getContentSummary(jpath).getLength()
    return spark.read.schema(df.schema).parquet(path), size
