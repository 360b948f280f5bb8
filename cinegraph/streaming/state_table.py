"""ST2's output as a log-structured table: batches append, levels merge, readers see a snapshot.

Every committed batch is a folder at level 0.  When a level holds ``fan`` folders they are
merged into one of the next level, with only the newest row per key, so after n batches
at most (fan - 1) * log_fan(n) folders are live.  A manifest (a small JSON file, numbered)
lists the live folders and the last batch; it is written aside and renamed, so a batch and
the merges it sets off become visible together or not at all.  Whatever a stopped writer
left is in no manifest, and a replayed batch that is committed already changes nothing.
Readers take the newest manifest; ``vacuum`` removes what the last few do not list.  There is
one writer: a manifest number that exists already raises.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession

from ..operators.latest import latest_per_key
from ..session import path_exists

FAN = 8


class StateTable:
    """Rows with ``keys``, of which the one with the greatest ``order`` counts."""

    def __init__(self, spark: SparkSession, path: str, keys: list[str], order: list[str], fan: int = FAN):
        if fan < 2:
            raise ValueError("a level needs two folders at least")
        self.spark, self.path, self.keys, self.order, self.fan = spark, path.rstrip("/"), keys, order, fan
        self._java = spark._jvm.org.apache.hadoop.fs.Path
        self._fs = self._java(self.path).getFileSystem(spark._jsc.hadoopConfiguration())

    # ---- manifests -------------------------------------------------------------------

    def _versions(self) -> list[int]:
        folder = self._java(f"{self.path}/_manifest")
        if not self._fs.exists(folder):
            return []
        names = [s.getPath().getName() for s in self._fs.listStatus(folder)]
        return sorted(int(n[:-5]) for n in names if n.endswith(".json"))

    def _file(self, version: int):
        return self._java(f"{self.path}/_manifest/{version:012d}.json")

    def manifest(self, version: int | None = None) -> dict:
        """The newest manifest (or that of a version): version, batch, folders."""
        if version is None:
            found = self._versions()
            if not found:
                return {"version": 0, "batch": -1, "folders": []}
            version = found[-1]
        stream = self._fs.open(self._file(version))
        try:
            text = self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()
        return json.loads(text)

    def _commit(self, manifest: dict) -> None:
        aside = self._java(f"{self.path}/_manifest/{uuid.uuid4().hex}.tmp")
        out = self._fs.create(aside, True)
        out.write(bytearray(json.dumps(manifest).encode()))
        out.close()
        target = self._file(manifest["version"])
        if self._fs.exists(target) or not self._fs.rename(aside, target):
            raise RuntimeError(f"{self.path}: version {manifest['version']} was committed by another writer")

    # ---- writing ---------------------------------------------------------------------

    def _write(self, rows: DataFrame) -> str:
        name = f"data/{uuid.uuid4().hex}"
        rows.write.parquet(f"{self.path}/{name}")
        return name

    def _newest(self, rows: DataFrame) -> DataFrame:
        rest = [c for c in rows.columns if c not in self.keys]
        return latest_per_key(rows, self.keys, self.order, rest).select(*rows.columns)

    def append(self, rows: DataFrame, batch: int) -> None:
        """Commit a batch's rows; a batch not after the last committed one is a replay."""
        now = self.manifest()
        if batch <= now["batch"]:
            return
        folders = now["folders"] + [{"name": self._write(rows), "level": 0}]
        while True:
            level = next((k for k in sorted({f["level"] for f in folders})
                          if sum(f["level"] == k for f in folders) >= self.fan), None)
            if level is None:
                break
            full = [f for f in folders if f["level"] == level]
            merged = self._write(self._newest(self._read([f["name"] for f in full], rows.schema)))
            folders = [f for f in folders if f["level"] != level] + [{"name": merged, "level": level + 1}]
        self._commit({"version": now["version"] + 1, "batch": batch, "folders": folders})

    def vacuum(self, keep: int = 3) -> int:
        """Remove folders that none of the last ``keep`` manifests list, and older manifests.
        Returns the number of folders removed.  Readers of older snapshots must be done."""
        versions = self._versions()
        live = {f["name"] for v in versions[-keep:] for f in self.manifest(v)["folders"]}
        removed = 0
        if path_exists(self.spark, f"{self.path}/data"):
            for s in self._fs.listStatus(self._java(f"{self.path}/data")):
                if f"data/{s.getPath().getName()}" not in live:
                    removed += bool(self._fs.delete(s.getPath(), True))
        for v in versions[:-keep]:
            self._fs.delete(self._file(v), False)
        return removed

    # ---- reading ---------------------------------------------------------------------

    def _read(self, names: list[str], schema) -> DataFrame:
        return self.spark.read.schema(schema).parquet(*[f"{self.path}/{n}" for n in names])

    def current(self, schema) -> DataFrame:
        """The newest row per key in the present snapshot (empty before the first batch)."""
        names = [f["name"] for f in self.manifest()["folders"]]
        if not names:
            return self.spark.createDataFrame([], schema)
        return self._newest(self._read(names, schema))
