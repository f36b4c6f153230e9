"""Tables that are written, checked and published in that order.

A store is a folder. Each write of a table goes to a folder of its own,
``{base}/{name}/v-{id}``, and is never changed again. What readers see is the
last manifest, ``{base}/_manifests/{number}.json``, which names one version of
every published table. ``publish`` writes the next manifest under a temporary
name and renames it: one step, after which all its tables are the new ones.
Whatever happens before (a job killed in mid-write, a failed check) leaves the
former manifest, and so the former tables, in place.

Of two publishers at once, the rename of the second to the same number fails
(on file systems where renaming doesn't replace, as HDFS), and it tries again on
top of the first. Versions that no manifest names stay on disk; removing them is
the owner's decision.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

_FOLDER = "_manifests"
_DIGITS = 12


class Store:
    """Published tables under one base folder, on any file system Spark reads."""

    def __init__(self, spark: SparkSession, base: str):
        self.spark, self.base = spark, base.rstrip("/")

    def _path(self, *parts: str):
        path = self.spark._jvm.org.apache.hadoop.fs.Path("/".join((self.base, *parts)))
        return path, path.getFileSystem(self.spark._jsc.hadoopConfiguration())

    def _last(self) -> int:
        """The number of the last manifest, 0 without one."""
        folder, fs = self._path(_FOLDER)
        if not fs.exists(folder):
            return 0
        names = [s.getPath().getName() for s in fs.listStatus(folder)]
        return max((int(n[:-5]) for n in names if n.endswith(".json") and n[:-5].isdigit()), default=0)

    def _manifest(self, number: int) -> dict[str, dict]:
        if not number:
            return {}
        path, _ = self._path(_FOLDER, f"{number:0{_DIGITS}}.json")
        lines = self.spark.read.text(path.toString(), wholetext=True).first()
        return json.loads(lines[0])

    def published(self) -> dict[str, dict]:
        """Of every published table its ``versions`` (more than one if it was
        added to) and, if bucketed, its ``table`` in the session's catalog."""
        return self._manifest(self._last())

    def stage(self, df: DataFrame, name: str, write: Callable | None = None) -> dict:
        """Write ``df`` as a new version that nobody sees yet. ``write`` takes
        (df, path) and returns the name of a catalog table (bucketed tables)."""
        version = f"v-{uuid.uuid4().hex}"
        path = f"{self.base}/{name}/{version}"
        if write is not None:
            return {"versions": [version], "table": write(df, path)}
        df.write.parquet(path)
        return {"versions": [version]}

    def stage_more(self, df: DataFrame, name: str) -> dict:
        """Write ``df`` as an addition to the published table."""
        before = self.published().get(name, {"versions": []})["versions"]
        return {"versions": before + self.stage(df, name)["versions"]}

    def paths(self, name: str, entry: dict) -> list[str]:
        return [f"{self.base}/{name}/{v}" for v in entry["versions"]]

    def read_version(self, name: str, entry: dict) -> DataFrame:
        table = entry.get("table")
        if table and self.spark.catalog.tableExists(table):
            return self.spark.table(table)
        return self.spark.read.parquet(*self.paths(name, entry))

    def read(self, name: str) -> DataFrame:
        """The published version of a table."""
        entry = self.published().get(name)
        if entry is None:
            raise FileNotFoundError(f"no table {name} is published in {self.base}")
        return self.read_version(name, entry)

    def publish(self, entries: dict[str, dict]) -> None:
        """Make staged versions the ones that readers see, all in one step;
        other published tables stay as they are."""
        folder, fs = self._path(_FOLDER)
        fs.mkdirs(folder)
        while True:
            number = self._last()
            content = json.dumps({**self._manifest(number), **entries}, sort_keys=True)
            draft, _ = self._path(_FOLDER, f".{uuid.uuid4().hex}.tmp")
            out = fs.create(draft, False)
            out.write(bytearray(content.encode()))
            out.close()
            target, _ = self._path(_FOLDER, f"{number + 1:0{_DIGITS}}.json")
            if not fs.exists(target) and fs.rename(draft, target):
                return
            fs.delete(draft, False)
