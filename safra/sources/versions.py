"""A table of versions in a folder: every write is a new one, and a manifest, written last, makes it the current one.

``data-<id>`` folders hold Parquet, ``manifest-<number>.json`` names the folder of a version. A write that fails leaves
no manifest, so the version before it stays; a reader keeps the version that it has opened.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


class Conflict(RuntimeError):
    """Another writer has made the version first."""


class VersionedTable:
    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        self._root = self._hadoop(self.path)
        self._fs = self._root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def _hadoop(self, path: str):
        return self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)

    def versions(self) -> list[int]:
        """The numbers of all versions there are, in order."""
        if not self._fs.exists(self._root):
            return []
        names = [s.getPath().getName() for s in self._fs.listStatus(self._root)]
        return sorted(int(n[9:-5]) for n in names if n.startswith("manifest-") and n.endswith(".json"))

    def manifest(self, version: int | None = None) -> dict | None:
        """What is recorded of a version, the latest if none is named; None if there is none."""
        known = self.versions()
        if not known or (version is not None and version not in known):
            return None
        path = f"{self.path}/manifest-{known[-1] if version is None else version:012d}.json"
        return json.loads(self.spark.read.text(path, wholetext=True).first()[0])

    def read(self, version: int | None = None) -> DataFrame:
        """A version, the latest if none is named. Later writes do not change what was opened."""
        told = self.manifest(version)
        if told is None:
            raise LookupError(f"no version {version if version is not None else ''} in {self.path}")
        return self.spark.read.parquet(f"{self.path}/{told['folder']}")

    def write(self, rows: DataFrame, based_on: int | None = None, **notes) -> int:
        """A new version with these rows; its number. ``based_on``: the version that they were made from, by default the latest at the time of the call.

        Fails with ``Conflict`` if another writer has made a version since.
        """
        known = self.versions()
        before = based_on if based_on is not None else (known[-1] if known else 0)
        number, folder = before + 1, f"data-{uuid.uuid4().hex}"
        rows.write.parquet(f"{self.path}/{folder}")
        target = self._hadoop(f"{self.path}/manifest-{number:012d}.json")
        fresh = self._hadoop(f"{self.path}/.{uuid.uuid4().hex}")
        out = self._fs.create(fresh, False)
        out.write(json.dumps({"version": number, "folder": folder, **notes}).encode())
        out.close()
        if self._fs.exists(target) or not self._fs.rename(fresh, target):
            self._fs.delete(fresh, False)
            self._fs.delete(self._hadoop(f"{self.path}/{folder}"), True)
            raise Conflict(f"version {number} of {self.path} is there already")
        return number

    def upsert(self, rows: DataFrame, keys: Sequence[str]) -> int:
        """A version in which ``rows`` take the place of those with equal keys (null equals null) and join the others. Keys must be unique in ``rows``."""
        if rows.groupBy(*keys).count().where("count > 1").limit(1).count():
            raise ValueError("a key is in the new rows more than once")
        known = self.versions()
        if not known:
            return self.write(rows)
        old = self.read(known[-1])
        new = rows.select(*[F.col(k).alias(f"_{k}") for k in keys])
        kept = old.join(new, [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys], "left_anti")
        return self.write(kept.unionByName(rows), known[-1])

    def replace(self, rows: DataFrame, where: F.Column) -> int:
        """A version in which ``rows`` take the place of all rows for which ``where`` holds."""
        known = self.versions()
        if not known:
            return self.write(rows)
        return self.write(self.read(known[-1]).where(~F.coalesce(where, F.lit(False))).unionByName(rows), known[-1])

    def vacuum(self, keep: int = 2) -> None:
        """Without all versions but the last ``keep`` and without folders that no version names. Not while another writer is at work."""
        known = self.versions()
        for n in known[: max(0, len(known) - keep)]:
            self._fs.delete(self._hadoop(f"{self.path}/manifest-{n:012d}.json"), False)
        named = {self.manifest(n)["folder"] for n in self.versions()}
        for status in self._fs.listStatus(self._root):
            if status.getPath().getName().startswith("data-") and status.getPath().getName() not in named:
                self._fs.delete(status.getPath(), True)


def cached(table: VersionedTable, wanted: DataFrame, keys: Sequence[str], make) -> DataFrame:
    """``wanted`` with what is kept for its keys; ``make`` (rows without an entry to rows with results) is run for the others only, and kept.

    For profiles and excerpts that a file's digest and the parameters of the work determine.
    """
    distinct = wanted.select(*keys).distinct()
    known = table.versions()
    if known:
        missing = distinct.join(table.read(known[-1]).select(*keys), list(keys), "left_anti")
    else:
        missing = distinct
    if not known or missing.limit(1).count():
        table.upsert(make(missing), keys)
    return wanted.join(table.read(), list(keys))
