"""Scans as a stream: each micro-batch is a whole scan, held against the one before it."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from ..operators.corpus import snapshot_diff
from ..sources.versions import VersionedTable

WARNING = "scan found no entries"


def scan_changes(scans: DataFrame, key: str, last: VersionedTable, changes: VersionedTable) -> DataStreamWriter:
    """The writer of a stream of scans: ``scan, <key>, change`` (added, removed, common) is appended to ``changes``, the keys are kept in ``last``.

    A scan without entries, counted while it is written, adds one row with the change ``warning`` and a null key, and leaves ``last`` as
    it is, so that the next scan is held against the last real one. A batch that comes again after a failure changes nothing twice:
    ``last`` and ``changes`` record the number of the batch with the version that it made. Both are made by the batches alone.
    """

    def done(table: VersionedTable, number: int) -> bool:
        told = table.manifest()
        return told is not None and told.get("batch", -1) >= number

    def one(batch: DataFrame, number: int) -> None:
        if done(last, number):
            return
        counted = Observation(f"scan_{number}")
        kept = VersionedTable(batch.sparkSession, f"{last.path}/scan-{number}")
        rows = batch.where(F.col(key).isNotNull()).select(key).distinct().observe(counted, F.count(F.lit(1)).alias("n"))
        now = kept.read(kept.write(rows))
        empty = counted.get["n"] == 0
        before = last.read() if last.versions() else now.limit(0)
        if empty:
            told = now.sparkSession.range(1).select(F.lit(None).cast(now.schema[key].dataType).alias(key), F.lit("warning").alias("change"))
        else:
            told = snapshot_diff(before, now, key)
        told = told.select(F.lit(number).cast("long").alias("scan"), key, "change")
        if not done(changes, number):
            old = changes.read() if changes.versions() else told.limit(0)
            changes.write(old.unionByName(told), batch=number)
        last.write(before if empty else now, batch=number)

    return scans.writeStream.foreachBatch(one).outputMode("append")
