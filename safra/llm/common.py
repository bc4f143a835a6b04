"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import atexit
import ctypes
import functools
import tempfile
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

ASCII_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"

_own_dirs: dict[str, str] = {}
_written: list[tuple[SparkSession, str]] = []


def shared_dir(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``. Where that is unset, a temporary one if Spark runs in one process, else an error."""
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    master, app = spark.sparkContext.master, spark.sparkContext.applicationId
    if master != "local" and not master.startswith("local["):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    if app not in _own_dirs:
        _own_dirs[app] = tempfile.mkdtemp(prefix="safra-")
    return _own_dirs[app]


def materialize(df: DataFrame, tag: str) -> DataFrame:
    """Write ``df`` to the shared folder once and read it back, cutting its lineage.

    Unlike ``checkpoint()`` the plan runs once, and the columns stay prunable.
    The files survive the loss of any executor; ``release`` removes them.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/safra-{tag}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    _written.append((spark, path))
    held = spark.read.schema(df.schema).parquet(path)
    held.written_at = path
    return held


def _delete(spark: SparkSession, path: str) -> None:
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(hadoop, True)


def discard(df: DataFrame) -> None:
    """Delete what ``materialize`` has written for ``df``, once nothing reads it any more."""
    path = df.written_at
    _written[:] = [x for x in _written if x[1] != path]
    _delete(df.sparkSession, path)


def release(since: int = 0) -> None:
    """Delete what ``materialize`` has written, but for the first ``since``; results that still read it become invalid."""
    while len(_written) > since:
        spark, path = _written.pop()
        try:
            _delete(spark, path)
        except Exception:  # the JVM has gone
            return


atexit.register(release)


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z only."""
    return F.translate(text, ASCII_UPPER, ASCII_UPPER.lower())


def crc_mod(doc_id: Column, m: int) -> Column:
    """crc32(doc_id as text) mod m; a null id counts as the empty text."""
    return F.pmod(F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")), F.lit(m))


def binary_text(text: Column) -> Column:
    """UTF-8 bytes of a text; null counts as empty."""
    return F.coalesce(text, F.lit("")).cast("binary")


def flat_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a binary Arrow column end to end (no copy), and the n+1 offsets."""
    if pa.types.is_large_binary(column.type):
        kind = np.int64
    else:
        kind = np.int32
    _, offsets, data = column.buffers()
    n = len(column)
    if n == 0 or offsets is None:
        return np.zeros(0, np.uint8), np.zeros(n + 1, np.int64)
    off = np.frombuffer(offsets, kind)[column.offset : column.offset + n + 1].astype(np.int64)
    flat = np.frombuffer(data, np.uint8)[off[0] : off[-1]] if data is not None else np.zeros(0, np.uint8)
    return flat, off - off[0]


Batches = Iterator[pa.RecordBatch]


def handing_back(work: Callable[[Batches], Batches]) -> Callable[[Batches], Batches]:
    """For the function of ``mapInArrow``: when a task ends, its worker gives freed memory back to the system.

    A worker waits for its next task beside an executor that may need the room meanwhile.
    """

    @functools.wraps(work)
    def run(batches: Batches) -> Batches:
        try:
            yield from work(batches)
        finally:
            pa.default_memory_pool().release_unused()
            trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
            if trim is not None:
                trim(0)

    return run


def text_sizes(column: pa.Array) -> np.ndarray:
    """Bytes of each text of an Arrow column; null: 0."""
    return pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False)


def byte_slices(sizes: np.ndarray, most: int) -> list[tuple[int, int]]:
    """Runs of consecutive items of about ``most`` bytes, one item at least."""
    out, start, held = [], 0, 0
    for i, size in enumerate(sizes.tolist()):
        if i > start and held + size > most:
            out.append((start, i))
            start, held = i, 0
        held += size
    if start < len(sizes):
        out.append((start, len(sizes)))
    return out
