"""Periodic runs of words by an all-lag scan.

A document's words become numbers. For every lag p from 1 to n / 4 the array of numbers is
compared with itself shifted by p; a stretch of equal places, long enough, is a run of period
p, unless the p words it repeats are themselves a repetition, in which case the same run is
found at the smaller lag (a run holds four periods, so no period that does not divide p can
be smaller). So every lag stands alone, and Spark deals the work out: documents whose lags
cost more than ``work`` comparisons are cut into ranges of lags, one row a range, on any
machine; the others are scanned whole where they are read, many at once in one array.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import binary_text, byte_slices, handing_back, materialize, read_table, text_sizes

#: Periods that a run holds at least, and its words at least.
MIN_EXPONENT = 4
MIN_LENGTH = 6
#: Comparisons of one range of lags, about, and the ranges of a document at most.
WORK = 1 << 26
RANGES = 256
#: Bytes of text that are scanned together.
TOGETHER = 1 << 18

Run = tuple[int, int, int]


def word_ids(words: list[bytes]) -> np.ndarray:
    """Equal words, equal numbers, from 0 by first appearance."""
    numbers: dict[bytes, int] = defaultdict()
    numbers.default_factory = numbers.__len__
    return np.fromiter(map(numbers.__getitem__, words), np.int32, len(words))


def _primes(n: int) -> list[int]:
    """Distinct prime factors."""
    out, f = [], 2
    while f * f <= n:
        if n % f == 0:
            out.append(f)
            while n % f == 0:
                n //= f
        f += 1
    return [*out, n] if n > 1 else out


def _primitive(root: np.ndarray) -> bool:
    """Whether the words of a root are no repetition of fewer words."""
    n = len(root)
    return not any(np.array_equal(root[n // r :], root[: n - n // r]) for r in _primes(n))


def scan(documents: list[np.ndarray], low: int = 1, high: int | None = None) -> list[list[Run]]:
    """The runs (start, length, period) of each array of word numbers whose period is in ``low`` to ``high``, by start, then period."""
    found: list[list[Run]] = [[] for _ in documents]
    order = sorted((i for i, d in enumerate(documents) if len(d) >= MIN_LENGTH), key=lambda i: -len(documents[i]))
    if not order:
        return found
    sizes = [len(documents[i]) for i in order]
    ends = np.cumsum(sizes)
    begins = ends - sizes
    flat, numbers = np.empty(ends[-1], np.int32), 0
    for a, b, i in zip(begins, ends, order, strict=True):  # no number is in two documents, so no stretch crosses
        flat[a:b] = documents[i] + numbers
        numbers += int(documents[i].max()) + 1
    same, live = np.empty(len(flat), bool), len(order)
    for lag in range(low, min(sizes[0] // MIN_EXPONENT, high or sizes[0]) + 1):
        least = max(MIN_LENGTH, MIN_EXPONENT * lag)
        while sizes[live - 1] < least:
            live -= 1
        end, need = int(ends[live - 1]), least - lag
        at = np.flatnonzero(np.equal(flat[: end - lag], flat[lag:end], out=same[: end - lag]))
        if len(at) < need or not (at[need - 1 :] - at[: len(at) - need + 1] == need - 1).any():
            continue
        cuts = np.flatnonzero(np.diff(at) != 1)
        first, last = at[np.r_[0, cuts + 1]], at[np.r_[cuts, len(at) - 1]]
        long = last - first >= need - 1
        for a, b in zip(first[long].tolist(), last[long].tolist(), strict=True):
            if _primitive(flat[a : a + lag]):
                d = int(np.searchsorted(ends, a, side="right"))
                found[order[d]].append((a - int(begins[d]), b - a + 1 + lag, lag))
    for runs in found:
        runs.sort(key=lambda r: (r[0], r[2]))
    return found


def strongest(runs: list[Run]) -> Run | None:
    """The run with the greatest length / period; ties: the smallest start, then period."""
    best = None
    for run in runs:  # by start, then period
        if best is None or run[1] * best[2] > best[1] * run[2]:
            best = run
    return best


def collapsed(words: list[bytes], runs: list[Run]) -> list[bytes]:
    """The words without those that some run holds after its first period."""
    if not runs:
        return words
    keep = np.ones(len(words), bool)
    for start, length, period in runs:
        keep[start + period : start + length] = False
    return [words[i] for i in np.flatnonzero(keep).tolist()]


_RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])
SCHEMA = "doc_id long, n_words long, runs array<struct<start:long,length:long,period:long>>, strongest struct<start:long,length:long,period:long>, collapsed string"
_NAMES = ["doc_id", "n_words", "runs", "strongest", "collapsed"]


def _named(run: Run | None) -> dict[str, int] | None:
    return run and dict(zip(("start", "length", "period"), run, strict=True))


def _told(ids: pa.Array, texts: list[list[bytes]], runs: list[list[Run]]) -> pa.RecordBatch:
    columns = [
        ids,
        pa.array([len(w) for w in texts], pa.int64()),
        pa.array([[_named(r) for r in x] for x in runs], pa.list_(_RUN)),
        pa.array([_named(strongest(x)) for x in runs], _RUN),
        pa.array([b" ".join(collapsed(w, x)).decode() for w, x in zip(texts, runs, strict=True)], pa.string()),
    ]
    return pa.RecordBatch.from_arrays(columns, _NAMES)


@handing_back
def _scan_whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for a, b in byte_slices(text_sizes(batch.column(1)), TOGETHER):
            words = [t.as_py().split() for t in batch.column(1).slice(a, b - a)]
            yield _told(batch.column(0).slice(a, b - a), words, scan([word_ids(w) for w in words]))


@handing_back
def _number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for i in range(batch.num_rows):
            ids = word_ids(batch.column(2)[i].as_py().split())
            yield pa.RecordBatch.from_arrays([*(c.slice(i, 1) for c in batch.columns), pa.array([len(ids)], pa.int64()), pa.array([ids.tobytes()], pa.binary())], ["row", "doc_id", "text", "n_words", "word_ids"])


@handing_back
def _scan_range(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row, ids, low, high in zip(*batch.columns, strict=True):
            runs = scan([np.frombuffer(ids.as_py(), np.int32)], low.as_py(), high.as_py())[0]
            yield pa.RecordBatch.from_arrays([pa.array([row.as_py()], pa.int64()), pa.array([[_named(r) for r in runs]], pa.list_(_RUN))], ["row", "runs"])


@handing_back
def _finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for i in range(batch.num_rows):
            runs = [(r["start"], r["length"], r["period"]) for r in batch.column(2)[i].as_py() or ()]
            yield _told(batch.column(0).slice(i, 1), [batch.column(1)[i].as_py().split()], [runs])


def periodic_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", work: int = WORK, ranges: int = RANGES) -> DataFrame:
    """``doc_id, n_words, runs, strongest, collapsed`` for each row of ``docs``.

    ``runs`` has every maximal run by start, then period; ``strongest`` is null without runs;
    ``collapsed`` joins the kept words by one space. Null and empty texts have no words, no
    runs and an empty ``collapsed``. Repeated rows and null ids are rows like others; no
    rows give no rows; other columns are ignored.

    A text of b bytes has (b + 1) / 2 words at most. Texts that by this bound need no more
    than ``work`` comparisons are scanned whole; the others have their word numbers written
    once and are dealt out by ranges of lags, ``ranges`` of them a document at most.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), binary_text(F.col(text_col)).alias("text"))
    size = F.octet_length("text")
    bound = max(MIN_LENGTH, 2 * int((MIN_EXPONENT * work) ** 0.5))
    whole = rows.where(size <= bound).mapInArrow(_scan_whole, SCHEMA)

    long = rows.where(size > bound).select(F.monotonically_increasing_id().alias("row"), "doc_id", "text")
    long = materialize(long.mapInArrow(_number, "row long, doc_id long, text binary, n_words long, word_ids binary"), "long")
    lags = F.expr(f"n_words div {MIN_EXPONENT}")
    parts = F.greatest(F.lit(1), F.least(F.lit(ranges), F.ceil(lags * F.col("n_words") / work), lags)).cast("int")
    cut = long.select("row", "word_ids", lags.alias("lags"), parts.alias("parts")).withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    cut = cut.select("row", "word_ids", F.expr("(lags * part) div parts + 1").alias("low"), F.expr("(lags * (part + 1)) div parts").alias("high"))
    found = cut.where("high >= low").repartition("row", "low").mapInArrow(_scan_range, "row long, runs array<struct<start:long,length:long,period:long>>")
    met = found.groupBy("row").agg(F.array_sort(F.flatten(F.collect_list("runs")), lambda a, b: F.when(F.struct(a["start"], a["period"]) < F.struct(b["start"], b["period"]), -1).otherwise(1)).alias("runs"))
    done = long.select("row", "doc_id", "text").join(met, "row", "left").select("doc_id", "text", "runs").mapInArrow(_finish, SCHEMA)
    return whole.unionByName(done)


def with_planted_runs(docs: DataFrame) -> DataFrame:
    """``doc_id, text``, where every tenth document by the checksum of its id is made to repeat itself from a word on."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    h = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary"))
    drawn = rows.withColumn("h", h).withColumn("g", F.expr("h div 10"))
    words = F.when(F.col("h") % 10 == 0, F.filter(F.split("text", "[\\x20\\x09-\\x0D]+"), lambda w: w != ""))
    drawn = drawn.withColumn("words", words).withColumn("n", F.size("words"))
    drawn = drawn.withColumn("a", F.when(F.col("n") > 0, F.col("g") % F.col("n")))
    drawn = drawn.withColumn("p", F.expr("1 + (n - a) div (3 + g % 8)"))
    # Slices and repeats, no element by element: an expression that is put in place of a column is evaluated a few times a row at most.
    tail = F.expr("slice(flatten(array_repeat(slice(words, int(a + 1), int(p)), int((n - a) div p + 1))), 1, int(n - a))")
    made = F.concat(F.expr("slice(words, 1, int(a))"), tail)
    return drawn.select("doc_id", F.when(F.col("n") > 0, F.array_join(made, " ")).otherwise(F.col("text")).alias("text"))


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = periodic_runs(with_planted_runs(read_table(spark, sf_dir, "documents")))
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"].cast("string"), r["length"].cast("string"), r["period"].cast("string")), F.lit("\n")))
    return found.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        "strongest.start",
        "strongest.length",
        "strongest.period",
        F.expr("(1000 * strongest.length) div strongest.period").alias("exponent_milli"),
        F.sha2(F.array_join(lines, "").cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
    )
