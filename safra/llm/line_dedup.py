"""Reversible line deduplication: sharded cuckoo filters before exact reference counts.

The index of the lines of a corpus is a set of written tables:

* ``postings``: each (digest of a key, document) once;
* ``base``: ``digest, refs, keeper`` as each key was first seen: how many documents hold it, and the smallest;
* ``deltas``: what later insertions add to keys that a filter already knows;
* ``filters``: one cuckoo filter a shard, over the digests of all keys of that shard.

An insertion counts its own keys (partial sums, so a line in a third of all documents is a
few rows a task), then each shard's filter tells the new keys, which are written without
another look, from those perhaps known, which become deltas. Only the latter meet the exact
table again: the unique lines, most of any corpus, are never merged. A false positive is a
delta without a base row, and counts exactly.

A deletion takes a document's references back: keys that no document holds any more leave
their filter, a key whose keeper goes gets the next smallest document. After it the index
is that of the remaining documents.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import ascii_lower, binary_text, byte_slices, handing_back, materialize, read_table, text_sizes

#: What is stripped at both ends of a line.
BLANK = "\x20\x09\x0a\x0b\x0c\x0d"
#: Code points of a key that counts.
LEAST = 10
#: Keys of a shard, about.
SHARD_KEYS = 1 << 16
#: Insertions in which a whole table is taken in.
ROUNDS = 2

# ---------------------------------------------------------------- cuckoo filters

SLOTS = 4
LOAD = 0.8
KICKS = 200


def _marks(digests: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Fingerprint (never 0) and place of each digest, from separate bytes of it."""
    parts = np.ascontiguousarray(digests)
    return np.maximum(parts[:, :2].copy().view("<u2").ravel(), 1), parts[:, 8:16].copy().view("<u8").ravel()


def _flip(marks: np.ndarray, buckets: int) -> np.ndarray:
    """What takes a bucket to the other one of the same fingerprint, and back."""
    return (marks.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(29)) & np.uint64(buckets - 1)


def _fill(table: np.ndarray, marks: np.ndarray, buckets: np.ndarray) -> np.ndarray:
    """Put marks into free slots of their buckets; the places of those that did not fit."""
    order = np.argsort(buckets, kind="stable")
    b = buckets[order].astype(np.int64)
    first = np.r_[True, b[1:] != b[:-1]]
    rank = np.arange(len(b)) - np.flatnonzero(first)[np.cumsum(first) - 1]
    free = table[b] == 0
    at = free & (np.cumsum(free, axis=1) == rank[:, None] + 1)
    fits = at.any(axis=1)
    table[b[fits], at.argmax(axis=1)[fits]] = marks[order[fits]]
    return order[~fits]


class CuckooFilter:
    """Fingerprints of 16 bits in buckets of four; each digest has two buckets. It never denies a digest that was added and not removed.

    When a table is full a larger one follows it. Fingerprints without a place after
    ``KICKS`` rounds of moves go to the table's stash.
    """

    def __init__(self, tables: list[tuple[np.ndarray, np.ndarray]] | None = None):
        self.tables = tables or []

    @classmethod
    def load(cls, data: bytes | None) -> CuckooFilter:
        tables, at = [], 0
        while data and at < len(data):
            buckets, stashed = np.frombuffer(data, "<u8", 2, at).tolist()
            slots = np.frombuffer(data, "<u2", buckets * SLOTS, at + 16).reshape(-1, SLOTS).copy()
            at += 16 + slots.nbytes
            tables.append((slots, np.frombuffer(data, "<u8", stashed, at).copy()))
            at += 8 * stashed
        return cls(tables)

    def dump(self) -> bytes:
        return b"".join(np.array([len(slots), len(stash)], "<u8").tobytes() + slots.tobytes() + stash.tobytes() for slots, stash in self.tables)

    @staticmethod
    def _codes(marks: np.ndarray, one: np.ndarray, other: np.ndarray) -> np.ndarray:
        return np.minimum(one, other) << np.uint64(16) | marks.astype(np.uint64)

    def contains(self, digests: np.ndarray) -> np.ndarray:
        marks, places = _marks(digests)
        found = np.zeros(len(marks), bool)
        for slots, stash in self.tables:
            one = places & np.uint64(len(slots) - 1)
            other = one ^ _flip(marks, len(slots))
            for b in (one, other):
                found |= (slots[b.astype(np.int64)] == marks[:, None]).any(axis=1)
            if len(stash):
                found |= np.isin(self._codes(marks, one, other), stash)
        return found

    def add(self, digests: np.ndarray) -> None:
        """Digests that are not in the filter yet, each once."""
        marks, places = _marks(digests)
        while len(marks):
            slots = self.tables[-1][0] if self.tables else np.zeros((0, SLOTS), np.uint16)
            room = int(LOAD * slots.size) - np.count_nonzero(slots)
            if room <= 0:
                wanted = max(len(marks) / (LOAD * SLOTS), 2 * len(slots), 16)
                slots = np.zeros((1 << math.ceil(math.log2(wanted)), SLOTS), np.uint16)
                self.tables.append((slots, np.zeros(0, np.uint64)))
                room = int(LOAD * slots.size)
            self._settle(marks[:room], places[:room] & np.uint64(len(slots) - 1))
            marks, places = marks[room:], places[room:]

    def _settle(self, marks: np.ndarray, buckets: np.ndarray) -> None:
        slots, stash = self.tables[-1]
        marks, buckets, turn = marks.copy(), buckets.copy(), np.random.default_rng(len(slots))
        for _ in range(KICKS):
            left = _fill(slots, marks, buckets)
            marks, buckets = marks[left], buckets[left]
            buckets ^= _flip(marks, len(slots))
            left = _fill(slots, marks, buckets)
            marks, buckets = marks[left], buckets[left]
            if not len(marks):
                return
            _, one = np.unique(buckets, return_index=True)
            at, slot = buckets[one].astype(np.int64), turn.integers(SLOTS, size=len(one))
            moved = slots[at, slot].copy()
            slots[at, slot] = marks[one]
            marks[one] = moved
            buckets[one] ^= _flip(moved, len(slots))
        self.tables[-1] = slots, np.concatenate([stash, self._codes(marks, buckets, buckets ^ _flip(marks, len(slots)))])

    def remove(self, digests: np.ndarray) -> None:
        """Digests that were added; each takes one fingerprint with it."""
        marks, places = _marks(digests)
        for t in range(len(self.tables) - 1, -1, -1):
            slots, stash = self.tables[t]
            for side in (0, 1):
                while len(marks):
                    b = places & np.uint64(len(slots) - 1)
                    b = (b ^ _flip(marks, len(slots)) if side else b).astype(np.int64)
                    same = slots[b] == marks[:, None]
                    hit = np.flatnonzero(same.any(axis=1))
                    if not len(hit):
                        break
                    at, first = np.unique(b[hit] * SLOTS + same[hit].argmax(axis=1), return_index=True)
                    slots.reshape(-1)[at] = 0
                    rest = np.ones(len(marks), bool)
                    rest[hit[first]] = False
                    marks, places = marks[rest], places[rest]
            if len(stash) and len(marks):
                one = places & np.uint64(len(slots) - 1)
                codes, rest, held = self._codes(marks, one, one ^ _flip(marks, len(slots))), np.ones(len(marks), bool), stash.tolist()
                for i, code in enumerate(codes.tolist()):
                    if code in held:
                        held.remove(code)
                        rest[i] = False
                self.tables[t] = slots, np.array(held, np.uint64)
                marks, places = marks[rest], places[rest]


def _digests(column: pa.ChunkedArray) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint8).reshape(-1, 32)


# ---------------------------------------------------------------- the index

_KEYS = "shard int, digest binary, refs long, keeper long"
_SIGHTED = _KEYS + ", known boolean, filter binary"


def _sight(keys: pa.Table, held: pa.Table) -> pa.Table:
    """A shard's new keys against its filter: the keys, told known or new, and the filter with the new ones."""
    data = held["filter"].to_pylist() if held.num_rows else [None]
    sieve = CuckooFilter.load(data[0])
    digests = _digests(keys["digest"])
    known = sieve.contains(digests)
    sieve.add(digests[~known])
    shard = (keys if keys.num_rows else held)["shard"][0].as_py()
    n = keys.num_rows
    columns = [
        pa.array([shard] * (n + 1), pa.int32()),
        pa.array([*keys["digest"].to_pylist(), None], pa.binary()),
        pa.array([*keys["refs"].to_pylist(), None], pa.int64()),
        pa.array([*keys["keeper"].to_pylist(), None], pa.int64()),
        pa.array([*known.tolist(), None], pa.bool_()),
        pa.array([None] * n + [sieve.dump()], pa.binary()),
    ]
    return pa.Table.from_arrays(columns, ["shard", "digest", "refs", "keeper", "known", "filter"])


def _forget(keys: pa.Table, held: pa.Table) -> pa.Table:
    """A shard's filter without the keys."""
    sieve = CuckooFilter.load(held["filter"][0].as_py())
    if keys.num_rows:
        sieve.remove(_digests(keys["digest"]))
    return pa.table({"shard": held["shard"].slice(0, 1), "filter": pa.array([sieve.dump()], pa.binary())})


def line_postings(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: int = LEAST) -> DataFrame:
    """``digest, doc_id``: the SHA-256 of each key of ``least`` code points or more, once a document."""
    lines = F.explode(F.split(ascii_lower(F.coalesce(F.col(text_col), F.lit(""))), "\n"))
    key = docs.select(F.col(id_col).cast("long").alias("doc_id"), lines.alias("line"))
    key = key.select("doc_id", F.btrim("line", F.lit(BLANK)).alias("key")).where(F.length("key") >= least)
    return key.select(F.unhex(F.sha2(F.col("key").cast("binary"), 256)).alias("digest"), "doc_id").distinct()


@dataclass(frozen=True)
class LineIndex:
    """The index as it stands; every change gives another one and leaves this one readable. Documents are told apart by id; null is an id, the largest."""

    shards: int
    postings: DataFrame
    base: DataFrame
    deltas: DataFrame
    filters: DataFrame

    @classmethod
    def empty(cls, spark: SparkSession, keys: int = SHARD_KEYS, shard_keys: int = SHARD_KEYS) -> LineIndex:
        """Made for about so many keys; more make the shards larger, not wrong."""
        none = [spark.createDataFrame([], s) for s in ("digest binary, doc_id long", _KEYS, _KEYS, "shard int, filter binary")]
        return cls(max(1, -(-keys // shard_keys)), *none)

    def _shard(self) -> F.Column:
        return F.pmod(F.xxhash64("digest"), F.lit(self.shards)).cast("int").alias("shard")

    def insert(self, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: int = LEAST) -> LineIndex:
        """With the lines of ``docs`` taken in. Documents whose id the index has already are left out."""
        new = line_postings(docs, id_col, text_col, least)
        there = self.postings.select(F.col("doc_id").alias("_there")).distinct()
        return self.insert_postings(materialize(new.join(there, F.col("doc_id").eqNullSafe(F.col("_there")), "left_anti"), "postings"))

    def insert_postings(self, new: DataFrame) -> LineIndex:
        """``new``: postings of documents that are not in the index."""
        counted = new.groupBy("digest").agg(F.count(F.lit(1)).alias("refs"), F.min("doc_id").alias("keeper"))
        keys = counted.select(self._shard(), "digest", "refs", "keeper")
        sighted = materialize(keys.groupBy("shard").cogroup(self.filters.groupBy("shard")).applyInArrow(_sight, _SIGHTED), "sighted")
        columns = ["shard", "digest", "refs", "keeper"]
        return LineIndex(
            self.shards,
            self.postings.unionByName(new.select("digest", "doc_id")),
            self.base.unionByName(sighted.where("known = false").select(columns)),
            self.deltas.unionByName(sighted.where("known").select(columns)),
            sighted.where("filter is not null").select("shard", "filter"),
        )

    def counts(self, least: int = 1) -> DataFrame:
        """``digest, refs, keeper`` of every key that ``least`` documents hold. Only keys with deltas are merged."""
        later = self.deltas.groupBy("digest").agg(F.sum("refs").alias("refs"), F.min("keeper").alias("keeper"))
        later = later.select("digest", F.struct("refs", "keeper").alias("more"))
        met = self.base.join(later, "digest", "left")
        both = met.select("digest", (F.col("refs") + F.coalesce("more.refs", F.lit(0))).alias("refs"), F.least("keeper", "more.keeper").alias("keeper"))
        alone = later.join(self.base.select("digest"), "digest", "left_anti").select("digest", "more.refs", "more.keeper")
        return both.unionByName(alone).where(F.col("refs") >= least)

    def delete(self, ids: DataFrame) -> LineIndex:
        """Without the documents whose ids are in the first column of ``ids``; ids that the index does not have change nothing."""
        gone = ids.select(F.col(ids.columns[0]).cast("long").alias("_gone")).distinct()
        named = F.col("doc_id").eqNullSafe(F.col("_gone"))
        taken = self.postings.join(gone, named, "left_semi").groupBy("digest").agg(F.count(F.lit(1)).alias("taken"))
        taken = materialize(taken, "taken")
        postings = materialize(self.postings.join(gone, named, "left_anti"), "postings")
        least = postings.join(taken, "digest", "left_semi").groupBy("digest").agg(F.min("doc_id").alias("keeper"), F.count(F.lit(1)).alias("refs"))
        kept = self.counts().join(taken, "digest", "left_anti").select(self._shard(), "digest", "refs", "keeper")
        base = materialize(kept.unionByName(least.select(self._shard(), "digest", "refs", "keeper")), "base")
        over = taken.join(base, "digest", "left_anti").select(self._shard(), "digest")
        filters = materialize(over.groupBy("shard").cogroup(self.filters.groupBy("shard")).applyInArrow(_forget, "shard int, filter binary"), "filters")
        return LineIndex(self.shards, postings, base, self.deltas.limit(0), filters)

    def dropped(self) -> DataFrame:
        """``doc_id, digests``: the keys that each document loses, for documents that lose any."""
        shared = materialize(self.counts(2).select("digest", "keeper"), "shared")
        met = self.postings.join(shared, "digest").where(~F.col("doc_id").eqNullSafe(F.col("keeper")))
        return met.groupBy("doc_id").agg(F.collect_list("digest").alias("digests"))


def build(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: int = LEAST, rounds: int = ROUNDS, shard_keys: int = SHARD_KEYS) -> LineIndex:
    """The index of ``docs``, taken in by ``rounds`` insertions so that each is bounded by a part of the corpus."""
    postings = line_postings(docs, id_col, text_col, least)
    postings = materialize(postings.withColumn("round", F.pmod(F.xxhash64("doc_id"), F.lit(rounds))), "postings")
    index = LineIndex.empty(docs.sparkSession, postings.count(), shard_keys)
    for k in range(rounds):
        index = index.insert_postings(postings.where(F.col("round") == k))
    return index


def _kept_lines(text: bytes, digests: set[bytes]) -> tuple[int, list[bytes]]:
    lines = text.split(b"\n")
    if not digests:
        return len(lines), lines
    strip = BLANK.encode()
    return len(lines), [x for x in lines if hashlib.sha256(x.strip(strip).lower()).digest() not in digests]


@handing_back
def _rewrite(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for a, b in byte_slices(text_sizes(batch.column(1)), 1 << 22):
            part = batch.slice(a, b - a)
            total, lost, kept = [], [], []
            for text, digests in zip(part.column(1), part.column(2), strict=True):
                n, lines = _kept_lines(text.as_py(), set(digests.as_py() or ()))
                total.append(n), lost.append(n - len(lines)), kept.append(b"\n".join(lines).decode())
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(total, pa.int64()), pa.array(lost, pa.int64()), pa.array(kept, pa.string())], ["doc_id", "n_lines", "n_dropped", "kept"])


def deduplicate_lines(docs: DataFrame, index: LineIndex, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_lines, n_dropped, kept`` for each row of ``docs``, whose documents ``index`` holds.

    A key that two documents hold or more loses its lines everywhere but in the smallest
    id that holds it, where all its lines stay. Null and empty texts are one empty line.
    Rows that share an id are one document and keep the same keys; a null id is an id of
    its own, larger than all others. Lines are split at ``\\n`` only; a document all of whose
    lines go keeps the empty text. No rows give no rows; other columns are ignored.
    """
    lost = index.dropped().withColumnRenamed("doc_id", "_id")
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), binary_text(F.col(text_col)).alias("text"))
    met = rows.join(lost, F.col("doc_id").eqNullSafe(F.col("_id")), "left").select("doc_id", "text", "digests")
    return met.mapInArrow(_rewrite, "doc_id long, n_lines long, n_dropped long, kept string")


def op11_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    found = deduplicate_lines(docs, build(docs))
    return found.select("doc_id", "n_lines", "n_dropped", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))


OP11_SQL = """
WITH u AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line, generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS i FROM documents
), l AS (
  SELECT doc_id, i, line, trim(translate(line, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS k FROM u
), shared AS (
  SELECT k, min(doc_id) AS keeper FROM l WHERE length(k) >= 10 GROUP BY k HAVING count(DISTINCT doc_id) >= 2
), m AS (
  SELECT l.doc_id, i, line, keeper IS NOT NULL AND keeper <> l.doc_id AS lost FROM l LEFT JOIN shared USING (k)
)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE lost) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (WHERE NOT lost), '')) AS kept_sha256
FROM m GROUP BY doc_id
"""
