"""Packing of token ids into rows of fixed length, best fit decreasing.

Every text is encoded, closed with the end token and, where longer than a row, cut into
rows and a remainder: nothing is lost. The pieces go, longest first, each into the fullest
row that still takes it. A segment tree over the free capacities finds that row in
logarithmic time. A task packs what it reads in windows of ``WINDOW`` tokens, so memory
is bounded and nothing is shuffled.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import read_table

LENGTH = 2048
WINDOW = 1 << 21
END = 50256


class Capacities:
    """Rows by free capacity; ``take(size)`` gives a row of the least capacity that is enough."""

    def __init__(self, most: int):
        self.leaves = 1 << most.bit_length()
        self.count = [0] * (2 * self.leaves)
        self.rows: list[list[int]] = [[] for _ in range(most + 1)]

    def put(self, capacity: int, row: int) -> None:
        self.rows[capacity].append(row)
        at = capacity + self.leaves
        while at:
            self.count[at] += 1
            at >>= 1

    def take(self, size: int) -> tuple[int, int] | None:
        """(capacity, row), or None."""
        at = size + self.leaves
        count = self.count
        while not count[at]:
            while at & 1:  # a right child: its range ends where its parent's does
                at >>= 1
            if not at:
                return None
            at |= 1
        while at < self.leaves:
            at = 2 * at if count[2 * at] else 2 * at + 1
        capacity = at - self.leaves
        row = self.rows[capacity].pop()
        while at:
            count[at] -= 1
            at >>= 1
        return capacity, row


def best_fit_decreasing(sizes: np.ndarray, length: int) -> list[list[int]]:
    """Rows of item numbers; every size is 1 to ``length``. Equal sizes keep their order."""
    rows: list[list[int]] = []
    free = Capacities(length)
    for item in np.argsort(-sizes, kind="stable").tolist():
        size = int(sizes[item])
        got = free.take(size) if size < length else None
        if got is None:
            capacity, row = length, len(rows)
            rows.append([])
        else:
            capacity, row = got
        rows[row].append(item)
        if capacity > size:
            free.put(capacity - size, row)
    return rows


class Tokens:
    """Token ids of texts by a rank file."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.ranks, self.pattern, self.codec = ranks, pattern, None

    def __getstate__(self) -> dict:
        return {**self.__dict__, "codec": None}

    def ids(self, text: str) -> np.ndarray:
        if self.codec is None:
            import tiktoken

            self.codec = tiktoken.Encoding("packing", pat_str=self.pattern, mergeable_ranks=self.ranks, special_tokens={})
        return self.codec.encode_to_numpy(text, disallowed_special=())


def load_tokens(path: str | None = None, pattern: str | None = None) -> Tokens:
    """From a file of ``base64 rank`` lines; by default the public byte-level vocabulary of 50,256 entries."""
    if path is None or pattern is None:
        import public_tokenizers

        path = path or public_tokenizers.path("byte_bpe_50k.tiktoken")
        pattern = pattern or public_tokenizers.PATTERN
    with open(path, "rb") as lines:
        return Tokens({base64.b64decode(t): int(rank) for t, rank in map(bytes.split, lines)}, pattern)


NAMES = ["shard", "row", "ids", "n_tokens", "cu_seqlens", "position_resets", "doc_ids", "doc_offsets"]
SCHEMA = "shard int, row long, ids binary, n_tokens int, cu_seqlens array<int>, position_resets array<int>, doc_ids array<long>, doc_offsets array<long>"


def _packed(held: list[tuple[int | None, np.ndarray]], length: int, pad: int, shard: int, first_row: int) -> pa.RecordBatch:
    pieces = [(doc, at, ids[at : at + length]) for doc, ids in held for at in range(0, len(ids), length)]
    rows = best_fit_decreasing(np.array([len(p[2]) for p in pieces], np.int64), length)
    columns: list[list] = [[] for _ in NAMES]
    for i, own in enumerate(rows):
        parts = [pieces[k] for k in own]
        ends = np.cumsum([len(p[2]) for p in parts])
        line = np.full(length, pad, "<u2")
        line[: ends[-1]] = np.concatenate([p[2] for p in parts])
        edges = [0, *ends.tolist()]
        for column, value in zip(columns, (shard, first_row + i, line.tobytes(), edges[-1], edges, edges[:-1], [p[0] for p in parts], [p[1] for p in parts]), strict=True):
            column.append(value)
    kinds = [pa.int32(), pa.int64(), pa.binary(), pa.int32(), pa.list_(pa.int32()), pa.list_(pa.int32()), pa.list_(pa.int64()), pa.list_(pa.int64())]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], NAMES)


def pack(docs: DataFrame, tokens: Tokens, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH, end: int = END, pad: int = END, window: int = WINDOW) -> DataFrame:
    """Rows of a packed id matrix, ``length`` ids each, in row order within a shard.

    ``ids`` holds little-endian unsigned 16-bit integers, padded after ``n_tokens``;
    ``cu_seqlens`` the cumulative segment lengths from 0, ``position_resets`` where
    position ids start again from 0; ``doc_ids`` and ``doc_offsets`` say of which row's
    text, from which token on, each segment is. A null or empty text is its end token.
    Repeated rows are packed as often as they occur; null ids stay null. An empty table
    gives no rows. Ids must be below 65,536.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        context = TaskContext.get()
        shard = context.partitionId() if context else 0
        held: list[tuple[int | None, np.ndarray]] = []
        size = row = 0
        for batch in batches:
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                ids = tokens.ids(text.as_py())
                line = np.empty(len(ids) + 1, "<u2")
                line[:-1], line[-1] = ids, end
                held.append((doc, line))
                size += len(line)
                if size >= window:
                    out = _packed(held, length, pad, shard, row)
                    held, size, row = [], 0, row + out.num_rows
                    yield from _small(out)
        if held:
            yield from _small(_packed(held, length, pad, shard, row))

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    return rows.mapInArrow(run, SCHEMA)


def _small(batch: pa.RecordBatch, rows: int = 512) -> Iterator[pa.RecordBatch]:
    for i in range(0, batch.num_rows, rows):
        yield batch.slice(i, rows)


def write_packed(packed: DataFrame, path: str) -> None:
    """As Parquet, one folder a shard: rows of ``ids`` end to end are the shard's matrix."""
    packed.write.partitionBy("shard").parquet(path)


def read_packed(spark: SparkSession, path: str) -> DataFrame:
    """What ``write_packed`` has written, whatever shards there are."""
    return spark.read.schema(SCHEMA).parquet(path)


def unpack(packed: DataFrame) -> DataFrame:
    """``doc_id, ids`` (binary, little-endian uint16, without the end token) of each text packed.

    Ids must be unique and not null: a text longer than a row is put together again by its id and the offsets of its pieces.
    """
    segment = F.explode(F.arrays_zip("doc_ids", "doc_offsets", F.slice("cu_seqlens", F.lit(1), F.size("doc_ids")).alias("begin"), F.slice("cu_seqlens", F.lit(2), F.size("doc_ids")).alias("stop")))
    parts = packed.select("ids", segment.alias("s"))
    piece = F.substring(F.col("ids"), F.col("s.begin") * 2 + 1, (F.col("s.stop") - F.col("s.begin")) * 2)
    parts = parts.select(F.col("s.doc_ids").alias("doc_id"), F.struct(F.col("s.doc_offsets").alias("at"), F.hex(piece).alias("piece")).alias("p"))
    whole = parts.groupBy("doc_id").agg(F.sort_array(F.collect_list("p")).alias("ps"))
    joined = F.array_join(F.transform("ps", lambda p: p["piece"]), "")
    return whole.select("doc_id", F.unhex(F.substring(joined, F.lit(1), F.length(joined) - 4)).alias("ids"))


def op10_packed_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(read_table(spark, sf_dir, "documents"), load_tokens())
