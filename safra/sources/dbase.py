"""dBase tables, plain (.dbf) and compressed (.dbc), as a Spark data source.

``spark.read.format("dbase").load(path)`` gives one row per record: ``raw_file,
row_number`` (from 1) and ``fields``, a map from upper-case name to trimmed text
(null where blank). Every file is a partition, read where its task runs through
the bytes that Spark's ``binaryFile`` reader delivers (``read_dbase``), so any file
system that Spark knows will do.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

SCHEMA = "raw_file string, row_number long, fields map<string,string>"
_BATCH = 2000

# Fixed values of the compression format: run-length coded code lengths, and the length codes.
_LITERAL_LENGTHS = bytes(
    [11, 124, 8, 7, 28, 7, 188, 13, 76, 4, 10, 8, 12, 10, 12, 10, 8, 23, 8, 9, 7, 6, 7, 8, 7, 6, 55, 8, 23, 24, 12, 11, 7, 9, 11, 12, 6, 7, 22, 5, 7, 24, 6, 11, 9, 6, 7, 22, 7, 11, 38, 7, 9, 8, 25, 11, 8, 11, 9, 12, 8, 12, 5, 38, 5, 38, 5, 11, 7, 5, 6, 21, 6, 10, 53, 8, 7, 24, 10, 27, 44, 253, 253, 253, 252, 252, 252, 13, 12, 45, 12, 45, 12, 61, 12, 45, 44, 173]
)
_LENGTH_LENGTHS = bytes([2, 35, 36, 53, 38, 23])
_DISTANCE_LENGTHS = bytes([2, 20, 53, 230, 247, 151, 248])
_LENGTH_BASE = [3, 2, 4, 5, 6, 7, 8, 9, 10, 12, 16, 24, 40, 72, 136, 264]
_LENGTH_EXTRA = [0, 0, 0, 0, 0, 0, 0, 0, 1, 2, 3, 4, 5, 6, 7, 8]


def _code(packed: bytes) -> dict[tuple[int, int], int]:
    """(bits, code) to symbol of a canonical Huffman code whose codes are stored inverted."""
    lengths = [p & 15 for p in packed for _ in range((p >> 4) + 1)]
    out, code = {}, 0
    for size in range(1, max(lengths) + 1):
        for symbol, own in enumerate(lengths):
            if own == size:
                out[size, code ^ ((1 << size) - 1)] = symbol
                code += 1
        code <<= 1
    return out


def explode(data: bytes) -> bytes:
    """Decompress an imploded stream (literals, and copies of earlier output)."""
    coded, window = data[0], data[1]
    literal, length, distance = _code(_LITERAL_LENGTHS), _code(_LENGTH_LENGTHS), _code(_DISTANCE_LENGTHS)
    bits = int.from_bytes(data[2:4098], "little")
    loaded, held = 4098, 8 * len(data[2:4098])
    out = bytearray()

    def take(n: int) -> int:
        nonlocal bits, held, loaded
        if held < n or held < 64:
            more = data[loaded : loaded + 4096]
            bits |= int.from_bytes(more, "little") << held
            held += 8 * len(more)
            loaded += 4096
        if held < n:
            raise ValueError("compressed data ends early")
        value = bits & ((1 << n) - 1)
        bits >>= n
        held -= n
        return value

    def symbol(code: dict[tuple[int, int], int]) -> int:
        value = 0
        for size in range(1, 14):
            value = value << 1 | take(1)
            if (found := code.get((size, value))) is not None:
                return found
        raise ValueError("unknown code")

    while True:
        if not take(1):
            out.append(symbol(literal) if coded else take(8))
            continue
        k = symbol(length)
        size = _LENGTH_BASE[k] + take(_LENGTH_EXTRA[k])
        if size == 519:
            return bytes(out)
        low = 2 if size == 2 else window
        back = (symbol(distance) << low) + take(low) + 1
        if back > len(out):
            raise ValueError("copy from before the start")
        for _ in range(size):
            out.append(out[-back])


def table_bytes(name: str, data: bytes) -> bytes:
    """A .dbc file as the .dbf that it holds; a .dbf as it is."""
    if not name.lower().endswith(".dbc"):
        return data
    header = int.from_bytes(data[8:10], "little")
    return data[:header] + explode(data[header + 4 :])


@dataclass(frozen=True)
class Layout:
    records: int
    start: int
    size: int
    fields: tuple[tuple[str, str, int, int], ...]  # name, kind, offset, length


def layout(data: bytes) -> Layout:
    fields, at, offset = [], 32, 1
    while at + 32 <= len(data) and data[at] != 0x0D:
        name = data[at : at + 11].split(b"\0")[0].decode("latin-1").strip().upper()
        fields.append((name, chr(data[at + 11]), offset, data[at + 16]))
        offset += data[at + 16]
        at += 32
    return Layout(int.from_bytes(data[4:8], "little"), int.from_bytes(data[8:10], "little"), int.from_bytes(data[10:12], "little"), tuple(fields))


def records(data: bytes, encoding: str = "latin-1") -> Iterator[dict[str, str | None]]:
    """Records that are not marked deleted; bytes that the encoding lacks are dropped."""
    own = layout(data)
    for i in range(own.records):
        row = data[own.start + i * own.size : own.start + (i + 1) * own.size]
        if len(row) == own.size and row[:1] != b"*":
            yield {name: row[at : at + n].decode(encoding, "ignore").strip("\0 ") or None for name, _, at, n in own.fields}


def read_dbase(spark: SparkSession, path: str, encoding: str = "latin-1") -> DataFrame:
    """All tables under a path or glob."""
    files = spark.read.format("binaryFile").load(path).where(F.lower("path").rlike(r"\.db[cf]$")).select("path", "content")

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = [pa.string(), pa.int64(), pa.map_(pa.string(), pa.string())]
        for batch in batches:
            for name, data in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                held: list[tuple] = []
                for number, row in enumerate(records(table_bytes(name, data), encoding), 1):
                    held.append((name, number, list(row.items())))
                    if len(held) == _BATCH:
                        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*held, strict=True), kinds, strict=True)], ["raw_file", "row_number", "fields"])
                        held = []
                if held:
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*held, strict=True), kinds, strict=True)], ["raw_file", "row_number", "fields"])

    return files.mapInArrow(rows, SCHEMA)


def read_layouts(spark: SparkSession, path: str) -> DataFrame:
    """``raw_file, records, name, kind, length, position`` of every field, from the headers."""
    files = spark.read.format("binaryFile").load(path).where(F.lower("path").rlike(r"\.db[cf]$")).select("path", "content")

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = [(name, own.records, f[0], f[1], f[3], i) for name, data in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True) for own in [layout(data)] for i, f in enumerate(own.fields)]
            yield pa.RecordBatch.from_pylist([dict(zip(("raw_file", "records", "name", "kind", "length", "position"), r, strict=True)) for r in out], schema=pa.schema([("raw_file", pa.string()), ("records", pa.int64()), ("name", pa.string()), ("kind", pa.string()), ("length", pa.int32()), ("position", pa.int32())]))

    return files.mapInArrow(rows, "raw_file string, records long, name string, kind string, length int, position int")


@dataclass
class _File(InputPartition):
    path: str


class _Reader(DataSourceReader):
    def __init__(self, options: dict):
        self.paths, self.encoding, self.most = options["path"].split(","), options.get("encoding", "latin-1"), int(options.get("sample_rows", 0))

    def partitions(self) -> list[InputPartition]:
        return [_File(p) for p in self.paths]

    def read(self, partition: InputPartition) -> Iterator[tuple]:
        with open(partition.path, "rb") as f:
            data = table_bytes(partition.path, f.read())
        for number, row in enumerate(records(data, self.encoding), 1):
            if self.most and number > self.most:
                return
            yield partition.path, number, row


class DBase(DataSource):
    """For files that every executor can open; option ``sample_rows`` stops early. Register with ``spark.dataSource.register(DBase)``."""

    @classmethod
    def name(cls) -> str:
        return "dbase"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> DataSourceReader:
        return _Reader(dict(self.options))
