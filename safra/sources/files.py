"""Readers and writers of text, JSON, XML, CSV and their archives."""

from __future__ import annotations

import io
import json
import zipfile
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import paths as p
from .dbase import read_dbase, records, table_bytes

#: Which member of an archive is read: the highest rank, ties to the last name.
MEMBER_RANK = {".json": 5, ".xml": 4, ".csv": 3, ".dbf": 2, ".dbc": 1}


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """``value``: trimmed lines that are not blank."""
    return spark.read.text(path).select(F.trim("value").alias("value")).where("value != ''")


def read_jsonl(spark: SparkSession, path: str, schema: str | None = None) -> DataFrame:
    reader = spark.read.schema(schema) if schema else spark.read
    return reader.json(path)


def read_json_document(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.option("multiLine", True).json(path)


def read_rows(spark: SparkSession, path: str) -> DataFrame:
    """Rows of a JSON document: a list of objects, or the first list under rows, downloads, items, selected_data_files."""
    doc = read_json_document(spark, path)
    for key in ("rows", "downloads", "items", "selected_data_files"):
        if key in doc.columns and doc.schema[key].dataType.typeName() == "array":
            return doc.select(F.inline(key))
    return doc


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    """``path`` from lines of URLs or paths, or from JSON lines with ``path`` or ``url``."""
    if path.endswith(".jsonl"):
        rows = read_jsonl(spark, path)
        given = [F.nullif(F.col(c), F.lit("")) for c in ("path", "url") if c in rows.columns]
        return rows.select(p.without_host(F.coalesce(*given)).alias("path"))
    return read_lines(spark, path).select(p.without_host(F.col("value")).alias("path"))


def profile_path(row: DataFrame) -> DataFrame:
    """Adds ``input_path``: the first of local_path, path, full_path, target_path that is not blank."""
    given = [F.nullif(F.col(c), F.lit("")) for c in ("local_path", "path", "full_path", "target_path") if c in row.columns]
    return row.withColumn("input_path", F.coalesce(*given))


def _tabular(payload: object) -> list[dict]:
    """A list of objects; else the longest such list in an object; else the object as one row."""
    if isinstance(payload, list):
        return [r for r in payload if isinstance(r, dict)]
    lists = [v for v in payload.values() if isinstance(v, list) and v and all(isinstance(r, dict) for r in v)] if isinstance(payload, dict) else []
    return max(lists, key=len) if lists else [payload] if isinstance(payload, dict) else []


def _xml_rows(data: bytes) -> list[dict]:
    """The child tag that repeats most is the row; without a repeated one, the root is."""
    import xml.etree.ElementTree as tree
    from collections import Counter

    root = tree.fromstring(data)
    tags = Counter(e.tag for e in root)
    tag, n = tags.most_common(1)[0] if tags else ("", 0)
    rows = [e for e in root if e.tag == tag] if n > 1 else [root]
    return [{c.tag: (c.text or "").strip() for c in e} for e in rows]


def _rows_of(name: str, data: bytes) -> list[dict]:
    """Rows of one file by its last suffix."""
    suffix = "." + name.lower().rpartition(".")[2]
    if suffix == ".json":
        return _tabular(json.loads(data))
    if suffix == ".xml":
        return _xml_rows(data)
    if suffix == ".csv":
        import csv

        return list(csv.DictReader(io.StringIO(data.decode("utf-8", "replace"))))
    if suffix in (".dbf", ".dbc"):
        return list(records(table_bytes(name, data)))
    if suffix == ".gz":
        import gzip

        return _rows_of(name[:-3], gzip.decompress(data))
    if suffix == ".zip":
        with zipfile.ZipFile(io.BytesIO(data)) as archive:
            members = [m for m in archive.namelist() if not m.endswith("/")]
            ranked = [m for m in members if "." + m.lower().rpartition(".")[2] in MEMBER_RANK]
            if not ranked:
                return [{"ARCHIVE_MEMBER": m} for m in members]
            best = max(ranked, key=lambda m: (MEMBER_RANK["." + m.lower().rpartition(".")[2]], m))
            return _rows_of(best, archive.read(best))
    raise ValueError(f"no reader for {name}")


def read_tables(spark: SparkSession, path: str) -> DataFrame:
    """``raw_file, row_number, fields, error`` of every file under a path: JSON, XML, CSV, dBase, plain or in an archive.

    Field names are upper case. A file that cannot be read gives one row with ``error``.
    One file is read by one task, as its formats ask for; large CSV and JSON lines are
    better read by Spark's own readers.
    """
    files = spark.read.format("binaryFile").load(path).select("path", "content")
    kinds = pa.schema([("raw_file", pa.string()), ("row_number", pa.int64()), ("fields", pa.map_(pa.string(), pa.string())), ("error", pa.string())])

    def shown(value: object) -> str | None:
        return None if value is None else value if isinstance(value, str) else json.dumps(value, ensure_ascii=False)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, data in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                try:
                    found, error = _rows_of(name, data), None
                except Exception as e:  # becomes a row, like any file's
                    found, error = [], f"{type(e).__name__}: {e}"
                if error:
                    yield pa.RecordBatch.from_pylist([{"raw_file": name, "row_number": 0, "fields": None, "error": error}], schema=kinds)
                for a in range(0, len(found), 2000):
                    part = [{"raw_file": name, "row_number": a + i + 1, "fields": [(str(k).upper(), shown(v)) for k, v in r.items() if k is not None], "error": None} for i, r in enumerate(found[a : a + 2000])]
                    yield pa.RecordBatch.from_pylist(part, schema=kinds)

    return files.mapInArrow(rows, "raw_file string, row_number long, fields map<string,string>, error string")


def read_native(spark: SparkSession, path: str, limit: int | None = None) -> DataFrame:
    """Spark's own reader for a path's format; compressed text is decoded by its codec."""
    plain = path.lower().removesuffix(".gz")
    if plain.endswith(".csv"):
        df = spark.read.option("header", True).csv(path)
    elif plain.endswith((".json", ".jsonl")):
        df = read_json_document(spark, path) if plain.endswith(".json") else read_jsonl(spark, path)
    elif plain.endswith(".parquet"):
        df = spark.read.parquet(path)
    elif plain.endswith((".dbf", ".dbc")):
        df = read_dbase(spark, path)
    else:
        raise ValueError(f"no reader for {path}")
    upper = df.toDF(*[c.upper() for c in df.columns]) if not plain.endswith((".dbf", ".dbc")) else df
    return upper.limit(limit) if limit else upper


def excerpts(spark: SparkSession, path: str, most: int = 4000) -> DataFrame:
    """``path, excerpt, status`` of documents: text in UTF-8, else Latin-1; other formats are ``unsupported_format``."""
    files = spark.read.format("binaryFile").load(path)
    known = F.lower("path").rlike(r"\.(txt|md|csv|json|xml|html)$")
    utf8 = F.when(F.is_valid_utf8(F.col("content").cast("string")), F.col("content").cast("string"))
    text = F.coalesce(utf8, F.decode("content", "ISO-8859-1"))
    return files.select("path", F.when(known, F.substring(text, 1, most)).alias("excerpt"), F.when(known, "ok").otherwise("unsupported_format").alias("status"))


def write_jsonl(df: DataFrame, path: str, append: bool = False) -> None:
    df.write.mode("append" if append else "overwrite").json(path)


def write_csv(df: DataFrame, path: str) -> bool:
    """With a header; nothing is written for an empty table."""
    if df.isEmpty():
        return False
    df.write.mode("overwrite").option("header", True).csv(path)
    return True


def cached(found: DataFrame, cache: DataFrame, key: str) -> tuple[DataFrame, DataFrame]:
    """Rows answered by a keyed cache, and those still to be fetched."""
    return found.join(cache, key), found.join(cache.select(key), key, "left_anti")


def request_key(endpoint: Column, params: Column) -> Column:
    """SHA-256 of an endpoint with its parameters (a map) in order of name."""
    pairs = F.transform(F.array_sort(F.map_entries(params)), lambda e: F.concat(e["key"], F.lit("="), e["value"]))
    return F.sha2(F.concat(endpoint, F.lit("?"), F.array_join(pairs, "&")), 256)
