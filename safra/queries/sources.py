"""Readers, sinks and streams, over copies of the driver's tables in the shared folder."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from ..functions import paths
from ..operators.graph import cut, shared_folder
from ..sources import files
from ..sources.versions import VersionedTable, cached
from ..streaming import ingest
from .common import table


def _folder(spark):
    return f"{shared_folder(spark)}/io-{uuid.uuid4().hex}"


def stream_dedup_ingest(spark, d):
    """Events replayed twice through a stream arrive once."""
    base = _folder(spark)
    events = table(spark, d, "events").select("event_id", F.col("ts").cast("timestamp").alias("ts"), "event_type", "value")
    events.write.parquet(f"{base}/in")
    events.where("event_id % 3 = 0").write.mode("append").parquet(f"{base}/in")
    ingest.ingest(spark, f"{base}/in", f"{base}/out", f"{base}/log", "event_id long, ts timestamp, event_type string, value double", "event_id", "ts", late="60 days")
    return spark.read.parquet(f"{base}/out").groupBy("event_type").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("value"), 2).alias("value"))


def json_round_trip(spark, d):
    path = f"{_folder(spark)}/orders"
    files.write_jsonl(table(spark, d, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice"), path)
    back = files.read_jsonl(spark, path, "o_orderkey long, o_orderstatus string, o_totalprice double")
    return back.groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("o_totalprice"), 2).alias("total"))


def csv_round_trip(spark, d):
    path = f"{_folder(spark)}/parts"
    files.write_csv(table(spark, d, "part"), path)
    back = spark.read.option("header", True).csv(path)
    return back.groupBy("p_type").agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("p_size").cast("long")).alias("size"))


def manifest_lines(spark, d):
    path = f"{_folder(spark)}/lines"
    pages = table(spark, d, "pages").select(F.concat(F.lit("  "), "url", F.lit(" ")).alias("value"))
    pages.unionByName(pages.limit(3).select(F.lit("").alias("value"))).write.text(path)
    return files.read_manifest(spark, path).groupBy(F.substring_index("path", "/", 2).alias("top")).agg(F.count(F.lit(1)).alias("n"))


def request_cache(spark, d):
    """Of all orders' requests, those that a cache answers and those it does not."""
    key = files.request_key(F.lit("/values"), F.create_map(F.lit("id"), F.col("o_orderkey").cast("string"), F.lit("b"), F.lit("1")))
    asked = table(spark, d, "orders").select(key.alias("cache_key"), "o_orderkey")
    cache = asked.where("o_orderkey % 4 = 0").select("cache_key", F.lit("x").alias("payload"))
    hits, misses = files.cached(asked, cache, "cache_key")
    return hits.select(F.lit("hit").alias("state")).unionByName(misses.select(F.lit("miss").alias("state"))).groupBy("state").agg(F.count(F.lit(1)).alias("n"))


def json_rows(spark, d):
    """A JSON document that holds its rows in a list."""
    path = f"{_folder(spark)}/nations"
    nation = table(spark, d, "nation").groupBy().agg(F.collect_list(F.struct("n_nationkey", "n_name")).alias("rows"))
    files.write_jsonl(nation.select(F.lit("nations").alias("title"), "rows"), path)
    return files.read_rows(spark, path).select(F.col("n_nationkey").cast("int").alias("n_nationkey"), "n_name")


def manifest_jsonl(spark, d):
    """Manifest entries as JSON lines: some name a path, the others a URL."""
    path = f"{_folder(spark)}/manifest.jsonl"
    given = table(spark, d, "pages").select("page_id", F.when(F.col("page_id") % 2 == 0, "").otherwise(F.concat(F.lit("/p/"), F.col("page_id").cast("string"))).alias("path"), "url")
    files.write_jsonl(given, path)
    return files.read_manifest(spark, path).groupBy(F.substring_index("path", "/", 2).alias("top")).agg(F.count(F.lit(1)).alias("n"))


def profile_inputs(spark, d):
    """Where the file of each page is to be read: the first place that is given."""
    n = F.col("page_id")
    places = {"local_path": F.when(n % 4 == 0, F.concat(F.lit("/l/"), n.cast("string"))), "path": F.when(n % 4 == 1, F.concat(F.lit("/p/"), n.cast("string"))).otherwise(""), "full_path": F.when(n % 4 == 2, "/f"), "target_path": F.lit("/t")}
    return files.profile_path(table(spark, d, "pages").select("page_id").withColumns(places)).select("page_id", "input_path")


def entry_normalize(spark, d):
    """Directories with one slash where there were several, and what a name says of its entry."""
    path = F.concat(F.lit(" "), F.replace(paths.without_host(F.col("url")), F.lit("/"), F.lit("//")), F.lit("/"))
    name = F.concat(F.col("page_id").cast("string"), F.element_at(F.array(*[F.lit(e) for e in (".DBC", ".zip", "", ".exe", ".pdf")]), (F.col("page_id") % 5 + 1).cast("int")))
    return table(spark, d, "pages").select("page_id", paths.normal_directory(path).alias("directory"), paths.entry_hint(name).alias("hint"))


def excerpt_cache(spark, d):
    """The beginnings of pages by the digest of their text: half of them are asked for first, then all, and only the rest is made anew."""
    held = VersionedTable(spark, f"{_folder(spark)}/excerpts")
    page = table(spark, d, "pages").select("page_id", F.sha2("html", 256).alias("digest"), F.lit(80).alias("most"), "html")
    made = lambda missing: missing.join(page.select("digest", "html").dropDuplicates(["digest"]), "digest").select("digest", "most", F.substring("html", 1, 80).alias("excerpt"))
    cached(held, page.where("page_id % 2 = 0").select("digest", "most"), ["digest", "most"], made)
    return cached(held, page.select("page_id", "digest", "most"), ["digest", "most"], made).select("page_id", "excerpt")


def windowed_events(spark, d):
    """Events an hour and type through a stream; each batch brings the windows that it changes."""
    base = _folder(spark)
    events = table(spark, d, "events").select(F.col("ts").cast("timestamp").alias("ts"), "event_type")
    events.write.parquet(f"{base}/in")
    held = VersionedTable(spark, f"{base}/windows")
    stream = spark.readStream.schema("ts timestamp, event_type string").option("maxFilesPerTrigger", 4).parquet(f"{base}/in")
    counts = ingest.windowed_counts(stream, "ts", "event_type", late="60 days")
    counts.writeStream.outputMode("update").foreachBatch(lambda batch, _: held.upsert(cut(batch), ["start", "event_type"])).option("checkpointLocation", f"{base}/log").trigger(availableNow=True).start().awaitTermination()
    return held.read().select(F.date_format("start", "yyyy-MM-dd HH").alias("hour"), "event_type", "n")


QUERIES = {f.__name__: f for f in (stream_dedup_ingest, json_round_trip, csv_round_trip, manifest_lines, request_cache, json_rows, manifest_jsonl, profile_inputs, entry_normalize, excerpt_cache, windowed_events)}
SQL = {
    "stream_dedup_ingest": "SELECT event_type, count(*) AS n, round(sum(value), 2) AS value FROM events GROUP BY 1",
    "json_round_trip": "SELECT o_orderstatus, count(*) AS n, round(sum(o_totalprice), 2) AS total FROM orders GROUP BY 1",
    "csv_round_trip": "SELECT p_type, count(*) AS n, CAST(sum(p_size) AS BIGINT) AS size FROM part GROUP BY 1",
    "manifest_lines": "SELECT '/' || string_split(regexp_replace(url, '^[a-z]+://[^/]*', ''), '/')[2] AS top, count(*) AS n FROM pages GROUP BY 1",
    "request_cache": "SELECT CASE WHEN o_orderkey % 4 = 0 THEN 'hit' ELSE 'miss' END AS state, count(*) AS n FROM orders GROUP BY 1",
    "json_rows": "SELECT n_nationkey, n_name FROM nation",
    "manifest_jsonl": "SELECT CASE WHEN page_id % 2 = 0 THEN '/' || string_split(regexp_replace(url, '^[a-z]+://[^/]*', ''), '/')[2] ELSE '/p' END AS top, count(*) AS n FROM pages GROUP BY 1",
    "profile_inputs": "SELECT page_id, CASE page_id % 4 WHEN 0 THEN '/l/' || page_id WHEN 1 THEN '/p/' || page_id WHEN 2 THEN '/f' ELSE '/t' END AS input_path FROM pages",
    "entry_normalize": "SELECT page_id, regexp_replace(regexp_replace(url, '^[a-z]+://[^/]*', ''), '/+$', '') AS directory, CASE WHEN page_id % 5 IN (0, 1, 4) THEN 'file' END AS hint FROM pages",
    "excerpt_cache": "SELECT page_id, left(html, 80) AS excerpt FROM pages",
    "windowed_events": "SELECT strftime(ts, '%Y-%m-%d %H') AS hour, event_type, count(*) AS n FROM events GROUP BY 1, 2",
}
