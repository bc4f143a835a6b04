"""Dataset families over a synthetic corpus of files."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import periods as t
from ..functions.paths import UF
from ..functions.text import tokens
from ..operators import corpus as c
from ..operators import docs as docs_
from ..operators.graph import cut
from .common import MANIFEST_SQL, UF_LIST, manifest, table


def _files(spark, d):
    """The inventory, written once: most operators read it several times."""
    return cut(c.inventory(manifest(spark, d)))


def filename_grammar(spark, d):
    return _files(spark, d).select("path", "pattern_name", "series_prefix", "geo_code", "date_code", "extension", "primary_extension", "format_family", "system_guess", "path_type")


def discard_reasons(spark, d):
    shaped = _files(spark, d).withColumns(
        {
            "series_prefix": F.when(F.col("geo_code") != "SP", F.col("series_prefix")),
            "format_family": F.when(F.col("geo_code") == "RJ", "unknown").otherwise(F.col("format_family")),
            "path_type": F.when(F.col("geo_code") == "BR", "Auxiliary").otherwise(F.col("path_type")),
        }
    )
    return c.with_discard_reason(shaped).groupBy("discard_reason").agg(F.count(F.lit(1)).alias("n"))


def date_format_infer(spark, d):
    return _files(spark, d).groupBy("series_prefix").agg(t.date_format(F.col("date_code")).alias("date_format"), F.count(F.lit(1)).alias("n"))


def normalized_periods(spark, d):
    rows = c.dated(_files(spark, d), ["series_prefix"])
    return rows.select("path", "period", t.display(F.col("period")).alias("shown"))


def partition_classify(spark, d):
    return _files(spark, d).groupBy("series_prefix", "directory").agg(F.sort_array(F.collect_set("geo_code")).alias("geo")).select("series_prefix", "directory", F.size("geo").alias("places"), c.partition_type(F.col("geo")).alias("partition_type"))


def series_catalog(spark, d):
    s = c.series_catalog(_files(spark, d))
    meanings = F.array_join(F.transform(F.map_entries("path_semantics"), lambda e: F.concat(e["key"], F.lit("="), e["value"])), ";")
    return s.select("series_id", "partition_type", "date_format", "first_period", "last_period", "time_range_display", F.array_join("geo_coverage", ",").alias("geo_coverage"), "file_count", F.array_join("source_paths", ",").alias("source_paths"), meanings.alias("path_semantics"), F.array_join("file_samples", ",").alias("file_samples"))


def physical_groups(spark, d):
    return c.physical_groups(_files(spark, d)).select("system_guess", "series_prefix", "partition_type", "date_format", "time_min", "time_max", "file_count", F.array_join("format_families", ",").alias("format_families"))


def dataset_families(spark, d):
    return c.families(_files(spark, d)).select("family_id", "series_prefix", "system_guess", "partition_type", "date_format", "time_range_display", "file_count", F.size("physical_variants").alias("variants"))


def _activity(spark, d):
    """Orders per nation and month as dated rows."""
    orders = table(spark, d, "orders").select("o_orderkey", "o_custkey", "o_orderdate", "o_orderpriority", "o_totalprice")
    customer = table(spark, d, "customer").select("c_custkey", "c_nationkey", "c_mktsegment")
    period = (F.year("o_orderdate") * 100 + F.month("o_orderdate")).cast("long")
    return orders.join(customer, F.col("o_custkey") == F.col("c_custkey")).withColumns({"period": period, "date_format": F.lit("YYMM")})


def _months(spark, d):
    """The months in which each customer orders."""
    return _activity(spark, d).select("o_custkey", "period", "date_format").distinct()


def family_clusters(spark, d):
    """A nation's orders of a segment chain into spells: one to three months each, longer while they overlap or touch."""
    rows = _activity(spark, d).withColumn("lo", t.ordinal(F.col("period"), F.col("date_format")))
    spans = rows.select("c_mktsegment", "c_nationkey", F.col("o_orderkey").alias("node"), "lo", (F.col("lo") + F.col("o_orderkey") % 3).alias("hi"))
    return c.interval_clusters(spans, ["c_mktsegment", "c_nationkey"], "node")


def family_rank_ids(spark, d):
    rows = _activity(spark, d).groupBy("c_mktsegment", "c_nationkey").agg(F.min("period").alias("time_min"), F.count(F.lit(1)).alias("file_count"))
    return c.family_ids(rows, "c_mktsegment", [F.col("time_min"), F.desc("file_count"), F.col("c_nationkey")]).select("family_id", "c_nationkey", "time_min", "file_count")


def _semantic(spark, d):
    return c.with_path_semantic(cut(c.dated(_files(spark, d), ["series_prefix"])), ["series_prefix"])


def preferred_series(spark, d):
    return c.preferred_files(_semantic(spark, d), ["series_prefix"]).select("series_prefix", "period", "path")


def series_segments(spark, d):
    chosen = c.preferred_files(_semantic(spark, d), ["series_prefix"])
    return c.segments(chosen, ["series_prefix"]).select("series_prefix", "segment", "primary_extension", "format_family", "system_guess", "path_semantic", "first_period", "last_period", "files", F.array_join("source_paths", ",").alias("source_paths"), "time_range_display")


def _series(spark, d):
    return c.working_series(_semantic(spark, d), ["series_prefix"])


def preferred_working_series(spark, d):
    joined = lambda k: F.array_join(k, ",").alias(k)
    return _series(spark, d).select("series_prefix", "strategy", "coverage_complete", joined("coverage_gaps"), "selected_file_count", joined("selected_files"), joined("selected_primary_extensions"), joined("selected_format_families"), "segment_count")


def family_summary(spark, d):
    files = _files(spark, d)
    shaped = files.withColumn("path_type", F.when(F.col("geo_code") == "AC", "Auxiliary").otherwise(F.col("path_type")))
    found = c.families(files).select("family_id", "series_prefix", "partition_type", "date_format", "source_systems")
    rows = found.join(_series(spark, d), "series_prefix").withColumns({"gap_count": F.size("coverage_gaps"), "doc_count": F.length("family_id") % 2})
    return c.summary(shaped, rows)


def coverage_gaps(spark, d):
    return c.missing_periods(_months(spark, d), ["o_custkey"])


def compress_ranges(spark, d):
    return c.ranges(c.missing_periods(_months(spark, d), ["o_custkey"]), ["o_custkey"], F.lit("YYMM"))


def state_panel(spark, d):
    panel = c.state_panel(c.dated(_files(spark, d), ["series_prefix"]), ["series_prefix"])
    return panel.select("series_prefix", "period", F.size("present").alias("present"), F.array_join("missing", ",").alias("missing"), F.round("coverage", 9).alias("coverage"))


def multi_grammar_parse(spark, d):
    stems = manifest(spark, d).select(F.regexp_extract("path", r"([^/.]+)\.[^/]*$", 1).alias("stem")).distinct()
    return c.best_grammar(stems).select("stem", F.col("best.prefix").alias("prefix"), F.col("best.kind").alias("kind"), F.col("best.geo").alias("geo"), F.col("best.date").alias("date"))


def scan_diff(spark, d):
    pages = table(spark, d, "pages").select("page_id", "url")
    return c.snapshot_diff(pages.where("page_id % 5 != 0"), pages.where("page_id % 3 != 0"), "url").groupBy("change").agg(F.count(F.lit(1)).alias("n"))


def family_registry(spark, d):
    """Each type as a family of parts as files; a part is profiled twice, and its brand is the field of the last profile."""
    part = table(spark, d, "part").withColumn("path", F.col("p_partkey").cast("string"))
    members = part.groupBy(F.col("p_type").alias("family_id")).agg(F.collect_list("path").alias("member_files"))
    old = part.select("path", F.lit("outdated").alias("name"), F.lit(1).alias("position"))
    fields = old.unionByName(part.select("path", F.lower("p_brand").alias("name"), F.lit(2).alias("position")))
    return c.registry(members, fields).select("family_id", "variable_count", F.array_join("variables", ",").alias("variables"))


def _audited(spark, d):
    docs = table(spark, d, "documents")
    rows = docs.groupBy(F.col("source").alias("family_id")).agg(
        F.count_if(F.col("n_chars") < 100).alias("gap_count"), F.when(F.max("n_chars") > 20000, "stitched").otherwise("single_format").alias("strategy"), F.lit(True).alias("coverage_complete"),
        F.when(F.count(F.lit(1)) % 2 == 0, "Unknown").otherwise("Nation-Wide").alias("partition_type"), F.when(F.sum("n_chars") % 3 != 0, "YY").alias("date_format"),
        F.collect_set("lang").alias("source_systems"), F.count_if(F.col("n_chars") > 30000).alias("doc_count"),
    )
    return c.audit(rows)


def family_audit(spark, d):
    return c.audit_summary(_audited(spark, d)).withColumn("family_ids", F.array_join("family_ids", ","))


def family_issue_matrix(spark, d):
    codes = ["coverage_gaps", "missing_date_format", "multi_source_system_family", "no_associated_docs", "stitched_preferred_working_series", "unknown_partition_type"]
    each = _audited(spark, d).select(F.size("source_systems").alias("systems"), F.explode("issues").alias("i"))
    return each.groupBy("systems").pivot("i.code", codes).agg(F.count(F.lit(1))).na.fill(0)


def orphan_documents(spark, d):
    docs = table(spark, d, "documents").select("doc_id", "source")
    return docs_.orphans(docs, table(spark, d, "labels"), "doc_id").groupBy("source").agg(F.count(F.lit(1)).alias("orphans"))


def matched_documents(spark, d):
    docs = table(spark, d, "documents").select("doc_id", "source")
    return docs_.matched(docs, table(spark, d, "labels"), "doc_id").groupBy("source").agg(F.count(F.lit(1)).alias("matched"))


def validated_series(spark, d):
    joined = lambda k: F.array_join(k, ",").alias(k)
    return c.validated_series(_files(spark, d)).select("series_prefix", "partition_type", "first_code", "last_code", joined("geo_coverage"), "file_count", joined("source_paths"))


def doc_token_overlap(spark, d):
    names = table(spark, d, "part").select(F.col("p_type").alias("family"), tokens(F.col("p_name")).alias("words")).select("family", F.explode("words").alias("word")).distinct()
    parts = table(spark, d, "part").select("p_partkey", F.explode(tokens(F.col("p_name"))).alias("word"))
    return docs_.token_overlap(names, parts, "family", "p_partkey", 2).groupBy("family").agg(F.count(F.lit(1)).alias("documents"), F.sum("overlap").alias("overlap"))


def candidate_select(spark, d):
    """Three files of each prefix, out of its working series."""
    files = _semantic(spark, d)
    kinds = files.groupBy(F.col("series_prefix").alias("family_id")).agg(c.partition_type(F.collect_set("geo_code")).alias("partition_type"))
    chosen = c.preferred_files(files, ["series_prefix"]).withColumn("family_id", F.col("series_prefix"))
    return c.candidate_files(chosen.join(kinds, "family_id"))


def candidate_docs(spark, d):
    pages = table(spark, d, "pages").withColumn("host", F.regexp_extract("url", "^[a-z]+://([^/]+)", 1))
    return c.candidate_docs(pages.select(F.col("host").alias("family_id"), "url", F.lit(None).cast("string").alias("filename"), (F.length("html") % 50).cast("double").alias("score")), 3).select("family_id", "url", "filename", "score", "selection_rank")


def group_pairs(spark, d):
    """Pairs of a prefix's groups, by system, whose periods overlap or touch."""
    return c.compatible_groups(cut(c.physical_groups(_files(spark, d))))


def asset_entries(spark, d):
    """Pages as chosen documents, some with their path or name, most with their URL only."""
    n = F.col("page_id")
    pages = table(spark, d, "pages").select("page_id", "url", F.when(n % 3 == 0, F.concat(F.lit("/x/"), n.cast("string"), F.lit(".pdf"))).alias("source_path"), F.when(n % 5 == 0, "named.pdf").otherwise("").alias("filename"), F.when(n % 2 == 0, n).alias("selection_rank"), n.alias("family_id"))
    return c.asset_entries(pages, "doc")


def download_plan(spark, d):
    return c.download_plan(manifest(spark, d), "/lake/raw", "https://example.org")


QUERIES = {
    f.__name__: f
    for f in (
        filename_grammar, discard_reasons, date_format_infer, normalized_periods, partition_classify, series_catalog, physical_groups, dataset_families, family_clusters, family_rank_ids,
        preferred_series, series_segments, preferred_working_series, family_summary, candidate_docs, group_pairs, coverage_gaps, compress_ranges, state_panel, multi_grammar_parse, scan_diff, family_registry, family_audit, family_issue_matrix,
        orphan_documents, matched_documents, validated_series, doc_token_overlap, asset_entries, candidate_select, download_plan,
    )
}

_PERIOD = "CASE WHEN length(code) = 4 THEN (CASE WHEN CAST(left(code, 2) AS INTEGER) < 70 THEN 2000 ELSE 1900 END + CAST(left(code, 2) AS BIGINT)) * 100 + CAST(right(code, 2) AS BIGINT) ELSE (CASE WHEN CAST(code AS INTEGER) < 70 THEN 2000 ELSE 1900 END + CAST(code AS BIGINT)) * 100 END"
_SYSTEM = "string_split(directory, '/')[4]"
_PRIMARY = "CASE ext WHEN '.json.zip' THEN '.json' ELSE ext END"
_FAMILY = "CASE ext WHEN '.json.zip' THEN 'json' WHEN '.csv' THEN 'csv' ELSE 'dbase' END"
_PART = f"CASE WHEN len(list_intersect(list(DISTINCT geo), {UF_LIST})) >= 20 THEN CASE WHEN bool_or(geo = 'BR') THEN 'Mixed-Partition' ELSE 'State-Partitioned' END WHEN bool_or(geo = 'BR') THEN 'Nation-Wide' ELSE 'Unknown' END"
_FMT = "CASE WHEN prefix = 'SMALL' THEN 'YY' ELSE 'YYMM' END"
_SHOW = "CASE WHEN {0} % 100 = 0 THEN CAST({0} // 100 AS VARCHAR) ELSE strftime(make_date({0} // 100, {0} % 100, 1), '%b %Y') END"
_GONE = """act AS (SELECT DISTINCT o_custkey, year(o_orderdate) * 12 + month(o_orderdate) AS n FROM orders JOIN customer ON o_custkey = c_custkey),
    span AS (SELECT o_custkey, min(n) AS a, max(n) AS b FROM act GROUP BY 1), gone AS (SELECT o_custkey, n FROM (SELECT o_custkey, unnest(range(a, b + 1)) AS n FROM span) ANTI JOIN act USING (o_custkey, n))"""
_MONTH = "CAST((({0} - 1) // 12) * 100 + ({0} - 1) % 12 + 1 AS BIGINT)"
_PREF = f"""WITH RECURSIVE {MANIFEST_SQL}, v AS (SELECT *, {_PERIOD} AS period, {_PRIMARY} AS pe, {_FAMILY} AS fam, {_SYSTEM} AS sys FROM manifest),
    dirs AS (SELECT prefix, directory, max(period) AS own, max(max(period)) OVER (PARTITION BY prefix) AS top FROM v GROUP BY 1, 2),
    m AS (SELECT v.*, CASE WHEN directory LIKE '%PRELIM%' THEN '[Staging]' WHEN top - own > CASE WHEN prefix = 'SMALL' THEN 5 ELSE 500 END THEN '[Legacy Archive]' ELSE '[Primary]' END AS sem FROM v JOIN dirs USING (prefix, directory)),
    k AS (SELECT *, row_number() OVER (PARTITION BY prefix, period ORDER BY CASE pe WHEN '.json' THEN 0 WHEN '.csv' THEN 3 ELSE 5 END, CASE sem WHEN '[Primary]' THEN 0 WHEN '[Legacy Archive]' THEN 1 ELSE 2 END, sys, directory, path) AS r FROM m), chosen AS (SELECT * FROM k WHERE r = 1)"""
_ORD = "CASE WHEN prefix = 'SMALL' THEN {0} // 100 ELSE ({0} // 100) * 12 + {0} % 100 END"
_SEGMENTS = f"""{_PREF}, o AS (SELECT *, {_ORD.format('period')} AS n FROM chosen),
    f AS (SELECT *, CASE WHEN lag(n) OVER w + 1 = n AND lag(pe) OVER w = pe AND lag(fam) OVER w = fam AND lag(sys) OVER w = sys AND lag(sem) OVER w = sem THEN 0 ELSE 1 END AS new FROM o WINDOW w AS (PARTITION BY prefix ORDER BY period)),
    g AS (SELECT *, CAST(sum(new) OVER (PARTITION BY prefix ORDER BY period) AS INTEGER) AS segment FROM f)"""
_BACK = "CASE WHEN prefix = 'SMALL' THEN CAST(n AS VARCHAR) ELSE strftime(make_date(CAST((n - 1) // 12 AS BIGINT), CAST((n - 1) % 12 + 1 AS BIGINT), 1), '%b %Y') END"
_SERIES = f"""{_SEGMENTS}, due AS (SELECT prefix, unnest(range(min(n), max(n) + 1)) AS n FROM o GROUP BY prefix), holes AS (SELECT * FROM due ANTI JOIN o USING (prefix, n)),
    gaps AS (SELECT prefix, string_agg({_BACK}, ',' ORDER BY n) AS coverage_gaps FROM holes GROUP BY 1),
    series AS (SELECT prefix, count(*) AS selected_file_count, string_agg(path, ',' ORDER BY period) AS selected_files, list_sort(list(DISTINCT CASE pe WHEN '.json' THEN '0.json' WHEN '.csv' THEN '3.csv' ELSE '5.dbc' END)) AS e,
      array_to_string(list_sort(list(DISTINCT fam)), ',') AS selected_format_families, CAST(max(segment) AS INTEGER) AS segment_count FROM g GROUP BY prefix)"""
_FAMILIES = f"""g1 AS (SELECT sys || '|' || prefix AS id, prefix, {_PART} AS pt, {_FMT} AS df, array_to_string(list_sort(list(DISTINCT geo)), ',') AS geos, min(period) AS a, max(period) AS b FROM v GROUP BY sys, prefix),
    o1 AS (SELECT *, {_ORD.format('a')} AS lo, {_ORD.format('b')} AS hi FROM g1),
    e1 AS (SELECT l.id AS a, r.id AS b FROM o1 l JOIN o1 r ON l.prefix = r.prefix AND l.pt = r.pt AND l.df = r.df AND l.geos = r.geos AND l.id <> r.id AND l.lo <= r.hi + 1 AND r.lo <= l.hi + 1),
    w1 AS (SELECT id AS a, id AS b FROM o1 UNION SELECT w1.a, e1.b FROM w1 JOIN e1 ON w1.b = e1.a), cl AS (SELECT a AS id, min(b) AS c FROM w1 GROUP BY 1),
    fam1 AS (SELECT prefix, c, CASE WHEN count(DISTINCT sys) = 1 THEN min(sys) ELSE 'MULTI' END AS sys, count(DISTINCT sys) AS systems, {_PART} AS pt, {_FMT} AS df, min(period) AS a, max(period) AS b, count(*) AS n FROM v JOIN cl ON cl.id = v.sys || '|' || v.prefix GROUP BY prefix, c HAVING count(*) >= 5),
    fam AS (SELECT *, prefix || CASE WHEN count(*) OVER (PARTITION BY prefix) > 1 THEN '__' || row_number() OVER (PARTITION BY prefix ORDER BY a, n DESC, c) ELSE '' END AS family_id FROM fam1)"""
_PICKS = f"""{_PREF}, kind AS (SELECT prefix, {_PART} AS pt FROM m GROUP BY 1), c AS (SELECT prefix AS f, path, regexp_extract(path, '[^/]*$') AS name, geo, period, pe, CASE sem WHEN '[Primary]' THEN 2 WHEN '[Legacy Archive]' THEN 1 ELSE 0 END AS q, pt FROM chosen JOIN kind USING (prefix)),
    p1 AS (SELECT *, row_number() OVER (PARTITION BY f ORDER BY (pt = 'Mixed-Partition' AND geo = 'BR') DESC, period DESC, q DESC, (pt <> 'State-Partitioned' AND geo = 'BR') DESC, name DESC, path DESC) AS r FROM c),
    k1 AS (SELECT * FROM p1 WHERE r = 1),
    p2 AS (SELECT c.*, c.geo <> k1.geo AS g, c.period <> k1.period AS t, row_number() OVER (PARTITION BY f ORDER BY c.geo <> k1.geo DESC, c.period <> k1.period DESC, c.q DESC, c.period DESC, c.name DESC, c.path DESC) AS r FROM c JOIN k1 USING (f) WHERE c.path <> k1.path),
    k2 AS (SELECT * FROM p2 WHERE r = 1),
    p3 AS (SELECT c.*, c.geo NOT IN (k1.geo, k2.geo) AS g, c.period NOT IN (k1.period, k2.period) AS t, row_number() OVER (PARTITION BY f ORDER BY c.geo NOT IN (k1.geo, k2.geo) DESC, c.period NOT IN (k1.period, k2.period) DESC, c.q DESC, c.period DESC, c.name DESC, c.path DESC) AS r
      FROM c JOIN k1 USING (f) JOIN k2 USING (f) WHERE c.path NOT IN (k1.path, k2.path)),
    all_ AS (SELECT f, path, pe, q, pt, geo, 1 AS k, false AS g, false AS t FROM k1 UNION ALL SELECT f, path, pe, q, pt, geo, 2, g, t FROM k2 UNION ALL SELECT f, path, pe, q, pt, geo, 3, g, t FROM p3 WHERE r = 1)
    SELECT f AS family_id, path, CAST(k AS INTEGER) AS selection_rank, concat_ws('; ', CASE WHEN k > 1 THEN NULL WHEN pt = 'Mixed-Partition' AND geo = 'BR' THEN 'latest nation-wide member in mixed family' WHEN pt = 'Nation-Wide' THEN 'latest nation-wide family member' ELSE 'most recent family member' END,
      CASE WHEN g THEN 'adds geo coverage (' || geo || ')' END, CASE WHEN t THEN 'adds time coverage' END, CASE WHEN q = 2 THEN 'preferred primary path' END, 'format=' || substr(pe, 2)) AS selection_reason FROM all_"""
_ISSUES = """WITH f AS (SELECT source AS family_id, count(*) FILTER (WHERE n_chars < 100) AS g, max(n_chars) AS x, count(*) AS n, sum(n_chars) AS s, count(DISTINCT lang) AS l, count(*) FILTER (WHERE n_chars > 30000) AS d FROM documents GROUP BY 1),
    i AS (SELECT family_id, l, unnest([CASE WHEN g > 0 THEN 'coverage_gaps:warning' END, CASE WHEN x > 20000 THEN 'stitched_preferred_working_series:info' END, CASE WHEN n % 2 = 0 THEN 'unknown_partition_type:warning' END,
      CASE WHEN s % 3 = 0 THEN 'missing_date_format:warning' END, CASE WHEN l > 1 THEN 'multi_source_system_family:info' END, CASE WHEN d = 0 THEN 'no_associated_docs:info' END]) AS c FROM f)"""
_WORDS = "list_distinct(list_filter(regexp_split_to_array(upper(p_name), '[^A-Z0-9]+'), lambda w: length(w) >= 2))"
SQL = {
    "filename_grammar": f"""WITH {MANIFEST_SQL} SELECT path, CASE WHEN length(code) = 4 THEN 'PREFIX_GEO_YYMM' ELSE 'PREFIX_GEO_YY' END AS pattern_name, prefix AS series_prefix, geo AS geo_code, code AS date_code, ext AS extension,
        {_PRIMARY} AS primary_extension, {_FAMILY} AS format_family, {_SYSTEM} AS system_guess, 'Primary' AS path_type FROM manifest""",
    "discard_reasons": f"WITH {MANIFEST_SQL} SELECT CASE geo WHEN 'BR' THEN 'auxiliary_path' WHEN 'SP' THEN 'missing_series_prefix' WHEN 'RJ' THEN 'unknown_format_family' END AS discard_reason, count(*) AS n FROM manifest GROUP BY 1",
    "date_format_infer": f"WITH {MANIFEST_SQL} SELECT prefix AS series_prefix, {_FMT} AS date_format, count(*) AS n FROM manifest GROUP BY 1",
    "normalized_periods": f"WITH {MANIFEST_SQL}, m AS (SELECT path, {_PERIOD} AS period FROM manifest) SELECT path, period, {_SHOW.format('period')} AS shown FROM m",
    "partition_classify": f"WITH {MANIFEST_SQL} SELECT prefix AS series_prefix, directory, CAST(count(DISTINCT geo) AS INTEGER) AS places, {_PART} AS partition_type FROM manifest GROUP BY 1, 2",
    "series_catalog": f"""WITH {MANIFEST_SQL}, m AS (SELECT *, {_PERIOD} AS period, {_SYSTEM} AS sys FROM manifest), k AS (SELECT *, count(*) OVER (PARTITION BY directory) AS n FROM m), v AS (SELECT * FROM k WHERE n >= 5),
        s AS (SELECT prefix, min(sys) AS sys, {_PART} AS partition_type, {_FMT} AS date_format, min(period) AS first_period, max(period) AS last_period, array_to_string(list_sort(list(DISTINCT geo)), ',') AS geo_coverage, count(*) AS file_count, array_to_string(list_sort(list(DISTINCT directory)), ',') AS source_paths, array_to_string(list(regexp_extract(path, '[^/]*$') ORDER BY path)[1:10], ',') AS file_samples FROM v GROUP BY prefix),
        d AS (SELECT prefix, directory, max(period) AS own, max(max(period)) OVER (PARTITION BY prefix) AS top FROM v GROUP BY 1, 2),
        w AS (SELECT prefix, string_agg(directory || '=' || CASE WHEN directory LIKE '%PRELIM%' THEN '[Staging]' WHEN top - own > CASE WHEN prefix = 'SMALL' THEN 5 ELSE 500 END THEN '[Legacy Archive]' ELSE '[Primary]' END, ';' ORDER BY directory) AS path_semantics FROM d GROUP BY 1)
        SELECT sys || ':' || prefix AS series_id, partition_type, date_format, first_period, last_period, {_SHOW.format('first_period')} || ' to ' || {_SHOW.format('last_period')} AS time_range_display, geo_coverage, file_count, source_paths, path_semantics, file_samples FROM s JOIN w USING (prefix) WHERE partition_type <> 'Unknown'""",
    "physical_groups": f"""WITH {MANIFEST_SQL}, m AS (SELECT *, {_PERIOD} AS period, {_SYSTEM} AS sys, {_FAMILY} AS fam FROM manifest)
        SELECT sys AS system_guess, prefix AS series_prefix, {_PART} AS partition_type, {_FMT} AS date_format, min(period) AS time_min, max(period) AS time_max, count(*) AS file_count, array_to_string(list_sort(list(DISTINCT fam)), ',') AS format_families FROM m GROUP BY sys, prefix""",
    "dataset_families": f"""{_PREF}, {_FAMILIES}
        SELECT family_id, prefix AS series_prefix, sys AS system_guess, pt AS partition_type, df AS date_format, {_SHOW.format('a')} || CASE WHEN a = b THEN '' ELSE ' to ' || {_SHOW.format('b')} END AS time_range_display, n AS file_count, CAST(systems AS INTEGER) AS variants FROM fam""",
    "group_pairs": f"{_PREF}, {_FAMILIES} SELECT a, b FROM e1 WHERE a < b",
    "family_summary": f"""{_SERIES}, {_FAMILIES}, fs AS (SELECT family_id, pt, df, systems, e, coverage_gaps IS NOT NULL AS gap, length(family_id) % 2 AS docs FROM fam JOIN series USING (prefix) LEFT JOIN gaps USING (prefix))
        SELECT 'files' AS section, CASE geo WHEN 'AC' THEN 'auxiliary_path' ELSE 'eligible' END AS item, count(*) AS n FROM manifest GROUP BY 2
        UNION ALL SELECT 'partition', pt, count(*) FROM fs GROUP BY 2 UNION ALL SELECT 'date_format', df, count(*) FROM fs GROUP BY 2
        UNION ALL SELECT 'system_shape', CASE WHEN systems <= 1 THEN 'single_system' ELSE 'multi_system' END, count(*) FROM fs GROUP BY 2
        UNION ALL SELECT 'strategy', CASE WHEN len(e) <= 1 THEN 'single_format' ELSE 'stitched' END, count(*) FROM fs GROUP BY 2
        UNION ALL SELECT 'preferred_extension', item, count(*) FROM (SELECT substr(unnest(e), 2) AS item FROM fs) GROUP BY 2
        UNION ALL SELECT 'families', 'with_gaps', count(*) FILTER (WHERE gap) FROM fs UNION ALL SELECT 'families', 'without_docs', count(*) FILTER (WHERE docs = 0) FROM fs""",
    "preferred_working_series": f"""{_SERIES} SELECT prefix AS series_prefix, CASE WHEN len(e) <= 1 THEN 'single_format' ELSE 'stitched' END AS strategy, coverage_gaps IS NULL AS coverage_complete, coalesce(coverage_gaps, '') AS coverage_gaps, selected_file_count, selected_files,
        array_to_string(list_transform(e, lambda x: substr(x, 2)), ',') AS selected_primary_extensions, selected_format_families, segment_count FROM series LEFT JOIN gaps USING (prefix)""",
    "candidate_select": _PICKS,
    "candidate_docs": """WITH s AS (SELECT regexp_extract(url, '^[a-z]+://([^/]+)', 1) AS family_id, url, regexp_extract(url, '([^/]*)/*$', 1) AS filename, CAST(length(html) % 50 AS DOUBLE) AS score FROM pages WHERE url <> ''),
        o AS (SELECT *, row_number() OVER (PARTITION BY family_id, url ORDER BY score DESC, url DESC) AS k FROM s), r AS (SELECT *, row_number() OVER (PARTITION BY family_id ORDER BY score DESC, url DESC) AS selection_rank FROM o WHERE k = 1)
        SELECT family_id, url, filename, score, CAST(selection_rank AS INTEGER) AS selection_rank FROM r WHERE selection_rank <= 3""",
    "family_clusters": """WITH s AS (SELECT c_mktsegment AS g, c_nationkey AS h, o_orderkey AS node, year(o_orderdate) * 12 + month(o_orderdate) AS lo, year(o_orderdate) * 12 + month(o_orderdate) + o_orderkey % 3 AS hi FROM orders JOIN customer ON o_custkey = c_custkey),
        r AS (SELECT *, max(hi) OVER (PARTITION BY g, h ORDER BY lo, hi, node ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS reach FROM s), k AS (SELECT *, sum(CASE WHEN reach IS NULL OR lo > reach + 1 THEN 1 ELSE 0 END) OVER (PARTITION BY g, h ORDER BY lo, hi, node) AS chain FROM r)
        SELECT node, min(node) OVER (PARTITION BY g, h, chain) AS component FROM k""",
    "family_rank_ids": """WITH r AS (SELECT c_mktsegment AS g, c_nationkey, CAST(min(year(o_orderdate) * 100 + month(o_orderdate)) AS BIGINT) AS time_min, count(*) AS file_count FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1, 2)
        SELECT g || '__' || row_number() OVER (PARTITION BY g ORDER BY time_min, file_count DESC, c_nationkey) AS family_id, c_nationkey, time_min, file_count FROM r""",
    "preferred_series": f"{_PREF} SELECT prefix AS series_prefix, period, path FROM chosen",
    "series_segments": f"""{_SEGMENTS}, q AS (SELECT prefix, segment, pe, fam, sys, sem, min(period) AS a, max(period) AS b, count(*) AS files, array_to_string(list_sort(list(DISTINCT directory)), ',') AS source_paths FROM g GROUP BY 1, 2, 3, 4, 5, 6)
        SELECT prefix AS series_prefix, segment, pe AS primary_extension, fam AS format_family, sys AS system_guess, sem AS path_semantic, a AS first_period, b AS last_period, files, source_paths, {_SHOW.format('a')} || CASE WHEN a = b THEN '' ELSE ' to ' || {_SHOW.format('b')} END AS time_range_display FROM q""",
    "coverage_gaps": f"WITH {_GONE} SELECT o_custkey, {_MONTH.format('n')} AS period FROM gone",
    "compress_ranges": f"WITH {_GONE}, r AS (SELECT o_custkey, n, n - row_number() OVER (PARTITION BY o_custkey ORDER BY n) AS run FROM gone) SELECT o_custkey, {_MONTH.format('min(n)')} AS first_period, {_MONTH.format('max(n)')} AS last_period, count(*) AS n FROM r GROUP BY o_custkey, run",
    "state_panel": f"""WITH {MANIFEST_SQL}, m AS (SELECT prefix, {_PERIOD} AS period, list_intersect(list(DISTINCT geo), {UF_LIST}) AS have FROM manifest GROUP BY 1, 2)
        SELECT prefix AS series_prefix, period, CAST(len(have) AS INTEGER) AS present, array_to_string(list_sort(list_filter({UF_LIST}, lambda u: NOT list_contains(have, u))), ',') AS missing, round(len(have) / 27.0, 9) AS coverage FROM m""",
    "multi_grammar_parse": f"""WITH {MANIFEST_SQL} SELECT DISTINCT prefix || geo || code AS stem, prefix, CASE WHEN length(code) = 2 THEN 'year2' ELSE 'month' END AS kind, geo, code AS date FROM manifest""",
    "scan_diff": "WITH a AS (SELECT DISTINCT url FROM pages WHERE page_id % 5 <> 0), b AS (SELECT DISTINCT url FROM pages WHERE page_id % 3 <> 0) SELECT CASE WHEN a.url IS NULL THEN 'added' WHEN b.url IS NULL THEN 'removed' ELSE 'common' END AS change, count(*) AS n FROM a FULL JOIN b ON a.url = b.url GROUP BY 1",
    "family_registry": "SELECT p_type AS family_id, CAST(count(DISTINCT upper(p_brand)) AS INTEGER) AS variable_count, array_to_string(list_sort(list(DISTINCT upper(p_brand))), ',') AS variables FROM part GROUP BY 1",
    "family_audit": f"{_ISSUES} SELECT split_part(c, ':', 1) AS code, split_part(c, ':', 2) AS severity, count(DISTINCT family_id) AS families, array_to_string(list_sort(list(DISTINCT family_id)), ',') AS family_ids FROM i WHERE c IS NOT NULL GROUP BY 1, 2",
    "family_issue_matrix": _ISSUES + " SELECT CAST(l AS INTEGER) AS systems, " + ", ".join(f"count(*) FILTER (WHERE c LIKE '{k}:%') AS {k}" for k in ("coverage_gaps", "missing_date_format", "multi_source_system_family", "no_associated_docs", "stitched_preferred_working_series", "unknown_partition_type")) + " FROM i WHERE c IS NOT NULL GROUP BY 1",
    "orphan_documents": "SELECT source, count(*) AS orphans FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels) GROUP BY 1",
    "asset_entries": """WITH x AS (SELECT *, CASE WHEN page_id % 3 = 0 THEN '/x/' || page_id || '.pdf' ELSE regexp_replace(regexp_replace(url, '^[a-z]+://[^/]*', ''), '[?#].*$', '') END AS path FROM pages)
        SELECT page_id AS family_id, 'doc' AS asset_kind, CAST(CASE WHEN page_id % 2 = 0 THEN page_id ELSE 0 END AS INTEGER) AS selection_rank, '' AS selection_reason, url AS source_url, path AS source_path, CASE WHEN page_id % 5 = 0 THEN 'named.pdf' ELSE regexp_extract(path, '([^/]*)/*$', 1) END AS filename FROM x""",
    "matched_documents": "SELECT source, count(*) AS matched FROM documents WHERE doc_id IN (SELECT doc_id FROM labels) GROUP BY 1",
    "validated_series": f"""WITH {MANIFEST_SQL}, s AS (SELECT prefix, list_sort(list(DISTINCT geo)) AS g, min(CAST(code AS BIGINT)) AS a, max(CAST(code AS BIGINT)) AS b, count(*) AS n, array_to_string(list_sort(list(DISTINCT directory)), ',') AS paths FROM manifest GROUP BY 1),
        u AS (SELECT *, len(list_intersect(g, {UF_LIST})) AS k, list_contains(g, 'BR') AS br FROM s), t AS (SELECT *, k >= 4 AND k / len(g) >= 0.35 AS st FROM u)
        SELECT prefix AS series_prefix, CASE WHEN st AND br THEN 'Mixed-Partition' WHEN st THEN 'State-Partitioned' ELSE 'Nation-Wide' END AS partition_type, a AS first_code, b AS last_code, array_to_string(g, ',') AS geo_coverage, n AS file_count, paths AS source_paths FROM t WHERE st OR br""",
    "doc_token_overlap": f"""WITH w AS (SELECT p_partkey, p_type, unnest({_WORDS}) AS word FROM part), f AS (SELECT DISTINCT p_type AS family, word FROM w),
        o AS (SELECT family, p_partkey, count(*) AS overlap FROM f JOIN w USING (word) GROUP BY 1, 2 HAVING count(*) >= 2) SELECT family, count(*) AS documents, CAST(sum(overlap) AS BIGINT) AS overlap FROM o GROUP BY 1""",
    "download_plan": f"WITH {MANIFEST_SQL} SELECT path, 'https://example.org' || path AS url, '/lake/raw' || path AS target_path, 'planned' AS status FROM manifest",
}
del UF
