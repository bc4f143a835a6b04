"""Logical families, bundles, request shards and the extensions, over the driver's tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import bundle as b
from ..operators import catalog as c
from ..operators import extensions as e
from ..operators import logical as l
from ..operators import profile as p
from ..operators.graph import cut
from .common import MANIFEST_SQL, UF_LIST, manifest, table
from .corpus import _PERIOD, _PRIMARY, _SHOW
from .profile import _FACTS, _SIG, _cells


#: Files that hold no data: a document of a system and of a subsystem, a table of codes, a program; a number each nation.
_OTHERS = ["SYSA/DOCS/LAYOUT{}.pdf", "SYSB/ESPECIAL/DOCS/GUIA{}.pdf", "SYSC/TABELAS/CODIGOS{}.cnv", "SYSA/instalador{}.exe", "SYSC/TABELAS/dicionario{}.pdf"]


def _files(spark, d):
    """The manifest below another root, with files that are no data; names of one state have two letters that are no place."""
    path = F.regexp_replace(F.regexp_replace("path", "^/public/data/", "/dissemin/publicos/"), r"/([A-Z]+)SP(\d+)\.", "/$1XX$2.")
    number = F.lpad(F.col("n_nationkey").cast("string"), 2, "0")
    others = table(spark, d, "nation").select(F.explode(F.array(*[F.concat(F.lit("/dissemin/publicos/"), F.replace(F.lit(o), F.lit("{}"), number)) for o in _OTHERS])).alias("path"))
    return l.inventory(manifest(spark, d).select(path.alias("path")).unionByName(others))


def logical_inventory(spark, d):
    return _files(spark, d).select("path", "asset_kind", "distribution_root", "system", "subsystem", "path_semantic", "prefix", "date_kind", "geo_code", "period", "uses_geo")


def logical_families(spark, d):
    found = cut(l.families(cut(_files(spark, d))))
    tier = F.element_at(F.array(F.lit("family_specific"), F.lit("system_generic")), F.length("family_id") % 3)
    docs = found.where(F.length("family_id") % 3 > 0).select("family_id", tier.alias("tier"))
    told = F.array_join(F.transform("issues", lambda i: F.concat_ws(":", i["code"], i["severity"])), ",")
    return l.graded_audit(found, docs).select("family_id", "date_kind", "partition_type", "partition_evidence", "coverage_status", F.array_join("geo_coverage", ",").alias("geo_coverage"), "file_count", "period_min", "period_max", "mode", "missing_periods", "partial_panels", "least_places", told.alias("issues"))


def logical_variants(spark, d):
    return l.variants(_files(spark, d)).select("system", "prefix", "date_kind", "uses_geo", "format_family", "file_count", "period_count", "time_range_display", F.array_join("geo_coverage", ",").alias("geo_coverage"))


def panel_files(spark, d):
    return l.panel_files(_files(spark, d)).select("system", "prefix", "period", "geo_code", "path")


def common_roots(spark, d):
    return l.common_root(l.data_files(_files(spark, d)), ["system"], "path")


def path_tails(spark, d):
    return l.compress_paths(l.data_files(_files(spark, d)), ["system"], "path").withColumn("tails", F.array_join("tails", ","))


def doc_rows(spark, d):
    told = l.doc_rows(_files(spark, d), "https://example.org/")
    return told.select("path", "url", "filename", "directory", "system", "subsystem", "format_family", "doc_scope_hint", F.array_join("keyword_hits", ",").alias("keyword_hits"))


def _members(spark):
    return spark.createDataFrame([("part", "A"), ("part", "B"), ("customer", "A"), ("supplier", "B")], "path string, family_id string")


def translation_bundle(spark, d):
    members = _members(spark)
    profiles = cut(p.field_profiles(_cells(spark, d)))
    fields = b.family_fields(members, profiles, p.variable_catalog(profiles, members))
    families = members.groupBy("family_id").agg(F.count(F.lit(1)).alias("file_count"), F.lit(None).cast("string").alias("system_guess"), F.min("path").alias("series_prefix"))
    docs = members.select("family_id", F.concat(F.lit("https://example.org/"), "path").alias("url"), F.length("path").cast("double").alias("score"))
    return b.translation_bundle(families, fields, docs)


def document_registry(spark, d):
    pages = table(spark, d, "pages").select("page_id", "url")
    docs = pages.select(F.regexp_extract("url", "^[a-z]+://([^/]+)", 1).alias("family_id"), "url", F.concat(F.lit("page"), F.col("page_id").cast("string")).alias("filename")).distinct()
    lies = pages.where("page_id % 3 = 0").select(F.concat(F.lit("page"), F.col("page_id").cast("string")).alias("path"))
    whole = pages.where("page_id % 3 = 1").select(F.regexp_replace("url", "^[a-z]+://[^/]*/?", "").alias("path"))
    return b.document_registry(docs, lies.unionByName(whole))


def request_shards(spark, d):
    customer = table(spark, d, "customer").groupBy(F.col("c_nationkey").cast("long").alias("aggregate_id")).agg(F.sort_array(F.collect_list("c_custkey")).alias("localities"))
    rows = customer.select("aggregate_id", F.lit("93").alias("variable_id"), "localities", F.when(F.col("aggregate_id") % 2 == 0, F.sequence(F.lit(1), F.lit(30))).otherwise(F.array().cast("array<int>")).alias("periods"))
    shown = lambda k: F.array_join(F.transform(k, lambda x: x.cast("string")), ",").alias(k)
    return c.request_shards(rows).select("aggregate_id", "variable_id", "locality_shard", "period_shard", shown("localities"), shown("periods"))


def national_coverage(spark, d):
    levels = table(spark, d, "orders").join(table(spark, d, "customer"), F.col("o_custkey") == F.col("c_custkey")).groupBy(F.col("c_nationkey").cast("long").alias("agregado_id"), F.concat(F.lit("n"), F.substring("o_orderpriority", 1, 1)).alias("level_id")).agg(F.count(F.lit(1)).alias("locality_count"))
    return c.national(levels, "N1", 120)


def catalog_candidates(spark, d):
    tables = table(spark, d, "part").select(F.col("p_partkey").alias("id"), F.col("p_name").alias("nome"), F.col("p_type").alias("assunto"), F.col("p_brand").alias("pesquisa"), F.lit(" ").alias("freq"))
    return c.table_text(c.candidates(tables, "Próm", "brand#1"))


def observable_forms(spark, d):
    x = F.col("l_discount")
    forms = e.representations(x)
    return table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", *[F.round(forms[k], 9).alias(k) for k in ("log", "log1p", "sqrt", "logit", "signed_log")])


def observable_templates(spark, d):
    out = e.templates(table(spark, d, "orders"), ["o_orderpriority"], "o_totalprice")
    return out.select("o_orderpriority", "n", F.round("mean", 4).alias("mean"), F.round("variance", 0).alias("variance"), *[F.round(f"bin_{k}", 9).alias(f"bin_{k}") for k in range(1, 5)])


def observable_lags(spark, d):
    month = (F.year("o_orderdate") * 12 + F.month("o_orderdate")).alias("month")
    rows = cut(table(spark, d, "orders").groupBy("o_orderpriority", "o_orderstatus", month).agg(F.count(F.lit(1)).alias("n")))
    return e.lagged(rows, ["o_orderpriority", "o_orderstatus"], "month", "n", [1, 12])


def latest_orders(spark, d):
    return e.latest(table(spark, d, "orders").select("o_custkey", "o_orderkey", "o_orderdate"), ["o_custkey"], [F.desc("o_orderdate"), F.desc("o_orderkey")]).select("o_custkey", "o_orderkey", "recency")


def table_overview(spark, d):
    return e.overview(_cells(spark, d)).withColumn("missing_share", F.round("missing_share", 9))


def vector_cosines(spark, d):
    v = table(spark, d, "embeddings").select("vec_id", "embedding")
    pairs = v.select(F.col("vec_id").alias("a"), (F.col("vec_id") + 1).alias("b"))
    return e.cosine_pairs(v, pairs, "vec_id", "embedding").withColumn("cosine", F.round("cosine", 6))


def value_frequencies(spark, d):
    from ..operators import strings

    return strings.frequencies(table(spark, d, "part"), ["p_type"], "p_brand", 5)


def family_schemas(spark, d):
    signatures = p.schema_signature(p.field_profiles(_cells(spark, d)))
    return e.family_signatures(_members(spark), signatures).withColumn("schema_signatures", F.array_join("schema_signatures", ","))


def series_by_system(spark, d):
    return e.by_system(l.data_files(_files(spark, d)), "system", "prefix").withColumn("series", F.array_join("series", ","))


QUERIES = {
    f.__name__: f
    for f in (
        logical_inventory, logical_families, logical_variants, panel_files, common_roots, path_tails, doc_rows, translation_bundle, document_registry, request_shards, national_coverage, catalog_candidates, observable_forms,
        observable_templates, observable_lags, latest_orders, table_overview, vector_cosines, value_frequencies, family_schemas, series_by_system,
    )
}

_KIND = "CASE WHEN prefix = 'SMALL' THEN 'yy' ELSE 'yymm' END"
_LOGICAL = f"""WITH {MANIFEST_SQL}, i AS (SELECT '/dissemin/publicos' || substr(directory, 13) || '/' || prefix || CASE geo WHEN 'SP' THEN 'XX' ELSE geo END || code || ext AS path, string_split(directory, '/')[4] AS sys, string_split(directory, '/')[5] AS stage, prefix AS own,
      CASE geo WHEN 'SP' THEN prefix || 'XX' ELSE prefix END AS prefix, {_KIND} AS kind, nullif(geo, 'SP') AS geo, {_PERIOD} AS period, {_PRIMARY} AS pe FROM manifest),
    known AS (SELECT DISTINCT sys, own FROM i WHERE geo IS NOT NULL), d AS (SELECT i.*, coalesce(k.own, i.prefix) AS pre FROM i LEFT JOIN known k ON k.sys = i.sys AND k.own = i.own)"""
_FORMAT = "substr(pe, 2)"
SQL = {
    "logical_inventory": f"{_LOGICAL} SELECT path, 'data' AS asset_kind, sys AS distribution_root, sys AS system, CAST(NULL AS VARCHAR) AS subsystem, CASE stage WHEN 'PRELIM' THEN '[Staging]' ELSE '[Primary]' END AS path_semantic, prefix, kind AS date_kind, geo AS geo_code, CAST(period AS BIGINT) AS period, geo IS NOT NULL AS uses_geo FROM i UNION ALL SELECT '/dissemin/publicos/' || replace(o.path, '{{}}', lpad(CAST(n_nationkey AS VARCHAR), 2, '0')), o.kind, left(o.path, 4), left(o.path, 4), o.sub, '[Primary]', o.prefix, 'yy', NULL, (2000 + n_nationkey) * 100, false FROM nation, (VALUES ('SYSA/DOCS/LAYOUT{{}}.pdf', 'doc', NULL, 'LAYOUT'), ('SYSB/ESPECIAL/DOCS/GUIA{{}}.pdf', 'doc', 'ESPECIAL', 'GUIA'), ('SYSC/TABELAS/CODIGOS{{}}.cnv', 'aux', NULL, 'CODIGOS'), ('SYSA/instalador{{}}.exe', 'other', NULL, 'INSTALADOR'), ('SYSC/TABELAS/dicionario{{}}.pdf', 'doc', NULL, 'DICIONARIO')) o(path, kind, sub, prefix)",
    "logical_families": f"""{_LOGICAL}, pp AS (SELECT sys, pre, kind, period, count(*) AS files, len(list_intersect(list(DISTINCT geo), {UF_LIST})) AS states, bool_or(geo IS NOT NULL) AS used FROM d GROUP BY 1, 2, 3, 4),
        g AS (SELECT sys, pre, list_sort(list(DISTINCT geo) FILTER (WHERE geo IS NOT NULL)) AS geos FROM d GROUP BY 1, 2),
        f AS (SELECT sys, pre, kind, CAST(sum(files) AS BIGINT) AS file_count, min(period) AS a, max(period) AS b, count(*) AS periods, max(files) AS most, bool_or(used) AS used, count(*) FILTER (WHERE states BETWEEN 1 AND 26) AS part, count(*) FILTER (WHERE states = 0) AS bare, min(states) FILTER (WHERE states > 0) AS least FROM pp GROUP BY 1, 2, 3),
        t AS (SELECT f.*, coalesce(geos, []) AS geos, len(list_intersect(coalesce(geos, []), {UF_LIST})) AS n, list_contains(coalesce(geos, []), 'BR') AS br, (CASE kind WHEN 'yy' THEN b // 100 - a // 100 ELSE (b // 100 - a // 100) * 12 + b % 100 - a % 100 END) + 1 AS span FROM f JOIN g USING (sys, pre)),
        u AS (SELECT *, CASE WHEN br AND n > 0 THEN 'Mixed-Partition' WHEN n > 0 THEN 'State-Partitioned' WHEN br THEN 'Nation-Wide' WHEN periods >= 2 AND NOT used AND most = 1 THEN 'Nation-Wide' WHEN used THEN 'Geo-Coded-Unresolved' ELSE 'Geo-Less' END AS pt,
          CASE WHEN br AND n > 0 THEN 'explicit_br_and_ufs' WHEN n > 0 THEN 'explicit_ufs' WHEN br THEN 'explicit_br' WHEN periods >= 2 AND NOT used AND most = 1 THEN 'implicit_single_file_per_period' WHEN used THEN 'geo_expected_but_unresolved' ELSE 'no_geo_in_filename' END AS why, sys || ':' || pre AS id FROM t),
        w AS (SELECT *, pt = 'State-Partitioned' AS panel, CASE pt WHEN 'State-Partitioned' THEN CASE WHEN n >= 27 THEN 'complete_state_panel' WHEN n >= 20 THEN 'broad_state_panel' WHEN n >= 5 THEN 'partial_state_panel' ELSE 'sparse_state_panel' END WHEN 'Nation-Wide' THEN 'nationwide' WHEN 'Mixed-Partition' THEN 'mixed_br_plus_' || n || '_ufs' WHEN 'Geo-Less' THEN 'geo_less' ELSE 'unresolved' END AS cs FROM u),
        x AS (SELECT *, span - periods + CASE WHEN panel THEN bare ELSE 0 END AS missing, CASE WHEN panel THEN part ELSE 0 END AS partial, CASE WHEN panel AND part > 0 THEN CAST(least AS INTEGER) END AS low FROM w)
        SELECT id AS family_id, kind AS date_kind, pt AS partition_type, why AS partition_evidence, cs AS coverage_status, array_to_string(geos, ',') AS geo_coverage, file_count, CAST(a AS BIGINT) AS period_min, CAST(b AS BIGINT) AS period_max, CASE WHEN panel THEN 'state_panel' WHEN pt = 'Nation-Wide' THEN 'national_series' ELSE 'geo_less_series' END AS mode,
        CAST(missing AS BIGINT) AS missing_periods, CAST(partial AS BIGINT) AS partial_panels, low AS least_places, concat_ws(',', CASE WHEN panel AND missing > 0 THEN 'missing_periods:error' END,
          CASE WHEN panel AND partial > 0 THEN CASE WHEN cs IN ('partial_state_panel', 'sparse_state_panel') OR low <= 10 THEN 'state_panel_fragmented:error' WHEN partial <= 6 AND low >= 24 THEN 'minor_panel_defects:info' ELSE 'state_panel_incomplete:warning' END END,
          CASE WHEN panel AND cs <> 'complete_state_panel' THEN CASE cs WHEN 'broad_state_panel' THEN 'incomplete_statewide_coverage:warning' ELSE 'incomplete_statewide_coverage:error' END END, CASE WHEN pt = 'Nation-Wide' AND missing > 0 THEN CASE WHEN missing <= 6 THEN 'national_series_gaps:warning' ELSE 'national_series_gaps:error' END END,
          CASE WHEN pt IN ('Geo-Coded-Unresolved', 'Geo-Less') THEN 'partition_unresolved:warning' END, CASE length(id) % 3 WHEN 0 THEN 'no_associated_docs:warning' WHEN 2 THEN 'docs_generic_only:info' END) AS issues FROM x""",
    "logical_variants": f"""{_LOGICAL}, v AS (SELECT sys AS system, i.prefix, kind AS date_kind, geo IS NOT NULL AS uses_geo, CASE WHEN pe = '.dbc' THEN 'dbase' ELSE {_FORMAT} END AS format_family, count(*) AS file_count, count(DISTINCT period) AS period_count, min(period) AS a, max(period) AS b, coalesce(string_agg(DISTINCT geo, ',' ORDER BY geo), '') AS geo_coverage FROM i GROUP BY 1, 2, 3, 4, 5)
        SELECT system, prefix, date_kind, uses_geo, format_family, file_count, period_count, {_SHOW.format('a')} || CASE WHEN a = b THEN '' ELSE ' to ' || {_SHOW.format('b')} END AS time_range_display, geo_coverage FROM v""",
    "panel_files": f"""{_LOGICAL}, r AS (SELECT *, row_number() OVER (PARTITION BY sys, prefix, period, geo ORDER BY CASE pe WHEN '.json' THEN 0 WHEN '.csv' THEN 3 ELSE 5 END, CASE stage WHEN 'PRELIM' THEN 2 ELSE 0 END, length(path), path) AS k FROM i WHERE list_contains({UF_LIST}, geo))
        SELECT sys AS system, prefix, CAST(period AS BIGINT) AS period, geo AS geo_code, path FROM r WHERE k = 1""",
    "common_roots": f"{_LOGICAL} SELECT sys AS system, count(DISTINCT path) AS count, '/dissemin/publicos/' || sys || CASE WHEN count(DISTINCT stage) = 1 THEN '/' || min(stage) ELSE '' END AS common_prefix FROM i GROUP BY 1",
    "path_tails": f"""{_LOGICAL}, c AS (SELECT sys AS system, count(DISTINCT path) AS count, '/dissemin/publicos/' || sys || CASE WHEN count(DISTINCT stage) = 1 THEN '/' || min(stage) ELSE '' END AS common_prefix FROM i GROUP BY 1),
        t AS (SELECT sys AS system, path, row_number() OVER (PARTITION BY sys ORDER BY path) AS r FROM (SELECT DISTINCT sys, path FROM i))
        SELECT system, count, common_prefix, string_agg(substr(path, length(common_prefix) + 2), ',' ORDER BY r) AS tails FROM c JOIN t USING (system) WHERE r <= 8 GROUP BY ALL""",
    "doc_rows": """SELECT '/dissemin/publicos/' || d || '/' || f AS path, 'https://example.org/dissemin/publicos/' || d || '/' || f AS url, f AS filename, '/dissemin/publicos/' || d AS directory, left(d, 4) AS system, sub AS subsystem, 'pdf' AS format_family, scope AS doc_scope_hint, hits AS keyword_hits
        FROM (SELECT o.d, o.name || lpad(CAST(n_nationkey AS VARCHAR), 2, '0') || '.pdf' AS f, sub, scope, hits FROM nation, (VALUES ('SYSA/DOCS', 'LAYOUT', NULL, 'system', 'layout'), ('SYSB/ESPECIAL/DOCS', 'GUIA', 'ESPECIAL', 'subsystem', ''), ('SYSC/TABELAS', 'dicionario', NULL, 'generic', 'dicionario')) o(d, name, sub, scope, hits))""",
    "translation_bundle": f"""WITH {_FACTS}, m(path, family_id) AS (VALUES ('part', 'A'), ('part', 'B'), ('customer', 'A'), ('supplier', 'B')), vc AS (SELECT upper(name) AS variable, count(DISTINCT family_id) AS fc FROM typed LEFT JOIN m USING (path) GROUP BY 1),
        six AS (SELECT path, name, string_agg(v, ', ' ORDER BY r) AS samp FROM ranked WHERE r <= 6 AND v IS NOT NULL GROUP BY 1, 2), f AS (SELECT family_id, path, upper(name) AS name, fc, '- ' || upper(name) || ' | ' || primitive_type || ' | shared=' || fc || ' | sig= | samp=' || samp AS line FROM m JOIN typed USING (path) JOIN six USING (path, name) JOIN vc ON vc.variable = upper(name)),
        t AS (SELECT family_id, count(*) AS n, string_agg(line, chr(10) ORDER BY fc DESC, name, path) AS lines FROM f GROUP BY 1), h AS (SELECT family_id, count(*) AS files, min(path) AS prefix, string_agg('- ' || CAST(CAST(length(path) AS DOUBLE) AS VARCHAR) || ' https://example.org/' || path, chr(10) ORDER BY length(path) DESC, path) AS docs FROM m GROUP BY 1)
        SELECT family_id, CAST(n AS INTEGER) AS n_fields, 'FAMILY ' || family_id || chr(10) || 'SYSTEM UNKNOWN' || chr(10) || 'PREFIX ' || prefix || chr(10) || 'FILES ' || files || chr(10) || chr(10) || 'DOCS' || chr(10) || docs || chr(10) || chr(10) || 'FIELDS' || chr(10) || lines || chr(10) || chr(10) || 'Return grammar only.' AS text FROM t JOIN h USING (family_id)""",
    "document_registry": """WITH q AS (SELECT DISTINCT regexp_extract(url, '^[a-z]+://([^/]+)', 1) AS family_id, url, 'page' || page_id AS filename, regexp_replace(url, '^[a-z]+://[^/]*/?', '') AS whole, regexp_extract(url, '([^/]*)/*$', 1) AS last FROM pages),
        l AS (SELECT 'page' || page_id AS p FROM pages WHERE page_id % 3 = 0 UNION SELECT regexp_replace(url, '^[a-z]+://[^/]*/?', '') FROM pages WHERE page_id % 3 = 1)
        SELECT family_id, url, filename, CASE WHEN filename IN (SELECT p FROM l) THEN filename WHEN whole IN (SELECT p FROM l) THEN whole WHEN last IN (SELECT p FROM l) THEN last END AS local_path FROM q""",
    "request_shards": """WITH r AS (SELECT CAST(c_nationkey AS BIGINT) AS aggregate_id, list_sort(list(c_custkey)) AS ls, CASE WHEN c_nationkey % 2 = 0 THEN range(1, 31) ELSE [] END AS ps FROM customer GROUP BY c_nationkey),
        x AS (SELECT aggregate_id, ls, ps, unnest(range(0, greatest(len(ls), 1), 25)) AS a FROM r), y AS (SELECT *, unnest(range(0, greatest(len(ps), 1), 12)) AS b FROM x)
        SELECT aggregate_id, '93' AS variable_id, CAST(a // 25 AS INTEGER) AS locality_shard, CAST(b // 12 AS INTEGER) AS period_shard, array_to_string(ls[a + 1:a + 25], ',') AS localities, coalesce(array_to_string(ps[b + 1:b + 12], ','), '') AS periods FROM y""",
    "national_coverage": """SELECT CAST(c_nationkey AS BIGINT) AS agregado_id, count(*) FILTER (WHERE left(o_orderpriority, 1) = '1') AS localities, count(*) FILTER (WHERE left(o_orderpriority, 1) = '1') >= 120 AS covers_national FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1""",
    "catalog_candidates": "SELECT p_partkey AS agregado_id, p_partkey || chr(10) || p_name || chr(10) || p_brand || chr(10) || p_type AS text FROM part WHERE contains(lower(p_type), 'prom') AND contains(replace(lower(p_brand), '#', ' '), 'brand 1')",
    "observable_forms": """SELECT l_orderkey, l_linenumber, round(CASE WHEN l_discount > 0 THEN ln(l_discount) END, 9) AS log, round(ln(1 + l_discount), 9) AS log1p, round(sqrt(l_discount), 9) AS sqrt, round(CASE WHEN l_discount > 0 AND l_discount < 1 THEN ln(l_discount / (1 - l_discount)) END, 9) AS logit, round(sign(l_discount) * ln(1 + abs(l_discount)), 9) AS signed_log FROM lineitem""",
    "observable_templates": """WITH q AS (SELECT quantile_cont(o_totalprice, 0.25) AS a, quantile_cont(o_totalprice, 0.5) AS b, quantile_cont(o_totalprice, 0.75) AS c FROM orders)
        SELECT o_orderpriority, count(*) AS n, round(avg(o_totalprice), 4) AS mean, round(var_samp(o_totalprice), 0) AS variance, round(avg(CAST(o_totalprice <= a AS INTEGER)), 9) AS bin_1, round(avg(CAST(o_totalprice > a AND o_totalprice <= b AS INTEGER)), 9) AS bin_2, round(avg(CAST(o_totalprice > b AND o_totalprice <= c AS INTEGER)), 9) AS bin_3, round(avg(CAST(o_totalprice > c AS INTEGER)), 9) AS bin_4 FROM orders, q GROUP BY 1""",
    "observable_lags": """WITH n AS (SELECT o_orderpriority, o_orderstatus, CAST(year(o_orderdate) * 12 + month(o_orderdate) AS INTEGER) AS month, count(*) AS n FROM orders GROUP BY 1, 2, 3)
        SELECT x.*, y.n AS lag_1, z.n AS lag_12 FROM n x LEFT JOIN n y ON y.o_orderpriority = x.o_orderpriority AND y.o_orderstatus = x.o_orderstatus AND y.month = x.month - 1 LEFT JOIN n z ON z.o_orderpriority = x.o_orderpriority AND z.o_orderstatus = x.o_orderstatus AND z.month = x.month - 12""",
    "latest_orders": "SELECT o_custkey, o_orderkey, CAST(r AS INTEGER) AS recency FROM (SELECT o_custkey, o_orderkey, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS r FROM orders) WHERE r <= 3",
    "table_overview": f"WITH {_FACTS} SELECT path, count(*) AS fields, max(non_null + nulls) AS rows, round(sum(nulls) / sum(non_null + nulls), 9) AS missing_share FROM facts GROUP BY 1",
    "vector_cosines": """SELECT x.vec_id AS a, y.vec_id AS b, round(list_cosine_similarity(CAST(x.embedding AS DOUBLE[]), CAST(y.embedding AS DOUBLE[])), 6) AS cosine FROM embeddings x JOIN embeddings y ON y.vec_id = x.vec_id + 1""",
    "value_frequencies": "SELECT p_type, p_brand, n, CAST(r AS INTEGER) AS rank FROM (SELECT p_type, p_brand, count(*) AS n, row_number() OVER (PARTITION BY p_type ORDER BY count(*) DESC, p_brand) AS r FROM part GROUP BY 1, 2) WHERE r <= 5",
    "family_schemas": f"""WITH m(path, family_id) AS (VALUES ('part', 'A'), ('part', 'B'), ('customer', 'A'), ('supplier', 'B')), s(path, names, n) AS (VALUES {_SIG})
        SELECT family_id, string_agg(left(sha1(names), 16), ',' ORDER BY left(sha1(names), 16)) AS schema_signatures FROM m JOIN s USING (path) GROUP BY 1""",
    "series_by_system": f"{_LOGICAL} SELECT sys AS system, string_agg(DISTINCT prefix, ',' ORDER BY prefix) AS series, count(DISTINCT prefix) AS n_series FROM i GROUP BY 1",
}
