"""Whole family records and the reports drawn from them; logical families by system."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import corpus as c
from ..operators import logical as l
from ..operators import records as r
from ..operators.graph import cut
from .common import MANIFEST_SQL, UF_LIST, manifest
from .corpus import _BACK, _FAMILIES, _FAMILY, _ORD, _PERIOD, _PRIMARY, _SHOW, _SYSTEM
from .more import _LOGICAL, SQL as LOGICAL_SQL, _files as _logical_files
from .profile import SQL as PROFILE_SQL, _sets

CODES = ["missing_periods", "state_panel_fragmented", "minor_panel_defects", "state_panel_incomplete", "incomplete_statewide_coverage", "national_series_gaps", "partition_unresolved", "no_associated_docs", "docs_generic_only"]


def _inventory(spark, d):
    return cut(c.inventory(manifest(spark, d)))


def _joined(*names):
    return [F.array_join(k, ",").alias(k.rsplit(".", 1)[-1]) for k in names]


def family_record(spark, d):
    rec = r.family_records(_inventory(spark, d))
    series = F.col("preferred_working_series")
    meanings = F.array_join(F.transform(F.array_sort(F.map_entries("path_semantics")), lambda e: F.concat(e["key"], F.lit("="), e["value"])), ";")
    return rec.select(
        "family_id", "system_guess", "partition_type", "date_format", "time_range_display", "file_count", *_joined("source_systems", "source_paths", "geo_coverage", "primary_extensions", "format_families"), meanings.alias("path_semantics"),
        F.md5(F.array_join("member_files", ",").cast("binary")).alias("member_files"), series["strategy"].alias("strategy"), *_joined("preferred_working_series.coverage_gaps"), series["selected_file_count"].alias("selected_file_count"),
        F.md5(F.array_join(series["selected_files"], ",").cast("binary")).alias("selected_files"), series["segment_count"].alias("segment_count"), F.size("associated_docs").alias("doc_count"), F.size("schema_signatures").alias("signatures"),
    )


def family_compact(spark, d):
    rec = r.compact_records(r.family_records(_inventory(spark, d)))
    return rec.select("family_id", "file_count", "source_path_count", "geo_coverage_count", *_joined("geo_coverage"), "physical_variant_count", "associated_doc_count", F.col("preferred_working_series.gap_count").alias("gap_count"), F.col("preferred_working_series.segment_count").alias("segment_count"), *_joined("issues"))


def _aside(files):
    """Files of one state put aside, as if their directories were auxiliary."""
    return files.withColumn("path_type", F.when(F.col("geo_code") == "AC", "Auxiliary").otherwise(F.col("path_type")))


def family_overview(spark, d):
    files = _inventory(spark, d)
    return r.overview(_aside(files), cut(r.family_records(files))).withColumn("listed", F.array_join("listed", ","))


def family_audit_rows(spark, d):
    told = r.record_audit(r.family_records(_inventory(spark, d)))
    each = lambda k: F.array_join(F.transform("issues", lambda i: i[k]), "|").alias(k)
    return told.select("family_id", "issue_count", each("code"), each("severity"), each("summary"), F.array_join("recommendations", "|").alias("recommendations"))


def family_candidates(spark, d):
    """Candidate files of each family, from its working series or, where that is taken away, from its members."""
    files = _inventory(spark, d)
    rec = cut(r.family_records(files))
    bare = rec.withColumn("preferred_working_series", F.lit(None).cast(rec.schema["preferred_working_series"].dataType)).withColumn("family_id", F.concat("family_id", F.lit("-bare")))
    chosen, _ = r.select_candidates(files, rec.unionByName(bare))
    return chosen.where("selection_rank = 1").select("family_id", "path", "selection_rank")


def similarity_clusters(spark, d):
    _, clusters = r.similarity_report(_sets(spark, d), "l_orderkey", "item", 0.7, 0.6)
    return clusters


def _audited(spark, d):
    found = cut(l.families(cut(_logical_files(spark, d))))
    tier = F.element_at(F.array(F.lit("family_specific"), F.lit("system_generic")), F.length("family_id") % 3)
    return l.graded_audit(found, found.where(F.length("family_id") % 3 > 0).select("family_id", tier.alias("tier")))


def missing_states(spark, d):
    told = l.missing_states(_logical_files(spark, d))
    return told.withColumn("top_missing", F.array_join(F.transform("top_missing", lambda e: F.concat_ws(":", e["state"], e["n"].cast("string"))), ","))


def gap_detail(spark, d):
    told = l.gap_detail(_logical_files(spark, d), 3)
    shown = F.array_join(F.transform("partial_panel_examples", lambda e: F.concat(e["period"], F.lit(":"), e["territory_count"].cast("string"), F.lit(":"), F.array_join(e["missing"], "/"))), ",")
    return told.select("family_id", "missing_period_count", F.array_join("missing_period_ranges", ",").alias("missing_period_ranges"), shown.alias("partial_panel_examples"))


def system_rollup(spark, d):
    return l.system_rollup(_audited(spark, d))


def system_issue_matrix(spark, d):
    return l.issue_matrix(_audited(spark, d), CODES)


def worst_families(spark, d):
    return l.worst_families(_audited(spark, d), 3)


QUERIES = {f.__name__: f for f in (family_record, family_compact, family_overview, family_audit_rows, family_candidates, similarity_clusters, missing_states, gap_detail, system_rollup, system_issue_matrix, worst_families)}

_RECORDS = f"""WITH RECURSIVE {MANIFEST_SQL}, v AS (SELECT *, {_PERIOD} AS period, {_PRIMARY} AS pe, {_FAMILY} AS fam, {_SYSTEM} AS sys FROM manifest), {_FAMILIES},
    fm AS (SELECT v.*, fam.family_id AS fid FROM v JOIN cl ON cl.id = v.sys || '|' || v.prefix JOIN fam ON fam.prefix = v.prefix AND fam.c = cl.c),
    dirs AS (SELECT fid, directory, max(period) AS own, max(max(period)) OVER (PARTITION BY fid) AS top FROM fm GROUP BY 1, 2),
    m AS (SELECT fm.*, CASE WHEN directory LIKE '%PRELIM%' THEN '[Staging]' WHEN top - own > CASE WHEN prefix = 'SMALL' THEN 5 ELSE 500 END THEN '[Legacy Archive]' ELSE '[Primary]' END AS sem FROM fm JOIN dirs USING (fid, directory)),
    k AS (SELECT *, row_number() OVER (PARTITION BY fid, period ORDER BY CASE pe WHEN '.json' THEN 0 WHEN '.csv' THEN 3 ELSE 5 END, CASE sem WHEN '[Primary]' THEN 0 WHEN '[Legacy Archive]' THEN 1 ELSE 2 END, sys, directory, path) AS r FROM m), chosen AS (SELECT *, {_ORD.format('period')} AS n FROM k WHERE r = 1),
    f AS (SELECT *, CASE WHEN lag(n) OVER w + 1 = n AND lag(pe) OVER w = pe AND lag(fam) OVER w = fam AND lag(sys) OVER w = sys AND lag(sem) OVER w = sem THEN 0 ELSE 1 END AS new FROM chosen WINDOW w AS (PARTITION BY fid ORDER BY period)),
    series AS (SELECT fid, prefix, count(*) AS files, md5(string_agg(path, ',' ORDER BY period)) AS selected, CAST(sum(new) AS INTEGER) AS segments, count(DISTINCT pe) AS kinds, list_sort(list(DISTINCT CASE pe WHEN '.json' THEN '0.json' WHEN '.csv' THEN '3.csv' ELSE '5.dbc' END)) AS e FROM f GROUP BY 1, 2),
    due AS (SELECT fid, prefix, unnest(range(min(n), max(n) + 1)) AS n FROM chosen GROUP BY 1, 2), gaps AS (SELECT fid, count(*) AS g, string_agg({_BACK}, ',' ORDER BY n) AS gaps FROM due ANTI JOIN chosen USING (fid, n) GROUP BY 1),
    meant AS (SELECT fid, string_agg(directory || '=' || sem, ';' ORDER BY directory) AS path_semantics FROM (SELECT DISTINCT fid, directory, sem FROM m) GROUP BY 1),
    lists AS (SELECT fid, md5(string_agg(path, ',' ORDER BY path)) AS members, string_agg(DISTINCT sys, ',' ORDER BY sys) AS sysn, string_agg(DISTINCT directory, ',' ORDER BY directory) AS dirs, count(DISTINCT directory) AS n_dirs, list_sort(list(DISTINCT geo)) AS geos,
      array_to_string(list_transform(list_sort(list(DISTINCT CASE pe WHEN '.json' THEN '0.json' WHEN '.csv' THEN '3.csv' ELSE '5.dbc' END)), lambda x: substr(x, 2)), ',') AS exts, string_agg(DISTINCT fam, ',' ORDER BY fam) AS fams FROM fm GROUP BY 1),
    rec AS (SELECT fam.*, lists.*, series.files, series.selected, series.segments, series.kinds, series.e, coalesce(g, 0) AS g, coalesce(gaps, '') AS gaps, path_semantics FROM fam JOIN lists ON lists.fid = family_id JOIN series ON series.fid = family_id LEFT JOIN gaps ON gaps.fid = family_id JOIN meant ON meant.fid = family_id)"""
_SPAN = f"{_SHOW.format('a')} || CASE WHEN a = b THEN '' ELSE ' to ' || {_SHOW.format('b')} END"
_SAY = {
    "coverage_gaps": "g > 0", "stitched_preferred_working_series": "kinds > 1", "incomplete": "g > 0", "unknown_partition_type": "pt = 'Unknown'", "missing_date_format": "df IS NULL", "multi_source_system_family": "sysn LIKE '%,%'", "no_associated_docs": "true",
}


def _said(texts):
    return "concat_ws('|', " + ", ".join(f"CASE WHEN {_SAY[k]} THEN {t} END" for k, t in texts.items()) + ")"


_LABEL = "CASE kind WHEN 'yy' THEN CAST({0} AS VARCHAR) ELSE strftime(make_date(CAST(({0} - 1) // 12 AS BIGINT), CAST(({0} - 1) % 12 + 1 AS BIGINT), 1), '%b %Y') END"
_AUDIT = LOGICAL_SQL["logical_families"]
_EACH = f"a AS ({_AUDIT}), b AS (SELECT *, split_part(family_id, ':', 1) AS system, CASE WHEN issues = '' THEN [] ELSE list_transform(string_split(issues, ','), lambda i: split_part(i, ':', 1)) END AS codes FROM a)"
_SECTIONS = {
    "families": ["'all'", "CASE WHEN g > 0 THEN 'with_gaps' END", "'without_docs'", "'suspicious'"], "partition": ["pt"], "date_format": ["df"], "system_shape": ["CASE WHEN sysn LIKE '%,%' THEN 'multi_system' ELSE 'single_system' END"],
    "strategy": ["CASE WHEN kinds > 1 THEN 'stitched' ELSE 'single_format' END"],
}
SQL = {
    "family_record": f"""{_RECORDS} SELECT family_id, sys AS system_guess, pt AS partition_type, df AS date_format, {_SPAN} AS time_range_display, n AS file_count, sysn AS source_systems, dirs AS source_paths, array_to_string(geos, ',') AS geo_coverage, exts AS primary_extensions, fams AS format_families,
        path_semantics, members AS member_files, CASE WHEN kinds > 1 THEN 'stitched' ELSE 'single_format' END AS strategy, gaps AS coverage_gaps, files AS selected_file_count, selected AS selected_files, segments AS segment_count, 0 AS doc_count, 0 AS signatures FROM rec""",
    "family_compact": f"""{_RECORDS} SELECT family_id, n AS file_count, CAST(n_dirs AS INTEGER) AS source_path_count, CAST(len(geos) AS INTEGER) AS geo_coverage_count, array_to_string(geos[1:10], ',') AS geo_coverage, CAST(len(string_split(sysn, ',')) AS INTEGER) AS physical_variant_count, 0 AS associated_doc_count, CAST(g AS INTEGER) AS gap_count, segments AS segment_count,
        concat_ws(',', CASE WHEN sysn LIKE '%,%' THEN 'multi_source_system_family' END, CASE WHEN pt = 'Unknown' THEN 'unknown_partition_type' END, 'no_associated_docs', CASE WHEN kinds > 1 THEN 'stitched_preferred_working_series' END, CASE WHEN g > 0 THEN 'coverage_gaps' END) AS issues FROM rec""",
    "family_overview": f"""{_RECORDS}, s AS ("""
    + " UNION ALL ".join(f"SELECT '{k}' AS section, {x} AS item, family_id AS what, 100 AS most FROM rec" for k, xs in _SECTIONS.items() for x in xs)
    + """ UNION ALL SELECT 'preferred_extension', substr(unnest(e), 2), family_id, 100 FROM rec UNION ALL SELECT CASE geo WHEN 'AC' THEN 'discarded' ELSE 'files' END, CASE geo WHEN 'AC' THEN 'auxiliary_path' ELSE 'eligible' END, path, CASE geo WHEN 'AC' THEN 25 ELSE 0 END FROM manifest),
        o AS (SELECT *, row_number() OVER (PARTITION BY section, item ORDER BY what) AS nth FROM s WHERE item IS NOT NULL)
        SELECT section, item, count(*) AS n, coalesce(string_agg(what, ',' ORDER BY what) FILTER (WHERE nth <= most), '') AS listed FROM o GROUP BY 1, 2 UNION ALL (SELECT 'largest', family_id, n, '' FROM rec ORDER BY n DESC, family_id LIMIT 50)""",
    "family_audit_rows": f"""{_RECORDS} SELECT family_id, CAST(len(string_split(codes, '|')) AS INTEGER) AS issue_count, codes AS code, severity, summary, recommendations FROM (SELECT family_id, {_said({k: f"'{k}'" for k in r.ISSUES})} AS codes, {_said({k: f"'{v[0]}'" for k, v in r.ISSUES.items()})} AS severity,
        {_said({k: "replace('" + v[1] + "', '{}', CAST(g AS VARCHAR))" for k, v in r.ISSUES.items()})} AS summary, {_said({"coverage_gaps": f"'{r.ISSUES['coverage_gaps'][2]}'", "stitched_preferred_working_series": f"'{r.ISSUES['stitched_preferred_working_series'][2]}'", "incomplete": f"'{r.INCOMPLETE}'"} | {k: f"'{v[2]}'" for k, v in list(r.ISSUES.items())[2:]})} AS recommendations FROM rec)""",
    "family_candidates": f"""{_RECORDS}, x AS (SELECT fid AS family_id, chosen.path, geo, period, sem FROM chosen UNION ALL SELECT fid || '-bare', path, geo, period, sem FROM m), y AS (SELECT x.*, pt FROM x JOIN fam ON fam.family_id = replace(x.family_id, '-bare', '')),
        z AS (SELECT *, pt = 'Mixed-Partition' AND bool_or(geo = 'BR') OVER (PARTITION BY family_id) AS started FROM y),
        o AS (SELECT *, row_number() OVER (PARTITION BY family_id ORDER BY (started AND geo = 'BR') DESC, period DESC, CASE sem WHEN '[Primary]' THEN 2 WHEN '[Legacy Archive]' THEN 1 ELSE 0 END DESC, (pt <> 'State-Partitioned' AND geo = 'BR') DESC, regexp_extract(path, '[^/]*$') DESC, path DESC) AS nth FROM z)
        SELECT family_id, path, 1 AS selection_rank FROM o WHERE nth = 1""",
    "similarity_clusters": f"WITH c AS ({PROFILE_SQL['components']}) SELECT 'family_cluster_' || dense_rank() OVER (ORDER BY component) AS cluster_id, node AS item FROM c",
    "missing_states": f"""{_LOGICAL}, q AS (SELECT sys || ':' || pre AS family_id, period, list_intersect(list(DISTINCT geo), {UF_LIST}) AS have FROM d GROUP BY sys, pre, period), w AS (SELECT * FROM q WHERE len(have) BETWEEN 1 AND 26),
        t AS (SELECT family_id, state, count(*) AS n FROM (SELECT family_id, unnest(list_filter({UF_LIST}, lambda u: NOT list_contains(have, u))) AS state FROM w) GROUP BY 1, 2), o AS (SELECT *, row_number() OVER (PARTITION BY family_id ORDER BY n DESC, state) AS nth FROM t),
        s AS (SELECT family_id, string_agg(state || ':' || n, ',' ORDER BY nth) AS top_missing FROM o WHERE nth <= 12 GROUP BY 1)
        SELECT family_id, count(*) AS partial_panels, CAST(min(len(have)) AS INTEGER) AS least_places, CAST(max(len(have)) AS INTEGER) AS most_places, top_missing FROM w JOIN s USING (family_id) GROUP BY family_id, top_missing""",
    "gap_detail": f"""{_LOGICAL}, q AS (SELECT sys || ':' || pre AS family_id, kind, period, CASE kind WHEN 'yy' THEN period // 100 ELSE period // 100 * 12 + period % 100 END AS n, list_filter({UF_LIST}, lambda u: list_contains(list(DISTINCT geo), u)) AS have FROM d GROUP BY sys, pre, kind, period),
        k AS (SELECT *, bool_or(len(have) > 0) OVER (PARTITION BY family_id) AS panel FROM q), due AS (SELECT family_id, any_value(kind) AS kind, unnest(range(min(n), max(n) + 1)) AS n FROM k GROUP BY 1),
        gone AS (SELECT *, n - row_number() OVER (PARTITION BY family_id ORDER BY n) AS run FROM due ANTI JOIN (SELECT family_id, n FROM k WHERE NOT panel OR len(have) > 0) USING (family_id, n)),
        r AS (SELECT family_id, kind, run, min(n) AS lo, max(n) AS hi, count(*) AS c FROM gone GROUP BY 1, 2, 3),
        s AS (SELECT family_id, lo, hi, c, {_LABEL.format('lo')} AS x, {_LABEL.format('hi')} AS y FROM r), m AS (SELECT family_id, CAST(sum(c) AS BIGINT) AS missing_period_count, string_agg(CASE WHEN lo = hi THEN x ELSE x || ' to ' || y END, ',' ORDER BY lo) AS missing_period_ranges FROM s GROUP BY 1),
        e AS (SELECT *, row_number() OVER (PARTITION BY family_id ORDER BY period) AS nth FROM k WHERE len(have) BETWEEN 1 AND 26),
        o AS (SELECT family_id, string_agg({_LABEL.format('n')} || ':' || len(have) || ':' || array_to_string(list_filter({UF_LIST}, lambda u: NOT list_contains(have, u)), '/'), ',' ORDER BY period) AS partial_panel_examples FROM e WHERE nth <= 3 GROUP BY 1)
        SELECT family_id, missing_period_count, missing_period_ranges, partial_panel_examples FROM m FULL JOIN o USING (family_id)""",
    "system_rollup": f"""WITH {_EACH}, s AS (SELECT system, 'families' AS section, 'all' AS item FROM b UNION ALL SELECT system, 'families', 'problem' FROM b WHERE len(codes) > 0 UNION ALL SELECT system, 'partition_type', partition_type FROM b UNION ALL SELECT system, 'coverage_status', coverage_status FROM b
        UNION ALL SELECT system, 'date_kind', date_kind FROM b UNION ALL SELECT system, 'issue', unnest(codes) FROM b) SELECT system, section, item, count(*) AS n FROM s GROUP BY 1, 2, 3""",
    "system_issue_matrix": f"WITH {_EACH} SELECT system, " + ", ".join(f"count(*) FILTER (WHERE list_contains(codes, '{k}')) AS {k}" for k in CODES) + " FROM b GROUP BY 1",
    "worst_families": f"WITH {_EACH}, o AS (SELECT system, family_id, CAST(len(codes) AS INTEGER) AS issues, CAST(row_number() OVER (PARTITION BY system ORDER BY len(codes) DESC, family_id) AS INTEGER) AS rank FROM b WHERE len(codes) > 0) SELECT * FROM o WHERE rank <= 3",
}
