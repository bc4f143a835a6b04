"""Whole records of dataset families, and the reports drawn from them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import paths as p
from . import corpus as c
from .docs import associate
from .graph import connected_components, cut
from .intervals import PART, in_ranges, running
from .profile import jaccard_pairs

# Issues with their severity, what they say, and what to do about them; lengths of lists.
ISSUES = {
    "coverage_gaps": ("warning", "preferred working series has {} uncovered period(s)", "inspect the uncovered periods and decide whether additional legacy/open-data files should be admitted into preferred_working_series"),
    "stitched_preferred_working_series": ("info", "preferred working series is composed of multiple segments", "verify that stitched segments are expected and not caused by avoidable grouping or format-selection mistakes"),
    "unknown_partition_type": ("warning", "family partition type could not be confidently classified", "inspect geo coverage and filename pattern extraction for this family"),
    "missing_date_format": ("warning", "family date format could not be inferred", "inspect date code extraction and filename pattern logic for this family"),
    "multi_source_system_family": ("info", "family spans multiple source systems or FTP roots", "confirm that all physical variants are truly the same logical series and not an over-merge"),
    "no_associated_docs": ("info", "family has no associated documentation PDFs", "check PDF audit output for nearby orphaned documentation under the same endpoint"),
}
INCOMPLETE = "inspect preferred_working_series.coverage_gaps and physical_variants together before downstream downloads/profiling"
COMPACT_ORDER = ["multi_source_system_family", "unknown_partition_type", "missing_date_format", "no_associated_docs", "stitched_preferred_working_series", "coverage_gaps"]
SAMPLES, LARGEST, LISTED = 25, 50, 100


def family_members(files: DataFrame, families_: DataFrame) -> DataFrame:
    """``family_id`` beside each file of an inventory that is in a family: its prefix and system are those of one of the family's groups."""
    groups = families_.select("family_id", F.col("series_prefix").alias("_prefix"), F.explode("physical_variants").alias("_v")).select("family_id", "_prefix", F.col("_v.system_guess").alias("_system"))
    eligible = c.with_discard_reason(files).where("discard_reason is null").drop("discard_reason")
    return eligible.join(groups, (F.col("series_prefix") == F.col("_prefix")) & (F.coalesce("system_guess", F.lit("")) == F.col("_system"))).drop("_prefix", "_system")


def family_records(files: DataFrame, signatures: DataFrame | None = None) -> DataFrame:
    """One row a family of an inventory, with all that is known of it.

    Beside the columns of ``families``: ``member_files, primary_extensions, path_semantics`` (a map of directories),
    ``preferred_working_series`` (a struct, see ``working_series``), ``associated_docs`` (``url, filename, score``, best first; the PDFs among
    ``files``) and ``schema_signatures`` of the member files, from ``signatures`` (``path, schema_signature``). Files and families are
    written once; every list is gathered by family in a pass of its own and joined.
    """
    files = cut(files)
    found = cut(c.families(files))
    key = ["family_id"]
    own = cut(c.with_path_semantic(cut(c.dated(family_members(files, found), key)), key))
    lists = own.groupBy(*key).agg(F.sort_array(F.collect_set("path")).alias("member_files"), c.by_extension(F.collect_set("primary_extension")).alias("primary_extensions"))
    meanings = own.where("path_semantic is not null").groupBy(*key, "directory").agg(F.first("path_semantic").alias("m")).groupBy(*key).agg(F.map_from_entries(F.sort_array(F.collect_list(F.struct("directory", "m")))).alias("path_semantics"))
    series = c.working_series(own, key)
    series = series.select("family_id", F.struct(*[k for k in series.columns if k != "family_id"]).alias("preferred_working_series"))
    near = associate(found.select(F.col("family_id").alias("series"), F.col("series_prefix").alias("name"), F.explode("source_paths").alias("source_path")), files.select(F.col("path").alias("url")))
    doc = F.struct((-F.col("score")).alias("_low"), "url", p.file_name(F.col("url")).alias("filename"), "score")
    docs = near.groupBy(F.col("series").alias("family_id")).agg(F.transform(F.sort_array(F.collect_list(doc)), lambda d: F.struct(d["url"].alias("url"), d["filename"].alias("filename"), d["score"].alias("score"))).alias("associated_docs"))
    out = found.join(lists, key, "left").join(meanings, key, "left").join(series, key, "left").join(docs, key, "left")
    if signatures is None:
        out = out.withColumn("schema_signatures", F.array().cast("array<string>"))
    else:
        told = own.select("family_id", "path").distinct().join(signatures.where("schema_signature != ''").select("path", "schema_signature"), "path").groupBy(*key).agg(F.sort_array(F.collect_set("schema_signature")).alias("schema_signatures"))
        out = out.join(told, key, "left").withColumn("schema_signatures", F.coalesce("schema_signatures", F.array().cast("array<string>")))
    return out.withColumn("associated_docs", F.coalesce("associated_docs", F.array().cast("array<struct<url:string,filename:string,score:double>>")))


def issue_codes(families_: DataFrame, order: list[str] | None = None) -> Column:
    """Codes of a record's issues, in the order of ``ISSUES`` or another one."""
    series = F.col("preferred_working_series")
    when = {
        "coverage_gaps": F.size(series["coverage_gaps"]) > 0, "stitched_preferred_working_series": series["strategy"] == "stitched", "unknown_partition_type": F.col("partition_type") == "Unknown",
        "missing_date_format": F.col("date_format").isNull(), "multi_source_system_family": (F.col("system_guess") == "MULTI") | (F.size("source_systems") > 1), "no_associated_docs": F.size("associated_docs") == 0,
    }
    return F.array_compact(F.array(*[F.when(F.coalesce(when[k], F.lit(False)), k) for k in order or ISSUES]))


def compact_records(records: DataFrame) -> DataFrame:
    """Records with counts for their lists: what a report of many families shows."""
    series = F.col("preferred_working_series")
    told = F.struct(series["strategy"].alias("strategy"), series["coverage_complete"].alias("coverage_complete"), F.size(series["coverage_gaps"]).alias("gap_count"), series["selected_file_count"].alias("selected_file_count"), series["selected_primary_extensions"].alias("selected_primary_extensions"), series["segment_count"].alias("segment_count"))
    return records.select(
        "family_id", "series_prefix", "system_guess", "source_systems", "partition_type", "date_format", "time_range_display", "file_count", F.size("source_paths").alias("source_path_count"), F.size("geo_coverage").alias("geo_coverage_count"),
        F.slice("geo_coverage", 1, 10).alias("geo_coverage"), "format_families", "primary_extensions", F.size("physical_variants").alias("physical_variant_count"), F.size("associated_docs").alias("associated_doc_count"), told.alias("preferred_working_series"), issue_codes(records, COMPACT_ORDER).alias("issues"),
    )


def record_audit(records: DataFrame) -> DataFrame:
    """``family_id, issue_count, issues`` (``code, severity, summary, detail``: a map of what bears on it) and ``recommendations``."""
    gaps = F.col("preferred_working_series.coverage_gaps")
    shown = {
        "coverage_gaps": {"gaps": F.array_join(gaps, ","), "gap_count": F.size(gaps).cast("string"), "strategy": F.col("preferred_working_series.strategy"), "segment_count": F.col("preferred_working_series.segment_count").cast("string")},
        "stitched_preferred_working_series": {"segment_count": F.col("preferred_working_series.segment_count").cast("string"), "selected_primary_extensions": F.array_join("preferred_working_series.selected_primary_extensions", ",")},
        "unknown_partition_type": {"geo_coverage": F.array_join("geo_coverage", ","), "geo_coverage_count": F.size("geo_coverage").cast("string")},
        "missing_date_format": {"time_range_display": F.col("time_range_display")},
        "multi_source_system_family": {"source_systems": F.array_join("source_systems", ","), "physical_variant_count": F.size("physical_variants").cast("string")},
        "no_associated_docs": {"source_paths": F.array_join("source_paths", ",")},
    }
    codes = issue_codes(records)
    has = {k: F.array_contains(codes, k) for k in ISSUES}
    issues, advice = [], []
    for k, (severity, said, do) in ISSUES.items():
        detail = F.create_map(*[x for name, value in shown[k].items() for x in (F.lit(name), value)])
        summary = F.replace(F.lit(said), F.lit("{}"), F.size(gaps).cast("string")) if "{}" in said else F.lit(said)
        issues.append(F.when(has[k], F.struct(F.lit(k).alias("code"), F.lit(severity).alias("severity"), summary.alias("summary"), detail.alias("detail"))))
        advice.append(F.when(has[k], do))
        if k == "stitched_preferred_working_series":
            advice.append(F.when(~F.coalesce("preferred_working_series.coverage_complete", F.lit(True)), INCOMPLETE))
    told = records.select("family_id", F.array_compact(F.array(*issues)).alias("issues"), F.array_compact(F.array(*advice)).alias("recommendations"))
    return told.select("family_id", F.size("issues").alias("issue_count"), "issues", "recommendations")


def overview(files: DataFrame, records: DataFrame) -> DataFrame:
    """``section, item, n, listed``: an inventory and its families in numbers, each with the first of what it counts.

    ``discarded`` by reason lists 25 paths; ``orphan_docs`` 100 documents that no family has; ``largest`` has a row for each of the 50
    families with most files; all other sections list 100 families. Every family says all its sections in one pass.
    """
    rows = compact_records(records)
    series = F.col("preferred_working_series")
    said = lambda section, item, when=None: F.when(F.lit(True) if when is None else when, F.struct(F.lit(section).alias("section"), item.alias("item")))
    all_ = [
        said("families", F.lit("all")), said("partition", F.coalesce("partition_type", F.lit("Unknown"))), said("date_format", F.coalesce("date_format", F.lit("None"))),
        said("system_shape", F.when(F.size("source_systems") <= 1, "single_system").otherwise("multi_system")), said("strategy", F.coalesce(series["strategy"], F.lit("none"))),
        said("families", F.lit("with_gaps"), series["gap_count"] > 0), said("families", F.lit("without_docs"), F.col("associated_doc_count") == 0), said("families", F.lit("suspicious"), F.size("issues") > 0),
    ]
    kept = F.transform(F.coalesce(series["selected_primary_extensions"], F.array().cast("array<string>")), lambda e: F.struct(F.lit("preferred_extension").alias("section"), e.alias("item")))
    each = rows.select(F.col("family_id").alias("what"), F.explode(F.concat(F.array_compact(F.array(*all_)), kept)).alias("s")).select("s.section", "s.item", "what", F.lit(LISTED).alias("most"))
    inventory = cut(c.with_discard_reason(files).select("path", "discard_reason", "extension"))
    fate = inventory.select(F.when(F.col("discard_reason").isNull(), "files").otherwise("discarded").alias("section"), F.coalesce("discard_reason", F.lit("eligible")).alias("item"), F.col("path").alias("what"), F.when(F.col("discard_reason").isNull(), 0).otherwise(SAMPLES).alias("most"))
    matched = records.select(F.explode("associated_docs").alias("d")).select(F.col("d.url").alias("path")).distinct()
    orphans = inventory.where("extension = '.pdf'").select("path").distinct().join(matched, "path", "left_anti").select(F.lit("orphan_docs").alias("section"), F.lit("all").alias("item"), F.col("path").alias("what"), F.lit(LISTED).alias("most"))
    every = each.unionByName(fate).unionByName(orphans)
    n = every.groupBy("section", "item").agg(F.count(F.lit(1)).alias("n"))
    nth = F.row_number().over(Window.partitionBy("section", "item").orderBy("what"))
    first = every.withColumn("_r", nth).where(F.col("_r") <= LISTED).where(F.col("_r") <= F.col("most")).groupBy("section", "item").agg(F.sort_array(F.collect_list("what")).alias("listed"))
    counted = n.join(first, ["section", "item"], "left").withColumn("listed", F.coalesce("listed", F.array().cast("array<string>")))
    large = rows.select("family_id", "file_count").orderBy(F.desc("file_count"), "family_id").limit(LARGEST)
    return counted.unionByName(large.select(F.lit("largest").alias("section"), F.col("family_id").alias("item"), F.col("file_count").alias("n"), F.array().cast("array<string>").alias("listed")))


def select_candidates(files: DataFrame, records: DataFrame, per_family: int = 3, per_docs: int = 5) -> tuple[DataFrame, DataFrame]:
    """The candidate files and documents of each record: from its preferred files or, where it has none, from all its members.

    ``files``: an inventory. Files that hold no structured data are left out.
    """
    preferred = F.col("preferred_working_series.selected_files")
    chosen = F.when(F.size(preferred) > 0, preferred).otherwise(F.coalesce("member_files", F.array().cast("array<string>")))
    own = records.select("family_id", "partition_type", "date_format", "path_semantics", F.explode(F.array_distinct(chosen)).alias("_path"))
    met = own.join(files.drop("family_id", "partition_type", "date_format", "path_semantic"), F.col("_path") == F.col("path")).where(p.is_structured(F.col("path")))
    dated = met.withColumns({"period": c.t.normalize(F.col("date_code"), F.col("date_format")), "path_semantic": F.try_element_at("path_semantics", F.col("directory"))})
    docs = records.select("family_id", F.explode("associated_docs").alias("d")).select("family_id", "d.url", "d.filename", "d.score")
    return c.candidate_files(dated, per_family), c.candidate_docs(docs, per_docs)


def similarity_report(members: DataFrame, item: str, value: str, threshold: float = 0.8, least: float = 0.0) -> tuple[DataFrame, DataFrame]:
    """Pairs of items with common values, and clusters of those ``threshold`` or more alike.

    Pairs, from most alike, then by names: ``a, b, similarity`` (four places), ``shared, a_count, b_count``. Clusters: ``cluster_id``
    (``family_cluster_<n>``, in order of their smallest items, by a running count over ranges) and ``item``, those without a like one in clusters of their own.
    """
    held = cut(members.select(F.col(item).alias("i"), F.col(value).alias("v")).where("i is not null and v is not null").distinct())
    pairs = cut(jaccard_pairs(held, "i", "v", least))
    n = held.groupBy("i").agg(F.count(F.lit(1)).alias("n"))
    told = pairs.join(n.select(F.col("i").alias("a"), F.col("n").alias("a_count")), "a").join(n.select(F.col("i").alias("b"), F.col("n").alias("b_count")), "b")
    told = told.select("a", "b", F.round("similarity", 4).alias("similarity"), "shared", "a_count", "b_count").orderBy(F.desc("similarity"), "a", "b")
    parts = cut(connected_components(held.select(F.col("i").alias("node")).distinct(), pairs.where(F.col("similarity") >= threshold).select("a", "b")))
    numbered = running(in_ranges(parts.select("component").distinct(), [], ["component"]), [], ["component"], F.lit(1), "sum", "_n").drop(PART)
    named = numbered.select("component", F.concat(F.lit("family_cluster_"), F.col("_n").cast("string")).alias("cluster_id"))
    return told, parts.join(named, "component").select("cluster_id", F.col("node").alias("item"))
