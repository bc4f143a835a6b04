"""Files to dataset families: inventory, catalogue of series, families, working series, audits, diffs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import paths as p
from ..functions import periods as t
from .graph import cut
from .intervals import interval_clusters

MIN_FILES = 5
MIN_UFS = 20
SAMPLE_FILES = 10
SEMANTIC_RANK = {"[Primary]": 0, "[Legacy Archive]": 1, "[Staging]": 2}


def inventory(files: DataFrame) -> DataFrame:
    """One row per file of ``path`` (with ``entry_type`` if there is one): all that its path and name tell.

    Directories and excluded paths are left out.
    """
    path = F.col("path")
    kept = files.where(~p.is_excluded(path))
    if "entry_type" in files.columns:
        kept = kept.where(F.coalesce("entry_type", F.lit("")) != "dir")
    c = F.col
    # A row for a row, twice: what follows reads fields instead of repeating the expressions that made them.
    plain = F.struct(p.directory(path).alias("directory"), p.file_name(path).alias("filename"), p.extension_chain(path).alias("extension"), p.suffixes(path).alias("suffixes"), p.stem(path).alias("stem"))
    cut_ = kept.select("path", F.explode(F.array(plain)).alias("t"))
    told = F.struct(p.primary_of(c("t.suffixes"), path).alias("primary_extension"), p.name_grammar(c("t.stem")).alias("g"), p.system_guess(c("t.directory")).alias("system_guess"))
    named = cut_.select("path", "t", F.explode(F.array(told)).alias("u"))
    return named.select(
        "path", "t.directory", "t.filename", "t.extension", "u.primary_extension", p.family_of(c("u.primary_extension"), c("t.suffixes")).alias("format_family"), "u.system_guess", p.path_type(path).alias("path_type"),
        "u.g.pattern_name", "u.g.series_prefix", "u.g.geo_code", "u.g.date_code",
    )


def with_discard_reason(files: DataFrame) -> DataFrame:
    c = F.col
    return files.withColumn("discard_reason", p.discard_reason(c("path"), c("path_type"), c("series_prefix"), c("primary_extension"), c("format_family")))


def partition_type(geo: Column) -> Column:
    """Of a set of geographic codes."""
    states = F.size(F.array_intersect(geo, F.array(*[F.lit(u) for u in p.UF]))) >= MIN_UFS
    nation = F.array_contains(geo, "BR")
    return F.when(states & nation, "Mixed-Partition").when(states, "State-Partitioned").when(nation, "Nation-Wide").otherwise("Unknown")


def path_semantic(dir_path: Column, overall: Column, own: Column, fmt: Column) -> Column:
    """By name, or by how far the directory's latest period lags."""
    lag = overall - own
    old = ((fmt == "YYMM") & (lag > 500)) | ((fmt == "YY") & (lag > 5))
    return F.when(F.upper(dir_path).rlike("|".join(p.STAGING)), "[Staging]").when(old, "[Legacy Archive]").otherwise("[Primary]")


def with_path_semantic(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Adds ``path_semantic`` of each row's directory within its group of ``keys``; null where nothing there has a date. Needs ``period, date_format, directory``."""
    good = F.nullif(F.col("period"), F.lit(0))
    by_dir = rows.groupBy(*keys, "directory").agg(F.max(good).alias("_own"), F.first("date_format").alias("_format"))
    by_dir = by_dir.withColumn("_all", F.max("_own").over(Window.partitionBy(*keys)))
    meaning = F.when(F.col("_own").isNotNull(), path_semantic(F.col("directory"), F.col("_all"), F.col("_own"), F.col("_format")))
    told = by_dir.select(*[F.col(k).alias(f"_{k}") for k in keys], F.col("directory").alias("_directory"), meaning.alias("path_semantic"))
    on = rows["directory"] == told["_directory"]
    for k in keys:
        on = on & rows[k].eqNullSafe(told[f"_{k}"])
    return rows.join(told, on, "left").drop("_directory", *[f"_{k}" for k in keys])


def dated(files: DataFrame, keys: list[str]) -> DataFrame:
    """Adds ``date_format`` of the group and ``period`` of the row."""
    formats = files.groupBy(*keys).agg(t.date_format(F.col("date_code")).alias("date_format"))
    on = [files[k].eqNullSafe(formats[k]) for k in keys]
    joined = files.join(formats, on, "left")
    for k in keys:
        joined = joined.drop(formats[k])
    return joined.withColumn("period", t.normalize(F.col("date_code"), F.col("date_format")))


def series_catalog(files: DataFrame) -> DataFrame:
    """Series by prefix over directories of five pattern files or more; unknown partitions drop out."""
    readable = files.where("pattern_name is not null")
    busy = readable.groupBy(F.col("directory").alias("_busy")).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= MIN_FILES)
    crowded = readable.join(busy, readable["directory"] == busy["_busy"], "left_semi")
    rows = dated(crowded, ["series_prefix"])
    by_dir = rows.groupBy("series_prefix", "directory").agg(F.max("period").alias("own"), F.count(F.lit(1)).alias("files"), F.first("date_format").alias("date_format"))
    overall = Window.partitionBy("series_prefix")
    by_dir = by_dir.withColumn("meaning", path_semantic(F.col("directory"), F.max("own").over(overall), F.col("own"), F.col("date_format")))
    meanings = by_dir.groupBy("series_prefix").agg(F.map_from_entries(F.sort_array(F.collect_list(F.struct("directory", "meaning")))).alias("path_semantics"))
    series = rows.groupBy("series_prefix").agg(
        F.sort_array(F.collect_set("geo_code")).alias("geo_coverage"), F.min("period").alias("first_period"), F.max("period").alias("last_period"), F.count(F.lit(1)).alias("file_count"),
        F.sort_array(F.collect_set("directory")).alias("source_paths"), F.first("date_format").alias("date_format"), F.min("system_guess").alias("system_guess"),
    )
    series = series.withColumn("partition_type", partition_type(F.col("geo_coverage"))).where("partition_type != 'Unknown'")
    named = series.withColumn("series_id", F.concat_ws(":", F.coalesce("system_guess", F.lit("UNKNOWN")), "series_prefix"))
    shown = F.concat_ws(" to ", t.display(F.col("first_period")), t.display(F.col("last_period")))
    nth = F.row_number().over(Window.partitionBy("series_prefix").orderBy("path"))
    first = rows.select("series_prefix", "path", "filename").withColumn("_r", nth).where(F.col("_r") <= SAMPLE_FILES)
    samples = first.groupBy("series_prefix").agg(F.transform(F.sort_array(F.collect_list(F.struct("_r", "filename"))), lambda s: s["filename"]).alias("file_samples"))
    return named.withColumn("time_range_display", shown).join(meanings, "series_prefix").join(samples, "series_prefix")


# Share of a series' two-letter codes that must be states, and their number.
STATE_SHARE, STATE_CODES = 0.35, 4


def validated_series(files: DataFrame) -> DataFrame:
    """``series_prefix, partition_type, first_code, last_code, geo_coverage, file_count, source_paths`` of prefixes of structured files, by the share of states among their two-letter codes; unknown ones drop out."""
    rows = files.where("series_prefix is not null").where(F.col("primary_extension").isin(p.STRUCTURED))
    series = rows.groupBy("series_prefix").agg(
        F.sort_array(F.collect_set("geo_code")).alias("geo_coverage"), F.min(F.col("date_code").try_cast("long")).alias("first_code"), F.max(F.col("date_code").try_cast("long")).alias("last_code"), F.count(F.lit(1)).alias("file_count"), F.sort_array(F.collect_set("directory")).alias("source_paths"),
    )
    two = F.size(F.filter("geo_coverage", lambda g: F.length(g) == 2))
    found = F.size(F.array_intersect("geo_coverage", F.array(*[F.lit(u) for u in p.UF])))
    states, nation = (F.try_divide(found, two) >= STATE_SHARE) & (found >= STATE_CODES), F.array_contains("geo_coverage", "BR")
    kind = F.when(states & nation, "Mixed-Partition").when(states, "State-Partitioned").when(nation, "Nation-Wide")
    return series.withColumn("partition_type", kind).where("partition_type is not null")


def physical_groups(files: DataFrame) -> DataFrame:
    """Signature of each (system, prefix) of the files that no reason discards."""
    rows = dated(with_discard_reason(files).where("discard_reason is null"), ["system_guess", "series_prefix"])
    good = F.nullif(F.col("period"), F.lit(0))
    groups = rows.groupBy("system_guess", "series_prefix").agg(
        F.sort_array(F.collect_set("geo_code")).alias("geo_coverage"), F.first("date_format").alias("date_format"), F.min(good).alias("time_min"), F.max(good).alias("time_max"),
        F.count(F.lit(1)).alias("file_count"), F.sort_array(F.collect_set("directory")).alias("source_paths"), F.sort_array(F.collect_set("format_family")).alias("format_families"),
        F.collect_set("primary_extension").alias("primary_extensions"), F.slice(F.sort_array(F.collect_set("path")), 1, SAMPLE_FILES).alias("sample_files"),
    )
    groups = groups.withColumn("primary_extensions", by_extension(F.col("primary_extensions")))
    groups = groups.withColumn("partition_type", partition_type(F.col("geo_coverage")))
    return groups.withColumn("group_id", F.concat_ws("|", F.coalesce("system_guess", F.lit("")), "series_prefix"))


def compatible_groups(groups: DataFrame) -> DataFrame:
    """Pairs ``a, b`` of groups alike in prefix, partition, format and geography whose periods overlap or touch."""
    c = F.col
    lo, hi = t.ordinal(c("time_min"), c("date_format")), t.ordinal(c("time_max"), c("date_format"))
    g = groups.where("time_min is not null").select("group_id", "series_prefix", "partition_type", "date_format", F.array_join("geo_coverage", ",").alias("geo"), lo.alias("lo"), hi.alias("hi"))
    l, r = g.alias("l"), g.alias("r")
    alike = [c(f"l.{k}") == c(f"r.{k}") for k in ("series_prefix", "partition_type", "date_format", "geo")]
    near = (c("l.group_id") < c("r.group_id")) & (c("l.lo") <= c("r.hi") + 1) & (c("r.lo") <= c("l.hi") + 1)
    cond = near
    for a in alike:
        cond = cond & a
    return l.join(r, cond).select(c("l.group_id").alias("a"), c("r.group_id").alias("b"))


def families(files: DataFrame) -> DataFrame:
    """Dataset families: clusters of compatible groups with five files or more, ranked within their prefix.

    The groups, few beside the files, are written once. Those alike in all but their periods chain where the periods overlap or touch.
    """
    groups = cut(physical_groups(files))
    c = F.col
    alike = groups.select("group_id", "series_prefix", "partition_type", "date_format", F.array_join("geo_coverage", ",").alias("geo"), t.ordinal(c("time_min"), c("date_format")).alias("lo"), t.ordinal(c("time_max"), c("date_format")).alias("hi"))
    cluster = interval_clusters(alike, ["series_prefix", "partition_type", "date_format", "geo"], "group_id").withColumnRenamed("group_id", "node")
    grouped = groups.join(cluster, groups["group_id"] == cluster["node"])
    rows = grouped.groupBy("series_prefix", "component").agg(
        F.sort_array(F.collect_set("system_guess")).alias("source_systems"), F.sort_array(F.array_distinct(F.flatten(F.collect_list("geo_coverage")))).alias("geo_coverage"),
        F.first("date_format").alias("date_format"), F.min("time_min").alias("time_min"), F.max("time_max").alias("time_max"), F.sum("file_count").alias("file_count"),
        F.sort_array(F.array_distinct(F.flatten(F.collect_list("source_paths")))).alias("source_paths"), F.sort_array(F.array_distinct(F.flatten(F.collect_list("format_families")))).alias("format_families"),
        F.sort_array(F.collect_list(F.struct(F.coalesce("system_guess", F.lit("")).alias("system_guess"), "time_min", "time_max", "file_count", "source_paths"))).alias("physical_variants"),
    )
    rows = rows.where(F.col("file_count") >= MIN_FILES)
    system = F.when(F.size("source_systems") == 1, F.col("source_systems")[0]).when(F.size("source_systems") > 1, "MULTI")
    rows = rows.withColumns({"system_guess": system, "partition_type": partition_type(F.col("geo_coverage")), "time_range_display": t.display_range(F.col("time_min"), F.col("time_max"))})
    return family_ids(rows, "series_prefix", [F.coalesce("time_min", F.lit(0)), F.desc("file_count"), F.col("component")])


def family_ids(rows: DataFrame, prefix: str, order: list[Column]) -> DataFrame:
    """Adds ``family_id``: the prefix, with ``__k`` where it has several families."""
    own = Window.partitionBy(prefix)
    k = F.row_number().over(own.orderBy(*order))
    many = F.count(F.lit(1)).over(own) > 1
    return rows.withColumn("family_id", F.when(many, F.concat(prefix, F.lit("__"), k.cast("string"))).otherwise(F.col(prefix)))


def _preference() -> list[Column]:
    """Best first: extension, meaning of the directory, system, directory, path."""
    ranks = F.create_map(*[F.lit(x) for kv in SEMANTIC_RANK.items() for x in kv])
    meaning = F.coalesce(F.try_element_at(ranks, F.col("path_semantic")), F.lit(9))
    return [p.extension_rank(F.col("primary_extension")).alias("_extension"), meaning.alias("_meaning"), F.coalesce("system_guess", F.lit("")).alias("_system"), F.col("directory"), F.col("path")]


def preferred_files(files: DataFrame, keys: list[str]) -> DataFrame:
    """Best file of each period: by extension, meaning of the directory, system, directory, path. Needs ``period, path_semantic``."""
    best = Window.partitionBy(*keys, "period").orderBy(*_preference())
    return files.where("period > 0").withColumn("_r", F.row_number().over(best)).where("_r = 1").drop("_r")


#: What the files of a segment have in common.
SIGNATURE = ["primary_extension", "format_family", "system_guess", "path_semantic"]


def by_extension(extensions: Column) -> Column:
    """Distinct extensions by preference, then name."""
    ranked = F.transform(F.array_distinct(F.array_compact(extensions)), lambda e: F.struct(p.extension_rank(e).alias("r"), e.alias("e")))
    return F.transform(F.sort_array(ranked), lambda s: s["e"])


def segments(chosen: DataFrame, keys: list[str], signature: list[str] = SIGNATURE) -> DataFrame:
    """Runs of consecutive periods of equal signature: ``first_period, last_period, files``, the files in order and their directories."""
    own = Window.partitionBy(*keys).orderBy("period")
    n = t.ordinal(F.col("period"), F.col("date_format"))
    sig = F.struct(*signature)
    begins = F.coalesce((F.lag(n).over(own) + 1 != n) | ~F.lag(sig).over(own).eqNullSafe(sig), F.lit(True))
    marked = chosen.withColumn("_new", begins.cast("int")).withColumn("segment", F.sum("_new").over(own).cast("int"))
    in_order = F.transform(F.sort_array(F.collect_list(F.struct("period", "path"))), lambda s: s["path"])
    runs = marked.groupBy(*keys, "segment", *signature).agg(
        F.min("period").alias("first_period"), F.max("period").alias("last_period"), F.count(F.lit(1)).alias("files"), in_order.alias("selected_files"), F.sort_array(F.collect_set("directory")).alias("source_paths")
    )
    return runs.withColumn("time_range_display", t.display_range(F.col("first_period"), F.col("last_period")))


def working_series(files: DataFrame, keys: list[str]) -> DataFrame:
    """The preferred working series of each group of ``keys``: ``strategy, coverage_complete, coverage_gaps,
    selected_file_count, selected_files, selected_primary_extensions, selected_format_families, segment_count, segments``.

    A group with dated files takes the best file of each period: ``single_format`` or ``stitched`` by how many extensions those
    have. One without takes all its files, best first, as one segment: ``undated_full_family``. Needs ``period,
    date_format, path_semantic`` beside the columns of the inventory.
    """
    found = cut(preferred_files(files, keys))
    parts = segments(found, keys).withColumnRenamed("files", "file_count")
    of = ["time_range_display", "primary_extension", "format_family", "system_guess", "path_semantic", "file_count", "selected_files", "source_paths"]
    listed = parts.groupBy(*keys).agg(F.sort_array(F.collect_list(F.struct("segment", *of))).alias("_s"))
    listed = listed.select(*keys, F.transform("_s", lambda s: F.struct(*[s[c].alias(c) for c in of])).alias("segments"))
    gaps = missing_periods(found, keys).groupBy(*keys).agg(F.transform(F.sort_array(F.collect_list("period")), t.display).alias("coverage_gaps"))
    names = F.transform(F.sort_array(F.collect_list(F.struct("period", "path"))), lambda s: s["path"])
    whole = found.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("selected_file_count"), names.alias("selected_files"), by_extension(F.collect_set("primary_extension")).alias("selected_primary_extensions"), F.sort_array(F.collect_set("format_family")).alias("selected_format_families")
    )
    none = F.array().cast("array<string>")
    dated_ = _beside(_beside(whole, listed, keys), gaps, keys).withColumn("coverage_gaps", F.coalesce("coverage_gaps", none))
    dated_ = dated_.withColumns({"strategy": F.when(F.size("selected_primary_extensions") <= 1, "single_format").otherwise("stitched"), "coverage_complete": F.size("coverage_gaps") == 0, "segment_count": F.size("segments")})

    some = files.groupBy(*keys).agg(F.max(F.coalesce("period", F.lit(0))).alias("_latest")).where("_latest = 0").drop("_latest")
    undated = files.join(some, [files[k].eqNullSafe(some[k]) for k in keys], "left_semi")
    best = F.sort_array(F.collect_list(F.struct(*_preference(), "format_family", "primary_extension", "path_semantic")))
    held = undated.groupBy(*keys).agg(best.alias("_b"))
    paths = F.transform("_b", lambda b: b["path"])
    top = F.col("_b")[0]
    one = F.struct(
        F.lit(None).cast("string").alias("time_range_display"), top["primary_extension"].alias("primary_extension"), top["format_family"].alias("format_family"), F.nullif(top["_system"], F.lit("")).alias("system_guess"), top["path_semantic"].alias("path_semantic"),
        F.size("_b").cast("long").alias("file_count"), paths.alias("selected_files"), F.sort_array(F.array_distinct(F.transform("_b", lambda b: b["directory"]))).alias("source_paths"),
    )
    undated_ = held.select(
        *keys, F.lit("undated_full_family").alias("strategy"), F.lit(True).alias("coverage_complete"), none.alias("coverage_gaps"), F.size("_b").cast("long").alias("selected_file_count"), paths.alias("selected_files"),
        by_extension(F.transform("_b", lambda b: b["primary_extension"])).alias("selected_primary_extensions"), F.sort_array(F.array_distinct(F.transform("_b", lambda b: b["format_family"]))).alias("selected_format_families"),
        F.lit(1).alias("segment_count"), F.array(one).alias("segments"),
    )
    return dated_.select(*undated_.columns).unionByName(undated_)


def _beside(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """Left join on keys that may be null; the keys stay once."""
    other = right.select(*[F.col(k).alias(f"_{k}") for k in keys], *[c for c in right.columns if c not in keys])
    on = F.lit(True)
    for k in keys:
        on = on & left[k].eqNullSafe(other[f"_{k}"])
    return left.join(other, on, "left").drop(*[f"_{k}" for k in keys])


def missing_periods(chosen: DataFrame, keys: list[str]) -> DataFrame:
    """Periods between a key's first and last that it lacks. Needs ``period, date_format``."""
    span = chosen.groupBy(*keys).agg(F.min("period").alias("a"), F.max("period").alias("b"), F.first("date_format").alias("date_format"))
    due = span.select(*keys, F.explode(t.calendar(F.col("a"), F.col("b"), F.col("date_format"))).alias("period"))
    return due.join(chosen.select(*keys, "period"), [*keys, "period"], "left_anti")


def ranges(missing: DataFrame, keys: list[str], fmt: Column) -> DataFrame:
    """Consecutive periods as ``first_period, last_period, n``."""
    own = Window.partitionBy(*keys).orderBy("period")
    n = t.ordinal(F.col("period"), fmt)
    run = missing.withColumn("_run", n - F.row_number().over(own))
    return run.groupBy(*keys, "_run").agg(F.min("period").alias("first_period"), F.max("period").alias("last_period"), F.count(F.lit(1)).alias("n")).drop("_run")


def state_panel(files: DataFrame, keys: list[str]) -> DataFrame:
    """Per key and period: states present, states missing, coverage. Needs ``period, geo_code``."""
    all_uf = F.array(*[F.lit(u) for u in p.UF])
    have = files.where("period > 0").groupBy(*keys, "period").agg(F.sort_array(F.array_intersect(F.collect_set("geo_code"), all_uf)).alias("present"))
    return have.withColumns({"missing": F.sort_array(F.array_except(all_uf, F.col("present"))), "coverage": F.size("present") / len(p.UF)})


def audit(families_: DataFrame) -> DataFrame:
    """Adds ``issues``. Needs ``gap_count, strategy, coverage_complete, partition_type, date_format, source_systems, doc_count``."""

    def issue(cond: Column, code: str, severity: str) -> Column:
        return F.when(cond, F.struct(F.lit(code).alias("code"), F.lit(severity).alias("severity")))

    found = F.array(
        issue(F.col("gap_count") > 0, "coverage_gaps", "warning"), issue(F.col("strategy") == "stitched", "stitched_preferred_working_series", "info"),
        issue(F.col("partition_type") == "Unknown", "unknown_partition_type", "warning"), issue(F.col("date_format").isNull(), "missing_date_format", "warning"),
        issue(F.size("source_systems") > 1, "multi_source_system_family", "info"), issue(F.coalesce("doc_count", F.lit(0)) == 0, "no_associated_docs", "info"),
    )
    return families_.withColumn("issues", F.array_compact(found))


def audit_summary(audited: DataFrame) -> DataFrame:
    """``code, families, family_ids`` over all issues."""
    each = audited.select("family_id", F.explode("issues").alias("i"))
    return each.groupBy(F.col("i.code").alias("code"), F.col("i.severity").alias("severity")).agg(F.countDistinct("family_id").alias("families"), F.sort_array(F.collect_set("family_id")).alias("family_ids"))


def snapshot_diff(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """``change`` (added, removed, common) by key, from one full join."""
    a, b = left.select(F.col(key).alias("k")).distinct(), right.select(F.col(key).alias("k2")).distinct()
    change = F.when(F.col("k").isNull(), "added").when(F.col("k2").isNull(), "removed").otherwise("common")
    return a.join(b, F.col("k") == F.col("k2"), "full").select(F.coalesce("k", "k2").alias(key), change.alias("change"))


def best_grammar(stems: DataFrame) -> DataFrame:
    """Of every way to read a name, the one of best score: known state or nation +3, plausible month +2, full-length code +1."""
    stem = F.col("stem")
    options = []
    for kind, code in (("month", r"(\d{4})"), ("year4", r"(\d{4})"), ("year2", r"(\d{2})")):
        pattern = rf"(?i)^([A-Z_]{{2,}}?)([A-Z]{{2}})?{code}$"
        prefix, geo, date = (F.upper(F.regexp_extract(stem, pattern, k)) for k in (1, 2, 3))
        known = geo.isin(*p.UF, "BR")
        good = F.substring(date, 3, 2).try_cast("int").between(1, 12) if kind == "month" else F.substring(date, 1, 2).isin("19", "20") if kind == "year4" else F.lit(True)
        score = F.when(known, 3).otherwise(0) + F.when(good, 2).otherwise(0) + F.when(F.lit(kind != "year2"), 1).otherwise(0)
        options.append(F.when(stem.rlike(pattern), F.struct((-score).alias("cost"), prefix.alias("prefix"), F.lit(kind).alias("kind"), F.nullif(geo, F.lit("")).alias("geo"), date.alias("date"))))
    best = F.array_min(F.array_compact(F.array(*options)))
    return stems.withColumn("best", best)


def candidate_files(files: DataFrame, per_family: int = 3) -> DataFrame:
    """Up to ``per_family`` files of each family: ``family_id, path, selection_rank, selection_reason``.

    The first is the latest (of a mixed family the latest nation-wide one, if it has any); each next one adds most to
    those before it: a new place, a new period, then a primary path, recency, name. Needs ``family_id, partition_type, path, filename,
    geo_code, period, path_semantic, primary_extension``. A family first shrinks to ``per_family`` files of each place and
    period, which loses no choice; each pick is then one ranking over the family.
    """
    c = F.col
    rank = F.when(c("path_semantic") == "[Primary]", 2).when(c("path_semantic") == "[Legacy Archive]", 1).otherwise(0)
    rows = files.select("family_id", "partition_type", "path", "filename", F.coalesce("geo_code", F.lit("")).alias("geo"), c("period").cast("long").alias("period"), rank.alias("rank"), "path_semantic", "primary_extension")
    few = Window.partitionBy("family_id", "geo", "period").orderBy(F.desc("rank"), F.desc("filename"), F.desc("path"))
    rows = rows.withColumn("_r", F.row_number().over(few)).where(c("_r") <= per_family).drop("_r")
    family = Window.partitionBy("family_id")
    recent = F.coalesce("period", F.lit(-1))
    nation = c("geo") == "BR"
    started = (c("partition_type") == "Mixed-Partition") & F.max(nation).over(family)
    first = [F.desc(started & nation), F.desc(recent), F.desc("rank"), F.desc((c("partition_type") != "State-Partitioned") & nation), F.desc("filename"), F.desc("path")]
    rows = rows.withColumn("selection_rank", F.row_number().over(family.orderBy(*first))).withColumn("selection_rank", F.when(c("selection_rank") == 1, 1))
    rows = rows.withColumns({"new_place": F.when(c("selection_rank") == 1, False), "new_period": F.when(c("selection_rank") == 1, False)})
    for k in range(2, per_family + 1):
        taken = c("selection_rank").isNotNull()
        places, dates = F.collect_set(F.when(taken, c("geo"))).over(family), F.collect_set(F.when(taken, c("period"))).over(family)
        rows = rows.withColumns({"_place": ~F.array_contains(places, c("geo")), "_date": F.coalesce(~F.array_contains(dates, c("period")), F.lit(True))})
        order = family.orderBy(taken, F.desc("_place"), F.desc("_date"), F.desc("rank"), F.desc(recent), F.desc("filename"), F.desc("path"))
        picked = (F.row_number().over(order) == 1) & ~taken
        rows = rows.withColumn("_now", picked)
        rows = rows.withColumns({
            "selection_rank": F.when(c("_now"), k).otherwise(c("selection_rank")),
            "new_place": F.when(c("_now"), c("_place") & (c("geo") != "")).otherwise(c("new_place")),
            "new_period": F.when(c("_now"), c("_date") & c("period").isNotNull()).otherwise(c("new_period")),
        }).drop("_place", "_date", "_now")
    chosen = rows.where("selection_rank is not null")
    opening = (
        F.when((c("partition_type") == "Mixed-Partition") & nation, "latest nation-wide member in mixed family")
        .when(c("partition_type") == "Nation-Wide", "latest nation-wide family member").otherwise("most recent family member")
    )
    told = F.concat_ws(
        "; ", F.when(c("selection_rank") == 1, opening), F.when(c("new_place"), F.concat(F.lit("adds geo coverage ("), c("geo"), F.lit(")"))), F.when(c("new_period"), "adds time coverage"),
        F.when(c("rank") == 2, "preferred primary path"), F.when(c("primary_extension") != "", F.concat(F.lit("format="), F.ltrim(c("primary_extension"), F.lit(".")))),
    )
    return chosen.select("family_id", "path", "selection_rank", F.coalesce(F.nullif(told, F.lit("")), F.lit("best remaining recent candidate")).alias("selection_reason"))


def candidate_docs(docs: DataFrame, per_family: int = 5) -> DataFrame:
    """Up to ``per_family`` documents of each family by score, each URL once. Needs ``family_id, url, filename, score``."""
    score = F.coalesce(F.col("score").cast("double"), F.lit(0.0))
    name = F.coalesce(F.nullif("filename", F.lit("")), F.col("url"))
    told = docs.where("url != ''").select("family_id", "url", F.coalesce("filename", p.file_name(F.col("url"))).alias("filename"), "score", score.alias("_score"), name.alias("_name"))
    once = told.withColumn("_r", F.row_number().over(Window.partitionBy("family_id", "url").orderBy(F.desc("_score"), F.desc("_name")))).where("_r = 1")
    best = Window.partitionBy("family_id").orderBy(F.desc("_score"), F.desc("_name"), "url")
    ranked = once.withColumn("selection_rank", F.row_number().over(best)).where(F.col("selection_rank") <= per_family)
    return ranked.select("family_id", "url", "filename", "score", "selection_rank", F.lit("top associated document by relevance score").alias("selection_reason"))


def registry(families_: DataFrame, fields: DataFrame) -> DataFrame:
    """Families with ``variable_count`` and ``variables``: the upper-case field names of their profiled member files.

    ``families_`` has ``family_id, member_files``; ``fields`` has ``path, name`` and, if a path was profiled more than once, ``position``: its last profile counts.
    """
    named = fields.where("trim(name) != ''").select("path", F.upper("name").alias("name"), *(["position"] if "position" in fields.columns else []))
    if "position" in fields.columns:
        last = Window.partitionBy("path")
        named = named.withColumn("_last", F.max("position").over(last)).where("position = _last")
    members = families_.select("family_id", F.explode("member_files").alias("path")).distinct()
    has = members.join(named.select("path", "name").distinct(), "path").groupBy("family_id").agg(F.sort_array(F.collect_set("name")).alias("variables"))
    return families_.join(has, "family_id", "left").withColumn("variables", F.coalesce("variables", F.array().cast("array<string>"))).withColumn("variable_count", F.size("variables"))


def summary(files: DataFrame, families_: DataFrame) -> DataFrame:
    """Counters over an inventory and its families as ``section, item, n``: files by fate, families by partition, date format, number of systems, strategy, extension.

    ``families_`` has ``family_id, partition_type, date_format, source_systems, strategy, selected_primary_extensions, gap_count, doc_count``.
    """
    fate = with_discard_reason(files).groupBy(F.coalesce("discard_reason", F.lit("eligible")).alias("item")).agg(F.count(F.lit(1)).alias("n")).select(F.lit("files").alias("section"), "item", "n")

    def by(section: str, item: Column) -> DataFrame:
        return families_.select(item.alias("item")).groupBy("item").agg(F.count(F.lit(1)).alias("n")).select(F.lit(section).alias("section"), "item", "n")

    kept = families_.select(F.explode("selected_primary_extensions").alias("item")).groupBy("item").agg(F.count(F.lit(1)).alias("n")).select(F.lit("preferred_extension").alias("section"), "item", "n")
    gaps = families_.where("gap_count > 0").groupBy().agg(F.count(F.lit(1)).alias("n")).select(F.lit("families").alias("section"), F.lit("with_gaps").alias("item"), "n")
    bare = families_.where("doc_count = 0").groupBy().agg(F.count(F.lit(1)).alias("n")).select(F.lit("families").alias("section"), F.lit("without_docs").alias("item"), "n")
    parts = [
        by("partition", F.coalesce("partition_type", F.lit("Unknown"))), by("date_format", F.coalesce("date_format", F.lit("None"))), by("system_shape", F.when(F.size("source_systems") <= 1, "single_system").otherwise("multi_system")),
        by("strategy", F.coalesce("strategy", F.lit("none"))), kept, gaps, bare,
    ]
    for part in parts:
        fate = fate.unionByName(part)
    return fate


def asset_entries(entries: DataFrame, kind: str) -> DataFrame:
    """Selected files or documents under one set of names: ``asset_kind, selection_rank, selection_reason, source_url, source_path, filename``.

    A URL may stand under ``url``, its path is taken where none is given, and the name from the path; missing numbers are 0, missing texts empty.
    """
    given = lambda *names: F.coalesce(*[F.nullif(F.col(n).cast("string"), F.lit("")) for n in names if n in entries.columns], F.lit(""))
    url = given("source_url", "url")
    path = F.coalesce(F.nullif(given("source_path"), F.lit("")), F.regexp_replace(p.without_host(url), r"[?#].*$", ""))
    rank = F.coalesce(F.col("selection_rank").cast("int"), F.lit(0)) if "selection_rank" in entries.columns else F.lit(0)
    named = entries.select("*", url.alias("_url"), path.alias("_path"))
    own = [c for c in ("family_id", "geo_code", "date_code") if c in entries.columns]
    return named.select(*own, F.lit(kind).alias("asset_kind"), rank.alias("selection_rank"), given("selection_reason").alias("selection_reason"), F.col("_url").alias("source_url"), F.col("_path").alias("source_path"), F.coalesce(F.nullif(given("filename"), F.lit("")), p.file_name(F.col("_path"))).alias("filename"))


def download_plan(files: DataFrame, root: str, base_url: str) -> DataFrame:
    path = F.col("path")
    return files.select("path", F.concat(F.lit(base_url.rstrip("/")), path).alias("url"), p.target_path(root, path).alias("target_path"), F.lit("planned").alias("status"))
