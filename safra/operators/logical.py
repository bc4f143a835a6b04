"""Logical families, the newer way to organise a corpus: by system and prefix, with graded evidence of what they cover.

The older way, by physical groups whose periods touch, is in ``corpus``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import paths as p
from ..functions import periods as t
from .graph import cut
from .intervals import beside

# Directory and file-name words, period bounds, scores of readings of a name.
DOC_EXTENSIONS = [".pdf", ".txt", ".md", ".doc", ".docx", ".xls", ".xlsx", ".csv", ".zip"]
FORMAT_DIRS = ["JSON", "XML", "CSV", "PARQUET"]
DOC_DIRS = ["DOC", "DOCS", "DOCUMENTO", "DOCUMENTOS", "MANUAL", "LEIA", "README", "LAYOUT"]
AUX_DIRS = ["AUX", "AUXILIAR", "AUXILIARES", "TAB", "TABELA", "TABELAS", "TABWIN"]
DATA_DIRS = ["DADOS", "DADO", "DADOS_", "DADOS-"]
SEMANTIC_DIRS = ["FINAIS", "FINAL", "PRELIM", "PRELIMINAR", "HOMOLOG", "HOMOLOGACAO", "TESTE", "TESTES"]
NOISE = r"^\d{6}_?$|^\d{4}_\d{4}$|^(?i)CID\d+$"
DOC_WORDS = ["dicionario", "dic_dados", "layout", "manual", "instrucao", "instrucoes", "estrutura", "readme", "nota", "docs_tab"]
FIRST_YEAR, LAST_YEAR = 1970, 2035
KINDS = ["yymm", "yyyy", "yy"]
KIND_SCORE = {"yymm": 50, "yyyy": 35, "yy": 25}
COMPLETE, BROAD, PARTIAL = 27, 20, 5  # states of a panel
TORN, FEW_DEFECTS, NEARLY_ALL, FEW_GAPS = 10, 6, 24, 6
QUALITY = {"[Primary]": 0, "[Legacy]": 1, "[Staging]": 2, "[Test]": 3}


def context(parts: Column) -> Column:
    """Struct ``distribution_root, system, subsystem`` of a path's directories: what follows ``publicos``, and the last one that names no format, stage or date."""
    at = F.array_position(parts, F.lit("publicos")).cast("int")
    tail = F.when(at > 0, F.slice(parts, at + 1, F.greatest(F.size(parts) - at, F.lit(0))))
    root = F.try_element_at(tail, F.lit(1))
    open_data = (root == "Dados_Abertos") & (F.size(tail) >= 2)
    rest = F.when(open_data, F.slice(tail, 3, F.size(tail))).otherwise(F.slice(tail, 2, F.greatest(F.size(tail), F.lit(1))))
    telling = F.filter(rest, lambda d: ~F.upper(d).isin(FORMAT_DIRS + DOC_DIRS + AUX_DIRS + DATA_DIRS + SEMANTIC_DIRS) & ~d.rlike(NOISE))
    return F.struct(root.alias("distribution_root"), F.when(open_data, F.try_element_at(tail, F.lit(2))).otherwise(root).alias("system"), F.try_element_at(telling, F.lit(-1)).alias("subsystem"))


def asset_kind(extension: Column, parts: Column, name: Column) -> Column:
    """``data, doc, aux`` or ``other`` by primary extension, upper-case components of the path, and words of the lower-case file name."""
    ext = F.coalesce(extension, F.lit(""))
    among = lambda words: F.arrays_overlap(parts, F.array(*[F.lit(w) for w in words]))
    doc, aux, data, told = among(DOC_DIRS), among(AUX_DIRS), among(DATA_DIRS + FORMAT_DIRS), name.rlike("|".join(DOC_WORDS))
    wrapped = ext.isin(p.WRAPPERS)
    return (
        F.when(ext.isin(p.STRUCTURED), "data").when(wrapped & (doc | told), "doc").when(wrapped & data, "data")
        .when(ext.isin(DOC_EXTENSIONS) & (doc | aux | told), "doc").when(aux, "aux").when(doc, "doc").otherwise("other")
    )


def format_family(extension: Column) -> Column:
    """By the primary extension alone."""
    return (
        F.when(extension.isin(".dbf", ".dbc"), "dbase").when(extension.isin(".json", ".xml", ".csv", ".parquet", ".pdf"), F.substring(extension, 2, 10))
        .when(extension.isin(p.WRAPPERS), "archive").otherwise("unknown")
    )


def path_semantic(parts: Column) -> Column:
    """By upper-case components of a path."""
    among = lambda *words: F.arrays_overlap(parts, F.array(*[F.lit(w) for w in words]))
    return F.when(among("TESTE", "TESTES"), "[Test]").when(among("PRELIM", "PRELIMINAR", "HOMOLOG", "HOMOLOGACAO"), "[Staging]").otherwise("[Primary]")


def period(token: Column, kind: str) -> Column:
    """YYYYMM, or YYYY00, of a date token; null out of bounds."""
    number = token.try_cast("int")
    year = lambda y: F.when(y < 70, 2000 + y).otherwise(1900 + y)
    if kind == "yymm":
        month = number % 100
        return F.when(month.between(1, 12), year(F.floor(number / 100)) * 100 + month).cast("long")
    if kind == "yy":
        return (year(number) * 100).cast("long")
    return F.when(number.between(FIRST_YEAR, LAST_YEAR), number * 100).cast("long")


def reading(stem: Column) -> Column:
    """Best of all ways to read a name: struct ``cost, prefix, date_kind, geo_code, period, uses_geo``; null if there is none."""
    upper, options = F.upper(stem), []
    for kind in KINDS:
        digits = 2 if kind == "yy" else 4
        token = p.some(upper, rf"(\d{{{digits}}})$")
        rest = F.substring(upper, F.lit(1), F.length(upper) - digits)
        for located in (True, False):
            geo = F.substring(rest, -2, 2)
            prefix = F.substring(rest, F.lit(1), F.length(rest) - 2) if located else rest
            value = period(token, kind)
            fits = token.isNotNull() & value.isNotNull() & (F.length(prefix) >= 2) & ((F.length(rest) >= 4) & geo.isin([*p.UF, "BR"]) if located else F.lit(True))
            score = KIND_SCORE[kind] + (30 if located else 10) + F.when(F.length(prefix) <= 8, 15).otherwise(0) + F.when(prefix.rlike(r"^\p{L}+$"), 10).otherwise(0)
            options.append(F.when(fits, F.struct((-score).alias("cost"), prefix.alias("prefix"), F.lit(kind).alias("date_kind"), F.when(F.lit(located), geo).alias("geo_code"), value.alias("period"), F.lit(located).alias("uses_geo"))))
    return F.array_min(F.array_compact(F.array(*options)))


def inventory(files: DataFrame) -> DataFrame:
    """One row per file of ``path`` with all that its path and name tell.

    What a name tells goes through ``explode``, a row for a row: projections on both sides of it stay apart, so the
    long expression is evaluated once a row and not once for each of its fields.
    """
    path, c = F.col("path"), F.col
    plain = F.struct(p.directory(path).alias("directory"), p.components(path).alias("_parts"), F.lower(p.file_name(path)).alias("_name"), F.upper(p.stem(path)).alias("_stem"), p.primary_extension(path).alias("primary_extension"))
    cut_ = files.select("path", F.explode(F.array(plain)).alias("_t")).select("path", "_t.*")
    cut_ = cut_.withColumn("format_family", format_family(c("primary_extension")))
    cut_ = cut_.withColumns({"_upper": F.transform("_parts", F.upper), "_dirs": F.slice("_parts", F.lit(1), F.size("_parts") - 1)})
    both = F.struct(context(c("_dirs")).alias("c"), reading(c("_stem")).alias("r"))
    told = cut_.withColumn("_told", F.explode(F.array(both)))
    told = told.select("path", "directory", "primary_extension", "format_family", asset_kind(c("primary_extension"), c("_upper"), c("_name")).alias("asset_kind"), c("_told.c").alias("c"), path_semantic(c("_upper")).alias("path_semantic"), c("_told.r").alias("r"))
    return told.select("path", "directory", "primary_extension", "format_family", "asset_kind", "c.*", "path_semantic", *[c("r")[k].alias(k) for k in ("prefix", "date_kind", "geo_code", "period", "uses_geo")])


def data_files(rows: DataFrame) -> DataFrame:
    """The files of an inventory that hold data and have a name that can be read."""
    return rows.where("asset_kind = 'data' and prefix is not null")


def coalesce_prefixes(rows: DataFrame) -> DataFrame:
    """A prefix without a place whose beginning, but for two letters, is a prefix with places of the same system and date kind takes that name."""
    known = rows.where("uses_geo").select(F.col("system").alias("_system"), F.col("date_kind").alias("_kind"), F.col("prefix").alias("_short")).distinct()
    short = F.when(~F.col("uses_geo") & (F.length("prefix") >= 5), F.substring(F.col("prefix"), F.lit(1), F.length("prefix") - 2))
    marked = rows.withColumn("_try", short)
    joined = marked.join(known, marked["system"].eqNullSafe(known["_system"]) & (marked["date_kind"] == known["_kind"]) & (marked["_try"] == known["_short"]), "left")
    return joined.withColumn("prefix", F.coalesce("_short", "prefix")).drop("_system", "_kind", "_short", "_try")


def main_kind(rows: DataFrame, keys: list[str]) -> DataFrame:
    """The rows of each group's most frequent date kind (ties: months, then years of four digits, then of two), as ``date_kind``."""
    rank = F.array_position(F.array(*[F.lit(k) for k in KINDS]), F.col("date_kind"))
    n = rows.groupBy(*keys, "date_kind").agg(F.count(F.lit(1)).alias("_n")).withColumn("_r", F.row_number().over(Window.partitionBy(*keys).orderBy(F.desc("_n"), rank))).where("_r = 1")
    return rows.join(n.select(*keys, "date_kind"), [*keys, "date_kind"], "left_semi")


def partition(places: Column, uses_geo: Column, implicit: Column) -> Column:
    """Struct ``type, evidence`` from a set of places, whether any name holds one, and whether single files follow one another in time."""
    nation, states = F.array_contains(places, "BR"), F.size(F.array_intersect(places, F.array(*[F.lit(u) for u in p.UF]))) > 0
    cases = [
        (nation & states, "Mixed-Partition", "explicit_br_and_ufs"), (states, "State-Partitioned", "explicit_ufs"), (nation, "Nation-Wide", "explicit_br"),
        (implicit, "Nation-Wide", "implicit_single_file_per_period"), (uses_geo, "Geo-Coded-Unresolved", "geo_expected_but_unresolved"), (F.lit(True), "Geo-Less", "no_geo_in_filename"),
    ]
    return F.coalesce(*[F.when(when, F.struct(F.lit(kind).alias("type"), F.lit(why).alias("evidence"))) for when, kind, why in cases])


def coverage_status(places: Column, kind: Column) -> Column:
    n = F.size(F.array_intersect(places, F.array(*[F.lit(u) for u in p.UF])))
    states = F.when(n >= COMPLETE, "complete_state_panel").when(n >= BROAD, "broad_state_panel").when(n >= PARTIAL, "partial_state_panel").otherwise("sparse_state_panel")
    return (
        F.when(kind == "State-Partitioned", states).when(kind == "Nation-Wide", "nationwide").when(kind == "Mixed-Partition", F.concat(F.lit("mixed_br_plus_"), n.cast("string"), F.lit("_ufs")))
        .when(kind == "Geo-Less", "geo_less").otherwise("unresolved")
    )


def best_files(rows: DataFrame, keys: list[str]) -> DataFrame:
    """The best file of each key: extension, meaning of its directories, shorter path, path."""
    meaning = F.coalesce(F.try_element_at(F.create_map(*[F.lit(x) for kv in QUALITY.items() for x in kv]), F.col("path_semantic")), F.lit(99))
    best = Window.partitionBy(*keys).orderBy(p.extension_rank(F.col("primary_extension")), meaning, F.length("path"), "path")
    return rows.withColumn("_r", F.row_number().over(best)).where("_r = 1").drop("_r")


FAMILY = ["system", "prefix"]


def families(rows: DataFrame) -> DataFrame:
    """Logical families of the data files of an ``inventory``: one per system and prefix, ``system:prefix``, with partition, coverage and gaps.

    A state-partitioned family misses periods, or places within a period (``partial_panels``); any other one misses periods.
    """
    data = coalesce_prefixes(data_files(rows).where("system is not null"))
    main = main_kind(data, FAMILY)
    per_period = main.groupBy(*FAMILY, "period").agg(F.count(F.lit(1)).alias("files"), F.collect_set("geo_code").alias("geo"), F.max("uses_geo").alias("geo_used"))
    states = F.array(*[F.lit(u) for u in p.UF])
    told = per_period.groupBy(*FAMILY).agg(
        F.sort_array(F.array_distinct(F.flatten(F.collect_list("geo")))).alias("geo_coverage"), F.max("geo_used").alias("geo_used"), F.min("period").alias("period_min"), F.max("period").alias("period_max"),
        F.count(F.lit(1)).alias("periods"), F.max("files").alias("most"),
        F.count_if(F.size(F.array_intersect("geo", states)).between(1, len(p.UF) - 1)).alias("_partial"), F.count_if(F.size(F.array_intersect("geo", states)) == 0).alias("_bare"),
        F.min(F.nullif(F.size(F.array_intersect("geo", states)), F.lit(0))).alias("_least"),
    )
    whole = data.groupBy(*FAMILY).agg(F.count(F.lit(1)).alias("file_count"), F.sort_array(F.collect_set("directory")).alias("source_paths"), F.mode("subsystem", True).alias("subsystem"))
    kind = main.groupBy(*FAMILY).agg(F.first("date_kind").alias("date_kind"))
    rows_ = told.join(whole, FAMILY).join(kind, FAMILY)
    implicit = (F.col("periods") >= 2) & ~F.col("geo_used") & (F.col("most") == 1)
    rows_ = rows_.withColumn("_p", partition(F.col("geo_coverage"), F.col("geo_used"), implicit)).withColumns({"partition_type": F.col("_p.type"), "partition_evidence": F.col("_p.evidence")})
    monthly = F.when(F.col("date_kind") == "yymm", "YYMM").otherwise("YY")
    span = t.ordinal(F.col("period_max"), monthly) - t.ordinal(F.col("period_min"), monthly) + 1
    panel = F.col("partition_type") == "State-Partitioned"
    return rows_.select(
        F.concat_ws(":", *FAMILY).alias("family_id"), *FAMILY, "subsystem", "date_kind", "partition_type", "partition_evidence", coverage_status(F.col("geo_coverage"), F.col("partition_type")).alias("coverage_status"),
        "geo_coverage", "file_count", "source_paths", "period_min", "period_max",
        F.when(panel, "state_panel").when(F.col("partition_type") == "Nation-Wide", "national_series").otherwise("geo_less_series").alias("mode"),
        (span - F.col("periods") + F.when(panel, F.col("_bare")).otherwise(0)).cast("long").alias("missing_periods"), F.when(panel, F.col("_partial")).otherwise(0).cast("long").alias("partial_panels"), F.when(panel & (F.col("_partial") > 0), F.col("_least")).alias("least_places"),
    )


def graded_audit(families_: DataFrame, docs: DataFrame) -> DataFrame:
    """Adds ``issues`` (``code, severity``). ``docs``: ``family_id, tier`` (``family_specific`` or ``system_generic``) of the documents of each family."""
    tiers = docs.groupBy(F.col("family_id").alias("_id")).agg(F.collect_set("tier").alias("_tiers"))
    f = families_.join(tiers, families_["family_id"] == tiers["_id"], "left").drop("_id")
    c = F.col
    panel, nation = c("partition_type") == "State-Partitioned", c("partition_type") == "Nation-Wide"
    issue = lambda when, code, severity: F.when(when, F.struct(code.alias("code"), severity.alias("severity")))
    torn = c("coverage_status").isin("partial_state_panel", "sparse_state_panel") | (c("least_places") <= TORN)
    slight = (c("partial_panels") <= FEW_DEFECTS) & (c("least_places") >= NEARLY_ALL)
    found = F.array(
        issue(panel & (c("missing_periods") > 0), F.lit("missing_periods"), F.lit("error")),
        issue(panel & (c("partial_panels") > 0), F.when(torn, "state_panel_fragmented").when(slight, "minor_panel_defects").otherwise("state_panel_incomplete"), F.when(torn, "error").when(slight, "info").otherwise("warning")),
        issue(panel & (c("coverage_status") != "complete_state_panel"), F.lit("incomplete_statewide_coverage"), F.when(c("coverage_status") == "broad_state_panel", "warning").otherwise("error")),
        issue(nation & (c("missing_periods") > 0), F.lit("national_series_gaps"), F.when(c("missing_periods") <= FEW_GAPS, "warning").otherwise("error")),
        issue(c("partition_type").isin("Geo-Coded-Unresolved", "Geo-Less"), F.lit("partition_unresolved"), F.lit("warning")),
        issue(c("_tiers").isNull(), F.lit("no_associated_docs"), F.lit("warning")),
        issue(F.coalesce(~F.array_contains("_tiers", "family_specific"), F.lit(False)), F.lit("docs_generic_only"), F.lit("info")),
    )
    return f.withColumn("issues", F.array_compact(found)).drop("_tiers")


def variants(rows: DataFrame) -> DataFrame:
    """Physical variants of each system and prefix: by date kind, places in names, distribution root, subsystem, format."""
    keys = [*FAMILY, "date_kind", "uses_geo", "distribution_root", "subsystem", "format_family"]
    return data_files(rows).groupBy(*keys).agg(
        F.count(F.lit(1)).alias("file_count"), F.countDistinct("period").alias("period_count"), t.display_range(F.min("period"), F.max("period")).alias("time_range_display"), F.sort_array(F.collect_set("geo_code")).alias("geo_coverage")
    )


def common_root(rows: DataFrame, keys: list[str], path: str) -> DataFrame:
    """``count, common_prefix`` of the distinct paths of each group: the components that its smallest and largest path begin with alike, so that no group is gathered."""
    ends = rows.groupBy(*keys).agg(F.countDistinct(path).alias("count"), F.min(p.components(F.col(path))).alias("_a"), F.max(p.components(F.col(path))).alias("_b"))
    n = F.size("_a") + F.size("_b") - p.tree_distance(F.col("_a"), F.col("_b"))
    shared = F.slice("_a", F.lit(1), (n / 2).cast("int"))
    return ends.select(*keys, "count", F.concat(F.lit("/"), F.array_join(shared, "/")).alias("common_prefix"))


def compress_paths(rows: DataFrame, keys: list[str], path: str, most: int = 8) -> DataFrame:
    """``common_root`` with ``tails``: what the first ``most`` distinct paths of each group, in order, have beyond the common beginning ("." for nothing)."""
    each = rows.select(*keys, F.col(path).alias("_p")).distinct()
    nth = F.row_number().over(Window.partitionBy(*keys).orderBy("_p"))
    few = each.withColumn("_r", nth).where(F.col("_r") <= most).groupBy(*keys).agg(F.sort_array(F.collect_list("_p")).alias("_first"))
    met = beside(common_root(rows, keys, path), few, keys)
    deep = F.size(p.components(F.col("common_prefix")))
    tails = F.transform("_first", lambda q: F.coalesce(F.nullif(F.array_join(F.slice(p.components(q), deep + 1, F.size(p.components(q))), "/"), F.lit("")), F.lit(".")))
    return met.withColumn("tails", tails).drop("_first")


def doc_rows(rows: DataFrame, base_url: str) -> DataFrame:
    """The documents of an inventory as ``associate_by_words`` takes them: ``path, url, filename, directory, system, subsystem, distribution_root, format_family, doc_scope_hint, keyword_hits``."""
    name = p.file_name(F.col("path"))
    words = F.array(*[F.lit(w) for w in sorted(DOC_WORDS)])
    in_docs = F.arrays_overlap(F.transform(p.components(F.col("path")), F.lower), F.array(F.lit("doc"), F.lit("docs")))
    scope = F.when(in_docs & F.col("subsystem").isNull(), "system").when(F.col("subsystem").isNotNull(), "subsystem").otherwise("generic")
    return rows.where("asset_kind = 'doc'").select(
        "path", F.concat(F.lit(base_url.rstrip("/")), "path").alias("url"), name.alias("filename"), "directory", "system", "subsystem", "distribution_root", "format_family", scope.alias("doc_scope_hint"), F.filter(words, lambda w: F.lower(name).contains(w)).alias("keyword_hits"),
    )


def panel_files(rows: DataFrame) -> DataFrame:
    """The best file of each family, period and state."""
    return best_files(data_files(rows).where(F.col("geo_code").isin(p.UF)), [*FAMILY, "period", "geo_code"])




#: States named for a family's defects at most, and families for a system's.
TOP_STATES, TOP_FAMILIES = 12, 20


def missing_states(rows: DataFrame) -> DataFrame:
    """``family_id, partial_panels, least_places, most_places, top_missing`` of families with periods that lack some states: ``top_missing`` are the 12 states (``state, n``) that most of those periods lack, ties by state."""
    data = main_kind(coalesce_prefixes(data_files(rows).where("system is not null")), FAMILY)
    states = F.array(*[F.lit(u) for u in p.UF])
    panels = data.groupBy(*FAMILY, "period").agg(F.array_intersect(F.collect_set("geo_code"), states).alias("have")).where(F.size("have").between(1, len(p.UF) - 1))
    panels = panels.withColumn("family_id", F.concat_ws(":", *FAMILY))
    told = panels.groupBy("family_id").agg(F.count(F.lit(1)).alias("partial_panels"), F.min(F.size("have")).alias("least_places"), F.max(F.size("have")).alias("most_places"))
    lacks = panels.select("family_id", F.explode(F.array_except(states, "have")).alias("state")).groupBy("family_id", "state").agg(F.count(F.lit(1)).alias("n"))
    nth = F.row_number().over(Window.partitionBy("family_id").orderBy(F.desc("n"), "state"))
    few = lacks.withColumn("r", nth).where(F.col("r") <= TOP_STATES)
    tops = few.groupBy("family_id").agg(F.transform(F.sort_array(F.collect_list(F.struct("r", "state", "n"))), lambda e: F.struct(e["state"].alias("state"), e["n"].alias("n"))).alias("top_missing"))
    return told.join(tops, "family_id")


def gap_detail(rows: DataFrame, examples: int = 12) -> DataFrame:
    """``family_id, missing_period_count, missing_period_ranges`` (``Jan 2001`` or ``Jan 2001 to Mar 2001``, in order) of families with periods missing between their first and last; a period of a family of states counts when no state has it.

    With ``partial_panel_examples``: the first ``examples`` periods that lack some states (``period, territory_count, missing``).
    """
    data = main_kind(coalesce_prefixes(data_files(rows).where("system is not null")), FAMILY).withColumn("family_id", F.concat_ws(":", *FAMILY))
    states = F.array(*[F.lit(u) for u in p.UF])
    monthly = F.when(F.col("date_kind") == "yymm", "YYMM").otherwise("YY")
    periods = data.groupBy("family_id", "period", monthly.alias("date_format")).agg(F.array_intersect(states, F.collect_set("geo_code")).alias("have"))
    any_states = Window.partitionBy("family_id")
    periods = cut(periods.withColumn("_panel", F.max(F.size("have") > 0).over(any_states)))
    span = periods.groupBy("family_id").agg(F.min("period").alias("a"), F.max("period").alias("b"), F.first("date_format").alias("date_format"))
    due = span.select("family_id", "date_format", F.explode(t.calendar(F.col("a"), F.col("b"), F.col("date_format"))).alias("period"))
    there = periods.where(~F.col("_panel") | (F.size("have") > 0)).select("family_id", "period")
    gone = due.join(there, ["family_id", "period"], "left_anti")
    run = gone.withColumn("_n", t.ordinal(F.col("period"), F.col("date_format")))
    run = run.withColumn("_run", F.col("_n") - F.row_number().over(Window.partitionBy("family_id").orderBy("_n")))
    each = run.groupBy("family_id", "_run").agg(F.min("period").alias("a"), F.max("period").alias("b"), F.count(F.lit(1)).alias("n"))
    told = each.groupBy("family_id").agg(F.sum("n").alias("missing_period_count"), F.transform(F.sort_array(F.collect_list(F.struct("a", "b"))), lambda s: t.display_range(s["a"], s["b"])).alias("missing_period_ranges"))
    partial = periods.where(F.size("have").between(1, len(p.UF) - 1)).withColumn("_r", F.row_number().over(any_states.orderBy("period"))).where(F.col("_r") <= examples)
    shown = partial.groupBy("family_id").agg(F.transform(F.sort_array(F.collect_list(F.struct("period", F.size("have").alias("territory_count"), F.array_except(states, "have").alias("missing")))), lambda s: F.struct(t.display(s["period"]).alias("period"), s["territory_count"].alias("territory_count"), s["missing"].alias("missing"))).alias("partial_panel_examples"))
    return told.join(shown, "family_id", "full")


def system_rollup(audited: DataFrame) -> DataFrame:
    """``system, section, item, n``: families of each system by partition, coverage and date kind, those with issues, and how many have each issue; one pass."""
    said = lambda section, item, when=None: F.when(F.lit(True) if when is None else when, F.struct(F.lit(section).alias("section"), item.alias("item")))
    fixed = F.array_compact(F.array(said("families", F.lit("all")), said("families", F.lit("problem"), F.size("issues") > 0), said("partition_type", F.col("partition_type")), said("coverage_status", F.col("coverage_status")), said("date_kind", F.col("date_kind"))))
    each = audited.select("system", F.explode(F.concat(fixed, F.transform("issues", lambda i: F.struct(F.lit("issue").alias("section"), i["code"].alias("item"))))).alias("s"))
    return each.groupBy("system", "s.section", "s.item").agg(F.count(F.lit(1)).alias("n"))


def issue_matrix(audited: DataFrame, codes: list[str]) -> DataFrame:
    """Families with each issue (a column a code) by system."""
    return audited.groupBy("system").agg(*[F.count_if(F.array_contains(F.transform("issues", lambda i: i["code"]), k)).alias(k) for k in codes])


def worst_families(audited: DataFrame, most: int = TOP_FAMILIES) -> DataFrame:
    """``system, family_id, issues, rank``: a system's ``most`` families with most issues; ties by id."""
    rank = F.row_number().over(Window.partitionBy("system").orderBy(F.desc("issues"), "family_id"))
    return audited.select("system", "family_id", F.size("issues").alias("issues")).where("issues > 0").withColumn("rank", rank).where(F.col("rank") <= most)
