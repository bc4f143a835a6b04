"""What a translator needs to know about a family, as one text: its fields, documents and excerpts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

FIELDS, DOCS, EXCERPTS = 120, 12, 6
# Section names and the last line, which readers of the text look for.
SECTIONS = {"docs": "DOCS", "excerpts": "DOC_EXCERPTS", "fields": "FIELDS"}
LAST = "Return grammar only."


def _lines(rows: DataFrame, line: Column, order: list[Column], most: int, name: str) -> DataFrame:
    """``family_id`` and the first ``most`` lines of each family as one text."""
    ranked = rows.withColumn("_r", F.row_number().over(Window.partitionBy("family_id").orderBy(*order))).where(F.col("_r") <= most)
    held = ranked.select("family_id", "_r", line.alias("_line")).groupBy("family_id").agg(F.sort_array(F.collect_list(F.struct("_r", "_line"))).alias("_l"))
    return held.select("family_id", F.array_join(F.transform("_l", lambda s: s["_line"]), "\n").alias(name), F.size("_l").alias(f"n_{name}"))


def family_fields(members: DataFrame, profiles: DataFrame, catalog: DataFrame) -> DataFrame:
    """The profiled fields of each family's files with the number of families that share the variable."""
    shared = catalog.select(F.col("variable").alias("_variable"), "family_count")
    own = members.select("family_id", "path").distinct().join(profiles, "path").withColumn("_variable", F.upper("name"))
    return own.join(shared, "_variable", "left").withColumn("shared", F.coalesce("family_count", F.lit(0))).drop("_variable", "family_count")


def translation_bundle(families: DataFrame, fields: DataFrame, docs: DataFrame | None = None, excerpts: DataFrame | None = None, most: int = FIELDS) -> DataFrame:
    """``family_id, n_fields, text``. Fields come by the number of families that share them, then by name, ``most`` at most.

    ``families``: ``family_id, system_guess, series_prefix, file_count``; ``fields``: ``family_fields``; ``docs``: ``family_id,
    url, score``; ``excerpts``: ``family_id, filename, extraction_status, excerpt``. A family without fields has an empty section.
    """
    c = F.col
    join = lambda name, n, by: F.array_join(F.slice(F.coalesce(name, F.array().cast("array<string>")), 1, n), by)
    told = F.concat(F.lit("- "), F.upper("name"), F.lit(" | "), F.coalesce("primitive_type", F.lit("unknown")), F.lit(" | shared="), c("shared").cast("string"), F.lit(" | sig="), join("signals", 4, ","), F.lit(" | samp="), join("samples", 6, ", "))
    out = families.join(_lines(fields, told, [F.desc("shared"), F.upper("name"), c("path")], most, "fields"), "family_id", "left")
    if docs is not None:
        url = F.concat(F.lit("- "), c("score").cast("string"), F.lit(" "), c("url"))
        out = out.join(_lines(docs, url, [F.desc("score"), c("url")], DOCS, "docs"), "family_id", "left")
    if excerpts is not None:
        text = F.substring(F.trim(F.regexp_replace("excerpt", r"\s+", " ")), 1, 500)
        line = F.concat_ws(" | ", F.concat(F.lit("- "), c("filename")), F.coalesce("extraction_status", F.lit("unknown")), F.nullif(text, F.lit("")))
        out = out.join(_lines(excerpts, line, [c("filename")], EXCERPTS, "excerpts"), "family_id", "left")
    head = F.concat_ws("\n", F.concat(F.lit("FAMILY "), c("family_id")), F.concat(F.lit("SYSTEM "), F.coalesce("system_guess", F.lit("UNKNOWN"))), F.concat(F.lit("PREFIX "), F.coalesce("series_prefix", F.lit("UNKNOWN"))), F.concat(F.lit("FILES "), F.coalesce("file_count", F.lit(0)).cast("string")))
    parts = [head] + [F.when(c(k).isNotNull(), F.concat(F.lit(SECTIONS[k] + "\n"), c(k))) for k in ("docs", "excerpts") if k in out.columns]
    parts += [F.concat(F.lit(SECTIONS["fields"] + "\n"), F.coalesce("fields", F.lit(""))), F.lit(LAST)]
    return out.select("family_id", F.coalesce("n_fields", F.lit(0)).alias("n_fields"), F.concat_ws("\n\n", *parts).alias("text"))


def document_registry(docs: DataFrame, files: DataFrame) -> DataFrame:
    """``family_id, url, filename, local_path``: the first of three places under a root where a document lies: by its name, its whole path, its last path component.

    ``docs``: ``family_id, url, filename``; ``files``: ``path`` of what lies under the root, relative to it. A document that lies nowhere keeps a null path.
    """
    url_path = F.regexp_replace("url", r"^[A-Za-z][A-Za-z0-9+.-]*://[^/]*/?", "")
    places = F.array(F.col("filename"), F.ltrim(url_path, F.lit("/")), F.regexp_extract("url", r"([^/]*)/*$", 1))
    tried = docs.select("family_id", "url", "filename", F.posexplode(places).alias("_at", "_place"))
    lies = files.select(F.col("path").alias("local_path")).distinct()
    found = tried.join(lies, tried["_place"] == lies["local_path"], "left").groupBy("family_id", "url", "filename")
    return found.agg(F.min_by("local_path", F.when(F.col("local_path").isNotNull(), F.col("_at"))).alias("local_path"))
