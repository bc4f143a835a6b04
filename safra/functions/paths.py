"""Column expressions over paths and file names."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Extensions, path keywords, geographic codes, file-name grammars.
STRUCTURED = [".dbc", ".dbf", ".xml", ".csv", ".json", ".parquet"]
WRAPPERS = [".zip", ".gz"]
AUXILIARY = ["TABELAS", "DOCS", "DOCUMENTOS", "TABWIN", "DOC", "AUXILIAR", "AUXILIARES"]
EXCLUDED = "/IBGE/"
STAGING = ["PRELIM", "HOMOL"]
REFERENCE_WORDS = ["manual", "dicionario", "leia-me", "layout", "estrutura", "dic_dados", "instrucoes"]
REFERENCE_DIRS = ["DOC", "TAB"]
UF = ["AC", "AL", "AP", "AM", "BA", "CE", "DF", "ES", "GO", "MA", "MT", "MS", "MG", "PA", "PB", "PR", "PE", "PI", "RJ", "RN", "RS", "RO", "RR", "SC", "SP", "SE", "TO"]
DATE_GRAMMARS = [("PREFIX_GEO_YYMM", r"\d{4}"), ("PREFIX_GEO_YY", r"\d{2}"), ("PREFIX_GEO_DATE", r"\d{2,8}")]
EXTENSION_RANK = {".json": 0, ".parquet": 1, ".xml": 2, ".csv": 3, ".dbf": 4, ".dbc": 5}


def some(text: Column, pattern: str, group: int = 1) -> Column:
    """``regexp_extract`` that is null where nothing, or nothing but the empty text, matches."""
    return F.nullif(F.regexp_extract(text, pattern, group), F.lit(""))


def without_host(url: Column) -> Column:
    """The path of a URL or of a plain path."""
    return F.regexp_replace(F.trim(url), r"^[A-Za-z][A-Za-z0-9+.-]*://[^/]*", "")


def file_name(path: Column) -> Column:
    return F.regexp_extract(path, r"([^/]*)/*$", 1)


def directory(path: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(path, r"/+$", ""), r"/[^/]*$", "")


def components(path: Column) -> Column:
    return F.filter(F.split(path, "/"), lambda p: p != "")


def extension_chain(path: Column) -> Column:
    """All suffixes, lower-cased (``.json.zip``); leading dots begin no suffix."""
    return F.lower(F.regexp_extract(file_name(path), r"^\.*[^.]+((?:\.[^.]+)*)$", 1))


def suffixes(path: Column) -> Column:
    return F.filter(F.transform(F.split(extension_chain(path), r"\."), lambda s: F.concat(F.lit("."), s)), lambda s: s != ".")


def stem(path: Column) -> Column:
    return F.regexp_replace(file_name(path), r"^(\.*[^.]+)((?:\.[^.]+)*)$", "$1")


def primary_of(own: Column, path: Column) -> Column:
    """The right-most structured one of a path's suffixes, else what a directory says, else the last suffix."""
    known = F.reverse(F.filter(own, lambda s: s.isin(STRUCTURED)))
    hint = F.coalesce(*[F.when(F.upper(path).contains(f"/{k.upper()}/"), f".{k}") for k in ("json", "xml", "csv", "parquet")])
    return F.coalesce(F.try_element_at(known, F.lit(1)), hint, F.try_element_at(own, F.lit(-1)))


def family_of(ext: Column, own: Column) -> Column:
    """By primary extension and suffixes."""
    wrapped = F.exists(own, lambda s: s.isin(WRAPPERS))
    return (
        F.when(ext.isin(".dbf", ".dbc"), "dbase")
        .when(ext.isin(".json", ".xml", ".csv", ".parquet"), F.substring(ext, 2, 10))
        .when(wrapped, "archive")
        .otherwise("unknown")
    )


def primary_extension(path: Column) -> Column:
    return primary_of(suffixes(path), path)


def format_family(path: Column) -> Column:
    return family_of(primary_extension(path), suffixes(path))


def is_structured(path: Column) -> Column:
    return F.coalesce(primary_extension(path).isin(STRUCTURED), F.lit(False)) | (format_family(path) == "archive")


def name_grammar(name_stem: Column) -> Column:
    """Struct ``pattern_name, series_prefix, geo_code, date_code`` of the first grammar that fits, else nulls."""
    parts = []
    for name, date in DATE_GRAMMARS:
        pattern = rf"(?i)^([A-Z_]{{2,}})([A-Z]{{2}})({date})$"
        found = F.struct(
            F.lit(name).alias("pattern_name"),
            F.upper(F.regexp_extract(name_stem, pattern, 1)).alias("series_prefix"),
            F.upper(F.regexp_extract(name_stem, pattern, 2)).alias("geo_code"),
            F.regexp_extract(name_stem, pattern, 3).alias("date_code"),
        )
        parts.append(F.when(name_stem.rlike(pattern), found))
    return F.coalesce(*parts)


def path_type(path: Column) -> Column:
    """Auxiliary where a keyword occurs anywhere in the whole path."""
    return F.when(F.upper(path).rlike("|".join(AUXILIARY)), "Auxiliary").otherwise("Primary")


def is_excluded(path: Column) -> Column:
    return F.upper(path).contains(EXCLUDED)


def system_guess(dir_path: Column) -> Column:
    return F.try_element_at(components(dir_path), F.lit(3))


def normal_directory(path: Column) -> Column:
    """One leading slash, single slashes, none at the end."""
    flat = F.regexp_replace(F.concat(F.lit("/"), F.trim(path)), r"/+", "/")
    return F.when(flat == "/", flat).otherwise(F.regexp_replace(flat, r"/$", ""))


def under(path: Column, endpoint: str) -> Column:
    root = "/" + endpoint.strip("/")
    return (path == root) | path.startswith(root.rstrip("/") + "/")


def target_path(root: str, path: Column) -> Column:
    return F.concat_ws("/", F.lit(root.rstrip("/")), F.ltrim(path, F.lit("/")))


def entry_hint(name: Column) -> Column:
    return F.when(name.rlike(r"(?i)\.(dbc|dbf|xml|csv|json|parquet|zip|gz|pdf|txt)$"), "file")


def discard_reason(path: Column, kind: Column, prefix: Column, primary: Column, family: Column) -> Column:
    """Why a file is left out of families; null where it is not."""
    del path
    blank = lambda c: c.isNull() | (c == "")
    return (
        F.when(kind == "Auxiliary", "auxiliary_path").when(blank(prefix), "missing_series_prefix").when(blank(primary), "missing_primary_extension").when(family == "unknown", "unknown_format_family")
    )


def extension_rank(ext: Column) -> Column:
    ranks = F.create_map(*[F.lit(x) for pair in EXTENSION_RANK.items() for x in pair])
    return F.coalesce(F.try_element_at(ranks, ext), F.lit(99))


def is_reference_pdf(name: Column, dir_path: Column) -> Column:
    """By a word in the file name, or a directory whose name begins with one of ``REFERENCE_DIRS``."""
    return F.lower(name).rlike("|".join(REFERENCE_WORDS)) | F.upper(dir_path).rlike("/(" + "|".join(REFERENCE_DIRS) + ")")


def tree_distance(a: Column, b: Column) -> Column:
    """Components of two paths beyond their common beginning."""
    same = F.zip_with(a, b, lambda x, y: F.coalesce(x == y, F.lit(False)))
    start = F.struct(F.lit(True).alias("on"), F.lit(0).alias("n"))
    common = F.aggregate(same, start, lambda s, hit: F.struct((s["on"] & hit).alias("on"), (s["n"] + F.when(s["on"] & hit, 1).otherwise(0)).alias("n")))["n"]
    return F.size(a) + F.size(b) - 2 * common


# Fixed value: a line of a Unix listing (mode, links, owner, group, size, month, day, time or year, name).
LIST_LINE = r"^([bcdlps-])[rwx-]{9}\s+\d+\s+\S+\s+\S+\s+(\d+)\s+([A-Z][a-z]{2})\s+(\d{1,2})\s+([\d:]{4,5})\s+(.+)$"


def parse_list_line(line: Column) -> Column:
    """Struct ``entry_type, size, modified, name`` of a Unix ``LIST`` line, null where it is none."""
    part = lambda k: F.regexp_extract(line, LIST_LINE, k)
    return F.when(
        line.rlike(LIST_LINE),
        F.struct(F.when(part(1) == "d", "dir").otherwise("file").alias("entry_type"), part(2).cast("long").alias("size"), F.concat_ws(" ", part(3), part(4), part(5)).alias("modified"), part(6).alias("name")),
    )
