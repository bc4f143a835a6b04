"""Scalar functions over strings, dates, codes and payloads."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import codes, paths, periods, text
from .common import UF_LIST, table


def municipality_normalize(spark, d):
    key = F.col("c_custkey")
    raw = F.lpad(key.cast("string"), (5 + key % 4).cast("int"), F.lit("1"))
    return table(spark, d, "customer").select("c_custkey", codes.municipality(F.concat(F.lit(" "), raw, F.lit("-"))).alias("code"))


def date_parse_multi(spark, d):
    date = F.col("o_orderdate").cast("date")
    shown = F.element_at(F.array(*[F.date_format(date, f) for f in ("yyyy-MM-dd", "yyyyMMdd", "ddMMyyyy", "dd/MM/yyyy")]), (F.col("o_orderkey") % 4 + 1).cast("int"))
    shown = F.when(F.col("o_orderkey") % 50 == 0, "13x45").otherwise(shown)
    parsed = periods.parse_date(shown)
    return table(spark, d, "orders").select("o_orderkey", shown.alias("shown"), F.year(parsed).alias("year"), F.month(parsed).alias("month"), F.date_format(parsed, "yyyy-MM-dd").alias("day"))


def text_normalize(spark, d):
    return table(spark, d, "documents").select("doc_id", F.md5(text.normalize_basic(F.col("text")).cast("binary")).alias("normal"))


def text_normalize_exact(spark, d):
    return table(spark, d, "documents").select("doc_id", F.md5(text.normalize_exact("text").cast("binary")).alias("normal"))


def code_normalize_list(spark, d):
    slots = F.array(F.col("p_brand"), F.col("p_type"), F.lower("p_brand"), F.lit("--"), F.lit(None).cast("string"))
    return table(spark, d, "part").select("p_partkey", F.array_join(codes.normalize_codes(slots), ",").alias("codes"))


def path_parse(spark, d):
    path = paths.without_host(F.col("url"))
    pages = table(spark, d, "pages").select("page_id", F.regexp_replace(path, r"[?#].*$", "").alias("path"))
    p = F.col("path")
    return pages.select(
        "page_id", paths.directory(p).alias("directory"), paths.file_name(p).alias("filename"), F.size(paths.components(p)).alias("depth"), paths.extension_chain(p).alias("extension"),
        paths.stem(p).alias("stem"), paths.primary_extension(p).alias("primary_extension"), paths.format_family(p).alias("format_family"), paths.path_type(p).alias("path_type"),
        paths.system_guess(paths.directory(p)).alias("system_guess"),
    )


_NAMES = ["DNSP2401.dbc", "x.json.zip", ".hidden", "a.tar.gz", "noext", "READ.ME.TXT", "LAYOUT12.pdf", "do_br99.DBF", "sp.CSV"]


def suffix_chain(spark, d):
    n = F.col("n_nationkey")
    path = F.concat(F.when(n % 2 == 0, "/data/JSON/").otherwise("/data/raw/"), F.element_at(F.array(*[F.lit(x) for x in _NAMES]), (n % len(_NAMES) + 1).cast("int")))
    return table(spark, d, "nation").select(
        "n_nationkey", paths.extension_chain(path).alias("extension"), paths.stem(path).alias("stem"), paths.primary_extension(path).alias("primary_extension"), paths.format_family(path).alias("family"),
        paths.is_structured(path).alias("structured"), paths.path_type(path).alias("path_type"), paths.is_excluded(path).alias("excluded"),
    )


def period_ord_kind(spark, d):
    date = F.col("o_orderdate").cast("date")
    shown = F.element_at(F.array(F.date_format(date, "yyyy"), F.date_format(date, "yyyyMM"), F.date_format(date, "yyyyMMdd"), F.lit("n/a")), (F.col("o_orderkey") % 4 + 1).cast("int"))
    kind, ym = periods.period_kind(shown), periods.year_month(shown)
    return table(spark, d, "orders").select("o_orderkey", kind["ord"].alias("ord"), kind["kind"].alias("kind"), ym["year"].alias("year"), ym["month"].alias("month"))


def payload_normalize(spark, d):
    k = F.get_json_object("props", "$.k")
    shown = F.when(F.col("event_id") % 5 == 0, F.concat(k, F.lit(",5"))).when(F.col("event_id") % 5 == 1, "...").when(F.col("event_id") % 5 == 2, "1.234,5").when(F.col("event_id") % 5 == 3, "").otherwise(k)
    return table(spark, d, "events").select("event_id", text.lenient_double(shown).alias("value"))


def aggregate_to_record(spark, d):
    from ..operators import catalog

    payload = F.to_json(F.array(F.struct(F.lpad(F.col("user_id").cast("string"), 7, "3").alias("NC"), F.lit("place").alias("NN"), F.date_format("ts", "yyyyMM").alias("D3C"), F.col("event_type").alias("D1N"), F.lit("9").alias("D1C"), F.col("value").cast("string").alias("V"))))
    rows = catalog.payload_rows(table(spark, d, "events").select(F.lit(1).cast("long").alias("aggregate_id"), F.lit("9").alias("variable_id"), payload.alias("payload")))
    r = catalog.value_records(rows)
    return r.groupBy(F.col("support.municipality").alias("municipality"), F.col("support.year").alias("year"), F.col("support.month").alias("month"), F.col("quality.included").alias("included")).agg(
        F.count(F.lit(1)).alias("n"), F.round(F.sum(F.col("continuous")["value"]), 4).alias("value")
    )


def string_metrics(spark, d):
    from ..operators import strings

    rounded = lambda c: F.round(c, 6).alias(c)
    return strings.metrics(strings.similar_names(table(spark, d, "part").select("p_name"), "p_name", 0.5)).select("a", "b", "edits", "damerau", "hamming", rounded("jaro_winkler"), rounded("jaccard"), rounded("dice"), rounded("overlap"), rounded("cosine"), rounded("spread"))


def disputed_pairs(spark, d):
    """Pairs of names on which the measures differ most."""
    from ..operators import strings

    told = strings.metrics(strings.similar_names(table(spark, d, "part").select("p_name"), "p_name", 0.5))
    return strings.most_disputed(told.withColumn("spread", F.round("spread", 6)), 20).select("a", "b", "spread", "rank")


def row_sample(spark, d):
    """A thousand order lines, the same ones in any run."""
    from ..operators import extensions

    return extensions.sample_rows(table(spark, d, "lineitem"), ["l_orderkey", "l_linenumber"], 1000)


def signatures(spark, d):
    return table(spark, d, "nation").select("n_nationkey", codes.signature(F.array(F.lit("n_name"), F.col("n_name"))).alias("signature"), F.sha2("n_name", 256).alias("sha256"))


def column_summary(spark, d):
    part = table(spark, d, "part")
    v = F.when(F.col("p_partkey") % 5 != 0, F.col("p_retailprice"))
    from ..operators import strings

    told = strings.column_summary(part, ["p_type"], v)
    return told.withColumns({"na_rate": F.round("na_rate", 9)} | {c: F.round(c, 6) for c in ("q1", "median", "mean", "q3")})


def list_lines(spark, d):
    n = F.col("n_nationkey")
    line = F.concat(F.when(n % 3 == 0, "d").otherwise("-"), F.lit("rw-r--r-- 1 ftp ftp "), (n * 100).cast("string"), F.lit(" Jan 0"), (n % 9 + 1).cast("string"), F.lit(" 12:30 "), F.col("n_name"), F.lit(" x.dbc"))
    line = F.when(n == 7, "total 12").otherwise(line)
    return table(spark, d, "nation").select("n_nationkey", paths.parse_list_line(line).alias("e")).select("n_nationkey", "e.*")


QUERIES = {
    f.__name__: f
    for f in (
        municipality_normalize, date_parse_multi, text_normalize, text_normalize_exact, code_normalize_list, path_parse, suffix_chain, period_ord_kind, payload_normalize, aggregate_to_record,
        string_metrics, disputed_pairs, row_sample, signatures, column_summary, list_lines,
    )
}

_PATH = "regexp_replace(regexp_replace(trim(url), '^[A-Za-z][A-Za-z0-9+.-]*://[^/]*', ''), '[?#].*$', '')"
_NORM = "regexp_replace(trim(regexp_replace(regexp_replace(lower(strip_accents(coalesce(text, ''))), '[^\\p{L}\\p{N}_\\s-]', ' ', 'g'), '[\\s\\x{00a0}]+', ' ', 'g')), ' *- *', '-', 'g')"
_LIST = ",".join(f"'{x}'" for x in _NAMES)
_METRICS = """WITH p AS (SELECT DISTINCT p_name AS n FROM part), g AS (SELECT n, list_distinct([substr(n, i, 3) FOR i IN range(1, length(n) - 1)]) AS g FROM p),
        k AS (SELECT x.n AS a, y.n AS b, len(list_intersect(x.g, y.g)) AS i, len(x.g) AS u, len(y.g) AS v FROM g x JOIN g y ON x.n < y.n),
        m AS (SELECT a, b, CAST(levenshtein(a, b) AS INTEGER) AS edits, CAST(damerau_levenshtein(a, b) AS INTEGER) AS damerau, jaro_winkler_similarity(a, b) AS jw, CASE WHEN length(a) = length(b) THEN CAST(hamming(a, b) AS INTEGER) END AS hamming, CAST(i AS DOUBLE) / (u + v - i) AS jaccard, 2.0 * i / (u + v) AS dice, CAST(i AS DOUBLE) / least(u, v) AS overlap, i / sqrt(u * v) AS cosine FROM k WHERE CAST(i AS DOUBLE) / (u + v - i) >= 0.5)
        SELECT a, b, edits, damerau, hamming, round(jw, 6) AS jaro_winkler, round(jaccard, 6) AS jaccard, round(dice, 6) AS dice, round(overlap, 6) AS overlap, round(cosine, 6) AS cosine, round(list_stddev_pop([jaccard, dice, overlap, cosine]), 6) AS spread FROM m"""
SQL = {
    "municipality_normalize": """SELECT c_custkey, CASE length(s) WHEN 6 THEN s || '0' WHEN 7 THEN s END AS code FROM (SELECT c_custkey,
        left(lpad(CAST(c_custkey AS VARCHAR), CAST(5 + c_custkey % 4 AS INTEGER), '1'), CAST(5 + c_custkey % 4 AS INTEGER)) AS s FROM customer)""",
    "date_parse_multi": """WITH s AS (SELECT o_orderkey, o_orderdate AS t, CASE WHEN o_orderkey % 50 = 0 THEN '13x45' ELSE [strftime(o_orderdate, '%Y-%m-%d'), strftime(o_orderdate, '%Y%m%d'), strftime(o_orderdate, '%d%m%Y'), strftime(o_orderdate, '%d/%m/%Y')][CAST(o_orderkey % 4 + 1 AS INTEGER)] END AS shown FROM orders),
        p AS (SELECT *, CASE WHEN regexp_full_match(shown, '\\d{8}') THEN coalesce(CASE WHEN CAST(substr(shown, 5, 2) AS INTEGER) BETWEEN 1 AND 12 THEN try_strptime(shown, '%Y%m%d') END, try_strptime(shown, '%d%m%Y')) ELSE try_strptime(shown, ['%Y-%m-%d', '%d/%m/%Y']) END AS v FROM s)
        SELECT o_orderkey, shown, CAST(year(v) AS INTEGER) AS year, CAST(month(v) AS INTEGER) AS month, strftime(v, '%Y-%m-%d') AS day FROM p""",
    "text_normalize": f"SELECT doc_id, md5({_NORM}) AS normal FROM documents",
    "text_normalize_exact": f"SELECT doc_id, md5({_NORM}) AS normal FROM documents",
    "code_normalize_list": """SELECT p_partkey, CASE WHEN a = b THEN a ELSE a || ',' || b END AS codes FROM (SELECT p_partkey, upper(regexp_replace(p_brand, '[^A-Za-z0-9]', '', 'g')) AS a, upper(p_type) AS b FROM part)""",
    "path_parse": f"""WITH p AS (SELECT page_id, {_PATH} AS path FROM pages), f AS (SELECT page_id, path, regexp_extract(path, '([^/]*)/*$', 1) AS filename, regexp_replace(regexp_replace(path, '/+$', ''), '/[^/]*$', '') AS directory FROM p),
        x AS (SELECT *, lower(regexp_extract(filename, '^\\.*[^.]+((?:\\.[^.]+)*)$', 1)) AS extension, list_filter(string_split(path, '/'), lambda q: q <> '') AS parts FROM f)
        SELECT page_id, directory, filename, CAST(len(parts) AS INTEGER) AS depth, extension, regexp_replace(filename, '^(\\.*[^.]+)((?:\\.[^.]+)*)$', '\\1') AS stem,
        CASE WHEN extension = '' THEN NULL ELSE '.' || string_split(extension, '.')[-1] END AS primary_extension, 'unknown' AS format_family,
        CASE WHEN regexp_matches(upper(path), 'TABELAS|DOC|TABWIN|AUXILIAR') THEN 'Auxiliary' ELSE 'Primary' END AS path_type, list_filter(string_split(directory, '/'), lambda q: q <> '')[3] AS system_guess FROM x""",
    "suffix_chain": f"""WITH n AS (SELECT n_nationkey, [{_LIST}][n_nationkey % {len(_NAMES)} + 1] AS f, n_nationkey % 2 = 0 AS j FROM nation),
        e AS (SELECT *, lower(regexp_extract(f, '^\\.*[^.]+((?:\\.[^.]+)*)$', 1)) AS extension FROM n),
        s AS (SELECT *, list_filter(['.' || y FOR y IN string_split(extension, '.')], lambda q: q <> '.') AS parts FROM e),
        k AS (SELECT *, coalesce(list_filter(parts, lambda q: q IN ('.dbc','.dbf','.xml','.csv','.json','.parquet'))[-1], CASE WHEN j THEN '.json' END, parts[-1]) AS p FROM s),
        m AS (SELECT *, CASE WHEN p IN ('.dbf','.dbc') THEN 'dbase' WHEN p IN ('.json','.xml','.csv','.parquet') THEN substr(p, 2) WHEN list_has_any(parts, ['.zip','.gz']) THEN 'archive' ELSE 'unknown' END AS family FROM k)
        SELECT n_nationkey, extension, regexp_replace(f, '^(\\.*[^.]+)((?:\\.[^.]+)*)$', '\\1') AS stem, p AS primary_extension, family, coalesce(p IN ('.dbc','.dbf','.xml','.csv','.json','.parquet'), false) OR family = 'archive' AS structured, 'Primary' AS path_type, false AS excluded FROM m""",
    "period_ord_kind": """WITH s AS (SELECT o_orderkey, o_orderdate AS t, o_orderkey % 4 AS k FROM orders)
        SELECT o_orderkey, CASE k WHEN 0 THEN year(t) * 100 WHEN 1 THEN year(t) * 100 + month(t) WHEN 2 THEN (year(t) * 100 + month(t)) * 100 + day(t) END AS ord, ['Y','YM','YMD','UNK'][CAST(k + 1 AS INTEGER)] AS kind,
        CASE WHEN k < 3 THEN CAST(year(t) AS INTEGER) END AS year, CASE WHEN k IN (1, 2) THEN CAST(month(t) AS INTEGER) END AS month FROM s""",
    "payload_normalize": """SELECT event_id, CASE event_id % 5 WHEN 0 THEN CAST(json_extract_string(props, '$.k') || '.5' AS DOUBLE) WHEN 4 THEN CAST(json_extract_string(props, '$.k') AS DOUBLE) END AS value FROM events""",
    "aggregate_to_record": """SELECT lpad(CAST(user_id AS VARCHAR), 7, '3') AS municipality, CAST(year(ts) AS INTEGER) AS year, CAST(month(ts) AS INTEGER) AS month, value IS NOT NULL AS included, count(*) AS n, round(sum(value), 4) AS value FROM events GROUP BY 1,2,3,4""",
    "string_metrics": _METRICS,
    "disputed_pairs": f"SELECT a, b, spread, CAST(row_number() OVER (ORDER BY spread DESC, a, b) AS INTEGER) AS rank FROM ({_METRICS}) WHERE spread IS NOT NULL ORDER BY spread DESC, a, b LIMIT 20",
    "signatures": "SELECT n_nationkey, left(sha1('n_name|' || n_name), 16) AS signature, sha256(n_name) AS sha256 FROM nation",
    "column_summary": """WITH p AS (SELECT p_type, CASE WHEN p_partkey % 5 <> 0 THEN p_retailprice END AS v FROM part)
        SELECT p_type, count(*) AS n, round(avg(CASE WHEN v IS NULL THEN 1 ELSE 0 END), 9) AS na_rate, min(v) AS low, round(quantile_cont(v, 0.25), 6) AS q1, round(quantile_cont(v, 0.5), 6) AS median, round(avg(v), 6) AS mean, round(quantile_cont(v, 0.75), 6) AS q3, max(v) AS high FROM p GROUP BY 1""",
    "list_lines": """SELECT n_nationkey, CASE WHEN n_nationkey = 7 THEN NULL WHEN n_nationkey % 3 = 0 THEN 'dir' ELSE 'file' END AS entry_type, CASE WHEN n_nationkey <> 7 THEN CAST(n_nationkey * 100 AS BIGINT) END AS size,
        CASE WHEN n_nationkey <> 7 THEN 'Jan 0' || (n_nationkey % 9 + 1) || ' 12:30' END AS modified, CASE WHEN n_nationkey <> 7 THEN n_name || ' x.dbc' END AS name FROM nation""",
}
del UF_LIST
