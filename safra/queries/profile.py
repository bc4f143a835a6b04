"""Profiles of the star tables, and how alike their parts are."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import functions as F

from ..operators import graph
from ..operators import profile as p
from ..operators.graph import cut
from .common import table

TABLES = {"part": "p_partkey", "customer": "c_custkey", "supplier": "s_suppkey", "nation": "n_nationkey"}


def _cells(spark, d):
    return reduce(lambda a, b: a.unionByName(b), [p.long_form(table(spark, d, t), t, None, key) for t, key in TABLES.items()])


def field_profile(spark, d):
    return p.field_profiles(_cells(spark, d)).select("path", "name", "primitive_type", "non_null", "nulls", "distinct_seen", F.array_join("samples", "|").alias("samples"))


def variable_catalog(spark, d):
    members = spark.createDataFrame([("part", "A"), ("part", "B"), ("customer", "A"), ("supplier", "B")], "path string, family_id string")
    out = p.variable_catalog(p.field_profiles(_cells(spark, d)), members, 3)
    return out.select("variable", "family_count", "file_count", F.array_join("scopes", ",").alias("scopes"), F.array_join("primitive_types", ",").alias("primitive_types"), F.array_join("samples", "|").alias("samples"))


def schema_signature(spark, d):
    return p.schema_signature(p.field_profiles(_cells(spark, d)))


def _sets(spark, d):
    """What an order holds: brand and supplier of each of its lines, so the items grow in number with the orders."""
    part = table(spark, d, "part").select("p_partkey", "p_brand")
    line = table(spark, d, "lineitem").select("l_orderkey", "l_partkey", "l_suppkey")
    item = F.concat_ws("|", "p_brand", F.col("l_suppkey").cast("string")).alias("item")
    return line.join(part, F.col("l_partkey") == F.col("p_partkey")).select("l_orderkey", item).distinct()


def family_jaccard(spark, d):
    return p.jaccard_pairs(_sets(spark, d), "l_orderkey", "item", 0.6).withColumn("similarity", F.round("similarity", 9))


def components(spark, d):
    sets = cut(_sets(spark, d))
    pairs = p.jaccard_pairs(sets, "l_orderkey", "item", 0.7).select("a", "b")
    return graph.connected_components(sets.select(F.col("l_orderkey").alias("node")).distinct(), pairs)


def _seasons(spark, d):
    """Profiles of the orders of each nation and season as files of one family a nation; the columns are named by the season."""
    customer = table(spark, d, "customer").select("c_custkey", "c_nationkey")
    orders = table(spark, d, "orders").join(customer, F.col("o_custkey") == F.col("c_custkey"))
    season = F.quarter("o_orderdate").cast("string")
    cells = orders.select(F.concat_ws("/", F.col("c_nationkey").cast("string"), season).alias("path"), F.explode(F.array(
        F.struct(F.concat(F.lit("priority_code"), season).alias("name"), F.col("o_orderpriority").alias("value")), F.struct(F.concat(F.lit("status_code"), season).alias("name"), F.col("o_orderstatus").alias("value")),
    )).alias("c"), F.col("o_orderkey").alias("position"))
    profiles = cut(p.field_profiles(cells.select("path", "c.name", "position", "c.value")))
    members = profiles.select("path", F.col("path").alias("family_id")).distinct()
    return profiles, members, members.select(F.col("family_id").alias("node"), F.substring_index("family_id", "/", 1).alias("component"))


def variable_similarity(spark, d):
    return p.variable_pairs(*_seasons(spark, d))


def variable_clusters(spark, d):
    profiles, members, clusters = _seasons(spark, d)
    found = p.variable_clusters(cut(p.variable_pairs(profiles, members, clusters)), profiles, members, clusters)
    return found.withColumns({"variables": F.array_join("variables", ","), "families": F.array_join("families", ",")})


QUERIES = {f.__name__: f for f in (field_profile, variable_catalog, schema_signature, family_jaccard, components, variable_similarity, variable_clusters)}

_COLUMNS = {
    "part": ["p_partkey", "p_name", "p_brand", "p_type", "p_size", "p_retailprice"],
    "customer": ["c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment"],
    "supplier": ["s_suppkey", "s_name", "s_nationkey", "s_acctbal"],
    "nation": ["n_nationkey", "n_name", "n_regionkey"],
}


def _shown(c):
    return f"CASE WHEN typeof({c}) = 'DOUBLE' THEN CAST({c} AS VARCHAR) ELSE CAST({c} AS VARCHAR) END"


_CELLS = "cells AS (" + " UNION ALL ".join(
    f"SELECT '{t}' AS path, '{c}' AS name, row_number() OVER (ORDER BY {TABLES[t]}) AS k, nullif(trim(CAST({c} AS VARCHAR)), '') AS v FROM (SELECT * FROM {t} ORDER BY {TABLES[t]})" for t, cs in _COLUMNS.items() for c in cs
) + ")"
_FACTS = f"""{_CELLS}, ranked AS (SELECT path, name, v, n, row_number() OVER (PARTITION BY path, name ORDER BY n DESC, first_at) AS r FROM (SELECT path, name, v, count(*) AS n, min(k) AS first_at FROM cells GROUP BY 1, 2, 3)),
    tops AS (SELECT path, name, string_agg(v, '|' ORDER BY r) AS samples FROM ranked WHERE r <= 12 GROUP BY 1, 2),
    facts AS (SELECT path, name, count(v) AS non_null, count(*) - count(v) AS nulls, count(DISTINCT v) FILTER (WHERE k <= 1000) AS distinct_seen, bool_and(regexp_full_match(v, '[0-9]+')) AS digits, max(length(v)) FILTER (WHERE k <= 100) AS len100,
      count(DISTINCT v) FILTER (WHERE k <= 50) AS d50, count(DISTINCT v) FILTER (WHERE k <= 100) AS d100, bool_and(regexp_full_match(replace(replace(v, '-', ''), '/', ''), '[0-9]{{6}}|[0-9]{{8}}')) FILTER (WHERE k <= 50) AS dates,
      bool_and(try_cast(v AS DOUBLE) IS NOT NULL) FILTER (WHERE k <= 50) AS floats FROM cells GROUP BY 1, 2),
    typed AS (SELECT *, CASE WHEN digits THEN CASE WHEN len100 <= 2 AND d50 <= 20 THEN 'categorical_code' ELSE 'integer' END WHEN dates THEN 'date' WHEN floats THEN 'numeric' WHEN d100 <= 20 THEN 'categorical_text' ELSE 'text' END AS primitive_type FROM facts)"""
_SIG = ", ".join(f"('{t}', '{'|'.join(sorted(cs))}', {len(cs)})" for t, cs in _COLUMNS.items())
_SUP = """e AS (SELECT DISTINCT l_orderkey AS i, p_brand || '|' || CAST(l_suppkey AS VARCHAR) AS v FROM lineitem JOIN part ON l_partkey = p_partkey), n AS (SELECT i, count(*) AS n FROM e GROUP BY 1),
    s AS (SELECT l.i AS a, r.i AS b, count(*) AS shared FROM e l JOIN e r ON l.v = r.v AND l.i < r.i GROUP BY 1, 2), j AS (SELECT a, b, shared, CAST(shared AS DOUBLE) / (x.n + y.n - shared) AS similarity FROM s JOIN n x ON x.i = a JOIN n y ON y.i = b)"""
_SIMILAR = """WITH q AS (SELECT DISTINCT c_nationkey AS n, quarter(o_orderdate) AS s FROM orders JOIN customer ON o_custkey = c_custkey),
        v AS (SELECT DISTINCT c_nationkey AS n, quarter(o_orderdate) AS s, unnest([{'k': 'PRIORITY_CODE', 'v': o_orderpriority}, {'k': 'STATUS_CODE', 'v': o_orderstatus}]) AS c FROM orders JOIN customer ON o_custkey = c_custkey),
        x AS (SELECT n, s, c.k AS k, list(DISTINCT c.v) AS space FROM v GROUP BY 1, 2, 3),
        j AS (SELECT l.n, l.k, l.s AS ls, r.s AS rs, CAST(len(list_intersect(l.space, r.space)) AS DOUBLE) / len(list_distinct(l.space || r.space)) AS w FROM x l JOIN x r ON l.n = r.n AND l.k = r.k AND l.s < r.s)
        SELECT CAST(n AS VARCHAR) AS component, k || ls AS a, k || rs AS b, round(2.0 * (length(k) - 1) / (2 * length(k)), 4) AS name_similarity, round(w, 4) AS value_similarity FROM j WHERE w >= 0.6"""
SQL = {
    "field_profile": f"WITH {_FACTS} SELECT path, name, primitive_type, non_null, nulls, distinct_seen, samples FROM typed JOIN tops USING (path, name)",
    "variable_catalog": f"""WITH {_FACTS}, m(path, family_id) AS (VALUES ('part', 'A'), ('part', 'B'), ('customer', 'A'), ('supplier', 'B'))
        SELECT upper(name) AS variable, count(DISTINCT family_id) AS family_count, count(DISTINCT path) AS file_count, coalesce(string_agg(DISTINCT family_id, ',' ORDER BY family_id), '') AS scopes, min(primitive_type) AS primitive_types, any_value(s3) AS samples
        FROM typed LEFT JOIN m USING (path) JOIN (SELECT path, name, string_agg(v, '|' ORDER BY v) AS s3 FROM (SELECT *, row_number() OVER (PARTITION BY path, name ORDER BY v) AS nth FROM ranked WHERE r <= 12 AND v IS NOT NULL) WHERE nth <= 3 GROUP BY 1, 2) USING (path, name) GROUP BY 1""",
    "schema_signature": f"SELECT path, left(sha1(names), 16) AS schema_signature, CAST(n AS BIGINT) AS fields FROM (VALUES {_SIG}) t(path, names, n)",
    "family_jaccard": f"WITH {_SUP} SELECT a, b, shared, round(similarity, 9) AS similarity FROM j WHERE similarity >= 0.6",
    "variable_similarity": _SIMILAR,
    "variable_clusters": f"""WITH RECURSIVE s AS ({_SIMILAR}), l AS (SELECT component, a, b FROM s UNION SELECT component, b, a FROM s),
        w AS (SELECT component, a AS x, a AS y FROM l UNION SELECT w.component, w.x, l.b FROM w JOIN l ON l.component = w.component AND l.a = w.y), p AS (SELECT component, x, min(y) AS part FROM w GROUP BY 1, 2),
        t AS (SELECT p.component, part, max(name_similarity) AS n, max(value_similarity) AS v FROM s JOIN p ON p.component = s.component AND p.x = s.a GROUP BY 1, 2)
        SELECT component, string_agg(x, ',' ORDER BY x) AS variables, string_agg(DISTINCT component || '/' || right(x, 1), ',' ORDER BY component || '/' || right(x, 1)) AS families, n AS strongest_name_similarity, v AS strongest_value_similarity FROM p JOIN t USING (component, part) GROUP BY component, part, n, v""",
    "components": f"""WITH RECURSIVE {_SUP}, l AS (SELECT a, b FROM j WHERE similarity >= 0.7 UNION SELECT b, a FROM j WHERE similarity >= 0.7), w AS (SELECT i AS a, i AS b FROM n UNION SELECT w.a, l.b FROM w JOIN l ON w.b = l.a) SELECT a AS node, min(b) AS component FROM w GROUP BY 1""",
}
