"""The metadata catalogue over the driver's tables: a nation is a table, its orders by priority are its levels."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import catalog as c
from ..operators import translate as t
from ..plans import boolean, grammar
from .common import table

GRAMMAR = """# translations of the order status and a few columns
$ O_ORDERSTATUS cat Order status
~ STATUS ORDER_STATE
= F finished
= O open
@ PART P_BRAND code Brand of a part
> cid10 upper
~ MARKE
$ C_NAME txt Name of a customer
$ C_NATIONKEY num Nation
> ibge6
% manual.pdf
@ CUSTOMER C_NATIONKEY num Nation of a customer
"""
OTHER = """$ C_NAME id Customer
$ L_TAX num Tax
"""


def _catalog(spark, d):
    nation, region = table(spark, d, "nation"), table(spark, d, "region")
    head = nation.join(region, F.col("n_regionkey") == F.col("r_regionkey")).select(
        F.col("n_nationkey").cast("long").alias("id"), F.concat_ws(" ", F.lit("Tábua"), "n_name").alias("nome"), F.col("r_name").alias("pesquisa"), F.lit("Orders").alias("assunto"),
        F.lit(None).cast("string").alias("url"), F.lit("month").alias("freq"), F.lit("199501").alias("periodo_inicio"), F.lit("200108").alias("periodo_fim"),
    )
    orders = table(spark, d, "orders").select("o_custkey", "o_orderpriority")
    customer = table(spark, d, "customer").select("c_custkey", "c_nationkey", "c_mktsegment")
    both = orders.join(customer, F.col("o_custkey") == F.col("c_custkey"))
    own = F.col("c_nationkey").cast("long").alias("agregado_id")
    levels = both.groupBy(own, F.concat(F.lit("n"), F.substring("o_orderpriority", 1, 1)).alias("level_id")).agg(F.count(F.lit(1)).alias("locality_count"))
    supplier = table(spark, d, "supplier")
    names = F.element_at(F.array(*[F.lit(x) for x in ("Área média", "Número de óbitos", "-", "Valor (R$)")]), (F.col("s_suppkey") % 4 + 1).cast("int"))
    variables = supplier.select(F.col("s_nationkey").cast("long").alias("agregado_id"), F.col("s_suppkey").cast("string").alias("id"), names.alias("nome"), F.lit("un").alias("unidade"))
    classes = customer.select(own, F.col("c_mktsegment").alias("id"), F.initcap("c_mktsegment").alias("nome")).distinct()
    cats = both.select(own, F.col("c_mktsegment").alias("classification_id"), F.substring("o_orderpriority", 1, 1).alias("id"), F.col("o_orderpriority").alias("nome"), F.lit("x").alias("unidade"), F.lit(0).cast("long").alias("nivel")).distinct()
    return {"agregados": head, "agregados_levels": levels, "variables": variables, "classifications": classes, "categories": cats}


WHERE = 'N1 >= 130 AND (SURVEY~"africa" OR VAR~"numero de obitos") AND NOT N9'


def where_search(spark, d):
    found = c.search(c.contexts(_catalog(spark, d)), WHERE, 10)
    return found.select("table_id", "title", "n3", "n6", F.array_join("why", "|").alias("why"), "score")


def coverage_search(spark, d):
    return c.covered(_catalog(spark, d)["agregados_levels"], "( n1 >= 120 or N2 > 125 ) AND not N5 < 100").select("agregado_id", F.map_values("counts")[0].alias("n1"))


def coverage_levels(spark, d):
    names = sorted(boolean.levels(boolean.parse(WHERE)))
    return spark.createDataFrame([(n,) for n in names], "level string")


def catalog_links(spark, d):
    tables = _catalog(spark, d)
    parts = [
        c.links(tables["variables"], "agregado_id").select(F.lit("var").alias("kind"), "name_key", "agregado_id"),
        c.links(tables["classifications"], "agregado_id").select(F.lit("class").alias("kind"), "name_key", "agregado_id"),
        c.category_links(tables["categories"], tables["classifications"]).select(F.lit("cat").alias("kind"), F.concat_ws("::", "class_key", "name_key").alias("name_key"), "agregado_id"),
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2]).groupBy("kind").agg(F.count(F.lit(1)).alias("links"), F.countDistinct("name_key").alias("names"))


def upsert_replace(spark, d):
    part = table(spark, d, "part").select("p_partkey", "p_brand", "p_size")
    new = part.where("p_partkey % 7 = 0").withColumn("p_size", F.col("p_size") + 100)
    return c.upsert(part.where("p_partkey % 5 != 0"), new, ["p_partkey"])


def period_positions(spark, d):
    rows = table(spark, d, "customer").select(F.col("c_nationkey").cast("long").alias("agregado_id"), F.concat(F.lit("P"), F.col("c_custkey").cast("string")).alias("periodo_id"), F.when(F.col("c_custkey") % 3 != 0, F.col("c_custkey") % 50).alias("periodo_ord"))
    return c.period_order(rows).select("agregado_id", "periodo_id", "position")


def metadata_shred(spark, d):
    text = F.to_json(F.struct(F.col("s_suppkey").alias("id"), F.col("s_name").alias("nome"), F.array(F.struct(F.lit("1").alias("id"), F.lit("Total").alias("nome"), F.lit("un").alias("unidade"))).alias("variaveis"),
        F.array(F.struct(F.lit("c").alias("id"), F.lit("Sex").alias("nome"), F.array(F.struct(F.lit("m").alias("id"), F.lit("Male").alias("nome")), F.struct(F.lit("f").alias("id"), F.lit("Female").alias("nome"))).alias("categorias"))).alias("classificacoes")))
    cats = c.shred(table(spark, d, "supplier").select(text.alias("payload")))["categories"]
    return cats.select("agregado_id", "classification_id", "id", "nome")


def _registry(spark):
    return grammar.registry(spark, grammar.parse(GRAMMAR))


def grammar_lines(spark, d):
    again = grammar.registry(spark, grammar.parse(grammar.emit(grammar.parse(GRAMMAR))))
    return again.select("scope", "variable", "kind", "label", F.size("value_map").alias("values"), F.array_join("rules", " ").alias("rules"), F.array_join("aliases", " ").alias("aliases"))


def translate_values(spark, d):
    rows = table(spark, d, "orders").select(F.col("o_orderstatus").alias("STATUS"), F.concat(F.lit(" 12-"), F.col("o_orderkey").cast("string"), F.lit("34567")).alias("C_NATIONKEY"), F.col("o_orderpriority").alias("P_BRAND"))
    out = t.translate_columns(rows, grammar.parse(GRAMMAR), "PART")
    return out.groupBy("STATUS", F.substring("C_NATIONKEY", 1, 3).alias("code"), "P_BRAND").agg(F.count(F.lit(1)).alias("n"))


def _names(spark, d):
    parts = [spark.createDataFrame([(x,) for x in table(spark, d, n).columns], "variable string") for n in ("part", "customer", "orders")]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


def translate_coverage(spark, d):
    return t.coverage(_names(spark, d), _registry(spark), ["PART"])


def registry_merge(spark, d):
    other = grammar.registry(spark, grammar.parse(OTHER))
    return t.merge([_registry(spark), other]).select("scope", "variable", "kind", "label")


def registry_lint(spark, d):
    bad = grammar.registry(spark, grammar.parse(GRAMMAR + "$ c_name odd x\n$ KIND_ cat No map\n"))
    return t.lint(bad).select("scope", "variable", F.array_join("errors", ",").alias("errors"), F.array_join("warnings", ",").alias("warnings"))


QUERIES = {
    f.__name__: f
    for f in (
        where_search, coverage_search, coverage_levels, catalog_links, upsert_replace, period_positions, metadata_shred, grammar_lines, translate_values, translate_coverage, registry_merge, registry_lint,
    )
}

_LEVELS = "lv AS (SELECT c_nationkey AS id, left(o_orderpriority, 1) AS l, count(*) AS n FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1, 2), p AS (SELECT id, coalesce(max(n) FILTER (WHERE l = '1'), 0) AS n1, coalesce(max(n) FILTER (WHERE l = '2'), 0) AS n2, coalesce(max(n) FILTER (WHERE l = '3'), 0) AS n3, coalesce(max(n) FILTER (WHERE l = '5'), 0) AS n5 FROM lv GROUP BY 1)"
SQL = {
    "where_search": f"""WITH {_LEVELS}, s AS (SELECT n_nationkey AS id, n_name, r_name = 'AFRICA' AS af, EXISTS (SELECT 1 FROM supplier WHERE s_nationkey = n_nationkey AND s_suppkey % 4 = 1) AS ob FROM nation JOIN region ON n_regionkey = r_regionkey)
        SELECT CAST(id AS BIGINT) AS table_id, 'Tábua ' || n_name AS title, n3, CAST(0 AS BIGINT) AS n6, 'N1>=130|' || CASE WHEN af THEN 'SURVEY~africa' ELSE 'VAR~numero de obitos' END AS why, 2.0 AS score
        FROM s JOIN p USING (id) WHERE n1 >= 130 AND (af OR ob) ORDER BY id LIMIT 10""",
    "coverage_search": f"WITH {_LEVELS} SELECT CAST(id AS BIGINT) AS agregado_id, n1 FROM p WHERE (n1 >= 120 OR n2 > 125) AND NOT n5 < 100",
    "coverage_levels": "SELECT unnest(['N1', 'N9']) AS level",
    "catalog_links": """WITH v AS (SELECT DISTINCT s_nationkey AS id, s_suppkey % 4 AS k FROM supplier WHERE s_suppkey % 4 <> 2), c AS (SELECT DISTINCT c_nationkey AS id, c_mktsegment AS k FROM customer),
        g AS (SELECT DISTINCT c_nationkey AS id, c_mktsegment || o_orderpriority AS k FROM orders JOIN customer ON o_custkey = c_custkey)
        SELECT 'var' AS kind, (SELECT count(*) FROM (SELECT DISTINCT s_nationkey, s_suppkey % 4 FROM supplier WHERE s_suppkey % 4 <> 2)) + (SELECT count(DISTINCT s_nationkey) FROM supplier WHERE s_suppkey % 4 = 2) AS links, (SELECT count(DISTINCT s_suppkey % 4) FROM supplier) AS names
        UNION ALL SELECT 'class', count(*), count(DISTINCT k) FROM c UNION ALL SELECT 'cat', count(*), count(DISTINCT k) FROM g""",
    "upsert_replace": "SELECT p_partkey, p_brand, p_size FROM part WHERE p_partkey % 5 <> 0 AND p_partkey % 7 <> 0 UNION ALL SELECT p_partkey, p_brand, p_size + 100 FROM part WHERE p_partkey % 7 = 0",
    "period_positions": """SELECT CAST(c_nationkey AS BIGINT) AS agregado_id, 'P' || c_custkey AS periodo_id, CAST(row_number() OVER (PARTITION BY c_nationkey ORDER BY CASE WHEN c_custkey % 3 <> 0 THEN c_custkey % 50 ELSE 99999999 END, 'P' || c_custkey) AS INTEGER) AS position FROM customer""",
    "metadata_shred": "SELECT s_suppkey AS agregado_id, 'c' AS classification_id, id, nome FROM supplier, (VALUES ('m', 'Male'), ('f', 'Female')) v(id, nome)",
    "grammar_lines": """SELECT * FROM (VALUES ('GLOBAL', 'O_ORDERSTATUS', 'cat', 'Order status', 2, '', 'STATUS ORDER_STATE'), ('PART', 'P_BRAND', 'code', 'Brand of a part', 0, 'cid10 upper', 'MARKE'), ('GLOBAL', 'C_NAME', 'txt', 'Name of a customer', 0, '', ''),
        ('GLOBAL', 'C_NATIONKEY', 'num', 'Nation', 0, 'ibge6', ''), ('CUSTOMER', 'C_NATIONKEY', 'num', 'Nation of a customer', 0, '', '')) t(scope, variable, kind, label, "values", rules, aliases)""",
    "translate_values": """SELECT CASE o_orderstatus WHEN 'F' THEN 'finished' WHEN 'O' THEN 'open' ELSE o_orderstatus END AS "STATUS", left('12' || o_orderkey, 3) AS code, upper(replace(o_orderpriority, '.', '')) AS "P_BRAND", count(*) AS n FROM orders GROUP BY 1, 2, 3""",
    "translate_coverage": """WITH v AS (SELECT DISTINCT upper(column_name) AS v FROM information_schema.columns WHERE table_name IN ('part', 'customer', 'orders'))
        SELECT v IN ('O_ORDERSTATUS', 'C_NAME', 'C_NATIONKEY', 'P_BRAND') AS covered, count(*) AS n, string_agg(v, ',' ORDER BY v) AS variables FROM v GROUP BY 1""",
    "registry_merge": """SELECT * FROM (VALUES ('GLOBAL', 'O_ORDERSTATUS', 'cat', 'Order status'), ('PART', 'P_BRAND', 'code', 'Brand of a part'), ('GLOBAL', 'C_NAME', 'id', 'Customer'), ('GLOBAL', 'C_NATIONKEY', 'num', 'Nation'), ('CUSTOMER', 'C_NATIONKEY', 'num', 'Nation of a customer'), ('GLOBAL', 'L_TAX', 'num', 'Tax')) t(scope, variable, kind, label)""",
    "registry_lint": """SELECT * FROM (VALUES ('GLOBAL', 'O_ORDERSTATUS', '', ''), ('PART', 'P_BRAND', '', ''), ('GLOBAL', 'C_NAME', 'duplicate_key', ''), ('GLOBAL', 'C_NATIONKEY', '', ''), ('CUSTOMER', 'C_NATIONKEY', '', ''), ('GLOBAL', 'c_name', 'duplicate_key,unknown_kind', ''), ('GLOBAL', 'KIND_', '', 'cat_without_value_map')) t(scope, variable, errors, warnings)""",
}
