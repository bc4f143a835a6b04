"""Observables over orders and order lines."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.codes import CodeQuery
from ..operators import observables as o
from .common import line_records, order_records, table

ORDERS = "orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey"
LINES = "lineitem JOIN part ON l_partkey = p_partkey"


def _order_counts(spark, d):
    return o.counts(order_records(spark, d), family="orders", support=["municipality", "year"], subgroups=["status"])


def counts_by_support(spark, d):
    return _order_counts(spark, d).cells.orderBy("municipality", "year", "status")


def counts_included(spark, d):
    return o.counts(order_records(spark, d), family="orders", support=["municipality"], exclude=True).cells


def weighted_counts(spark, d):
    return o.counts(line_records(spark, d), family="lines", support=["municipality", "year"]).cells


def counts_multigrain(spark, d):
    grains = [["municipality", "year", "status"], ["municipality", "year"], ["year"], []]
    return o.multigrain(order_records(spark, d), grains, support=["municipality", "year"], subgroups=["status"])


def code_count_prefix(spark, d):
    return o.code_counts(line_records(spark, d), CodeQuery("brand", "Brand#1"), family="brand", support=["municipality", "year"]).cells


def code_count_range(spark, d):
    return o.code_counts(order_records(spark, d), CodeQuery("priority", "1-3"), family="priority", support=["municipality", "year"]).cells


def code_count_exact(spark, d):
    return o.code_counts(line_records(spark, d), CodeQuery("brand", "Brand#1", descendants=False), family="brand", support=["municipality", "year"], subgroups=["type"]).cells


def code_count_any_slot(spark, d):
    part = table(spark, d, "part").select("p_partkey", "p_brand", "p_type")
    line = table(spark, d, "lineitem").select("l_orderkey", "l_partkey")
    slots = line.join(part, F.col("l_partkey") == F.col("p_partkey")).groupBy("l_orderkey").agg(F.collect_list("p_brand").alias("brands"), F.collect_list("p_type").alias("types"))
    orders = table(spark, d, "orders").select("o_orderkey", "o_orderstatus")
    rows = orders.join(slots, F.col("o_orderkey") == F.col("l_orderkey")).select(
        F.struct(F.col("o_orderstatus").alias("municipality")).alias("support"),
        F.lit("order").alias("support_role"),
        F.create_map(F.lit("brand"), F.col("brands")).alias("code_roles"),
        F.create_map(F.lit("x"), F.lit("y")).alias("subgroups"),
        F.create_map(F.lit("types"), F.col("types")).alias("annotations"),
        F.lit(1.0).alias("weight"),
    )
    by_brand = o.code_counts(rows, CodeQuery("brand", "Brand#1"), family="any", support=["municipality"]).cells
    by_type = o.code_counts(rows, CodeQuery("brand", "PROMO"), family="any", support=["municipality"]).cells
    naive = rows.select("support.municipality", F.size(F.filter(F.col("code_roles")["brand"], lambda c: CodeQuery("brand", "Brand#1").matches(c))).alias("n")).groupBy("municipality").agg(F.sum("n").alias("slots"))
    return by_brand.withColumnRenamed("value", "by_brand").join(by_type.withColumnRenamed("value", "by_type"), "municipality", "full").join(naive, "municipality", "full")


def threshold_counts(spark, d):
    return o.threshold_counts(line_records(spark, d), "quantity", lambda q: q < 25, family="small", support=["municipality", "year"]).cells


def _finished(spark, d, keys):
    records = order_records(spark, d)
    return o.counts(records.where(F.col("subgroups")["status"] == "F"), family="finished", support=keys), o.counts(records, family="all", support=keys)


def shrunk_rates(spark, d):
    top, bottom = _finished(spark, d, ["municipality", "year"])
    cells = o.rates(top, bottom.cells, family="finished").cells
    return cells.select("municipality", "year", "denominator", F.round("value", 9).alias("value"))


def rates_null_safe(spark, d):
    records = order_records(spark, d)
    blank = F.nullif(F.col("support.municipality"), F.lit("NATION_3"))
    records = records.withColumn("support", F.struct(blank.alias("municipality"), F.col("support.year").alias("year")))
    top = o.counts(records.where(F.col("subgroups")["status"] == "F"), family="f", support=["municipality"])
    return o.rates(top, o.counts(records, family="all", support=["municipality"]).cells, family="f").cells.select("municipality", "denominator", F.round("value", 9).alias("value"))


def record_validation(spark, d):
    records = order_records(spark, d)
    month = F.col("support.month")
    support = F.struct(F.when(month != 1, F.col("support.municipality")).alias("municipality"), F.col("support.year").alias("year"))
    shaped = records.withColumns({"support_role": F.when(month != 2, F.col("support_role")), "event_type": F.when(month == 3, "").otherwise(F.col("event_type")), "support": support})
    out = o.validation(shaped)
    return out.groupBy("valid", F.array_join("errors", ",").alias("errors"), F.array_join("warnings", ",").alias("warnings")).agg(F.count(F.lit(1)).alias("n"))


def intensive_rollup(spark, d):
    top, bottom = _finished(spark, d, ["municipality", "year"])
    return o.intensive_rollup(o.rates(top, bottom.cells, family="f").cells, ["year"]).select("year", "denominator", F.round("value", 9).alias("value"))


def gamma_poisson_rate(spark, d):
    top, bottom = _finished(spark, d, ["municipality"])
    joined = top.cells.withColumnRenamed("value", "y").join(bottom.cells.withColumnRenamed("value", "n"), "municipality")
    share = joined.select(F.sum("y").alias("ty"), F.sum("n").alias("tn"))
    return joined.crossJoin(F.broadcast(share)).select("municipality", F.round(o.gamma_poisson(F.col("y"), F.col("n") * F.col("ty") / F.col("tn")), 9).alias("ratio"))


def contextual_clone(spark, d):
    yearly = o.extensive_rollup(_order_counts(spark, d).cells, ["municipality"]).withColumnRenamed("value", "context")
    return o.contextual_clone(_order_counts(spark, d).cells, yearly, ["municipality"])


def code_rollup(spark, d):
    """Counts at every prefix length of a code (extension)."""
    code = F.upper(F.regexp_replace("p_brand", "[^A-Za-z0-9]", ""))
    part = table(spark, d, "part").select(code.alias("code"))
    split = part.select(F.substring("code", 1, 5).alias("root"), F.substring("code", 1, 6).alias("branch"), F.col("code").alias("leaf"))
    return split.rollup("root", "branch", "leaf").agg(F.count(F.lit(1)).alias("n"))


QUERIES = {
    f.__name__: f
    for f in (
        counts_by_support, counts_included, weighted_counts, counts_multigrain, code_count_prefix, code_count_range, code_count_exact, code_count_any_slot,
        threshold_counts, shrunk_rates, rates_null_safe, record_validation, intensive_rollup, gamma_poisson_rate, contextual_clone, code_rollup,
    )
}

_CODE = "upper(regexp_replace({}, '[^A-Za-z0-9]', '', 'g'))"
SQL = {
    "counts_by_support": f"SELECT n_name AS municipality, CAST(year(o_orderdate) AS INTEGER) AS year, o_orderstatus AS status, CAST(count(*) AS DOUBLE) AS value FROM {ORDERS} GROUP BY 1,2,3",
    "counts_included": f"SELECT n_name AS municipality, CAST(count(*) AS DOUBLE) AS value FROM {ORDERS} WHERE o_orderstatus <> 'P' GROUP BY 1",
    "weighted_counts": f"SELECT l_returnflag AS municipality, CAST(year(l_shipdate) AS INTEGER) AS year, sum(l_quantity) AS value FROM {LINES} GROUP BY 1,2",
    "counts_multigrain": f"""SELECT n_name AS municipality, CAST(year(o_orderdate) AS INTEGER) AS year, o_orderstatus AS status, CAST(grouping(n_name, CAST(year(o_orderdate) AS INTEGER), o_orderstatus) AS BIGINT) AS grain, CAST(count(*) AS DOUBLE) AS value
        FROM {ORDERS} GROUP BY GROUPING SETS ((n_name, CAST(year(o_orderdate) AS INTEGER), o_orderstatus), (n_name, CAST(year(o_orderdate) AS INTEGER)), (CAST(year(o_orderdate) AS INTEGER)), ())""",
    "code_count_prefix": f"SELECT l_returnflag AS municipality, CAST(year(l_shipdate) AS INTEGER) AS year, sum(l_quantity) AS value FROM {LINES} WHERE {_CODE.format('p_brand')} LIKE 'BRAND1%' GROUP BY 1,2",
    "code_count_range": f"SELECT n_name AS municipality, CAST(year(o_orderdate) AS INTEGER) AS year, CAST(count(*) AS DOUBLE) AS value FROM {ORDERS} WHERE left({_CODE.format('o_orderpriority')}, 1) BETWEEN '1' AND '3' GROUP BY 1,2",
    "code_count_exact": f"SELECT l_returnflag AS municipality, CAST(year(l_shipdate) AS INTEGER) AS year, p_type AS type, sum(l_quantity) AS value FROM {LINES} WHERE {_CODE.format('p_brand')} = 'BRAND1' GROUP BY 1,2,3",
    "code_count_any_slot": f"""WITH s AS (SELECT o_orderkey, o_orderstatus, bool_or({_CODE.format('p_brand')} LIKE 'BRAND1%') AS b, bool_or(p_type LIKE 'PROMO%') AS t, sum(CASE WHEN {_CODE.format('p_brand')} LIKE 'BRAND1%' THEN 1 ELSE 0 END) AS n
        FROM orders JOIN lineitem ON o_orderkey = l_orderkey JOIN part ON l_partkey = p_partkey GROUP BY 1,2)
        SELECT o_orderstatus AS municipality, CAST(count(*) FILTER (WHERE b) AS DOUBLE) AS by_brand, CAST(count(*) FILTER (WHERE t) AS DOUBLE) AS by_type, CAST(sum(n) AS BIGINT) AS slots FROM s GROUP BY 1""",
    "threshold_counts": f"SELECT l_returnflag AS municipality, CAST(year(l_shipdate) AS INTEGER) AS year, sum(l_quantity) AS value FROM {LINES} WHERE l_quantity < 25 GROUP BY 1,2",
    "shrunk_rates": f"""SELECT n_name AS municipality, CAST(year(o_orderdate) AS INTEGER) AS year, CAST(count(*) AS DOUBLE) AS denominator, round((count(*) FILTER (WHERE o_orderstatus = 'F') + 0.5) / (count(*) + 1.0), 9) AS value
        FROM {ORDERS} GROUP BY 1,2 HAVING count(*) FILTER (WHERE o_orderstatus = 'F') > 0""",
    "rates_null_safe": f"""WITH r AS (SELECT nullif(n_name, 'NATION_3') AS municipality, o_orderstatus FROM {ORDERS}), n AS (SELECT municipality, count(*) AS v FROM r WHERE o_orderstatus = 'F' GROUP BY 1), d AS (SELECT municipality, count(*) AS v FROM r GROUP BY 1)
        SELECT n.municipality, CAST(d.v AS DOUBLE) AS denominator, round((n.v + 0.5) / (d.v + 1.0), 9) AS value FROM n JOIN d ON n.municipality IS NOT DISTINCT FROM d.municipality""",
    "record_validation": f"""WITH r AS (SELECT month(o_orderdate) AS m, o_orderstatus AS s FROM {ORDERS})
        SELECT m NOT IN (2, 3) AS valid, CASE m WHEN 2 THEN 'missing_support_role' WHEN 3 THEN 'missing_event_type' ELSE '' END AS errors,
        concat_ws(',', CASE WHEN m = 1 THEN 'missing_support_municipality' END, CASE WHEN s = 'P' THEN 'record_marked_excluded' END) AS warnings, count(*) AS n FROM r GROUP BY 1,2,3""",
    "intensive_rollup": f"""WITH c AS (SELECT n_name, CAST(year(o_orderdate) AS INTEGER) AS year, count(*) AS d, count(*) FILTER (WHERE o_orderstatus = 'F') AS f FROM {ORDERS} GROUP BY 1,2)
        SELECT year, CAST(sum(d) AS DOUBLE) AS denominator, round(sum(d * (f + 0.5) / (d + 1.0)) / sum(d), 9) AS value FROM c WHERE f > 0 GROUP BY 1""",
    "gamma_poisson_rate": f"""WITH c AS (SELECT n_name AS municipality, count(*) AS n, count(*) FILTER (WHERE o_orderstatus = 'F') AS y FROM {ORDERS} GROUP BY 1)
        SELECT municipality, round((y + 0.5) / (CAST(n AS DOUBLE) * (SELECT sum(y) FROM c) / (SELECT sum(n) FROM c) + 0.5), 9) AS ratio FROM c WHERE y > 0""",
    "contextual_clone": f"""SELECT n_name AS municipality, CAST(year(o_orderdate) AS INTEGER) AS year, o_orderstatus AS status, CAST(count(*) AS DOUBLE) AS value, CAST(sum(count(*)) OVER (PARTITION BY n_name) AS DOUBLE) AS context FROM {ORDERS} GROUP BY 1,2,3""",
    "code_rollup": f"SELECT left(c, 5) AS root, left(c, 6) AS branch, c AS leaf, count(*) AS n FROM (SELECT {_CODE.format('p_brand')} AS c FROM part) GROUP BY ROLLUP (left(c, 5), left(c, 6), c)",
}
