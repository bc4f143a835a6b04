"""The driver's tables read as the records that operators take."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.paths import UF


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def order_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as canonical records: support (nation, year), status as subgroup, priority and segment as codes."""
    orders = table(spark, sf_dir, "orders")
    customer = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_mktsegment")
    nation = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    rows = orders.join(customer, orders["o_custkey"] == customer["c_custkey"]).join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
    date = F.col("o_orderdate").cast("date")
    return rows.select(
        F.struct(F.col("n_name").alias("municipality"), F.year(date).alias("year"), F.month(date).alias("month"), date.alias("date")).alias("support"),
        F.lit("residence").alias("support_role"),
        F.lit("order").alias("event_type"),
        F.struct(F.lit("orders").alias("system"), F.col("c_mktsegment").alias("dataset"), F.lit(None).cast("string").alias("file")).alias("source"),
        F.create_map(F.lit("priority"), F.array("o_orderpriority")).alias("code_roles"),
        F.create_map(F.lit("status"), F.col("o_orderstatus")).alias("subgroups"),
        F.create_map(F.lit("price"), F.col("o_totalprice")).alias("continuous"),
        F.create_map(F.lit("segment"), F.array("c_mktsegment")).alias("annotations"),
        F.lit(1.0).alias("weight"),
        F.struct((F.col("o_orderstatus") != "P").alias("included"), F.array().cast("array<string>").alias("flags")).alias("quality"),
        F.create_map(F.lit("row"), F.col("o_orderkey").cast("string")).alias("provenance"),
    )


def line_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines as canonical records: support (flag as municipality, ship year), brand as code, quantity as weight and attribute."""
    part = table(spark, sf_dir, "part").select("p_partkey", "p_brand", "p_type")
    line = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_quantity", "l_extendedprice", "l_returnflag", "l_shipdate")
    date = F.col("l_shipdate").cast("date")
    return line.join(part, F.col("l_partkey") == F.col("p_partkey")).select(
        F.struct(F.col("l_returnflag").alias("municipality"), F.year(date).alias("year"), F.month(date).alias("month"), date.alias("date")).alias("support"),
        F.lit("occurrence").alias("support_role"),
        F.lit("line").alias("event_type"),
        F.struct(F.lit("lineitem").alias("system"), F.lit("part").alias("dataset"), F.lit(None).cast("string").alias("file")).alias("source"),
        F.create_map(F.lit("brand"), F.array("p_brand")).alias("code_roles"),
        F.create_map(F.lit("type"), F.col("p_type")).alias("subgroups"),
        F.create_map(F.lit("quantity"), F.col("l_quantity"), F.lit("price"), F.col("l_extendedprice")).alias("continuous"),
        F.create_map(F.lit("type"), F.array("p_type")).alias("annotations"),
        F.col("l_quantity").alias("weight"),
        F.struct(F.lit(True).alias("included"), F.array().cast("array<string>").alias("flags")).alias("quality"),
        F.create_map(F.lit("row"), F.col("l_orderkey").cast("string")).alias("provenance"),
    )


UF_LIST = "[" + ",".join(f"'{u}'" for u in UF) + "]"

#: The same files as ``manifest`` below, as DuckDB SQL; a prefix for WITH clauses.
MANIFEST_SQL = f"""
files AS (
  SELECT DISTINCT p_type AS prefix,
    CASE WHEN o_orderpriority = '1-URGENT' AND p_type IN ('PROMO','LARGE') THEN 'BR' ELSE {UF_LIST}[(c_nationkey + (o_orderkey % 3) * 9) % 27 + 1] END AS geo,
    right(CAST(year(o_orderdate) AS VARCHAR), 2) || CASE WHEN p_type = 'SMALL' THEN '' ELSE lpad(CAST(month(o_orderdate) AS VARCHAR), 2, '0') END AS code,
    CASE WHEN o_orderstatus = 'P' THEN 'PRELIM' ELSE 'FINAL' END AS stage,
    CASE WHEN p_type IN ('PROMO','STANDARD') THEN 'SYSA' WHEN p_type <> 'MEDIUM' THEN 'SYSB' WHEN year(o_orderdate) <= 1992 THEN 'SYSA' WHEN year(o_orderdate) <= 1995 THEN 'SYSB' ELSE 'SYSC' END AS sys_,
    CASE WHEN o_orderkey % 7 = 0 THEN '.csv' WHEN o_orderkey % 11 = 0 THEN '.json.zip' ELSE '.dbc' END AS ext
  FROM lineitem JOIN part ON l_partkey = p_partkey JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
), manifest AS (
  SELECT prefix, geo, code, ext, '/public/data/' || sys_ || '/' || stage AS directory, '/public/data/' || sys_ || '/' || stage || '/' || prefix || geo || code || ext AS path
  FROM files
)"""


def manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``path``: names like PROMOSP9803.dbc in directories of three systems, from the order lines. One prefix moves from system to system over the years."""
    line = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey")
    part = table(spark, sf_dir, "part").select("p_partkey", "p_type")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate", "o_orderpriority")
    customer = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    rows = line.join(part, F.col("l_partkey") == F.col("p_partkey")).join(orders, F.col("l_orderkey") == F.col("o_orderkey")).join(customer, F.col("o_custkey") == F.col("c_custkey"))
    key = F.col("o_orderkey")
    uf = F.element_at(F.array(*[F.lit(u) for u in UF]), ((F.col("c_nationkey") + (key % 3) * 9) % 27 + 1).cast("int"))
    geo = F.when((F.col("o_orderpriority") == "1-URGENT") & F.col("p_type").isin("PROMO", "LARGE"), "BR").otherwise(uf)
    month = F.when(F.col("p_type") == "SMALL", "").otherwise(F.date_format("o_orderdate", "MM"))
    stage = F.when(F.col("o_orderstatus") == "P", "PRELIM").otherwise("FINAL")
    ext = F.when(key % 7 == 0, ".csv").when(key % 11 == 0, ".json.zip").otherwise(".dbc")
    year = F.year("o_orderdate")
    system = F.when(F.col("p_type").isin("PROMO", "STANDARD"), "SYSA").when(F.col("p_type") != "MEDIUM", "SYSB").when(year <= 1992, "SYSA").when(year <= 1995, "SYSB").otherwise("SYSC")
    name = F.concat("p_type", geo, F.date_format("o_orderdate", "yy"), month, ext)
    return rows.select(F.concat_ws("/", F.lit("/public/data"), system, stage, name).alias("path")).distinct()
