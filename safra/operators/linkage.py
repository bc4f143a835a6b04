"""Complete-linkage clusters of items with sparse similarities, by reciprocal nearest neighbours in rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .graph import cut, drop


def reciprocal(edges: DataFrame, keys: list[str], cost: str) -> DataFrame:
    """``keys, lo, hi``: the edges (``lo, hi, cost``) that are the cheapest of both their ends; ties by ends."""
    rank = F.struct(F.col(cost).alias("cost"), "lo", "hi")
    ends = edges.select(*keys, F.explode(F.array("lo", "hi")).alias("end"), rank.alias("rank"))
    best = ends.groupBy(*keys, "end").agg(F.min("rank").alias("rank"))
    return best.groupBy(*keys, F.col("rank.lo").alias("lo"), F.col("rank.hi").alias("hi")).agg(F.count(F.lit(1)).alias("_both")).where("_both = 2").drop("_both")


def complete_linkage(items: DataFrame, pairs: DataFrame, least: float) -> DataFrame:
    """``item, cluster``: agglomeration by the least similarity between two clusters' members, down to ``least`` (above 0); a cluster is its smallest item.

    ``items`` has ``item``, ``pairs`` ``a, b, similarity``; pairs that are not there have similarity 0. The most similar
    clusters merge first, ties by name. Merging two clusters makes neither more similar to a third one, so all clusters that
    are each other's most similar merge in the same round, with the result of one merge at a time.
    """
    each = pairs.where((F.col("similarity") >= least) & (F.col("a") != F.col("b"))).select(F.least("a", "b").alias("lo"), F.greatest("a", "b").alias("hi"), "similarity")
    edges = cut(each.groupBy("lo", "hi").agg(F.max("similarity").alias("similarity")))
    labels = cut(items.select("item", F.col("item").alias("cluster")).where("item is not null").distinct())
    while edges.limit(1).count():
        merged = cut(reciprocal(edges.withColumn("cost", -F.col("similarity")), [], "cost"))
        into = merged.select(F.col("hi").alias("_old"), F.col("lo").alias("_new"))
        moved = edges
        for end in ("lo", "hi"):
            moved = moved.join(into, moved[end] == into["_old"], "left").withColumn(end, F.coalesce("_new", end)).drop("_old", "_new")
        parts = merged.select(F.col("lo").alias("_c"), F.lit(2).alias("_n"))
        moved = moved.where("lo != hi").select(F.least("lo", "hi").alias("lo"), F.greatest("lo", "hi").alias("hi"), "similarity")
        found = moved.groupBy("lo", "hi").agg(F.min("similarity").alias("similarity"), F.count(F.lit(1)).alias("_have"))
        for end in ("lo", "hi"):
            found = found.join(parts.select(F.col("_c").alias(f"_c{end}"), F.col("_n").alias(f"_n{end}")), F.col(end) == F.col(f"_c{end}"), "left").drop(f"_c{end}")
        kept = found.where(F.col("_have") == F.coalesce("_nlo", F.lit(1)) * F.coalesce("_nhi", F.lit(1))).select("lo", "hi", "similarity")
        after = cut(kept), cut(labels.join(into, labels["cluster"] == into["_old"], "left").select("item", F.coalesce("_new", "cluster").alias("cluster")))
        drop(edges, labels, merged)
        edges, labels = after
    drop(edges)
    return labels
