"""Any table of parents as a hierarchy of codes: closure, counts pushed up, totals shared down."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .graph import cut, drop


def closure(edges: DataFrame) -> DataFrame:
    """``node, ancestor, steps``: every node with itself (0 steps) and all above it, by the shortest way. ``edges``: ``child, parent``; a child may have several parents.

    Ways of doubling length are joined, so the rounds are the logarithm of the depth. A circle is an error.
    """
    own = edges.where("child is not null and parent is not null and child != parent")
    ways = cut(own.select(F.col("child").alias("node"), F.col("parent").alias("ancestor"), F.lit(1).alias("steps")).distinct())
    known = ways.count()
    while True:
        onward = ways.select(F.col("node").alias("ancestor"), F.col("ancestor").alias("_top"), F.col("steps").alias("_more"))
        longer = ways.join(onward, "ancestor").select("node", F.col("_top").alias("ancestor"), (F.col("steps") + F.col("_more")).alias("steps"))
        grown = cut(ways.unionByName(longer).groupBy("node", "ancestor").agg(F.min("steps").alias("steps")))
        drop(ways)
        ways, before, known = grown, known, grown.count()
        if ways.where("node = ancestor").limit(1).count():
            raise ValueError("the parents form a circle")
        if known == before:
            break
    nodes = own.select(F.explode(F.array("child", "parent")).alias("node")).distinct()
    return ways.unionByName(nodes.select("node", F.col("node").alias("ancestor"), F.lit(0).alias("steps")))


def roll_up(counts: DataFrame, edges: DataFrame) -> DataFrame:
    """``node, own, value``: what a node has itself, and with all below it. ``counts``: ``node, value``; a node that is under another by several ways counts once."""
    own = cut(counts.groupBy("node").agg(F.sum("value").alias("own")))
    above = closure(edges)
    up = own.join(above, "node").groupBy(F.col("ancestor").alias("node")).agg(F.sum("own").alias("_value"))
    met = up.join(own, "node", "full")
    return met.select("node", F.coalesce("own", F.lit(0)).alias("own"), F.coalesce("_value", "own").alias("value"))


def shares(edges: DataFrame, weights: DataFrame) -> DataFrame:
    """``child, parent, share``: a parent divided among its children by ``weights`` (``node, weight``; missing: 0), equally where all weigh nothing."""
    weighed = edges.join(weights.select(F.col("node").alias("child"), "weight"), "child", "left").select("child", "parent", F.coalesce(F.col("weight").cast("double"), F.lit(0.0)).alias("w"))
    whole = weighed.groupBy("parent").agg(F.sum("w").alias("_w"), F.count(F.lit(1)).alias("_n"))
    share = F.when(F.col("_w") > 0, F.col("w") / F.col("_w")).otherwise(1 / F.col("_n"))
    return weighed.join(whole, "parent").select("child", "parent", share.alias("share"))


def descend(totals: DataFrame, edges: DataFrame, weights: DataFrame) -> DataFrame:
    """``node, value, leaf``: totals of nodes (``node, value``) shared down to all below them; the leaves under a node keep its sum.

    ``edges``: ``child, parent``, one parent a child (else an error). A total of a node deeper down is added to what comes from above.
    Shares are multiplied along ways of doubling length.
    """
    links = cut(shares(edges.where("child is not null and parent is not null and child != parent").select("child", "parent").distinct(), weights))
    if links.groupBy("child").count().where("count > 1").limit(1).count():
        raise ValueError("a child has several parents")
    ways = cut(links.select(F.col("child").alias("node"), F.col("parent").alias("ancestor"), "share"))
    known = ways.count()
    while True:
        onward = ways.select(F.col("node").alias("ancestor"), F.col("ancestor").alias("_top"), F.col("share").alias("_share"))
        longer = ways.join(onward, "ancestor").select("node", F.col("_top").alias("ancestor"), (F.col("share") * F.col("_share")).alias("share"))
        grown = cut(ways.unionByName(longer).groupBy("node", "ancestor").agg(F.max("share").alias("share")))
        drop(ways)
        ways, before, known = grown, known, grown.count()
        if ways.where("node = ancestor").limit(1).count():
            raise ValueError("the parents form a circle")
        if known == before:
            break
    own = cut(totals.groupBy("node").agg(F.sum(F.col("value").cast("double")).alias("value")))
    down = own.select(F.col("node").alias("ancestor"), "value").join(ways, "ancestor").select("node", (F.col("value") * F.col("share")).alias("value"))
    parents = links.select(F.col("parent").alias("node"), F.lit(False).alias("_leaf")).distinct()
    both = own.unionByName(down).groupBy("node").agg(F.sum("value").alias("value"))
    return both.join(parents, "node", "left").select("node", "value", F.coalesce("_leaf", F.lit(True)).alias("leaf"))


def by_prefix(codes: DataFrame, code: str, lengths: list[int]) -> DataFrame:
    """``child, parent`` of codes whose beginnings of given lengths are the codes above them."""
    own = codes.select(F.col(code).alias("c")).where("c is not null").distinct()
    levels: list[Column] = [F.when(F.length("c") > n, F.substring("c", 1, n)) for n in sorted(lengths)] + [F.col("c")]
    chain = F.array_compact(F.array(*levels))
    pairs = F.transform(F.sequence(F.lit(2), F.size("chain")), lambda i: F.struct(F.element_at("chain", i).alias("child"), F.element_at("chain", i - 1).alias("parent")))
    return own.select(chain.alias("chain")).where(F.size("chain") > 1).select(F.explode(pairs).alias("p")).select("p.child", "p.parent").distinct()
