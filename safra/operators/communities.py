"""Communities of graphs by short random walks: nodes from which walks end alike belong together."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .graph import cut, drop
from .linkage import reciprocal

STEPS = 4


def walks(links: DataFrame, steps: int) -> DataFrame:
    """``graph, node, at, p``: where a walk of so many steps from a node ends. ``links``: ``graph, node, at``, both ways, each node with a link to itself."""
    degree = links.groupBy("graph", "node").agg(F.count(F.lit(1)).alias("d"))
    step = cut(links.join(degree, ["graph", "node"]).select("graph", "node", "at", (1 / F.col("d")).alias("p")))
    onward = step.select("graph", F.col("node").alias("at"), F.col("at").alias("_to"), F.col("p").alias("_p"))
    out = step
    for _ in range(steps - 1):
        out = cut(out.join(onward, ["graph", "at"]).groupBy("graph", "node", F.col("_to").alias("_at")).agg(F.sum(F.col("p") * F.col("_p")).alias("p")).withColumnRenamed("_at", "at"))
    return out


def communities(edges: DataFrame, steps: int = STEPS) -> DataFrame:
    """``graph, node, community`` of the nodes of undirected ``edges`` (``graph, a, b``); a community is its smallest node.

    Two communities are as far apart as the ends of their walks differ, by degree; merging them adds that distance times
    the product over the sum of their sizes to the spread within communities. Linked communities each of which is the
    other's smallest addition merge, round by round, until none are linked. Each connected part is then taken as it was in the round
    of its highest modularity within its graph (the first such). All steps are sparse joins and sums; a node that holds
    most links is summed over many tasks first.
    """
    plain = edges.where("a != b").select("graph", F.least("a", "b").alias("lo"), F.greatest("a", "b").alias("hi")).distinct()
    links_ = cut(plain.withColumn("e", F.lit(1).cast("long")))
    ends = links_.select("graph", F.col("lo").alias("node"), F.col("hi").alias("at")).unionByName(links_.select("graph", F.col("hi").alias("node"), F.col("lo").alias("at")))
    nodes = cut(ends.groupBy("graph", "node").agg(F.count(F.lit(1)).alias("degree")))
    looped = ends.unionByName(nodes.select("graph", "node", F.col("node").alias("at")))
    scale = nodes.select("graph", F.col("node").alias("at"), (F.col("degree") + 1).alias("_d"))
    vectors = cut(walks(looped, steps).join(scale, ["graph", "at"]).select("graph", F.col("node").alias("c"), "at", (F.col("p") / F.sqrt("_d")).alias("v")))
    labels = cut(nodes.select("graph", "node", F.col("node").alias("c")))
    sizes = cut(nodes.select("graph", F.col("node").alias("c"), F.lit(1).cast("long").alias("n")))
    between, rounds = links_, [labels]
    while between.limit(1).count():
        side = lambda df, end, names: df.select("graph", F.col("c").alias(end), *[F.col(k).alias(f"{k}_{end}") for k in names])
        square = vectors.groupBy("graph", "c").agg(F.sum(F.col("v") * F.col("v")).alias("s"))
        told = sizes.join(square, ["graph", "c"])
        at = lambda end: vectors.select("graph", F.col("c").alias(end), "at", F.col("v").alias(f"v_{end}"))
        pairs = between.select("graph", "lo", "hi")
        dots = pairs.join(at("lo"), ["graph", "lo"]).join(at("hi"), ["graph", "hi", "at"]).groupBy("graph", "lo", "hi").agg(F.sum(F.col("v_lo") * F.col("v_hi")).alias("dot"))
        both = pairs.join(dots, ["graph", "lo", "hi"], "left").join(side(told, "lo", ["n", "s"]), ["graph", "lo"]).join(side(told, "hi", ["n", "s"]), ["graph", "hi"])
        apart = F.col("s_lo") + F.col("s_hi") - 2 * F.coalesce("dot", F.lit(0.0))
        cost = F.round(apart * F.col("n_lo") * F.col("n_hi") / (F.col("n_lo") + F.col("n_hi")), 12)
        merged = cut(reciprocal(both.withColumn("cost", cost), ["graph"], "cost"))
        into = merged.select("graph", F.col("hi").alias("c"), F.col("lo").alias("_new"))
        now = lambda df: df.join(into, ["graph", "c"], "left").withColumn("c", F.coalesce("_new", "c")).drop("_new")
        weighed = vectors.join(sizes, ["graph", "c"]).withColumn("v", F.col("v") * F.col("n"))
        larger = cut(now(sizes).groupBy("graph", "c").agg(F.sum("n").alias("n")))
        summed = now(weighed.drop("n")).groupBy("graph", "c", "at").agg(F.sum("v").alias("v"))
        moved = between
        for end in ("lo", "hi"):
            moved = moved.join(into.select("graph", F.col("c").alias(end), "_new"), ["graph", end], "left").withColumn(end, F.coalesce("_new", end)).drop("_new")
        moved = moved.where("lo != hi").groupBy("graph", F.least("lo", "hi").alias("_l"), F.greatest("lo", "hi").alias("_h")).agg(F.sum("e").alias("e"))
        after = cut(summed.join(larger, ["graph", "c"]).select("graph", "c", "at", (F.col("v") / F.col("n")).alias("v"))), cut(moved.select("graph", F.col("_l").alias("lo"), F.col("_h").alias("hi"), "e"))
        labels = cut(now(labels).select("graph", "node", "c"))
        drop(vectors, sizes)
        (vectors, between), sizes = after, larger
        rounds.append(labels)

    part = labels.select("graph", "node", F.col("c").alias("part"))
    numbered = [df.withColumn("round", F.lit(k)) for k, df in enumerate(rounds)]
    every = cut(reduce(DataFrame.unionByName, numbered).join(part, ["graph", "node"]).join(nodes, ["graph", "node"]))
    total = nodes.groupBy("graph").agg(F.sum("degree").alias("m2"))
    one = every.select("graph", "round", F.col("node").alias("lo"), F.col("c").alias("c_lo"))
    two = every.select("graph", "round", F.col("node").alias("hi"), F.col("c").alias("c_hi"))
    inside = links_.join(one, ["graph", "lo"]).join(two, ["graph", "round", "hi"]).where("c_lo = c_hi").groupBy("graph", "round", F.col("c_lo").alias("c")).agg(F.count(F.lit(1)).alias("within"))
    degrees = every.groupBy("graph", "round", "part", "c").agg(F.sum("degree").alias("degree"))
    terms = degrees.join(inside, ["graph", "round", "c"], "left").join(total, "graph")
    value = 2 * F.coalesce("within", F.lit(0)) / F.col("m2") - (F.col("degree") / F.col("m2")) * (F.col("degree") / F.col("m2"))
    quality = terms.groupBy("graph", "part", "round").agg(F.round(F.sum(value), 9).alias("q"))
    best = quality.withColumn("_r", F.row_number().over(Window.partitionBy("graph", "part").orderBy(F.desc("q"), "round"))).where("_r = 1").select("graph", "part", "round")
    return every.join(best, ["graph", "part", "round"]).select("graph", "node", F.col("c").alias("community"))
