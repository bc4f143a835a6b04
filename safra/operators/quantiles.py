"""Exact quantiles of large groups: rank selection by histograms of a narrowing range.

Groups of ``SMALL`` values or fewer are sorted whole. In a larger one each wanted rank has a
range of values that holds it, at first all; a round counts the values of every open range
in ``BINS`` bins, a few rows a task, and the bin that holds the rank is the next range, from
its smallest to its largest value. A range of one value, or of few, ends it. Never are all
values of a group in one task.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .graph import cut
from .intervals import beside

SMALL = 4096
BINS = 512
#: Ranges that are broadcast at most; beyond it they meet the values by a shuffle.
FEW = 10_000


def _ranged(values: DataFrame, ranges: DataFrame, keys: list[str]) -> DataFrame:
    """Values of ``keys, v`` with each range (``keys, low, high``) that holds them."""
    r = ranges.select(*[F.col(k).alias(f"_r{k}") for k in keys], "low", "high").distinct()
    if r.limit(FEW + 1).count() <= FEW:
        r = F.broadcast(r)
    on = F.col("v").between(F.col("low"), F.col("high"))
    for k in keys:
        on = on & values[k].eqNullSafe(F.col(f"_r{k}"))
    return values.join(r, on).drop(*[f"_r{k}" for k in keys])


def quantiles(rows: DataFrame, keys: list[str], value: Column, shares: list[float], small: int = SMALL, bins: int = BINS) -> DataFrame:
    """``keys, quantiles``: of each group with a number, the values at ``shares``, in that order, interpolated between neighbours as usual.

    Nulls, NaN and infinities do not count. Keys may be null; without keys all rows are one group.
    """
    own = [f"_k{i}" for i in range(len(keys))]
    group = [F.col(k).alias(o) for k, o in zip(keys, own, strict=True)] or [F.lit(0).alias("_k0")]
    own = own or ["_k0"]
    number = value.cast("double")
    finite = number.isNotNull() & ~F.isnan(number) & (F.abs(number) < float("inf"))
    values = cut(rows.select(*group, F.when(finite, number).alias("v")).where("v is not null"))
    sizes = cut(values.groupBy(*own).agg(F.count(F.lit(1)).alias("n"), F.min("v").alias("low"), F.max("v").alias("high")))

    place = [F.lit(float(s)) * (F.col("n") - 1) for s in shares]
    few = beside(values, sizes.select(*own, "n"), own).where(F.col("n") <= small).groupBy(*own).agg(F.percentile("v", F.array(*[F.lit(float(s)) for s in shares])).alias("q"))
    ends = F.array_distinct(F.flatten(F.array(*[F.array(F.floor(x), F.ceil(x)) for x in place])))
    open_ = cut(sizes.where(F.col("n") > small).select(*own, F.explode(F.transform(ends, lambda x: x.cast("long"))).alias("rank"), "low", "high", F.lit(0).cast("long").alias("below"), F.col("n").alias("held")))
    narrow = []
    while True:
        wide = (F.col("low") != F.col("high")) & (F.col("held") > small)
        narrow.append(open_.where(~wide))
        open_ = open_.where(wide)
        if not open_.limit(1).count():
            break
        # Halves, so that the width of a range of both signs stays finite.
        at = F.least(F.lit(bins - 1), F.floor((F.col("v") / 2 - F.col("low") / 2) / (F.col("high") / 2 - F.col("low") / 2) * bins)).cast("int")
        counted = _ranged(values, open_, own).groupBy(*own, "low", "high", at.alias("bin")).agg(F.count(F.lit(1)).alias("c"), F.min("v").alias("first"), F.max("v").alias("last"))
        before = F.sum("c").over(Window.partitionBy(*own, "low", "high").orderBy("bin").rowsBetween(Window.unboundedPreceding, -1))
        counted = counted.withColumn("before", F.coalesce(before, F.lit(0)))
        met = beside(open_, counted.select(*own, "low", "high", "c", "first", "last", "before"), [*own, "low", "high"])
        rank = F.col("rank") - F.col("below") - F.col("before")
        step = met.where((rank >= 0) & (rank < F.col("c")))
        open_ = cut(step.select(*own, "rank", F.col("first").alias("low"), F.col("last").alias("high"), (F.col("below") + F.col("before")).alias("below"), F.col("c").alias("held")))
    ended = cut(reduce(DataFrame.unionByName, narrow))
    one = F.col("low") == F.col("high")
    few_held = ended.where(~one)
    held = _ranged(values, few_held, own).groupBy(*own, "low", "high").agg(F.sort_array(F.collect_list("v")).alias("vs"))
    picked = beside(few_held, held, [*own, "low", "high"]).select(*own, "rank", F.element_at("vs", (F.col("rank") - F.col("below") + 1).cast("int")).alias("v"))
    found = ended.where(one).select(*own, "rank", F.col("low").alias("v")).unionByName(picked)
    by_rank = found.groupBy(*own).agg(F.map_from_entries(F.collect_list(F.struct("rank", "v"))).alias("_at"))
    large = sizes.join(by_rank.select(*[F.col(o).alias(f"_s{o}") for o in own], "_at"), [F.col(o).eqNullSafe(F.col(f"_s{o}")) for o in own])
    at = lambda x: F.element_at("_at", x.cast("long"))
    between = [at(F.floor(x)) * (1 - (x - F.floor(x))) + at(F.ceil(x)) * (x - F.floor(x)) for x in place]
    both = few.unionByName(large.select(*own, F.array(*between).alias("q")))
    return both.select(*[F.col(o).alias(k) for k, o in zip(keys, own, strict=False)], F.col("q").alias("quantiles"))
