"""Running values over ordered rows without one task a key, and chains of intervals built on them.

The rows are dealt by ranges of key and order, and written with the number of their part. A
part's own running values come from a window inside it; what all earlier parts of a key
bring along is one row a key and part, so a key with most of the rows is spread over many
tasks like any other.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .graph import cut

PART = "_part"


def in_ranges(rows: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """``rows`` with the number of the part they are in: parts follow one another by keys, then ``order``. Written once, so the numbers stay."""
    return cut(rows.repartitionByRange(*[F.col(c).asc_nulls_first() for c in [*keys, *order]]).withColumn(PART, F.spark_partition_id()))


def beside(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """Left join on keys that may be null; the keys stay once."""
    other = right.select(*[F.col(k).alias(f"_r{k}") for k in keys], *[c for c in right.columns if c not in keys])
    on = F.lit(True)
    for k in keys:
        on = on & left[k].eqNullSafe(other[f"_r{k}"])
    return left.join(other, on, "left").drop(*[f"_r{k}" for k in keys])


def running(parts: DataFrame, keys: list[str], order: list[str], value: Column, how: str, name: str, own: bool = True) -> DataFrame:
    """Adds ``name``: the ``how`` (``max`` or ``sum``) of ``value`` over a key's rows so far, the row's own counted or not; null where there is none.

    ``parts`` comes from ``in_ranges`` with the same keys and order, and may have been extended row by row.
    """
    total = {"max": F.max, "sum": F.sum}[how]
    kept = parts.withColumn("_value", value)
    each = kept.groupBy(*keys, PART).agg(total("_value").alias("_of_part"))
    earlier = Window.partitionBy(*keys).orderBy(PART).rowsBetween(Window.unboundedPreceding, -1)
    brought = each.withColumn("_brought", total("_of_part").over(earlier)).drop("_of_part")
    here = Window.partitionBy(PART, *keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0 if own else -1)
    met = beside(kept.withColumn("_here", total("_value").over(here)), brought, [*keys, PART])
    both = F.greatest("_here", "_brought") if how == "max" else F.when(F.col("_here").isNull(), F.col("_brought")).otherwise(F.col("_here") + F.coalesce("_brought", F.lit(0)))
    return met.withColumn(name, both).drop("_value", "_here", "_brought")


def interval_clusters(rows: DataFrame, keys: list[str], name: str, lo: str = "lo", hi: str = "hi") -> DataFrame:
    """``name, component``: rows of equal keys whose intervals of whole numbers chain by overlapping or touching; the component is its smallest name.

    Along the lower ends a new chain begins where no earlier interval reaches, and counting the beginnings numbers the
    chains: two running values. A row without an interval stands alone. Names are unique.
    """
    own = [f"_k{i}" for i in range(len(keys))]
    plain = rows.select(*[F.col(k).alias(o) for k, o in zip(keys, own, strict=True)], F.col(name).alias("_name"), F.col(lo).alias("_lo"), F.col(hi).alias("_hi"))
    real = F.col("_lo").isNotNull() & F.col("_hi").isNotNull()
    order = ["_lo", "_hi", "_name"]
    parts = in_ranges(plain.where(real), own, order)
    reached = running(parts, own, order, F.col("_hi"), "max", "_reach", own=False)
    begins = F.when(F.col("_reach").isNull() | (F.col("_lo") > F.col("_reach") + 1), 1).otherwise(0)
    chained = cut(running(reached.withColumn("_begins", begins), own, order, F.col("_begins"), "sum", "_chain"))
    smallest = chained.groupBy(*own, "_chain").agg(F.min("_name").alias("component"))
    found = beside(chained.select(*own, "_chain", "_name"), smallest, [*own, "_chain"]).select(F.col("_name").alias(name), "component")
    alone = plain.where(~real).select(F.col("_name").alias(name), F.col("_name").alias("component"))
    return found.unionByName(alone)
