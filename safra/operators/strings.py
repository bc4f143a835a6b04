"""Likeness of names by several measures, and where the measures disagree."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text as x
from .intervals import beside
from .profile import jaccard_pairs
from .quantiles import quantiles


def similar_names(names: DataFrame, column: str, least: float = 0.5) -> DataFrame:
    """``a, b``: distinct names whose three-letter pieces have a Jaccard similarity of ``least`` or more; found by their rarest pieces."""
    own = names.select(F.col(column).alias("name")).where("name is not null").distinct()
    return jaccard_pairs(own.select("name", F.explode(x.grams(F.col("name"))).alias("piece")), "name", "piece", least).select("a", "b")


def hamming(a: Column, b: Column) -> Column:
    """Places at which two texts of equal length differ; null for others."""
    letters = lambda c: F.split(c, "")
    differ = F.zip_with(letters(a), letters(b), lambda l, r: (l != r).cast("int"))
    return F.when(F.length(a) == F.length(b), F.aggregate(differ, F.lit(0), lambda s, v: s + v))


def metrics(pairs: DataFrame) -> DataFrame:
    """Adds ``edits, damerau, hamming, jaro_winkler, jaccard, dice, overlap, cosine`` of ``a, b`` (the last four over three-letter pieces), whether
    their match-rating and their New York codes agree, and ``spread``, the standard deviation of the four over pieces; those are null for names too short for a piece."""
    u, v = x.grams(F.col("a")), x.grams(F.col("b"))
    sized = pairs.withColumns({"_u": F.size(u), "_v": F.size(v), "_both": F.size(F.array_intersect(u, v))})
    both = F.col("_both")
    told = sized.withColumns({
        "edits": F.levenshtein("a", "b"), "damerau": x.damerau("a", "b"), "jaro_winkler": x.jaro_winkler("a", "b"), "match_rating": x.match_rating("a", "b"), "same_sound": x.nysiis("a") == x.nysiis("b"), "hamming": hamming(F.col("a"), F.col("b")), "jaccard": F.try_divide(both, F.col("_u") + F.col("_v") - both), "dice": F.try_divide(2 * both, F.col("_u") + F.col("_v")),
        "overlap": F.try_divide(both, F.least("_u", "_v")), "cosine": F.try_divide(both, F.sqrt(F.col("_u") * F.col("_v"))),
    })
    four = [F.col(c) for c in ("jaccard", "dice", "overlap", "cosine")]
    mean = sum(four[1:], four[0]) / 4
    squares = [(c - mean) * (c - mean) for c in four]
    return told.withColumn("spread", F.sqrt(sum(squares[1:], squares[0]) / 4)).drop("_u", "_v", "_both")


def most_disputed(measured: DataFrame, most: int = 50) -> DataFrame:
    """The ``most`` pairs on which the measures differ most, with their rank."""
    top = measured.where("spread is not null").orderBy(F.desc("spread"), "a", "b").limit(most)
    return top.withColumn("rank", F.row_number().over(Window.orderBy(F.desc("spread"), "a", "b")))


def frequencies(rows: DataFrame, keys: list[str], value: str, most: int = 25) -> DataFrame:
    """The ``most`` frequent values of a column within each group, with counts; ties by value."""
    n = rows.groupBy(*keys, value).agg(F.count(F.lit(1)).alias("n"))
    best = Window.partitionBy(*keys).orderBy(F.desc("n"), value)
    return n.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= most)


def column_summary(rows: DataFrame, keys: list[str], value: Column) -> DataFrame:
    """Count, share of nulls, extremes, quartiles and mean of a number within each group; the quartiles are those of its finite values."""
    told = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), F.avg(value.isNull().cast("int")).alias("na_rate"), F.min(value).alias("low"), F.avg(value).alias("mean"), F.max(value).alias("high"))
    found = beside(told, quantiles(rows, keys, value, [0.25, 0.5, 0.75]), keys)
    q = [F.col("quantiles")[k].alias(name) for k, name in enumerate(("q1", "median", "q3"))]
    return found.select(*keys, "n", "na_rate", "low", q[0], q[1], "mean", q[2], "high")
