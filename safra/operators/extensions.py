"""Operators around compiled observables and files that no other module has: representations, templates, lags, samples, recent files, overviews."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .quantiles import quantiles


def representations(value: Column, offset: float = 0.0) -> dict[str, Column]:
    """A number as it is, its logarithm, logit, square root and sign with logarithm; null where one is not defined."""
    x = value + F.lit(offset)
    return {
        "identity": x, "log": F.when(x > 0, F.log(x)), "log1p": F.when(x > -1, F.log1p(x)), "sqrt": F.when(x >= 0, F.sqrt(x)),
        "logit": F.when((x > 0) & (x < 1), F.log(x / (1 - x))), "signed_log": F.signum(x) * F.log1p(F.abs(x)),
    }


def templates(rows: DataFrame, keys: list[str], value: str, bins: int = 4) -> DataFrame:
    """Mean, variance, and the shares of a group's values in the quantile bins of all values: ``n, mean, variance, bin_1 ...``."""
    edges = quantiles(rows, [], F.col(value), [k / bins for k in range(1, bins)]).select(F.col("quantiles").alias("_edges"))
    placed = rows.where(F.col(value).isNotNull()).crossJoin(F.broadcast(edges)).withColumn("_bin", F.aggregate("_edges", F.lit(1), lambda n, e: n + (F.col(value) > e).cast("int")))
    shares = [F.avg((F.col("_bin") == k).cast("int")).alias(f"bin_{k}") for k in range(1, bins + 1)]
    return placed.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), F.avg(value).alias("mean"), F.var_samp(value).alias("variance"), *shares)


def lagged(rows: DataFrame, keys: list[str], ordinal: str, value: str, lags: list[int]) -> DataFrame:
    """Adds ``lag_k``: the value of exactly ``k`` periods before, null where that period is missing; one ordering of each key for all lags."""
    own = Window.partitionBy(*keys).orderBy(ordinal)
    return rows.withColumns({f"lag_{k}": F.first(value).over(own.rangeBetween(-k, -k)) for k in lags})


def latest(files: DataFrame, keys: list[str], order: list[Column], most: int = 3) -> DataFrame:
    """The ``most`` latest rows of each group with their ``recency`` from 1; each task hands on no more than so many."""
    return files.withColumn("recency", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where(F.col("recency") <= most)


def sample_rows(rows: DataFrame, key: list[str], most: int = 50_000, seed: int = 1) -> DataFrame:
    """``most`` rows by the smallest seeded hash of a key: the same ones in any run and however the rows are dealt."""
    return rows.orderBy(F.xxhash64(*key, F.lit(seed)), *key).limit(most)


def overview(cells: DataFrame) -> DataFrame:
    """``path, fields, rows, missing_share`` of tables in long form (``path, name, value``)."""
    by_field = cells.groupBy("path", "name").agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("value").isNull()).alias("missing"))
    return by_field.groupBy("path").agg(F.count(F.lit(1)).alias("fields"), F.max("n").alias("rows"), (F.sum("missing") / F.sum("n")).alias("missing_share"))


def cosine_pairs(vectors: DataFrame, pairs: DataFrame, id_: str, vector: str) -> DataFrame:
    """``a, b, cosine`` of given pairs of rows with vectors; null where one is null, zero or of another length."""
    v = vectors.select(F.col(id_).alias("_id"), F.transform(vector, lambda x: x.cast("double")).alias("_v"))
    dot = lambda x, y: F.aggregate(F.zip_with(x, y, lambda l, r: l * r), F.lit(0.0), lambda s, z: s + z)
    joined = pairs.join(v.select(F.col("_id").alias("a"), F.col("_v").alias("_x")), "a").join(v.select(F.col("_id").alias("b"), F.col("_v").alias("_y")), "b")
    norm = F.sqrt(dot(F.col("_x"), F.col("_x")) * dot(F.col("_y"), F.col("_y")))
    return joined.select("a", "b", F.when((F.size("_x") == F.size("_y")) & (norm > 0), dot(F.col("_x"), F.col("_y")) / norm).alias("cosine"))


def family_signatures(members: DataFrame, signatures: DataFrame) -> DataFrame:
    """``family_id, schema_signatures``: the distinct signatures of a family's files."""
    return members.select("family_id", "path").distinct().join(signatures.select("path", "schema_signature"), "path").groupBy("family_id").agg(F.sort_array(F.collect_set("schema_signature")).alias("schema_signatures"))


def by_system(series: DataFrame, system: str, name: str) -> DataFrame:
    """Each system with the sorted names of its series and their number."""
    return series.groupBy(system).agg(F.sort_array(F.collect_set(name)).alias("series"), F.countDistinct(name).alias("n_series"))
