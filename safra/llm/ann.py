"""Approximate nearest neighbours by cosine with an adaptive dimension scan.

Vectors are scaled to length one and turned by a random rotation, so that any few
leading dimensions estimate a distance without bias. They are filed in lists around
centroids fitted on a bounded sample; there are about as many lists as the root of the rows, so
filing grows by the power 1.5. How many lists may be probed is measured: for some vectors
outside the sample that the centroids are fitted on, the true neighbours are found in one pass over all
rows, and the lists that hold ``RECALL`` of them suffice. Where vectors form no clusters that is most
lists, and searching then grows by the square.

A query first reads its nearest list whole, which gives it a k-th distance to beat. A list whose widest angle, taken from the
query's angle to its centroid, leaves no room for a nearer vector is not read at all. In every other probed list it
scans the candidates in column blocks and after each block abandons those whose partial
distance, by a hypothesis test, puts them beyond that distance.
What is left is measured exactly, in double precision, on the original vectors.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import materialize, read_table

K = 5
#: Rows that centroids are fitted on, at most, and a list on average: those of smallest seeded hash.
SAMPLE, SAMPLE_PER_LIST = 1 << 17, 32
#: Rows, and queries, of a list that a task holds at once.
PART_ROWS = 4096
#: Vectors whose true neighbours are found to measure how many lists to probe, and the share of those to reach.
MEASURED, RECALL = 128, 0.97
LEAST_PROBES = 4
COLUMNS = 16
#: Standard errors of the test that abandons a candidate.
EPSILON = 2.0
SEED = 7


def rotation(dim: int, seed: int = SEED) -> np.ndarray:
    q, r = np.linalg.qr(np.random.default_rng(seed).standard_normal((dim, dim)))
    return q * np.sign(np.diag(r))


def _usable(vector: str) -> Column:
    """Neither null nor zero, without null or non-finite components."""
    v = F.col(vector)
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return v.isNotNull() & finite & F.exists(v, lambda x: x != 0)


def _vectors(column: pa.Array) -> np.ndarray:
    if not len(column):
        return np.zeros((0, 1))
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), -1)


def _unit(x: np.ndarray) -> np.ndarray:
    scale = np.abs(x).max(1, keepdims=True)
    x = x / scale
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def fit_centroids(sample: np.ndarray, lists: int, rounds: int = 8, seed: int = SEED) -> np.ndarray:
    """Spherical k-means on a bounded sample."""
    lists = max(1, min(lists, len(sample)))
    centre = sample[np.random.default_rng(seed).permutation(len(sample))[:lists]].copy()
    for _ in range(rounds):
        near = np.concatenate([(sample[i : i + 4096] @ centre.T).argmax(1) for i in range(0, len(sample), 4096)])
        total = np.zeros_like(centre)
        np.add.at(total, near, sample)
        norm = np.linalg.norm(total, axis=1, keepdims=True)
        centre = np.where(norm > 0, total / np.maximum(norm, 1e-12), centre)
    return centre


def _angles(dots: np.ndarray, centres: np.ndarray) -> np.ndarray:
    """Angles to centres that may be shorter than one, from the dot products."""
    return np.arccos(np.clip(dots / np.maximum(np.linalg.norm(centres, axis=1), 1e-300), -1, 1))


def cosine(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Cosine of each row of ``a`` with the row of ``b``, in double precision; huge or tiny components do not overflow."""
    a, b = a / np.abs(a).max(1, keepdims=True), b / np.abs(b).max(1, keepdims=True)
    return (a * b).sum(1) / np.sqrt((a * a).sum(1) * (b * b).sum(1))


def slack(stop: int, dim: int, epsilon: float = EPSILON) -> float:
    """Multiple of the distance to beat that the scaled partial distance over ``stop`` of ``dim`` dimensions must exceed for a candidate to go.

    Over a random rotation the share of a squared distance in d of D dimensions has mean d / D and relative variance
    2 (D - d) / (d (D + 2)).
    """
    return 1 + epsilon * np.sqrt(2 * (dim - stop) / (stop * (dim + 2))) if stop < dim else 1 + 1e-5


def scan_lists(queries: np.ndarray, limits: np.ndarray, turned: np.ndarray, columns: int = COLUMNS, epsilon: float = EPSILON) -> tuple[list[np.ndarray], int]:
    """For each of ``queries`` the rows of ``turned`` (unit and rotated, like them) that may be within its squared distance ``limits``; and the components read."""
    dim = turned.shape[1]
    first = min(columns, dim)
    x, q = turned[:, :first], queries[:, :first]
    begun = (q * q).sum(1)[:, None] + (x * x).sum(1)[None, :] - 2 * (q @ x.T)
    keep = begun * (dim / first) <= (limits * slack(first, dim, epsilon) + 1e-6)[:, None]
    read = begun.size * first
    out = []
    for own, limit, partial, kept in zip(queries, limits, begun, keep, strict=True):
        alive = np.flatnonzero(kept)
        partial = partial[alive]
        for start in range(first, dim, columns):
            stop = min(dim, start + columns)
            partial = partial + ((turned[alive, start:stop] - own[start:stop]) ** 2).sum(1)
            read += len(alive) * (stop - start)
            still = partial * (dim / stop) <= limit * slack(stop, dim, epsilon) + 1e-6
            alive, partial = alive[still], partial[still]
        out.append(alive)
    return out, read


def nearest(
    table: DataFrame,
    queries: DataFrame,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    k: int = K,
    recall: float = RECALL,
    probes: int | None = None,
    lists: int | None = None,
    part_rows: int = PART_ROWS,
    epsilon: float = EPSILON,
) -> DataFrame:
    """``query_id, rank, vec_id, score``: for each row of ``queries`` its ``k`` nearest rows of ``table`` found.

    Largest cosine first, ties to the smaller id, the query's own id left out; fewer than
    ``k`` where there are fewer. Vectors that are null, zero or hold null or non-finite
    components take no part, nor do rows without an id, or vectors of another length than
    most. Equal vectors are filed once, with their ``k + 1`` smallest ids: the others
    cannot be among the nearest of anything. Repeated rows count once. Empty tables
    give an empty result. ``lists`` and ``probes`` are chosen from the rows and the measured ``recall`` if not given.
    """
    spark = table.sparkSession
    good = table.where(_usable(vector_col) & F.col(id_col).isNotNull()).select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).cast("array<double>").alias("v"))
    asked = queries.where(_usable(vector_col) & F.col(id_col).isNotNull()).select(F.col(id_col).cast("long").alias("query_id"), F.col(vector_col).cast("array<double>").alias("q"))
    out = "query_id long, rank int, vec_id long, score double"
    shape = good.groupBy(F.size("v").alias("dim")).count().orderBy(F.desc("count"), "dim").first()
    if shape is None:
        return spark.createDataFrame([], out)
    dim, rows = shape["dim"], shape["count"]
    good, asked = good.where(F.size("v") == dim), asked.where(F.size("q") == dim).distinct()

    # Equal vectors are filed once.
    distinct = materialize(_smallest_ids(good, k + 1), "vectors")

    wanted = lists or max(1, round(float(rows) ** 0.5))
    picked = distinct.orderBy(F.xxhash64("v"), "v").limit(min(SAMPLE, SAMPLE_PER_LIST * wanted) + MEASURED).select("v").toArrow()
    turn = rotation(dim)
    points = _unit(_vectors(picked.column("v").combine_chunks())) @ turn
    apart = min(MEASURED, len(points) // 4)  # measured on, not fitted on
    points, measured = (points[:-apart], points[-apart:]) if apart else (points, points)
    centroids = fit_centroids(points, min(wanted, max(1, len(points) // 8)))
    index = spark.sparkContext.broadcast((turn, centroids))
    if probes is None:
        probes = _probes_for(distinct, measured, index, k, recall)
    probed = min(len(centroids), max(LEAST_PROBES, probes))

    def file(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        turn, centre = index.value
        for batch in batches:
            x = _vectors(batch.column(0))
            if len(x):
                near = _unit(x) @ turn @ centre.T
                at = near.argmax(1).astype(np.int32)
                yield pa.RecordBatch.from_arrays([pa.array(at), batch.column(0), batch.column(1), pa.array(_angles(near[np.arange(len(x)), at], centre[at]))], ["list", "v", "ids", "angle"])

    filed = materialize(distinct.select("v", "ids").mapInArrow(file, "list int, v array<double>, ids array<long>, angle double"), "lists")
    widths = materialize(filed.groupBy("list").agg(F.max("angle").alias("width")), "widths")  # a row a list, SAMPLE / 8 at most

    def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        turn, centre = index.value
        for batch in batches:
            x = _vectors(batch.column(1))
            if len(x):
                score = _unit(x) @ turn @ centre.T
                near = np.argsort(-score, axis=1, kind="stable")[:, :probed].astype(np.int32)
                angle = _angles(np.take_along_axis(score, near, 1).ravel(), centre[near.ravel()])
                row = pa.array(np.repeat(np.arange(len(x)), near.shape[1]))
                order = pa.array(np.tile(np.arange(near.shape[1], dtype=np.int32), len(x)))
                yield pa.RecordBatch.from_arrays([pa.array(near.ravel()), order, batch.column(0).take(row), batch.column(1).take(row), pa.array(angle)], ["list", "near", "query_id", "q", "angle"])

    probing = materialize(asked.select("query_id", "q").mapInArrow(probe, "list int, near int, query_id long, q array<double>, angle double"), "probes")

    def scan(held: pd.DataFrame, probing: pd.DataFrame) -> pd.DataFrame:
        types = {"query_id": "int64", "vec_id": "int64", "score": "float64", "limit": "float64"}
        if not len(held) or not len(probing):
            return pd.DataFrame({c: [] for c in types}).astype(types)
        turn, _ = index.value
        x, q = np.stack(held["v"].to_numpy()), np.stack(probing["q"].to_numpy())
        turned, own = _unit(x) @ turn, _unit(q) @ turn
        limits = probing["limit"].to_numpy(np.float64)
        ids = held["ids"].tolist()
        found: list[tuple[int, int, float, float]] = []
        for at in range(0, len(own), 256):
            part = slice(at, at + 256)
            near, _ = scan_lists(own[part], limits[part], turned, COLUMNS, epsilon)
            for name, original, limit, few in zip(probing["query_id"].tolist()[part], q[part], limits[part].tolist(), near, strict=True):
                score = cosine(x[few], np.broadcast_to(original, (len(few), x.shape[1])))
                if limit == np.inf and len(score) > k:
                    # k + 1 different vectors: one of them may be the query itself
                    limit = 2 - 2 * float(np.partition(score, len(score) - k - 1)[len(score) - k - 1])
                best = sorted(((-s, i) for s, row in zip(score.tolist(), few.tolist(), strict=True) for i in ids[row] if i != name))[:k]
                found += [(name, i, -s, limit) for s, i in best]
        return pd.DataFrame(found, columns=list(types)).astype(types)

    def search(some: DataFrame) -> DataFrame:
        """Parts of a list, by its rows and by its queries, meet each other: as many tables of two numbers a list as there are lists are broadcast, ``SAMPLE / 8`` rows at most."""
        of = filed.groupBy("list").agg(F.greatest(F.lit(1), F.ceil(F.count(F.lit(1)) / F.lit(part_rows))).cast("int").alias("parts"))
        asking = some.groupBy("list").agg(F.greatest(F.lit(1), F.ceil(F.count(F.lit(1)) / F.lit(part_rows))).cast("int").alias("turns"))
        sizes = F.broadcast(of.join(asking, "list"))
        up_to = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
        rows_ = filed.join(sizes, "list").select("list", "v", "ids", F.pmod(F.xxhash64("v"), F.col("parts")).cast("int").alias("part"), up_to("turns").alias("turn"))
        own = some.join(sizes, "list").select("list", "query_id", "q", "limit", F.pmod(F.xxhash64("query_id"), F.col("turns")).cast("int").alias("turn"), up_to("parts").alias("part"))
        return rows_.groupBy("list", "part", "turn").cogroup(own.groupBy("list", "part", "turn")).applyInPandas(scan, "query_id long, vec_id long, score double, limit double")

    first = materialize(search(probing.where("near = 0").withColumn("limit", F.lit(float("inf")))), "first")
    limits = first.groupBy("query_id").agg(F.min("limit").alias("limit"))
    others = probing.where("near > 0").join(limits, "query_id", "left").withColumn("limit", F.coalesce("limit", F.lit(float("inf"))))
    # The nearest that a vector of a list can be: the angle to the centroid less the list's width.
    closest = 2 - 2 * F.cos(F.greatest(F.lit(0.0), F.col("angle") - F.col("width") - 1e-9))
    others = others.join(F.broadcast(widths), "list").where(closest <= F.col("limit") + 1e-9)
    hits = first.select("query_id", "vec_id", "score").unionByName(search(materialize(others, "others")).select("query_id", "vec_id", "score"))
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    once = hits.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    return once.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def _probes_for(distinct: DataFrame, some: np.ndarray, index, k: int, recall: float) -> int:
    """How many lists, nearest first, hold the share ``recall`` of the ``k`` nearest of ``some`` vectors among all rows."""
    asked = distinct.sparkSession.sparkContext.broadcast(some)

    def brute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        turn, centre = index.value
        own = asked.value
        place = np.argsort(np.argsort(-(own @ centre.T), axis=1, kind="stable"), axis=1)
        top = np.full((len(own), k + 1), -np.inf)
        rank = np.zeros((len(own), k + 1), np.int64)
        for batch in batches:
            x = _vectors(batch.column(0))
            for a in range(0, len(x), 2048):
                turned = _unit(x[a : a + 2048]) @ turn
                at = (turned @ centre.T).argmax(1)
                score = np.concatenate([top, own @ turned.T], axis=1)
                ranks = np.concatenate([rank, place[:, at]], axis=1)
                best = np.argpartition(-score, k, axis=1)[:, : k + 1]
                top, rank = np.take_along_axis(score, best, 1), np.take_along_axis(ranks, best, 1)
        query = np.repeat(np.arange(len(own)), k + 1)
        real = np.flatnonzero(top.ravel() > -np.inf)
        yield pa.RecordBatch.from_arrays([pa.array(query[real]), pa.array(top.ravel()[real]), pa.array(rank.ravel()[real])], ["query", "score", "near"])

    found = distinct.select("v").mapInArrow(brute, "query long, score double, near long")
    best = Window.partitionBy("query").orderBy(F.desc("score"), "near")
    ranks = found.withColumn("r", F.row_number().over(best)).where(F.col("r").between(2, k + 1)).select("near").toArrow()  # the vector itself comes first
    near = np.sort(ranks.column("near").to_numpy())
    return int(near[min(len(near) - 1, int(np.ceil(recall * len(near))) - 1)]) + 1 if len(near) else 1


def _smallest_ids(good: DataFrame, most: int) -> DataFrame:
    """``v, ids``: each distinct vector with its ``most`` smallest ids.

    Ranked within salts first, so that a vector of very many rows is not one task's.
    """
    salt = F.pmod(F.xxhash64("id"), F.lit(64))
    single = good.distinct().withColumn("salt", salt)
    within = Window.partitionBy("v", "salt").orderBy("id")
    few = single.withColumn("r", F.row_number().over(within)).where(F.col("r") <= most)
    return few.groupBy("v").agg(F.slice(F.sort_array(F.collect_list("id")), 1, most).alias("ids"))


def op2_ann_dimension_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = read_table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return nearest(table, table.where(F.pmod("vec_id", F.lit(50)) == 0))
