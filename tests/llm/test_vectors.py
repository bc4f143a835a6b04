"""Nearest neighbours against brute force."""

import math

import numpy as np

from safra.llm import ann


def test_edge_rows(spark):
    inf = float("inf")
    rows = [(0, [1.0, 0.0]), (1, [2.0, 0.0]), (2, [0.0, 1.0]), (2, [0.0, 1.0]), (3, None), (4, [0.0, 0.0]), (5, [None, 1.0]), (6, [inf, 1.0]), (7, [math.nan, 1.0]), (8, [1.0]), (None, [1.0, 1.0]), (9, [1.0, 0.0])]
    table = spark.createDataFrame([(i, v, "x") for i, v in rows], "vec_id long, embedding array<float>, list string")
    got = [tuple(r) for r in ann.nearest(table, table.where("vec_id = 0")).orderBy("rank").collect()]
    assert got == [(0, 1, 1, 1.0), (0, 2, 9, 1.0), (0, 3, 2, 0.0)]
    assert ann.nearest(table.limit(0), table).count() == 0


def test_recall(spark):
    rng = np.random.default_rng(2)
    centre = rng.standard_normal((20, 32))
    x = (centre[rng.integers(0, 20, 3000)] + 0.7 * rng.standard_normal((3000, 32))).astype(np.float32)
    table = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<float>")
    got = ann.nearest(table, table.where("vec_id % 50 = 0")).collect()
    unit = x.astype(np.float64) / np.linalg.norm(x.astype(np.float64), axis=1, keepdims=True)
    hit = 0
    for q in range(0, 3000, 50):
        score = unit @ unit[q]
        score[q] = -9
        best = set(np.argsort(-score)[:5].tolist())
        own = [r for r in got if r.query_id == q]
        assert sorted(r["rank"] for r in own) == [1, 2, 3, 4, 5] and all(abs(r.score - score[r.vec_id]) < 1e-9 for r in own)
        hit += len(best & {r.vec_id for r in own})
    assert hit / 300 >= 0.9


def test_the_scan_abandons_and_loses_little():
    """Unit vectors around centres and on the whole sphere, one list, the limit that the rows themselves set."""
    rng = np.random.default_rng(4)
    for spread in (0.5, 9.0):
        centre = rng.standard_normal((40, 64))
        x = ann._unit(centre[rng.integers(0, 40, 4000)] + spread * rng.standard_normal((4000, 64))) @ ann.rotation(64)
        distance = ((x[:100, None, :] - x[None, :, :]) ** 2).sum(2)
        limits = np.partition(distance[:, :300], 5, axis=1)[:, 5]  # as a first list of 300 rows would set it
        found, read = ann.scan_lists(x[:100], limits, x)
        true = np.argsort(distance, axis=1)[:, :6]
        hit = sum(len(np.intersect1d(a, b)) for a, b in zip(found, true, strict=True))
        assert hit >= 0.97 * true.size and read <= 0.6 * 100 * x.size


def test_recall_where_nothing_clusters(spark):
    rng = np.random.default_rng(6)
    x = rng.standard_normal((4000, 64)).astype(np.float32)
    table = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<float>")
    got = ann.nearest(table, table.where("vec_id % 50 = 0")).collect()
    unit = x.astype(np.float64) / np.linalg.norm(x.astype(np.float64), axis=1, keepdims=True)
    hit = 0
    for q in range(0, 4000, 50):
        score = unit @ unit[q]
        score[q] = -9
        hit += len(set(np.argsort(-score)[:5].tolist()) & {r.vec_id for r in got if r.query_id == q})
    assert hit / 400 >= 0.9


def test_lists_without_room_are_not_read(spark):
    """Tight clusters far apart: with all lists to probe, the result is that of brute force, though most lists are left out."""
    rng = np.random.default_rng(9)
    centre = rng.standard_normal((30, 16)) * 9
    x = (centre[rng.integers(0, 30, 1500)] + 0.2 * rng.standard_normal((1500, 16))).astype(np.float32)
    table = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<float>")
    got = ann.nearest(table, table.where("vec_id % 50 = 0"), probes=60, lists=60, epsilon=50.0).collect()
    unit = x.astype(np.float64) / np.linalg.norm(x.astype(np.float64), axis=1, keepdims=True)
    for q in range(0, 1500, 50):
        score = unit @ unit[q]
        score[q] = -9
        assert [r.vec_id for r in sorted((r for r in got if r.query_id == q), key=lambda r: r["rank"])] == np.argsort(-score, kind="stable")[:5].tolist()
