"""Operators for discovery against plain loops, edge rows and hot keys."""

import math
from collections import Counter, defaultdict
from itertools import combinations

import numpy as np
import pytest
from pyspark.sql import functions as F

from safra.functions import text
from safra.operators import communities, docs, fuzzy, hierarchy, intervals, linkage, logical, nearest, quantiles, ranking, strings
from safra.operators.strings import metrics
from safra.sources import versions
from safra.streaming.changes import scan_changes


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


# ---------------------------------------------------------------- documents


def steps(a, b):
    x, y = ([q for q in p.split("/") if q] for p in (a, b))
    same = 0
    while same < min(len(x), len(y)) and x[same] == y[same]:
        same += 1
    return len(x) + len(y) - 2 * same


def test_near_directories(spark):
    left = ["", "/", "/a", "/a/b", "/a/b/c/d/e", "/x/y", "/x/y/z/w", "/q"]
    right = ["/a", "/a/b/c", "/x/y/z/w/v", "/x/q", "/a/b/c/d/e/f/g/h/i", "/", "/n/m/k"]
    frame = lambda x: spark.createDataFrame([(q,) for q in x] + [(None,)], "directory string")
    got = {(r.a, r.b): r.distance for r in docs.near_directories(frame(left), frame(right)).collect()}
    assert got == {(a, b): steps(a, b) for a in left for b in right if steps(a, b) <= 4}


def test_a_lake_under_one_root_makes_no_pairs_of_all(spark):
    """Two hundred systems below one root: directories meet within their system only, though all share the first components."""
    dirs = [f"/lake/raw/s{i}/data/year/month" for i in range(200)]
    series = spark.createDataFrame([(f"S{i}", q) for i, q in enumerate(dirs)], "series string, source_path string")
    files = spark.createDataFrame([(f"/lake/raw/s{i}/docs/layout.pdf",) for i in range(200)], "url string")
    near = docs.near_directories(series.select(F.col("source_path").alias("directory")), files.select(F.regexp_replace("url", "/[^/]*$", "").alias("directory")))
    assert near.count() == 200
    index = spark.createDataFrame([(q,) for q in dirs], "directory string").select(F.explode(docs.ancestors(F.filter(F.split("directory", "/"), lambda p: p != ""))).alias("e"))
    assert index.where("e.ancestor = 'lake'").count() == 0


def test_associate(spark):
    series = spark.createDataFrame([("PROMO", "/data/SIM/FINAL"), ("PROMO", "/data/SIM"), (None, "/data"), ("X", None)], "series string, source_path string")
    files = spark.createDataFrame([("/data/SIM/DOCS/layout_promo.pdf",), ("/data/SIM/DOCS/layout_promo.PDF",), ("/far/from/all/of/it/layout_promo.pdf",), ("/data/SIM/DOCS/layout_promo.txt",), (None,)], "url string")
    got = {r.url: r for r in docs.associate(series, files).collect()}
    assert set(got) == {"/data/SIM/DOCS/layout_promo.pdf", "/data/SIM/DOCS/layout_promo.PDF"}
    r = got["/data/SIM/DOCS/layout_promo.pdf"]
    assert (r.distance, r.bonus) == (1, 25) and r.score == pytest.approx(0.35 * 80 + 0.25 * text._partial("promo", "layout_promo") + 0.4 * text._token_set("promo data sim", "layout_promo sim docs") + 25, abs=0.01)


def test_associate_asks_for_name_likeness_only_where_it_decides(spark, monkeypatch):
    series = spark.createDataFrame([("PROMO", "/a/b/c"), ("PROMO", "/a")], "series string, source_path string")
    files = spark.createDataFrame([("/a/x/y/w/nada.pdf",), ("/a/b/c/promo_layout.pdf",)], "url string")
    want = [r.url for r in docs.associate(series, files).collect()]
    asked = lambda a, b: F.when(a.isNotNull() & (b == "nada"), F.raise_error(F.lit("asked"))).when(a.isNotNull(), F.lit(100.0)).cast("double")
    monkeypatch.setattr(docs.x, "partial_ratio", asked)
    assert [r.url for r in docs.associate(series, files).collect()] == want == ["/a/b/c/promo_layout.pdf"]
    monkeypatch.setattr(text, "common_length", lambda a, b: 1 / 0)
    assert text._partial("abc", "xxabcxx") == 100


def test_published_ratios():
    assert text._partial("abc", "xxabcxx") == 100 and text._partial("", "") == 100 and text._partial("", "a") == 0
    assert text._alike("this is a test", "this is a test!") == pytest.approx(96.551724, abs=1e-5)
    assert text._partial("this is a test", "this is a test!") == 100
    assert text._token_set("fuzzy was a bear", "fuzzy fuzzy was a bear") == 100
    assert text._token_set("fuzzy was a bear", "") == 0
    for a, b in (("kitten", "sitting"), ("abcde", "ace"), ("", "x"), ("aaa", "aa"), ("banana", "ananas")):
        table = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for i in range(len(a)):
            for j in range(len(b)):
                table[i + 1][j + 1] = table[i][j] + 1 if a[i] == b[j] else max(table[i][j + 1], table[i + 1][j])
        assert text.common_length(a, b) == table[-1][-1]


def test_published_codes_and_distances(spark):
    nysiis = {"Bishop": "BASAP", "Carlson": "CARLSAN", "Chapman": "CAPNAN", "Franklin": "FRANCLAN", "Greene": "GRAN", "Jacobs": "JACAB", "Lawrence": "LARANC", "Morrison": "MARASAN", "O'Banion": "OBANAN", "Richards": "RACARD", "Watkins": "WATCAN", "Wheeler": "WALAR", "Willis": "WAL", "Worthy": "WARTY", "MacIntosh": "MCANT", "": ""}
    mra = {"Byrne": "BYRN", "Boern": "BRN", "Smith": "SMTH", "Smyth": "SMYTH", "Catherine": "CTHRN", "Kathryn": "KTHRYN"}
    names = spark.createDataFrame([(n,) for n in [*nysiis, *mra]] + [(None,)], "name string").select("name", text.nysiis("name").alias("n"), text.match_rating_code("name").alias("m")).collect()
    told = {r.name: r for r in names}
    assert {k: told[k].n for k in nysiis} == nysiis and {k: told[k].m for k in mra} == mra and told[None].n is None
    pairs = spark.createDataFrame([("Byrne", "Boern"), ("Catherine", "Kathryn"), ("Tim", "Rumpelstiltskin"), ("ca", "abc"), ("MARTHA", "MARHTA"), ("DIXON", "DICKSONX"), (None, "x")], "a string, b string")
    got = {(r.a, r.b): r for r in metrics(pairs).collect()}
    assert [got[k].match_rating for k in (("Byrne", "Boern"), ("Catherine", "Kathryn"), ("Tim", "Rumpelstiltskin"), (None, "x"))] == [True, True, None, None]
    assert got["ca", "abc"].damerau == 2 and got["ca", "abc"].edits == 3
    assert got["MARTHA", "MARHTA"].jaro_winkler == pytest.approx(0.961111, abs=1e-6) and got["DIXON", "DICKSONX"].jaro_winkler == pytest.approx(0.813333, abs=1e-6)


# ---------------------------------------------------------------- names


def some_names(seed, n, low, high):
    rng = np.random.default_rng(seed)
    base = ["".join(rng.choice(list("abcdé"), int(rng.integers(low, high)))) for _ in range(n)]
    for x in base[: n // 2]:
        y = list(x)
        for _ in range(int(rng.integers(1, 4))):
            k = int(rng.integers(0, len(y) + 1))
            y[k : k + int(rng.integers(0, 2))] = list(rng.choice(list("abcdé"), int(rng.integers(0, 2))))
        base.append("".join(y))
    return [*base, "", None, base[0]]


@pytest.mark.parametrize("most", [1, 2])
def test_edit_pairs(spark, most):
    names = some_names(most, 60, 2, 9)
    frame = spark.createDataFrame([(x, 1) for x in names], "name string, rest int")

    def distance(a, b):
        row = list(range(len(b) + 1))
        for i, c in enumerate(a, 1):
            row, old = [i], row
            for j, d in enumerate(b, 1):
                row.append(min(old[j - 1] + (c != d), old[j] + 1, row[-1] + 1))
        return row[-1]

    want = [(a, b, distance(a, b)) for a, b in combinations(sorted({x for x in names if x is not None}), 2) if distance(a, b) <= most]
    assert want and rows(fuzzy.edit_pairs(frame, "name", most)) == sorted(want, key=repr)


@pytest.mark.parametrize("size", [(3, 14), (12, 30), (28, 45)])
def test_likely_pairs_and_merge(spark, size):
    names = some_names(sum(size), 50, *size)
    frame = spark.createDataFrame([(x,) for x in names], "name string")
    own = sorted({x for x in names if x})
    want = {(a, b): text._alike(a, b) for a, b in combinations(own, 2) if text._alike(a, b) >= 90}
    assert want and {(r.a, r.b): r.score for r in fuzzy.likely_pairs(frame, "name").collect()} == want
    taken, merged = set(), []
    for i, a in enumerate(own):
        if a not in taken:
            best = max(((want[a, b], j) for j, b in enumerate(own) if (a, b) in want), key=lambda x: (x[0], -x[1]), default=None)
            if best:
                taken.add(own[best[1]])
                merged.append((a, own[best[1]], best[0]))
    assert rows(fuzzy.fuzzy_merge(frame, "name")) == sorted(merged, key=repr)


# ---------------------------------------------------------------- intervals, quantiles


def chains(items):
    out, reach, first = {}, None, None
    for lo, hi, name in sorted(items):
        if reach is None or lo > reach + 1:
            first, group = name, []
        group.append(name)
        reach = hi if reach is None else max(reach, hi)
        for x in group:
            out[x] = min(group)
    del first
    return out


@pytest.mark.parametrize("keys", [1, 7])
def test_chains_of_intervals_of_one_key(spark, keys):
    """One key with all rows is spread over many parts; nulls are keys and rows of their own."""
    rng = np.random.default_rng(keys)
    items = [(None if k % keys == 3 else k % keys, int(lo), int(lo + w), f"n{k:05d}") for k, (lo, w) in enumerate(zip(rng.integers(0, 9000, 3000), rng.integers(0, 12, 3000)))]
    alone = [(0, None, 3, "z1"), (0, 3, None, "z2"), (None, None, None, "z3")]
    frame = spark.createDataFrame(items + alone, "key int, lo int, hi int, id string").repartition(5)
    spark.conf.set("spark.sql.shuffle.partitions", "13")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        parts = intervals.in_ranges(frame.where("lo is not null"), ["key"], ["lo", "id"])
        assert parts.groupBy("key").agg(F.countDistinct(intervals.PART).alias("n")).agg(F.max("n")).first()[0] >= (5 if keys == 1 else 1)
        got = {r.id: r.component for r in intervals.interval_clusters(frame, ["key"], "id").collect()}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    want = {name: name for *_, name in alone}
    by_key = defaultdict(list)
    for key, lo, hi, name in items:
        by_key[key].append((lo, hi, name))
    for group in by_key.values():
        want |= chains(group)
    assert got == want


def test_running_sums(spark):
    frame = spark.createDataFrame([(k % 2, k, k * k % 7) for k in range(200)], "g int, k int, v int")
    got = {(r.g, r.k): (r.upto, r.before) for r in intervals.running(intervals.running(intervals.in_ranges(frame, ["g"], ["k"]), ["g"], ["k"], F.col("v"), "sum", "upto"), ["g"], ["k"], F.col("v"), "sum", "before", own=False).collect()}
    for g in (0, 1):
        total = None
        for k in range(g, 200, 2):
            before, total = total, (total or 0) + k * k % 7
            assert got[g, k] == (total, before)


@pytest.mark.parametrize("small", [200, 5000])
def test_quantiles(spark, small):
    rng = np.random.default_rng(3)
    groups = {"even": rng.normal(size=900), "few": np.array([3.0]), "same": np.full(700, -2.5), "heavy": np.exp(rng.normal(size=800) * 40), "ties": rng.integers(0, 3, 600).astype(float), "wide": np.array([-1.7e308, 1.7e308] * 110 + [0.0] * 5), None: rng.normal(size=50) * 1e-300}
    cells = [(k, float(v)) for k, vs in groups.items() for v in vs] + [("few", None), ("few", math.nan), ("few", math.inf), ("none", None)]
    frame = spark.createDataFrame(cells, "g string, v double").repartition(4)
    shares = [0.0, 0.25, 0.5, 0.9, 1.0]
    got = {r.g: r.quantiles for r in quantiles.quantiles(frame, ["g"], F.col("v"), shares, small=small, bins=64).collect()}
    assert set(got) == set(groups)
    for g, vs in groups.items():
        x = np.sort(vs)
        at = [s * (len(x) - 1) for s in shares]
        assert got[g] == pytest.approx([x[math.floor(a)] * (1 - (a - math.floor(a))) + x[math.ceil(a)] * (a - math.floor(a)) for a in at], rel=1e-12)
    whole = quantiles.quantiles(frame.where("g = 'even'"), [], F.col("v"), [0.5], small=small, bins=64).collect()
    assert whole[0].quantiles == pytest.approx([float(np.median(groups["even"]))])
    assert quantiles.quantiles(frame.limit(0), ["g"], F.col("v"), [0.5]).count() == 0
    assert strings.column_summary(frame, ["g"], F.col("v")).where("g is null").first().n == 50


# ---------------------------------------------------------------- clusters


def test_complete_linkage(spark):
    rng = np.random.default_rng(8)
    for turn in range(2):
        items = [f"i{k:02d}" for k in range(26)]
        sim = {p: float(round(s, 1 if turn else 6)) for p, s in zip(combinations(items, 2), rng.random(325) ** 0.5)}
        groups = {i: [i] for i in items}
        while True:
            link = lambda a, b: min(sim[min(x, y), max(x, y)] for x in groups[a] for y in groups[b])  # noqa: E731, B023
            best = min(((-link(a, b), a, b) for a, b in combinations(sorted(groups), 2)), default=None)
            if best is None or -best[0] < 0.4:
                break
            groups[best[1]] += groups.pop(best[2])
        want = {x: c for c, xs in groups.items() for x in xs}
        pairs = spark.createDataFrame([(b, a, s) for (a, b), s in sim.items()], "a string, b string, similarity double")
        frame = spark.createDataFrame([(i,) for i in [*items, "alone", None]], "item string")
        got = {r.item: r.cluster for r in linkage.complete_linkage(frame, pairs, 0.4).collect()}
        assert got == want | {"alone": "alone"}


def plain_communities(edges, steps=4):
    """The same rule with dense arrays: reciprocal cheapest merges, each connected part at its best modularity."""
    nodes = sorted({x for e in edges for x in e})
    at = {x: i for i, x in enumerate(nodes)}
    a = np.zeros((len(nodes),) * 2)
    for x, y in edges:
        a[at[x], at[y]] = a[at[y], at[x]] = 1
    d = a.sum(1)
    step = (a + np.eye(len(nodes))) / (d + 1)[:, None]
    walk = np.linalg.matrix_power(step, steps) / np.sqrt(d + 1)
    groups = {x: [at[x]] for x in nodes}
    history = []
    while True:
        history.append({nodes[i]: c for c, g in groups.items() for i in g})
        cost = {}
        for x, y in combinations(sorted(groups), 2):
            if a[np.ix_(groups[x], groups[y])].any():
                gap = walk[groups[x]].mean(0) - walk[groups[y]].mean(0)
                cost[x, y] = round(float((gap**2).sum()) * len(groups[x]) * len(groups[y]) / (len(groups[x]) + len(groups[y])), 12)
        if not cost:
            break
        best = {x: min((c, p) for p, c in cost.items() if x in p)[1] for x in {x for p in cost for x in p}}
        for x, y in sorted(set(best.values())):
            if best[x] == best[y] == (x, y):
                groups[x] += groups.pop(y)
    out = {}
    for part in set(history[-1].values()):
        def quality(labels):
            total = 0.0
            for c in {labels[x] for x in nodes if history[-1][x] == part}:
                own = [at[x] for x in nodes if labels[x] == c]
                total += a[np.ix_(own, own)].sum() / d.sum() - (d[own].sum() / d.sum()) ** 2
            return round(total, 9)

        best = max(range(len(history)), key=lambda k: (quality(history[k]), -k))
        out |= {x: c for x, c in history[best].items() if history[-1][x] == part}
    return out


def test_communities(spark):
    rng = np.random.default_rng(2)
    graphs = {"rings": [(f"{g}{i}", f"{g}{j}") for g in "abc" for i, j in combinations(range(5), 2)] + [("a0", "b0"), ("b1", "c0"), ("z1", "z2")]}
    graphs["random"] = [(f"r{i:02d}", f"r{j:02d}") for i, j in combinations(range(22), 2) if rng.random() < (0.5 if i // 8 == j // 8 else 0.06)]
    frame = spark.createDataFrame([(g, *e) for g, es in graphs.items() for e in es] + [("rings", "a1", "a0"), ("rings", "q", "q")], "graph string, a string, b string")
    got = defaultdict(dict)
    for r in communities.communities(frame).collect():
        got[r.graph][r.node] = r.community
    assert got == {g: plain_communities(es) for g, es in graphs.items()}
    assert Counter(got["rings"].values()) == {"a0": 5, "b0": 5, "c0": 5, "z1": 2}


@pytest.mark.parametrize("clustered", [True, False])
def test_top_cosine_pairs(spark, clustered):
    rng = np.random.default_rng(4)
    x = rng.normal(size=(300, 24)) + (rng.normal(size=(6, 24)) * 4)[rng.integers(0, 6, 300)] * clustered
    kinds = [f"k{k % 3}" for k in range(300)]
    cells = [(k, [float(v) for v in x[k]], kinds[k]) for k in range(300)] + [(900, None, "k0"), (901, [0.0] * 24, "k0"), (902, [None] * 24, "k1"), (903, [math.nan] * 24, "k1"), (904, [1.0] * 24, None), (None, [1.0] * 24, "k1")]
    frame = spark.createDataFrame(cells, "id long, v array<double>, kind string")
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    want = sorted((-float(unit[a] @ unit[b]), a, b) for a, b in combinations(range(300), 2) if kinds[a] != kinds[b])[:60]
    got = sorted(((-r.cosine, r.a, r.b) for r in nearest.top_pairs(frame, "id", "v", "kind", 60, piece=40, columns=5).collect()))
    assert [g[1:] for g in got] == [w[1:] for w in want] and [g[0] for g in got] == pytest.approx([w[0] for w in want])
    few = nearest.top_pairs(frame.where("id < 4"), "id", "v", "kind", 60).count()
    assert few == 5 and nearest.top_pairs(frame.limit(0), "id", "v", "kind", 5).count() == 0


def test_top_cosine_pairs_sends_a_vector_to_few_tasks(spark, monkeypatch):
    """Sixty pieces: tasks and copies of a vector are bounded by the blocks, whatever the number of pieces."""
    rng = np.random.default_rng(6)
    x = rng.normal(size=(1200, 8))
    kinds = [f"k{k % 3}" for k in range(1200)]
    frame = spark.createDataFrame([(k, x[k].tolist(), kinds[k]) for k in range(1200)], "id long, v array<double>, kind string")
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    score = unit @ unit.T
    score[[[kinds[a] == kinds[b] or a >= b for b in range(1200)] for a in range(1200)]] = -2
    want = sorted((-score[a, b], a, b) for a, b in zip(*np.nonzero(score > 0.8), strict=True))[:300]
    tasks, cut = [], nearest.cut
    monkeypatch.setattr(nearest, "cut", lambda df: (tasks.append(df) if "task" in df.columns else None) or cut(df))
    monkeypatch.setattr(nearest, "BLOCKS", 5, raising=False)
    got = nearest.top_pairs(frame, "id", "v", "kind", 300, piece=20, pivots=4)
    assert len(want) == 300 and {(r.a, r.b) for r in got.collect()} == {(a, b) for _, a, b in want}
    assert tasks[0].select("task").distinct().count() <= 66


def test_top_cosine_pairs_multiplies_few_pairs_twice(monkeypatch):
    """Of eight million pairs only those at the bound, but for the error of single precision, get an exact product; prefixes leave nothing out that counts."""
    rng = np.random.default_rng(9)
    x = rng.normal(size=(4000, 48))
    x[:, 8:] *= np.where(np.arange(4000) < 2000, 1.0, 0.05)[:, None]  # a prefix tells for the second half
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    kinds, unit = np.arange(4000) % 3, np.arange(4000) // 1000
    table = nearest.pa.table({"id": np.arange(4000), "kind": [f"k{k}" for k in kinds], "v": [r.tobytes() for r in x], "unit": unit.astype(np.int32)})
    score = np.where((kinds[:, None] != kinds) & np.triu(np.ones((4000, 4000), bool), 1), x @ x.T, -2)
    a, b = np.unravel_index(np.argsort(-score, axis=None)[:100], score.shape)
    exact, einsum = [], np.einsum
    monkeypatch.setattr(nearest.np, "einsum", lambda how, left, right: exact.append(len(left)) or einsum(how, left, right))
    for columns in (8, 16, 48):
        got = nearest._compare_units(nearest._Units(table), ((c, [0, 1, 2, 3][c:]) for c in range(4)), -2.0, 100, 256, columns).to_pydict()
        assert list(zip(got["a"], got["b"], strict=True)) == list(zip(a.tolist(), b.tolist(), strict=True))
        assert sum(exact) < 40_000
        exact.clear()


def test_top_cosine_pairs_of_equal_vectors_and_ids(spark):
    """Ties go by a, then b, wherever their vectors are compared; a row never pairs with one of its own id."""
    rng = np.random.default_rng(10)
    base = rng.normal(size=(7, 33))
    rows = [(int(k), base[k % 7].tolist(), f"k{k % 4}") for k in rng.permutation(140)] + [(5, base[5].tolist(), "k0"), (5, base[5].tolist(), "k2")]
    kinds = [(i, i % 7, g) for i, _, g in rows]
    pairs = sorted((min(i, j), max(i, j)) for (i, c, g), (j, d, h) in combinations(kinds, 2) if c == d and g != h and i != j)
    got = nearest.top_pairs(spark.createDataFrame(rows, "id long, v array<double>, kind string"), "id", "v", "kind", 90, piece=9, pivots=5).collect()
    assert [r.cosine for r in got] == pytest.approx([1.0] * 90, abs=1e-12) and all(r.a < r.b for r in got)
    by_score = sorted((-r.cosine, r.a, r.b) for r in got)
    assert [(r.a, r.b) for r in got] == [p[1:] for p in by_score] and {(r.a, r.b) for r in got} <= set(pairs)
    one = nearest.top_pairs(spark.createDataFrame([r for r in rows if r[0] % 7 == 5], "id long, v array<double>, kind string"), "id", "v", "kind", 90, piece=9, pivots=5).collect()
    assert [(r.a, r.b) for r in one] == [p for p in pairs if p[0] % 7 == 5][:90]


# ---------------------------------------------------------------- ranking, hierarchies


def test_best_matches(spark):
    titles = [(1, "Água e saúde"), (2, "saúde, saúde!"), (3, ""), (4, None), (5, "mapa do ar"), (6, "água"), (6, "outra água")]
    asked = [(10, "saúde saúde água"), (11, "nada"), (12, None), (None, "mapa")]
    split = lambda t: [w for w in "".join(c if c.isalnum() else " " for c in (t or "").lower()).split()]
    docs_ = [(i, split(t)) for i, t in titles]
    merged = defaultdict(list)
    for i, ws in docs_:
        for w, tf in Counter(ws).items():
            merged[i, w].append((tf, len(ws)))
    mean = sum(len(ws) for _, ws in docs_) / len(docs_)
    df = Counter(w for (_, w), xs in merged.items() for _ in xs)
    want = []
    for q, t in asked:
        score = Counter()
        for w in set(split(t)):
            for (i, v), xs in merged.items():
                if v == w:
                    score[i] += sum(math.log(1 + (len(docs_) - df[w] + 0.5) / (df[w] + 0.5)) * tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * n / mean)) for tf, n in xs)
        want += [(q, i, round(s, 6), r) for r, (i, s) in enumerate(sorted(score.items(), key=lambda x: (-round(x[1], 9), x[0]))[:2], 1)]
    found = ranking.best_matches(spark.createDataFrame(titles, "id long, title string"), spark.createDataFrame(asked, "q long, t string"), "id", "title", "q", "t", 2)
    assert rows(found.withColumn("score", F.round("score", 6))) == sorted(want, key=repr)


def test_roll_up_and_descent(spark):
    edges = [("b", "a"), ("c", "a"), ("d", "b"), ("e", "b"), ("e", "c"), ("f", "e"), ("g", "f"), ("x", "y"), ("q", "q"), (None, "a")]
    frame = spark.createDataFrame(edges, "child string, parent string")
    counts = spark.createDataFrame([("g", 5), ("g", 1), ("d", 2), ("a", 1), ("lone", 9)], "node string, value int")
    got = {r.node: (r.own, r.value) for r in hierarchy.roll_up(counts, frame).collect()}
    assert got == {"g": (6, 6), "f": (0, 6), "e": (0, 6), "d": (2, 2), "c": (0, 6), "b": (0, 8), "a": (1, 9), "lone": (9, 9)}
    with pytest.raises(ValueError, match="circle"):
        hierarchy.closure(spark.createDataFrame([("a", "b"), ("b", "c"), ("c", "a")], "child string, parent string"))
    tree = spark.createDataFrame([e for e in edges if e != ("e", "c")], "child string, parent string")
    weights = spark.createDataFrame([("b", 3.0), ("c", 1.0), ("g", 7.0)], "node string, weight double")
    down = {r.node: (r.value, r.leaf) for r in hierarchy.descend(spark.createDataFrame([("a", 80.0), ("e", 10.0), ("lone", 1.0)], "node string, value double"), tree, weights).collect()}
    assert down == {"a": (80, False), "b": (60, False), "c": (20, True), "d": (30, True), "e": (40, False), "f": (40, False), "g": (40, True), "lone": (1, True)}
    assert sum(v for k, (v, leaf) in down.items() if leaf) == 91
    with pytest.raises(ValueError, match="several"):
        hierarchy.descend(counts, frame, weights)


# ---------------------------------------------------------------- versions, scans


def test_a_failing_write_leaves_the_version_before(spark, tmp_path):
    table = versions.VersionedTable(spark, str(tmp_path / "t"))
    assert table.versions() == [] and table.manifest() is None
    with pytest.raises(LookupError):
        table.read()
    first = spark.createDataFrame([(1, "a"), (2, "b"), (None, "n")], "k int, v string")
    assert table.upsert(first, ["k"]) == 1
    pinned = table.read()
    fails = first.withColumn("v", F.when(F.col("k") == 2, F.raise_error(F.lit("no"))).otherwise(F.col("v")))
    with pytest.raises(Exception, match="no"):
        table.write(fails)
    assert table.versions() == [1] and rows(table.read()) == rows(first)
    with pytest.raises(ValueError, match="more than once"):
        table.upsert(first.unionByName(first), ["k"])
    assert table.upsert(spark.createDataFrame([(2, "c"), (None, "m"), (3, "d")], "k int, v string"), ["k"]) == 2
    assert rows(table.read()) == rows(spark.createDataFrame([(1, "a"), (2, "c"), (None, "m"), (3, "d")], "k int, v string"))
    assert rows(pinned) == rows(first) == rows(table.read(1))
    with pytest.raises(versions.Conflict):
        table.write(first, based_on=1)
    assert table.replace(spark.createDataFrame([(9, "z")], "k int, v string"), F.col("k") >= 2) == 3
    assert rows(table.read()) == rows(spark.createDataFrame([(1, "a"), (None, "m"), (9, "z")], "k int, v string"))
    table.vacuum(1)
    assert table.versions() == [3] and table.read().count() == 3


def test_cache_makes_what_it_lacks_only(spark, tmp_path):
    table, made = versions.VersionedTable(spark, str(tmp_path / "c")), []

    def make(missing):
        made.append(sorted(r.k for r in missing.collect()))
        return missing.withColumn("size", F.length("k"))

    want = lambda ks: spark.createDataFrame([(k,) for k in ks], "k string")
    assert rows(versions.cached(table, want(["a", "bb", "bb"]), ["k"], make)) == [("a", 1), ("bb", 2), ("bb", 2)]
    assert rows(versions.cached(table, want(["bb", "ccc"]), ["k"], make)) == [("bb", 2), ("ccc", 3)]
    assert rows(versions.cached(table, want(["a"]), ["k"], make)) == [("a", 1)]
    assert made == [["a", "bb"], ["ccc"]]


def test_scans_as_a_stream(spark, tmp_path):
    last, changes = versions.VersionedTable(spark, str(tmp_path / "last")), versions.VersionedTable(spark, str(tmp_path / "changes"))
    source = str(tmp_path / "in")
    for scan in (["a", "b", "b", None], [], ["b", "c"], ["b", "c"]):
        spark.createDataFrame([(x,) for x in scan], "url string").coalesce(1).write.mode("append").parquet(source)
        stream = spark.readStream.schema("url string").parquet(source)
        scan_changes(stream, "url", last, changes).option("checkpointLocation", str(tmp_path / "log")).trigger(availableNow=True).start().awaitTermination()
    assert rows(changes.read()) == sorted([(0, "a", "added"), (0, "b", "added"), (1, None, "warning"), (2, "a", "removed"), (2, "b", "common"), (2, "c", "added"), (3, "b", "common"), (3, "c", "common")], key=repr)
    assert rows(last.read()) == [("b",), ("c",)]


# ---------------------------------------------------------------- families


def test_documents_leave_logical_families_unchanged(spark):
    data = [f"/dissemin/publicos/SIM/DADOS/DO{u}{y:02d}{m:02d}.dbc" for u in ("SP", "RJ") for y in (10, 11) for m in (1, 2)]
    other = ["/dissemin/publicos/SIM/DOCS/LAYOUT12.pdf", "/dissemin/publicos/SIM/TABELAS/CID1096.cnv", "/dissemin/publicos/SIM/DOCS/DOSP1205.zip", "/dissemin/publicos/SIM/x/programa98.exe"]
    frame = lambda paths: logical.inventory(spark.createDataFrame([(p,) for p in paths], "path string"))
    for made in (logical.families, logical.variants, logical.panel_files):
        assert rows(made(frame(data + other))) == rows(made(frame(data)))
    kinds = {r.path.rsplit("/", 1)[1]: (r.asset_kind, r.format_family) for r in frame(other).collect()}
    assert kinds == {"LAYOUT12.pdf": ("doc", "pdf"), "CID1096.cnv": ("aux", "unknown"), "DOSP1205.zip": ("doc", "archive"), "programa98.exe": ("other", "unknown")}


def test_records_of_families_with_documents(spark):
    from safra.operators import corpus, records

    paths = [f"/public/SIM/DO/DO{u}{y:02d}.dbc" for u in ("SP", "RJ", "BR") for y in (10, 11, 13)] + ["/public/SIM/DO/DOSP13.csv", "/public/SIM/AUXILIAR/DOSP14.dbc", "/public/SIM/DO/manual_do.pdf", "/public/SIM/far/away/from/it/all/nota.pdf", "/public/SIM/DO/sem_nome.dbc"]
    files = corpus.inventory(spark.createDataFrame([(q,) for q in paths], "path string"))
    signatures = spark.createDataFrame([(paths[0], "s1"), (paths[1], "s2"), (paths[2], ""), ("elsewhere", "s9")], "path string, schema_signature string")
    rec = records.cut(records.family_records(files, signatures))
    r = rec.collect()
    assert [x.family_id for x in r] == ["DO"]
    r = r[0]
    assert (r.file_count, r.system_guess, r.date_format, r.schema_signatures, r.preferred_working_series.coverage_gaps) == (10, "DO", "YY", ["s1", "s2"], ["2012"])
    assert r.member_files == sorted(paths[:10]) and [d.filename for d in r.associated_docs] == ["manual_do.pdf"]
    over = {(x.section, x.item): (x.n, x.listed) for x in records.overview(files, rec).collect()}
    assert over["discarded", "auxiliary_path"] == (1, [paths[10]]) and over["orphan_docs", "all"] == (1, [paths[12]]) and over["largest", "DO"] == (10, [])
    assert ("families", "without_docs") not in over and over["families", "with_gaps"] == (1, ["DO"])
    told = records.record_audit(rec).first()
    assert [i.code for i in told.issues] == ["coverage_gaps", "stitched_preferred_working_series"] and told.issues[0].summary == "preferred working series has 1 uncovered period(s)" and told.issues[0].detail["gaps"] == "2012" and len(told.recommendations) == 3
    chosen, docs_ = records.select_candidates(files, rec)
    assert [x.path for x in chosen.orderBy("selection_rank").collect()][0] == "/public/SIM/DO/DOSP13.csv" and docs_.count() == 1
    bare = rec.withColumn("preferred_working_series", F.lit(None).cast(rec.schema["preferred_working_series"].dataType))
    assert {x.path for x in records.select_candidates(files, bare)[0].collect()} <= set(paths[:10])


def test_similarity_report(spark):
    from safra.operators import records

    sets = {"d": "abc", "c": "abcd", "b": "xyz", "a": "xy", "e": "q"}
    frame = spark.createDataFrame([(k, v) for k, vs in sets.items() for v in vs], "i string, v string")
    pairs, clusters = records.similarity_report(frame, "i", "v", 0.7)
    assert [tuple(x) for x in pairs.collect()] == [("c", "d", 0.75, 3, 4, 3), ("a", "b", 0.6667, 2, 2, 3)]
    assert rows(clusters) == [("family_cluster_1", "a"), ("family_cluster_2", "b"), ("family_cluster_3", "c"), ("family_cluster_3", "d"), ("family_cluster_4", "e")]


def test_variable_catalog_signals(spark):
    from safra.operators import profile

    cells = [("a", "DTOBITO", k, "20200101") for k in range(3)] + [("b", "dtobito", 0, "01012020"), ("b", "CODMUNRES", 0, "355030"), ("c", "dtobito", 0, "x"), ("c", "RACACOR", 0, None)]
    profiles = profile.field_profiles(spark.createDataFrame(cells, "path string, name string, position long, value string"))
    members = spark.createDataFrame([("a", "F1"), ("b", "F2"), ("b", "F1")], "path string, family_id string")
    got = {r.variable: r for r in profile.variable_catalog(profiles, members).collect()}
    assert got["DTOBITO"].signals[0] == "date_name_hint" and got["DTOBITO"].scopes == ["F1", "F2"] and got["DTOBITO"].file_count == 3
    assert got["CODMUNRES"].signals == ["municipality_name_hint"] and got["RACACOR"].signals is None and got["RACACOR"].scopes == []


def test_samples_are_the_same_in_any_order(spark):
    from safra.operators import extensions

    frame = spark.range(5000).withColumn("v", F.col("id") % 7)
    one = rows(extensions.sample_rows(frame, ["id"], 200))
    assert len(one) == 200 and one == rows(extensions.sample_rows(frame.orderBy(F.desc("v")).repartition(9), ["id"], 200)) and one != rows(extensions.sample_rows(frame, ["id"], 200, seed=2))
