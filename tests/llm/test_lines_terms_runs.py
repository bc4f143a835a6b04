"""Line deduplication, lexical search and periodic runs against brute force and SQL."""

import hashlib
import math
import os
import re
from collections import Counter, defaultdict
from pathlib import Path
from zlib import crc32

import duckdb
import numpy as np
import pytest

from safra.llm import lexical_search, line_dedup, periodic_runs, queries
from safra.llm.common import read_table

SF = Path(os.environ.get("SAFRA_TEST_SF", "/root/testdata/sf0.001"))
here = pytest.mark.skipif(not SF.exists(), reason="no test tables here")


def fold(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


@here
@pytest.mark.parametrize("name", ["op3_exact_dedup", "op11_line_dedup", "op12_lexical_search"])
def test_same_as_duckdb(spark, name):
    con = duckdb.connect()
    for f in SF.iterdir():
        con.sql(f"create view {f.stem} as select * from '{f}'")
    df, want = queries.QUERIES[name](spark, str(SF)), con.sql(queries.ORACLE_SQL[name])
    columns = sorted(want.columns)
    assert columns == sorted(df.columns)
    assert sorted(map(repr, (tuple(r[c] for c in columns) for r in df.collect()))) == sorted(map(repr, want.select(*columns).fetchall()))


# ---------------------------------------------------------------- lines


def line_rule(docs):
    """(id, text) rows by brute force: sorted (id, lines, dropped, kept)."""
    strip = "\x20\x09\x0a\x0b\x0c\x0d"
    holders = defaultdict(set)
    key = lambda x: fold(x).strip(strip)
    for i, t in docs:
        for x in (t or "").split("\n"):
            if len(key(x)) >= 10:
                holders[key(x)].add(math.inf if i is None else i)
    out = []
    for i, t in docs:
        own, lines = math.inf if i is None else i, (t or "").split("\n")
        kept = [x for x in lines if len(holders[key(x)]) < 2 or min(holders[key(x)]) == own]
        out.append((i, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return sorted(out, key=repr)


def line_docs():
    shared = "Uma linha que se repete"
    docs = [(i, f"{shared}\nlinha própria número {i}\ncurta\n\t{shared.upper()} \x0b\r") for i in range(1, 30)]
    docs += [(3, "outra linha do mesmo documento"), (40, "outra linha do mesmo documento\n\n"), (41, None), (42, ""), (43, "curta\ncurta"), (None, f"{shared}\nsó aqui, sem número"), (None, "só aqui, sem número"), (44, "É LONGA a linha\n" * 400), (45, "é longa a linha"), (46, "É longa A linha" + "\x85"), (47, "\n".join(f"uma de muitas linhas {k}" for k in range(3000)))]
    return docs


def frame(spark, docs):
    return spark.createDataFrame([(i, t, "x", b"y", 1) for i, t in docs], "doc_id long, text string, digests string, digest binary, n_lines int").repartition(3)


def line_result(spark, docs, index):
    return sorted((tuple(r) for r in line_dedup.deduplicate_lines(frame(spark, docs), index).collect()), key=repr)


def test_lines_by_brute_force(spark):
    docs = line_docs()
    assert line_result(spark, docs, line_dedup.build(frame(spark, docs), shard_keys=500)) == line_rule(docs)
    assert line_result(spark, docs, line_dedup.build(frame(spark, docs), rounds=1)) == line_rule(docs)


def test_lines_of_no_rows(spark):
    none = frame(spark, [(1, "x")]).limit(0)
    assert line_dedup.deduplicate_lines(none, line_dedup.build(none)).count() == 0


def test_lines_are_reversible(spark):
    first = [d for d in line_docs() if d[0] is not None and d[0] <= 20]
    second = [d for d in line_docs() if d not in first]
    both = line_dedup.LineIndex.empty(spark, 200, 50).insert(frame(spark, first)).insert(frame(spark, second))
    assert line_result(spark, first + second, both) == line_rule(first + second)
    again = both.insert(frame(spark, first[:5]))
    assert sorted(map(tuple, again.counts().collect())) == sorted(map(tuple, both.counts().collect()))
    # the keepers of most lines go, then all of the second part
    ids = lambda rows: spark.createDataFrame([(i,) for i, _ in rows] + [(999,)], "id long")
    less = both.delete(ids(first[:2]))
    rest = [d for d in first + second if d[0] not in {i for i, _ in first[:2]}]
    assert line_result(spark, rest, less) == line_rule(rest)
    back = less.delete(ids(second))
    left = [d for d in rest if d in first]
    assert line_result(spark, left, back) == line_rule(left)
    fresh = line_dedup.build(frame(spark, left))
    assert sorted(map(tuple, back.counts().collect())) == sorted(map(tuple, fresh.counts().collect()))
    # the filters deny what has gone, and still know what is left
    known = back.counts().where("refs > 0").count()
    sizes = [sum(int(np.count_nonzero(s)) + len(x) for s, x in line_dedup.CuckooFilter.load(bytes(r.filter)).tables) for r in back.filters.collect()]
    assert known <= sum(sizes) <= known + 1
    # what was deleted may come back
    full = back.insert(frame(spark, [d for d in first[:2] + second ]))
    assert line_result(spark, first + second, full) == line_rule(first + second)


def test_cuckoo_filter():
    rng = np.random.default_rng(5)
    digests = rng.integers(0, 256, (20_000, 32), dtype=np.uint8)
    sieve = line_dedup.CuckooFilter()
    for part in np.array_split(digests[:15_000], [200, 900, 5000]):
        sieve.add(part)
    sieve = line_dedup.CuckooFilter.load(sieve.dump())
    assert sieve.contains(digests[:15_000]).all() and sieve.contains(digests[15_000:]).mean() < 0.01
    sieve.remove(digests[:9_000])
    assert sieve.contains(digests[9_000:15_000]).all() and sieve.contains(digests[:9_000]).mean() < 0.01
    sieve.remove(digests[9_000:15_000])
    assert not any(s.any() or len(x) for s, x in sieve.tables)
    # fuller than its slots: the stash holds the rest
    full = line_dedup.CuckooFilter([(np.zeros((16, 4), np.uint16), np.zeros(0, np.uint64))])
    marks, places = line_dedup._marks(digests[:80])
    full._settle(marks, places & np.uint64(15))
    assert full.contains(digests[:80]).all() and len(full.tables[0][1]) == 16
    full.remove(digests[:80])
    assert not full.tables[0][0].any() and not len(full.tables[0][1])
    assert not line_dedup.CuckooFilter.load(b"").contains(digests).any()


# ---------------------------------------------------------------- terms


def search_rule(docs, items, k=10):
    rx = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")
    own = [(i, Counter(rx.findall(fold(t)))) for i, t in docs]
    own = [(i, c, sum(c.values())) for i, c in own if c]
    n, total, df = len(own), sum(x[2] for x in own), Counter(t for _, c, _ in own for t in c)
    out = []
    for item, text in items:
        scored = []
        for i, c, size in own:
            m = 10 + 90 * size * n // total
            score = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 8 * m)) for t in set(rx.findall(fold(text))) if t in c)
            if score > 0:
                scored.append((-score, i is None, i or 0))
        out += [(item, r, None if none else i, -s) for r, (s, none, i) in enumerate(sorted(scored)[:k], 1)]
    return sorted(out, key=repr)


def search_frames(spark, docs, items):
    left = spark.createDataFrame([(i, t, 1, "x") for i, t in docs], "doc_id long, text string, block int, term string").repartition(3)
    return left, spark.createDataFrame([(i, t, "x") for i, t in items], "item_id long, text string, query string")


def test_search_by_brute_force(spark):
    rng = np.random.default_rng(3)
    words = [f"w{k}" for k in range(60)]
    draw = lambda n: " ".join(words[int(59 * rng.random() ** 3)] for _ in range(n))
    docs = [(i, draw(int(rng.integers(1, 60)))) for i in range(400)]
    docs += [(i + 1000, docs[i][1].upper()) for i in range(0, 400, 3)]
    docs += [(7, "Água, água; w1 w2"), (None, "w58 w58"), (None, None), (2000, ""), (2001, " ;;; "), (2002, "w1 " * 40_000), (2003, "é" * 5000), (2004, "w58 w58")]
    items = [(i, draw(int(rng.integers(1, 15)))) for i in range(25)]
    items += [(100, None), (101, "!!"), (102, "ausente"), (103, "água W58"), (103, "w58"), (None, "w58 w3 w3"), (104, draw(400))]
    for options in ({}, {"block_rows": 7, "pairs": 60, "pieces": 2}):
        got = lexical_search.search(*search_frames(spark, docs, items), **options)
        assert sorted((tuple(r) for r in got.collect()), key=repr) == search_rule(docs, items)


def test_search_in_few_or_no_rows(spark):
    docs, items = [(1, "um dois"), (2, "dois três"), (3, None)], [(1, "um dois três"), (2, "quatro")]
    for d, q in ((docs, items), (docs[:1], items), ([], items), (docs, [])):
        got = lexical_search.search(*search_frames(spark, d, q))
        assert sorted((tuple(r) for r in got.collect()), key=repr) == search_rule(d, q)


def test_threshold_is_the_largest_that_is_safe():
    rng = np.random.default_rng(1)
    for _ in range(300):
        best = rng.integers(0, 50, int(rng.integers(1, 8))).tolist()
        low = int(rng.integers(0, sum(best) + 1))
        t = lexical_search.threshold(low, best)
        assert sum(min(t, x) for x in best) <= low and (t >= max(best) or sum(min(t + 1, x) for x in best) > low)


# ---------------------------------------------------------------- runs


def run_rule(words):
    """Every maximal run by its definition."""
    n, out = len(words), []
    for q in range(1, n // 4 + 1):
        a = 0
        while a + q < n:
            b = a
            while b + q < n and words[b] == words[b + q]:
                b += 1
            length = b - a + q
            if length >= max(6, 4 * q):
                part = words[a : a + length]
                if all(any(part[i] != part[i + d] for i in range(length - d)) for d in range(1, q)):
                    out.append((a, length, q))
            a = b + 1
    return sorted(out, key=lambda r: (r[0], r[2]))


def run_row(doc_id, words):
    runs = run_rule(words)
    best = max(runs, key=lambda r: (r[1] / r[2], -r[0], -r[2]), default=None)
    gone = {i for a, n, q in runs for i in range(a + q, a + n)}
    told = "".join(f"{a},{n},{q}\n" for a, n, q in runs)
    return (doc_id, len(runs), *(best or (None,) * 3), best and 1000 * best[1] // best[2], sha(told), sha(" ".join(w for i, w in enumerate(words) if i not in gone)))


def split(text):
    return [x for x in re.split("[\x20\x09-\x0d]+", text or "") if x]


def test_scan_by_definition():
    rng = np.random.default_rng(11)
    for turn in range(250):
        docs = []
        for _ in range(int(rng.integers(1, 5))):
            x = rng.integers(0, int(rng.integers(1, 4)), int(rng.integers(0, 70)))
            if turn % 2 and len(x) > 5:
                a, p = int(rng.integers(0, len(x))), int(rng.integers(1, 9))
                x = np.concatenate([x[:a], np.resize(x[a : a + p], len(x) - a)])
            docs.append(x.astype(np.int32))
        assert periodic_runs.scan(docs) == [run_rule(x.tolist()) for x in docs]
        halves = [periodic_runs.scan(docs, 1, 3), periodic_runs.scan(docs, 4)]
        assert [sorted(a + b, key=lambda r: (r[0], r[2])) for a, b in zip(*halves, strict=True)] == periodic_runs.scan(docs)


def test_runs_of_long_documents_by_ranges_of_lags(spark):
    texts = [(1, "um dois três " * 300), (2, " ".join(f"p{k % 97} q{k // 50}" for k in range(1500))), (2, "x " * 700), (None, ("a b a b c " * 200) + "fim " * 9), (3, None), (4, ""), (5, "só uma"), (6, "y y y y y"), (7, "y y y y y y"), (8, "z" * 100_000), (9, "\x1fa \x1fa \x0b\x1fa\t\x1fa \x1fa \x1fa")]
    rows = spark.createDataFrame([(i, t, "x", 3, 4) for i, t in texts], "doc_id long, text string, runs string, row int, n_words int").repartition(2)
    want = sorted(((i, len(split(t)), run_rule(split(t))) for i, t in texts), key=repr)
    for options in ({}, {"work": 2000}, {"work": 2000, "ranges": 3}):
        got = periodic_runs.periodic_runs(rows, **options).collect()
        assert sorted(((r.doc_id, r.n_words, [tuple(x) for x in r.runs]) for r in got), key=repr) == want
    assert periodic_runs.periodic_runs(rows.limit(0)).count() == 0


@here
def test_op13(spark):
    want = {}
    for d in read_table(spark, str(SF), "documents").collect():
        words, h = split(d.text), crc32(str(d.doc_id).encode())
        g, n = h // 10, len(words)
        if h % 10 == 0 and n:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
        want[d.doc_id] = (words, d.doc_id)
    rows = queries.QUERIES["op13_periodic_runs"](spark, str(SF)).collect()
    assert len(rows) == len(want)
    for r in rows:
        words, doc_id = want[r.doc_id]
        if len(words) <= 2500:
            assert tuple(r) == run_row(doc_id, words)
    assert sum(r.n_runs > 0 for r in rows) >= 0.04 * len(rows)
