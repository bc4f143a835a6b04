"""Functions and operators on cases worked out by hand."""

import re
import unicodedata

import pytest
from pyspark.sql import functions as F

from safra.functions import codes, paths, periods, text
from safra.operators import corpus, graph, observables, profile, translate
from safra.plans import boolean, grammar


def one(spark, column, **values):
    row = spark.range(1).select(*[F.lit(v).alias(k) for k, v in values.items()])
    return row.select(column.alias("x")).first()["x"]


@pytest.mark.parametrize(
    "name,chain,stem,primary,family",
    [
        ("/a/DNSP2401.dbc", ".dbc", "DNSP2401", ".dbc", "dbase"),
        ("/a/MALABR18.json.zip", ".json.zip", "MALABR18", ".json", "json"),
        ("/a/.hidden", "", ".hidden", None, "unknown"),
        ("/a/x.tar.gz", ".tar.gz", "x", ".gz", "archive"),
        ("/CSV/x.zip", ".zip", "x", ".csv", "csv"),
    ],
)
def test_suffixes(spark, name, chain, stem, primary, family):
    p = F.col("p")
    got = spark.createDataFrame([(name,)], "p string").select(paths.extension_chain(p), paths.stem(p), paths.primary_extension(p), paths.format_family(p)).first()
    assert tuple(got) == (chain, stem, primary, family)


def test_name_grammar_takes_any_two_letters_as_place(spark):
    got = one(spark, paths.name_grammar(F.col("s")), s="LAYOUT12")
    assert (got["series_prefix"], got["geo_code"], got["date_code"]) == ("LAYO", "UT", "12")
    assert one(spark, paths.name_grammar(F.col("s")), s="123") is None


def test_dates_in_four_formats(spark):
    rows = spark.createDataFrame([("2024-01-31",), ("20240131",), ("31012024",), ("31/01/2024",), ("20241331",), ("x",), (None,)], "d string")
    got = [r[0] and r[0].isoformat() for r in rows.select(periods.parse_date(F.col("d"))).collect()]
    assert got == ["2024-01-31"] * 4 + [None] * 3


def test_periods_pivot_and_reject_bad_months(spark):
    rows = spark.createDataFrame([("2401", "YYMM"), ("9913", "YYMM"), ("99", "YY"), ("24", "YY"), ("2024", "YYYY")], "c string, f string")
    assert [r[0] for r in rows.select(periods.normalize(F.col("c"), F.col("f"))).collect()] == [202401, 0, 199900, 202400, 202400]


@pytest.mark.parametrize("code,kept", [("A50.1", True), ("a53", True), ("A539", True), ("A54", False), ("", False), (None, False)])
def test_code_ranges_compare_the_node_s_length(spark, code, kept):
    df = spark.createDataFrame([(code,)], "c string")
    assert df.select(codes.CodeQuery("r", "A50-A53").matches(F.col("c"))).first()[0] is kept


def test_code_query_on_a_stored_column_reaches_the_scan(spark, tmp_path):
    spark.createDataFrame([("A50",), ("B20",)], "c string").write.parquet(str(tmp_path / "c"))
    df = spark.read.parquet(str(tmp_path / "c"))
    plan = df.where(codes.CodeQuery("r", "A50-A53").matches(F.col("c"), normalized=True))._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(c,A50)" in plan


def test_rates_match_null_keys_and_drop_empty_denominators(spark):
    top = observables.Observable(spark.createDataFrame([(None, 1.0), ("a", 2.0), ("b", 1.0)], "k string, value double"), "f", "count", "extensive", ["k"])
    bottom = spark.createDataFrame([(None, 3.0), ("a", 0.0)], "k string, value double")
    assert [tuple(r) for r in observables.rates(top, bottom, family="f").cells.collect()] == [(None, 3.0, 1.5 / 4)]


def test_normalize_basic(spark):
    assert one(spark, text.normalize_basic(F.col("t")), t="  Número - de (Óbitos)!  x") == "numero-de obitos x"


def test_lenient_double(spark):
    rows = spark.createDataFrame([("12,5",), ("1.234,5",), ("...",), ("",), ("-",), (None,)], "v string")
    assert [r[0] for r in rows.select(text.lenient_double(F.col("v"))).collect()] == [12.5, None, None, None, None, None]


def test_sequence_ratio_is_not_symmetric(spark):
    df = spark.createDataFrame([("tide", "diet"), ("diet", "tide")], "a string, b string")
    assert [r[0] for r in df.select(text.sequence_ratio("a", "b")).collect()] == [0.25, 0.5]


def test_components_of_chains_and_singles(spark):
    nodes = spark.range(10).withColumnRenamed("id", "node")
    edges = spark.createDataFrame([(i, i + 1) for i in range(6)] + [(8, 9)], "a long, b long")
    got = {r["node"]: r["component"] for r in graph.connected_components(nodes, edges).collect()}
    assert got == {**dict.fromkeys(range(7), 0), 7: 7, 8: 8, 9: 8}


def test_where_expression(spark):
    node = boolean.parse('n6 >= 10 AND (TITLE ~ "obitos" OR NOT N3)')
    assert boolean.levels(node) == {"N6", "N3"}
    rows = spark.createDataFrame([({"N6": 12, "N3": 1}, ["numero de obitos"]), ({"N6": 12}, ["x"]), ({"N6": 12, "N3": 2}, ["x"]), ({}, ["obitos"])], "c map<string,bigint>, t array<string>")
    truth, why = boolean.compile_node(node, F.col("c"), {"TITLE": F.col("t")})
    assert [tuple(r) for r in rows.select(truth, why).collect()] == [(True, ["N6>=10", "TITLE~obitos"]), (True, ["N6>=10"]), (False, ["N6>=10", "N3>=1"]), (False, [])]


@pytest.mark.parametrize("bad", ["", "N6 >=", "(N6", "N6 N3", 'N6 ~ "x', "N6 >= x"])
def test_where_errors(bad):
    with pytest.raises(SyntaxError):
        boolean.parse(bad)


def test_grammar_round_trip_and_errors():
    text_ = "$ SEX cat Sex of a person\n= 1 male\n= 2 female\n~ SEXO\n@ SIM DT date Day\n> date8\n% a.pdf\n"
    assert grammar.parse(grammar.emit(grammar.parse(text_))) == sorted(grammar.parse(text_), key=lambda e: (e.scope, e.variable))
    for bad in ("= 1 x", "$ A cat", "? x", "$ A cat b\n= 1"):
        with pytest.raises(grammar.GrammarError):
            grammar.parse(bad)


def test_translation_priorities():
    entries = grammar.parse("$ A cat global\n@ S B num scoped\n~ A\n@ S A num own")
    assert translate.resolve_entry(entries, "a", "S").label == "own"
    assert translate.resolve_entry(entries, "A").label == "global"
    assert translate.resolve_entry(entries, "zz") is None


def test_candidates_prefer_new_places_then_new_periods(spark):
    rows = [("f", "Mixed-Partition", f"/{n}", n, g, p, "[Primary]", ".dbc") for n, g, p in (("BR1", "BR", 202401), ("SP1", "SP", 202402), ("SP2", "SP", 202403), ("RJ1", "RJ", 202401))]
    rows += [("g", "Unknown", "/x", "x", None, None, None, None)]
    files = spark.createDataFrame(rows, "family_id string, partition_type string, path string, filename string, geo_code string, period long, path_semantic string, primary_extension string")
    got = [tuple(r) for r in corpus.candidate_files(files, 3).orderBy("family_id", "selection_rank").collect()]
    assert got == [
        ("f", "/BR1", 1, "latest nation-wide member in mixed family; preferred primary path; format=dbc"),
        ("f", "/SP2", 2, "adds geo coverage (SP); adds time coverage; preferred primary path; format=dbc"),
        ("f", "/RJ1", 3, "adds geo coverage (RJ); preferred primary path; format=dbc"),
        ("g", "/x", 1, "most recent family member"),
    ]


FILES = "series_prefix string, path string, directory string, system_guess string, primary_extension string, format_family string, date_format string, period long, path_semantic string"


def test_working_series_stitches_formats_and_names_gaps(spark):
    row = lambda name, ext, period, d="/d": ("P", f"{d}/{name}{ext}", d, "S", ext, {".json": "json", ".csv": "csv"}.get(ext, "dbase"), "YYMM", period, "[Primary]")
    rows = [row("a", ".csv", 202401), row("a", ".json", 202401), row("b", ".csv", 202402), row("b", ".parquet", 202402), row("c", ".json", 202404), row("d", ".json", 202405, "/e")]
    rows += [("U", f"/u/{n}", "/u", None, ".dbf", "dbase", None, None, None) for n in "ba"]
    got = {r.series_prefix: r for r in corpus.working_series(spark.createDataFrame(rows, FILES), ["series_prefix"]).collect()}
    p, u = got["P"], got["U"]
    assert (p.strategy, p.coverage_complete, p.coverage_gaps, p.selected_primary_extensions) == ("stitched", False, ["Mar 2024"], [".json", ".parquet"])
    assert p.selected_files == ["/d/a.json", "/d/b.parquet", "/d/c.json", "/e/d.json"]
    assert [(s.primary_extension, s.time_range_display, s.source_paths) for s in p.segments] == [(".json", "Jan 2024", ["/d"]), (".parquet", "Feb 2024", ["/d"]), (".json", "Apr 2024 to May 2024", ["/d", "/e"])]
    assert (u.strategy, u.coverage_complete, u.selected_files, u.segment_count, u.segments[0].file_count) == ("undated_full_family", True, ["/u/a", "/u/b"], 1, 2)


def test_interval_chains_are_the_closure_of_touching_pairs(spark):
    import random

    rng = random.Random(3)
    rows = [(rng.choice("ab"), i, lo, lo + rng.randrange(4)) for i in range(120) for lo in [rng.randrange(200)]] + [("a", 500, None, None), ("a", 501, None, None)]
    got = {r["n"]: r["component"] for r in corpus.interval_clusters(spark.createDataFrame(rows, "k string, n long, lo long, hi long"), ["k"], "n").collect()}
    parent = {r[1]: r[1] for r in rows}

    def root(x):
        return x if parent[x] == x else root(parent[x])

    for k, a, lo, hi in rows:
        for m, b, lo2, hi2 in rows:
            if k == m and None not in (lo, lo2) and lo <= hi2 + 1 and lo2 <= hi + 1:
                x, y = sorted((root(a), root(b)))
                parent[y] = x
    assert got == {n: root(n) for n in parent}


def test_jaccard_pairs_by_the_rarest_values_lose_none(spark):
    import random

    rng = random.Random(5)
    sets = {i: set(rng.sample(range(30), rng.randrange(1, 9))) | {99} for i in range(120)}
    rows = spark.createDataFrame([(i, v) for i, s in sets.items() for v in s], "i long, v long")
    for least in (0.0, 0.4, 0.7, 1.0):
        want = {(a, b): len(sets[a] & sets[b]) / len(sets[a] | sets[b]) for a in sets for b in sets if a < b}
        got = {(r.a, r.b): r.similarity for r in profile.jaccard_pairs(rows, "i", "v", least).collect()}
        assert got == {k: pytest.approx(v) for k, v in want.items() if v >= least}


def test_coverage_tries_the_scopes_then_all(spark):
    registry = grammar.registry(spark, grammar.parse("$ RACACOR cat Race\n~ COR_RACA\n= 1 white\n@ S:DN DTOBITO date Day\n> date8\n"))
    names = spark.createDataFrame([("racacor",), ("DTOBITO",), ("IGNORADO",), (" ",)], "variable string")
    told = lambda scopes: {r.covered: r.variables for r in translate.coverage(names, registry, scopes).collect()}
    assert told(["S:DN"]) == {True: "DTOBITO,RACACOR", False: "IGNORADO"} and told(None) == {True: "RACACOR", False: "DTOBITO,IGNORADO"}


def test_list_lines_of_other_shapes_are_none(spark):
    good = "drwxr-xr-x 2 ftp ftp 4096 Jan 01 12:30 a name"
    bad = [good.replace("d", "x", 1), good.replace("rwx", "rws", 1), good.replace("Jan", "jan"), good.replace("Jan", "J4n"), "total 12"]
    rows = spark.createDataFrame([(x,) for x in [good, *bad]], "l string").select(paths.parse_list_line(F.col("l")).alias("e")).collect()
    assert tuple(rows[0].e) == ("dir", 4096, "Jan 01 12:30", "a name") and all(r.e is None for r in rows[1:])


def test_rates_of_several_denominators(spark):
    top = observables.Observable(spark.createDataFrame([("a", 2.0)], "k string, value double"), "f", "count", "extensive", ["k"])
    twice = spark.createDataFrame([("a", 9.0, 1), ("a", 3.0, 2)], "k string, value double, at int")
    assert [tuple(r) for r in observables.rates(top, twice, family="f", order="at").cells.collect()] == [("a", 3.0, 2.5 / 4)]
    with pytest.raises(Exception, match="several denominators"):
        observables.rates(top, twice, family="f").cells.collect()


def test_bundle_has_excerpts_and_documents(spark):
    from safra.operators import bundle

    families = spark.createDataFrame([("F", "SIM", "DO", 3), ("G", None, None, None)], "family_id string, system_guess string, series_prefix string, file_count long")
    fields = spark.createDataFrame([("F", "/a", "raca", "text", ["1", "2"], [], 2)], "family_id string, path string, name string, primitive_type string, samples array<string>, signals array<string>, shared long")
    docs = spark.createDataFrame([("F", "u", 61.0)], "family_id string, url string, score double")
    excerpts = spark.createDataFrame([("F", "a.txt", "ok", " two\n words "), ("F", "b.txt", None, None)], "family_id string, filename string, extraction_status string, excerpt string")
    got = {r.family_id: r.text for r in bundle.translation_bundle(families, fields, docs, excerpts).collect()}
    assert got["F"] == "FAMILY F\nSYSTEM SIM\nPREFIX DO\nFILES 3\n\nDOCS\n- 61.0 u\n\nDOC_EXCERPTS\n- a.txt | ok | two words\n- b.txt | unknown\n\nFIELDS\n- RACA | text | shared=2 | sig= | samp=1, 2\n\nReturn grammar only."
    assert got["G"] == "FAMILY G\nSYSTEM UNKNOWN\nPREFIX UNKNOWN\nFILES 0\n\nFIELDS\n\n\nReturn grammar only."


def test_logical_readings(spark):
    from safra.operators import logical

    rows = spark.createDataFrame([(s,) for s in ("DNSP2401", "DNBR99", "MALABR2018", "LAYOUT12", "X1", "DNXX9913", "")], "s string")
    got = [r.r and tuple(r.r)[1:] for r in rows.select(logical.reading(F.col("s")).alias("r")).collect()]
    assert got == [("DN", "yymm", "SP", 202401, True), ("DN", "yy", "BR", 199900, True), ("MALA", "yyyy", "BR", 201800, True), ("LAYOUT", "yy", None, 201200, False), None, ("DNXX99", "yy", None, 201300, False), None]
    where = spark.createDataFrame([("/dissemin/publicos/Dados_Abertos/SINAN/Malaria/json/x.json.zip",), ("/dissemin/publicos/SIM/CID10/DOCS/manual.pdf",), ("/other/x",)], "p string")
    c = [(r.distribution_root, r.system, r.subsystem, r.asset_kind) for r in logical.inventory(where.withColumnRenamed("p", "path")).collect()]
    assert c == [("Dados_Abertos", "SINAN", "Malaria", "data"), ("SIM", "SIM", None, "doc"), (None, None, None, "other")]


def test_field_types(spark):
    df = spark.createDataFrame([(i, f"2024-01-{i % 28 + 1:02d}", f"{i},5", "ab"[i % 2], "350010") for i in range(60)], "id long, DTX string, v string, k string, CODMUN string")
    got = {r["name"]: r["primitive_type"] for r in profile.field_profiles(profile.long_form(df, "t", None, "id")).collect()}
    assert got == {"id": "integer", "DTX": "date", "v": "numeric", "k": "categorical_text", "CODMUN": "municipality_code"}


def test_field_profiles_of_long_tables_in_any_order(spark):
    """Equal to plain loops over more cells than a task holds, in ascending and descending positions, with nulls, rare and unique values."""
    from collections import Counter

    n = 80_000
    value = {"few": lambda i: str(i * 7919 % 97), "own": str, "late": lambda i: None if i % 3 or i < 600 else f"v{i * 31 % 5000}"}
    for order in ("id", "-id"):
        rows = spark.range(0, n, 1, 2).withColumn("position", F.expr(order))
        one = [F.struct(F.lit(k).alias("name"), F.col(k).alias("value")) for k in value]
        id_ = F.col("id")
        values = {"few": (id_ * 7919 % 97).cast("string"), "own": id_.cast("string"), "late": F.when((id_ % 3 == 0) & (id_ >= 600), F.concat(F.lit("v"), (id_ * 31 % 5000).cast("string")))}
        cells = rows.withColumns(values).select(F.lit("t").alias("path"), F.explode(F.array(*one)).alias("c"), "position").select("path", "c.name", "position", "c.value")
        got = {r.name: r for r in profile.field_profiles(cells).collect()}
        for name, of in value.items():
            filled = [v for i in (range(n) if order == "id" else reversed(range(n))) if (v := of(i)) is not None]
            at = {v: k for k, v in reversed(list(enumerate(filled)))}
            best = sorted(Counter(filled).items(), key=lambda e: (-e[1], at[e[0]]))[:12]
            assert got[name].samples == [v for v, _ in best], (order, name)
            assert (got[name].non_null, got[name].nulls, got[name].distinct_seen) == (len(filled), n - len(filled), len(set(filled[:1000]))), (order, name)


def _cell_batches(cells, size=1000):
    import pyarrow as pa

    schema = pa.schema([("path", pa.string()), ("name", pa.string()), ("position", pa.int64()), ("value", pa.string())])
    for i in range(0, len(cells), size):
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*cells[i : i + size]), schema.types)], schema=schema)


@pytest.mark.parametrize("order", ["up", "down", "mixed"])
def test_first_cells_of_a_task(order):
    """The first cells of each field, nulls first, are among those handed on; a few fields hand on no others, many are handed on in turns."""
    import random

    for fields, held in ((5, 500), (400, 500), (400, 100_000)):
        cells = [(None if i % fields == 3 else "t", None if i % fields == 1 else f"f{i % fields}", None if i == 7777 else i, f"v{i % 50}") for i in range(20_000)]
        cells = cells if order == "up" else cells[::-1] if order == "down" else random.Random(3).sample(cells, len(cells))
        out = [tuple(r.values()) for b in profile._first_cells(_cell_batches(cells), 20, held) for r in b.to_pylist()]
        want = {}
        for c in sorted(cells, key=lambda c: -1 if c[2] is None else c[2]):
            want.setdefault(c[:2], []).append(c)
        want = [c for of in want.values() for c in of[:20]]
        assert len(set(out)) == len(out) and set(want) <= set(out) <= set(cells)
        if fields * 20 <= held:
            assert len(out) == len(want)
    assert list(profile._first_cells(iter([]), 20)) == []


def test_counted_cells_of_a_task():
    """Counts and least positions are whole, whatever the stretches; a stretch holds no more than it may."""
    cells = [("t", None if i % 4 == 1 else f"f{i % 4}", None if i % 10 == 0 else 9000 - i, f"v{i % 8}") for i in range(9000)]
    for held in (1, 3000, 100_000):
        got = {}
        for b in profile._counted_cells(_cell_batches(cells), held):
            assert len(b) <= 8
            for p, n, v, k, at in (r.values() for r in b.to_pylist()):
                count, least = got.get((p, n, v), (0, None))
                got[p, n, v] = (count + k, at if least is None else least if at is None else min(at, least))
        want = {}
        for p, n, at, v in cells:
            count, least = want.get((p, n, v), (0, None))
            want[p, n, v] = (count + 1, at if least is None else least if at is None else min(at, least))
        assert got == want


def test_field_profiles_neither_sort_nor_table_all_cells_of_a_task(spark):
    """Until a task's cells are reduced or shuffled, none sorts them or groups them by value: either would grow with the task."""
    cells = profile.long_form(spark.range(10).withColumn("v", F.col("id") % 3), "t", None, "id")

    def steps(node):
        """Sorts and aggregates of cells as they are read."""
        children = [node.children().apply(i) for i in range(node.children().size())]
        below = [steps(c) for c in children]
        done = node.nodeName() in ("Exchange", "MapInArrow") or any(d for d, _ in below)
        own = [node.simpleString(200)] if not done and ("Aggregate" in node.nodeName() or node.nodeName() == "Sort") else []
        return done, own + [x for _, found in below for x in found]

    found = steps(profile.field_profiles(cells)._jdf.queryExecution().executedPlan().initialPlan())[1]
    assert found and not [s for s in found if s.startswith("Sort ") or "value#" in s.split("functions=")[0]]


def test_no_row_at_a_time_python_in_built_in_queries(spark):
    df = spark.range(3).select(F.lit("/a/B/DNSP2401.dbc").alias("path"))
    assert "BatchEvalPython" not in corpus.inventory(df)._jdf.queryExecution().executedPlan().toString()


def test_normalize_exact_holds_few_texts_at_once(spark):
    """Equal to the plain rule on odd texts; a batch's Python strings stay far below its size."""
    import tracemalloc

    import pyarrow as pa

    texts = [None, "", "  Á\u0301çãO -- x_y ", "ﬁm\u00a0½ Ⅷ", "ΑΣ-  ΑΣ", "a\n\t-\tb!"] * 200 + ["é -" * 4000] * 400
    tracemalloc.start()
    got = text.normalize_exact.func(pa.array(texts, pa.string())).to_pylist()
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()

    def plain(t):
        t = "".join(c for c in unicodedata.normalize("NFKD", t or "") if not unicodedata.combining(c)).lower()
        return re.sub(r" *- *", "-", re.sub(r"\s+", " ", re.sub(r"[^\w\s-]", " ", t)).strip())

    assert got == [plain(t) for t in texts]
    assert peak < 60_000_000 and text.normalize_exact.func(pa.array([], pa.string())).to_pylist() == []
    rows = spark.createDataFrame([(k, t) for k, t in enumerate(texts[:6])], "k int, t string").select("k", text.normalize_exact("t")).collect()
    assert dict(map(tuple, rows)) == {k: plain(t) for k, t in enumerate(texts[:6])}


def test_jaccard_pairs_judge_short_sets_where_they_meet(spark):
    """Equal to brute force, for sets shorter and longer than those that travel along; the join itself drops pairs that are not alike."""
    import random

    draw = random.Random(5)
    sets = {k: {draw.randrange(12) for _ in range(draw.randrange(1, 7))} for k in range(60)} | {k: set(draw.sample(range(60), draw.randrange(28, 55))) for k in range(60, 80)}
    rows = spark.createDataFrame([(k, v) for k, s in sets.items() for v in s], "i int, v int")
    for least in (0.0, 0.5, 0.7):
        pairs = profile.jaccard_pairs(rows, "i", "v", least)
        got = {(r.a, r.b): (r.shared, round(r.similarity, 9)) for r in pairs.collect()}
        alike = {(a, b): (len(x & y), round(len(x & y) / len(x | y), 9)) for a, x in sets.items() for b, y in sets.items() if a < b and x & y}
        assert got == {p: m for p, m in alike.items() if m[1] >= least}
    plan = pairs._jdf.queryExecution().optimizedPlan().toString()
    assert any("Join Inner" in line and "array_intersect" in line for line in plan.splitlines())
