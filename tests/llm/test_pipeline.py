"""The pipeline against its stages' rules on a small table."""

import os
from pathlib import Path

import pytest

import corpus_pipeline
from safra.llm.common import read_table

SF = Path(os.environ.get("SAFRA_TEST_SF", "/root/testdata/sf0.001"))
pytestmark = pytest.mark.skipif(not SF.exists(), reason="no test tables here")


def test_stages(spark):
    docs = read_table(spark, str(SF), "documents")
    columns, kept = docs.columns, {r.doc_id: r.text for r in docs.collect()}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before = kept
        docs = corpus_pipeline.materialize(stage(spark, docs, str(SF)), name)
        assert docs.columns == columns
        rows = docs.collect()
        kept = {r.doc_id: r.text for r in rows}
        assert kept.items() <= before.items()
        if name == "language_id":
            assert set(kept) == {i for i, t in before.items() if any(c.isalpha() for c in t or "")}
        if name == "exact_dedup":
            low = {}
            for i, t in before.items():
                key = "".join(c.lower() if "A" <= c <= "Z" else c for c in t)
                low[key] = max(i, low.get(key, -1))
            assert set(kept) == set(low.values())
        if name == "source_mix":
            times = [sum(r.doc_id == i for r in rows) for i in kept]
            assert max(times) <= 2
    out = corpus_pipeline.STAGES[-1][1](spark, docs, str(SF))
    assert sorted(r.doc_id for r in out.select("doc_id").collect()) == sorted(r.doc_id for r in rows)


def test_stages_on_edge_rows(spark):
    """Nulls, empty and very long texts, repeated rows, ids with several texts, extra columns with names used inside."""
    one = " ".join(f"palavra{i}" for i in range(60))
    texts = [(1, one), (1, one), (2, one.upper()), (3, one + " fim"), (3, "outro texto curto"), (4, None), (5, ""), (6, " \t\n"), (7, "1234 5678"), (None, "sem número aqui"), (None, None), (8, "texto longo é bom " * 30_000)]
    rows = [(i, t, None if k % 2 else "pt", (None, "a", "b")[k % 3], k, "x", k, "y", {"n": "z"}) for k, (i, t) in enumerate(texts)]
    schema = "doc_id long, text string, lang string, source string, n_chars int, lang_pred string, row int, key string, class map<string,string>"
    docs = spark.createDataFrame(rows, schema).repartition(2)
    kept = []
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = corpus_pipeline.materialize(stage(spark, docs, ""), name)
        assert docs.schema.simpleString() == spark.createDataFrame([], schema).schema.simpleString()
        kept.append(sorted(((r.doc_id or 0, r.text) for r in docs.collect()), key=str))
    letters = sorted(((i or 0, t) for i, t in texts if t and any(c.isalpha() for c in t)), key=str)
    assert kept[0] == letters
    # equal but for case: doc 2 stays, the largest id; the repeated rows of doc 1 go with it
    assert kept[1] == [x for x in letters if x != (1, one)]
    assert kept[2] == [x for x in kept[1] if x != (3, one + " fim")]
    assert {x: kept[3].count(x) for x in kept[3]}.keys() <= set(kept[2]) and max(kept[3].count(x) for x in kept[2]) <= 2
    out = corpus_pipeline.STAGES[-1][1](spark, docs, "")
    assert out.count() == len(kept[3])


def test_stages_on_no_rows(spark):
    docs = spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars int")
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, "")
        assert docs.count() == 0
