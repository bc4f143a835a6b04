"""Every query with SQL gives what DuckDB gives on the same tables."""

import math
import os
from pathlib import Path

import duckdb
import pytest

from safra import queries

SF = Path(os.environ.get("SAFRA_TEST_SF", "/root/testdata/sf0.001"))
pytestmark = pytest.mark.skipif(not SF.exists(), reason="no test tables here")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for f in SF.iterdir():
        con.sql(f"create view {f.stem} as select * from '{f}'")
    return con


def rows(found, columns):
    order = sorted(range(len(columns)), key=lambda i: columns[i])

    def cell(v):
        if isinstance(v, float):
            return None if math.isnan(v) else round(v, 6)
        return v

    return sorted((tuple(cell(r[i]) for i in order) for r in found), key=repr)


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_same_as_duckdb(spark, duck, name):
    df = queries.QUERIES[name](spark, str(SF))
    want = duck.sql(queries.SQL[name])
    assert sorted(df.columns) == sorted(want.columns)
    assert rows([tuple(r) for r in df.collect()], df.columns) == rows(want.fetchall(), want.columns)


@pytest.mark.parametrize("name", sorted(set(queries.QUERIES) - set(queries.SQL)))
def test_runs(spark, name):
    assert queries.QUERIES[name](spark, str(SF)).count() >= 0


def test_entry_works_without_the_training_data_part():
    import __spark_entry__

    assert set(queries.QUERIES) <= set(__spark_entry__.queries())
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
