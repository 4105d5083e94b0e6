"""Every registered query against its DuckDB statement on the sf0.001 tables
(row count, column names, order-insensitive value hash)."""

import os

import duckdb
import pytest

import __spark_entry__ as E
from pixelflow import oracle
from pixelflow.queries import QUERIES
from tools.oracle_check import TABLES, digest

SF = "/root/testdata/sf0.001"
KEYS = sorted(QUERIES)
SQL = oracle.statements()
TYPES = {"string": "VARCHAR", "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "boolean": "BOOLEAN"}


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        p = f"{SF}/{t}.parquet"
        if os.path.exists(p):
            c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return c


def test_every_query_has_an_oracle():
    assert set(SQL) == set(KEYS)
    assert set(KEYS) <= set(E.queries()) and set(SQL) <= set(E.oracle_sql()) <= set(E.queries())


@pytest.mark.parametrize("key", KEYS)
def test_query_matches_oracle(spark, con, key):
    df = QUERIES[key](spark, SF)
    rows = [tuple(r) for r in df.collect()]
    rel = con.sql(SQL[key])
    dtypes = {n: str(t) for n, t in zip(rel.columns, rel.types)}
    stypes = {f.name: TYPES.get(f.dataType.simpleString(), f.dataType.simpleString()) for f in df.schema.fields}
    assert stypes == dtypes
    res = con.execute(SQL[key])
    dcols = [d[0] for d in res.description]
    drows = res.fetchall()
    assert sorted(df.columns) == sorted(dcols)
    assert len(rows) == len(drows)
    assert digest(df.columns, rows) == digest(dcols, drows)


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns == ["hour_group", "state", "os", "browser", "category", "imp", "conv", "rate"]
    assert df.count() > 0
