"""Every statement of this subpackage against its query on the sf0.001 tables."""

import os

import duckdb
import pytest

from pixelflow.llm import oracle
from pixelflow.llm.queries import QUERIES
from tools.oracle_check import TABLES, TYPES, digest

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("key", sorted(oracle.statements()))
def test_query_matches_oracle(spark, key):
    con = duckdb.connect()
    for t in TABLES:
        if os.path.exists(p := f"{SF}/{t}.parquet"):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    df = QUERIES[key](spark, SF)
    rel = con.sql(oracle.statements()[key])
    assert {f.name: TYPES[f.dataType.simpleString()] for f in df.schema.fields} == {n: str(t) for n, t in zip(rel.columns, rel.types)}
    assert digest(df.columns, [tuple(r) for r in df.collect()]) == digest(rel.columns, rel.fetchall())
