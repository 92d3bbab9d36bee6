"""Corpus queries with SQL equal it on the driver's tables."""

from __future__ import annotations

from pathlib import Path

import duckdb
import pytest

from assay.llm import entries

SF = Path("/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not SF.exists(), reason="no test tables")


@pytest.fixture(scope="module")
def oracle():
    con = duckdb.connect()
    for name in ("documents", "pages", "labels"):
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{SF}/{name}.parquet')")
    return con


@pytest.mark.parametrize("name", sorted(entries.ORACLE_SQL))
def test_equals_sql(spark, oracle, name):
    df = entries.QUERIES[name](spark, str(SF))
    run = oracle.execute(entries.ORACLE_SQL[name])
    names = [d[0] for d in run.description]
    assert sorted(names) == sorted(df.columns)
    want = sorted((tuple(r) for r in run.fetchall()), key=str)
    assert sorted((tuple(r[c] for c in names) for r in df.collect()), key=str) == want
