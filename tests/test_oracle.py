"""Every query with a SQL counterpart equals it on the driver's smallest tables."""

from __future__ import annotations

import math
from pathlib import Path

import duckdb
import pytest

from assay import catalog

SF = Path("/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not SF.exists(), reason="no test tables")


@pytest.fixture(scope="module")
def oracle():
    con = duckdb.connect()
    for p in SF.glob("*.parquet"):
        con.execute(f"CREATE VIEW {p.stem} AS SELECT * FROM read_parquet('{p}')")
    return con


def plain(v):
    return (None if math.isnan(v) else round(v, 6)) if isinstance(v, float) else v


@pytest.mark.parametrize("name", sorted(catalog.ORACLE_SQL))
def test_equals_sql(spark, oracle, name):
    df = catalog.QUERIES[name](spark, str(SF))
    columns = sorted(df.columns)
    got = sorted((tuple(plain(r[c]) for c in columns) for r in df.collect()), key=str)
    run = oracle.execute(catalog.ORACLE_SQL[name])
    names = [d[0] for d in run.description]
    assert sorted(names) == columns
    want = sorted((tuple(plain(r[names.index(c)]) for c in columns) for r in run.fetchall()), key=str)
    assert got == want


@pytest.mark.parametrize("name", sorted(set(catalog.QUERIES) - set(catalog.ORACLE_SQL)))
def test_runs(spark, name):
    assert catalog.QUERIES[name](spark, str(SF)).limit(5).collect() is not None
