"""Every batch query equals its DuckDB SQL twin on the smallest driver tables."""

import math

import duckdb
import pytest

import __spark_entry__ as se
from turnmeter.plans.catalog import QUERIES
from turnmeter.sources.tables import DRIVER_TABLES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in DRIVER_TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return con


def _norm(v):
    return round(v, 9) if isinstance(v, float) and not math.isnan(v) else v


def _key(t):
    return tuple((0, "") if x is None else (1, str(x)) for x in t)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, duck, name):
    df = se.queries()[name](spark, SF)
    cols = df.columns
    got = sorted((tuple(_norm(r[c]) for c in cols) for r in df.collect()), key=_key)
    res = duck.execute(se.oracle_sql()[name])
    ocols = [d[0] for d in res.description]
    assert sorted(ocols) == sorted(cols)
    idx = [ocols.index(c) for c in cols]
    want = sorted((tuple(_norm(r[i]) for i in idx) for r in res.fetchall()), key=_key)
    assert got == want


def test_entry_smoke(spark):
    df = se.entry(spark)
    assert df.count() > 0 and "p95_query_ms" in df.columns
