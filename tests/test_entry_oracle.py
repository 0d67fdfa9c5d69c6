"""Every registered query against its DuckDB oracle on the smallest tables."""

import math
import os

import duckdb
import pytest

import __spark_entry__ as entry
from overround.plans.catalog import ORACLE_SQL, QUERIES

SF = "/root/testdata/sf0.001"
TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]

pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="test tables not present")


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


def _norm(v):
    if v is None:
        return (0, "")
    if isinstance(v, bool):
        return (4, str(v))
    if isinstance(v, (int, float)):
        return (1, "nan" if isinstance(v, float) and math.isnan(v) else f"{float(v):.9g}")
    if isinstance(v, (list, tuple)):
        return (2, repr([_norm(x) for x in v]))
    if hasattr(v, "isoformat"):
        return (3, v.isoformat())
    return (5, str(v))


def test_entry_runs(spark):
    df = entry.entry(spark)
    assert df.columns == ["match", "start_time", "market_name", "home_team", "home_win", "away_team",
                          "away_win", "margin", "agency"]
    assert df.count() > 0


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLE_SQL)
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    sdf = entry.queries()[name](spark, SF)
    cols = sdf.columns
    got = sorted(tuple(_norm(r[c]) for c in sorted(cols)) for r in sdf.collect())
    res = con.execute(entry.oracle_sql()[name])
    ocols = [d[0] for d in res.description]
    assert sorted(ocols) == sorted(cols)
    idx = [ocols.index(c) for c in sorted(cols)]
    exp = sorted(tuple(_norm(r[i]) for i in idx) for r in res.fetchall())
    assert got == exp
