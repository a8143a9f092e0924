"""Every query with SQL against DuckDB on the smallest tables."""

import math
import os

import pytest

from seamfold.plans import matches, runs, suite  # noqa: F401

DIR = "/root/testdata/sf0.001"


def norm(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return None
    return round(float(v), 9) if isinstance(v, float) else str(v)


@pytest.fixture(scope="module")
def duck():
    import duckdb

    con = duckdb.connect()
    for f in os.listdir(DIR):
        con.execute(f"CREATE VIEW {f.split('.')[0]} AS SELECT * FROM '{DIR}/{f}'")
    return con


@pytest.mark.skipif(not os.path.isdir(DIR), reason="no test tables")
@pytest.mark.parametrize("name", sorted(suite.QUERIES))
def test_query(spark, duck, name):
    df = suite.QUERIES[name](spark, DIR)
    got = [tuple(r) for r in df.select(*sorted(df.columns)).collect()]
    if name in suite.ORACLES:
        rel = duck.sql(suite.ORACLES[name])
        want = rel.select(*sorted(rel.columns)).fetchall() if sorted(rel.columns) == sorted(df.columns) else pytest.fail("columns differ")
        key = lambda rows: sorted(tuple(map(str, map(norm, r))) for r in rows)
        assert key(got) == key(want)
