"""Every core query with SQL against that SQL, on small tables."""

import math
import os

import pytest

import __spark_entry__ as entry
from quirework.plans.queries import ORACLES, QUERIES

FOLDER = "/root/testdata/sf0.01"

pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables here")


@pytest.fixture(scope="module")
def duck():
    import duckdb

    c = duckdb.connect()
    for f in os.listdir(FOLDER):
        c.execute(f"CREATE VIEW {f[:-8]} AS SELECT * FROM '{FOLDER}/{f}'")
    return c


def plain(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(round(v, 6) + 0.0)
    return repr(v)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_against_sql(spark, duck, name):
    df = QUERIES[name](spark, FOLDER)
    result = duck.execute(ORACLES[name])
    columns = [d[0] for d in result.description]
    assert sorted(columns) == sorted(df.columns)
    want = sorted(tuple(plain(r[columns.index(c)]) for c in sorted(columns)) for r in result.fetchall())
    got = sorted(tuple(plain(r[c]) for c in sorted(columns)) for r in df.collect())
    assert got == want and got


def test_entry(spark):
    assert set(entry.oracle_sql()) <= set(entry.queries()) and set(ORACLES) <= set(QUERIES)
    assert entry.entry(spark).count() > 0
    for name in set(QUERIES) - set(ORACLES):
        assert QUERIES[name](spark, FOLDER).count() > 0
