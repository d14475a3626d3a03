"""Each query against its SQL on the smallest tables."""

import datetime as dt
import decimal
from pathlib import Path

import duckdb
import pytest

from palimpsest.plans import catalog

DATA = Path("/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not DATA.exists(), reason="no test tables")


def plain(v):
    if isinstance(v, decimal.Decimal):
        return float(v)
    if isinstance(v, float):
        return repr(round(v, 5))
    if isinstance(v, dt.datetime):
        return v.isoformat()
    return v


def rows(names, data):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(repr([plain(r[i]) for i in order]) for r in data)


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for f in DATA.glob("*.parquet"):
        c.execute(f"create view {f.stem} as select * from read_parquet('{f}')")
    return c


@pytest.mark.parametrize("name", list(catalog.oracle_sql()))
def test_equals_sql(spark, con, name):
    df = catalog.queries()[name](spark, str(DATA))
    got = df.collect()
    want = con.execute(catalog.oracle_sql()[name])
    names = [c[0] for c in want.description]
    assert sorted(df.columns) == sorted(names)
    assert rows(df.columns, got) == rows(names, want.fetchall())


@pytest.mark.parametrize("name", sorted(set(catalog.queries()) - set(catalog.oracle_sql())))
def test_runs(spark, name):
    assert catalog.queries()[name](spark, str(DATA)).count() > 0
