"""Every query with an oracle gives the oracle's rows, values compared; the others run and return rows."""

import math
import os

import duckdb
import pytest

import __spark_entry__ as E
from tillwise.plans import catalog

from .conftest import SF


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for f in os.listdir(SF):
        c.execute(f"CREATE VIEW {f.split('.')[0]} AS SELECT * FROM read_parquet('{SF}/{f}')")
    return c


def plain(v):
    if v is None or isinstance(v, float) and math.isnan(v):
        return "null"
    if isinstance(v, bool):
        return str(v)
    if isinstance(v, float):
        return f"{round(v, 5) + 0.0:.5f}"
    return str(v)


def rows_of(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted(tuple(plain(r[i]) for i in order) for r in rows)


def test_entry(spark):
    df = E.entry(spark)
    assert df.columns[0] == "bundle_id" and df.count() > 0


@pytest.mark.parametrize("name", sorted(catalog.ORACLES))
def test_oracle_match(spark, con, name):
    df = catalog.QUERIES[name](spark, SF)
    got = rows_of(df.columns, df.collect())
    res = con.execute(catalog.ORACLES[name])
    cols = [d[0] for d in res.description]
    want = rows_of(cols, res.fetchall())
    assert sorted(df.columns) == sorted(cols)
    assert len(got) == len(want)
    assert got == want


@pytest.mark.parametrize("name", sorted(set(catalog.QUERIES) - set(catalog.ORACLES)))
def test_runs(spark, name):
    assert catalog.QUERIES[name](spark, SF).count() > 0
