"""Every query with SQL gives the SQL's rows on the smallest tables."""

import glob
import math
import os

import pytest

import __spark_entry__ as entry

SF = "/root/testdata/sf0.001"
duckdb = pytest.importorskip("duckdb")


def norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else round(v, 6)
    if isinstance(v, (list, tuple)):
        return [norm(x) for x in v]
    return v


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for f in glob.glob(SF + "/*.parquet"):
        c.execute(f"create view {os.path.basename(f)[:-8]} as select * from '{f}'")
    return c


def names():
    from textloom.plans import registry

    return sorted(registry.QUERIES)


def test_entry_has_rows(spark):
    assert entry.entry(spark).count() > 0


def test_sql_belongs_to_queries():
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", names())
def test_query(spark, con, name):
    df = entry.queries()[name](spark, SF)
    cols = sorted(df.columns)
    got = sorted(repr([norm(r[c]) for c in cols]) for r in df.collect())
    sql = entry.oracle_sql().get(name)
    if sql is None:
        return
    rel = con.execute(sql)
    have = [d[0] for d in rel.description]
    assert sorted(have) == cols
    want = sorted(repr([norm(r[have.index(c)]) for c in cols]) for r in rel.fetchall())
    assert got == want
