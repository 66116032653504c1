"""Every query of the subpackage that has SQL gives the SQL's rows on the smallest tables."""

import glob
import os

import pytest

from textloom.llm import queries

SF = "/root/testdata/sf0.001"
duckdb = pytest.importorskip("duckdb")


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_sql(spark, name):
    con = duckdb.connect()
    for f in glob.glob(SF + "/*.parquet"):
        con.execute(f"create view {os.path.basename(f)[:-8]} as select * from '{f}'")
    df = queries.QUERIES[name](spark, SF)
    cols = sorted(df.columns)
    got = sorted(repr([r[c] for c in cols]) for r in df.collect())
    rel = con.execute(queries.SQL[name])
    have = [d[0] for d in rel.description]
    assert sorted(have) == cols
    assert got == sorted(repr([r[have.index(c)] for c in cols]) for r in rel.fetchall())
