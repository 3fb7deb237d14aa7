"""Every registered query against its DuckDB oracle at sf 0.001 (the driver
runs the same comparison at sf 0.01)."""

import math
import os

import duckdb
import pytest

import __spark_entry__ as E

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for f in os.listdir(SF):
        if f.endswith(".parquet"):
            c.execute(f"CREATE VIEW {f[:-8]} AS SELECT * FROM read_parquet('{SF}/{f}')")
    return c


def _norm(rows):
    def v(x):
        if isinstance(x, float):
            return round(x, 6) if not math.isnan(x) else "nan"
        return x.item() if hasattr(x, "item") else x
    return sorted((tuple(v(x) for x in r) for r in rows), key=repr)


@pytest.mark.parametrize("name", sorted(E.queries()))
def test_query_matches_oracle(spark, con, name):
    sdf = E.queries()[name](spark, SF).toPandas()
    sql = E.oracle_sql().get(name)
    if sql is None:
        assert len(sdf) > 0
        return
    ddf = con.execute(sql).df()
    cols = sorted(sdf.columns)
    assert cols == sorted(ddf.columns)
    assert _norm(sdf[cols].itertuples(index=False)) == _norm(ddf[cols].itertuples(index=False))


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
