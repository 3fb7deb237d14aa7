import duckdb
import pytest
from helpers import SF

from corpusloom.llm import queries as Q


def test_names():
    assert [n.split("_")[0] for n in Q.QUERIES] == [f"op{i}" for i in range(1, 14)] or \
        {n.split("_")[0] for n in Q.QUERIES} == {f"op{i}" for i in range(1, 14)}


@pytest.mark.parametrize("name", [n for n, (_, sql) in Q.QUERIES.items() if sql])
def test_oracle(spark, name):
    fn, sql = Q.QUERIES[name]
    con = duckdb.connect()
    for t in ("documents", "labels"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    got = fn(spark, SF)
    want = con.execute(sql)
    names = [c[0] for c in want.description]
    assert sorted(map(tuple, got.select(*names).collect())) == sorted(map(tuple, want.fetchall()))
