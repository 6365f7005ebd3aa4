"""Every registered query runs at the smallest scale, and equals its SQL twin where it has one."""

import duckdb
import pytest

import __spark_entry__ as entry_module
from tools.check import TABLES, norm

SF = "/root/testdata/sf0.001"
QUERIES, ORACLES = entry_module.queries(), entry_module.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return con


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(QUERIES) and len(QUERIES) > 110


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, duck, name):
    df = QUERIES[name](spark, SF)
    cols = sorted(df.columns)
    got = sorted((tuple(norm(v) for v in r) for r in df.select(*cols).collect()), key=repr)
    cur = duck.execute(ORACLES[name])
    names = [d[0] for d in cur.description]
    assert sorted(names) == cols
    order = sorted(range(len(names)), key=lambda i: names[i])
    want = sorted((tuple(norm(r[i]) for i in order) for r in cur.fetchall()), key=repr)
    assert got == want


def test_entry(spark):
    assert entry_module.entry(spark).count() == 100
