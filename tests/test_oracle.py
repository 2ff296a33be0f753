"""Every registered query against its DuckDB oracle on the smallest tables."""

import duckdb
import pytest

import __spark_entry__ as E
from skyroute.plans import catalog
from tools.oracle_check import TABLES, frame_hash
from tests.conftest import SF_SMALL

# queries of the library itself; those of the optional subpackage have their own tests
SQL = {k: v for k, v in E.oracle_sql().items() if k in catalog.QUERIES}
DUCK_TYPE = {"int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR",
             "date": "DATE", "timestamp_ntz": "TIMESTAMP", "boolean": "BOOLEAN"}


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from read_parquet('{SF_SMALL}/{t}.parquet')")
    return con


def test_every_query_has_an_oracle():
    assert set(catalog.QUERIES) == set(SQL)


@pytest.mark.parametrize("name", sorted(catalog.QUERIES))
def test_query_matches_oracle(spark, duck, name):
    df = E.queries()[name](spark, SF_SMALL)
    got = [tuple(r) for r in df.collect()]
    rel = duck.sql(SQL[name])
    types = dict(zip(rel.columns, [str(t) for t in rel.types]))
    assert {c: DUCK_TYPE.get(t, t) for c, t in df.dtypes} == types
    cur = duck.execute(SQL[name])
    ocols = [d[0] for d in cur.description]
    want = cur.fetchall()
    assert sorted(df.columns) == sorted(ocols)
    assert len(got) == len(want)
    assert frame_hash(df.columns, got) == frame_hash(ocols, want)


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns == ["airport", "count", "rank"]
    assert 0 < df.count() <= 10
