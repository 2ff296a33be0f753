"""Queries with a DuckDB form against it, on the smallest tables."""

import duckdb
import pandas as pd
import pytest

from skyroute.llm import queries
from tests.llm.conftest import SF

DUCK_TYPE = {"int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN"}


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in ("documents", "benchmark", "pages", "conversations"):
        con.execute(f"create view {t} as select * from read_parquet('{SF}/{t}.parquet')")
    return con


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_query_matches_sql(spark, duck, name):
    df = queries.QUERIES[name](spark, SF)
    rel = duck.sql(queries.ORACLE_SQL[name])
    assert {c: DUCK_TYPE[t] for c, t in df.dtypes} == dict(zip(rel.columns, map(str, rel.types), strict=True))
    got, want = df.toPandas(), rel.df()
    cols = sorted(want.columns)
    assert sorted(got.columns) == cols and len(got) == len(want) > 0
    got, want = (x[cols].sort_values(cols).reset_index(drop=True) for x in (got, want))
    pd.testing.assert_frame_equal(got, want, check_exact=False, rtol=1e-7, check_dtype=False)
