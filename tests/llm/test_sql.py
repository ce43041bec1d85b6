"""Registered queries against their SQL, on the small tables."""

import duckdb
import pytest

from knockwork.llm import queries

D = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", list(queries.ORACLE_SQL))
def test_query_equals_its_sql(spark, name):
    con = duckdb.connect()
    for table in ("documents", "benchmark", "pages"):
        con.execute(f"create view {table} as select * from '{D}/{table}.parquet'")
    want = con.sql(queries.ORACLE_SQL[name])
    got = queries.QUERIES[name](spark, D)
    assert sorted(got.columns) == sorted(want.columns)
    columns = sorted(got.columns)
    assert sorted(map(repr, got.select(*columns).toPandas().itertuples(index=False, name=None))) == sorted(map(repr, want.df()[columns].itertuples(index=False, name=None)))
