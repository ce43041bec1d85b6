"""Every registered query that has SQL, against DuckDB on the smallest tables."""

import math
import os
from decimal import Decimal

import duckdb
import pytest

import __spark_entry__ as entry
from knockwork.plans import queries as plans

D = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for f in os.listdir(D):
        con.execute(f"create view {f.split('.')[0]} as select * from '{D}/{f}'")
    return con


def plain(v):
    if isinstance(v, Decimal):
        v = float(v)
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 5) + 0.0
    return v


@pytest.mark.parametrize("name", sorted(plans.ORACLE_SQL))
def test_query_equals_sql(spark, duck, name):
    df = plans.QUERIES[name](spark, D)
    cursor = duck.execute(plans.ORACLE_SQL[name])
    columns = [c[0] for c in cursor.description]
    assert sorted(columns) == sorted(df.columns)
    order = sorted(columns)
    want = sorted((tuple(plain(r[columns.index(c)]) for c in order) for r in cursor.fetchall()), key=str)
    got = sorted((tuple(plain(r[c]) for c in order) for r in df.collect()), key=str)
    assert got == want


def test_entry_has_rows(spark):
    assert entry.entry(spark).count() > 0


def test_every_query_is_registered():
    assert set(plans.QUERIES) <= set(entry.queries())
    assert set(plans.ORACLE_SQL) <= set(entry.oracle_sql())


def test_routing_holds_the_whole_de_set(spark):
    routed = {r.gene_id for r in plans.QUERIES["loo_routing_de_set"](spark, D).collect()}
    passing = {r.gene_id for r in plans.QUERIES["de_gene_set"](spark, D).collect()}
    assert passing <= routed and any(g % 2 == 0 for g in passing)
