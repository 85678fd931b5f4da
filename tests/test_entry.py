"""Every registered query against its DuckDB oracle (sf0.001)."""

import math
from decimal import Decimal

import duckdb
import pytest

import __spark_entry__ as E

SF = "/root/testdata/sf0.001"


def norm(v):
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 6)
    if isinstance(v, Decimal):
        return float(v)
    return v


def canon(rows):
    return sorted((tuple(norm(v) for v in r) for r in rows), key=lambda r: tuple((v is None, str(v)) for v in r))


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in E.TABLES:
        c.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


def test_every_query_has_an_oracle():
    assert set(E._QUERIES) <= set(E.oracle_sql()) <= set(E.queries())


@pytest.mark.parametrize("name", sorted(E.oracle_sql()))
def test_query_matches_oracle(spark, con, name):
    df = E.queries()[name](spark, SF)
    rel = con.sql(E.oracle_sql()[name])
    assert sorted(df.columns) == sorted(rel.columns)
    order = [rel.columns.index(c) for c in df.columns]
    expect = [tuple(r[i] for i in order) for r in rel.fetchall()]
    assert canon(df.collect()) == canon(expect)


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.columns == ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate",
                          "o_orderpriority"]
    assert df.count() > 0
