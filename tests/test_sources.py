import datetime as dt
import os
import tempfile

import pytest
from pyspark.sql import functions as F

from tidecopy.operators import mapped_columns
from tidecopy.sources import (
    JdbcTable, append_jdbc, catalog_from_frames, chunked_load, jdbc_scan, load_tsv, run_sql, write_tsv,
)

DERBY = {"driver": "org.apache.derby.iapi.jdbc.AutoloadedDriver"}


def derby(name):
    return f"jdbc:derby:memory:test_{name};create=true"


def test_tsv_round_trip_keeps_escapes_nulls_and_empty(spark):
    df = spark.createDataFrame([(1, "tab\there", "line\nbreak"), (2, "", None), (3, "back\\slash\\t", "\\N")],
                               "id long, a string, b string")
    path = os.path.join(tempfile.mkdtemp(prefix="run-", dir="/tmp"), "t")
    write_tsv(df, path)
    raw = sorted(r.value for r in spark.read.text(path).collect())
    assert raw[1] == "2\t\t\\N"
    back = load_tsv(spark, path, "id long, a string, b string")
    assert sorted(back.collect()) == sorted(df.collect())


def test_tsv_wrong_field_count_fails(spark):
    path = os.path.join(tempfile.mkdtemp(prefix="run-", dir="/tmp"), "bad")
    spark.createDataFrame([("1\tx",), ("2",)], "value string").write.text(path)
    with pytest.raises(Exception, match="field count"):
        load_tsv(spark, path, "id long, a string").collect()


@pytest.fixture
def derby_orders(spark, sf_small):
    orders = spark.read.parquet(f"{sf_small}/orders.parquet")
    src = JdbcTable(derby("orders"), "APP.ORDERS", DERBY)
    (orders.write.format("jdbc").options(**src.options()).option("dbtable", src.table)
     .option("createTableColumnTypes", "o_orderstatus VARCHAR(8), o_orderpriority VARCHAR(32)")
     .mode("overwrite").save())
    return orders, src


def test_jdbc_scan_pushes_filter_and_prunes(spark, derby_orders):
    orders, src = derby_orders
    pred = F.col("o_orderdate") >= F.lit("1999-01-01").cast("timestamp_ntz")
    df = jdbc_scan(spark, src, columns=["o_orderkey", "o_orderdate"], predicate=pred)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [*IsNotNull(o_orderdate), *GreaterThanOrEqual(o_orderdate" in plan
    assert df.schema["o_orderdate"].dataType.simpleString() == "timestamp_ntz"
    assert df.count() == orders.where(pred).count()


def test_chunked_jdbc_load_one_partition_per_chunk(spark, derby_orders):
    orders, src = derby_orders
    cols = mapped_columns(catalog_from_frames(spark, {"orders": orders}, table_schema="shop"))
    from tidecopy.sources.target import chunk_predicates, source_frame
    from tidecopy.operators import chunk_list

    bounds = chunk_list(spark, 1999, "AS", dt.datetime(2001, 8, 2))
    preds = chunk_predicates(src, "o_orderdate", bounds)
    assert preds[0] == "\"o_orderdate\" >= TIMESTAMP('1999-01-01 00:00:00') AND \"o_orderdate\" < TIMESTAMP('2000-01-01 00:00:00')"
    frame = source_frame(spark, src, cols, predicates=preds)
    assert frame.rdd.getNumPartitions() == len(bounds) == 3
    report = chunked_load(spark, src, cols, "chk.orders_jdbc", column="o_orderdate", freq="AS",
                          start_year=1999, until=dt.datetime(2001, 8, 2))
    expect = orders.where("o_orderdate >= '1999-01-01'").groupBy(F.date_trunc("YEAR", "o_orderdate")).count()
    rows = report.collect()
    assert sorted((r[0], r[1]) for r in rows if r["loaded"]) == sorted((r[0], r[1]) for r in expect.collect())
    assert [r["n"] for r in rows if not r["loaded"]] == [orders.where("o_orderdate < '1999-01-01'").count()]


def test_include_rest_loads_early_rows(spark, sf_small):
    orders = spark.read.parquet(f"{sf_small}/orders.parquet")
    cols = mapped_columns(catalog_from_frames(spark, {"orders": orders}, table_schema="shop"))
    report = chunked_load(spark, orders, cols, "chk.orders_rest", column="o_orderdate", freq="AS",
                          start_year=2000, until=dt.datetime(2001, 8, 2), include_rest=True)
    got = {r["chunk_lo"]: r["n"] for r in report.collect()}
    assert sum(got.values()) == orders.count()
    assert got[None] == orders.where("o_orderdate < '2000-01-01'").count()


def test_append_jdbc_nan_to_null_and_columns(spark):
    dest = JdbcTable(derby("append"), "APP.T", DERBY)
    spark.createDataFrame([], "id long, v double").write.format("jdbc").options(**dest.options()) \
        .option("dbtable", dest.table).mode("overwrite").save()
    df = spark.createDataFrame([(1, float("nan")), (2, 2.5)], "a long, b double")
    append_jdbc(df, dest, columns=["id", "v"], commit_every=0)
    assert sorted(tuple(r) for r in jdbc_scan(spark, dest).collect()) == [(1, None), (2, 2.5)]
    with pytest.raises(ValueError):
        append_jdbc(df, dest, columns=["id"])


def test_run_sql_binds_parameters(spark):
    spark.range(10).createOrReplaceTempView("ten")
    df = run_sql(spark, ["SELECT 1", "SELECT count(*) AS n FROM IDENTIFIER(:t) WHERE id >= :k"],
                 {"t": "ten", "k": 7})
    assert df.first()["n"] == 3
    # a value is never spliced into the text
    assert run_sql(spark, "SELECT :s AS s", {"s": "x' OR '1'='1"}).first()["s"] == "x' OR '1'='1"


def test_chunks_split_into_key_strides(spark, derby_orders):
    from tidecopy.operators import chunk_list
    from tidecopy.sources.target import chunk_key_ranges, chunk_predicates, source_frame

    orders, src = derby_orders
    cols = mapped_columns(catalog_from_frames(spark, {"orders": orders}, table_schema="shop"))
    bounds = chunk_list(spark, 1999, "AS", dt.datetime(2001, 8, 2))
    ranges = chunk_key_ranges(spark, src, "o_orderdate", "o_orderkey", bounds)
    assert len(ranges) == 3 and all(r[0] <= r[1] for r in ranges)
    preds = chunk_predicates(src, "o_orderdate", bounds, key="o_orderkey", key_ranges=ranges, key_splits=4)
    assert len(preds) == 12
    frame = source_frame(spark, src, cols, predicates=preds)
    assert frame.rdd.getNumPartitions() == 12
    expect = orders.where("o_orderdate >= '1999-01-01'").select("o_orderkey")
    got = frame.select("o_orderkey")
    assert got.count() == expect.count() and got.exceptAll(expect).count() == 0
    report = chunked_load(spark, src, cols, "chk.orders_split", column="o_orderdate", freq="AS",
                          start_year=1999, until=dt.datetime(2001, 8, 2), key="o_orderkey", key_splits=4)
    assert sum(r["n"] for r in report.collect() if r["loaded"]) == expect.count()


def test_jdbc_catalog_reads_information_schema(spark):
    from tidecopy.operators import mapped_columns
    from tidecopy.sources import column_catalog, jdbc_catalog
    from tidecopy.sources.catalog import CATALOG_SCHEMA, TABLES_SCHEMA

    url = derby("catalog")
    cols = spark.createDataFrame([
        ("def", "shopdb", "users", "id", 1, "bigint", "bigint unsigned", None, 20, 0),
        ("def", "shopdb", "users", "name", 2, "varchar", "varchar(64)", 64, None, None),
        ("def", "shopdb", "users_v", "id", 1, "bigint", "bigint", None, 19, 0),
        ("def", "other", "t", "x", 1, "int", "int", None, 10, 0),
    ], CATALOG_SCHEMA)
    tabs = spark.createDataFrame([("def", "shopdb", "users", "BASE TABLE"), ("def", "shopdb", "users_v", "VIEW"),
                                  ("def", "other", "t", "BASE TABLE")], TABLES_SCHEMA)
    for df, name in ((cols, "information_schema.columns"), (tabs, "information_schema.tables")):
        # the source server keeps these as varchar (Derby's default for strings, CLOB, is not comparable)
        text_cols = ", ".join(f"{f.name} VARCHAR(64)" for f in df.schema.fields if f.dataType.simpleString() == "string")
        (df.write.format("jdbc").options(url=url, dbtable=name, **DERBY)
         .option("createTableColumnTypes", text_cols).mode("overwrite").save())
    columns, tables = jdbc_catalog(spark, url, DERBY, schema="shopdb")
    assert columns.schema == CATALOG_SCHEMA
    assert columns.count() == 3 and tables.count() == 2
    users = column_catalog(columns, tables, "shopdb", "users")
    mapped = mapped_columns(users)
    assert [(c.target_name, c.spark_type) for c in mapped] == [("ID", "decimal(20,0)"), ("NAME", "string")]


from hypothesis import HealthCheck, given, settings  # noqa: E402
from hypothesis import strategies as st  # noqa: E402

_TRICKY = st.text(alphabet=st.sampled_from(list("ab\\\t\n\r\x00Nt0é￿ ")), max_size=12)


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.one_of(st.none(), _TRICKY, st.text(max_size=8)), min_size=1, max_size=25))
def test_tsv_round_trip_any_text(spark, values):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "id long, s string")
    path = os.path.join(tempfile.mkdtemp(prefix="run-", dir="/tmp"), "t")
    write_tsv(df, path)
    back = load_tsv(spark, path, "id long, s string")
    assert sorted(back.collect()) == sorted(df.collect())


def test_tsv_one_column_keeps_empty_lines_and_fills_a_table(spark, tmp_path):
    from tidecopy.sources import load_tsv, write_tsv
    df = spark.createDataFrame([("a",), ("",), ("b",), (None,)], "v string").coalesce(1)
    write_tsv(df, f"{tmp_path}/x")
    assert [r.v for r in load_tsv(spark, f"{tmp_path}/x", df.schema).collect()] == ["a", "", "b", None]
    spark.sql("DROP TABLE IF EXISTS rep.tsv_in")
    load_tsv(spark, f"{tmp_path}/x", df.schema, "rep.tsv_in")
    assert load_tsv(spark, f"{tmp_path}/x", df.schema, "rep.tsv_in").count() == 8
