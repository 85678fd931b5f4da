import pytest
from pyspark.sql import functions as F

from tidecopy.sources import append_target, drop_target, ensure_table, target_exists, write_swap
from pyspark.sql import types as T


def test_ensure_then_drop(spark):
    st = T.StructType([T.StructField("ID", T.DecimalType(20, 0)), T.StructField("NAME", T.StringType())])
    drop_target(spark, "tgt.ensure_t")
    assert ensure_table(spark, "tgt.ensure_t", st) is True
    assert ensure_table(spark, "tgt.ensure_t", st) is False
    assert spark.table("tgt.ensure_t").count() == 0
    assert spark.table("tgt.ensure_t").schema == st
    assert drop_target(spark, "tgt.ensure_t") is True
    assert not target_exists(spark, "tgt.ensure_t")
    assert drop_target(spark, "tgt.ensure_t") is False


def test_swap_replaces(spark):
    write_swap(spark.range(3).toDF("ID"), "tgt.swap_t")
    write_swap(spark.range(5).toDF("ID"), "tgt.swap_t")
    assert spark.table("tgt.swap_t").count() == 5
    write_swap(spark.range(2).selectExpr("cast(id AS string) AS NAME"), "tgt.swap_t")      # other columns
    assert sorted(tuple(r) for r in spark.table("tgt.swap_t").collect()) == [("0",), ("1",)]


def test_failed_write_keeps_old_rows(spark):
    write_swap(spark.range(4).toDF("ID"), "tgt.keep_t")
    bad = spark.range(3).select(F.when(F.col("id") == 2, F.raise_error(F.lit("boom"))).otherwise(F.col("id")).alias("ID"))
    with pytest.raises(Exception):
        write_swap(bad, "tgt.keep_t")
    assert spark.table("tgt.keep_t").count() == 4


def test_append_target_by_name_and_position(spark):
    write_swap(spark.createDataFrame([(1, "a", 1.0)], "ID long, NAME string, SCORE double"), "tgt.app_t")
    append_target(spark.createDataFrame([("b", 2)], "name string, id long"), "tgt.app_t")
    append_target(spark.createDataFrame([(3, "c")], "x long, y string"), "tgt.app_t", columns=["ID", "NAME"])
    rows = sorted(tuple(r) for r in spark.table("tgt.app_t").collect())
    assert rows == [(1, "a", 1.0), (2, "b", None), (3, "c", None)]
    with pytest.raises(ValueError):
        append_target(spark.createDataFrame([(1,)], "nope long"), "tgt.app_t")


# ------------------------------------------------- partitioned targets

PART = {"P": "CASE WHEN ID < 10 THEN NULL WHEN ID < 20 THEN '' ELSE cast(ID div 10 AS string) END"}


def _partitioned(spark, name, n=100):
    from tidecopy.sources import with_partitions
    drop_target(spark, name)
    df = spark.range(n).select(F.col("id").alias("ID"), F.lit("old").alias("V"))
    write_swap(with_partitions(df, PART), name, partition_by=["P"])


@pytest.mark.parametrize("ids", [[55], [3], [15], [3, 15, 55, 200]])
def test_partitioned_merge_keeps_untouched_partitions(spark, ids):
    """A session with Spark's defaults (static overwrite): a partition that the delta
    doesn't touch keeps its rows; NULL and '' partitions are found."""
    from tidecopy.sources import merge_into_target
    assert spark.conf.get("spark.sql.sources.partitionOverwriteMode").lower() == "static"
    name = f"tgt.parts_{len(ids)}_{ids[0]}"
    _partitioned(spark, name)
    delta = spark.createDataFrame([(i, "new") for i in ids], "ID long, V string")
    out = merge_into_target(spark, name, delta, ["ID"], partition_by=PART)
    assert out["rows"] == len(ids) and out["written"]
    got = {r.ID: r.V for r in spark.table(name).collect()}
    assert spark.table(name).count() == len(got)
    assert got == {i: "new" if i in ids else "old" for i in {*range(100), *ids}}
    assert spark.conf.get("spark.sql.sources.partitionOverwriteMode").lower() == "static"


def test_append_to_a_partitioned_target_then_merge(spark):
    from tidecopy.sources import merge_into_target
    _partitioned(spark, "tgt.parts_app")
    more = spark.createDataFrame([(i, "app") for i in range(100, 106)], "ID long, V string")
    with pytest.raises(ValueError, match="partitioned by"):
        append_target(more, "tgt.parts_app")
    append_target(more, "tgt.parts_app", partition_by=PART)
    merge_into_target(spark, "tgt.parts_app", spark.createDataFrame([(103, "new")], "ID long, V string"), ["ID"], partition_by=PART)
    got = [(r.ID, r.V) for r in spark.table("tgt.parts_app").where("ID >= 100").collect()]
    assert sorted(got) == [(i, "new" if i == 103 else "app") for i in range(100, 106)]
    assert spark.table("tgt.parts_app").count() == 106


# ------------------------------------------------- what a JDBC source is asked for (no database)

def test_replaced_columns_leave_the_source_replaced(spark, monkeypatch):
    from tidecopy.operators import mapped_columns
    from tidecopy.session import local_frame
    from tidecopy.sources import CATALOG_SCHEMA, JdbcTable
    from tidecopy.sources import target as module
    rows = [("def", "s", "t", "id", 1, "bigint", "bigint", None, 19, 0), ("def", "s", "t", "mail", 2, "varchar", "varchar(9)", 9, None, None),
            ("def", "s", "t", "raw", 3, "binary", "binary(4)", 4, None, None)]
    cols = mapped_columns(local_frame(spark, rows, CATALOG_SCHEMA))
    asked = []
    monkeypatch.setattr(module, "jdbc_scan", lambda spark, source, **kw: asked.append(kw))
    module.source_frame(spark, JdbcTable("jdbc:mysql://h/d", "s.t"), cols, replace={"mail": "md5(upper(1))"}, where="`id` >= 5",
                        partition_column="id", num_partitions=4)
    module.source_frame(spark, JdbcTable("jdbc:postgresql://h/d", "s.t"), cols, replace={"MAIL": "md5('x')"})
    module.source_frame(spark, JdbcTable("jdbc:postgresql://h/d", "s.t"), cols)
    assert asked[0]["query"] == ("select `id` AS `id`, md5(upper(1)) AS `mail`, cast(`raw` as char(4)) AS `raw` from s.t where `id` >= 5")
    assert (asked[0]["partition_column"], asked[0]["num_partitions"]) == ("id", 4)
    assert asked[1]["query"] == """select "id" AS "id", md5('x') AS "mail", "raw" AS "raw" from s.t"""
    assert "query" not in asked[2]
    with pytest.raises(ValueError, match="unknown columns"):
        module.source_frame(spark, JdbcTable("jdbc:mysql://h/d", "s.t"), cols, replace={"nope": "1"})


def test_whole_loads_of_a_jdbc_source_are_split_by_key(spark, monkeypatch):
    from tidecopy.sources import JdbcTable, full_load, truncate_load
    from tidecopy.sources import target as module
    asked = []

    def scan(spark, source, **kw):
        asked.append((kw["partition_column"], kw["num_partitions"]))
        return spark.range(3).toDF("id")

    monkeypatch.setattr(module, "jdbc_scan", scan)
    from tidecopy.operators import mapped_columns
    from tidecopy.session import local_frame
    from tidecopy.sources import CATALOG_SCHEMA
    cols = mapped_columns(local_frame(spark, [("def", "s", "t", "id", 1, "bigint", "bigint", None, 19, 0)], CATALOG_SCHEMA))
    src = JdbcTable("jdbc:postgresql://h/d", "s.t")
    full_load(spark, src, cols, "tgt.jdbc_full", key="id", key_splits=6)
    truncate_load(spark, src, cols, "tgt.jdbc_full", key="id", key_splits=6)
    assert asked == [("id", 6)] * 2


def test_only_keys_with_strides_are_split():
    import datetime as dt
    from decimal import Decimal

    from tidecopy.sources.jdbc import strided
    assert all(map(strided, (1, 2.5, Decimal(3), dt.date(2020, 1, 1), dt.datetime(2020, 1, 1))))
    assert not any(map(strided, ("a", None, True, b"x")))


def test_stored_key_maximum_has_the_keys_type(spark):
    from decimal import Decimal

    from tidecopy.operators.incremental import watermark_sql
    from tidecopy.plans.replicate import _typed_key
    from tidecopy.sources import JdbcTable
    src = JdbcTable("jdbc:postgresql://h/d", "s.t")
    km = _typed_key("45", T.DecimalType(20, 0))
    assert km == Decimal(45) and _typed_key("45", T.LongType()) == 45 and _typed_key("45", T.StringType()) == "45"
    assert watermark_sql(src.quote, src.literal, {"id": "int"}, None, km) == '"id" >= 45'
