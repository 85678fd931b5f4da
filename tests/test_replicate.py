import datetime as dt

from pyspark.sql import functions as F

from tidecopy import ChunkSpec, TableSpec
from tidecopy.plans import replicate_all, replicate_table

D = dt.datetime
SCHEMA = "id long, created_at timestamp_ntz, updated_at timestamp_ntz, name string"


def spec(**kw):
    base = dict(load_type="merge", source_schema="shopdb", source_table_name="users", target_schema="rep",
                target_table_name="users", source_main_fields=["id"], target_main_fields=["ID"],
                source_merge_columns={"updated_at": "datetime", "created_at": "datetime", "id": "int"},
                source_freq=ChunkSpec("created_at", "MS", 2021))
    base.update(kw)
    return TableSpec(**base)


def test_first_load_then_merge(spark):
    spark.sql("DROP TABLE IF EXISTS rep.users")
    v1 = spark.createDataFrame([(1, D(2021, 1, 5), D(2021, 1, 5), "a"), (2, D(2021, 2, 5), D(2021, 2, 5), "b")], SCHEMA)
    st = replicate_table(spark, spec(), v1, run_date="2021-03-01", now=D(2021, 3, 1, 12))
    assert (st["path"], st["created"], st["rows_written"], st["ok"]) == ("first_load", True, 2, True)
    assert spark.table("rep.users").columns == ["ID", "CREATED_AT", "UPDATED_AT", "NAME"]
    v2 = spark.createDataFrame([(1, D(2021, 1, 5), D(2021, 3, 2), "a2"), (2, D(2021, 2, 5), D(2021, 2, 5), "b"),
                                (3, D(2021, 3, 2), D(2021, 3, 2), "c")], SCHEMA)
    st = replicate_table(spark, spec(), v2, run_date="2021-03-03", now=D(2021, 3, 3, 12))
    assert (st["path"], st["rows_written"], st["check_rule"], st["ok"]) == ("merge", 3, "cutoff", True)
    got = sorted((int(r["ID"]), r["NAME"]) for r in spark.table("rep.users").collect())
    assert got == [(1, "a2"), (2, "b"), (3, "c")]
    # the merge recorded the key maximum; the next run reads it instead of scanning
    from tidecopy.sources.target import append_target, stored_key_max

    assert stored_key_max(spark, "rep.users", "ID") == "3"
    v3 = v2.union(spark.createDataFrame([(9, D(2021, 1, 1), D(2021, 1, 1), "old-ts-high-id")], SCHEMA))
    st = replicate_table(spark, spec(), v3, run_date="2021-03-04", now=D(2021, 3, 4, 12))
    assert st["rows_read"] == 3  # ids 1, 3 (updated since 03-01) and 9 (id >= stored max 3)
    assert stored_key_max(spark, "rep.users", "ID") == "9"
    append_target(spark.createDataFrame([(20, "x")], "id long, name string"), "rep.users")
    assert stored_key_max(spark, "rep.users", "ID") is None


def test_replace_fields_on_both_paths(spark):
    spark.sql("DROP TABLE IF EXISTS rep.users_masked")
    s = spec(target_table_name="users_masked", replace_fields_to={"name": "upper(name)"})
    v1 = spark.createDataFrame([(1, D(2021, 1, 5), D(2021, 1, 5), "a")], SCHEMA)
    replicate_table(spark, s, v1, run_date="2021-03-01", now=D(2021, 3, 1, 12))
    v2 = v1.union(spark.createDataFrame([(2, D(2021, 3, 2), D(2021, 3, 2), "b")], SCHEMA))
    replicate_table(spark, s, v2, run_date="2021-03-03", now=D(2021, 3, 3, 12))
    assert sorted(r["NAME"] for r in spark.table("rep.users_masked").collect()) == ["A", "B"]


def test_replicate_all_reports_failures(spark, sf_small):
    nation = spark.read.parquet(f"{sf_small}/nation.parquet")
    good = TableSpec(load_type="truncate", source_schema="s", source_table_name="nation", target_schema="rep",
                     target_table_name="nation_all", source_main_fields=["n_nationkey"],
                     target_main_fields=["N_NATIONKEY"])
    bad = spec(target_table_name="users_bad")
    broken = spark.createDataFrame([(1, "x")], "id long, name string")  # no chunk column
    spark.sql("DROP TABLE IF EXISTS rep.users_bad")
    status = {r["table_name"]: r for r in replicate_all(spark, [(good, nation), (bad, broken)], run_date="2021-03-01",
                                                          now=D(2021, 3, 1)).collect()}
    assert status["rep.nation_all"]["ok"] is True and status["rep.nation_all"]["rows_written"] == 25
    assert status["rep.users_bad"]["ok"] is False and status["rep.users_bad"]["error"]


def test_jdbc_source_first_load_then_merge(spark):
    from tidecopy.sources import JdbcTable, catalog_from_frames, jdbc_scan, tables_from_frames
    from tidecopy.sources.jdbc import jdbc_count, key_range

    src = JdbcTable("jdbc:derby:memory:test_rep_users;create=true", "APP.USERS",
                    {"driver": "org.apache.derby.iapi.jdbc.AutoloadedDriver"})
    v1 = spark.createDataFrame([(i, D(2021, 1 + i % 2, 5), D(2021, 1 + i % 2, 5), f"n{i}") for i in range(1, 41)],
                               SCHEMA)
    (v1.write.format("jdbc").options(**src.options()).option("dbtable", src.table)
     .option("createTableColumnTypes", "name VARCHAR(32)").mode("overwrite").save())
    frame = jdbc_scan(spark, src)
    cat = catalog_from_frames(spark, {"users": frame}, table_schema="shopdb")
    tabs = tables_from_frames(spark, {"users": frame}, table_schema="shopdb")
    s = spec(target_table_name="users_jdbc", source_partitions=3)
    spark.sql("DROP TABLE IF EXISTS rep.users_jdbc")
    st = replicate_table(spark, s, src, run_date="2021-03-01", now=D(2021, 3, 1, 12), catalog=cat, tables=tabs)
    assert (st["path"], st["rows_written"]) == ("first_load", 40)
    assert jdbc_count(spark, src).first()["n"] == 40
    assert key_range(spark, src, "id", "\"id\" >= 30") == (30, 40)
    # the source changes: row 3 updated, rows 41..45 new
    v2 = (v1.where("id <> 3")
          .union(spark.createDataFrame([(3, D(2021, 1, 5), D(2021, 3, 2), "changed")], SCHEMA))
          .union(spark.createDataFrame([(i, D(2021, 3, 2), D(2021, 3, 2), f"n{i}") for i in range(41, 46)], SCHEMA)))
    (v2.write.format("jdbc").options(**src.options()).option("dbtable", src.table)
     .option("truncate", "true").mode("overwrite").save())
    st = replicate_table(spark, s, src, run_date="2021-03-03", now=D(2021, 3, 3, 12), catalog=cat, tables=tabs)
    assert (st["path"], st["rows_written"], st["source_n"], st["target_n"], st["ok"]) == ("merge", 7, 45, 45, True)
    got = {int(r["ID"]): r["NAME"] for r in spark.table("rep.users_jdbc").collect()}
    assert got[3] == "changed" and got[45] == "n45" and len(got) == 45


def _files(spark, table):
    """Files the table's rows are read from (partition folder and name) and when they were written."""
    import os

    files = [f.removeprefix("file://") for f in spark.table(table).inputFiles()]
    return {"/".join(f.split("/")[-2:]).replace("%3D", "="): os.path.getmtime(f) for f in files}


def test_partitioned_merge_rewrites_only_touched_partitions(spark, sf_small):
    orders = spark.read.parquet(f"{sf_small}/orders.parquet")
    parts = {"O_RANGE": "cast(O_ORDERKEY div 100 AS bigint)"}
    s = TableSpec(load_type="merge", source_schema="shop", source_table_name="orders", target_schema="rep",
                  target_table_name="orders_parts", source_main_fields=["o_orderkey"],
                  target_main_fields=["O_ORDERKEY"], source_merge_columns={"o_orderdate": "datetime"},
                  partition_by=parts)
    plain = TableSpec(**{**s.__dict__, "target_table_name": "orders_plain", "partition_by": {}})
    for t in ("orders_parts", "orders_plain"):
        spark.sql(f"DROP TABLE IF EXISTS rep.{t}")
    old = orders.where("o_orderkey < 1400")
    replicate_table(spark, s, old, run_date="2001-07-01", now=D(2001, 8, 2))
    replicate_table(spark, plain, old, run_date="2001-07-01", now=D(2001, 8, 2))
    assert spark.table("rep.orders_parts").columns[-1] == "O_RANGE"
    before = _files(spark, "rep.orders_parts")
    # new source: keys 1300..1499 changed or new (only ranges 13 and 14)
    changed = orders.withColumn("o_orderdate", F.when(F.col("o_orderkey") >= 1300, F.lit(D(2001, 7, 1)))
                                .otherwise(F.least("o_orderdate", F.lit(D(2000, 1, 1)))))
    for spec_ in (s, plain):
        st = replicate_table(spark, spec_, changed, run_date="2001-07-02", now=D(2001, 8, 2))
        assert st["path"] == "merge"
    a = spark.table("rep.orders_parts").drop("O_RANGE")
    b = spark.table("rep.orders_plain")
    assert a.count() == b.count() == orders.count()
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0
    after = _files(spark, "rep.orders_parts")
    untouched = {k: v for k, v in before.items() if not k.startswith(("O_RANGE=13/", "O_RANGE=14/"))}
    assert untouched and all(after.get(k) == v for k, v in untouched.items())
    assert any(k.startswith("O_RANGE=14/") for k in after)


def test_chunked_load_equals_full_load_when_start_precedes_rows(spark, sf_small):
    from tidecopy.operators import mapped_columns
    from tidecopy.sources import catalog_from_frames, chunked_load, full_load

    events = spark.read.parquet(f"{sf_small}/events.parquet")
    cols = mapped_columns(catalog_from_frames(spark, {"events": events}, table_schema="shop"))
    full = full_load(spark, events, cols, "rep.events_full")
    chunked_load(spark, events, cols, "rep.events_chunked", column="ts", freq="D", start_year=2023,
                 until=D(2024, 2, 1))
    chunked = spark.table("rep.events_chunked")
    assert full.count() == chunked.count() == events.count()
    assert full.exceptAll(chunked).count() == 0


def test_bucketed_target_merge_shuffles_only_the_delta(spark, sf_small):
    import glob

    from tidecopy.operators import merge_upsert

    orders = spark.read.parquet(f"{sf_small}/orders.parquet")
    base = dict(load_type="merge", source_schema="shop", source_table_name="orders", target_schema="rep",
                source_main_fields=["o_orderkey"], target_main_fields=["O_ORDERKEY"],
                source_merge_columns={"o_orderdate": "datetime"})
    bucketed = TableSpec(target_table_name="orders_bucketed", bucket_count=4, **base)
    plain = TableSpec(target_table_name="orders_unbucketed", **base)
    for t in ("orders_bucketed", "orders_unbucketed"):
        spark.sql(f"DROP TABLE IF EXISTS rep.{t}")
    old = orders.where("o_orderkey < 1400")
    changed = orders.withColumn("o_orderdate", F.when(F.col("o_orderkey") >= 1300, F.lit(D(2001, 7, 1)))
                                .otherwise(F.least("o_orderdate", F.lit(D(2000, 1, 1)))))
    for s in (bucketed, plain):
        replicate_table(spark, s, old, run_date="2001-07-01", now=D(2001, 8, 2))
        assert replicate_table(spark, s, changed, run_date="2001-07-02", now=D(2001, 8, 2))["path"] == "merge"
    a, b = spark.table("rep.orders_bucketed"), spark.table("rep.orders_unbucketed")
    assert a.count() == b.count() == orders.count()
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0
    loc = spark.sql("DESCRIBE TABLE EXTENDED rep.orders_bucketed").where("col_name = 'Location'").first()[1]
    assert len(glob.glob(loc.replace("file:", "") + "/*.parquet")) <= 8  # updated + inserted, per bucket
    old_thr = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        delta = spark.table("rep.orders_bucketed").where("O_ORDERKEY >= 1450")
        plan = merge_upsert(a, delta, ["O_ORDERKEY"], broadcast_bytes=0, align=4) \
            ._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old_thr)
    join = plan[plan.index("SortMergeJoin"):]
    target_side = join[:join.index("Bucketed: true")]
    assert "Exchange" not in target_side.split("Sort [O_ORDERKEY")[1]  # target read bucketed, not shuffled


def test_quiet_run_writes_nothing(spark):
    import glob
    import os

    spark.sql("DROP TABLE IF EXISTS rep.users_quiet")
    s = spec(target_table_name="users_quiet", source_merge_columns={"updated_at": "datetime"})
    v1 = spark.createDataFrame([(1, D(2021, 1, 5), D(2021, 1, 5), "a"), (2, D(2021, 2, 5), D(2021, 2, 5), "b")],
                               SCHEMA)
    replicate_table(spark, s, v1, run_date="2021-03-01", now=D(2021, 3, 1, 12))
    loc = spark.sql("DESCRIBE TABLE EXTENDED rep.users_quiet").where("col_name = 'Location'").first()[1]
    files = {p: os.path.getmtime(p) for p in glob.glob(loc.replace("file:", "") + "/*.parquet")}
    st = replicate_table(spark, s, v1, run_date="2021-03-09", now=D(2021, 3, 9, 12))
    assert (st["path"], st["rows_read"], st["written"], st["rows_written"]) == ("merge", 0, False, 0)
    assert {p: os.path.getmtime(p) for p in glob.glob(loc.replace("file:", "") + "/*.parquet")} == files


def test_jobs_from_configs_with_jdbc_connections(spark, sf_small):
    import pytest

    from tidecopy.plans import jobs_from_configs
    from tidecopy.sources import catalog_from_frames, jdbc_scan, tables_from_frames

    nation = spark.read.parquet(f"{sf_small}/nation.parquet")
    url = "jdbc:derby:memory:test_configs;create=true"
    drv = {"driver": "org.apache.derby.iapi.jdbc.AutoloadedDriver"}
    nation.write.format("jdbc").options(url=url, dbtable="SHOP.NATION", **drv).mode("overwrite").save()
    configs = [{"load_type": "truncate", "source_jdbc_connection": "SRC", "source_schema": "SHOP",
                "source_table_name": "NATION", "target_schema": "rep", "target_table_name": "nation_cfg",
                "source_main_fields": ["n_nationkey"], "target_main_fields": ["N_NATIONKEY"]}]
    jobs = jobs_from_configs(configs, {"SRC": (url, drv)})
    assert jobs[0][1].table == "SHOP.NATION" and jobs[0][1].url == url
    frame = jdbc_scan(spark, jobs[0][1])
    cats = {"NATION": (catalog_from_frames(spark, {"NATION": frame}, table_schema="SHOP"),
                       tables_from_frames(spark, {"NATION": frame}, table_schema="SHOP"))}
    status = replicate_all(spark, jobs, run_date="2021-03-01", now=D(2021, 3, 1), catalogs=cats).first()
    assert (status["ok"], status["rows_written"], status["error"]) == (True, 25, None)
    with pytest.raises(ValueError, match="unknown connection"):
        jobs_from_configs(configs, {"OTHER": (url, drv)})


def test_partitioned_and_bucketed_target(spark, sf_small):
    orders = spark.read.parquet(f"{sf_small}/orders.parquet")
    base = dict(load_type="merge", source_schema="shop", source_table_name="orders", target_schema="rep",
                source_main_fields=["o_orderkey"], target_main_fields=["O_ORDERKEY"],
                source_merge_columns={"o_orderdate": "datetime"})
    both = TableSpec(target_table_name="orders_both", bucket_count=2,
                     partition_by={"O_RANGE": "cast(O_ORDERKEY div 500 AS bigint)"}, **base)
    plain = TableSpec(target_table_name="orders_neither", **base)
    for t in ("orders_both", "orders_neither"):
        spark.sql(f"DROP TABLE IF EXISTS rep.{t}")
    old = orders.where("o_orderkey < 1400")
    changed = orders.withColumn("o_orderdate", F.when(F.col("o_orderkey") >= 1300, F.lit(D(2001, 7, 1)))
                                .otherwise(F.least("o_orderdate", F.lit(D(2000, 1, 1)))))
    for s in (both, plain):
        replicate_table(spark, s, old, run_date="2001-07-01", now=D(2001, 8, 2))
        st = replicate_table(spark, s, changed, run_date="2001-07-02", now=D(2001, 8, 2))
        assert (st["path"], st["written"]) == ("merge", True)
    a = spark.table("rep.orders_both").drop("O_RANGE")
    b = spark.table("rep.orders_neither")
    assert a.count() == b.count() == orders.count()
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0
