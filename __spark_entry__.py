"""

Every query reads the driver's tables (``{sf_dir}/<table>.parquet``) and runs a
replication operator over the whole table. Scenarios that need an "older
replica" build it from the same tables with a date cut (the copy as it stood on
a day), never from an id subset. All times are fixed parameters.
"""

from __future__ import annotations

import datetime as dt
import struct
import uuid
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidecopy import ChunkSpec, TableSpec
from tidecopy.functions import geometry_srid, lookback_start, null_cells, text_cells
from tidecopy.operators import (
    catalog_of, chunk_grid, chunk_list, column_pairs, condition_met, conform, count_check, ddl_report,
    duplicate_keys, has_rows, in_chunk, incremental_filter, key_max, map_types, mapped_columns,
    merge_upsert, replace_fields, unknown_types,
)
from tidecopy.plans import replicate_all, replicate_table
from tidecopy.session import checkpoint_dir, local_frame, remove_path
from tidecopy.sources import (
    CATALOG_SCHEMA, JdbcTable, append_jdbc, append_target, catalog_from_frames, chunk_report, chunked_load,
    column_catalog, drop_target, ensure_table, full_load, jdbc_scan, load_tsv, postgres_catalog, postgres_columns, run_sql,
    tables_from_frames, truncate_load, write_swap, write_tsv,
)

try:  # the subpackage may be absent; nothing else needs it
    import corpus_pipeline
    from tidecopy.llm import queries as llm_queries
except ModuleNotFoundError as missing:
    if missing.name not in ("corpus_pipeline", "tidecopy.llm"):
        raise
    corpus_pipeline = llm_queries = None

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()
SOURCE_SCHEMA = "shop"        # name the driver tables carry as a "source database"
DEMO_DB = "tidecopy_demo"     # catalog database the loads write to
RUN_DATE = dt.date(2001, 7, 1)              # scheduled run; re-reads from 2001-06-28
REPLICA_AS_OF = dt.datetime(2001, 7, 15)    # the older replica holds rows before this
EVENTS_NOW = dt.datetime(2024, 1, 20, 10, 20)      # count-check clock -> cutoff 09:00
EVENTS_REPLICA_AS_OF = dt.datetime(2024, 1, 20, 6, 0)
ORDER_WATERMARKS = {"o_orderdate": "datetime", "o_orderkey": "int"}
DERBY_DRIVER = {"driver": "org.apache.derby.iapi.jdbc.AutoloadedDriver"}


def _t(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _ts(value: dt.datetime) -> F.Column:
    return F.lit(value.isoformat(sep=" ")).cast("timestamp_ntz")


def _mapped(spark: SparkSession, name: str, df: DataFrame, measure: bool = False):
    cat = catalog_from_frames(spark, {name: df}, table_schema=SOURCE_SCHEMA, measure=measure)
    return mapped_columns(cat)


def _derby(spark: SparkSession, name: str) -> str:
    # Embedded Derby: a database only this JVM sees (fine for local runs).
    return f"jdbc:derby:memory:tidecopy_{name};create=true"


# ---------------------------------------------------------------- merge path

def _orders_replica(orders: DataFrame) -> DataFrame:
    """The replica as of REPLICA_AS_OF, with prices that have since changed."""
    return (orders.where(F.col("o_orderdate") < _ts(REPLICA_AS_OF))
            .withColumn("o_totalprice", F.col("o_totalprice") - F.lit(1.0)))


def q_incremental_filter(spark, sf_dir):
    orders = _t(spark, sf_dir, "orders")
    km = key_max(_orders_replica(orders), "o_orderkey")
    delta = incremental_filter(orders, ORDER_WATERMARKS, lookback_start(RUN_DATE), km)
    return delta.select("o_orderkey", "o_orderdate")


def q_merge_upsert(spark, sf_dir):
    orders = _t(spark, sf_dir, "orders")
    target = _orders_replica(orders)
    km = key_max(target, "o_orderkey")
    delta = incremental_filter(orders, ORDER_WATERMARKS, lookback_start(RUN_DATE), km)
    return merge_upsert(target, delta, ["o_orderkey"])


def _line_totals(lineitem: DataFrame, before: dt.datetime | None = None) -> DataFrame:
    if before is not None:
        lineitem = lineitem.where(F.col("l_shipdate") < _ts(before))
    return lineitem.groupBy("l_orderkey", "l_linenumber").agg(
        F.sum("l_quantity").alias("qty"), F.max("l_shipdate").alias("l_shipdate"))


def q_merge_composite_key(spark, sf_dir):
    lineitem = _t(spark, sf_dir, "lineitem")
    source = _line_totals(lineitem)
    target = _line_totals(lineitem, REPLICA_AS_OF)
    delta = incremental_filter(source, {"l_shipdate": "datetime"}, lookback_start(RUN_DATE))
    return merge_upsert(target, delta, ["l_orderkey", "l_linenumber"])


def _customer_side(customer: DataFrame, segments_cond, tag: str) -> DataFrame:
    key = F.when(F.col("c_acctbal") >= 0, F.col("c_custkey"))  # unknown key: NULL
    return customer.where(segments_cond).select(
        key.alias("k"), "c_name", "c_acctbal", F.lit(tag).alias("src"))


def q_merge_null_keys(spark, sf_dir):
    customer = _t(spark, sf_dir, "customer")
    target = _customer_side(customer, F.col("c_mktsegment") != "BUILDING", "old")
    delta = _customer_side(customer, F.col("c_mktsegment").isin("BUILDING", "MACHINERY"), "new")
    return merge_upsert(target, delta, ["k"])


def q_duplicate_keys(spark, sf_dir):
    return duplicate_keys(_t(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"])


def q_key_max(spark, sf_dir):
    return local_frame(spark, [(key_max(_t(spark, sf_dir, "orders"), "o_orderkey"),)], "key_max bigint")


def q_has_rows(spark, sf_dir):
    return has_rows(_t(spark, sf_dir, "orders"))


# ---------------------------------------------------------------- type map

def _catalog(spark, sf_dir, names=TABLES, measure=True):
    """Catalog of driver tables as a source would declare them. String widths are
    measured over the whole data (one aggregation per table) where the result
    shows them."""
    frames = {name: _t(spark, sf_dir, name) for name in names}
    return (catalog_from_frames(spark, frames, table_schema=SOURCE_SCHEMA, measure=measure),
            tables_from_frames(spark, frames, table_schema=SOURCE_SCHEMA))


def q_column_catalog(spark, sf_dir):
    cols, tabs = _catalog(spark, sf_dir, ["lineitem"])
    return column_catalog(cols, tabs, SOURCE_SCHEMA, "lineitem")


def q_type_map(spark, sf_dir):
    cols, _ = _catalog(spark, sf_dir)
    return map_types(cols).select("table_name", "column_name", "ordinal_position", "data_type",
                                  "target_type", "spark_type")


def q_postgres_type_map(spark, sf_dir):
    """The driver tables declared in a PostgreSQL source (widths measured), mapped by its rules."""
    cols = postgres_columns(spark, {n: _t(spark, sf_dir, n) for n in TABLES}, table_schema=SOURCE_SCHEMA, measure=True)
    return map_types(postgres_catalog(cols), dialect="postgresql").select(
        "table_name", "column_name", "ordinal_position", "data_type", "column_type", "target_type", "load_expr", "spark_type")


def q_unknown_types(spark, sf_dir):
    """Columns of unknown types, and how many rows of their table lose them."""
    cols, _ = _catalog(spark, sf_dir, measure=False)
    found = unknown_types(cols)
    names = sorted({r["table_name"] for r in found.select("table_name").collect()})
    counts = reduce(DataFrame.unionByName, [_t(spark, sf_dir, n).agg(F.count(F.lit(1)).alias("n_rows"))
                                            .withColumn("table_name", F.lit(n)) for n in names])
    return found.join(counts, "table_name")


def q_ddl_report(spark, sf_dir):
    cols, _ = _catalog(spark, sf_dir)
    return ddl_report(cols, target_schema="REPLICA", connection="SRC").orderBy("table_schema", "table_name")


def q_column_pairs(spark, sf_dir):
    """The source's rows under the names that the pairs give them, and the pairs' number."""
    orders = _t(spark, sf_dir, "orders")
    loaded = conform(orders, _mapped(spark, "orders", orders))
    pairs = column_pairs(catalog_of(orders, SOURCE_SCHEMA, "orders"), catalog_of(loaded, "REPLICA", "ORDERS"))
    named = [(r["source_name"], r["target_name"]) for r in pairs.orderBy("ord").collect()]
    return orders.select(*[F.col(a).alias(b) for a, b in named], F.lit(len(named)).alias("N_PAIRS"))


def q_conform_wide_types(spark, sf_dir):
    """Columns of the rarer source types, derived from lineitem and events: decimals
    (one wider than a target holds), BIT(1), BIT(8), TIME, YEAR, BINARY and CHAR(n)."""
    lineitem = _t(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", F.col("l_extendedprice").cast("decimal(38,4)").alias("price"),
        F.col("l_quantity").cast("decimal(12,2)").alias("qty"), (F.col("l_discount") > 0.05).alias("cheap"),
        F.unhex(F.hex(F.col("l_linenumber").cast("bigint"))).alias("flags"),
        F.date_format("l_shipdate", "HH:mm:ss").alias("at_time"), F.year("l_shipdate").alias("in_year"),
        F.encode(F.concat("l_returnflag", "l_linestatus"), "utf-8").alias("raw"),
        F.concat_ws("-", "l_returnflag", "l_linestatus", F.col("l_partkey").cast("string")).alias("code"))
    declared = {"l_orderkey": ("bigint", "bigint", None, 19, 0), "l_linenumber": ("int", "int", None, 10, 0),
                "price": ("decimal", "decimal(38,4)", None, 38, 4), "qty": ("decimal", "decimal(12,2)", None, 12, 2),
                "cheap": ("bit", "bit(1)", None, 1, None), "flags": ("bit", "bit(8)", None, 8, None),
                "at_time": ("time", "time", None, None, None), "in_year": ("year", "year", None, None, None),
                "raw": ("binary", "binary(4)", 4, None, None), "code": ("char", "char(6)", 6, None, None)}
    rows = [("def", SOURCE_SCHEMA, "wide", name, i + 1, *declared[name]) for i, name in enumerate(lineitem.columns)]
    cols = mapped_columns(local_frame(spark, rows, CATALOG_SCHEMA))
    return conform(lineitem, cols)


def _stored_shapes(orders: DataFrame) -> DataFrame:
    """Orders with a shape as a MySQL table stores it: SRID, then well-known binary of every
    kind in both byte orders, its points made of the keys in half units. No shape for urgent orders."""
    little = F.col("_little")
    u32 = lambda n: F.when(little, struct.pack("<I", n).hex()).otherwise(struct.pack(">I", n).hex())

    # the bytes of the double v / 2, greatest first
    double = ("lpad(hex(CASE WHEN v = 0 THEN 0L ELSE shiftleft(cast(length(bin(abs(v))) + 1021 AS bigint), 52)"
              " | (shiftleft(abs(v), 53 - length(bin(abs(v)))) & 4503599627370495L)"
              " | (CASE WHEN v < 0 THEN shiftleft(1L, 63) ELSE 0L END) END), 16, '0')")
    turned = lambda h: F.concat(*[F.substring(h, i, 2) for i in range(15, 0, -2)])
    units = F.array(*[F.expr(e) for e in ("_a", "_b", "_a + 1", "_a + 2", "_b + 3")])
    orders = (orders.withColumns({"_little": F.expr("o_orderkey div 8 % 2 = 1"), "_a": F.expr("o_custkey % 2000 - 1000"),
                                  "_b": F.expr("o_orderkey % 1000 - 500")})
              .withColumn("_n", units).withColumn("_n", F.expr(f"transform(_n, v -> {double})"))
              .withColumn("_n", F.when(little, F.transform("_n", turned)).otherwise(F.col("_n"))))
    p, q, r = (F.concat(F.col("_n")[i], F.col("_n")[j]) for i, j in ((0, 1), (1, 2), (3, 4)))
    kind = lambda n, *parts: F.concat(F.when(little, "01").otherwise("00"), u32(n), *parts)
    orders = orders.withColumns({"_p": p, "_q": q, "_r": r})
    p, q, r = F.col("_p"), F.col("_q"), F.col("_r")
    point, line, polygon = kind(1, p), kind(2, u32(2), p, q), kind(3, u32(1), u32(4), p, q, r, p)
    shapes = [kind(7, u32(0)), point, line, polygon, kind(4, u32(2), point, kind(1, q)), kind(5, u32(2), line, kind(2, u32(2), q, r)),
              kind(6, u32(1), polygon), kind(7, u32(2), point, kind(7, u32(1), line))]
    wkb = reduce(lambda rest, i: F.when(F.expr("o_orderkey % 8") == i, shapes[i]).otherwise(rest), range(7), shapes[7])
    srid = F.when(F.col("o_orderstatus") == "O", "E6100000").otherwise("00000000")
    return orders.withColumn("shape", F.when(F.col("o_orderpriority") != "1-URGENT", F.unhex(F.concat(srid, wkb))))


def q_geometry_text(spark, sf_dir):
    """Stored geometries loaded as text, by the column's type in the catalog."""
    shapes = _stored_shapes(_t(spark, sf_dir, "orders")).select("o_orderkey", "shape", geometry_srid(F.col("shape")).alias("srid"))
    rows = [("def", SOURCE_SCHEMA, "shapes", name, i + 1, kind, kind, None, None, None)
            for i, (name, kind) in enumerate([("o_orderkey", "bigint"), ("shape", "geometry"), ("srid", "int")])]
    return conform(shapes, mapped_columns(local_frame(spark, rows, CATALOG_SCHEMA)))


def q_conform_types(spark, sf_dir):
    lineitem = _t(spark, sf_dir, "lineitem")
    return conform(lineitem, _mapped(spark, "lineitem", lineitem))


def q_replace_fields(spark, sf_dir):
    return replace_fields(_t(spark, sf_dir, "customer"), {"c_name": "sha2(c_name, 256)"})


def q_null_cells(spark, sf_dir):
    events = _t(spark, sf_dir, "events")
    # a failed reading is stored as NaN on the source side
    raw = events.withColumn("value", F.when(F.col("event_type") == "error", F.lit(float("nan")))
                            .otherwise(F.col("value")))
    return null_cells(raw)


def q_text_cells(spark, sf_dir):
    events = _t(spark, sf_dir, "events")
    raw = events.withColumn("value", F.when(F.col("event_type") == "error", F.lit(float("nan"))).otherwise(F.col("value")))
    return text_cells(raw.select("event_id", "ts", "event_type", "value"))


# ---------------------------------------------------------------- loads

def q_full_load(spark, sf_dir):
    orders = _t(spark, sf_dir, "orders")
    return full_load(spark, orders, _mapped(spark, "orders", orders), f"{DEMO_DB}.orders_full")


def q_chunked_load(spark, sf_dir):
    orders = _t(spark, sf_dir, "orders")
    return chunked_load(spark, orders, _mapped(spark, "orders", orders), f"{DEMO_DB}.orders_chunked",
                        column="o_orderdate", freq="MS", start_year=1995,
                        until=dt.datetime(2001, 8, 15))


def q_chunked_load_rest(spark, sf_dir):
    """Chunks from 1998 on, and the rest (earlier and undated orders) with them: every row."""
    orders = _t(spark, sf_dir, "orders").withColumn(
        "o_orderdate", F.when(F.col("o_orderstatus") != "P", F.col("o_orderdate")))
    target = f"{DEMO_DB}.orders_chunked_rest"
    chunked_load(spark, orders, _mapped(spark, "orders", orders), target, column="o_orderdate", freq="MS",
                 start_year=1998, until=dt.datetime(2001, 8, 15), include_rest=True)
    return spark.table(f"`{DEMO_DB}`.`orders_chunked_rest`")


def q_chunk_rows(spark, sf_dir):
    """All orders, each with the chunk whose bounds hold it (the last one is open)."""
    orders = _t(spark, sf_dir, "orders")
    bounds = [(dt.datetime(1990, 1, 1), dt.datetime(1997, 1, 1)), (dt.datetime(1997, 1, 1), dt.datetime(2000, 7, 1)),
              (dt.datetime(2000, 7, 1), None)]
    return reduce(DataFrame.unionByName, [
        in_chunk(orders, "o_orderdate", lo, hi).select("o_orderkey", "o_orderdate", F.lit(i).alias("chunk"))
        for i, (lo, hi) in enumerate(bounds)])


def q_chunked_load_weekly(spark, sf_dir):
    events = _t(spark, sf_dir, "events")
    return chunked_load(spark, events, _mapped(spark, "events", events), f"{DEMO_DB}.events_weekly",
                        column="ts", freq="W-MON", start_year=2024, until=dt.datetime(2024, 2, 1))


def q_chunk_bounds(spark, sf_dir):
    span = _t(spark, sf_dir, "orders").agg(
        F.date_trunc("YEAR", F.min("o_orderdate")).alias("start"), F.max("o_orderdate").alias("until"))
    return chunk_grid(span, F.col("start"), F.col("until"), "MS")


CHUNK_ALIASES = ("2W-MON", "QS-FEB", "BME", "3B", "YE-JUN", "SMS", "WOM-2TUE", "1D12h")


def q_chunk_grids(spark, sf_dir):
    """Orders per chunk of eight kinds of grids (multiples, anchors, period ends, business days)."""
    orders, until = _t(spark, sf_dir, "orders"), dt.datetime(2001, 8, 15)
    parts = []
    for alias in CHUNK_ALIASES:
        bounds = chunk_list(spark, 1995, alias, until)
        parts.append(chunk_report(orders, "o_orderdate", alias, bounds[0][0], bounds[-1][0])
                     .select(F.lit(alias).alias("freq"), "chunk_lo", "n"))
    return reduce(DataFrame.unionByName, parts)


def q_truncate_load(spark, sf_dir):
    nation = _t(spark, sf_dir, "nation")
    cols = _mapped(spark, "nation", nation)
    target = f"{DEMO_DB}.nation_truncate"
    # a stale copy is in place before the reload
    write_swap(conform(nation.withColumn("n_name", F.lower("n_name")), cols), target)
    return truncate_load(spark, nation, cols, target)


def q_ensure_table(spark, sf_dir):
    part = _t(spark, sf_dir, "part")
    target = f"{DEMO_DB}.part_ensure"
    spark.sql(f"DROP TABLE IF EXISTS `{DEMO_DB}`.`part_ensure`")
    cols = _mapped(spark, "part", part)
    created = ensure_table(spark, target, cols)
    again = ensure_table(spark, target, cols)     # there already: left as it is
    append_target(conform(part, cols), target)
    return spark.table(f"`{DEMO_DB}`.`part_ensure`").withColumns({"CREATED": F.lit(created), "AGAIN": F.lit(again)})


def q_drop_target(spark, sf_dir):
    nation = _t(spark, sf_dir, "nation")
    target = f"{DEMO_DB}.nation_drop"
    full_load(spark, nation, _mapped(spark, "nation", nation), target)
    rows_before = spark.table(f"`{DEMO_DB}`.`nation_drop`").count()
    existed = drop_target(spark, target)
    exists_after = spark.catalog.tableExists(f"`{DEMO_DB}`.`nation_drop`")
    return local_frame(spark, [(existed, exists_after, rows_before)],
                       "existed_before boolean, exists_after boolean, rows_before bigint")


def q_append_target(spark, sf_dir):
    supplier = _t(spark, sf_dir, "supplier")
    cols = _mapped(spark, "supplier", supplier)
    target = f"{DEMO_DB}.supplier_append"
    full_load(spark, supplier, cols, target)
    moved = supplier.withColumn("s_suppkey", F.col("s_suppkey") + F.lit(100000))
    append_target(moved, target)
    return spark.table(f"`{DEMO_DB}`.`supplier_append`")


def q_tsv_load(spark, sf_dir):
    supplier = _t(spark, sf_dir, "supplier")
    path = f"{checkpoint_dir(spark)}/supplier_tsv_{uuid.uuid4().hex}"
    spark.sql(f"DROP TABLE IF EXISTS `{DEMO_DB}`.`supplier_tsv`")
    write_tsv(supplier, path)
    out = load_tsv(spark, path, supplier.schema, f"{DEMO_DB}.supplier_tsv")
    remove_path(spark, path)
    return out


def q_jdbc_scan(spark, sf_dir):
    orders = _t(spark, sf_dir, "orders")
    src = JdbcTable(_derby(spark, "scan"), "APP.ORDERS", DERBY_DRIVER)
    (orders.write.format("jdbc").options(**src.options()).option("dbtable", src.table)
     .option("createTableColumnTypes", "o_orderstatus VARCHAR(8), o_orderpriority VARCHAR(32)")
     .mode("overwrite").save())
    pred = (F.col("o_orderdate") >= _ts(dt.datetime(1998, 1, 1))) & (F.col("o_orderstatus") == "F")
    return jdbc_scan(spark, src, columns=["o_orderkey", "o_totalprice", "o_orderdate"], predicate=pred)


def q_append_jdbc(spark, sf_dir):
    supplier = _t(spark, sf_dir, "supplier").select("s_suppkey", "s_name")
    dest = JdbcTable(_derby(spark, "append"), "APP.SUPPLIER", DERBY_DRIVER)
    (supplier.limit(0).write.format("jdbc").options(**dest.options()).option("dbtable", dest.table)
     .option("createTableColumnTypes", "s_name VARCHAR(64)").mode("overwrite").save())
    append_jdbc(supplier, dest)
    append_jdbc(supplier.select(F.col("s_suppkey") + F.lit(100000), "s_name"), dest,
                columns=["s_suppkey", "s_name"], commit_every=0)
    return jdbc_scan(spark, dest)


def q_run_sql(spark, sf_dir):
    _t(spark, sf_dir, "orders").createOrReplaceTempView("tidecopy_orders")
    return run_sql(spark, "SELECT o_orderstatus, count(*) AS n FROM IDENTIFIER(:t) "
                          "WHERE o_orderdate >= :since GROUP BY o_orderstatus",
                   {"t": "tidecopy_orders", "since": dt.datetime(1999, 1, 1)})


# ---------------------------------------------------------------- checks

def q_count_check_cutoff(spark, sf_dir):
    events = _t(spark, sf_dir, "events")
    replica = events.where(F.col("ts") < _ts(EVENTS_REPLICA_AS_OF)).toDF(*[c.upper() for c in events.columns])
    return count_check(events, replica, {"ts": "datetime"}, now=EVENTS_NOW, cutoff_column="ts")


def q_count_check_tolerance(spark, sf_dir):
    orders = _t(spark, sf_dir, "orders")
    replica = orders.where(F.col("o_orderdate") < _ts(REPLICA_AS_OF))
    return count_check(orders, replica, None)


def q_condition_met(spark, sf_dir):
    probe = _t(spark, sf_dir, "events").where(F.col("event_type") == "error").agg(F.count(F.lit(1)).alias("n"))
    return condition_met(probe)


# ---------------------------------------------------------------- whole runs

def _orders_spec(target: str, **kw) -> TableSpec:
    return TableSpec(load_type="merge", source_schema=SOURCE_SCHEMA, source_table_name="orders",
                     target_schema=DEMO_DB, target_table_name=target,
                     source_main_fields=["o_orderkey"], target_main_fields=["O_ORDERKEY"],
                     source_merge_columns=ORDER_WATERMARKS, **kw)


def q_replicate_first_load(spark, sf_dir):
    orders = _t(spark, sf_dir, "orders")
    spec = _orders_spec("orders_first", source_freq=ChunkSpec("o_orderdate", "AS", 1995))
    spark.sql(f"DROP TABLE IF EXISTS `{DEMO_DB}`.`orders_first`")
    replicate_table(spark, spec, orders, run_date=RUN_DATE, now=dt.datetime(2001, 8, 2),
                    until=dt.datetime(2001, 8, 2))
    return spark.table(f"`{DEMO_DB}`.`orders_first`")


def q_replicate_merge(spark, sf_dir):
    orders = _t(spark, sf_dir, "orders")
    spec = _orders_spec("orders_merge")
    cols = _mapped(spark, "orders", orders)
    write_swap(conform(_orders_replica(orders), cols), f"{DEMO_DB}.orders_merge")
    replicate_table(spark, spec, orders, run_date=RUN_DATE, now=dt.datetime(2001, 7, 1, 12))
    return spark.table(f"`{DEMO_DB}`.`orders_merge`")


def q_replicate_merge_partitioned(spark, sf_dir):
    """The same merge into a target partitioned by the month of the order (which
    never changes): only the months the delta falls in are read and rewritten,
    and every other one stays as it is."""
    orders = _t(spark, sf_dir, "orders")
    parts = {"O_MONTH": "date_format(O_ORDERDATE, 'yyyy-MM')"}
    spec = _orders_spec("orders_merge_parts", partition_by=parts)
    spark.sql(f"DROP TABLE IF EXISTS `{DEMO_DB}`.`orders_merge_parts`")
    cols = _mapped(spark, "orders", orders)
    full_load(spark, _orders_replica(orders), cols, f"{DEMO_DB}.orders_merge_parts", partition_by=parts)
    replicate_table(spark, spec, orders, run_date=RUN_DATE, now=dt.datetime(2001, 7, 1, 12))
    return spark.table(f"`{DEMO_DB}`.`orders_merge_parts`")


def q_replicate_merge_files(spark, sf_dir):
    """The same merge into a target in file groups: the index picks the groups that
    hold keys of the delta, and only their files are rewritten."""
    orders = _t(spark, sf_dir, "orders")
    spec = _orders_spec("orders_merge_files", group_rows=5000)
    target = f"{DEMO_DB}.orders_merge_files"
    cols = _mapped(spark, "orders", orders)
    write_swap(conform(_orders_replica(orders), cols), target, group_by=(5000, ["O_ORDERKEY"]))
    replicate_table(spark, spec, orders, run_date=RUN_DATE, now=dt.datetime(2001, 7, 1, 12))
    return spark.table(f"`{DEMO_DB}`.`orders_merge_files`").drop("TC_GROUP")


def q_replicate_merge_bucketed(spark, sf_dir):
    """The same merge into a target bucketed by the key: a large delta is
    shuffled into the buckets, the target is read in place."""
    orders = _t(spark, sf_dir, "orders")
    spec = _orders_spec("orders_merge_buckets", bucket_count=8)
    spark.sql(f"DROP TABLE IF EXISTS `{DEMO_DB}`.`orders_merge_buckets`")
    cols = _mapped(spark, "orders", orders)
    full_load(spark, _orders_replica(orders), cols, f"{DEMO_DB}.orders_merge_buckets",
              bucket_by=(8, ["O_ORDERKEY"]))
    replicate_table(spark, spec, orders, run_date=RUN_DATE, now=dt.datetime(2001, 7, 1, 12))
    return spark.table(f"`{DEMO_DB}`.`orders_merge_buckets`")


def q_replicate_all(spark, sf_dir):
    """Four reloads, a merge, and a job whose count check fails: its watermark says all of
    its rows should be there, but its first load leaves out the early ones."""
    jobs = []
    for name, key in (("nation", "n_nationkey"), ("region", "r_regionkey"),
                      ("supplier", "s_suppkey"), ("customer", "c_custkey")):
        spec = TableSpec(load_type="truncate", source_schema=SOURCE_SCHEMA, source_table_name=name,
                         target_schema=DEMO_DB, target_table_name=f"all_{name}",
                         source_main_fields=[key], target_main_fields=[key.upper()])
        jobs.append((spec, _t(spark, sf_dir, name)))
    orders = _t(spark, sf_dir, "orders")
    write_swap(conform(_orders_replica(orders), _mapped(spark, "orders", orders)), f"{DEMO_DB}.all_orders")
    jobs.append((_orders_spec("all_orders"), orders))
    spark.sql(f"DROP TABLE IF EXISTS `{DEMO_DB}`.`all_orders_late`")
    jobs.append((_orders_spec("all_orders_late", source_freq=ChunkSpec("o_orderdate", "MS", 1998),
                              count_cutoff_column="o_orderdate"), orders))
    status = replicate_all(spark, jobs, run_date=RUN_DATE, now=dt.datetime(2001, 7, 1, 12))
    return status.select("table_name", "path", "rows_written", "written", "excluded", "check_rule", "source_n", "target_n", "ok")


_QUERIES = {
    "merge_upsert": q_merge_upsert,
    "merge_composite_key": q_merge_composite_key,
    "merge_null_keys": q_merge_null_keys,
    "incremental_filter": q_incremental_filter,
    "duplicate_keys": q_duplicate_keys,
    "key_max": q_key_max,
    "has_rows": q_has_rows,
    "column_catalog": q_column_catalog,
    "type_map": q_type_map,
    "postgres_type_map": q_postgres_type_map,
    "unknown_types": q_unknown_types,
    "ddl_report": q_ddl_report,
    "column_pairs": q_column_pairs,
    "conform_types": q_conform_types,
    "conform_wide_types": q_conform_wide_types,
    "replace_fields": q_replace_fields,
    "null_cells": q_null_cells,
    "text_cells": q_text_cells,
    "full_load": q_full_load,
    "chunked_load": q_chunked_load,
    "chunked_load_rest": q_chunked_load_rest,
    "chunk_rows": q_chunk_rows,
    "chunked_load_weekly": q_chunked_load_weekly,
    "chunk_bounds": q_chunk_bounds,
    "chunk_grids": q_chunk_grids,
    "geometry_text": q_geometry_text,
    "truncate_load": q_truncate_load,
    "ensure_table": q_ensure_table,
    "drop_target": q_drop_target,
    "append_target": q_append_target,
    "tsv_load": q_tsv_load,
    "jdbc_scan": q_jdbc_scan,
    "append_jdbc": q_append_jdbc,
    "run_sql": q_run_sql,
    "count_check_cutoff": q_count_check_cutoff,
    "count_check_tolerance": q_count_check_tolerance,
    "condition_met": q_condition_met,
    "replicate_first_load": q_replicate_first_load,
    "replicate_merge": q_replicate_merge,
    "replicate_merge_partitioned": q_replicate_merge_partitioned,
    "replicate_merge_bucketed": q_replicate_merge_bucketed,
    "replicate_merge_files": q_replicate_merge_files,
    "replicate_all": q_replicate_all,
}


def entry(spark: SparkSession) -> DataFrame:
    """Flagship: incremental upsert of orders into an older replica (sf0.001)."""
    return q_merge_upsert(spark, "/root/testdata/sf0.001")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    if llm_queries is None:
        return dict(_QUERIES)
    return {**_QUERIES, **llm_queries.QUERIES, "pipeline": corpus_pipeline.run}


# ---------------------------------------------------------------- oracles

_ORDERS_REPLICA = """
  replica AS (SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice - 1.0 AS o_totalprice,
                     o_orderdate, o_orderpriority
              FROM orders WHERE o_orderdate < TIMESTAMP '2001-07-15 00:00:00'),
  delta AS (SELECT *, TRUE AS hit FROM orders
            WHERE o_orderdate >= TIMESTAMP '2001-06-28 00:00:00'
               OR o_orderkey >= (SELECT max(o_orderkey) FROM replica))"""

_MERGED_ORDERS = """
  SELECT coalesce(d.o_orderkey, t.o_orderkey) AS o_orderkey,
         CASE WHEN d.hit THEN d.o_custkey ELSE t.o_custkey END AS o_custkey,
         CASE WHEN d.hit THEN d.o_orderstatus ELSE t.o_orderstatus END AS o_orderstatus,
         CASE WHEN d.hit THEN d.o_totalprice ELSE t.o_totalprice END AS o_totalprice,
         CASE WHEN d.hit THEN d.o_orderdate ELSE t.o_orderdate END AS o_orderdate,
         CASE WHEN d.hit THEN d.o_orderpriority ELSE t.o_orderpriority END AS o_orderpriority
  FROM replica t FULL OUTER JOIN delta d ON t.o_orderkey = d.o_orderkey"""

# String columns of the driver tables; their widths are measured by the oracle too.
_STRING_COLUMNS = {
    "benchmark": ["text"], "conversations": ["role", "text"], "customer": ["c_name", "c_mktsegment"],
    "documents": ["text", "lang", "source"], "events": ["event_type", "props"],
    "lineitem": ["l_returnflag", "l_linestatus"], "nation": ["n_name"], "orders": ["o_orderstatus", "o_orderpriority"],
    "pages": ["url", "html"], "part": ["p_name", "p_brand", "p_type"], "region": ["r_name"], "supplier": ["s_name"],
}
_WIDTHS = " UNION ALL ".join(
    f"SELECT '{t}' AS table_name, '{c}' AS column_name, greatest(coalesce(max(length({c})), 0), 1) AS w FROM {t}"
    for t, cs in _STRING_COLUMNS.items() for c in cs)
_DRIVER_TABLES = ", ".join(f"'{t}'" for t in TABLES)
# information_schema rows of the driver tables with the measured width of each string column
_COLS = f"""(SELECT i.table_name, i.column_name, i.ordinal_position, i.data_type, w.w
            FROM information_schema.columns i LEFT JOIN ({_WIDTHS}) w
              ON i.table_name = w.table_name AND i.column_name = w.column_name
            WHERE i.table_name IN ({_DRIVER_TABLES}))"""
_IS_VARCHAR = "(data_type = 'VARCHAR' AND w <= 16383)"
# Source type names the driver's column types stand for, and their mapping.
_SRC_TYPE = f"""CASE WHEN data_type = 'BIGINT' THEN 'bigint' WHEN data_type = 'INTEGER' THEN 'int'
                 WHEN data_type = 'DOUBLE' THEN 'double' WHEN {_IS_VARCHAR} THEN 'varchar'
                 WHEN data_type = 'VARCHAR' THEN 'longtext'
                 WHEN data_type LIKE 'TIMESTAMP%' THEN 'datetime' ELSE 'vector' END"""
_TARGET_TYPE = f"""CASE WHEN data_type = 'BIGINT' THEN 'DECIMAL (20,0)' WHEN data_type = 'INTEGER' THEN 'DECIMAL(11,0)'
                 WHEN data_type = 'DOUBLE' THEN 'DOUBLE' WHEN {_IS_VARCHAR} THEN 'VARCHAR(' || w || ')'
                 WHEN data_type = 'VARCHAR' THEN 'varchar(2000000)'
                 WHEN data_type LIKE 'TIMESTAMP%' THEN 'TIMESTAMP' END"""
_SPARK_TYPE = """CASE WHEN data_type = 'BIGINT' THEN 'decimal(20,0)' WHEN data_type = 'INTEGER' THEN 'decimal(11,0)'
                 WHEN data_type = 'DOUBLE' THEN 'double' WHEN data_type = 'VARCHAR' THEN 'string'
                 WHEN data_type LIKE 'TIMESTAMP%' THEN 'timestamp_ntz' END"""

_ORACLES = {
    "merge_upsert": f"WITH {_ORDERS_REPLICA} {_MERGED_ORDERS}",
    "merge_composite_key": """
      WITH src AS (SELECT l_orderkey, l_linenumber, sum(l_quantity) AS qty, max(l_shipdate) AS l_shipdate
                   FROM lineitem GROUP BY 1, 2),
           replica AS (SELECT l_orderkey, l_linenumber, sum(l_quantity) AS qty, max(l_shipdate) AS l_shipdate
                       FROM lineitem WHERE l_shipdate < TIMESTAMP '2001-07-15 00:00:00' GROUP BY 1, 2),
           delta AS (SELECT *, TRUE AS hit FROM src WHERE l_shipdate >= TIMESTAMP '2001-06-28 00:00:00')
      SELECT coalesce(d.l_orderkey, t.l_orderkey) AS l_orderkey,
             coalesce(d.l_linenumber, t.l_linenumber) AS l_linenumber,
             CASE WHEN d.hit THEN d.qty ELSE t.qty END AS qty,
             CASE WHEN d.hit THEN d.l_shipdate ELSE t.l_shipdate END AS l_shipdate
      FROM replica t FULL OUTER JOIN delta d
        ON t.l_orderkey = d.l_orderkey AND t.l_linenumber = d.l_linenumber""",
    "merge_null_keys": """
      WITH t AS (SELECT CASE WHEN c_acctbal >= 0 THEN c_custkey END AS k, c_name, c_acctbal, 'old' AS src
                 FROM customer WHERE c_mktsegment <> 'BUILDING'),
           d AS (SELECT CASE WHEN c_acctbal >= 0 THEN c_custkey END AS k, c_name, c_acctbal, 'new' AS src,
                        TRUE AS hit
                 FROM customer WHERE c_mktsegment IN ('BUILDING', 'MACHINERY'))
      SELECT CASE WHEN d.hit THEN d.k ELSE t.k END AS k,
             CASE WHEN d.hit THEN d.c_name ELSE t.c_name END AS c_name,
             CASE WHEN d.hit THEN d.c_acctbal ELSE t.c_acctbal END AS c_acctbal,
             CASE WHEN d.hit THEN d.src ELSE t.src END AS src
      FROM t FULL OUTER JOIN d ON t.k = d.k""",
    "incremental_filter": f"""
      WITH {_ORDERS_REPLICA}
      SELECT o_orderkey, o_orderdate FROM delta""",
    "duplicate_keys": """
      SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem
      GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1""",
    "key_max": "SELECT max(o_orderkey) AS key_max FROM orders",
    "has_rows": "SELECT count(*) > 0 AS has_rows FROM orders",
    "column_catalog": f"""
      SELECT 'def' AS table_catalog, 'shop' AS table_schema, table_name, column_name,
             CAST(ordinal_position AS INTEGER) AS ordinal_position,
             {_SRC_TYPE} AS data_type,
             CASE WHEN data_type LIKE 'TIMESTAMP%' THEN 'datetime(6)'
                  WHEN {_IS_VARCHAR} THEN 'varchar(' || w || ')' ELSE {_SRC_TYPE} END AS column_type,
             CASE WHEN {_IS_VARCHAR} THEN w WHEN data_type = 'VARCHAR' THEN 4294967295 END::BIGINT
               AS character_maximum_length,
             CASE data_type WHEN 'BIGINT' THEN 19 WHEN 'INTEGER' THEN 10 WHEN 'DOUBLE' THEN 22 END::INTEGER
               AS numeric_precision,
             CASE data_type WHEN 'BIGINT' THEN 0 WHEN 'INTEGER' THEN 0 END::INTEGER AS numeric_scale
      FROM {_COLS} WHERE table_name = 'lineitem'""",
    "type_map": f"""
      SELECT table_name, column_name, CAST(ordinal_position AS INTEGER) AS ordinal_position,
             {_SRC_TYPE} AS data_type, {_TARGET_TYPE} AS target_type, {_SPARK_TYPE} AS spark_type
      FROM {_COLS}""",
    "postgres_type_map": f"""
      WITH c AS (
        SELECT table_name, column_name, CAST(ordinal_position AS INTEGER) AS ordinal_position, w,
               CASE WHEN data_type = 'BIGINT' THEN 'bigint' WHEN data_type = 'INTEGER' THEN 'integer'
                    WHEN data_type = 'DOUBLE' THEN 'double precision' WHEN data_type LIKE 'TIMESTAMP%' THEN 'timestamp without time zone'
                    WHEN data_type LIKE '%[]' THEN 'ARRAY' WHEN w <= 10485760 THEN 'character varying' ELSE 'text' END AS data_type,
               CASE data_type WHEN 'FLOAT[]' THEN 'real[]' WHEN 'DOUBLE[]' THEN 'double precision[]' END AS of_array
        FROM {_COLS})
      SELECT table_name, column_name, ordinal_position, data_type,
             CASE data_type WHEN 'ARRAY' THEN of_array WHEN 'character varying' THEN 'character varying(' || w || ')'
                  ELSE data_type END AS column_type,
             CASE data_type WHEN 'bigint' THEN 'DECIMAL (20,0)' WHEN 'integer' THEN 'DECIMAL(11,0)' WHEN 'double precision' THEN 'DOUBLE'
                  WHEN 'timestamp without time zone' THEN 'TIMESTAMP' WHEN 'character varying' THEN 'varchar(' || least(w, 2000000) || ')'
                  ELSE 'varchar(2000000)' END AS target_type,
             CASE data_type WHEN 'ARRAY' THEN 'cast(array_to_json("' || column_name || '") as text)'
                  ELSE '"' || column_name || '"' END AS load_expr,
             CASE data_type WHEN 'bigint' THEN 'decimal(20,0)' WHEN 'integer' THEN 'decimal(11,0)' WHEN 'double precision' THEN 'double'
                  WHEN 'timestamp without time zone' THEN 'timestamp_ntz' ELSE 'string' END AS spark_type
      FROM c""",
    "unknown_types": f"""
      SELECT 'shop' AS table_schema, table_name, column_name,
             CAST(ordinal_position AS INTEGER) AS ordinal_position, 'VECTOR' AS data_type,
             '--UNKNOWN_DATATYPE: "' || upper(column_name) || '" VECTOR' AS unknown_note,
             (SELECT count(*) FROM embeddings) AS n_rows
      FROM {_COLS} WHERE ({_TARGET_TYPE}) IS NULL""",
    "ddl_report": f"""
      WITH c AS (
        SELECT table_name, ordinal_position, column_name,
               CASE WHEN ({_TARGET_TYPE}) IS NOT NULL
                    THEN '"' || upper(column_name) || '" ' || ({_TARGET_TYPE}) END AS col_ddl,
               CASE WHEN ({_TARGET_TYPE}) IS NULL
                    THEN '--UNKNOWN_DATATYPE: "' || upper(column_name) || '" VECTOR' END AS note,
               CASE WHEN ({_TARGET_TYPE}) IS NOT NULL THEN '`' || column_name || '`' END AS sel
        FROM {_COLS})
      SELECT 'shop' AS table_schema, table_name, 'REPLICA' AS target_schema, upper(table_name) AS target_table,
             'create schema if not exists "REPLICA";' AS sql_create_schema,
             'create table if not exists  "REPLICA"."' || upper(table_name) || '" ('
               || coalesce(string_agg(col_ddl, ',' ORDER BY ordinal_position), '') || ');'
               || coalesce(string_agg(note, ',' ORDER BY ordinal_position), '') || ' ' AS sql_create_table,
             'import into "REPLICA"."' || upper(table_name) || '" from jdbc at SRC statement ''select '
               || coalesce(string_agg(sel, ',' ORDER BY ordinal_position), '')
               || ' from shop.' || table_name || '''' AS sql_imports
      FROM c GROUP BY table_name""",
    "column_pairs": """
      SELECT o_orderkey AS "O_ORDERKEY", o_custkey AS "O_CUSTKEY", o_orderstatus AS "O_ORDERSTATUS",
             o_totalprice AS "O_TOTALPRICE", o_orderdate AS "O_ORDERDATE", o_orderpriority AS "O_ORDERPRIORITY",
             6 AS "N_PAIRS"
      FROM orders""",
    "conform_types": """
      SELECT CAST(l_orderkey AS DECIMAL(20,0)) AS "L_ORDERKEY", CAST(l_partkey AS DECIMAL(20,0)) AS "L_PARTKEY",
             CAST(l_suppkey AS DECIMAL(20,0)) AS "L_SUPPKEY", CAST(l_linenumber AS DECIMAL(11,0)) AS "L_LINENUMBER",
             l_quantity AS "L_QUANTITY", l_extendedprice AS "L_EXTENDEDPRICE", l_discount AS "L_DISCOUNT",
             l_tax AS "L_TAX", l_returnflag AS "L_RETURNFLAG", l_linestatus AS "L_LINESTATUS",
             l_shipdate AS "L_SHIPDATE"
      FROM lineitem""",
    "conform_wide_types": """
      SELECT CAST(l_orderkey AS DECIMAL(20,0)) AS "L_ORDERKEY", CAST(l_linenumber AS DECIMAL(11,0)) AS "L_LINENUMBER",
             CAST(l_extendedprice AS DECIMAL(36,4)) AS "PRICE", CAST(l_quantity AS DECIMAL(12,2)) AS "QTY",
             CAST(CASE WHEN l_discount > 0.05 THEN 1 WHEN l_discount <= 0.05 THEN 0 END AS DECIMAL(1,0)) AS "CHEAP",
             CAST(l_linenumber AS DECIMAL(8,0)) AS "FLAGS", strftime(l_shipdate, '%H:%M:%S') AS "AT_TIME",
             CAST(year(l_shipdate) AS VARCHAR) AS "IN_YEAR", l_returnflag || l_linestatus AS "RAW",
             l_returnflag || '-' || l_linestatus || '-' || l_partkey AS "CODE"
      FROM lineitem""",
    "replace_fields": """
      SELECT c_custkey, sha256(c_name) AS c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer""",
    "text_cells": """
      SELECT CAST(event_id AS VARCHAR) AS event_id,
             CASE WHEN date_trunc('second', ts) = ts THEN strftime(ts, '%Y-%m-%dT%H:%M:%S') ELSE strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') END AS ts,
             event_type, CASE WHEN event_type <> 'error' OR event_type IS NULL THEN CAST(value AS VARCHAR) END AS value FROM events""",
    "null_cells": """
      SELECT event_id, ts, user_id, event_type,
             CASE WHEN event_type = 'error' THEN NULL ELSE value END AS value, props
      FROM events""",
    "full_load": """
      SELECT CAST(o_orderkey AS DECIMAL(20,0)) AS "O_ORDERKEY", CAST(o_custkey AS DECIMAL(20,0)) AS "O_CUSTKEY",
             o_orderstatus AS "O_ORDERSTATUS", o_totalprice AS "O_TOTALPRICE", o_orderdate AS "O_ORDERDATE",
             o_orderpriority AS "O_ORDERPRIORITY"
      FROM orders""",
    "chunked_load": """
      SELECT date_trunc('month', o_orderdate)::TIMESTAMP AS chunk_lo, count(*) AS n, TRUE AS loaded
      FROM orders WHERE o_orderdate >= TIMESTAMP '1995-01-01 00:00:00' GROUP BY 1
      UNION ALL
      SELECT NULL::TIMESTAMP, count(*) FILTER (WHERE o_orderdate < TIMESTAMP '1995-01-01 00:00:00'
                                                 OR o_orderdate IS NULL), FALSE FROM orders""",
    "chunked_load_rest": """
      SELECT CAST(o_orderkey AS DECIMAL(20,0)) AS "O_ORDERKEY", CAST(o_custkey AS DECIMAL(20,0)) AS "O_CUSTKEY",
             o_orderstatus AS "O_ORDERSTATUS", o_totalprice AS "O_TOTALPRICE",
             CASE WHEN o_orderstatus <> 'P' THEN o_orderdate END AS "O_ORDERDATE", o_orderpriority AS "O_ORDERPRIORITY"
      FROM orders""",
    "chunk_rows": """
      SELECT o_orderkey, o_orderdate, CASE WHEN o_orderdate < TIMESTAMP '1997-01-01 00:00:00' THEN 0
                                           WHEN o_orderdate < TIMESTAMP '2000-07-01 00:00:00' THEN 1 ELSE 2 END AS chunk
      FROM orders WHERE o_orderdate >= TIMESTAMP '1990-01-01 00:00:00'""",
    "chunked_load_weekly": """
      SELECT date_trunc('week', ts)::TIMESTAMP AS chunk_lo, count(*) AS n, TRUE AS loaded
      FROM events WHERE ts >= TIMESTAMP '2024-01-01 00:00:00' GROUP BY 1
      UNION ALL
      SELECT NULL::TIMESTAMP, count(*) FILTER (WHERE ts < TIMESTAMP '2024-01-01 00:00:00' OR ts IS NULL), FALSE
      FROM events""",
    "chunk_bounds": """
      WITH g AS (SELECT unnest(generate_series(
                   (SELECT date_trunc('year', min(o_orderdate))::TIMESTAMP FROM orders),
                   (SELECT max(o_orderdate) FROM orders), INTERVAL 1 MONTH)) AS lo)
      SELECT lo, lead(lo) OVER (ORDER BY lo) AS hi FROM g""",
    "chunk_grids": """
      WITH days AS (SELECT unnest(generate_series(TIMESTAMP '1995-01-01', TIMESTAMP '2001-08-15', INTERVAL 1 DAY)) AS d),
           worked AS (SELECT d, row_number() OVER (ORDER BY d) - 1 AS i,
                             d = max(d) OVER (PARTITION BY date_trunc('month', d)) AS last_one
                      FROM (SELECT unnest(generate_series(TIMESTAMP '1995-01-01', TIMESTAMP '2001-08-31', INTERVAL 1 DAY)) AS d)
                      WHERE isodow(d) < 6),
           points AS (
             SELECT '2W-MON' AS freq, d AS lo FROM days WHERE isodow(d) = 1 AND date_diff('day', TIMESTAMP '1995-01-02', d) % 14 = 0
             UNION ALL SELECT 'QS-FEB', d FROM days WHERE day(d) = 1 AND month(d) IN (2, 5, 8, 11)
             UNION ALL SELECT 'BME', d FROM worked WHERE last_one AND d <= TIMESTAMP '2001-08-15'
             UNION ALL SELECT '3B', d FROM worked WHERE i % 3 = 0 AND d <= TIMESTAMP '2001-08-15'
             UNION ALL SELECT 'YE-JUN', d FROM days WHERE month(d) = 6 AND day(d) = 30
             UNION ALL SELECT 'SMS', d FROM days WHERE day(d) IN (1, 15)
             UNION ALL SELECT 'WOM-2TUE', d FROM days WHERE isodow(d) = 2 AND day(d) BETWEEN 8 AND 14
             UNION ALL SELECT '1D12h', unnest(generate_series(TIMESTAMP '1995-01-01', TIMESTAMP '2001-08-15', INTERVAL 36 HOUR))),
           placed AS (SELECT f.freq, o.o_orderdate FROM orders o, (SELECT DISTINCT freq FROM points) f)
      SELECT a.freq, p.lo AS chunk_lo, count(*) AS n
      FROM placed a ASOF LEFT JOIN points p ON a.freq = p.freq AND a.o_orderdate >= p.lo
      GROUP BY a.freq, p.lo""",
    "geometry_text": """
      WITH v AS (SELECT *, o_custkey % 2000 - 1000 AS a, o_orderkey % 1000 - 500 AS b FROM orders),
           c AS (SELECT *, unnest([a, b, a + 1, a + 2, b + 3]) AS n, unnest([1, 2, 3, 4, 5]) AS i FROM v),
           t AS (SELECT o_orderkey, o_orderstatus, o_orderpriority,
                        list(CASE WHEN n < 0 THEN '-' ELSE '' END || abs(n) // 2 || CASE WHEN abs(n) % 2 = 1 THEN '.5' ELSE '' END
                             ORDER BY i) AS s
                 FROM c GROUP BY ALL),
           w AS (SELECT *, CASE WHEN o_orderstatus = 'O' THEN s[2] || ' ' || s[1] ELSE s[1] || ' ' || s[2] END AS p,
                        CASE WHEN o_orderstatus = 'O' THEN s[3] || ' ' || s[2] ELSE s[2] || ' ' || s[3] END AS q,
                        CASE WHEN o_orderstatus = 'O' THEN s[5] || ' ' || s[4] ELSE s[4] || ' ' || s[5] END AS r FROM t)
      SELECT CAST(o_orderkey AS DECIMAL(20,0)) AS "O_ORDERKEY",
             CASE WHEN o_orderpriority <> '1-URGENT' THEN
               CASE o_orderkey % 8
                 WHEN 0 THEN 'GEOMETRYCOLLECTION EMPTY' WHEN 1 THEN 'POINT(' || p || ')'
                 WHEN 2 THEN 'LINESTRING(' || p || ',' || q || ')'
                 WHEN 3 THEN 'POLYGON((' || p || ',' || q || ',' || r || ',' || p || '))'
                 WHEN 4 THEN 'MULTIPOINT((' || p || '),(' || q || '))'
                 WHEN 5 THEN 'MULTILINESTRING((' || p || ',' || q || '),(' || q || ',' || r || '))'
                 WHEN 6 THEN 'MULTIPOLYGON(((' || p || ',' || q || ',' || r || ',' || p || ')))'
                 ELSE 'GEOMETRYCOLLECTION(POINT(' || p || '),GEOMETRYCOLLECTION(LINESTRING(' || p || ',' || q || ')))' END
             END AS "SHAPE",
             CAST(CASE WHEN o_orderpriority <> '1-URGENT' THEN CASE WHEN o_orderstatus = 'O' THEN 4326 ELSE 0 END END
                  AS DECIMAL(11,0)) AS "SRID"
      FROM w""",
    "truncate_load": """
      SELECT CAST(n_nationkey AS DECIMAL(11,0)) AS "N_NATIONKEY", n_name AS "N_NAME",
             CAST(n_regionkey AS DECIMAL(11,0)) AS "N_REGIONKEY"
      FROM nation""",
    "ensure_table": """
      SELECT CAST(p_partkey AS DECIMAL(20,0)) AS "P_PARTKEY", p_name AS "P_NAME", p_brand AS "P_BRAND", p_type AS "P_TYPE",
             CAST(p_size AS DECIMAL(11,0)) AS "P_SIZE", p_retailprice AS "P_RETAILPRICE", TRUE AS "CREATED", FALSE AS "AGAIN"
      FROM part""",
    "drop_target": """
      SELECT TRUE AS existed_before, FALSE AS exists_after, count(*) AS rows_before FROM nation""",
    "append_target": """
      SELECT CAST(s_suppkey AS DECIMAL(20,0)) AS "S_SUPPKEY", s_name AS "S_NAME",
             CAST(s_nationkey AS DECIMAL(11,0)) AS "S_NATIONKEY", s_acctbal AS "S_ACCTBAL" FROM supplier
      UNION ALL
      SELECT CAST(s_suppkey + 100000 AS DECIMAL(20,0)), s_name, CAST(s_nationkey AS DECIMAL(11,0)), s_acctbal
      FROM supplier""",
    "tsv_load": "SELECT s_suppkey, s_name, s_nationkey, s_acctbal FROM supplier",
    "jdbc_scan": """
      SELECT o_orderkey, o_totalprice, o_orderdate FROM orders
      WHERE o_orderdate >= TIMESTAMP '1998-01-01 00:00:00' AND o_orderstatus = 'F'""",
    "append_jdbc": """
      SELECT s_suppkey, s_name FROM supplier
      UNION ALL SELECT s_suppkey + 100000, s_name FROM supplier""",
    "run_sql": """
      SELECT o_orderstatus, count(*) AS n FROM orders
      WHERE o_orderdate >= TIMESTAMP '1999-01-01 00:00:00' GROUP BY o_orderstatus""",
    "count_check_cutoff": """
      SELECT 'cutoff' AS rule, TIMESTAMP '2024-01-20 09:00:00' AS cutoff,
             count(*) FILTER (WHERE ts <= TIMESTAMP '2024-01-20 09:00:00') AS source_n,
             count(*) FILTER (WHERE ts <= TIMESTAMP '2024-01-20 09:00:00'
                                AND ts < TIMESTAMP '2024-01-20 06:00:00') AS target_n,
             count(*) FILTER (WHERE ts <= TIMESTAMP '2024-01-20 09:00:00'
                                AND ts < TIMESTAMP '2024-01-20 06:00:00')
               >= count(*) FILTER (WHERE ts <= TIMESTAMP '2024-01-20 09:00:00') AS ok
      FROM events""",
    "count_check_tolerance": """
      SELECT 'tolerance' AS rule, CAST(NULL AS TIMESTAMP) AS cutoff, count(*) AS source_n,
             count(*) FILTER (WHERE o_orderdate < TIMESTAMP '2001-07-15 00:00:00') AS target_n,
             count(*) FILTER (WHERE o_orderdate < TIMESTAMP '2001-07-15 00:00:00') + 1000 >= count(*) AS ok
      FROM orders""",
    "condition_met": "SELECT count(*) > 0 AS met FROM events WHERE event_type = 'error'",
    "replicate_first_load": """
      SELECT CAST(o_orderkey AS DECIMAL(20,0)) AS "O_ORDERKEY", CAST(o_custkey AS DECIMAL(20,0)) AS "O_CUSTKEY",
             o_orderstatus AS "O_ORDERSTATUS", o_totalprice AS "O_TOTALPRICE", o_orderdate AS "O_ORDERDATE",
             o_orderpriority AS "O_ORDERPRIORITY"
      FROM orders WHERE o_orderdate >= TIMESTAMP '1995-01-01 00:00:00'""",
    "replicate_merge": f"""
      WITH {_ORDERS_REPLICA}, merged AS ({_MERGED_ORDERS})
      SELECT CAST(o_orderkey AS DECIMAL(20,0)) AS "O_ORDERKEY", CAST(o_custkey AS DECIMAL(20,0)) AS "O_CUSTKEY",
             o_orderstatus AS "O_ORDERSTATUS", o_totalprice AS "O_TOTALPRICE", o_orderdate AS "O_ORDERDATE",
             o_orderpriority AS "O_ORDERPRIORITY"
      FROM merged""",
    "replicate_merge_partitioned": f"""
      WITH {_ORDERS_REPLICA}, merged AS ({_MERGED_ORDERS})
      SELECT CAST(o_orderkey AS DECIMAL(20,0)) AS "O_ORDERKEY", CAST(o_custkey AS DECIMAL(20,0)) AS "O_CUSTKEY",
             o_orderstatus AS "O_ORDERSTATUS", o_totalprice AS "O_TOTALPRICE", o_orderdate AS "O_ORDERDATE",
             o_orderpriority AS "O_ORDERPRIORITY", strftime(o_orderdate, '%Y-%m') AS "O_MONTH"
      FROM merged""",
    "replicate_merge_bucketed": f"""
      WITH {_ORDERS_REPLICA}, merged AS ({_MERGED_ORDERS})
      SELECT CAST(o_orderkey AS DECIMAL(20,0)) AS "O_ORDERKEY", CAST(o_custkey AS DECIMAL(20,0)) AS "O_CUSTKEY",
             o_orderstatus AS "O_ORDERSTATUS", o_totalprice AS "O_TOTALPRICE", o_orderdate AS "O_ORDERDATE",
             o_orderpriority AS "O_ORDERPRIORITY"
      FROM merged""",
    "replicate_merge_files": f"""
      WITH {_ORDERS_REPLICA}, merged AS ({_MERGED_ORDERS})
      SELECT CAST(o_orderkey AS DECIMAL(20,0)) AS "O_ORDERKEY", CAST(o_custkey AS DECIMAL(20,0)) AS "O_CUSTKEY",
             o_orderstatus AS "O_ORDERSTATUS", o_totalprice AS "O_TOTALPRICE", o_orderdate AS "O_ORDERDATE",
             o_orderpriority AS "O_ORDERPRIORITY"
      FROM merged""",
    "replicate_all": f"""
      WITH {_ORDERS_REPLICA}, whole(table_name, n) AS (
        SELECT '{DEMO_DB}.all_nation', count(*) FROM nation UNION ALL SELECT '{DEMO_DB}.all_region', count(*) FROM region
        UNION ALL SELECT '{DEMO_DB}.all_supplier', count(*) FROM supplier
        UNION ALL SELECT '{DEMO_DB}.all_customer', count(*) FROM customer)
      SELECT table_name, 'truncate' AS path, n AS rows_written, TRUE AS written, 0::BIGINT AS excluded, 'tolerance' AS check_rule,
             n AS source_n, n AS target_n, TRUE AS ok FROM whole
      UNION ALL
      SELECT '{DEMO_DB}.all_orders', 'merge', count(*), TRUE, 0, 'none', NULL, NULL, TRUE FROM delta
      UNION ALL
      SELECT '{DEMO_DB}.all_orders_late', 'first_load', count(*) FILTER (WHERE o_orderdate >= TIMESTAMP '1998-01-01 00:00:00'), TRUE,
             count(*) FILTER (WHERE o_orderdate < TIMESTAMP '1998-01-01 00:00:00' OR o_orderdate IS NULL), 'cutoff',
             count(*) FILTER (WHERE o_orderdate <= TIMESTAMP '2001-07-01 11:00:00'),
             count(*) FILTER (WHERE o_orderdate <= TIMESTAMP '2001-07-01 11:00:00' AND o_orderdate >= TIMESTAMP '1998-01-01 00:00:00'),
             FALSE FROM orders""",
}


def oracle_sql() -> dict[str, str]:
    if llm_queries is None:
        return dict(_ORACLES)
    whole = {"pipeline": corpus_pipeline.ORACLE_SQL} if corpus_pipeline.ORACLE_SQL else {}
    return {**_ORACLES, **llm_queries.ORACLES, **whole}
