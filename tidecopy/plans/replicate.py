"""One table's replication (S9) and many tables at once (V4).

``replicate_table`` chooses the load the way a scheduled copy job does:
merge into a table with rows, first (optionally chunked) load into an empty
one, full reload for truncate specs; then the count check. Everything heavy
is a Spark job; the driver holds the spec, a few scalars and the status row."""

from __future__ import annotations

import datetime as dt
import traceback
from decimal import Decimal
from concurrent.futures import ThreadPoolExecutor
from typing import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidecopy.functions.timeparts import lookback_start
from tidecopy.operators.checks import CountCheckError, count_check
from tidecopy.operators.incremental import incremental_filter, key_max, watermark_sql
from tidecopy.operators.project import conform, replace_fields
from tidecopy.operators.typemap import RULES, MappedColumn, mapped_columns
from tidecopy.sources.catalog import catalog_from_frames, column_catalog, jdbc_catalog, tables_from_frames
from tidecopy.sources.jdbc import JdbcTable, jdbc_count, key_range
from tidecopy.sources import counts, groups
from tidecopy.sources.splits import closed_by, high_water
from tidecopy.sources.target import (
    chunked_load, ensure_table, full_load, hold, merge_into_target, quoted, source_frame,
    store_key_max, stored_key_max,
)
from tidecopy.session import local_frame, stage
from tidecopy.spec import TableSpec

STATUS_SCHEMA = T.StructType([
    T.StructField("table_name", T.StringType()),
    T.StructField("load_type", T.StringType()),
    T.StructField("path", T.StringType()),
    T.StructField("created", T.BooleanType()),
    T.StructField("rows_read", T.LongType()),        # of the delta, or of the load
    T.StructField("rows_written", T.LongType()),     # upserted or loaded; 0 for a quiet run
    T.StructField("written", T.BooleanType()),       # was the target written at all
    T.StructField("excluded", T.LongType()),         # source rows that a chunked load left out
    T.StructField("check_rule", T.StringType()),
    T.StructField("source_n", T.LongType()),
    T.StructField("target_n", T.LongType()),
    T.StructField("ok", T.BooleanType()),
    T.StructField("error", T.StringType()),
])


def spec_columns(spark: SparkSession, spec: TableSpec, source: DataFrame | JdbcTable,
                 catalog: DataFrame | None = None, tables: DataFrame | None = None) -> list[MappedColumn]:
    """Mapped columns of the spec's source table: from the given catalog
    (information_schema rows) or, for a DataFrame source, from its schema."""
    dialect = "mysql"
    if isinstance(source, JdbcTable) and source.dialect in RULES:
        dialect = source.dialect
    elif catalog is not None:
        dialect = spec.source_database_type
    if catalog is None and isinstance(source, JdbcTable) and source.dialect in RULES:
        # the source's own information_schema, narrowed to the spec's schema in the source
        catalog, tables = jdbc_catalog(spark, source.url, source.properties, schema=spec.source_schema)
    if catalog is None:
        if not isinstance(source, DataFrame):
            raise ValueError("a JDBC source other than MySQL and PostgreSQL needs its catalog (see sources.catalog.jdbc_catalog)")
        frames = {spec.source_table_name: source}
        catalog = catalog_from_frames(spark, frames, table_schema=spec.source_schema)
        tables = tables_from_frames(spark, frames, table_schema=spec.source_schema)
    if tables is not None:
        catalog = column_catalog(catalog, tables, spec.source_schema, spec.source_table_name)
    else:
        catalog = catalog.where((F.col("table_schema") == spec.source_schema)
                                & (F.col("table_name") == spec.source_table_name))
    cols = mapped_columns(catalog, fold_case=spec.fold_case, dialect=dialect)
    if not cols:
        raise ValueError(f"no mapped columns for {spec.source}")
    return cols


def _target_keys(spec: TableSpec, columns: Sequence[MappedColumn]) -> list[str]:
    """Target key names; each must be the target column its paired source key
    maps to."""
    by_source = {c.source_name.lower(): c.target_name for c in columns}
    keys = []
    for s, t in zip(spec.source_main_fields, spec.target_main_fields):
        mapped = by_source.get(s.lower())
        if mapped is None:
            raise ValueError(f"key {s!r} is not a mapped source column")
        if mapped.lower() != t.lower():
            raise ValueError(f"source key {s!r} maps to {mapped!r}, not to target key {t!r}")
        keys.append(mapped)
    return keys


def _typed_key(text, dtype: T.DataType):
    """A stored key maximum (text) as a value of the key column's type."""
    if not isinstance(text, str) or isinstance(dtype, T.StringType):
        return text
    if isinstance(dtype, T.IntegralType):
        return int(Decimal(text))
    if isinstance(dtype, T.DecimalType):
        return Decimal(text)
    if isinstance(dtype, T.FractionalType):
        return float(text)
    if isinstance(dtype, T.DateType):
        return dt.date.fromisoformat(text)
    if isinstance(dtype, (T.TimestampType, T.TimestampNTZType)):
        return dt.datetime.fromisoformat(text)
    return text


def _larger(a, b):
    """max of the previous key maximum and the delta's."""
    if a is None or b is None:
        return b if a is None else a
    return max(a, b)


def replicate_table(spark: SparkSession, spec: TableSpec, source: DataFrame | JdbcTable, *,
                    run_date: dt.date | dt.datetime | str, now: dt.datetime | None = None,
                    catalog: DataFrame | None = None, tables: DataFrame | None = None,
                    until: dt.datetime | None = None, raise_on_check: bool = True, lease_wait: float = 0.0) -> dict:
    """Replicate one table; returns its status (see ``STATUS_SCHEMA``). The run holds the
    target's lease: a second run of the table waits up to ``lease_wait`` seconds for it,
    then raises ``LeaseHeld``."""
    with hold(spark, spec.target, wait=lease_wait) as lease:
        return _replicate(spark, spec, source, lease, run_date=run_date, now=now, catalog=catalog, tables=tables, until=until,
                          raise_on_check=raise_on_check)


def _replicate(spark, spec, source, lease, *, run_date, now, catalog, tables, until, raise_on_check) -> dict:
    lease.published.clear()
    now = now or dt.datetime.now()
    until = until or now
    columns = spec_columns(spark, spec, source, catalog, tables)
    target = spec.target
    parts = dict(spec.partition_by)
    buckets = (spec.bucket_count, _target_keys(spec, columns)) if spec.bucket_count else None
    group_by = (spec.group_rows, _target_keys(spec, columns)) if spec.group_rows else None
    created = ensure_table(spark, target, columns, partition_by=parts, bucket_by=buckets, grouped=bool(group_by))
    status = {"table_name": f"{spec.target_schema}.{spec.target_table_name}", "load_type": spec.load_type,
              "created": created}
    tname = quoted(target)
    # a JDBC source may grow while it is read: every statement is closed by the marks taken here
    closed = None
    if isinstance(source, JdbcTable):
        closed = closed_by(source, high_water(spark, source, list(spec.source_merge_columns)))

    first_key = spec.source_main_fields[0] if spec.source_main_fields else None

    def first_load() -> None:
        common = dict(replace=dict(spec.replace_fields_to), partition_by=parts, key=first_key,
                      key_splits=spec.source_partitions, bucket_by=buckets, group_by=group_by,
                      where=closed)
        if spec.source_freq is not None:
            report = chunked_load(spark, source, columns, target, column=spec.source_freq.column,
                                  freq=spec.source_freq.freq, start_year=spec.source_freq.start_year,
                                  until=until, include_rest=spec.source_freq.include_rest, **common)
            status["excluded"] = report.agg(F.coalesce(F.sum(F.when(~F.col("loaded"), F.col("n"))), F.lit(0))).first()[0]
        else:
            full_load(spark, source, columns, target, **common)
            status["excluded"] = 0

    # the target's counts as the last run left them; None if something else wrote since
    cutoff = spec.count_cutoff_column if dict(spec.source_merge_columns).get(spec.count_cutoff_column) == "datetime" else None
    cutoff = next((c.target_name for c in columns if cutoff and c.source_name.lower() == cutoff.lower()), None)
    known = None if created else counts.ledger(spark, spark.table(tname), lease, cutoff)

    if spec.load_type == "merge":
        current = spark.table(tname)
        before = known.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0] if known is not None else None
        has_rows = before > 0 if before is not None else bool(current.limit(1).count())
        if has_rows:
            keys = _target_keys(spec, columns)
            stored = stored_key_max(spark, target, keys[0])
            km = (_typed_key(stored, current.schema[keys[0]].dataType) if stored is not None
                  else key_max(current, keys[0]))
            before = current.count() if before is None else before
            since = lookback_start(run_date, spec.lookback_days)
            watermarks = dict(spec.source_merge_columns)
            replace = dict(spec.replace_fields_to)
            if isinstance(source, JdbcTable):
                # the source filters its raw columns and computes the replaced ones; the
                # read is split into key strides over the delta's own key range
                where = watermark_sql(source.quote, source.literal, watermarks, since, km)
                where = f"({where}) AND {closed}" if closed else where
                split = spec.source_partitions > 1
                delta = source_frame(spark, source, columns, replace=replace, where=where,
                                     partition_column=first_key if split else None, num_partitions=spec.source_partitions,
                                     bounds=key_range(spark, source, first_key, where) if split else None)
            else:
                delta = replace_fields(incremental_filter(source, watermarks, since, km), replace)
            delta = conform(delta, columns)
            merged = merge_into_target(spark, target, delta, keys, partition_by=parts, bucket_by=buckets, group_by=group_by)
            status.update(rows_read=merged["rows"], rows_written=merged["rows"], written=merged["written"], excluded=0)
            new_max = _larger(km, merged.get("key_max"))
            store_key_max(spark, target, keys[0], new_max)
            status["path"] = "merge"
        else:
            first_load()
            status["path"] = "first_load"
    else:
        first_load()
        status["path"] = "truncate"

    if status["path"] != "merge" or status["written"] or known is None:
        partition_columns = [groups.GROUP] if spec.group_rows else list(parts)
        # what the merge replaced is counted in the version it wrote, the rest is taken over
        known = counts.update(spark, spark.table(tname), lease, cutoff, partition_columns, known if status["path"] == "merge" else None)
    total = known.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0] if known is not None else spark.table(tname).count()
    if status["path"] != "merge":
        status.update(rows_read=total, rows_written=total, written=True)
    elif total < before:  # a merge never deletes
        raise CountCheckError(f"{status['table_name']}: the merge left {total} of {before} rows")
    src_frame = source_frame(spark, source, columns)
    counter = None
    if isinstance(source, JdbcTable):  # count in the source, do not pull rows
        counter = lambda col, upto: jdbc_count(spark, source, col, upto, closed)
    check = count_check(src_frame, spark.table(tname), dict(spec.source_merge_columns), now=now,
                        cutoff_column=spec.count_cutoff_column, tolerance=spec.count_tolerance,
                        source_counter=counter, target_counter=counts.counter(known) if known is not None else None).first()
    status.update(check_rule=check["rule"], source_n=check["source_n"], target_n=check["target_n"],
                  ok=check["ok"])
    if raise_on_check and not check["ok"]:
        raise CountCheckError(f"{status['table_name']}: target {check['target_n']} rows, "
                              f"source {check['source_n']} ({check['rule']})")
    return status


def jobs_from_configs(configs: Sequence[Mapping], connections: Mapping[str, tuple[str, Mapping[str, str]]], *,
                      default_connection: str | None = None) -> list[tuple[TableSpec, JdbcTable]]:
    """(spec, source) jobs from table configs: each config names its source
    connection (``source_jdbc_connection``), looked up in ``connections`` as
    (JDBC URL, properties); the source table is ``source_schema.source_table_name``."""
    jobs = []
    for conf in configs:
        spec = TableSpec.from_config(conf)
        name = spec.source_jdbc_connection or default_connection
        if name not in connections:
            raise ValueError(f"{spec.source}: unknown connection {name!r}")
        url, props = connections[name]
        jobs.append((spec, JdbcTable(url, spec.source, dict(props))))
    return jobs


def replicate_all(spark: SparkSession, jobs: Sequence[tuple[TableSpec, DataFrame | JdbcTable]], *,
                  run_date, now: dt.datetime | None = None, max_parallel: int = 8,
                  catalogs: Mapping[str, tuple[DataFrame, DataFrame]] | None = None,
                  lease_wait: float = 0.0) -> DataFrame:
    """Run every (spec, source) job, up to ``max_parallel`` at once, each in
    its own scheduler pool; a failing table is reported, not raised, and does
    not stop the others. Returns one status row per table.

    Tables read from the same MySQL or PostgreSQL schema share one read of its
    information_schema, staged once, instead of one read per table."""
    shared: dict[tuple[str, str], tuple[DataFrame, DataFrame]] = {}
    for spec, source in jobs:
        key = (getattr(source, "url", ""), spec.source_schema)
        if (isinstance(source, JdbcTable) and source.dialect in RULES and key not in shared
                and spec.source_table_name not in (catalogs or {})):
            try:
                cols, tabs = jdbc_catalog(spark, source.url, source.properties, schema=spec.source_schema)
                shared[key] = (stage(cols), stage(tabs))
            except Exception:  # leave it to the table's own run, which reports the error
                pass

    def run(job):
        spec, source = job
        try:
            sc = spark.sparkContext
            sc.setLocalProperty("spark.scheduler.pool", f"replicate_{spec.target_table_name}")
            sc.setJobGroup(f"replicate {spec.target_schema}.{spec.target_table_name}", spec.source, False)
        except Exception:  # Spark Connect: jobs are tagged instead
            spark.addTag(f"replicate_{spec.target_schema}_{spec.target_table_name}")
        cat, tabs = (catalogs or {}).get(spec.source_table_name, (None, None))
        if cat is None:
            cat, tabs = shared.get((getattr(source, "url", ""), spec.source_schema), (None, None))
        try:
            st = replicate_table(spark, spec, source, run_date=run_date, now=now, catalog=cat, tables=tabs,
                                 raise_on_check=False, lease_wait=lease_wait)
            st["error"] = None if st["ok"] else (
                f"count check ({st['check_rule']}): target {st['target_n']}, source {st['source_n']}")
        except Exception as exc:  # reported per table
            st = {"table_name": f"{spec.target_schema}.{spec.target_table_name}",
                  "load_type": spec.load_type, "ok": False,
                  "error": f"{type(exc).__name__}: {exc}".strip()}
            st.setdefault("path", None)
            traceback.clear_frames(exc.__traceback__)
        return st

    with ThreadPoolExecutor(max_workers=max(1, max_parallel)) as pool:
        statuses = list(pool.map(run, jobs))
    rows = [tuple(s.get(f.name) for f in STATUS_SCHEMA.fields) for s in statuses]
    return local_frame(spark, rows, STATUS_SCHEMA)
