"""Target tables (S3-S7, S10, S12): ordinary tables of the session catalog.

A load writes its rows to a new versioned folder under the table's lease (see
``versions``) and then changes what the catalog points to: the location of an
unpartitioned table, the locations of the partitions a merge has replaced. Queries see
the old rows until then and finish on the old files; a failed load leaves the table
untouched. Only where the table's columns, partitioning or buckets change, or all of a
partitioned table is loaded anew, two renames of catalog entries (no data moves) put
the new table in place. Before the first pointer changes, the intended change is noted
in ``publish/<version>``; the next holder of the lease finishes it if the run died."""

from __future__ import annotations

import datetime as dt
import json
import re
import time
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
from decimal import Decimal
from typing import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidecopy.functions.timeparts import chunk_start
from tidecopy.operators.incremental import chunk_list
from tidecopy.operators.project import conform, replace_fields
from tidecopy.operators.typemap import MappedColumn
from tidecopy.session import stage, unstage
from tidecopy.sources import groups, versions
from tidecopy.sources.jdbc import JdbcTable, jdbc_scan
from tidecopy.sources.versions import Lease, held, holding, partition_spec, partitions_in


# Rows per output file: one task (e.g. one JDBC chunk) can hold a month of a
# large table; cut its output into files readers can split and skip.
MAX_RECORDS_PER_FILE = 5_000_000


def split_name(name: str) -> tuple[str, str]:
    parts = [p.strip("`") for p in name.replace("`.`", ".").split(".")]
    if len(parts) != 2 or not all(parts):
        raise ValueError(f"target must be schema.table, got {name!r}")
    return parts[0], parts[1]


def quoted(name: str, suffix: str = "") -> str:
    db, tbl = split_name(name)
    return f"`{db}`.`{tbl}{suffix}`"


def target_exists(spark: SparkSession, name: str) -> bool:
    db, tbl = split_name(name)
    return spark.catalog.tableExists(f"`{db}`.`{tbl}`")


def struct_of(columns: Sequence[MappedColumn]) -> T.StructType:
    return T.StructType([T.StructField(c.target_name, T.DataType.fromDDL(c.spark_type))
                         for c in columns])


def ensure_table(spark: SparkSession, name: str, schema: T.StructType | Sequence[MappedColumn], *,
                 partition_by: Mapping[str, str] | None = None,
                 bucket_by: tuple[int, Sequence[str]] | None = None, grouped: bool = False) -> bool:
    """Create the schema and an empty table of the mapped types if the table is
    missing (with the ``partition_by`` columns, see ``with_partitions``).
    Returns True when it was created. An existing table is left as it is (no
    schema evolution)."""
    if target_exists(spark, name):
        return False
    with hold(spark, name) as lease:
        if target_exists(spark, name):
            return False
        struct = schema if isinstance(schema, T.StructType) else struct_of(schema)
        if grouped:
            partition_by = {groups.GROUP: "cast(0 AS int)"}
        empty = with_partitions(spark.createDataFrame([], struct), partition_by)
        path = lease.version()
        if lease.files is not None:
            lease.files.make(path)
        _publish(spark, name, lease, path, _shape(empty.schema, list(partition_by or ()), bucket_by))
    return True


def with_partitions(df: DataFrame, partition_by: Mapping[str, str] | None) -> DataFrame:
    """Add the partition columns ``{name: SQL expression over the row}``.

    The expressions must give every version of a row the same value (derive
    them from the key, or from columns that never change): a merge then finds
    a key's target row inside the partitions its delta rows fall in. An empty
    string is stored as NULL, as partition folders can't tell the two apart."""
    if not partition_by:
        return df
    df = df.withColumns({c: F.expr(e) for c, e in partition_by.items()})
    texts = [c for c in partition_by if isinstance(df.schema[c].dataType, T.StringType)]
    return df.withColumns({c: F.nullif(F.col(f"`{c}`"), F.lit("")) for c in texts}) if texts else df


def _root(spark: SparkSession, name: str) -> str:
    """The folder of a table's versions (the database must exist)."""
    db, tbl = split_name(name)
    return f"{spark.catalog.getDatabase(db).locationUri.rstrip('/')}/_tidecopy/{tbl.lower()}"


@contextmanager
def hold(spark: SparkSession, name: str, *, wait: float = 0.0, seconds: float | None = None):
    """The lease of a target for the block: no other run can load it meanwhile. Waits up to
    ``wait`` seconds for another run, then raises ``LeaseHeld``. Loads take it themselves;
    hold it around several steps that belong together."""
    inner = holding(name)
    if inner is not None:
        yield inner
        return
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{split_name(name)[0]}`")
    with held(spark, name, _root(spark, name), wait=wait, seconds=seconds or versions.LEASE_SECONDS,
              on_take=lambda lease: _tidy(spark, name, lease)) as lease:
        yield lease


def drop_target(spark: SparkSession, name: str) -> bool:
    """DROP TABLE IF EXISTS, with all versions of its rows. True if it existed."""
    if not spark.catalog.databaseExists(split_name(name)[0]):
        return False
    with hold(spark, name) as lease:
        existed = target_exists(spark, name)
        spark.sql(f"DROP TABLE IF EXISTS {quoted(name)}")
        if lease.files is not None:
            for part in ("v", "index", "counts", "publish", "retired", "shape"):
                lease.files.delete(f"{lease.root}/{part}")
    return existed


def recover(spark: SparkSession, name: str) -> None:
    """Finish what a run that died was publishing and delete what it wrote and never
    published. Every load does this when it takes the lease; raises ``LeaseHeld`` while
    another run is at work."""
    if spark.catalog.databaseExists(split_name(name)[0]):
        with hold(spark, name):
            pass


def _tidy(spark: SparkSession, name: str, lease: Lease) -> None:
    """Under a lease just taken: nothing else writes to the table's folder. Only that
    folder and the staged catalog entries that its notes name are touched."""
    files, root = lease.files, lease.root
    notes = set(files.names(f"{root}/publish"))
    for version in sorted(n for n in notes if not n.endswith(".done") and f"{n}.done" not in notes):
        try:
            note = json.loads(files.read(f"{root}/publish/{version}"))
        except ValueError:  # cut off: nothing was changed yet
            files.delete(f"{root}/publish/{version}")
            notes.discard(version)
            continue
        _switch(spark, name, lease, note)
    for part in ("v", "index"):
        for version in files.names(f"{root}/{part}"):
            if version.removesuffix(".whole") not in notes:
                files.delete(f"{root}/{part}/{version}")
    for noted in files.names(f"{root}/retired"):
        if int(noted.split("_")[0]) / 1000 + versions.KEEP_SECONDS < time.time():
            for path in files.read(f"{root}/retired/{noted}").splitlines():
                files.delete(path)
                version = path.removeprefix(f"{root}/v/")
                if "/" not in version:
                    files.delete(f"{root}/publish/{version}")
                    files.delete(f"{root}/publish/{version}.done")
            files.delete(f"{root}/retired/{noted}")


def _shape(schema: T.StructType, partition_by: Sequence[str], bucket_by: tuple[int, Sequence[str]] | None) -> dict:
    return {"columns": [[f.name, f.dataType.simpleString()] for f in schema.fields], "partition_by": list(partition_by),
            "bucket_by": [bucket_by[0], list(bucket_by[1])] if bucket_by else None}


def _literal(text: str) -> str:
    return text.replace("\\", "\\\\").replace("'", "\\'")


def _create(spark: SparkSession, table: str, path: str, shape: dict) -> None:
    """A catalog entry (metadata only) over the rows in ``path``."""
    names = lambda cols: ", ".join(f"`{c}`" for c in cols)
    ddl = f"CREATE TABLE {table} ({', '.join(f'`{c}` {t}' for c, t in shape['columns'])}) USING parquet"
    if shape["partition_by"]:
        ddl += f" PARTITIONED BY ({names(shape['partition_by'])})"
    if shape["bucket_by"]:
        n, keys = shape["bucket_by"]
        ddl += f" CLUSTERED BY ({names(keys)}) SORTED BY ({names(keys)}) INTO {n} BUCKETS"
    spark.sql(f"{ddl} LOCATION '{_literal(path)}'")
    if shape["partition_by"]:
        spark.sql(f"MSCK REPAIR TABLE {table}")


def _publish(spark: SparkSession, name: str, lease: Lease, path: str, shape: dict, *, partitions: bool = False) -> None:
    """Make the rows in ``path`` the table's, or with ``partitions`` the content of the partitions they fall in."""
    lease.check()
    version = path.rsplit("/", 1)[1]
    note = {"path": path, "shape": shape, "partitions": partitions, "stamp": f"{lease.fence:012d}_{version.split('_')[1]}"}
    if lease.files is not None:
        lease.files.write(f"{lease.root}/publish/{version}", json.dumps(note))
    _switch(spark, name, lease, note)
    lease.published.append((path, partitions))


def _switch(spark: SparkSession, name: str, lease: Lease, note: dict) -> None:
    """Change the catalog as noted. Every step may be done already: a note is followed again after a crash."""
    path, shape, files = note["path"], note["shape"], lease.files
    table, staged, old = (quoted(name, s) for s in ("", f"__tidecopy_{note['stamp']}", f"__tidecopy_{note['stamp']}_old"))
    keep = []
    if note["partitions"]:
        keep = _switch_partitions(spark, name, lease, path, shape)
    elif not shape["partition_by"] and target_exists(spark, name) and _has_shape(spark, name, lease, shape):
        spark.sql(f"ALTER TABLE {table} SET LOCATION '{_literal(path)}'")
    else:
        db, tbl = split_name(name)
        there = lambda suffix: spark.catalog.tableExists(f"`{db}`.`{tbl}{suffix}`")
        mark = f"__tidecopy_{note['stamp']}"
        if there(mark + "_old"):            # died between the renames, or after them
            if there(mark):
                spark.sql(f"ALTER TABLE {staged} RENAME TO {table}")
        elif not there("") or not _points_to(spark, name, path):
            spark.sql(f"DROP TABLE IF EXISTS {staged}")
            _create(spark, staged, path, shape)
            if there(""):
                spark.sql(f"ALTER TABLE {table} RENAME TO {old}")
            spark.sql(f"ALTER TABLE {staged} RENAME TO {table}")
        spark.sql(f"DROP TABLE IF EXISTS {old}")
    if not note["partitions"] and files is not None:
        files.write(f"{lease.root}/shape", json.dumps(shape))
    spark.catalog.refreshTable(table)
    if files is not None:
        version = path.rsplit("/", 1)[1]
        if note["partitions"]:
            lease.retire(keep)
        else:
            known = {p for n in files.names(f"{lease.root}/retired") for p in files.read(f"{lease.root}/retired/{n}").splitlines()}
            shown = set(files.names(f"{lease.root}/publish"))
            gone = [f"{lease.root}/v/{v}" for v in files.names(f"{lease.root}/v") if v != version and f"{v}.done" in shown]
            gone += [f"{lease.root}/index/{v}" for v in files.names(f"{lease.root}/index") if v.removesuffix(".whole") != version]
            lease.retire([p for p in gone if p not in known])
        files.write(f"{lease.root}/publish/{version}.done", "")


def _points_to(spark: SparkSession, name: str, path: str) -> bool:
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {quoted(name)}").where("col_name = 'Location'").collect()
    strip = lambda p: re.sub("^file:/+", "/", p).rstrip("/")
    return bool(rows) and strip(rows[-1]["data_type"]) == strip(path)


def _has_shape(spark: SparkSession, name: str, lease: Lease, shape: dict) -> bool:
    """Do the table's columns and layout stay, so that a new location is all it takes?"""
    if lease.files is None or not lease.files.exists(f"{lease.root}/shape"):
        return False
    now = [[f.name, f.dataType.simpleString()] for f in spark.table(quoted(name)).schema.fields]
    return json.loads(lease.files.read(f"{lease.root}/shape")) == shape and now == shape["columns"]


def _switch_partitions(spark: SparkSession, name: str, lease: Lease, path: str, shape: dict) -> list[str]:
    """Point the partitions that ``path`` holds there; returns the folders they pointed to."""
    table, files = quoted(name), lease.files
    if files is None:  # no folder listing at hand: rows are copied into their partitions
        _overwrite_partitions(spark, name, path)
        return []
    parts = partitions_in(files, path, len(shape["partition_by"]))
    have = {r[0] for r in spark.sql(f"SHOW PARTITIONS {table}").collect()}
    where = lambda p: _literal(f"{path}/{p}")
    new = [p for p in parts if p not in have]
    for i in range(0, len(new), 200):
        spark.sql(f"ALTER TABLE {table} ADD IF NOT EXISTS " + " ".join(f"{partition_spec(p)} LOCATION '{where(p)}'" for p in new[i:i + 200]))
    with ThreadPoolExecutor(8) as pool:     # one catalog call per partition
        list(pool.map(lambda p: spark.sql(f"ALTER TABLE {table} {partition_spec(p)} SET LOCATION '{where(p)}'"),
                      [p for p in parts if p in have]))
    return [f for p in parts for f in files.glob(f"{lease.root}/v/*/{p}") if f"/v/{path.rsplit('/', 1)[1]}/" not in f]


def _write(df: DataFrame, name: str, lease: Lease, path: str, partition_by: Sequence[str] | None,
           bucket_by: tuple[int, Sequence[str]] | None) -> None:
    """Rows to a version's folder. Bucketed files are named by the table writer, so they
    go through a staged catalog entry, dropped again (it is external: the files stay)."""
    writer = df.write.format("parquet").option("maxRecordsPerFile", MAX_RECORDS_PER_FILE)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    try:
        if not bucket_by:
            writer.save(path)
        else:
            staged = quoted(name, f"__tidecopy_{lease.fence:012d}_{lease.run}_rows")
            writer.bucketBy(bucket_by[0], *bucket_by[1]).sortBy(*bucket_by[1]).option("path", path).saveAsTable(staged)
            df.sparkSession.sql(f"DROP TABLE IF EXISTS {staged}")
    except Exception:
        lease.discard(path)
        raise


def write_swap(df: DataFrame, name: str, *, partition_by: Sequence[str] | None = None,
               bucket_by: tuple[int, Sequence[str]] | None = None, aligned: bool = False, merge: bool = False,
               group_by: tuple[int, Sequence[str]] | None = None) -> None:
    """Write ``df`` as the new content of ``name``: a new version, then the pointer.

    With ``group_by`` = (rows, keys) the rows are dealt to file groups and indexed, so
    that merges rewrite only the groups they touch (see ``groups``).

    A partitioned write is rebalanced on the partition columns first: AQE
    packs small partitions into few files and splits a hot one across tasks.
    A bucketed write (``bucket_by`` = (n, key columns)) is hash-partitioned on
    the keys into n tasks first, one file per bucket, unless the rows are
    ``aligned`` already (a merge over a bucketed target). A key maximum that a merge
    recorded is forgotten, but by a ``merge`` itself."""
    spark = df.sparkSession
    staged = None
    with hold(spark, name) as lease:
        if group_by:
            df, staged = groups.dealt(df, group_by[1], group_by[0])
            partition_by = [groups.GROUP]
        elif bucket_by and not aligned:
            df = df.repartition(bucket_by[0], *[F.col(f"`{c}`") for c in bucket_by[1]])
        elif partition_by and not bucket_by:
            df = df.hint("rebalance", *partition_by)
        path = lease.version()
        _write(df, name, lease, path, partition_by, bucket_by)
        if group_by:
            groups.write_index(lease, path, group_by[1], group_by[0], spark, df.schema, True)
            unstage(staged)
        _publish(spark, name, lease, path, _shape(df.schema, partition_by or (), bucket_by))
        if not merge:
            _forget_key_max(spark, name)


def select_list(source: JdbcTable, columns: Sequence[MappedColumn], replace: Mapping[str, str] | None = None) -> str:
    """What the source is asked for: each mapped column under its own name, as its
    ``replace`` expression (in the source's dialect, so a masked column leaves the
    source masked), for MySQL and PostgreSQL as its conversion (binary, geometry, arrays), or as it is."""
    replace = {k.lower(): v for k, v in (replace or {}).items()}
    unknown = sorted(set(replace) - {c.source_name.lower() for c in columns})
    if unknown:
        raise ValueError(f"replace_fields names unknown columns: {unknown}")
    plain = lambda c: c.load_expr if source.dialect == c.dialect else source.quote(c.source_name)
    return ", ".join(f"{replace.get(c.source_name.lower()) or plain(c)} AS {source.quote(c.source_name)}" for c in columns)


def source_frame(spark: SparkSession, source: DataFrame | JdbcTable, columns: Sequence[MappedColumn], *,
                 replace: Mapping[str, str] | None = None, where: str | None = None,
                 predicates: Sequence[str] | None = None, partition_column: str | None = None,
                 num_partitions: int | None = None, bounds: tuple | None = None) -> DataFrame:
    """Source rows with the mapped columns. ``replace`` swaps columns for expressions:
    in Spark for a DataFrame, in the source's own select list for JDBC. ``where``
    (source dialect, over the raw columns) narrows a JDBC read; it is split by
    ``predicates`` or by key strides (see ``jdbc_scan``)."""
    if isinstance(source, DataFrame):
        return replace_fields(source, dict(replace or {}))
    split = dict(predicates=predicates, partition_column=partition_column, num_partitions=num_partitions,
                 bounds=bounds)
    if replace or where or any(c.dialect == source.dialect for c in columns):
        tail = f" where {where}" if where else ""
        return jdbc_scan(spark, source, query=f"select {select_list(source, columns, replace)} from {source.table}{tail}",
                         **(split | ({"where": where} if where else {})))
    return jdbc_scan(spark, source, columns=[c.source_name for c in columns], **split)


def full_load(spark: SparkSession, source: DataFrame | JdbcTable, columns: Sequence[MappedColumn],
              target: str, *, replace: dict[str, str] | None = None,
              partition_by: Mapping[str, str] | None = None, key: str | None = None, key_splits: int = 1,
              bucket_by: tuple[int, Sequence[str]] | None = None,
              group_by: tuple[int, Sequence[str]] | None = None, where: str | None = None) -> DataFrame:
    """Replace the target's rows with the whole source (of a JDBC source the rows of
    ``where``, its own SQL), conformed; returns the target table. With ``key`` and ``key_splits`` > 1 a JDBC source is read in that
    many key strides at once (see ``jdbc_scan``)."""
    frame = source_frame(spark, source, columns, replace=replace, where=where, partition_column=key, num_partitions=key_splits)
    write_swap(with_partitions(conform(frame, columns), partition_by), target,
               partition_by=list(partition_by or ()), bucket_by=bucket_by, group_by=group_by)
    return spark.table(quoted(target))


def chunk_conditions(source: JdbcTable, column: str, bounds: Sequence[tuple]) -> list[str]:
    q = source.quote(column)
    return [f"{q} >= {source.literal(lo)}" + (f" AND {q} < {source.literal(hi)}" if hi is not None else "") for lo, hi in bounds]


def chunk_predicates(source: JdbcTable, column: str, bounds: Sequence[tuple], *,
                     include_rest: bool = False, key: str | None = None,
                     key_ranges: Sequence[tuple] | None = None, key_splits: int = 1,
                     key_cuts: Sequence[Sequence] | None = None) -> list[str]:
    """Source-dialect predicates, one per chunk (the last one open).

    With ``key`` each chunk is cut further into key strides: at ``key_cuts[i]`` (even
    counts, from ``splits.even_cuts``), or with ``key_splits`` > 1 evenly in its key
    range ``key_ranges[i]`` = (min, max). The first stride is open below (NULL keys
    included) and the last open above, so the strides of a chunk always cover all its rows."""
    from tidecopy.sources.splits import stride_predicates

    q = source.quote(column)
    preds = []
    for i, chunk in enumerate(chunk_conditions(source, column, bounds)):
        if key is not None and key_cuts is not None:
            preds += stride_predicates(source, key, key_cuts[i], within=chunk) if key_cuts[i] else [chunk]
            continue
        rng = key_ranges[i] if key_ranges else None
        numeric = bool(rng) and all(isinstance(v, (int, float, Decimal)) and not isinstance(v, bool) for v in rng)
        if key is None or key_splits <= 1 or not numeric or rng[1] <= rng[0]:
            preds.append(chunk)
            continue
        k = source.quote(key)
        kmin, kmax = rng
        step = (kmax - kmin) / key_splits
        cuts = sorted({kmin + int(step * j) for j in range(1, key_splits)} - {kmin})
        edges = [None, *cuts, None]
        for a, b in zip(edges, edges[1:]):
            parts = []
            if a is not None:
                parts.append(f"{k} >= {source.literal(a)}")
            if b is not None:
                parts.append(f"({k} < {source.literal(b)} OR {k} IS NULL)" if a is None
                             else f"{k} < {source.literal(b)}")
            preds.append(f"({chunk}) AND " + " AND ".join(parts))
    if include_rest:
        preds.append(f"{q} < {source.literal(bounds[0][0])} OR {q} IS NULL")
    return preds


def chunk_key_ranges(spark: SparkSession, source: JdbcTable, column: str, key: str,
                     bounds: Sequence[tuple], where: str | None = None) -> list[tuple]:
    """(min, max) of ``key`` in every chunk, from ONE grouped statement the
    source runs (its size is set by the number of chunks, not the data)."""
    from tidecopy.sources.jdbc import jdbc_query

    q, k = source.quote(column), source.quote(key)
    case = " ".join(f"WHEN {q} >= {source.literal(lo)} THEN {i}" for i, (lo, _) in reversed(list(enumerate(bounds))))
    rows = jdbc_query(spark, source, f"SELECT chunk_no, min({k}) AS kmin, max({k}) AS kmax FROM "
                                     f"(SELECT CASE {case} END AS chunk_no, {k} FROM {source.table}{f' WHERE {where}' if where else ''}) c "
                                     f"WHERE chunk_no IS NOT NULL GROUP BY chunk_no").collect()
    found = {int(r[0]): (r[1], r[2]) for r in rows}
    return [found.get(i) for i in range(len(bounds))]


def chunked_load(spark: SparkSession, source: DataFrame | JdbcTable, columns: Sequence[MappedColumn],
                 target: str, *, column: str, freq: str, start_year: int, until: dt.datetime,
                 include_rest: bool = False, replace: dict[str, str] | None = None,
                 partition_by: Mapping[str, str] | None = None, key: str | None = None,
                 key_splits: int = 1, bucket_by: tuple[int, Sequence[str]] | None = None,
                 group_by: tuple[int, Sequence[str]] | None = None, where: str | None = None) -> DataFrame:
    """First load cut into ``freq`` ranges of ``column`` from Jan 1 of
    ``start_year``; the last range is open-ended. A JDBC source is read with
    one partition (one bounded source statement) per range, all in one job.
    Rows before the first boundary or with NULL in ``column`` are loaded only
    with ``include_rest``. With a numeric ``key`` and ``key_splits`` > 1 every
    JDBC chunk is also cut into key strides of about equal counts, so a large
    chunk is read by several tasks. ``where`` (the source's SQL) closes a JDBC read
    and all its counts, e.g. by a high-water mark. Returns the load report: loaded rows per
    chunk (``chunk_report``) and, unless ``include_rest``, one row with the
    number of source rows left out (``excluded_count``)."""
    bounds = chunk_list(spark, start_year, freq, until)
    if isinstance(source, DataFrame):
        frame = source
        if not include_rest:
            first = F.lit(bounds[0][0].isoformat(sep=" ")).cast(source.schema[column].dataType)
            frame = frame.where(F.col(f"`{column}`") >= first)
        frame = replace_fields(frame, replace)
    else:
        from tidecopy.sources.splits import even_cuts

        cuts = None
        if key is not None and key_splits > 1:
            ranges = chunk_key_ranges(spark, source, column, key, bounds, where)
            cuts = even_cuts(spark, source, key, key_splits, ranges=ranges, slices=chunk_conditions(source, column, bounds), where=where)
        preds = chunk_predicates(source, column, bounds, include_rest=include_rest, key=key, key_cuts=cuts)
        frame = source_frame(spark, source, columns, replace=replace, where=where, predicates=preds)
    write_swap(with_partitions(conform(frame, columns), partition_by), target,
               partition_by=list(partition_by or ()), bucket_by=bucket_by, group_by=group_by)
    tcol = next(c.target_name for c in columns if c.source_name.lower() == column.lower())
    report = chunk_report(spark.table(quoted(target)), tcol, freq, bounds[0][0], bounds[-1][0])
    if include_rest:
        return report
    return report.unionByName(excluded_count(spark, source, column, bounds[0][0], where))


def chunk_report(df: DataFrame, column: str, freq: str, first: dt.datetime, last: dt.datetime) -> DataFrame:
    """Loaded rows per chunk ``(chunk_lo, n, loaded)``; loaded rows outside
    every chunk have ``chunk_lo`` NULL."""
    lo = chunk_start(F.col(f"`{column}`"), freq, first, last)
    return df.groupBy(lo.alias("chunk_lo")).agg(F.count(F.lit(1)).alias("n"), F.lit(True).alias("loaded"))


def excluded_count(spark: SparkSession, source: DataFrame | JdbcTable, column: str, first: dt.datetime,
                   where: str | None = None) -> DataFrame:
    """One report row ``(NULL, n, false)``: source rows a chunked load leaves
    out (before the first boundary, or NULL in the chunk column), counted by
    the source for a JDBC table, by a one-column aggregate otherwise."""
    if isinstance(source, DataFrame):
        c = F.col(f"`{column}`")
        cond = c.isNull() | (c < F.lit(first.isoformat(sep=" ")).cast(source.schema[column].dataType))
        counted = source.agg(F.count(F.when(cond, F.lit(1))).alias("n"))
    else:
        from tidecopy.sources.jdbc import jdbc_query

        q = source.quote(column)
        counted = jdbc_query(spark, source, f"SELECT count(*) AS n FROM {source.table} "
                                            f"WHERE ({q} < {source.literal(first)} OR {q} IS NULL)"
                                            + (f" AND ({where})" if where else ""))
    return counted.select(F.lit(None).cast("timestamp_ntz").alias("chunk_lo"), F.col("n").cast("bigint").alias("n"),
                          F.lit(False).alias("loaded"))


def truncate_load(spark: SparkSession, source: DataFrame | JdbcTable, columns: Sequence[MappedColumn],
                  target: str, *, chunk=None, until: dt.datetime | None = None,
                  replace: dict[str, str] | None = None,
                  partition_by: Mapping[str, str] | None = None, key: str | None = None, key_splits: int = 1,
                  bucket_by: tuple[int, Sequence[str]] | None = None,
                  group_by: tuple[int, Sequence[str]] | None = None) -> DataFrame:
    """Reload the target from scratch, chunked when a chunk spec is given.
    The old rows stay readable until the swap."""
    if chunk is not None:
        chunked_load(spark, source, columns, target, column=chunk.column, freq=chunk.freq,
                     start_year=chunk.start_year, until=until or dt.datetime.now(), replace=replace,
                     include_rest=chunk.include_rest, partition_by=partition_by, key=key, key_splits=key_splits,
                     bucket_by=bucket_by, group_by=group_by)
        return spark.table(quoted(target))
    return full_load(spark, source, columns, target, replace=replace, partition_by=partition_by,
                     key=key, key_splits=key_splits, bucket_by=bucket_by, group_by=group_by)


def merge_into_target(spark: SparkSession, target: str, delta: DataFrame, keys: Sequence[str], *,
                      partition_by: Mapping[str, str] | None = None,
                      bucket_by: tuple[int, Sequence[str]] | None = None,
                      group_by: tuple[int, Sequence[str]] | None = None) -> dict:
    """Upsert ``delta`` (target columns, no partition columns) into the target
    table by ``keys``.

    Unpartitioned target: merge everything into a new version.
    Partitioned target: only the partitions the delta falls in are read (their
    range and a join with them prune the scan), merged and written once, to new
    folders that the partitions then point to; every other partition's files stay
    as they are. A run that dies while the pointers change is finished by the next.

    Grouped target (``group_by`` = (rows, keys)): the index picks the file groups that
    hold keys of the delta; only those are read and written (see ``groups``).

    Bucketed target (``bucket_by`` = (n, keys)): the target is read already
    hash-partitioned on the keys, so a large delta is shuffled to the buckets
    and the target is not shuffled at all; new rows are aligned to the buckets
    before the write.

    Returns rows, bytes, key_max and broadcast of the delta, ``written``, and
    ``before``: the rows of the target that were read to be merged."""
    with hold(spark, target) as lease:
        if group_by:
            return _merge_groups(spark, target, delta, keys, group_by[0], lease)
        return _merge(spark, target, delta, keys, partition_by, bucket_by, lease)


def _merge(spark, target, delta, keys, partition_by, bucket_by, lease) -> dict:
    from tidecopy.operators.merge import merge_upsert

    current = spark.table(quoted(target))
    stats: dict = {}
    align = bucket_by[0] if bucket_by else None
    # the delta is read from the source once; an empty one changes nothing, so
    # a quiet run writes nothing at all
    delta = stage(with_partitions(delta, partition_by).select(*current.columns))
    try:
        if not partition_by:
            merged = merge_upsert(current, delta, keys, stage_delta=False, stats=stats, align=align)
            if stats["rows"]:
                write_swap(merged, target, bucket_by=bucket_by, aligned=True, merge=True)
            return {"partitions": None if stats["rows"] else 0, "written": bool(stats["rows"]), **stats}
        touched = stage(delta.select(*partition_by).distinct())
        try:
            n = touched.count()
            merged = merge_upsert(_in_partitions(current, touched), delta, keys, stage_delta=False, stats=stats, align=align)
            if not n:
                return {"partitions": 0, "written": False, **stats}
            path = lease.version()
            _write(merged if bucket_by else merged.hint("rebalance", *partition_by), target, lease, path, list(partition_by), bucket_by)
            _publish(spark, target, lease, path, _shape(current.schema, list(partition_by), bucket_by), partitions=True)
            return {"partitions": n, "written": True, **stats}
        finally:
            unstage(touched)
    finally:
        unstage(delta)


def _merge_groups(spark: SparkSession, target: str, delta: DataFrame, keys: Sequence[str], group_rows: int, lease: Lease) -> dict:
    current = spark.table(quoted(target))
    types = {f.name: f.dataType for f in current.schema.fields if f.name != groups.GROUP}
    delta = stage(delta.select(*[F.col(f"`{c}`").cast(t).alias(c) for c, t in types.items()]))

    def write(rows: DataFrame) -> None:
        path = lease.version()
        _write(rows.hint("rebalance", groups.GROUP), target, lease, path, [groups.GROUP], None)
        groups.write_index(lease, path, keys, group_rows, spark, rows.schema, False)
        _publish(spark, target, lease, path, _shape(rows.schema, [groups.GROUP], None), partitions=True)
        groups.compact(spark, lease, path.rsplit("/", 1)[1])

    try:
        return groups.merge_grouped(spark, current, delta, keys, group_rows, lease, write)
    finally:
        unstage(delta)


def _in_partitions(current: DataFrame, touched: DataFrame) -> DataFrame:
    """Rows of the target in the touched partitions. Values are joined by plain
    equality (so Spark prunes the scan to the joined partitions) behind the range of the
    first column, which prunes the listing; rows with a NULL partition value, which
    equality can't find, are taken by a NULL-safe join of their own."""
    pcols = touched.columns
    first = F.col(f"`{pcols[0]}`")
    lo, hi, nulls = touched.agg(F.min(first), F.max(first), F.count(F.when(_any_null(pcols), F.lit(1)))).first()
    out = current.where(F.lit(False))
    if lo is not None:
        dtype = current.schema[pcols[0]].dataType
        inside = first.between(F.lit(lo).cast(dtype), F.lit(hi).cast(dtype))
        out = current.where(inside).join(touched.where(inside), pcols, "left_semi")
    if nulls:
        t = touched.where(_any_null(pcols)).toDF(*[f"__t_{c}" for c in pcols])
        out = out.unionByName(current.where(_any_null(pcols)).join(
            t, [F.col(f"`{c}`").eqNullSafe(F.col(f"`__t_{c}`")) for c in pcols], "left_semi"))
    return out


def _any_null(columns: Sequence[str]):
    cond = F.lit(False)
    for c in columns:
        cond = cond | F.col(f"`{c}`").isNull()
    return cond


# Table property holding the key maximum a merge left behind.
KEY_MAX_PROPERTY = "tidecopy.key_max."


def stored_key_max(spark: SparkSession, name: str, column: str):
    """The key maximum recorded by the last merge, as text, or None. A
    rewritten table (full, chunked, truncate load) starts without one."""
    props = {r["key"]: r["value"] for r in spark.sql(f"SHOW TBLPROPERTIES {quoted(name)}").collect()}
    return props.get(KEY_MAX_PROPERTY + column.upper())


def store_key_max(spark: SparkSession, name: str, column: str, value) -> None:
    """Record the key maximum so the next run need not scan the key column.
    A merge never deletes, so max(before, delta) is the new maximum; a value
    lower than the truth only widens the next delta, never loses rows."""
    key = KEY_MAX_PROPERTY + column.upper()
    if value is None:
        spark.sql(f"ALTER TABLE {quoted(name)} UNSET TBLPROPERTIES IF EXISTS ('{key}')")
    else:
        text = str(value).replace("\\", "\\\\").replace("'", "\\'")
        spark.sql(f"ALTER TABLE {quoted(name)} SET TBLPROPERTIES ('{key}' = '{text}')")


def _forget_key_max(spark: SparkSession, name: str) -> None:
    for prop in spark.sql(f"SHOW TBLPROPERTIES {quoted(name)}").collect():
        if prop["key"].startswith(KEY_MAX_PROPERTY):
            spark.sql(f"ALTER TABLE {quoted(name)} UNSET TBLPROPERTIES IF EXISTS ('{prop['key']}')")


def _overwrite_partitions(spark: SparkSession, target: str, path: str) -> None:
    """Replace the target's partitions that ``path`` has rows for, by copying; no other.

    Dynamic overwrite is a session setting (a writer option is not read by
    ``insertInto``), so the insert runs in a session of its own on the same
    catalog: nothing changes for the caller's session or its other threads."""
    schema = spark.table(quoted(target)).schema
    own = spark.newSession()
    own.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
    own.conf.set("spark.sql.session.timeZone", spark.conf.get("spark.sql.session.timeZone"))
    own.conf.set("spark.sql.shuffle.partitions", spark.conf.get("spark.sql.shuffle.partitions"))
    rows = own.read.schema(schema).parquet(path).select(*[F.col(f"`{c}`") for c in schema.names])
    rows.write.insertInto(quoted(target), overwrite=True)
    spark.catalog.refreshTable(quoted(target))


def append_target(df: DataFrame, name: str, columns: Sequence[str] | None = None, *,
                  partition_by: Mapping[str, str] | None = None) -> None:
    """Append rows. ``columns`` names the target columns the DataFrame's
    columns fill, by position; target columns not named get NULL.

    Partition columns must be given, as columns or by the target's
    ``partition_by`` expressions: a row filed under NULL would not be found by
    the merges that follow."""
    spark = df.sparkSession
    if columns:
        if len(columns) != len(df.columns):
            raise ValueError(f"{len(columns)} column names for {len(df.columns)} columns")
        df = df.toDF(*columns)
    target = spark.table(quoted(name))
    have = {c.lower(): c for c in df.columns}
    unknown = [c for c in df.columns if c.lower() not in {t.lower() for t in target.columns}]
    if unknown:
        raise ValueError(f"target {name} has no columns {unknown}")
    expressions = {c.lower(): e for c, e in (partition_by or {}).items()}
    parts = [c.name for c in spark.catalog.listColumns(quoted(name)) if c.isPartition]
    lost = [c for c in parts if c.lower() not in have and c.lower() not in expressions]
    if lost:
        raise ValueError(f"target {name} is partitioned by {lost}: give the columns or partition_by")
    out = df.select(*[F.col(f"`{have[f.name.lower()]}`").cast(f.dataType).alias(f.name)
                      if f.name.lower() in have else F.lit(None).cast(f.dataType).alias(f.name)
                      for f in target.schema.fields])
    derived = {c: expressions[c.lower()] for c in parts if c.lower() not in have}
    out = with_partitions(out, derived).select(
        *[F.col(f"`{f.name}`").cast(f.dataType).alias(f.name) for f in target.schema.fields])
    with hold(spark, name) as lease:
        lease.published.clear()             # the run's versions are no longer all there is
        out.write.insertInto(quoted(name))
        _forget_key_max(spark, name)        # appended rows may raise it
