"""JDBC source and sink (S1, S11).

Reads go through Spark's JDBC reader, so column pruning and filters reach the
source statement; a list of ``predicates`` gives one partition (one source
statement) per predicate. Writes use Spark's JDBC writer: rows are batched
and each partition commits as one transaction."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass, field
from decimal import Decimal
from typing import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidecopy.functions.cells import null_cells

# How each source dialect quotes names and writes a timestamp.
DIALECTS = {
    "mysql": ("`", "'{}'"),
    "postgresql": ('"', "TIMESTAMP '{}'"),
    "derby": ('"', "TIMESTAMP('{}')"),
}
# Options a MySQL source needs so that types arrive as the type map expects.
MYSQL_OPTIONS = {"tinyInt1isBit": "false", "zeroDateTimeBehavior": "CONVERT_TO_NULL"}


@dataclass(frozen=True)
class JdbcTable:
    """A table behind a JDBC URL."""

    url: str
    table: str
    properties: Mapping[str, str] = field(default_factory=dict)
    fetchsize: int = 10000

    @property
    def dialect(self) -> str:
        for name in DIALECTS:
            if self.url.startswith(f"jdbc:{name}:"):
                return name
        return "other"

    def quote(self, name: str) -> str:
        q = DIALECTS.get(self.dialect, ('"', ""))[0]
        return f"{q}{name}{q}"

    def literal(self, value) -> str:
        if isinstance(value, (dt.datetime, dt.date)):
            fmt = DIALECTS.get(self.dialect, ('"', "'{}'"))[1]
            text = value.isoformat(sep=" ") if isinstance(value, dt.datetime) else value.isoformat()
            if self.dialect == "derby" and not isinstance(value, dt.datetime):
                fmt = "DATE('{}')"
            return fmt.format(text)
        if isinstance(value, str):
            if self.dialect == "mysql":  # a backslash escapes there
                value = value.replace("\\", "\\\\")
            return "'" + value.replace("'", "''") + "'"
        return str(value)

    def options(self) -> dict[str, str]:
        opts = {"url": self.url, "fetchsize": str(self.fetchsize), "preferTimestampNTZ": "true"}
        if self.dialect == "mysql":
            opts.update(MYSQL_OPTIONS)
        opts.update(self.properties)
        return opts


def jdbc_query(spark: SparkSession, src: JdbcTable, query: str) -> DataFrame:
    """Result of a source-side query (aggregates run in the source)."""
    return spark.read.format("jdbc").options(**src.options()).option("query", query).load()


def key_range(spark: SparkSession, src: JdbcTable, column: str, where_sql: str | None = None):
    """(min, max) of ``column`` over the rows ``where_sql`` selects, computed
    by the source."""
    q = src.quote(column)
    where = f" WHERE {where_sql}" if where_sql else ""
    row = jdbc_query(spark, src, f"SELECT min({q}) AS lo, max({q}) AS hi FROM {src.table}{where}").first()
    return row[0], row[1]


def jdbc_count(spark: SparkSession, src: JdbcTable, column: str | None = None, upto=None,
               where_sql: str | None = None) -> DataFrame:
    """One row ``n``: rows of the source (``column <= upto`` when given, of those that
    ``where_sql`` selects), counted by the source instead of pulled."""
    conds = [f"{src.quote(column)} <= {src.literal(upto)}"] if column is not None and upto is not None else []
    conds += [f"({where_sql})"] if where_sql else []
    where = f" WHERE {' AND '.join(conds)}" if conds else ""
    return jdbc_query(spark, src, f"SELECT count(*) AS n FROM {src.table}{where}").select(
        F.col("n").cast("bigint").alias("n"))


def strided(value) -> bool:
    """Can a read be cut into ranges of keys like this one? (Numbers, dates and
    timestamps; a key of another type is read by one statement.)"""
    return isinstance(value, (int, float, Decimal, dt.date)) and not isinstance(value, bool)


def jdbc_scan(spark: SparkSession, url: str | JdbcTable, table: str | None = None, *,
              columns: Sequence[str] | None = None, predicate: Column | None = None,
              predicates: Sequence[str] | None = None, query: str | None = None,
              partition_column: str | None = None, num_partitions: int | None = None,
              bounds: tuple | None = None, properties: Mapping[str, str] | None = None,
              where: str | None = None) -> DataFrame:
    """Rows of a source table. ``predicate`` (a Column) is pushed into the
    statement; ``predicates`` (source-dialect text) split the read into one
    partition each; ``query`` replaces the table by a source-side select.

    ``partition_column`` + ``num_partitions`` split the read into key strides
    between ``bounds`` (min, max; asked from the source when not given) of about
    equal counts, as the source counts its rows (those of ``where``; see ``splits``);
    the first and last strides are open, so no row is lost whatever the bounds. A
    key without strides (text) leaves the read in one piece."""
    src = url if isinstance(url, JdbcTable) else JdbcTable(url, table or "", dict(properties or {}))
    opts = src.options()
    if not predicates and partition_column and (num_partitions or 0) > 1:
        from tidecopy.sources.splits import even_cuts, stride_predicates

        lo, hi = bounds if bounds is not None else key_range(spark, src, partition_column, where)
        if strided(lo) and strided(hi) and hi > lo:
            cuts = even_cuts(spark, src, partition_column, num_partitions, ranges=[(lo, hi)], where=where)[0]
            predicates = stride_predicates(src, partition_column, cuts)
    if predicates:
        df = spark.read.jdbc(src.url, query and f"({query}) q" or src.table,
                             predicates=list(predicates), properties={k: v for k, v in opts.items() if k != "url"})
    else:
        reader = spark.read.format("jdbc").options(**opts)
        reader = reader.option("query", query) if query else reader.option("dbtable", src.table)
        df = reader.load()
    if columns:
        df = df.select(*[F.col(f"`{c}`") for c in columns])
    if predicate is not None:
        df = df.where(predicate)
    return df


def append_jdbc(df: DataFrame, url: str | JdbcTable, table: str | None = None, *,
                columns: Sequence[str] | None = None, commit_every: int = 1000,
                properties: Mapping[str, str] | None = None, run: str | None = None) -> dict:
    """Append rows to a source-database table. ``columns`` names the target
    columns the DataFrame's columns go to, by position. NaN cells are stored as
    NULL. Every ``commit_every`` rows are one transaction (0: all rows are one),
    and a repeated task adds nothing twice; an append that died goes on where it
    was when called again with the same ``run`` (see ``append``). Columns must be
    comparable in the destination (no LOBs in Derby). Returns rows, batches, skipped."""
    from tidecopy.sources.append import append_in_batches

    dest = url if isinstance(url, JdbcTable) else JdbcTable(url, table or "", dict(properties or {}))
    if columns:
        if len(columns) != len(df.columns):
            raise ValueError(f"{len(columns)} column names for {len(df.columns)} columns")
        df = df.toDF(*columns)
    if commit_every < 0:
        raise ValueError("commit_every is a number of rows, or 0 for one transaction")
    return append_in_batches(null_cells(df), dest, commit_every, run)
