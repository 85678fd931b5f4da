"""Counts of a target without scanning it (A5, V2).

After each run that wrote, the target's rows by partition and hour of the cutoff
column stand in a small ledger, ``counts/<fence>`` in the table's folder. A load counts
what it wrote; a merge counts the partitions it rewrote, in the version it has just
written, and takes the others over. The ledger counts only while the table's files
are those it was made for (their number and a digest of their names); after any
other write the table is counted anew."""

from __future__ import annotations

import json
import zlib

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidecopy.sources.versions import Lease


def _stamp(table: DataFrame) -> dict:
    files = sorted(table.inputFiles())
    return {"files": len(files), "names": zlib.crc32("\n".join(files).encode())}


def _hour(column: str | None) -> Column:
    """The first full hour at or after the value: counting up to a full hour needs no finer."""
    if column is None:
        return F.lit(None).cast("timestamp_ntz")
    v = F.col(f"`{column}`").cast("timestamp_ntz")
    whole = F.date_trunc("hour", v).cast("timestamp_ntz")
    return F.when(whole < v, whole + F.expr("INTERVAL 1 HOUR")).otherwise(whole)


def _counted(rows: DataFrame, parts: list[str], column: str | None) -> DataFrame:
    part = F.to_json(F.struct(*[F.col(f"`{p}`").cast("string").alias(p) for p in parts])) if parts else F.lit("")
    return (rows.withColumn("__hour", _hour(column)).groupBy(*[F.col(f"`{p}`") for p in parts], "__hour").agg(F.count(F.lit(1)).alias("n"))
            .select(part.alias("part"), F.col("__hour").alias("hour"), "n"))


def _note(lease: Lease) -> dict | None:
    at = f"{lease.root}/counts/current"
    if lease.files is None or not lease.files.exists(at):
        return None
    try:
        return json.loads(lease.files.read(at))
    except ValueError:
        return None


def ledger(spark: SparkSession, table: DataFrame, lease: Lease, column: str | None) -> DataFrame | None:
    """Rows (part, hour, n) of the table as it stands, or None if they are not known."""
    note = _note(lease)
    if note is None or note["column"] != column or note["stamp"] != _stamp(table):
        return None
    return spark.read.schema("part string, hour timestamp_ntz, n long").parquet(note["path"])


def count(spark: SparkSession, table: DataFrame, lease: Lease, column: str | None) -> int | None:
    known = ledger(spark, table, lease, column)
    return None if known is None else known.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]


def counter(known: DataFrame):
    """``count_check``'s target counter: one row ``n`` from the ledger."""
    def upto(column: str | None, cutoff) -> DataFrame:
        rows = known if column is None else known.where(F.col("hour") <= F.lit(cutoff.isoformat(sep=" ")).cast("timestamp_ntz"))
        return rows.agg(F.coalesce(F.sum("n"), F.lit(0)).cast("bigint").alias("n"))

    return upto


def update(spark: SparkSession, table: DataFrame, lease: Lease, column: str | None, parts: list[str],
           before: DataFrame | None) -> DataFrame | None:
    """Write the ledger of the table after this run's ``lease.published`` versions; returns it.
    ``before``: the ledger as it was when the run began, if it was known."""
    if lease.files is None:
        return None
    have, published = before, list(lease.published)
    lease.published.clear()
    for path, partly in published:
        if partly and have is None:
            continue
        new = _counted(spark.read.schema(table.schema).parquet(path), parts, column)
        if partly:
            new = new.unionByName(have.join(new.select("part").distinct(), "part", "left_anti"))
        have = new
    if have is None or not published:
        have = _counted(table, parts, column)
    path = f"{lease.root}/counts/{lease.fence:012d}"
    have.coalesce(1).write.mode("overwrite").parquet(path)
    old = _note(lease)
    lease.files.write(f"{lease.root}/counts/current", json.dumps({"path": path, "column": column, "stamp": _stamp(table)}))
    if old and old["path"] != path:
        lease.files.delete(old["path"])
    return spark.read.schema("part string, hour timestamp_ntz, n long").parquet(path)
