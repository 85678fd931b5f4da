"""Checks: has rows (A1), row counts to a cutoff (A5), source-vs-target count
check (V2, J4) and the "condition met" rule of a probe query (V3).

Each returns a small DataFrame (one row) computed on the executors; the
driver only ever sees that row."""

from __future__ import annotations

import datetime as dt
from typing import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidecopy.functions.timeparts import count_cutoff, typed_lit


class CountCheckError(AssertionError):
    """The target holds fewer rows than the source allows."""


def has_rows(df: DataFrame) -> DataFrame:
    """One row, ``has_rows``: true when ``df`` is not empty. The scan stops at
    the first row found."""
    return df.limit(1).agg((F.count(F.lit(1)) > 0).alias("has_rows"))


def row_count(df: DataFrame, column: str | None = None, upto=None) -> DataFrame:
    """One row, ``n``: rows of ``df``, or rows with ``column <= upto``."""
    if column is not None and upto is not None:
        df = df.where(F.col(column) <= typed_lit(upto, df.schema[column].dataType))
    return df.agg(F.count(F.lit(1)).alias("n"))


def _find(df: DataFrame, name: str) -> str | None:
    for c in df.columns:
        if c.lower() == name.lower():
            return c
    return None


def count_check(source: DataFrame, target: DataFrame, watermarks: Mapping[str, str] | None, *,
                now: dt.datetime | None = None, cutoff_column: str = "created_at",
                tolerance: int = 1000, source_counter=None, target_counter=None) -> DataFrame:
    """One row ``(rule, cutoff, source_n, target_n, ok)``.

    * a datetime watermark named ``cutoff_column``: rows up to the cutoff (half an
      hour before ``now``, floored to the hour) must all be in the target:
      ``target_n >= source_n``;
    * no watermark columns: ``target_n + tolerance >= source_n``;
    * watermark columns without ``cutoff_column``: no check (ok, no counts).

    The two counts are two one-row aggregates joined side by side.
    ``source_counter(column, upto)`` may supply the source count as a one-row
    DataFrame ``n`` computed elsewhere (e.g. by the source database), and
    ``target_counter`` likewise the target's (e.g. from a ledger)."""
    watermarks = dict(watermarks or {})
    dt_cols = [c for c, kind in watermarks.items() if kind == "datetime"]
    spark = source.sparkSession
    if cutoff_column in dt_cols:
        cutoff = count_cutoff(now)
        tcol = _find(target, cutoff_column)
        if tcol is None:
            raise ValueError(f"target has no column {cutoff_column!r}")
        s = (source_counter(cutoff_column, cutoff) if source_counter else
             row_count(source, cutoff_column, cutoff)).withColumnRenamed("n", "source_n")
        t = (target_counter(tcol, cutoff) if target_counter else row_count(target, tcol, cutoff)).withColumnRenamed("n", "target_n")
        return s.crossJoin(t).select(
            F.lit("cutoff").alias("rule"), typed_lit(cutoff, "timestamp_ntz").alias("cutoff"),
            "source_n", "target_n", (F.col("target_n") >= F.col("source_n")).alias("ok"))
    if not watermarks:
        s = (source_counter(None, None) if source_counter else row_count(source)).withColumnRenamed("n", "source_n")
        t = (target_counter(None, None) if target_counter else row_count(target)).withColumnRenamed("n", "target_n")
        return s.crossJoin(t).select(
            F.lit("tolerance").alias("rule"), F.lit(None).cast("timestamp_ntz").alias("cutoff"),
            "source_n", "target_n", (F.col("target_n") + F.lit(tolerance) >= F.col("source_n")).alias("ok"))
    return spark.range(1).select(
        F.lit("none").alias("rule"), F.lit(None).cast("timestamp_ntz").alias("cutoff"),
        F.lit(None).cast("bigint").alias("source_n"), F.lit(None).cast("bigint").alias("target_n"),
        F.lit(True).alias("ok"))


def condition_met(df: DataFrame) -> DataFrame:
    """One row, ``met``: ``df`` returned a row whose first cell, as text, is
    not ``'0'`` or ``''``. A NULL first cell counts as met; no row is not met."""
    first = df.limit(1).select(F.col(f"`{df.columns[0]}`").cast("string").alias("c"))
    cell_ok = F.coalesce(~F.col("c").isin("0", ""), F.lit(True))
    return first.agg(F.coalesce(F.max(cell_ok), F.lit(False)).alias("met"))
