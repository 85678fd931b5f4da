"""Which rows to pull: watermark filter (P3), chunk ranges (P4, W1), target
key maximum (A2)."""

from __future__ import annotations

import datetime as dt
from functools import reduce
from operator import or_
from typing import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidecopy.functions.timeparts import Freq, grid_points, parse_freq, typed_lit


def watermark_predicate(df: DataFrame, watermarks: Mapping[str, str], since: dt.datetime,
                        key_max=None) -> Column:
    """``c1 >= x OR c2 >= y ...``: datetime columns against ``since``, int
    columns against ``key_max`` (the target's key maximum). Inclusive, so a
    re-run re-reads the boundary rows; literals carry the column's type so the
    whole OR is pushed to the scan. An int column is skipped when the target
    has no key maximum."""
    types = {f.name: f.dataType for f in df.schema.fields}
    conds = []
    for col, kind in watermarks.items():
        if col not in types:
            raise ValueError(f"watermark column {col!r} not in source")
        if kind == "datetime":
            conds.append(F.col(col) >= typed_lit(since, types[col]))
        elif kind == "int":
            if key_max is not None:
                conds.append(F.col(col) >= typed_lit(key_max, types[col]))
        else:
            raise ValueError(f"watermark type must be int or datetime, got {kind!r}")
    return reduce(or_, conds) if conds else F.lit(False)


def watermark_sql(quote, literal, watermarks: Mapping[str, str], since: dt.datetime, key_max=None) -> str:
    """The same predicate as source-dialect text, for statements the source
    runs itself (e.g. the key range of the delta)."""
    conds = []
    for col, kind in watermarks.items():
        if kind == "datetime":
            conds.append(f"{quote(col)} >= {literal(since)}")
        elif kind == "int" and key_max is not None:
            conds.append(f"{quote(col)} >= {literal(key_max)}")
    return " OR ".join(conds) if conds else "1 = 0"


def incremental_filter(df: DataFrame, watermarks: Mapping[str, str], since: dt.datetime,
                       key_max=None) -> DataFrame:
    """New and changed rows since the last run (see ``watermark_predicate``)."""
    return df.where(watermark_predicate(df, watermarks, since, key_max))


def in_chunk(df: DataFrame, column: str, lo, hi=None) -> DataFrame:
    """``lo <= column < hi``; open-ended when ``hi`` is None."""
    dtype = df.schema[column].dataType
    cond = F.col(column) >= typed_lit(lo, dtype)
    if hi is not None:
        cond &= F.col(column) < typed_lit(hi, dtype)
    return df.where(cond)


def chunk_grid(frame: DataFrame, start: Column, until: Column, freq: Freq | str) -> DataFrame:
    """Chunk bounds (lo, hi) for every row of ``frame``: grid points from the
    first one at/after ``start`` up to ``until``, each paired with the next;
    the last chunk is open (hi NULL). No window: the grid is an array, and
    each point's successor is the next element."""
    freq = parse_freq(freq) if isinstance(freq, str) else freq
    seq = grid_points(start.cast("timestamp_ntz"), until.cast("timestamp_ntz"), freq)  # NULL or empty: no chunk
    return (frame.select(seq.alias("_grid"))
            .select("_grid", F.posexplode("_grid").alias("_i", "lo"))
            .select("lo", F.try_element_at("_grid", F.col("_i") + F.lit(2)).alias("hi")))


def chunk_bounds(spark: SparkSession, start_year: int, freq: str, until: dt.datetime) -> DataFrame:
    """Grid from Jan 1 of ``start_year`` to ``until`` at ``freq``."""
    one = spark.range(1).select(
        typed_lit(dt.datetime(start_year, 1, 1), "timestamp_ntz").alias("s"),
        typed_lit(until, "timestamp_ntz").alias("u"))
    return chunk_grid(one, F.col("s"), F.col("u"), freq)


def chunk_list(spark: SparkSession, start_year: int, freq: str, until: dt.datetime) -> list[tuple]:
    """The grid on the driver (its length is set by the parameters, not the
    data). Raises when there is no boundary at all."""
    bounds = [(r["lo"], r["hi"]) for r in chunk_bounds(spark, start_year, freq, until).orderBy("lo").collect()]
    if not bounds:
        raise ValueError(f"no {freq} boundary between {start_year}-01-01 and {until}")
    return bounds


def key_max(df: DataFrame, key: str):
    """max(key) of the target, as a driver scalar (one partial + final agg)."""
    return df.agg(F.max(F.col(key)).alias("key_max")).first()["key_max"]
