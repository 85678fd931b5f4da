"""Targets in file groups: a merge rewrites only the groups that hold keys of the delta.

The rows of a grouped target lie in groups of about ``group_rows`` rows, each the
partition of a technical column (``TC_GROUP``) with its own folder. A load deals the
rows by key range, so a group spans a stretch of keys; equal or missing keys that
would make a group too large are spread over several.

An index, written beside every version (``index/<version>``), holds for each group its
rows, the range of the first key and a Bloom filter of the whole keys: blocks of
32768 bits, a key setting three bits of the one block that its hash picks. A merge
looks for the delta's keys by range, then by filter, reads the keys of the few groups
that pass, and rewrites those that really hold one. New rows go to the smallest group
while there is room, then to new groups. Other groups keep their files."""

from __future__ import annotations

from functools import reduce
from math import ceil
from operator import and_
from typing import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidecopy.operators.merge import merge_upsert
from tidecopy.session import stage, unstage
from tidecopy.sources.versions import Lease

GROUP = "TC_GROUP"
BITS_A_KEY = 16
_BLOCK = 32768             # bits of one block: what bitmap_construct_agg holds
_HASHES = 3
INDEX_VERSIONS = 32        # so many index versions are written together as one


def _keyed(keys: Sequence[str]) -> Column:
    return reduce(and_, [F.col(f"`{k}`").isNotNull() for k in keys])


def _places(keys: Sequence[str]) -> list[Column]:
    """The bits a key sets in its block."""
    h = F.xxhash64(*[F.col(f"`{k}`") for k in keys], F.lit("bits"))
    return [F.pmod(F.shiftrightunsigned(h, 16 * i), F.lit(_BLOCK)).cast("long") for i in range(_HASHES)]


def _block(keys: Sequence[str], blocks: Column) -> Column:
    return F.pmod(F.xxhash64(*[F.col(f"`{k}`") for k in keys]), blocks).cast("int")


def dealt(df: DataFrame, keys: Sequence[str], group_rows: int) -> tuple[DataFrame, DataFrame]:
    """``df``, staged (its source is read once), with its group column; and the staged frame."""
    rows = stage(df)
    n = max(1, ceil(rows.count() / group_rows))
    return _by_range(rows, keys, n).withColumn(GROUP, F.spark_partition_id().cast("int")), rows


def _by_range(staged: DataFrame, keys: Sequence[str], n: int) -> DataFrame:
    """Staged rows in n parts by key range; rows of one key, or without one, may be parted too."""
    order = [*[F.col(f"`{k}`") for k in keys], F.col("__row")]
    return staged.withColumn("__row", F.monotonically_increasing_id()).repartitionByRange(n, *order).drop("__row")


def write_index(lease: Lease, path: str, keys: Sequence[str], group_rows: int, spark: SparkSession, schema, whole: bool) -> None:
    """The index of the groups written to ``path``, which are all there are if ``whole``."""
    version = path.rsplit("/", 1)[1]
    blocks = max(1, ceil(group_rows * BITS_A_KEY / _BLOCK))
    rows = spark.read.schema(schema).parquet(path).select(GROUP, *[F.col(f"`{k}`") for k in keys])
    first = F.col(f"`{keys[0]}`")
    out = f"{lease.root}/index/{version}{'.whole' if whole else ''}"
    (rows.groupBy(GROUP).agg(F.count(F.lit(1)).alias("n"), F.min(first).alias("lo"), F.max(first).alias("hi"))
     .withColumns({"version": F.lit(version), "blocks": F.lit(blocks)}).coalesce(1).write.parquet(f"{out}/ranges"))
    bits = (rows.where(_keyed(keys)).select(GROUP, _block(keys, F.lit(blocks)).alias("block"), F.explode(F.array(*_places(keys))).alias("at"))
            .groupBy(GROUP, "block").agg(F.bitmap_construct_agg("at").alias("bits")))
    bits.withColumn("version", F.lit(version)).write.parquet(f"{out}/bits")


def read_index(spark: SparkSession, lease: Lease) -> tuple[DataFrame, DataFrame]:
    """Ranges (one row per group, its latest) and filters of the published versions."""
    have = _versions(lease)
    if not have:
        raise ValueError(f"no index in {lease.root}: load the target in groups first")
    ranges = spark.read.parquet(*[f"{lease.root}/index/{v}/ranges" for v in have])
    latest = ranges.groupBy(GROUP).agg(F.max_by(F.struct(*[F.col(c) for c in ranges.columns if c != GROUP]), "version").alias("r"))
    return latest.select(GROUP, "r.*"), spark.read.parquet(*[f"{lease.root}/index/{v}/bits" for v in have])


def _versions(lease: Lease) -> list[str]:
    """Index versions to be read: the last that holds all groups (``.whole``, or the load's) and those after it."""
    shown = set(lease.files.names(f"{lease.root}/publish"))
    have = sorted(v for v in lease.files.names(f"{lease.root}/index") if v.removesuffix(".whole") in shown)
    whole = [i for i, v in enumerate(have) if v.endswith(".whole")]
    return have[whole[-1]:] if whole else have


def _holding(delta: DataFrame, keys: Sequence[str], ranges: DataFrame, bits: DataFrame) -> list[int]:
    """Groups whose range and filter admit a key of the delta. Keys are compared with
    the ranges by pieces: ``delta`` is range-partitioned, so a piece meets few groups."""
    first, k = F.col(f"`{keys[0]}`"), [F.col(f"`{c}`") for c in keys]
    some = delta.where(_keyed(keys))
    pieces = some.groupBy("__piece").agg(F.min(first).alias("p_lo"), F.max(first).alias("p_hi"))
    near = pieces.join(F.broadcast(ranges), (F.col("lo") <= F.col("p_hi")) & (F.col("hi") >= F.col("p_lo"))).select(
        F.col("__piece").alias("n_piece"), F.col(GROUP).alias("n_group"), "lo", "hi", "version", "blocks")
    pairs = (some.select("__piece", *k).distinct()
             .join(near, (F.col("__piece") == F.col("n_piece")) & (first >= F.col("lo")) & (first <= F.col("hi")))
             .select("n_group", F.col("version").alias("n_version"), _block(keys, F.col("blocks")).alias("n_block"),
                     *[p.alias(f"at{i}") for i, p in enumerate(_places(keys))]))
    hit = reduce(and_, [F.expr(f"(conv(hex(substring(bits, cast(at{i} div 8 AS int) + 1, 1)), 16, 10) & shiftleft(1, cast(at{i} % 8 AS int))) <> 0")
                        for i in range(_HASHES)])
    found = pairs.join(bits, (F.col("n_group") == F.col(GROUP)) & (F.col("n_version") == F.col("version"))
                       & (F.col("n_block") == F.col("block"))).where(hit)
    return sorted(r[0] for r in found.select("n_group").distinct().collect())      # a number per group


def merge_grouped(spark: SparkSession, table: DataFrame, delta: DataFrame, keys: Sequence[str], group_rows: int,
                  lease: Lease, write) -> dict:
    """Upsert ``delta`` (staged; the table's columns but the group) by ``keys``; ``write(rows)`` publishes
    the rewritten groups. Returns rows, bytes, key_max, written, groups (rewritten), read (groups whose keys
    were read) and all (groups there were)."""
    stats: dict = {}
    total = delta.count()
    if not total:
        return {"rows": 0, "bytes": 0, "key_max": None, "broadcast": True, "written": False, "groups": 0, "read": 0}
    ranges, bits = read_index(spark, lease)
    parts = max(1, min(int(spark.conf.get("spark.sql.shuffle.partitions")), total))
    ranges = stage(ranges)
    delta = stage(_by_range(delta, keys, parts).withColumn("__piece", F.spark_partition_id()))
    matched = None
    try:
        maybe = _holding(delta, keys, ranges, bits)
        named = [F.col(f"`{c}`") for c in keys]
        matched = stage(table.where(F.col(GROUP).isin(maybe)).select(GROUP, *named).distinct()
                        .join(delta.select(*named).distinct(), list(keys), "left_semi"))
        touched = {r[0] for r in matched.select(GROUP).distinct().collect()}
        fresh = total - delta.join(matched.select(*named).distinct(), list(keys), "left_semi").count()
        n, last, small = ranges.agg(F.count(F.lit(1)), F.max(GROUP), F.min(F.struct("n", GROUP))).first()
        group = F.lit(last + 1 if last is not None else 0)
        if fresh and small is not None and small["n"] + fresh <= group_rows:
            group = F.lit(small[GROUP])
            touched.add(small[GROUP])
        elif fresh > group_rows:
            group = group + F.expr(f"cast(__piece * {ceil(fresh / group_rows)} div {parts} AS int)")
        rows = table.where(F.col(GROUP).isin(sorted(touched)))
        merged = merge_upsert(rows, delta.withColumn(GROUP, group.cast("int")).drop("__piece"), keys, stage_delta=False,
                              stats=stats, keep=[GROUP])
        write(merged)
        return {**stats, "written": True, "groups": len(touched), "read": len(maybe), "all": n}
    finally:
        for frame in (delta, ranges, matched):
            if frame is not None:
                unstage(frame)


def compact(spark: SparkSession, lease: Lease, version: str) -> None:
    """Write the index versions as one, under the newest's name, once there are many."""
    have = _versions(lease)
    if len(have) < INDEX_VERSIONS:
        return
    ranges, bits = read_index(spark, lease)
    now = F.broadcast(ranges.select(GROUP, "version"))
    whole = f"{lease.root}/index/{version}.whole"
    ranges.withColumn("version", F.lit(version)).coalesce(1).write.parquet(f"{whole}/ranges")
    bits.join(now, [GROUP, "version"], "left_semi").withColumn("version", F.lit(version)).write.parquet(f"{whole}/bits")
    lease.retire([f"{lease.root}/index/{v}" for v in have])
