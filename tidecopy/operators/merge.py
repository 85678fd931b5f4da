"""Key upsert of a delta into a target (S8/J1) and the duplicate-key report (A6).

Semantics of a MERGE with an update and an insert branch and no delete:
a target row whose key equals a delta key takes the delta's non-key values;
a delta row with no equal target key is inserted; rows with a NULL in any key
never match (NULL = x is not true), so NULL-key delta rows always insert and
NULL-key target rows stay. Two delta rows matching one target key are an error;
duplicate delta keys that match nothing are all inserted.

Plan, built from joins only. The delta is staged and measured once; delta keys
that occur twice are looked for in the delta alone, and only if there are any
the target's keys are read to see whether one of them matches.

* Delta under the session's own broadcast threshold (measured bytes): the delta
  is broadcast and the target never shuffled. Update: target LEFT JOIN delta;
  insert: delta LEFT ANTI JOIN the target keys found in the delta.
* Larger delta: one FULL OUTER JOIN on the keys gives updates, untouched rows and
  inserts in one pass, so the target is shuffled once (not at all if it is
  bucketed by the keys). NULL-key rows cannot match and bypass the join, so a
  NULL key that holds a third of the table never meets in one task."""

from __future__ import annotations

from functools import reduce
from operator import and_
from typing import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidecopy.session import stage


class DuplicateKeyError(ValueError):
    """Several delta rows match the same target row."""


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Key values held by more than one row (NULL keys included as a group),
    with their row count ``n``. Partial counts are combined map-side, so a hot
    key costs one row per map task in the shuffle."""
    return (df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1))


def _row_bytes(df: DataFrame) -> Column:
    """Approximate in-memory bytes of a row: 8 per field plus variable data."""
    parts = [F.lit(8 * (len(df.columns) + 1))]
    for f in df.schema.fields:
        if isinstance(f.dataType, (T.StringType, T.BinaryType)):
            parts.append(F.coalesce(F.octet_length(F.col(f"`{f.name}`")), F.lit(0)))
        elif isinstance(f.dataType, T.DecimalType) and f.dataType.precision > 18:
            parts.append(F.lit(16))
    return reduce(lambda a, b: a + b, parts)


def broadcast_limit(spark) -> int:
    """Bytes under which the delta is broadcast: the session's own auto-broadcast
    threshold (negative: never)."""
    raw = str(spark.conf.get("spark.sql.autoBroadcastJoinThreshold", "10485760")).strip().lower().rstrip("b")
    scale = {"k": 1 << 10, "m": 1 << 20, "g": 1 << 30}.get(raw[-1:], 1)
    return int(float(raw.rstrip("kmg"))) * scale


def merge_upsert(target: DataFrame, delta: DataFrame, keys: Sequence[str], *,
                 stage_delta: bool = True, broadcast_bytes: int | None = None,
                 check_duplicates: bool = True, stats: dict | None = None,
                 align: int | None = None, keep: Sequence[str] = ()) -> DataFrame:
    """Merged rows of ``target`` after upserting ``delta`` by ``keys``.

    ``delta`` must have the target's columns (any order); it is cast to the
    target's types. With ``stage_delta`` the delta is materialised once in the
    shared folder (a live source is read exactly once). Returns a lazy
    DataFrame in the target's column order; write it elsewhere (a table being
    read cannot be overwritten) and swap. ``stats``, when given, receives the
    delta's ``rows``, ``bytes``, the max of its first key (``key_max``) and
    whether it was broadcast (``broadcast``). ``align`` = n hash-partitions
    inserted rows on the keys into n parts, matching a target bucketed by the
    keys into n buckets (the updated rows keep the target's own layout).
    ``keep`` names columns that updated rows keep from the target (inserted rows
    have the delta's). A staged delta stays in the shared folder as long as the result may be read."""
    keys = list(keys)
    cols = target.columns
    if not keys:
        raise ValueError("merge needs at least one key column")
    missing_t = [k for k in keys if k not in cols]
    if missing_t:
        raise ValueError(f"keys not in target: {missing_t}")
    missing_d = [c for c in cols if c not in delta.columns]
    extra_d = [c for c in delta.columns if c not in cols]
    if missing_d or extra_d:
        raise ValueError(f"delta columns differ from target: missing {missing_d}, extra {extra_d}")
    types = {f.name: f.dataType for f in target.schema.fields}
    delta = delta.select(*[F.col(f"`{c}`").cast(types[c]).alias(c) for c in cols])
    if stage_delta:
        delta = stage(delta)

    limit = broadcast_limit(target.sparkSession) if broadcast_bytes is None else broadcast_bytes
    measured = delta.agg(F.count(F.lit(1)).alias("n"), F.sum(_row_bytes(delta)).alias("b"),
                         F.max(F.col(f"`{keys[0]}`")).alias("k")).first()
    small = limit >= 0 and (measured["b"] or 0) <= limit
    if stats is not None:
        stats.update(rows=measured["n"], bytes=measured["b"] or 0, key_max=measured["k"], broadcast=small)
    if not measured["n"]:
        return target  # nothing to upsert: no key scan, no join

    key_ok = reduce(and_, [F.col(f"`{k}`").isNotNull() for k in keys])
    d_keyed, d_nullkey = delta.where(key_ok), delta.where(~key_ok)
    if check_duplicates:
        _refuse_duplicates(target, d_keyed, keys, small)
    non_keys = [c for c in cols if c not in keys]
    src = d_keyed.select(*keys, *[F.col(f"`{c}`").alias(f"__src_{c}") for c in non_keys], F.lit(True).alias("__hit"))
    picked = [F.col(f"`{c}`") if c in keys
              else F.coalesce(F.col(f"`{c}`"), F.col(f"`__src_{c}`")).alias(c) if c in keep
              else F.when(F.col("__hit"), F.col(f"`__src_{c}`")).otherwise(F.col(f"`{c}`")).alias(c) for c in cols]
    if small:
        # the target is streamed past a broadcast delta: NULL keys cannot skew
        # anything and simply find no match, so the target is not split
        updated = target.join(F.broadcast(src), keys, "left").select(*picked) if non_keys else target
        found = target.select(*keys).join(F.broadcast(d_keyed.select(*keys).distinct()), keys, "left_semi").distinct()
        inserts = d_keyed.join(found, keys, "left_anti")
        if align:
            inserts = inserts.repartition(align, *[F.col(f"`{k}`") for k in keys])
        return updated.unionByName(inserts.select(*cols)).unionByName(d_nullkey)
    t_keyed, t_nullkey = target.where(key_ok), target.where(~key_ok)
    merged = t_keyed.join(src, keys, "full_outer").select(*picked)
    return merged.unionByName(t_nullkey).unionByName(d_nullkey)


def _refuse_duplicates(target: DataFrame, d_keyed: DataFrame, keys: list[str], small: bool) -> None:
    """Raise if a key that the delta has twice is in the target. The target is read
    only if the delta has such keys."""
    twice = d_keyed.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > 1).select(*keys)
    if twice.isEmpty():
        return
    hit = target.select(*keys).join(F.broadcast(twice) if small else twice, keys, "left_semi").distinct().limit(5).collect()
    if hit:
        shown = ", ".join(str(tuple(r[k] for k in keys)) for r in hit)
        raise DuplicateKeyError(f"several delta rows match one target key: {shown}")
