"""Mixing sources to target weights by hash-threshold histograms.

Every document has a fixed 60-bit hash. A source takes each document some whole
number of times and once more those below a hash threshold, so a larger budget
only adds documents (thresholds are nested) and nothing is sorted: words are
summed by source and hash bucket, the running sum shows the bucket in which the
source's budget ends, and only that bucket is split into finer ones, until one
hash is left. That hash's documents go to the side that leaves the smaller
difference. Buckets are summed on the map side, so a hot source moves 1024 rows
a task; sources meet their thresholds in a broadcast join of checked size.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidecopy.llm._store import Stage, free_names

WORD = r"[^\x20\x09-\x0D]+"
HASH_BITS, STEP_BITS = 60, 10
BROADCAST_SOURCES = 100_000     # plan rows (under 100 bytes each) that are broadcast; more are joined by a shuffle


def word_count(text: str) -> Column:
    return F.coalesce(F.regexp_count(F.col(text).cast("string"), F.lit(WORD)), F.lit(0)).cast("long")


def document_hash(id_col: str, text_col: str) -> Column:
    """60 bits fixed by the id and the text: equal rows share them."""
    return F.shiftrightunsigned(F.xxhash64(F.col(id_col).cast("string"), F.col(text_col).cast("string")), 64 - HASH_BITS)


def _targets(sources: DataFrame, weights: tuple[int, ...], share: float, cap: int) -> DataFrame:
    """Per source: source_size, target (shares by weight, at most ``cap`` times the
    size, the excess reshared). One row per source, so one task suffices."""
    everything = Window.partitionBy()
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    w = F.element_at(F.array(*[F.lit(x) for x in weights]), ((F.row_number().over(by_name) - 1) % len(weights) + 1).cast("int"))
    t = (sources.withColumn("weight", w).withColumn("limit", F.col("source_size") * cap)
         .withColumn("budget", F.sum("source_size").over(everything) * F.lit(share))
         .withColumn("all_weights", F.sum("weight").over(everything)))
    # in order of limit / weight, sources are held to their limit as long as the
    # level of the others would lift them above it
    order = Window.orderBy((F.col("limit") / F.col("weight")), F.col("source").asc_nulls_last())
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    t = (t.withColumn("place", F.row_number().over(order))
         .withColumn("level", (F.col("budget") - F.coalesce(F.sum("limit").over(before), F.lit(0)))
                     / (F.col("all_weights") - F.coalesce(F.sum("weight").over(before), F.lit(0)))))
    open_from = F.min(F.when(F.col("limit") >= F.col("level") * F.col("weight"), F.col("place"))).over(everything)
    t = t.withColumn("open_from", F.coalesce(open_from, F.lit(2**31 - 1)))
    level = F.max(F.when(F.col("place") == F.col("open_from"), F.col("level"))).over(everything)
    return t.select("source", "source_size", F.when(F.col("place") < F.col("open_from"), F.col("limit").cast("double"))
                    .otherwise(level * F.col("weight")).alias("target"))


def _joined(rows: DataFrame, plan: DataFrame, small: bool, how: str = "inner") -> DataFrame:
    p = F.broadcast(plan) if small else plan
    return rows.join(p, rows["source"].eqNullSafe(p["p_source"]), how).drop("p_source")


def mix_plan(sized: DataFrame, stage: Stage, *, weights: tuple[int, ...] = (1, 2, 3), share: float = 1.0,
             cap: int = 3) -> tuple[DataFrame, bool]:
    """Per source: source_size, target, ``whole`` (times every document is taken) and
    ``threshold`` (documents whose hash is at most this are taken once more).

    ``sized`` has source, size, hash. Also tells whether the plan may be broadcast."""
    totals = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    targets = stage.write(_targets(totals, weights, share, cap))
    small = targets.count() <= BROADCAST_SOURCES
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0)).cast("long")
    state = (targets.withColumn("whole", whole)
             .withColumn("rest", F.col("target") - F.col("whole") * F.col("source_size"))
             .withColumn("threshold", F.lit(-1).cast("long")))
    # rest == 0 needs no threshold; else the search goes bucket by bucket
    open_ = state.where("rest > 0").select(F.col("source").alias("p_source"), F.lit(0).cast("long").alias("bucket"), "rest")
    found = []
    for shift in range(HASH_BITS - STEP_BITS, -1, -STEP_BITS):
        open_ = stage.write(open_)
        if open_.isEmpty():
            break
        inside = _joined(sized, open_, small).where(F.shiftright("hash", shift + STEP_BITS) == F.col("bucket"))
        hist = (inside.groupBy("source", F.shiftright("hash", shift).alias("b"))
                .agg(F.sum("size").alias("n"), F.min("hash").alias("lo"), F.max("hash").alias("hi"), F.first("rest").alias("rest")))
        run = Window.partitionBy("source").orderBy("b")
        hist = hist.withColumn("upto", F.sum("n").over(run)).withColumn("before", F.col("upto") - F.col("n"))
        edge = stage.write(hist.where((F.col("before") < F.col("rest")) & (F.col("rest") <= F.col("upto"))))
        take = F.col("upto") - F.col("rest") <= F.col("rest") - F.col("before")
        found.append(edge.where("lo = hi").select(
            F.col("source").alias("f_source"), F.when(take, F.col("hi")).otherwise(F.col("lo") - 1).alias("found")))
        open_ = edge.where("lo < hi").select(F.col("source").alias("p_source"), F.col("b").alias("bucket"),
                                             (F.col("rest") - F.col("before")).alias("rest"))
    for f in found:
        state = state.join(f, state["source"].eqNullSafe(f["f_source"]), "left").withColumn(
            "threshold", F.coalesce("found", "threshold")).drop("f_source", "found")
    plan = state.select(F.col("source").alias("p_source"), "source_size", "target", "whole", "threshold")
    return stage.write(plan), small


def _sized(docs: DataFrame, id_col: str, text_col: str, source_col: str) -> list[Column]:
    return [F.col(source_col).cast("string").alias("source"), word_count(text_col).alias("size"),
            document_hash(id_col, text_col).alias("hash")]


def mix_sources(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
                weights: tuple[int, ...] = (1, 2, 3), share: float = 1.0, cap: int = 3) -> DataFrame:
    """One row per row of ``docs``: doc_id, size (words), source_size, target, taken
    (words, repeats counted), copies.

    A null source is a source of its own, last in order; a null text has no words
    and is taken as its hash says (0 words); rows that agree in id and text share
    a hash and are taken together; a source without words has target 0; an empty
    table gives an empty result; other columns don't matter.
    """
    stage = Stage(docs.sparkSession, "mix")
    sized = stage.write(docs.select(F.col(id_col).alias("doc_id"), *_sized(docs, id_col, text_col, source_col)))
    plan, small = mix_plan(sized.select("source", "size", "hash"), stage, weights=weights, share=share, cap=cap)
    copies = F.col("whole") + (F.col("hash") <= F.col("threshold")).cast("long")
    return _joined(sized, plan, small).select(
        "doc_id", "size", "source_size", "target", (F.col("size") * copies).alias("taken"), copies.alias("copies"))


def mix_rows(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
             weights: tuple[int, ...] = (1, 2, 3), share: float = 1.0, cap: int = 3) -> DataFrame:
    """The mix itself: each row of ``docs``, with its columns, as often as it is taken."""
    stage = Stage(docs.sparkSession, "mix")
    sized = stage.write(docs.select(*_sized(docs, id_col, text_col, source_col)))
    plan, small = mix_plan(sized, stage, weights=weights, share=share, cap=cap)
    source, whole, upto, copy = free_names(docs, "mix_source", "mix_whole", "mix_upto", "mix_copy")
    plan = plan.select(F.col("p_source").alias(source), F.col("whole").alias(whole), F.col("threshold").alias(upto))
    p = F.broadcast(plan) if small else plan
    copies = F.col(whole) + (document_hash(id_col, text_col) <= F.col(upto)).cast("long")
    return (docs.join(p, F.col(source_col).cast("string").eqNullSafe(F.col(source)))
            .withColumn(copy, F.explode(F.array_repeat(F.lit(0), copies.cast("int")))).select(*docs.columns))
