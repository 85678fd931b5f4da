"""Shards of near equal bytes from a k-d tree over document metadata.

A node of the tree holds some shards; it is split at the weighted median of its
widest metadata dimension (spread relative to the whole table's), so that both
sides get bytes in proportion to their shards, until a node holds one shard.
The median is found without sorting: bytes are summed by node and value bucket
(map side first, at most 1024 buckets a node go to the driver), and only the
bucket in which the median lies is split further, last by a hash, so that many
equal values don't matter. Rows of equal text share one point, and so a shard,
unless together they exceed a sixteenth of a shard; then they are spread over
as many points as needed, rows that share their id too: these are numbered,
from counts by partition of the staged table. The tree (shards - 1 cuts) becomes one expression.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidecopy.llm._store import Stage, shuffle_width, small

BUCKETS = 1024
DIMENSIONS = ("d_size", "d_source", "d_lang")
PART_OF_SHARD = 16      # a group of equal texts over this part of a shard's bytes is spread


def _ranks(meta: DataFrame, col: str, stage: Stage) -> tuple[DataFrame, int]:
    """Each value of ``col`` with its rank among the distinct values, in the order of their
    bytes, whatever their length; and how many there are. Sorted by range partitions."""
    apart = stage.write(meta.where(F.col(col).isNotNull()).select(col).distinct()
                        .repartitionByRange(shuffle_width(meta.sparkSession), col).withColumn("part", F.spark_partition_id()))
    sizes = apart.groupBy("part").agg(F.count(F.lit(1)).alias("n"))         # a row per range partition
    first = sizes.select(F.col("part").alias("f_part"), F.coalesce(F.sum("n").over(
        Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("first"))
    inside = F.row_number().over(Window.partitionBy("part").orderBy(col)) - 1
    ranks = apart.withColumn("inside", inside).join(F.broadcast(first), F.col("part") == F.col("f_part"))
    ranks = stage.write(ranks.select(F.col(col).alias(f"v_{col}"), (F.col("first") + F.col("inside")).alias(f"d_{col}")))
    return ranks, apart.count()


def _points(docs: DataFrame, stage: Stage, n_shards: int, id_col: str, text_col: str, source_col: str, lang_col: str) -> DataFrame:
    """doc_id, size, text_crc32, the row's point (dimensions and hash u), row hash r
    (of equal rows of a spread group, with the row's number)."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    meta = stage.write(docs.select(
        F.col(id_col).cast("long").alias("doc_id"), (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"), F.xxhash64(text).alias("t1"), F.xxhash64(text, F.lit("shard")).alias("t2"),
        F.xxhash64(F.col(id_col).cast("string"), text, F.lit("row")).alias("r"),
        F.col(source_col).cast("string").alias("source"), F.col(lang_col).cast("string").alias("lang"),
        F.spark_partition_id().alias("p")))
    for col in ("source", "lang"):
        ranks, n = _ranks(meta, col, stage)
        meta = (meta.join(small(ranks, n), F.col(col) == F.col(f"v_{col}"), "left").drop(col, f"v_{col}")
                .withColumn(f"d_{col}", F.coalesce(f"d_{col}", F.lit(-1).cast("long"))))
    meta = stage.write(meta)
    total = meta.agg(F.coalesce(F.sum("size"), F.lit(0))).first()[0]
    most = max(1, total // (n_shards * PART_OF_SHARD))
    groups = (meta.groupBy("t1", "t2").agg(F.sum("size").alias("w"), F.count(F.lit(1)).alias("n"),
                                           F.min("d_source").alias("g_source"), F.min("d_lang").alias("g_lang"))
              .where("n > 1").withColumnsRenamed({"t1": "g1", "t2": "g2"}))
    spread = F.greatest(F.lit(1), F.ceil(F.coalesce("w", F.lit(0)) / F.lit(most))).cast("long")
    rows = (meta.join(groups, (F.col("t1") == F.col("g1")) & (F.col("t2") == F.col("g2")), "left").withColumn("spread", spread))
    # equal rows (one id and text) of a spread group: 0, 1, ... over the partitions they were staged in
    hot = rows.where("spread > 1")
    by_p, all_p = Window.partitionBy("r").orderBy("p").rowsBetween(Window.unboundedPreceding, -1), Window.partitionBy("r")
    before = stage.write(
        hot.groupBy("r", "p").agg(F.count(F.lit(1)).alias("c"))
        .select("r", "p", F.coalesce(F.sum("c").over(by_p), F.lit(0)).alias("before"), F.sum("c").over(all_p).alias("equal"))
        .where("equal > 1").select("r", "p", "before"))
    hot = hot.join(before, ["r", "p"], "left")
    inside = Window.partitionBy("p", "r").orderBy("doc_id")
    numbered = hot.where("before is not null").withColumn("nth", F.col("before") + F.row_number().over(inside) - 1)
    none = F.lit(0).cast("long")
    rows = (rows.where("spread = 1").withColumn("nth", none)
            .unionByName(hot.where("before is null").drop("before").withColumn("nth", none))
            .unionByName(numbered.drop("before")))
    part = F.when(F.col("spread") > 1, F.pmod(F.pmod("r", "spread") + F.col("nth"), F.col("spread"))).otherwise(F.lit(0))
    return stage.write(rows.select(
        "doc_id", "size", "text_crc32", F.when(F.col("nth") > 0, F.xxhash64("r", "nth")).otherwise(F.col("r")).alias("r"),
        F.col("size").alias("d_size"),
        F.coalesce("g_source", "d_source").alias("d_source"), F.coalesce("g_lang", "d_lang").alias("d_lang"),
        F.shiftrightunsigned(F.xxhash64("t1", "t2", part), 2).alias("u")))


class _Cut:
    """Search of one node's weighted median along one column, then along the hash."""

    def __init__(self, node: int, column: str, lo: int, hi: int, goal: float):
        self.node, self.column, self.lo, self.hi, self.goal = node, column, lo, hi, goal
        self.value: int | None = None        # the cut lies inside this value of the dimension
        self.done: tuple | None = None

    def where(self) -> Column:
        c = (F.col("node") == self.node) & F.col(self.axis).between(self.lo, self.hi)
        return c if self.value is None else c & (F.col(self.column) == self.value)

    @property
    def axis(self) -> str:
        return self.column if self.value is None else "u"

    @property
    def width(self) -> int:
        return (self.hi - self.lo) // BUCKETS + 1

    def narrow(self, buckets: list[tuple[int, int, int, int, int]]) -> None:
        """buckets: (bucket, bytes, least, greatest, least u) in order."""
        before = 0
        for i, (_, n, lo, hi) in enumerate(buckets):
            if before + n >= self.goal or i == len(buckets) - 1:
                if lo < hi:
                    self.goal, self.lo, self.hi = self.goal - before, lo, hi
                elif self.value is None:
                    self.goal, self.value, self.lo, self.hi = self.goal - before, lo, 0, 2**62 - 1
                else:  # one point: on the side that leaves the smaller difference
                    inside = before + n - self.goal <= self.goal - before
                    self.done = (self.column, self.value, lo if inside else lo - 1)
                return
            before += n


def _split(points: DataFrame, nodes: dict[int, int], whole: dict[str, int]) -> dict[int, tuple]:
    """Cut of each node (number -> shards): column, value, hash up to which rows go left."""
    rows = points.where(F.col("node").isin(list(nodes)))
    spans = [f(d).alias(f"{n}_{d}") for d in DIMENSIONS for f, n in ((F.min, "lo"), (F.max, "hi"))]
    cuts = []
    for s in rows.groupBy("node").agg(F.sum("size").alias("n"), *spans).collect():   # a row per node
        wide = max(DIMENSIONS, key=lambda d: (s[f"hi_{d}"] - s[f"lo_{d}"]) / max(1, whole[d]))
        k = nodes[s["node"]]
        cuts.append(_Cut(s["node"], wide, s[f"lo_{wide}"], s[f"hi_{wide}"], s["n"] * (k // 2) / k))
    while todo := [c for c in cuts if c.done is None]:
        axis, bucket, which = F.lit(None).cast("long"), F.lit(None).cast("long"), F.lit(None).cast("int")
        for i, c in enumerate(todo):
            axis = F.when(c.where(), F.col(c.axis)).otherwise(axis)
            bucket = F.when(c.where(), F.expr(f"({c.axis} - {c.lo}L) div {c.width}L")).otherwise(bucket)
            which = F.when(c.where(), F.lit(i)).otherwise(which)
        hist = (rows.select("size", which.alias("i"), bucket.cast("long").alias("b"), axis.alias("x")).where("i is not null")
                .groupBy("i", "b").agg(F.sum("size").alias("n"), F.min("x").alias("lo"), F.max("x").alias("hi")).collect())
        for i, c in enumerate(todo):   # at most 1025 rows a node
            c.narrow(sorted((h["b"], h["n"], h["lo"], h["hi"]) for h in hist if h["i"] == i))
    return {c.node: c.done for c in cuts}


def kd_shards(docs: DataFrame, n_shards: int = 16, *, id_col: str = "doc_id", text_col: str = "text",
              source_col: str = "source", lang_col: str = "lang") -> DataFrame:
    """One row per row of ``docs``: doc_id, size (UTF-8 bytes of the text + 1),
    text_crc32, law (``bytes``), shard, slot (0, 1, ... within the shard), grown_shard (null).

    A null text counts as empty; null metadata sorts first; rows with a null or
    repeated id each have their slot; an empty table gives an empty result; other
    columns don't matter. Only metadata is shuffled, never a text.
    """
    spark = docs.sparkSession
    stage = Stage(spark, "shard")
    points = _points(docs, stage, n_shards, id_col, text_col, source_col, lang_col)
    ends = points.agg(*[f(d).alias(f"{n}_{d}") for d in DIMENSIONS for f, n in ((F.min, "lo"), (F.max, "hi"))]).first()
    whole = {d: (ends[f"hi_{d}"] or 0) - (ends[f"lo_{d}"] or 0) for d in DIMENSIONS}
    # nodes are named by their first shard; a cut sends rows right by changing the name
    points, nodes = points.withColumn("node", F.lit(0)), {0: n_shards}
    while wide := {name: k for name, k in nodes.items() if k > 1}:
        cuts, side = _split(points, wide, whole), F.col("node")
        for name, k in wide.items():
            nodes[name], nodes[name + k // 2] = k // 2, k - k // 2
            if name in cuts:
                column, value, upto = cuts[name]
                goes_left = (F.col(column) < value) | ((F.col(column) == value) & (F.col("u") <= upto))
                side = F.when((F.col("node") == name) & ~goes_left, F.lit(name + k // 2)).otherwise(side)
        points = points.withColumn("node", side)
    placed = points.withColumnRenamed("node", "shard")
    # slots: rows are numbered within (shard, part), parts one after another
    parts = shuffle_width(spark) * 4
    placed = placed.withColumn("part", F.pmod(F.col("r"), F.lit(parts)).cast("int"))
    first = Window.partitionBy("shard").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (placed.groupBy("shard", "part").agg(F.count(F.lit(1)).alias("n"))
               .select("shard", "part", F.coalesce(F.sum("n").over(first), F.lit(0)).alias("before")))
    inside = Window.partitionBy("shard", "part").orderBy("doc_id", "r")
    numbered = placed.withColumn("at_part", F.row_number().over(inside) - 1)
    # n_shards * parts rows
    return numbered.join(F.broadcast(offsets), ["shard", "part"]).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard",
        (F.col("before") + F.col("at_part")).cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard"))
