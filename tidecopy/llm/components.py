"""Connected components of a link table, by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidecopy.llm._store import Stage


def components(links: DataFrame, stage: Stage) -> DataFrame:
    """``links``: a, b (long). Result: node, comp (the least node it is connected with),
    for every node that has a link to another.

    Each round every node's larger neighbours are linked to its least neighbour,
    then its smaller ones and itself, until nothing changes: a number of rounds
    that grows with the logarithm of the longest path. Only the edges move, a
    node's neighbours are never gathered (a least neighbour is a map-side
    combined minimum), and every round's edges are staged."""
    e = stage.write(links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u > v").distinct())
    before = None
    while True:
        both = e.unionAll(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u > v").distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u")
        e_new = stage.write(small.select(F.col("v").alias("u"), F.col("m").alias("v")).where("u > v")
                            .unionAll(least.select("u", F.col("m").alias("v"))).distinct())
        state = e_new.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first()
        stage.drop(e)
        e = e_new
        if state == before:
            break
        before = state
    return e.select(F.col("u").alias("node"), F.col("v").alias("comp")).unionAll(
        e.select(F.col("v").alias("node"), F.col("v").alias("comp")).distinct())
