"""Staged tables in the shared checkpoint folder.

Staging cuts lineage: a staged table is written once, with Spark's commit
protocol, where every executor can read it, so a lost executor costs a task and
not a recomputation of the stages before.
"""

from __future__ import annotations

import gc
import time
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidecopy.session import checkpoint_dir


class Stage:
    """Tables that one run of an operator writes and, when it can, drops again."""

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.root = f"{checkpoint_dir(spark)}/{name}-{uuid.uuid4().hex}"
        self._n = 0

    def write(self, df: DataFrame, partition_by: list[str] | None = None) -> DataFrame:
        """``df`` as Parquet, read back."""
        self._n += 1
        path = f"{self.root}/{self._n}"
        schema = df.schema
        writer = df.write.option("compression", "zstd")
        if partition_by:
            writer = writer.partitionBy(*partition_by)
        writer.parquet(path)
        out = self.spark.read.schema(schema).parquet(path)
        out.staged_path = path
        return out

    def drop(self, *frames: DataFrame) -> None:
        """Delete staged tables that no later read needs."""
        jvm = self.spark._jvm
        for df in frames:
            path = jvm.org.apache.hadoop.fs.Path(df.staged_path)
            path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)

    def release(self) -> None:
        """Let Spark's cleaner delete the shuffle files of jobs that are over: it acts
        when the driver's garbage is collected, which may be long after large shuffles.
        The cleaner works beside the driver, so it gets a moment before the next shuffle."""
        for _ in range(2):
            gc.collect()
            self.spark._jvm.System.gc()
            time.sleep(0.5)


def free_names(df: DataFrame, *names: str) -> list[str]:
    """The names, each lengthened until ``df`` has no column of that name."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in names:
        while name in taken:
            name += "_"
        taken.add(name)
        out.append(name)
    return out


def text_bytes(col: str = "text") -> Column:
    """The text's UTF-8 bytes (a string column cast to binary; null stays null)."""
    return F.col(col).cast("string").cast("binary")


def row_key(id_col: str, text_col: str) -> list[Column]:
    """128 bits that name a row by its id and text; equal rows share them."""
    i, t = F.col(id_col).cast("string"), F.col(text_col).cast("string")
    return [F.xxhash64(i, t).alias("k1"), F.xxhash64(t, F.lit("key"), i).alias("k2")]


def shuffle_width(spark: SparkSession) -> int:
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))


BROADCAST_ROWS = 2_000_000     # rows of two or three numbers (under 100 MB in memory) that are broadcast


def small(df: DataFrame, rows: int | None = None) -> DataFrame:
    """``df``, to be broadcast if its rows, counted, are at most ``BROADCAST_ROWS``;
    otherwise left to Spark, which shuffles. For staged frames of a few numbers a row."""
    n = df.count() if rows is None else rows
    return F.broadcast(df) if n <= BROADCAST_ROWS else df
