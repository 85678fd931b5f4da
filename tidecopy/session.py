"""Session helpers: build a session for tests and benches, locate the shared
checkpoint folder, and stage a DataFrame so that it is read from its source once."""

from __future__ import annotations

import os
import re
import uuid

from pyspark.sql import DataFrame, SparkSession


def build_session(master: str | None = None, *, app_name: str = "tidecopy",
                  shuffle_partitions: int | None = None,
                  extra: dict[str, str] | None = None) -> SparkSession:
    """Session with AQE on and the UI off. On a cluster the master and the
    shared folders come from the cluster's own configuration."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = {
        "spark.ui.enabled": "false",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        # replicate_all runs tables side by side in their own pools
        "spark.scheduler.mode": "FAIR",
    }
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    try:
        spark.sparkContext.setLogLevel("ERROR")
    except Exception:  # Spark Connect: no local context
        pass
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder for staged data: the context's checkpoint dir, else the
    cluster's ``spark.checkpoint.dir``. Only a local session, where one machine is
    all there is, gets a folder under its warehouse if neither is set; on a
    cluster such a folder would lose staged rows, so there this raises."""
    try:
        sc = spark.sparkContext
    except Exception:  # a Spark Connect client: the server's setting applies
        conf_dir = spark.conf.get("spark.checkpoint.dir", None)
    else:
        current = sc.getCheckpointDir()
        if current:
            return current
        conf_dir = sc.getConf().get("spark.checkpoint.dir", None)
        if not conf_dir and re.match(r"local(\[|$)", sc.master):
            conf_dir = os.path.join(warehouse_dir(spark), "_checkpoints")
        if conf_dir:
            sc.setCheckpointDir(conf_dir)
            return sc.getCheckpointDir() or conf_dir
    if not conf_dir:
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    return conf_dir


def warehouse_dir(spark: SparkSession) -> str:
    path = spark.conf.get("spark.sql.warehouse.dir")
    return path[len("file:"):] if path.startswith("file:") else path


def stage(df: DataFrame) -> DataFrame:
    """Write ``df`` once as Parquet in the shared checkpoint folder and read it back.

    Used for rows pulled from a live source (the delta of a merge), so that the
    count, the duplicate guard and the merge all see the same rows. Later reads
    take only the columns they need; lost executors do not lose it. ``unstage``
    deletes it once nothing reads it any more."""
    spark, schema = df.sparkSession, df.schema
    path = f"{checkpoint_dir(spark)}/stage-{uuid.uuid4().hex}"
    df.write.parquet(path)
    out = spark.read.schema(schema).parquet(path)
    out.staged_path = path
    return out


def unstage(df: DataFrame) -> None:
    """Delete a staged frame's files (no-op for other frames, and where the client has no JVM)."""
    path = getattr(df, "staged_path", None)
    if path:
        remove_path(df.sparkSession, path)


def remove_path(spark: SparkSession, path: str) -> None:
    try:
        jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    except Exception:  # Spark Connect: left to the folder's own clean-up
        return
    where = jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(conf).delete(where, True)


def local_frame(spark: SparkSession, rows, schema) -> DataFrame:
    """A small DataFrame of driver-side rows (catalog rows, statuses), handed
    to the JVM as one Arrow table: a local relation, no Python workers."""
    import pyarrow as pa
    from pyspark.sql import types as T
    from pyspark.sql.pandas.types import to_arrow_schema

    struct = T.DataType.fromDDL(schema) if isinstance(schema, str) else schema
    names = struct.names
    table = pa.Table.from_pylist([dict(zip(names, r)) for r in rows], schema=to_arrow_schema(struct))
    df = spark.createDataFrame(table)
    # keep the declared types and nullability exactly
    return df if df.schema == struct else df.select(
        *[df[f.name].cast(f.dataType).alias(f.name) for f in struct.fields])
