"""Column catalogs: read one from a JDBC source's information_schema, or
describe DataFrames in the same shape, then narrow it to one table (S2)."""

from __future__ import annotations

from typing import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidecopy.session import local_frame

CATALOG_SCHEMA = T.StructType([
    T.StructField("table_catalog", T.StringType()),
    T.StructField("table_schema", T.StringType()),
    T.StructField("table_name", T.StringType()),
    T.StructField("column_name", T.StringType()),
    T.StructField("ordinal_position", T.IntegerType()),
    T.StructField("data_type", T.StringType()),
    T.StructField("column_type", T.StringType()),
    T.StructField("character_maximum_length", T.LongType()),
    T.StructField("numeric_precision", T.IntegerType()),
    T.StructField("numeric_scale", T.IntegerType()),
])
TABLES_SCHEMA = T.StructType([
    T.StructField("table_catalog", T.StringType()),
    T.StructField("table_schema", T.StringType()),
    T.StructField("table_name", T.StringType()),
    T.StructField("table_type", T.StringType()),
])
# Schemas of the source servers that are never replicated.
SYSTEM_SCHEMAS = ("information_schema", "performance_schema", "mysql", "pg_catalog")
LONGTEXT_CHARS = 4294967295
# Widest VARCHAR (characters, 4-byte charset) and VARBINARY (bytes)
# of the source server; wider measured columns are described as LONGTEXT / LONGBLOB.
VARCHAR_MAX_CHARS = 16383
VARBINARY_MAX_BYTES = 65535


def source_type_of(dt: T.DataType, width: int | None = None) -> tuple[str, str, int | None, int | None, int | None]:
    """(data_type, column_type, char length, precision, scale) of the source
    column a Spark type stands for; arrays of numbers are vectors (no mapping).
    A measured ``width`` (longest value) makes a string VARCHAR(width) and a
    binary VARBINARY(width) when they fit."""
    if width is not None and isinstance(dt, T.StringType) and not isinstance(dt, (T.CharType, T.VarcharType)):
        n = max(int(width), 1)
        if n <= VARCHAR_MAX_CHARS:
            return "varchar", f"varchar({n})", n, None, None
    if width is not None and isinstance(dt, T.BinaryType):
        n = max(int(width), 1)
        if n <= VARBINARY_MAX_BYTES:
            return "varbinary", f"varbinary({n})", n, None, None
    if isinstance(dt, T.LongType):
        return "bigint", "bigint", None, 19, 0
    if isinstance(dt, T.IntegerType):
        return "int", "int", None, 10, 0
    if isinstance(dt, T.ShortType):
        return "smallint", "smallint", None, 5, 0
    if isinstance(dt, T.ByteType):
        return "tinyint", "tinyint", None, 3, 0
    if isinstance(dt, T.BooleanType):
        return "tinyint", "tinyint(1)", None, 3, 0
    if isinstance(dt, T.FloatType):
        return "float", "float", None, 12, None
    if isinstance(dt, T.DoubleType):
        return "double", "double", None, 22, None
    if isinstance(dt, T.DecimalType):
        return "decimal", f"decimal({dt.precision},{dt.scale})", None, dt.precision, dt.scale
    if isinstance(dt, T.CharType):
        return "char", f"char({dt.length})", dt.length, None, None
    if isinstance(dt, T.VarcharType):
        return "varchar", f"varchar({dt.length})", dt.length, None, None
    if isinstance(dt, T.StringType):
        return "longtext", "longtext", LONGTEXT_CHARS, None, None
    if isinstance(dt, T.BinaryType):
        return "longblob", "longblob", LONGTEXT_CHARS, None, None
    if isinstance(dt, T.DateType):
        return "date", "date", None, None, None
    if isinstance(dt, T.TimestampNTZType):
        return "datetime", "datetime(6)", None, None, None
    if isinstance(dt, T.TimestampType):
        return "timestamp", "timestamp(6)", None, None, None
    if isinstance(dt, T.ArrayType) and isinstance(dt.elementType, T.NumericType):
        return "vector", "vector", None, None, None
    return "json", "json", None, None, None


def measured_widths(frames: Mapping[str, DataFrame]) -> dict[tuple[str, str], int]:
    """Longest value of every string (characters) and binary (bytes) column,
    over the whole data: one aggregation per table (partial maxima per task),
    all tables in one job whose scan stages run side by side."""
    parts = []
    for name, df in frames.items():
        aggs = []
        for f in df.schema.fields:
            c = F.col(f"`{f.name}`")
            if isinstance(f.dataType, T.StringType):
                aggs.append(F.max(F.char_length(c)).alias(f.name))
            elif isinstance(f.dataType, T.BinaryType):
                aggs.append(F.max(F.octet_length(c)).alias(f.name))
        if aggs:
            maxima = df.agg(*aggs)
            parts.append(maxima.unpivot([], [a for a in maxima.columns], "column_name", "width")
                         .select(F.lit(name).alias("table_name"), "column_name",
                                 F.coalesce(F.col("width"), F.lit(0)).cast("long").alias("width")))
    if not parts:
        return {}
    union = parts[0]
    for p in parts[1:]:
        union = union.unionByName(p)
    return {(r["table_name"], r["column_name"]): r["width"] for r in union.collect()}


def catalog_from_frames(spark: SparkSession, frames: Mapping[str, DataFrame], *,
                        table_schema: str, table_catalog: str = "def", measure: bool = False) -> DataFrame:
    """Describe DataFrames as catalog rows. From the schema alone by default;
    with ``measure`` the string and binary widths are measured over the whole
    data (see ``measured_widths``), as a source catalog would declare them."""
    rows = []
    widths = measured_widths(frames) if measure else {}
    for name, df in frames.items():
        for i, f in enumerate(df.schema.fields):
            dtype, ctype, length, prec, scale = source_type_of(f.dataType, widths.get((name, f.name)))
            rows.append((table_catalog, table_schema, name, f.name, i + 1, dtype, ctype, length, prec, scale))
    return local_frame(spark, rows, CATALOG_SCHEMA)


def tables_from_frames(spark: SparkSession, frames: Mapping[str, DataFrame], *,
                       table_schema: str, table_catalog: str = "def") -> DataFrame:
    rows = [(table_catalog, table_schema, name, "BASE TABLE") for name in frames]
    return local_frame(spark, rows, TABLES_SCHEMA)


def jdbc_catalog(spark: SparkSession, url: str, properties: Mapping[str, str] | None = None,
                 schema: str | None = None) -> tuple[DataFrame, DataFrame]:
    """information_schema.columns and .tables of a MySQL-like or PostgreSQL source, read
    over JDBC (the schema filter is pushed into the source)."""
    from tidecopy.sources.jdbc import jdbc_scan

    if url.startswith("jdbc:postgresql:"):
        from tidecopy.sources.postgres import postgres_information_schema

        return postgres_information_schema(spark, url, properties, schema)

    cols = jdbc_scan(spark, url, "information_schema.columns", columns=list(CATALOG_SCHEMA.names),
                     properties=properties)
    tabs = jdbc_scan(spark, url, "information_schema.tables", columns=list(TABLES_SCHEMA.names),
                     properties=properties)
    if schema is not None:
        cols, tabs = cols.where(F.col("table_schema") == schema), tabs.where(F.col("table_schema") == schema)
    cols = cols.select(*[F.col(f.name).cast(f.dataType) for f in CATALOG_SCHEMA.fields])
    return cols, tabs


def column_catalog(columns: DataFrame, tables: DataFrame, schema: str | None = None,
                   table: str | None = None) -> DataFrame:
    """Columns of base tables outside the system schemas, optionally of one
    schema and table (exact names)."""
    joined = columns.join(tables.select("table_catalog", "table_schema", "table_name", "table_type"),
                          ["table_catalog", "table_schema", "table_name"], "inner")
    cond = (F.col("table_type") == "BASE TABLE") & ~F.col("table_schema").isin(*SYSTEM_SCHEMAS)
    if schema is not None:
        cond &= F.col("table_schema") == schema
    if table is not None:
        cond &= F.col("table_name") == table
    return joined.where(cond).select(*CATALOG_SCHEMA.names)
