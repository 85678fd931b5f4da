"""Projections of the load: pair source and target columns (P1), swap
columns for expressions (P2), conform types (P6) and fold names (P8)."""

from __future__ import annotations

from typing import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidecopy.functions.geometry import GEOMETRY_TYPES, geometry_text
from tidecopy.operators.typemap import MappedColumn
from tidecopy.session import local_frame


def column_pairs(source_catalog: DataFrame, target_catalog: DataFrame) -> DataFrame:
    """Source column -> target column, paired by position.

    Both catalogs carry ``ordinal_position`` and ``column_name``; positions are
    renumbered 1..n per side (so a dropped unknown-type column does not shift
    the pairing) and joined. Raises when the two sides differ in length, or when
    a catalog holds several tables (their positions would pair across tables)."""
    from pyspark.sql import Window

    def numbered(cat: DataFrame, name: str) -> DataFrame:
        w = Window.partitionBy("table_schema", "table_name").orderBy("ordinal_position")
        return cat.select(F.row_number().over(w).alias("ord"), F.col("column_name").alias(name))

    src, tgt = numbered(source_catalog, "source_name"), numbered(target_catalog, "target_name")
    pairs = src.join(tgt, "ord", "full_outer")
    gap = F.col("source_name").isNull() | F.col("target_name").isNull()
    seen = pairs.agg(F.min(F.when(gap, F.col("ord"))).alias("gap"), F.count(F.lit(1)).alias("n"),
                     F.countDistinct("ord").alias("places")).first()
    if seen["n"] > seen["places"]:
        raise ValueError("column_pairs takes one table on each side: narrow the catalogs (see column_catalog)")
    if seen["gap"] is not None:
        raise ValueError(f"source and target column lists differ in length (first gap at {seen['gap']})")
    return pairs.select("ord", "source_name", "target_name")


def catalog_of(df: DataFrame, table_schema: str = "", table_name: str = "") -> DataFrame:
    """(table_schema, table_name, ordinal_position, column_name) of a DataFrame."""
    rows = [(table_schema, table_name, i + 1, f.name) for i, f in enumerate(df.schema.fields)]
    return local_frame(df.sparkSession, rows,
                       "table_schema string, table_name string, ordinal_position int, column_name string")


def replace_fields(df: DataFrame, replacements: Mapping[str, str | Column] | None) -> DataFrame:
    """Replace columns by SQL expressions (text or Column), keeping their
    positions; applied once, so update and insert see the same value."""
    if not replacements:
        return df
    missing = [c for c in replacements if c not in df.columns]
    if missing:
        raise ValueError(f"replace_fields names unknown columns: {missing}")
    return df.withColumns({c: (F.expr(e) if isinstance(e, str) else e) for c, e in replacements.items()})


def conform_column(src: Column, src_type: T.DataType, col: MappedColumn) -> Column:
    """Cast one source column to its stored type."""
    target = col.spark_type
    if isinstance(src_type, T.BinaryType) and col.data_type in GEOMETRY_TYPES:
        return geometry_text(src)  # stored bytes; a source's own select list gives text
    if col.data_type == "BYTEA" and isinstance(src_type, T.BinaryType):
        src = F.lower(F.hex(src))
    elif col.data_type == "ARRAY" and isinstance(src_type, T.ArrayType):
        src = F.to_json(src)
    elif col.data_type == "TIMESTAMP WITH TIME ZONE" and isinstance(src_type, T.TimestampType):  # in UTC, whatever the session's zone
        zero = F.lit(0)
        since = (F.unix_micros(src).cast("decimal(20,0)") * F.lit("0.000001").cast("decimal(6,6)")).cast("decimal(18,6)")
        src = F.lit("1970-01-01").cast("timestamp_ntz") + F.make_dt_interval(zero, zero, zero, since)
    elif target.startswith("decimal") and isinstance(src_type, T.BooleanType):
        src = src.cast("int")
    elif target.startswith("decimal") and isinstance(src_type, T.BinaryType):
        src = F.conv(F.hex(src), 16, 10)  # BIT(n) read as bytes
    if target == "string":
        text = src.cast("string")
        return F.substring(text, 1, col.char_length) if col.char_length else text
    return src.cast(target)


def conform(df: DataFrame, columns: Sequence[MappedColumn], *, rename: bool = True) -> DataFrame:
    """One select of the mapped columns in ordinal order, each cast to its
    stored type, renamed to the target name (``rename``). Columns of unknown
    types are not in ``columns`` and so are left out."""
    schema = {f.name: f.dataType for f in df.schema.fields}
    lower = {k.lower(): k for k in schema}
    out = []
    for c in columns:
        name = c.source_name if c.source_name in schema else lower.get(c.source_name.lower())
        if name is None:
            raise ValueError(f"source has no column {c.source_name!r}")
        out.append(conform_column(F.col(f"`{name}`"), schema[name], c).alias(c.target_name if rename else name))
    return df.select(*out)
