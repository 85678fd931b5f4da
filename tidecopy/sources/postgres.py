"""Column catalogs of a PostgreSQL source: its information_schema has no column type text,
describes arrays, enums and extension types as ``ARRAY`` and ``USER-DEFINED``, and a domain
over a domain by the inner domain's name. ``postgres_catalog`` brings them to the catalog
shape that the type map reads (see ``typemap.POSTGRES_RULES``)."""

from __future__ import annotations

from typing import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidecopy.session import local_frame
from tidecopy.sources.catalog import CATALOG_SCHEMA, TABLES_SCHEMA, measured_widths

_TEXT, _LONG, _INT = T.StringType(), T.LongType(), T.IntegerType()
_SHAPE = {"data_type": _TEXT, "udt_schema": _TEXT, "udt_name": _TEXT, "character_maximum_length": _LONG,
          "numeric_precision": _INT, "numeric_scale": _INT}


def _schema(**types: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in types.items()])


COLUMNS_SCHEMA = _schema(table_catalog=_TEXT, table_schema=_TEXT, table_name=_TEXT, column_name=_TEXT, ordinal_position=_INT, **_SHAPE)
DOMAINS_SCHEMA = _schema(domain_schema=_TEXT, domain_name=_TEXT, **_SHAPE)
ENUMS_SCHEMA = _schema(type_schema=_TEXT, type_name=_TEXT)
# The widest declared character varying of the source server; names of its
# extension types by what they hold; element types by their catalog names.
VARCHAR_MAX_CHARS = 10485760
EXTENSION_TYPES = {"geometry": "geometry", "geography": "geometry", "citext": "text"}
ELEMENT_NAMES = {"int2": "smallint", "int4": "integer", "int8": "bigint", "float4": "real", "float8": "double precision",
                 "bool": "boolean", "bpchar": "character", "varchar": "character varying", "varbit": "bit varying",
                 "timestamp": "timestamp without time zone", "timestamptz": "timestamp with time zone",
                 "time": "time without time zone", "timetz": "time with time zone"}


def _renamed(names: Mapping[str, str], value: Column) -> Column:
    table = F.create_map(*[F.lit(x) for pair in names.items() for x in pair])
    return F.coalesce(F.element_at(table, value), value)


def _through_domains(df: DataFrame, domains: DataFrame) -> DataFrame:
    """Replace the type of every column declared as one of ``domains`` by the domain's own."""
    inner = domains.select(F.col("domain_schema").alias("_s"), F.col("domain_name").alias("_n"),
                           *[F.col(c).alias(f"_{c}") for c in _SHAPE])
    hit = F.col("_n").isNotNull()
    own = ("character_maximum_length", "numeric_precision", "numeric_scale")
    resolved = {c: F.when(hit, F.coalesce(F.col(c), F.col(f"_{c}")) if c in own else F.col(f"_{c}")).otherwise(F.col(c))
                for c in _SHAPE}
    return (df.join(inner, (F.col("data_type") == "USER-DEFINED") & (F.col("udt_schema") == F.col("_s"))
                    & (F.col("udt_name") == F.col("_n")), "left")
            .select(*[resolved.get(c, F.col(c)).alias(c) for c in df.columns]))


def resolve_domains(domains: DataFrame) -> DataFrame:
    """Domains with the types at the end of their chains; the length and precision come
    from the outermost domain that declares them. One row per domain on the driver."""
    rows = {(r["domain_schema"], r["domain_name"]): r.asDict() for r in domains.collect()}

    def ends(name) -> dict:
        seen, shape = [name], dict(rows[name])
        while shape["data_type"] == "USER-DEFINED" and (inner := (shape["udt_schema"], shape["udt_name"])) in rows:
            if inner in seen:
                raise ValueError(f"domains refer to each other in a circle: {seen}")
            seen.append(inner)
            shape = {k: v if k.startswith(("domain_", "data_", "udt_")) or shape[k] is None else shape[k]
                     for k, v in rows[inner].items()}
        return shape | {"domain_schema": name[0], "domain_name": name[1]}

    ended = [ends(name) for name in rows]
    return local_frame(domains.sparkSession, [tuple(d[f] for f in DOMAINS_SCHEMA.names) for d in ended], DOMAINS_SCHEMA)


def postgres_catalog(columns: DataFrame, domains: DataFrame | None = None, enums: DataFrame | None = None) -> DataFrame:
    """Catalog rows (``CATALOG_SCHEMA``) of PostgreSQL's ``information_schema.columns``.
    Columns of a domain get the type that ends its chain; enums become ``enum``; arrays keep
    ``ARRAY`` with their element type in ``column_type`` (``integer[]``); other types that
    the server does not own keep their own name, to be mapped (geometry, citext) or reported
    as unknown. Numerics whose scale lies outside 0 .. precision get the precision they need."""
    spark = columns.sparkSession
    cols = columns.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in COLUMNS_SCHEMA.fields])
    if domains is not None:
        cols = _through_domains(cols, resolve_domains(domains))
    enums = enums if enums is not None else local_frame(spark, [], ENUMS_SCHEMA)
    marks = enums.select(F.col("type_schema").alias("udt_schema"), F.col("type_name").alias("udt_name"), F.lit(True).alias("_enum"))
    cols = cols.join(marks.dropDuplicates(["udt_schema", "udt_name"]), ["udt_schema", "udt_name"], "left")
    user = F.col("data_type") == "USER-DEFINED"
    named = (F.when(user & F.col("_enum"), "enum").when(user, _renamed(EXTENSION_TYPES, F.col("udt_name")))
             .otherwise(F.col("data_type")))
    element = _renamed(ELEMENT_NAMES, F.regexp_replace("udt_name", "^_", ""))
    scale, precision = F.col("numeric_scale"), F.col("numeric_precision")
    numeric = F.col("data_type") == "numeric"
    length = F.col("character_maximum_length").cast("string")
    cols = cols.withColumns({
        "data_type": named,
        "numeric_precision": F.when(numeric & (scale < 0), precision - scale)
                              .when(numeric & (scale > precision), scale).otherwise(precision),
        "numeric_scale": F.when(numeric & (scale < 0), F.lit(0)).otherwise(scale)})
    named = F.col("data_type")
    cols = cols.withColumns({
        "column_type": F.when(named == "ARRAY", F.concat(element, F.lit("[]")))
                        .when(length.isNotNull(), F.concat(named, F.lit("("), length, F.lit(")")))
                        .when(numeric & precision.isNotNull(),
                              F.concat(named, F.lit("("), precision.cast("string"), F.lit(","), scale.cast("string"), F.lit(")")))
                        .otherwise(named)})
    return cols.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in CATALOG_SCHEMA.fields])


def postgres_information_schema(spark: SparkSession, url: str, properties: Mapping[str, str] | None = None,
                                schema: str | None = None) -> tuple[DataFrame, DataFrame]:
    """(columns, tables) of a PostgreSQL source in the catalog shape, read over JDBC; the
    schema filter of columns and tables is pushed into the source (domains and enums may
    lie in any schema)."""
    from tidecopy.sources.jdbc import JdbcTable, jdbc_query, jdbc_scan

    read = lambda view, of: jdbc_scan(spark, url, f"information_schema.{view}", columns=of.names,
                                      properties=properties)
    cast = lambda df, of: df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in of.fields])
    columns, tables = read("columns", COLUMNS_SCHEMA), read("tables", TABLES_SCHEMA)
    if schema is not None:
        columns, tables = columns.where(F.col("table_schema") == schema), tables.where(F.col("table_schema") == schema)
    enums = jdbc_query(spark, JdbcTable(url, "", dict(properties or {})),
                       "SELECT n.nspname AS type_schema, t.typname AS type_name FROM pg_catalog.pg_type t "
                       "JOIN pg_catalog.pg_namespace n ON n.oid = t.typnamespace WHERE t.typtype = 'e'")
    return postgres_catalog(columns, cast(read("domains", DOMAINS_SCHEMA), DOMAINS_SCHEMA), cast(enums, ENUMS_SCHEMA)), tables


# The source type that a Spark type stands for, and an array's element name.
_OF_SPARK = {"bigint": ("bigint", "int8", 64, 0), "int": ("integer", "int4", 32, 0), "smallint": ("smallint", "int2", 16, 0),
             "tinyint": ("smallint", "int2", 16, 0), "boolean": ("boolean", "bool", None, None),
             "float": ("real", "float4", 24, None), "double": ("double precision", "float8", 53, None),
             "date": ("date", "date", None, None), "binary": ("bytea", "bytea", None, None),
             "timestamp_ntz": ("timestamp without time zone", "timestamp", None, None),
             "timestamp": ("timestamp with time zone", "timestamptz", None, None)}


def postgres_columns(spark: SparkSession, frames: Mapping[str, DataFrame], *, table_schema: str,
                     table_catalog: str = "db", measure: bool = False) -> DataFrame:
    """DataFrames described as PostgreSQL's ``information_schema.columns`` would; with
    ``measure`` text columns are declared as wide as their longest value."""
    widths = measured_widths(frames) if measure else {}
    rows = []
    for name, df in frames.items():
        for i, f in enumerate(df.schema.fields):
            kind, width = f.dataType, widths.get((name, f.name))
            if isinstance(kind, T.StringType):
                fits = width is not None and width <= VARCHAR_MAX_CHARS
                shape = ("character varying", "varchar", max(width, 1), None, None) if fits else ("text", "text", None, None, None)
            elif isinstance(kind, T.DecimalType):
                shape = ("numeric", "numeric", None, kind.precision, kind.scale)
            elif isinstance(kind, T.ArrayType) and kind.elementType.simpleString() in _OF_SPARK:
                shape = ("ARRAY", f"_{_OF_SPARK[kind.elementType.simpleString()][1]}", None, None, None)
            elif kind.simpleString() in _OF_SPARK:
                base, udt, precision, scale = _OF_SPARK[kind.simpleString()]
                shape = (base, udt, None, precision, scale)
            else:
                shape = ("jsonb", "jsonb", None, None, None)
            rows.append((table_catalog, table_schema, name, f.name, i + 1, shape[0], "pg_catalog", *shape[1:]))
    return local_frame(spark, rows, COLUMNS_SCHEMA)
