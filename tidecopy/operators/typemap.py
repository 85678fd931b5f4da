"""Column-catalog operators: map source column types to target types (P9),
list the columns left out (P7) and render the DDL / import text per table (V5).

All of it runs as DataFrame expressions over a catalog DataFrame (one row per
source column), so a whole database catalog is mapped in one job."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The source type names the mapping knows and, for each, the target
# DDL type, the source-side select expression used on full load, the Spark type
# of the stored column and the character limit of the stored text.
# Placeholders: %COL% source column name, %CTYPE% upper(column_type),
# %LEN% character_maximum_length, %PREC% numeric_precision,
# %BITP% numeric_precision capped at 38. DECIMAL has its own rule (decimal_rule).
TYPE_RULES = (
    ("INT", "DECIMAL(11,0)", "`%COL%`", "decimal(11,0)", None),
    ("INTEGER", "DECIMAL(11,0)", "`%COL%`", "decimal(11,0)", None),
    ("TINYINT", "DECIMAL(4,0)", "`%COL%`", "decimal(4,0)", None),
    ("SMALLINT", "DECIMAL(5,0)", "`%COL%`", "decimal(5,0)", None),
    ("MEDIUMINT", "DECIMAL(9,0)", "`%COL%`", "decimal(9,0)", None),
    ("BIGINT", "DECIMAL (20,0)", "`%COL%`", "decimal(20,0)", None),
    ("FLOAT", "FLOAT", "`%COL%`", "double", None),
    ("DOUBLE", "DOUBLE", "`%COL%`", "double", None),
    ("DECIMAL", None, "`%COL%`", None, None),
    ("BIT", "DECIMAL(%PREC%,0)", "cast(`%COL%` as DECIMAL(%PREC%,0))", "decimal(%BITP%,0)", None),
    ("DATE", "DATE", "`%COL%`", "date", None),
    ("DATETIME", "TIMESTAMP", "`%COL%`", "timestamp_ntz", None),
    ("TIMESTAMP", "TIMESTAMP", "`%COL%`", "timestamp_ntz", None),
    ("TIME", "varchar(8)", "cast(`%COL%` as char(8))", "string", "8"),
    ("YEAR", "varchar(4)", "cast(`%COL%` as char(4))", "string", "4"),
    ("CHAR", "%CTYPE%", "`%COL%`", "string", None),
    ("VARCHAR", "%CTYPE%", "`%COL%`", "string", None),
    ("BINARY", "char(%LEN%)", "cast(`%COL%` as char(%LEN%))", "string", "%LEN%"),
    ("VARBINARY", "varchar(%LEN%)", "cast(`%COL%` as char(%LEN%))", "string", "%LEN%"),
    ("TINYTEXT", "varchar(2000000)", "`%COL%`", "string", None),
    ("TEXT", "varchar(2000000)", "`%COL%`", "string", None),
    ("MEDIUMTEXT", "varchar(2000000)", "`%COL%`", "string", None),
    ("LONGTEXT", "varchar(2000000)", "`%COL%`", "string", None),
    ("TINYBLOB", "varchar(2000000)", "cast(`%COL%` as char(2000000))", "string", "2000000"),
    ("BLOB", "varchar(2000000)", "cast(`%COL%` as char(2000000))", "string", "2000000"),
    ("MEDIUMBLOB", "varchar(2000000)", "cast(`%COL%` as char(2000000))", "string", "2000000"),
    ("LONGBLOB", "varchar(2000000)", "cast(`%COL%` as char(2000000))", "string", "2000000"),
    ("ENUM", "varchar(2000000)", "`%COL%`", "string", None),
    ("SET", "varchar(2000000)", "`%COL%`", "string", None),
    ("JSON", "varchar(2000000)", "`%COL%`", "string", None),
    ("GEOMETRY", "%CTYPE%", "ST_AsText(`%COL%`)", "string", None),
    ("GEOMETRYCOLLECTION", "GEOMETRY", "ST_AsText(`%COL%`)", "string", None),
    ("POINT", "GEOMETRY", "ST_AsText(`%COL%`)", "string", None),
    ("MULTIPOINT", "GEOMETRY", "ST_AsText(`%COL%`)", "string", None),
    ("LINESTRING", "GEOMETRY", "ST_AsText(`%COL%`)", "string", None),
    ("MULTILINESTRING", "GEOMETRY", "ST_AsText(`%COL%`)", "string", None),
    ("POLYGON", "GEOMETRY", "ST_AsText(`%COL%`)", "string", None),
    ("MULTIPOLYGON", "GEOMETRY", "ST_AsText(`%COL%`)", "string", None),
)
# The same for the type names of a PostgreSQL catalog (see
# sources.postgres); %VLEN% is the declared length, or 2000000. Times with a zone are
# stored in UTC, bytes as hex digits, arrays as JSON.
POSTGRES_RULES = (
    ("SMALLINT", "DECIMAL(5,0)", '"%COL%"', "decimal(5,0)", None),
    ("INTEGER", "DECIMAL(11,0)", '"%COL%"', "decimal(11,0)", None),
    ("BIGINT", "DECIMAL (20,0)", '"%COL%"', "decimal(20,0)", None),
    ("OID", "DECIMAL(11,0)", 'cast("%COL%" as bigint)', "decimal(11,0)", None),
    ("NUMERIC", None, '"%COL%"', None, None),
    ("MONEY", "DECIMAL(19,2)", 'cast("%COL%" as numeric(19,2))', "decimal(19,2)", None),
    ("REAL", "FLOAT", '"%COL%"', "double", None),
    ("DOUBLE PRECISION", "DOUBLE", '"%COL%"', "double", None),
    ("BOOLEAN", "BOOLEAN", '"%COL%"', "boolean", None),
    ("DATE", "DATE", '"%COL%"', "date", None),
    ("TIMESTAMP WITHOUT TIME ZONE", "TIMESTAMP", '"%COL%"', "timestamp_ntz", None),
    ("TIMESTAMP WITH TIME ZONE", "TIMESTAMP", """("%COL%" at time zone 'UTC')""", "timestamp_ntz", None),
    ("TIME WITHOUT TIME ZONE", "varchar(15)", 'cast("%COL%" as varchar(15))', "string", "15"),
    ("TIME WITH TIME ZONE", "varchar(24)", 'cast("%COL%" as varchar(24))', "string", "24"),
    ("INTERVAL", "varchar(100)", 'cast("%COL%" as varchar(100))', "string", "100"),
    ("CHARACTER", "char(%VLEN%)", '"%COL%"', "string", None),
    ("CHARACTER VARYING", "varchar(%VLEN%)", '"%COL%"', "string", None),
    ("TEXT", "varchar(2000000)", '"%COL%"', "string", None),
    ("NAME", "varchar(63)", 'cast("%COL%" as varchar(63))', "string", None),
    ('"CHAR"', "char(1)", 'cast("%COL%" as char(1))', "string", None),
    ("UUID", "char(36)", 'cast("%COL%" as char(36))', "string", None),
    ("BIT", "varchar(%VLEN%)", 'cast("%COL%" as varchar(%VLEN%))', "string", None),
    ("BIT VARYING", "varchar(%VLEN%)", 'cast("%COL%" as varchar(%VLEN%))', "string", None),
    ("BYTEA", "varchar(2000000)", """encode("%COL%", 'hex')""", "string", "2000000"),
    ("JSON", "varchar(2000000)", 'cast("%COL%" as text)', "string", None),
    ("JSONB", "varchar(2000000)", 'cast("%COL%" as text)', "string", None),
    ("XML", "varchar(2000000)", 'cast("%COL%" as text)', "string", None),
    ("ENUM", "varchar(2000000)", 'cast("%COL%" as text)', "string", None),
    ("ARRAY", "varchar(2000000)", 'cast(array_to_json("%COL%") as text)', "string", None),
    ("INET", "varchar(43)", 'cast("%COL%" as varchar(43))', "string", None),
    ("CIDR", "varchar(43)", 'cast("%COL%" as varchar(43))', "string", None),
    ("MACADDR", "char(17)", 'cast("%COL%" as char(17))', "string", None),
    ("MACADDR8", "char(23)", 'cast("%COL%" as char(23))', "string", None),
    ("POINT", "varchar(2000000)", 'cast("%COL%" as text)', "string", None),
    ("LINE", "varchar(2000000)", 'cast("%COL%" as text)', "string", None),
    ("LSEG", "varchar(2000000)", 'cast("%COL%" as text)', "string", None),
    ("BOX", "varchar(2000000)", 'cast("%COL%" as text)', "string", None),
    ("PATH", "varchar(2000000)", 'cast("%COL%" as text)', "string", None),
    ("POLYGON", "varchar(2000000)", 'cast("%COL%" as text)', "string", None),
    ("CIRCLE", "varchar(2000000)", 'cast("%COL%" as text)', "string", None),
    ("INT4RANGE", "varchar(2000000)", 'cast("%COL%" as text)', "string", None),
    ("INT8RANGE", "varchar(2000000)", 'cast("%COL%" as text)', "string", None),
    ("NUMRANGE", "varchar(2000000)", 'cast("%COL%" as text)', "string", None),
    ("DATERANGE", "varchar(2000000)", 'cast("%COL%" as text)', "string", None),
    ("TSRANGE", "varchar(2000000)", 'cast("%COL%" as text)', "string", None),
    ("TSTZRANGE", "varchar(2000000)", 'cast("%COL%" as text)', "string", None),
    ("GEOMETRY", "GEOMETRY", 'ST_AsText("%COL%")', "string", None),
)
RULES = {"mysql": TYPE_RULES, "postgresql": POSTGRES_RULES}
# Precision cap of DECIMAL in the target, and of decimals in Spark.
TARGET_MAX_PRECISION = 36
SPARK_MAX_PRECISION = 38
# Fixed value: the text that marks a column of an unknown type in the DDL.
UNKNOWN_NOTE = '--UNKNOWN_DATATYPE: "%TCOL%" %UTYPE%'

# SQL text of each placeholder's value, over the catalog columns.
_TOKEN_SQL = {
    "%COL%": "column_name",
    "%TCOL%": "target_column",
    "%CTYPE%": "upper(column_type)",
    "%UTYPE%": "upper(data_type)",
    "%LEN%": "cast(character_maximum_length AS string)",
    "%VLEN%": "cast(least(coalesce(character_maximum_length, 2000000), 2000000) AS string)",
    "%PREC%": "cast(numeric_precision AS string)",
    "%BITP%": f"cast(least(numeric_precision, {SPARK_MAX_PRECISION}) AS string)",
}


def fill_sql(template_sql: str, tokens: tuple[str, ...] | None = None) -> str:
    """SQL that replaces the placeholders of a template; NULL when a
    placeholder that occurs has a NULL value (marked, then nulled once at the
    end, so the expression grows linearly with the number of placeholders)."""
    out = template_sql
    for token in tokens or tuple(_TOKEN_SQL):
        out = f"replace({out}, '{token}', coalesce({_TOKEN_SQL[token]}, char(0)))"
    return f"CASE WHEN instr({out}, char(0)) = 0 THEN {out} END"


def rules_frame(spark, dialect: str = "mysql") -> DataFrame:
    """The rules of a source's type names as a lookup table (a fixed 38 or 47 rows)."""
    from tidecopy.session import local_frame

    return local_frame(
        spark, [tuple(r) for r in RULES[dialect]],
        "rule_type string, rule_ddl string, rule_load string, rule_spark string, rule_chars string")


# DECIMAL(p,s): DOUBLE when p is unknown, else precision capped at 36 and scale
# brought into 0..p (the Spark type also keeps scale <= capped precision).
_DEC_SCALE = "CASE WHEN numeric_scale > numeric_precision THEN numeric_precision " \
             "WHEN numeric_scale < 0 THEN 0 ELSE numeric_scale END"
_DEC_CAP = f"least(numeric_precision, {TARGET_MAX_PRECISION})"
_DEC_DDL = f"CASE WHEN numeric_precision IS NULL THEN 'DOUBLE' ELSE " \
           f"concat('decimal(', {_DEC_CAP}, ',', {_DEC_SCALE}, ')') END"
_DEC_SPARK = f"CASE WHEN numeric_precision IS NULL THEN 'double' ELSE " \
             f"concat('decimal(', {_DEC_CAP}, ',', least(coalesce({_DEC_SCALE}, 0), {_DEC_CAP}), ')') END"


def map_types(catalog: DataFrame, *, fold_case: bool = True, dialect: str = "mysql") -> DataFrame:
    """Add the mapping columns to a column catalog of a ``mysql`` or ``postgresql`` source:

    ``target_column`` (upper-cased when ``fold_case``), ``known``,
    ``target_type`` (DDL type text), ``column_ddl``, ``load_expr`` (source-side
    select expression), ``spark_type`` and ``char_length``. Unknown types get
    NULL in all of them and a note in ``unknown_note``.

    The rules are a small lookup table joined by broadcast on the upper-cased
    type name; the catalog is never shuffled."""
    rules = F.broadcast(rules_frame(catalog.sparkSession, dialect))
    target_col = "upper(column_name)" if fold_case else "column_name"
    joined = (catalog.withColumn("target_column", F.expr(target_col))
              .join(rules, F.upper(F.col("data_type")) == F.col("rule_type"), "left"))
    dec = "rule_type IN ('DECIMAL', 'NUMERIC')"
    mapped = joined.selectExpr(
        *[f"`{c}`" for c in catalog.columns], "target_column",
        "rule_type IS NOT NULL AS known",
        f"CASE WHEN {dec} THEN {_DEC_DDL} ELSE {fill_sql('rule_ddl')} END AS target_type",
        f"{fill_sql('rule_load', ('%COL%', '%LEN%', '%PREC%') + (('%VLEN%',) if dialect == 'postgresql' else ()))} AS load_expr",
        f"CASE WHEN {dec} THEN {_DEC_SPARK} ELSE {fill_sql('rule_spark', ('%BITP%',))} END AS spark_type",
        f"cast({fill_sql('rule_chars', ('%LEN%',))} AS int) AS char_length",
    )
    note = fill_sql("'" + UNKNOWN_NOTE.replace("'", "''") + "'", ("%TCOL%", "%UTYPE%"))
    return mapped.selectExpr(
        "*", "concat('\"', target_column, '\" ', target_type) AS column_ddl",
        f"CASE WHEN NOT known THEN {note} END AS unknown_note")


def unknown_types(catalog: DataFrame, *, fold_case: bool = True, dialect: str = "mysql") -> DataFrame:
    """Columns whose type has no mapping: they are left out of DDL and loads."""
    return (map_types(catalog, fold_case=fold_case, dialect=dialect).where(~F.col("known"))
            .select("table_schema", "table_name", "column_name", "ordinal_position",
                    F.upper(F.col("data_type")).alias("data_type"), "unknown_note"))


def _ordered_join(text: Column, order: Column, sep: str = ",") -> Column:
    """String aggregate ordered by ``order``; NULL texts are skipped, and an
    all-NULL group gives NULL."""
    items = F.array_sort(F.collect_list(F.struct(order.alias("o"), text.alias("t"))))
    joined = F.array_join(F.transform(items, lambda x: x["t"]), sep)
    return F.when(F.count(text) > 0, joined)


def ddl_report(catalog: DataFrame, *, target_schema: str, connection: str,
               fold_case: bool = True, target_tables: dict[str, str] | None = None, dialect: str = "mysql") -> DataFrame:
    """One row per source table: the schema DDL, the table DDL (unknown types
    noted at the end) and the import statement with its source select list.

    Target table names default to the source names (upper-cased with
    ``fold_case``); ``target_tables`` overrides them by source table name."""
    mapped = map_types(catalog, fold_case=fold_case, dialect=dialect)
    default_target = F.upper(F.col("table_name")) if fold_case else F.col("table_name")
    if target_tables:
        pairs = F.create_map(*[F.lit(x) for kv in target_tables.items() for x in kv])
        default_target = F.coalesce(F.element_at(pairs, F.col("table_name")), default_target)
    mapped = mapped.withColumns({"target_schema": F.lit(target_schema), "target_table": default_target})
    qualified = F.concat(F.lit('"'), F.col("target_schema"), F.lit('"."'), F.col("target_table"), F.lit('"'))
    grouped = mapped.groupBy("table_schema", "table_name", "target_schema", "target_table").agg(
        _ordered_join(F.col("column_ddl"), F.col("ordinal_position")).alias("_cols"),
        _ordered_join(F.col("unknown_note"), F.col("ordinal_position")).alias("_unknown"),
        _ordered_join(F.col("load_expr"), F.col("ordinal_position")).alias("_select"),
        F.first(qualified).alias("_qualified"),
    )
    # The statement formats of the target warehouse.
    return grouped.select(
        "table_schema", "table_name", "target_schema", "target_table",
        F.concat(F.lit('create schema if not exists "'), F.col("target_schema"), F.lit('";')).alias("sql_create_schema"),
        F.concat(F.lit("create table if not exists  "), F.col("_qualified"), F.lit(" ("),
                 F.coalesce(F.col("_cols"), F.lit("")), F.lit(");"),
                 F.coalesce(F.col("_unknown"), F.lit("")), F.lit(" ")).alias("sql_create_table"),
        F.concat(F.lit("import into "), F.col("_qualified"), F.lit(f" from jdbc at {connection} statement 'select "),
                 F.coalesce(F.col("_select"), F.lit("")), F.lit(" from "), F.col("table_schema"), F.lit("."),
                 F.col("table_name"), F.lit("'")).alias("sql_imports"),
    )


@dataclass(frozen=True)
class MappedColumn:
    ordinal: int
    source_name: str
    target_name: str
    data_type: str
    spark_type: str
    char_length: int | None
    load_expr: str
    dialect: str = "mysql"  # whose SQL load_expr is


def mapped_columns(catalog: DataFrame, *, fold_case: bool = True, dialect: str = "mysql") -> list[MappedColumn]:
    """The known columns of ONE table, in ordinal order, on the driver.

    A catalog has one row per column of the table, so this is metadata, not
    data; it drives the select list of the load."""
    rows = (map_types(catalog, fold_case=fold_case, dialect=dialect).where("known")
            .select("table_schema", "table_name", "ordinal_position", "column_name", "target_column",
                    "data_type", "spark_type", "char_length", "load_expr")
            .collect())
    rows.sort(key=lambda r: r["ordinal_position"])  # one row per column of one table
    if len({(r[0], r[1]) for r in rows}) > 1:
        raise ValueError("mapped_columns needs the catalog of one table; filter it first")
    out = [MappedColumn(r[2], r[3], r[4], r[5].upper(), r[6], r[7], r[8], dialect) for r in rows]
    targets = [c.target_name for c in out]
    clash = {t for t in targets if targets.count(t) > 1}
    if clash:
        raise ValueError(f"column names collide after case folding: {sorted(clash)}")
    return out
