import datetime as dt

import pytest
from pyspark.sql import functions as F

from tidecopy.operators import POSTGRES_RULES, conform, ddl_report, map_types, mapped_columns, unknown_types
from tidecopy.session import local_frame
from tidecopy.sources import JdbcTable, postgres_catalog, postgres_columns, postgres_information_schema, resolve_domains
from tidecopy.sources.postgres import COLUMNS_SCHEMA, DOMAINS_SCHEMA, ENUMS_SCHEMA

# (data_type, udt_schema, udt_name, length, precision, scale) -> data_type, column_type, target_type, spark_type
SHOP, PG = "shop", "pg_catalog"
RESOLVED = [
    (("USER-DEFINED", SHOP, "email", None, None, None), ("character varying", "character varying(80)", "varchar(80)", "string")),
    (("USER-DEFINED", SHOP, "work_email", None, None, None), ("character varying", "character varying(80)", "varchar(80)", "string")),
    (("USER-DEFINED", SHOP, "boss_email", None, None, None), ("character varying", "character varying(80)", "varchar(80)", "string")),
    (("USER-DEFINED", SHOP, "scores", None, None, None), ("ARRAY", "smallint[]", "varchar(2000000)", "string")),
    (("USER-DEFINED", SHOP, "mood", None, None, None), ("enum", "enum", "varchar(2000000)", "string")),
    (("USER-DEFINED", SHOP, "feeling", None, None, None), ("enum", "enum", "varchar(2000000)", "string")),
    (("USER-DEFINED", "gis", "geography", None, None, None), ("geometry", "geometry", "GEOMETRY", "string")),
    (("USER-DEFINED", SHOP, "address", None, None, None), ("address", "address", None, None)),
    (("ARRAY", PG, "_timestamptz", None, None, None), ("ARRAY", "timestamp with time zone[]", "varchar(2000000)", "string")),
    (("ARRAY", SHOP, "_mood", None, None, None), ("ARRAY", "mood[]", "varchar(2000000)", "string")),
    (("character varying", PG, "varchar", None, None, None), ("character varying", "character varying", "varchar(2000000)", "string")),
    (("character", PG, "bpchar", 7, None, None), ("character", "character(7)", "char(7)", "string")),
    (("bit", PG, "bit", 3, None, None), ("bit", "bit(3)", "varchar(3)", "string")),
    (("numeric", PG, "numeric", None, 12, 2), ("numeric", "numeric(12,2)", "decimal(12,2)", "decimal(12,2)")),
    (("numeric", PG, "numeric", None, 50, 10), ("numeric", "numeric(50,10)", "decimal(36,10)", "decimal(36,10)")),
    (("numeric", PG, "numeric", None, 5, -2), ("numeric", "numeric(7,0)", "decimal(7,0)", "decimal(7,0)")),
    (("numeric", PG, "numeric", None, 3, 5), ("numeric", "numeric(5,5)", "decimal(5,5)", "decimal(5,5)")),
    (("numeric", PG, "numeric", None, None, None), ("numeric", "numeric", "DOUBLE", "double")),
    (("tsvector", PG, "tsvector", None, None, None), ("tsvector", "tsvector", None, None)),
]
DOMAINS = [
    (SHOP, "email", "character varying", PG, "varchar", 80, None, None),
    (SHOP, "work_email", "USER-DEFINED", SHOP, "email", None, None, None),
    (SHOP, "boss_email", "USER-DEFINED", SHOP, "work_email", None, None, None),
    (SHOP, "scores", "ARRAY", PG, "_int2", None, None, None),
    (SHOP, "feeling", "USER-DEFINED", SHOP, "mood", None, None, None),
    ("other", "mood", "integer", PG, "int4", None, 32, 0),
]


def columns_of(spark, shapes):
    return local_frame(spark, [("db", SHOP, "t", f"c{i}", i + 1, *s) for i, s in enumerate(shapes)], COLUMNS_SCHEMA)


def test_domains_arrays_enums(spark):
    cat = postgres_catalog(columns_of(spark, [s for s, _ in RESOLVED]), local_frame(spark, DOMAINS, DOMAINS_SCHEMA),
                           local_frame(spark, [(SHOP, "mood"), (SHOP, "mood")], ENUMS_SCHEMA))
    got = map_types(cat, dialect="postgresql").orderBy("ordinal_position")
    assert [tuple(r) for r in got.select("data_type", "column_type", "target_type", "spark_type").collect()] == [w for _, w in RESOLVED]
    assert sorted(r["data_type"] for r in unknown_types(cat, dialect="postgresql").collect()) == ["ADDRESS", "TSVECTOR"]


def test_every_type_is_mapped(spark):
    names = [r[0].lower() for r in POSTGRES_RULES]
    assert len(names) == len(set(names))
    cat = postgres_catalog(columns_of(spark, [(n, PG, n, None, 20 if n == "numeric" else None, 2 if n == "numeric" else None)
                                              for n in names]))
    rows = map_types(cat, dialect="postgresql").orderBy("ordinal_position").collect()
    assert all(r["known"] and r["target_type"] and r["load_expr"] and r["spark_type"] for r in rows)
    assert all(f'"c{i}"' in r["load_expr"] for i, r in enumerate(rows))
    assert [c.data_type for c in mapped_columns(cat, dialect="postgresql")] == [n.upper() for n in names]


def test_domains_in_a_circle(spark):
    circle = [("s", "a", "USER-DEFINED", "s", "b", None, None, None), ("s", "b", "USER-DEFINED", "s", "a", None, None, None)]
    with pytest.raises(ValueError, match="circle"):
        resolve_domains(local_frame(spark, circle, DOMAINS_SCHEMA))


def test_ddl_quotes_as_the_source_does(spark):
    cat = postgres_catalog(columns_of(spark, [("integer", PG, "int4", None, 32, 0), ("ARRAY", PG, "_int4", None, None, None)]))
    r = ddl_report(cat, target_schema="R", connection="C", dialect="postgresql").first()
    assert r["sql_imports"].endswith("""'select "c0",cast(array_to_json("c1") as text) from shop.t'""")


def test_conform_rows_of_a_postgres_table(spark):
    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "Europe/Berlin")
    try:
        df = spark.sql("""SELECT 7 AS id, true AS ok, X'00AbFf' AS raw, array(1, NULL, 3) AS list, 1.255BD AS n,
                                 timestamp_micros(1698541200000001L) AS at, CAST(NULL AS timestamp) AS never""")
        cat = postgres_catalog(postgres_columns(spark, {"t": df}, table_schema="s"))
        out = conform(df, mapped_columns(cat, dialect="postgresql"))
        row = out.first()
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
    # 2023-10-29 01:00 UTC is one of the two 02:00 o'clocks of that night
    assert tuple(row)[:4] == (7, True, "00abff", "[1,null,3]") and str(row["N"]) == "1.255"
    assert row["AT"] == dt.datetime(2023, 10, 29, 1, 0, 0, 1) and row["NEVER"] is None


def test_select_list_of_a_postgres_source(spark):
    from tidecopy.sources.target import select_list

    cat = postgres_catalog(columns_of(spark, [("bytea", PG, "bytea", None, None, None),
                                              ("timestamp with time zone", PG, "timestamptz", None, None, None)]))
    src = JdbcTable("jdbc:postgresql://db/shop", "shop.t")
    assert select_list(src, mapped_columns(cat, dialect="postgresql"), {"C0": "NULL"}) == (
        """NULL AS "c0", ("c1" at time zone 'UTC') AS "c1\"""")


def test_information_schema_over_jdbc(spark):
    """The same views under the same names in a database of this process."""
    url, driver = "jdbc:derby:memory:pg_shape;create=true", {"driver": "org.apache.derby.iapi.jdbc.AutoloadedDriver"}
    frames = {
        "information_schema.columns": columns_of(spark, [s for s, _ in RESOLVED]).unionByName(
            columns_of(spark, [("text", PG, "text", None, None, None)]).withColumn("table_schema", F.lit("elsewhere"))),
        "information_schema.domains": local_frame(spark, DOMAINS, DOMAINS_SCHEMA),
        "information_schema.tables": local_frame(spark, [("db", SHOP, "t", "BASE TABLE"), ("db", "elsewhere", "t", "BASE TABLE")],
                                                 "table_catalog string, table_schema string, table_name string, table_type string"),
        "pg_catalog.pg_type": local_frame(spark, [("mood", "e", 5), ("address", "c", 5)], "typname string, typtype string, typnamespace int"),
        "pg_catalog.pg_namespace": local_frame(spark, [(5, SHOP), (6, "other")], "oid int, nspname string"),
    }
    for name, df in frames.items():
        sizes = ", ".join(f"{f.name} VARCHAR(200)" for f in df.schema.fields if f.dataType.simpleString() == "string")
        (df.toDF(*[c.upper() for c in df.columns]).write.format("jdbc")
         .options(url=url, dbtable=name, createTableColumnTypes=sizes.upper(), **driver).mode("overwrite").save())
    cat, tables = postgres_information_schema(spark, url, driver, schema=SHOP)
    got = cat.orderBy("ordinal_position").select("data_type", "column_type").collect()
    assert [tuple(r) for r in got] == [w[:2] for _, w in RESOLVED]
    assert [r["table_schema"] for r in tables.collect()] == [SHOP]
