import pytest

from tidecopy.operators import ddl_report, map_types, mapped_columns, unknown_types
from tidecopy.operators.typemap import TYPE_RULES
from tidecopy.sources.catalog import CATALOG_SCHEMA, TABLES_SCHEMA, column_catalog

# (data_type, column_type, char length, precision, scale) -> (target DDL type, spark type, load expr)
CASES = [
    ("int", "int(11)", None, 10, 0, "DECIMAL(11,0)", "decimal(11,0)", "`c`"),
    ("integer", "int(11)", None, 10, 0, "DECIMAL(11,0)", "decimal(11,0)", "`c`"),
    ("tinyint", "tinyint(4)", None, 3, 0, "DECIMAL(4,0)", "decimal(4,0)", "`c`"),
    ("smallint", "smallint(6)", None, 5, 0, "DECIMAL(5,0)", "decimal(5,0)", "`c`"),
    ("mediumint", "mediumint(9)", None, 7, 0, "DECIMAL(9,0)", "decimal(9,0)", "`c`"),
    ("bigint", "bigint(20) unsigned", None, 20, 0, "DECIMAL (20,0)", "decimal(20,0)", "`c`"),
    ("float", "float", None, 12, None, "FLOAT", "double", "`c`"),
    ("double", "double", None, 22, None, "DOUBLE", "double", "`c`"),
    ("decimal", "decimal", None, None, None, "DOUBLE", "double", "`c`"),
    ("decimal", "decimal(10,2)", None, 10, 2, "decimal(10,2)", "decimal(10,2)", "`c`"),
    ("decimal", "decimal(65,30)", None, 65, 30, "decimal(36,30)", "decimal(36,30)", "`c`"),
    ("decimal", "decimal(5,7)", None, 5, 7, "decimal(5,5)", "decimal(5,5)", "`c`"),
    ("decimal", "decimal(5,-2)", None, 5, -2, "decimal(5,0)", "decimal(5,0)", "`c`"),
    ("bit", "bit(1)", None, 1, None, "DECIMAL(1,0)", "decimal(1,0)", "cast(`c` as DECIMAL(1,0))"),
    ("bit", "bit(64)", None, 64, None, "DECIMAL(64,0)", "decimal(38,0)", "cast(`c` as DECIMAL(64,0))"),
    ("date", "date", None, None, None, "DATE", "date", "`c`"),
    ("datetime", "datetime", None, None, None, "TIMESTAMP", "timestamp_ntz", "`c`"),
    ("timestamp", "timestamp", None, None, None, "TIMESTAMP", "timestamp_ntz", "`c`"),
    ("time", "time", None, None, None, "varchar(8)", "string", "cast(`c` as char(8))"),
    ("year", "year(4)", None, None, None, "varchar(4)", "string", "cast(`c` as char(4))"),
    ("char", "char(10)", 10, None, None, "CHAR(10)", "string", "`c`"),
    ("varchar", "varchar(255)", 255, None, None, "VARCHAR(255)", "string", "`c`"),
    ("binary", "binary(16)", 16, None, None, "char(16)", "string", "cast(`c` as char(16))"),
    ("varbinary", "varbinary(40)", 40, None, None, "varchar(40)", "string", "cast(`c` as char(40))"),
    ("tinytext", "tinytext", 255, None, None, "varchar(2000000)", "string", "`c`"),
    ("text", "text", 65535, None, None, "varchar(2000000)", "string", "`c`"),
    ("mediumtext", "mediumtext", 16777215, None, None, "varchar(2000000)", "string", "`c`"),
    ("longtext", "longtext", 4294967295, None, None, "varchar(2000000)", "string", "`c`"),
    ("tinyblob", "tinyblob", 255, None, None, "varchar(2000000)", "string", "cast(`c` as char(2000000))"),
    ("blob", "blob", 65535, None, None, "varchar(2000000)", "string", "cast(`c` as char(2000000))"),
    ("mediumblob", "mediumblob", 1, None, None, "varchar(2000000)", "string", "cast(`c` as char(2000000))"),
    ("longblob", "longblob", 1, None, None, "varchar(2000000)", "string", "cast(`c` as char(2000000))"),
    ("enum", "enum('a','b')", 1, None, None, "varchar(2000000)", "string", "`c`"),
    ("set", "set('a','b')", 3, None, None, "varchar(2000000)", "string", "`c`"),
    ("json", "json", None, None, None, "varchar(2000000)", "string", "`c`"),
    ("geometry", "geometry", None, None, None, "GEOMETRY", "string", "ST_AsText(`c`)"),
    ("geometrycollection", "geomcollection", None, None, None, "GEOMETRY", "string", "ST_AsText(`c`)"),
    ("point", "point", None, None, None, "GEOMETRY", "string", "ST_AsText(`c`)"),
    ("multipoint", "multipoint", None, None, None, "GEOMETRY", "string", "ST_AsText(`c`)"),
    ("linestring", "linestring", None, None, None, "GEOMETRY", "string", "ST_AsText(`c`)"),
    ("multilinestring", "multilinestring", None, None, None, "GEOMETRY", "string", "ST_AsText(`c`)"),
    ("polygon", "polygon", None, None, None, "GEOMETRY", "string", "ST_AsText(`c`)"),
    ("multipolygon", "multipolygon", None, None, None, "GEOMETRY", "string", "ST_AsText(`c`)"),
    ("VARCHAR", "varchar(3)", 3, None, None, "VARCHAR(3)", "string", "`c`"),
]


def _catalog(spark, cases, schema="baza", table="t"):
    rows = [("def", schema, table, "c", i + 1, d, ct, ln, p, s) for i, (d, ct, ln, p, s, *_rest) in enumerate(cases)]
    return spark.createDataFrame(rows, CATALOG_SCHEMA)


def test_every_rule_is_covered():
    covered = {c[0].upper() for c in CASES}
    assert covered == {r[0] for r in TYPE_RULES}
    assert len(TYPE_RULES) == 38


def test_map_types_all_cases(spark):
    got = (map_types(_catalog(spark, CASES)).orderBy("ordinal_position")
           .select("known", "target_type", "spark_type", "load_expr", "column_ddl").collect())
    for case, row in zip(CASES, got):
        assert row["known"], case
        assert (row["target_type"], row["spark_type"], row["load_expr"]) == case[5:], case
        assert row["column_ddl"] == f'"C" {case[5]}'


def test_char_lengths(spark):
    rows = {r["data_type"]: r["char_length"] for r in map_types(_catalog(spark, CASES)).collect()}
    assert rows["time"] == 8 and rows["year"] == 4 and rows["binary"] == 16 and rows["varbinary"] == 40
    assert rows["blob"] == 2000000 and rows["text"] is None


def test_unknown_type_is_left_out(spark):
    cases = [("int", "int", None, 10, 0), ("vector", "vector(3)", None, None, None)]
    cat = _catalog(spark, cases)
    unknown = unknown_types(cat).collect()
    assert [(r["data_type"], r["unknown_note"]) for r in unknown] == [("VECTOR", '--UNKNOWN_DATATYPE: "C" VECTOR')]
    assert [c.data_type for c in mapped_columns(cat)] == ["INT"]


def test_fold_case_off_keeps_names(spark):
    cat = spark.createDataFrame([("def", "s", "t", "MixedCase", 1, "int", "int", None, 10, 0)], CATALOG_SCHEMA)
    assert [c.target_name for c in mapped_columns(cat, fold_case=False)] == ["MixedCase"]
    assert [c.target_name for c in mapped_columns(cat)] == ["MIXEDCASE"]


def test_case_fold_collision_raises(spark):
    cat = spark.createDataFrame([("def", "s", "t", "a", 1, "int", "int", None, 10, 0),
                                 ("def", "s", "t", "A", 2, "int", "int", None, 10, 0)], CATALOG_SCHEMA)
    with pytest.raises(ValueError, match="collide"):
        mapped_columns(cat)


def test_column_catalog_filters_views_and_system_schemas(spark):
    cols = spark.createDataFrame([
        ("def", "baza", "users", "id", 1, "bigint", "bigint", None, 19, 0),
        ("def", "baza", "users_v", "id", 1, "bigint", "bigint", None, 19, 0),
        ("def", "mysql", "users", "id", 1, "bigint", "bigint", None, 19, 0),
        ("def", "baza", "other", "id", 1, "bigint", "bigint", None, 19, 0),
    ], CATALOG_SCHEMA)
    tabs = spark.createDataFrame([("def", "baza", "users", "BASE TABLE"), ("def", "baza", "users_v", "VIEW"),
                                  ("def", "mysql", "users", "BASE TABLE"), ("def", "baza", "other", "BASE TABLE")],
                                 TABLES_SCHEMA)
    got = column_catalog(cols, tabs).select("table_schema", "table_name").collect()
    assert sorted(tuple(r) for r in got) == [("baza", "other"), ("baza", "users")]
    assert column_catalog(cols, tabs, "baza", "users").count() == 1
    assert column_catalog(cols, tabs, "baza", "users_v").count() == 0


def test_ddl_report_text(spark):
    cases = [("bigint", "bigint", None, 19, 0), ("varchar", "varchar(20)", 20, None, None),
             ("multilinestring", "multilinestring", None, None, None), ("vector", "vector", None, None, None),
             ("time", "time", None, None, None)]
    rows = [("def", "baza", "users", n, i + 1, *c) for i, (n, c) in
            enumerate(zip(["id", "name", "path", "emb", "t"], cases))]
    cat = spark.createDataFrame(rows, CATALOG_SCHEMA)
    r = ddl_report(cat, target_schema="REPLICA", connection="SRC").first()
    assert r["sql_create_schema"] == 'create schema if not exists "REPLICA";'
    assert r["sql_create_table"] == ('create table if not exists  "REPLICA"."USERS" ("ID" DECIMAL (20,0),'
                                     '"NAME" VARCHAR(20),"PATH" GEOMETRY,"T" varchar(8));'
                                     '--UNKNOWN_DATATYPE: "EMB" VECTOR ')
    assert r["sql_imports"] == ("import into \"REPLICA\".\"USERS\" from jdbc at SRC statement "
                                "'select `id`,`name`,ST_AsText(`path`),cast(`t` as char(8)) from baza.users'")


def test_ddl_report_target_name_override(spark):
    cat = _catalog(spark, CASES[:2], table="users")
    r = ddl_report(cat, target_schema="R", connection="C", target_tables={"users": "USERS_COPY"}).first()
    assert r["target_table"] == "USERS_COPY" and '"R"."USERS_COPY"' in r["sql_create_table"]


def test_conform_casts_and_truncates(spark):
    from tidecopy.operators import conform

    cat = spark.createDataFrame([
        ("def", "s", "t", "id", 1, "bigint", "bigint", None, 19, 0),
        ("def", "s", "t", "flag", 2, "bit", "bit(1)", None, 1, None),
        ("def", "s", "t", "code", 3, "binary", "binary(3)", 3, None, None),
        ("def", "s", "t", "price", 4, "decimal", "decimal(10,2)", None, 10, 2),
    ], CATALOG_SCHEMA)
    df = spark.createDataFrame([(5, True, bytearray(b"abcdef"), 1.255)], "id long, flag boolean, code binary, price double")
    out = conform(df, mapped_columns(cat))
    assert out.columns == ["ID", "FLAG", "CODE", "PRICE"]
    assert [f.dataType.simpleString() for f in out.schema.fields] == [
        "decimal(20,0)", "decimal(1,0)", "string", "decimal(10,2)"]
    row = out.first()
    assert int(row["ID"]) == 5 and int(row["FLAG"]) == 1 and row["CODE"] == "abc"


def test_ddl_report_all_unknown_columns(spark):
    cat = spark.createDataFrame([("def", "s", "t", "v", 1, "vector", "vector", None, None, None)], CATALOG_SCHEMA)
    r = ddl_report(cat, target_schema="R", connection="C").first()
    assert r["sql_create_table"] == 'create table if not exists  "R"."T" ();--UNKNOWN_DATATYPE: "V" VECTOR '
    assert r["sql_imports"] == "import into \"R\".\"T\" from jdbc at C statement 'select  from s.t'"


def test_column_pairs_length_mismatch(spark):
    from tidecopy.operators import catalog_of, column_pairs

    a = spark.createDataFrame([(1, 2)], "x long, y long")
    b = spark.createDataFrame([(1,)], "X long")
    with pytest.raises(ValueError, match="differ in length"):
        column_pairs(catalog_of(a, "s", "t"), catalog_of(b, "r", "T"))
    pairs = column_pairs(catalog_of(a, "s", "t"), catalog_of(a.toDF("X", "Y"), "r", "T")).orderBy("ord").collect()
    assert [tuple(p) for p in pairs] == [(1, "x", "X"), (2, "y", "Y")]


def test_measured_catalog_widths(spark):
    from tidecopy.sources import catalog_from_frames

    df = spark.createDataFrame([("héllo", bytearray(b"ab")), ("x" * 20000, None), (None, bytearray(b"abcd"))],
                               "s string, b binary")
    plain = {r["column_name"]: r["column_type"] for r in
             catalog_from_frames(spark, {"t": df.limit(0)}, table_schema="s").collect()}
    assert plain == {"s": "longtext", "b": "longblob"}
    measured = {r["column_name"]: (r["data_type"], r["column_type"], r["character_maximum_length"]) for r in
                catalog_from_frames(spark, {"t": df}, table_schema="s", measure=True).collect()}
    assert measured == {"s": ("longtext", "longtext", 4294967295), "b": ("varbinary", "varbinary(4)", 4)}
    short = catalog_from_frames(spark, {"t": df.where("length(s) < 100")}, table_schema="s", measure=True)
    row = short.where("column_name = 's'").first()
    assert (row["column_type"], row["character_maximum_length"]) == ("varchar(5)", 5)  # characters, not bytes
    assert map_types(short).where("column_name = 's'").first()["target_type"] == "VARCHAR(5)"
