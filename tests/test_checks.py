import datetime as dt

import pytest

from tidecopy.operators import condition_met, count_check, has_rows

D = dt.datetime


@pytest.mark.parametrize("rows, schema, met", [
    ([(0,)], "c long", False), ([("0",)], "c string", False), ([("",)], "c string", False),
    ([(None,)], "c string", True), ([(5,)], "c long", True), ([("x",)], "c string", True),
    ([(0.0,)], "c double", True), ([], "c long", False),
])
def test_condition_met_cells(spark, rows, schema, met):
    assert condition_met(spark.createDataFrame(rows, schema)).first()["met"] is met


def test_has_rows(spark):
    assert has_rows(spark.range(0)).first()["has_rows"] is False
    assert has_rows(spark.range(5)).first()["has_rows"] is True


def test_count_check_rules(spark):
    src = spark.createDataFrame([(1, D(2024, 1, 1, 8)), (2, D(2024, 1, 1, 9, 30)), (3, D(2024, 1, 1, 11))],
                                "id long, created_at timestamp_ntz")
    tgt = src.where("id < 2").toDF("ID", "CREATED_AT")
    now = D(2024, 1, 1, 10, 10)  # cutoff 09:00
    r = count_check(src, tgt, {"created_at": "datetime"}, now=now).first()
    assert (r["rule"], r["cutoff"], r["source_n"], r["target_n"], r["ok"]) == ("cutoff", D(2024, 1, 1, 9), 1, 1, True)
    r = count_check(src, tgt, {"created_at": "datetime"}, now=D(2024, 1, 1, 10, 40)).first()
    assert (r["source_n"], r["target_n"], r["ok"]) == (2, 1, False)
    r = count_check(src, tgt, None, tolerance=1).first()
    assert (r["rule"], r["ok"]) == ("tolerance", False)
    assert count_check(src, tgt, None).first()["ok"] is True
    r = count_check(src, tgt, {"id": "int"}).first()
    assert (r["rule"], r["ok"], r["source_n"]) == ("none", True, None)


def test_text_cells(spark):
    from tidecopy.functions import text_cells
    rows = [(1, D(2001, 7, 1, 12, 30), float("nan"), "a'b", True, [1, 2], dt.date(2020, 2, 29)),
            (None, D(2001, 7, 1, 12, 30, 5, 1200), 2.5, None, None, None, None), (3, None, None, "", False, [], None)]
    df = spark.createDataFrame(rows, "`a.b` long, t timestamp_ntz, x double, s string, f boolean, l array<int>, d date")
    out = text_cells(df)
    assert out.columns == df.columns and {f.dataType.simpleString() for f in out.schema} == {"string"}
    assert [tuple(r) for r in out.collect()] == [
        ("1", "2001-07-01T12:30:00", None, "a'b", "true", "[1,2]", "2020-02-29"),
        (None, "2001-07-01T12:30:05.001200", "2.5", None, None, None, None), ("3", None, None, "", "false", "[]", None)]


def test_column_pairs_refuses_several_tables(spark):
    from tidecopy.operators import catalog_of, column_pairs
    one = spark.createDataFrame([(1, 2)], "a long, b long")
    two = catalog_of(one, "s", "t").unionAll(catalog_of(one, "s", "u"))
    with pytest.raises(ValueError, match="one table"):
        column_pairs(two, catalog_of(one.toDF("A", "B"), "r", "T"))
