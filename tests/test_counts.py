"""The count ledger: equal to full counts after any runs, and no target row is read in a quiet one."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from tidecopy import TableSpec
from tidecopy.plans import replicate_table
from tidecopy.sources import append_target, counts, drop_target, hold

SCHEMA = "id long, v string, created_at timestamp_ntz"
LAYOUTS = {"plain": {}, "parts": {"partition_by": {"P": "ID div 50"}}, "groups": {"group_rows": 60}, "buckets": {"bucket_count": 3}}


def spec(table, **kw):
    return TableSpec(load_type="merge", source_schema="shop", source_table_name="t", target_schema="cnt", target_table_name=table,
                     source_main_fields=["id"], target_main_fields=["ID"], source_merge_columns={"created_at": "datetime", "id": "int"}, **kw)


def rows(spark, ids, rnd, v):
    at = lambda i: None if i % 17 == 0 else dt.datetime(2020, 1, 1) + dt.timedelta(minutes=20 * i, microseconds=i % 3)
    return spark.createDataFrame([(i, f"{v}{rnd.random()}", at(i)) for i in ids], SCHEMA)


@pytest.mark.parametrize("layout", sorted(LAYOUTS))
def test_random_runs(spark, layout):
    rnd, name = random.Random(layout), f"cnt.{layout}"
    drop_target(spark, name)
    top = 200
    for step in range(5):
        source = rows(spark, range(top), rnd, step)
        now = dt.datetime(2020, 1, 1) + dt.timedelta(minutes=20 * rnd.randrange(1, top + 40))
        st = replicate_table(spark, spec(layout, **LAYOUTS[layout]), source, run_date="2020-01-04", now=now, raise_on_check=False)
        table = spark.table(name)
        cutoff = (now - dt.timedelta(minutes=30)).replace(minute=0, second=0, microsecond=0)
        assert st["target_n"] == table.where(F.col("CREATED_AT") <= F.lit(cutoff)).count()
        with hold(spark, name) as lease:
            known = counts.ledger(spark, table, lease, "CREATED_AT")
            assert known.agg(F.sum("n")).first()[0] == table.count() == top
        if step == 2:       # rows that come another way: counted anew
            append_target(rows(spark, [top], rnd, "x"), name, partition_by=LAYOUTS[layout].get("partition_by")) if layout != "groups" else None
            with hold(spark, name) as lease:
                assert layout == "groups" or counts.ledger(spark, spark.table(name), lease, "CREATED_AT") is None
            top += layout != "groups"
        top += rnd.choice([0, 3, 60])


def test_a_quiet_run_reads_no_target_row(spark):
    drop_target(spark, "cnt.quiet")
    source = rows(spark, range(300), random.Random(1), "v")
    run = dict(now=dt.datetime(2020, 1, 3))
    replicate_table(spark, spec("quiet"), source, run_date="2020-01-04", **run)
    replicate_table(spark, spec("quiet"), source, run_date="2020-01-04", **run)         # records the key maximum
    for f in spark.table("cnt.quiet").inputFiles():
        path = f.removeprefix("file://")
        with open(path, "r+b") as h:        # whoever reads it now, fails
            size = len(h.read())
            h.seek(0)
            h.write(b"x" * size)
    with pytest.raises(Exception):
        spark.table("cnt.quiet").count()
    st = replicate_table(spark, spec("quiet"), source.where("id < 0"), run_date="2020-01-04", raise_on_check=False, **run)
    upto = sum(i % 17 > 0 and 1200 * 10**6 * i + i % 3 <= 47 * 3600 * 10**6 for i in range(300))
    assert st["path"] == "merge" and st["written"] is False and st["target_n"] == upto and st["source_n"] == 0
