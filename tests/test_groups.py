"""Merges by file groups: results as of a plain merge, and what stays untouched."""

import os
import random

import pytest
from pyspark.sql import functions as F

from tidecopy.operators import merge_upsert
from tidecopy.sources import drop_target, hold, merge_into_target, write_swap
from tidecopy.sources import groups
from tidecopy.sources.groups import GROUP


def files_of(spark, name):
    return {f: os.stat(f.removeprefix("file://")).st_mtime_ns for f in spark.table(name).inputFiles()}


def content(df):
    return sorted(map(tuple, df.drop(GROUP).collect()), key=str)


def check_merge(spark, name, delta, keys, rows):
    plain = content(merge_upsert(spark.table(name).drop(GROUP), delta, keys))
    before = files_of(spark, name)
    sizes = {r[0]: r[1] for r in spark.table(name).groupBy(GROUP).count().collect()}
    out = merge_into_target(spark, name, delta, keys, group_by=(rows, keys))
    assert content(spark.table(name)) == plain
    after = files_of(spark, name)
    kept = [f for f in after if f in before]
    assert all(after[f] == before[f] for f in kept)
    return out, before, kept, sizes


def test_a_clustered_delta_rewrites_few_files(spark):
    name = "grp.clustered"
    drop_target(spark, name)
    write_swap(spark.range(40_000).select(F.col("id").alias("ID"), F.lit("old").alias("V")), name, group_by=(1000, ["ID"]))
    assert spark.table(name).count() == 40_000 and len(files_of(spark, name)) >= 40
    delta = spark.range(20_000, 20_400).select(F.col("id").alias("ID"), F.lit("new").alias("V"))      # 1 %
    out, before, kept, _ = check_merge(spark, name, delta, ["ID"], 1000)
    assert out["written"] and out["groups"] <= 2 and len(before) - len(kept) < len(before) / 10
    # the filter, not only the range: keys that are missing inside a group's range
    assert merge_into_target(spark, name, delta.limit(0), ["ID"], group_by=(1000, ["ID"]))["written"] is False


def test_scattered_keys_are_found_by_filter(spark):
    name = "grp.filter"
    drop_target(spark, name)
    even = spark.range(0, 40_000, 2).select(F.col("id").alias("ID"), F.lit("old").alias("V"))
    write_swap(even, name, group_by=(1000, ["ID"]))
    odd = spark.createDataFrame([(2 * i + 1, "new") for i in range(0, 20_000, 1000)], "ID long, V string")
    out, *_ = check_merge(spark, name, odd, ["ID"], 1000)
    # 20 keys in the ranges of 20 groups, in none of them: hardly a group's keys are read
    assert out["all"] == 20 and out["read"] <= 3 and out["groups"] <= 1


@pytest.mark.parametrize("keys", [["ID"], ["K", "ID"]])
def test_random_merges(spark, keys, monkeypatch):
    monkeypatch.setattr(groups, "INDEX_VERSIONS", 2)
    rnd, name = random.Random(len(keys)), f"grp.random_{len(keys)}"
    schema = "ID long, K string, V string, N double"
    make = lambda n, top, v: spark.createDataFrame(
        list({(i, k): (i, k, v, rnd.random()) for i, k in ((rnd.choice([None, *range(top)] if rnd.random() < 0.1 else range(top)),
                                                           rnd.choice("abcé")) for _ in range(n))}.values()), schema)
    one = lambda df: df.dropDuplicates(["ID"]) if keys == ["ID"] else df
    drop_target(spark, name)
    first = one(make(600, 700, "0")).unionAll(spark.createDataFrame([(None, None, "n", 1.0)] * 300, schema))      # many without a key
    write_swap(first, name, group_by=(100, keys))
    sizes = [r[1] for r in spark.table(name).groupBy(GROUP).count().collect()]
    assert max(sizes) < 200          # rows without a key don't make a group of their own
    for step in range(3):
        check_merge(spark, name, one(make(rnd.choice([5, 60, 400]), 900, str(step + 1))), keys, 100)
    write_swap(one(make(200, 300, "again")), name, group_by=(100, keys))
    check_merge(spark, name, one(make(40, 400, "last")), keys, 100)


def test_a_merge_that_dies_before_its_index_is_published(spark, monkeypatch):
    name = "grp.crash"
    drop_target(spark, name)
    write_swap(spark.range(500).select(F.col("id").alias("ID"), F.lit("old").alias("V")), name, group_by=(100, ["ID"]))
    from tidecopy.sources import target
    publish = target._publish
    monkeypatch.setattr(target, "_publish", lambda *a, **k: (_ for _ in ()).throw(RuntimeError("gone")))
    delta = spark.createDataFrame([(7, "new"), (700, "new")], "ID long, V string")
    with pytest.raises(RuntimeError, match="gone"):
        merge_into_target(spark, name, delta, ["ID"], group_by=(100, ["ID"]))
    monkeypatch.setattr(target, "_publish", publish)
    with hold(spark, name) as lease:
        assert len(lease.files.names(f"{lease.root}/index")) == 1
    check_merge(spark, name, delta, ["ID"], 100)
    check_merge(spark, name, spark.createDataFrame([(7, "newer"), (701, "x")], "ID long, V string"), ["ID"], 100)
