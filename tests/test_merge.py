"""Merge semantics on the users fixture, brute force on random data, and the
two physical paths (broadcast / shuffle) against each other."""

import datetime as dt
import math
import random

import pytest
from pyspark.sql import functions as F

from tidecopy.functions import lookback_start
from tidecopy.operators import DuplicateKeyError, duplicate_keys, incremental_filter, key_max, merge_upsert

SCHEMA = "id long, created_at timestamp_ntz, updated_at timestamp_ntz, name string, score double"
D = dt.datetime


def _nan_free(v):
    return "NaN" if isinstance(v, float) and math.isnan(v) else v


def rows(df):
    data = [tuple(_nan_free(v) for v in r) for r in df.collect()]
    return sorted(data, key=lambda r: tuple((v is None, str(v)) for v in r))


@pytest.fixture
def users(spark):
    target = spark.createDataFrame([
        (1, D(2021, 1, 1), D(2021, 1, 1), "same", 1.0),
        (2, D(2021, 1, 2), D(2021, 1, 2), "old-in-overlap", 2.0),
        (3, D(2021, 1, 3), D(2021, 1, 3), "old-outside", 3.0),
        (4, D(2021, 1, 4), D(2021, 1, 4), "deleted-at-source", 4.0),
        (None, D(2021, 1, 5), D(2021, 1, 5), "null-key-target", 5.0),
    ], SCHEMA)
    source = spark.createDataFrame([
        (1, D(2021, 1, 1), D(2021, 1, 1), "same", 1.0),
        (2, D(2021, 1, 2), D(2021, 3, 9), "changed", 20.0),
        (3, D(2021, 1, 3), D(2021, 2, 1), "changed-outside", 30.0),
        (5, D(2021, 3, 10), D(2021, 3, 10), "new", float("nan")),
        (None, D(2021, 3, 10), D(2021, 3, 10), "null-key-source", None),
    ], SCHEMA)
    return target, source


def test_users_cases(spark, users):
    target, source = users
    since = lookback_start(D(2021, 3, 10, 13, 0))  # 2021-03-07
    km = key_max(target, "id")
    assert km == 4
    delta = incremental_filter(source, {"updated_at": "datetime", "created_at": "datetime", "id": "int"}, since, km)
    out = {(r["id"], r["name"]) for r in merge_upsert(target, delta, ["id"]).collect()}
    assert out == {(1, "same"), (2, "changed"), (3, "old-outside"), (4, "deleted-at-source"),
                   (5, "new"), (None, "null-key-target"), (None, "null-key-source")}


def test_matched_duplicate_raises(spark, users):
    target, _ = users
    delta = spark.createDataFrame([(2, None, None, "a", 1.0), (2, None, None, "b", 2.0)], SCHEMA)
    with pytest.raises(DuplicateKeyError, match=r"\(2,\)"):
        merge_upsert(target, delta, ["id"])


def test_unmatched_duplicates_both_insert(spark, users):
    target, _ = users
    delta = spark.createDataFrame([(9, None, None, "a", 1.0), (9, None, None, "b", 2.0)], SCHEMA)
    out = merge_upsert(target, delta, ["id"])
    assert out.where("id = 9").count() == 2 and out.count() == 7


def test_target_duplicates_all_updated(spark):
    target = spark.createDataFrame([(1, "x"), (1, "y"), (2, "z")], "k long, v string")
    delta = spark.createDataFrame([(1, "new")], "k long, v string")
    assert rows(merge_upsert(target, delta, ["k"])) == [(1, "new"), (1, "new"), (2, "z")]


def test_merge_twice_equals_once(spark, users):
    target, source = users
    first = merge_upsert(target, source, ["id"])
    first_rows = rows(first)
    second = merge_upsert(first, source, ["id"])
    # the NULL-key source row inserts again on every run (it never matches)
    again = [r for r in rows(second)]
    extra = [r for r in again if r[0] is None and r[3] == "null-key-source"]
    assert len(extra) == 2
    assert [r for r in again if r[3] != "null-key-source"] == [r for r in first_rows if r[3] != "null-key-source"]


def test_merge_from_empty_is_the_delta(spark, users):
    _, source = users
    empty = spark.createDataFrame([], SCHEMA)
    assert rows(merge_upsert(empty, source, ["id"])) == rows(source)


def test_all_key_columns(spark):
    target = spark.createDataFrame([(1, 1), (1, 2)], "a long, b long")
    delta = spark.createDataFrame([(1, 2), (2, 2)], "a long, b long")
    assert rows(merge_upsert(target, delta, ["a", "b"])) == [(1, 1), (1, 2), (2, 2)]


def test_delta_columns_must_match(spark, users):
    target, source = users
    with pytest.raises(ValueError, match="differ"):
        merge_upsert(target, source.drop("score"), ["id"])


def test_delta_is_cast_to_target_types(spark):
    target = spark.createDataFrame([(1, "a")], "k long, v string").selectExpr("cast(k as decimal(20,0)) k", "v")
    delta = spark.createDataFrame([(1, "b"), (2, "c")], "k long, v string")
    out = merge_upsert(target, delta, ["k"])
    assert out.schema["k"].dataType.simpleString() == "decimal(20,0)"
    assert sorted((int(r[0]), r[1]) for r in out.collect()) == [(1, "b"), (2, "c")]


def brute_force(target, delta, nkeys):
    """Row-by-row MERGE: update matched, insert unmatched, NULL never matches."""
    out = []
    matched_delta = set()
    for t in target:
        key = t[:nkeys]
        hits = [i for i, d in enumerate(delta) if None not in key and d[:nkeys] == key]
        if len(hits) > 1:
            raise DuplicateKeyError("dup")
        if hits:
            matched_delta.add(hits[0])
            out.append(delta[hits[0]])
        else:
            out.append(t)
    out += [d for i, d in enumerate(delta) if i not in matched_delta and
            not any(None not in d[:nkeys] and t[:nkeys] == d[:nkeys] for t in target)]
    return out


@pytest.mark.parametrize("seed", range(4))
@pytest.mark.parametrize("broadcast", [True, False])
def test_random_against_brute_force(spark, seed, broadcast):
    rnd = random.Random(seed)

    def key():
        return None if rnd.random() < 0.1 else rnd.randint(0, 6)

    target = [(key(), rnd.randint(0, 2), f"t{i}") for i in range(30)]
    delta = []
    for i in range(12):
        row = (key(), rnd.randint(0, 2), f"d{i}")
        delta.append(row)
    schema = "k1 long, k2 long, v string"
    try:
        expect = sorted(brute_force(target, delta, 2), key=str)
    except DuplicateKeyError:
        expect = None
    conf = "spark.sql.autoBroadcastJoinThreshold"
    old = spark.conf.get(conf)
    if not broadcast:
        spark.conf.set(conf, "-1")
    try:
        tdf, ddf = spark.createDataFrame(target, schema), spark.createDataFrame(delta, schema)
        if expect is None:
            with pytest.raises(DuplicateKeyError):
                merge_upsert(tdf, ddf, ["k1", "k2"], broadcast_bytes=None if broadcast else 0).collect()
        else:
            got = merge_upsert(tdf, ddf, ["k1", "k2"], broadcast_bytes=None if broadcast else 0)
            assert sorted((tuple(r) for r in got.collect()), key=str) == expect
    finally:
        spark.conf.set(conf, old)


def test_shuffle_path_plan_has_no_broadcast(spark, sf_small):
    orders = spark.read.parquet(f"{sf_small}/orders.parquet")
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        out = merge_upsert(orders, orders.where("o_orderkey % 2 = 0"), ["o_orderkey"])
        plan = out._jdf.queryExecution().executedPlan().toString()
        assert "BroadcastHashJoin" not in plan
        assert out.count() == orders.count()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_hot_null_key_bypasses_join(spark):
    # a third of the target has a NULL key: it must pass through, not be joined
    target = spark.range(3000).select(F.when(F.col("id") % 3 == 0, None).otherwise(F.col("id")).alias("k"),
                                      F.lit("t").alias("v"))
    delta = spark.range(0, 3000, 7).select(F.col("id").alias("k"), F.lit("d").alias("v"))
    out = merge_upsert(target, delta, ["k"])
    assert out.count() == 3000 + delta.where("k % 3 = 0").count()
    assert out.where("k is null").count() == 1000


def test_duplicate_keys_report(spark):
    df = spark.createDataFrame([(1, 1), (1, 1), (1, 2), (None, 3), (None, 3)], "a long, b long")
    assert rows(duplicate_keys(df, ["a", "b"])) == [(1, 1, 2), (None, 3, 2)]


def test_hot_target_key_on_shuffle_path(spark):
    # one key holds a third of the target; the delta updates it and inserts others
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        target = spark.range(3000).select(
            F.when(F.col("id") < 1000, F.lit(7)).otherwise(F.col("id")).alias("k"), F.lit("t").alias("v"))
        delta = spark.createDataFrame([(7, "hot"), (5000, "new")], "k long, v string")
        out = merge_upsert(target, delta, ["k"], broadcast_bytes=0)
        assert "BroadcastHashJoin" not in out._jdf.queryExecution().executedPlan().toString()
        got = {r["v"]: r["n"] for r in out.groupBy("v").count().withColumnRenamed("count", "n").collect()}
        assert got == {"hot": 1000, "t": 2000, "new": 1}
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


from hypothesis import HealthCheck, given, settings  # noqa: E402
from hypothesis import strategies as st  # noqa: E402


@settings(max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.one_of(st.none(), st.integers(0, 9)), st.text("ab", max_size=2)), max_size=15),
       st.dictionaries(st.integers(0, 12), st.text("xy", max_size=2), max_size=8))
def test_merge_is_idempotent(spark, target_rows, delta_map):
    schema = "k long, v string"
    target = spark.createDataFrame(target_rows, schema)
    delta = spark.createDataFrame(list(delta_map.items()), schema)
    once_rows = rows(merge_upsert(target, delta, ["k"]))  # delta keys are unique: no duplicate error
    twice = rows(merge_upsert(spark.createDataFrame(once_rows, schema), delta, ["k"]))
    assert twice == once_rows
    # every delta row is in the result exactly once per matching target row, or once if new
    assert {r for r in once_rows if r[0] in delta_map} == set(delta_map.items())
