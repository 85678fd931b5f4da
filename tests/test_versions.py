"""Publishing by versions and leases: overlapping runs, dead runs, readers at work."""

import glob
import os
import threading
import time

import pytest
from pyspark.sql import functions as F

from tidecopy.sources import LeaseHeld, LeaseLost, drop_target, hold, merge_into_target, recover, target_exists, with_partitions, write_swap
from tidecopy.sources import target as module
from tidecopy.sources import versions

PART = {"P": "ID div 10"}


class Crash(BaseException):
    """A run that stops where it stands."""


def rows(n, v="a"):
    return lambda spark: spark.range(n).select(F.col("id").alias("ID"), F.lit(v).alias("V"))


def folder(spark, name):
    return module._root(spark, name).removeprefix("file:")


def content(spark, name):
    return sorted((r.ID, r.V) for r in spark.table(name).collect())


def files_of(spark, name):
    return sorted(f.removeprefix("file://") for f in spark.table(name).inputFiles())


def test_tables_with_similar_names_are_left_alone(spark):
    write_swap(rows(3)(spark), "ver.orders")
    similar = ["orders__next_list", "orders__old_1", "orders__parts_list", "orders__tidecopy_list"]
    for t in similar:
        spark.range(7).toDF("ID").write.mode("overwrite").saveAsTable(f"ver.{t}")
    recover(spark, "ver.orders")
    write_swap(rows(4)(spark), "ver.orders")
    assert content(spark, "ver.orders") == [(i, "a") for i in range(4)]
    drop_target(spark, "ver.orders")
    assert [spark.table(f"ver.{t}").count() for t in similar] == [7] * 4


def test_a_second_run_is_refused_or_waits(spark):
    write_swap(rows(2)(spark), "ver.twice")
    seen = {}

    def other(key, wait):
        try:
            with hold(spark, "ver.twice", wait=wait):
                write_swap(rows(5, key)(spark), "ver.twice")
            seen[key] = "done"
        except LeaseHeld:
            seen[key] = "refused"

    with hold(spark, "ver.twice") as lease:
        staged = lease.version()
        rows(9)(spark).write.parquet(staged)             # a load at work
        for key, wait in (("no", 0.0), ("yes", 60.0)):
            t = threading.Thread(target=other, args=(key, wait))
            t.start()
            if key == "no":
                t.join()
        assert seen == {"no": "refused"} and os.path.isdir(staged.removeprefix("file:"))
        write_swap(rows(3, "first")(spark), "ver.twice")
        assert content(spark, "ver.twice") == [(i, "first") for i in range(3)]
    t.join()
    assert seen == {"no": "refused", "yes": "done"}
    assert content(spark, "ver.twice") == [(i, "yes") for i in range(5)]


def test_a_dead_run_is_replaced_and_cannot_publish_any_more(spark):
    write_swap(rows(2)(spark), "ver.dead")
    root = module._root(spark, "ver.dead")
    old = versions.take(versions.Files(spark), root)
    old._stop.set()                                      # no heartbeat: the process is gone
    staged = old.version()
    rows(9)(spark).write.parquet(staged)
    with pytest.raises(LeaseHeld):
        write_swap(rows(3)(spark), "ver.dead")
    old.files.write(f"{root}/lease/{old.fence:012d}.beat", '{"until": 0}')       # its time has run out
    write_swap(rows(3)(spark), "ver.dead")
    assert not os.path.exists(staged.removeprefix("file:"))
    with pytest.raises(LeaseLost):
        module._publish(spark, "ver.dead", old, staged, module._shape(rows(1)(spark).schema, [], None))
    assert content(spark, "ver.dead") == [(i, "a") for i in range(3)]


def test_the_heartbeat_keeps_a_long_run_alive(spark):
    with hold(spark, "ver.long", seconds=6) as lease:
        time.sleep(9)
        lease.check()
        with pytest.raises(LeaseHeld):
            versions.take(lease.files, lease.root)


@pytest.mark.parametrize("partitioned", [False, True])
@pytest.mark.parametrize("step", range(8))
def test_a_load_that_dies_while_publishing_is_finished(spark, monkeypatch, partitioned, step):
    """Dies at the step-th catalog statement of the switch: the old rows or the new ones, never none after recovery."""
    name = f"ver.crash_{int(partitioned)}_{step}"
    part = dict(partition_by=["P"]) if partitioned else {}
    frame = lambda n, v: with_partitions(rows(n, v)(spark), PART if partitioned else None)
    write_swap(frame(25, "old"), name, **part)
    switch, left, ended = module._switch, [step], []

    class Dying:
        def __init__(self, real):
            self._real = real

        def __getattr__(self, key):
            return getattr(self._real, key)

        def sql(self, text, *a, **k):
            if not left[0]:
                raise Crash
            left[0] -= 1
            return self._real.sql(text, *a, **k)

    monkeypatch.setattr(module, "_switch", lambda spark, *a: switch(Dying(spark), *a))
    try:
        write_swap(frame(40, "new"), name, **part)
        ended.append(True)
    except Crash:
        pass
    monkeypatch.setattr(module, "_switch", switch)
    recover(spark, name)
    assert content(spark, name) == [(i, "new") for i in range(40)]
    db_tables = {r.tableName for r in spark.sql("SHOW TABLES IN ver").collect()}
    assert not [t for t in db_tables if t.startswith(name.split(".")[1] + "__")]
    write_swap(frame(5, "next"), name, **part)
    assert content(spark, name) == [(i, "next") for i in range(5)]


def test_a_merge_that_dies_between_partitions_is_finished(spark, monkeypatch):
    name = "ver.parts"
    write_swap(with_partitions(rows(50, "old")(spark), PART), name, partition_by=["P"])
    before = {f: os.stat(f).st_mtime_ns for f in files_of(spark, name)}
    switch = module._switch_partitions

    def half(spark, name, lease, path, shape):
        p = versions.partitions_in(lease.files, path, 1)[0]
        spark.sql(f"ALTER TABLE {module.quoted(name)} {versions.partition_spec(p)} SET LOCATION '{path}/{p}'")
        raise Crash

    monkeypatch.setattr(module, "_switch_partitions", half)
    delta = spark.createDataFrame([(i, "new") for i in (5, 15, 25, 99)], "ID long, V string")
    with pytest.raises(Crash):
        merge_into_target(spark, name, delta, ["ID"], partition_by=PART)
    monkeypatch.setattr(module, "_switch_partitions", switch)
    recover(spark, name)
    want = {i: "new" if i in (5, 15, 25) else "old" for i in range(50)} | {99: "new"}
    assert content(spark, name) == sorted(want.items())
    # partitions that the delta doesn't touch keep their files
    kept = [f for f in files_of(spark, name) if f in before]
    assert len(kept) >= 2 and all(os.stat(f).st_mtime_ns == before[f] for f in kept)


def test_readers_never_fail_or_see_a_mix(spark):
    name, stop, seen, errors = "ver.read", threading.Event(), [], []
    write_swap(rows(20, "0")(spark).repartition(4), name)

    def read():
        while not stop.is_set():
            try:
                spark.catalog.refreshTable(name)
                seen.append({(r.V, r.n) for r in spark.table(name).groupBy("V").agg(F.count("*").alias("n")).collect()})
            except Exception as e:  # noqa: BLE001
                errors.append(e)
                return

    reader = threading.Thread(target=read)
    reader.start()
    for i in range(1, 11):
        write_swap(rows(20 + i, str(i))(spark).repartition(4), name)
    stop.set()
    reader.join()
    assert not errors and len(seen) > 3
    assert all(len(s) == 1 and next(iter(s))[1] == 20 + int(next(iter(s))[0]) for s in seen)


def test_replaced_files_go_after_a_while(spark, monkeypatch):
    name = "ver.keep"
    for i in range(3):
        write_swap(rows(5, str(i))(spark), name)
    assert len(glob.glob(f"{folder(spark, name)}/v/*")) == 3
    monkeypatch.setattr(versions, "KEEP_SECONDS", 0)
    recover(spark, name)
    assert len(glob.glob(f"{folder(spark, name)}/v/*")) == 1 and content(spark, name) == [(i, "2") for i in range(5)]
    with_parts = "ver.keep_p"
    write_swap(with_partitions(rows(30, "old")(spark), PART), with_parts, partition_by=["P"])
    merge_into_target(spark, with_parts, spark.createDataFrame([(12, "new")], "ID long, V string"), ["ID"], partition_by=PART)
    recover(spark, with_parts)
    assert len(glob.glob(f"{folder(spark, with_parts)}/v/*/P=1")) == 1
    assert content(spark, with_parts) == [(i, "new" if i == 12 else "old") for i in range(30)]


def test_a_failed_load_leaves_nothing(spark):
    write_swap(rows(4)(spark), "ver.failed")
    bad = rows(3)(spark).withColumn("V", F.when(F.col("ID") == 2, F.raise_error(F.lit("boom"))).otherwise(F.col("V")))
    with pytest.raises(Exception, match="boom"):
        write_swap(bad, "ver.failed")
    assert len(glob.glob(f"{folder(spark, 'ver.failed')}/v/*")) == 1 and spark.table("ver.failed").count() == 4
    drop_target(spark, "ver.failed")
    assert not target_exists(spark, "ver.failed") and not glob.glob(f"{folder(spark, 'ver.failed')}/v/*")
    write_swap(rows(2)(spark), "ver.failed")
    assert spark.table("ver.failed").count() == 2
