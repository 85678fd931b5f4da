import datetime as dt

import pytest
from pyspark.sql import functions as F

from tidecopy.functions import chunk_start, count_cutoff, lookback_start, parse_freq
from tidecopy.operators import chunk_bounds, chunk_list

D = dt.datetime


@pytest.mark.parametrize("freq, n, first", [
    ("MS", 3, D(2021, 1, 1)), ("W-MON", 9, D(2021, 1, 4)), ("AS", 1, D(2021, 1, 1)), ("YS", 1, D(2021, 1, 1)),
    ("D", 60, D(2021, 1, 1)), ("QS", 1, D(2021, 1, 1)), ("W", 9, D(2021, 1, 3)),
])
def test_fixture_grids(spark, freq, n, first):
    bounds = chunk_list(spark, 2021, freq, D(2021, 3, 1))
    assert len(bounds) == n
    assert bounds[0][0] == first
    assert bounds[-1][1] is None
    assert all(lo < hi for lo, hi in bounds[:-1])
    assert all(a[1] == b[0] for a, b in zip(bounds, bounds[1:]))


def test_no_boundary_raises(spark):
    with pytest.raises(ValueError, match="no MS boundary"):
        chunk_list(spark, 2021, "MS", D(2020, 12, 31))


def test_bad_alias():
    with pytest.raises(ValueError):
        parse_freq("freq")


def test_chunk_start_matches_bounds(spark):
    bounds = chunk_bounds(spark, 2021, "W-MON", D(2021, 3, 1))
    days = spark.range(0, 90).select(F.date_add(F.lit("2020-12-25").cast("date"), F.col("id").cast("int"))
                                     .cast("timestamp_ntz").alias("ts"))
    first, last = D(2021, 1, 4), D(2021, 3, 1)
    lo = days.select("ts", chunk_start("ts", "W-MON", first, last).alias("lo"))
    # range join as a reference: lo <= ts < hi (hi NULL = open)
    ref = days.join(bounds, (F.col("ts") >= F.col("lo")) & (F.col("hi").isNull() | (F.col("ts") < F.col("hi"))),
                    "left").select("ts", "lo")
    assert sorted(lo.collect()) == sorted(ref.collect())


def test_run_date_helpers():
    assert lookback_start("2021-03-10T13:00:00") == D(2021, 3, 7)
    assert count_cutoff(D(2021, 3, 10, 13, 20)) == D(2021, 3, 10, 12, 0)
    assert count_cutoff(D(2021, 3, 10, 13, 40)) == D(2021, 3, 10, 13, 0)


def test_column_helpers(spark):
    from tidecopy.operators import in_chunk

    days = spark.range(10).select(F.date_add(F.lit("2021-01-01").cast("date"), F.col("id").cast("int")).alias("d"))
    assert in_chunk(days, "d", dt.date(2021, 1, 3), dt.date(2021, 1, 6)).count() == 3
    assert in_chunk(days, "d", dt.date(2021, 1, 8)).count() == 3


from hypothesis import HealthCheck, given, settings  # noqa: E402
from hypothesis import strategies as st  # noqa: E402

# pandas names of the same grids (its own aliases for year starts changed over versions)
_PANDAS_ALIAS = {"D": "D", "W": "W-SUN", "W-MON": "W-MON", "W-THU": "W-THU", "MS": "MS", "QS": "QS-JAN",
                 "AS": "YS", "YS": "YS"}


@settings(max_examples=25, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.integers(2019, 2022), st.dates(dt.date(2019, 1, 1), dt.date(2023, 12, 31)),
       st.sampled_from(sorted(_PANDAS_ALIAS)))
def test_grid_matches_pandas_date_range(spark, start_year, until, freq):
    import pandas as pd

    until_ts = D(until.year, until.month, until.day, 13, 30)
    expect = [t.to_pydatetime() for t in pd.date_range(start=D(start_year, 1, 1), end=until_ts,
                                                      freq=_PANDAS_ALIAS[freq])]
    if not expect:
        with pytest.raises(ValueError):
            chunk_list(spark, start_year, freq, until_ts)
        return
    got = chunk_list(spark, start_year, freq, until_ts)
    assert [lo for lo, _ in got] == expect
    assert [hi for _, hi in got] == expect[1:] + [None]


def test_watermark_or_reaches_the_parquet_scan(spark, sf_small):
    from tidecopy.operators import incremental_filter

    orders = spark.read.parquet(f"{sf_small}/orders.parquet")
    delta = incremental_filter(orders, {"o_orderdate": "datetime", "o_orderkey": "int"}, D(2001, 6, 28), 1400)
    plan = delta.select("o_orderkey")._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [Or(GreaterThanOrEqual(o_orderdate,2001-06-28T00:00),GreaterThanOrEqual(o_orderkey,1400))]" in plan
    assert "ReadSchema: struct<o_orderkey:bigint,o_orderdate:timestamp_ntz>" in plan


ALIASES = ["D", "3D", "h", "6h", "1D12h", "1.5h", "90min", "45s", "B", "3B", "W", "W-MON", "2W-MON", "3W-FRI", "MS", "2MS", "ME",
           "5ME", "BMS", "BME", "2BME", "QS", "QS-FEB", "2QS-MAR", "QE", "QE-JAN", "BQS", "BQS-FEB", "BQE", "2BQE-NOV", "YS",
           "YS-APR", "2YS-APR", "YE", "YE-JUN", "BYS", "BYS-MAY", "BYE", "2BYE-SEP", "SMS", "SME", "3SMS", "3SME", "WOM-1MON",
           "WOM-2TUE", "2WOM-4SUN"]


@pytest.mark.parametrize("until", [D(2003, 3, 31), D(2004, 2, 29, 13, 5), D(2002, 12, 15), D(2002, 1, 1), D(2006, 7, 2, 0, 0, 1)])
def test_grids_equal_pandas(spark, until):
    """230 grids: every alias from Jan 1 (a Tuesday, in 2002) to dates of many kinds."""
    import pandas as pd

    from tidecopy.functions.timeparts import grid_points

    upto = {a: min(until, D(2002, 2, 3, 4, 5, 6)) if a in ("h", "1.5h", "90min", "45s") else until for a in ALIASES}
    lit = lambda t: F.lit(t.isoformat(sep=" ")).cast("timestamp_ntz")
    row = spark.range(1).select(*[grid_points(lit(D(2002, 1, 1)), lit(upto[a]), parse_freq(a)).alias(a) for a in ALIASES]).first()
    for a in ALIASES:
        assert (row[a] or []) == [t.to_pydatetime() for t in pd.date_range(D(2002, 1, 1), upto[a], freq=a)], a


@pytest.mark.parametrize("start", [D(2000, 1, 1), D(2003, 2, 28)])
def test_values_fall_into_the_grid_pandas_gives(spark, start):
    import bisect

    import pandas as pd

    step = spark.range(0, 1500).select((F.lit(start.isoformat(sep=" ")).cast("timestamp_ntz")
                                        + F.make_dt_interval(F.col("id").cast("int") - 20, (F.col("id") % 24).cast("int"),
                                                             F.lit(0), F.lit("7.250001").cast("decimal(18,6)"))).alias("ts"))
    todo = [a for a in ALIASES if a != "45s"]
    grids = {a: [t.to_pydatetime() for t in pd.date_range(start, start + dt.timedelta(days=1100), freq=a)] for a in todo}
    rows = step.select("ts", *[chunk_start("ts", a, grids[a][0], grids[a][-1]).alias(a) for a in todo]).collect()
    for r in rows:
        for a in todo:
            i = bisect.bisect_right(grids[a], r["ts"]) - 1
            assert r[a] == (grids[a][i] if i >= 0 else None), (a, r["ts"])


@pytest.mark.parametrize("alias", ["", "0D", "00MS", "W-FOO", "MS-JAN", "QS-13", "C", "bh", "1.5MS", "WOM-5MON", "LWOM-FRI", "10ms",
                                   "0.5s", "-1D", None])
def test_unsupported_aliases(alias):
    with pytest.raises(ValueError, match="unsupported freq"):
        parse_freq(alias)
