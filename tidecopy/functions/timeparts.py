"""Run-date arithmetic and chunk grids.

Every time is a parameter: nothing here reads the clock unless the caller
passes ``None`` for "now"."""

from __future__ import annotations

import datetime as dt
import re
from dataclasses import dataclass
from fractions import Fraction

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

_WEEKDAYS = ("MON", "TUE", "WED", "THU", "FRI", "SAT", "SUN")
_MONTHS = ("JAN", "FEB", "MAR", "APR", "MAY", "JUN", "JUL", "AUG", "SEP", "OCT", "NOV", "DEC")

# The offset aliases of the pandas grid, older spellings included.
# Ticks and their seconds:
_TICKS = {"D": 86400, "h": 3600, "H": 3600, "min": 60, "T": 60, "s": 1, "S": 1}
# Grids of months: (every how many months, the day of the month, default anchor month)
_MONTH_GRIDS = {
    "MS": (1, "first", None), "ME": (1, "last", None), "M": (1, "last", None),
    "BMS": (1, "first business", None), "BME": (1, "last business", None), "BM": (1, "last business", None),
    "QS": (3, "first", "JAN"), "QE": (3, "last", "DEC"), "Q": (3, "last", "DEC"),
    "BQS": (3, "first business", "JAN"), "BQE": (3, "last business", "DEC"), "BQ": (3, "last business", "DEC"),
    "YS": (12, "first", "JAN"), "AS": (12, "first", "JAN"),
    "YE": (12, "last", "DEC"), "Y": (12, "last", "DEC"), "A": (12, "last", "DEC"),
    "BYS": (12, "first business", "JAN"), "BAS": (12, "first business", "JAN"),
    "BYE": (12, "last business", "DEC"), "BY": (12, "last business", "DEC"), "BA": (12, "last business", "DEC"),
}
_HALF_GRIDS = {"SMS": "first and 15th", "SME": "15th and last", "SM": "15th and last"}


@dataclass(frozen=True)
class Freq:
    """A grid of chunk boundaries. ``unit`` is what is counted: SECOND, DAY, BUSINESS
    (days), HALF (months) or MONTH. Every ``step`` units is a boundary, on units whose
    number leaves ``phase`` when divided by ``every``; ``rule`` names the day of a month."""

    alias: str
    unit: str
    step: int
    every: int = 1
    phase: int = 0
    rule: str = ""

    def number(self, value: Column) -> Column:
        """Number of the unit that holds the day of ``value``."""
        day = F.to_date(value)
        if self.unit == "MONTH":
            return F.year(day) * 12 + F.month(day) - 1
        if self.unit == "HALF":
            late = F.dayofmonth(day) >= (15 if self.rule == "first and 15th" else 16)
            return (F.year(day) * 12 + F.month(day) - 1) * 2 + late.cast("int")
        days = F.datediff(day, _day(_MONDAY))
        if self.unit == "BUSINESS":  # a weekend counts as its Friday
            return F.floor(days / 7) * 5 + F.least(F.pmod(days, F.lit(7)), F.lit(4))
        return days

    def day(self, number: Column) -> Column:
        """The boundary's day in unit ``number``."""
        number = number.cast("int")
        if self.unit == "DAY":
            return F.date_add(_day(_MONDAY), number)
        if self.unit == "BUSINESS":
            return F.date_add(_day(_MONDAY), (F.floor(number / 5) * 7 + F.pmod(number, F.lit(5))).cast("int"))
        if self.unit == "HALF":
            first = _month(F.floor(number / 2))
            late = F.pmod(number, F.lit(2)) == 1
            if self.rule == "first and 15th":
                return F.when(late, F.date_add(first, 14)).otherwise(first)
            return F.when(late, F.last_day(first)).otherwise(F.date_add(first, 14))
        first = _month(number)
        last = F.last_day(first)
        if self.rule == "first":
            return first
        if self.rule == "last":
            return last
        if self.rule == "first business":  # weekday() counts from Monday
            return F.when(F.weekday(first) > 4, F.next_day(first, "MON")).otherwise(first)
        if self.rule == "last business":
            return F.date_sub(last, F.greatest(F.lit(0), F.weekday(last) - 4))
        weekday, week = self.rule.split()
        return F.date_add(F.next_day(F.date_sub(first, 1), weekday), 7 * (int(week) - 1))


_MONDAY = "1970-01-05"


def _day(text: str) -> Column:
    return F.lit(text).cast("date")


def _month(number: Column) -> Column:
    """First day of a month by its number (12 x year + month - 1)."""
    return F.make_date(F.floor(number / 12).cast("int"), F.pmod(number, F.lit(12)).cast("int") + 1, F.lit(1))


def parse_freq(alias: str) -> Freq:
    """Offset aliases of the pandas grid used for first loads: ``D``, ``h``, ``min``, ``s``
    and their sums (``1D12h``, ``1.5h``), ``B`` (business days), ``W`` (= ``W-SUN``) and
    ``W-MON`` .. ``W-SUN``, starts and ends of months, quarters and years (``MS``, ``QE``,
    ``YS-APR``), on business days (``BME``, ``BQS-FEB``), half months (``SMS``, ``SME``), the
    n-th weekday of a month (``WOM-2TUE``); multiples of each (``2W-MON``). Others are rejected: holidays, business hours, steps under a second."""
    bad = ValueError(f"unsupported freq {alias!r}: use a pandas offset such as h, D, 2W-MON, MS, QS-FEB, BME or YS")
    if not isinstance(alias, str):
        raise bad
    a = alias.strip().replace(" ", "")
    names = "|".join(sorted(_TICKS, key=len, reverse=True))
    if re.fullmatch(rf"((\d+(\.\d+)?)?({names}))+", a):
        seconds = sum(Fraction(n or 1) * _TICKS[t] for n, _, t in re.findall(rf"(\d+(\.\d+)?)?({names})", a))
        if seconds <= 0 or seconds.denominator != 1:
            raise bad
        return Freq(a, "SECOND", int(seconds))
    match = re.fullmatch(r"(\d*)([A-Za-z]+)(?:-([0-9A-Za-z]+))?", a)
    if match is None or match[1].strip("0") == "" != match[1]:
        raise bad
    n, name, anchor = int(match[1] or 1), match[2], (match[3] or "").upper()
    if name == "W" and (anchor or "SUN") in _WEEKDAYS:
        return Freq(a, "DAY", 7 * n, 7, _WEEKDAYS.index(anchor or "SUN"))
    if name in _MONTH_GRIDS:
        every, rule, default = _MONTH_GRIDS[name]
        if default is None and not anchor:
            return Freq(a, "MONTH", n, rule=rule)
        if default is not None and (anchor or default) in _MONTHS:
            return Freq(a, "MONTH", n * every, every, _MONTHS.index(anchor or default) % every, rule)
    if name in _HALF_GRIDS and not anchor:
        return Freq(a, "HALF", n, rule=_HALF_GRIDS[name])
    if name == "B" and not anchor:
        return Freq(a, "BUSINESS", n)
    if name == "WOM" and anchor[:1] in tuple("1234") and anchor[1:] in _WEEKDAYS:
        return Freq(a, "MONTH", n, rule=f"{anchor[1:]} {anchor[0]}")
    raise bad


def typed_lit(value, data_type: T.DataType | str) -> Column:
    """A literal of the column's own type, so that comparisons stay pushable.
    Times go through their text form, which does not depend on the session
    time zone for ``timestamp_ntz`` and ``date`` columns."""
    if isinstance(value, (dt.datetime, dt.date)):
        text = value.isoformat(sep=" ") if isinstance(value, dt.datetime) else value.isoformat()
        return F.lit(text).cast(data_type)
    return F.lit(value).cast(data_type)


def lookback_start(run_date: dt.date | dt.datetime | str, days: int = 3) -> dt.datetime:
    """Date part of the run date, minus ``days``, at midnight."""
    if isinstance(run_date, str):
        run_date = dt.datetime.strptime(run_date[:10], "%Y-%m-%d")
    if isinstance(run_date, dt.datetime):
        run_date = run_date.date()
    day = run_date - dt.timedelta(days=days)
    return dt.datetime(day.year, day.month, day.day)


def count_cutoff(now: dt.datetime | None = None) -> dt.datetime:
    """Half an hour before ``now``, floored to the hour."""
    now = now or dt.datetime.now()
    return (now - dt.timedelta(minutes=30)).replace(minute=0, second=0, microsecond=0)


def _time_of_day(value: Column) -> Column:
    return value - F.to_date(value).cast("timestamp_ntz")


def grid_points(start: Column, until: Column, freq: Freq) -> Column:
    """Array of the grid points from the first one at or after ``start`` up to ``until``
    (timestamp_ntz; NULL or empty: no point). Points keep the time of day of ``start``."""
    if freq.unit == "SECOND":
        return F.when(start <= until, F.sequence(start, until, F.expr(f"INTERVAL '{freq.step}' SECOND")))
    held = freq.number(start).cast("bigint")
    aligned = held + F.pmod(F.lit(freq.phase) - held, F.lit(freq.every))
    first = F.when(freq.day(aligned) < F.to_date(start), aligned + freq.every).otherwise(aligned)
    last = freq.number(until).cast("bigint")
    numbers = F.when(first <= last, F.sequence(first, last, F.lit(freq.step).cast("bigint")))
    points = F.transform(numbers, lambda k: freq.day(k).cast("timestamp_ntz") + _time_of_day(start))
    return F.filter(points, lambda p: p <= until)


def grid_trunc(value: Column, freq: Freq, first: Column) -> Column:
    """The grid point at or before ``value``, on the grid that holds the point ``first``."""
    if freq.unit == "SECOND":
        micros = lambda v: (F.datediff(F.to_date(v), _day(_MONDAY)).cast("bigint") * 86400000000
                            + F.hour(v) * 3600000000 + F.minute(v) * 60000000
                            + (F.date_part(F.lit("SECOND"), v) * 1000000).cast("bigint"))
        over = F.pmod(micros(value) - micros(first), F.lit(freq.step * 1000000).cast("bigint"))
        zero = F.lit(0)
        return value - F.make_dt_interval(zero, zero, zero, (over.cast("decimal(18,0)") * F.lit("0.000001").cast("decimal(6,6)"))
                                          .cast("decimal(18,6)"))
    origin = freq.number(first).cast("bigint")
    steps = F.floor((freq.number(value).cast("bigint") - origin) / F.lit(freq.step))
    point = lambda k: freq.day(origin + k * freq.step).cast("timestamp_ntz") + _time_of_day(first)
    return F.when(point(steps) <= value, point(steps)).otherwise(point(steps - 1))


def chunk_start(value: Column | str, freq: Freq | str, first: dt.datetime, last: dt.datetime) -> Column:
    """Lower bound of the chunk holding ``value``: NULL before the first
    boundary, the last boundary for everything after it (the open chunk)."""
    freq = parse_freq(freq) if isinstance(freq, str) else freq
    value = F.col(value) if isinstance(value, str) else value
    v = value.cast("timestamp_ntz")
    lo = F.least(grid_trunc(v, freq, typed_lit(first, "timestamp_ntz")), typed_lit(last, "timestamp_ntz"))
    return F.when(v >= typed_lit(first, "timestamp_ntz"), lo)
