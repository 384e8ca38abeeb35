"""Date and time helpers (TIMESTAMP_NTZ throughout).

Bounds that depend only on ``as_of`` are computed on the driver and enter the
plan as typed literals, so Catalyst folds them and pushes them into the Parquet
scan. Column-side helpers never go through a session time zone.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

NTZ = "timestamp_ntz"


# ---------------------------------------------------------------- driver side
def as_datetime(value) -> dt.datetime:
    if isinstance(value, dt.datetime):
        return value
    if isinstance(value, dt.date):
        return dt.datetime(value.year, value.month, value.day)
    return dt.datetime.fromisoformat(str(value))


def day_floor(value) -> dt.datetime:
    v = as_datetime(value)
    return dt.datetime(v.year, v.month, v.day)


def month_floor(value) -> dt.datetime:
    v = as_datetime(value)
    return dt.datetime(v.year, v.month, 1)


def shift_months(value, months: int) -> dt.datetime:
    """Month arithmetic that sticks to the month end like the source database."""
    v = as_datetime(value)
    idx = v.year * 12 + (v.month - 1) + months
    year, month = divmod(idx, 12)
    month += 1
    last = _last_day(year, month)
    day = last if v.day == _last_day(v.year, v.month) else min(v.day, last)
    return v.replace(year=year, month=month, day=day)


def _last_day(year: int, month: int) -> int:
    nxt = dt.date(year + (month == 12), month % 12 + 1, 1)
    return (nxt - dt.timedelta(days=1)).day


def month_text(value) -> str:
    v = as_datetime(value)
    return f"{v.year:04d}-{v.month:02d}"


def months_back_start(as_of, months: int) -> dt.datetime:
    """First instant of the month ``months`` before the month of ``as_of``."""
    return shift_months(month_floor(as_of), -months)


# ---------------------------------------------------------------- column side
def ts_lit(value) -> Column:
    """A TIMESTAMP_NTZ literal (string cast: independent of any time zone)."""
    v = as_datetime(value)
    return F.lit(v.isoformat(sep=" ")).cast(NTZ)


def day_start(c: Column) -> Column:
    """``trunc(ts)``: midnight of the same day, still TIMESTAMP_NTZ."""
    return F.to_date(c).cast(NTZ)


def month_start(c: Column) -> Column:
    """``trunc(ts, 'MM')`` as TIMESTAMP_NTZ."""
    return F.trunc(c, "MM").cast(NTZ)


def plus_days(c: Column, n) -> Column:
    return F.timestamp_add("DAY", F.lit(n) if isinstance(n, int) else n, c)


def plus_hours(c: Column, n) -> Column:
    return F.timestamp_add("HOUR", F.lit(n) if isinstance(n, int) else n, c)


def plus_seconds(c: Column, n) -> Column:
    return F.timestamp_add("SECOND", F.lit(n) if isinstance(n, int) else n, c)


def minus_minutes(c: Column, n: int) -> Column:
    return F.timestamp_add("MINUTE", F.lit(-n), c)


def month_key(c: Column) -> Column:
    """``to_char(ts, 'YYYY-MM')``."""
    return F.date_format(c, "yyyy-MM")
