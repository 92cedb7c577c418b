"""Bounded reads whose bounds reach the scan.

A bound on a derived column (a floored instant, local time) isn't pushed into
a Parquet scan. Each reader here also states it as a range of the stored
instant that holds all wanted rows, which is pushed, and keeps the exact
bound on top.
"""

from __future__ import annotations

import datetime as dt
from zoneinfo import ZoneInfo

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ampere.config import MARKET_TZ


def instant(text: str) -> dt.datetime:
    """A UTC instant from ISO text (a date is its midnight; without offset: UTC)."""
    t = dt.datetime.fromisoformat(text)
    return t.replace(tzinfo=dt.timezone.utc) if t.tzinfo is None else t.astimezone(dt.timezone.utc)


def within(column: Column, start=None, end=None, closed: bool = False) -> Column:
    """``start <= column < end``, or ``<= end`` if ``closed``; either bound may be left out."""
    cond = F.lit(True) if start is None else column >= F.lit(start)
    if end is None:
        return cond
    upper = column <= F.lit(end) if closed else column < F.lit(end)
    return upper if start is None else cond & upper


def bounded(df: DataFrame, start: str | None = None, end: str | None = None, closed: bool = False,
            ts: str = "timestamp") -> DataFrame:
    """Rows whose instant lies in the bounds (ISO texts), ascending."""
    return df.where(within(F.col(ts), start and instant(start), end and instant(end), closed)).orderBy(ts)


def bounded_local(df: DataFrame, start: str | None = None, end: str | None = None, closed: bool = False,
                  ts: str = "timestamp", local: str = "local_timestamp", tz: str = MARKET_TZ) -> DataFrame:
    """Rows whose local time lies in the bounds (ISO texts of local time), ascending by it.

    The stored instant is bounded too, an hour wider on both sides, so that no
    row of a repeated or skipped hour is lost to the clock change.
    """
    def utc(text: str, hours: int) -> dt.datetime:
        t = dt.datetime.fromisoformat(text).replace(tzinfo=ZoneInfo(tz))
        return t.astimezone(dt.timezone.utc) + dt.timedelta(hours=hours)

    wide = within(F.col(ts), start and utc(start, -1), end and utc(end, 1), True)
    bound = lambda text: text and dt.datetime.fromisoformat(text)
    # local times are stored as instants or as wall clock times; the session's zone is UTC, so both read the same
    exact = within(F.col(local).cast("timestamp_ntz"), bound(start), bound(end), closed)
    return df.where(wide & exact).orderBy(local, ts)


def on_day(column: Column, day: str, tz: str = "UTC") -> Column:
    """Whether an instant falls on a calendar day of a time zone, as a range of instants.

    ``to_date(column) = day`` isn't pushed into a scan; this is. A day with a
    clock change has its 23 or 25 hours.
    """
    first = dt.date.fromisoformat(day)
    start, end = (dt.datetime.combine(d, dt.time(), ZoneInfo(tz)).astimezone(dt.timezone.utc) for d in (first, first + dt.timedelta(days=1)))
    return within(column, start, end)


def raw_bounds(raw_ts: str, minutes: int, start: str | None = None, end: str | None = None, closed: bool = False,
               ahead: dt.timedelta = dt.timedelta(0)) -> Column:
    """Bounds on ``floor(raw_ts, minutes) + ahead``, stated on the raw instant itself.

    ``floor(t) >= b`` is ``t >= ceil(b)``, ``floor(t) < b`` is ``t < ceil(b)``
    and ``floor(t) <= b`` is ``t < floor(b) + step``: equal for every row, so
    nothing has to be filtered again.
    """
    step = dt.timedelta(minutes=minutes)

    def floor(t: dt.datetime) -> dt.datetime:
        return t - (t - dt.datetime(1970, 1, 1, tzinfo=dt.timezone.utc)) % step

    def ceil(t: dt.datetime) -> dt.datetime:
        return floor(t) if floor(t) == t else floor(t) + step

    lo = None if start is None else ceil(instant(start) - ahead)
    hi = None if end is None else (floor(instant(end) - ahead) + step if closed else ceil(instant(end) - ahead))
    return within(F.col(raw_ts), lo, hi)


def days_returned(df: DataFrame, start: str, end: str, column: str = "local_timestamp") -> DataFrame:
    """(days_queried, days_returned, rows) of a half-open read."""
    asked = (dt.datetime.fromisoformat(end) - dt.datetime.fromisoformat(start)).days
    return df.agg(F.lit(asked).cast("long").alias("days_queried"), F.countDistinct(F.to_date(column)).alias("days_returned"),
                  F.count(F.lit(1)).alias("rows"))
