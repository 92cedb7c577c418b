"""Time functions (H1-H3, H8, H10-H11, H14-H17, B17) as Column expressions.

Instants are ``TIMESTAMP`` in a UTC session. Market-local wall time is a
``TIMESTAMP_NTZ`` derived explicitly, never an implicit index.
"""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

from ampere.config import (ISSUE_HOUR_DEFAULT, ISSUE_HOUR_LOCAL, MARKET_TZ,
                           QUARTERHOUR_CUTOVER_UTC, SEASONS)


def col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def as_instant(c) -> Column:
    """Naive (NTZ) timestamps are read as UTC instants (session zone UTC)."""
    return col(c).cast("timestamp")


def to_local(ts, tz: str = MARKET_TZ) -> Column:
    """H1: instant -> market-local wall time (``AT TIME ZONE``), as NTZ."""
    return F.from_utc_timestamp(col(ts), tz).cast("timestamp_ntz")


def delivery_date(ts, tz: str = MARKET_TZ) -> Column:
    """H2: market-local calendar date of an instant."""
    return F.to_date(F.from_utc_timestamp(col(ts), tz))


def floor_minutes(ts, minutes: int) -> Column:
    """Floor an instant to a multiple of ``minutes`` (quarter-hour: 15)."""
    secs = minutes * 60
    return F.timestamp_seconds(F.floor(F.unix_seconds(col(ts)) / secs) * secs)


def shift_hours(ts, hours: int) -> Column:
    """Absolute interval arithmetic on instants (DST-safe)."""
    return col(ts) + F.make_dt_interval(F.lit(0), F.lit(hours))


def quarter_of_hour(local_ts) -> Column:
    """H8: ``minute // 15`` of the local wall time."""
    return (F.minute(col(local_ts)) / 15).cast("int")


def season(month) -> Column:
    """H7: meteorological season of a month number."""
    m = col(month)
    return (F.when(m.isin(12, 1, 2), "winter").when(m.isin(3, 4, 5), "spring")
            .when(m.isin(6, 7, 8), "summer").otherwise("autumn"))


def season_order(season_col) -> Column:
    """sort key of seasons (ordered categorical)."""
    return F.element_at(F.create_map(*[x for i, s in enumerate(("winter", "spring", "summer", "autumn"))
                                       for x in (F.lit(s), F.lit(i))]), col(season_col))


def local_time_columns(df, ts: str = "timestamp", tz: str = MARKET_TZ, prefix: str = ""):
    """H3: helper columns in local time: timestamp, date, hour, dow (0=Mon), month, year, season."""
    lt = to_local(ts, tz)
    return (df.withColumn(f"{prefix}local_timestamp", lt)
              .withColumn(f"{prefix}local_date", F.to_date(F.col(f"{prefix}local_timestamp")))
              .withColumn(f"{prefix}hour", F.hour(F.col(f"{prefix}local_timestamp")))
              .withColumn(f"{prefix}dow", F.weekday(F.col(f"{prefix}local_date")))
              .withColumn(f"{prefix}month", F.month(F.col(f"{prefix}local_date")))
              .withColumn(f"{prefix}year", F.year(F.col(f"{prefix}local_date")))
              .withColumn(f"{prefix}season", season(F.col(f"{prefix}month"))))


def cyclic(value, period: float, offset: float = 0.0) -> tuple[Column, Column]:
    """sin/cos encoding of ``(value - offset) / period``."""
    angle = F.lit(2 * math.pi) * (col(value) - F.lit(offset)) / F.lit(period)
    return F.sin(angle), F.cos(angle)


def direction_sin_cos(deg) -> tuple[Column, Column]:
    """H9: sin/cos of an angle in degrees."""
    r = F.radians(col(deg))
    return F.sin(r), F.cos(r)


def issue_timestamp(ts, signal, tz: str = MARKET_TZ,
                    hours: dict[str, int] | None = None, default_hour: int = ISSUE_HOUR_DEFAULT) -> Column:
    """Forecast issue instant = ``h``:00 local on the day before delivery.

    Local midnight of the delivery day minus (24 - h) hours, converted back to
    UTC; no clock change falls between the issue hour and midnight.
    """
    hours = ISSUE_HOUR_LOCAL if hours is None else hours
    local_midnight = F.date_trunc("DAY", F.from_utc_timestamp(col(ts), tz))
    h = F.lit(default_hour)
    for sig, hr in hours.items():
        h = F.when(col(signal) == sig, F.lit(hr)).otherwise(h)
    issue_local = local_midnight - F.make_dt_interval(F.lit(0), F.lit(24) - h)
    return F.to_utc_timestamp(issue_local, tz)


def resolution_by_date(ts, cutover_utc: str = QUARTERHOUR_CUTOVER_UTC) -> Column:
    """Products from the cut-over instant on are quarter-hourly."""
    return F.when(col(ts) >= F.lit(cutover_utc).cast("timestamp"), "quarterhour").otherwise("hour")


def epoch_ms_to_ts(ms) -> Column:
    """Epoch milliseconds -> instant."""
    return F.timestamp_millis(col(ms).cast("long"))


def week_label(ts) -> Column:
    """D11 weekly bin label: Monday-start week labelled by its Sunday."""
    return F.date_add(F.to_date(F.date_trunc("WEEK", col(ts))), 6)


SEASON_OF_MONTH = SEASONS
