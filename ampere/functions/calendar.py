"""Date spine, holiday calendar and date dimension."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ampere.config import EASTER_HOLIDAYS, FIXED_HOLIDAYS
from ampere.functions.time import season


def date_spine(bounds: DataFrame, start: str = "start", end: str = "end",
               end_exclusive: bool = True, name: str = "date_day") -> DataFrame:
    """One row per day between the dates of a one-row ``bounds`` frame.

    The spine is generated inside a task from the bounds row (no driver loop);
    its size is the number of days in the range, independent of data volume.
    """
    last = F.date_sub(F.col(end), 1) if end_exclusive else F.col(end)
    return bounds.select(F.explode(F.sequence(F.col(start).cast("date"), last.cast("date"),
                                              F.expr("INTERVAL 1 DAY"))).alias(name))


def easter_sunday(year) -> Column:
    """Gregorian Easter Sunday of a year (anonymous Gregorian computus)."""
    y = F.col(year) if isinstance(year, str) else year
    a = y % 19
    b = F.floor(y / 100)
    c = y % 100
    d = F.floor(b / 4)
    e = b % 4
    f = F.floor((b + 8) / 25)
    g = F.floor((b - f + 1) / 3)
    h = (19 * a + b - d - g + 15) % 30
    i = F.floor(c / 4)
    k = c % 4
    ll = (32 + 2 * e + 2 * i - h - k) % 7
    m = F.floor((a + 11 * h + 22 * ll) / 451)
    n = h + ll - 7 * m + 114
    return F.make_date(y.cast("int"), F.floor(n / 31).cast("int"), ((n % 31) + 1).cast("int"))


def holidays_for_years(years: DataFrame, year: str = "year") -> DataFrame:
    """Nation-wide public holidays (date, holiday_name) of each year.

    Rule form of the holiday seed: five fixed dates plus four Easter-relative
    days; valid for reunified Germany (1991 on) except one-off holidays.
    """
    y = F.col(year)
    easter = easter_sunday(y)
    items = [F.struct(F.make_date(y, F.lit(mo), F.lit(dd)).alias("date"), F.lit(nm).alias("holiday_name"))
             for mo, dd, nm in FIXED_HOLIDAYS]
    items += [F.struct(F.date_add(easter, off).alias("date"), F.lit(nm).alias("holiday_name"))
              for off, nm in EASTER_HOLIDAYS]
    return years.select(F.inline(F.array(*items)))


def easter_date(year: int) -> dt.date:
    """Gregorian Easter Sunday (same computus as :func:`easter_sunday`)."""
    a, b, c = year % 19, year // 100, year % 100
    d, e = b // 4, b % 4
    g = (b - (b + 8) // 25 + 1) // 3
    h = (19 * a + b - d - g + 15) % 30
    i, k = c // 4, c % 4
    ll = (32 + 2 * e + 2 * i - h - k) % 7
    m = (a + 11 * h + 22 * ll) // 451
    n = h + ll - 7 * m + 114
    return dt.date(year, n // 31, n % 31 + 1)


EASTER_YEARS = range(1900, 2200)
# Easter Sunday per year, generated from the rule above (constant map literal)
_EASTER_MAP_SQL = "map(" + ", ".join(f"{y}, DATE'{easter_date(y).isoformat()}'" for y in EASTER_YEARS) + ")"
_FIXED_MAP_SQL = "map(" + ", ".join(f"{mo * 100 + dd}, '{nm}'" for mo, dd, nm in FIXED_HOLIDAYS) + ")"
_EASTER_OFFSET_MAP_SQL = "map(" + ", ".join(f"{off}, '{nm}'" for off, nm in EASTER_HOLIDAYS) + ")"


def holiday_name_sql(day: str) -> str:
    """Public-holiday name of the DATE expression ``day`` (NULL if none), SQL
    text: two lookups in constant maps (fixed dates by month*100+day, Easter
    offsets by days from that year's Easter Sunday). Years outside 1900-2199
    raise instead of losing their Easter holidays; null days give null."""
    easter = (f"CASE WHEN year({day}) NOT BETWEEN {EASTER_YEARS[0]} AND {EASTER_YEARS[-1]} "
              f"THEN CAST(raise_error('no Easter date for year ' || year({day})) AS DATE) "
              f"ELSE try_element_at({_EASTER_MAP_SQL}, year({day})) END")
    return (f"coalesce(try_element_at({_FIXED_MAP_SQL}, month({day}) * 100 + dayofmonth({day})), "
            f"try_element_at({_EASTER_OFFSET_MAP_SQL}, datediff({day}, {easter})))")


def easter_sql(day: str) -> str:
    """Easter Sunday of the year of the DATE expression ``day``, any Gregorian year, SQL text: the Sunday after the
    paschal full moon, which falls ``moon`` days after 21 March (same rule as :func:`easter_sunday`)."""
    y = f"year({day})"
    century = f"floor({y} / 100)"
    moon = (f"pmod(19 * pmod({y}, 19) + {century} - floor({century} / 4) - floor(({century} - floor(({century} + 8) / 25) + 1) / 3) + 15, 30)")
    early = f"CASE WHEN {moon} = 29 OR ({moon} = 28 AND pmod({y}, 19) > 10) THEN 1 ELSE 0 END"
    return f"next_day(date_add(make_date({y}, 3, 21), CAST({moon} - {early} AS INT)), 'SUN')"


def holiday_rule_sql(day: str) -> str:
    """:func:`holiday_name_sql` for any year: Easter by rule, not from the map of years."""
    return (f"coalesce(try_element_at({_FIXED_MAP_SQL}, month({day}) * 100 + dayofmonth({day})), "
            f"try_element_at({_EASTER_OFFSET_MAP_SQL}, datediff({day}, {easter_sql(day)})))")


def holiday_name(day) -> Column:
    """Name of the public holiday on ``day`` (null if none); pure expression,
    so no holiday table has to be joined or broadcast. ``day`` is a column
    name or SQL expression of DATE type."""
    return F.expr(holiday_name_sql(day))


def calendar_columns(day: str, holiday: Column | None = None) -> list[Column]:
    """H4-H7 + holiday flags of a DATE column (name or SQL expression), as the
    date dimension defines them (ISO week; day_of_week 0 = Monday); holidays of
    any year, as a series may reach beyond the map of :func:`holiday_name`."""
    hol = holiday_rule_sql(day) if holiday is None else None
    exprs = [f"year({day}) AS year", f"quarter({day}) AS quarter", f"month({day}) AS month",
             f"weekofyear({day}) AS week_of_year", f"weekday({day}) AS day_of_week",
             f"weekday({day}) >= 5 AS is_weekend",
             f"CASE WHEN month({day}) IN (12, 1, 2) THEN 'winter' WHEN month({day}) IN (3, 4, 5) THEN 'spring' "
             f"WHEN month({day}) IN (6, 7, 8) THEN 'summer' ELSE 'autumn' END AS season"]
    cols = [F.expr(e) for e in exprs]
    h = F.expr(hol) if holiday is None else holiday
    cols += [h.isNotNull().alias("is_german_public_holiday"), h.alias("holiday_name"),
             ((F.expr(f"weekday({day})") < 5) & h.isNull()).alias("is_workday")]
    return cols


def date_dimension(spine: DataFrame, day: str = "date_day") -> DataFrame:
    """Calendar attributes of a date spine (holidays by rule, H22)."""
    return spine.select(F.col(day), *calendar_columns(day))


def holiday_join(spine: DataFrame, holidays: DataFrame, day: str = "date_day") -> DataFrame:
    """Date dimension from a holiday *table* (e.g. the CSV seed, A23):
    left join + ``IS NOT NULL`` flag. The seed has a handful of rows per year;
    it is broadcast because its size is bounded by the calendar, not the data."""
    hol = F.broadcast(holidays.select(F.col("date").alias("_hday"), F.col("holiday_name").alias("_hname")))
    joined = spine.join(hol, F.col(day) == F.col("_hday"), "left")
    return joined.select(F.col(day), *calendar_columns(day, holiday=F.col("_hname")))


def calendar_join(facts: DataFrame, dim: DataFrame, ts: str = "timestamp", day: str = "date_day") -> DataFrame:
    """C4: attributes of the (UTC) day from a date dimension; rows of days that it doesn't cover keep nulls.

    The dimension is broadcast: it has a row a day and its holidays are known
    for 300 years, so it has at most 109,573 rows however many facts there are.
    """
    return facts.join(F.broadcast(dim), F.to_date(F.col(ts)) == dim[day], "left")


def dimension_for(df: DataFrame, ts: str = "timestamp", day: str = "date_day") -> DataFrame:
    """Date dimension covering the (UTC) dates of ``df[ts]``; derived from the data."""
    bounds = df.agg(F.min(F.to_date(ts)).alias("start"), F.max(F.to_date(ts)).alias("end"))
    return date_dimension(date_spine(bounds, end_exclusive=False, name=day), day=day)
