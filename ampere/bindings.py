"""Bindings of the driver's test tables onto the platform's raw schemas.

The operators are generic; this module only says which test columns play
which role, so that every registered query reads the given tables and its
work grows with them.

``events`` (event_id, ts, user_id, event_type, value, props) becomes:

* raw signals: ``timestamp`` = ts floored to the hour (or quarter-hour),
  ``signal`` = upper(event_type), ``value`` = value - 50 (signed, so the
  validity and negative-price rules are exercised), ``unit`` = 'MW',
  ``fetched_at`` = ts, ``event_id`` = tie-breaker. Several events of one
  (hour, type) are revisions of one key; the upsert keeps the latest.
* raw signal forecasts: same rows, ``signal`` suffixed ``_FC``, valid for the
  *next* hour (``timestamp + 1 h``), issue time by the day-ahead rule (H15).
* raw weather: ``region`` = one of four regions by ``user_id % 4``,
  ``signal_type`` = one of the five weather variables by event type,
  ``value`` = value (non-negative).
* raw weather forecasts: same, valid for the next hour, issue = valid - 18 h,
  model 'icon_seamless'; every fetched version is kept (4-column key).

``orders`` (o_orderdate, o_totalprice) becomes a multi-year daily series for
calendar, resample and regime queries.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ampere.config import (GENERATION_SIGNALS, LOAD_SIGNALS, PRICE_SIGNALS, Catalog, WEATHER_REGIONS,
                           WEATHER_VARIABLES)
from ampere.functions.time import floor_minutes, issue_timestamp, shift_hours
from ampere.operators.merge import latest_per_key

# Fixed binding values: role of each event type.
EVENT_TYPES = ["click", "error", "purchase", "signup", "view"]
EVENT_WEATHER_VARIABLE = {"click": "wind_speed_100m", "error": "wind_direction_100m",
                          "purchase": "shortwave_radiation", "signup": "cloud_cover",
                          "view": "temperature_2m"}
REGION_ORDER = list(WEATHER_REGIONS)  # user_id % 4 -> index
VALUE_OFFSET = 50.0
RETIRED_CUT = "2024-01-20 00:00:00"

EVENTS_CATALOG = Catalog(
    generation={"CLICK": "click_mw", "VIEW": "view_mw", "SIGNUP": "signup_mw"},
    load={"ERROR": "error_mw", "PURCHASE": "purchase_mw"},
    signed=("ERROR", "PURCHASE"),
    retired={"SIGNUP": RETIRED_CUT},
    home_price="PURCHASE",
    neighbours={"CLICK": "click", "VIEW": "view", "SIGNUP": "signup"},
    forecasts={"CLICK_FC": "click_forecast_mw", "ERROR_FC": "error_forecast_mw",
               "PURCHASE_FC": "purchase_forecast_mw", "SIGNUP_FC": "signup_forecast_mw",
               "VIEW_FC": "view_forecast_mw"},
    forecast_signed=("ERROR_FC", "PURCHASE_FC"),
    groups={"renewable": ["CLICK", "VIEW"], "fossil": ["SIGNUP"], "storage": ["PURCHASE"]},
)
EVENTS_ISSUE_HOURS = {"ERROR_FC": 10}

def energy_events(dense: DataFrame) -> DataFrame:
    """Dense events, and one event of every energy signal for each purchase of the first region (``plans.oracle.ENERGY_EVENTS``)."""
    n = F.lit(len(ENERGY_TYPES))
    k = F.explode(F.sequence(F.lit(0), n - 1)).alias("k")
    e = dense.where("event_type = 'purchase' and user_id = 0").select("*", k)
    e = e.select((-1 - F.col("event_id") * n - F.col("k")).alias("event_id"), "ts", "user_id",
                 F.element_at(F.array(*[F.lit(t) for t in ENERGY_TYPES]), F.col("k") + 1).alias("event_type"),
                 (F.col("value") + 30 + (F.col("event_id") * (F.col("k") + 3)) % 17).alias("value"),
                 *[c for c in dense.columns if c == "at"])
    return dense.unionByName(e)


# Energy binding: the event types that play its signals and (with _FC) its forecasts.
ENERGY_TYPES = [s.lower() for s in (*GENERATION_SIGNALS, *LOAD_SIGNALS, *PRICE_SIGNALS, "WIND_PV", "TOTAL_GENERATION")]
REVISED_DAY = "2024-03-05"

# Dense binding: first instant, and the quarter-hours of a week.
DENSE_START = "2024-01-01 00:00:00"
SLOTS_A_WEEK = 672
#: Orders that a task turns into (20 times as many) events.
ORDERS_A_TASK = 25_000

RES_MINUTES = {"hour": 60, "quarterhour": 15}


_READS: dict = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Parquet table of the driver; the DataFrame (resolved schema, file
    listing) is reused within one session."""
    key = (id(spark._jsparkSession), sf_dir, name)
    if key not in _READS:
        _READS[key] = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    return _READS[key]


def events(spark: SparkSession, sf_dir: str, source: str = "events", at: Callable[[Column], Column] | None = None) -> DataFrame:
    """Events with ``ts`` as a UTC instant, from the ``events`` table or (dense) from ``orders``.

    ``at`` gives the column of this name from ``ts``: the instant that the rows are used at, by which dense events lie together.

    ``revised`` are the dense events with other values on :data:`REVISED_DAY`;
    ``energy`` have an event for every signal of the energy catalogue, too.
    """
    if source in ("orders", "revised", "energy"):
        e = dense_events(spark, sf_dir, at)
        if source == "revised":
            e = e.withColumn("value", F.col("value") + F.when(F.to_date("ts") == F.lit(REVISED_DAY).cast("date"), 5.0).otherwise(0.0))
        return energy_events(e) if source == "energy" else e
    e = table(spark, sf_dir, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    return e if at is None else e.withColumn("at", at(F.col("ts")))


def dense_events(spark: SparkSession, sf_dir: str, at: Callable[[Column], Column] | None = None) -> DataFrame:
    """Events without holes, derived from ``orders``.

    Orders are dealt to the quarter-hours of as many whole weeks as they can
    fill; each gives an event of every type and region, later orders of a
    quarter-hour being revisions. Some errors are left out (single gaps) and
    on some days all clicks (incomplete days). ``plans.oracle.DENSE_EVENTS``
    is the same in SQL. The orders are dealt by the day of their slot before
    they become events, ``ORDERS_A_TASK`` to a task: so revisions of a key
    meet before the first exchange, and nothing twenty times as large as the
    orders has to be stored. With ``at`` they are dealt by that instant, a
    column of the events then: aggregates and joins by it need no exchange.
    """
    if at is not None:
        return _dense_rows(spark, sf_dir, at)
    key = (id(spark._jsparkSession), sf_dir, "dense events")
    if key not in _READS:
        _READS[key] = _dense_rows(spark, sf_dir)
    return _READS[key]


def _dense_rows(spark: SparkSession, sf_dir: str, at: Callable[[Column], Column] | None = None) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    key = (id(spark._jsparkSession), sf_dir, "orders counted")
    if key not in _READS:
        _READS[key] = o.count()
    n = _READS[key]
    slots = F.lit(max(1, n // SLOTS_A_WEEK) * SLOTS_A_WEEK).cast("long")
    e = o.select("o_orderkey", (F.round(F.col("o_totalprice") * 100).cast("long") % 1000 / 100.0).alias("cents"),
                 (F.col("o_orderkey") % slots).alias("slot"), F.floor(F.col("o_orderkey") / slots).alias("revision"))
    ts = F.lit(DENSE_START).cast("timestamp") + F.make_dt_interval(mins=(F.col("slot") * 15).cast("int"), secs=F.col("revision"))
    e = e if at is None else e.withColumn("at", at(ts))
    e = e.repartition(n // ORDERS_A_TASK + 1, F.floor(F.col("slot") / 96) if at is None else F.col("at"))
    e = e.select("*", F.explode(F.sequence(F.lit(0), F.lit(4 * len(EVENT_TYPES) - 1))).alias("k"))
    e = e.withColumn("event_type", F.element_at(F.array(*[F.lit(t) for t in EVENT_TYPES]), (F.floor(F.col("k") / 4) + 1).cast("int")))
    home = F.col("event_type") == "purchase"
    noise = (F.col("o_orderkey") * 7919 + F.col("k") * 31) % 1000 / 100.0 + F.col("cents")
    wave = F.sin(2 * F.pi() * (F.col("slot") % 96) / 96)
    left_out = (((F.col("event_type") == "error") & (F.col("slot") % 97 == 5))
                | ((F.col("event_type") == "click") & (F.floor(F.col("slot") / 96) % 23 == 11)))
    return e.where(~left_out).select(
        (F.col("o_orderkey") * 4 * len(EVENT_TYPES) + F.col("k")).alias("event_id"), ts.alias("ts"),
        (F.col("k") % 4).cast("long").alias("user_id"), "event_type",
        (F.when(home, 60).otherwise(75) + F.when(home, 30).otherwise(15) * wave + noise).alias("value"),
        *[F.col("at") for _ in range(at is not None)])


def raw_signal_rows(spark, sf_dir, resolution: str = "hour", signals=None, source: str = "events") -> DataFrame:
    """Landed signal rows, revisions included (input of the upsert). With
    ``signals`` the selection is an ``IN`` filter on the stored column, which
    the Parquet reader applies (pushed filter), before any projection."""
    e = events(spark, sf_dir, source, lambda ts: floor_minutes(ts, RES_MINUTES[resolution]))
    if signals is not None:
        e = e.where(F.col("event_type").isin(*[s.lower() for s in signals]))
    return e.select(F.col("at").alias("timestamp"),
                    F.upper("event_type").alias("signal"),
                    (F.col("value") - VALUE_OFFSET).alias("value"),
                    F.lit("MW").alias("unit"), F.lit(resolution).alias("resolution"),
                    F.col("ts").alias("fetched_at"), "event_id")


def raw_signals(spark, sf_dir, resolution: str = "hour", signals=None, source: str = "events") -> DataFrame:
    """``raw_*`` signal table after the keyed upsert (one row per key)."""
    rows = raw_signal_rows(spark, sf_dir, resolution, signals, source)
    merged = latest_per_key(rows, ["timestamp", "signal", "resolution"], ["fetched_at", "event_id"])
    return merged.select("timestamp", "signal", "value", "unit", "resolution")


def raw_signal_forecast_rows(spark, sf_dir, resolution: str = "hour", source: str = "events", signals=None) -> DataFrame:
    """Landed forecasts, revisions included; ``signals`` (names with ``_FC``) as in :func:`raw_signal_rows`."""
    e = events(spark, sf_dir, source, lambda ts: shift_hours(floor_minutes(ts, RES_MINUTES[resolution]), 1))
    if signals is not None:
        e = e.where(F.col("event_type").isin(*[s.removesuffix("_FC").lower() for s in signals]))
    sig = F.concat(F.upper("event_type"), F.lit("_FC"))
    return e.select(F.col("at").alias("timestamp"), sig.alias("signal"),
                    (F.col("value") - VALUE_OFFSET).alias("value"), F.lit("MW").alias("unit"),
                    F.lit(resolution).alias("resolution"), F.col("ts").alias("fetched_at"), "event_id"
                    ).withColumn("issue_timestamp", issue_timestamp("timestamp", "signal", hours=EVENTS_ISSUE_HOURS))


def raw_signal_forecast(spark, sf_dir, resolution: str = "hour", source: str = "events", signals=None) -> DataFrame:
    rows = raw_signal_forecast_rows(spark, sf_dir, resolution, source, signals)
    merged = latest_per_key(rows, ["timestamp", "signal", "resolution"], ["fetched_at", "event_id"])
    return merged.select("issue_timestamp", "timestamp", "signal", "value", "unit", "resolution", "fetched_at")


def _region() -> F.Column:
    return F.element_at(F.array(*[F.lit(r) for r in REGION_ORDER]), (F.col("user_id") % 4 + 1).cast("int"))


def _variable() -> F.Column:
    m = F.create_map(*[x for k, v in EVENT_WEATHER_VARIABLE.items() for x in (F.lit(k), F.lit(v))])
    return F.element_at(m, F.col("event_type"))


def _unit(var: F.Column) -> F.Column:
    m = F.create_map(*[x for k, v in WEATHER_VARIABLES.items() for x in (F.lit(k), F.lit(v))])
    return F.element_at(m, var)


def raw_weather_rows(spark, sf_dir, source: str = "events") -> DataFrame:
    e = events(spark, sf_dir, source, lambda ts: F.date_trunc("HOUR", ts))
    return (e.select(F.col("at").alias("timestamp"), _region().alias("region"),
                     _variable().alias("signal_type"), F.col("value"),
                     F.col("ts").alias("fetched_at"), "event_id")
             .withColumn("unit", _unit(F.col("signal_type"))))


def raw_weather(spark, sf_dir, source: str = "events") -> DataFrame:
    merged = latest_per_key(raw_weather_rows(spark, sf_dir, source), ["timestamp", "region", "signal_type"],
                            ["fetched_at", "event_id"])
    return merged.select("timestamp", "region", "signal_type", "value", "unit")


def raw_weather_forecast(spark, sf_dir, source: str = "events") -> DataFrame:
    """All fetched versions (key includes ``fetched_at``)."""
    e = events(spark, sf_dir, source, lambda ts: shift_hours(F.date_trunc("HOUR", ts), 1))
    t = F.col("at")
    return (e.select(t.alias("timestamp"), shift_hours(t, -18).alias("issue_timestamp"),
                     _region().alias("region"), _variable().alias("signal_type"), "value",
                     F.lit("icon_seamless").alias("model"), F.col("ts").alias("fetched_at"))
             .withColumn("unit", _unit(F.col("signal_type")))
             .select("timestamp", "issue_timestamp", "region", "signal_type", "value", "unit", "model",
                     "fetched_at"))


def routing(spark: SparkSession, catalog: Catalog = EVENTS_CATALOG) -> DataFrame:
    """(signal, table) catalogue as a DataFrame (configuration, a few rows)."""
    return spark.createDataFrame(catalog.table_of(), "signal string, table string")


def daily_orders(spark, sf_dir) -> DataFrame:
    """Multi-year daily series: (timestamp = order day, value = sum of totals, n)."""
    o = table(spark, sf_dir, "orders")
    return (o.groupBy(F.col("o_orderdate").cast("timestamp").alias("timestamp"))
             .agg(F.sum("o_totalprice").alias("value"), F.count(F.lit(1)).alias("n_orders")))
