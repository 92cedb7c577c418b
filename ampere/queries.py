"""Registered queries: name -> (Spark builder, DuckDB oracle SQL).

Each builder takes ``(spark, sf_dir)``, reads the driver tables through
:mod:`ampere.bindings` and returns a DataFrame normalised by ``tidy``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ampere import bindings as B
from ampere.config import ENERGY
from ampere.functions.output import tidy
from ampere.operators.staging import routed
from ampere.plans import oracle as O
from ampere.plans.contracts import build_contract, hourly_spec, quarter_hourly_spec
from ampere.plans.products import Warehouse

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        def run(spark, sf_dir, _fn=fn):
            return tidy(_fn(spark, sf_dir))
        run.__name__ = name
        run.__doc__ = fn.__doc__
        QUERIES[name] = run
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


# ---------------------------------------------------------------------------
# warehouse over the events binding
# ---------------------------------------------------------------------------
_WAREHOUSES: dict = {}


def warehouse(spark: SparkSession, sf_dir: str, resolution: str = "hour", source: str = "events") -> Warehouse:
    """The products over a test binding, built once per (session, data
    directory, resolution, binding) and shared by every query — the DataFrame
    plans play the role of the platform's materialised tables."""
    key = (id(spark._jsparkSession), sf_dir, resolution, source)
    if key not in _WAREHOUSES:
        _WAREHOUSES[key] = _build_warehouse(spark, sf_dir, resolution, source)
    return _WAREHOUSES[key]


def _build_warehouse(spark: SparkSession, sf_dir: str, resolution: str, source: str = "events") -> Warehouse:
    # each raw table reads only its own signals (IN filter pushed into the scan)
    catalog = ENERGY if source == "energy" else CAT
    tables = {t: sorted({s for s, tt in catalog.table_of() if tt == t}) for t in ("generation", "prices", "neighbour_prices")}
    raw = {
        "generation": B.raw_signals(spark, sf_dir, resolution, tables["generation"], source),
        "prices": B.raw_signals(spark, sf_dir, resolution, tables["prices"], source),
        "neighbour_prices": B.raw_signals(spark, sf_dir, resolution, tables["neighbour_prices"], source),
        "signal_forecast": B.raw_signal_forecast(spark, sf_dir, resolution, source, sorted(catalog.forecasts)),
        "weather": B.raw_weather(spark, sf_dir, source),
        "weather_forecast": B.raw_weather_forecast(spark, sf_dir, source),
    }
    return Warehouse(spark, raw, catalog)


CAT = B.EVENTS_CATALOG
EV_LOAD_LAGS = {"error_mw": "error", "purchase_mw": "purchase", "click_mw": "click", "view_mw": "view"}
EV_CONSUMPTION = ("error_forecast_mw", "error_mw", "load_error_mw")
HOURLY = hourly_spec(CAT, EV_LOAD_LAGS, EV_CONSUMPTION, ("click_forecast_mw", "view_forecast_mw"))
QUARTER_HOURLY = quarter_hourly_spec(CAT, EV_LOAD_LAGS, EV_CONSUMPTION,
                                     ("click_forecast_mw", "view_forecast_mw", "purchase_forecast_mw"))


@register("hourly_model_contract", O.contract_sql(HOURLY))
def hourly_model_contract(spark, sf_dir):
    """I12 (flagship): hourly lagged price-model contract, fan-out lags."""
    return build_contract(warehouse(spark, sf_dir).fct_ml_features, HOURLY, method="fanout")


@register("hourly_model_contract_self_join", O.contract_sql(HOURLY))
def hourly_model_contract_self_join(spark, sf_dir):
    """I12 with one self left join per offset (C6 SQL shape); same oracle."""
    return build_contract(warehouse(spark, sf_dir).fct_ml_features, HOURLY, method="self_join")


@register("quarter_hourly_model_contract", O.contract_sql(QUARTER_HOURLY))
def quarter_hourly_model_contract(spark, sf_dir):
    """Quarter-hourly contract (lags 96/192/672 qh, quarter_of_hour)."""
    return build_contract(warehouse(spark, sf_dir, "quarterhour").fct_ml_features, QUARTER_HOURLY)


# ---------------------------------------------------------------------------
# shared pieces
# ---------------------------------------------------------------------------
from ampere.functions import calendar as CAL  # noqa: E402
from ampere.functions import time as TM  # noqa: E402
from ampere.operators import lags as LG  # noqa: E402
from ampere.operators import quantiles as QT  # noqa: E402
from ampere.operators import reshape as RS  # noqa: E402
from ampere.operators import windows as WN  # noqa: E402
from ampere.operators.merge import latest_per_key, merge_latest  # noqa: E402

W_H = "WITH " + O.staging_ctes("hour")
W_ML = "WITH " + O.ml_features_ctes("hour")
LOCAL_SQL = "((timestamp AT TIME ZONE 'UTC') AT TIME ZONE 'Europe/Berlin')"


def prices(spark, sf_dir, resolution="hour"):
    return warehouse(spark, sf_dir, resolution).fct_market_prices


def _dbl(names):
    return list(names)


# -- A/B/I staging, upsert, routing -----------------------------------------
@register("stage_signals_valid", O.rounded(f"{W_H} SELECT timestamp, signal_name, value, unit, resolution FROM stg_gen",
                                           ["value"]))
def stage_signals_valid(spark, sf_dir):
    """I1 (B1 B2 B3 B6): NaN->null, nulls dropped, generation validity rule."""
    return warehouse(spark, sf_dir).stg_generation_load


UPSERT_BASE_BEFORE = "2024-01-20 00:00:00"
UPSERT_DELTA_FROM = "2024-01-15 00:00:00"


@register("merge_latest_upsert", O.rounded(f"""WITH sig_rows AS ({O.signal_rows('hour')}),
base AS ({O.latest(f"(SELECT * FROM sig_rows WHERE fetched_at < TIMESTAMP '{UPSERT_BASE_BEFORE}')",
                   'timestamp, signal, resolution')}),
delta AS (SELECT timestamp, signal, value + 1 AS value, 'MWh' AS unit, resolution, fetched_at, event_id
          FROM sig_rows WHERE fetched_at >= TIMESTAMP '{UPSERT_DELTA_FROM}'),
u AS (SELECT *, 0 AS d FROM base UNION ALL SELECT *, 1 AS d FROM delta),
w AS ({O.latest('u', 'timestamp, signal, resolution', 'd DESC, fetched_at DESC, event_id DESC')})
SELECT w.timestamp, w.signal, w.value, CASE WHEN b.timestamp IS NOT NULL THEN b.unit ELSE w.unit END AS unit,
       w.resolution, w.fetched_at, w.event_id
FROM w LEFT JOIN base b ON w.timestamp = b.timestamp AND w.signal = b.signal AND w.resolution = b.resolution""",
                                           ["value"]))
def merge_latest_upsert(spark, sf_dir):
    """Keyed upsert of a revised delivery into an existing table;
    ``value`` is updated, ``unit`` keeps the stored value for existing keys."""
    rows = B.raw_signal_rows(spark, sf_dir)
    key = ["timestamp", "signal", "resolution"]
    base = latest_per_key(rows.where(F.col("fetched_at") < F.lit(UPSERT_BASE_BEFORE).cast("timestamp")),
                          key, ["fetched_at", "event_id"])
    delta = (rows.where(F.col("fetched_at") >= F.lit(UPSERT_DELTA_FROM).cast("timestamp"))
                 .withColumn("value", F.col("value") + 1).withColumn("unit", F.lit("MWh")))
    return merge_latest(base, delta, key, ["fetched_at", "event_id"],
                        update_cols=["value", "fetched_at", "event_id"])


@register("route_by_signal", O.rounded(f"""{W_H}
SELECT timestamp, signal, value, resolution, 'generation' AS "table" FROM sig WHERE signal IN ({O.inlist(CAT.generation_load)})
UNION ALL SELECT timestamp, signal, value, resolution, 'prices' FROM sig WHERE signal = {O.q(CAT.home_price)}
UNION ALL SELECT timestamp, signal, value, resolution, 'neighbour_prices' FROM sig WHERE signal IN ({O.inlist(CAT.neighbours)})""",
                                       ["value"]))
def route_by_signal_q(spark, sf_dir):
    """Long rows routed to their tables by the signal catalogue."""
    return routed(B.raw_signals(spark, sf_dir), CAT.table_of()).select(
        "timestamp", "signal", "value", "resolution", "table")


@register("latest_version_per_key", O.rounded(
    f"{W_H} SELECT timestamp, region, signal_name, value, fetched_at FROM ({O.latest('stg_wxf', 'timestamp, region, signal_name', 'fetched_at DESC')})",
    ["value"]))
def latest_version_per_key(spark, sf_dir):
    """Latest fetched forecast version per (timestamp, region, signal)."""
    f = warehouse(spark, sf_dir).stg_weather_forecast
    return latest_per_key(f.select("timestamp", "region", "signal_name", "value", "fetched_at"),
                          ["timestamp", "region", "signal_name"], ["fetched_at"])


# -- D1-D6 pivots, I6-I11 products ------------------------------------------
GEN_COLS = list(CAT.generation_load.values()) + ["total_generation_mw"]
FC_COLS = list(CAT.forecasts.values())
PS_COLS = [f"{CAT.home_price.lower()}_price_eur_mwh"] + [f"{a}_{k}_eur_mwh" for a in CAT.neighbours.values()
                                                          for k in ("price", "spread")]
W_COLS = [n for _, _, n in CAT.weather_columns()]
WF_COLS = [n for _, _, n in CAT.weather_columns("_forecast")]


@register("pivot_generation_load", O.rounded(f"{W_H} {O.pivot_gen_sql()}", GEN_COLS))
def pivot_generation_load(spark, sf_dir):
    """Wide generation + load + total generation."""
    return warehouse(spark, sf_dir).fct_generation_load


@register("pivot_forecast", O.rounded(f"{W_H} {O.pivot_fc_sql()}", FC_COLS))
def pivot_forecast(spark, sf_dir):
    """Wide signal forecasts."""
    return warehouse(spark, sf_dir).fct_generation_load_forecast


@register("pivot_weather_region_var", O.rounded(f"{W_H} {O.pivot_weather_sql('stg_wx')}", W_COLS))
def pivot_weather_region_var(spark, sf_dir):
    """Region x variable pivot of weather actuals."""
    return warehouse(spark, sf_dir).fct_weather


@register("pivot_weather_forecast", O.rounded(f"{W_H} {O.pivot_weather_sql('stg_wxf', '_forecast')}", WF_COLS))
def pivot_weather_forecast(spark, sf_dir):
    """Forecast pivot, max over all fetched versions."""
    return warehouse(spark, sf_dir).fct_weather_forecast


@register("weather_forecast_features", O.rounded(f"""{W_H},
lv AS ({O.latest('stg_wxf', 'timestamp, region, signal_name', 'fetched_at DESC')}),
wp AS ({O.pivot_weather_sql('lv')}),
yrs AS (SELECT DISTINCT year(CAST(timestamp AS DATE)) AS y FROM wp),
{O.holidays_sql('yrs')}
SELECT wp.*, CAST(wp.timestamp AS DATE) AS date_day, {O.calendar_select('CAST(wp.timestamp AS DATE)')}
FROM wp LEFT JOIN holidays h ON CAST(wp.timestamp AS DATE) = h.date""", W_COLS, dates=["date_day"]))
def weather_forecast_features(spark, sf_dir):
    """I10 (E2 D5 C4): latest forecast version pivoted, with calendar."""
    return warehouse(spark, sf_dir).fct_weather_forecast_features


@register("price_spreads", O.rounded(f"{W_H} {O.spreads_sql()}", PS_COLS))
def price_spreads(spark, sf_dir):
    """I8 (C1 D6): home price, neighbour prices and spreads (home - neighbour)."""
    return warehouse(spark, sf_dir).fct_price_spreads


ML_DOUBLES = (["price_eur_mwh"] + [c for c in GEN_COLS if c != "signup_mw"] + FC_COLS + PS_COLS + W_COLS + WF_COLS)


@register("ml_features_wide", O.rounded(f"{W_ML} SELECT * FROM ml", ML_DOUBLES, dates=["date_day"]))
def ml_features_wide(spark, sf_dir):
    """I11 (C2 C3 C4): market price left-joined with all facts and the calendar."""
    return warehouse(spark, sf_dir).fct_ml_features


# -- I5, C5 calendar over the orders date range ------------------------------
def _orders_spine(spark, sf_dir):
    o = B.table(spark, sf_dir, "orders")
    bounds = o.agg(F.min(F.to_date("o_orderdate")).alias("start"), F.max(F.to_date("o_orderdate")).alias("end"))
    return CAL.date_spine(bounds, end_exclusive=False)


ORDERS_SPINE_SQL = ("spine AS (SELECT CAST(d AS DATE) AS date_day FROM (SELECT min(CAST(o_orderdate AS DATE)) lo, "
                    "max(CAST(o_orderdate AS DATE)) hi FROM orders), generate_series(lo, hi, INTERVAL 1 DAY) t(d)),\n"
                    "yrs AS (SELECT DISTINCT year(date_day) AS y FROM spine)")
DIM_SQL = O.rounded(f"""WITH {ORDERS_SPINE_SQL},
{O.holidays_sql('yrs')}
SELECT s.date_day, {O.calendar_select('s.date_day')} FROM spine s LEFT JOIN holidays h ON s.date_day = h.date""",
                    dates=["date_day"])


@register("date_dimension", DIM_SQL)
def date_dimension(spark, sf_dir):
    """I5 (H25 H4-H7 H22): calendar over the orders date range, holidays by rule."""
    return CAL.date_dimension(_orders_spine(spark, sf_dir))


@register("holiday_join", DIM_SQL)
def holiday_join(spark, sf_dir):
    """Same dimension from a holiday *table* (rule-generated per year) by
    broadcast left join + IS NOT NULL flag."""
    spine = _orders_spine(spark, sf_dir)
    hol = CAL.holidays_for_years(spine.select(F.year("date_day").alias("year")).distinct())
    return CAL.holiday_join(spine, hol)


# -- H1-H3, E1 ----------------------------------------------------------------
@register("local_time_columns", O.rounded(f"""{W_H},
p AS (SELECT timestamp, value AS price_eur_mwh, {LOCAL_SQL} AS lt FROM stg_prices)
SELECT timestamp, price_eur_mwh, lt AS local_timestamp, CAST(lt AS DATE) AS local_date, hour(lt) AS hour,
       isodow(CAST(lt AS DATE)) - 1 AS dow, month(lt) AS month, year(lt) AS year,
       CASE WHEN month(lt) IN (12, 1, 2) THEN 'winter' WHEN month(lt) IN (3, 4, 5) THEN 'spring'
            WHEN month(lt) IN (6, 7, 8) THEN 'summer' ELSE 'autumn' END AS season FROM p""",
                                          ["price_eur_mwh"], dates=["local_date"]))
def local_time_columns(spark, sf_dir):
    """H1-H3: market-local wall time and calendar helper columns."""
    return TM.local_time_columns(prices(spark, sf_dir).select("timestamp", "price_eur_mwh"))


@register("delivery_horizon", O.rounded(f"""{W_H}
SELECT timestamp, value AS price_eur_mwh, CAST({LOCAL_SQL} AS DATE) AS delivery_date,
       row_number() OVER (PARTITION BY CAST({LOCAL_SQL} AS DATE) ORDER BY timestamp) AS horizon FROM stg_prices""",
                                        ["price_eur_mwh"], dates=["delivery_date"]))
def delivery_horizon(spark, sf_dir):
    """E1 (H2): product number within the local delivery day."""
    return WN.horizon(prices(spark, sf_dir).select("timestamp", "price_eur_mwh"))


# -- C6, E8, E9, E10/E11 -------------------------------------------------------
PRICE_LAGS = {24: {"price_eur_mwh": "price_lag_24h"}, 48: {"price_eur_mwh": "price_lag_48h"},
              168: {"price_eur_mwh": "price_lag_168h"}}
LAG_SQL = O.rounded(f"""{W_H}
SELECT t.timestamp, t.value AS price_eur_mwh, p1.value AS price_lag_24h, p2.value AS price_lag_48h,
       p7.value AS price_lag_168h
FROM stg_prices t
LEFT JOIN stg_prices p1 ON p1.timestamp = t.timestamp - INTERVAL 24 HOUR
LEFT JOIN stg_prices p2 ON p2.timestamp = t.timestamp - INTERVAL 48 HOUR
LEFT JOIN stg_prices p7 ON p7.timestamp = t.timestamp - INTERVAL 168 HOUR""",
                    ["price_eur_mwh", "price_lag_24h", "price_lag_48h", "price_lag_168h"])


@register("lag_fanout", LAG_SQL)
def lag_fanout_q(spark, sf_dir):
    """Time-offset lags in one exchange (rows dealt to time buckets)."""
    return LG.lag_fanout(prices(spark, sf_dir).select("timestamp", "price_eur_mwh"), PRICE_LAGS)


@register("lag_self_join", LAG_SQL)
def lag_self_join_q(spark, sf_dir):
    """Time-offset lags as one self left join per offset."""
    return LG.lag_self_join(prices(spark, sf_dir).select("timestamp", "price_eur_mwh"), PRICE_LAGS)


@register("lag_range_window", LAG_SQL)
def lag_range_window_q(spark, sf_dir):
    """Exact-offset range frames per series (third physical form)."""
    p = prices(spark, sf_dir).select("timestamp", "resolution", "price_eur_mwh")
    return LG.lag_range_window(p, PRICE_LAGS, partition=["resolution"]).drop("resolution")


@register("same_hour_avg_7d", O.rounded(f"""{W_H}
SELECT t.timestamp, t.value AS price_eur_mwh,
       ({' + '.join(f'p{k}.value' for k in range(1, 8))}) / 7.0 AS price_rolling_avg_7d_same_hour
FROM stg_prices t
{chr(10).join(f'LEFT JOIN stg_prices p{k} ON p{k}.timestamp = t.timestamp - INTERVAL {24 * k} HOUR' for k in range(1, 8))}""",
                                        ["price_eur_mwh", "price_rolling_avg_7d_same_hour"]))
def same_hour_avg_7d(spark, sf_dir):
    """Exact 7-term same-hour mean (null if any of the 7 lags is null)."""
    lags = {24 * k: {"price_eur_mwh": f"_p{k}"} for k in range(1, 8)}
    j = LG.lag_fanout(prices(spark, sf_dir).select("timestamp", "price_eur_mwh"), lags)
    return j.select("timestamp", "price_eur_mwh",
                    LG.same_hour_average([f"_p{k}" for k in range(1, 8)]).alias("price_rolling_avg_7d_same_hour"))


@register("rolling_mean_7d", O.rounded(f"""{W_H}
SELECT timestamp, value AS price_eur_mwh,
       avg(value) OVER (ORDER BY timestamp RANGE BETWEEN INTERVAL '604799999999 microseconds' PRECEDING AND CURRENT ROW)
         AS price_rolling_mean_7d FROM stg_prices""", ["price_eur_mwh", "price_rolling_mean_7d"]))
def rolling_mean_7d(spark, sf_dir):
    """7-day time-range rolling mean, bucketed (week buckets, one halo copy)."""
    p = prices(spark, sf_dir).select("timestamp", "price_eur_mwh")
    return WN.rolling_mean_bucketed(p, "price_eur_mwh", "price_rolling_mean_7d", 7 * 86400)


@register("lag_with_fallback", O.rounded(f"""{W_H}
SELECT t.timestamp, t.value AS price_eur_mwh, coalesce(p1.value, p2.value, p7.value) AS price_lag_fallback,
       coalesce(p1.value, p7.value) AS price_lag_24h_patched
FROM stg_prices t
LEFT JOIN stg_prices p1 ON p1.timestamp = t.timestamp - INTERVAL 24 HOUR
LEFT JOIN stg_prices p2 ON p2.timestamp = t.timestamp - INTERVAL 48 HOUR
LEFT JOIN stg_prices p7 ON p7.timestamp = t.timestamp - INTERVAL 168 HOUR""",
                                         ["price_eur_mwh", "price_lag_fallback", "price_lag_24h_patched"]))
def lag_with_fallback(spark, sf_dir):
    """First non-null of 24/48/168 h lags; patch form lag_24 := coalesce(lag_24, lag_168)."""
    p = prices(spark, sf_dir).select("timestamp", "price_eur_mwh")
    j = LG.lag_fanout(p, {24: {"price_eur_mwh": "_l24"}, 48: {"price_eur_mwh": "_l48"},
                          168: {"price_eur_mwh": "_l168"}})
    return j.select("timestamp", "price_eur_mwh", F.coalesce("_l24", "_l48", "_l168").alias("price_lag_fallback"),
                    F.coalesce("_l24", "_l168").alias("price_lag_24h_patched"))


def _error_cols():
    out = []
    for var in CAT.weather_variables:
        for alias in CAT.weather_regions.values():
            b = f"{var}_{alias}"
            if var in CAT.direction_variables:
                out += [(f"sin(radians(wf.{b}_forecast - w.{b}))", f"{b}_error_sin"),
                        (f"cos(radians(wf.{b}_forecast - w.{b}))", f"{b}_error_cos")]
            else:
                out.append((f"wf.{b}_forecast - w.{b}", f"{b}_error"))
    return out


@register("forecast_error_circular", O.rounded(f"""{W_H},
w AS ({O.pivot_weather_sql('stg_wx')}), wf AS ({O.pivot_weather_sql('stg_wxf', '_forecast')})
SELECT w.timestamp, {', '.join(f'{e} AS {n}' for e, n in _error_cols())}
FROM w JOIN wf ON w.timestamp = wf.timestamp""", [n for _, n in _error_cols()]))
def forecast_error_circular(spark, sf_dir):
    """H12 + H9: forecast - actual per region/variable; wind-direction error as sin/cos."""
    wh = warehouse(spark, sf_dir)
    j = wh.fct_weather.join(wh.fct_weather_forecast, "timestamp")
    cols = [F.col("timestamp")]
    for var in CAT.weather_variables:
        for alias in CAT.weather_regions.values():
            b = f"{var}_{alias}"
            e = F.col(f"{b}_forecast") - F.col(b)
            if var in CAT.direction_variables:
                s, c = TM.direction_sin_cos(e)
                cols += [s.alias(f"{b}_error_sin"), c.alias(f"{b}_error_cos")]
            else:
                cols.append(e.alias(f"{b}_error"))
    return j.select(*cols)


# -- E3, E7, H10/H11, C9/C10 ----------------------------------------------------
from ampere.functions import bins as BN  # noqa: E402
from ampere.operators import analysis as AN  # noqa: E402

SPINE_SQL = (f"{W_H},\nspine AS (SELECT unnest(generate_series(lo, hi, INTERVAL 1 HOUR)) AS timestamp "
             f"FROM (SELECT min(timestamp) lo, max(timestamp) hi FROM stg_prices)),\n"
             f"s AS (SELECT sp.timestamp, p.value FROM spine sp LEFT JOIN stg_prices p ON sp.timestamp = p.timestamp),\n"
             f"ff AS (SELECT timestamp, 'hour' AS resolution, last_value(value IGNORE NULLS) OVER "
             f"(ORDER BY timestamp ROWS BETWEEN 3 PRECEDING AND CURRENT ROW) AS price_eur_mwh FROM s)")


def _price_spine(spark, sf_dir):
    p = prices(spark, sf_dir)
    return WN.on_spine(p, "timestamp", "1 hour", ["resolution"]).select("timestamp", "resolution", "price_eur_mwh")


@register("ffill_limit3", O.rounded(f"{SPINE_SQL} SELECT * FROM ff", ["price_eur_mwh"]))
def ffill_limit3(spark, sf_dir):
    """Bounded forward fill (3 rows) of the price on its hourly grid; window per series."""
    return WN.forward_fill(_price_spine(spark, sf_dir), ["price_eur_mwh"], partition=["resolution"], limit=3)


@register("ffill_limit3_bucketed", O.rounded(f"{SPINE_SQL} SELECT * FROM ff", ["price_eur_mwh"]))
def ffill_limit3_bucketed(spark, sf_dir):
    """E3 as scan-with-carry over day buckets (one long series over many tasks)."""
    return WN.forward_fill_bucketed(_price_spine(spark, sf_dir), ["price_eur_mwh"], partition=["resolution"], limit=3)


@register("drop_incomplete_days", O.rounded(f"""{SPINE_SQL}
SELECT timestamp, resolution, price_eur_mwh FROM (
  SELECT *, min(CASE WHEN price_eur_mwh IS NOT NULL THEN 1 ELSE 0 END)
    OVER (PARTITION BY CAST(((timestamp AT TIME ZONE 'UTC') AT TIME ZONE 'Europe/Berlin') AS DATE)) AS ok FROM ff)
WHERE ok = 1""", ["price_eur_mwh"]))
def drop_incomplete_days(spark, sf_dir):
    """After the bounded fill, drop local days with any null price."""
    f = WN.forward_fill_bucketed(_price_spine(spark, sf_dir), ["price_eur_mwh"], partition=["resolution"], limit=3)
    return WN.complete_days(f, ["price_eur_mwh"])


def _cyc_sql():
    lt = "lt"
    parts = []
    for name, val, per, off in (("hour", f"hour({lt})", 24, 0), ("dow", f"(isodow(CAST({lt} AS DATE)) - 1)", 7, 0),
                                ("month", f"month({lt})", 12, 1), ("hourf", f"(hour({lt}) + minute({lt}) / 60.0)", 24, 0)):
        a = f"2 * pi() * ({val} - {off}) / {per}"
        parts += [f"sin({a}) AS {name}_sin", f"cos({a}) AS {name}_cos"]
    return ", ".join(parts)


CYC_NAMES = [f"{n}_{f}" for n in ("hour", "dow", "month", "hourf") for f in ("sin", "cos")]


@register("cyclic_time_features", O.rounded(f"""WITH {O.staging_ctes('quarterhour')},
p AS (SELECT timestamp, value AS price_eur_mwh, {LOCAL_SQL} AS lt FROM stg_prices)
SELECT timestamp, price_eur_mwh, {_cyc_sql()} FROM p""", ["price_eur_mwh"] + CYC_NAMES))
def cyclic_time_features(spark, sf_dir):
    """sin/cos of local hour/24, dow/7, (month-1)/12 and fractional hour."""
    p = prices(spark, sf_dir, "quarterhour").select("timestamp", "price_eur_mwh")
    lt = TM.to_local("timestamp")
    cols = [F.col("timestamp"), F.col("price_eur_mwh")]
    for name, val, per, off in (("hour", F.hour(lt), 24, 0), ("dow", F.weekday(F.to_date(lt)), 7, 0),
                                ("month", F.month(lt), 12, 1), ("hourf", F.hour(lt) + F.minute(lt) / 60.0, 24, 0)):
        s, c = TM.cyclic(val, per, off)
        cols += [s.alias(f"{name}_sin"), c.alias(f"{name}_cos")]
    return p.select(*cols)


@register("hour_to_quarter_broadcast", O.rounded(f"""WITH {O.staging_ctes('quarterhour')},
hsig AS ({O.latest(f"({O.signal_rows('hour')})", 'timestamp, signal, resolution')}),
hp AS (SELECT timestamp, value FROM hsig WHERE signal = {O.q(CAT.home_price)} AND value IS NOT NULL)
SELECT q.timestamp, q.value AS price_eur_mwh, hp.value AS hourly_price_eur_mwh, q.value - hp.value AS deviation
FROM stg_prices q LEFT JOIN hp ON date_trunc('hour', q.timestamp) = hp.timestamp""",
                                             ["price_eur_mwh", "hourly_price_eur_mwh", "deviation"]))
def hour_to_quarter_broadcast(spark, sf_dir):
    """Hourly value mapped onto its four quarter-hours (join on the
    UTC hour) and the quarter-hour deviation from it (Stage-2 target)."""
    q = prices(spark, sf_dir, "quarterhour")
    h = prices(spark, sf_dir, "hour")
    needed = h.join(q.select(F.date_trunc("HOUR", "timestamp").alias("timestamp")).distinct(), "timestamp", "left_semi")
    j = q.join(needed.select(F.col("timestamp").alias("_h"), F.col("price_eur_mwh").alias("hourly_price_eur_mwh")),
               F.date_trunc("HOUR", q["timestamp"]) == F.col("_h"), "left")
    return j.select("timestamp", "price_eur_mwh", "hourly_price_eur_mwh",
                    (F.col("price_eur_mwh") - F.col("hourly_price_eur_mwh")).alias("deviation"))


# -- D11, E6, D21, D18, regimes on the multi-year orders series -----------------
DAILY_SQL = ("daily AS (SELECT CAST(o_orderdate AS TIMESTAMP) AS timestamp, sum(o_totalprice) AS value, "
             "count(*) AS n_orders FROM orders GROUP BY 1)")
PERIOD_SQL = {"day": "CAST(date_trunc('day', timestamp) AS DATE)",
              "week": "CAST(date_trunc('week', timestamp) AS DATE) + 6",
              "month": "CAST(date_trunc('month', timestamp) AS DATE)",
              "year": "CAST(date_trunc('year', timestamp) AS DATE)"}


def _resample(unit):
    sql = O.rounded(f"WITH {DAILY_SQL} SELECT {PERIOD_SQL[unit]} AS period, avg(value) AS value, "
                    f"avg(n_orders) AS n_orders FROM daily GROUP BY 1", ["value", "n_orders"], dates=["period"])

    @register(f"resample_{unit}", sql)
    def q(spark, sf_dir, _u=unit):
        return AN.resample_mean(B.daily_orders(spark, sf_dir), "timestamp", ["value", "n_orders"], _u)
    q.__doc__ = f"D11: mean per {unit} bin (week: Mon-Sun labelled Sunday)."
    return q


for _u in AN.RESAMPLE_UNITS:
    _resample(_u)


@register("annual_yoy_change", O.rounded(f"""WITH {DAILY_SQL},
y AS (SELECT year(timestamp) AS year, avg(value) AS value FROM daily GROUP BY 1)
SELECT year, value, value - lag(value) OVER (ORDER BY year) AS yoy_change FROM y""", ["value", "yoy_change"]))
def annual_yoy_change(spark, sf_dir):
    """Yearly mean and change from the previous year (window over the year table)."""
    y = B.daily_orders(spark, sf_dir).groupBy(F.year("timestamp").alias("year")).agg(F.avg("value").alias("value"))
    return AN.year_over_year(y, "year", "value")


@register("volatility_cv_by_month", O.rounded(f"""WITH {DAILY_SQL}
SELECT CAST(date_trunc('month', timestamp) AS DATE) AS month, stddev_samp(value) AS std, avg(value) AS mean,
       stddev_samp(value) / avg(value) AS cv FROM daily GROUP BY 1""", ["std", "mean", "cv"], dates=["month"]))
def volatility_cv_by_month(spark, sf_dir):
    """Sample standard deviation and coefficient of variation per month."""
    d = B.daily_orders(spark, sf_dir)
    return d.groupBy(F.to_date(F.date_trunc("MONTH", "timestamp")).alias("month")).agg(
        F.stddev_samp("value").alias("std"), F.avg("value").alias("mean"),
        (F.stddev_samp("value") / F.avg("value")).alias("cv"))


@register("weekday_weekend_gap", O.rounded(f"""WITH {DAILY_SQL}
SELECT year(timestamp) AS year,
       avg(value) FILTER (WHERE isodow(timestamp) - 1 < 5) - avg(value) FILTER (WHERE isodow(timestamp) - 1 = 6) AS gap
FROM daily GROUP BY 1""", ["gap"]))
def weekday_weekend_gap(spark, sf_dir):
    """Mean on weekdays minus mean on Sundays, per year."""
    d = B.daily_orders(spark, sf_dir)
    dow = F.weekday("timestamp")
    return AN.conditional_gap(d, [F.year("timestamp").alias("year")], "value", dow < 5, dow == 6)


REGIME_BREAKS = ("1997-01-01", "2000-01-01")
REGIME_SQL = (f"CASE WHEN timestamp < TIMESTAMP '{REGIME_BREAKS[0]}' THEN 'early' "
              f"WHEN timestamp < TIMESTAMP '{REGIME_BREAKS[1]}' THEN 'middle' ELSE 'late' END")


def regime(ts="timestamp"):
    """Regime label from two break points."""
    t = F.col(ts)
    return (F.when(t < F.lit(REGIME_BREAKS[0]).cast("timestamp"), "early")
             .when(t < F.lit(REGIME_BREAKS[1]).cast("timestamp"), "middle").otherwise("late"))


PCTS = (0.05, 0.25, 0.5, 0.75, 0.95)
DESC_COLS = ["mean", "std", "min", "max"] + [f"p{int(q * 100):02d}" for q in PCTS]


def _describe_sql(value, key_expr, key_name, src):
    ps = ", ".join(f"quantile_cont({value}, {q}) AS p{int(q * 100):02d}" for q in PCTS)
    return (f"SELECT {key_expr} AS {key_name}, count({value}) AS count, avg({value}) AS mean, "
            f"stddev_samp({value}) AS std, min({value}) AS min, {ps}, max({value}) AS max FROM {src} GROUP BY 1")


@register("regime_describe", O.rounded(f"WITH {DAILY_SQL} {_describe_sql('value', REGIME_SQL, 'regime', 'daily')}",
                                       DESC_COLS))
def regime_describe(spark, sf_dir):
    """H24 + D22: describe (count, mean, std, min, percentiles, max) per regime."""
    d = B.daily_orders(spark, sf_dir).withColumn("regime", regime())
    return AN.describe(d, ["regime"], "value", PCTS)


@register("regime_mode_per_year", """SELECT year, mode, mode_count FROM (
  SELECT year, o_orderpriority AS mode, n AS mode_count,
         row_number() OVER (PARTITION BY year ORDER BY n DESC, o_orderpriority) AS rn
  FROM (SELECT year(o_orderdate) AS year, o_orderpriority, count(*) AS n FROM orders GROUP BY 1, 2)) WHERE rn = 1""")
def regime_mode_per_year(spark, sf_dir):
    """Most frequent category per year (ties: smallest), two aggregates."""
    o = B.table(spark, sf_dir, "orders").select(F.year("o_orderdate").alias("year"), "o_orderpriority")
    return AN.mode_per_group(o, ["year"], "o_orderpriority")


# -- D9, D10, D26, D27 on the hourly price ----------------------------------------
LOCAL_DAY_SQL = f"CAST({LOCAL_SQL} AS DATE)"


def _local_prices(spark, sf_dir):
    return TM.local_time_columns(prices(spark, sf_dir).select("timestamp", "price_eur_mwh"))


@register("heatmap_dow_hour", O.rounded(f"""{W_H}
SELECT isodow({LOCAL_DAY_SQL}) - 1 AS dow,
       {', '.join(f'avg(value) FILTER (WHERE hour({LOCAL_SQL}) = {h}) AS h{h:02d}' for h in range(24))}
FROM stg_prices GROUP BY 1""", [f"h{h:02d}" for h in range(24)]))
def heatmap_dow_hour(spark, sf_dir):
    """Mean price by local day-of-week x hour, unstacked."""
    return AN.heatmap(_local_prices(spark, sf_dir), "dow", "hour", "price_eur_mwh", range(24), "avg", "h")\
        .select("dow", *[F.col(f"h{h}").alias(f"h{h:02d}") for h in range(24)])


@register("season_hour_median", O.rounded(f"""{W_H}
SELECT CASE WHEN month({LOCAL_SQL}) IN (12, 1, 2) THEN 'winter' WHEN month({LOCAL_SQL}) IN (3, 4, 5) THEN 'spring'
            WHEN month({LOCAL_SQL}) IN (6, 7, 8) THEN 'summer' ELSE 'autumn' END AS season,
       {', '.join(f'quantile_cont(value, 0.5) FILTER (WHERE hour({LOCAL_SQL}) = {h}) AS h{h:02d}' for h in range(24))}
FROM stg_prices GROUP BY 1""", [f"h{h:02d}" for h in range(24)]))
def season_hour_median(spark, sf_dir):
    """Median price by season x local hour, unstacked."""
    return AN.heatmap(_local_prices(spark, sf_dir), "season", "hour", "price_eur_mwh", range(24), "median", "h")\
        .select("season", *[F.col(f"h{h}").alias(f"h{h:02d}") for h in range(24)])


@register("negative_share_by_period", O.rounded(f"""{W_H}
SELECT {LOCAL_DAY_SQL} AS local_date, avg(CASE WHEN value < 0 THEN 1.0 ELSE 0.0 END) * 100 AS pct_negative,
       avg(CASE WHEN value > 0 THEN 1.0 ELSE 0.0 END) * 100 AS pct_positive FROM stg_prices GROUP BY 1""",
                                                ["pct_negative", "pct_positive"], dates=["local_date"]))
def negative_share_by_period(spark, sf_dir):
    """Share of negative / positive prices per local day (in %)."""
    p = _local_prices(spark, sf_dir)
    return AN.share_where(p, ["local_date"], {"pct_negative": F.col("price_eur_mwh") < 0,
                                              "pct_positive": F.col("price_eur_mwh") > 0})


THRESHOLDS = (200.0, 300.0, 400.0, 500.0)


@register("threshold_exceedance", O.rounded(f"""{W_H}
SELECT t.threshold, count(*) FILTER (WHERE p.value > t.threshold) AS hours,
       count(*) FILTER (WHERE p.value > t.threshold) * 100.0 / count(p.value) AS pct
FROM stg_prices p, (VALUES {', '.join(f'({t})' for t in THRESHOLDS)}) t(threshold) GROUP BY 1""",
                                            ["threshold", "pct"]))
def threshold_exceedance(spark, sf_dir):
    """Hours above each price threshold, count and %, one pass."""
    return AN.threshold_table(prices(spark, sf_dir), "price_eur_mwh", THRESHOLDS)


# -- D13/D15, D14, D16/D17, D19, D20, D25 ------------------------------------------
REN = ["click_mw", "view_mw"]
GEN_NO_STORAGE = ["click_mw", "view_mw", "signup_mw"]


def _rowsum_sql(cols, alias="g"):
    return " + ".join(f"coalesce({alias}.{c}, 0)" for c in cols)


@register("renewable_share_weighted", O.rounded(f"""{W_H}, g AS ({O.pivot_gen_sql()})
SELECT CAST(((g.timestamp AT TIME ZONE 'UTC') AT TIME ZONE 'Europe/Berlin') AS DATE) AS local_date,
       sum({_rowsum_sql(REN)}) / sum({_rowsum_sql(GEN_NO_STORAGE)}) AS renewable_share,
       avg({_rowsum_sql(REN)}) AS renewable_mean_mw, avg({_rowsum_sql(['signup_mw'])}) AS fossil_mean_mw
FROM g GROUP BY 1""", ["renewable_share", "renewable_mean_mw", "fossil_mean_mw"], dates=["local_date"]))
def renewable_share_weighted(spark, sf_dir):
    """D13 + D15: energy-weighted renewable share (ratio of sums) and group means per local day."""
    g = warehouse(spark, sf_dir).fct_generation_load.withColumn("local_date", TM.delivery_date("timestamp"))

    def rs(cols):
        e = F.lit(0.0)
        for c in cols:
            e = e + F.coalesce(F.col(c), F.lit(0.0))
        return e
    return g.groupBy("local_date").agg(F.try_divide(F.sum(rs(REN)), F.sum(rs(GEN_NO_STORAGE))).alias("renewable_share"),
                                       F.avg(rs(REN)).alias("renewable_mean_mw"),
                                       F.avg(rs(["signup_mw"])).alias("fossil_mean_mw"))


GEN_SOURCES = list(CAT.generation.values())


@register("net_export_proxy", O.rounded(f"""{W_H}, g AS ({O.pivot_gen_sql()}),
m AS (SELECT date_trunc('month', timestamp) AS mo, {' + '.join(f'coalesce(avg({c}), 0)' for c in GEN_SOURCES)} AS total
      FROM g GROUP BY 1),
a AS (SELECT year(mo) AS year, avg(total) AS mean_generation_mw FROM m GROUP BY 1),
l AS (SELECT year(timestamp) AS year, avg(error_mw) AS mean_load_mw FROM g GROUP BY 1)
SELECT a.year, mean_generation_mw, mean_load_mw, mean_generation_mw - mean_load_mw AS net_export_proxy_mw
FROM a JOIN l ON a.year = l.year""", ["mean_generation_mw", "mean_load_mw", "net_export_proxy_mw"]))
def net_export_proxy(spark, sf_dir):
    """Per year the mean over months of the summed monthly means of all
    sources, minus the mean load. Load sums and counts travel through the monthly
    aggregate, so the rows are read once."""
    g = warehouse(spark, sf_dir).fct_generation_load
    total = sum((F.coalesce(F.avg(c), F.lit(0.0)) for c in GEN_SOURCES[1:]), F.coalesce(F.avg(GEN_SOURCES[0]), F.lit(0.0)))
    m = g.groupBy(F.date_trunc("MONTH", "timestamp").alias("mo")).agg(
        total.alias("total"), F.sum("error_mw").alias("load"), F.count("error_mw").alias("n"))
    y = m.groupBy(F.year("mo").alias("year")).agg(
        F.avg("total").alias("mean_generation_mw"), F.try_divide(F.sum("load"), F.sum("n")).alias("mean_load_mw"))
    return y.withColumn("net_export_proxy_mw", F.col("mean_generation_mw") - F.col("mean_load_mw"))


MID_SQL = ("mid AS (SELECT min(timestamp) + (max(timestamp) - min(timestamp)) / 2 AS m FROM stg_gen)")


def _halves(spark, sf_dir):
    s = warehouse(spark, sf_dir).stg_generation_load
    mid = s.agg(F.min("timestamp") + (F.max("timestamp") - F.min("timestamp")) / 2).scalar()
    return s.withColumn("period", F.when(F.col("timestamp") < mid, "A").otherwise("B"))


@register("two_period_mix_change", O.rounded(f"""{W_H}, {MID_SQL}
SELECT signal_name, avg(value) FILTER (WHERE timestamp < m) AS mean_a, avg(value) FILTER (WHERE timestamp >= m) AS mean_b,
       avg(value) FILTER (WHERE timestamp >= m) - avg(value) FILTER (WHERE timestamp < m) AS change
FROM stg_gen, mid GROUP BY 1""", ["mean_a", "mean_b", "change"]))
def two_period_mix_change(spark, sf_dir):
    """Mean per source in the first and second half of the range, and the change."""
    return AN.period_comparison(_halves(spark, sf_dir), "signal_name", "value", F.col("period"), "A", "B")


@register("hourly_mix_change", O.rounded(f"""{W_H}, {MID_SQL}
SELECT signal_name, hour({LOCAL_SQL}) AS hour, avg(value) FILTER (WHERE timestamp < m) AS mean_a,
       avg(value) FILTER (WHERE timestamp >= m) AS mean_b,
       avg(value) FILTER (WHERE timestamp >= m) - avg(value) FILTER (WHERE timestamp < m) AS change
FROM stg_gen, mid GROUP BY 1, 2""", ["mean_a", "mean_b", "change"]))
def hourly_mix_change(spark, sf_dir):
    """The same comparison per local hour of day."""
    h = _halves(spark, sf_dir).withColumn("hour", F.hour(TM.to_local("timestamp")))
    return AN.period_comparison(h, "signal_name", "value", F.col("period"), "A", "B", extra_keys=["hour"])


TEMP = "temperature_2m_brandenburg"
BIN_LO, BIN_HI, BIN_W = 0.0, 600.0, 25.0


@register("temperature_response_bins", O.rounded(f"""{W_H}, g AS ({O.pivot_gen_sql()}), w AS ({O.pivot_weather_sql('stg_wx')}),
j AS (SELECT w.{TEMP} AS x, g.error_mw AS y FROM w JOIN g ON w.timestamp = g.timestamp
      WHERE w.{TEMP} > {BIN_LO} AND w.{TEMP} <= {BIN_HI}),
b AS (SELECT CAST(ceil((x - {BIN_LO}) / {BIN_W}) - 1 AS BIGINT) AS bin, y FROM j)
SELECT bin, {BIN_LO} + bin * {BIN_W} AS bin_left, {BIN_LO} + (bin + 1) * {BIN_W} AS bin_right,
       avg(y) AS mean_load_mw, count(y) AS n FROM b GROUP BY bin""", ["bin_left", "bin_right", "mean_load_mw"]))
def temperature_response_bins(spark, sf_dir):
    """D19 + H18: mean load per right-closed temperature bin (explicit edges)."""
    wh = warehouse(spark, sf_dir)
    j = wh.fct_weather.select("timestamp", F.col(TEMP).alias("x")).join(
        wh.fct_generation_load.select("timestamp", F.col("error_mw").alias("y")), "timestamp")
    idx, left, right = BN.fixed_bins("x", BIN_LO, BIN_HI, BIN_W)
    b = j.select(idx.alias("bin"), "y").where(F.col("bin").isNotNull())
    return b.groupBy("bin").agg((F.lit(BIN_LO) + F.col("bin") * BIN_W).alias("bin_left"),
                                (F.lit(BIN_LO) + (F.col("bin") + 1) * BIN_W).alias("bin_right"),
                                F.avg("y").alias("mean_load_mw"), F.count("y").alias("n"))


@register("supply_curve_bins", O.rounded(f"""{W_ML},
s AS (SELECT total_generation_mw AS x, price_eur_mwh AS y FROM ml WHERE total_generation_mw IS NOT NULL),
mm AS (SELECT min(x) lo, max(x) hi FROM s),
b AS (SELECT LEAST(GREATEST(CAST(ceil((x - lo) / ((hi - lo) / 30.0)) AS BIGINT) - 1, 0), 29) AS bin, y, lo, hi FROM s, mm)
SELECT bin, quantile_cont(y, 0.5) AS median_price, count(*) AS n,
       CASE WHEN bin = 0 THEN any_value(lo) - (any_value(hi) - any_value(lo)) * 0.001
            ELSE any_value(lo) + bin * (any_value(hi) - any_value(lo)) / 30.0 END AS bin_left,
       any_value(lo) + (bin + 1) * (any_value(hi) - any_value(lo)) / 30.0 AS bin_right
FROM b GROUP BY bin""", ["median_price", "bin_left", "bin_right"]))
def supply_curve_bins(spark, sf_dir):
    """D20 + H19: median price per equal-width bin (30) of total generation."""
    ml = warehouse(spark, sf_dir).fct_ml_features.select("total_generation_mw", "price_eur_mwh")
    s = ml.where(F.col("total_generation_mw").isNotNull())
    b = BN.equal_width_bins(s, "total_generation_mw", 30)
    bins = b.groupBy("bin").agg(F.count(F.lit(1)).alias("n"), F.first("bin_left").alias("bin_left"),
                                F.first("bin_right").alias("bin_right"))
    return QT.joined_on(bins, QT.exact_quantiles(b, ["bin"], "price_eur_mwh", {"median_price": 0.5}), ["bin"])


HEAT_BELOW, COOL_ABOVE = 150.0, 300.0


@register("elasticity_slopes", O.rounded(f"""{W_ML}
SELECT regr_slope(CASE WHEN {TEMP} < {HEAT_BELOW} THEN price_eur_mwh END, CASE WHEN {TEMP} < {HEAT_BELOW} THEN {TEMP} END) AS heating_slope,
       CAST(regr_count(CASE WHEN {TEMP} < {HEAT_BELOW} THEN price_eur_mwh END, CASE WHEN {TEMP} < {HEAT_BELOW} THEN {TEMP} END) AS BIGINT) AS heating_n,
       regr_slope(CASE WHEN {TEMP} > {COOL_ABOVE} THEN price_eur_mwh END, CASE WHEN {TEMP} > {COOL_ABOVE} THEN {TEMP} END) AS cooling_slope,
       CAST(regr_count(CASE WHEN {TEMP} > {COOL_ABOVE} THEN price_eur_mwh END, CASE WHEN {TEMP} > {COOL_ABOVE} THEN {TEMP} END) AS BIGINT) AS cooling_n
FROM ml""", ["heating_slope", "cooling_slope"]))
def elasticity_slopes(spark, sf_dir):
    """Slope of price on temperature below / above comfort thresholds, one pass."""
    ml = warehouse(spark, sf_dir).fct_ml_features
    x, y = F.col(TEMP), F.col("price_eur_mwh")
    heat, cool = x < HEAT_BELOW, x > COOL_ABOVE
    return ml.agg(F.regr_slope(F.when(heat, y), F.when(heat, x)).alias("heating_slope"),
                  F.regr_count(F.when(heat, y), F.when(heat, x)).alias("heating_n"),
                  F.regr_slope(F.when(cool, y), F.when(cool, x)).alias("cooling_slope"),
                  F.regr_count(F.when(cool, y), F.when(cool, x)).alias("cooling_n"))


# -- spreads: D22/D35, D38, D24, E5 ---------------------------------------------
from ampere.operators import metrics as MT  # noqa: E402
from ampere.operators import quality as QL  # noqa: E402
from ampere.operators import splits as SP  # noqa: E402

SPREAD_SQL = ("sp AS (SELECT np.timestamp, np.signal_name AS neighbour, np.value AS neighbour_price, "
              "p.value AS home_price, p.value - np.value AS spread FROM stg_nb np JOIN stg_prices p "
              "ON np.timestamp = p.timestamp AND np.resolution = p.resolution)")


def _spreads_long(spark, sf_dir):
    wh = warehouse(spark, sf_dir)
    n = wh.stg_neighbour_prices.select("timestamp", "resolution", F.col("signal_name").alias("neighbour"),
                                       F.col("value").alias("neighbour_price"))
    p = wh.stg_prices.select("timestamp", "resolution", F.col("value").alias("home_price"))
    return (n.join(p, ["timestamp", "resolution"])
             .withColumn("spread", F.col("home_price") - F.col("neighbour_price")).drop("resolution"))


@register("spread_stats", O.rounded(f"""{W_H}, {SPREAD_SQL}
SELECT neighbour, count(spread) AS count, avg(spread) AS mean, stddev_samp(spread) AS std, min(spread) AS min,
       {', '.join(f'quantile_cont(spread, {q}) AS p{int(q * 100):02d}' for q in PCTS)}, max(spread) AS max,
       avg(abs(spread)) AS mean_abs_spread FROM sp GROUP BY 1""", DESC_COLS + ["mean_abs_spread"]))
def spread_stats(spark, sf_dir):
    """D22 + D35: spread distribution per neighbour and mean absolute spread, in one aggregate."""
    return AN.describe(_spreads_long(spark, sf_dir), ["neighbour"], "spread", PCTS,
                       extra=[F.avg(F.abs("spread")).alias("mean_abs_spread")])


@register("feature_selection_summary", O.rounded(f"""{W_H}, {SPREAD_SQL}
SELECT s.neighbour, corr(s.neighbour_price, s.home_price) AS level_corr, corr(s.spread, s2.home_price) AS lead1_corr,
       avg(s.spread) AS mean_spread, stddev_samp(s.spread) AS std_spread,
       avg(CASE WHEN s.spread > 0 THEN 1.0 ELSE 0.0 END) * 100 AS pct_positive
FROM sp s LEFT JOIN sp s2 ON s2.neighbour = s.neighbour AND s2.timestamp = s.timestamp + INTERVAL 1 HOUR
GROUP BY 1""", ["level_corr", "lead1_corr", "mean_spread", "std_spread", "pct_positive"]))
def feature_selection_summary(spark, sf_dir):
    """Per neighbour level correlation, correlation with the next hour's
    home price (time-based lead via fan-out), mean, std, % positive."""
    s = _spreads_long(spark, sf_dir)
    j = LG.lag_fanout(s, {-1: {"home_price": "_next_home"}}, partition=["neighbour"])
    return j.groupBy("neighbour").agg(
        F.corr("neighbour_price", "home_price").alias("level_corr"), F.corr("spread", "_next_home").alias("lead1_corr"),
        F.avg("spread").alias("mean_spread"), F.stddev_samp("spread").alias("std_spread"),
        (F.avg((F.col("spread") > 0).cast("double")) * 100).alias("pct_positive"))


ZONES = PS_COLS[0:1] + [c for c in PS_COLS if c.endswith("_price_eur_mwh") and c != PS_COLS[0]]


def _corr_sql():
    parts = []
    for i, a in enumerate(ZONES):
        for b in ZONES[i:]:
            parts.append(f"SELECT {O.q(a)} AS a, {O.q(b)} AS b, corr({a}, {b}) AS corr FROM ps")
            if a != b:
                parts.append(f"SELECT {O.q(b)} AS a, {O.q(a)} AS b, corr({a}, {b}) AS corr FROM ps")
    return " UNION ALL ".join(parts)


@register("zone_correlation_matrix", O.rounded(f"{W_H}, ps AS ({O.spreads_sql()}) {_corr_sql()}", ["corr"]))
def zone_correlation_matrix(spark, sf_dir):
    """Pairwise price correlations of all zones, long form, one pass."""
    return AN.pairwise_corr(warehouse(spark, sf_dir).fct_price_spreads, ZONES)


@register("lead1_spread_correlation", O.rounded(f"""{W_H}, {SPREAD_SQL}
SELECT neighbour, corr(spread, nxt) AS lead1_corr FROM (
  SELECT neighbour, spread, lead(home_price) OVER (PARTITION BY neighbour ORDER BY timestamp) AS nxt FROM sp) GROUP BY 1""",
                                                ["lead1_corr"]))
def lead1_spread_correlation(spark, sf_dir):
    """E5 + D23: correlation of each spread with the next row's home price (row lead per series)."""
    return AN.lead_correlation(_spreads_long(spark, sf_dir), "spread", "home_price", partition=["neighbour"])


# -- coverage, profile, top-k (G3 D29 L6 L8 F2 F3) -------------------------------
@register("coverage_histogram", f"""{W_H}
SELECT signal, rows, count(*) AS groups FROM (
  SELECT signal, CAST(timestamp AS DATE) AS day, count(*) AS rows FROM sig GROUP BY 1, 2) GROUP BY 1, 2""")
def coverage_histogram(spark, sf_dir):
    """Rows per (signal, day) and how many days have each count."""
    s = B.raw_signals(spark, sf_dir)
    c = s.groupBy("signal", F.to_date("timestamp").alias("day")).agg(F.count(F.lit(1)).alias("rows"))
    return c.groupBy("signal", "rows").agg(F.count(F.lit(1)).alias("groups"))


@register("missing_days", f"""{W_H},
d AS (SELECT DISTINCT signal, CAST(timestamp AS DATE) AS day FROM sig),
b AS (SELECT signal, min(day) lo, max(day) hi FROM d GROUP BY 1),
spine AS (SELECT signal, CAST(unnest(generate_series(lo, hi, INTERVAL 1 DAY)) AS DATE) AS day FROM b)
SELECT CAST(s.day AS TIMESTAMP) AS day, s.signal FROM spine s ANTI JOIN d ON s.signal = d.signal AND s.day = d.day""")
def missing_days(spark, sf_dir):
    """Calendar days inside each signal's range without any row."""
    return QL.missing_days(B.raw_signals(spark, sf_dir), "timestamp", ["signal"])


@register("missing_hours", f"""{W_H},
b AS (SELECT signal, min(timestamp) lo, max(timestamp) hi FROM sig GROUP BY 1),
spine AS (SELECT signal, unnest(generate_series(lo, hi, INTERVAL 1 HOUR)) AS timestamp FROM b)
SELECT s.signal, s.timestamp FROM spine s ANTI JOIN sig ON s.signal = sig.signal AND s.timestamp = sig.timestamp""")
def missing_hours(spark, sf_dir):
    """Expected-vs-actual hourly coverage: hours absent per signal (grid minus rows)."""
    s = B.raw_signals(spark, sf_dir).select("signal", "timestamp")
    grid = WN.time_spine(s, "timestamp", "1 hour", ["signal"])
    return grid.join(s, ["signal", "timestamp"], "left_anti")


@register("signal_profile_zero_neg_null", f"""{W_H}
SELECT signal, count(*) AS rows, count(*) FILTER (WHERE value IS NULL) AS nulls,
       count(*) FILTER (WHERE value = 0) AS zeros, count(*) FILTER (WHERE value < 0) AS negatives,
       count(*) FILTER (WHERE value > 0 AND value < 100) AS low_positive FROM sig GROUP BY 1""")
def signal_profile_zero_neg_null(spark, sf_dir):
    """L8 (B14 D30): rows, nulls, zeros, negatives, (0,100) values per signal."""
    return QL.profile(B.raw_signals(spark, sf_dir), ["signal"], "value")


@register("topk_price_hours", O.rounded(f"""{W_H}
SELECT timestamp, value AS price_eur_mwh FROM stg_prices ORDER BY value DESC, timestamp LIMIT 10""", ["price_eur_mwh"]))
def topk_price_hours(spark, sf_dir):
    """the ten most expensive hours (top-k is the feature)."""
    p = prices(spark, sf_dir).select("timestamp", "price_eur_mwh")
    return AN.top_k(p, [F.col("price_eur_mwh").desc(), F.col("timestamp")], 10)


@register("signal_value_counts", """SELECT upper(event_type) AS signal, count(*) AS count FROM events GROUP BY 1""")
def signal_value_counts(spark, sf_dir):
    """landed rows per signal (revisions included), frequency table."""
    return AN.value_counts(B.raw_signal_rows(spark, sf_dir), "signal")


# -- data quality L1-L5 -----------------------------------------------------------
@register("dq_unique_combination", f"""WITH sig_rows AS ({O.signal_rows('hour')}),
sig AS ({O.latest('sig_rows', 'timestamp, signal, resolution')}),
r AS (SELECT count(*) AS k, coalesce(sum(n - 1), 0) AS extra FROM (SELECT count(*) n FROM sig_rows GROUP BY timestamp, signal, resolution HAVING count(*) > 1)),
s AS (SELECT count(*) AS k, coalesce(sum(n - 1), 0) AS extra FROM (SELECT count(*) n FROM sig GROUP BY timestamp, signal, resolution HAVING count(*) > 1))
SELECT 'unique_combination' AS "check", 'raw_rows' AS "table", 'timestamp,signal,resolution' AS key, k AS n_violations FROM r
UNION ALL SELECT 'duplicate_rows', 'raw_rows', 'timestamp,signal,resolution', CAST(extra AS BIGINT) FROM r
UNION ALL SELECT 'unique_combination', 'raw_signals', 'timestamp,signal,resolution', k FROM s
UNION ALL SELECT 'duplicate_rows', 'raw_signals', 'timestamp,signal,resolution', CAST(extra AS BIGINT) FROM s""")
def dq_unique_combination(spark, sf_dir):
    """Key uniqueness of landed rows (revisions) and of the upserted table."""
    key = ["timestamp", "signal", "resolution"]
    return QL.unique_combination(B.raw_signal_rows(spark, sf_dir), "raw_rows", key).unionByName(
        QL.unique_combination(B.raw_signals(spark, sf_dir), "raw_signals", key))


@register("dq_not_null_accepted", f"""{W_H}
SELECT 'not_null' AS "check", 'stg_generation_load' AS "table", 'timestamp' AS key, count(*) FILTER (WHERE timestamp IS NULL) AS n_violations FROM stg_gen UNION ALL SELECT 'not_null' AS "check", 'stg_generation_load' AS "table", 'signal_name' AS key, count(*) FILTER (WHERE signal_name IS NULL) AS n_violations FROM stg_gen UNION ALL SELECT 'not_null' AS "check", 'stg_generation_load' AS "table", 'value' AS key, count(*) FILTER (WHERE value IS NULL) AS n_violations FROM stg_gen UNION ALL SELECT 'not_null' AS "check", 'stg_generation_load' AS "table", 'resolution' AS key, count(*) FILTER (WHERE resolution IS NULL) AS n_violations FROM stg_gen
UNION ALL SELECT 'accepted_values', 'stg_generation_load', 'resolution',
  count(*) FILTER (WHERE resolution IS NOT NULL AND resolution NOT IN ('hour', 'quarterhour')) FROM stg_gen
UNION ALL SELECT 'accepted_values', 'stg_generation_load', 'signal_name',
  count(*) FILTER (WHERE signal_name IS NOT NULL AND signal_name NOT IN ({O.inlist(CAT.generation_load)})) FROM stg_gen
UNION ALL SELECT 'accepted_values', 'stg_generation_load', 'unit',
  count(*) FILTER (WHERE unit IS NOT NULL AND unit NOT IN ('MW')) FROM stg_gen""")
def dq_not_null_accepted(spark, sf_dir):
    """L2 + L4 fused in one pass over the staging view."""
    s = warehouse(spark, sf_dir).stg_generation_load
    return QL.not_null_and_accepted(s, "stg_generation_load", ["timestamp", "signal_name", "value", "resolution"],
                                    {"resolution": ["hour", "quarterhour"], "signal_name": list(CAT.generation_load),
                                     "unit": ["MW"]})


@register("dq_facts_in_dim", f"""{W_H},
dim AS (SELECT CAST(unnest(generate_series(lo, hi, INTERVAL 1 DAY)) AS DATE) AS date_day
        FROM (SELECT min(CAST(timestamp AS DATE)) lo, max(CAST(timestamp AS DATE)) hi FROM stg_prices)),
g AS ({O.pivot_gen_sql()}), gf AS ({O.pivot_fc_sql()}), w AS ({O.pivot_weather_sql('stg_wx')}),
wf AS ({O.pivot_weather_sql('stg_wxf', '_forecast')}),
f AS (SELECT 'fct_generation_load' AS t, CAST(timestamp AS DATE) AS d FROM g
      UNION ALL SELECT 'fct_generation_load_forecast', CAST(timestamp AS DATE) FROM gf
      UNION ALL SELECT 'fct_weather', CAST(timestamp AS DATE) FROM w
      UNION ALL SELECT 'fct_weather_forecast', CAST(timestamp AS DATE) FROM wf),
bad AS (SELECT t, d FROM f ANTI JOIN dim ON f.d = dim.date_day),
tabs AS (SELECT * FROM (VALUES ('fct_generation_load'), ('fct_generation_load_forecast'), ('fct_weather'),
                               ('fct_weather_forecast')) v(t))
SELECT 'relationships' AS "check", tabs.t AS "table", 'date_day' AS key, count(bad.d) AS n_violations
FROM tabs LEFT JOIN bad ON tabs.t = bad.t GROUP BY tabs.t""")
def dq_facts_in_dim(spark, sf_dir):
    """L5 (C8 G1): fact days missing from the date dimension, per fact table (null-safe anti join, union)."""
    wh = warehouse(spark, sf_dir)
    dim = wh.dim_date
    out = None
    for name in ("fct_generation_load", "fct_generation_load_forecast", "fct_weather", "fct_weather_forecast"):
        r = QL.missing_in_dimension(wh.product(name), name, F.to_date("timestamp"), dim)
        out = r if out is None else out.unionByName(r)
    return out


# -- D37 daily summary, G5 splice ----------------------------------------------------
GEN_MIX = [c for c in CAT.generation.values()]


@register("daily_energy_summary", O.rounded(f"""{W_H}, g AS ({O.pivot_gen_sql()}),
gd AS (SELECT CAST(timestamp AS DATE) AS target_date, {', '.join(f'avg({c}) AS {c}' for c in GEN_MIX)},
       sum({_rowsum_sql(REN, 'g')}) * 100.0 / nullif(sum({_rowsum_sql(GEN_NO_STORAGE, 'g')}), 0) AS renewable_share
       FROM g GROUP BY 1),
pd AS (SELECT CAST(timestamp AS DATE) AS target_date, avg(value) AS avg_price FROM stg_prices GROUP BY 1)
SELECT gd.*, pd.avg_price FROM gd LEFT JOIN pd ON gd.target_date = pd.target_date""",
                                            GEN_MIX + ["renewable_share", "avg_price"], dates=["target_date"]))
def daily_energy_summary(spark, sf_dir):
    """Per day generation mix (mean per source), mean price, renewable share (%)."""
    wh = warehouse(spark, sf_dir)
    g = wh.fct_generation_load

    def rs(cols):
        e = F.lit(0.0)
        for c in cols:
            e = e + F.coalesce(F.col(c), F.lit(0.0))
        return e
    gd = g.groupBy(F.to_date("timestamp").alias("target_date")).agg(
        *[F.avg(c).alias(c) for c in GEN_MIX],
        F.try_divide(F.sum(rs(REN)) * 100.0, F.sum(rs(GEN_NO_STORAGE))).alias("renewable_share"))
    pd_ = wh.stg_prices.groupBy(F.to_date("timestamp").alias("target_date")).agg(F.avg("value").alias("avg_price"))
    return gd.join(pd_, "target_date", "left")


@register("history_forecast_splice", O.rounded(f"""{W_H},
nw AS (SELECT date_trunc('day', max(timestamp)) - INTERVAL 7 DAY AS now FROM stg_prices)
SELECT timestamp, value, 'observed' AS source FROM stg_prices, nw WHERE timestamp <= now AND timestamp > now - INTERVAL 7 DAY
UNION ALL SELECT timestamp, value, 'forecast' FROM stg_fc, nw
WHERE signal_name = {O.q(CAT.home_price + '_FC')} AND timestamp > now""", ["value"]))
def history_forecast_splice(spark, sf_dir):
    """7-day observed buffer up to "now" + forecast rows after it (disjoint
    filters, no duplicate at the boundary); "now" derived from the data."""
    wh = warehouse(spark, sf_dir)
    obs = wh.stg_prices
    now = obs.agg(F.date_trunc("DAY", F.max("timestamp")) - F.expr("INTERVAL 7 DAYS")).scalar()
    o = (obs.where((F.col("timestamp") <= now) & (F.col("timestamp") > now - F.expr("INTERVAL 7 DAYS")))
            .select("timestamp", "value", F.lit("observed").alias("source")))
    fc = wh.stg_generation_load_forecast.where(F.col("signal_name") == CAT.home_price + "_FC")
    f = fc.where(F.col("timestamp") > now).select("timestamp", "value", F.lit("forecast").alias("source"))
    return o.unionByName(f)


# -- J1, J2, J4 -----------------------------------------------------------------------
HOLDOUT_DAYS = 7


@register("temporal_split_counts", f"""{W_H},
c AS (SELECT max({LOCAL_SQL}) - INTERVAL {HOLDOUT_DAYS} DAY AS cut FROM stg_prices)
SELECT CASE WHEN {LOCAL_SQL} >= cut THEN 'test' ELSE 'trainval' END AS role, count(*) AS n,
       min(timestamp) AS first_ts, max(timestamp) AS last_ts FROM stg_prices, c GROUP BY 1""")
def temporal_split_counts(spark, sf_dir):
    """Hold-out = last N days of local time (cut = max - N days); rows per role."""
    p = prices(spark, sf_dir).withColumn("local_timestamp", TM.to_local("timestamp"))
    s = SP.temporal_split(p, "local_timestamp", holdout_days=HOLDOUT_DAYS)
    return s.groupBy("role").agg(F.count(F.lit(1)).alias("n"), F.min("timestamp").alias("first_ts"),
                                 F.max("timestamp").alias("last_ts"))


LOCAL_DAY_SQL = f"CAST({LOCAL_SQL} AS DATE)"
WINDOWS_SQL = f"""b AS (SELECT min({LOCAL_DAY_SQL}) + 7 AS fs, max({LOCAL_DAY_SQL}) - 9 AS ho,
                  max({LOCAL_DAY_SQL}) + 1 AS he FROM stg_prices),
st AS (SELECT fs AS s FROM b
       UNION SELECT CAST(unnest(generate_series(fs + CAST(7 - (isodow(fs) - 1) AS INTEGER), ho - 1, INTERVAL 7 DAY)) AS DATE) FROM b
       UNION SELECT ho FROM b
       UNION SELECT CAST(unnest(generate_series(ho + CAST(7 - (isodow(ho) - 1) AS INTEGER), he - 1, INTERVAL 7 DAY)) AS DATE) FROM b),
win AS (SELECT row_number() OVER (ORDER BY s) AS window_id, s AS start,
               coalesce(lead(s) OVER (ORDER BY s), he) AS "end", s >= ho AS in_holdout FROM st, b)"""


def _windows(spark, sf_dir):
    d = TM.delivery_date("timestamp")
    bounds = prices(spark, sf_dir).agg(F.date_add(F.min(d), 7).alias("first_start"),
                                       F.date_sub(F.max(d), 9).alias("holdout_start"),
                                       F.date_add(F.max(d), 1).alias("holdout_end"))
    return cut_lineage(SP.prediction_windows(bounds), "windows")   # one row per week, read several times


@register("prediction_windows", O.rounded(f"""{W_H}, {WINDOWS_SQL}
SELECT w.window_id, w.start, w."end", w.in_holdout, count(p.timestamp) AS n_rows
FROM win w LEFT JOIN stg_prices p ON {LOCAL_DAY_SQL} >= w.start AND {LOCAL_DAY_SQL} < w."end"
GROUP BY 1, 2, 3, 4""", dates=["start", "end"]))
def prediction_windows_q(spark, sf_dir):
    """Weekly expanding prediction windows (first start, Mondays, hold-out
    restart) with the number of rows each window predicts."""
    win = _windows(spark, sf_dir)
    tagged = SP.assign_window(prices(spark, sf_dir), win, day=TM.delivery_date("timestamp"))
    counts = tagged.groupBy("window_id").agg(F.count(F.lit(1)).alias("n_rows"))
    return win.join(counts, "window_id", "left").select("window_id", "start", "end", "in_holdout",
                                                        F.coalesce("n_rows", F.lit(0)).alias("n_rows"))


CV_SPLITS, CV_GAP = 3, 24


@register("ts_cv_folds", f"""{W_H},
r AS (SELECT timestamp, row_number() OVER (ORDER BY timestamp) - 1 AS idx, count(*) OVER () AS n FROM stg_prices),
f AS (SELECT r.*, fold, n - ({CV_SPLITS} - fold + 1) * (n // {CV_SPLITS + 1}) AS ts0, n // {CV_SPLITS + 1} AS t
      FROM r, (SELECT CAST(f AS BIGINT) AS fold FROM (VALUES (1), (2), (3)) v(f))),
x AS (SELECT *, CASE WHEN idx >= ts0 AND idx < ts0 + t THEN 'test' WHEN idx < ts0 - {CV_GAP} THEN 'train' END AS role FROM f)
SELECT fold, role, count(*) AS n, min(timestamp) AS first_ts, max(timestamp) AS last_ts FROM x
WHERE role IS NOT NULL GROUP BY 1, 2""")
def ts_cv_folds(spark, sf_dir):
    """Expanding time-series CV folds with a gap (global row index by
    bucket counts + prefix sum, no one-task window); rows per (fold, role)."""
    f = SP.ts_cv_folds(prices(spark, sf_dir).select("timestamp"), CV_SPLITS, CV_GAP)
    return f.groupBy("fold", "role").agg(F.count(F.lit(1)).alias("n"), F.min("timestamp").alias("first_ts"),
                                         F.max("timestamp").alias("last_ts"))


# -- K metrics on a predictions table ------------------------------------------------------
PRED_SQL = f"""{WINDOWS_SQL},
pr AS (SELECT t.timestamp, t.value AS y,
              ({' + '.join(f'p{k}.value' for k in range(1, 8))}) / 7.0 AS pred, p1.value AS ref
       FROM stg_prices t
       {chr(10).join(f'LEFT JOIN stg_prices p{k} ON p{k}.timestamp = t.timestamp - INTERVAL {24 * k} HOUR' for k in range(1, 8))}),
pw AS (SELECT w.window_id, pr.* FROM pr JOIN win w ON {LOCAL_DAY_SQL} >= w.start AND {LOCAL_DAY_SQL} < w."end"
       WHERE pr.y IS NOT NULL AND pr.pred IS NOT NULL AND pr.ref IS NOT NULL),
fl AS (SELECT *, coalesce((pred - lag(pred) OVER w) * (y - lag(y) OVER w) > 0, false) AS dir_hit,
              coalesce((ref - lag(ref) OVER w) * (y - lag(y) OVER w) > 0, false) AS bdir_hit,
              (pred > ref) = (y > ref) AS dev_hit
       FROM pw WINDOW w AS (PARTITION BY window_id ORDER BY timestamp))"""


def _predictions(spark, sf_dir):
    """Long predictions table: model = exact same-hour 7-day mean, reference = 24 h persistence."""
    p = prices(spark, sf_dir).select("timestamp", F.col("price_eur_mwh").alias("y"))
    j = LG.lag_fanout(p, {24 * k: {"y": f"_p{k}"} for k in range(1, 8)})
    pr = j.select("timestamp", "y", LG.same_hour_average([f"_p{k}" for k in range(1, 8)]).alias("pred"),
                  F.col("_p1").alias("ref")).na.drop(subset=["y", "pred", "ref"])
    return SP.assign_window(pr, _windows(spark, sf_dir), day=TM.delivery_date("timestamp")).select("window_id", "timestamp", "y", "pred", "ref")


@register("regression_metrics", O.rounded(f"""{W_H}, {PRED_SQL}
SELECT window_id, count(*) AS n, avg(abs(pred - y)) AS mae, sqrt(avg((pred - y) * (pred - y))) AS rmse,
       1 - sum((pred - y) * (pred - y)) / (var_pop(y) * count(y)) AS r2 FROM pw GROUP BY 1""", ["mae", "rmse", "r2"]))
def regression_metrics(spark, sf_dir):
    """K1: MAE, RMSE, R^2 (1 - SSres/SStot) per prediction window."""
    pr = _predictions(spark, sf_dir)
    return pr.groupBy("window_id").agg(F.count(F.lit(1)).alias("n"), *MT.error_aggregates("y", "pred"))


@register("directional_metrics", O.rounded(f"""{W_H}, {PRED_SQL}
SELECT window_id, avg(CASE WHEN dir_hit THEN 1.0 ELSE 0.0 END) AS directional_accuracy,
       avg(CASE WHEN dev_hit THEN 1.0 ELSE 0.0 END) AS deviation_directional_accuracy FROM fl GROUP BY 1""",
                                           ["directional_accuracy", "deviation_directional_accuracy"]))
def directional_metrics(spark, sf_dir):
    """K2 + K3: directional accuracy (first row a miss, ties misses) and deviation-directional accuracy."""
    f = MT.with_direction_flags(_predictions(spark, sf_dir), ["window_id"], "timestamp", "y", "pred", "ref")
    return f.groupBy("window_id").agg(F.avg(F.col("_dir_hit").cast("double")).alias("directional_accuracy"),
                                      F.avg(F.col("_dev_hit").cast("double")).alias("deviation_directional_accuracy"))


@register("peak_mae", O.rounded(f"""{W_H}, {PRED_SQL},
q AS (SELECT window_id, quantile_cont(y, 0.9) AS q FROM pw GROUP BY 1)
SELECT pw.window_id, avg(abs(pred - y)) AS peak_mae, count(*) AS n_peak FROM pw JOIN q ON pw.window_id = q.window_id
WHERE y > q.q GROUP BY 1""", ["peak_mae"]))
def peak_mae(spark, sf_dir):
    """K4: MAE over hours strictly above the window's 0.9 quantile."""
    return MT.peak_mae(_predictions(spark, sf_dir), ["window_id"], "y", "pred", 0.9)


@register("persistence_report_by_window", O.rounded(f"""{W_H}, {PRED_SQL}
SELECT window_id, count(*) AS n, avg(abs(pred - y)) AS mae, sqrt(avg((pred - y) * (pred - y))) AS rmse,
       1 - sum((pred - y) * (pred - y)) / (var_pop(y) * count(y)) AS r2,
       avg(CASE WHEN dir_hit THEN 1.0 ELSE 0.0 END) AS directional_accuracy,
       avg(CASE WHEN dev_hit THEN 1.0 ELSE 0.0 END) AS deviation_directional_accuracy,
       avg(abs(ref - y)) AS baseline_mae, sqrt(avg((ref - y) * (ref - y))) AS baseline_rmse,
       1 - sum((ref - y) * (ref - y)) / (var_pop(y) * count(y)) AS baseline_r2,
       avg(CASE WHEN bdir_hit THEN 1.0 ELSE 0.0 END) AS baseline_directional_accuracy,
       avg(abs(ref - y)) - avg(abs(pred - y)) AS mae_improvement,
       (avg(abs(ref - y)) - avg(abs(pred - y))) / avg(abs(ref - y)) * 100 AS mae_improvement_pct
FROM fl GROUP BY 1""", ["mae", "rmse", "r2", "directional_accuracy", "deviation_directional_accuracy", "baseline_mae",
                        "baseline_rmse", "baseline_r2", "baseline_directional_accuracy", "mae_improvement",
                        "mae_improvement_pct"]))
def persistence_report_by_window(spark, sf_dir):
    """Full report per window incl. the 24 h persistence baseline and improvement."""
    return MT.report(_predictions(spark, sf_dir), ["window_id"], "timestamp", "y", "pred", ref="ref",
                     with_baseline=True)


# -- D40, D41, D43, A15 -----------------------------------------------------------------------
CLIP_LOW, CLIP_HIGH = 400_000.0, 2_500_000.0


@register("histogram_density_by_regime", O.rounded(f"""WITH {DAILY_SQL},
s AS (SELECT {REGIME_SQL} AS regime, least(greatest(value, {CLIP_LOW}), {CLIP_HIGH}) AS x FROM daily),
r AS (SELECT regime, count(*) AS nr, min(x) - CASE WHEN min(x) = max(x) THEN 0.5 ELSE 0 END AS lo,
             max(x) + CASE WHEN min(x) = max(x) THEN 0.5 ELSE 0 END AS hi FROM s GROUP BY 1)
SELECT s.regime, CAST(least(floor((x - lo) / (hi - lo) * 120), 119) AS BIGINT) AS bin, count(*) AS n,
       count(*) / (any_value(nr) * ((any_value(hi) - any_value(lo)) / 120.0)) AS density
FROM s JOIN r ON s.regime = r.regime GROUP BY 1, 2""", ["density"]))
def histogram_density_by_regime(spark, sf_dir):
    """Density histogram per regime: values clipped, 120 bins over the regime's own range."""
    d = B.daily_orders(spark, sf_dir).select(regime().alias("regime"), F.col("value").alias("x"))
    return AN.density_histogram(d, ["regime"], "x", 120, CLIP_LOW, CLIP_HIGH)


@register("share_vs_season_average", O.rounded(f"""{W_H}, g AS ({O.pivot_gen_sql()}),
d AS (SELECT CAST(((timestamp AT TIME ZONE 'UTC') AT TIME ZONE 'Europe/Berlin') AS DATE) AS local_date,
             sum({_rowsum_sql(REN)}) / nullif(sum({_rowsum_sql(GEN_NO_STORAGE)}), 0) AS share FROM g GROUP BY 1),
s AS (SELECT *, CASE WHEN month(local_date) IN (12, 1, 2) THEN 'winter' WHEN month(local_date) IN (3, 4, 5) THEN 'spring'
             WHEN month(local_date) IN (6, 7, 8) THEN 'summer' ELSE 'autumn' END AS season FROM d),
a AS (SELECT season, avg(share) AS season_avg FROM s GROUP BY 1)
SELECT s.local_date, s.season, s.share, a.season_avg, s.share - a.season_avg AS vs_season FROM s JOIN a ON s.season = a.season""",
                                               ["share", "season_avg", "vs_season"], dates=["local_date"]))
def share_vs_season_average(spark, sf_dir):
    """Daily renewable share against the average share of its season."""
    g = warehouse(spark, sf_dir).fct_generation_load.withColumn("local_date", TM.delivery_date("timestamp"))
    d = AN.weighted_share(g, ["local_date"], REN, GEN_NO_STORAGE, "share").withColumn("season", TM.season(F.month("local_date")))
    a = d.groupBy("season").agg(F.avg("share").alias("season_avg"))
    return d.join(F.broadcast(a), "season").select("local_date", "season", "share", "season_avg",
                                                   (F.col("share") - F.col("season_avg")).alias("vs_season"))


@register("deviation_from_typical", O.rounded(f"""{W_H},
p AS (SELECT timestamp, value, hour({LOCAL_SQL}) AS hour,
             CASE WHEN month({LOCAL_SQL}) IN (12, 1, 2) THEN 'winter' WHEN month({LOCAL_SQL}) IN (3, 4, 5) THEN 'spring'
                  WHEN month({LOCAL_SQL}) IN (6, 7, 8) THEN 'summer' ELSE 'autumn' END AS season FROM stg_prices)
SELECT timestamp, value AS price_eur_mwh, hour, season, value - avg(value) OVER (PARTITION BY hour, season) AS deviation FROM p""",
                                              ["price_eur_mwh", "deviation"]))
def deviation_from_typical(spark, sf_dir):
    """Price minus the mean of its (local hour, season) cell."""
    p = _local_prices(spark, sf_dir).select("timestamp", "price_eur_mwh", "hour", "season")
    return AN.deviation_from_cell_mean(p, "price_eur_mwh", ["hour", "season"])


LOADED_BEFORE = "2024-01-20 00:00:00"


@register("skip_existing_partitions", f"""WITH sig_rows AS ({O.signal_rows('hour')}),
inc AS (SELECT DISTINCT CAST(timestamp AS DATE) AS day, resolution FROM sig_rows),
ex AS (SELECT DISTINCT CAST(timestamp AS DATE) AS day, resolution FROM sig_rows WHERE fetched_at < TIMESTAMP '{LOADED_BEFORE}')
SELECT CAST(day AS TIMESTAMP) AS day, resolution FROM inc ANTI JOIN ex USING (day, resolution)""")
def skip_existing_partitions(spark, sf_dir):
    """Incoming (day, resolution) partitions not yet in the lake (anti join
    against the partitions present); ``force`` would skip this filter."""
    from ampere.sources.lake import partitions_to_write
    rows = B.raw_signal_rows(spark, sf_dir)
    existing = rows.where(F.col("fetched_at") < F.lit(LOADED_BEFORE).cast("timestamp"))
    return partitions_to_write(rows, existing)


# -- M1-M3 streaming (availableNow over the events file) -------------------------------------
import uuid  # noqa: E402

from ampere.session import cut_lineage, ensure_checkpoint_dir  # noqa: E402
from ampere.streaming import ingest as SI  # noqa: E402

EVENTS_SCHEMA = "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string"


def _events_stream(spark, sf_dir):
    from pyspark.sql.types import _parse_datatype_string
    s = SI.table_stream(spark, f"{sf_dir}/events.parquet", _parse_datatype_string(EVENTS_SCHEMA))
    return s.withColumn("ts", F.col("ts").cast("timestamp"))


def _scratch(spark, name):
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/ampere-{name}-{uuid.uuid4().hex}"


@register("stream_upsert_available_now", O.rounded(f"""WITH sig_rows AS ({O.signal_rows('hour')})
{O.latest('sig_rows', 'timestamp, signal, resolution')}""", ["value"]))
def stream_upsert_available_now(spark, sf_dir):
    """M1: file stream -> foreachBatch keyed upsert into a day-partitioned
    table (only touched day partitions are read and rewritten per batch)."""
    ev = _events_stream(spark, sf_dir)
    rows = ev.select(TM.floor_minutes("ts", 60).alias("timestamp"), F.upper("event_type").alias("signal"),
                     (F.col("value") - B.VALUE_OFFSET).alias("value"), F.lit("MW").alias("unit"),
                     F.lit("hour").alias("resolution"), F.col("ts").alias("fetched_at"), "event_id")
    root = _scratch(spark, "stream-upsert")
    q = SI.upsert_stream(rows, f"{root}/table", f"{root}/_checkpoint", ["timestamp", "signal", "resolution"],
                         ["fetched_at", "event_id"])
    q.awaitTermination()
    return spark.read.parquet(f"{root}/table").drop("day")


@register("stream_dedup_first_wins")
def stream_dedup_first_wins(spark, sf_dir):
    """M2: streaming de-duplication of revisions within the watermark (first
    arrival wins, so values depend on arrival order: rows-only check)."""
    ev = _events_stream(spark, sf_dir).withColumn("timestamp", F.date_trunc("HOUR", "ts"))
    d = SI.dedup_stream(ev, ["timestamp", "event_type"], "ts", "2 hours")
    root = _scratch(spark, "stream-dedup")
    SI.run_available_now(d.select("timestamp", "event_type", "value", "ts"), f"{root}/out", f"{root}/_checkpoint")
    return spark.read.parquet(f"{root}/out")


@register("stream_hourly_rollup", O.rounded("""WITH w AS (
  SELECT date_trunc('hour', ts) AS window_start, date_trunc('hour', ts) + INTERVAL 1 HOUR AS window_end, event_type,
         count(*) AS n, sum(value) AS total, avg(value) AS mean FROM events GROUP BY 1, 2, 3),
wm AS (SELECT max(ts) - INTERVAL 2 HOUR AS wm FROM events)
SELECT w.* FROM w, wm WHERE window_end <= wm""", ["total", "mean"]))
def stream_hourly_rollup(spark, sf_dir):
    """M3: tumbling hourly windows with a 2 h watermark in append mode; windows
    whose end is past the final watermark stay open and are not emitted."""
    ev = _events_stream(spark, sf_dir)
    r = SI.windowed_rollup(ev, "ts", ["event_type"], "value", "1 hour", "2 hours")
    root = _scratch(spark, "stream-rollup")
    SI.run_available_now(r, f"{root}/out", f"{root}/_checkpoint")
    return spark.read.parquet(f"{root}/out")


# -- A2, A3, A5, A6, A9-A12 landed payloads ------------------------------------------------
from ampere.sources import payloads as PL  # noqa: E402
from pyspark.sql import types as T  # noqa: E402


def _chunks(spark, sf_dir):
    """Weekly signal chunks as landed JSON payloads (one per signal x week)."""
    s = B.raw_signals(spark, sf_dir).withColumn("chunk_start", F.date_trunc("WEEK", "timestamp"))
    return PL.series_payload(s, ["signal", "chunk_start"])


@register("series_payload_parse", O.rounded(f"{W_H} SELECT signal, timestamp, value FROM sig", ["value"]))
def series_payload_parse(spark, sf_dir):
    """A2/A4: parse landed weekly series payloads back to (signal, timestamp, value)."""
    return PL.parse_series_payload(_chunks(spark, sf_dir), keep=["signal"])


CHUNK_SQL = f"""{W_H},
idx AS (SELECT DISTINCT signal, date_trunc('week', timestamp) AS chunk_start FROM sig),
rng AS (SELECT min(timestamp) + INTERVAL 10 DAY AS s, max(timestamp) - INTERVAL 10 DAY AS e FROM sig),
fr AS (SELECT signal, coalesce(max(chunk_start) FILTER (WHERE chunk_start <= s), min(chunk_start)) AS f FROM idx, rng GROUP BY 1)
SELECT idx.signal, idx.chunk_start FROM idx JOIN fr ON idx.signal = fr.signal, rng
WHERE idx.chunk_start >= fr.f AND idx.chunk_start <= rng.e"""


@register("chunk_selection", CHUNK_SQL)
def chunk_selection(spark, sf_dir):
    """A3: chunks to fetch for a range: last chunk starting at/before the range
    start (else the first), through all chunks starting at/before the end."""
    s = B.raw_signals(spark, sf_dir)
    idx = s.select("signal", F.date_trunc("WEEK", "timestamp").alias("chunk_start")).distinct()
    rng = s.agg(F.struct((F.min("timestamp") + F.expr("INTERVAL 10 DAYS")).alias("s"),
                         (F.max("timestamp") - F.expr("INTERVAL 10 DAYS")).alias("e"))).scalar()
    return PL.select_chunks(idx, rng.getField("s"), rng.getField("e"), ["signal"]).select("signal", "chunk_start")


@register("props_permissive_parse", """SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k
FROM events WHERE props IS NULL OR json_valid(props)""")
def props_permissive_parse(spark, sf_dir):
    """A5: permissive JSON parse of a text column; unparsable rows go to a quarantine frame."""
    good, _quarantine = PL.parse_permissive(B.table(spark, sf_dir, "events"), "props",
                                            T.StructType([T.StructField("k", T.LongType())]), keep=["event_id"])
    return good


@register("props_quarantine", """SELECT event_id, props AS "_corrupt_record"
FROM events WHERE props IS NOT NULL AND NOT json_valid(props)""")
def props_quarantine(spark, sf_dir):
    """A5: the rows of the same parse that are no JSON, with their text."""
    _good, quarantine = PL.parse_permissive(B.table(spark, sf_dir, "events"), "props",
                                            T.StructType([T.StructField("k", T.LongType())]), keep=["event_id"])
    return quarantine


VARS = list(CAT.weather_variables)


@register("weather_response_parse", O.rounded(f"""{W_H},
rd AS (SELECT DISTINCT region, CAST(timestamp AS DATE) AS day FROM stg_wx),
grid AS (SELECT region, CAST(day AS TIMESTAMP) + to_hours(h) AS timestamp, v AS signal_type
         FROM rd, range(24) t(h), (VALUES {', '.join(f"('{v}')" for v in VARS)}) vv(v))
SELECT g.timestamp, g.region, g.signal_type, x.value FROM grid g
LEFT JOIN stg_wx x ON x.timestamp = g.timestamp AND x.region = g.region AND x.signal_name = g.signal_type""",
                                              ["value"]))
def weather_response_parse(spark, sf_dir):
    """Per (region, day) API-shaped responses (start, end, interval, one
    value array per variable) turned back into long rows on the full grid."""
    w = warehouse(spark, sf_dir).stg_weather.withColumn("day", F.to_date("timestamp")).withColumn("h", F.hour("timestamp"))
    arrays = [F.array(*[F.max(F.when((F.col("h") == h) & (F.col("signal_name") == v), F.col("value"))) for h in range(24)])
              for v in VARS]
    resp = w.groupBy("region", "day").agg(F.array(*arrays).alias("_vars")).select(F.struct(
        F.col("region"), F.unix_seconds(F.to_timestamp("day")).alias("start"),
        (F.unix_seconds(F.to_timestamp("day")) + 86400).alias("end"), F.lit(3600).alias("interval_s"),
        F.col("_vars").alias("vars")).alias("response"))
    return PL.weather_response_to_long(resp, VARS)


HYBRID_CUTOVER = "2024-01-15"


@register("hybrid_forecast_range", O.rounded(f"""WITH f AS ({O.weather_forecast_rows()})
SELECT timestamp, timestamp - INTERVAL 18 HOUR AS issue_timestamp, region, signal_type, value, 'icon_seamless' AS model, fetched_at
FROM f WHERE NOT (CAST(timestamp AS DATE) - 1 >= DATE '{HYBRID_CUTOVER}')
UNION ALL
SELECT timestamp, CAST(CAST(timestamp AS DATE) - 1 AS TIMESTAMP) AS issue_timestamp, region, signal_type, value,
       'ecmwf_ifs' AS model, fetched_at
FROM f WHERE CAST(timestamp AS DATE) - 1 >= DATE '{HYBRID_CUTOVER}'""", ["value"]))
def hybrid_forecast_range(spark, sf_dir):
    """Stitched forecasts (issue = valid - 18 h) before the cut-over,
    single-run forecasts (issue = D-1 00:00 UTC) from it on, per delivery day."""
    f = B.raw_weather_forecast(spark, sf_dir)
    stitched = f.withColumn("issue_timestamp", PL.stitched_issue()).withColumn("model", F.lit("icon_seamless"))
    single = f.withColumn("issue_timestamp", PL.single_run_issue()).withColumn("model", F.lit("ecmwf_ifs"))
    out = PL.hybrid_day_forecast(stitched, single, HYBRID_CUTOVER)
    return out.select("timestamp", "issue_timestamp", "region", "signal_type", "value", "model", "fetched_at")


# -- J3/J8 two-stage expanding-window backtest, J10 report ----------------------------------
from ampere.plans import backtest as BT  # noqa: E402

CYCLES = ["hour_sin", "hour_cos", "dow_sin", "dow_cos", "month_sin", "month_cos"]
FLAGS = ["is_weekend", "is_german_public_holiday", "is_workday"]
# contract columns that the events binding has for whole days (the others are never complete there, so E7 would
# leave nothing); gaps of the first list are filled
S1_FILL = ["price_lag_24h", "price_lag_48h", "price_lag_168h", "price_rolling_avg_7d_same_hour", "click_price_lag_24h",
           "view_price_lag_24h", "signup_price_lag_24h", "error_lag_48h", "purchase_lag_48h", "error_forecast_mw"]
S2_FILL = ["price_lag_96qh", "price_lag_192qh", "purchase_lag_192qh"]
S1_FEATURES = [*S1_FILL, "horizon", *FLAGS, *CYCLES]
S2_FEATURES = [*S2_FILL, "quarter_of_hour", "horizon", *FLAGS, *CYCLES]


def _model_frame(spark, sf_dir, resolution="hour"):
    """The model's columns of a contract, short gaps filled, whole local days only (E3, E7, H10, H11), stored."""
    hourly = resolution == "hour"
    c = build_contract(warehouse(spark, sf_dir, resolution).fct_ml_features, HOURLY if hourly else QUARTER_HOURLY)
    lt = F.col("local_timestamp")
    hour = F.hour(lt) + (F.lit(0.0) if hourly else F.minute(lt) / 60.0)
    for name, val, per, off in (("hour", hour, 24, 0), ("dow", F.weekday(lt), 7, 0), ("month", F.month(lt), 12, 1)):
        sn, cs = TM.cyclic(val, per, off)
        c = c.withColumn(f"{name}_sin", sn).withColumn(f"{name}_cos", cs)
    fill, feats = (S1_FILL, S1_FEATURES) if hourly else (S2_FILL, S2_FEATURES)
    # stored first: the fill and the day filter read their input several times
    c = cut_lineage(c.select("timestamp", "delivery_date", "resolution", "price_eur_mwh",
                             *[F.col(f).cast("double").alias(f) for f in feats]), f"bt-contract-{resolution}")
    return cut_lineage(BT.model_frame(c, fill, ["price_eur_mwh", *feats], partition=["resolution"]), f"bt-{resolution}")


def _model_sql(spec, name, fill) -> str:
    """CTEs ``{name}``: the same frame in SQL (timestamp, day, y, the filled columns)."""
    cols = ", ".join(f"last_value({c} IGNORE NULLS) OVER w AS {c}" for c in fill)
    null = " OR ".join(f"{c} IS NULL" for c in ["y", *fill])
    return f"""{name}_f AS (SELECT timestamp, CAST(delivery_date AS DATE) AS day, price_eur_mwh AS y, {cols}
    FROM ({O.contract_sql(spec)}) WINDOW w AS (ORDER BY timestamp ROWS BETWEEN 3 PRECEDING AND CURRENT ROW)),
{name} AS (SELECT * FROM {name}_f WHERE day NOT IN (SELECT day FROM {name}_f WHERE {null}))"""


HX_SQL = _model_sql(HOURLY, "hx", S1_FILL)
STATUS_SQL = f"""{HX_SQL}, {_model_sql(QUARTER_HOURLY, "qx", S2_FILL)},
wc AS (SELECT win.*, (SELECT count(*) FROM hx WHERE day >= start AND day < "end") AS n_hourly,
              (SELECT count(*) FROM qx WHERE day >= start AND day < "end") AS n_quarter,
              start <= greatest((SELECT min(day) FROM hx), (SELECT min(day) FROM qx)) AS early FROM win),
ws AS (SELECT *, CASE WHEN early THEN 'before_data' WHEN n_hourly = 0 THEN 'no_hourly_rows'
                      WHEN n_quarter = 0 THEN 'no_quarter_rows' END AS skip FROM wc),
wst AS (SELECT window_id, start, "end", in_holdout, n_hourly, n_quarter,
               coalesce(skip, CASE WHEN NOT in_holdout THEN 'warm_up'
                                   WHEN coalesce(sum(CASE WHEN skip IS NULL THEN n_quarter END) OVER
                                        (ORDER BY window_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) = 0
                                   THEN 'no_stage2_training' ELSE 'predicted' END) AS status FROM ws)"""


def _frames(spark, sf_dir):
    """(hourly frame, quarter-hour frame, windows with their status); the status table has one row per week."""
    h, q = _model_frame(spark, sf_dir), _model_frame(spark, sf_dir, "quarterhour")
    return h, q, cut_lineage(BT.window_status(_windows(spark, sf_dir), h, q), "bt-windows")


def _backtest(spark, sf_dir):
    # windows without Stage-2 training rows are reported by backtest_windows instead of ending the query
    h, q, status = _frames(spark, sf_dir)
    s1, s2 = BT.two_stage(h, q, status.select("window_id", "start", "end"), S1_FEATURES, S2_FEATURES,
                          day="delivery_date", status=status, strict=False)
    a = s1.select(F.lit("hour").alias("stage"), "window_id", "timestamp", F.col("price_eur_mwh").alias("y"), "pred",
                  F.col("price_lag_24h").alias("baseline"), "n_train")
    b = s2.select(F.lit("quarterhour").alias("stage"), "window_id", "timestamp", F.col("price_eur_mwh").alias("y"), "pred",
                  F.col("price_lag_96qh").alias("baseline"), "n_train")
    return a.unionByName(b).join(F.broadcast(status.select("window_id", "in_holdout")), "window_id")


@register("two_stage_backtest")
def two_stage_backtest(spark, sf_dir):
    """Weekly expanding-window two-stage forecast (ridge on exact
    expanding Gram sums); long predictions table with persistence baseline."""
    return _backtest(spark, sf_dir)


@register("backtest_windows", O.rounded(f"""WITH {O.staging_ctes('hour')}, {WINDOWS_SQL}, {STATUS_SQL}
SELECT * FROM wst""", dates=["start", "end"]))
def backtest_windows(spark, sf_dir):
    """Every window, its complete rows of both frames, and whether (or why not) it is predicted."""
    return _frames(spark, sf_dir)[2]


@register("backtest_rows", O.rounded(f"""WITH {O.staging_ctes('hour')}, {WINDOWS_SQL}, {STATUS_SQL}
SELECT 'hour' AS stage, w.window_id, x.timestamp, x.y, x.price_lag_24h AS baseline,
       (SELECT count(*) FROM hx t WHERE t.day < w.start) AS n_train, w.in_holdout
FROM hx x JOIN wst w ON x.day >= w.start AND x.day < w."end" WHERE w.status IN ('warm_up', 'predicted')""",
                                     ["y", "baseline"]))
def backtest_rows(spark, sf_dir):
    """The hourly rows that the two-stage backtest predicts, with their training size and baseline."""
    return _backtest(spark, sf_dir).where("stage = 'hour'").drop("pred")


ONE_FEATURE_SQL = f"""{WINDOWS_SQL}, {HX_SQL},
fit AS (SELECT w.window_id, w.start, w."end", w.in_holdout, count(*) AS n_train,
               regr_slope(y, price_lag_24h) AS b, regr_intercept(y, price_lag_24h) AS a
        FROM win w JOIN hx ON hx.day < w.start GROUP BY 1, 2, 3, 4),
pw AS (SELECT f.window_id, f.in_holdout, x.timestamp, x.y, f.a + f.b * x.price_lag_24h AS pred,
              x.price_lag_24h AS ref, f.n_train
       FROM hx x JOIN fit f ON x.day >= f.start AND x.day < f."end"),
fl AS (SELECT *, coalesce((pred - lag(pred) OVER w) * (y - lag(y) OVER w) > 0, false) AS dir_hit,
              coalesce((ref - lag(ref) OVER w) * (y - lag(y) OVER w) > 0, false) AS bdir_hit,
              (pred > ref) = (y > ref) AS dev_hit
       FROM pw WINDOW w AS (PARTITION BY window_id ORDER BY timestamp))"""


def _one_feature(spark, sf_dir):
    win = _windows(spark, sf_dir)
    out = BT.expanding_fit_predict(_model_frame(spark, sf_dir), win, ["price_lag_24h"], "price_eur_mwh", ridge=0.0,
                                   day="delivery_date").where("n_train > 0")
    return out.join(F.broadcast(win.select("window_id", "in_holdout")), "window_id").select(
        "window_id", "in_holdout", "timestamp", F.col("price_eur_mwh").alias("y"), "pred",
        F.col("price_lag_24h").alias("ref"), "n_train")


@register("one_feature_backtest", O.rounded(f"""{W_H}, {ONE_FEATURE_SQL} SELECT * FROM pw""", ["y", "pred", "ref"]))
def one_feature_backtest(spark, sf_dir):
    """The expanding-window fit with one feature and no ridge, which SQL can check by linear regression."""
    return _one_feature(spark, sf_dir)


@register("one_feature_backtest_report", O.rounded(f"""{W_H}, {ONE_FEATURE_SQL}
SELECT window_id, in_holdout, count(*) AS n, avg(abs(pred - y)) AS mae, sqrt(avg((pred - y) * (pred - y))) AS rmse,
       1 - sum((pred - y) * (pred - y)) / nullif(var_pop(y) * count(y), 0) AS r2,
       avg(CASE WHEN dir_hit THEN 1.0 ELSE 0.0 END) AS directional_accuracy,
       avg(CASE WHEN dev_hit THEN 1.0 ELSE 0.0 END) AS deviation_directional_accuracy,
       avg(abs(ref - y)) AS baseline_mae, sqrt(avg((ref - y) * (ref - y))) AS baseline_rmse,
       1 - sum((ref - y) * (ref - y)) / nullif(var_pop(y) * count(y), 0) AS baseline_r2,
       avg(CASE WHEN bdir_hit THEN 1.0 ELSE 0.0 END) AS baseline_directional_accuracy,
       avg(abs(ref - y)) - avg(abs(pred - y)) AS mae_improvement,
       100 * (avg(abs(ref - y)) - avg(abs(pred - y))) / nullif(avg(abs(ref - y)), 0) AS mae_improvement_pct
FROM fl GROUP BY 1, 2""", ["mae", "rmse", "r2", "directional_accuracy", "deviation_directional_accuracy", "baseline_mae",
                           "baseline_rmse", "baseline_r2", "baseline_directional_accuracy", "mae_improvement",
                           "mae_improvement_pct"]))
def one_feature_backtest_report(spark, sf_dir):
    """Every metric of the report on the one-feature backtest, per window."""
    return MT.report(_one_feature(spark, sf_dir), ["window_id", "in_holdout"], "timestamp", "y", "pred", ref="ref",
                     with_baseline=True)


@register("backtest_report")
def backtest_report(spark, sf_dir):
    """Per stage and hold-out window MAE/RMSE/R^2/directional accuracy of
    the forecast and of the persistence baseline (skipped windows: backtest_windows)."""
    p = _backtest(spark, sf_dir).where("in_holdout").na.drop(subset=["y", "pred", "baseline"])
    return MT.report(p, ["stage", "window_id", "in_holdout"], "timestamp", "y", "pred", ref="baseline",
                     with_baseline=True)


# -- small inventory items: D8 D12 D31-D34 D42 L9-L11 B21 J16 F4 A24-A27 ------------------------
@register("group_mean_calendar", O.rounded(f"""{W_H}
SELECT month({LOCAL_SQL}) AS month, hour({LOCAL_SQL}) AS hour, isodow(CAST({LOCAL_SQL} AS DATE)) - 1 AS dow,
       avg(value) AS avg_price_eur_mwh FROM stg_prices GROUP BY 1, 2, 3""", ["avg_price_eur_mwh"]))
def group_mean_calendar(spark, sf_dir):
    """Mean price by local (month, hour, day-of-week)."""
    p = _local_prices(spark, sf_dir)
    return AN.group_mean(p, ["month", "hour", "dow"], ["price_eur_mwh"])


@register("row_sum_generation", O.rounded(f"""{W_H}, g AS ({O.pivot_gen_sql()})
SELECT timestamp, {_rowsum_sql(GEN_MIX)} AS generation_sum_mw FROM g""", ["generation_sum_mw"]))
def row_sum_generation(spark, sf_dir):
    """Row-wise sum over generation columns, nulls counted as 0."""
    g = warehouse(spark, sf_dir).fct_generation_load
    e = F.lit(0.0)
    for c in GEN_MIX:
        e = e + F.coalesce(F.col(c), F.lit(0.0))
    return g.select("timestamp", e.alias("generation_sum_mw"))


@register("unit_consistency", f"""{W_H}
SELECT signal_name, min(unit) AS unit, count(DISTINCT unit) AS n_units FROM stg_gen GROUP BY 1""")
def unit_consistency(spark, sf_dir):
    """First unit and number of distinct units per signal."""
    return QL.unit_consistency(warehouse(spark, sf_dir).stg_generation_load, "signal_name", "unit")


@register("duplicate_key_count", f"""WITH r AS ({O.signal_rows('hour')})
SELECT signal, count(*) - count(DISTINCT timestamp) AS duplicates FROM r GROUP BY 1""")
def duplicate_key_count(spark, sf_dir):
    """Landed rows minus distinct keys per signal (revisions)."""
    r = B.raw_signal_rows(spark, sf_dir)
    return r.groupBy("signal").agg((F.count(F.lit(1)) - F.countDistinct("timestamp")).alias("duplicates"))


@register("signal_time_range", O.rounded(f"""{W_H}
SELECT signal, min(timestamp) AS first_ts, max(timestamp) AS last_ts, quantile_cont(value, 0.5) AS median_value,
       count(DISTINCT CAST(timestamp AS DATE)) AS n_days FROM sig GROUP BY 1""", ["median_value"]))
def signal_time_range(spark, sf_dir):
    """first/last instant, median and number of distinct days per signal."""
    s = B.raw_signals(spark, sf_dir)
    ends = s.groupBy("signal").agg(F.min("timestamp").alias("first_ts"), F.max("timestamp").alias("last_ts"),
                                   F.countDistinct(F.to_date("timestamp")).alias("n_days"))
    return QT.joined_on(ends, QT.exact_quantiles(s, ["signal"], "value", {"median_value": 0.5}), ["signal"])


@register("incomplete_days", f"""{W_H}
SELECT signal, CAST(CAST(timestamp AS DATE) AS TIMESTAMP) AS day, count(*) AS rows FROM sig GROUP BY 1, 2 HAVING count(*) <> 24""")
def incomplete_days(spark, sf_dir):
    """(signal, day) groups whose row count is not 24 (HAVING)."""
    return QL.coverage(B.raw_signals(spark, sf_dir), "timestamp", ["signal"], 24)


@register("forecast_availability", f"""{W_H}
SELECT CAST(CAST(timestamp AS DATE) AS TIMESTAMP) AS day, count(*) AS rows,
       coalesce(bool_or(value IS NOT NULL), false) AS any_value FROM stg_wxf GROUP BY 1""")
def forecast_availability(spark, sf_dir):
    """Per target day, forecast rows and whether any value is present
    (the inference path raises when either is missing)."""
    f = warehouse(spark, sf_dir).stg_weather_forecast.withColumn("day", F.to_date("timestamp"))
    return f.groupBy("day").agg(F.count(F.lit(1)).alias("rows"),
                                F.coalesce(F.max(F.col("value").isNotNull()), F.lit(False)).alias("any_value"))


@register("freshness", f"""{W_H}
SELECT signal_name, max(fetched_at) AS latest_fetch,
       round(round(epoch(max(timestamp)) - epoch(max(fetched_at)), 9), 6) AS lead_s FROM stg_fc GROUP BY 1""")
def freshness(spark, sf_dir):
    """Newest fetch per forecast signal and how far the newest valid time
    lies beyond it (seconds)."""
    f = warehouse(spark, sf_dir).stg_generation_load_forecast
    return f.groupBy("signal_name").agg(
        F.max("fetched_at").alias("latest_fetch"),
        ((F.unix_micros(F.max("timestamp")) - F.unix_micros(F.max("fetched_at"))) / 1e6).alias("lead_s"))


SOURCE_COLUMNS = ["click_mw", "view_mw", "signup_mw"]


@register("source_selection", O.rounded(f"""{W_H}, g AS ({O.pivot_gen_sql()})
SELECT timestamp, 'view_mw' AS source, view_mw AS value FROM g""", ["value"]))
def source_selection(spark, sf_dir):
    """One generation source chosen by name (validated against the
    catalogue), as (timestamp, source, value) via unpivot + filter."""
    name = "view_mw"
    if name not in SOURCE_COLUMNS:
        raise ValueError(f"unknown source {name}")
    g = warehouse(spark, sf_dir).fct_generation_load
    return RS.unpivot(g, ["timestamp"], SOURCE_COLUMNS, "source", "value").where(F.col("source") == name)


SELECT_HOUR = 0


@register("hour_selection", O.rounded(f"""{W_H}
SELECT timestamp, value AS price_eur_mwh FROM stg_prices WHERE hour({LOCAL_SQL}) = {SELECT_HOUR}""", ["price_eur_mwh"]))
def hour_selection(spark, sf_dir):
    """One local hour of each day (0 is a valid choice; None = all 24)."""
    hour = SELECT_HOUR
    p = prices(spark, sf_dir).select("timestamp", "price_eur_mwh")
    return p if hour is None else p.where(F.hour(TM.to_local("timestamp")) == hour)


@register("season_ordered_means", O.rounded(f"""{W_H}
SELECT CASE WHEN month({LOCAL_SQL}) IN (12, 1, 2) THEN 'winter' WHEN month({LOCAL_SQL}) IN (3, 4, 5) THEN 'spring'
            WHEN month({LOCAL_SQL}) IN (6, 7, 8) THEN 'summer' ELSE 'autumn' END AS season,
       CAST(CASE WHEN month({LOCAL_SQL}) IN (12, 1, 2) THEN 0 WHEN month({LOCAL_SQL}) IN (3, 4, 5) THEN 1
            WHEN month({LOCAL_SQL}) IN (6, 7, 8) THEN 2 ELSE 3 END AS BIGINT) AS season_rank,
       avg(value) AS avg_price FROM stg_prices GROUP BY 1, 2""", ["avg_price"]))
def season_ordered_means(spark, sf_dir):
    """mean price per season with the categorical sort key (winter..autumn)."""
    p = _local_prices(spark, sf_dir)
    return p.groupBy("season").agg(F.avg("price_eur_mwh").alias("avg_price")).withColumn(
        "season_rank", TM.season_order("season"))


READ_FROM, READ_TO = "2024-01-08 00:00:00", "2024-01-15 00:00:00"


@register("bounded_feature_read", O.rounded(f"""{W_ML}
SELECT timestamp, price_eur_mwh, CAST(((timestamp AT TIME ZONE 'UTC') AT TIME ZONE 'Europe/Berlin') AS TIMESTAMP) AS local_timestamp
FROM ml WHERE timestamp >= TIMESTAMP '{READ_FROM}' AND timestamp < TIMESTAMP '{READ_TO}'""", ["price_eur_mwh"]))
def bounded_feature_read(spark, sf_dir):
    """Feature table read with half-open UTC bounds, local time added."""
    ml = warehouse(spark, sf_dir).fct_ml_features
    r = ml.where((F.col("timestamp") >= F.lit(READ_FROM).cast("timestamp")) &
                 (F.col("timestamp") < F.lit(READ_TO).cast("timestamp")))
    return r.select("timestamp", "price_eur_mwh", TM.to_local("timestamp").alias("local_timestamp"))


from ampere.plans import tuning as TU  # noqa: E402


@register("random_search_cv")
def random_search_cv(spark, sf_dir):
    """Seeded random search of the ridge strength over 3
    expanding CV folds (gap 24 rows), best trial refit and scored on the hold-out."""
    return TU.random_search_cv(_model_frame(spark, sf_dir), S1_FEATURES, "price_eur_mwh", n_trials=10, n_splits=3, gap=24)


# -- remaining inventory rows: C7 D7/I14 D39 E4/H23 B17 B19/B20 J17 J18 K8 ------------------------
@register("series_vs_national_mean", O.rounded(f"""WITH {O.staging_ctes('hour')},
nat AS (SELECT timestamp, avg(value) AS national_mean FROM stg_wx WHERE signal_name = 'temperature_2m' GROUP BY 1)
SELECT x.timestamp, x.region, x.value, nat.national_mean, x.value - nat.national_mean AS vs_national
FROM stg_wx x JOIN nat ON x.timestamp = nat.timestamp WHERE x.signal_name = 'temperature_2m'""",
                                             ["value", "national_mean", "vs_national"]))
def series_vs_national_mean(spark, sf_dir):
    """Regional series joined (inner) with the national aggregate per timestamp."""
    w = warehouse(spark, sf_dir).stg_weather.where(F.col("signal_name") == "temperature_2m")
    nat = w.groupBy("timestamp").agg(F.avg("value").alias("national_mean"))
    return (w.join(nat, "timestamp").select("timestamp", "region", "value", "national_mean",
                                             (F.col("value") - F.col("national_mean")).alias("vs_national")))


WIDE_SIGNALS = sorted(CAT.generation_load)


@register("wide_local_frame", O.rounded(f"""{W_H}
SELECT timestamp, {', '.join(f"max(value) FILTER (WHERE signal_name = '{s}') AS {s}" for s in WIDE_SIGNALS)},
       any_value({LOCAL_SQL}) AS local_timestamp, hour(any_value({LOCAL_SQL})) AS hour
FROM stg_gen GROUP BY timestamp""", WIDE_SIGNALS))
def wide_local_frame(spark, sf_dir):
    """I14 (A1 D7 H3): long signals -> dynamic wide pivot (key uniqueness
    checked first: duplicates are an error) -> local-time helper columns."""
    s = warehouse(spark, sf_dir).stg_generation_load
    wide = RS.pivot_dynamic(s, ["timestamp"], "signal_name", "value", WIDE_SIGNALS)   # raises on duplicates
    lt = TM.to_local("timestamp")
    return wide.select("timestamp", *WIDE_SIGNALS, lt.alias("local_timestamp"), F.hour(lt).alias("hour"))


@register("summary_transpose", O.rounded(f"""{W_H}, {SPREAD_SQL},
s AS (SELECT neighbour, avg(spread) AS stat_mean, stddev_samp(spread) AS stat_std, min(spread) AS stat_min,
             max(spread) AS stat_max FROM sp GROUP BY 1)
UNPIVOT s ON stat_mean, stat_std, stat_min, stat_max INTO NAME stat VALUE value""", ["value"]).replace(
    "SELECT * REPLACE", "SELECT neighbour, regexp_replace(stat, '^stat_', '') AS stat, * EXCLUDE (neighbour, stat) REPLACE"))
def summary_transpose(spark, sf_dir):
    """Transpose of a per-neighbour summary to long form, prefix stripped from names."""
    s = _spreads_long(spark, sf_dir).groupBy("neighbour").agg(
        F.avg("spread").alias("stat_mean"), F.stddev_samp("spread").alias("stat_std"),
        F.min("spread").alias("stat_min"), F.max("spread").alias("stat_max"))
    long = RS.unpivot(s, ["neighbour"], ["stat_mean", "stat_std", "stat_min", "stat_max"], "stat", "value")
    return long.withColumn("stat", F.regexp_replace("stat", "^stat_", ""))


@register("row_lag_and_wind_total", O.rounded(f"""{W_H}, g AS ({O.pivot_gen_sql()})
SELECT timestamp, click_mw + view_mw AS wind_total_mw,
       lag(view_mw, 24) OVER (ORDER BY timestamp) AS view_mw_lag_24,
       lag(view_mw, 168) OVER (ORDER BY timestamp) AS view_mw_lag_168 FROM g""",
                                                ["wind_total_mw", "view_mw_lag_24", "view_mw_lag_168"]))
def row_lag_and_wind_total(spark, sf_dir):
    """E4 + H23 (X11 contract): null-propagating sum of two sources and *row*-based
    shift(24)/shift(168) over one resolution's series."""
    g = warehouse(spark, sf_dir).fct_generation_load
    out = g.select("timestamp", "resolution", (F.col("click_mw") + F.col("view_mw")).alias("wind_total_mw"), "view_mw")
    out = LG.row_lag_indexed(out, {24: {"view_mw": "view_mw_lag_24"}, 168: {"view_mw": "view_mw_lag_168"}},
                             partition=["resolution"])
    return out.drop("resolution", "view_mw")


@register("resolution_by_date", f"""WITH sig_rows AS ({O.signal_rows('hour')})
SELECT CASE WHEN timestamp >= TIMESTAMP '2024-01-20 00:00:00' THEN 'quarterhour' ELSE 'hour' END AS resolution,
       count(*) AS n FROM sig_rows GROUP BY 1""")
def resolution_by_date(spark, sf_dir):
    """Product resolution from the cut-over instant on (rows per resolution)."""
    r = B.raw_signal_rows(spark, sf_dir)
    return r.groupBy(TM.resolution_by_date("timestamp", "2024-01-20 00:00:00").alias("resolution")).agg(
        F.count(F.lit(1)).alias("n"))


@register("clipped_prices", O.rounded(f"""{W_H}
SELECT timestamp, value AS price_eur_mwh, least(greatest(value, 0.0), 300.0) AS price_clipped FROM stg_prices""",
                                      ["price_eur_mwh", "price_clipped"]))
def clipped_prices(spark, sf_dir):
    """Clip to [lo, hi] (null stays null)."""
    p = prices(spark, sf_dir).select("timestamp", "price_eur_mwh")
    v = F.col("price_eur_mwh")
    return p.withColumn("price_clipped", F.when(v.isNotNull(), F.least(F.greatest(v, F.lit(0.0)), F.lit(300.0))))


@register("sampled_prices")
def sampled_prices(spark, sf_dir):
    """1 % Bernoulli sample with a fixed seed (sampling is the feature;
    rows-only check)."""
    return B.raw_signal_rows(spark, sf_dir).sample(fraction=0.01, seed=42)


@register("backtest_report_nested")
def backtest_report_nested(spark, sf_dir):
    """Model report as one nested row per stage: overall metrics, MAPE,
    baseline and the per-window list (to_json-able, written by A28)."""
    p = cut_lineage(_backtest(spark, sf_dir).where("in_holdout").na.drop(subset=["y", "pred", "baseline"]), "bt-scored")
    per_w = MT.report(p, ["stage", "window_id", "in_holdout"], "timestamp", "y", "pred", ref="baseline",
                      with_baseline=True)
    overall = MT.report(p.where("in_holdout"), ["stage"], "timestamp", "y", "pred", ref="baseline", with_baseline=True)
    mape = p.where("in_holdout").groupBy("stage").agg(MT.mape("y", "pred").alias("mape"))
    windows = per_w.groupBy("stage").agg(F.sort_array(F.collect_list(F.struct("window_id", "n", "mae", "rmse", "r2")))
                                         .alias("windows"))
    o = overall.join(mape, "stage")
    return o.select("stage", F.struct(*[c for c in o.columns if c != "stage"]).alias("holdout")).join(windows, "stage")


@register("generation_backtest")
def generation_backtest(spark, sf_dir):
    """The same expanding-window model for a generation target
    (wind total = two sources) with 24 h / 168 h lags and lag fallback."""
    g = warehouse(spark, sf_dir).fct_generation_load.where(F.col("resolution") == "hour")
    g = g.select("timestamp", (F.col("click_mw") + F.col("view_mw")).alias("wind_total_mw"))
    j = LG.lag_fanout(g, {24: {"wind_total_mw": "lag_24"}, 168: {"wind_total_mw": "lag_168"}})
    j = j.withColumn("lag_24", F.coalesce("lag_24", "lag_168"))   # E11 patch
    s, c = TM.cyclic(F.hour(TM.to_local("timestamp")), 24)
    j = j.select("timestamp", TM.delivery_date("timestamp").alias("delivery_date"), "wind_total_mw", "lag_24", "lag_168",
                 s.alias("hour_sin"), c.alias("hour_cos"))
    out = BT.expanding_fit_predict(j, _windows(spark, sf_dir), ["lag_24", "lag_168", "hour_sin", "hour_cos"],
                                   "wind_total_mw", day="delivery_date")
    return out.select("window_id", "timestamp", "wind_total_mw", "pred", "n_train")


@register("random_search_cv_stage2")
def random_search_cv_stage2(spark, sf_dir):
    """Stage-2 (quarter-hour deviation) random search with a per-fold
    Stage-1 refit; CV MAE of the reconstructed price per trial."""
    h, q = _model_frame(spark, sf_dir), _model_frame(spark, sf_dir, "quarterhour")
    return TU.random_search_cv_stage2(h, q, S1_FEATURES, S2_FEATURES, n_trials=10, n_splits=2, gap=4)


from ampere import ingest_queries, landing_queries, model_queries, report_queries, sink_queries  # noqa: E402,F401  (registers their queries)
