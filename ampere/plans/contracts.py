"""Lagged model contracts: one row per market product.

Built from the wide feature table: market-local delivery date and horizon
(E1), exact time-offset lags (C6), the exact 7-term same-hour mean (E8),
forecast errors (H12) and circular encodings of wind direction (H9).
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ampere.config import ENERGY, MARKET_TZ, Catalog
from ampere.functions.time import delivery_date, quarter_of_hour, to_local
from ampere.operators.lags import lag_fanout, lag_self_join, same_hour_average
from ampere.session import cut_lineage

CALENDAR_COLUMNS = ["year", "quarter", "month", "week_of_year", "day_of_week", "is_weekend",
                    "is_german_public_holiday", "is_workday"]


@dataclass(frozen=True)
class ContractSpec:
    resolution: str                          # 'hour' | 'quarterhour'
    steps_per_hour: int                      # 1 -> '_lag_24h', 4 -> '_lag_96qh'
    price: str = "price_eur_mwh"
    price_lags: tuple[int, ...] = (24, 48, 168)
    same_hour_avg: bool = True               # E8 over 24..168 h (hourly only)
    neighbour_prices: dict[str, str] = field(default_factory=dict)   # col -> name base (lag 24 h)
    load_lags: dict[str, str] = field(default_factory=dict)          # col -> name base (lag 48 h)
    consumption: tuple[str, str, str] | None = None  # (forecast col, actual col, error base), lag 48 h
    forecast_lags: tuple[str, ...] = ()      # forecast cols lagged 24 h
    weather: tuple[tuple[str, str, str, bool], ...] = ()  # (forecast col, actual col, base, is_direction)
    quarter_of_hour: bool = False

    def suffix(self, hours: int) -> str:
        return f"_lag_{hours}h" if self.steps_per_hour == 1 else f"_lag_{hours * self.steps_per_hour}qh"


def weather_pairs(catalog: Catalog) -> tuple[tuple[str, str, str, bool], ...]:
    """(forecast col, actual col, error base, is_direction), variable-major as in the contract."""
    out = []
    for var in catalog.weather_variables:
        for _reg, alias in catalog.weather_regions.items():
            base = f"{var}_{alias}"
            out.append((f"{base}_forecast", base, base, var in catalog.direction_variables))
    return tuple(out)


def _local_columns(df: DataFrame, spec: ContractSpec, tz: str) -> DataFrame:
    out = (df.where(F.col("resolution") == spec.resolution)
             .withColumn("local_timestamp", to_local("timestamp", tz))
             .withColumn("delivery_date", delivery_date("timestamp", tz)))
    if spec.quarter_of_hour:
        out = out.withColumn("quarter_of_hour", quarter_of_hour("local_timestamp"))
    return out


def _horizon(*by: str):
    return F.row_number().over(Window.partitionBy(*by, "delivery_date").orderBy("timestamp"))


def build_contract(features: DataFrame, spec: ContractSpec, method: str = "fanout",
                   tz: str = MARKET_TZ, materialize: bool = True) -> DataFrame:
    """I12/I13 from the wide feature table (``fct_ml_features``).

    The fan-out reads the base once and exchanges it once: its buckets are whole
    delivery days, so products are numbered where the lags are found. The
    self-joins read it once per offset; with ``materialize`` the base is then checkpointed into the shared
    checkpoint folder so the upstream DAG is not recomputed per consumer.
    """
    base = _local_columns(features, spec, tz)
    if method != "fanout":
        base = base.withColumn("horizon", _horizon())
        base = cut_lineage(base) if materialize else base
    # error terms are formed at the source row, then lagged (same as lagging both sides)
    err_cols = {}
    if spec.consumption:
        fc, act, name = spec.consumption
        err_cols["_err_consumption"] = F.col(fc) - F.col(act)
    for fc, act, b, _is_dir in spec.weather:
        err_cols[f"_err_{b}"] = F.col(fc) - F.col(act)
    base = base.select("*", *[e.alias(n) for n, e in err_cols.items()])

    lag24, lag48 = {spec.price: "_p24"}, {spec.price: "_p48"}
    for c, b in spec.neighbour_prices.items():
        lag24[c] = f"{b}_price{spec.suffix(24)}"
    for c in spec.forecast_lags:
        lag24[c] = f"{c}{spec.suffix(24)}"
    for c, b in spec.load_lags.items():
        lag48[c] = f"{b}{spec.suffix(48)}"
    for n in err_cols:
        lag48[n] = f"_l48{n}"
    lags = {24: lag24, 48: lag48}
    extra = [72, 96, 120, 144] if spec.same_hour_avg else []
    for h in sorted(set(spec.price_lags) | set(extra) | {168}):
        if h not in lags:
            lags[h] = {spec.price: f"_p{h}"}
    if method == "fanout":
        joined = lag_fanout(base, lags, day=lambda t: delivery_date(t, tz), bucket_col="_days").withColumn("horizon", _horizon("_days"))
    else:
        joined = lag_self_join(base, lags)

    cols = [F.col(c) for c in ["timestamp", "resolution"]]
    head = ["local_timestamp", "delivery_date"] if spec.quarter_of_hour else ["delivery_date", "local_timestamp"]
    cols += [F.col(c) for c in head] + [F.col("horizon")]
    if spec.quarter_of_hour:
        cols.append(F.col("quarter_of_hour"))
    cols += [F.col(spec.price)] + [F.col(c) for c in CALENDAR_COLUMNS]
    cols += [F.col(f"_p{h}").alias(f"price{spec.suffix(h)}") for h in spec.price_lags]
    if spec.same_hour_avg:
        cols.append(same_hour_average([f"_p{h}" for h in (24, 48, 72, 96, 120, 144, 168)])
                    .alias("price_rolling_avg_7d_same_hour"))
    cols += [F.col(f"{b}_price{spec.suffix(24)}") for b in spec.neighbour_prices.values()]
    # current weather forecasts; directions as sin/cos
    for fc, _act, _b, is_dir in spec.weather:
        if is_dir:
            r = F.radians(F.col(fc))
            cols += [F.sin(r).alias(f"{fc}_sin"), F.cos(r).alias(f"{fc}_cos")]
        else:
            cols.append(F.col(fc))
    cols += [F.col(f"{b}{spec.suffix(48)}") for b in spec.load_lags.values()]
    if spec.consumption:
        fc, _act, name = spec.consumption
        cols += [F.col(fc), F.col("_l48_err_consumption").alias(f"{name}{spec.suffix(48)}")]
    cols += [F.col(f"{c}{spec.suffix(24)}") for c in spec.forecast_lags]
    for _fc, _act, b, is_dir in spec.weather:
        e = F.col(f"_l48_err_{b}")
        if is_dir:
            r = F.radians(e)
            cols += [F.sin(r).alias(f"{b}_error_sin{spec.suffix(48)}"),
                     F.cos(r).alias(f"{b}_error_cos{spec.suffix(48)}")]
        else:
            cols.append(e.alias(f"{b}_error{spec.suffix(48)}"))
    return joined.select(*cols)


def hourly_spec(catalog: Catalog, load_lags: dict[str, str], consumption, forecast_lags) -> ContractSpec:
    return ContractSpec(
        resolution="hour", steps_per_hour=1,
        neighbour_prices={f"{a}_price_eur_mwh": a for a in catalog.neighbours.values()},
        load_lags=load_lags, consumption=consumption, forecast_lags=tuple(forecast_lags),
        weather=weather_pairs(catalog))


def quarter_hourly_spec(catalog: Catalog, load_lags: dict[str, str], consumption, forecast_lags) -> ContractSpec:
    return ContractSpec(
        resolution="quarterhour", steps_per_hour=4, same_hour_avg=False,
        neighbour_prices={f"{a}_price_eur_mwh": a for a in catalog.neighbours.values()},
        load_lags=load_lags, consumption=consumption, forecast_lags=tuple(forecast_lags),
        weather=weather_pairs(catalog), quarter_of_hour=True)


# Energy defaults (column lists of the platform's contracts).
ENERGY_LOAD_LAGS = {"residual_load_mw": "residual_load", "total_consumption_mw": "total_consumption",
                    "wind_onshore_mw": "wind_onshore", "wind_offshore_mw": "wind_offshore", "solar_mw": "solar"}
ENERGY_CONSUMPTION = ("total_consumption_forecast_mw", "total_consumption_mw", "total_consumption_error_mw")
ENERGY_FORECAST_LAGS_HOURLY = ("wind_offshore_forecast_mw", "solar_forecast_mw")
ENERGY_FORECAST_LAGS_QH = ("wind_onshore_forecast_mw", "wind_offshore_forecast_mw", "solar_forecast_mw",
                           "residual_load_forecast_mw")


def energy_spec(resolution: str = "hour") -> ContractSpec:
    """The platform's contract of a resolution."""
    if resolution == "hour":
        return hourly_spec(ENERGY, ENERGY_LOAD_LAGS, ENERGY_CONSUMPTION, ENERGY_FORECAST_LAGS_HOURLY)
    return quarter_hourly_spec(ENERGY, ENERGY_LOAD_LAGS, ENERGY_CONSUMPTION, ENERGY_FORECAST_LAGS_QH)
