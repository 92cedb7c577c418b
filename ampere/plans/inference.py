"""Forecast of one delivery day from observed history and landed forecasts."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from zoneinfo import ZoneInfo

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ampere.config import MARKET_TZ
from ampere.functions.time import delivery_date, to_local
from ampere.operators.lags import lag_with_fallback

#: Hours back that stand in for each other, in this order, where the nearer one is not observed yet.
PRICE_LAGS = (24, 48, 168)
BUFFER_DAYS = 7


class ForecastUnavailable(ValueError):
    """No usable forecast rows for the target day."""


def local_day(now: dt.datetime, tz: str = MARKET_TZ) -> dt.date:
    """The market's day at an instant (naive: UTC)."""
    return (now if now.tzinfo else now.replace(tzinfo=dt.timezone.utc)).astimezone(ZoneInfo(tz)).date()


def tomorrow(now: dt.datetime, tz: str = MARKET_TZ) -> dt.date:
    return local_day(now, tz) + dt.timedelta(days=1)


def inference_frame(observed: DataFrame, forecast: DataFrame, now: dt.datetime, target: dt.date, forecast_cols: Sequence[str],
                    ts: str = "timestamp", buffer_days: int = BUFFER_DAYS) -> DataFrame:
    """Observed rows of the last days up to ``now``, then forecast rows to the end of the target day (UTC).

    The buffer starts at the midnight ``buffer_days`` before today's. Both
    sides are bounded on ``ts`` itself, so the bounds reach a scan, and
    disjoint, so no instant comes twice. Columns of the other side are null;
    ``observed`` tells the sides apart. Raises :class:`ForecastUnavailable` if
    the target day has no forecast rows or all its ``forecast_cols`` are null.
    """
    day = lambda d: F.lit(dt.datetime.combine(d, dt.time(), dt.timezone.utc))
    today = (now if now.tzinfo else now.replace(tzinfo=dt.timezone.utc)).astimezone(dt.timezone.utc)
    at = F.lit(today)
    past = observed.where((F.col(ts) >= day(today.date() - dt.timedelta(days=buffer_days))) & (F.col(ts) <= at))
    ahead = forecast.where((F.col(ts) > at) & (F.col(ts) < day(target + dt.timedelta(days=1))))
    usable = F.coalesce(*[F.col(c) for c in forecast_cols]).isNotNull()
    on_day = ahead.where(F.col(ts) >= day(target)).agg(F.count(F.lit(1)).alias("n"), F.count_if(usable).alias("known")).first()
    if not on_day["n"]:
        raise ForecastUnavailable(f"no forecast rows for {target}")
    if not on_day["known"]:
        raise ForecastUnavailable(f"all forecast columns are null for {target}")
    return (past.withColumn("observed", F.lit(True))
            .unionByName(ahead.withColumn("observed", F.lit(False)), allowMissingColumns=True))


def price_lags(frame: DataFrame, price: str, ts: str = "timestamp", horizons: Sequence[int] = PRICE_LAGS) -> DataFrame:
    """``price_{h}h_lag`` for every horizon: the price ``h`` hours back, else that of the longer horizons."""
    for k, h in enumerate(horizons):
        frame = lag_with_fallback(frame, price, horizons[k:], f"price_{h}h_lag", ts)
    return frame


def patched_generation_lags(frame: DataFrame, source: str, ts: str = "timestamp") -> DataFrame:
    """``{source}_lag_24`` takes ``{source}_lag_168`` where the day before is not observed."""
    frame = lag_with_fallback(frame, source, [168], f"{source}_lag_168", ts)
    return lag_with_fallback(frame, source, [24, 168], f"{source}_lag_24", ts)


def predict_day(frame: DataFrame, model: PipelineModel, target: dt.date, ts: str = "timestamp", tz: str = MARKET_TZ,
                stage1: DataFrame | None = None) -> DataFrame:
    """The frame's rows of the target day (market time) with ``hour`` and ``pred``.

    With ``stage1(timestamp, pred)`` the rows are quarter-hours and the model's
    value is a deviation from their hour's prediction (J13).
    """
    rows = frame.where(delivery_date(ts, tz) == F.lit(target))
    out = model.transform(rows).withColumn("hour", F.hour(to_local(ts, tz)))
    if stage1 is None:
        return out.withColumn("pred", F.col("prediction")).drop("prediction")
    hours = stage1.select(F.col(ts).alias("_h"), F.col("pred").alias("stage1_pred"))
    out = out.join(hours, F.date_trunc("HOUR", F.col(ts)) == F.col("_h"), "left").drop("_h")
    return out.withColumn("pred", F.col("stage1_pred") + F.col("prediction")).drop("prediction")


def select_hours(predictions: DataFrame, now: dt.datetime, target: dt.date, hour: int | None = None,
                 tz: str = MARKET_TZ) -> DataFrame:
    """All hours of the target day, or one (0 is one); today and tomorrow can be asked for.

    Raises ``ValueError`` for another day, an impossible hour, or an hour that
    the predictions don't have.
    """
    if target not in (local_day(now, tz), tomorrow(now, tz)):
        raise ValueError(f"{target} is neither today nor tomorrow")
    if hour is None:
        return predictions
    if not 0 <= hour <= 23:
        raise ValueError(f"{hour} is no hour of a day")
    out = predictions.where(F.col("hour") == hour)
    if not out.head(1):
        raise ValueError(f"no prediction for hour {hour} of {target}")
    return out
