"""The inference frame of a target day, its fallback lags, and the selection of hours."""
import datetime as dt

import pytest
from pyspark.ml import Pipeline
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import LinearRegression
from pyspark.sql import functions as F

from ampere.plans import inference as IN

UTC = dt.timezone.utc
TODAY = dt.datetime(2024, 1, 1, tzinfo=UTC)
TOMORROW = dt.date(2024, 1, 2)


def hours(spark, start, n, value, name):
    return spark.createDataFrame([((start + dt.timedelta(hours=k)), value(k)) for k in range(n)], f"timestamp timestamp, {name} double")


@pytest.fixture(scope="module")
def observed(spark):
    return hours(spark, TODAY - dt.timedelta(days=20), 20 * 24 + 24, float, "price_eur_mwh")


@pytest.fixture(scope="module")
def forecast(spark):
    return hours(spark, TODAY - dt.timedelta(days=2), 24 * 6, lambda k: 1.0 * k, "wind_forecast")


def at(df, h):
    return df.where(F.col("timestamp") == F.lit(TODAY + dt.timedelta(hours=h))).first()


def test_frame_is_spliced_without_duplicates(observed, forecast):
    now = TODAY + dt.timedelta(hours=14)
    f = IN.inference_frame(observed, forecast, now, TOMORROW, ["wind_forecast"])
    ts = [r.timestamp for r in f.orderBy("timestamp").collect()]
    assert len(ts) == len(set(ts)) == 7 * 24 + 48 and ts[0] == dt.datetime(2023, 12, 25)
    assert at(f, 10).price_eur_mwh is not None and at(f, 10).wind_forecast is None and at(f, 10).observed
    assert at(f, 14).observed and not at(f, 15).observed and at(f, 15).price_eur_mwh is None
    # a naive "now" is UTC
    assert IN.inference_frame(observed, forecast, now.replace(tzinfo=None), TOMORROW, ["wind_forecast"]).count() == f.count()


def test_no_usable_forecast_raises(observed, forecast):
    with pytest.raises(IN.ForecastUnavailable, match="no forecast rows"):
        IN.inference_frame(observed, forecast.where("false"), TODAY, TOMORROW, ["wind_forecast"])
    with pytest.raises(IN.ForecastUnavailable, match="no forecast rows"):   # rows of today don't help tomorrow
        IN.inference_frame(observed, forecast.where(F.col("timestamp") < F.lit(TODAY + dt.timedelta(days=1))), TODAY, TOMORROW, ["wind_forecast"])
    with pytest.raises(IN.ForecastUnavailable, match="null"):
        IN.inference_frame(observed, forecast.withColumn("wind_forecast", F.lit(None).cast("double")), TODAY, TOMORROW, ["wind_forecast"])


def series(spark):
    """Hourly 0, 1, 2, ... for seven days up to TODAY, then unknown for three."""
    start = TODAY - dt.timedelta(days=7)
    return hours(spark, start, 169 + 72, lambda k: float(k) if k <= 168 else None, "v")


def test_price_lags_fall_back(spark):
    f = IN.price_lags(series(spark), "v")
    assert at(f, -1).price_24h_lag == 168 - 25
    assert at(f, 29).price_24h_lag == 168 + 29 - 48 == at(f, 29).price_48h_lag
    assert at(f, 53).price_24h_lag == 168 + 53 - 168 == at(f, 53).price_168h_lag
    assert at(f, -100).price_24h_lag == 168 - 124 and at(f, -150).price_168h_lag is None


def test_generation_lags_are_patched(spark):
    f = IN.patched_generation_lags(series(spark), "v")
    assert at(f, 53).v_lag_24 == at(f, 53).v_lag_168 == 53
    assert at(f, -1).v_lag_24 == 168 - 25 and at(f, -1).v_lag_168 is None


def fitted(df, feature, label):
    return Pipeline(stages=[VectorAssembler(inputCols=[feature], outputCol="v"),
                            LinearRegression(featuresCol="v", labelCol=label)]).fit(df)


def test_day_prediction_and_hours(spark, observed):
    lagged = IN.price_lags(observed, "price_eur_mwh").na.drop()
    model = fitted(lagged, "price_24h_lag", "price_eur_mwh")
    day = IN.predict_day(lagged, model, dt.date(2024, 1, 1))
    rows = IN.select_hours(day, TODAY, dt.date(2024, 1, 1)).orderBy("timestamp").collect()
    assert len(rows) == 24 and all(abs(r.pred - r.price_eur_mwh) < 1e-6 for r in rows)
    one = IN.select_hours(day, TODAY, dt.date(2024, 1, 1), hour=23).collect()
    assert [r.hour for r in one] == [23]
    late = IN.predict_day(lagged, model, dt.date(2023, 12, 31))
    assert [r.hour for r in IN.select_hours(late, TODAY - dt.timedelta(days=1), dt.date(2023, 12, 31), hour=0).collect()] == [0]
    with pytest.raises(ValueError, match="neither"):
        IN.select_hours(day, TODAY, dt.date(2024, 1, 3))
    with pytest.raises(ValueError, match="neither"):
        IN.select_hours(day, TODAY, dt.date(2023, 12, 31))
    with pytest.raises(ValueError, match="no hour"):
        IN.select_hours(day, TODAY, dt.date(2024, 1, 1), hour=24)
    with pytest.raises(ValueError, match="no prediction for hour 0"):
        IN.select_hours(day.where("hour > 0"), TODAY, dt.date(2024, 1, 1), hour=0)


def test_second_stage_adds_to_its_hour(spark, observed):
    lagged = IN.price_lags(observed, "price_eur_mwh").na.drop()
    s1 = IN.predict_day(lagged, fitted(lagged, "price_24h_lag", "price_eur_mwh"), dt.date(2024, 1, 1))
    quarters = s1.select(F.explode(F.sequence("timestamp", F.col("timestamp") + F.expr("INTERVAL 45 MINUTES"),
                                              F.expr("INTERVAL 15 MINUTES"))).alias("timestamp"))
    q = quarters.withColumn("x", F.minute("timestamp") * 1.0).withColumn("dev", F.col("x") / 15)
    out = IN.predict_day(q, fitted(q, "x", "dev"), dt.date(2024, 1, 1), stage1=s1).collect()
    assert len(out) == 4 * 24 and all(abs(r.pred - r.stage1_pred - r.dev) < 1e-6 for r in out)
