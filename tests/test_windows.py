"""Bounded forward fill, bucketed forms, rolling mean, complete days, horizon."""
import datetime as dt

import pytest
from pyspark.sql import functions as F

from ampere.operators import windows as WN

START = dt.datetime(2024, 1, 1)


def series(spark, values, step_h=1, key="s"):
    rows = [(key, START + dt.timedelta(hours=i * step_h), None if v is None else float(v)) for i, v in enumerate(values)]
    return spark.createDataFrame(rows, "k string, timestamp timestamp, v double")


def col(df, c="v"):
    return [r[c] for r in df.orderBy("timestamp").collect()]


def test_ffill_limit3_fixture(spark):
    df = series(spark, [1, None, None, None, None, None, 2, None, 3])
    expect = [1, 1, 1, 1, None, None, 2, 2, 3]
    assert col(WN.forward_fill(df, ["v"], partition=["k"], limit=3)) == expect


@pytest.mark.parametrize("bucket_hours", [1, 2, 5, 24])
def test_bucketed_ffill_equals_global_any_sparsity(spark, bucket_hours):
    vals = [1, None, None, None, None, 2, None, None, None, None, None, 7, None, 4, None, None]
    df = series(spark, vals)
    b = F.floor(F.unix_seconds("timestamp") / (bucket_hours * 3600))
    g = col(WN.forward_fill(df, ["v"], partition=["k"], limit=3))
    assert col(WN.forward_fill_bucketed(df, ["v"], partition=["k"], limit=3, bucket=b)) == g


def test_previous_row_bucketed(spark):
    df = series(spark, [5, 6, None, 8, 9])
    b = F.floor(F.unix_seconds("timestamp") / 7200)
    out = col(WN.previous_row_bucketed(df, ["v"], partition=["k"], bucket=b), "prev_v")
    assert out == [None, 5, 6, None, 8]


def test_rolling_mean_bucketed_equals_plain(spark):
    vals = [float(i % 7) for i in range(24 * 20)]
    df = series(spark, vals)
    a = col(WN.rolling_mean(df, "v", "m", 7 * 86400, partition=["k"]), "m")
    b = col(WN.rolling_mean_bucketed(df, "v", "m", 7 * 86400, partition=["k"]), "m")
    assert a == pytest.approx(b)


def test_complete_days_only_nulls_count(spark):
    rows = [("s", dt.datetime(2024, 1, 1, h), 1.0 if h != 5 else None) for h in range(0, 10)]
    rows += [("s", dt.datetime(2024, 1, 3, h), 2.0) for h in range(0, 3)]  # missing rows do not count
    df = spark.createDataFrame(rows, "k string, timestamp timestamp, v double")
    out = WN.complete_days(df, ["v"], day=F.to_date("timestamp"))
    assert {r["timestamp"].date() for r in out.collect()} == {dt.date(2024, 1, 3)}


@pytest.mark.parametrize("day,n", [("2025-03-30", 23), ("2025-10-26", 25), ("2025-06-01", 24)])
def test_horizon_dst_days(spark, day, n):
    # all UTC hours that fall on the given Berlin day
    d = dt.datetime.fromisoformat(day)
    rows = [(d - dt.timedelta(hours=3) + dt.timedelta(hours=i),) for i in range(30)]
    df = spark.createDataFrame(rows, "timestamp timestamp")
    h = WN.horizon(df).where(F.col("delivery_date") == F.lit(day).cast("date"))
    got = sorted(r["horizon"] for r in h.collect())
    assert got == list(range(1, n + 1))


def test_time_spine_fills_gaps(spark):
    df = series(spark, [1, 2, 3]).where(F.col("v") != 2)
    s = WN.on_spine(df, "timestamp", "1 hour", ["k"])
    assert col(s) == [1, None, 3]
