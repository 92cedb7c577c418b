import datetime as dt

import pytest
from pyspark.sql import functions as F

from ampere.functions import calendar as CAL
from ampere.operators import analysis as AN
from ampere.sources import payloads as PL


def test_sample_depends_on_keys_alone(spark):
    df = spark.range(20_000).select((F.col("id") * 3 - 7).alias("k"), (F.col("id") % 5).alias("v"))
    a = {r.k for r in AN.sample_by_key(df.repartition(7), "k", 0.1, seed=3).collect()}
    b = {r.k for r in AN.sample_by_key(df.unionByName(df).repartition(2), "k", 0.1, seed=3).collect()}
    assert a == b and 1_500 < len(a) < 2_500
    other = {r.k for r in AN.sample_by_key(df, "k", 0.1, seed=4_000).collect()}
    assert other != a
    assert AN.sample_by_key(df, "k", 0.0).count() == 0 and AN.sample_by_key(df, "k", 1.0).count() == 20_000


def test_sample_takes_any_long_and_leaves_nulls_out(spark):
    df = spark.createDataFrame([(2 ** 63 - 1,), (-2 ** 63,), (0,), (None,)], "k long")
    assert {r.k for r in AN.sample_by_key(df, "k", 1.0, seed=-5).collect()} == {2 ** 63 - 1, -2 ** 63, 0}
    with pytest.raises(ValueError):
        AN.sample_by_key(df, "k", 1.5)


def test_calendar_join_keeps_days_outside_as_null(spark):
    t = spark.createDataFrame([("2024-01-01 05:00:00",), ("2024-01-02 23:59:59",), ("2024-03-01 00:00:00",), (None,)], "s string")
    facts = t.select(F.col("s").cast("timestamp").alias("timestamp"))
    dim = CAL.dimension_for(facts.where("timestamp < '2024-02-01'"))
    got = {r.timestamp: (r.date_day, r.holiday_name, r.is_workday) for r in CAL.calendar_join(facts, dim).collect()}
    assert got[dt.datetime(2024, 1, 1, 5)][2] is False and got[dt.datetime(2024, 1, 1, 5)][1]
    assert got[dt.datetime(2024, 1, 2, 23, 59, 59)] == (dt.date(2024, 1, 2), None, True)
    assert got[dt.datetime(2024, 3, 1)] == (None, None, None) and got[None] == (None, None, None)


def test_live_forecast_stamp(spark):
    df = spark.createDataFrame([("2024-05-05 13:00:00", 1.0)], "s string, value double").select(
        F.col("s").cast("timestamp").alias("timestamp"), "value")
    at = F.lit("2024-05-05 09:30:00").cast("timestamp")
    row = PL.live_forecast_stamp(df, now=at).first()
    assert row.fetched_at == dt.datetime(2024, 5, 5, 9, 30) and row.issue_timestamp == dt.datetime(2024, 5, 5)
    assert PL.live_forecast_stamp(df).first().fetched_at is not None
