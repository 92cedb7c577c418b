"""Upsert, lags, pivots, calendar, time functions, bins, splits."""
import datetime as dt

import pytest
from pyspark.sql import functions as F

from ampere.config import ENERGY
from ampere.functions import calendar as CAL
from ampere.functions import time as TM
from ampere.functions.bins import equal_width_bins, fixed_bins
from ampere.operators import lags as LG
from ampere.operators import reshape as RS
from ampere.operators import splits as SP
from ampere.operators import staging as ST
from ampere.operators.merge import latest_per_key, merge_latest

T0 = dt.datetime(2024, 1, 15)
KEY = ["timestamp", "signal", "resolution"]
SCHEMA = "timestamp timestamp, signal string, value double, unit string, resolution string, fetched_at timestamp"


def rows_of(df):
    return sorted(tuple(r) for r in df.collect())


def test_merge_latest_delta_wins_and_is_idempotent(spark):
    base = spark.createDataFrame([(T0, "SOLAR", 1.0, "MW", "hour", T0), (T0, "WIND", 2.0, "MW", "hour", T0)], SCHEMA)
    older = T0 - dt.timedelta(days=1)
    delta = spark.createDataFrame([(T0, "SOLAR", 10.0, "GW", "hour", older),   # older than base, still wins
                                   (T0, "SOLAR", 11.0, "GW", "hour", older + dt.timedelta(hours=1)),  # in-batch dup
                                   (T0, "NEW", 3.0, "MW", "hour", T0)], SCHEMA)
    once = merge_latest(base, delta, KEY, ["fetched_at"], update_cols=["value", "fetched_at"])
    got = {r["signal"]: (r["value"], r["unit"]) for r in once.collect()}
    assert got == {"SOLAR": (11.0, "MW"), "WIND": (2.0, "MW"), "NEW": (3.0, "MW")}
    twice = merge_latest(once, delta, KEY, ["fetched_at"], update_cols=["value", "fetched_at"])
    assert rows_of(twice) == rows_of(once)


def test_latest_per_key_hot_key(spark):
    rows = [(T0, "HOT", float(i), "MW", "hour", T0 + dt.timedelta(seconds=i)) for i in range(3000)]
    rows += [(T0 + dt.timedelta(hours=i), "COLD", float(i), "MW", "hour", T0) for i in range(10)]
    df = spark.createDataFrame(rows, SCHEMA).repartition(8)
    out = latest_per_key(df, KEY, ["fetched_at"])
    assert out.count() == 11
    assert out.where("signal = 'HOT'").first()["value"] == 2999.0


def test_lag_fanout_equals_self_join(spark):
    rows = [(T0 + dt.timedelta(hours=i), float(i) if i % 5 else None) for i in range(400) if i % 7 != 3]
    df = spark.createDataFrame(rows, "timestamp timestamp, v double")
    lags = {24: {"v": "l24"}, 48: {"v": "l48"}, 168: {"v": "l168"}}
    a = rows_of(LG.lag_fanout(df, lags).select("timestamp", "v", "l24", "l48", "l168"))
    b = rows_of(LG.lag_self_join(df, lags).select("timestamp", "v", "l24", "l48", "l168"))
    assert a == b
    c = rows_of(LG.lag_range_window(df, lags).select("timestamp", "v", "l24", "l48", "l168"))
    assert c == a
    r = {x[0]: x for x in a}
    t = T0 + dt.timedelta(hours=50)
    assert r[t][2] == 26.0 and r[t][3] == 2.0


def test_lag_across_dst_is_absolute(spark):
    t = dt.datetime(2025, 3, 30, 12)
    df = spark.createDataFrame([(t - dt.timedelta(hours=24), 1.0), (t, 2.0)], "timestamp timestamp, v double")
    out = {r["timestamp"]: r["l"] for r in LG.lag_fanout(df, {24: {"v": "l"}}).collect()}
    assert out[t] == 1.0


def test_lag_with_fallback(spark):
    today = dt.datetime(2024, 1, 1)
    rows = [(today - dt.timedelta(hours=168 - i), float(i)) for i in range(169)]
    rows += [(today + dt.timedelta(hours=i), None) for i in range(1, 72)]
    df = spark.createDataFrame(rows, "timestamp timestamp, v double")
    out = {r["timestamp"]: r["fb"] for r in LG.lag_with_fallback(df, "v", [24, 48, 168], "fb").collect()}
    value_at = {t: v for t, v in rows}
    assert out[today - dt.timedelta(hours=1)] == value_at[today - dt.timedelta(hours=25)]
    assert out[today + dt.timedelta(hours=29)] == value_at[today - dt.timedelta(hours=19)]
    assert out[today + dt.timedelta(hours=53)] == value_at[today - dt.timedelta(hours=115)]


def test_same_hour_average_null_if_any_term_null(spark):
    df = spark.createDataFrame([(1.0, 2.0, None), (1.0, 2.0, 3.0)], "a double, b double, c double")
    assert [r["m"] for r in df.select(LG.same_hour_average(["a", "b", "c"]).alias("m")).collect()] == [None, 2.0]


def test_generation_validity_and_pivot(spark):
    cut = dt.datetime(2023, 4, 15)
    rows = [(T0, "SOLAR", -1.0, "MW", "hour"), (T0, "WIND_ONSHORE", 5.0, "MW", "hour"),
            (T0, "PUMPED_STORAGE", -3.0, "MW", "hour"), (T0, "NUCLEAR", 9.0, "MW", "hour"),
            (cut, "NUCLEAR", 9.0, "MW", "hour"), (T0, "BIOMASS", float("nan"), "MW", "hour")]
    raw = spark.createDataFrame(rows, "timestamp timestamp, signal string, value double, unit string, resolution string")
    st = ST.stage_generation(raw, ENERGY)
    assert sorted((r["signal_name"], r["timestamp"]) for r in st.collect()) == sorted(
        [("WIND_ONSHORE", T0), ("PUMPED_STORAGE", T0), ("NUCLEAR", cut)])
    wide = {r["timestamp"]: r for r in RS.pivot_generation_load(st, ENERGY).collect()}
    assert wide[T0]["total_generation_mw"] == 2.0 and wide[T0]["solar_mw"] is None
    assert wide[cut]["nuclear_mw"] == 9.0


def test_nan_becomes_null(spark):
    df = spark.createDataFrame([(float("nan"),), (1.0,)], "v double")
    assert [r[0] for r in df.select(ST.nan_to_null("v")).collect()] == [None, 1.0]


def test_calendar_iso_week_and_holidays(spark):
    days = spark.createDataFrame([(dt.date(2021, 1, 1),), (dt.date(2024, 3, 29),), (dt.date(2024, 5, 9),),
                                  (dt.date(2024, 12, 26),), (dt.date(2024, 12, 27),)], "date_day date")
    out = {r["date_day"]: r for r in CAL.date_dimension(days).collect()}
    assert out[dt.date(2021, 1, 1)]["week_of_year"] == 53 and out[dt.date(2021, 1, 1)]["day_of_week"] == 4
    assert out[dt.date(2024, 3, 29)]["holiday_name"] == "Karfreitag"
    assert out[dt.date(2024, 5, 9)]["holiday_name"] == "Christi Himmelfahrt"
    assert out[dt.date(2024, 12, 26)]["is_german_public_holiday"] and not out[dt.date(2024, 12, 26)]["is_workday"]
    assert out[dt.date(2024, 12, 27)]["is_workday"]


def test_holiday_rule_matches_seed_shape(spark):
    years = spark.range(2019, 2031).select(F.col("id").cast("int").alias("year"))
    h = CAL.holidays_for_years(years)
    assert h.count() == 108
    easter_mondays = {r["date"] for r in h.where("holiday_name = 'Ostermontag'").collect()}
    assert dt.date(2019, 4, 22) in easter_mondays and dt.date(2025, 4, 21) in easter_mondays


def test_local_time_repeated_autumn_hour(spark):
    df = spark.createDataFrame([(dt.datetime(2025, 10, 26, 0, 30),), (dt.datetime(2025, 10, 26, 1, 30),)], "t timestamp")
    got = [r[0] for r in df.select(TM.to_local("t")).collect()]
    assert got == [dt.datetime(2025, 10, 26, 2, 30)] * 2


def test_issue_timestamp_rule(spark):
    df = spark.createDataFrame([(dt.datetime(2025, 7, 10, 12), "TOTAL_CONSUMPTION_FC"),
                                (dt.datetime(2025, 1, 10, 12), "SOLAR_FC")], "t timestamp, s string")
    got = [r[0] for r in df.select(TM.issue_timestamp("t", "s")).collect()]
    assert got == [dt.datetime(2025, 7, 9, 8), dt.datetime(2025, 1, 9, 17)]


def test_fixed_bins_edges(spark):
    df = spark.createDataFrame([(-15.0,), (-13.0,), (35.0,), (36.0,)], "x double")
    idx, lo, hi = fixed_bins("x", -15.0, 35.0, 2.0)
    got = [r[0] for r in df.select(idx).collect()]
    assert got == [None, 0, 24, None]


def test_equal_width_bins_min_in_first_max_in_last(spark):
    df = spark.createDataFrame([(float(x),) for x in range(31)], "x double")
    b = {r["x"]: r["bin"] for r in equal_width_bins(df, "x", 30).collect()}
    assert b[0.0] == 0 and b[30.0] == 29 and b[1.0] == 0 and b[2.0] == 1


def test_ts_cv_folds_match_sklearn_rule(spark):
    n, k, gap = 20, 3, 2
    df = spark.createDataFrame([(T0 + dt.timedelta(hours=i),) for i in range(n)], "timestamp timestamp")
    f = SP.ts_cv_folds(df, k, gap).collect()
    t = n // (k + 1)
    for fold in range(1, k + 1):
        test_start = n - (k - fold + 1) * t
        test = sorted(r["row_idx"] for r in f if r["fold"] == fold and r["role"] == "test")
        train = sorted(r["row_idx"] for r in f if r["fold"] == fold and r["role"] == "train")
        assert test == list(range(test_start, test_start + t))
        assert train == list(range(0, test_start - gap))


def test_prediction_windows(spark):
    b = spark.createDataFrame([(dt.date(2025, 10, 1), dt.date(2026, 1, 1), dt.date(2026, 4, 1))],
                              "first_start date, holdout_start date, holdout_end date")
    w = SP.prediction_windows(b).orderBy("start").collect()
    assert w[0]["start"] == dt.date(2025, 10, 1) and w[1]["start"] == dt.date(2025, 10, 6)
    assert sum(1 for r in w if r["in_holdout"]) == 14
    assert w[-1]["end"] == dt.date(2026, 4, 1)
    assert all(a["end"] == b_["start"] for a, b_ in zip(w, w[1:]))


def test_easter_python_rule_equals_spark_rule(spark):
    years = spark.range(1900, 2200).select(F.col("id").cast("int").alias("y"))
    got = {r["y"]: r["e"] for r in years.select("y", CAL.easter_sunday("y").alias("e")).collect()}
    assert all(got[y] == CAL.easter_date(y) for y in CAL.EASTER_YEARS)
    assert CAL.easter_date(2024) == dt.date(2024, 3, 31) and CAL.easter_date(2019) == dt.date(2019, 4, 21)


def test_first_wins_batch_twin_and_epoch(spark):
    from ampere.operators.merge import drop_revisions_first_wins
    rows = [(T0, "S", 1.0, "MW", "hour", T0 + dt.timedelta(minutes=5)),
            (T0, "S", 2.0, "MW", "hour", T0 + dt.timedelta(minutes=1))]
    df = spark.createDataFrame(rows, SCHEMA)
    first = drop_revisions_first_wins(df, KEY, ["fetched_at"]).first()
    latest = latest_per_key(df, KEY, ["fetched_at"]).first()
    assert first["value"] == 2.0 and latest["value"] == 1.0
    ms = spark.createDataFrame([(1705276800000,)], "ms long").select(TM.epoch_ms_to_ts("ms").alias("t")).first()["t"]
    assert ms == dt.datetime(2024, 1, 15)


def test_live_forecast_stamp(spark):
    from ampere.sources.payloads import live_forecast_stamp
    df = spark.createDataFrame([(dt.datetime(2024, 1, 15, 13),)], "timestamp timestamp")
    r = live_forecast_stamp(df).first()
    assert r["issue_timestamp"] == dt.datetime(2024, 1, 15) and r["fetched_at"] is not None


def test_dynamic_pivot_rejects_duplicates(spark):
    ok = spark.createDataFrame([(T0, "A", 1.0), (T0, "B", 2.0)], "timestamp timestamp, s string, v double")
    r = RS.pivot_dynamic(ok, ["timestamp"], "s", "v").first()
    assert r["A"] == 1.0 and r["B"] == 2.0
    dup = spark.createDataFrame([(T0, "A", 1.0), (T0, "A", 3.0)], "timestamp timestamp, s string, v double")
    with pytest.raises(ValueError):
        RS.pivot_dynamic(dup, ["timestamp"], "s", "v")


def test_row_lag_indexed_equals_window_shift(spark):
    rows = [(T0 + dt.timedelta(hours=i * (1 + (i % 3 == 0))), float(i) if i % 4 else None) for i in range(200)]
    df = spark.createDataFrame(rows, "timestamp timestamp, v double").withColumn("k", F.lit("s"))
    a = LG.row_lag(LG.row_lag(df, "v", 24, "l24", partition=["k"]), "v", 1, "l1", partition=["k"])
    b = LG.row_lag_indexed(df, {24: {"v": "l24"}, 1: {"v": "l1"}}, partition=["k"])
    cols = ["timestamp", "v", "l24", "l1"]
    assert sorted(tuple(r) for r in a.select(*cols).collect()) == sorted(tuple(r) for r in b.select(*cols).collect())
