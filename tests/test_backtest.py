"""Expanding-window Gram backtest equals a brute-force per-window refit."""
import datetime as dt
import math

import numpy as np
import pytest

from ampere.plans import backtest as BT
from ampere.operators import splits as SP


def test_expanding_fit_matches_bruteforce(spark):
    rng = np.random.default_rng(7)
    t0 = dt.datetime(2024, 1, 1)
    n = 24 * 28
    x1 = rng.normal(size=n)
    x2 = rng.normal(size=n)
    y = 3.0 + 2.0 * x1 - 1.5 * x2 + rng.normal(scale=0.1, size=n)
    rows = [(t0 + dt.timedelta(hours=i), float(x1[i]), float(x2[i]), float(y[i])) for i in range(n)]
    df = spark.createDataFrame(rows, "timestamp timestamp, x1 double, x2 double, y double")
    b = spark.createDataFrame([(dt.date(2024, 1, 8), dt.date(2024, 1, 22), dt.date(2024, 1, 29))],
                              "first_start date, holdout_start date, holdout_end date")
    win = SP.prediction_windows(b)
    out = BT.expanding_fit_predict(df, win, ["x1", "x2"], "y", ridge=0.0).collect()
    starts = {r["window_id"]: r["start"] for r in win.collect()}
    X = np.c_[np.ones(n), x1, x2]
    days = np.array([(t0 + dt.timedelta(hours=i)).date() for i in range(n)])
    for r in out:
        train = days < starts[r["window_id"]]
        beta = np.linalg.lstsq(X[train], y[train], rcond=None)[0]
        i = int((r["timestamp"] - t0).total_seconds() // 3600)
        assert r["pred"] == pytest.approx(float(X[i] @ beta), rel=1e-6, abs=1e-6)
        assert r["n_train"] == int(train.sum())


def test_two_stage_acceptance_on_seasonal_series(spark):
    """No leakage, reconstruction identity, and better than persistence."""
    from pyspark.sql import functions as F
    rng = np.random.default_rng(3)
    t0 = dt.datetime(2024, 1, 1)
    n_h = 24 * 35
    hours = [t0 + dt.timedelta(hours=i) for i in range(n_h)]
    base = [50 + 20 * math.sin(2 * math.pi * (i % 24) / 24) + rng.normal(scale=2) for i in range(n_h)]
    h_rows = [(t, float(b), float(base[i - 24]) if i >= 24 else None, math.sin(2 * math.pi * (i % 24) / 24),
               math.cos(2 * math.pi * (i % 24) / 24)) for i, (t, b) in enumerate(zip(hours, base))]
    hourly = spark.createDataFrame(h_rows, "timestamp timestamp, price_eur_mwh double, lag24 double, hs double, hc double")
    q_rows = []
    for i, t in enumerate(hours):
        for q in range(4):
            qs = t + dt.timedelta(minutes=15 * q)
            q_rows.append((qs, base[i] + 5.0 * (q - 1.5) + rng.normal(scale=0.5),
                           math.sin(2 * math.pi * q / 4), math.cos(2 * math.pi * q / 4)))
    quarter = spark.createDataFrame(q_rows, "timestamp timestamp, price_eur_mwh double, qs double, qc double")
    b = spark.createDataFrame([(dt.date(2024, 1, 8), dt.date(2024, 1, 29), dt.date(2024, 2, 5))],
                              "first_start date, holdout_start date, holdout_end date")
    win = SP.prediction_windows(b)
    s1, s2 = BT.two_stage(hourly, quarter, win, ["lag24", "hs", "hc"], ["qs", "qc"])
    starts = {r["window_id"]: r["start"] for r in win.collect()}
    # no leakage: a window's training rows all precede its start
    h_rows_before = {w: sum(1 for r in h_rows if r[2] is not None and r[0].date() < s) for w, s in starts.items()}
    for r in s1.select("window_id", "n_train").distinct().collect():
        assert r["n_train"] == h_rows_before[r["window_id"]]
    rows = s2.collect()
    # reconstruction identity: final = stage 1 + stage 2 deviation prediction
    scored = [r for r in rows if r["pred"] is not None]
    assert scored and all(abs(r["pred"] - (r["stage1_pred"] + r["stage2_pred"])) < 1e-9 for r in scored)
    assert max(abs(r["stage2_pred"]) for r in scored) > 1.0   # the deviation model is not trivially zero
    s1r = [r for r in s1.collect() if r["pred"] is not None]
    mae = sum(abs(r["pred"] - r["price_eur_mwh"]) for r in s1r) / len(s1r)
    pers = sum(abs(r["lag24"] - r["price_eur_mwh"]) for r in s1r) / len(s1r)
    assert mae < pers
    q_mae = np.mean([abs(r["pred"] - r["price_eur_mwh"]) for r in rows if r["pred"] is not None])
    q_s1 = np.mean([abs(r["stage1_pred"] - r["price_eur_mwh"]) for r in rows if r["pred"] is not None])
    assert q_mae < q_s1   # Stage 2 improves on broadcasting the hourly forecast


def test_window_status_and_rows_without_target(spark):
    """Every window has a state; a row without a target is predicted, one without a feature stays with a null."""
    d = dt.date(2024, 1, 1)
    win = spark.createDataFrame([(1, d, d + dt.timedelta(7), False), (2, d + dt.timedelta(7), d + dt.timedelta(14), False),
                                 (3, d + dt.timedelta(14), d + dt.timedelta(21), True),
                                 (4, d + dt.timedelta(21), d + dt.timedelta(28), True)],
                                "window_id int, start date, end date, in_holdout boolean")
    days = [(dt.datetime(2024, 1, 1) + dt.timedelta(days=i), d + dt.timedelta(i), float(i), 2.0 * i) for i in range(28)]
    days[20] = (*days[20][:3], None)
    days[21] = (*days[21][:2], None, 42.0)
    h = spark.createDataFrame(days, "timestamp timestamp, delivery_date date, x double, y double")
    q = h.where("delivery_date not between '2024-01-08' and '2024-01-14'")
    status = BT.window_status(win, h, q)
    assert {r["window_id"]: r["status"] for r in status.collect()} == {
        1: "before_data", 2: "no_quarter_rows", 3: "no_stage2_training", 4: "predicted"}
    with pytest.raises(ValueError, match="2024-01-15"):
        BT.two_stage(h, q, win, ["x"], ["x"], y="y", day="delivery_date", status=status)
    out = {r["delivery_date"]: r for r in BT.expanding_fit_predict(h, win, ["x"], "y", ridge=0.0,
                                                                   day="delivery_date").collect()}
    assert len(out) == 28 and out[days[20][1]]["pred"] == pytest.approx(40.0)
    assert out[days[21][1]]["pred"] is None and out[days[22][1]]["n_train"] == 20
