"""Guards: exact types in lags, constant groups and bins, thresholds with equal integer parts, folder streams."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F


def test_lags_keep_every_digit(spark):
    from ampere.operators.lags import lag_fanout, row_lag_indexed
    t = dt.datetime(2024, 1, 1)
    big, exact = (1 << 53) + 1, Decimal("12345678901234567.89")
    df = spark.createDataFrame([(t, big, exact, "a", 1.5), (t + dt.timedelta(hours=1), 2, Decimal("1.00"), "b", 2.5)],
                               "timestamp timestamp, n long, d decimal(20,2), s string, x double")
    cols = {"n": "n1", "x": "x1", "d": "d1", "s": "s1"}
    for out in (lag_fanout(df, {1: cols, 2: {"s": "s2"}}), row_lag_indexed(df, {1: cols, 2: {"s": "s2"}})):
        r = out.orderBy("timestamp").collect()[1]
        assert (r.n1, r.d1, r.s1, r.x1, r.s2) == (big, exact, "a", 1.5, None)


def test_constant_groups_and_bins(spark):
    from ampere.functions.bins import equal_width_bins
    from ampere.operators.analysis import threshold_table
    from ampere.operators.metrics import report
    df = spark.createDataFrame([(1, 5.0, 4.0, 5.0)], "ts int, y double, pred double, ref double")
    r = report(df, [], "ts", "y", "pred", ref="ref", with_baseline=True).first()
    assert r.mae == 1.0 and r.r2 is None and r.mae_improvement_pct is None
    assert equal_width_bins(df, "y", 4).first()["bin"] == 0
    got = [(x.threshold, x.hours) for x in threshold_table(df.select((F.col("y") / 10).alias("v")), "v", [0.2, 0.7]).collect()]
    assert got == [(0.2, 1), (0.7, 0)]


def test_years_without_an_easter_date_raise(spark):
    import pytest
    from ampere.functions.calendar import easter_date, holiday_name
    last = easter_date(2199) + dt.timedelta(days=1)
    df = spark.createDataFrame([(1, last), (2, dt.date(1900, 4, 16)), (3, None)], "i int, d date")
    assert {r.i: r.h for r in df.select("i", holiday_name("d").alias("h")).collect()} == {1: "Ostermontag", 2: "Ostermontag", 3: None}
    with pytest.raises(Exception, match="no Easter date for year 2200"):
        spark.createDataFrame([(dt.date(2200, 4, 7),)], "d date").select(holiday_name("d")).collect()


def test_one_pass_routing_equals_one_filter_per_table(spark):
    from ampere.operators.staging import route_by_signal, routed
    routing = [("a", "x"), ("b", "x"), ("b", "y"), ("c", "z")]
    df = spark.createDataFrame([("a", 1), ("b", 2), ("b", 2), ("c", 3), ("d", 4), (None, 5)], "signal string, v int")
    want = sorted((r.signal, r.v, t) for t in "xyz" for r in route_by_signal(df, routing, t).collect())
    assert sorted(map(tuple, routed(df, routing).collect())) == want


def test_unparsable_rows_are_all_in_the_quarantine(spark, tmp_path):
    from ampere.queries import QUERIES
    rows = [(1, '{"k": 3}'), (2, "not json"), (3, None), (4, "{broken"), (5, '{"k": 7}')]
    spark.createDataFrame(rows, "event_id long, props string").write.parquet(f"{tmp_path}/events.parquet")
    good = {r.event_id for r in QUERIES["props_permissive_parse"](spark, str(tmp_path)).collect()}
    bad = {r.event_id: r["_corrupt_record"] for r in QUERIES["props_quarantine"](spark, str(tmp_path)).collect()}
    assert good == {1, 3, 5} and bad == {2: "not json", 4: "{broken"}


def test_streams_read_a_folder_table(spark, tmp_path):
    from ampere.queries import QUERIES
    src = "/root/testdata/sf0.001"
    spark.read.parquet(f"{src}/events.parquet").repartition(4).write.parquet(f"{tmp_path}/events.parquet")
    got = QUERIES["stream_upsert_available_now"](spark, str(tmp_path)).count()
    assert got == QUERIES["stream_upsert_available_now"](spark, src).count() > 0
