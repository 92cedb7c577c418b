import datetime as dt

import pytest
from pyspark.sql import functions as F

from ampere.functions.output import read_ordered, rounded, write_ordered
from ampere.operators import metrics as MT
from ampere.plans.products import qualified_name, schema_name
from ampere.sources import payloads as PL
from ampere.sources import reads as RD


def test_numbers_from_text(spark):
    texts = ["1", " 2.5 ", "-3e2", "", None, "n/a", "1,5", "4f", "4.0D", ".5", "0x10"]
    got = [r[0] for r in spark.createDataFrame([(t,) for t in texts], "t string").select(PL.to_number(F.col("t"))).collect()]
    assert got == [1.0, 2.5, -300.0, None, None, None, None, None, None, 0.5, None]


def test_stamped_series(spark):
    rows = spark.createDataFrame([("A", 1.0), ("B", None), ("C", 2.0), (None, 3.0)], "signal string, value double")
    got = {(r.signal, r.unit, r.resolution) for r in PL.stamp_series(rows, {"A": "MW", "B": "EUR/MWh"}, "hour").collect()}
    assert got == {("A", "MW", "hour"), ("B", "EUR/MWh", "hour"), ("C", None, "hour"), (None, None, "hour")}
    assert {r.unit for r in PL.stamp_series(rows, {}, "hour").collect()} == {None}


def test_written_order_is_read_back(spark, tmp_path):
    df = spark.range(50_000).select((F.col("id") * 7919 % 50_000).alias("a"), (F.col("id") % 3).alias("b")).repartition(13)
    df = df.unionByName(spark.createDataFrame([(None, 1), (None, 2)], "a long, b long"))
    path = str(tmp_path / "t")
    write_ordered(df, path, ["a", "b"])
    got = sorted((r.position, r.a) for r in read_ordered(spark, path).collect())
    assert [p for p, _ in got] == list(range(50_002))
    assert [a for _, a in got] == [None, None, *range(50_000)]
    empty = str(tmp_path / "e")
    write_ordered(df.where("false"), empty, ["a"])
    assert read_ordered(spark, empty).count() == 0


def test_rounding_takes_halves_to_even(spark):
    df = spark.createDataFrame([(0.5, 2.675), (1.5, -0.125), (None, 0.125)], "x double, y double")
    assert [r.x for r in df.select(*rounded(["x"], 0)).collect()] == [0.0, 2.0, None]
    assert [r.y for r in df.select(*rounded(["y"], 2)).collect()][1:] == [-0.12, 0.12]


def test_day_is_a_pushed_range_with_its_own_hours(spark, tmp_path):
    hours = spark.range(0, 24 * 200).select(F.timestamp_seconds(F.lit(1704067200) + F.col("id") * 3600).alias("timestamp"))
    hours.write.parquet(str(tmp_path / "h"))
    stored = spark.read.parquet(str(tmp_path / "h"))
    for day, n in [("2024-03-31", 23), ("2024-03-30", 24), ("2024-01-01", 23)]:   # the first day begins an hour before the rows
        got = stored.where(RD.on_day(F.col("timestamp"), day, "Europe/Berlin"))
        local = stored.where(F.to_date(F.from_utc_timestamp("timestamp", "Europe/Berlin")) == F.lit(day).cast("date"))
        assert got.count() == n == local.count()
    plan = got._jdf.queryExecution().explainString(got._sc._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
    assert "GreaterThanOrEqual(timestamp" in plan and "LessThan(timestamp" in plan
    assert stored.where(RD.on_day(F.col("timestamp"), "2024-02-01")).count() == 24


def test_model_report_has_only_the_fields_given(spark):
    rows = [("m", i, dt.datetime(2024, 1, 1, i), float(y), float(p), float(r)) for i, (y, p, r) in
            enumerate([(10, 11, 8), (20, 18, 10), (0, 1, 20), (30, 30, 0)])]
    df = spark.createDataFrame(rows, "model string, n long, timestamp timestamp, y double, pred double, ref double")
    short = MT.model_report(df, ["model"], "timestamp", "y", "pred", "ref", {"depth": 3}).first().report.asDict(True)
    assert sorted(short) == ["hyperparameters", "metrics", "n_holdout"]
    assert short["n_holdout"] == 4 and short["hyperparameters"] == {"depth": 3}
    hold, base = short["metrics"]["holdout"], short["metrics"]["baseline_persistence"]
    assert hold["mae"] == pytest.approx(1.0) and base["mae"] == pytest.approx((2 + 10 + 20 + 30) / 4)
    assert hold["mape"] == pytest.approx(100 * (1 / 10 + 2 / 20 + 0) / 3)
    full = MT.model_report(df, ["model"], "timestamp", "y", "pred", "ref", {"depth": 3}, n_train="n", n_features=7, cv_mae=1.5,
                           source={"version": "latest"}, artifacts={"model": "a/b"}).first().report.asDict(True)
    assert {k: full[k] for k in ("n_train", "n_features", "cv_mae")} == {"n_train": 3, "n_features": 7, "cv_mae": 1.5}
    assert full["hyperparameters_source"] == {"version": "latest"} and full["artifacts"] == {"model": "a/b"}


def test_schema_names():
    assert schema_name(None, "raw") == "raw" and schema_name(" staging ", "raw") == "staging"
    assert qualified_name("stg_prices") == "staging.stg_prices" and qualified_name("dim_date") == "analytics.dim_date"
    assert qualified_name("prices") == "raw.prices" and qualified_name("prices", "landing") == "landing.prices"
