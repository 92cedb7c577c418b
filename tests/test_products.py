"""Energy contracts by name, the incremental build, published versions, calendars with empty bins, report flags."""
import datetime as dt
import os
import tempfile

import pytest
from pyspark.ml import PipelineModel
from pyspark.sql import functions as F

from ampere import bindings as B
from ampere.config import ENERGY
from ampere.operators import analysis as AN
from ampere.operators import metrics as MT
from ampere.plans.contracts import build_contract, energy_spec
from ampere.plans.models import split_features_target
from ampere.plans.products import Warehouse, refresh
from ampere.sources import artifacts as AR

SF = "/root/testdata/sf0.001"


def raw_tables(spark, source="orders"):
    from ampere.queries import _build_warehouse
    return _build_warehouse(spark, SF, "hour", source)


@pytest.mark.parametrize("resolution, features", [("hour", 73), ("quarterhour", 75)])
def test_energy_contract_by_name(spark, resolution, features):
    wh = Warehouse(spark, raw_tables(spark, "energy").raw, ENERGY)
    c = build_contract(wh.fct_ml_features, energy_spec(resolution), materialize=False)
    names, _ = split_features_target(c, "price_eur_mwh")
    assert len(names) == features            # with the six calendar encodings: 79 and 81
    lag = ("_lag_24h", "_lag_48h") if resolution == "hour" else ("_lag_96qh", "_lag_192qh")
    wanted = {f"denmark_2_price{lag[0]}", f"solar{lag[1]}", f"total_consumption_error_mw{lag[1]}", f"solar_forecast_mw{lag[0]}",
              f"wind_direction_100m_bawue_error_cos{lag[1]}", "wind_direction_100m_schleswig_forecast_sin"}
    assert wanted <= set(names) and len(set(c.columns)) == len(c.columns)
    assert ("quarter_of_hour" in names) == (resolution != "hour")
    assert (f"residual_load_forecast_mw{lag[0]}" in names) == (resolution != "hour")


def files_of(path):
    return {os.path.join(d, f): os.stat(os.path.join(d, f)).st_mtime_ns for d, _, fs in os.walk(path) for f in fs if f.endswith(".parquet")}


def test_refresh_rewrites_what_a_day_reaches(spark):
    from ampere.queries import HOURLY
    root = tempfile.mkdtemp(prefix="products-", dir="/tmp")
    wh = raw_tables(spark)
    first = refresh(spark, wh.raw, wh.catalog, root, {"contract": HOURLY})
    assert len(first["fct_market_prices"]) == 14
    before = files_of(root)
    day = dt.date(2024, 1, 6)
    raw = {k: v.withColumn("value", F.col("value") + F.when(F.to_date("timestamp") == F.lit(day), 1.0).otherwise(0.0))
           for k, v in wh.raw.items()}
    raw["prices"] = raw["prices"].where("not (timestamp >= '2024-01-06 05:00:00' and timestamp < '2024-01-07')")
    written = refresh(spark, raw, wh.catalog, root, {"contract": HOURLY}, [day])
    assert all(v == [day] for k, v in written.items() if k != "contract")
    assert written["contract"] == [day + dt.timedelta(days=k) for k in range(-1, 8)]
    same = {p for p, t in files_of(root).items() if before.get(p) == t}
    touched = {p.split("day=")[1][:10] for p in before if p not in same and "/contract/" not in p}
    assert touched == {"2024-01-06"}
    whole = tempfile.mkdtemp(prefix="products-", dir="/tmp")
    refresh(spark, raw, wh.catalog, whole, {"contract": HOURLY})
    for name in ("fct_ml_features", "fct_price_spreads", "contract"):
        a, b = (spark.read.parquet(f"{r}/{name}") for r in (root, whole))
        assert a.count() == b.count() and a.exceptAll(b.select(*a.columns)).count() == 0
    # a day whose rows all go leaves no partition
    gone = {k: v.where(F.to_date("timestamp") != F.lit(day)) for k, v in raw.items()}
    refresh(spark, gone, wh.catalog, root, {"contract": HOURLY}, [day])
    assert spark.read.parquet(f"{root}/fct_market_prices").where(F.col("day") == F.lit(day)).count() == 0


def test_latest_is_published_by_manifest(spark):
    root = tempfile.mkdtemp(prefix="versions-", dir="/tmp")
    runs = spark.sparkContext.accumulator(0)

    def once(batches):
        for b in batches:
            runs.add(len(b))
            yield b

    df = spark.range(3).mapInPandas(once, "id long")
    a = AR.save_versioned(df, root, "params", dt.datetime(2026, 1, 1))
    assert runs.value == 3                                       # the plan ran once
    assert AR.latest_version(spark, root, "params") == a == "20260101-000000"
    b = AR.save_versioned(spark.range(5), root, "params", dt.datetime(2026, 1, 2))
    assert AR.load_versioned(spark, root, "params").count() == 5 and AR.load_versioned(spark, root, "params", a).count() == 3
    with pytest.raises(FileExistsError):
        AR.save_versioned(spark.range(1), root, "params", dt.datetime(2026, 1, 2))
    with pytest.raises(Exception):                               # a failing write leaves the old version published
        AR.save_versioned(spark.range(1).select(F.raise_error(F.lit("no"))), root, "params", dt.datetime(2026, 1, 3))
    assert AR.latest_version(spark, root, "params") == b
    with pytest.raises(ValueError):
        AR.load_versioned(spark, root, "params", "newest")
    assert PipelineModel is not None


def test_resample_with_empty_bins(spark):
    rows = [("a", dt.datetime(2024, 1, 30), 1.0), ("a", dt.datetime(2024, 2, 2), 3.0), ("b", dt.datetime(2024, 1, 1), 5.0), ("b", None, 7.0)]
    df = spark.createDataFrame(rows, "k string, ts timestamp, v double")
    day = {(r.k, str(r.period)): r.v for r in AN.resample_mean(df, "ts", ["v"], "day", ["k"], spine=True).collect()}
    assert day == {("a", "2024-01-30"): 1.0, ("a", "2024-01-31"): None, ("a", "2024-02-01"): None, ("a", "2024-02-02"): 3.0,
                   ("b", "2024-01-01"): 5.0}
    wide = spark.createDataFrame([(dt.datetime(2023, 12, 31), 1.0), (dt.datetime(2024, 1, 20), 2.0)], "ts timestamp, v double")
    week = {str(r.period): r.v for r in AN.resample_mean(wide, "ts", ["v"], "week", spine=True).collect()}
    assert week == {"2023-12-31": 1.0, "2024-01-07": None, "2024-01-14": None, "2024-01-21": 2.0}
    assert len(AN.resample_mean(wide, "ts", ["v"], "month", spine=True).collect()) == 2
    with pytest.raises(ValueError):
        AN.resample_mean(wide, "ts", ["v"], "hour")


def test_report_flags(spark):
    rows = [(k, float(y), float(p), 0.0) for k, (y, p) in enumerate([(1, 4), (2, 3), (3, 2), (4, 1)])]
    df = spark.createDataFrame(rows, "t int, y double, p double, ref double")
    full = MT.full_report(df, [], "t", "y", "p", ref="ref")
    assert set(full.columns) == {"n", "mae", "rmse", "r2", "directional_accuracy", "deviation_directional_accuracy", "peak_mae"}
    r = full.first()
    assert (r.directional_accuracy, r.deviation_directional_accuracy, r.peak_mae) == (0.0, 1.0, 3.0)
    assert MT.full_report(df, [], "t", "y", "p", include_directional=False, include_peak=False).columns == ["n", "mae", "rmse", "r2"]
    with pytest.raises(ValueError, match="reference"):
        MT.full_report(df, [], "t", "y", "p")
    assert B.ENERGY_TYPES and "peak_mae" in MT.full_report(df, [], "t", "y", "p", include_directional=False).columns
