"""Results that must hold on larger tables: years beyond the Easter map, lags and stored days."""
import datetime as dt

from pyspark.sql import functions as F

from ampere.functions import calendar as CAL


def test_calendar_of_any_year(spark):
    years = spark.range(1600, 9900, 1).select(F.make_date(F.col("id").cast("int"), F.lit(7), F.lit(1)).alias("d"))
    wrong = years.where(F.expr(CAL.easter_sql("d")) != CAL.easter_sunday(F.year("d")))
    assert years.count() == 8300 and wrong.count() == 0
    easter = CAL.easter_date(2230)
    rows = [(easter + dt.timedelta(days=1),), (easter - dt.timedelta(days=2),), (dt.date(2281, 12, 25),), (dt.date(2230, 7, 9),), (None,)]
    out = spark.createDataFrame(rows, "d date").select("d", *CAL.calendar_columns("d")).collect()
    assert [r.holiday_name for r in out] == ["Ostermontag", "Karfreitag", out[2].holiday_name, None, None] and out[2].holiday_name
    assert [r.is_german_public_holiday for r in out] == [True, True, True, False, False]


def test_calendar_equals_the_map(spark):
    days = spark.range(0, 365 * 300, 1).select(F.date_add(F.lit("1900-01-01").cast("date"), F.col("id").cast("int")).alias("d"))
    differ = days.where(~CAL.holiday_name("d").eqNullSafe(F.expr(CAL.holiday_rule_sql("d"))))
    assert differ.count() == 0


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_lag_fanout_reads_and_exchanges_rows_once(spark):
    from ampere.operators import lags as LG
    start = dt.datetime(2024, 1, 1)
    rows = [(s, start + dt.timedelta(hours=h), float(h * k)) for k, s in enumerate(("a", "b", None), 1) for h in range(0, 2000, 7)]
    rows += [("a", start + dt.timedelta(hours=7), 9.5), ("a", None, 1.0), ("a", dt.datetime(2285, 5, 1, 3, 0, 0, 1), 5.0),
             ("a", dt.datetime(2285, 5, 8, 3, 0, 0, 1), 6.0)]
    df = spark.createDataFrame(rows, "s string, timestamp timestamp, v double").dropDuplicates()
    once = df.where("timestamp is null or v <> 9.5")
    lags = {168: {"v": "l168"}, 7: {"v": "l7"}, -14: {"v": "ahead"}}
    a, b = LG.lag_fanout(once, lags, partition=["s"]), LG.lag_self_join(once, lags, partition=["s"])
    assert a.columns == ["timestamp", "s", "v", "l168", "l7", "ahead"]
    assert a.exceptAll(b.select(a.columns)).count() == 0 and a.count() == b.count() == once.count()
    assert LG.lag_fanout(df, lags, partition=["s"]).count() == df.count()      # a repeated instant makes no more rows
    base = spark.range(10).select(F.timestamp_seconds(F.col("id") * 3600).alias("timestamp"), F.col("id").alias("v"))
    plan = _plan(LG.lag_fanout(base, {k: {"v": f"l{k}"} for k in range(1, 9)}))
    assert plan.count("Exchange hashpartitioning") == 1 and "Join" not in plan


def test_dense_events_are_not_stored(spark, tmp_path):
    from ampere import bindings as B
    o = spark.range(3000).select(F.col("id").alias("o_orderkey"), (F.col("id") * 1.37 % 1000).alias("o_totalprice"))
    o.write.parquet(f"{tmp_path}/orders.parquet")
    files = B.dense_events(spark, str(tmp_path)).inputFiles()
    assert files and all("orders.parquet" in f for f in files)


def test_energy_forecasts_read_their_own_signals(spark):
    from ampere.config import ENERGY
    from ampere.queries import _build_warehouse
    raw = _build_warehouse(spark, "/root/testdata/sf0.001", "hour", "energy").raw["signal_forecast"]
    assert {r.signal for r in raw.select("signal").distinct().collect()} == set(ENERGY.forecasts)


def test_first_build_writes_days_in_many_tasks(spark):
    import os
    import tempfile

    from ampere.plans.products import _write_days
    root = tempfile.mkdtemp(prefix="days-", dir="/tmp")
    days = spark.range(40).select(F.timestamp_seconds(F.col("id") * 86400).alias("timestamp"), "id")
    assert len(_write_days(days, f"{root}/t", None)) == 40
    names = [f for _, _, fs in os.walk(root) for f in fs if f.endswith(".parquet")]
    assert len(names) == 40 and len({f.split("-")[1] for f in names}) > 1     # part-<task>-...


def test_days_are_read_without_listing_the_others(spark):
    import tempfile

    from ampere.plans import products as PR
    path = tempfile.mkdtemp(prefix="days-", dir="/tmp") + "/t"
    days = spark.range(60).select(F.timestamp_seconds(F.col("id") * 86400).alias("timestamp"), "id")
    assert PR._write_days(days, path, None) == [dt.date(1970, 1, 1) + dt.timedelta(days=k) for k in range(60)]
    some = [dt.date(1970, 1, 5), dt.date(1970, 2, 1), dt.date(1999, 1, 1)]
    read = PR._read_days(spark, path, some)
    assert len(read.inputFiles()) == 2 and sorted((r.day, r.id) for r in read.collect()) == [(some[0], 4), (some[1], 31)]
    assert PR._read_days(spark, path, some[2:]).count() == 0
    assert PR.stored_partitions_of(spark, path + "-none") == []


def test_model_frame_exchanges_whole_rows_once(spark):
    from ampere.operators import windows as WN
    from ampere.plans.backtest import model_frame
    start = dt.datetime(2024, 1, 1)
    gaps = {5, 6, 24, 49, 50, 51, 52, 53, 120}
    rows = [("r", start + dt.timedelta(hours=h), start.date() + dt.timedelta(days=h // 24), None if h in gaps else float(h), float(-h))
            for h in range(24 * 8) if not 72 <= h < 94] + [("r", start, None, 1.0, 1.0), (None, start, start.date(), 1.0, 1.0)]
    df = spark.createDataFrame(rows, "resolution string, timestamp timestamp, delivery_date date, v double, y double")
    got = model_frame(df, ["v"], ["v", "y"], partition=["resolution"])
    known = df.where("resolution is not null and delivery_date is not null")
    want = WN.complete_days(WN.forward_fill(known, ["v"], partition=["resolution"]), ["v", "y"],
                            day=F.col("delivery_date"), partition=["resolution"])
    assert sorted(map(tuple, got.select(want.columns).collect())) == sorted(map(tuple, want.collect())) and want.count() == 7 * 24 - 22
    # the rows, the last rows of each day, and their carries in and out of the running sums
    assert _plan(model_frame(df, ["v"], ["v", "y"], partition=["resolution"])).count("Exchange hashpartitioning") == 4


def test_contract_exchanges_its_rows_once(spark):
    from ampere.plans.contracts import ContractSpec, build_contract
    start = dt.datetime(2024, 3, 1)     # the clock goes forward on March 31st, back on October 27th
    rows = [(start + dt.timedelta(hours=h), "hour", float(h % 89)) for h in range(24 * 270) if h % 97]
    df = spark.createDataFrame(rows, "timestamp timestamp, resolution string, price_eur_mwh double")
    from ampere.plans.contracts import CALENDAR_COLUMNS
    df = df.select("*", *[F.lit(1).alias(c) for c in CALENDAR_COLUMNS])
    spec = ContractSpec("hour", 1)
    a, b = build_contract(df, spec), build_contract(df, spec, method="self_join")
    assert a.columns == b.columns and a.count() == b.count() == len(rows)
    assert a.exceptAll(b).count() == 0 and a.agg(F.max("horizon")).first()[0] == 25
    assert _plan(build_contract(df, spec)).count("Exchange hashpartitioning") == 1


def test_products_of_dense_events_exchange_orders_only(spark, tmp_path):
    from ampere.queries import _build_warehouse
    n = 60_000
    o = spark.range(n).select(F.col("id").alias("o_orderkey"), (F.col("id") * 1.37 % 1000).alias("o_totalprice"))
    o.write.parquet(f"{tmp_path}/orders.parquet")
    for source in ("orders", "energy"):
        plan = _plan(_build_warehouse(spark, str(tmp_path), "hour", source).fct_ml_features)
        lines = [x for x in plan.splitlines() if "Exchange hashpartitioning" in x]
        assert lines and all("REPARTITION_BY_NUM" in x for x in lines)
