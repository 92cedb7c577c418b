"""Lake, payloads, artifacts and streaming sources."""
import datetime as dt
import json
import os
import tempfile

import pytest
from pyspark.sql import functions as F

from ampere.sources import artifacts as AR
from ampere.sources import lake as LK
from ampere.sources import payloads as PL

START = dt.datetime(2024, 1, 15)
END = dt.datetime(2024, 1, 21, 23)


def ms(t):
    return int(t.replace(tzinfo=dt.timezone.utc).timestamp() * 1000)


def test_series_payload_values_nulls_and_bad(spark):
    p = json.dumps({"series": [[ms(START), 500.0], [ms(START + dt.timedelta(hours=1)), None], [ms(END), "x"]]})
    df = spark.createDataFrame([("SOLAR", p), ("WIND", json.dumps({"series": []}))], "signal string, payload string")
    out = sorted((r["signal"], r["timestamp"], r["value"]) for r in PL.parse_series_payload(df, keep=["signal"]).collect())
    assert out == [("SOLAR", START, 500.0), ("SOLAR", START + dt.timedelta(hours=1), None), ("SOLAR", END, None)]


def test_chunk_selection(spark):
    starts = [START - dt.timedelta(days=7), START, START + dt.timedelta(days=7), START + dt.timedelta(days=14)]
    idx = spark.createDataFrame([(s,) for s in starts], "chunk_start timestamp")
    got = [r[0] for r in PL.select_chunks(idx, "2024-01-16 00:00:00", "2024-01-22 00:00:00").orderBy("chunk_start").collect()]
    assert got == [START, START + dt.timedelta(days=7)]
    before = [r[0] for r in PL.select_chunks(idx, "2023-01-01 00:00:00", "2024-01-01 00:00:00").collect()]
    assert before == []  # range ends before the first chunk: nothing to fetch


def test_permissive_quarantine(spark):
    df = spark.createDataFrame([(1, '{"k": 3}'), (2, '{"k": '), (3, None)], "id long, props string")
    from pyspark.sql import types as T
    good, bad = PL.parse_permissive(df, "props", T.StructType([T.StructField("k", T.LongType())]), keep=["id"])
    assert sorted((r["id"], r["k"]) for r in good.collect()) == [(1, 3), (3, None)]
    assert [r["id"] for r in bad.collect()] == [2]


def test_weather_response_rows(spark):
    s = ms(START) // 1000
    resp = spark.createDataFrame([(("r1", s, s + 3 * 3600, 3600, [[1.0, 2.0, 3.0], [4.0, None, 6.0]]),)],
                                 "response struct<region:string,start:bigint,end:bigint,interval_s:int,vars:array<array<double>>>")
    out = PL.weather_response_to_long(resp, ["a", "b"]).collect()
    assert len(out) == 6
    vals = {(r["timestamp"], r["signal_type"]): r["value"] for r in out}
    assert vals[(START + dt.timedelta(hours=1), "b")] is None and vals[(START + dt.timedelta(hours=2), "a")] == 3.0


def test_lake_roundtrip_pruning_and_idempotent_day_overwrite(spark):
    root = tempfile.mkdtemp(prefix="lake-", dir="/tmp")
    rows = [(START + dt.timedelta(hours=h), "SOLAR", float(h), "MW", "hour") for h in range(48)]
    df = spark.createDataFrame(rows, LK.SIGNAL_SCHEMA)
    LK.write_day_partitions(df, root, files_per_partition=3)
    LK.write_day_partitions(df.where(F.to_date("timestamp") == F.lit("2024-01-16").cast("date"))
                            .withColumn("value", F.col("value") + 100), root)
    back = LK.scan_range(spark, root, "2024-01-15", "2024-01-16", LK.SIGNAL_SCHEMA)
    assert back.count() == 48
    assert back.where(F.col("value") >= 100).count() == 24
    assert LK.read_day(spark, root, "2024-01-15").count() == 24
    assert LK.scan_range(spark, root, "2024-02-01", "2024-02-02").count() == 0
    plan = back._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "year" in plan.split("PartitionFilters: [")[1].split("]")[0]
    pushed = plan.split("PushedFilters: [")[1].split("]")[0]
    assert "timestamp" in pushed                      # exact time bounds reach the Parquet reader


def test_artifact_versions(spark):
    root = tempfile.mkdtemp(prefix="art-", dir="/tmp")
    df = spark.createDataFrame([(1, [0.5, 2.0])], "window_id long, beta array<double>")
    stamp = AR.save_versioned(df, root, "stage1", dt.datetime(2026, 1, 2, 3, 4, 5))
    assert stamp == "20260102-030405"
    assert AR.load_versioned(spark, root, "stage1").first()["beta"] == [0.5, 2.0]
    assert AR.load_versioned(spark, root, "stage1", stamp).count() == 1
    with pytest.raises(ValueError):
        AR.load_versioned(spark, root, "stage1", "2026-01-02")


def test_report_and_seed(spark):
    root = tempfile.mkdtemp(prefix="rep-", dir="/tmp")
    rep = AR.hyperparameter_record({"ridge": 0.1}, 12.5, 10, spark)
    AR.write_report(rep, f"{root}/report")
    assert spark.read.json(f"{root}/report").first()["n_trials"] == 10
    with open(os.path.join(root, "seed.csv"), "w") as f:
        f.write("date,holiday_name\n2024-01-01,Neujahr\n")
    s = AR.read_seed_csv(spark, os.path.join(root, "seed.csv")).first()
    assert s["date"] == dt.date(2024, 1, 1) and s["holiday_name"] == "Neujahr"


def test_stream_upsert_touches_only_batch_days_and_is_idempotent(spark):
    from pyspark.sql import types as T
    from ampere.streaming import ingest as SI
    root = tempfile.mkdtemp(prefix="stream-", dir="/tmp")
    src = f"{root}/in"
    schema = T.StructType([T.StructField("timestamp", T.TimestampType()), T.StructField("signal", T.StringType()),
                           T.StructField("value", T.DoubleType()), T.StructField("fetched_at", T.TimestampType())])
    d1 = [(START, "S", 1.0, START), (START + dt.timedelta(days=1), "S", 2.0, START)]
    spark.createDataFrame(d1, schema).write.parquet(f"{src}/f1")

    def run():
        stream = SI.file_stream(spark, f"{src}/*", schema)
        SI.upsert_stream(stream, f"{root}/table", f"{root}/ckpt", ["timestamp", "signal"], ["fetched_at"]).awaitTermination()
    run()
    later = START + dt.timedelta(hours=5)
    spark.createDataFrame([(START + dt.timedelta(days=1), "S", 20.0, later)], schema).write.parquet(f"{src}/f2")
    run()
    out = {r["timestamp"]: r["value"] for r in spark.read.parquet(f"{root}/table").collect()}
    assert out == {START: 1.0, START + dt.timedelta(days=1): 20.0}


def test_stream_rollup_watermark_drops_late_rows(spark):
    from pyspark.sql import types as T
    from ampere.streaming import ingest as SI
    root = tempfile.mkdtemp(prefix="rollup-", dir="/tmp")
    schema = T.StructType([T.StructField("ts", T.TimestampType()), T.StructField("k", T.StringType()),
                           T.StructField("v", T.DoubleType())])
    t = dt.datetime(2024, 1, 1)
    first = [(t + dt.timedelta(minutes=10), "a", 1.0), (t + dt.timedelta(hours=5), "a", 2.0)]
    spark.createDataFrame(first, schema).coalesce(1).write.parquet(f"{root}/in/f1")

    def run():
        s = SI.file_stream(spark, f"{root}/in/*", schema, max_files_per_trigger=1)
        SI.run_available_now(SI.windowed_rollup(s, "ts", ["k"], "v", "1 hour", "2 hours"), f"{root}/out", f"{root}/ckpt")
        return {(r["window_start"], r["n"]) for r in spark.read.parquet(f"{root}/out").collect()}
    out1 = run()
    assert out1 == {(t, 1)}                      # 05:00 window still open (watermark 03:00)
    late = [(t + dt.timedelta(minutes=20), "a", 9.0),       # behind the watermark: dropped
            (t + dt.timedelta(hours=9), "a", 3.0)]          # moves the watermark to 07:00
    spark.createDataFrame(late, schema).coalesce(1).write.parquet(f"{root}/in/f2")
    out2 = run()
    assert out2 == {(t, 1), (t + dt.timedelta(hours=5), 1)}
