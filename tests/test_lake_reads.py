"""Lake by folder names, bounds that reach the scan, upserts in any order of delivery."""
import datetime as dt
import random
import tempfile

import pytest
from pyspark.sql import functions as F

from ampere.functions.time import to_local
from ampere.operators.merge import merge_versions
from ampere.sources import lake as LK
from ampere.sources import reads as RD
from ampere.streaming import ingest as SI

T0 = dt.datetime(2024, 1, 30)


def fresh(name):
    return tempfile.mkdtemp(prefix=f"{name}-", dir="/tmp") + "/data"


def signals(spark, days=4, start=T0, value=1.0, resolution="hour"):
    rows = [(start + dt.timedelta(hours=h), "SOLAR", value, "MW", resolution) for h in range(24 * days)]
    return spark.createDataFrame(rows, LK.SIGNAL_SCHEMA)


def plan_of(df):
    df.sparkSession.conf.set("spark.sql.maxMetadataStringLength", "2000")
    return df._jdf.queryExecution().executedPlan().toString()


def test_day_is_a_partition_filter(spark):
    root = fresh("lake")
    LK.write_day_partitions(signals(spark), root)
    df = LK.scan_range(spark, root, "2024-01-31", "2024-02-01", LK.SIGNAL_SCHEMA)
    assert df.count() == 48
    partition, pushed = (next(x for x in plan_of(df).splitlines() if "FileScan" in x).split(k)[1].split("]")[0]
                         for k in ("PartitionFilters: [", "PushedFilters: ["))
    assert "day#" in partition and "month#" in partition and "timestamp" in pushed
    assert len(LK.scan_range(spark, root, "2024-01-31", "2024-01-31", LK.SIGNAL_SCHEMA).inputFiles()) >= 1


def test_missing_lake_and_day_are_empty(spark):
    nowhere = fresh("none")
    assert LK.read_day(spark, nowhere, "2024-01-30").collect() == []
    assert LK.stored_partitions(spark, nowhere).collect() == []
    assert LK.scan_range(spark, nowhere, "2024-01-01", "2024-01-02", LK.WEATHER_SCHEMA).columns[:3] == ["timestamp", "region", "signal_type"]
    root = fresh("lake")
    LK.write_day_partitions(signals(spark), root)
    assert LK.read_day(spark, root, "2024-03-01").collect() == []


def test_text_instants_are_coerced(spark):
    root = fresh("texts")
    texts = ["2024-01-30 05:00:00", "2024-01-30T23:59:59Z", "not a time", None, "2024-01-31 00:00:00"]
    df = spark.createDataFrame([(t, 2024, "01", "30") for t in texts], "timestamp string, year int, month string, day string")
    df.write.partitionBy("year", "month", "day").parquet(root)
    got = sorted(r.timestamp for r in LK.read_day(spark, root, "2024-01-30").collect())
    assert got == [dt.datetime(2024, 1, 30, 5), dt.datetime(2024, 1, 30, 23, 59, 59)]


def test_only_missing_days_are_written(spark):
    root = fresh("skip")
    first = LK.write_missing_days(signals(spark, 2), root)
    assert [r.day for r in first.orderBy("day").collect()] == [dt.date(2024, 1, 30), dt.date(2024, 1, 31)]
    again = LK.write_missing_days(signals(spark, 4, value=2.0), root)
    assert [r.day for r in again.orderBy("day").collect()] == [dt.date(2024, 2, 1), dt.date(2024, 2, 2)]
    per_day = {r.d: r.v for r in spark.read.parquet(root).groupBy(F.to_date("timestamp").alias("d")).agg(F.avg("value").alias("v")).collect()}
    assert list(dict(sorted(per_day.items())).values()) == [1.0, 1.0, 2.0, 2.0]
    LK.write_missing_days(signals(spark, 1, value=2.0, resolution="quarterhour"), root)   # another partition of a stored day
    assert spark.read.parquet(root).where("resolution = 'quarterhour'").count() == 24
    assert LK.write_missing_days(signals(spark, 4, value=3.0), root).count() == 0
    assert LK.write_missing_days(signals(spark, 1, value=3.0), root, force=True).count() == 1
    back = spark.read.parquet(root).where("resolution = 'hour'").groupBy("value").count().collect()
    assert {r.value: r["count"] for r in back} == {3.0: 24, 1.0: 24, 2.0: 48}


@pytest.mark.parametrize("closed", [False, True])
def test_raw_bounds_equal_bounds_of_the_floor(spark, closed):
    rng = random.Random(1)
    rows = [(dt.datetime(2024, 1, 1) + dt.timedelta(seconds=rng.randrange(4 * 86400)),) for _ in range(500)]
    rows += [(dt.datetime(2024, 1, 2, 3),), (dt.datetime(2024, 1, 2, 2, 59, 59),), (dt.datetime(2024, 1, 3, 4),)]
    df = spark.createDataFrame(rows, "ts timestamp")
    for minutes, ahead in ((60, 0), (15, 0), (60, 1)):
        grid = F.timestamp_seconds(F.floor(F.unix_timestamp("ts") / (60 * minutes)) * 60 * minutes) + F.make_dt_interval(hours=F.lit(ahead))
        for a, z in (("2024-01-02 03:00:00", "2024-01-03 04:00:00"), ("2024-01-02 02:10:00", "2024-01-03 03:50:00"),
                     (None, "2024-01-03"), ("2024-01-02", None), (None, None)):
            exact = df.where(RD.within(grid, a and RD.instant(a), z and RD.instant(z), closed))
            got = df.where(RD.raw_bounds("ts", minutes, a, z, closed, dt.timedelta(hours=ahead)))
            assert sorted(exact.collect()) == sorted(got.collect())


def test_bounds_reach_the_scan(spark):
    root = fresh("contract")
    (spark.range(24 * 400).select(F.timestamp_seconds(1704067200 + F.col("id") * 3600).alias("timestamp"))
     .withColumn("local_timestamp", to_local("timestamp")).write.parquet(root))
    df = spark.read.parquet(root)
    for a, z in (("2024-03-31", "2024-04-01"), ("2024-10-27", "2024-10-28"), ("2024-10-27 02:30:00", "2024-10-27 02:45:00"),
                 ("2024-03-31 02:00:00", "2024-03-31 03:30:00"), (None, "2024-01-02"), ("2025-01-01", None)):
        for closed in (False, True):
            got = RD.bounded_local(df, a, z, closed)
            bound = [x and dt.datetime.fromisoformat(x) for x in (a, z)]
            want = [r for r in df.collect() if (not bound[0] or r.local_timestamp >= bound[0])
                    and (not bound[1] or r.local_timestamp < bound[1] or (closed and r.local_timestamp == bound[1]))]
            assert sorted(got.collect()) == sorted(want)
    days = RD.bounded_local(df, "2024-03-31", "2024-04-02")
    assert "GreaterThanOrEqual(timestamp" in plan_of(days) and "LessThanOrEqual(timestamp" in plan_of(days)
    assert "GreaterThanOrEqual(timestamp" in plan_of(RD.bounded(df, "2024-03-31", "2024-04-02"))
    r = RD.days_returned(days, "2024-03-31", "2024-04-02").first()
    assert (r.days_queried, r.days_returned, r.rows) == (2, 2, 47)
    ordered = [x.timestamp for x in days.collect()]
    assert ordered == sorted(ordered)


def test_versions_in_any_order(spark):
    v = lambda *rows: spark.createDataFrame(list(rows), "k int, value string, fetched int")
    old, new = v((1, "old", 1), (2, "only old", 1)), v((1, "new", 2), (3, "only new", 2))
    for first, second in ((old, new), (new, old)):
        t = merge_versions(merge_versions(None, first, ["k"], ["fetched"]), second, ["k"], ["fetched"])
        assert {r.k: r.value for r in t.collect()} == {1: "new", 2: "only old", 3: "only new"}
        assert sorted(merge_versions(t, second, ["k"], ["fetched"]).collect()) == sorted(t.collect())
    same = merge_versions(old, v((1, "again", 1)), ["k"], ["fetched"])
    assert {r.k: r.value for r in same.collect()}[1] == "again"


def test_stream_keeps_the_newest_version_and_leaves_no_stage(spark):
    root = fresh("stream")
    rows = lambda value, fetched: signals(spark, 1, value=value).withColumn("fetched_at", F.lit(fetched))

    def deliver(df):
        df.write.mode("append").parquet(f"{root}/in")
        src = SI.file_stream(spark, f"{root}/in", df.schema)
        SI.upsert_stream(src, f"{root}/t", f"{root}/cp", ["timestamp", "signal", "resolution"], ["fetched_at"]).awaitTermination()

    deliver(rows(2.0, 20))
    deliver(rows(1.0, 10))
    assert {r.value for r in spark.read.parquet(f"{root}/t").collect()} == {2.0}
    deliver(rows(3.0, 30))
    assert {r.value for r in spark.read.parquet(f"{root}/t").collect()} == {3.0}
    assert not list(__import__("pathlib").Path(root).rglob("_staging")) and not list(__import__("pathlib").Path(f"{root}/cp-stage").glob("*"))
    src = SI.file_stream(spark, f"{root}/in", rows(1.0, 1).schema)
    with pytest.raises(ValueError, match="by_version"):
        SI.upsert_stream(src, f"{root}/t", f"{root}/cp2", ["timestamp"], ["fetched_at"], update_cols=["value"])


def test_table_stream_takes_one_file_or_a_folder(spark):
    import shutil
    root = fresh("table")
    df = signals(spark, 1).coalesce(1)
    df.write.parquet(f"{root}/folder.parquet")
    part = next(__import__("pathlib").Path(f"{root}/folder.parquet").glob("part-*.parquet"))
    shutil.copy(part, f"{root}/one.parquet")
    shutil.copy(part, f"{root}/one.parquet.bak")
    for name in ("folder", "one"):
        out = f"{root}/out-{name}"
        SI.run_available_now(SI.table_stream(spark, f"{root}/{name}.parquet", df.schema), out, f"{root}/cp-{name}")
        assert spark.read.parquet(out).count() == 24
