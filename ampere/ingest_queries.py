"""Queries of the lake, of bounded reads and of the upsert variants."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from ampere import bindings as B
from ampere import model_queries as MQ
from ampere.operators import lags as LG
from ampere.operators.merge import latest_per_key, merge_latest, merge_versions
from ampere.plans import oracle as O
from ampere.queries import LOCAL_SQL, register, warehouse
from ampere.session import ensure_checkpoint_dir
from ampere.sources import lake as LK
from ampere.sources import reads as RD
from ampere.streaming import ingest as SI

_LAKES: dict = {}


def _scratch(spark, name: str) -> str:
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/ampere-{name}-{uuid.uuid4().hex}"


def _lake(spark, sf_dir) -> str:
    """The day-partitioned lake of the raw signals, written once per session and folder."""
    key = (id(spark._jsparkSession), sf_dir)
    if key not in _LAKES:
        root = _scratch(spark, "lake")
        LK.write_day_partitions(B.raw_signals(spark, sf_dir), root)
        _LAKES[key] = root
    return _LAKES[key]


SIG = f"WITH sig_rows AS ({O.signal_rows('hour')}), sig AS ({O.latest('sig_rows', 'timestamp, signal, resolution')})"
SIG_COLS = ["timestamp", "signal", "value", "unit", "resolution"]
LAKE_FROM, LAKE_TO, LAKE_DAY = "2024-01-10", "2024-01-12", "2024-01-15"


@register("lake_range_scan", O.rounded(f"""{SIG} SELECT {", ".join(SIG_COLS)} FROM sig
WHERE timestamp >= TIMESTAMP '{LAKE_FROM}' AND timestamp <= TIMESTAMP '{LAKE_TO} 23:59:59'""", ["value"]))
def lake_range_scan(spark, sf_dir):
    """A day range (closed) of the lake, pruned by its day partitions."""
    return LK.scan_range(spark, _lake(spark, sf_dir), LAKE_FROM, LAKE_TO, LK.SIGNAL_SCHEMA).select(*SIG_COLS)


@register("lake_day_read", O.rounded(f"""{SIG} SELECT {", ".join(SIG_COLS)} FROM sig
WHERE CAST(timestamp AS DATE) = DATE '{LAKE_DAY}'""", ["value"]))
def lake_day_read(spark, sf_dir):
    """The rows of one UTC day of the lake."""
    return LK.read_day(spark, _lake(spark, sf_dir), LAKE_DAY).select(*SIG_COLS)


@register("lake_partitions", f"""{SIG} SELECT DISTINCT CAST(CAST(timestamp AS DATE) AS TIMESTAMP) AS day, resolution FROM sig""")
def lake_partitions(spark, sf_dir):
    """The stored day partitions, from folder names."""
    return LK.stored_partitions(spark, _lake(spark, sf_dir))


STORED_BEFORE = "2024-01-20"


@register("lake_skip_existing_write", O.rounded(f"""{SIG}
SELECT timestamp, signal, value + CASE WHEN timestamp < TIMESTAMP '{STORED_BEFORE}' THEN 0 ELSE 1 END AS value, unit, resolution
FROM sig""", ["value"]))
def lake_skip_existing_write(spark, sf_dir):
    """A delivery of all days (values + 1) over a lake that has the first ones: only missing days are written."""
    sig, root = B.raw_signals(spark, sf_dir), _scratch(spark, "lake-skip")
    LK.write_day_partitions(sig.where(F.col("timestamp") < F.lit(STORED_BEFORE).cast("timestamp")), root)
    LK.write_missing_days(sig.withColumn("value", F.col("value") + 1), root)
    return spark.read.parquet(root).select(*SIG_COLS)


# --- bounded reads -----------------------------------------------------------------

READ_FROM, READ_TO = "2024-03-28", "2024-04-02"   # holds a day of 23 hours
HOURLY_COLS = ["timestamp", "local_timestamp", "horizon", "price_eur_mwh", "price_lag_24h"]


@register("contract_read_local", O.dense(O.rounded(f"""SELECT {", ".join(HOURLY_COLS)} FROM ({O.contract_sql(MQ.SPECS["hour"])})
WHERE local_timestamp >= TIMESTAMP '{READ_FROM}' AND local_timestamp < TIMESTAMP '{READ_TO}'""", ["price_eur_mwh", "price_lag_24h"])))
def contract_read_local(spark, sf_dir):
    """The hourly contract in half-open bounds of local time."""
    return RD.bounded_local(MQ.contract(spark, sf_dir), READ_FROM, READ_TO).select(*HOURLY_COLS)


@register("contract_read_days", O.dense(f"""SELECT CAST(5 AS BIGINT) AS days_queried,
count(DISTINCT CAST(local_timestamp AS DATE)) AS days_returned, count(*) AS rows FROM ({O.contract_sql(MQ.SPECS["hour"])})
WHERE local_timestamp >= TIMESTAMP '{READ_FROM}' AND local_timestamp < TIMESTAMP '{READ_TO}'"""))
def contract_read_days(spark, sf_dir):
    """The days that the read asked for and got."""
    return RD.days_returned(RD.bounded_local(MQ.contract(spark, sf_dir), READ_FROM, READ_TO), READ_FROM, READ_TO)


@register("quarter_contract_read", O.dense(O.rounded(f"""SELECT timestamp, local_timestamp, quarter_of_hour, price_eur_mwh, price_lag_96qh
FROM ({O.contract_sql(MQ.SPECS["quarterhour"])})
WHERE timestamp >= TIMESTAMP '{READ_FROM}' AND timestamp < TIMESTAMP '{READ_TO}'""", ["price_eur_mwh", "price_lag_96qh"])))
def quarter_contract_read(spark, sf_dir):
    """The quarter-hourly contract in half-open bounds of UTC."""
    return RD.bounded(MQ.contract(spark, sf_dir, "quarterhour"), READ_FROM, READ_TO).select(
        "timestamp", "local_timestamp", "quarter_of_hour", "price_eur_mwh", "price_lag_96qh")


WXF_COLS = [n for _, _, n in B.EVENTS_CATALOG.weather_columns()]


@register("weather_forecast_read", O.rounded(f"""WITH {O.staging_ctes('hour')},
l AS ({O.latest('stg_wxf', 'timestamp, region, signal_name', 'fetched_at DESC')})
SELECT timestamp, {", ".join(WXF_COLS)} FROM ({O.pivot_weather_sql('l')}) WHERE timestamp <= TIMESTAMP '{LAKE_TO} 06:00:00'""", WXF_COLS))
def weather_forecast_read(spark, sf_dir):
    """The weather forecast features up to a closed bound, no lower one."""
    f = warehouse(spark, sf_dir).fct_weather_forecast_features
    return RD.bounded(f, end=f"{LAKE_TO} 06:00:00", closed=True).select("timestamp", *WXF_COLS)


@register("ml_features_read", O.dense(O.rounded(f"""WITH {O.ml_features_ctes('hour')},
r AS (SELECT timestamp, click_mw, view_mw FROM ml WHERE timestamp >= TIMESTAMP '2024-03-01' AND timestamp <= TIMESTAMP '2024-03-20')
SELECT *, click_mw + view_mw AS wind_total_mw, lag(view_mw, 24) OVER w AS view_mw_lag_24h, lag(view_mw, 168) OVER w AS view_mw_lag_168h
FROM r WINDOW w AS (ORDER BY timestamp)""", ["click_mw", "view_mw", "wind_total_mw", "view_mw_lag_24h", "view_mw_lag_168h"])))
def ml_features_read(spark, sf_dir):
    """The feature table in closed bounds, with the total and the row lags of the rows read."""
    ml = warehouse(spark, sf_dir, "hour", "orders").fct_ml_features.select("timestamp", "click_mw", "view_mw")
    r = RD.bounded(ml, "2024-03-01", "2024-03-20", closed=True).withColumn("wind_total_mw", F.col("click_mw") + F.col("view_mw"))
    return LG.row_lag_indexed(r, {24: {"view_mw": "view_mw_lag_24h"}, 168: {"view_mw": "view_mw_lag_168h"}}).orderBy("timestamp")


@register("raw_bounded_read", f"""WITH sig_rows AS ({O.signal_rows('hour')}) SELECT signal, min(timestamp) AS first_ts,
max(timestamp) AS last_ts, count(*) AS n FROM sig_rows
WHERE timestamp >= TIMESTAMP '{LAKE_FROM} 02:30:00' AND timestamp <= TIMESTAMP '{LAKE_TO} 05:00:00' GROUP BY 1""")
def raw_bounded_read(spark, sf_dir):
    """Closed bounds on the floored instant, pushed into the scan of the raw events."""
    e = B.events(spark, sf_dir).where(RD.raw_bounds("ts", 60, f"{LAKE_FROM} 02:30:00", f"{LAKE_TO} 05:00:00", closed=True))
    r = e.select(F.date_trunc("HOUR", "ts").alias("timestamp"), F.upper("event_type").alias("signal"))
    return r.groupBy("signal").agg(F.min("timestamp").alias("first_ts"), F.max("timestamp").alias("last_ts"), F.count("*").alias("n"))


# --- upsert variants -----------------------------------------------------------------

BASE_BEFORE, DELTA_FROM = "2024-01-20 00:00:00", "2024-01-15 00:00:00"


def _base_and_delta(rows, key, change, order):
    base = latest_per_key(rows.where(F.col("fetched_at") < F.lit(BASE_BEFORE).cast("timestamp")), key, order)
    return base, change(rows.where(F.col("fetched_at") >= F.lit(DELTA_FROM).cast("timestamp")))


def _upsert_sql(rows: str, key: str, order: str, change: str) -> str:
    return f"""WITH r AS ({rows}), base AS ({O.latest(f"(SELECT * FROM r WHERE fetched_at < TIMESTAMP '{BASE_BEFORE}')", key, order)}),
delta AS (SELECT * REPLACE ({change}) FROM r WHERE fetched_at >= TIMESTAMP '{DELTA_FROM}'),
u AS (SELECT *, 0 AS d FROM base UNION ALL SELECT *, 1 AS d FROM delta)
SELECT * EXCLUDE (d) FROM ({O.latest('u', key, 'd DESC, ' + order)})"""


@register("upsert_forecast", O.rounded(_upsert_sql(
    f"SELECT *, {O.issue_expr()} AS issue_timestamp FROM ({O.forecast_rows('hour')})", "timestamp, signal, resolution",
    "fetched_at DESC, event_id DESC", "value + 1 AS value, issue_timestamp + INTERVAL 1 HOUR AS issue_timestamp"), ["value"]))
def upsert_forecast(spark, sf_dir):
    """Signal forecasts by (timestamp, signal, resolution); issue and fetch time are updated too."""
    rows, key = B.raw_signal_forecast_rows(spark, sf_dir), ["timestamp", "signal", "resolution"]
    base, delta = _base_and_delta(rows, key, lambda d: d.withColumns({
        "value": F.col("value") + 1, "issue_timestamp": F.col("issue_timestamp") + F.expr("INTERVAL 1 HOUR")}), ["fetched_at", "event_id"])
    return merge_latest(base, delta, key, ["fetched_at", "event_id"])


@register("upsert_weather", O.rounded(_upsert_sql(O.weather_rows(), "timestamp, region, signal_type",
                                                  "fetched_at DESC, event_id DESC", "value + 1 AS value"), ["value"]))
def upsert_weather(spark, sf_dir):
    """Weather by (timestamp, region, signal_type)."""
    rows, key = B.raw_weather_rows(spark, sf_dir).drop("unit"), ["timestamp", "region", "signal_type"]
    base, delta = _base_and_delta(rows, key, lambda d: d.withColumn("value", F.col("value") + 1), ["fetched_at", "event_id"])
    return merge_latest(base, delta, key, ["fetched_at", "event_id"])


def _weather_forecasts(spark, sf_dir):
    return B.raw_weather_forecast(spark, sf_dir).drop("unit")


@register("upsert_weather_forecast", O.rounded(_upsert_sql(
    O.weather_forecast_rows(), "timestamp, region, signal_type", "fetched_at DESC, value DESC",
    "value + 1 AS value, 'ecmwf_ifs' AS model"), ["value"]))
def upsert_weather_forecast(spark, sf_dir):
    """Weather forecasts by three columns: a refetched forecast replaces the stored one, its model too."""
    rows, key = _weather_forecasts(spark, sf_dir), ["timestamp", "region", "signal_type"]
    base, delta = _base_and_delta(rows, key, lambda d: d.withColumns({"value": F.col("value") + 1, "model": F.lit("ecmwf_ifs")}),
                                  ["fetched_at", "value"])
    return merge_latest(base, delta, key, ["fetched_at", "value"])


@register("upsert_weather_forecast_versions", O.rounded(_upsert_sql(
    O.weather_forecast_rows(), "timestamp, region, signal_type, fetched_at", "value DESC",
    "value + 1 AS value, 'ecmwf_ifs' AS model"), ["value"]))
def upsert_weather_forecast_versions(spark, sf_dir):
    """The same by four columns: every fetched version stays, a version delivered again is replaced."""
    rows, key = _weather_forecasts(spark, sf_dir), ["timestamp", "region", "signal_type", "fetched_at"]
    base, delta = _base_and_delta(rows, key, lambda d: d.withColumns({"value": F.col("value") + 1, "model": F.lit("ecmwf_ifs")}), ["value"])
    return merge_latest(base, delta, key, ["value"])


@register("upsert_any_order", O.rounded(f"""{SIG} SELECT timestamp, signal, value, unit, resolution, fetched_at, event_id FROM sig""",
                                        ["value"]))
def upsert_any_order(spark, sf_dir):
    """M1: the newer half of the deliveries first, then the older, then the newer again: the newest version stays."""
    rows, key, version = B.raw_signal_rows(spark, sf_dir), ["timestamp", "signal", "resolution"], ["fetched_at", "event_id"]
    old = rows.where(F.col("event_id") % 2 == 0)
    new = rows.where(F.col("event_id") % 2 == 1)
    table = merge_versions(None, new, key, version)
    return merge_versions(merge_versions(table, old, key, version), new, key, version)


@register("stream_upsert_any_order", O.rounded(f"""{SIG} SELECT timestamp, signal, value, unit, resolution, fetched_at, event_id FROM sig""",
                                               ["value"]))
def stream_upsert_any_order(spark, sf_dir):
    """M1: two deliveries, each file a batch, the newer rows first: the stream's table has the newest version."""
    rows, root = B.raw_signal_rows(spark, sf_dir), _scratch(spark, "stream-any-order")
    middle = rows.agg(F.timestamp_seconds(F.avg(F.unix_timestamp("fetched_at")))).scalar()
    for part in (rows.where(F.col("fetched_at") >= middle), rows.where(F.col("fetched_at") < middle)):
        part.write.mode("append").parquet(f"{root}/landing")
        src = SI.file_stream(spark, f"{root}/landing", rows.schema)
        SI.upsert_stream(src, f"{root}/table", f"{root}/checkpoint", ["timestamp", "signal", "resolution"],
                         ["fetched_at", "event_id"]).awaitTermination()
    return spark.read.parquet(f"{root}/table").drop("day")
