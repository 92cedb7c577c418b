"""Queries of landing and staging rules on rows that reach every branch: issue times, damaged values, seeds, reports, samples."""

from __future__ import annotations

from pyspark.sql import functions as F

from ampere import bindings as B
from ampere.functions import calendar as CAL
from ampere.operators import analysis as AN
from ampere.operators import metrics as MT
from ampere.operators import reshape as RS
from ampere.operators import staging as ST
from ampere.operators.merge import latest_per_key
from ampere.plans import oracle as O
from ampere.queries import (CAT, DIM_SQL, PRED_SQL, W_H, WIDE_SIGNALS, _events_stream, _orders_spine, _predictions, _scratch, register,
                            warehouse)
from ampere.sources import artifacts as AR
from ampere.sources import lake as LK
from ampere.sources import payloads as PL
from ampere.streaming import ingest as SI

# --- H15, A8: when a forecast was issued -------------------------------------------


@register("forecast_issue_times", f"""WITH fc AS ({O.forecast_rows('hour')})
SELECT event_id, signal, timestamp, {O.issue_expr()} AS issue_timestamp FROM fc""")
def forecast_issue_times(spark, sf_dir):
    """Issue instant of every landed forecast row, by its signal's local hour on the day before."""
    return B.raw_signal_forecast_rows(spark, sf_dir).select("event_id", "signal", "timestamp", "issue_timestamp")


@register("live_forecast_rows", O.rounded(f"""WITH f AS ({O.weather_forecast_rows()})
SELECT timestamp, region, signal_type, value, {O.unit_expr('signal_type')} AS unit, model,
       (SELECT max(ts) FROM events) AS fetched_at, CAST(date_trunc('day', timestamp) AS TIMESTAMP) AS issue_timestamp FROM f""",
                                          ["value"]))
def live_forecast_rows(spark, sf_dir):
    """Live forecasts, fetched at one instant (here the last event) and issued at the start of the valid day."""
    rows = B.raw_weather_forecast(spark, sf_dir).drop("issue_timestamp", "fetched_at")
    return PL.live_forecast_stamp(rows, now=B.events(spark, sf_dir).agg(F.max("ts")).scalar())


# --- B1, B2, B7: damaged and exact values --------------------------------------------

NAN_SQL = ("CASE WHEN event_id % 11 = 3 THEN 'NaN'::DOUBLE WHEN event_id % 13 = 5 THEN NULL ELSE value END AS value")
DAMAGED_SQL = (O.staging_ctes("hour")
               .replace(O.signal_rows("hour"), f"SELECT * REPLACE ({NAN_SQL}) FROM ({O.signal_rows('hour')})")
               .replace(O.weather_rows(), f"SELECT * REPLACE ({NAN_SQL}) FROM ({O.weather_rows()})"))


def _damaged(rows):
    """Some values not a number, some missing, by the event's number."""
    n = F.col("event_id")
    return rows.withColumn("value", F.when(n % 11 == 3, F.lit(float("nan"))).when(n % 13 == 5, F.lit(None).cast("double"))
                           .otherwise(F.col("value")))


@register("stage_damaged_values", O.rounded(f"""WITH {DAMAGED_SQL}
SELECT 'generation' AS "table", timestamp, signal_name AS series, value FROM stg_gen
UNION ALL SELECT 'prices', timestamp, signal_name, value FROM stg_prices
UNION ALL SELECT 'weather', timestamp, region || '/' || signal_name, value FROM stg_wx""", ["value"]))
def stage_damaged_values(spark, sf_dir):
    """NaN becomes null; generation and prices lose such rows, weather keeps them as null."""
    signals = latest_per_key(_damaged(B.raw_signal_rows(spark, sf_dir)), ["timestamp", "signal", "resolution"], ["fetched_at", "event_id"])
    weather = latest_per_key(_damaged(B.raw_weather_rows(spark, sf_dir)), ["timestamp", "region", "signal_type"], ["fetched_at", "event_id"])
    parts = [("generation", ST.stage_generation(signals.where(F.col("signal").isin(*CAT.generation_load)), CAT), F.col("signal_name")),
             ("prices", ST.stage_prices(signals.where(F.col("signal") == CAT.home_price)), F.col("signal_name")),
             ("weather", ST.stage_weather(weather), F.concat_ws("/", "region", "signal_name"))]
    out = [df.select(F.lit(name).alias("table"), "timestamp", series.alias("series"), "value") for name, df, series in parts]
    return out[0].unionByName(out[1]).unionByName(out[2])


@register("stage_exact_sums", f"""{W_H} SELECT signal_name, CAST(sum(CAST(value AS DECIMAL(18, 4))) AS VARCHAR) AS total,
       count(*) AS n FROM stg_gen GROUP BY 1""")
def stage_exact_sums(spark, sf_dir):
    """Staging with exact numerics (decimal), whose sums don't depend on the order of rows."""
    staged = ST.stage_generation(warehouse(spark, sf_dir).raw["generation"], CAT, decimal=True)
    return staged.groupBy("signal_name").agg(F.sum("value").cast("string").alias("total"), F.count(F.lit(1)).alias("n"))


# --- A23, C4, C5: seeds and the date dimension -----------------------------------------

@register("holiday_seed_join", DIM_SQL)
def holiday_seed_join(spark, sf_dir):
    """The holidays of the range as a CSV seed, read by its schema and joined to the calendar."""
    spine = _orders_spine(spark, sf_dir)
    path = _scratch(spark, "holiday-seed")
    CAL.holidays_for_years(spine.select(F.year("date_day").alias("year")).distinct()).select("date", "holiday_name").write.option(
        "header", True).csv(path)
    return CAL.holiday_join(spine, AR.read_seed_csv(spark, path))


CALENDAR_NUMBERS = ["year", "quarter", "month", "week_of_year", "day_of_week"]
CALENDAR_FLAGS = ["is_weekend", "is_german_public_holiday", "is_workday"]
DIMENSION_END = "2024-01-21"


@register("weather_forecast_in_dimension", O.rounded(f"""{W_H}, wp AS ({O.pivot_weather_sql(f"({O.latest('stg_wxf', 'timestamp, region, signal_name', 'fetched_at DESC')})")}),
days AS (SELECT DISTINCT CAST(timestamp AS DATE) AS date_day FROM stg_prices WHERE timestamp < TIMESTAMP '{DIMENSION_END}'),
b AS (SELECT min(date_day) AS lo, max(date_day) AS hi FROM days),
spine AS (SELECT CAST(unnest(generate_series(lo, hi, INTERVAL 1 DAY)) AS DATE) AS date_day FROM b),
yrs AS (SELECT DISTINCT year(date_day) AS y FROM spine), {O.holidays_sql('yrs')},
dim AS (SELECT s.date_day, {O.calendar_select('s.date_day')} FROM spine s LEFT JOIN holidays h ON s.date_day = h.date)
SELECT wp.timestamp, dim.date_day, dim.season, dim.holiday_name, {", ".join(f"CAST(dim.{c} AS DOUBLE) AS {c}" for c in CALENDAR_NUMBERS)},
       {", ".join(f"CAST(dim.{c} AS VARCHAR) AS {c}" for c in CALENDAR_FLAGS)}
FROM wp LEFT JOIN dim ON CAST(wp.timestamp AS DATE) = dim.date_day""", dates=["date_day"]))
def weather_forecast_in_dimension(spark, sf_dir):
    """C4: the calendar by a join with the date dimension; days that it doesn't cover have none (numbers as
    doubles and flags as text, whose nulls every reader knows)."""
    wh = warehouse(spark, sf_dir)
    dim = CAL.dimension_for(wh.stg_prices.where(F.col("timestamp") < F.lit(DIMENSION_END).cast("timestamp")))
    return CAL.calendar_join(wh.fct_weather_forecast_features.select("timestamp"), dim).select(
        "timestamp", "date_day", "season", "holiday_name", *[F.col(c).cast("double").alias(c) for c in CALENDAR_NUMBERS],
        *[F.col(c).cast("string").alias(c) for c in CALENDAR_FLAGS])


# --- A28, A14/H26, D7 --------------------------------------------------------------------

@register("report_round_trip", O.rounded(f"""{W_H}, {PRED_SQL}
SELECT (SELECT count(*) FROM pw) AS n_total, window_id, count(*) AS n, avg(abs(pred - y)) AS mae,
       sqrt(avg((pred - y) * (pred - y))) AS rmse FROM pw GROUP BY window_id""", ["mae", "rmse"]))
def report_round_trip(spark, sf_dir):
    """A nested report written as JSON, read back and spread to its windows (one a week)."""
    per = _predictions(spark, sf_dir).groupBy("window_id").agg(F.count(F.lit(1)).alias("n"), *MT.error_aggregates("y", "pred"))
    report = per.agg(F.sum("n").alias("n_total"), F.sort_array(F.collect_list(F.struct("window_id", "n", "mae", "rmse"))).alias("windows"))
    path = _scratch(spark, "report")
    schema = report.schema
    AR.write_report(report, path)
    back = spark.read.schema(schema).json(path)
    return back.select("n_total", F.inline("windows"))


@register("rows_by_partition_value", f"""WITH r AS ({O.signal_rows('hour')})
SELECT year(timestamp) AS year, strftime(timestamp, '%m') AS month, strftime(timestamp, '%d') AS day, count(*) AS n FROM r GROUP BY 1, 2, 3""")
def rows_by_partition_value(spark, sf_dir):
    """Landed rows by the partition values that the lake would give them."""
    return LK.with_partition_columns(B.raw_signal_rows(spark, sf_dir)).groupBy("year", "month", "day").agg(F.count(F.lit(1)).alias("n"))


@register("wide_frame_inferred", O.rounded(f"""{W_H}
SELECT timestamp, {', '.join(f"max(value) FILTER (WHERE signal_name = '{s}') AS {s}" for s in WIDE_SIGNALS)}
FROM stg_gen GROUP BY timestamp""", WIDE_SIGNALS))
def wide_frame_inferred(spark, sf_dir):
    """The dynamic pivot with its columns taken from the signals present."""
    return RS.pivot_dynamic(warehouse(spark, sf_dir).stg_generation_load, ["timestamp"], "signal_name", "value")


# --- B19, M2 -----------------------------------------------------------------------------

@register("sampled_rows_by_key", O.rounded(f"""WITH r AS ({O.signal_rows('hour')})
SELECT event_id, timestamp, signal, value FROM r
WHERE ((event_id % {AN.KEY_RANGE} + 42) % {AN.KEY_RANGE}) * {AN.KEY_FACTOR} % {AN.KEY_RANGE} < 0.05 * {AN.KEY_RANGE}""", ["value"]))
def sampled_rows_by_key(spark, sf_dir):
    """A seeded 5 % sample that depends on the rows' keys alone, not on files or partitions (sampling is the feature)."""
    rows = B.raw_signal_rows(spark, sf_dir).select("event_id", "timestamp", "signal", "value")
    return AN.sample_by_key(rows, "event_id", 0.05, seed=42)


@register("stream_dedup_keys", """SELECT date_trunc('hour', ts) AS timestamp, event_type, CAST(1 AS BIGINT) AS n, true AS from_input
FROM events GROUP BY 1, 2""")
def stream_dedup_keys(spark, sf_dir):
    """M2: what holds for any order of arrival: the deduplicated stream has each key once, by a row that came in."""
    ev = _events_stream(spark, sf_dir).withColumn("timestamp", F.date_trunc("HOUR", "ts"))
    d = SI.dedup_stream(ev, ["timestamp", "event_type"], "ts", "2 hours")
    root = _scratch(spark, "stream-dedup-keys")
    SI.run_available_now(d.select("timestamp", "event_type", "event_id", "value"), f"{root}/out", f"{root}/_checkpoint")
    known = B.events(spark, sf_dir).select("event_id", "event_type", F.date_trunc("HOUR", "ts").alias("timestamp"), F.col("value").alias("was"))
    out = spark.read.parquet(f"{root}/out").join(known, ["event_id", "event_type", "timestamp"], "left")
    return out.groupBy("timestamp", "event_type").agg(
        F.count(F.lit(1)).alias("n"), F.bool_and(F.col("value").eqNullSafe(F.col("was"))).alias("from_input"))
