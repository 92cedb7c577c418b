"""Queries of single reports: calendars with empty bins, full metrics, comparisons by year, rows that don't parse."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from ampere import bindings as B
from ampere import model_queries as MQ
from ampere.functions import time as TM
from ampere.operators import analysis as AN
from ampere.operators import lags as LG
from ampere.operators import metrics as MT
from ampere.operators import quality as QL
from ampere.operators import reshape as RS
from ampere.plans import backtest as BT
from ampere.plans import oracle as O
from ampere.queries import LOCAL_SQL, PERIOD_SQL, PRED_SQL, W_H, _predictions, register, warehouse
from ampere.sources import payloads as PL

# --- D11 on a calendar ------------------------------------------------------------

#: Series of whole orders that have empty bins: by price band for days and weeks, by customer for months.
BAND = 25_000
SERIES = {"day": f"CAST(floor(o_totalprice / {BAND}) AS BIGINT)", "week": f"CAST(floor(o_totalprice / {BAND}) AS BIGINT)", "month": "o_custkey"}


def _calendar(unit: str) -> None:
    start = f"CAST(date_trunc('{unit}', timestamp) AS DATE)"
    label = "bin + 6" if unit == "week" else "bin"
    sql = O.rounded(f"""WITH daily AS (SELECT {SERIES[unit]} AS series, CAST(o_orderdate AS TIMESTAMP) AS timestamp, sum(o_totalprice) AS value
FROM orders GROUP BY 1, 2), m AS (SELECT series, {start} AS bin, avg(value) AS value FROM daily GROUP BY 1, 2),
e AS (SELECT series, min(bin) AS lo, max(bin) AS hi FROM m GROUP BY 1),
g AS (SELECT series, CAST(unnest(generate_series(lo, hi, INTERVAL 1 {unit})) AS DATE) AS bin FROM e)
SELECT g.series, g.{label} AS period, m.value FROM g LEFT JOIN m ON m.series = g.series AND m.bin = g.bin""",
                    ["value"], dates=["period"])

    @register(f"resample_{unit}_calendar", sql)
    def q(spark, sf_dir, _u=unit):
        daily = B.table(spark, sf_dir, "orders").groupBy(F.expr(SERIES[_u]).alias("series"), F.col("o_orderdate").cast("timestamp").alias(
            "timestamp")).agg(F.sum("o_totalprice").alias("value"))
        return AN.resample_mean(daily, "timestamp", ["value"], _u, ["series"], spine=True)
    q.__doc__ = f"D11: mean per {unit} and series of all orders on a whole calendar; empty bins are null."


for _unit in ("day", "week", "month"):
    _calendar(_unit)


# --- K6, K4 ------------------------------------------------------------------------

@register("full_report_by_window", O.rounded(f"""{W_H}, {PRED_SQL},
pq AS (SELECT window_id, quantile_cont(y, 0.9) AS q FROM pw GROUP BY 1),
pk AS (SELECT pw.window_id, avg(abs(pred - y)) AS peak_mae FROM pw JOIN pq ON pw.window_id = pq.window_id WHERE y > q GROUP BY 1),
r AS (SELECT window_id, count(*) AS n, avg(abs(pred - y)) AS mae, sqrt(avg((pred - y) * (pred - y))) AS rmse,
       1 - sum((pred - y) * (pred - y)) / nullif(var_pop(y) * count(y), 0) AS r2,
       avg(CASE WHEN dir_hit THEN 1.0 ELSE 0.0 END) AS directional_accuracy,
       avg(CASE WHEN dev_hit THEN 1.0 ELSE 0.0 END) AS deviation_directional_accuracy FROM fl GROUP BY 1)
SELECT r.*, pk.peak_mae FROM r LEFT JOIN pk ON pk.window_id = r.window_id""",
                                             ["mae", "rmse", "r2", "directional_accuracy", "deviation_directional_accuracy", "peak_mae"]))
def full_report_by_window(spark, sf_dir):
    """K6: the whole report per window, directional metrics and peak error included."""
    return MT.full_report(_predictions(spark, sf_dir), ["window_id"], "timestamp", "y", "pred", ref="ref")


@register("minimal_report", O.rounded(f"""{W_H}, {PRED_SQL}
SELECT count(*) AS n, avg(abs(pred - y)) AS mae, sqrt(avg((pred - y) * (pred - y))) AS rmse,
       1 - sum((pred - y) * (pred - y)) / nullif(var_pop(y) * count(y), 0) AS r2 FROM pw""", ["mae", "rmse", "r2"]))
def minimal_report(spark, sf_dir):
    """K6: the report without its optional parts, over all windows."""
    return MT.full_report(_predictions(spark, sf_dir), [], "timestamp", "y", "pred", include_directional=False, include_peak=False)


# --- D16, D18, D41 -------------------------------------------------------------------

MIX = ["click_mw", "view_mw", "error_mw", "purchase_mw"]
MIX_SQL = f"""g AS ({O.pivot_gen_sql()}),
long AS (UNPIVOT (SELECT timestamp, {", ".join(MIX)} FROM g) ON {", ".join(MIX)} INTO NAME source VALUE value)"""


def _mix(spark, sf_dir):
    g = warehouse(spark, sf_dir, "hour", "orders").fct_generation_load
    return RS.unpivot(g.select("timestamp", *MIX), ["timestamp"], MIX, "source", "value")


@register("mix_change_by_month", O.dense(O.rounded(f"""WITH {O.staging_ctes('hour')}, {MIX_SQL}
SELECT source, avg(value) FILTER (WHERE month(timestamp) = 1) AS mean_a, avg(value) FILTER (WHERE month(timestamp) = 4) AS mean_b,
       avg(value) FILTER (WHERE month(timestamp) = 4) - avg(value) FILTER (WHERE month(timestamp) = 1) AS change,
       CAST(list_position([{O.inlist(MIX)}], source) - 1 AS BIGINT) AS position FROM long GROUP BY 1""", ["mean_a", "mean_b", "change"])))
def mix_change_by_month(spark, sf_dir):
    """Mean per source in January and April of the series, the change, in stack order."""
    c = AN.period_comparison(_mix(spark, sf_dir), "source", "value", F.month("timestamp"), 1, 4)
    return c.withColumn("position", F.array_position(F.array(*[F.lit(m) for m in MIX]), F.col("source")) - 1).orderBy("position")


ORDERS_DAILY = "daily AS (SELECT CAST(o_orderdate AS TIMESTAMP) AS timestamp, sum(o_totalprice) AS value FROM orders GROUP BY 1)"


@register("mix_change_by_year", O.rounded("""WITH y AS (SELECT o_orderpriority AS source, year(o_orderdate) AS year, o_totalprice AS value FROM orders),
e AS (SELECT min(year) AS a, max(year) AS b FROM y)
SELECT source, avg(value) FILTER (WHERE year = a) AS mean_a, avg(value) FILTER (WHERE year = b) AS mean_b,
       avg(value) FILTER (WHERE year = b) - avg(value) FILTER (WHERE year = a) AS change FROM y, e GROUP BY 1""",
                                          ["mean_a", "mean_b", "change"]))
def mix_change_by_year(spark, sf_dir):
    """Mean per source in the first and the last year, and the change, ordered by source."""
    o = B.table(spark, sf_dir, "orders").select(F.col("o_orderpriority").alias("source"), F.year("o_orderdate").alias("year"),
                                                F.col("o_totalprice").alias("value"))
    a, b = o.agg(F.min("year")).scalar(), o.agg(F.max("year")).scalar()
    return AN.period_comparison(o, "source", "value", F.col("year"), a, b).orderBy("source")


@register("weekday_sunday_gap_overall", O.rounded(f"""WITH {ORDERS_DAILY}
SELECT avg(value) FILTER (WHERE isodow(timestamp) <= 5) AS weekday_mean, avg(value) FILTER (WHERE isodow(timestamp) = 7) AS sunday_mean,
       avg(value) FILTER (WHERE isodow(timestamp) <= 5) - avg(value) FILTER (WHERE isodow(timestamp) = 7) AS gap FROM daily""",
                                                  ["weekday_mean", "sunday_mean", "gap"]))
def weekday_sunday_gap_overall(spark, sf_dir):
    """The weekday and the Sunday mean of the whole series, and the gap."""
    d, dow = B.daily_orders(spark, sf_dir), F.weekday("timestamp")
    both = d.agg(F.avg(F.when(dow < 5, F.col("value"))).alias("weekday_mean"), F.avg(F.when(dow == 6, F.col("value"))).alias("sunday_mean"))
    return both.withColumn("gap", AN.conditional_gap(d, [], "value", dow < 5, dow == 6).scalar())


@register("last_30_days_mix", O.dense(O.rounded(f"""WITH {O.staging_ctes('hour')}, {MIX_SQL},
r AS (SELECT * FROM long WHERE timestamp > (SELECT max(timestamp) FROM long) - INTERVAL 30 DAY AND value > 0),
t AS (SELECT sum(value) AS total FROM r)
SELECT source, sum(value) AS energy, sum(value) / any_value(total) * 100 AS share_pct FROM r, t GROUP BY 1""", ["energy", "share_pct"])))
def last_30_days_mix(spark, sf_dir):
    """Each source's share of the positive generation of the last 30 days."""
    m = _mix(spark, sf_dir)
    last = m.where(F.col("timestamp") > m.agg(F.max("timestamp")).scalar() - F.expr("INTERVAL 30 DAYS")).where("value > 0")
    by = last.groupBy("source").agg(F.sum("value").alias("energy"))
    return by.withColumn("share_pct", F.try_divide("energy", by.agg(F.sum("energy")).scalar()) * 100)


# --- G3, A5 on data that have such rows -----------------------------------------------

@register("missing_days_dense", O.dense(f"""WITH {O.staging_ctes('hour')}, d AS (SELECT DISTINCT signal, CAST(timestamp AS DATE) AS day FROM sig),
b AS (SELECT signal, min(day) AS lo, max(day) AS hi FROM d GROUP BY 1),
spine AS (SELECT signal, CAST(unnest(generate_series(lo, hi, INTERVAL 1 DAY)) AS DATE) AS day FROM b)
SELECT CAST(s.day AS TIMESTAMP) AS day, s.signal FROM spine s ANTI JOIN d ON s.signal = d.signal AND s.day = d.day"""))
def missing_days_dense(spark, sf_dir):
    """Days without a row in a series that has such days."""
    return QL.missing_days(B.raw_signals(spark, sf_dir, source="orders"), "timestamp", ["signal"])


@register("props_quarantine_damaged", """WITH e AS (SELECT event_id, CASE WHEN event_id % 10 = 3 THEN left(props, length(props) - 1)
WHEN event_id % 10 = 7 THEN 'k=' || props ELSE props END AS props FROM events)
SELECT event_id, props AS "_corrupt_record" FROM e WHERE NOT json_valid(props)""")
def props_quarantine_damaged(spark, sf_dir):
    """A5: quarantine of records that were cut off or have text before them."""
    e = B.table(spark, sf_dir, "events")
    cut = F.expr("left(props, length(props) - 1)")
    e = e.withColumn("props", F.when(F.col("event_id") % 10 == 3, cut).when(F.col("event_id") % 10 == 7, F.concat(F.lit("k="), "props"))
                     .otherwise(F.col("props")))
    return PL.parse_permissive(e, "props", T.StructType([T.StructField("k", T.LongType())]), keep=["event_id"])[1]


# --- J18 --------------------------------------------------------------------------------

@register("generation_backtest_rows", O.dense(O.rounded(f"""WITH {O.staging_ctes('hour')}, {MQ.WINDOWS}, g AS ({O.pivot_gen_sql()}),
s AS (SELECT timestamp, click_mw + view_mw AS wind_total_mw, view_mw AS solar_mw FROM g),
long AS (UNPIVOT (SELECT timestamp, wind_total_mw, solar_mw FROM s) ON wind_total_mw, solar_mw INTO NAME target VALUE y),
f AS (SELECT t.timestamp, CAST({LOCAL_SQL.replace("timestamp", "t.timestamp", 1)} AS DATE) AS day, t.target, t.y,
             coalesce(a.y, b.y) AS lag_24, b.y AS lag_168
      FROM long t LEFT JOIN long a ON a.target = t.target AND a.timestamp = t.timestamp - INTERVAL 24 HOUR
                  LEFT JOIN long b ON b.target = t.target AND b.timestamp = t.timestamp - INTERVAL 168 HOUR),
c AS (SELECT * FROM f WHERE y IS NOT NULL AND lag_24 IS NOT NULL AND lag_168 IS NOT NULL)
SELECT f.target, w.window_id, f.timestamp, f.y, f.lag_24, f.lag_168,
       (SELECT count(*) FROM c WHERE c.target = f.target AND c.day < w.start) AS n_train,
       f.lag_24 IS NOT NULL AND f.lag_168 IS NOT NULL AND (SELECT count(*) FROM c WHERE c.target = f.target AND c.day < w.start) > 0 AS predicted
FROM f JOIN win w ON f.day >= w.start AND f.day < w."end" WHERE w.window_id > 0""", ["y", "lag_24", "lag_168"])))
def generation_backtest_rows(spark, sf_dir):
    """Both generation targets, wind total and solar, with their patched lags, by the expanding-window fit."""
    g = warehouse(spark, sf_dir, "hour", "orders").fct_generation_load
    s = g.select("timestamp", (F.col("click_mw") + F.col("view_mw")).alias("wind_total_mw"), F.col("view_mw").alias("solar_mw"))
    win = MQ.windows(spark, sf_dir).where("window_id > 0")
    out = []
    for target in ("wind_total_mw", "solar_mw"):
        t = s.select("timestamp", F.col(target).alias("y")).where("y is not null")
        t = LG.lag_with_fallback(t, "y", [168], "lag_168")
        t = LG.lag_with_fallback(t, "y", [24, 168], "lag_24").withColumn("delivery_date", TM.delivery_date("timestamp"))
        p = BT.expanding_fit_predict(t, win, ["lag_24", "lag_168"], "y", day="delivery_date")
        out.append(p.select(F.lit(target).alias("target"), F.col("window_id").cast("long"), "timestamp", "y", "lag_24", "lag_168",
                            "n_train", F.col("pred").isNotNull().alias("predicted")))
    return out[0].unionByName(out[1])
