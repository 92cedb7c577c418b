"""Queries of what is stamped on rows and of what results look like: units, order, rounding, model reports, table names."""

from __future__ import annotations

from pyspark.sql import functions as F

from ampere import bindings as B
from ampere.config import MARKET_TZ
from ampere.functions.output import read_ordered, rounded, write_ordered
from ampere.operators import metrics as MT
from ampere.plans import oracle as O
from ampere.plans.products import Warehouse, materialize
from ampere.queries import CAT, LOCAL_SQL, ONE_FEATURE_SQL, W_H, _one_feature, _scratch, register, warehouse
from ampere.sources import payloads as PL
from ampere.sources import reads as RD

# --- A4, H27: stamped series, values that are no numbers -------------------------------

UNITS = {**{s: "MW" for s in CAT.load}, **{s: "MWh" for s in CAT.generation}, CAT.home_price: "EUR/MWh"}
#: What stands in place of the values of some hours.
NO_NUMBERS = {3: "n/a", 5: "", 11: "12.5f", 17: "1,5"}
BLANKED = 20


@register("series_payload_stamped", O.rounded(f"""{W_H} SELECT signal, timestamp,
  CASE WHEN hour(timestamp) NOT IN ({', '.join(map(str, NO_NUMBERS))}) THEN value END AS value,
  CASE signal {' '.join(f"WHEN '{s}' THEN '{u}'" for s, u in UNITS.items())} END AS unit, 'hour' AS resolution FROM sig""", ["value"]))
def series_payload_stamped(spark, sf_dir):
    """All chunks of all signals as one table with unit and resolution; values that are no numbers are null."""
    text = F.col("value").cast("string")
    hour = F.hour("timestamp")
    for h, t in NO_NUMBERS.items():
        text = F.when(hour == h, t).otherwise(text)
    text = F.when(hour == BLANKED, F.concat(F.lit("  "), text, F.lit(" "))).otherwise(text)
    landed = B.raw_signals(spark, sf_dir).select("signal", "timestamp", text.alias("value"), F.date_trunc("WEEK", "timestamp").alias("chunk"))
    rows = PL.parse_series_payload(PL.series_payload(landed, ["signal", "chunk"]), keep=["signal"])
    return PL.stamp_series(rows, UNITS, "hour").select("signal", "timestamp", "value", "unit", "resolution")


# --- F1: stored order --------------------------------------------------------------------

@register("ordered_generation", O.rounded(f"""{W_H}, g AS ({O.pivot_gen_sql()})
SELECT timestamp, resolution, total_generation_mw, row_number() OVER (ORDER BY timestamp, resolution) - 1 AS position FROM g""",
                                          ["total_generation_mw"]))
def ordered_generation(spark, sf_dir):
    """the generation table stored in order, read back with the place of each row in its files."""
    path = _scratch(spark, "ordered-generation")
    write_ordered(warehouse(spark, sf_dir).fct_generation_load.select("timestamp", "resolution", "total_generation_mw"), path,
                  ["timestamp", "resolution"])
    return read_ordered(spark, path)


# --- B11: one day as a range ---------------------------------------------------------------

MARKET_DAY = "2024-01-07"


@register("market_day_rows", f"""WITH r AS ({O.signal_rows('hour')}) SELECT signal, count(*) AS n, min(timestamp) AS first, max(timestamp) AS last
FROM r WHERE CAST({LOCAL_SQL} AS DATE) = DATE '{MARKET_DAY}' GROUP BY 1""")
def market_day_rows(spark, sf_dir):
    """Landed rows of one market day, found by a range of instants that reaches the scan."""
    rows = B.raw_signal_rows(spark, sf_dir).where(RD.on_day(F.col("timestamp"), MARKET_DAY, MARKET_TZ))
    return rows.groupBy("signal").agg(F.count(F.lit(1)).alias("n"), F.min("timestamp").alias("first"), F.max("timestamp").alias("last"))


# --- H21 -------------------------------------------------------------------------------------

@register("rounded_mix_share", f"""{W_H}, t AS (SELECT month(timestamp) AS month, signal_name, sum(CAST(value AS DECIMAL(18, 2))) AS s
FROM stg_gen GROUP BY 1, 2)
SELECT month, signal_name, round_even(CAST(100 * s / sum(s) OVER (PARTITION BY month) AS DOUBLE), 1) AS share_pct FROM t""")
def rounded_mix_share(spark, sf_dir):
    """Share of each signal in its month's total, in per cent with one digit."""
    g = warehouse(spark, sf_dir).stg_generation_load.select(F.month("timestamp").alias("month"), "signal_name",
                                                           F.col("value").cast("decimal(18,2)").alias("value"))
    parts = g.groupBy("month", "signal_name").agg(F.sum("value").alias("s"))
    share = parts.join(parts.groupBy("month").agg(F.sum("s").alias("total")), "month").withColumn(
        "share_pct", (100 * F.col("s").cast("double")) / F.col("total").cast("double"))
    return share.select("month", "signal_name", *rounded(["share_pct"], 1))


# --- J17: the report of one model ----------------------------------------------------------------

SCORES = ["mae", "rmse", "r2", "directional_accuracy", "mape"]


def _score_sql(pred: str, hit: str, prefix: str) -> str:
    return (f"avg(abs({pred} - y)) AS {prefix}mae, sqrt(avg(({pred} - y) * ({pred} - y))) AS {prefix}rmse, "
            f"1 - sum(({pred} - y) * ({pred} - y)) / nullif(var_pop(y) * count(y), 0) AS {prefix}r2, "
            f"avg(CASE WHEN {hit} THEN 1.0 ELSE 0.0 END) AS {prefix}directional_accuracy, "
            f"100 * avg(CASE WHEN y <> 0 THEN abs(({pred} - y) / y) END) AS {prefix}mape")


@register("model_report_fields", O.rounded(f"""{W_H}, {ONE_FEATURE_SQL},
s AS (SELECT *, coalesce((pred - lag(pred) OVER w) * (y - lag(y) OVER w) > 0, false) AS hit,
             coalesce((ref - lag(ref) OVER w) * (y - lag(y) OVER w) > 0, false) AS bhit
      FROM pw WINDOW w AS (PARTITION BY in_holdout ORDER BY timestamp))
SELECT in_holdout, count(*) AS n_holdout, max(n_train) AS n_train, CAST(1 AS BIGINT) AS n_features, CAST(0.0 AS DOUBLE) AS ridge,
       'fixed' AS tuned_by, avg(CASE WHEN (pred > ref) = (y > ref) THEN 1.0 ELSE 0.0 END) AS deviation_directional_accuracy,
       {_score_sql('pred', 'hit', 'holdout_')}, {_score_sql('ref', 'bhit', 'baseline_')} FROM s GROUP BY in_holdout""",
                                           ["deviation_directional_accuracy", *[f"{p}_{c}" for p in ("holdout", "baseline") for c in SCORES]]))
def model_report_fields(spark, sf_dir):
    """The nested report of the one-feature model on both kinds of windows, spread to columns."""
    r = MT.model_report(_one_feature(spark, sf_dir), ["in_holdout"], "timestamp", "y", "pred", "ref", {"ridge": 0.0}, n_train="n_train",
                        n_features=1, source={"tuned_by": "fixed"})
    at = lambda path, name: F.col(f"report.{path}").alias(name)
    m = {"holdout": "metrics.holdout", "baseline": "metrics.baseline_persistence"}
    return r.select("in_holdout", at("n_holdout", "n_holdout"), at("n_train", "n_train"), at("n_features", "n_features"),
                    at("hyperparameters.ridge", "ridge"), at("hyperparameters_source.tuned_by", "tuned_by"),
                    at("metrics.holdout.deviation_directional_accuracy", "deviation_directional_accuracy"),
                    *[at(f"{path}.{c}", f"{p}_{c}") for p, path in m.items() for c in SCORES])


# --- N-7: tables by schema -------------------------------------------------------------------------

STORED = ["stg_prices", "stg_neighbour_prices", "fct_market_prices", "fct_price_spreads"]


@register("tables_by_schema", f"""{W_H}, sp AS ({O.spreads_sql()})
SELECT 'analytics.fct_market_prices' AS "table", count(*) AS n, min(timestamp) AS first, max(timestamp) AS last FROM stg_prices
UNION ALL SELECT 'analytics.fct_price_spreads', count(*), min(timestamp), max(timestamp) FROM sp""")
def tables_by_schema(spark, sf_dir):
    """N-7/A31: prices and spreads stored under their schema's name, and what each table holds."""
    own = Warehouse(spark, warehouse(spark, sf_dir).raw, CAT)
    written = materialize(own, _scratch(spark, "by-schema"), STORED, by_schema=True)
    parts = [spark.read.parquet(path).agg(F.lit(name).alias("table"), F.count(F.lit(1)).alias("n"), F.min("timestamp").alias("first"),
                                          F.max("timestamp").alias("last")) for name, path in sorted(written.items())]
    return parts[0].unionByName(parts[1])
