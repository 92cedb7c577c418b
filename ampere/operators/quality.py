"""Data-quality checks (L1-L11). Every check returns the uniform long frame
``(check, table, key, n_violations)``; the per-table checks are fused into a
single aggregation pass."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

CHECK_SCHEMA = "check string, table string, key string, n_violations bigint"


def _row(check: str, table: str, key: str, n) -> F.Column:
    return F.struct(F.lit(check).alias("check"), F.lit(table).alias("table"), F.lit(key).alias("key"),
                    F.coalesce(n.cast("bigint"), F.lit(0).cast("bigint")).alias("n_violations"))


def unique_combination(df: DataFrame, table: str, key: Sequence[str]) -> DataFrame:
    """L1/L3: number of key values that occur more than once (and extra rows)."""
    dup = df.groupBy(*key).agg(F.count(F.lit(1)).alias("_n")).where("_n > 1")
    agg = dup.agg(F.count(F.lit(1)).alias("keys"), F.sum(F.col("_n") - 1).alias("extra"))
    k = ",".join(key)
    return agg.select(F.inline(F.array(_row("unique_combination", table, k, F.col("keys")),
                                       _row("duplicate_rows", table, k, F.col("extra")))))


def not_null_and_accepted(df: DataFrame, table: str, not_null: Sequence[str],
                          accepted: Mapping[str, Sequence] | None = None) -> DataFrame:
    """L2/L4 fused: one pass counting nulls per column and values outside an
    accepted list (nulls pass ``accepted_values`` as in the source tests)."""
    accepted = accepted or {}
    aggs = [F.count_if(F.col(c).isNull()).alias(f"nn_{c}") for c in not_null]
    aggs += [F.count_if(F.col(c).isNotNull() & ~F.col(c).isin(*vals)).alias(f"av_{c}") for c, vals in accepted.items()]
    wide = df.agg(*aggs)
    rows = [_row("not_null", table, c, F.col(f"nn_{c}")) for c in not_null]
    rows += [_row("accepted_values", table, c, F.col(f"av_{c}")) for c in accepted]
    return wide.select(F.inline(F.array(*rows)))


def missing_in_dimension(fact: DataFrame, table: str, day_expr, dim: DataFrame, dim_day: str = "date_day") -> DataFrame:
    """Fact rows whose day is absent from the dimension (null-safe anti
    join, unlike ``NOT IN``), counted per table."""
    f = fact.select(day_expr.alias("_d"))
    miss = f.join(dim.select(F.col(dim_day).alias("_d")), "_d", "left_anti")
    return miss.agg(F.count(F.lit(1)).alias("_n")).select(
        F.inline(F.array(_row("relationships", table, dim_day, F.col("_n")))))


def coverage(df: DataFrame, ts: str, series: Sequence[str], expected_per_day: int, day=None) -> DataFrame:
    """Per (series, day) row counts; days whose count differs from
    ``expected_per_day`` (HAVING)."""
    day = F.to_date(ts) if day is None else day
    c = df.groupBy(*series, day.alias("day")).agg(F.count(F.lit(1)).alias("rows"))
    return c.where(F.col("rows") != expected_per_day)


def missing_days(df: DataFrame, ts: str, series: Sequence[str] = ()) -> DataFrame:
    """Calendar days between first and last day of each series with no row."""
    d = df.select(*series, F.to_date(ts).alias("day"))
    b = d.groupBy(*series).agg(F.min("day").alias("_lo"), F.max("day").alias("_hi"))
    spine = b.select(*series, F.explode(F.sequence("_lo", "_hi")).alias("day"))
    return spine.join(d.distinct(), [*series, "day"], "left_anti")


def profile(df: DataFrame, keys: Sequence[str], value: str, low: float = 0.0, high: float = 100.0) -> DataFrame:
    """Rows, nulls, zeros, negatives, (low, high) values per key."""
    v = F.col(value)
    return df.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("rows"), F.count_if(v.isNull()).alias("nulls"),
        F.count_if(v == 0).alias("zeros"), F.count_if(v < 0).alias("negatives"),
        F.count_if((v > low) & (v < high)).alias("low_positive"))


def unit_consistency(df: DataFrame, key: str, unit: str) -> DataFrame:
    """First unit and number of distinct units per signal."""
    return df.groupBy(key).agg(F.min(unit).alias("unit"), F.countDistinct(unit).alias("n_units"))


def forecast_available(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row (rows, any_value) — the caller raises if either is falsy."""
    any_val = F.lit(False)
    for c in columns:
        any_val = any_val | F.col(c).isNotNull()
    return df.agg(F.count(F.lit(1)).alias("rows"), F.coalesce(F.max(any_val), F.lit(False)).alias("any_value"))


def assert_forecast_available(df: DataFrame, columns: Sequence[str]) -> None:
    r = forecast_available(df, columns).first()
    if not r["rows"]:
        raise ValueError("no forecast rows for the target day")
    if not r["any_value"]:
        raise ValueError("all forecast columns are null for the target day")


def freshness(df: DataFrame, fetched: str, now=None) -> DataFrame:
    """Age of the newest fetched row."""
    now = F.current_timestamp() if now is None else now
    return df.agg(F.max(fetched).alias("latest"), (F.unix_seconds(now) - F.unix_seconds(F.max(fetched))).alias("age_s"))
