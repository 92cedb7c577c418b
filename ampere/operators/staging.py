"""Staging views: NaN normalisation, validity rules, renames."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ampere.config import Catalog


def nan_to_null(c) -> Column:
    """B1: ``NULLIF(value, 'NaN')`` — NaN would otherwise win every ``max``."""
    c = F.col(c) if isinstance(c, str) else c
    return F.when(~F.isnan(c), c)


def generation_validity(signal: Column, value: Column, ts: Column, catalog: Catalog) -> Column:
    """Ordinary signals >= 0; retired signals >= 0 up to their cut;
    signed signals any value."""
    special = list(catalog.signed) + list(catalog.retired)
    ok = (~signal.isin(*special)) & (value >= 0) if special else value >= 0
    for sig, cut in catalog.retired.items():
        ok = ok | ((signal == sig) & (ts <= F.lit(cut).cast("timestamp")) & (value >= 0))
    if catalog.signed:
        ok = ok | signal.isin(*catalog.signed)
    return ok


def stage_generation(raw: DataFrame, catalog: Catalog, decimal: bool = False) -> DataFrame:
    """Valid, non-null generation/load rows; ``signal`` renamed ``signal_name``."""
    v = nan_to_null("value")
    if decimal:  # B7 opt-in exact numeric
        v = v.cast("decimal(18,4)")
    staged = raw.select(F.col("timestamp").cast("timestamp").alias("timestamp"),
                        F.col("signal").alias("signal_name"), v.alias("value"), "unit", "resolution")
    return staged.where(F.col("value").isNotNull() & generation_validity(
        F.col("signal_name"), F.col("value"), F.col("timestamp"), catalog))


def stage_forecast(raw: DataFrame, catalog: Catalog) -> DataFrame:
    """Forecasts; listed signals may be negative, others must be >= 0."""
    staged = raw.select(F.col("timestamp").cast("timestamp").alias("timestamp"),
                        F.col("issue_timestamp").cast("timestamp").alias("issue_timestamp"),
                        F.col("signal").alias("signal_name"), nan_to_null("value").alias("value"),
                        "unit", "resolution", F.col("fetched_at").cast("timestamp").alias("fetched_at"))
    ok = F.col("signal_name").isin(*catalog.forecast_signed) | (F.col("value") >= 0)
    return staged.where(F.col("value").isNotNull() & ok)


def stage_prices(raw: DataFrame) -> DataFrame:
    """Prices; only nulls/NaN dropped — negative prices are kept."""
    return (raw.select(F.col("timestamp").cast("timestamp").alias("timestamp"),
                       F.col("signal").alias("signal_name"), nan_to_null("value").alias("value"),
                       "unit", "resolution")
            .where(F.col("value").isNotNull()))


def stage_weather(raw: DataFrame) -> DataFrame:
    """I4: weather actuals; NaN -> null, nulls kept."""
    return raw.select(F.col("timestamp").cast("timestamp").alias("timestamp"), "region",
                      F.col("signal_type").alias("signal_name"), nan_to_null("value").alias("value"), "unit")


def stage_weather_forecast(raw: DataFrame) -> DataFrame:
    """I4: weather forecasts with issue/fetch times; nulls kept."""
    return raw.select(F.col("timestamp").cast("timestamp").alias("timestamp"),
                      F.col("issue_timestamp").cast("timestamp").alias("issue_timestamp"), "region",
                      F.col("signal_type").alias("signal_name"), nan_to_null("value").alias("value"), "unit",
                      "model", F.col("fetched_at").cast("timestamp").alias("fetched_at"))


def route_by_signal(long: DataFrame, routing, table: str) -> DataFrame:
    """Rows whose signal routes to ``table``; unknown signals are dropped.

    ``routing`` is the (signal, table) catalogue, either as rows (list of
    pairs) — then the route is an ``IN`` filter pushed into the scan — or as a
    DataFrame (catalogue table), joined as a broadcast semi-join; the
    catalogue has one row per signal, so its size is bounded by configuration.
    """
    if isinstance(routing, DataFrame):
        r = F.broadcast(routing.where(F.col("table") == table).select(F.col("signal").alias("_sig")))
        return long.join(r, long["signal"] == r["_sig"], "left_semi")
    sigs = sorted({s for s, t in routing if t == table})
    return long.where(F.col("signal").isin(*sigs))


def routed(long: DataFrame, routing: list[tuple[str, str]], out: str = "table") -> DataFrame:
    """A22 for all tables in one pass: each row once per table its signal routes to.

    The catalogue's signals are an ``IN`` filter pushed into the scan; the tables
    of a signal come from a constant map, so the rows are read once.
    """
    tables: dict[str, list[str]] = {}
    for signal, table in routing:
        tables.setdefault(signal, []).append(table)
    lookup = F.create_map(*[c for s, ts in sorted(tables.items())
                            for c in (F.lit(s), F.array(*map(F.lit, sorted(set(ts)))))])
    return (long.where(F.col("signal").isin(*sorted(tables)))
                .withColumn(out, F.explode(lookup[F.col("signal")])))
