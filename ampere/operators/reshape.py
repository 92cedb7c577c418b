"""Pivots and unpivots.

Pivots use an explicit value list (``max(when(...))``): one hash aggregate
with map-side partial aggregation, no extra job to discover distinct values,
and absent signals still yield (null) columns.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ampere.config import Catalog


def filtered_max(value: str, cond: Column) -> Column:
    """``MAX(value) FILTER (WHERE cond)``."""
    return F.max(F.when(cond, F.col(value)))


def pivot_signals(df: DataFrame, keys: Sequence[str], columns: Mapping[str, str],
                  signal: str = "signal_name", value: str = "value",
                  totals: Mapping[str, Sequence[str]] | None = None) -> DataFrame:
    """One column per listed signal (filtered max), plus filtered sums.

    A total is null when no row of its signal set exists for the key.
    """
    s = F.col(signal)
    aggs = [filtered_max(value, s == sig).alias(out) for sig, out in columns.items()]
    for out, sigs in (totals or {}).items():
        aggs.append(F.sum(F.when(s.isin(*sigs), F.col(value))).alias(out))
    return df.groupBy(*keys).agg(*aggs)


def pivot_generation_load(staged: DataFrame, catalog: Catalog) -> DataFrame:
    """Wide generation + load per (timestamp, resolution) + total generation."""
    return pivot_signals(staged, ["timestamp", "resolution"], catalog.generation_load,
                         totals={"total_generation_mw": list(catalog.generation)})


def pivot_forecast(staged: DataFrame, catalog: Catalog) -> DataFrame:
    """Wide forecasts per (timestamp, resolution)."""
    return pivot_signals(staged, ["timestamp", "resolution"], catalog.forecasts)


def pivot_region_variable(df: DataFrame, catalog: Catalog, suffix: str = "",
                          keys: Sequence[str] = ("timestamp",)) -> DataFrame:
    """Region x variable -> ``{variable}_{region alias}{suffix}`` columns."""
    r, v = F.col("region"), F.col("signal_name")
    aggs = [filtered_max("value", (r == reg) & (v == var)).alias(name)
            for reg, var, name in catalog.weather_columns(suffix)]
    return df.groupBy(*keys).agg(*aggs)


def price_spreads(neighbours: DataFrame, home: DataFrame, catalog: Catalog) -> DataFrame:
    """I8 (C1 + D6): per (timestamp, resolution) home price, each neighbour's
    price and spread = home - neighbour (inner join: both must exist)."""
    n = neighbours.select("timestamp", "resolution", F.col("signal_name").alias("neighbour"),
                          F.col("value").alias("neighbour_price_eur_mwh"))
    p = home.select("timestamp", "resolution", F.col("value").alias("home_price"))
    base = n.join(p, ["timestamp", "resolution"], "inner").withColumn(
        "spread", F.col("home_price") - F.col("neighbour_price_eur_mwh"))
    home_col = f"{catalog.home_price.lower()}_price_eur_mwh"
    aggs = [F.max("home_price").alias(home_col)]
    for sig, alias in catalog.neighbours.items():
        cond = F.col("neighbour") == sig
        aggs.append(filtered_max("neighbour_price_eur_mwh", cond).alias(f"{alias}_price_eur_mwh"))
        aggs.append(filtered_max("spread", cond).alias(f"{alias}_spread_eur_mwh"))
    return base.groupBy("timestamp", "resolution").agg(*aggs)


def pivot_dynamic(df: DataFrame, keys: Sequence[str], pivot_col: str, value: str,
                  values: Sequence[str] | None = None, check_unique: bool = True) -> DataFrame:
    """Wide pivot with ``first``; duplicate (keys, pivot value) rows are an
    error (checked with one aggregate + ``limit(1)`` job before pivoting)."""
    if check_unique:
        dup = df.groupBy(*keys, pivot_col).count().where("count > 1").limit(1).count()
        if dup:
            raise ValueError(f"duplicate ({', '.join(keys)}, {pivot_col}) rows: the pivot would be ambiguous")
    g = df.groupBy(*keys)
    g = g.pivot(pivot_col, list(values)) if values is not None else g.pivot(pivot_col)
    return g.agg(F.first(value))


def unpivot(df: DataFrame, ids: Sequence[str], values: Sequence[str],
            variable: str = "variable", value: str = "value") -> DataFrame:
    """Wide -> long (``stack``), keeping nulls."""
    return df.unpivot(list(ids), list(values), variable, value)
