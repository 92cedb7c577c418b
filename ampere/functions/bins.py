"""Interval binning."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def fixed_bins(x, lo: float, hi: float, width: float) -> tuple[Column, Column, Column]:
    """Right-closed bins ``(lo + k*w, lo + (k+1)*w]`` over explicit edges
    ``lo..hi``; values outside ``(lo, hi]`` get null. Returns (index, left, right)."""
    x = F.col(x) if isinstance(x, str) else x
    idx = F.when((x > lo) & (x <= hi), F.ceil((x - F.lit(lo)) / F.lit(width)) - 1)
    left = F.lit(lo) + idx * F.lit(width)
    return idx.cast("int"), left, left + F.lit(width)


def equal_width_bins(df: DataFrame, x: str, n: int) -> DataFrame:
    """``n`` equal-width right-closed bins over [min, max]; the first
    bin's left edge is widened by 0.1 % of the range so the minimum falls in.

    Two passes: the (min, max) of the column as one scalar subquery (computed
    once, used as a value), then per-row arithmetic. Adds ``bin``,
    ``bin_left``, ``bin_right``, ``bin_mid``.
    """
    mm = df.agg(F.struct(F.min(x).alias("lo"), F.max(x).alias("hi"))).scalar()
    out = df.withColumn("_lo", mm.getField("lo")).withColumn("_hi", mm.getField("hi"))
    w = (F.col("_hi") - F.col("_lo")) / F.lit(n)
    # a constant column has bins of no width: all rows fall into the first
    k = F.least(F.greatest(F.coalesce(F.ceil(F.try_divide(F.col(x) - F.col("_lo"), w)) - 1, F.lit(0)), F.lit(0)), F.lit(n - 1))
    out = out.withColumn("bin", F.when(F.col(x).isNotNull(), k).cast("int"))
    left = F.col("_lo") + F.col("bin") * w
    left = F.when(F.col("bin") == 0, F.col("_lo") - (F.col("_hi") - F.col("_lo")) * F.lit(0.001)).otherwise(left)
    right = F.col("_lo") + (F.col("bin") + 1) * w
    return (out.withColumn("bin_left", left).withColumn("bin_right", right)
               .withColumn("bin_mid", (F.col("bin_left") + F.col("bin_right")) / 2).drop("_lo", "_hi"))
