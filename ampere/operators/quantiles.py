"""Exact quantiles of groups of any size.

A quantile is the value at a rank. The range that holds the rank is cut into
equal bins, the bins are counted (partial counts per task), and the bin with
the rank becomes the next range, with its own least and greatest value as
ends. Only ranges with more than ``SMALL`` rows are cut again; what remains
is counted by value and the rank is read off. No task ever holds a group: a
window runs over at most ``BINS`` bins or ``SMALL`` values.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ampere.session import cut_lineage

#: Bins that a range is cut into, and rows of a range that are counted by value.
BINS, SMALL = 4096, 100_000


def _in_ranges(rows: DataFrame, ranges: DataFrame) -> DataFrame:
    """(_k, lo, hi, _v): the rows inside any of the (disjoint) ranges of their group."""
    r = ranges.select(F.col("_k").alias("_rk"), "lo", "hi").distinct()
    return rows.join(r, rows["_k"].eqNullSafe(r["_rk"]) & rows["_v"].between(r["lo"], r["hi"])).select("_k", "lo", "hi", "_v")


def _with_rank(state: DataFrame, counts: DataFrame, order: str, *more: str) -> DataFrame:
    """``state`` with the entry of ``counts(_k, lo, hi, order, c)`` that holds its rank, and the rows ``before`` it."""
    w = Window.partitionBy("_k", "lo", "hi").orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    c = counts.withColumn("before", F.sum("c").over(w) - F.col("c")).select(
        F.col("_k").alias("_ck"), F.col("lo").alias("_clo"), F.col("hi").alias("_chi"), "c", "before", *more)
    at = F.col("rank") - F.col("below")
    return state.join(c, state["_k"].eqNullSafe(c["_ck"]) & (F.col("lo") == F.col("_clo")) & (F.col("hi") == F.col("_chi"))
                      & (at >= F.col("before")) & (at < F.col("before") + F.col("c")))


def exact_quantiles(df: DataFrame, keys: Sequence[str], value: str, probs: Mapping[str, float], bins: int = BINS,
                    small: int = SMALL) -> DataFrame:
    """One row per group with the quantile ``probs[name]`` of ``value`` as column ``name``.

    Between two ranks the value is interpolated linearly. Null and NaN values
    don't count; groups without values are left out; a null key is a group.
    """
    key = F.struct(*[F.col(k) for k in keys]) if keys else F.struct(F.lit(0).alias("_all"))
    rows = df.select(key.alias("_k"), F.col(value).cast("double").alias("_v"))
    rows = cut_lineage(rows.where(F.col("_v").isNotNull() & ~F.isnan("_v")), "quantile-rows")
    ends = cut_lineage(rows.groupBy("_k").agg(F.count(F.lit(1)).alias("n"), F.min("_v").alias("lo"), F.max("_v").alias("hi")),
                       "quantile-groups")

    def ranks(p: float) -> tuple[Column, Column]:
        first = F.floor(F.lit(float(p)) * (F.col("n") - 1)).cast("long")
        return first, F.least(first + 1, F.col("n") - 1)

    wanted = F.array_distinct(F.array(*[r for p in probs.values() for r in ranks(p)]))
    state = ends.select("_k", "lo", "hi", F.lit(0).cast("long").alias("below"), F.col("n").alias("inside"),
                        F.explode(wanted).alias("rank"))
    columns = state.columns
    while True:
        open_ = (F.col("inside") > small) & (F.col("lo") < F.col("hi"))
        if not state.where(open_).head(1):
            break
        # quarters, so that the width of a range over all doubles is finite (it may round to 0 between the least doubles)
        part = F.coalesce(F.try_divide(F.col("_v") / 4 - F.col("lo") / 4, F.col("hi") / 4 - F.col("lo") / 4), F.lit(0.0))
        at = F.when(F.col("_v") == F.col("hi"), bins - 1).otherwise(F.least(F.floor(part * bins), F.lit(bins - 1)))
        counts = (_in_ranges(rows, state.where(open_)).groupBy("_k", "lo", "hi", at.alias("bin"))
                  .agg(F.count(F.lit(1)).alias("c"), F.min("_v").alias("blo"), F.max("_v").alias("bhi")))
        cut = _with_rank(state.where(open_), counts, "bin", "blo", "bhi").select(
            "_k", F.col("blo").alias("lo"), F.col("bhi").alias("hi"), (F.col("below") + F.col("before")).alias("below"),
            F.col("c").alias("inside"), "rank")
        state = cut_lineage(cut.unionByName(state.where(~open_)).select(*columns), "quantile-ranges")
    single = state.where("lo = hi").select("_k", "rank", F.col("lo").alias("v"))
    values = (_in_ranges(rows, state.where("lo < hi")).groupBy("_k", "lo", "hi", "_v").agg(F.count(F.lit(1)).alias("c")))
    found = _with_rank(state.where("lo < hi"), values, "_v", "_v").select("_k", "rank", F.col("_v").alias("v"))
    by_rank = (found.unionByName(single).groupBy(F.col("_k").alias("_vk"))
               .agg(F.map_from_entries(F.collect_list(F.struct("rank", "v"))).alias("_m")))   # two entries a quantile

    def quantile(p: float) -> Column:
        a, b = (F.element_at("_m", r) for r in ranks(p))
        return a + (b - a) * (F.lit(float(p)) * (F.col("n") - 1) - ranks(p)[0])

    out = ends.join(by_rank, ends["_k"].eqNullSafe(by_rank["_vk"]))
    return out.select(*[F.col(f"_k.{k}").alias(k) for k in keys], *[quantile(p).alias(n) for n, p in probs.items()])


def joined_on(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``left`` with the other columns of ``right`` (one row per group), null keys matching."""
    if not keys:
        return left.join(F.broadcast(right))   # both have one row
    r = right.select(*[F.col(k).alias(f"_r_{k}") for k in keys], *[c for c in right.columns if c not in keys])
    cond = F.lit(True)
    for k in keys:
        cond = cond & left[k].eqNullSafe(r[f"_r_{k}"])
    return left.join(r, cond, "left").drop(*[f"_r_{k}" for k in keys])
