"""Analysis aggregates.

All are single ``groupBy``/``agg`` passes with map-side partial aggregation,
generic over (time, key, value) columns.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ampere.functions.time import week_label
from ampere.operators.quantiles import exact_quantiles, joined_on

RESAMPLE_UNITS = ("day", "week", "month", "year")


def _bin_start(day: Column, unit: str) -> Column:
    if unit not in RESAMPLE_UNITS:
        raise ValueError(f"unknown unit {unit}")
    return F.to_date(F.date_trunc(unit.upper(), day))


def resample_mean(df: DataFrame, ts: str, values: Sequence[str], unit: str,
                  keys: Sequence[str] = (), spine: bool = False) -> DataFrame:
    """Mean per calendar bin. Week bins run Monday-Sunday and are
    labelled by their Sunday; month/year bins by their first day.

    With ``spine`` every bin between the first and the last of a series is
    there, empty ones with null means, as a regular calendar has them. The bins
    are generated from each series' first and last bin, inside the tasks.
    """
    label = (lambda start: week_label(start)) if unit == "week" else (lambda start: start)
    means = df.groupBy(*keys, _bin_start(F.col(ts), unit).alias("_bin")).agg(*[F.avg(v).alias(v) for v in values])
    if spine:
        ends = means.groupBy(*keys).agg(F.min("_bin").alias("_lo"), F.max("_bin").alias("_hi"))
        bins = ends.where(F.col("_lo").isNotNull()).select(
            *keys, F.explode(F.sequence("_lo", "_hi", F.expr(f"INTERVAL 1 {unit.upper()}"))).alias("_bin"))
        means = joined_on(bins, means, [*keys, "_bin"])
    return means.select(*keys, label(F.col("_bin")).alias("period"), *values)


def group_mean(df: DataFrame, keys: Sequence[Column | str], values: Sequence[str]) -> DataFrame:
    """Mean per calendar key(s)."""
    return df.groupBy(*keys).agg(*[F.avg(v).alias(f"avg_{v}") for v in values])


def heatmap(df: DataFrame, row: str, col: str, value: str, col_values: Sequence,
            agg: str = "avg", prefix: str = "c") -> DataFrame:
    """Two-key aggregate unstacked into a matrix (explicit columns).

    ``agg='median'`` is exact by rank selection, cell by cell;
    ``agg='median_approx'`` uses the bounded-memory quantile sketch."""
    if agg == "median":
        rows = df.select(row).distinct()
        cells = exact_quantiles(df.where(F.col(col).isin(*col_values)), [row, col], value, {"_q": 0.5})
        wide = cells.groupBy(row).agg(*[F.max(F.when(F.col(col) == v, F.col("_q"))).alias(f"{prefix}{v}") for v in col_values])
        return joined_on(rows, wide, [row])
    f = {"avg": F.avg, "median_approx": lambda c: F.percentile_approx(c, 0.5, 10000)}[agg]
    return df.groupBy(row).agg(*[f(F.when(F.col(col) == v, F.col(value))).alias(f"{prefix}{v}")
                                 for v in col_values])


def weighted_share(df: DataFrame, keys: Sequence, part: Sequence[str], whole: Sequence[str],
                   out: str = "share") -> DataFrame:
    """Ratio of sums (sum of part columns / sum of whole columns), not a
    mean of ratios; nulls count as 0 in the row sums (D12)."""
    def rowsum(cols):
        e = F.lit(0.0)
        for c in cols:
            e = e + F.coalesce(F.col(c), F.lit(0.0))
        return e
    return df.groupBy(*keys).agg(F.try_divide(F.sum(rowsum(part)), F.sum(rowsum(whole))).alias(out))


def period_comparison(long: DataFrame, key: str, value: str, period: Column, a, b,
                      extra_keys: Sequence = ()) -> DataFrame:
    """Mean per key in period A and B and the change B - A."""
    return (long.groupBy(key, *extra_keys)
                .agg(F.avg(F.when(period == a, F.col(value))).alias("mean_a"),
                     F.avg(F.when(period == b, F.col(value))).alias("mean_b"))
                .withColumn("change", F.col("mean_b") - F.col("mean_a")))


def conditional_gap(df: DataFrame, keys: Sequence, value: str, cond_a: Column, cond_b: Column,
                    out: str = "gap") -> DataFrame:
    """avg(value | A) - avg(value | B), e.g. weekday minus Sunday."""
    g = df.groupBy(*keys) if keys else df.groupBy()
    return g.agg((F.avg(F.when(cond_a, F.col(value))) - F.avg(F.when(cond_b, F.col(value)))).alias(out))


def describe(df: DataFrame, keys: Sequence, value: str,
             percentiles: Sequence[float] = (0.05, 0.25, 0.5, 0.75, 0.95), approx: bool = False,
             accuracy: int = 10000, extra: Sequence[Column] = ()) -> DataFrame:
    """Count, mean, sample std, min, percentiles, max, and ``extra`` aggregates of the same pass.

    Exact percentiles (linear interpolation, as pandas) come from
    ``quantiles.exact_quantiles``, whose memory doesn't grow with a group.
    ``approx=True`` takes a mergeable quantile sketch of fixed size per group
    in the same pass (relative rank error ~ 1/accuracy)."""
    keys = list(keys)
    names = {f"p{int(round(q * 100)):02d}": q for q in percentiles}
    aggs = [F.count(value).alias("count"), F.avg(value).alias("mean"), F.stddev_samp(value).alias("std"),
            F.min(value).alias("min"), F.max(value).alias("max"), *extra]
    if approx:
        out = df.groupBy(*keys).agg(*aggs, F.percentile_approx(F.col(value), list(percentiles), accuracy).alias("_p"))
        return out.select("*", *[F.col("_p")[i].alias(n) for i, n in enumerate(names)]).drop("_p")
    return joined_on(df.groupBy(*keys).agg(*aggs), exact_quantiles(df, keys, value, names), keys)


def density_histogram(df: DataFrame, keys: Sequence[str], value: str, bins: int, low: float | None = None,
                      high: float | None = None) -> DataFrame:
    """``bin`` (0-based), rows ``n`` and ``density`` = n / (rows of the group * bin width), empty bins left out.

    Values are clipped to [low, high] first. Each group has its own range of
    equal left-closed bins, the last closed on both sides; a group of one value
    gets a range of width 1 around it.
    """
    x = F.col(value).cast("double")
    x = x if low is None else F.greatest(x, F.lit(float(low)))
    x = x if high is None else F.least(x, F.lit(float(high)))
    rows = df.where(F.col(value).isNotNull()).select(*keys, x.alias("_x"))
    one = F.when(F.min("_x") == F.max("_x"), 0.5).otherwise(0.0)
    ends = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"), (F.min("_x") - one).alias("_lo"), (F.max("_x") + one).alias("_hi"))
    at = F.least(F.floor((F.col("_x") - F.col("_lo")) / (F.col("_hi") - F.col("_lo")) * bins), F.lit(bins - 1))
    counted = joined_on(rows, ends, keys).groupBy(*keys, at.cast("long").alias("bin"), "_n", "_lo", "_hi").agg(F.count(F.lit(1)).alias("n"))
    return counted.select(*keys, "bin", "n", (F.col("n") / (F.col("_n") * ((F.col("_hi") - F.col("_lo")) / bins))).alias("density"))


def mode_per_group(df: DataFrame, keys: Sequence[str], value: str, out: str = "mode") -> DataFrame:
    """Most frequent value per group; ties -> smallest value.

    Counts per (group, value) first, then ``max(struct(count, -rank))`` —
    one aggregate, never a whole group in one task.
    """
    c = df.groupBy(*keys, value).agg(F.count(F.lit(1)).alias("_n"))
    best = c.groupBy(*keys).agg(F.min(F.struct((-F.col("_n")).alias("n"), F.col(value).alias("v"))).alias("_m"))
    return best.select(*keys, F.col("_m.v").alias(out), (-F.col("_m.n")).alias("mode_count"))


def share_where(df: DataFrame, keys: Sequence, conds: Mapping[str, Column], pct: bool = True) -> DataFrame:
    """Share (in %) of rows meeting each predicate."""
    scale = 100.0 if pct else 1.0
    g = df.groupBy(*keys) if keys else df.groupBy()
    return g.agg(*[(F.avg(c.cast("double")) * scale).alias(n) for n, c in conds.items()])


def threshold_table(df: DataFrame, value: str, thresholds: Sequence[float]) -> DataFrame:
    """Count and % of rows above each threshold (one pass; thresholds
    are a literal array exploded per row-group, not a cross join of data)."""
    aggs = []
    for i, t in enumerate(thresholds):
        aggs += [F.count_if(F.col(value) > t).alias(f"n_{i}")]
    n = F.count(F.col(value))
    wide = df.agg(n.alias("_n"), *aggs)
    rows = [F.struct(F.lit(float(t)).alias("threshold"), F.col(f"n_{i}").alias("hours"),
                     F.try_divide(F.col(f"n_{i}") * 100.0, F.col("_n")).alias("pct")) for i, t in enumerate(thresholds)]
    return wide.select(F.inline(F.array(*rows)))


def size_distribution(df: DataFrame, group: Sequence) -> DataFrame:
    """Rows per group, then how many groups have each size."""
    return (df.groupBy(*group).agg(F.count(F.lit(1)).alias("rows"))
              .groupBy("rows").agg(F.count(F.lit(1)).alias("groups")))


def pairwise_corr(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Correlation matrix in long form (a, b, corr); pairwise null
    deletion (each pair uses the rows where both are non-null), one pass."""
    aggs, pairs = [], []
    for i, a in enumerate(cols):
        for b in cols[i:]:
            both = F.col(a).isNotNull() & F.col(b).isNotNull()
            aggs.append(F.corr(F.when(both, F.col(a)), F.when(both, F.col(b))).alias(f"{a}__{b}"))
            pairs.append((a, b))
    wide = df.agg(*aggs)
    rows = []
    for a, b in pairs:
        rows.append(F.struct(F.lit(a).alias("a"), F.lit(b).alias("b"), F.col(f"{a}__{b}").alias("corr")))
        if a != b:
            rows.append(F.struct(F.lit(b).alias("a"), F.lit(a).alias("b"), F.col(f"{a}__{b}").alias("corr")))
    return wide.select(F.inline(F.array(*rows)))


def slope(df: DataFrame, keys: Sequence, y: str, x: str, where: Column | None = None, out: str = "slope") -> DataFrame:
    """Least-squares slope r * sy / sx (= covar_samp / var_samp)."""
    src = df.where(where) if where is not None else df
    g = src.groupBy(*keys) if keys else src.groupBy()
    return g.agg(F.regr_slope(F.col(y), F.col(x)).alias(out), F.count(F.when(F.col(x).isNotNull() & F.col(y).isNotNull(), 1)).alias("n"))


def deviation_from_cell_mean(df: DataFrame, value: str, cell: Sequence[str], out: str = "deviation") -> DataFrame:
    """Value minus the mean of its (e.g. hour, season) cell.

    Cell means come from a partially aggregated ``groupBy`` (one row per cell)
    joined back — no window, so a cell holding a large share of the rows is
    never gathered into one task. Adaptive execution broadcasts the means if
    they are small; cells are arbitrary, so no broadcast is forced."""
    means = df.groupBy(*cell).agg(F.avg(value).alias("_cell_mean"))
    return (df.join(means, list(cell), "left")
              .withColumn(out, F.col(value) - F.col("_cell_mean")).drop("_cell_mean"))


def top_k(df: DataFrame, order: Column, k: int) -> DataFrame:
    """top-k rows (TakeOrderedAndProject: per-partition top-k, then merge)."""
    return df.orderBy(order).limit(k)


def value_counts(df: DataFrame, col: str) -> DataFrame:
    """frequency table, most frequent first (ties by value)."""
    return df.groupBy(col).agg(F.count(F.lit(1)).alias("count")).orderBy(F.desc("count"), col)


def year_over_year(df: DataFrame, year: str, value: str, out: str = "yoy_change") -> DataFrame:
    """E6 on a per-year table (one row per year, tiny): change from the previous year."""
    return df.withColumn(out, F.col(value) - F.lag(value).over(Window.orderBy(year)))


def lead_correlation(df: DataFrame, x: str, y: str, order: str = "timestamp",
                     partition: Sequence[str] = (), out: str = "lead1_corr") -> DataFrame:
    """E5: corr(x_t, y_{next row}) per series. The next row comes from the
    global-row-index fold (a row lag of -1), so no series is ordered in one task."""
    from ampere.operators.lags import row_lag_indexed
    led = row_lag_indexed(df, {-1: {y: "_lead"}}, order, partition)
    g = led.groupBy(*partition) if partition else led.groupBy()
    return g.agg(F.corr(x, "_lead").alias(out))


#: Multiplicative hash of integer keys: range of the hash (a prime) and factor.
KEY_RANGE, KEY_FACTOR = 2_147_483_647, 1_103_515_245


def sample_by_key(df: DataFrame, key: str, fraction: float, seed: int = 0) -> DataFrame:
    """Rows whose integer ``key`` hashes below ``fraction``.

    Equal keys are taken or left together, and the same rows come out however
    the data are partitioned; a null key is left out. Only a filter: no shuffle.
    """
    if not 0 <= fraction <= 1:
        raise ValueError(f"fraction {fraction} is not between 0 and 1")
    k = F.col(key).cast("long")
    h = F.pmod((F.pmod(k, F.lit(KEY_RANGE)) + F.lit(seed % KEY_RANGE)) % KEY_RANGE * F.lit(KEY_FACTOR), F.lit(KEY_RANGE))
    return df.where(h < fraction * KEY_RANGE)
