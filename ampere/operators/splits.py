"""Time-ordered splits, prediction windows and CV folds."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def temporal_split(df: DataFrame, ts: str = "timestamp", holdout_start: str | None = None,
                   holdout_days: int = 90) -> DataFrame:
    """``role`` = 'test' for ts >= cut, else 'trainval'; cut = given date
    or max(ts) - holdout_days (scalar subquery)."""
    if holdout_start is not None:
        cut = F.lit(holdout_start).cast("timestamp")
        return df.withColumn("role", F.when(F.col(ts) >= cut, "test").otherwise("trainval"))
    cut = df.agg(F.max(ts) - F.make_dt_interval(F.lit(holdout_days))).scalar()
    return df.withColumn("role", F.when(F.col(ts) >= cut, "test").otherwise("trainval"))


def prediction_windows(bounds: DataFrame, first: str = "first_start", holdout: str = "holdout_start",
                       end: str = "holdout_end", step_days: int = 7) -> DataFrame:
    """Window starts = first start, then each following Monday before the
    hold-out, the hold-out start, then each following Monday before the end;
    each window ends at the next start, the last at the hold-out end.

    ``bounds`` is a one-row frame of dates; windows are generated in-task
    (number of weeks in the range), then numbered by a small window.
    """
    def mondays_after(d, until):
        first_mon = F.date_add(d, step_days - F.weekday(d))
        return F.filter(F.sequence(first_mon, F.greatest(first_mon, until), F.expr(f"INTERVAL {step_days} DAYS")),
                        lambda x: x < until)
    starts = F.array_distinct(F.array_sort(F.concat(
        F.array(F.col(first)), mondays_after(F.col(first), F.col(holdout)),
        F.array(F.col(holdout)), mondays_after(F.col(holdout), F.col(end)))))
    rows = bounds.select(F.posexplode(starts).alias("window_id", "start"), F.col(end).alias("_end"), F.col(holdout).alias("_ho"))
    w = Window.orderBy("start")
    return (rows.withColumn("end", F.coalesce(F.lead("start").over(w), F.col("_end")))
                .withColumn("in_holdout", F.col("start") >= F.col("_ho"))
                .withColumn("window_id", F.col("window_id") + 1).drop("_end", "_ho"))


def assign_window(df: DataFrame, windows: DataFrame, ts: str = "timestamp", day: Column | None = None) -> DataFrame:
    """Rows tagged with the window whose [start, end) holds their day (default: the UTC date).

    Windows are expanded to one row per day (bounded by the calendar span) and
    joined on the day — an equi-join instead of a range join.
    """
    days = windows.select("window_id", "start", "end", "in_holdout",
                          F.explode(F.sequence("start", F.date_sub("end", 1))).alias("_day"))
    day = F.to_date(F.col(ts)) if day is None else day
    return df.join(F.broadcast(days), day == F.col("_day")).drop("_day")


def global_row_index(df: DataFrame, order: str, partition: Sequence[str] = (),
                     bucket: Column | None = None, out: str = "row_idx") -> DataFrame:
    """0-based row number over a whole ordered series without one-task
    windows: per-bucket counts, a prefix sum over the (small) bucket table,
    plus the row number inside the bucket."""
    part = list(partition)
    bucket = F.to_date(F.col(order)) if bucket is None else bucket
    t = df.withColumn("_b", bucket)
    counts = t.groupBy(*part, "_b").agg(F.count(F.lit(1)).alias("_n"))
    wb = Window.partitionBy(*part).orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.withColumn("_off", F.coalesce(F.sum("_n").over(wb), F.lit(0))).drop("_n")
    t = t.join(counts, [*part, "_b"])
    r = F.row_number().over(Window.partitionBy(*part, "_b").orderBy(order)) - 1
    return t.withColumn(out, F.col("_off") + r).drop("_b", "_off")


def ts_cv_folds(df: DataFrame, n_splits: int, gap: int, order: str = "timestamp",
                partition: Sequence[str] = ()) -> DataFrame:
    """Expanding-window time-series CV. With n rows, test size =
    n // (k+1); fold i tests rows [n - (k-i+1)*t, +t) and trains on rows before
    test start - gap. Returns each row once per fold it takes part in, with
    ``fold`` (1..k) and ``role`` ('train' | 'test')."""
    part = list(partition)
    idx = global_row_index(df, order, part)
    if part:
        n = idx.groupBy(*part).agg(F.count(F.lit(1)).alias("_n"))
        j = idx.join(n, part)   # one row per series; AQE broadcasts it when small
    else:
        j = idx.withColumn("_n", idx.agg(F.count(F.lit(1))).scalar())
    t = F.floor(F.col("_n") / (n_splits + 1))
    folds = F.sequence(F.lit(1), F.lit(n_splits))
    j = j.withColumn("fold", F.explode(folds))
    test_start = F.col("_n") - (F.lit(n_splits) - F.col("fold") + 1) * t
    role = (F.when((F.col("row_idx") >= test_start) & (F.col("row_idx") < test_start + t), "test")
             .when(F.col("row_idx") < test_start - gap, "train"))
    return j.withColumn("role", role).where(F.col("role").isNotNull()).drop("_n")


def ts_cv_roles(df: DataFrame, n_splits: int, gap: int, order: str = "timestamp") -> DataFrame:
    """The folds of :func:`ts_cv_folds` with every row once.

    The training sets grow, so a row is told by the first fold that trains on
    it (``train_from``, ``n_splits + 1`` if none does); test sets are disjoint
    (``test_fold``, null outside of them).
    """
    idx = global_row_index(df, order)
    j = idx.withColumn("_n", idx.agg(F.count(F.lit(1))).scalar())
    t = F.floor(F.col("_n") / (n_splits + 1))
    folds, row = F.sequence(F.lit(1), F.lit(n_splits)), F.col("row_idx")
    start = lambda i: F.col("_n") - (F.lit(n_splits) - i + 1) * t
    trained = F.get(F.filter(folds, lambda i: row < start(i) - gap), F.lit(0))
    tested = F.get(F.filter(folds, lambda i: (row >= start(i)) & (row < start(i) + t)), F.lit(0))
    return (j.withColumn("train_from", F.coalesce(trained, F.lit(n_splits + 1)).cast("long"))
             .withColumn("test_fold", tested.cast("long")).drop("_n"))
