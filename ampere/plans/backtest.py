"""Weekly expanding-window two-stage forecast backtest.

Training set of window *w* = every row before the window's start. Instead of
refitting on a copy of that growing set per window, each row is tagged with
the bucket it falls in (0 = before the first window, else its window id). Every
task sums the products of ``[1, x..., y]`` of its rows per bucket in numpy; the
sums travel as one array per task and bucket and are added entry by entry. A
running sum over buckets, entry by entry, yields the training statistics of
*every* expanding window in one pass; a ``k x k`` ridge solve per window reads
that small table, and prediction is built-in array math.

Stage 1 predicts the hourly price. Stage 2 predicts the quarter-hour
deviation from the Stage-1 prediction of its hour (joined on the UTC hour) and
trains, for window *w*, only on quarter-hours of earlier windows, whose Stage-1
values are out-of-sample. Final quarter-hour forecast = Stage 1 + Stage 2.

Windows that can't be used are never left out silently: :func:`window_status`
gives each window's rule, and ``two_stage`` raises where a hold-out window has
no Stage-2 training rows.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ampere.operators.windows import complete_days, forward_fill_bucketed
from ampere.session import cut_lineage

#: Window states that take part: warm-up windows train Stage 2, predicted ones are scored.
USED = ("warm_up", "predicted")


def model_frame(df: DataFrame, fill: Sequence[str], required: Sequence[str], day: str = "delivery_date",
                ts: str = "timestamp", limit: int = 3, partition: Sequence[str] = ()) -> DataFrame:
    """E3 then E7: gaps of the ``fill`` columns take the value of the last
    ``limit`` rows (leave the target out of them), then every (local) day with a
    null in a ``required`` column goes as a whole. Frames for inference leave
    the target out of ``required``, too."""
    filled = forward_fill_bucketed(df, fill, ts, partition, limit, bucket=day)
    return complete_days(filled, required, ts, day, partition, together=True)   # the fill leaves days together


def gram_sums(df: DataFrame, features: Sequence[str], y: str, bucket: str = "bucket") -> DataFrame:
    """(bucket, pos, v): sums of the products of ``[1, x..., y]`` per bucket, the
    upper triangle row by row. Rows need complete features and target."""
    cols, size = [*features, y], len(features) + 2
    upper = np.triu_indices(size)

    def partial(batches):
        sums: dict[int, np.ndarray] = {}
        for pdf in batches:
            for b, part in pdf.dropna().groupby(bucket):
                m = np.column_stack([np.ones(len(part)), part[cols].to_numpy(dtype=float)])
                sums[b] = sums.get(b, 0.0) + m.T @ m
        for b, g in sums.items():
            yield pd.DataFrame({bucket: [int(b)], "g": [g[upper].tolist()]})

    # incomplete rows go inside the task: a filter over all columns makes the optimiser's constraints very many
    parts = df.select(F.col(bucket).cast("long").alias(bucket), *cols).mapInPandas(partial, f"{bucket} long, g array<double>")
    return (parts.select(bucket, F.posexplode("g").alias("pos", "v"))
            .groupBy(bucket, "pos").agg(F.sum("v").alias("v")))


def gram_arrays(sums: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row per key with its sums as the array ``g`` (as many numbers as pairs of features)."""
    entries = F.array_sort(F.collect_list(F.struct("pos", "v")))
    return sums.groupBy(*keys).agg(F.transform(entries, lambda e: e["v"]).alias("g"))


def cumulative_before(sums: DataFrame, windows: DataFrame, n_features: int, bucket: str = "bucket") -> DataFrame:
    """Training sums of each window = sums over the buckets strictly before it, as (window_id, g)."""
    size = (n_features + 2) * (n_features + 3) // 2
    zero = windows.select(F.col("window_id").cast("long").alias(bucket),
                          F.explode(F.sequence(F.lit(0), F.lit(size - 1))).alias("pos"), F.lit(0.0).alias("v"),
                          F.lit(True).alias("is_window"))
    every = (sums.select(bucket, "pos", "v", F.lit(False).alias("is_window")).unionByName(zero)
             .groupBy(bucket, "pos").agg(F.sum("v").alias("v"), F.max("is_window").alias("is_window")))
    run = Window.partitionBy("pos").orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)
    cum = every.select(F.col(bucket).alias("window_id"), "pos", "is_window",
                       F.coalesce(F.sum("v").over(run), F.lit(0.0)).alias("v"))
    return gram_arrays(cum.where("is_window"), ["window_id"])


def solve_ridge(grams: DataFrame, keys: dict[str, str], n_features: int) -> DataFrame:
    """``grams(keys..., ridge, g)`` to ``(keys..., n_train, beta)``:
    beta = (X'X + ridge * diag(X'X) on non-intercept terms)^-1 X'y, of least
    norm where the rows don't determine it; null without training rows.
    ``keys`` maps key columns to their types. Each row holds k^2 numbers."""
    size, k = n_features + 2, n_features + 1
    upper = np.triu_indices(size)

    def fit(batches):
        for pdf in batches:
            out = []
            for r in pdf.itertuples(index=False):
                full = np.zeros((size, size))
                full[upper] = r.g
                full = full + np.triu(full, 1).T
                n, beta = int(round(full[0, 0])), None
                if n:
                    reg = np.diag(np.r_[0.0, np.diag(full)[1:k]]) * r.ridge
                    beta = np.linalg.lstsq(full[:k, :k] + reg, full[:k, k], rcond=None)[0].tolist()
                out.append((*[getattr(r, c) for c in keys], n, beta))
            yield pd.DataFrame(out, columns=[*keys, "n_train", "beta"])

    schema = "".join(f"{c} {t}, " for c, t in keys.items()) + "n_train long, beta array<double>"
    return grams.select(*keys, F.col("ridge").cast("double").alias("ridge"), "g").mapInPandas(fit, schema)


def dot(features: Sequence[str], beta: Column) -> Column:
    """``[1, x...] . beta``; null if a feature or beta is null."""
    x = F.array(F.lit(1.0), *[F.col(f).cast("double") for f in features])
    return F.when(beta.isNotNull(),
                  F.aggregate(F.zip_with(x, beta, lambda a, b: a * b), F.lit(0.0), lambda acc, v: acc + v))


def tag_buckets(df: DataFrame, windows: DataFrame, day: Column) -> DataFrame:
    """window_id of each row (null outside all windows) and its training
    bucket (0 before the first window, else the window id)."""
    days = windows.select("window_id", F.explode(F.sequence("start", F.date_sub("end", 1))).alias("_day"))
    first = windows.agg(F.min("start")).scalar()
    j = df.withColumn("_d", day).join(F.broadcast(days), F.col("_d") == F.col("_day"), "left").drop("_day")
    return j.withColumn("bucket", F.when(F.col("_d") < first, F.lit(0)).otherwise(F.col("window_id"))).drop("_d")


def expanding_fit_predict(df: DataFrame, windows: DataFrame, features: Sequence[str], y: str,
                          ts: str = "timestamp", ridge: float = 1e-6, train_filter=None,
                          day: str | Column | None = None) -> DataFrame:
    """For every window, fit on rows of days before its start, predict its rows.

    Training takes rows with complete features and target (B18); every row of
    a window stays in the result, with a null ``pred`` where a feature is
    missing or nothing was there to train on. A row needs no target to be
    predicted. ``day`` is the day that windows go by (default: UTC).
    ``train_filter`` restricts the rows allowed into training (Stage 2: rows
    with out-of-sample inputs)."""
    day = F.to_date(F.col(ts)) if day is None else F.col(day) if isinstance(day, str) else day
    tagged = tag_buckets(df, windows, day)
    train = tagged.where(F.col("bucket").isNotNull())
    if train_filter is not None:
        train = train.where(train_filter)
    cum = cumulative_before(gram_sums(train, features, y), windows, len(features))
    betas = solve_ridge(cum.withColumn("ridge", F.lit(ridge)), {"window_id": "long"}, len(features))
    betas = cut_lineage(betas, "betas")   # one row per window, as many as weeks
    test = tagged.where(F.col("window_id").isNotNull()).join(F.broadcast(betas), "window_id", "left")
    return test.withColumn("pred", dot(features, F.col("beta"))).drop("beta")


def window_status(windows: DataFrame, hourly: DataFrame, quarter: DataFrame, day: str = "delivery_date") -> DataFrame:
    """``windows`` with the rows of both frames in them and a ``status``:

    ``before_data`` (starts on or before the first day of a frame),
    ``no_hourly_rows`` or ``no_quarter_rows`` (nothing complete in it),
    ``warm_up`` (before the hold-out), ``no_stage2_training`` (hold-out without
    rows of earlier used windows), else ``predicted``."""
    days = windows.select("window_id", F.explode(F.sequence("start", F.date_sub("end", 1))).alias(day))

    def rows_in(df: DataFrame, name: str) -> DataFrame:
        per_day = df.groupBy(day).agg(F.count(F.lit(1)).alias("n"))
        return days.join(per_day, day).groupBy("window_id").agg(F.sum("n").alias(name))

    out = (windows.join(rows_in(hourly, "n_hourly"), "window_id", "left")
           .join(rows_in(quarter, "n_quarter"), "window_id", "left").na.fill(0, ["n_hourly", "n_quarter"]))
    first = F.greatest(hourly.agg(F.min(day)).scalar(), quarter.agg(F.min(day)).scalar())
    skipped = (F.when(F.col("start") <= first, "before_data").when(F.col("n_hourly") == 0, "no_hourly_rows")
               .when(F.col("n_quarter") == 0, "no_quarter_rows"))
    before = Window.orderBy("window_id").rowsBetween(Window.unboundedPreceding, -1)   # one row per week
    out = out.withColumn("_skip", skipped).withColumn(
        "_prior", F.coalesce(F.sum(F.when(F.col("_skip").isNull(), F.col("n_quarter"))).over(before), F.lit(0)))
    return out.withColumn("status", F.coalesce(
        "_skip", F.when(~F.col("in_holdout"), "warm_up").when(F.col("_prior") == 0, "no_stage2_training")
        .otherwise("predicted"))).drop("_skip", "_prior")


def two_stage(hourly: DataFrame, quarter: DataFrame, windows: DataFrame, f1: Sequence[str], f2: Sequence[str],
              y: str = "price_eur_mwh", ts: str = "timestamp", ridge: float = 1e-6, day: str | None = None,
              status: DataFrame | None = None, strict: bool = True) -> tuple[DataFrame, DataFrame]:
    """(hourly Stage-1 predictions, quarter-hour final predictions).

    With ``status`` (of :func:`window_status`) only its used windows predict,
    and only their quarter-hours train Stage 2; ``strict`` then raises if a
    hold-out window has none to train on."""
    if status is not None and strict:
        bad = status.where(F.col("status") == "no_stage2_training").agg(F.min("start").alias("start")).first()["start"]
        if bad is not None:
            raise ValueError(f"no Stage 2 training rows before the window of {bad}")
    s1 = expanding_fit_predict(hourly, windows, f1, y, ts, ridge, day=day)
    if status is not None:
        used = status.where(F.col("status").isin(*USED)).select("window_id")
        s1 = s1.join(F.broadcast(used), "window_id", "left_semi")
    # Stage-1 output feeds Stage 2 and the result: store it once
    s1 = cut_lineage(s1, "stage1")
    s1p = s1.select(F.col(ts).alias("_h"), F.col("pred").alias("stage1_pred"))
    q = quarter.join(s1p, F.date_trunc("HOUR", F.col(ts)) == F.col("_h"), "left").drop("_h")
    q = q.withColumn("deviation", F.col(y) - F.col("stage1_pred"))
    s2 = expanding_fit_predict(q, windows, f2, "deviation", ts, ridge,
                               train_filter=F.col("bucket") >= 1, day=day)
    if status is not None:
        scored = status.where(F.col("status") == "predicted").select("window_id")
        s2 = s2.join(F.broadcast(scored), "window_id", "left_semi")
    s2 = s2.withColumn("stage2_pred", F.col("pred")).withColumn("pred", F.col("stage1_pred") + F.col("stage2_pred"))
    return s1, s2
