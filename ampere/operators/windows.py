"""Ordered-series window operators (E1, E3, E7, E9) and their scalable forms.

A window ordered over a *whole* series without a partition key runs in one
task. Every operator here takes ``partition`` (series key). For one very long
series the ``*_bucketed`` forms partition by a time bucket and copy a halo of
neighbouring rows into each bucket, compute the window there, and keep only the
bucket's own rows — exact, with work spread over the buckets.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ampere.functions.time import delivery_date


def forward_fill(df: DataFrame, columns: Sequence[str], order: str = "timestamp",
                 partition: Sequence[str] = (), limit: int = 3) -> DataFrame:
    """``ffill(limit)``: a null takes the last non-null value of the
    previous ``limit`` rows (row-based); longer gaps keep their tail null."""
    w = Window.partitionBy(*partition).orderBy(order).rowsBetween(-limit, 0)
    filled = {c: F.last(c, ignorenulls=True).over(w).alias(c) for c in columns}
    return df.select(*[filled.get(c, F.col(c)) for c in df.columns])   # one Window pass


def _bucket_frame(df: DataFrame, order: str, partition: Sequence[str], bucket: Column):
    """Tag rows with bucket ``_b``, local row number ``_r`` and the global row
    index ``_gi`` (= rows in earlier buckets + ``_r``). The prefix sums run over
    the per-bucket count table (one row per bucket), not over the data."""
    part = list(partition)
    t = df.withColumn("_b", bucket)
    t = t.withColumn("_r", F.row_number().over(Window.partitionBy(*part, "_b").orderBy(order)))
    return t, part


def forward_fill_bucketed(df: DataFrame, columns: Sequence[str], order: str = "timestamp",
                          partition: Sequence[str] = (), limit: int = 3,
                          bucket: Column | str | None = None) -> DataFrame:
    """E3 as a scan with carry over (series, bucket) partitions — exact for any
    sparsity, equal to :func:`forward_fill`.

    Only a bucket's last ``limit`` rows can fill a later bucket: they alone go
    to the carry table, the others don't leave their task for it. There every
    bucket counts as if it had no other rows; a running sum/max over buckets
    gives each its row offset and the last non-null value before it. Inside the
    bucket a running max of (row, value) finds the last non-null, filled if
    within ``limit`` rows. Whole rows are exchanged once; they stay by (series,
    bucket) if ``bucket`` is the name of a column.
    """
    bucket = F.to_date(F.col(order)) if bucket is None else bucket
    b, part = bucket if isinstance(bucket, str) else "_b", list(partition)
    t = df if isinstance(bucket, str) else df.withColumn("_b", bucket)
    in_b = Window.partitionBy(*part, b)
    ends = (t.select(*dict.fromkeys([*part, b, order, *columns]))
            .withColumn("_e", F.row_number().over(in_b.orderBy(F.desc(order)))).where(F.col("_e") <= limit))
    per_b = ends.groupBy(*part, b).agg(
        F.count(F.lit(1)).alias("_n"),
        *[F.max(F.when(F.col(c).isNotNull(), F.struct((-F.col("_e")).alias("i"), F.col(c).alias("v")))).alias(f"_l_{c}")
          for c in columns])
    wb = Window.partitionBy(*part).orderBy(b).rowsBetween(Window.unboundedPreceding, -1)
    per_b = per_b.withColumn("_off", F.coalesce(F.sum("_n").over(wb), F.lit(0)))
    carries = []
    for c in columns:
        g = F.when(F.col(f"_l_{c}").isNotNull(),
                   F.struct((F.col("_off") + F.col("_n") + 1 + F.col(f"_l_{c}.i")).alias("i"), F.col(f"_l_{c}.v").alias("v")))
        carries.append(F.max(g).over(wb).alias(f"_c_{c}"))
    per_b = per_b.select(*part, b, "_off", *carries)
    t = t.withColumn("_r", F.row_number().over(in_b.orderBy(order)))
    t = t.join(per_b, [*part, b]).withColumn("_gi", F.col("_off") + F.col("_r"))
    wr = in_b.orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    t = t.select("*", *[F.max(F.when(F.col(c).isNotNull(), F.struct(F.col("_gi").alias("i"), F.col(c).alias("v"))))
                        .over(wr).alias(f"_w_{c}") for c in columns])          # one Window pass
    filled = {}
    for c in columns:
        last = F.coalesce(F.col(f"_w_{c}"), F.col(f"_c_{c}"))
        filled[c] = F.when(F.col(c).isNotNull(), F.col(c)).when(F.col("_gi") - last["i"] <= limit, last["v"]).alias(c)
    return t.select(*[filled.get(c, F.col(c)) for c in df.columns])


def previous_row_bucketed(df: DataFrame, columns: Sequence[str], order: str = "timestamp",
                          partition: Sequence[str] = (), bucket: Column | None = None,
                          prefix: str = "prev_") -> DataFrame:
    """E4/E6 ``lag(c, 1)`` over a whole series, bucketed: inside a bucket a
    plain ``lag``; a bucket's first row takes the last row of the previous
    non-empty bucket (carried through the one-row-per-bucket table)."""
    bucket = F.to_date(F.col(order)) if bucket is None else bucket
    t, part = _bucket_frame(df, order, partition, bucket)
    last = t.groupBy(*part, "_b").agg(F.max(F.struct("_r", *[F.col(c) for c in columns])).alias("_last"))
    wb = Window.partitionBy(*part).orderBy("_b")
    last = last.select(*part, "_b", F.lag("_last").over(wb).alias("_carry"))
    t = t.join(last, [*part, "_b"])
    w = Window.partitionBy(*part, "_b").orderBy(order)
    for c in columns:
        t = t.withColumn(f"{prefix}{c}", F.when(F.col("_r") == 1, F.col(f"_carry.{c}")).otherwise(F.lag(c).over(w)))
    return t.drop("_b", "_r", "_carry")


def time_spine(df: DataFrame, ts: str = "timestamp", step: str = "1 hour",
               partition: Sequence[str] = ()) -> DataFrame:
    """Regular time grid from the first to the last instant of each series
    (one generated row per step; size set by the time span, not the data)."""
    b = df.groupBy(*partition).agg(F.min(ts).alias("_lo"), F.max(ts).alias("_hi"))
    return b.select(*partition, F.explode(F.sequence("_lo", "_hi", F.expr(f"INTERVAL {step}"))).alias(ts))


def on_spine(df: DataFrame, ts: str = "timestamp", step: str = "1 hour",
             partition: Sequence[str] = ()) -> DataFrame:
    """Series left-joined onto its regular grid: absent steps become null rows."""
    return time_spine(df, ts, step, partition).join(df, [*partition, ts], "left")


def complete_days(df: DataFrame, columns: Sequence[str], ts: str = "timestamp",
                  day: Column | str | None = None, partition: Sequence[str] = (), together: bool = False) -> DataFrame:
    """Keep only (local) days on which every listed column is non-null
    in every row present. Missing *rows* do not make a day incomplete.

    With ``together`` the rows of a (series, day) lie in one task already,
    ``day`` being a column: the flag is a window there, and ``df`` runs once."""
    day = delivery_date(ts) if day is None else day
    ok = F.lit(True)
    for c in columns:
        ok = ok & F.col(c).isNotNull()
    if together:
        known = F.lit(True)
        for c in (*partition, day):   # rows of a null series or day are in none
            known = known & F.col(c).isNotNull()
        flag = F.min(ok.cast("int")).over(Window.partitionBy(*partition, day))
        return df.withColumn("_ok", flag).where((F.col("_ok") == 1) & known).drop("_ok")
    day = F.col(day) if isinstance(day, str) else day
    # per-(series, day) flag by a partially aggregated groupBy, then a semi
    # join: no task ever holds a whole day; the flag table (one row per series
    # and day) is small enough for AQE to broadcast
    tagged = df.withColumn("_day", day)
    good = (tagged.groupBy(*partition, "_day").agg(F.min(ok.cast("int")).alias("_ok"))
                  .where(F.col("_ok") == 1).drop("_ok"))
    return tagged.join(good, [*partition, "_day"], "left_semi").drop("_day")


def rolling_mean(df: DataFrame, value: str, out: str, seconds: int, ts: str = "timestamp",
                 partition: Sequence[str] = ()) -> DataFrame:
    """Mean over the time range ``(ts - seconds, ts]`` per series."""
    w = (Window.partitionBy(*partition).orderBy(F.unix_micros(F.col(ts)))
         .rangeBetween(-(seconds * 1_000_000) + 1, 0))
    return df.withColumn(out, F.avg(value).over(w))


def rolling_mean_bucketed(df: DataFrame, value: str, out: str, seconds: int, ts: str = "timestamp",
                          partition: Sequence[str] = (), bucket_seconds: int | None = None) -> DataFrame:
    """E9 with time buckets of width >= the window: each row is copied into
    its own and the next bucket, so every frame lies inside one bucket; the
    copy doubles the rows but spreads one series over many tasks. Exact."""
    width = max(bucket_seconds or seconds, seconds)
    b = F.floor(F.unix_seconds(F.col(ts)) / width)
    both = df.select("*", F.explode(F.array(b, b + 1)).alias("_b")).withColumn("_home", F.col("_b") == b)
    w = (Window.partitionBy(*partition, "_b").orderBy(F.unix_micros(F.col(ts)))
         .rangeBetween(-(seconds * 1_000_000) + 1, 0))
    return both.withColumn(out, F.avg(value).over(w)).where("_home").drop("_b", "_home")


def horizon(df: DataFrame, ts: str = "timestamp", tz: str = "Europe/Berlin",
            partition: Sequence[str] = ()) -> DataFrame:
    """Product number within the market-local delivery day (1..23/24/25;
    numbers the rows that exist)."""
    out = df.withColumn("delivery_date", delivery_date(ts, tz))
    w = Window.partitionBy(*partition, "delivery_date").orderBy(ts)
    return out.withColumn("horizon", F.row_number().over(w))
