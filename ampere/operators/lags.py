"""Time-offset lags.

Two physical forms of "value of column c at ``ts - k hours``":

* :func:`lag_self_join` — one left join per offset (the SQL shape; one
  exchange per join input).
* :func:`lag_fanout` — every source row is emitted to the time buckets that
  look back at it; there a frame of exactly ``k`` hours before each row finds
  the value: one exchange of the rows and a few copies, whatever the number
  of offsets.

Both are exact on absolute (UTC) offsets and give null for a null source value
and for an absent source row alike. They need unique timestamps per series
(check with ``quality.unique_combination``).
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ampere.functions.time import shift_hours

MICROS_AN_HOUR = 3_600_000_000
#: Length of a time bucket in longest offsets: one row in so many is copied into a second bucket.
BUCKET_LAGS = 4


def lag_self_join(df: DataFrame, lags: Mapping[int, Mapping[str, str]], ts: str = "timestamp",
                  partition: Sequence[str] = ()) -> DataFrame:
    """``lags = {hours: {source_col: out_col}}``; one left join per offset."""
    out = df
    for hours, cols in lags.items():
        src = df.select(shift_hours(ts, hours).alias(ts), *partition,
                        *[F.col(c).alias(o) for c, o in cols.items()])
        out = out.join(src, [ts, *partition], "left")
    return out


def lag_fanout(df: DataFrame, lags: Mapping[int, Mapping[str, str]], ts: str = "timestamp",
               partition: Sequence[str] = (), day: Callable[[Column], Column] | None = None,
               bucket_col: str | None = None) -> DataFrame:
    """Same result as :func:`lag_self_join` in one exchange.

    Time is cut into buckets of ``BUCKET_LAGS`` times the longest offset. Each
    row goes to its own bucket and is copied to the bucket that looks back at
    it (or ahead, for negative offsets), if that is another one; there every
    offset is a frame of exactly that distance. ``df`` is read once, the rows
    exchanged don't grow with the number of offsets, and values keep their
    own types. With ``day`` (the date of an instant, never falling as time goes
    on) buckets are whole days of it. The rows stay together by their bucket,
    which ``bucket_col`` names if it is to be kept."""
    partition = list(partition)
    micros = {h: h * MICROS_AN_HOUR for h in lags}
    reach = [min(0, *micros.values()), max(0, *micros.values())]
    width = max(BUCKET_LAGS * max(-reach[0], reach[1]), 24 * MICROS_AN_HOUR)
    if day is not None:   # the number of the day, in buckets of as many whole days
        place = lambda m: F.unix_date(day(F.timestamp_micros(m))).cast("long")
        width = -(-width // (24 * MICROS_AN_HOUR))
    else:
        place = lambda m: m
    width = F.lit(width).cast("long")
    bucket = lambda m: place(m) - F.pmod(place(m), width)
    seen = df.withColumn("_at", F.unix_micros(F.col(ts).cast("timestamp")))
    looks = F.sequence(*[bucket(F.col("_at") + m) for m in reach], width)
    dealt = seen.select("*", F.explode_outer(looks).alias("_bucket"))
    dealt = dealt.withColumn("_home", F.coalesce(F.col("_bucket") == bucket(F.col("_at")), F.lit(True)))
    known = F.col("_at").isNotNull()
    for p in partition:   # rows of a null series match none
        known = known & F.col(p).isNotNull()
    w = Window.partitionBy(*partition, "_bucket").orderBy("_at")
    frames = [F.when(known, F.max(c).over(w.rangeBetween(-m, -m))).alias(o)
              for h, m in micros.items() for c, o in lags[h].items()]
    out = dealt.select("*", *frames).where("_home")   # one sort for all frames
    rest = [c for c in df.columns if c not in (ts, *partition)]
    kept = [F.col("_bucket").alias(bucket_col)] if bucket_col else []
    return out.select(ts, *partition, *rest, *[o for cols in lags.values() for o in cols.values()], *kept)


def _fan(df: DataFrame, lags: Mapping[int, Mapping[str, str]], partition: Sequence[str], at) -> tuple[DataFrame, list[Column]]:
    """The rows (partition, _k, _t, values) of every offset, and the aggregates that fold them.

    Offsets with the same column types share value columns; a value stands in
    an array of its own type, so nothing is cast."""
    kinds = {h: tuple(df.schema[c].dataType.simpleString() for c in cols) for h, cols in lags.items()}
    slots = {k: f"_v{i}" for i, k in enumerate(sorted({t for ts_ in kinds.values() for t in ts_}))}
    def array_of(h, cols, t):
        own = [F.col(c) for c in cols if df.schema[c].dataType.simpleString() == t]
        return F.array(*own) if own else F.lit(None)
    items = [F.struct(F.lit(h).alias("_k"), at(h).alias("_t"),
                      *[array_of(h, cols, t).cast(f"array<{t}>").alias(s) for t, s in slots.items()])
             for h, cols in lags.items()]
    fan = df.select(*partition, F.inline(F.array(*items)))
    aggs = []
    for h, cols in lags.items():
        seen: dict[str, int] = {}
        for c, out in cols.items():
            t = df.schema[c].dataType.simpleString()
            i = seen[t] = seen.get(t, -1) + 1
            aggs.append(F.max(F.when(F.col("_k") == h, F.col(slots[t])[i])).alias(out))
    return fan, aggs


def lag_range_window(df: DataFrame, lags: Mapping[int, Mapping[str, str]], ts: str = "timestamp",
                     partition: Sequence[str] = ()) -> DataFrame:
    """Third form: ``max(c) over (partition by series order by epoch range
    between k and k preceding)`` — an exact-offset frame, one sort per series,
    no join. Each series is ordered inside one task, so it suits many
    moderate series (signals x regions), not one very long series."""
    epoch = F.unix_seconds(F.col(ts))
    frames = []
    for hours, cols in lags.items():
        k = hours * 3600
        w = Window.partitionBy(*partition).orderBy(epoch).rangeBetween(-k, -k)
        frames += [F.max(c).over(w).alias(o) for c, o in cols.items()]
    # one select: all frames share partitioning and order -> one sort, one Window pass
    return df.select("*", *frames)


def same_hour_average(cols: Sequence[str]) -> Column:
    """Exact arithmetic mean — null if any term is null (unlike ``avg``)."""
    total = F.col(cols[0])
    for c in cols[1:]:
        total = total + F.col(c)
    return total / F.lit(float(len(cols)))


def lag_with_fallback(df: DataFrame, value: str, horizons: Sequence[int], out: str,
                      ts: str = "timestamp", partition: Sequence[str] = (),
                      existing: str | None = None) -> DataFrame:
    """First non-null of the value ``h`` hours earlier, for h in order.

    With ``existing`` the current column is kept where not null (patch form,
    E11: ``lag_24 := coalesce(lag_24, lag_168)``).
    """
    lag_cols = {h: {value: f"_fb_{h}"} for h in horizons}
    joined = lag_fanout(df, lag_cols, ts, partition)
    picks = ([F.col(existing)] if existing else []) + [F.col(f"_fb_{h}") for h in horizons]
    return joined.withColumn(out, F.coalesce(*picks)).drop(*[f"_fb_{h}" for h in horizons])


def row_lag_indexed(df: DataFrame, lags: Mapping[int, Mapping[str, str]], order: str = "timestamp",
                    partition: Sequence[str] = ()) -> DataFrame:
    """E4 (row-based ``shift(n)``) without ordering a whole series in one
    task: a global row index from per-day counts and a prefix sum over the
    small day table (``splits.global_row_index``), then the same fan-out fold
    as :func:`lag_fanout` keyed on ``row_idx + n``. Exact."""
    from ampere.operators.splits import global_row_index
    part = list(partition)
    idx = global_row_index(df, order, part)
    fan, aggs = _fan(idx, lags, part, lambda n: F.col("row_idx") + n)
    folded = fan.groupBy(F.col("_t").alias("row_idx"), *part).agg(*aggs)
    return idx.join(folded, ["row_idx", *part], "left").drop("row_idx")


def row_lag(df: DataFrame, value: str, n: int, out: str, order: str = "timestamp",
            partition: Sequence[str] = ()) -> DataFrame:
    """Row-based ``shift(n)`` within a series (not time-based, see X11).

    Requires a series key in ``partition`` at scale; without one the whole
    series is ordered in one task (use ``windows.bucketed_row_window``).
    """
    w = Window.partitionBy(*partition).orderBy(order)
    return df.withColumn(out, F.lag(value, n).over(w))
