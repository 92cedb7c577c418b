"""Landed source payloads -> long rows.

Payloads are landed as files (JSON text, one payload per line); parsing is
``from_json`` + ``explode``/``posexplode`` inside tasks, never a driver loop.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

SERIES_PAYLOAD = T.StructType([T.StructField("series", T.ArrayType(T.ArrayType(T.StringType())))])
INDEX_PAYLOAD = T.StructType([T.StructField("timestamps", T.ArrayType(T.LongType()))])
WEATHER_RESPONSE = T.StructType([
    T.StructField("region", T.StringType()), T.StructField("start", T.LongType()),
    T.StructField("end", T.LongType()), T.StructField("interval_s", T.IntegerType()),
    T.StructField("vars", T.ArrayType(T.ArrayType(T.DoubleType())))])


def to_number(text: Column) -> Column:
    """The number that a text states, null where it states none.

    Blanks around it don't count. A type letter at its end (``1.5f``), which a
    cast to double takes, makes it no number.
    """
    return F.when(~F.coalesce(text.rlike("[0-9.][dDfF]\\s*$"), F.lit(False)), text.try_cast("double"))


def parse_series_payload(df: DataFrame, text: str = "payload", keep: Sequence[str] = ()) -> DataFrame:
    """A2: ``{"series": [[epoch_ms, value|null], ...]}`` -> (timestamp UTC,
    value). Values that are not numbers become null; an empty series gives no
    rows. Points are kept as strings first so one bad value cannot null the
    whole payload."""
    p = df.select(*keep, F.from_json(F.col(text), SERIES_PAYLOAD).alias("_p"))
    pts = p.select(*keep, F.explode(F.col("_p.series")).alias("_pt"))
    return pts.select(*keep, F.timestamp_millis(F.col("_pt")[0].try_cast("bigint")).alias("timestamp"),
                      to_number(F.col("_pt")[1]).alias("value")).where(F.col("timestamp").isNotNull())


def series_payload(df: DataFrame, keys: Sequence[str], ts: str = "timestamp", value: str = "value") -> DataFrame:
    """Inverse of A2 (for landing chunks): one JSON payload per group of
    ``keys`` (e.g. signal x week chunk — bounded by the chunk length)."""
    pt = F.array(F.unix_millis(F.col(ts)).cast("string"), F.col(value).cast("string"))
    return df.groupBy(*keys).agg(F.to_json(F.struct(F.array_sort(F.collect_list(pt)).alias("series"))).alias("payload"))


def stamp_series(rows: DataFrame, units: Mapping[str, str], resolution: str, signal: str = "signal") -> DataFrame:
    """A4: concatenated series rows with the ``unit`` of their signal and the ``resolution`` asked for.

    The units are configuration and become a constant map: no join. Signals
    that it doesn't name get a null unit.
    """
    lookup = F.create_map(*[c for s, u in sorted(units.items()) for c in (F.lit(s), F.lit(u))]) if units else F.lit(None)
    unit = F.element_at(lookup, F.col(signal)) if units else F.lit(None).cast("string")
    return rows.withColumn("unit", unit).withColumn("resolution", F.lit(resolution))


def select_chunks(index: DataFrame, start, end, key: Sequence[str] = (), chunk: str = "chunk_start") -> DataFrame:
    """A3: chunks needed for [start, end]: from the last chunk starting at or
    before ``start`` (else the first chunk) through every chunk starting at or
    before ``end``. Per key, over the (small) chunk index."""
    s = start if isinstance(start, Column) else F.lit(start).cast("timestamp")
    e = end if isinstance(end, Column) else F.lit(end).cast("timestamp")
    c = F.col(chunk)
    frm = F.coalesce(F.max(F.when(c <= s, c)), F.min(c))
    if key:
        j = index.join(index.groupBy(*key).agg(frm.alias("_from")), list(key))
    else:
        j = index.withColumn("_from", index.agg(frm).scalar())
    return j.where((c >= F.col("_from")) & (c <= e)).drop("_from")


def parse_permissive(df: DataFrame, text: str, schema: T.StructType, keep: Sequence[str] = ()):
    """A5: parse JSON text; rows that do not parse go to a quarantine frame
    instead of failing the job. Returns (good, quarantine)."""
    with_corrupt = T.StructType(list(schema.fields) + [T.StructField("_corrupt_record", T.StringType())])
    opts = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt_record"}
    parsed = df.select(*keep, F.col(text), F.from_json(F.col(text), with_corrupt, opts).alias("_j"))
    bad = F.col("_j._corrupt_record").isNotNull()
    fields = [F.col(f"_j.{f.name}").alias(f.name) for f in schema.fields]
    good = parsed.where(~bad).select(*keep, *fields)
    quarantine = parsed.where(bad).select(*keep, F.col(text).alias("_corrupt_record"))
    return good, quarantine


def weather_response_to_long(df: DataFrame, variables: Sequence[str], resp: str = "response",
                             model: str | None = None) -> DataFrame:
    """``{region, start, end, interval_s, vars[n_vars][n_times]}`` -> long
    rows (timestamp, region, signal_type, value) on the grid
    ``[start, end)`` by ``interval``; one row per time x variable."""
    r = F.col(resp)
    grid = df.select(r["region"].alias("region"), r["vars"].alias("_vars"),
                     F.posexplode(F.sequence(r["start"], r["end"] - r["interval_s"], r["interval_s"])).alias("_i", "_t"))
    var_arr = F.array(*[F.lit(v) for v in variables])
    long = grid.select("region", F.timestamp_seconds("_t").alias("timestamp"), "_i", "_vars",
                       F.posexplode(var_arr).alias("_v", "signal_type"))
    out = long.select("timestamp", "region", "signal_type",
                      F.element_at(F.element_at(F.col("_vars"), F.col("_v") + 1), F.col("_i") + 1).alias("value"))
    return out.withColumn("model", F.lit(model)) if model else out


def stitched_issue(ts: str = "timestamp", hours: int = 18) -> Column:
    """Stitched historical forecast issued ``hours`` before validity."""
    return F.col(ts) - F.make_dt_interval(F.lit(0), F.lit(hours))


def single_run_issue(ts: str = "timestamp", run_hour: int = 0) -> Column:
    """A10: single forecast run at ``run_hour`` UTC on the day before delivery."""
    return F.to_timestamp(F.date_sub(F.to_date(F.col(ts)), 1)) + F.make_dt_interval(F.lit(0), F.lit(run_hour))


def hybrid_day_forecast(stitched: DataFrame, single_run: DataFrame, cutover: str, ts: str = "timestamp") -> DataFrame:
    """For each delivery day D in the range, the single-run branch if
    D-1 >= cut-over else the stitched branch, keeping only rows of day D. Two
    disjoint filtered branches and a union — no per-day driver loop."""
    d = F.to_date(F.col(ts))
    use_single = F.date_sub(d, 1) >= F.lit(cutover).cast("date")
    return stitched.where(~use_single).unionByName(single_run.where(use_single))


def live_forecast_stamp(df: DataFrame, ts: str = "timestamp", now: Column | None = None) -> DataFrame:
    """Live forecast: fetched now (or at ``now``), issued at the start of the valid day."""
    return (df.withColumn("fetched_at", F.current_timestamp() if now is None else now)
              .withColumn("issue_timestamp", F.date_trunc("DAY", F.col(ts))))
