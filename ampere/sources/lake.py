"""The raw Parquet lake: partitioned day files, partition pruning, idempotent
writes (A1, A14, A15, A16, A21)."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ampere.session import cut_lineage

SIGNAL_SCHEMA = T.StructType([
    T.StructField("timestamp", T.TimestampType(), False), T.StructField("signal", T.StringType(), False),
    T.StructField("value", T.DoubleType(), True), T.StructField("unit", T.StringType(), True),
    T.StructField("resolution", T.StringType(), False)])
WEATHER_SCHEMA = T.StructType([
    T.StructField("timestamp", T.TimestampType(), False), T.StructField("region", T.StringType(), False),
    T.StructField("signal_type", T.StringType(), False), T.StructField("value", T.DoubleType(), True),
    T.StructField("unit", T.StringType(), True)])
PARTITION_COLS = ["year", "month", "day"]


def with_partition_columns(df: DataFrame, ts: str = "timestamp") -> DataFrame:
    """Year, month, day partition values of each row's UTC day."""
    return (df.withColumn("year", F.year(ts)).withColumn("month", F.format_string("%02d", F.month(ts)))
              .withColumn("day", F.format_string("%02d", F.dayofmonth(ts))))


def write_day_partitions(df: DataFrame, path: str, ts: str = "timestamp",
                         extra: Sequence[str] = ("resolution",), files_per_partition: int = 1,
                         max_records_per_file: int = 5_000_000) -> None:
    """One directory per (year, month, day[, resolution]); dynamic
    partition overwrite replaces only the days present in ``df`` (idempotent
    re-delivery of a day).

    Rows are hash-spread over ``files_per_partition`` buckets inside each day
    so one day is written by several tasks (size it so a file is ~128-512 MB
    at the target volume); ``max_records_per_file`` caps any single file."""
    extra = [c for c in extra if c in df.columns]
    parts = PARTITION_COLS + extra
    out = with_partition_columns(df, ts)
    spread = [F.pmod(F.xxhash64(*[F.col(c) for c in df.columns]), F.lit(files_per_partition))] \
        if files_per_partition > 1 else []
    (out.repartition(*[F.col(c) for c in parts], *spread).sortWithinPartitions(ts)
        .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        .option("maxRecordsPerFile", max_records_per_file)
        .partitionBy(*parts).parquet(path))


def partition_predicate(start: str, end: str) -> Column:
    """Partition-pruning predicate for the UTC days of [start, end]: Spark does not
    derive partition filters from a timestamp filter, so add one on the days."""
    day = F.col("year").cast("int") * 10000 + F.col("month").cast("int") * 100 + F.col("day").cast("int")
    return day.between(int(start[:10].replace("-", "")), int(end[:10].replace("-", "")))


def _folder(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def lake_exists(spark: SparkSession, path: str) -> bool:
    """Whether there is a lake folder, on any file system."""
    fs, p = _folder(spark, path)
    return fs.exists(p)


def stored_partitions(spark: SparkSession, path: str, extra: Sequence[str] = ("resolution",)) -> DataFrame:
    """(day, extra...): the day partitions of a lake, from its folder names. No file is opened.

    As many rows as days (and resolutions) are stored; none if there is no lake.
    """
    from urllib.parse import unquote

    schema = T.StructType([T.StructField("day", T.DateType())] + [T.StructField(c, T.StringType()) for c in extra])
    names = [*PARTITION_COLS, *extra]
    fs, p = _folder(spark, "/".join([path.rstrip("/"), *[f"{c}=*" for c in names]]))
    rows = []
    for status in fs.globStatus(p) or []:
        parts = str(status.getPath().toString()).rstrip("/").split("/")[-len(names):]
        y, m, d, *rest = (unquote(x.split("=", 1)[1]) for x in parts)
        rows.append((dt.date(int(y), int(m), int(d)), *rest))
    return spark.createDataFrame(rows, schema)


def _lake_schema(schema: T.StructType) -> T.StructType:
    return T.StructType(list(schema.fields) + [T.StructField("year", T.IntegerType()), T.StructField("month", T.StringType()),
                                               T.StructField("day", T.StringType())])


def scan_range(spark: SparkSession, path: str, start: str, end: str, schema: T.StructType | None = None,
               ts: str = "timestamp", closed_end_of_day: bool = True) -> DataFrame:
    """Read the lake for [start 00:00, end 23:59:59] (closed bounds):
    partition pruning by day plus an exact timestamp filter that is pushed
    into the Parquet scan. A lake that doesn't exist yet is empty (of
    ``schema``, default: signals)."""
    full = _lake_schema(schema or SIGNAL_SCHEMA)
    if not lake_exists(spark, path):
        return spark.createDataFrame([], full)
    r = spark.read.option("ignoreMissingFiles", "true").option("basePath", path)
    df = (r.schema(full) if schema is not None else r).parquet(path).where(partition_predicate(start, end))
    hi = F.lit(f"{end} 23:59:59").cast("timestamp") if closed_end_of_day else F.lit(end).cast("timestamp")
    return df.where(coerced(df, ts).between(F.lit(start).cast("timestamp"), hi))


def coerced(df: DataFrame, ts: str = "timestamp") -> Column:
    """The instant of each row; null where a text is none (stored instants are taken as they are)."""
    c = F.col(ts)
    return c if isinstance(df.schema[ts].dataType, T.TimestampType) else F.try_to_timestamp(c.cast("string"))


def read_day(spark: SparkSession, path: str, day: str, schema: T.StructType | None = None, ts: str = "timestamp") -> DataFrame:
    """Rows of one UTC day, the timestamp coerced (rows with a bad one are
    left out); a missing lake, day or file gives an empty frame."""
    df = scan_range(spark, path, day, day, schema, ts)
    return df.withColumn(ts, coerced(df, ts)).where(F.to_date(ts) == F.lit(day).cast("date"))


def partitions_to_write(incoming: DataFrame, existing: DataFrame, ts: str = "timestamp",
                        keys: Sequence[str] = ("resolution",), force: bool = False) -> DataFrame:
    """(day, keys...) partitions of ``incoming`` that ``existing`` doesn't
    have (left anti join on the partition keys); with ``force`` everything is
    rewritten. ``existing`` is a table of rows, or of partitions
    (:func:`stored_partitions`) if it has a ``day``."""
    k = [c for c in keys if c in incoming.columns]
    inc = incoming.select(F.to_date(ts).alias("day"), *k).distinct()
    if force:
        return inc
    day = F.col("day") if "day" in existing.columns else F.to_date(ts)
    ex = existing.select(day.alias("day"), *k).distinct()
    return inc.join(ex, ["day", *k], "left_anti")


def write_missing_days(df: DataFrame, path: str, ts: str = "timestamp", extra: Sequence[str] = ("resolution",),
                       force: bool = False, **options) -> DataFrame:
    """Write the day partitions of ``df`` that the lake doesn't have yet, or all with ``force``.

    Returns the partitions written. What is stored is known from folder names
    alone; the rows of stored days are left out by an anti join with that
    short list before anything is written.
    """
    spark = df.sparkSession
    extra = [c for c in extra if c in df.columns]
    have = stored_partitions(spark, path, extra)
    todo = cut_lineage(partitions_to_write(df, have, ts, extra, force), "lake-todo")
    if force:
        rows = df
    else:
        day = have.select(F.col("day").alias("_day"), *[F.col(c).alias(f"_{c}") for c in extra])
        cond = F.to_date(ts) == F.col("_day")
        for c in extra:
            cond = cond & (F.col(c) == F.col(f"_{c}"))
        rows = df.join(F.broadcast(day), cond, "left_anti")   # one row a stored day
    write_day_partitions(rows, path, ts, extra, **options)
    return todo
