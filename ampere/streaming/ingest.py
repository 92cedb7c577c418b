"""Structured Streaming forms of the daily load (M1-M3).

* :func:`upsert_stream` — file stream -> ``foreachBatch(merge_latest)`` into a
  day-partitioned Parquet table; each batch reads and rewrites only the day
  partitions its rows touch. A replayed batch recomputes the same partitions,
  so the sink is idempotent.
* :func:`dedup_stream` — ``dropDuplicatesWithinWatermark``: *first* arrival
  wins (the upsert keeps the *latest*).
* :func:`windowed_rollup` — tumbling event-time windows with a watermark,
  append mode: a window is emitted once the watermark passes its end; rows
  later than the watermark are dropped.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ampere.operators.merge import merge_latest, merge_versions


def file_stream(spark: SparkSession, path: str, schema: T.StructType, glob: str | None = None,
                max_files_per_trigger: int | None = None) -> DataFrame:
    r = spark.readStream.schema(schema)
    if glob:
        r = r.option("pathGlobFilter", glob)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    return r.parquet(path)


def table_stream(spark: SparkSession, path: str, schema: T.StructType, max_files_per_trigger: int | None = None) -> DataFrame:
    """A stream over one table: a folder of part files, or a single file (named in its folder, nothing beside it)."""
    fs, p = _fs(spark, path)
    if fs.getFileStatus(p).isDirectory():
        return file_stream(spark, path, schema, max_files_per_trigger=max_files_per_trigger)
    folder, name = path.rsplit("/", 1)
    # characters that a glob would read as more than themselves
    glob = "".join(f"\\{c}" if c in "*?[]{}\\" else c for c in name)
    return file_stream(spark, folder, schema, glob, max_files_per_trigger)


def _fs(spark: SparkSession, path: str):
    jvm = spark._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def upsert_stream(source: DataFrame, table_root: str, checkpoint: str, key: Sequence[str],
                  order: Sequence[str], update_cols: Sequence[str] | None = None, ts: str = "timestamp",
                  partition_col: str = "day", files_per_partition: int = 4, by_version: bool = True):
    """M1: incremental keyed upsert of a file stream (``availableNow``) into a
    day-partitioned Parquet table, touching only the days in each batch.

    A row replaces the stored one if its ``order`` (say, when it was fetched)
    is not less, so files may arrive in any order; with ``by_version=False``
    the later batch always wins, and ``update_cols`` can be given. Per
    micro-batch the distinct days of the delta (partition values, never data)
    select the stored partitions to read; the merged rows are staged beside
    the checkpoint (a path cannot be overwritten while it is read), replace
    exactly those day partitions (dynamic partition overwrite), and the stage
    goes. A replayed batch recomputes the same partitions: idempotent. Bound
    a batch by the source's ``maxFilesPerTrigger``.
    """
    if by_version and update_cols is not None:
        raise ValueError("columns that keep their stored value need by_version=False")
    spark = source.sparkSession
    full_key = [*key, partition_col] if partition_col not in key else list(key)

    def batch(df: DataFrame, epoch_id: int) -> None:
        delta = df.withColumn(partition_col, F.to_date(F.col(ts)))
        days = [r[0] for r in delta.select(partition_col).distinct().collect()]
        if not days:
            return
        base = None
        if _exists(spark, table_root):
            base = (spark.read.parquet(table_root).where(F.col(partition_col).isin(days))
                    .select(*delta.columns))
        merged = (merge_versions(base, delta, full_key, order) if by_version
                  else merge_latest(base, delta, full_key, order, update_cols))
        stage = f"{checkpoint.rstrip('/')}-stage/{epoch_id}"
        merged.write.mode("overwrite").parquet(stage)
        staged = spark.read.parquet(stage)
        spread = F.pmod(F.xxhash64(*[F.col(c) for c in key]), F.lit(files_per_partition))
        (staged.repartition(F.col(partition_col), spread).write.mode("overwrite")
               .option("partitionOverwriteMode", "dynamic").partitionBy(partition_col).parquet(table_root))
        fs, p = _fs(spark, stage)
        fs.delete(p, True)

    return (source.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint)
            .trigger(availableNow=True).start())


def _exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return fs.exists(p) and any(not st.getPath().getName().startswith(("_", ".")) for st in fs.listStatus(p))


def dedup_stream(source: DataFrame, key: Sequence[str], event_time: str, delay: str = "2 hours") -> DataFrame:
    """M2: streaming de-duplication within the watermark delay (first wins)."""
    return source.withWatermark(event_time, delay).dropDuplicatesWithinWatermark(list(key))


def windowed_rollup(source: DataFrame, event_time: str, keys: Sequence[str], value: str,
                    window: str = "1 hour", delay: str = "2 hours") -> DataFrame:
    """M3: tumbling-window count/sum/mean per key, append mode with watermark."""
    w = F.window(event_time, window)
    agg = (source.withWatermark(event_time, delay).groupBy(w.alias("w"), *keys)
           .agg(F.count(F.lit(1)).alias("n"), F.sum(value).alias("total"), F.avg(value).alias("mean")))
    return agg.select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), *keys,
                      "n", "total", "mean")


def run_available_now(df: DataFrame, path: str, checkpoint: str, fmt: str = "parquet", mode: str = "append"):
    """Drive a streaming query over everything available, then stop (file sink).

    With ``availableNow`` the query itself runs the batch without input rows
    that applies the watermark of the last data batch, so the windows it
    closes are emitted before it ends; there is no time limit."""
    q = (df.writeStream.format(fmt).outputMode(mode).option("path", path)
         .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    q.awaitTermination()
    return q
