"""Spark session defaults and lineage-cutting helpers."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Session settings every operator relies on. Instants are UTC; local market
# time is always derived explicitly (functions.time.to_local).
BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.parquet.datetimeRebaseModeInWrite": "CORRECTED",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    # Sizing for large volumes: scan splits and AQE's post-shuffle target both
    # ~128 MB so a task's partition fits comfortably in executor memory; the
    # initial shuffle partition count should be high (e.g. total shuffle
    # bytes / 128 MB: ~8k for 1 TB shuffled) and AQE coalesces small ones.
    "spark.sql.files.maxPartitionBytes": "128m",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    # folders of a table are listed by so many tasks, not by one for each folder
    "spark.sql.sources.parallelPartitionDiscovery.parallelism": "64",
    # a partition 5x the median and > 256 MB is split by the skew-join rule
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "5",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "256m",
}


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app_name: str = "ampere", extra: dict | None = None) -> SparkSession:
    """Build (or reuse) a session with the engine defaults.

    On a cluster leave ``master`` unset; ``shuffle_partitions`` should then be
    sized so one shuffle partition stays around 128-256 MB at the target scale.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(BASE_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    for k, v in conf.items():
        if not k.startswith("spark.ui") and not k.startswith("spark.driver"):
            try:
                spark.conf.set(k, v)
            except Exception:  # static conf of an already running session
                pass
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    On a cluster this setting must point at shared storage and is only read.
    A local folder is created only when the setting is unset and the master
    is local (tests, laptops); elsewhere an unset folder is an error.
    """
    d = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not d:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
        d = tempfile.mkdtemp(prefix="ampere-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
        spark.conf.set("spark.checkpoint.dir", d)
    spark.sparkContext.setCheckpointDir(d)
    return d


def cut_lineage(df: DataFrame, name: str = "cut") -> DataFrame:
    """Materialise ``df`` as a Parquet table in the shared checkpoint folder
    and continue from the stored table.

    One computation (``Dataset.checkpoint`` runs its input twice unless it is
    persisted), survives executor loss (unlike a local checkpoint), and the
    re-read side gets file statistics for AQE.
    """
    root = ensure_checkpoint_dir(df.sparkSession)
    path = f"{root.rstrip('/')}/ampere-{name}-{uuid.uuid4().hex}"
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.parquet(path)
