"""Seeds, reports and versioned artifacts."""

from __future__ import annotations

import datetime as dt
import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

VERSION_RE = re.compile(r"^\d{8}-\d{6}$")
HOLIDAY_SEED_SCHEMA = T.StructType([T.StructField("date", T.DateType()), T.StructField("holiday_name", T.StringType())])


def read_seed_csv(spark: SparkSession, path: str, schema: T.StructType = HOLIDAY_SEED_SCHEMA) -> DataFrame:
    """CSV seed with header and an explicit schema (no inference)."""
    return spark.read.schema(schema).option("header", True).csv(path)


def write_report(report: DataFrame, path: str) -> None:
    """A (small, one-row) report as JSON; nested columns stay nested."""
    report.coalesce(1).write.mode("overwrite").json(path)


def version_stamp(now: dt.datetime | None = None) -> str:
    return (now or dt.datetime.now(dt.timezone.utc)).strftime("%Y%m%d-%H%M%S")


def check_version(version: str) -> str:
    """``latest`` or ``YYYYMMDD-HHMMSS``; anything else is rejected."""
    if version != "latest" and not VERSION_RE.match(version):
        raise ValueError(f"invalid version {version!r}: use 'latest' or YYYYMMDD-HHMMSS")
    return version


def save_versioned(obj, root: str, name: str, now: dt.datetime | None = None, spark: SparkSession | None = None) -> str:
    """Write ``obj`` once to ``{root}/{name}/archive/{stamp}``, then publish it as ``latest``.

    ``latest`` is a manifest, one small file that names the archived version
    and is written only when that is complete: a reader gets the version
    before or the new one, never half of one, and the plan of a DataFrame
    (parameters, reports: Parquet) runs once. Other objects are Spark ML
    models or pipelines (ML persistence). A stamp that is taken is refused.
    """
    stamp = version_stamp(now)
    spark = spark or (obj.sparkSession if isinstance(obj, DataFrame) else SparkSession.active())
    path = f"{root}/{name}/archive/{stamp}"
    fs, p = _fs(spark, path)
    if fs.exists(p):
        raise FileExistsError(f"version {stamp} of {name} exists")
    if isinstance(obj, DataFrame):
        obj.write.parquet(path)
    else:
        obj.write().save(path)
    _publish(spark, root, name, stamp)
    return stamp


def _fs(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def _publish(spark: SparkSession, root: str, name: str, stamp: str) -> None:
    """Point ``latest`` at a version: a new file beside it, then one rename over it."""
    fs, new = _fs(spark, f"{root}/{name}/.latest-{stamp}")
    out = fs.create(new, True)
    out.write(bytearray(stamp.encode()))
    out.close()
    latest = spark._jvm.org.apache.hadoop.fs.Path(f"{root}/{name}/latest")
    options = spark._jvm.org.apache.hadoop.fs.FileContext.getFileContext(latest.toUri(), spark._jsc.hadoopConfiguration())
    overwrite = spark._jvm.org.apache.hadoop.fs.Options.Rename.OVERWRITE
    args = spark.sparkContext._gateway.new_array(spark._jvm.org.apache.hadoop.fs.Options.Rename, 1)
    args[0] = overwrite
    options.rename(new, latest, args)


def latest_version(spark: SparkSession, root: str, name: str) -> str:
    """The version that ``latest`` names."""
    row = spark.read.text(f"{root}/{name}/latest").first()
    return check_version(row[0].strip())


def load_versioned(spark: SparkSession, root: str, name: str, version: str = "latest", loader=None):
    """Load ``latest`` or an archived version; ``loader`` (e.g.
    ``PipelineModel.load``) for ML models, Parquet otherwise."""
    stamp = latest_version(spark, root, name) if check_version(version) == "latest" else version
    path = f"{root}/{name}/archive/{stamp}"
    return loader(path) if loader is not None else spark.read.parquet(path)


def hyperparameter_record(params: dict, cv_mae: float, n_trials: int, spark: SparkSession) -> DataFrame:
    """One-row parameter artifact (params as a map, cv_mae, n_trials, tuned_at)."""
    m = F.create_map(*[x for k, v in params.items() for x in (F.lit(k), F.lit(float(v)))])
    return spark.range(1).select(m.alias("params"), F.lit(float(cv_mae)).alias("cv_mae"),
                                 F.lit(int(n_trials)).alias("n_trials"), F.current_timestamp().alias("tuned_at"))
