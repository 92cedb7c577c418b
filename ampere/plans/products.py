"""The analytics DAG: staging views -> facts -> feature tables.

A :class:`Warehouse` holds the raw tables and builds each product lazily as a
DataFrame; :func:`materialize` writes them in dependency order (staging as
temp views, analytics as Parquet tables), like the original model DAG.
"""

from __future__ import annotations

import datetime as dt
import re
from collections.abc import Mapping, Sequence
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ampere.config import Catalog
from ampere.functions.calendar import calendar_columns, dimension_for
from ampere.operators import reshape, staging
from ampere.operators.merge import latest_per_key
from ampere.plans.contracts import ContractSpec, build_contract


class Warehouse:
    """Raw tables in, data products out. ``raw`` keys: generation, prices,
    neighbour_prices, signal_forecast, weather, weather_forecast."""

    DEPENDENCIES = {
        "stg_generation_load": ["generation"],
        "stg_generation_load_forecast": ["signal_forecast"],
        "stg_prices": ["prices"],
        "stg_neighbour_prices": ["neighbour_prices"],
        "stg_weather": ["weather"],
        "stg_weather_forecast": ["weather_forecast"],
        "fct_generation_load": ["stg_generation_load"],
        "fct_generation_load_forecast": ["stg_generation_load_forecast"],
        "fct_market_prices": ["stg_prices"],
        "fct_price_spreads": ["stg_prices", "stg_neighbour_prices"],
        "fct_weather": ["stg_weather"],
        "fct_weather_forecast": ["stg_weather_forecast"],
        "fct_weather_forecast_features": ["stg_weather_forecast", "dim_date"],
        "dim_date": ["stg_prices"],
        "fct_ml_features": ["fct_market_prices", "fct_generation_load", "fct_generation_load_forecast",
                            "fct_price_spreads", "fct_weather", "fct_weather_forecast", "dim_date"],
    }

    def __init__(self, spark: SparkSession, raw: dict[str, DataFrame], catalog: Catalog):
        self.spark, self.raw, self.catalog = spark, raw, catalog

    # -- staging (views) --------------------------------------------------
    @cached_property
    def stg_generation_load(self) -> DataFrame:
        return staging.stage_generation(self.raw["generation"], self.catalog)

    @cached_property
    def stg_generation_load_forecast(self) -> DataFrame:
        return staging.stage_forecast(self.raw["signal_forecast"], self.catalog)

    @cached_property
    def stg_prices(self) -> DataFrame:
        return staging.stage_prices(self.raw["prices"])

    @cached_property
    def stg_neighbour_prices(self) -> DataFrame:
        return staging.stage_prices(self.raw["neighbour_prices"])

    @cached_property
    def stg_weather(self) -> DataFrame:
        return staging.stage_weather(self.raw["weather"])

    @cached_property
    def stg_weather_forecast(self) -> DataFrame:
        return staging.stage_weather_forecast(self.raw["weather_forecast"])

    # -- analytics (tables) -------------------------------------------------
    @cached_property
    def dim_date(self) -> DataFrame:
        """Calendar over the dates the price series covers (derived, bounded by days)."""
        return dimension_for(self.stg_prices)

    @cached_property
    def fct_generation_load(self) -> DataFrame:
        return reshape.pivot_generation_load(self.stg_generation_load, self.catalog)

    @cached_property
    def fct_generation_load_forecast(self) -> DataFrame:
        return reshape.pivot_forecast(self.stg_generation_load_forecast, self.catalog)

    @cached_property
    def fct_market_prices(self) -> DataFrame:
        return self.stg_prices.select("timestamp", "resolution", F.col("value").alias("price_eur_mwh"))

    @cached_property
    def fct_price_spreads(self) -> DataFrame:
        return reshape.price_spreads(self.stg_neighbour_prices, self.stg_prices, self.catalog)

    @cached_property
    def fct_weather(self) -> DataFrame:
        return reshape.pivot_region_variable(self.stg_weather, self.catalog)

    @cached_property
    def fct_weather_forecast(self) -> DataFrame:
        """Max over all fetched versions."""
        return reshape.pivot_region_variable(self.stg_weather_forecast, self.catalog, suffix="_forecast")

    @cached_property
    def fct_weather_forecast_features(self) -> DataFrame:
        """Latest fetched version per key (E2), pivoted (D5), with calendar (C4)."""
        latest = latest_per_key(self.stg_weather_forecast.select("timestamp", "region", "signal_name",
                                                                 "value", "fetched_at"),
                                ["timestamp", "region", "signal_name"], ["fetched_at"])
        wide = reshape.pivot_region_variable(latest, self.catalog)
        return wide.select("*", F.to_date("timestamp").alias("date_day"), *calendar_columns("to_date(timestamp)"))

    @cached_property
    def fct_ml_features(self) -> DataFrame:
        """Market price left-joined with every fact."""
        on = ["timestamp", "resolution"]
        g = self.fct_generation_load
        # the wide table omits retired signals (nuclear in the energy catalogue)
        g = g.drop(*[self.catalog.generation_load[s] for s in self.catalog.retired
                     if s in self.catalog.generation_load])
        out = (self.fct_market_prices
               .join(g, on, "left")
               .join(self.fct_generation_load_forecast, on, "left")
               .join(self.fct_price_spreads, on, "left")
               .join(self.fct_weather, ["timestamp"], "left")
               .join(self.fct_weather_forecast, ["timestamp"], "left"))
        # C4: calendar of the UTC date; the dimension's attributes are pure
        # functions of the day, so they are computed in place of a dim join
        return out.select("*", F.to_date("timestamp").alias("date_day"), *calendar_columns("to_date(timestamp)"))

    def product(self, name: str) -> DataFrame:
        return getattr(self, name)


#: The layer of a product, by the first part of its name.
LAYERS = {"stg": "staging", "fct": "analytics", "dim": "analytics"}


def schema_name(custom: str | None, default: str) -> str:
    """N-7: the schema a product is stored in: its own name as it stands (blanks cut off), else the default."""
    return default if custom is None else custom.strip()


def qualified_name(product: str, default: str = "raw") -> str:
    """``schema.product``, the schema by the product's layer; names of no layer go to the default schema."""
    return f"{schema_name(LAYERS.get(product.split('_', 1)[0]), default)}.{product}"


def dependency_order(deps: dict[str, list[str]]) -> list[str]:
    """Topological order of the model DAG (raw inputs excluded)."""
    order, seen = [], set()

    def visit(n):
        if n in seen or n not in deps:
            return
        seen.add(n)
        for d in deps[n]:
            visit(d)
        order.append(n)
    for n in deps:
        visit(n)
    return order


def materialize(wh: Warehouse, out_dir: str, names: list[str] | None = None, by_schema: bool = False) -> dict[str, str]:
    """Staging -> temp views; analytics -> Parquet tables, in DAG order.

    Each table is written, then re-read, so downstream products start from
    the stored table (lineage cut at every analytics boundary). With
    ``by_schema`` (N-7) a table lies in the folder of its schema and is listed
    by its qualified name.
    """
    written = {}
    for name in dependency_order(wh.DEPENDENCIES):
        if names is not None and name not in names:
            continue
        df = wh.product(name)
        if name.startswith("stg_"):
            df.createOrReplaceTempView(name)
            continue
        title = qualified_name(name) if by_schema else name
        path = f"{out_dir}/{title.replace('.', '/')}"
        df.write.mode("overwrite").parquet(path)
        stored = wh.spark.read.parquet(path)
        wh.__dict__[name] = stored
        stored.createOrReplaceTempView(name)
        written[title] = path
    return written


# --- incremental form -------------------------------------------------------------

#: Days before and after a changed day that a contract's rows can change (its longest lag is 7 days, a delivery day
#: begins on the UTC day before), and that its rows read.
CONTRACT_WRITES, CONTRACT_READS = (-1, 7), (-9, 8)


def _days_around(days: Sequence[dt.date], before: int, after: int) -> list[dt.date]:
    return sorted({d + dt.timedelta(days=k) for d in days for k in range(before, after + 1)})


def _write_days(df: DataFrame, path: str, days: Sequence[dt.date] | None) -> list[dt.date]:
    """Write ``df`` by UTC day; with ``days`` replace these partitions only, removing those that have no rows any more."""
    spark = df.sparkSession
    out = df.withColumn("day", F.to_date("timestamp"))
    if days is not None:
        out = out.where(F.col("day").isin(list(days)))
    # a file a day, so the number of files is the work: tasks by it, not by bytes, and every task moves its own files
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions")) if days is None else 1
    (out.repartition(tasks, "day").write.mode("overwrite").option("mapreduce.fileoutputcommitter.algorithm.version", "2")
        .option("partitionOverwriteMode", "static" if days is None else "dynamic").partitionBy("day").parquet(path))
    if days is None:
        return sorted(r["day"] for r in stored_partitions_of(spark, path))
    gone = set(_stored_days(spark, path, days)) - {r["day"] for r in out.select("day").distinct().collect()}   # calendar days, not data
    for d in gone:
        p = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/day={d.isoformat()}")
        p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)
    return sorted(set(days))


def stored_partitions_of(spark: SparkSession, path: str) -> list[dict]:
    """The ``day`` partitions of a product, from its folder names (handed over in one piece, not a call for each)."""
    jvm = spark._jvm
    p = jvm.org.apache.hadoop.fs.Path(f"{path}/day=*")
    if not p.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(p):
        return []
    files = jvm.org.apache.hadoop.util.StringUtils.arrayToString(spark.read.parquet(path)._jdf.inputFiles())
    return [{"day": dt.date.fromisoformat(d)} for d in sorted(set(re.findall(r"/day=([^/]+)/", files)))]


def _stored_days(spark: SparkSession, path: str, days: Sequence[dt.date]) -> list[dt.date]:
    """Those of the days that have a partition, each looked up by its folder."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs, new = folder.getFileSystem(spark._jsc.hadoopConfiguration()), spark._jvm.org.apache.hadoop.fs.Path
    return [d for d in sorted(set(days)) if fs.exists(new(f"{path}/day={d.isoformat()}"))]


def _read_days(spark: SparkSession, path: str, days: Sequence[dt.date]) -> DataFrame:
    """The partitions of some days, without listing the others."""
    have = _stored_days(spark, path, days)
    if not have:
        return spark.read.parquet(path).where(F.col("day").isin(list(days)))
    return spark.read.option("basePath", path).parquet(*[f"{path}/day={d.isoformat()}" for d in have])


def refresh(spark: SparkSession, raw: Mapping[str, DataFrame], catalog: Catalog, root: str,
            specs: Mapping[str, ContractSpec], changed: Sequence[dt.date] | None = None) -> dict[str, list[dt.date]]:
    """(re)build the analytics tables and the contracts under ``root``, in dependency order.

    Every table is partitioned by UTC day. Without ``changed`` all are built.
    With the days whose raw rows changed, the facts rewrite these days only,
    from raw rows of these days, and a contract rewrites the days that its
    lags and delivery days reach, from the stored feature table. Returns the
    days written per table.
    """
    if changed is not None:
        raw = {k: v.where(F.to_date("timestamp").isin(list(changed))) for k, v in raw.items()}
    wh, written = Warehouse(spark, dict(raw), catalog), {}
    for name in dependency_order(wh.DEPENDENCIES):
        if name.startswith("stg_"):
            continue
        path = f"{root}/{name}"
        if name == "dim_date":   # the calendar changes only with the span of the data: rebuilt with everything
            if changed is None:
                wh.product(name).write.mode("overwrite").parquet(path)
            continue
        written[name] = _write_days(wh.product(name), path, changed)
        wh.__dict__[name] = (spark.read.parquet(path) if changed is None else _read_days(spark, path, changed)).drop("day")
    features = f"{root}/fct_ml_features"
    for name, spec in specs.items():
        base = spark.read.parquet(features) if changed is None else _read_days(spark, features, _days_around(changed, *CONTRACT_READS))
        days = None if changed is None else _days_around(changed, *CONTRACT_WRITES)
        written[name] = _write_days(build_contract(base.drop("day"), spec), f"{root}/{name}", days)
    return written
