"""Results: normalisation shared by every registered query, rounding, order at the sink."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T


def tidy(df: DataFrame, digits: int = 6) -> DataFrame:
    """Round doubles, widen integers to BIGINT, instants and days to naive UTC (NTZ).

    Makes results comparable with an SQL oracle independent of summation order.
    Doubles are rounded in two steps: the first removes last-ulp noise so that
    exact ties (e.g. a mean ending in ...5) round the same in every engine.
    Built as one ``selectExpr`` (a single call, however wide the result).
    """
    exprs = []
    for f in df.schema.fields:
        c = "`" + f.name.replace("`", "``") + "`"
        t = f.dataType
        if isinstance(t, (T.DoubleType, T.FloatType, T.DecimalType)):
            e = f"round(round(CAST({c} AS DOUBLE), {digits + 3}), {digits})"
        elif isinstance(t, (T.IntegerType, T.ShortType, T.ByteType)):
            e = f"CAST({c} AS BIGINT)"
        elif isinstance(t, (T.TimestampType, T.DateType)):
            # calendar days as midnight NTZ: same pandas/arrow type as SQL TIMESTAMP
            e = f"CAST({c} AS TIMESTAMP_NTZ)"
        else:
            e = c
        exprs.append(f"{e} AS {c}")
    return df.selectExpr(*exprs)


def rounded(columns: Sequence[str], digits: int) -> list[Column]:
    """The columns rounded to ``digits``, halves to the even digit."""
    return [F.bround(F.col(c), digits).alias(c) for c in columns]


def write_ordered(df: DataFrame, path: str, by: Sequence[str]) -> None:
    """a table stored in the order of ``by``: every file holds one range, in order, and the files' numbers ascend.

    A sampled range shuffle and a sort inside each range: no task sees more
    than its range. Rows that are equal in ``by`` stay in one file.
    """
    df.repartitionByRange(*by).sortWithinPartitions(*by).write.mode("overwrite").parquet(path)


def read_ordered(spark: SparkSession, path: str, position: str = "position") -> DataFrame:
    """a table of :func:`write_ordered` with the place of each row, from 0.

    The place is the number of rows in earlier files plus the row's index in
    its own, so nothing is sorted again. The window runs over one row a file.
    """
    rows = spark.read.parquet(path)
    rows = rows.select("*", F.regexp_extract("_metadata.file_name", r"part-(\d+)", 1).cast("long").alias("_file"),
                       F.col("_metadata.row_index").alias("_row"))
    before = Window.orderBy("_file").rowsBetween(Window.unboundedPreceding, -1)
    files = rows.groupBy("_file").agg(F.count(F.lit(1)).alias("n")).select(
        "_file", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("_before"))
    return rows.join(files, "_file").withColumn(position, F.col("_before") + F.col("_row")).drop("_file", "_row", "_before")
