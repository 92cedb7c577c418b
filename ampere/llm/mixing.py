"""Mixing sources to target weights by Efraimidis-Spirakis sampling.

Every row draws the exponential key ``-ln(u) / w`` from a hash of its id and
its quality weight ``w``; ascending keys are a weighted sample without
replacement. A source's target is served by whole epochs (every row once
more) and then by rows in key order until their sizes, summed from the
start, reach what is left; the row at the edge gives the words still missing.

The running sum is taken in two steps: rows are dealt by range of source and
key to partitions of like size, which are written down with their number;
partitions are summed and accumulated, and rows are accumulated within their
partition. No task sees a whole source, however its keys are spread. Targets
come from one row per source.

Defined cases: null texts have size 0 and are never taken; a null source is
a source of its own, ordered last; sources of size 0 have target 0; ties of
keys are broken by id and size; rows of equal id and size are alike, so any
of them may stand first; empty tables give empty results.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ampere.llm.common import BROADCAST_IDS, stored, words_of, unused

#: Times that a source may be repeated at most.
MAX_EPOCHS = 3
#: Rows (four numbers each) that one range of keys holds, on average, at most.
ROWS_PER_RANGE = 200_000


def quality_weight(text: Column) -> Column:
    """0.05 to 1: the share of a text's characters that are no sign or digit, squared."""
    t = F.coalesce(text, F.lit(""))
    odd = F.length(t) - F.length(F.translate(t, "#*$%&|<>!0123456789", ""))
    return F.greatest(F.lit(0.05), F.pow(1 - odd / F.greatest(F.length(t), F.lit(1)), F.lit(2.0)))


def source_targets(sizes: DataFrame, cycle: tuple[int, ...] = (1, 2, 3), max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """``sizes(source, source_size)`` to (source, source_size, target).

    Sources in code-point order, null last, weigh the cycle's numbers in
    turn. With cap ``max_epochs * size`` the target is ``min(cap, weight * x)``
    where x makes targets add up to all sizes: sorted by cap / weight, x
    follows from the sums of the caps before and the weights after.
    """
    order = Window.orderBy(F.col("source").isNull(), F.col("source"))  # one row per source
    k = (F.row_number().over(order) - 1) % len(cycle)
    s = sizes.withColumn("weight", F.element_at(F.array(*map(F.lit, cycle)), (k + 1).cast("int")).cast("double"))
    s = s.withColumn("cap", F.col("source_size").cast("double") * max_epochs)
    by = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").isNull(), F.col("source"))
    everything = Window.partitionBy()
    s = (s.withColumn("total", F.sum(F.col("source_size").cast("double")).over(everything))
         .withColumn("before", F.coalesce(F.sum("cap").over(by.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0)))
         .withColumn("after", F.sum("weight").over(by.rowsBetween(Window.currentRow, Window.unboundedFollowing)))
         .withColumn("x", (F.col("total") - F.col("before")) / F.col("after")))
    # the first source whose cap is not reached fixes x for itself and all after it
    first = F.min(F.when(F.col("x") * F.col("weight") <= F.col("cap"), F.struct("nth", "x")))
    s = s.withColumn("nth", F.row_number().over(by)).withColumn("level", first.over(everything)["x"])
    return s.select("source", "source_size",
                    F.least("cap", F.coalesce(F.col("level") * F.col("weight"), "cap")).alias("target"))


def mix_sources(docs: DataFrame, weight: Column | None = None, id_col: str = "doc_id", text_col: str = "text",
                source_col: str = "source", cycle: tuple[int, ...] = (1, 2, 3), max_epochs: int = MAX_EPOCHS,
                seed: int = 17, row_col: str | None = None) -> DataFrame:
    """id, source, size, source_size, target, taken and copies (and ``row_col``, if one is given).

    ``taken`` counts the words that the mix takes of the row; ``copies`` is
    the number of whole copies for a mix of whole rows, where the edge row is
    taken if half of it or more is due.
    """
    t = F.col(text_col)
    w = F.greatest(weight if weight is not None else quality_weight(t), F.lit(1e-6))
    u = (F.pmod(F.xxhash64(F.col(id_col).cast("string"), F.lit(seed)), F.lit(1 << 52)) + 0.5) / F.lit(float(1 << 52))
    row = [F.col(row_col).alias("row")] if row_col else []
    rows = stored(docs.select(*row, F.col(id_col).alias("id"), F.col(source_col).alias("source"),
                              F.size(words_of(t)).cast("long").alias("size"), (-F.log(u) / w).alias("key")), "mix-rows")
    targets = stored(source_targets(rows.groupBy("source").agg(F.sum("size").alias("source_size")), cycle, max_epochs),
                     "mix-targets").withColumnRenamed("source", "s")
    n = max(1, math.ceil(rows.count() / ROWS_PER_RANGE))
    # ranges are found by sampling; rows alike in all else are told apart by a stored number, so they part as well
    rows = stored(stored(rows.withColumn("nth", F.monotonically_increasing_id()), "mix-numbered")
                  .repartitionByRange(n, "source", "key", "id", "size", "nth")
                  .withColumn("rng", F.spark_partition_id()), "mix-ranges")
    ranges = rows.groupBy("source", "rng").agg(F.sum("size").alias("n"))
    start = ranges.select(
        F.col("source").alias("s2"), F.col("rng").alias("r2"),
        F.coalesce(F.sum("n").over(Window.partitionBy("source").orderBy("rng")
                                   .rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("start"))
    within = Window.partitionBy("source", "rng").orderBy("key", "id", "size", "nth").rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumn("ahead", F.coalesce(F.sum("size").over(within), F.lit(0)))
    # one row per source and range, and one per source: sides that adaptive execution broadcasts if they are small
    rows = (rows.join(start, F.col("source").eqNullSafe(F.col("s2")) & (F.col("rng") == F.col("r2")))
            .join(targets, F.col("source").eqNullSafe(F.col("s"))))
    due = F.round("target").cast("long")
    epochs = F.when(F.col("source_size") > 0, F.floor(due / F.col("source_size"))).otherwise(0)
    rows = rows.withColumn("epochs", epochs.cast("long")).withColumn(
        "left", due - F.col("epochs") * F.col("source_size") - F.col("start") - F.col("ahead"))
    part = F.greatest(F.lit(0), F.least("size", "left"))
    return rows.select(
        F.col("id").alias(id_col), F.col("source").alias(source_col), "size", "source_size", "target",
        (F.col("epochs") * F.col("size") + part).cast("long").alias("taken"),
        F.when(F.col("size") > 0, F.col("epochs") + F.when(2 * part >= F.col("size"), 1).otherwise(0)).otherwise(0)
        .cast("int").alias("copies"), *[F.col("row").alias(row_col) for _ in row])


def mixed_documents(docs: DataFrame, id_col: str = "doc_id", weight: Column | None = None, **kw) -> DataFrame:
    """The whole rows of the mix: every row as often as it has copies.

    Rows are written down with a number of their own, by which their copies
    come back, so rows of null or repeated ids keep their own decisions.
    Texts are not shuffled unless the decisions are too many to broadcast.
    """
    row, own, of, copies, copy = (unused(docs, n) for n in ("__row", "__weight", "__of", "__copies", "__copy"))
    extra = {} if weight is None else {own: weight}
    rows = stored(docs.withColumns({row: F.monotonically_increasing_id(), **extra}), "mix-documents")
    mix = mix_sources(rows, F.col(own) if extra else None, id_col=id_col, row_col=row, **kw)
    found = stored(mix.filter("copies > 0").select(F.col(row).alias(of), F.col("copies").alias(copies)), "mix-copies")
    side = F.broadcast(found) if found.limit(BROADCAST_IDS + 1).count() <= BROADCAST_IDS else found
    return (rows.join(side, F.col(row) == F.col(of))
            .withColumn(copy, F.explode(F.sequence(F.lit(1), F.col(copies))))
            .select(*[rows[c] for c in docs.columns]))
