"""Keyed upsert and latest-version selection.

Both are expressed as one hash/sort aggregate on the key with
``max(struct(order..., payload...))``: partial aggregation runs map-side, so a
key that holds a large share of all rows is collapsed before the shuffle
instead of landing whole in one task (as a ``row_number`` window would).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def latest_per_key(df: DataFrame, key: Sequence[str], order: Sequence[str],
                   payload: Sequence[str] | None = None) -> DataFrame:
    """One row per ``key`` — the row with the greatest ``order`` tuple.

    ``order`` should end with a unique tie-breaker; remaining ties are broken
    by the payload values, so the result is deterministic.
    """
    key, order = list(key), list(order)
    payload = [c for c in (payload if payload is not None else df.columns) if c not in key and c not in order]
    packed = F.max(F.struct(*[F.col(c).alias(f"_o{i}") for i, c in enumerate(order)],
                            *[F.col(c) for c in payload])).alias("_best")
    out = df.groupBy(*key).agg(packed)
    cols = [F.col(c) for c in key]
    cols += [F.col(f"_best._o{i}").alias(c) for i, c in enumerate(order)]
    cols += [F.col(f"_best.{c}").alias(c) for c in payload]
    return out.select(*cols).select(*[c for c in df.columns if c in key + order + payload])


def merge_latest(base: DataFrame | None, delta: DataFrame, key: Sequence[str],
                 order: Sequence[str] = (), update_cols: Sequence[str] | None = None) -> DataFrame:
    """``INSERT ... ON CONFLICT (key) DO UPDATE`` as a pure DataFrame op.

    Delta rows win over base rows; among several delta rows of one key the one
    with the greatest ``order`` wins (the source database would reject such a
    batch). Columns not in ``update_cols`` keep the base value when the key
    exists. Applying the same delta twice gives the same table (idempotent).
    """
    key, order = list(key), list(order)
    cols = delta.columns
    if base is None:
        return latest_per_key(delta, key, order, payload=cols)
    update_cols = list(update_cols) if update_cols is not None else [c for c in cols if c not in key]
    keep = [c for c in cols if c not in key and c not in update_cols]
    tagged = (base.select(*cols).withColumn("_is_delta", F.lit(0))
              .unionByName(delta.select(*cols).withColumn("_is_delta", F.lit(1))))
    if not keep:
        winner = latest_per_key(tagged, key, ["_is_delta", *order], payload=cols)
        return winner.drop("_is_delta").select(*cols)
    # one aggregate: the winning row, plus the stored values of the columns an
    # update must not change (no second join against the base)
    payload = [c for c in cols if c not in key and c not in order]
    best = F.max(F.struct(F.col("_is_delta").alias("_o_d"), *[F.col(c).alias(f"_o{i}") for i, c in enumerate(order)],
                          *[F.col(c) for c in payload])).alias("_best")
    old = F.max(F.when(F.col("_is_delta") == 0, F.struct(*[F.col(c) for c in keep]))).alias("_old")
    g = tagged.groupBy(*key).agg(best, old)
    sel = {c: F.col(c) for c in key}
    sel.update({c: F.col(f"_best._o{i}").alias(c) for i, c in enumerate(order)})
    for c in payload:
        sel[c] = (F.when(F.col("_old").isNotNull(), F.col(f"_old.{c}")).otherwise(F.col(f"_best.{c}")).alias(c)
                  if c in keep else F.col(f"_best.{c}").alias(c))
    return g.select(*[sel[c] for c in cols])


def merge_versions(base: DataFrame | None, delta: DataFrame, key: Sequence[str], version: Sequence[str]) -> DataFrame:
    """M1: upsert by a stored version: the row with the greatest ``version`` wins, whichever delivery brings it.

    Deliveries can come in any order or twice. Of equal versions the delta's
    row wins.
    """
    cols = delta.columns
    if base is None:
        return latest_per_key(delta, key, version, payload=cols)
    both = (base.select(*cols).withColumn("_is_delta", F.lit(0))
            .unionByName(delta.select(*cols).withColumn("_is_delta", F.lit(1))))
    return latest_per_key(both, key, [*version, "_is_delta"], payload=cols).select(*cols)


def drop_revisions_first_wins(df: DataFrame, key: Sequence[str], order: Sequence[str]) -> DataFrame:
    """M2 batch twin: keep the *earliest* version per key (first wins)."""
    key, order = list(key), list(order)
    neg = df
    packed = F.min(F.struct(*[F.col(c).alias(f"_o{i}") for i, c in enumerate(order)],
                            *[F.col(c) for c in df.columns if c not in key and c not in order])).alias("_b")
    out = neg.groupBy(*key).agg(packed)
    sel = [F.col(c) for c in key] + [F.col(f"_b._o{i}").alias(c) for i, c in enumerate(order)]
    sel += [F.col(f"_b.{c}").alias(c) for c in df.columns if c not in key and c not in order]
    return out.select(*sel).select(*df.columns)
