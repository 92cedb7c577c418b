"""Sharding by Karmarkar-Karp differencing over indivisible groups.

A partial partition holds one sum per shard. Differencing takes the two with
the largest spread (largest minus smallest sum) and adds them in opposite
order, until one is left. Groups are dealt to tasks by hash; each task
differences its groups to one partial partition; these are differenced again,
``FAN_IN`` at a time, up a tree, and the shard numbers then travel back down.
A task holds at most about ``GROUPS_PER_TASK`` groups or ``FAN_IN`` partial
partitions, however large the input, and a group is one number there, however
many rows it has.

Defined cases: null texts are equal to empty ones; ties are broken by the
group's key; a group larger than the mean shard has a shard mostly to
itself; repeated rows of one id are rows of their own; empty tables give
empty results.
"""

from __future__ import annotations

import heapq

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ampere.llm.common import stored

GROUPS_PER_TASK = 20_000
FAN_IN = 512
#: Rows that one task numbers when slots are given out.
ROWS_PER_SLOT_TASK = 50_000


def difference(parts: list[np.ndarray], k: int) -> tuple[np.ndarray, list[np.ndarray]]:
    """Karmarkar-Karp on partial partitions of ``k`` sums, each descending.

    Returns the sums of the result, descending, and for each input the
    positions of its sums in that result.
    """
    nodes: list[tuple] = [(i,) for i in range(len(parts))]
    heap = [(int(p[-1] - p[0]), i, p) for i, p in enumerate(parts)]
    heapq.heapify(heap)
    while len(heap) > 1:
        _, a, pa = heapq.heappop(heap)
        _, b, pb = heap[0]
        added = pa + pb[::-1]
        order = np.argsort(-added, kind="stable")
        added = added[order]
        nodes.append((a, b, order))
        heapq.heapreplace(heap, (int(added[-1] - added[0]), len(nodes) - 1, added))
    place: list = [None] * len(nodes)
    place[heap[0][1]] = np.arange(k)
    for i in range(len(nodes) - 1, len(parts) - 1, -1):
        a, b, order = nodes[i]
        mine = np.empty(k, dtype=np.int64)
        mine[order] = place[i]
        place[a], place[b] = mine, mine[::-1]
        place[i] = None
    return heap[0][2], place[:len(parts)]


def _of_groups(k: int):
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["size", "key"], ascending=[False, True])
        parts = []
        for s in pdf["size"]:
            p = np.zeros(k, dtype=np.int64)
            p[0] = s
            parts.append(p)
        sums, place = difference(parts, k)
        out = pd.DataFrame({"key": pdf["key"].array, "node": pdf["node"].array, "place": [int(p[0]) for p in place]})
        out["sums"] = [list(map(int, sums))] + [None] * (len(out) - 1)
        return out
    return run


def _of_nodes(k: int):
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("node")
        sums, place = difference([np.asarray(s, dtype=np.int64) for s in pdf["sums"]], k)
        out = pd.DataFrame({"node": pdf["node"].array, "up": pdf["up"].array, "places": [list(map(int, p)) for p in place]})
        out["sums"] = [list(map(int, sums))] + [None] * (len(out) - 1)
        return out
    return run


def shards_of_groups(groups: DataFrame, n_shards: int) -> DataFrame:
    """``groups(key, size)`` to (key, shard), by differencing up a tree."""
    groups = stored(groups, "shard-groups")
    n_nodes = max(1, -(-groups.count() // GROUPS_PER_TASK))
    leaf = stored(groups.withColumn("node", F.pmod(F.xxhash64("key"), F.lit(n_nodes)))
                  .groupBy("node").applyInPandas(_of_groups(n_shards),
                                                 "key binary, node long, place int, sums array<long>"), "shard-leaf")
    levels, level = [], leaf
    while n_nodes > 1:
        n_nodes = -(-n_nodes // FAN_IN)
        level = stored(level.filter("sums is not null").select("node", "sums")
                       .withColumn("up", F.floor(F.col("node") / FAN_IN))
                       .groupBy("up").applyInPandas(_of_nodes(n_shards),
                                                    "node long, up long, places array<int>, sums array<long>"),
                       "shard-level")
        levels.append(level.select("node", "up", "places"))
        level = level.select(F.col("up").alias("node"), "sums")
    labels = None
    for lv in reversed(levels):
        if labels is None:
            labels = lv.select("node", "places")
        else:
            upper = labels.select(F.col("node").alias("up"), F.col("places").alias("upper"))
            labels = lv.join(upper, "up").select("node", F.transform("places", lambda p: F.col("upper")[p]).alias("places"))
    if labels is None:
        return leaf.select("key", F.col("place").alias("shard"))
    return leaf.join(labels, "node").select("key", F.col("places")[F.col("place")].alias("shard"))


def shard_documents(docs: DataFrame, n_shards: int, id_col: str = "doc_id", text_col: str = "text",
                    row_bytes: int = 16) -> DataFrame:
    """id, size, text_crc32, shard, slot: equal texts share a shard.

    Texts are reduced to a digest in the scan. The rows of a shard are
    numbered in pieces: each piece counts its rows, the counts are summed up
    before it, and rows are numbered within their piece.
    """
    t = F.coalesce(F.col(text_col), F.lit("")).cast("binary")
    rows = stored(docs.select(F.col(id_col).alias("id"), t.alias("b")).select(
        "id", F.unhex(F.md5("b")).alias("key"), (F.octet_length("b") + row_bytes).cast("long").alias("size"),
        F.crc32("b").alias("text_crc32")), "shard-rows")
    shards = stored(shards_of_groups(rows.groupBy("key").agg(F.sum("size").alias("size")), n_shards), "shards")
    n_pieces = max(1, -(-rows.count() // (n_shards * ROWS_PER_SLOT_TASK)) * 4)
    placed = stored(rows.join(shards, "key").withColumn(
        "piece", F.pmod(F.xxhash64("id", "text_crc32"), F.lit(n_pieces))), "shard-placed")
    before = Window.partitionBy("shard").orderBy("piece").rowsBetween(Window.unboundedPreceding, -1)
    start = (placed.groupBy("shard", "piece").agg(F.count("*").alias("n"))
             .select("shard", "piece", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start")))
    within = Window.partitionBy("shard", "piece").orderBy("id", "text_crc32", "size")
    return (placed.withColumn("k", F.row_number().over(within) - 1).join(start, ["shard", "piece"])
            .select(F.col("id").alias(id_col), "size", "text_crc32", F.col("shard").cast("int").alias("shard"),
                    (F.col("start") + F.col("k")).cast("long").alias("slot")))
