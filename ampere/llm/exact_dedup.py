"""Exact dedup by progressive refinement, in DataFrame operations only.

Lengths of the normalised texts are counted first. Only rows of a length that
repeats get a hash of their prefix, and only rows that still share length and
prefix with another row have their full content hashed and compared. The
first two steps shuffle counted numbers, the last one digest a surviving row.
Texts themselves are never shuffled, unless the surviving lengths or (length,
prefix) groups are too many to broadcast.

Defined cases: null counts as the empty text; of equal texts the smallest id
stays (null ids come last; if all are null, none is smallest and all stay);
repeated rows of one id stay or go together, and ``drop_copies`` leaves one
of them; empty tables give empty results.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ampere.llm.common import one_space, stored, unused, without_ids

#: Characters that the prefix hash covers.
PREFIX_CHARS = 128
#: (length, prefix) groups broadcast at most: 24 bytes each, so under 48 MB.
BROADCAST_GROUPS = 2_000_000


def _few(groups: DataFrame) -> DataFrame:
    """Broadcast if counted to at most :data:`BROADCAST_GROUPS` rows."""
    return F.broadcast(groups) if groups.limit(BROADCAST_GROUPS + 1).count() <= BROADCAST_GROUPS else groups


def surviving_groups(texts: DataFrame, norm: Column) -> DataFrame:
    """The (n_bytes, prefix_hash) groups of two rows or more.

    First lengths alone, then prefixes of the rows whose length repeats. Rows
    of one length or prefix are counted map-side, so a common text costs no
    more than a rare one.
    """
    sized = texts.select(norm.alias("t")).withColumn("n_bytes", F.octet_length("t"))
    lengths = stored(sized.groupBy("n_bytes").agg(F.count("*").alias("n")).filter("n > 1").select("n_bytes"), "dedup-lengths")
    prefix = F.xxhash64(F.substring("t", 1, PREFIX_CHARS)).alias("prefix_hash")
    return (sized.join(_few(lengths), "n_bytes", "left_semi").select("n_bytes", prefix)
            .groupBy("n_bytes", "prefix_hash").agg(F.count("*").alias("n")).filter("n > 1").select("n_bytes", "prefix_hash"))


def exact_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 digest_all: bool = False) -> DataFrame:
    """One row per input row: id, keep_id, group_size, kept and text_sha256.

    ``text_sha256`` is the digest of the normalised text where the row's
    group survived to the last step, else null; with ``digest_all`` every row
    carries it.
    """
    docs = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    norm = one_space(F.col("text"))
    groups = stored(surviving_groups(docs, norm), "dedup-groups").withColumn("survives", F.lit(True))
    keyed = (docs.select("id", norm.alias("t"))
             .withColumn("n_bytes", F.octet_length("t"))
             .withColumn("prefix_hash", F.xxhash64(F.substring("t", 1, PREFIX_CHARS)))
             .join(_few(groups), ["n_bytes", "prefix_hash"], "left"))
    full = F.sha2(F.col("t").cast("binary"), 256)
    rows = stored(keyed.select(
        "id", "survives", (full if digest_all else F.when(F.col("survives"), full)).alias("text_sha256")),
        "dedup-digests")
    # stored, so that both sides of the join are plain shuffles and a hot text's rows can be split among tasks
    copies = stored(rows.filter("survives").groupBy("text_sha256")
                    .agg(F.min("id").alias("keep_id"), F.count("*").alias("group_size")).filter("group_size > 1"),
                    "dedup-copies")
    # rows that survived no step have no copy: they stay out of the join, whose key many of them would share as a null
    alone = rows.filter("survives is null").withColumns({"keep_id": F.col("id"), "group_size": F.lit(None).cast("long")})
    both = rows.filter("survives").join(copies, "text_sha256", "left").unionByName(alone)
    return (both
            .select("id", F.when(F.col("group_size").isNull(), F.col("id")).otherwise(F.col("keep_id")).alias("keep_id"),
                    F.coalesce("group_size", F.lit(1)).cast("long").alias("group_size"), "text_sha256")
            .withColumn("kept", F.col("keep_id").eqNullSafe(F.col("id")))
            .select(F.col("id").alias(id_col), "keep_id", "group_size", "kept", "text_sha256"))


def drop_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with one row of each group of equal texts; all columns stay.

    Rows are dropped by id. Where an id is repeated or null, rows are told
    apart by their digest as well, and whole repetitions are reduced to one;
    only those few rows are shuffled with their texts.
    """
    groups = stored(exact_groups(docs, id_col, text_col), "dedup-decisions").withColumnRenamed(id_col, "id")
    dropped = groups.filter("not kept")
    repeated = stored(groups.filter("id is not null").groupBy("id").agg(F.count("*").alias("n"))
                      .filter("n > 1").select("id"), "dedup-repeated")
    out = without_ids(docs.filter(F.col(id_col).isNotNull()),
                      dropped.filter("id is not null").select("id").unionByName(repeated), id_col)
    digest = F.sha2(one_space(F.col(text_col)).cast("binary"), 256)
    key = unused(docs, "__key")
    if not repeated.isEmpty():
        gone = dropped.select(F.col("id").alias("gone_id"), F.col("text_sha256").alias("gone_key")).distinct()
        rows = (docs.join(repeated, docs[id_col] == repeated["id"], "left_semi")
                .withColumn(key, digest).dropDuplicates([id_col, key]))
        out = out.unionByName(rows.join(gone, (rows[id_col] == gone["gone_id"]) & (rows[key] == gone["gone_key"]),
                                        "left_anti").drop(key))
    if not groups.filter("id is null").isEmpty():
        named = groups.filter("id is not null and text_sha256 is not null").select(
            F.col("text_sha256").alias("named_key")).distinct()
        rows = docs.filter(F.col(id_col).isNull()).withColumn(key, digest).dropDuplicates([key])
        out = out.unionByName(rows.join(named, rows[key] == named["named_key"], "left_anti").drop(key))
    return out
