"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ampere.session import cut_lineage

#: The white space of every contract here: space, tab, LF, VT, FF, CR.
BLANKS = "[\\x20\\x09-\\x0D]+"

#: Id lists up to this many rows (8 MB of longs) may be broadcast; longer
#: ones are joined by a shuffle.
BROADCAST_IDS = 1_000_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Read one table of a data folder through Spark (any file system)."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, name: str) -> DataFrame:
    """Cut the lineage: write to the shared checkpoint folder and read back."""
    return cut_lineage(df, f"llm-{name}")


def held_out(id_col: str = "doc_id") -> Column:
    """The fold rule: crc32 of the id as text, modulo 5, is 0 (null: false)."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 5 == 0, F.lit(False))


def words_of(text: Column) -> Column:
    """The words of a text (null: none), by the contracts' white space."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), BLANKS), "")


def one_space(text: Column) -> Column:
    """Every run of white space as one space; null as the empty text.

    Plain byte replacement turns single white-space characters into spaces
    and the regex runs only where two spaces meet, which is several times
    cheaper than one regex over every blank.
    """
    t = F.coalesce(text, F.lit(""))
    for c in ("\n", "\t", "\r", "\x0b", "\x0c"):
        t = F.replace(t, F.lit(c), F.lit(" "))
    return F.regexp_replace(t, " {2,}", " ")


def small_batches(spark: SparkSession, rows: int = 1000) -> None:
    """Bound the rows of an Arrow batch, so that whole long texts fit a worker."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))


def unused(df: DataFrame, name: str) -> str:
    """``name``, lengthened until no column of ``df`` is called so (names don't tell cases apart)."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def without_ids(df: DataFrame, drop: DataFrame, id_col: str) -> DataFrame:
    """``df`` without the rows whose id is in ``drop`` (one stored column).

    The list is broadcast only if it was counted to at most
    :data:`BROADCAST_IDS` rows; otherwise both sides are shuffled. Rows with
    a null id stay.
    """
    ids = drop.select(F.col(drop.columns[0]).alias("__drop_id"))
    if ids.limit(BROADCAST_IDS + 1).count() <= BROADCAST_IDS:
        ids = F.broadcast(ids)
    return df.join(ids, df[id_col] == ids["__drop_id"], "left_anti")


def components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """Connected components of ``edges(u, v)``: (node, root), root the least node.

    Alternating large-star and small-star steps; each round is two joins on
    hashed node ids and is written to the checkpoint folder, so no lineage
    grows and no list of links reaches the driver. The least neighbours are
    stored too: both sides of a join are then plain shuffles, and adaptive
    execution can split the rows of a node with very many links. Raises if
    ``max_rounds`` don't suffice.
    """
    cur = stored(edges.filter("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
                 .distinct(), "edges")
    state = None
    for _ in range(max_rounds):
        both = cur.union(cur.select("v", "u"))
        low = stored(both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")), "least")
        large = both.join(low, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        large = stored(large, "large-star")
        low = stored(large.groupBy("u").agg(F.min("v").alias("m")), "least")
        small = large.join(low, "u").select(F.explode(F.array(
            F.struct(F.col("u").alias("u"), F.col("m").alias("v")),
            F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("e")).select("e.*").filter("u <> v")
        cur = stored(small.distinct(), "edges")
        seen = cur.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if seen == state:
            return cur.select(F.col("u").alias("node"), F.col("v").alias("root"))
        state = seen
    raise RuntimeError(f"components did not settle in {max_rounds} rounds")
