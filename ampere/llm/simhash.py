"""SimHash near-dedup by segment-popcount embedding and a grid join.

A 64-bit fingerprint is cut into segments; the counts of set bits of the
segments are a point on an integer grid. The Manhattan distance of two points
is at most the Hamming distance of their fingerprints, so fingerprints within
``max_bits`` lie in cells at most that far apart. Two cells at distance 2 or
less share a cell one step from both (or are the same, or one step apart):
each fingerprint goes to its own cell and to those one step away, pairs that
meet in a cell are candidates, and the exact bit distance decides. Larger
bounds take ``ceil(max_bits / 2)`` steps.

Only distinct fingerprints are joined, each standing for its documents, so
copies make no pairs. Links are turned into components with Spark joins.

Defined cases: null texts have no words; a text without words has the
fingerprint zero, linked like any other; one or two words are one shingle;
repeated rows of one id link like copies; empty tables give empty results.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ampere.llm.common import components, stored, unused, without_ids

#: Numbers of segments to choose from. Longer segments give a fingerprint fewer cells; shorter ones make a finer grid,
#: in which fewer fingerprints meet that are not close.
SEGMENTS = (8, 16, 32, 64)
SEED = 42
#: Shingles hashed and counted at a time (bounds the bit table of one text).
SLICE = 1 << 16

_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))


def fingerprint(text: str | None, n_words: int = 3) -> int:
    """The SimHash of a text: a bit is set if over half of its shingles set it."""
    import xxhash

    if not text:
        return 0
    words = text.encode("utf-8", "replace").translate(_LOWER).split()
    if not words:
        return 0
    norm, n = b" ".join(words), max(1, len(words) - n_words + 1)
    ends = np.cumsum(np.fromiter(map(len, words), dtype=np.int64, count=len(words)) + 1)
    first = [0, *ends[:n - 1].tolist()]
    last = (ends[min(n_words, len(words)) - 1:] - 1).tolist()
    h, ones = xxhash.xxh64_intdigest, np.zeros(64, dtype=np.int64)
    for at in range(0, n, SLICE):
        hashes = np.array([h(norm[a:b], SEED) for a, b in zip(first[at:at + SLICE], last[at:at + SLICE])], dtype="<u8")
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int32)
    return int(np.packbits(2 * ones > n, bitorder="little").view("<u8")[0])


def simhash(text: Column, n_words: int = 3) -> Column:
    """Fingerprints of a text column as (signed) longs."""

    @F.pandas_udf("long")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series(np.array([fingerprint(t, n_words) for t in texts], dtype=np.uint64).view(np.int64))

    return run(text)


def segments_for(n: int, max_bits: int = 2) -> int:
    """The number of segments with the fewest rows to expect: cells of ``n`` fingerprints, and pairs that meet in them.

    For random fingerprints a segment of w bits has 2 - 2^(1-w) neighbours on
    average, and two segments are equal with probability C(2w, w) / 4^w. Which
    number is taken changes the work, never the pairs found.
    """
    def rows(segments: int) -> float:
        width, steps = 64 // segments, -(-max_bits // 2)
        cells = (1 + segments * (2 - 2.0 ** (1 - width))) ** steps
        return n * cells + n * n / 2 * cells ** 2 * (math.comb(2 * width, width) / 4.0 ** width) ** segments

    return min(SEGMENTS, key=rows)


def cell(fp: Column, segments: int) -> Column:
    """The grid cell: the segments' bit counts, a few bits each, in one long."""
    width, bits = 64 // segments, _field(segments)
    if 64 % segments or segments * bits > 64:
        raise ValueError("segments have to part 64 bits evenly, and their counts to fit one long")
    mask = (1 << width) - 1
    out = F.lit(0).cast("long")
    for i in range(segments):
        count = F.bit_count(F.shiftrightunsigned(fp, i * width).bitwiseAND(F.lit(mask).cast("long"))).cast("long")
        out = out.bitwiseOR(F.shiftleft(count, i * bits))
    return out


def _field(segments: int) -> int:
    return (64 // segments).bit_length()


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def nearby_cells(c: Column, segments: int) -> Column:
    """The cell and those one step away, as an array."""
    width, bits = 64 // segments, _field(segments)
    steps = [c]
    for i in range(segments):
        field = ((1 << bits) - 1) << (i * bits)
        at = F.shiftrightunsigned(c, i * bits).bitwiseAND(F.lit((1 << bits) - 1).cast("long"))
        # the other fields as they are; bit by bit, because the highest field ends in the sign
        rest = c.bitwiseAND(F.lit(_signed(~field & (1 << 64) - 1)).cast("long"))
        steps += [F.when(at < width, rest.bitwiseOR(F.shiftleft(at + 1, i * bits))),
                  F.when(at > 0, rest.bitwiseOR(F.shiftleft(at - 1, i * bits)))]
    return F.array_compact(F.array(*steps))


def near_pairs(fps: DataFrame, max_bits: int = 2, segments: int | None = None) -> DataFrame:
    """Pairs (a, b), a < b, of distinct ``fps(fp)`` at most ``max_bits`` apart (``segments``: by their number)."""
    segments = segments or segments_for(fps.count(), max_bits)
    grid = fps.select("fp", F.array(cell(F.col("fp"), segments)).alias("cells"))
    for _ in range(-(-max_bits // 2)):
        grid = grid.select("fp", F.explode("cells").alias("c")).distinct().select(
            "fp", nearby_cells(F.col("c"), segments).alias("cells"))
    grid = grid.select("fp", F.explode("cells").alias("cell"))
    if max_bits > 2:
        grid = grid.distinct()
    # by a shuffle: Spark sizes an exploded table like the rows before it, and would broadcast one of many more rows
    a, b = grid.withColumnRenamed("fp", "a"), grid.withColumnRenamed("fp", "b").hint("merge")
    return (a.join(b, "cell").filter((F.col("a") < F.col("b"))
                                     & (F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= max_bits))
            .select("a", "b").distinct())


def near_dup_components(docs: DataFrame, n_words: int = 3, max_bits: int = 2, id_col: str = "doc_id",
                        text_col: str = "text") -> DataFrame:
    """id, fingerprint (16 lowercase hex digits) and component_id.

    ``component_id`` is the smallest id reachable over links. Rows with a null
    id carry the component of their fingerprint and name none.
    """
    return _labelled(docs, n_words, max_bits, id_col, text_col).select(
        F.col("id").alias(id_col), F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def _labelled(docs: DataFrame, n_words: int, max_bits: int, id_col: str, text_col: str) -> DataFrame:
    """(id, fp, root, component_id): repeated ids may give components of different root the same component_id."""
    rows = stored(docs.select(F.col(id_col).alias("id"), simhash(F.col(text_col), n_words).alias("fp")), "simhash")
    fps = stored(rows.groupBy("fp").agg(F.min("id").alias("id"), F.count("*").alias("n")), "simhash-distinct")
    pairs = stored(near_pairs(fps.select("fp"), max_bits), "simhash-pairs")
    # components over fingerprints, then the smallest id of each
    roots = components(pairs.select(F.col("a").alias("u"), F.col("b").alias("v"))) if not pairs.isEmpty() else None
    label = fps.select("fp", "id").withColumn("root", F.col("fp"))
    if roots is not None:
        label = fps.select("fp", "id").join(roots.withColumnRenamed("node", "fp"), "fp", "left").withColumn(
            "root", F.coalesce("root", "fp"))
    least = label.groupBy("root").agg(F.min("id").alias("component_id"))
    label = label.join(least, "root").select("fp", "root", "component_id")
    return rows.join(label, "fp")


def drop_near_copies(docs: DataFrame, n_words: int = 3, max_bits: int = 2, id_col: str = "doc_id",
                     text_col: str = "text") -> DataFrame:
    """``docs`` with the row of the smallest id of each component; all columns stay.

    Rows with a null id stay. Rows are dropped by id; where an id is
    repeated, its rows are told apart by their fingerprint as well, and one
    of those in a component stays. Only those few rows are shuffled with
    their texts.
    """
    found = stored(_labelled(docs, n_words, max_bits, id_col, text_col).select("id", "fp", "root", "component_id"),
                   "simhash-decisions").filter("id is not null")
    repeated = stored(found.groupBy("id").agg(F.count("*").alias("n")).filter("n > 1").select("id"), "simhash-repeated")
    drop = stored(found.filter("id <> component_id").select("id").unionByName(repeated).distinct(), "simhash-drop")
    out = without_ids(docs, drop, id_col)
    if not repeated.isEmpty():
        keep = (found.filter("id = component_id").join(repeated, "id", "left_semi")
                .groupBy("id", "root").agg(F.min("fp").alias("fp"))
                .select(F.col("id").alias("keep_id"), F.col("fp").alias("keep_fp")))
        fp = unused(docs, "__fp")
        rows = (docs.join(repeated, docs[id_col] == repeated["id"], "left_semi")
                .withColumn(fp, simhash(F.col(text_col), n_words)).dropDuplicates([id_col, fp]))
        out = out.unionByName(rows.join(keep, (rows[id_col] == keep["keep_id"]) & (rows[fp] == keep["keep_fp"]),
                                        "left_semi").drop(fp))
    return out
