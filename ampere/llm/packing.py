"""Best-fit packing by hierarchical residual merging.

Pieces are dealt to groups of bounded size; each group packs its own by
best fit, largest first, and emits the bins that are nearly full. The
underfull bins become items of the next, smaller round, ``FAN_IN`` groups to
one, up a tree to a single group. After a best-fit round a group has at most
one bin that is half full or less, so a round hands on few bins that still
need a place, beside the emptiest bins that can give one; the fuller rest
gains nothing from further rounds and is emitted. Rounds carry numbers only;
texts are read once, to be tokenised.

Why handing on the :data:`HANDED_ON` emptiest bins of a group loses no merge:
two bins merge only if one of them is half full or less. Best fit leaves at
most one such bin in a group, so at most ``FAN_IN`` bins are placed as items
in a group of the next round, and ``FAN_IN`` times the number of rounds over
the whole tree can take a place in a group's bins. Whatever fits some bin
fits the emptiest ones, which are there.

Defined cases: null and empty texts have the closing id alone; longer
documents are cut so that the first piece may be shorter and the others are
full; repeated rows are packed each; empty tables give empty results.
"""

from __future__ import annotations

import json
import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ampere.llm.common import stored

#: Items that one group packs, groups that meet in one of the next round.
ITEMS_PER_GROUP = 40_000
FAN_IN = 8
#: A bin with at most this share of its room left is emitted at once.
NEARLY_FULL = 1 / 128
#: Bins handed on by a group (the emptiest; the rest are emitted): far more than can take another one.
HANDED_ON = 4_000


def best_fit(sizes: list[int], capacity: int) -> tuple[list[int], list[int]]:
    """Best fit, largest first: the bin of each item, and the bins' fills.

    Open bins are kept by their room: one sorted list of the rooms in use,
    one stack of bins for each room.
    """
    bin_of, fills = [0] * len(sizes), []
    rooms: list[int] = []
    at_room: dict[int, list[int]] = {}
    for i in sorted(range(len(sizes)), key=lambda j: -sizes[j]):
        s = sizes[i]
        k = bisect_left(rooms, s)
        if k < len(rooms):
            room = rooms[k]
            b = at_room[room].pop()
            if not at_room[room]:
                del rooms[k]
        else:
            room, b = capacity, len(fills)
            fills.append(0)
        fills[b] += s
        bin_of[i] = b
        left = room - s
        if left:
            stack = at_room.setdefault(left, [])
            if not stack:
                insort(rooms, left)
            stack.append(b)
    return bin_of, fills


def _round(capacity: int, last: bool):
    """Pack one group; ``bin`` is unique in the group, ``open`` bins go on."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["size", "item"], ascending=[False, True])
        bin_of, fills = best_fit(pdf["size"].tolist(), capacity)
        fill = np.array(fills)
        go_on = np.zeros(len(fills), dtype=bool)
        if not last:
            under = np.nonzero(capacity - fill > capacity * NEARLY_FULL)[0]
            go_on[under[np.argsort(fill[under], kind="stable")[:HANDED_ON]]] = True
        at = np.array(bin_of)
        return pd.DataFrame({"item": pdf["item"].array, "grp": pdf["grp"].array, "bin": at,
                             "fill": fill[at], "open": go_on[at]})

    return run


def pack_items(items: DataFrame, capacity: int) -> DataFrame:
    """``items(item long, size int)``, 0 < size <= capacity, to (item, sequence_id).

    A sequence id is round, group and bin in one number.
    """
    items = stored(items.select("item", F.col("size").cast("int").alias("size")), "pack-items")
    n = max(1, -(-items.count() // ITEMS_PER_GROUP))
    cur = items.withColumn("grp", F.pmod(F.xxhash64("item"), F.lit(n)))
    # final bin of every current item, as far as settled: (item, bin id)
    links = []
    level = 0
    while True:
        packed = stored(cur.groupBy("grp").applyInPandas(
            _round(capacity, n == 1), "item long, grp long, bin int, fill int, open boolean"), "pack-round")
        bins = packed.withColumn("seq", (F.lit(level) * (1 << 56)) + F.col("grp") * (1 << 24) + F.col("bin"))
        links.append(bins.select("item", "seq", "open"))
        if n == 1:
            break
        n = -(-n // FAN_IN)
        cur = (bins.filter("open").groupBy("seq").agg(F.max("fill").alias("size"), F.max("grp").alias("g"))
               .select(F.col("seq").alias("item"), "size", F.floor(F.col("g") / FAN_IN).alias("grp")))
        level += 1
    out = links[-1].select("item", "seq")
    for below in reversed(links[:-1]):
        upper = out.select(F.col("item").alias("seq"), F.col("seq").alias("upper"))
        out = (below.filter("open").join(upper, "seq").select("item", F.col("upper").alias("seq"))
               .unionByName(below.filter("not open").select("item", "seq")))
    return out.select("item", F.col("seq").alias("sequence_id"))


#: Fixed value: how byte-level vocabularies split a text before merging.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: Texts on which both libraries must agree before a worker starts.
PROBES = ("It's 3 o'clock,  we'll see!\n\n\tEnd ", "\u00e9\u00df\u4e2d\U0001f600 a\u00a0b\u3000c", "<|endoftext|>", "x" * 300, " \r\n ")


@lru_cache(maxsize=2)
def encoder(path: str):
    """A whole-text encoder with the ids of the tokenizers file at ``path``, its added tokens as special tokens.

    The file's vocabulary is handed to a byte-pair encoder that takes whole
    texts several times faster than ``tokenizers``, which stays the measure:
    a worker that finds the two apart on :data:`PROBES` fails.
    """
    import tiktoken
    from tokenizers import Tokenizer

    with open(path, encoding="utf-8") as f:
        file = json.load(f)
    special = {t["content"]: t["id"] for t in file["added_tokens"]}
    if any(t.get(k) for t in file["added_tokens"] for k in ("lstrip", "rstrip", "single_word")):
        raise ValueError(f"{path} has added tokens that depend on the text around them")
    # byte-level alphabet: printable bytes stand for themselves, the others follow from 256 on
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    byte_of = {chr(b): b for b in own} | {chr(256 + k): b for k, b in enumerate(b for b in range(256) if b not in own)}
    ranks = {bytes(byte_of[c] for c in t): i for t, i in file["model"]["vocab"].items() if t not in special}
    enc = tiktoken.Encoding("file", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens=special)
    tok, ordinary = Tokenizer.from_file(path), Tokenizer.from_file(path)
    ordinary.encode_special_tokens = True  # the strings of special tokens are ordinary text
    for t in (*PROBES, *(f"a {s} b{s}" for s in special)):
        if (enc.encode(t, allowed_special="all") != tok.encode(t, add_special_tokens=False).ids
                or enc.encode_ordinary(t) != ordinary.encode(t, add_special_tokens=False).ids):
            raise ValueError(f"{path} is no byte-level vocabulary of the expected kind")
    return enc


def encode(path: str, end_id: int, text: str | None, special: bool = False) -> bytes:
    """The ids of a whole text and the closing id, as little-endian 32-bit numbers.

    With ``special`` the strings of added tokens in the text become their
    ids, as ``tokenizers`` does by default; else they are ordinary text.
    """
    enc = encoder(path)
    ids = enc.encode(text or "", allowed_special="all") if special else enc.encode_ordinary(text or "")
    return np.array([*ids, end_id], dtype="<u4").tobytes()


def pieces_of(docs: DataFrame, tokenizer_path: str, capacity: int, end_id: int = 0, id_col: str = "doc_id",
              text_col: str = "text") -> DataFrame:
    """(id, piece, start, length, ids_crc32): token pieces of every document."""
    id_type = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, which = batch.column("text").to_pylist(), batch.column("id")
            row, piece, start, length, crc = [], [], [], [], []
            for r, b in enumerate(encode(tokenizer_path, end_id, t, special=True) for t in texts):
                n = len(b) // 4
                cuts = [0, *range(n % capacity or capacity, n + 1, capacity)]
                for p, (a, z) in enumerate(zip(cuts, cuts[1:])):
                    row.append(r)
                    piece.append(p)
                    start.append(a)
                    length.append(z - a)
                    crc.append(zlib.crc32(b[4 * a:4 * z]))
            yield pa.RecordBatch.from_arrays(
                [which.take(pa.array(row, pa.int64())), pa.array(piece, pa.int32()), pa.array(start, pa.int64()),
                 pa.array(length, pa.int64()), pa.array(crc, pa.int64())], ["id", "piece", "start", "length", "ids_crc32"])

    return docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInArrow(
        run, f"id {id_type}, piece int, start long, length long, ids_crc32 long")


def pack_documents(docs: DataFrame, tokenizer_path: str, capacity: int = 2048, end_id: int = 0,
                   id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per piece with its sequence and the place it has there."""
    pieces = stored(pieces_of(docs, tokenizer_path, capacity, end_id, id_col, text_col), "pack-pieces")
    # a stored table is read in the same splits, so row numbers of its scan could be used as keys, but only within
    # one plan; a second table with the numbers written down holds after lost executors too
    pieces = stored(pieces.withColumn("item", F.monotonically_increasing_id()), "pack-numbered")
    packed = pack_items(pieces.filter(F.col("length") < capacity).select("item", F.col("length").alias("size")), capacity)
    whole = pieces.filter(F.col("length") >= capacity).select("item", (-1 - F.col("item")).alias("sequence_id"))
    placed = pieces.join(packed.unionByName(whole), "item")
    before = Window.partitionBy("sequence_id").orderBy("item").rowsBetween(Window.unboundedPreceding, -1)
    return placed.select(F.col("id").alias(id_col), "piece", "start", "length", "ids_crc32", "sequence_id",
                         F.coalesce(F.sum("length").over(before), F.lit(0)).cast("long").alias("offset"))
