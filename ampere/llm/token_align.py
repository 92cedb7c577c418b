"""Alignment of two tokenizers' tokens, with corpus-wide link counts.

Every text is encoded by a byte-level vocabulary (A) and a piece model (B).
Byte offsets where tokens of both end cut the tokens into groups; the A and
the B token that end there are linked. The first pass counts the links of
every task; their distinct (A id, B id) pairs get a minimal perfect hash
(:mod:`ampere.llm.perfect_hash`, one per bucket of pairs). Dense count
vectors indexed by that hash are summed up a tree, ``FAN_IN`` tasks to one.
The second pass aligns the stored tokens again, looks every link up (the key
in its slot must be the pair) and adds up a document's figures.

Texts are encoded once: the ids are stored, two bytes each where the
vocabularies allow. Tree steps hold one bucket of pairs at a time. The
table of pairs is sent to all tasks if it has at most
:data:`BROADCAST_PAIRS`; larger ones are joined to the documents' links by a
shuffle, with the same result.

Defined cases: null and empty texts, and texts that one of the tokenizers
doesn't give back byte by byte, have no tokens, zero figures and an empty
digest; rows with equal or null ids are counted each; empty tables give
empty results; other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ampere.llm.common import stored
from ampere.llm.packing import encoder
from ampere.llm.perfect_hash import PerfectHash, bucket_of, build

#: Buckets that pairs are dealt to, and lists or vectors that one tree step adds up.
BUCKETS, FAN_IN = 256, 32
#: Bytes of stored ids aligned at a time (a longer document alone).
SLICE_BYTES = 1 << 20
#: Distinct pairs that a task holds before it hands its counts on.
HELD_PAIRS = 4_000_000
#: Pairs whose table (17 bytes each: key, count, hash) may be sent to all tasks.
BROADCAST_PAIRS = 2_000_000

FIGURES = ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum")


@lru_cache(maxsize=2)
def piece_model(path: str):
    """(model, the bytes of each of its pieces)."""
    import sentencepiece

    m = sentencepiece.SentencePieceProcessor(model_file=path)
    pieces = ((i, m.id_to_piece(i)) for i in range(m.get_piece_size()))
    return m, [bytes([int(p[3:5], 16)]) if m.is_byte(i) else p.replace("▁", " ").encode() for i, p in pieces]


@lru_cache(maxsize=2)
def lengths(byte_path: str, piece_path: str) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of every token of A and of B."""
    enc, (_, pieces) = encoder(byte_path), piece_model(piece_path)
    a = np.array([len(enc.decode_single_token_bytes(i)) for i in range(enc.n_vocab)], np.int64)
    b = np.array([len(p) for p in pieces], np.int64)
    if not b.all():
        raise ValueError(f"{piece_path} has empty pieces")
    return a, b


def id_type(byte_path: str, piece_path: str) -> np.dtype:
    """The stored type of ids: two bytes if both vocabularies fit."""
    return np.dtype("<u2" if max(map(len, lengths(byte_path, piece_path))) <= 1 << 16 else "<u4")


def tokens_of(docs: DataFrame, byte_path: str, piece_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(row, id, a, b): both encodings of every text as packed ids, null where the text has no tokens."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, (model, pieces), kind = encoder(byte_path), piece_model(piece_path), id_type(byte_path, piece_path)
        for batch in batches:
            a, b = [], []
            for t in batch.column("text").to_pylist():
                ids_a = ids_b = None
                if t:
                    raw = f" {t}".encode()
                    ids_a, ids_b = enc.encode_ordinary(f" {t}"), model.encode(t, num_threads=1)
                    if enc.decode_bytes(ids_a) != raw or b"".join(map(pieces.__getitem__, ids_b)) != raw:
                        ids_a = ids_b = None
                a.append(None if ids_a is None else np.array(ids_a, kind).tobytes())
                b.append(None if ids_b is None else np.array(ids_b, kind).tobytes())
            yield pa.RecordBatch.from_arrays([batch.column("row"), batch.column("id"), pa.array(a, pa.binary()),
                                              pa.array(b, pa.binary())], ["row", "id", "a", "b"])

    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(run, f"row long, id {docs.schema[id_col].dataType.simpleString()}, a binary, b binary")


def slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The rows of ``batches`` in pieces of bounded bytes of ids."""
    for batch in batches:
        size = pc.fill_null(pc.binary_length(batch.column("a")), 0).to_numpy(zero_copy_only=False).astype(np.int64)
        piece = np.cumsum(size) // SLICE_BYTES
        cuts = [0, *(np.nonzero(np.diff(piece))[0] + 1).tolist(), len(piece)] if len(piece) else [0, 0]
        for lo, hi in zip(cuts, cuts[1:]):
            yield batch.slice(lo, hi - lo)


class Aligned:
    """The tokens of a batch of documents, cut into groups.

    Both encodings of a document have the same bytes, so end offsets run on
    through the batch, and a group never goes over a document's end.
    """

    def __init__(self, batch: pa.RecordBatch, byte_path: str, piece_path: str):
        len_a, len_b = lengths(byte_path, piece_path)
        kind = id_type(byte_path, piece_path)
        a, b = ([x or b"" for x in batch.column(c).to_pylist()] for c in ("a", "b"))
        self.n_a = np.array([len(x) for x in a], np.int64) // kind.itemsize
        self.n_b = np.array([len(x) for x in b], np.int64) // kind.itemsize
        self.a = np.frombuffer(b"".join(a), kind).astype(np.int64)
        self.b = np.frombuffer(b"".join(b), kind).astype(np.int64)
        end_a, end_b = np.cumsum(len_a[self.a]), np.cumsum(len_b[self.b])
        ends = np.zeros((2, int(end_a[-1]) + 1 if len(end_a) else 1), bool)
        ends[0, end_a] = True
        ends[1, end_b] = True
        #: whether a token is the last of its group
        self.cut_a, self.cut_b = ends[1, end_a], ends[0, end_b]
        self.doc_of_link = np.repeat(np.arange(len(a)), self.n_a)[self.cut_a]
        self.n_links = np.bincount(self.doc_of_link, minlength=len(a))
        #: one number for every link: A id and B id
        self.pairs = self.a[self.cut_a] * len(len_b) + self.b[self.cut_b]

    def digests(self) -> list[str]:
        """The SHA-256 of every document's groups as ``a1,a2|b1;a3|b2,b3``."""
        group_a, group_b = (np.cumsum(c) - c for c in (self.cut_a, self.cut_b))
        n = len(self.pairs)
        in_a, in_b = np.bincount(group_a, minlength=n), np.bincount(group_b, minlength=n)
        order = np.empty(len(self.a) + len(self.b), np.int64)
        order[np.arange(len(self.a)) + (np.cumsum(in_b) - in_b)[group_a]] = 3 * self.a + self.cut_a
        order[np.arange(len(self.b)) + np.cumsum(in_a)[group_b]] = 3 * self.b + 2 * self.cut_b
        texts, out, at = numerals(int(order.max(initial=0)) // 3 + 1), [], 0
        for k in (self.n_a + self.n_b).tolist():
            s = "".join(map(texts.__getitem__, order[at:at + k].tolist()))
            out.append(hashlib.sha256(s[:-1].encode()).hexdigest() if k else "")
            at += k
        return out


_NUMERALS: list[str] = []


def numerals(n: int) -> list[str]:
    """At 3 i, 3 i + 1, 3 i + 2: the number i followed by a comma, a bar, a semicolon (up to ``n`` at least)."""
    for i in range(len(_NUMERALS) // 3, n):
        _NUMERALS.extend((f"{i},", f"{i}|", f"{i};"))
    return _NUMERALS


def summed(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys and the sums of their counts."""
    keys, at = np.unique(keys, return_inverse=True)
    out = np.zeros(len(keys), np.int64)
    np.add.at(out, at, counts)
    return keys, out


def task_counts(tokens: DataFrame, byte_path: str, piece_path: str) -> DataFrame:
    """(part, bucket, pairs, counts): the pairs linked in a task and how often."""

    def flush(part: int, keys: np.ndarray, counts: np.ndarray) -> pa.RecordBatch:
        bucket = bucket_of(keys, BUCKETS)
        order = np.argsort(bucket, kind="stable")
        which, first = np.unique(bucket[order], return_index=True)
        keys, counts = (np.split(x[order], first[1:]) if len(first) else [] for x in (keys, counts))
        return pa.RecordBatch.from_arrays(
            [pa.array([part] * len(which), pa.int32()), pa.array(which, pa.int32()),
             pa.array([k.tobytes() for k in keys], pa.binary()), pa.array([c.tobytes() for c in counts], pa.binary())],
            ["part", "bucket", "pairs", "counts"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        held = (np.zeros(0, np.int64), np.zeros(0, np.int64))
        for batch in slices(batches):
            new = np.unique(Aligned(batch, byte_path, piece_path).pairs, return_counts=True)
            held = summed(*(np.concatenate(x) for x in zip(held, new)))
            if len(held[0]) > HELD_PAIRS:
                yield flush(part, *held)
                held = (np.zeros(0, np.int64), np.zeros(0, np.int64))
        yield flush(part, *held)

    return tokens.select("a", "b").mapInArrow(run, "part int, bucket int, pairs binary, counts binary")


def numbers(blobs) -> np.ndarray:
    """Packed 64-bit numbers of several blobs in a row."""
    return np.frombuffer(b"".join(blobs), np.int64)


def up_the_tree(rows: DataFrame, parts: int, step: Callable[[list[bytes]], bytes]) -> DataFrame:
    """(bucket, blob): ``step`` over the blobs of ``rows(bucket, part, blob)``, FAN_IN parts to one, to one part."""

    def run(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"bucket": [key[0]], "part": [key[1]], "blob": [step(pdf["blob"].tolist())]})

    while True:
        parts = -(-parts // FAN_IN)
        rows = rows.withColumn("part", F.floor(F.col("part") / FAN_IN).cast("int"))
        rows = rows.groupBy("bucket", "part").applyInPandas(run, "bucket int, part int, blob binary")
        if parts <= 1:
            return rows.select("bucket", "blob")


def hashed_pairs(local: DataFrame, parts: int) -> DataFrame:
    """(bucket, n, sizes, words, keys): the perfect hash of every bucket's pairs, and the pairs by slot."""

    def hashes(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            out = []
            for bucket, blob in zip(pdf["bucket"], pdf["blob"]):
                keys = numbers([blob])
                sizes, words = build(keys)
                by_slot = np.empty(len(keys), np.int64)
                by_slot[PerfectHash([(sizes, words)]).slots(keys)] = keys
                out.append((bucket, len(keys), sizes, words.tobytes(), by_slot.tobytes()))
            yield pd.DataFrame(out, columns=["bucket", "n", "sizes", "words", "keys"])

    pairs = up_the_tree(local.select("bucket", "part", F.col("pairs").alias("blob")), parts,
                        lambda blobs: np.unique(numbers(blobs)).tobytes())
    return pairs.mapInPandas(hashes, "bucket int, n long, sizes array<int>, words binary, keys binary")


def verified(table: PerfectHash, keys: np.ndarray, pairs: np.ndarray) -> np.ndarray:
    """The slots of ``pairs``, whose keys must be there."""
    at = table.slots(pairs)
    if len(at) and (at.min() < 0 or (keys[at] != pairs).any()):
        raise ValueError("a link is not among the counted pairs")
    return at


def dense_counts(local: DataFrame, hashes: DataFrame, parts: int) -> DataFrame:
    """(bucket, blob): how often each pair of the bucket is linked, by slot."""

    def vector(key: tuple, counted: pd.DataFrame, hashed: pd.DataFrame) -> pd.DataFrame:
        if counted.empty:
            return pd.DataFrame({"bucket": [], "part": [], "blob": []})
        h = hashed.iloc[0]
        keys, out = numbers([h["keys"]]), np.zeros(h["n"], np.int64)
        table = PerfectHash([(h["sizes"], np.frombuffer(h["words"], "<u8"))])
        for pairs, counts in zip(counted["pairs"], counted["counts"]):
            out[verified(table, keys, numbers([pairs]))] += numbers([counts])
        return pd.DataFrame({"bucket": [key[0]], "part": [key[1]], "blob": [out.tobytes()]})

    groups = -(-parts // FAN_IN)
    one = local.withColumn("part", F.floor(F.col("part") / FAN_IN).cast("int"))
    each = hashes.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(groups - 1))))
    vectors = one.groupBy("bucket", "part").cogroup(each.groupBy("bucket", "part")).applyInPandas(
        vector, "bucket int, part int, blob binary")
    if groups <= 1:
        return vectors.select("bucket", "blob")
    return up_the_tree(vectors, groups, lambda blobs: np.sum([numbers([b]) for b in blobs], axis=0).tobytes())


def pair_counts(tokens: DataFrame, byte_path: str, piece_path: str) -> DataFrame:
    """(bucket, n, sizes, words, keys, counts): the corpus-wide pairs with hash and counts, one row per bucket, stored."""
    local = stored(task_counts(tokens, byte_path, piece_path), "align-local")
    parts = (local.agg(F.max("part")).first()[0] or 0) + 1
    hashes = stored(hashed_pairs(local, parts), "align-hashes")
    counts = dense_counts(local, hashes, parts).select(F.col("bucket").alias("at"), F.col("blob").alias("counts"))
    return stored(hashes.join(counts, F.col("bucket") == F.col("at")).drop("at"), "align-pairs")


def top_counts(pairs: DataFrame, n_b: int) -> DataFrame:
    """(b, top): the highest count of every B id, at most as many rows as B has ids."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        top = np.zeros(n_b, np.int64)
        for pdf in batches:
            for keys, counts in zip(pdf["keys"], pdf["counts"]):
                np.maximum.at(top, numbers([keys]) % n_b, numbers([counts]))
        b = np.nonzero(top)[0]
        yield pd.DataFrame({"b": b, "top": top[b]})

    return pairs.select("keys", "counts").mapInPandas(run, "b long, top long").groupBy("b").agg(F.max("top").alias("top"))


def _figures(batch: pa.RecordBatch, x: Aligned, best: np.ndarray | None, counts: np.ndarray | None) -> list[pa.Array]:
    """row, id, the figures of every document (null where they aren't known yet) and its digest."""
    n = len(x.n_a)
    add = lambda v: None if v is None else np.rint(np.bincount(x.doc_of_link, v, n)).astype(np.int64)
    cols = [x.n_a, x.n_b, x.n_links, x.n_links, add(best), None]
    if counts is not None:  # exact beyond the 53 bits of a float
        cols[5] = np.zeros(n, np.int64)
        np.add.at(cols[5], x.doc_of_link, counts)
    return [batch.column("row"), batch.column("id"), *(pa.nulls(n, pa.int64()) if c is None else pa.array(c, pa.int64())
                                                       for c in cols), pa.array(x.digests(), pa.string())]


def align_documents(docs: DataFrame, byte_path: str, piece_path: str, id_col: str = "doc_id", text_col: str = "text",
                    broadcast_pairs: int = BROADCAST_PAIRS) -> DataFrame:
    """id, the figures of :data:`FIGURES` and groups_sha256 of every document."""
    spark = docs.sparkSession
    tokens = stored(tokens_of(docs, byte_path, piece_path, id_col, text_col), "align-tokens")
    pairs = pair_counts(tokens, byte_path, piece_path)
    n_b = len(lengths(byte_path, piece_path)[1])
    top = top_counts(pairs, n_b)
    kind = docs.schema[id_col].dataType.simpleString()
    names = ["row", "id", *FIGURES, "groups_sha256"]
    schema = f"row long, id {kind}, " + ", ".join(f"{f} long" for f in FIGURES) + ", groups_sha256 string"

    if (pairs.agg(F.sum("n")).first()[0] or 0) <= broadcast_pairs:
        rows = {r.bucket: r for r in pairs.collect()}
        table = PerfectHash([(rows[k].sizes, np.frombuffer(rows[k].words, "<u8")) if k in rows else ([], np.zeros(0, "<u8"))
                             for k in range(BUCKETS)])
        best_of = np.zeros(n_b, np.int64)
        for r in top.collect():
            best_of[r.b] = r.top
        keys, counts = (numbers(rows[k][c] for k in sorted(rows)) for c in ("keys", "counts"))
        sent = spark.sparkContext.broadcast((table, keys, counts, best_of))

        def look_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            table, keys, counts, best_of = sent.value
            for batch in slices(batches):
                x = Aligned(batch, byte_path, piece_path)
                c = counts[verified(table, keys, x.pairs)]
                yield pa.RecordBatch.from_arrays(_figures(batch, x, c == best_of[x.pairs % n_b], c), names)

        out = tokens.mapInArrow(look_up, schema)
    else:
        out = _joined(tokens, pairs, top, byte_path, piece_path, n_b, schema, names)
    return out.select(F.col("id").alias(id_col), *FIGURES, "groups_sha256")


def _joined(tokens: DataFrame, pairs: DataFrame, top: DataFrame, byte_path: str, piece_path: str, n_b: int,
            schema: str, names: list[str]) -> DataFrame:
    """The second pass for more pairs than may be sent: the documents' distinct pairs are joined to the counts."""

    def again(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            x = Aligned(batch, byte_path, piece_path)
            split = np.split(x.pairs, np.cumsum(x.n_links)[:-1]) if len(x.n_links) else []
            links = [[{"pair": p, "n": n} for p, n in zip(*(v.tolist() for v in np.unique(s, return_counts=True)))]
                     for s in split]
            kind = pa.list_(pa.struct([("pair", pa.int64()), ("n", pa.int64())]))
            yield pa.RecordBatch.from_arrays([*_figures(batch, x, None, None), pa.array(links, kind)], [*names, "links"])

    def pair_rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for keys, counts in zip(pdf["keys"], pdf["counts"]):
                yield pd.DataFrame({"pair": numbers([keys]), "count": numbers([counts])})

    seen = stored(tokens.mapInArrow(again, f"{schema}, links array<struct<pair: long, n: long>>"), "align-links")
    known = pairs.select("keys", "counts").mapInPandas(pair_rows, "pair long, count long")
    known = known.withColumn("b", F.col("pair") % n_b).join(F.broadcast(top), "b")
    hits = (seen.select("row", F.inline("links")).join(stored(known, "align-known"), "pair").groupBy("row")
            .agg(F.sum(F.when(F.col("count") == F.col("top"), F.col("n")).otherwise(0)).alias("best"),
                 F.sum(F.col("count") * F.col("n")).alias("total")))
    return (seen.drop("links", "n_best", "count_sum").join(hits, "row", "left")
            .withColumns({"n_best": F.coalesce("best", F.lit(0)).cast("long"),
                          "count_sum": F.coalesce("total", F.lit(0)).cast("long")}))
