"""Suffix-array dedup of byte strings that occur again anywhere.

A byte goes if it is covered by a string of ``length`` bytes that also starts
at another place of the corpus. Places are found in four steps, all exact.

1. Every window of ``length`` bytes names an anchor: the first of the ``GRAM``
   bytes in it with the least hash. Equal windows name equal anchors at equal
   offsets, so only anchors whose bytes occur again can lie in repeated
   windows. Anchors are counted by hash (partial counts first) and the unique
   ones are left.
2. The windows that name one anchor are neighbours; the bytes they span are
   its context, and every window lies in one context only. Where a whole
   context occurs again, all of it is covered. Only the contexts of anchors
   that have different ones go on, one row for each distinct context.
3. The windows whose anchor lies at offsets ``j * STEP`` and up share the
   bytes that all of them have in common; contexts that share these with no
   other cannot hold a repeated window there and are left.
4. What remains is grouped by the shared bytes, which count as one symbol from
   here on, and each group's suffixes are sorted by linear grouping
   construction (:func:`suffix_order`); runs of suffixes that agree over a
   window are the repeated windows. Groups beyond ``GROUP_ROWS`` rows are not
   sorted in one task: their windows are counted by content, which is exact
   as well.

Spans are merged per document and the texts read once more to cut them.

Defined cases: null and short texts have no window; a row repeated as a
whole is a copy of itself, so both lose what repeats; very long texts are
hashed in slices that overlap by a window; empty tables give empty results.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ampere.llm.common import stored

LENGTH = 200
#: Bytes of an anchor; longer ones match less by chance but stand denser.
GRAM = 56
#: Offsets that one round of step 3 takes together.
STEP = 29
#: Contexts that are sorted together at most.
GROUP_ROWS = 2_000
#: Bytes hashed at a time.
SLICE = 1 << 20
#: Merged spans broadcast at most (16 bytes each).
BROADCAST_SPANS = 2_000_000

_BASE = 0x9E3779B97F4A7C15 | 1


# --- suffix sorting -------------------------------------------------------

def suffix_order(strings: list[bytes]) -> list[tuple[int, int]]:
    """All suffixes of the strings, (string, position), in ascending order.

    Suffixes are grouped by their Lyndon prefix, the longest Lyndon word that
    begins there, which ends where the next smaller suffix starts. Groups take
    their places in the order in descending order of their words. Within a
    group the order is that of the suffixes behind the prefix, which are all
    smaller: going through the order upwards, each suffix sends the suffixes
    whose prefix it ends, found along previous-smaller pointers, to the next
    free place of their groups. No suffix is renamed and nothing is sorted
    but the distinct words.
    """
    groups: dict[bytes, list[int]] = {}
    group_of: list[list] = []
    previous: list[list[int]] = []
    for s in strings:
        n = len(s)
        end, prev = [n] * n, [-1] * (n + 1)
        mine: list = [None] * n
        for i in range(n - 1, -1, -1):
            j = i + 1
            word = s[i:j]
            while j < n:
                k = end[j]
                if word >= s[j:k]:
                    break
                prev[j] = i
                j = k
                word = s[i:j]
            end[i] = j
            g = groups.get(word)
            if g is None:
                g = groups[word] = [0]
            g[0] += 1
            mine[i] = g
        group_of.append(mine)
        previous.append(prev)
    free = sum(map(len, strings))
    order: list = [None] * free
    for word in sorted(groups, reverse=True):
        g = groups[word]
        free -= g[0]
        g[0] = free  # the next free place

    def place(c: int, q: int) -> None:
        prev, mine = previous[c], group_of[c]
        i, stop = q - 1, prev[q]
        while i > stop:
            g = mine[i]
            order[g[0]] = (c, i)
            g[0] += 1
            i = prev[i]

    for c, s in enumerate(strings):  # the empty suffixes come first
        place(c, len(s))
    for c, q in order:
        place(c, q)
    return order


def repeated_windows(strings: list[bytes], copies: list[int], width: int) -> list[list[int]]:
    """For each string the starts of its windows of ``width`` that occur again.

    ``copies``: in how many places each string stands; no two of all these
    places overlap in a window.
    """
    found: list[list[int]] = [[] for _ in strings]
    run: list[tuple[int, int]] = []
    last = None

    def settle() -> None:
        if len(run) > 1 or copies[run[0][0]] > 1:
            for c, i in run:
                found[c].append(i)

    for c, i in suffix_order(strings):
        window = strings[c][i:i + width]
        if len(window) < width:
            continue
        if window != last:
            if run:
                settle()
            run, last = [], window
        run.append((c, i))
    if run:
        settle()
    return found


def merge(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Maximal runs: overlapping or touching spans become one."""
    out: list[list[int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return [tuple(x) for x in out]


# --- anchors --------------------------------------------------------------

def _tables(n: int, gram: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse, modulo 2**64."""
    def powers(base: int, count: int) -> np.ndarray:
        x = np.full(count, base, dtype=np.uint64)
        x[0] = 1
        return np.cumprod(x, dtype=np.uint64)
    return powers(_BASE, n + gram + 1), powers(pow(_BASE, -1, 1 << 64), n + 1)


def gram_hashes(b: np.ndarray, gram: int, tables: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """The hash of the ``gram`` bytes at every position that has so many."""
    powers, back = tables
    n = len(b) - gram + 1
    sums = np.empty(len(b) + 1, dtype=np.uint64)
    sums[0] = 0
    np.cumsum((b.astype(np.uint64) + np.uint64(1)) * powers[:len(b)], out=sums[1:])
    h = (sums[gram:] - sums[:-gram]) * back[:n]
    h ^= h >> np.uint64(32)
    h *= np.uint64(0xD6E8FEB86659FD93)
    h ^= h >> np.uint64(32)
    return h


def _sliding(x: np.ndarray, width: int, pick) -> np.ndarray:
    """``pick`` over every ``width`` neighbours, by doubling."""
    w = 1
    while 2 * w <= width:
        x = pick(x[:-w], x[w:])
        w *= 2
    return x if w == width else pick(x[:len(x) - (width - w)], x[width - w:])


def window_owners(h: np.ndarray, width: int) -> np.ndarray:
    """For every window of ``width`` hashes the place of the first least one."""
    ranked = (h & np.uint64(0xFFFFFFFF00000000)) | np.arange(len(h), dtype=np.uint64)
    return (_sliding(ranked, width, np.minimum) & np.uint64(0xFFFFFFFF)).astype(np.int64)


def _anchor_rows(texts: list[bytes], length: int, gram: int, tables, slice_bytes: int) -> Iterator[tuple]:
    """(text, position, hash, left, right, context hash) in arrays, slice by slice.

    ``left`` and ``right``: how far the context reaches from the position.
    """
    import xxhash

    width = length - gram + 1
    todo: list[tuple[int, int, int]] = []  # text, from, to: each window lies in one slice
    for k, t in enumerate(texts):
        for lo in range(0, len(t) - length + 1, slice_bytes - length + 1):
            todo.append((k, lo, min(len(t), lo + slice_bytes)))
    at = 0
    while at < len(todo):
        size, upto = 0, at
        while upto < len(todo) and (upto == at or size + todo[upto][2] - todo[upto][1] <= slice_bytes):
            size += todo[upto][2] - todo[upto][1]
            upto += 1
        part = todo[at:upto]
        at = upto
        buf = b"".join(texts[k][lo:hi] for k, lo, hi in part)
        h = gram_hashes(np.frombuffer(buf, dtype=np.uint8), gram, tables)
        owner = window_owners(h, width)
        ends = np.cumsum([hi - lo for _, lo, hi in part])
        starts = ends - [hi - lo for _, lo, hi in part]
        flags = np.zeros(len(h) + 1, dtype=np.int32)
        np.add.at(flags, starts, 1)
        np.add.at(flags, ends - length + 1, -1)
        whole = np.cumsum(flags[:len(owner)]) > 0  # windows inside one text
        w = np.nonzero(whole)[0]
        new = np.ones(len(w), dtype=bool)
        new[1:] = (owner[w[1:]] != owner[w[:-1]]) | (w[1:] != w[:-1] + 1)
        first = w[new]
        last = w[np.append(np.nonzero(new)[0][1:] - 1, len(w) - 1)]
        pos = owner[first]
        which = np.searchsorted(ends, pos, "right")
        p = pos - starts[which] + np.array([q[1] for q in part])[which]
        stop, left = last + length, pos - first
        c = np.fromiter((xxhash.xxh64_intdigest(buf[a:b], x) for a, b, x in zip(first.tolist(), stop.tolist(), left.tolist())),
                        dtype=np.uint64, count=len(p))
        yield np.array([q[0] for q in part])[which], p, h[pos].view(np.int64), left, stop - pos, c.view(np.int64)


def anchor_table(docs: DataFrame, length: int, gram: int) -> DataFrame:
    """``docs(key, b)`` to (key, pos, h, l, r, c), one row per context."""
    key_type, slice_bytes = docs.schema["key"].dataType.simpleString(), SLICE

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = _tables(slice_bytes + length, gram)
        for batch in batches:
            texts = [t or b"" for t in batch.column("b").to_pylist()]
            for k, p, h, left, right, c in _anchor_rows(texts, length, gram, tables, slice_bytes):
                yield pa.RecordBatch.from_arrays(
                    [batch.column("key").take(pa.array(k)), pa.array(p, pa.int32()), pa.array(h, pa.int64()),
                     pa.array(left, pa.int16()), pa.array(right, pa.int16()), pa.array(c, pa.int64())],
                    ["key", "pos", "h", "l", "r", "c"])

    return docs.mapInArrow(run, f"key {key_type}, pos int, h long, l short, r short, c long")


# --- the operator ---------------------------------------------------------

def keyed_texts(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, key, b): the text's bytes under a key that is one row's own.

    The key is the id where ids are longs, not null and not repeated; else a
    hash of id and text, which only rows equal in both share (their spans are
    the same, and each counts).
    """
    b = F.coalesce(F.col(text_col), F.lit("")).cast("binary")
    plain = docs.schema[id_col].dataType.simpleString() == "bigint"
    if plain:
        n, some, each = docs.select(F.count("*"), F.count(id_col), F.countDistinct(id_col)).first()
        plain = n == some == each
    key = F.col(id_col) if plain else F.xxhash64(F.col(id_col).cast("string"), F.col(text_col))
    return docs.select(F.col(id_col).alias("id"), key.alias("key"), b.alias("b"))


def repeated_places(texts: DataFrame, length: int = LENGTH, gram: int = GRAM) -> DataFrame:
    """``texts(key, b)`` to merged spans (key, start, stop) of repeated bytes."""
    table = stored(anchor_table(texts.select("key", "b").filter(F.length("b") >= length), length, gram), "sa-anchors")
    # stored, so that both sides of the join are plain shuffles and a hot anchor's rows can be split among tasks
    again = stored(table.groupBy("h").agg(F.count("*").alias("n"), (F.min("c") != F.max("c")).alias("mixed"))
                   .filter("n > 1").select("h", "mixed"), "sa-again")
    rows = stored(table.join(again.hint("shuffle_hash"), "h"), "sa-repeated")
    contexts = stored(rows.groupBy("h", "c", "l", "r", "mixed").agg(
        F.count("*").alias("n"), F.min(F.struct("key", "pos")).alias("one")), "sa-contexts")
    whole = rows.join(contexts.filter("n > 1").select("h", "c").hint("shuffle_hash"), ["h", "c"], "left_semi").select(
        "key", (F.col("pos") - F.col("l")).alias("start"), (F.col("pos") + F.col("r")).alias("stop"))
    return merged(whole.unionByName(_differing(contexts.filter("mixed"), texts, length, gram)))


def merged(spans: DataFrame) -> DataFrame:
    """Maximal runs of (key, start, stop) per key."""
    by = Window.partitionBy("key").orderBy("start", "stop")
    reached = F.max("stop").over(by.rowsBetween(Window.unboundedPreceding, -1))
    return (spans.withColumn("new", F.coalesce((F.col("start") > reached).cast("int"), F.lit(1)))
            .withColumn("run", F.sum("new").over(by.rowsBetween(Window.unboundedPreceding, 0)))
            .groupBy("key", "run").agg(F.min("start").alias("start"), F.max("stop").alias("stop"))
            .select("key", "start", "stop"))


def _differing(contexts: DataFrame, texts: DataFrame, length: int, gram: int) -> DataFrame:
    """Steps 3 and 4: the repeated windows of contexts that differ."""
    reach = length - gram
    want = contexts.select(F.col("one.key").alias("key"), F.struct(
        F.col("h"), F.col("one.pos").alias("pos"), F.col("l"), F.col("r"), F.col("n")).alias("w"))
    want = stored(want.groupBy(F.col("key").alias("k")).agg(F.collect_list("w").alias("w")), "sa-wanted")
    # a document has one row here; the texts that have one are shuffled by key, at every size alike
    cut = (texts.join(want, F.col("key") == F.col("k")).select("key", "b", F.explode("w").alias("w"))
           .select("key", "w.h", "w.pos", F.col("w.l").cast("int").alias("l"), F.col("w.r").cast("int").alias("r"), "w.n",
                   F.expr("substring(b, w.pos - w.l + 1, w.l + w.r)").alias("ctx")))
    # the offsets of the windows of a context are length - r to l; steps that it has no window in are left out
    steps = F.array(*[F.struct(F.lit(a).alias("lo"), F.lit(min(a + STEP - 1, reach)).alias("hi"))
                      for a in range(0, reach + 1, STEP)])
    steps = F.filter(steps, lambda s: (s["lo"] <= F.col("l")) & (s["hi"] >= length - F.col("r")))
    parts = (cut.withColumn("s", F.explode(steps))
             .withColumn("lo", F.greatest(F.col("s.lo"), length - F.col("r")))
             .withColumn("hi", F.least(F.col("s.hi"), F.col("l")))
             .withColumn("core", F.expr(f"{length} - s.hi + s.lo")))
    # 0xFF, which no UTF-8 text holds, stands for the shared bytes
    parts = stored(parts.select(
        F.expr("xxhash64(h, s.lo, substring(ctx, l - s.lo + 1, core))").alias("g"), "key",
        (F.col("pos") - F.col("hi")).alias("at"), "n", F.expr("s.hi - s.lo + 1").alias("width"),
        F.expr("concat(substring(ctx, l - hi + 1, hi - s.lo), X'FF', substring(ctx, l - s.lo + core + 1, s.hi - lo))")
        .alias("ctx")), "sa-parts")
    sizes = stored(parts.groupBy("g").agg(F.count("*").alias("rows")).filter("rows > 1"), "sa-groups")
    small = parts.join(sizes.filter(F.col("rows") <= GROUP_ROWS).select("g").hint("shuffle_hash"), "g", "left_semi")
    key_type = texts.schema["key"].dataType.simpleString()

    def sort_groups(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Groups stand together, in order; one is held at a time."""
        group, rows = None, []
        for batch in batches:
            out: list[tuple] = []
            for g, *row in zip(*(batch.column(c).to_pylist() for c in ("g", "key", "at", "n", "width", "ctx"))):
                if g != group and rows:
                    out += _spans_of_group(rows, length)
                    rows = []
                group = g
                rows.append(row)
            yield _spans_batch(out)
        if rows:
            yield _spans_batch(_spans_of_group(rows, length))

    def _spans_batch(out: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_pandas(pd.DataFrame(out, columns=["key", "start", "stop"]).astype(
            {"start": "int32", "stop": "int32"} | ({} if out else {"key": "int64"})), preserve_index=False)

    found = small.repartition("g").sortWithinPartitions("g").mapInArrow(
        sort_groups, f"key {key_type}, start int, stop int")
    large = parts.join(sizes.filter(F.col("rows") > GROUP_ROWS).select("g"), "g", "left_semi").withColumn(
        "o", F.explode(F.sequence(F.lit(0), F.length("ctx") - F.col("width"))))
    windows = stored(large.select("g", "key", (F.col("at") + F.col("o")).alias("start"), "n",
                                  F.md5(F.expr("substring(ctx, o + 1, width)")).alias("w")), "sa-windows")
    several = windows.groupBy("g", "w").agg(F.sum("n").alias("n")).filter("n > 1").select("g", "w")
    counted = windows.join(several, ["g", "w"], "left_semi").select(
        "key", "start", (F.col("start") + length).cast("int").alias("stop"))
    return stored(found.unionByName(counted), "sa-found")


def _spans_of_group(rows: list, length: int) -> list[tuple]:
    """The repeated spans of one group's (key, at, n, width, ctx) rows."""
    alike: dict[bytes, list] = {}
    for row in rows:
        alike.setdefault(row[4], []).append(row)
    strings, width = list(alike), rows[0][3]
    if len(strings) == 1:
        windows = [list(range(len(strings[0]) - width + 1))] if sum(r[2] for r in rows) > 1 else [[]]
    else:
        windows = repeated_windows(strings, [sum(r[2] for r in alike[s]) for s in strings], width)
    out = []
    for s, starts in zip(strings, windows):
        spans = merge([(i, i + length) for i in starts])
        out += [(key, at + a, at + b) for key, at, *_ in alike[s] for a, b in spans]
    return out


def remove_repeats(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, id_col: str = "doc_id",
                   text_col: str = "text", keep_bytes: bool = False) -> DataFrame:
    """id, n_bytes, n_removed, n_spans, kept_sha256 (and kept, the bytes left).

    The spans of all documents are broadcast if they were counted to at most
    :data:`BROADCAST_SPANS`; otherwise texts and spans are shuffled by key.
    """
    texts = keyed_texts(docs, id_col, text_col)
    spans = stored(repeated_places(texts, length, gram), "sa-spans")
    few = spans.limit(BROADCAST_SPANS + 1).count() <= BROADCAST_SPANS
    spans = spans.groupBy(F.col("key").alias("k")).agg(F.sort_array(F.collect_list(F.struct("start", "stop"))).alias("s"))
    rows = texts.join(F.broadcast(spans) if few else spans, F.col("key") == F.col("k"), "left")
    # a document's spans cut its bytes into the parts that stay
    pieces = F.expr("""concat(
        array(substring(b, 1, s[0].start)),
        transform(sequence(0, size(s) - 1), i -> substring(
            b, s[i].stop + 1, coalesce(get(s, i + 1).start, length(b)) - s[i].stop)))""")
    kept = F.when(F.col("s").isNull(), F.col("b")).otherwise(
        F.aggregate(pieces, F.lit(b"").cast("binary"), lambda acc, x: F.concat(acc, x)))
    gone = F.coalesce(F.aggregate("s", F.lit(0).cast("long"), lambda a, x: a + x["stop"] - x["start"]), F.lit(0))
    out = rows.select(F.col("id").alias(id_col), F.length("b").cast("long").alias("n_bytes"),
                      gone.cast("long").alias("n_removed"),
                      F.coalesce(F.size("s"), F.lit(0)).cast("long").alias("n_spans"), kept.alias("kept"))
    out = out.withColumn("kept_sha256", F.sha2("kept", 256))
    return out if keep_bytes else out.drop("kept")
