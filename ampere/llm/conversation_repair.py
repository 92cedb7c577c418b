"""Repair of a conversation's structure by divide and conquer.

The roles of a conversation must read ``(s?(ua)+)?`` (system, user,
assistant). Four states say what stands before a row: nothing, a system
message, a user message, an assistant message. From each of them the next
row can be kept, reroled or deleted, and empty messages can be inserted
before it; every row is thus a table of 4 x 4 least costs. Forward and
backward cost vectors meet in the middle of the conversation; among the
states in which a cheapest repair can cross there, the one with the ASCII
least edits before it is taken, and both halves are solved alike. Memory is
the rows' codes and two vectors.

Edits up to two states that take the same number of rows never are one the
beginning of the other, so four ranks beside the four costs compare them:
no edit string is stored for the choice.

On Spark the rows are range-partitioned and sorted by conversation and turn,
and each task cuts its part of a conversation into segments of bounded rows
and bytes. A segment is summed up as one 4 x 4 table, the same kind a row
has, so a conversation of any length is solved over its segments first, and
every segment, whose first and last state are then known, by itself. Tasks
read sorted rows in a stream and hold a segment at a time; the digest of a
conversation's text, which has to be computed in order, is fed piece by
piece.

Defined cases: null roles and texts are one space; rows without an id are
one conversation; rows of one turn are taken by role, text and place in the
table; equal rows are duplicates of the first; other columns are not read;
empty tables give empty results.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator, Sequence
from itertools import groupby

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from ampere.llm.common import stored

#: Costs of the edits; an undeleted truncated row adds TRUNCATED.
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 3, 4, 3, 3
#: Rows and bytes of text at which a segment of a conversation ends.
SEGMENT_ROWS, SEGMENT_BYTES = 4_096, 4 << 20

BLANK_CHARS = " \t\n\x0b\x0c\r"
START, SYSTEM, USER, ASSISTANT = range(4)
NEVER = 1 << 60
Table = tuple[tuple[tuple[int, ...], ...], tuple[tuple[int, ...], ...]]


def _next(state: int) -> int:
    """The state after the message that has to follow (a system message aside)."""
    return ASSISTANT if state == USER else USER


ROLE_OF = {USER: "user", ASSISTANT: "assistant"}


def _step(initial: str, fault: str) -> tuple[Table, list[list[str]]]:
    """Costs and ranks of one row from state to state, and the edits that have them.

    ``initial`` is the role's first letter, ``fault`` one of "" , "delete",
    "truncated", "end" (the end of the conversation, which only a complete
    one passes, into state START).
    """
    best: list[list[tuple[int, str]]] = [[(NEVER, "")] * 4 for _ in range(4)]
    for p in range(4):
        state, before, cost = p, "", 0
        for _ in range(4):
            if fault == "end":
                options = [(0, "", START)] if state in (START, ASSISTANT) else []
            else:
                extra = TRUNCATED if fault == "truncated" else 0
                options = [(DELETE, "D", state)]
                if fault != "delete":
                    options.append((REROLE + extra, "R", _next(state)))
                    if initial == "s" and state == START:
                        options.append((KEEP + extra, "K", SYSTEM))
                    if initial and initial == ROLE_OF[_next(state)][0]:
                        options.append((KEEP + extra, "K", _next(state)))
            for c, letter, q in options:
                best[p][q] = min(best[p][q], (cost + c, before + letter))
            state, before, cost = _next(state), before + "I", cost + INSERT
    costs = tuple(tuple(c for c, _ in row) for row in best)
    ranks = tuple(tuple(sorted(e for _, e in row).index(e) for _, e in row) for row in best)
    return (costs, ranks), [[e for _, e in row] for row in best]


#: Codes of rows: every first letter that matters with every fault, then the end.
CODES = {(i, f): k for k, (i, f) in enumerate([(i, f) for i in ("", "s", "u", "a") for f in ("", "delete", "truncated")])}
END = len(CODES)
STEPS = [_step(i, f) for i, f in CODES] + [_step("", "end")]
TABLES: list[Table] = [t for t, _ in STEPS]
EDITS = [e for _, e in STEPS]


def forward(tables: Sequence[Table], lo: int, hi: int, state: int) -> tuple[list[int], list[int]]:
    """Least costs from ``state`` before step ``lo`` to every state before ``hi``, and the order of their least edits."""
    cost, rank = [NEVER] * 4, [0] * 4
    cost[state] = 0
    for k in range(lo, hi):
        c, r = tables[k]
        live = [p for p in range(4) if cost[p] < NEVER]
        came = []
        for q in range(4):
            came.append(min(((cost[p] + c[p][q], rank[p], r[p][q]) for p in live if c[p][q] < NEVER),
                            default=(NEVER, 4, q)))
        order = sorted(range(4), key=lambda q: came[q][1:])
        cost = [x[0] for x in came]
        for place, q in enumerate(order):
            rank[q] = place
    return cost, rank


def backward(tables: Sequence[Table], lo: int, hi: int, state: int) -> list[int]:
    """Least costs from every state before step ``lo`` to ``state`` before ``hi``."""
    cost = [NEVER] * 4
    cost[state] = 0
    for k in range(hi - 1, lo - 1, -1):
        c = tables[k][0]
        cost = [min(min(c[p][q] + cost[q] for q in range(4)), NEVER) for p in range(4)]
    return cost


def crossings(tables: Sequence[Table], first: int, last: int) -> list[int]:
    """The states before every step of the audit-least cheapest way, and the last."""
    out = [first, *[START] * (len(tables) - 1), last]

    def solve(lo: int, hi: int) -> None:
        if hi - lo > 1:
            mid = (lo + hi) // 2
            cost, rank = forward(tables, lo, mid, out[lo])
            rest = backward(tables, mid, hi, out[hi])
            out[mid] = min(range(4), key=lambda q: (cost[q] + rest[q], rank[q]))
            solve(lo, mid)
            solve(mid, hi)

    if tables:
        solve(0, len(tables))
    return out


def audit_of(codes: Sequence[int], first: int, last: int) -> str:
    """The edits of rows with these codes, from state to state."""
    at = crossings([TABLES[k] for k in codes], first, last)
    return "".join(EDITS[k][p][q] for k, p, q in zip(codes, at, at[1:]))


def summary(codes: Sequence[int]) -> Table:
    """Costs and ranks of a whole segment, like those of a row."""
    tables = [TABLES[k] for k in codes]
    each = [forward(tables, 0, len(tables), p) for p in range(4)]
    return tuple(tuple(c) for c, _ in each), tuple(tuple(r) for _, r in each)


def messages(audit: str, rows: Sequence[tuple[str, str]], state: int) -> Iterator[str]:
    """The repaired ``role:text`` of rows, from ``state`` on."""
    rows = iter(rows)
    for letter in audit:
        role, text = ("", "") if letter == "I" else next(rows)
        if letter == "D":
            continue
        if letter == "K":
            state = SYSTEM if role[:1] == "s" else _next(state)
        else:
            state = _next(state)
            role = ROLE_OF[state]
        yield f"{role}:{text}"


# --- on Spark ---------------------------------------------------------------

STATS = ("blank", "duplicate", "truncated", "illegal")
FIGURES = ("gaps", *STATS, "cost")
LEGAL = {"su", "ua", "au"}


def _longs(names: Sequence[str]) -> str:
    return ", ".join(f"{n} long" for n in names)


def _streamed(df: DataFrame, step: Callable[[Iterator[dict]], Iterator[tuple]], ddl: str) -> DataFrame:
    """``step`` over the rows of every partition in their order, in bounded batches."""
    schema = to_arrow_schema(StructType.fromDDL(ddl))

    def batch(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), schema.types)], schema=schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, size = [], 0
        for row in step(r for b in batches for r in b.to_pylist()):
            out.append(row)
            size += sum(len(v) for v in row if isinstance(v, str))
            if len(out) >= 1000 or size > SEGMENT_BYTES:
                yield batch(out)
                out, size = [], 0
        if out:
            yield batch(out)

    return df.mapInArrow(run, ddl)


def _in_order(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    return df.repartition(*keys).sortWithinPartitions(*[F.asc_nulls_first(c) for c in order])


def damaged(rows: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """(conv, turn, role, text, dropped, n, copy): the rows after damage by their id and turn.

    The remainder of crc32(id:turn) by 20: 0 drops the row (it stays with
    ``dropped``, so its conversation isn't lost), 1 empties the text, 2 takes
    its sentence ends away, 3 repeats the row, 4 makes its role user.
    """
    shown = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind = F.crc32(F.concat(shown(conv), F.lit(":"), shown(turn)).cast("binary")) % 20
    out = rows.select(F.col(conv).alias("conv"), F.col(turn).alias("turn"), shown(role).alias("role"),
                      shown(text).alias("text"), kind.alias("kind"), F.monotonically_increasing_id().alias("n"))
    said = F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    copies = F.when(F.col("kind") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return out.select("conv", "turn", F.when(F.col("kind") == 4, "user").otherwise(F.col("role")).alias("role"),
                      said.alias("text"), (F.col("kind") == 0).alias("dropped"), "n", F.explode(copies).alias("copy"))


def with_faults(rows: DataFrame) -> DataFrame:
    """``rows`` with ``fault``: blank, duplicate (of an earlier row of the conversation), truncated or null."""
    rows = stored(rows.withColumn("same", F.sha2(F.concat_ws(":", F.length("role"), "role", "text"), 256)), "conv-damaged")
    place = F.struct("turn", "n", "copy")
    first = (rows.filter("not dropped").groupBy(F.col("conv").alias("c"), F.col("same").alias("s"))
             .agg(F.min(place).alias("first"), F.count("*").alias("times")).filter("times > 1").drop("times"))
    bare = F.rtrim(F.col("text"), F.lit(BLANK_CHARS))
    again = F.col("first").isNotNull() & ~F.col("first").eqNullSafe(place)
    fault = (F.when(bare == "", "blank").when(again, "duplicate")
             .when(~F.right(bare, F.lit(1)).isin(".", "!", "?"), "truncated"))
    return (rows.join(stored(first, "conv-first"), F.col("conv").eqNullSafe(F.col("c")) & (F.col("same") == F.col("s")), "left")
            .select("conv", "turn", "role", "text", "dropped", "n", "copy", fault.alias("fault")))


class _Segment:
    """The segment that a task is reading: its codes and figures so far."""

    def __init__(self, conv, number: int):
        self.conv, self.number, self.codes, self.size, self.rows = conv, number, [], 0, 0
        self.stats = dict.fromkeys(STATS, 0)
        self.turns, self.low, self.high, self.first, self.last = 0, None, None, None, None

    def full(self) -> bool:
        return self.rows >= SEGMENT_ROWS or self.size >= SEGMENT_BYTES

    def add(self, row: dict) -> None:
        initial, fault = row["role"][:1], row["fault"]
        self.codes.append(CODES[initial if initial in ("s", "u", "a") else "",
                                "delete" if fault in ("blank", "duplicate") else fault or ""])
        self.size += len(row["text"])
        if fault:
            self.stats[fault] += 1
        if self.last is None:
            self.first = initial
        else:
            self.stats["illegal"] += self.last + initial not in LEGAL
        self.last = initial
        if row["turn"] is not None:
            self.turns += row["turn"] != self.high
            self.low, self.high = row["turn"] if self.low is None else self.low, row["turn"]

    def summed_up(self, part: int) -> tuple:
        costs, ranks = summary(self.codes)
        return (part, self.number, -1, self.conv, None, None, None, sum(costs, ()), sum(ranks, ()), *self.stats.values(),
                self.turns, self.low, self.high, self.first, self.last)


def segments(rows: DataFrame) -> DataFrame:
    """The rows in order, by task and segment, and a row for each segment with its table and figures (``pos`` -1)."""
    conv, turn = (rows.schema[c].dataType.simpleString() for c in ("conv", "turn"))
    ddl = (f"part int, seg int, pos int, conv {conv}, role string, text string, code int, costs array<long>, "
           f"ranks array<int>, {_longs(STATS)}, turns long, low {turn}, high {turn}, first string, last string")

    def step(rows: Iterator[dict]) -> Iterator[tuple]:
        part, seg = TaskContext.get().partitionId(), None
        for r in rows:
            if seg is None or seg.conv != r["conv"] or seg.full():
                if seg is not None:
                    yield seg.summed_up(part)
                seg = _Segment(r["conv"], seg.number + 1 if seg else 0)
            seg.rows += 1
            if not r["dropped"]:
                seg.add(r)
                yield part, seg.number, seg.rows, seg.conv, r["role"], r["text"], seg.codes[-1], *[None] * (len(STATS) + 7)
        if seg is not None:
            yield seg.summed_up(part)

    order = [F.asc_nulls_first(c) for c in ("conv", "turn", "role", "text", "n", "copy")]
    ranged = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    return _streamed(ranged.select("conv", "turn", "role", "text", "dropped", "fault"), step, ddl)


def routes(segs: DataFrame) -> DataFrame:
    """The states around every segment of the cheapest repair (``pos`` 0, so before the segment's rows).

    The figures of a conversation stand with its last segment, as do the
    edits at its end (``tail``).
    """
    conv = segs.schema["conv"].dataType.simpleString()

    def square(v: list[int]) -> tuple[tuple[int, ...], ...]:
        return tuple(tuple(v[4 * p:4 * p + 4]) for p in range(4))

    def step(rows: Iterator[dict]) -> Iterator[tuple]:
        for conv, run in groupby(rows, key=lambda r: r["conv"]):
            tables, places, stats = [], [], dict.fromkeys(STATS, 0)
            turns, low, high, last = 0, None, None, None
            for r in run:
                places.append((r["part"], r["seg"]))
                tables.append((square(r["costs"]), square(r["ranks"])))
                for s in STATS:
                    stats[s] += r[s]
                if r["first"] is not None:
                    stats["illegal"] += last is not None and last + r["first"] not in LEGAL
                    last = r["last"]
                if r["low"] is not None:
                    turns += r["turns"] - (r["low"] == high)
                    low, high = r["low"] if low is None else low, r["high"]
            tables.append(TABLES[END])
            at = crossings(tables, START, START)
            cost = forward(tables, 0, len(tables), START)[0][START]
            gaps = 0 if low is None else high - low + 1 - turns
            for k, (part, seg) in enumerate(places[:-1]):
                yield part, seg, 0, conv, at[k], at[k + 1], "", *[None] * len(FIGURES)
            yield *places[-1], 0, conv, at[-3], at[-2], EDITS[END][at[-2]][START], gaps, *stats.values(), cost

    only = segs.filter("pos = -1").drop("pos", "role", "text", "code")
    return _streamed(_in_order(only, ["conv"], ["conv", "part", "seg"]), step,
                     f"part int, seg int, pos int, conv {conv}, first_state int, last_state int, tail string, {_longs(FIGURES)}")


def repaired_segments(segs: DataFrame, paths: DataFrame) -> DataFrame:
    """(conv, part, seg, audit, body, figures): edits and repaired text of every segment (null: no message)."""
    conv = segs.schema["conv"].dataType.simpleString()

    def step(rows: Iterator[dict]) -> Iterator[tuple]:
        for (part, seg), run in groupby(rows, key=lambda r: (r["part"], r["seg"])):
            path, *rows_of = run
            audit = audit_of([r["code"] for r in rows_of], path["first_state"], path["last_state"]) + path["tail"]
            said = list(messages(audit, [(r["role"], r["text"]) for r in rows_of], path["first_state"]))
            yield (path["conv"], part, seg, audit, "\n".join(said) if said else None, *(path[f] for f in FIGURES))

    both = segs.filter("pos > 0").select("part", "seg", "pos", "conv", "role", "text", "code").unionByName(
        paths, allowMissingColumns=True)
    return _streamed(_in_order(both, ["part", "seg"], ["part", "seg", "pos"]), step,
                     f"conv {conv}, part int, seg int, audit string, body string, {_longs(FIGURES)}")


def repair_conversations(rows: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text",
                         prepare: Callable[..., DataFrame] = damaged) -> DataFrame:
    """One row per conversation: its faults, the cheapest edits and the digest of its repaired text.

    ``prepare`` brings the table's rows into the form of :func:`damaged`.
    """
    segs = stored(segments(stored(with_faults(prepare(rows, conv, turn, role, text)), "conv-faults")), "conv-segments")
    pieces = repaired_segments(segs, routes(segs))

    def step(rows: Iterator[dict]) -> Iterator[tuple]:
        for conv, run in groupby(rows, key=lambda r: r["conv"]):
            digest, audit, before = hashlib.sha256(), [], ""
            for r in run:
                audit.append(r["audit"])
                if r["body"] is not None:
                    digest.update((before + r["body"]).encode())
                    before = "\n"
            yield conv, *(r[f] for f in FIGURES), "".join(audit), digest.hexdigest()

    kind = pieces.schema["conv"].dataType.simpleString()
    return _streamed(_in_order(pieces, ["conv"], ["conv", "part", "seg"]), step,
                     f"conv {kind}, {_longs(FIGURES)}, audit string, repaired_sha256 string").withColumnRenamed("conv", conv)
