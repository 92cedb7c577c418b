"""Toxicity: a weighted lexicon matched by Aho-Corasick on folded text.

Folding maps every character to one character (case, look-alike letters of
other scripts, digits and signs that stand for letters), so positions in the
folded text are positions in the text. Accented letters stay what they are;
plain words are also looked for with accents taken off. Signs that stand for
i also stand for l: l and i are one symbol for the automaton, and a match
counts unless the text has an l where the entry has an i. A lexicon entry is a
whole word or a stem (written ``stem*``) that begins a word. A match counts
where the characters beside it are no letters or digits (behind a stem, they
may be) and no exception phrase covers it; a place counts once, with its
largest weight. The sum of the weights is divided by a power of the text's
length and turned into a probability by a logistic curve.

Defined cases: null and empty texts have no match and get the score of a
text without matches; with no labelled rows the lexicon is empty and every
score is 0; repeated label rows of one id count once, toxic if any says so.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: For each letter, the letters of other scripts, digits and
#: signs that stand for it, and its accented forms.
STANDS_FOR = {
    "a": "аαɑ@4", "b": "вβ8", "c": "сϲ¢", "d": "ԁ", "e": "еεё3€", "g": "ɡ9", "h": "һн", "i": "іιı1!|", "j": "јϳ",
    "k": "кκ", "l": "ⅼӏ", "m": "м", "n": "ոη", "o": "оοσ0", "p": "рρ", "q": "ԛ", "s": "ѕ5$", "t": "тτ7", "u": "υ",
    "v": "ν", "w": "ԝ", "x": "хχ", "y": "уγ", "z": "2",
}
ACCENTED = {"a": "àáâãäå", "c": "ç", "e": "èéêë", "i": "ìíîï", "n": "ñ", "o": "òóôõöø", "u": "ùúûü", "y": "ýÿ"}

#: Phrases in which a lexicon word is harmless (callers may pass others).
EXCEPTIONS = ("trash can", "trash cans", "trash bin", "trash bag", "clown fish", "pathetic fallacy")

#: Rows of labelled documents that the lexicon is learned from at most.
MAX_TRAIN_ROWS = 12_000
#: Letters of the stems considered.
STEMS = (4, 5, 6, 7)
#: A candidate stands in at least this share of the toxic training texts,
#: and is this many times likelier in toxic ones.
MIN_SHARE, MIN_LIFT = 0.01, 10.0
#: The lexicon grows until toxic texts hold this many of its entries each, or
#: no entry adds to this share of them.
COVER, MIN_GAIN = 2, 0.01
#: Exponents of the length tried for normalisation.
POWERS = (0.25, 0.5, 1.0)

_PLAIN = {ord(c): letter for letter, forms in ACCENTED.items() for c in forms}
_FOLD = {ord(c): letter for letter, forms in STANDS_FOR.items() for c in forms}
_ONE = {ord("l"): "i"}  # 1 and | are folded to i but also stand for l
# full-width forms stand at a fixed distance from ASCII
_FOLD.update({0xFF01 + i: _FOLD.get(0x21 + i, chr(0x21 + i).lower()) for i in range(94)})


def lower(text: str) -> str:
    """Lower case, character by character (length unchanged)."""
    low = text.lower()
    return low if len(low) == len(text) else "".join(c.lower() if len(c.lower()) == 1 else c for c in text)


def fold(text: str) -> str:
    """The text in lower case with look-alikes and substitutions undone."""
    return lower(text).translate(_FOLD)


@dataclass(frozen=True)
class ToxicityModel:
    """Folded words and stems with weights, exception phrases, and the score's curve."""

    weights: dict[str, float] = field(default_factory=dict)
    exceptions: tuple[str, ...] = EXCEPTIONS
    power: float = 0.5
    bias: float = -20.0
    slope: float = 0.0

    def automaton(self):
        """Automata for the folded text and for the text without accents (None if it can't differ)."""
        import ahocorasick

        full, plain = {}, {}
        for entry, x in self.weights.items():
            w, stem = entry.rstrip("*"), entry.endswith("*")
            full.setdefault(w.translate(_ONE), []).append((w, x, stem))
            if not stem and w.isascii():
                plain.setdefault(w.translate(_ONE), []).append((w, x, False))
        for p in map(fold, self.exceptions):
            full.setdefault(p.translate(_ONE), []).append((p, None, False))
        automata = []
        for forms in (full, plain):
            automata.append(ahocorasick.Automaton())
            for form, spelled in forms.items():
                automata[-1].add_word(form, tuple(spelled))
            automata[-1].make_automaton()
        return automata[0], automata[1] if plain else None

    def places(self, automata, text: str) -> dict[int, float]:
        """The counted matches: where each starts, and its weight."""
        low = lower(text)
        folded = low.translate(_FOLD)
        runs = [(automata[0], folded)]
        if automata[1] is not None and not low.isascii():
            runs.append((automata[1], folded.translate(_PLAIN)))
        found, shielded = {}, []
        for automaton, t in runs:
            for end, entries in automaton.iter(t.translate(_ONE)):
                start = end - len(entries[0][0]) + 1
                if start and low[start - 1].isalnum():
                    continue
                inside, here = end + 1 < len(low) and low[end + 1].isalnum(), t[start:end + 1]
                for w, x, stem in entries:
                    if inside and not stem or any(a == "i" and b == "l" for a, b in zip(w, here)):
                        continue
                    if x is None:
                        shielded.append((start, end))
                    elif x > found.get(start, (0.0, 0))[0]:
                        found[start] = (x, end)
        return {a: x for a, (x, b) in found.items() if not any(p <= a and b <= q for p, q in shielded)}

    def matches(self, automata, text: str) -> tuple[float, int]:
        """The sum of the weights of the counted matches, and their number."""
        found = self.places(automata, text)
        return sum(found.values()), len(found)

    def rate(self, total: float, length: int) -> float:
        return total / max(length, 1) ** self.power

    def score(self, rate: float) -> float:
        return 1 / (1 + math.exp(-max(-500.0, min(500.0, self.bias + self.slope * _squash(rate)))))


def _squash(rate: float) -> float:
    return math.log(rate + 1e-4) - math.log(1e-4)


def toxicity(model: ToxicityModel, text: Column) -> Column:
    """The score of a text column, 0 to 1, as an Arrow-batched column."""
    if not model.weights:
        return F.lit(0.0)

    @F.pandas_udf("double")
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        a = model.automaton()
        for texts in batches:
            yield pd.Series([model.score(model.rate(model.matches(a, t)[0], len(t)) if t else 0.0) for t in texts],
                            dtype="float64")

    return score(text)


def fit_toxicity(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 label_col: str = "toxic", max_rows: int = MAX_TRAIN_ROWS,
                 exceptions: tuple[str, ...] = EXCEPTIONS) -> ToxicityModel:
    """Learn the lexicon and the curve from a bounded sample of labelled rows.

    At most ``max_rows`` labelled ids, least hash first, are joined to their
    whole texts. Spark counts the folded words of both classes; every word
    that is much likelier in toxic texts is tried, greedily: a word enters if
    enough toxic texts that hold fewer than :data:`COVER` words so far hold it,
    so words that only accompany others stay out. A candidate stands in
    :data:`MIN_SHARE` of the toxic texts, so there are at most 1 / MIN_SHARE
    times as many as a toxic text has words and stems on average.
    """
    ids = (labels.filter(F.col(label_col).isNotNull() & F.col(id_col).isNotNull())
           .groupBy(F.col(id_col).alias("__id")).agg(F.max(label_col).cast("int").alias("y"))
           .orderBy(F.xxhash64("__id"), "__id").limit(max_rows))
    # only id and text, under own names: other columns may be called anything
    texts = docs.select(F.col(id_col).alias("__doc"), F.col(text_col).alias("t")).filter("t is not null")
    rows = texts.join(F.broadcast(ids), F.col("__doc") == F.col("__id")).select("t", "y")

    @F.pandas_udf("array<string>")
    def entries(texts: pd.Series) -> pd.Series:
        import re
        word = re.compile(r"[^\W\d_]{3,}")

        def of(t: str) -> list[str]:
            ws = set(word.findall(fold(t)))
            return [*ws, *{w[:k] + "*" for w in ws for k in STEMS if len(w) > k}]

        return texts.map(of)

    n = {r.y: r.n for r in rows.groupBy("y").agg(F.count("*").alias("n")).collect()}
    n1, n0 = n.get(1, 0), n.get(0, 0)
    if not n1 or not n0:
        return ToxicityModel(exceptions=exceptions)
    counts = (rows.select("y", F.explode(entries("t")).alias("w"))
              .groupBy("w").agg(F.sum("y").alias("a"), F.sum(1 - F.col("y")).alias("b")))
    lift = F.log((F.col("a") + 0.5) / (n1 + 1)) - F.log((F.col("b") + 0.5) / (n0 + 1))
    cand = [(r.w, r.lift) for r in counts.filter(F.col("a") >= max(2, math.ceil(MIN_SHARE * n1)))
            .withColumn("lift", lift).filter(F.col("lift") > math.log(MIN_LIFT))
            .orderBy(F.desc(F.col("a") * F.col("lift")), F.col("w").endswith("*"), F.desc(F.length("w")), "w").collect()]
    if not cand:
        return ToxicityModel(exceptions=exceptions)
    # each candidate alone, to see which texts hold it: weights are places + 1
    place = {w: i for i, (w, _) in enumerate(cand)}

    @F.pandas_udf("array<int>")
    def held(texts: pd.Series) -> pd.Series:
        import re
        word = re.compile(r"[^\W\d_]{3,}")

        def of(t: str) -> list[int]:
            ws = word.findall(fold(t))
            return sorted({place[e] for w in set(ws) for e in (w, *(w[:k] + "*" for k in STEMS if len(w) > k)) if e in place})

        return texts.map(of)

    seen = rows.filter("y = 1").select(held("t").alias("k")).collect()
    chosen = _cover([r.k for r in seen], [w for w, _ in cand], np.array([x for _, x in cand]))
    weights = {cand[j][0]: float(cand[j][1]) for j in chosen}
    model = ToxicityModel(weights, exceptions)

    @F.pandas_udf("double")
    def total_of(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        a = model.automaton()
        for texts in batches:
            yield texts.map(lambda t: float(model.matches(a, t)[0]))

    seen = rows.select("y", F.length("t").alias("n"), total_of("t").alias("x")).collect()
    y, total = np.array([r.y for r in seen]), np.array([r.x for r in seen])
    size = np.maximum(np.array([r.n for r in seen]), 1)
    _, bias, slope, power = min((*_logistic(np.array([_squash(v) for v in total / size**p]), y), p) for p in POWERS)
    return ToxicityModel(weights, exceptions, power, bias, slope)


def _cover(held: list[list[int]], entries: list[str], weight: np.ndarray) -> list[int]:
    """Greedy cover of the toxic texts, by the weight that an entry adds to texts still short of entries.

    ``held`` has the entries of each text, by place. An entry that begins with
    another, or begins it, marks the same places and doesn't count beside it.
    The gains are kept up to date text by text, so the work is in proportion to
    what the texts hold, not to texts times entries.
    """
    need, left = [COVER] * len(held), [set(k) for k in held]
    holders: list[list[int]] = [[] for _ in entries]
    for t, k in enumerate(left):
        for j in k:
            holders[j].append(t)
    gain = np.array([len(ts) for ts in holders], dtype=np.int64)
    stems = [e.rstrip("*") for e in entries]
    chosen: list[int] = []
    while any(n > 0 for n in need):
        j = int(np.argmax(gain * weight))
        if gain[j] < max(1, MIN_GAIN * len(held)):
            break
        chosen.append(j)
        kin = {k for k, s in enumerate(stems) if s.startswith(stems[j]) or stems[j].startswith(s)}
        for t in holders[j]:
            if need[t] <= 0:
                continue
            need[t] -= j in left[t]
            gone = left[t] & kin if need[t] > 0 else left[t]
            gain[list(gone)] -= 1
            left[t] = left[t] - gone
    return chosen


def _logistic(z: np.ndarray, y: np.ndarray, steps: int = 60) -> tuple[float, float, float]:
    """Newton fit of p = 1/(1+exp(-(a+b z))) with a small ridge: (loss, a, b)."""
    x = np.stack([np.ones_like(z), z], axis=1)
    w = np.zeros(2)
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        h = (x * (p * (1 - p))[:, None]).T @ x + np.eye(2) * 1e-2
        w = w + np.linalg.solve(h, x.T @ (y - p) - 1e-2 * w)
    p = np.clip(1 / (1 + np.exp(-np.clip(x @ w, -30, 30))), 1e-12, 1 - 1e-12)
    return float(-(y * np.log(p) + (1 - y) * np.log(1 - p)).mean()), float(w[0]), float(w[1])
