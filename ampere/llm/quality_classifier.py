"""Document quality by random Fourier features, ridge regression and isotonic calibration.

Every whole text becomes a short vector of statistics. Cosines of random
projections of the standardised vector approximate a Gaussian kernel; a
ridge regression on them is fitted from normal equations: every task adds up
the products of its labelled rows, and the matrices are added up a tree.
Sums are kept apart by fold, so models that leave a fold out follow without
another pass: the kernel's width and the ridge are those with the least
squared error on left-out folds. A second pass counts labels by the
left-out raw score on a fixed grid (``RESOLUTION``); pooling adjacent
violators over the grid gives the calibration, a non-decreasing line
through the pools.

All labelled rows take part; what reaches the driver has a size fixed by
``FEATURES``, ``FOLDS``, ``WIDTHS`` and ``RESOLUTION``.

Defined cases: null texts are empty, and empty texts have statistics like
others; several labels of an id count as the least; rows with a null id or
label teach nothing; repeated rows count each; without labels every score is
0.5; other columns are not read; empty tables give empty results.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ampere.llm.common import stored

#: Cosines, folds of the labelled rows, and matrices added up in one tree step.
FEATURES, FOLDS, FAN_IN = 256, 4, 32
#: Kernel widths (times the square root of the number of statistics) and ridges (times the number of rows) tried.
WIDTHS, RIDGES = (0.5, 1.0, 2.0), (1e-6, 1e-5, 1e-4, 1e-3, 1e-2)
#: Steps of the raw score for calibration, and the range they cover.
RESOLUTION, LOW, HIGH = 0.001, -0.5, 1.5
#: Standardised statistics are cut at this many deviations.
FAR = 6.0
SEED = 13

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SYMBOLS = b"#*$%&|<>"

STATISTICS = (
    "words", "characters", "word_length", "word_length_spread", "longest_word", "distinct_words", "top_word",
    "neighbours_equal", "distinct_trigrams", "lines", "repeated_lines", "words_per_line", "digits", "capitals",
    "other_letters", "symbols_per_word", "bars_per_word", "signs_per_word", "commas_per_word", "stops_per_word",
    "capital_words", "one_letter_words", "entropy")


def statistics(text: str | None) -> list[float]:
    """The statistics of a whole text, in the order of :data:`STATISTICS`."""
    text = text or ""
    words = WORD.findall(text)
    n = len(words)
    by = np.bincount(np.frombuffer(text.encode(), np.uint8), minlength=256)
    n_bytes = max(1, int(by.sum() - by[[32, *range(9, 14)]].sum()))
    per_word = lambda chars: float(by[list(chars)].sum()) / max(1, n)
    long = np.array([len(w) for w in words] or [0], float)
    seen = Counter(words)
    lines = [x for x in text.split("\n") if WORD.search(x)]
    share = by[by > 0] / max(1, by.sum())
    letters = max(1, int(by[65:91].sum() + by[97:123].sum()))
    return [
        np.log1p(n), np.log1p(len(text)), np.log1p(long.mean()), np.log1p(long.std()), np.log1p(long.max()),
        len(seen) / max(1, n), max(seen.values(), default=0) / max(1, n),
        sum(a == b for a, b in zip(words, words[1:])) / max(1, n - 1),
        len(set(zip(words, words[1:], words[2:]))) / max(1, n - 2),
        np.log1p(len(lines)), 1 - len(set(lines)) / max(1, len(lines)), np.log1p(n / max(1, len(lines))),
        np.sqrt(by[48:58].sum() / n_bytes), by[65:91].sum() / letters, by[128:].sum() / n_bytes,
        np.log1p(per_word(SYMBOLS)), np.log1p(per_word(b"|")), np.log1p(per_word(b"!")), np.log1p(per_word(b",")),
        np.log1p(per_word(b".?")), sum(w[0].isupper() for w in words) / max(1, n),
        sum(len(w) == 1 for w in words) / max(1, n), float(-(share * np.log(share)).sum())]


def document_statistics(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, x): the statistics of every document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = [statistics(t) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(x, pa.list_(pa.float64()))], ["id", "x"])

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInArrow(run, f"id {kind}, x array<double>")


@dataclass(frozen=True)
class Cosines:
    """Standardisation and the random projections of every kernel width."""

    mean: np.ndarray
    scale: np.ndarray
    seed: int = SEED

    def of(self, x: np.ndarray, width: float) -> np.ndarray:
        """An intercept and the cosines of rows ``x``."""
        z = np.clip((x - self.mean) / self.scale, -FAR, FAR)
        rng = np.random.default_rng(self.seed)
        w = rng.normal(size=(len(self.mean), FEATURES)) / (width * np.sqrt(len(self.mean)))
        phase = rng.uniform(0, 2 * np.pi, FEATURES)
        return np.column_stack([np.ones(len(z)), np.sqrt(2 / FEATURES) * np.cos(z @ w + phase)])


def matrix(column) -> np.ndarray:
    """Rows of equal arrays as a matrix."""
    return np.array([*column], float).reshape(-1, len(STATISTICS))


def normal_equations(rows: DataFrame, cosines: Cosines) -> dict[tuple[int, int], np.ndarray]:
    """Sums of the products of [1, cosines, y] of ``rows(x, y, fold)``, by (width, fold)."""
    side = FEATURES + 2

    def partial(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        part, sums = TaskContext.get().partitionId(), {}
        for pdf in batches:
            x, y, fold = matrix(pdf["x"]), pdf["y"].to_numpy(float), pdf["fold"].to_numpy()
            for k, width in enumerate(WIDTHS):
                m = np.column_stack([cosines.of(x, width), y])
                for f in np.unique(fold):
                    sums[k, f] = sums.get((k, f), 0.0) + m[fold == f].T @ m[fold == f]
        for (k, f), s in sorted(sums.items()):
            yield pd.DataFrame({"width": [k], "fold": [int(f)], "part": [part], "blob": [s.tobytes()]})

    def add(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        # in the order of the tasks, so that reruns round alike
        total = sum(np.frombuffer(b) for b in pdf.sort_values("part")["blob"])
        return pd.DataFrame({"width": [key[0]], "fold": [key[1]], "part": [key[2]], "blob": [total.tobytes()]})

    schema = "width int, fold int, part int, blob binary"
    sums = stored(rows.mapInPandas(partial, schema), "quality-sums")
    parts = (sums.agg(F.max("part")).first()[0] or 0) + 1
    while parts > 1:
        parts = -(-parts // FAN_IN)
        sums = sums.withColumn("part", F.floor(F.col("part") / FAN_IN).cast("int"))
        sums = sums.groupBy("width", "fold", "part").applyInPandas(add, schema)
    return {(r.width, r.fold): np.frombuffer(r.blob).reshape(side, side) for r in sums.collect()}


def ridge(total: np.ndarray, penalty: float) -> np.ndarray:
    """The weights that normal equations and a ridge on all but the intercept give."""
    k = len(total) - 1
    own = np.full(k, penalty * max(1.0, total[0, 0]))
    own[0] = 1e-9
    return np.linalg.solve(total[:k, :k] + np.diag(own), total[:k, k])


def squared_error(total: np.ndarray, w: np.ndarray) -> float:
    """The summed squared error of weights on the rows that the sums are of."""
    v = np.r_[w, -1.0]
    return float(v @ total @ v)


def pooled(counts: np.ndarray, means: np.ndarray) -> list[list[float]]:
    """Pool adjacent violators: [weight, mean, first, last] of every pool, means rising."""
    out: list[list[float]] = []
    for k, (n, m) in enumerate(zip(counts, means)):
        out.append([n, m, k, k])
        while len(out) > 1 and out[-2][1] >= out[-1][1]:
            n2, m2, _, last = out.pop()
            n1, m1, first, _ = out.pop()
            out.append([n1 + n2, (n1 * m1 + n2 * m2) / (n1 + n2), first, last])
    return out


@dataclass(frozen=True)
class QualityModel:
    """Cosines, weights and the calibration line; without weights every score is 0.5."""

    cosines: Cosines | None
    width: float
    weights: np.ndarray | None
    line: tuple[np.ndarray, np.ndarray] | None

    def scores(self, x: np.ndarray) -> np.ndarray:
        if self.weights is None or not len(x):
            return np.full(len(x), 0.5)
        return np.clip(np.interp(self.cosines.of(x, self.width) @ self.weights, *self.line), 0.0, 1.0)


def fit_quality(stats: DataFrame, labels: DataFrame, id_col: str = "doc_id", label_col: str = "quality",
                seed: int = SEED) -> QualityModel:
    """A model of ``labels`` on ``stats(id, x)``, the statistics of documents."""
    y = (labels.filter(F.col(label_col).isNotNull() & F.col(id_col).isNotNull())
         .groupBy(F.col(id_col).alias("of")).agg(F.min(label_col).cast("double").alias("y")))
    fold = F.pmod(F.xxhash64("id"), F.lit(FOLDS)).cast("int")
    rows = stored(stats.join(y, F.col("id") == F.col("of")).select("x", "y", fold.alias("fold")), "quality-labelled")
    k = range(len(STATISTICS))
    at = rows.agg(F.count("*"), *[F.avg(F.col("x")[i]) for i in k], *[F.stddev_pop(F.col("x")[i]) for i in k]).first()
    if not at[0]:
        return QualityModel(None, 1.0, None, None)
    mean, scale = np.array(at[1:], float).reshape(2, -1)
    cosines = Cosines(mean, np.where(scale > 1e-9, scale, 1.0), seed)
    sums = normal_equations(rows, cosines)

    folds = sorted({f for _, f in sums})
    total = [sum(sums[w, f] for f in folds) for w in range(len(WIDTHS))]
    # a fold that holds all rows can't be left out
    rest = {key: total[key[0]] - s if len(folds) > 1 else s for key, s in sums.items()}
    error = {(w, p): sum(squared_error(sums[w, f], ridge(rest[w, f], p)) for f in folds)
             for w in range(len(WIDTHS)) for p in RIDGES}
    best, penalty = min(error, key=error.get)
    width = WIDTHS[best]
    without = {f: ridge(rest[best, f], penalty) for f in folds}

    def graded(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            if pdf.empty:
                continue
            z, fold = cosines.of(matrix(pdf["x"]), width), pdf["fold"].to_numpy()
            raw = np.zeros(len(z))
            for f, w in without.items():
                raw[fold == f] = z[fold == f] @ w
            step = np.rint((np.clip(raw, LOW, HIGH) - LOW) / RESOLUTION).astype(int)
            yield pd.DataFrame({"step": step, "y": pdf["y"].to_numpy()})

    grid = sorted(tuple(r) for r in rows.mapInPandas(graded, "step int, y double").groupBy("step")
                  .agg(F.count("*"), F.avg("y")).collect())
    step, count, mean_y = np.array(grid).T
    pools = pooled(count, mean_y)
    middle = [np.average(step[int(a):int(z) + 1], weights=count[int(a):int(z) + 1]) for _, _, a, z in pools]
    line = (LOW + RESOLUTION * np.array(middle), np.array([m for _, m, _, _ in pools]))
    return QualityModel(cosines, width, ridge(total[best], penalty), line)


def score_quality(stats: DataFrame, model: QualityModel) -> DataFrame:
    """(id, score) of ``stats(id, x)``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            score = model.scores(matrix(batch.column("x").to_pylist()))
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(score, pa.float64())], ["id", "score"])

    return stats.mapInArrow(run, f"id {stats.schema['id'].dataType.simpleString()}, score double")


def classify_quality(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id and score of every document, learned from ``labels(id, quality)``."""
    stats = stored(document_statistics(docs, id_col, text_col), "quality-statistics")
    return score_quality(stats, fit_quality(stats, labels, id_col)).withColumnRenamed("id", id_col)
