"""Language identification by averaged hashed subword embeddings.

A text is the average of the embeddings of its byte 2-, 3- and 4-grams
(lower case, everything but letters as one blank, so grams see word edges),
hashed into a fixed number of buckets. A linear softmax reads the average.
Embeddings and softmax are trained together by stochastic gradient descent in
numpy on a bounded sample; a temperature fitted on rows left out of training
calibrates the probability, and the least probability at which the accepted
left-out rows reach the target precision is the rejection threshold.

Defined cases: null texts and texts without a letter give ``und`` with score
0; rows without a language are not learned from; with nothing to learn from
every text is ``und``; very long texts are summed in slices.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ampere.llm.common import stored

#: Hash buckets (2**BITS) and size of an embedding.
BITS, DIM = 14, 16
#: Sampled rows of one language at most, and of all languages (each keeps one at least).
ROWS_PER_LANG, MAX_ROWS = 700, 8_000
EPOCHS, BATCH, RATE = 12, 32, 0.5
#: Of the sample, every CALIBRATE-th row is left out of training.
CALIBRATE = 5
#: Precision that accepted rows shall have.
PRECISION = 0.99
#: Bytes that one slice of a batch holds.
SLICE = 1 << 20

_MIX = (np.uint32(2654435761), np.uint32(2246822519), np.uint32(3266489917))
# letters stay; ASCII other than letters becomes a blank; bytes of other scripts stay
_LETTERS = bytes(c if c >= 128 or chr(c).isalpha() else 32 for c in range(256))


def _bytes(text: str) -> bytes:
    return b" " + b" ".join(text.lower().encode("utf-8", "replace").translate(_LETTERS).split()) + b" "


def _grams(b: np.ndarray) -> list[np.ndarray]:
    """The buckets of the 2-, 3- and 4-grams that start at each byte but the last 3."""
    x = b.astype(np.uint32)
    g2 = x[:-3] | (x[1:-2] << np.uint32(8))
    g3 = g2 | (x[2:-1] << np.uint32(16))
    g4 = g3 | (x[3:] << np.uint32(24))
    return [((g * m) ^ (g >> np.uint32(15))) * m >> np.uint32(32 - BITS) for g, m in zip((g2, g3, g4), _MIX)]


def has_letter(text: str | None) -> bool:
    return bool(text) and any(map(str.isalpha, text))


def features(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Buckets and their share of the text's grams."""
    b = np.frombuffer(_bytes(text) + b"   ", dtype=np.uint8)
    idx, n = np.unique(np.concatenate(_grams(b)), return_counts=True)
    return idx.astype(np.int32), (n / n.sum()).astype(np.float32)


@dataclass(frozen=True)
class LanguageModel:
    langs: list[str]
    #: buckets x languages: the softmax applied to every embedding
    table: np.ndarray
    bias: np.ndarray
    temperature: float
    reject_below: float

    def logits(self, texts: list[str]) -> np.ndarray:
        """One row per text; the texts are joined and cut into slices."""
        parts = [_bytes(t) + b"   " for t in texts]
        ends = np.cumsum([len(p) for p in parts])
        starts = ends - [len(p) for p in parts]
        buf = np.frombuffer(b"".join(parts) + b"   ", dtype=np.uint8)
        out = np.zeros((len(texts), len(self.langs)))
        for lo in range(0, int(ends[-1]) if len(ends) else 0, SLICE):
            hi = min(lo + SLICE, int(ends[-1]))
            first, last = np.searchsorted(ends, lo, "right"), np.searchsorted(starts, hi, "left")
            cuts = np.maximum(starts[first:last] - lo, 0)
            for g in _grams(buf[lo:hi + 3]):
                out[first:last] += np.add.reduceat(self.table[g], cuts, axis=0)
        return out / (3 * (ends - starts))[:, None] + self.bias

    def predict(self, texts: list[str]) -> tuple[list[str], np.ndarray]:
        z = self.logits(texts) / self.temperature
        p = np.exp(z - z.max(axis=1, keepdims=True))
        p /= p.sum(axis=1, keepdims=True)
        return [self.langs[i] for i in p.argmax(axis=1)], p.max(axis=1)


def fit_language_id(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
                    rows_per_lang: int = ROWS_PER_LANG, max_rows: int = MAX_ROWS, seed: int = 7) -> LanguageModel | None:
    """Train on up to ``rows_per_lang`` rows of every language, least hash first.

    With many languages each takes a smaller share of ``max_rows``, but no
    language is left out that has a row with a letter. Spark turns the sampled
    texts into sparse features of at most ``2**BITS`` buckets; the driver holds
    those of ``max_rows`` texts (or one for each language).
    """
    known = docs.select(F.col(lang_col).alias("l"), F.col(text_col).alias("t"),
                        F.xxhash64(F.col(id_col).cast("string"), F.lit(seed)).alias("h")).filter(
                            F.col("l").isNotNull() & F.col("t").rlike("\\p{L}"))
    counts = known.groupBy(F.col("l").alias("of")).agg(F.count("*").alias("n"))
    counts = stored(counts, "language-counts")
    n_langs = counts.count()
    if not n_langs:
        return None
    each = max(1, min(rows_per_lang, max_rows // n_langs))
    # a filter by hash leaves about twice the rows wanted, so that the window below sees few
    part = (F.pmod(F.col("h"), F.lit(1_000_003)) / 1_000_003) * F.col("n") < 2 * each + 20
    near = known.join(counts, F.col("l") == F.col("of")).filter(part).select("l", "t", "h")
    first = F.row_number().over(Window.partitionBy("l").orderBy("h", "t"))
    sample = near.withColumn("k", first).filter(F.col("k") <= each)

    @F.pandas_udf("struct<i:array<int>, v:array<float>>")
    def sparse(texts: pd.Series) -> pd.DataFrame:
        rows = [features(t) for t in texts]
        return pd.DataFrame({"i": [r[0] for r in rows], "v": [r[1] for r in rows]})

    rows = sample.select("l", "h", sparse("t").alias("x")).select("l", "h", "x.i", "x.v").toPandas()
    if rows.empty:
        return None
    return _train(rows.sort_values(["h", "l"], kind="stable").reset_index(drop=True), sorted(rows["l"].unique()), seed)


def _dense(rows: pd.DataFrame) -> np.ndarray:
    x = np.zeros((len(rows), 1 << BITS), dtype=np.float32)
    for k, (i, v) in enumerate(zip(rows["i"], rows["v"])):
        x[k, np.asarray(i)] = v
    return x


def _softmax(z: np.ndarray) -> np.ndarray:
    p = np.exp(z - z.max(axis=1, keepdims=True))
    return p / p.sum(axis=1, keepdims=True)


def _train(rows: pd.DataFrame, langs: list[str], seed: int) -> LanguageModel:
    rng = np.random.default_rng(seed)
    y = rows["l"].map({v: k for k, v in enumerate(langs)}).to_numpy()
    order = rng.permutation(len(rows))
    left_out, train = order[::CALIBRATE], np.array([k for j, k in enumerate(order) if j % CALIBRATE])
    if not len(train):
        train = order
    emb = rng.normal(0, 0.1, (1 << BITS, DIM)).astype(np.float32) * 10
    w, bias = np.zeros((DIM, len(langs)), dtype=np.float32), np.zeros(len(langs), dtype=np.float32)
    for epoch in range(EPOCHS):
        rate = RATE * (1 - epoch / EPOCHS) + 0.01
        for at in range(0, len(train), BATCH):
            k = train[at:at + BATCH]
            x = _dense(rows.iloc[k])
            h = x @ emb
            p = _softmax(h @ w + bias)
            p[np.arange(len(k)), y[k]] -= 1
            p /= len(k)
            back = p @ w.T
            w -= rate * (h.T @ p)
            bias -= rate * p.sum(axis=0)
            emb -= rate * 50 * (x.T @ back)  # a bucket's share of a text is small
        rng.shuffle(train)
    model = LanguageModel(langs, (emb @ w).astype(np.float32), bias.astype(np.float64), 1.0, 0.0)
    check = left_out if len(left_out) else train
    z = np.concatenate([_dense(rows.iloc[check[a:a + 256]]) @ model.table + bias for a in range(0, len(check), 256)])
    temperature = min(np.geomspace(0.05, 10, 60), key=lambda t: -np.log(
        _softmax(z / t)[np.arange(len(check)), y[check]] + 1e-12).mean())
    p = _softmax(z / temperature)
    best, right = p.max(axis=1), p.argmax(axis=1) == y[check]
    by = np.argsort(-best)
    precise = np.nonzero(np.cumsum(right[by]) / np.arange(1, len(by) + 1) >= PRECISION)[0]
    reject = float(best[by][precise[-1]]) if len(precise) else 1.0
    return LanguageModel(langs, model.table, model.bias, float(temperature), reject)


def identify_language(docs: DataFrame, model: LanguageModel | None, id_col: str = "doc_id",
                      text_col: str = "text") -> DataFrame:
    """id, lang_pred, score, rejected (score under the calibrated threshold)."""

    @F.pandas_udf("struct<lang_pred:string, score:double>")
    def predict(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            out = pd.DataFrame({"lang_pred": "und", "score": np.zeros(len(texts))})
            at = [k for k, t in enumerate(texts) if model and has_letter(t)]
            if at:
                langs, score = model.predict([texts.iloc[k] for k in at])
                out.loc[at, "lang_pred"] = langs
                out.loc[at, "score"] = score
            yield out

    reject = model.reject_below if model else 1.0
    return (docs.select(F.col(id_col), predict(F.col(text_col)).alias("p")).select(id_col, "p.*")
            .withColumn("rejected", (F.col("score") < reject) | (F.col("lang_pred") == "und")))
