"""Quality rules with risk-controlled thresholds, in DataFrame operations only.

Every rule is a ratio of a document that is larger the worse the document.
Its cutoff is chosen per stratum from labelled rows: going from the laxest
cutoff of a fixed grid to stricter ones, a cutoff is certified while the
exact binomial tail ``P(Bin(n, alpha / rules) <= x)`` of the ``x`` good rows
it would reject out of ``n`` is at most ``delta / (strata * rules)``. With
probability ``1 - delta`` no stratum then loses more than ``alpha`` of its
good documents (union bounds over rules and strata; a fixed sequence of tests
needs no correction along the grid). Of the certified cutoffs the laxest that
rejects nearly as many bad rows as the strictest one is taken. A stratum with
too few labels has no certified cutoff and rejects nothing.

Defined cases: null texts have no words and fail the base rules; null strata
are one stratum; repeated labels of an id count once, good only if all say
so; without labels nothing but the base rules rejects.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ampere.llm.common import BLANKS, stored, words_of

SYMBOLS = "#*$%&|<>"
#: Words of the windows whose repetition is counted.
WINDOW = 5
MIN_WORDS, MAX_REPEAT_PERCENT = 10, 20
#: False rejections allowed in a stratum, and the probability of exceeding them.
ALPHA, DELTA = 0.05, 0.05
#: Share of the bad rows caught by the strictest certified cutoff that a laxer one must catch.
NEARLY = 0.99
#: Strata whose cutoffs may be broadcast (one short row each).
BROADCAST_STRATA = 10_000

#: Cutoffs from lax to strict, common to all rules: halving steps and halves between.
GRID = [round(x, 4) for k in range(0, 8) for x in (2.0 ** (1 - k), 1.5 * 2.0 ** -k)]

#: A rule: its name and the ratio, from the columns of :func:`measures`.
RULES = {
    "symbols_per_word": "n_symbols / n_words",
    "signs_per_word": "n_signs / n_words",
    "dup_line_share": "n_dup_lines / n_lines",
    "repeat_share": "n_repeat_words / n_words",
    "long_words": "(word_chars / n_words - 10) / 10",
    "short_words": "(3 - word_chars / n_words) / 3",
}


def _repeat_words(words: str, window: int) -> list[tuple[str, str]]:
    """Steps (column, SQL) that end in n_repeat_words, from a column of words.

    Windows are hashed; only where hashes repeat are they sorted with their
    places, and the words covered by the repeated places counted.
    """
    at = ", ".join(f"get(hashes, i + {j})" for j in range(window))
    return [
        ("hashes", f"transform({words}, w -> xxhash64(w))"),
        ("grams", f"if(size(hashes) < {window}, array(), transform(sequence(0, size(hashes) - {window}), "
                  f"i -> xxhash64({at})))"),
        ("sorted", "if(size(array_distinct(grams)) = size(grams), null, "
                   "array_sort(transform(grams, (g, i) -> named_struct('g', g, 'i', i))))"),
        ("places", "array_sort(transform(filter(sorted, (x, i) -> get(sorted, i - 1).g <=> x.g "
                   "or get(sorted, i + 1).g <=> x.g), x -> x.i))"),
        ("n_repeat_words", f"cast(if(sorted is null, 0, {window} + aggregate(zip_with("
                           "slice(places, 2, greatest(size(places) - 1, 0)), "
                           "slice(places, 1, greatest(size(places) - 1, 0)), "
                           f"(b, a) -> least({window}, b - a)), 0, (s, x) -> s + x)) as bigint)"),
    ]


def measures(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", stratum: Column | None = None) -> DataFrame:
    """id, stratum, the base measures of every whole text, and base_failed."""
    d = docs.select(F.col(id_col).alias("id"), (stratum if stratum is not None else F.lit("all")).alias("stratum"),
                    F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    d = d.withColumn("words", words_of(F.col("text")))
    lines = F.filter(F.split("text", "\n"), lambda x: x.rlike("[^\\x20\\x09-\\x0D]"))
    d = d.withColumn("lines", F.transform(lines, lambda x: F.xxhash64(x)))
    bare = F.translate(F.col("text"), SYMBOLS, "")
    d = d.select(
        "id", "stratum", "words", F.size("words").cast("long").alias("n_words"),
        F.length(F.array_join("words", "")).cast("long").alias("word_chars"),
        (F.length("text") - F.length(bare)).cast("long").alias("n_symbols"),
        (F.length("text") - F.length(F.replace(F.col("text"), F.lit("!"), F.lit("")))).cast("long").alias("n_signs"),
        F.size("lines").cast("long").alias("n_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"))
    for name, sql in _repeat_words("words", WINDOW):
        d = d.withColumn(name, F.expr(sql))
    return d.select("id", "stratum", "n_words", "word_chars", "n_symbols", "n_signs", "n_lines", "n_dup_lines",
                    "n_repeat_words",
                    ((F.col("n_words") < MIN_WORDS)
                     | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))).alias("base_failed"))


def binomial_tail(n: Column, x: Column, p: float) -> Column:
    """P(Bin(n, p) <= x), exactly, summed in logarithms; 1 where x >= n p."""
    odds = math.log(p / (1 - p))
    first = F.col(n) * math.log1p(-p)
    term = lambda acc, k: acc["t"] + F.log((F.col(n) - k + 1) / k) + odds
    add = lambda a, b: F.greatest(a, b) + F.log1p(F.exp(F.least(a, b) - F.greatest(a, b)))
    steps = F.when(F.col(x) > 0, F.sequence(F.lit(1).cast("long"), F.col(x).cast("long"))).otherwise(F.array().cast("array<bigint>"))
    total = F.aggregate(steps, F.struct(first.alias("t"), first.alias("s")),
                        lambda acc, k: F.struct(term(acc, k).alias("t"), add(acc["s"], term(acc, k)).alias("s")))
    return F.when(F.col(x) >= F.col(n) * p, F.lit(1.0)).otherwise(F.exp(total["s"]))


def certified_cutoffs(rows: DataFrame, labels: DataFrame, id_col: str = "doc_id", label_col: str = "quality",
                      alpha: float = ALPHA, delta: float = DELTA) -> DataFrame:
    """(stratum, rule, cutoff): one row for each rule certified in a stratum."""
    y = (labels.filter(F.col(label_col).isNotNull() & F.col(id_col).isNotNull())
         .groupBy(F.col(id_col).alias("id")).agg(F.min(label_col).alias("good")))
    known = rows.filter("not base_failed").join(y, "id")
    rules = F.array(*[F.struct(F.lit(r).alias("rule"), F.expr(f"try_divide(1.0D * ({sql}), 1.0D)").alias("v"))
                      for r, sql in RULES.items()])
    known = known.select("stratum", "good", F.explode(rules).alias("m")).select("stratum", "good", "m.rule", "m.v")
    # one row per stratum and rule: how many good and bad rows each cutoff of the grid rejects
    over = [F.sum(F.when((F.col("good") == g) & (F.col("v") > c), 1).otherwise(0)).alias(f"x{g}_{i}")
            for i, c in enumerate(GRID) for g in (0, 1)]
    counts = known.groupBy("stratum", "rule").agg(F.sum((F.col("good") == 1).cast("long")).alias("n"), *over)
    cuts = F.array(*[F.struct(F.lit(i).alias("i"), F.lit(c).alias("cutoff"), F.col(f"x1_{i}").alias("x"),
                              F.col(f"x0_{i}").alias("bad")) for i, c in enumerate(GRID)])
    counts = counts.select("stratum", "rule", "n", F.explode(cuts).alias("c")).select("stratum", "rule", "n", "c.*")
    strata = rows.select("stratum").distinct().agg(F.greatest(F.count("*"), F.lit(1)).alias("s")).scalar()
    level = F.lit(delta) / (strata * len(RULES))
    tests = counts.withColumn("passed", binomial_tail("n", "x", alpha / len(RULES)) <= level)
    upto = Window.partitionBy("stratum", "rule").orderBy("i").rowsBetween(Window.unboundedPreceding, 0)
    sure = tests.withColumn("sure", F.min(F.col("passed").cast("int")).over(upto) == 1).filter("sure")
    most = Window.partitionBy("stratum", "rule")
    return (sure.withColumn("most", F.max("bad").over(most)).filter(F.col("bad") >= NEARLY * F.col("most"))
            .filter("most > 0").groupBy("stratum", "rule").agg(F.max("cutoff").alias("cutoff")))


def apply_rules(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                stratum: Column | None = None, alpha: float = ALPHA, delta: float = DELTA) -> DataFrame:
    """id, the measures, base_failed, failed_rule (the first, if any) and kept."""
    rows = stored(measures(docs, id_col, text_col, stratum), "quality")
    cuts = stored(certified_cutoffs(rows, labels, id_col, alpha=alpha, delta=delta)
                  .groupBy("stratum").agg(*[F.max(F.when(F.col("rule") == r, F.col("cutoff"))).alias(f"cut_{r}")
                                            for r in RULES]).withColumnRenamed("stratum", "s"), "quality-cutoffs")
    side = F.broadcast(cuts) if cuts.limit(BROADCAST_STRATA + 1).count() <= BROADCAST_STRATA else cuts
    rows = rows.join(side, F.col("stratum").eqNullSafe(F.col("s")), "left")
    failed = F.coalesce(*[F.when(F.expr(f"n_words > 0 and ({sql}) > cut_{r}"), F.lit(r)) for r, sql in RULES.items()])
    return rows.select(F.col("id").alias(id_col), "n_words", "word_chars", "n_symbols", "n_dup_lines",
                       "n_repeat_words", "base_failed", failed.alias("failed_rule")).withColumn(
        "kept", ~F.col("base_failed") & F.col("failed_rule").isNull())
