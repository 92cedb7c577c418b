"""Exact quantiles against numpy, with ranges that are cut several times; density histograms against numpy."""
import numpy as np
import pytest
from pyspark.sql import functions as F

from ampere.operators.analysis import density_histogram, describe, heatmap
from ampere.operators.quantiles import exact_quantiles

PROBS = {"q0": 0.0, "q10": 0.1, "q50": 0.5, "q90": 0.9, "q99": 0.999, "q100": 1.0}


def test_a_million_distinct_values_in_one_group(spark):
    n = 1_000_003
    df = spark.range(n).select(F.lit("hot").alias("g"), ((F.col("id") * 7919) % n).cast("double").alias("v"))
    got = exact_quantiles(df, ["g"], "v", PROBS, bins=64, small=500).first()
    for name, p in PROBS.items():
        assert got[name] == pytest.approx(p * (n - 1), abs=1e-6)


@pytest.mark.parametrize("small", [7, 100_000])
def test_quantiles_equal_numpy(spark, small):
    rng = np.random.default_rng(7)
    groups = {"wide": np.exp(rng.normal(0, 40, 400)), "ties": rng.integers(0, 4, 300).astype(float), "one": np.array([5.0]),
              "same": np.full(50, -2.5), "negative": -np.exp(rng.normal(size=200)), None: np.array([1.0, 3.0]),
              "huge": np.array([-1.7e308, 1.7e308, 0.0, 5e-324, -5e-324])}
    rows = [(g, float(v)) for g, vs in groups.items() for v in vs] + [("ties", None), ("none", None), ("ties", float("nan"))]
    df = spark.createDataFrame(rows, "g string, v double").repartition(5)
    got = {r.g: r for r in exact_quantiles(df, ["g"], "v", PROBS, bins=16, small=small).collect()}
    assert set(got) == set(groups)
    for g, vs in groups.items():
        if g == "huge":
            assert got[g].q50 == 0.0 and got[g].q0 == -1.7e308
            continue
        for name, p in PROBS.items():
            assert got[g][name] == pytest.approx(np.quantile(vs, p), rel=1e-9)


def test_no_keys_and_no_rows(spark):
    df = spark.createDataFrame([(float(v),) for v in range(11)], "v double")
    assert exact_quantiles(df, [], "v", {"m": 0.5}).collect()[0].m == 5.0
    assert exact_quantiles(df.where("false"), [], "v", {"m": 0.5}).collect() == []


def test_describe_and_heatmap_by_rank_selection(spark):
    rows = [("a", k % 2, float(k)) for k in range(21)] + [("b", 0, 4.0), ("b", 0, None), ("c", 1, None)]
    df = spark.createDataFrame(rows, "g string, c int, v double")
    d = {r.g: r for r in describe(df, ["g"], "v", (0.25, 0.5)).collect()}
    assert (d["a"].p25, d["a"].p50, d["a"]["count"], d["a"].max) == (5.0, 10.0, 21, 20.0)
    assert d["b"].p50 == 4.0 and d["c"]["count"] == 0 and d["c"].p50 is None
    h = {r.g: r for r in heatmap(df, "g", "c", "v", [0, 1], "median").collect()}
    assert (h["a"].c0, h["a"].c1, h["b"].c0, h["b"].c1, h["c"].c1) == (10.0, 10.0, 4.0, None, None)


def test_density_histogram_equals_numpy(spark):
    rng = np.random.default_rng(9)
    groups = {"x": rng.normal(0, 300, 700), "y": rng.normal(100, 30, 200), "z": np.full(9, 42.0)}
    df = spark.createDataFrame([(g, float(v)) for g, vs in groups.items() for v in vs] + [("x", None)], "g string, v double")
    got = {}
    for r in density_histogram(df, ["g"], "v", 120, -100, 600).collect():
        got.setdefault(r.g, {})[r.bin] = (r.n, r.density)
    for g, vs in groups.items():
        clipped = vs.clip(-100, 600)
        n, _ = np.histogram(clipped, 120)
        dens, _ = np.histogram(clipped, 120, density=True)
        assert {k: v[0] for k, v in got[g].items()} == {k: int(c) for k, c in enumerate(n) if c}
        assert all(v[1] == pytest.approx(dens[k]) for k, v in got[g].items())
