"""Edge semantics of analysis and data-quality operators."""
import datetime as dt

import pytest
from pyspark.sql import functions as F

from ampere.operators import analysis as AN
from ampere.operators import quality as QL


def test_mode_tie_takes_smallest(spark):
    df = spark.createDataFrame([(1, "b"), (1, "a"), (1, "b"), (1, "a"), (2, "z")], "g int, v string")
    out = {r["g"]: (r["mode"], r["mode_count"]) for r in AN.mode_per_group(df, ["g"], "v").collect()}
    assert out == {1: ("a", 2), 2: ("z", 1)}


def test_pairwise_corr_uses_pairwise_complete_rows(spark):
    df = spark.createDataFrame([(1.0, 2.0, None), (2.0, 4.0, 1.0), (3.0, 6.5, 0.0), (4.0, 8.0, 1.0)],
                               "a double, b double, c double")
    m = {(r["a"], r["b"]): r["corr"] for r in AN.pairwise_corr(df, ["a", "b", "c"]).collect()}
    assert m[("a", "a")] == pytest.approx(1.0)
    assert m[("a", "b")] == m[("b", "a")]
    # corr(a, c) over rows 2..4 only
    import numpy as np
    assert m[("a", "c")] == pytest.approx(np.corrcoef([2, 3, 4], [1, 0, 1])[0, 1])


def test_threshold_table_and_share(spark):
    df = spark.createDataFrame([(v,) for v in [100.0, 250.0, 350.0, None, -5.0]], "p double")
    t = {r["threshold"]: (r["hours"], r["pct"]) for r in AN.threshold_table(df, "p", [200.0, 300.0]).collect()}
    assert t[200.0] == (2, 50.0) and t[300.0] == (1, 25.0)
    s = AN.share_where(df, [], {"neg": F.col("p") < 0}).first()["neg"]
    assert s == pytest.approx(25.0)


def test_describe_percentiles_linear_like_pandas(spark):
    import pandas as pd
    vals = [1.0, 2.0, 4.0, 8.0, 16.0]
    df = spark.createDataFrame([("g", v) for v in vals], "k string, v double")
    r = AN.describe(df, ["k"], "v").first()
    s = pd.Series(vals)
    assert r["p25"] == pytest.approx(s.quantile(0.25)) and r["p95"] == pytest.approx(s.quantile(0.95))
    assert r["std"] == pytest.approx(s.std())
    a = AN.describe(df, ["k"], "v", approx=True).first()
    assert a["p50"] == 4.0


def test_deviation_from_cell_mean(spark):
    df = spark.createDataFrame([(0, 1.0), (0, 3.0), (1, 10.0)], "h int, v double")
    out = sorted((r["h"], r["deviation"]) for r in AN.deviation_from_cell_mean(df, "v", ["h"]).collect())
    assert out == [(0, -1.0), (0, 1.0), (1, 0.0)]


def test_quality_checks(spark):
    t = dt.datetime(2024, 1, 1)
    df = spark.createDataFrame([(t, "A", 1.0, "hour"), (t, "A", 2.0, "hour"), (t, None, None, "week"),
                                (t, "B", 3.0, None)], "timestamp timestamp, signal string, value double, resolution string")
    u = {r["check"]: r["n_violations"] for r in QL.unique_combination(df, "t", ["timestamp", "signal"]).collect()}
    assert u == {"unique_combination": 1, "duplicate_rows": 1}
    na = {(r["check"], r["key"]): r["n_violations"] for r in QL.not_null_and_accepted(
        df, "t", ["signal", "value"], {"resolution": ["hour", "quarterhour"]}).collect()}
    assert na == {("not_null", "signal"): 1, ("not_null", "value"): 1, ("accepted_values", "resolution"): 1}
    dim = spark.createDataFrame([(dt.date(2023, 12, 31),)], "date_day date")
    r = QL.missing_in_dimension(df, "t", F.to_date("timestamp"), dim).first()
    assert r["n_violations"] == 4


def test_forecast_availability_raises(spark):
    empty = spark.createDataFrame([], "timestamp timestamp, f double")
    with pytest.raises(ValueError):
        QL.assert_forecast_available(empty, ["f"])
    nulls = spark.createDataFrame([(dt.datetime(2024, 1, 1), None)], "timestamp timestamp, f double")
    with pytest.raises(ValueError):
        QL.assert_forecast_available(nulls, ["f"])
