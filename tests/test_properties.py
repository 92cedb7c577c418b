"""Property-based equality of alternative physical forms on random sparse series."""
import datetime as dt

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from ampere.operators import lags as LG
from ampere.operators import windows as WN

T0 = dt.datetime(2024, 3, 25)   # spans the spring clock change
cells = st.lists(st.one_of(st.none(), st.floats(-100, 100, allow_nan=False), st.just("gap")), min_size=5, max_size=120)
SETTINGS = settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])


def frame(spark, vals):
    rows = [(T0 + dt.timedelta(hours=i), v) for i, v in enumerate(vals) if v != "gap"]
    return spark.createDataFrame(rows, "timestamp timestamp, v double")


@SETTINGS
@given(vals=cells)
def test_lag_forms_agree(spark, vals):
    df = frame(spark, vals)
    lags = {1: {"v": "a"}, 24: {"v": "b"}, 25: {"v": "c"}}
    cols = ["timestamp", "a", "b", "c"]
    x = sorted(tuple(r) for r in LG.lag_fanout(df, lags).select(*cols).collect())
    y = sorted(tuple(r) for r in LG.lag_self_join(df, lags).select(*cols).collect())
    z = sorted(tuple(r) for r in LG.lag_range_window(df, lags).select(*cols).collect())
    assert x == y == z


@SETTINGS
@given(vals=cells, width=st.integers(1, 30), limit=st.integers(1, 5))
def test_bucketed_fill_equals_plain(spark, vals, width, limit):
    df = frame(spark, vals).withColumn("k", F.lit("s"))
    b = F.floor(F.unix_seconds("timestamp") / (width * 3600))
    p = sorted(tuple(r) for r in WN.forward_fill(df, ["v"], partition=["k"], limit=limit).collect())
    q = sorted(tuple(r) for r in WN.forward_fill_bucketed(df, ["v"], partition=["k"], limit=limit, bucket=b).collect())
    assert p == q
