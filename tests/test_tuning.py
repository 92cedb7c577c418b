import numpy as np
import pytest
from pyspark.sql import functions as F

from ampere.operators import splits as SP
from ampere.plans import tuning as TU


@pytest.mark.parametrize("n,k,gap", [(100, 3, 5), (41, 4, 0), (7, 3, 10), (3, 3, 1)])
def test_roles_are_the_folds_with_each_row_once(spark, n, k, gap):
    df = spark.range(n).select((F.lit(0) + F.col("id") * 3600).cast("timestamp").alias("timestamp"), "id").repartition(3)
    want = {(r.id, r.fold, r.role) for r in SP.ts_cv_folds(df, k, gap).collect()}
    rows = SP.ts_cv_roles(df, k, gap).collect()
    assert sorted(r.id for r in rows) == list(range(n))
    got = {(r.id, i, "train") for r in rows for i in range(r.train_from, k + 1)}
    got |= {(r.id, r.test_fold, "test") for r in rows if r.test_fold is not None}
    assert got == want


def test_search_equals_separate_fits(spark):
    rng = np.random.default_rng(5)
    n, k, gap = 600, 3, 4
    x = rng.normal(size=(n, 2))
    y = 3 + x @ [2.0, -1.0] + rng.normal(size=n)
    df = spark.createDataFrame([(i * 3600, float(a), float(b), float(c)) for i, ((a, b), c) in enumerate(zip(x, y))],
                               "s long, a double, b double, y double").withColumn("timestamp", F.col("s").cast("timestamp")).repartition(4)
    got = {r.trial: r for r in TU.random_search_cv(df, ["a", "b"], "y", n_trials=3, n_splits=k, gap=gap).collect()}
    roles = [r.role for r in SP.temporal_split(df, "timestamp", holdout_days=7).orderBy("timestamp").collect()]
    m = roles.count("trainval")
    design = np.column_stack([np.ones(n), x])

    def mae(train, test, ridge):
        g = design[train].T @ design[train]
        beta = np.linalg.solve(g + ridge * np.diag([0.0, g[1, 1], g[2, 2]]), design[train].T @ y[train])
        return np.abs(design[test] @ beta - y[test]).mean()

    t = m // (k + 1)
    starts = [m - (k - i + 1) * t for i in range(1, k + 1)]
    want = {j + 1: np.mean([mae(slice(0, s - gap), slice(s, s + t), r) for s in starts])
            for j, r in enumerate(TU.draw_trials(3, 1e-4, 10.0))}
    assert {j: pytest.approx(v) for j, v in want.items()} == {j: r.cv_mae for j, r in got.items()}
    best = min(want, key=want.get)
    assert [j for j, r in got.items() if r.is_best] == [best]
    assert got[best].holdout_mae == pytest.approx(mae(slice(0, m), slice(m, n), got[best].ridge))
