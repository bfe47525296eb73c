"""Newton steps against plain numpy, and what depends on MD5."""

import hashlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from scorewatch.functions.columns import hash_share
from scorewatch.operators import logistic, model, quantiles, series
from scorewatch.spec import FeatureSpec

SPEC = FeatureSpec(("a", "b", "c"), "y")


def drawn(n=400):
    rng = np.random.default_rng(1)
    x = rng.normal(size=(n, 3)) * [1, 20, 0.1] + [0, 500, 3]
    p = 1 / (1 + np.exp(-(x[:, 0] + 0.1 * (x[:, 1] - 500) - 0.2)))
    return x, (rng.random(n) < p).astype(int)


def by_numpy(x, y, steps, ridge):
    scaled = (x - x.min(axis=0)) / (x.max(axis=0) - x.min(axis=0))
    scaled, beta = np.column_stack([np.ones(len(x)), scaled]), np.zeros(4)
    for _ in range(steps):
        p = 1 / (1 + np.exp(-scaled @ beta))
        hessian = (scaled * (p * (1 - p))[:, None]).T @ scaled + ridge * np.eye(4)
        beta = beta + np.linalg.solve(hessian, scaled.T @ (y - p) - ridge * beta)
    return beta


@pytest.mark.parametrize("ridge", [0.0, 2.0])
@pytest.mark.parametrize("method", ["columns", "matrix"])
def test_steps_equal_numpy(spark, method, ridge):
    x, y = drawn()
    rows = [(*map(float, r), int(k)) for r, k in zip(x, y)] + [(1.0, None, 3.0, 1), (0.0, 500.0, float("nan"), 0), (0.0, 500.0, 3.0, None)]
    df = spark.createDataFrame(rows, "a double, b double, c double, y int").repartition(3)
    fitted = logistic.fit_newton(df, SPEC, 6, ridge, method, partitions=2)
    assert [fitted.intercept, *fitted.weights] == pytest.approx(by_numpy(x, y, 6, ridge), rel=1e-8)
    assert np.abs(logistic.gradient_of(df, fitted, "y", ridge)).max() < 1e-6


def test_saved_and_loaded_scores(spark, tmp_path):
    x, y = drawn()
    df = spark.createDataFrame([(*map(float, r), int(k)) for r, k in zip(x, y)], "a double, b double, c double, y int")
    fitted = logistic.fit_newton(df, SPEC, 6)
    for _ in range(2):
        fitted.save(spark, str(tmp_path / "model"))
    assert logistic.LinearModel.load(spark, str(tmp_path / "model")) == fitted
    odd = spark.createDataFrame([(None, 500.0, 3.0), (float("nan"), 500.0, 3.0)], "a double, b double, c double")
    zero, nan = logistic.score_linear(odd, fitted).collect()
    assert zero.a == 0.0 and zero.benign_probability + zero.malignant_probability == 1
    assert nan.predicted_label == 0 and np.isnan(nan.malignant_probability)


def test_constant_features_and_empty_tables(spark):
    df = spark.createDataFrame([(1.0, 5.0, 2.0, 0), (2.0, 5.0, 1.0, 1), (3.0, 5.0, 2.0, 0), (4.0, 5.0, 2.5, 1)], "a double, b double, c double, y int")
    fitted = logistic.fit_newton(df, SPEC, 3, ridge=0.5)
    assert all(np.isfinite(fitted.weights)) and logistic.score_linear(df, fitted).count() == 4
    with pytest.raises(ValueError, match="no values"):
        logistic.fit_newton(df.limit(0), SPEC)


def test_shares_are_those_of_md5(spark):
    df = spark.createDataFrame([(k,) for k in ["a", "", "é", None, "17"]], "k string")
    found = {r.k: r.s for r in df.select("k", hash_share("k", 3).alias("s")).collect()}
    assert found.pop(None) is None
    assert found == {k: int(hashlib.md5(f"{k}:3".encode()).hexdigest()[:8], 16) % 100 for k in found}
    first, second = model.split(df, 0.5, 3, "k", "md5")
    assert first.count() + second.count() == 5


@pytest.mark.parametrize("ranges", [None, 9])
def test_newest_rows_of_a_key_of_most_rows(spark, ranges):
    """n beyond Spark's limit, one key of 90 %, one of fewer rows than n, rows without a key."""
    keys = ["hot"] * 18_000 + ["b"] * 1500 + [None] * 500
    df = spark.createDataFrame([(k, i) for i, k in enumerate(keys)], "k string, id int").repartition(5)
    found = series.last_n(df, 5000, ["id"], ["k"], ranges)
    counts = {r.k: (r.n, r.low) for r in found.groupBy("k").agg(F.count("*").alias("n"), F.min("id").alias("low")).collect()}
    assert counts == {"hot": (5000, 13_000), "b": (1500, 18_000), None: (500, 19_500)} and found.columns == ["k", "id"]


def test_rank_errors_are_counted(spark):
    values = [1.0] * 10 + [2.0] * 50 + [float(v) for v in range(3, 43)]
    df = spark.createDataFrame([("g", v) for v in values] + [("g", None), (None, 4.0)], "g string, v double")
    found = spark.createDataFrame([("g", 2.0, 2.0, 40.0), (None, 4.0, 4.0, 4.0)], "g string, q1 double, median double, q3 double")
    errors = {r.g: (r.n, r.q1, r.median, r.q3) for r in quantiles.rank_errors(df, "v", found, ["g"]).collect()}
    # Rank 75 is wanted, 40.0 has rank 98.
    assert errors == {"g": (100, 0, 0, 23), None: (1, 0, 0, 0)}
