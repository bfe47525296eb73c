"""Vectors, scalers, training, saving, metrics."""

import math
import random

import pytest
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from scorewatch.operators import evaluate, features, model
from scorewatch.plans.registry import LINE_SPEC, feature_table
from scorewatch.spec import FeatureSpec, tumour_spec

SPEC = FeatureSpec(("a", "b"), "label")


def scaled(df, kind, fitted_on=None):
    vectors = features.assemble(df, SPEC, "keep")
    fitted = None
    if fitted_on is not None:
        fitted = features.scaler(kind).fit(features.assemble(fitted_on, SPEC))
    values = features.scale(vectors, kind, fitted).select(vector_to_array("scaled_features").alias("v"))
    return [r.v for r in values.collect()]


def test_assemble_policies(spark):
    df = spark.createDataFrame([(1.0, None)], "a double, b double")
    kept = features.assemble(df, SPEC, "keep").select(vector_to_array("features").alias("v")).first().v
    assert kept[0] == 1.0 and math.isnan(kept[1])
    assert features.assemble(df, SPEC, "skip").count() == 0
    with pytest.raises(Exception, match="(?i)null"):
        features.assemble(df, SPEC).collect()


def test_minmax_is_not_clamped_and_constants_give_a_half(spark):
    fit = spark.createDataFrame([(1.0, 4.0), (3.0, 4.0)], "a double, b double")
    df = spark.createDataFrame([(0.0, 4.0), (9.0, 4.0)], "a double, b double").coalesce(1)
    assert scaled(df, "minmax", fit) == [[-0.5, 0.5], [4.0, 0.5]]
    plain = features.minmax_columns(df, features.fit_ranges(fit, ["a", "b"]))
    assert [tuple(r) for r in plain.collect()] == [(-0.5, 0.5), (4.0, 0.5)]
    nothing = features.minmax_columns(df, features.fit_ranges(fit.limit(0), ["a"]))
    assert {r.a for r in nothing.collect()} == {None}


def test_standard_scaling_does_not_center(spark):
    df = spark.createDataFrame([(1.0, 7.0), (3.0, 7.0)], "a double, b double").coalesce(1)
    assert [[round(x, 6) for x in v] for v in scaled(df, "standard")] == [[0.707107, 0.0], [2.12132, 0.0]]


def test_standard_columns_equal_the_scaler(spark):
    df = spark.createDataFrame([(1.0, 7.0), (3.0, 7.0), (4.5, 7.0)], "a double, b double").coalesce(1)
    plain = features.scaled_columns(df, ["a", "b"], "standard")
    assert [pytest.approx(v) for v in scaled(df, "standard")] == [[r.a, r.b] for r in plain.collect()]
    assert "UDF" not in plain._jdf.queryExecution().executedPlan().toString()
    one = features.scaled_columns(df.limit(1), ["a"], "standard").first()
    assert one.a is None


def test_radar_has_a_row_per_measure(spark):
    spec = tumour_spec()
    rows = [tuple(float(i) for i in range(30)), tuple(float(2 * i + 1) for i in range(30))]
    df = spark.createDataFrame(rows, spec.schema()).withColumn("id", F.monotonically_increasing_id())
    assert features.scaled_long(df, spec, ids=["id"]).count() == 60
    scaled = features.scaled_columns(df, spec.features)
    wide = features.radar(scaled, spec, ["id"], ["mean", "se", "worst"])
    assert "Exchange" not in wide._jdf.queryExecution().executedPlan().toString()
    assert wide.count() == 20
    assert "concave_points" in {r.measure for r in wide.collect()}
    assert {(r["mean"], r["se"], r["worst"]) for r in wide.collect()} == {(0.0, 0.0, 0.0), (1.0, 1.0, 1.0)}


@pytest.fixture(scope="module")
def fitted(spark):
    rng = random.Random(1)
    rows = [(x, y, int(x + y > 1.0)) for x, y in ((rng.random(), rng.random()) for _ in range(400))]
    df = spark.createDataFrame(rows, "a double, b double, label int")
    return model.train(df, SPEC), df


def test_score_adds_label_and_probabilities(spark, fitted):
    rows = model.score_rows(spark, [{"b": 0.9, "a": 0.9}, {"a": 0, "b": 0}, {"a": 0.1}], fitted[0], SPEC)
    assert rows.columns == ["a", "b", "predicted_label", "benign_probability", "malignant_probability"]
    found = rows.collect()
    assert sorted(r.predicted_label for r in found) == [0, 0, 1]
    assert all(r.benign_probability + r.malignant_probability == pytest.approx(1) for r in found)


@pytest.mark.parametrize("kind", ["minmax", "standard"])
def test_arithmetic_equals_the_stages(spark, kind):
    spec = FeatureSpec(("a", "b", "constant"), "label")
    rng = random.Random(8)
    rows = [(rng.random() * 100, rng.gauss(0, 1), 3.0, rng.randrange(2)) for _ in range(300)]
    schema = "a double, b double, constant double, label int"
    fitted = model.train(spark.createDataFrame(rows, schema), spec, scale_kind=kind)
    nan = float("nan")
    extra = [(None, 1.0, 3.0, 0), (nan, 1.0, 3.0, 0), (1.0, 1.0, nan, 0), (-1e9, 5.0, 4.0, 0), (1e9, None, None, 1)]
    df = spark.createDataFrame(rows + extra, schema).coalesce(1)
    ours, theirs = model.score(df, fitted, spec), model.score_by_stages(df, fitted, spec)
    assert ours.columns == theirs.columns and ours.dtypes == theirs.dtypes
    for a, b in zip(ours.collect(), theirs.collect(), strict=True):
        assert list(a)[:5] == pytest.approx(list(b)[:5], nan_ok=True)
        assert list(a)[5:] == pytest.approx(list(b)[5:], abs=1e-12, nan_ok=True)


def test_nan_scores_as_negative_with_nan_probability(spark, fitted):
    r = model.score_rows(spark, [(float("nan"), 0.9)], fitted[0], SPEC).first()
    assert r.predicted_label == 0 and math.isnan(r.malignant_probability)


def test_saved_model_keeps_its_feature_order(spark, fitted, tmp_path):
    path = str(tmp_path / "model")
    model.save_model(fitted[0], SPEC, path)
    model.save_model(fitted[0], SPEC, path)
    loaded, spec = model.load_model(path)
    assert spec == SPEC
    before = model.score(fitted[1], fitted[0], SPEC).sort("a", "b").collect()
    assert model.score(fitted[1], loaded, spec).sort("a", "b").collect() == before


def test_defaults_of_the_classifier(fitted):
    lr = fitted[0].stages[-1]
    assert (lr.getMaxIter(), lr.getRegParam(), lr.getFitIntercept(), lr.getThreshold()) == (10, 0.0, True, 0.5)


def test_splits(spark):
    df = spark.range(10_000).select((F.col("id") % 1000).alias("key"))
    for method in ("hash", "mod"):
        first, second = model.split(df, 0.8, key="key", method=method)
        assert first.count() + second.count() == 10_000
        assert first.join(second, "key").count() == 0
        assert 7_500 < first.count() < 8_500
    first, second = model.split(df.withColumn("key", F.lit(None).cast("bigint")), 0.8, key="key")
    assert (first.count(), second.count()) == (10_000, 0)
    first, second = model.split(df, 0.8)
    assert first.count() + second.count() == 10_000


def test_held_out_quality(spark, sf_dir):
    first, second = model.split(feature_table(spark, sf_dir), 0.8, key="l_orderkey")
    scored = model.score(second, model.train(first, LINE_SPEC), LINE_SPEC)
    found = {
        r.metric: r.value
        for r in evaluate.evaluate(scored, "label", "predicted_label", "malignant_probability").collect()
    }
    assert found["area_under_roc"] > 0.97 and found["accuracy"] > 0.9
    assert found["weighted_recall"] == pytest.approx(found["accuracy"])
    assert set(found) == {
        "accuracy", "weighted_precision", "weighted_recall", "precision", "recall", "specificity", "f1",
        "area_under_roc",
    }


@pytest.mark.parametrize("classes", [2, 3])
def test_metrics_equal_sparks_evaluators(spark, classes):
    rng = random.Random(classes)
    rows = [(float(rng.randrange(classes)), float(rng.randrange(2))) for _ in range(200)]
    df = spark.createDataFrame(rows, "label double, prediction double")
    found = evaluate.weighted_metrics(df).first()
    for ours, theirs in (
        ("accuracy", "accuracy"),
        ("weighted_precision", "weightedPrecision"),
        ("weighted_recall", "weightedRecall"),
    ):
        assert found[ours] == pytest.approx(MulticlassClassificationEvaluator(metricName=theirs).evaluate(df))


def test_undefined_metrics_are_null(spark):
    df = spark.createDataFrame([(0, 0), (0, None)], "label int, prediction int")
    r = evaluate.positive_metrics(df).first()
    assert (r.precision, r.recall, r.specificity, r.f1) == (None, None, 1.0, None)


def test_contributions_of_a_row(spark):
    df = spark.createDataFrame([(1, 0.5, 2.0)], "id int, a double, b double")
    found = features.row_contributions(df, {"a": 4.0, "b": -1.0}, ["id"]).collect()
    assert [(r.factor, r.contribution) for r in found] == [("a", 2.0), ("b", -2.0)]
