"""Column expressions on edge rows."""

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from scorewatch.functions import columns as C
from scorewatch.functions.texts import MEASURE_TEXTS, NO_TEXT, STATISTIC_TEXTS, explain_feature
from scorewatch.spec import FeatureSpec, match_columns, tumour_spec

NAN = float("nan")


def values(spark, rows, schema, c):
    return [r[0] for r in spark.createDataFrame(rows, schema).coalesce(1).select(c).collect()]


def test_is_missing(spark):
    rows = [(1.0,), (None,), (NAN,)]
    assert values(spark, rows, "v double", C.is_missing("v", "double")) == [False, True, True]
    assert values(spark, [("x",), (None,)], "v string", C.is_missing("v", "string")) == [False, True]


def test_label_encodings_differ_on_unknown_text(spark):
    rows = [("M",), ("B",), ("?",), (None,)]
    assert values(spark, rows, "d string", C.encode_label("d", positive="M")) == [1, 0, 0, 0]
    coded = C.encode_label("d", mapping={"M": 1, "B": 0})
    assert values(spark, rows, "d string", coded) == [1, 0, None, None]
    with pytest.raises(ValueError):
        C.encode_label("d")


def test_decode_label_takes_null_as_negative(spark):
    rows = [(1,), (0,), (None,)]
    assert values(spark, rows, "l int", C.decode_label("l")) == ["Malignant", "Benign", "Benign"]


def test_confidence_needs_a_pair(spark):
    rows = [(1, [0.2, 0.8]), (0, [0.2, 0.8]), (None, [0.2, 0.8]), (1, [0.9]), (1, []), (1, None)]
    found = values(spark, rows, "l int, p array<double>", C.confidence("l", "p"))
    assert found == pytest.approx([80.0, 20.0, 20.0, 0.0, 0.0, 0.0])


def test_share_of_nothing_is_null(spark):
    rows = [(1, 3), (0, 0)]
    assert values(spark, rows, "n int, t int", C.share("n", "t")) == [33.3, None]


def test_clamp_keeps_missing(spark):
    rows = [(5.0,), (50.0,), (95.0,), (None,), (NAN,)]
    assert values(spark, rows, "a double", C.clamp("a", 18, 90)) == [18.0, 50.0, 90.0, None, None]


def test_bands_are_lower_inclusive(spark):
    rows = [(0.29,), (0.3,), (0.69,), (0.7,), (1.0,), (None,)]
    found = values(spark, rows, "r double", C.risk_band("r"))
    assert found == ["green", "yellow", "yellow", "red", "red", None]


def test_severity_is_strict(spark):
    rows = [(16.0,), (15.0,), (10.5,), (10.0,), (None,)]
    found = values(spark, rows, "p double", C.severity("p"))
    assert found == ["red", "orange", "orange", "yellow", None]


def test_age_groups(spark):
    rows = [(17,), (18,), (30,), (31,), (46,), (61,), (75,), (76,), (None,)]
    found = values(spark, rows, "a int", C.bucket("a"))
    assert found == [None, "18-30", "18-30", "31-45", "46-60", "61-75", "61-75", "76+", None]


def test_alert_and_delta(spark):
    rows = [(0.8,), (0.32,)]
    assert values(spark, rows, "r double", C.alert("r")) == [True, False]
    assert values(spark, rows, "r double", C.delta_from("r")) == pytest.approx([0.3, -0.18])


def test_rule_score(spark):
    rows = [(6.0, 5.0), (5.0, 5.0), (None, 11.0), (NAN, 3.0)]
    assert values(spark, rows, "a double, b double", C.rule_score(["a", "b"])) == [1, 0, 1, 0]


def test_body_mass_index(spark):
    rows = [(80.5, 175.0), (80.0, 0.0)]
    found = values(spark, rows, "w double, h double", F.round(C.body_mass_index("w", "h"), 1))
    assert found == [26.3, None]


def test_title(spark):
    assert values(spark, [("concave_points_mean",)], "f string", C.title("f")) == ["Concave Points Mean"]


def test_cohort_filter_is_inclusive_and_ends_at_now(spark):
    now = datetime(2024, 1, 2)
    rows = [
        (30, "F", now),
        (60, "F", now - timedelta(hours=24)),
        (61, "F", now),
        (40, "X", now),
        (40, "F", now - timedelta(hours=25)),
        (40, "F", now + timedelta(seconds=1)),
    ]
    df = spark.createDataFrame(rows, "age int, sex string, ts timestamp_ntz").coalesce(1)
    now_c = F.lit("2024-01-02 00:00:00").cast("timestamp_ntz")
    inside = C.in_cohort("age", 30, 60, {"sex": ["M", "F"]}, "ts", timedelta(hours=24), now_c)
    assert [r[0] for r in df.select(inside).collect()] == [True, True, False, False, False, False]
    all_time = C.in_cohort("age", 30, 60, {"sex": ["M", "F"]})
    assert df.filter(all_time).count() == 4


def test_explain_feature(spark):
    rows = [("concave_points_mean",), ("radius",), ("shape_mean",), ("area_worst",), (None,)]
    found = values(spark, rows, "f string", explain_feature("f"))
    mean = STATISTIC_TEXTS["mean"]
    assert found[:4] == [
        f"{MEASURE_TEXTS['concave_points']}. {mean}",
        f"{MEASURE_TEXTS['radius']}. ",
        f"{NO_TEXT}. {mean}",
        f"{MEASURE_TEXTS['area']}. {STATISTIC_TEXTS['worst']}",
    ]
    legacy = values(spark, rows[:2], "f string", explain_feature("f", legacy=True))
    assert legacy == [f"{NO_TEXT}. ", f"{MEASURE_TEXTS['radius']}. "]


def test_feature_spec():
    spec = tumour_spec()
    assert len(spec.features) == 30
    assert spec.features[:2] == ("radius_mean", "texture_mean")
    assert spec.features[-1] == "fractal_dimension_worst"
    assert len(spec.match(contains="mean")) == 10
    assert spec.match(endswith=("_se", "_worst"), exclude=["area_se"])[0] == "radius_se"
    assert match_columns(["id", "x_mean"], exclude=["id"]) == ["x_mean"]
    assert FeatureSpec.from_json(spec.to_json()) == spec
    with pytest.raises(ValueError):
        FeatureSpec(("a", "a"))
    with pytest.raises(ValueError):
        FeatureSpec(("a", "label"))
