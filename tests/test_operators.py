"""Reports, counts, histograms, correlations and series on small frames."""

from datetime import datetime, timedelta

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from scorewatch.operators import bins, clean, correlation, counts, points, quality, series

NAN = float("nan")


def rows_of(df, *order):
    return [tuple(r) for r in (df.sort(*order) if order else df).collect()]


def test_missing_report(spark):
    df = spark.createDataFrame([(1.0, "x"), (NAN, None), (None, "y"), (2.0, "z")], "v double, s string")
    assert rows_of(quality.missing_report(df)) == [("v", 2, 50.0), ("s", 1, 25.0)]
    empty = quality.missing_report(df.limit(0))
    assert {(r.missing_count, r.missing_percent) for r in empty.collect()} == {(0, None)}


def test_missing_report_is_one_aggregate(spark):
    df = spark.createDataFrame([(1.0, "x")], "v double, s string")
    plan = quality.missing_report(df)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Aggregate") == 1


def test_feature_ranges_ignore_nan(spark):
    df = spark.createDataFrame([(1.0, None), (NAN, None), (3.0, None)], "a double, b double")
    assert rows_of(quality.feature_ranges(df, ["a", "b"]), "feature") == [
        ("a", 0.0, 3.0, 2.0),
        ("b", 0.0, None, None),
    ]


def test_clean(spark):
    df = spark.createDataFrame([(1, "M", 2.0, None)], "id int, diagnosis string, `concave points_mean` double, _c32 string")
    assert clean.normalize_names(df).columns[2] == "concave_points_mean"
    kept = clean.clean(df, ["id", "_c32", "Unnamed: 32"], {"concave points_mean": "concave_points_mean"})
    assert kept.columns == ["diagnosis", "concave_points_mean"]
    with pytest.raises(ValueError):
        clean.normalize_names(df.select(F.lit(1).alias("a b"), F.lit(2).alias("a_b")))


def test_fill_missing_leaves_nan_unless_asked(spark):
    df = spark.createDataFrame([(None, 1), (NAN, None)], "v double, n int").coalesce(1)
    assert str(rows_of(clean.fill_missing(df, ["v"]))) == "[(0.0, 1), (nan, None)]"
    assert rows_of(clean.fill_missing(df, ["v"], nan=True)) == [(0.0, 1), (0.0, None)]


def test_sample_does_not_depend_on_partitions(spark):
    df = spark.range(1000).withColumnRenamed("id", "key")
    one = rows_of(clean.sample_rows(df.coalesce(1), "key", 20), "key")
    many = rows_of(clean.sample_rows(df.repartition(7), "key", 20), "key")
    assert one == many and len(one) == 20
    assert one != rows_of(clean.sample_rows(df, "key", 20, seed=1), "key")


def test_label_counts_and_summary(spark):
    df = spark.createDataFrame([(0,), (1,), (1,), (None,)], "predicted_label int")
    assert rows_of(counts.label_counts(df, labels=(0, 1, 2)), "predicted_label") == [(0, 1), (1, 2), (2, 0)]
    assert rows_of(counts.summary(df)) == [(4, 1, 2, 1, 25.0, 50.0)]
    assert rows_of(counts.summary(df, rest_is_positive=True)) == [(4, 1, 3, 1, 25.0, 75.0)]
    assert rows_of(counts.summary(df.limit(0))) == [(0, 0, 0, 0, None, None)]


def test_histogram_edges(spark):
    rows = [(0.0,), (0.99,), (1.0,), (9.99,), (10.0,), (10.01,), (-0.01,), (None,), (NAN,)]
    df = spark.createDataFrame(rows, "v double")
    assert rows_of(bins.histogram(df, "v", bins=10, low=0, high=10), "bin") == [
        (-1, 1), (0, 2), (1, 1), (9, 2), (10, 1)
    ]
    found = bins.histogram(df.filter("v between 0 and 10"), "v", bins=10)
    assert rows_of(found, "bin") == [(0, 2), (1, 1), (9, 2)]
    constant = spark.createDataFrame([(4.0,), (4.0,)], "v double")
    assert rows_of(bins.histogram(constant, "v")) == [(0, 2)]
    assert rows_of(bins.histogram(df.limit(0), "v")) == []
    with pytest.raises(ValueError):
        bins.histogram(df, "v", bins=0)


def test_histogram2d_margins(spark):
    df = spark.createDataFrame([(0.0, 0.0), (0.0, 9.0), (9.0, 9.0), (None, 1.0)], "x double, y double")
    found = bins.histogram2d(df, "x", "y", 2, (0, 10), (0, 10))
    assert sorted(rows_of(found), key=str) == sorted(
        [
            (0, 0, "cell", 1),
            (0, 1, "cell", 1),
            (1, 1, "cell", 1),
            (0, None, "x_margin", 2),
            (1, None, "x_margin", 1),
            (None, 0, "y_margin", 1),
            (None, 1, "y_margin", 2),
        ],
        key=str,
    )


def test_bars(spark):
    rows = [("a", "r", 2.0), ("a", "g", -1.0), ("a", "r", 1.0), ("a", "b", 4.0)]
    df = spark.createDataFrame(rows, "x string, c string, y double")
    assert rows_of(counts.bar_table(df, "x", "y", "c", "stack"), "c") == [
        ("a", "b", 4.0, 0.0),
        ("a", "g", -1.0, 4.0),
        ("a", "r", 3.0, 3.0),
    ]
    relative = rows_of(counts.bar_table(df, "x", "y", "c", "relative"), "c")
    assert relative == [("a", "b", 4.0, 0.0), ("a", "g", -1.0, 0.0), ("a", "r", 3.0, 4.0)]
    with pytest.raises(ValueError):
        counts.bar_table(df, "x", "y", "c", "pile")


def test_hourly_pattern_fill(spark):
    rows = [(datetime(2024, 1, 1, 5), 0), (datetime(2024, 1, 2, 5), 0), (datetime(2024, 1, 1, 7), 1), (None, 1)]
    df = spark.createDataFrame(rows, "ts timestamp_ntz, predicted_label int")
    assert rows_of(counts.hourly_pattern(df), "hour") == [(5, 2, None), (7, None, 1)]
    assert rows_of(counts.hourly_pattern(df, fill=0), "hour") == [(5, 2, 0), (7, 0, 1)]


def test_percent_outside(spark):
    rows = [("hr", 50.0), ("hr", 100.0), ("hr", 101.0), ("hr", None), ("other", 1.0)]
    df = spark.createDataFrame(rows, "signal string, value double")
    found = counts.percent_outside(df, {"hr": (50, 100)}, "signal", "value")
    assert [(r.signal, round(r.percent_outside, 4)) for r in found.collect()] == [("hr", 33.3333)]


def test_contributions_add_up(spark):
    df = spark.createDataFrame([("hr", 40), ("bp", 30), ("age", 15), ("bmi", 15)], "f string, w int")
    assert {r.f: r.percent for r in counts.contributions(df, "f", "w").collect()} == {
        "hr": 40.0,
        "bp": 30.0,
        "age": 15.0,
        "bmi": 15.0,
    }


@pytest.mark.parametrize("method", ["pairs", "matrix"])
def test_correlation_equals_pandas(spark, method):
    rng = np.random.default_rng(3)
    x = rng.normal(1e6, 1.0, 200)
    pdf = pd.DataFrame({"a": x, "b": 2 * x + rng.normal(0, 1, 200), "c": rng.normal(0, 1, 200), "k": 5.0})
    pdf.loc[::7, "a"] = np.nan
    pdf.loc[::5, "c"] = np.nan
    df = spark.createDataFrame(pdf).repartition(3)
    expected = pdf.corr()
    found = {(r.a, r.b): r.r for r in correlation.corr_matrix(df, list(pdf), method).collect()}
    assert len(found) == 10
    for (a, b), r in found.items():
        if "k" in (a, b):
            assert r is None
        else:
            assert r == pytest.approx(expected.loc[a, b], abs=1e-8)


def test_correlation_of_known_rows(spark):
    rows = [(1.0, 2.0), (2.0, 1.0), (3.0, 5.0), (4.0, NAN), (None, 3.0)]
    df = spark.createDataFrame(rows, "x double, y double")
    for method in ("pairs", "matrix"):
        found = {(r.a, r.b): r.r for r in correlation.corr_matrix(df, ["x", "y"], method).collect()}
        assert found["x", "y"] == pytest.approx(pd.DataFrame(rows).corr().iloc[0, 1])


def test_correlation_does_not_depend_on_the_first_rows(spark):
    df = spark.range(0, 5000, numPartitions=4).selectExpr(
        "CASE WHEN id >= 2000 THEN 1.7e9 + id % 100 END AS a", "2.0 * (id % 100) AS c"
    )
    found = {(r.a, r.b): r.r for r in correlation.corr_matrix(df, ["a", "c"]).collect()}
    assert all(abs(r - 1.0) < 1e-9 for r in found.values())


def test_moments_merge_over_tasks_without_losing_digits(spark):
    """Values far from zero with a small spread, in many tasks, some of them without a row that has both."""
    rng = np.random.default_rng(4)
    x = 1e9 + rng.normal(size=3000)
    y = 2e9 - 0.5 * (x - 1e9) + rng.normal(size=3000)
    rows = [(float(a) if i % 7 else None, float(b) if i % 5 else None) for i, (a, b) in enumerate(zip(x, y))]
    rows += [(1e9, None)] * 50 + [(None, 2e9)] * 50 + [(None, None)] * 50
    df = spark.createDataFrame(rows, "x double, y double").repartition(13).sortWithinPartitions("x")
    both = np.array([r for r in rows if None not in r])
    m = {(r.a, r.b): r for r in correlation.pair_moments(df, ["x", "y"]).collect()}[0, 1]
    assert m.n == len(both) and (m.ma, m.mb) == pytest.approx(both.mean(axis=0), rel=1e-14)
    centred = both - both.mean(axis=0)
    assert m.maa == pytest.approx((centred[:, 0] ** 2).sum(), rel=1e-7)
    assert m.mab == pytest.approx((centred[:, 0] * centred[:, 1]).sum(), rel=1e-6)
    assert all(r.n == 0 for r in correlation.pair_moments(df.limit(0), ["x", "y"]).collect())


def test_wide_label_correlation_equals_the_narrow_one(spark):
    rng = np.random.default_rng(4)
    pdf = pd.DataFrame(rng.normal(0, 1, (100, 14)), columns=[f"f{i}" for i in range(14)])
    pdf["predicted_label"] = (pdf.f3 + pdf.f5 > 0).astype(int)
    df = spark.createDataFrame(pdf)
    wide = {r.feature: r for r in correlation.label_correlation(df, [f"f{i}" for i in range(14)]).collect()}
    narrow = {r.feature: r for r in correlation.label_correlation(df, ["f3", "f5"]).collect()}
    assert len(wide) == 14 and {wide["f3"]["rank"], wide["f5"]["rank"]} == {1, 2}
    for f in narrow:
        assert wide[f].original_correlation == pytest.approx(narrow[f].original_correlation)


def test_cumulative_counts(spark):
    t = [datetime(2024, 1, 1, 0, 0, i) for i in range(3)]
    rows = [(t[0], 0), (t[0], 0), (t[1], 1), (t[2], 0), (None, 0), (t[2], None)]
    df = spark.createDataFrame(rows, "ts timestamp_ntz, predicted_label int")
    expected = [(0, t[0], 2, 2), (0, t[2], 1, 3), (1, t[1], 1, 1)]
    for options in ({}, {"ranges": 2}, {"grain": "second"}):
        found = series.cumulative_counts(df, **options)
        assert rows_of(found.select("predicted_label", "ts", "n", "cumulative"), "predicted_label", "ts") == expected


def test_last_n_and_latest_break_ties_by_id(spark):
    t = datetime(2024, 1, 1)
    rows = [("a", t, 1), ("a", t, 2), ("a", t - timedelta(1), 3), ("b", t, 4)]
    df = spark.createDataFrame(rows, "k string, ts timestamp_ntz, id int")
    assert rows_of(series.last_n(df, 2, ["ts", "id"]).select("id"), "id") == [(2,), (4,)]
    assert rows_of(series.last_n(df, 1, ["ts", "id"], ["k"]).select("id"), "id") == [(2,), (4,)]
    assert rows_of(series.latest(df, ["ts", "id"]).select("id")) == [(4,)]
    assert rows_of(series.latest(df, ["ts", "id"], ["k"]).select("id"), "id") == [(2,), (4,)]
    assert rows_of(series.latest(df.limit(0), ["ts", "id"])) == []
    assert series.recent(df, 1, ["ts", "id"], ["k"]).collect() == [("b",)]


def test_last_n_per_hot_key_above_the_limit(spark):
    df = spark.range(6000).select(F.lit("hot").alias("k"), "id")
    found = series.last_n(df, 2500, ["id"], ["k"])
    assert found.agg(F.count("*"), F.min("id")).first() == (2500, 3500)


def test_since_compares_tuples(spark):
    t = datetime(2024, 1, 1)
    rows = [(t, 1), (t, 2), (t + timedelta(1), 0), (t - timedelta(1), 9)]
    df = spark.createDataFrame(rows, "ts timestamp_ntz, id int")
    assert rows_of(series.since(df, ["ts", "id"], [t, 1]).select("id"), "id") == [(0,), (2,)]


def test_recent_series(spark):
    t = datetime(2024, 1, 1, 12, 0, 30)
    rows = [
        ("p", "hr", t, 80.0),
        ("p", "hr", t - timedelta(seconds=10), 70.0),
        ("p", "bp", t - timedelta(minutes=59), 120.0),
        ("p", "hr", t - timedelta(minutes=60), 1.0),
        ("q", "bp", t - timedelta(days=9), 110.0),
        ("q", "xx", t - timedelta(days=9), 1.0),
    ]
    df = spark.createDataFrame(rows, "e string, s string, ts timestamp_ntz, v double")
    found = rows_of(series.recent_series(df, "e", "s", "ts", "v", ["hr", "bp"]), "e", "minute")
    minute = t.replace(second=0)
    assert found == [
        ("p", minute - timedelta(minutes=59), None, 120.0),
        ("p", minute, 75.0, None),
        ("q", minute - timedelta(days=9), None, 110.0),
    ]


def test_append_aligns_by_name(spark):
    old = spark.createDataFrame([(1, "x")], "a int, b string")
    new = spark.createDataFrame([("y", 2, 3.0)], "b string, a int, c double")
    assert rows_of(clean.append(old, new), "a") == [(1, "x", None), (2, "y", 3.0)]


def test_lookup_keeps_rows_without_a_match(spark):
    df = spark.createDataFrame([("a",), ("b",), (None,)], "k string")
    dim = spark.createDataFrame([("a", "A")], "k string, t string")
    found = clean.lookup_text(df, dim, "k", "t", "none")
    assert sorted(map(str, rows_of(found))) == ["('a', 'A')", "('b', 'none')", "(None, 'none')"]


def test_points_sample_is_seeded(spark):
    df = spark.range(1000).select("id", (F.col("id") * 2).alias("y"))
    first = rows_of(points.points(df, ["id", "y"], fraction=0.1), "id")
    assert first == rows_of(points.points(df, ["id", "y"], fraction=0.1), "id")
    assert 50 < len(first) < 200


def test_confidence_timeline_leaves_out_unlabeled(spark):
    df = spark.createDataFrame([(1, 1, 0.2, 0.8), (2, None, 0.5, 0.5)], "ts int, l int, p0 double, p1 double")
    assert rows_of(points.confidence_timeline(df, "ts", "l", F.array("p0", "p1"))) == [(1, 1, 80.0)]
