"""Ordered work against brute force, on skewed data and any number of partitions."""

import random
from datetime import date, datetime

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from scorewatch.operators import evaluate, quantiles, series
from scorewatch.operators.ordered import dealt, previous_row, running_sums


def skewed_rows(seed, n=600):
    """One key with two thirds of the rows, one time with a third, null keys and null times."""
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        key = rng.choice(["hot", "hot", "hot", "hot", "b", None])
        ts = 50 if rng.random() < 0.34 else rng.choice([None, *range(100)])
        rows.append((key, ts, i, rng.randint(0, 9)))
    rng.shuffle(rows)
    return rows


def frame(spark, rows):
    return spark.createDataFrame(rows, "key string, ts int, id int, v int").repartition(5)


def ordered(rows):
    """Rows per key in window order: null times first."""
    by_key = {}
    for r in sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0, r[2])):
        by_key.setdefault(r[0], []).append(r)
    return by_key


@pytest.mark.parametrize("ranges", [None, 2, 7, 100])
@pytest.mark.parametrize("seed", [1, 2])
def test_running_sums(spark, ranges, seed):
    rows = skewed_rows(seed)
    df = frame(spark, rows)
    found = running_sums(df, ["key"], ["ts", "id"], {"seen": "v"}, {"all": "v"}, ranges)
    expected = {}
    for group in ordered(rows).values():
        total = 0
        for r in group:
            total += r[3]
            expected[r[2]] = (total, sum(x[3] for x in group))
    assert {r.id: (r.seen, r["all"]) for r in found.collect()} == expected


@pytest.mark.parametrize("ranges", [None, 2, 7, 100])
@pytest.mark.parametrize("seed", [3, 4])
def test_previous_row(spark, ranges, seed):
    rows = skewed_rows(seed)
    df = frame(spark, rows)
    found = previous_row(df, ["key"], ["ts", "id"], ["id", "ts"], "before", ranges)
    expected = {}
    for group in ordered(rows).values():
        for before, r in zip([None, *group], group):
            expected[r[2]] = before and (before[2], before[1])
    assert {r.id: r.before and tuple(r.before) for r in found.collect()} == expected


def test_a_hot_value_is_cut_by_its_tiebreak(spark):
    df = spark.range(10_000).select(F.lit(1).alias("ts"), F.col("id"))
    parts = dealt(df, [], ["ts", "id"], 20).groupBy("_ordered_part").count().collect()
    assert len(parts) >= 19 and max(r["count"] for r in parts) < 1500


@pytest.mark.parametrize("ranges", [None, 9])
def test_a_key_of_most_rows_beside_keys_that_just_fit(spark, ranges):
    """One key of 90 %; keys of about one partition's rows; keys of one row; all in one path."""
    keys = ["hot"] * 9000 + ["fit"] * 500 + ["next"] * 499 + ["a"]
    df = spark.createDataFrame([(k, i, 1) for i, k in enumerate(keys)], "key string, id int, one int").repartition(7)
    found = running_sums(df, ["key"], ["id"], {"n": "one"}, {"all": "one"}, ranges)
    starts = {"hot": 0, "fit": 9000, "next": 9500, "a": 9999}
    assert all((r.n, r["all"]) == (r.id - starts[r.key] + 1, keys.count(r.key)) for r in found.collect())
    before = previous_row(df, ["key"], ["id"], ["id"], "before", ranges)
    assert all((r.before and r.before.id) == (r.id - 1 if r.id > starts[r.key] else None) for r in before.collect())
    # No window over a whole key: each sorts within one partition of the dealt rows.
    assert "hashpartitioning(_ordered_part" in found._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize(
    ("dtype", "values"),
    [
        ("double", [float("nan")] * 40 + [None] * 40 + [float("-inf"), float("inf")] * 5 + [0.5, -2.0] * 20),
        ("string", ["a", "b", None, "c", "a"] * 20),
        ("timestamp_ntz", [datetime(2024, 3, 31, h, 30, 0, us) for h in range(5) for us in range(20)]),
        ("timestamp", [datetime(2024, 1, 1, 0, 0, 0, us % 3) for us in range(100)]),
        ("date", [date(2024, 1, 1 + d % 9) for d in range(100)]),
        ("double", [float("nan")] * 50),
        ("bigint", [2**60 + i % 4 for i in range(80)]),
    ],
)
@pytest.mark.parametrize("ranges", [3, 40])
def test_every_order_type(spark, dtype, values, ranges):
    """The split form numbers rows as a plain window does, whatever the type of the order."""
    df = spark.createDataFrame([(v, i, 1) for i, v in enumerate(values)], f"o {dtype}, id int, one int")
    df = df.repartition(3)
    order = ["o", "id"]
    cut = running_sums(df, [], order, {"rank": "one"}, ranges=ranges)
    plain = df.withColumn("rank", F.row_number().over(Window.orderBy(*order)))
    assert {r.id: r["rank"] for r in cut.collect()} == {r.id: r["rank"] for r in plain.collect()}


@pytest.mark.parametrize("ranges", [None, 4])
def test_empty_tables(spark, ranges):
    df = spark.range(0)
    assert running_sums(df, [], ["id"], {"s": "id"}, ranges=ranges).count() == 0
    assert previous_row(df, ["id"], ["id"], ["id"], ranges=ranges).count() == 0


@pytest.mark.parametrize("ranges", [None, 5])
def test_dedup_consecutive(spark, ranges):
    rows = [(i, t) for i, t in enumerate([5, 5, None, None, 7, 5, 5, 5, 8])]
    df = spark.createDataFrame(rows, "id int, ts int")
    found = series.dedup_consecutive(df, "ts", ["id"], ranges=ranges)
    assert sorted(r.id for r in found.collect()) == [0, 2, 4, 5, 8]


@pytest.mark.parametrize("ranges", [None, 6])
def test_with_delta(spark, ranges):
    rows = [("a", i, float(i * i)) for i in range(40)] + [("b", 3, 1.0), ("b", 4, None)]
    df = spark.createDataFrame(rows, "key string, t int, v double")
    found = series.with_delta(df, ["key"], ["t"], "v", ranges=ranges).collect()
    deltas = {(r.key, r.t): r.delta for r in found}
    assert deltas["a", 0] is None and deltas["a", 10] == 19.0
    assert deltas["b", 3] is None and deltas["b", 4] is None


@pytest.mark.parametrize("ranges", [None, 4])
def test_capped_path_equals_the_loop(spark, ranges):
    rng = random.Random(9)
    steps = [rng.uniform(0.02, 0.1) for _ in range(24)]
    df = spark.createDataFrame(list(enumerate(steps)), "hour int, step double")
    found = series.capped_cumsum(df, [], ["hour"], "step", 0.32, ranges=ranges)
    risk, expected = 0.32, []
    for s in steps:
        risk = min(1.0, risk + s)
        expected.append(risk)
    assert [r.risk for r in found.sort("hour").collect()] == pytest.approx(expected)


def test_capped_path_rejects_negative_steps(spark):
    df = spark.createDataFrame([(0, 0.1), (1, -0.1)], "hour int, step double")
    with pytest.raises(Exception, match="must not be negative"):
        series.capped_cumsum(df, [], ["hour"], "step", 0.3).collect()


@pytest.mark.parametrize("ranges", [None, 3])
@pytest.mark.parametrize(
    "values",
    [[1.0], [1.0, 2.0], [3.0, 1.0, 2.0, 2.0, 2.0, 9.0, 40.0], [5.0] * 6, [float(x) for x in range(101)]],
)
def test_box_stats(spark, values, ranges):
    import numpy as np

    rows = [("g", v) for v in values] + [("g", None), ("g", float("nan")), ("empty", None)]
    df = spark.createDataFrame(rows, "g string, v double")
    found = quantiles.box_stats(df, "v", ["g"], ranges).collect()
    assert [r.g for r in found] == ["g"]
    q1, median, q3 = np.quantile(values, [0.25, 0.5, 0.75])
    inside = [v for v in values if q1 - 1.5 * (q3 - q1) <= v <= q3 + 1.5 * (q3 - q1)]
    r = found[0]
    assert (r.n, r.q1, r.median, r.q3) == pytest.approx((len(values), q1, median, q3))
    assert (r.whisker_low, r.whisker_high) == (min(inside), max(inside))
    assert r.outliers == len(values) - len(inside)


def test_approximate_quantiles_stay_near(spark):
    df = spark.range(1, 10_001).select(F.lit("g").alias("g"), F.col("id").cast("double").alias("v"))
    r = quantiles.approximate_quantiles(df, "v", ["g"]).first()
    assert r.n == 10_000 and abs(r.median - 5000) <= 2


@pytest.mark.parametrize("ranges", [None, 4])
def test_area_equals_sparks_evaluator(spark, ranges):
    from pyspark.ml.evaluation import BinaryClassificationEvaluator

    rng = random.Random(5)
    rows = [(int(rng.random() < s), s) for s in (round(rng.random(), 2) for _ in range(500))]
    df = spark.createDataFrame(rows, "label int, score double")
    ours = evaluate.area_under_roc(df, ranges=ranges).first().area_under_roc
    theirs = BinaryClassificationEvaluator(
        rawPredictionCol="score", labelCol="label", metricName="areaUnderROC", numBins=0
    ).evaluate(df.withColumn("label", F.col("label").cast("double")))
    assert ours == pytest.approx(theirs)


def test_area_of_one_class_is_null(spark):
    df = spark.createDataFrame([(1, 0.2), (1, 0.4)], "label int, score double")
    assert evaluate.area_under_roc(df).first().area_under_roc is None


def test_roc_curve_bins_and_missing_rows(spark):
    rows = [(1, 0.91), (0, 0.95), (1, 0.2), (None, 0.5), (1, float("nan")), (0, 0.21)]
    df = spark.createDataFrame(rows, "label int, score double")
    exact = evaluate.roc_curve(df).sort("threshold").collect()
    assert [r.threshold for r in exact] == [0.2, 0.21, 0.91, 0.95]
    assert (exact[0].tpr, exact[0].fpr) == (1.0, 1.0)
    binned = evaluate.roc_curve(df, bins=10).sort("threshold").collect()
    assert [(r.threshold, r.true_positives, r.false_positives) for r in binned] == [(0.2, 2, 2), (0.9, 1, 1)]
