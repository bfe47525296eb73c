"""Counts, shares and bars. All are one aggregation with a map-side combine."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from scorewatch.functions.columns import share


def row_count(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("n"))


def label_counts(df: DataFrame, label: str = "predicted_label", labels: Sequence[int] = (0, 1)) -> DataFrame:
    """Rows per label, 0 for a label that does not occur; other labels are left out."""
    one = df.agg(*[F.count_if(F.col(label) == v).alias(f"n{i}") for i, v in enumerate(labels)])
    rows = [F.struct(F.lit(v).alias(label), F.col(f"n{i}").alias("n")) for i, v in enumerate(labels)]
    return one.select(F.inline(F.array(*rows)))


def summary(
    df: DataFrame,
    by: Sequence[str | Column] = (),
    label: str = "predicted_label",
    rest_is_positive: bool = False,
) -> DataFrame:
    """Total, negatives, positives, unlabeled, and both shares in percent.

    ``rest_is_positive`` counts every row that is not negative as positive, so that
    rows without a label fall there too.
    """
    counted = df.groupBy(*by).agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if(F.col(label) == 0).alias("negatives"),
        F.count_if(F.col(label) == 1).alias("positives"),
        F.count_if(F.col(label).isNull()).alias("unlabeled"),
    )
    if rest_is_positive:
        counted = counted.withColumn("positives", F.col("total") - F.col("negatives"))
    return counted.withColumns(
        {
            "negative_percent": share("negatives", "total"),
            "positive_percent": share("positives", "total"),
        }
    )


def category_share(df: DataFrame, column: str) -> DataFrame:
    """Rows per category and their percent of all rows."""
    counted = df.groupBy(column).agg(F.count(F.lit(1)).alias("n"))
    total = counted.agg(F.sum("n")).scalar()
    return counted.withColumn("percent", share("n", total))


def bar_table(df: DataFrame, x: str, y: str, color: str, mode: str = "group") -> DataFrame:
    """Sum of y per x and color, with where each bar starts.

    ``group`` and ``overlay`` bars start at 0; ``stack`` piles the colors of one x, and
    ``relative`` piles positive and negative sums apart.
    """
    if mode not in ("group", "overlay", "stack", "relative"):
        raise ValueError(f"unknown bar mode {mode!r}")
    bars = df.groupBy(x, color).agg(F.sum(y).alias("height"))
    if mode in ("group", "overlay"):
        return bars.withColumn("base", F.lit(0.0))
    # Both windows run over the summed bars: rows per x = number of colors.
    keys = [F.col(x)] if mode == "stack" else [F.col(x), F.col("height") < 0]
    below = Window.partitionBy(*keys).orderBy(color).rowsBetween(Window.unboundedPreceding, -1)
    return bars.withColumn("base", F.coalesce(F.sum("height").over(below), F.lit(0.0)))


def hourly_pattern(
    df: DataFrame,
    ts: str = "ts",
    label: str = "predicted_label",
    labels: Sequence[int] = (0, 1),
    fill: int | None = None,
) -> DataFrame:
    """Rows per hour of day, one column per label; an empty cell is null, or ``fill``.

    The labels are given, so neither a job to find them nor the second aggregation of a
    pivot is needed. Rows without a timestamp, and hours without any of the labels, are left out.
    """
    counted = (
        df.filter(F.col(ts).isNotNull() & F.col(label).isin(list(labels)))
        .groupBy(F.hour(ts).alias("hour"))
        .agg(*[F.count_if(F.col(label) == v).alias(f"label_{v}") for v in labels])
    )
    empty = F.lit(fill).cast("bigint")
    return counted.withColumns(
        {f"label_{v}": F.coalesce(F.nullif(F.col(f"label_{v}"), F.lit(0)), empty) for v in labels}
    )


def cohort_counts(df: DataFrame, dims: Sequence[str], totals: str | None = None) -> DataFrame:
    """Rows per combination of dimensions; ``totals`` may be "rollup" or "cube"."""
    cells = df.groupBy(*dims).agg(F.count(F.lit(1)).alias("n"))
    if totals is None:
        return cells
    if totals not in ("rollup", "cube"):
        raise ValueError(f"unknown totals {totals!r}")
    # The counted cells are expanded into the grouping sets, not the rows.
    grouped = cells.rollup(*dims) if totals == "rollup" else cells.cube(*dims)
    return grouped.agg(F.sum("n").alias("n"), F.grouping_id().alias("grouping_set"))


def percent_outside(
    df: DataFrame, ranges: Mapping[str, tuple[float, float]], signal: str, value: str
) -> DataFrame:
    """Percent of readings outside the normal range of their signal.

    Readings without a value, and signals without a range, do not count.
    """
    outside = reduce(
        lambda rest, s: F.when(
            F.col(signal) == s[0], ~F.col(value).between(float(s[1][0]), float(s[1][1]))
        ).otherwise(rest),
        ranges.items(),
        F.lit(None).cast("boolean"),
    )
    return (
        df.filter(F.col(signal).isin(list(ranges)) & F.col(value).isNotNull())
        .groupBy(signal)
        .agg((F.avg(outside.cast("int")) * 100).alias("percent_outside"))
    )


def contributions(df: DataFrame, factor: str, weight: str | Column) -> DataFrame:
    """Weight per factor in percent of all weight."""
    weight = F.col(weight) if isinstance(weight, str) else weight
    summed = df.groupBy(factor).agg(F.sum(weight).alias("weight"))
    total = summed.agg(F.sum("weight")).scalar()
    return summed.withColumn("percent", F.try_divide("weight", total) * 100)
