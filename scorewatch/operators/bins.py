"""Histograms over one or two columns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scorewatch.functions.columns import nan_to_null


def _bounds(df: DataFrame, column: str) -> tuple[Column, Column]:
    """Smallest and largest value, as one scalar subquery of the same plan."""
    c = nan_to_null(column)
    both = df.agg(F.struct(F.min(c).alias("low"), F.max(c).alias("high"))).scalar()
    return both.getField("low"), both.getField("high")


def bin_of(
    df: DataFrame, column: str, bins: int, low: float | None = None, high: float | None = None
) -> Column:
    """Bin number from 0. The last bin holds the upper bound; values below the bounds are in
    bin -1, those above in bin ``bins``, and missing values get null.

    A column with a single value falls in bin 0. Bounds that are not given are found in
    the data.
    """
    if bins < 1:
        raise ValueError("bins must be at least 1")
    first, last = _bounds(df, column) if low is None or high is None else (None, None)
    lo = first if low is None else F.lit(float(low))
    hi = last if high is None else F.lit(float(high))
    c = nan_to_null(column)
    number = F.coalesce(F.try_divide(c - lo, (hi - lo) / F.lit(bins)), F.lit(0.0))
    inner = F.least(F.floor(number), F.lit(bins - 1)).cast("bigint")
    return F.when(c < lo, F.lit(-1)).when(c > hi, F.lit(bins)).when(c.isNotNull(), inner).cast("bigint")


def histogram(
    df: DataFrame,
    column: str,
    by: Sequence[str] = (),
    bins: int = 10,
    low: float | None = None,
    high: float | None = None,
    weight: str | None = None,
) -> DataFrame:
    """Rows (or the sum of ``weight``) per bin and group; missing values are left out."""
    counted = F.count(F.lit(1)).alias("n") if weight is None else F.sum(weight).alias("total")
    return (
        df.withColumn("bin", bin_of(df, column, bins, low, high))
        .filter(F.col("bin").isNotNull())
        .groupBy("bin", *by)
        .agg(counted)
    )


def histogram2d(
    df: DataFrame,
    x: str,
    y: str,
    bins: int = 10,
    x_range: tuple[float, float] | None = None,
    y_range: tuple[float, float] | None = None,
) -> DataFrame:
    """Rows per cell, with both margins, in one aggregation.

    A margin row has null for the axis it adds up; ``part`` says which it is.
    """
    binned = df.select(
        bin_of(df, x, bins, *(x_range or (None, None))).alias("x_bin"),
        bin_of(df, y, bins, *(y_range or (None, None))).alias("y_bin"),
    ).filter(F.col("x_bin").isNotNull() & F.col("y_bin").isNotNull())
    # Cells are counted first, so that each row is not expanded once per grouping set.
    cells = binned.groupBy("x_bin", "y_bin").agg(F.count(F.lit(1)).alias("_n"))
    summed = cells.groupingSets([["x_bin", "y_bin"], ["x_bin"], ["y_bin"]], "x_bin", "y_bin").agg(
        F.sum("_n").alias("n"), F.grouping_id().alias("_set")
    )
    part = F.when(F.col("_set") == 0, "cell").when(F.col("_set") == 1, "x_margin").otherwise("y_margin")
    return summed.select("x_bin", "y_bin", part.alias("part"), "n")
