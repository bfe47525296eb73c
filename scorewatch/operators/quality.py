"""Missing-value report and feature ranges, one pass over the table each."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scorewatch.functions.columns import is_missing, nan_to_null


def long_form(one_row: DataFrame, key: str, entries: dict[str, dict[str, Column]]) -> DataFrame:
    """One row per entry from a one-row aggregate: ``key``, then the named columns."""
    rows = [
        F.struct(F.lit(name).alias(key), *[c.alias(n) for n, c in columns.items()])
        for name, columns in entries.items()
    ]
    return one_row.select(F.inline(F.array(*rows)))


def missing_report(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Missing count and percent per column, most missing first; percent null on no rows."""
    types = dict(df.dtypes)
    columns = list(columns or df.columns)
    one = df.agg(
        F.count(F.lit(1)).alias("_rows"),
        *[F.count_if(is_missing(c, types[c])).alias(c) for c in columns],
    )
    long = long_form(
        one,
        "column",
        {
            c: {
                "missing_count": F.col(c),
                "missing_percent": F.try_divide(F.col(c), F.col("_rows")) * 100,
            }
            for c in columns
        },
    )
    return long.orderBy(F.desc("missing_percent"), "column")


def feature_ranges(df: DataFrame, columns: Sequence[str], low: float = 0.0) -> DataFrame:
    """Input range and mean per feature: fixed lower bound, largest value, mean."""
    one = df.agg(
        *[F.max(nan_to_null(c)).alias(f"{c}_max") for c in columns],
        *[F.avg(nan_to_null(c)).alias(f"{c}_avg") for c in columns],
    )
    return long_form(
        one,
        "feature",
        {
            c: {"low": F.lit(low), "high": F.col(f"{c}_max"), "mean": F.col(f"{c}_avg")}
            for c in columns
        },
    )
