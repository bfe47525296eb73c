"""Datasets behind the charts; drawing is left to the reader's tool."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scorewatch.functions.columns import confidence


def points(
    df: DataFrame,
    axes: Sequence[str],
    color: str | None = None,
    sort: bool = False,
    fraction: float | None = None,
    seed: int = 42,
) -> DataFrame:
    """The columns of a two- or three-dimensional scatter, or of a line with ``sort``.

    For more points than a chart can draw, ``fraction`` takes a seeded sample, or use
    ``bins.histogram2d``.
    """
    chosen = df.select(*axes, *([color] if color else []))
    if fraction is not None:
        chosen = chosen.sample(fraction=fraction, seed=seed)
    return chosen.orderBy(*axes) if sort else chosen


def probability_timeline(
    df: DataFrame, ts: str, probabilities: Sequence[str], ids: Sequence[str] = ()
) -> DataFrame:
    """Class probabilities over time, one row per record and class."""
    return df.unpivot([*ids, ts], list(probabilities), "class", "probability")


def confidence_timeline(
    df: DataFrame, ts: str, label: str, probabilities: Column, ids: Sequence[str] = ()
) -> DataFrame:
    """Confidence in percent of the predicted class over time; records without a class are left out."""
    return df.filter(F.col(label).isin(0, 1)).select(
        *ids, ts, label, confidence(label, probabilities).alias("confidence")
    )


def feature_trend(
    df: DataFrame, ts: str, feature: str, label: str, grain: str | None = None
) -> DataFrame:
    """A feature over time per class, each record or the mean per ``grain``."""
    labeled = df.filter(F.col(label).isin(0, 1))
    if grain is None:
        return labeled.select(ts, label, feature)
    period = F.date_trunc(grain, ts).cast(dict(df.dtypes)[ts])
    return labeled.groupBy(period.alias(ts), label).agg(F.avg(feature).alias(feature))
