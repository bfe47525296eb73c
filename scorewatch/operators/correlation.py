"""Pearson correlation with pairwise deletion of missing values."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from itertools import combinations_with_replacement

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from scorewatch.functions.columns import nan_to_null

#: Rows, means, centred squares and centred products of a pair of columns, where both have values.
_MOMENTS = "a int, b int, n double, ma double, mb double, maa double, mbb double, mab double"
_FIELDS = ("n", "ma", "mb", "maa", "mbb", "mab")


def pair_correlation(x: Column | str, y: Column | str) -> Column:
    """Aggregate over the rows that have both values; null when either is constant there."""
    x, y = nan_to_null(x), nan_to_null(y)
    a, b = F.when(y.isNotNull(), x), F.when(x.isNotNull(), y)
    return F.try_divide(F.covar_pop(a, b), F.stddev_pop(a) * F.stddev_pop(b))


def _batch_moments(x: np.ndarray) -> dict[str, np.ndarray]:
    """Moments of all column pairs of one batch, as matrix products.

    Values are taken about the batch's own mean of their column, so that no sum of squares is much
    larger than what is left of it.
    """
    missing = np.isnan(x)
    there = (~missing).astype("float64")
    counts = there.sum(axis=0)
    centre = np.where(missing, 0.0, x).sum(axis=0) / np.maximum(counts, 1)
    x = np.where(missing, 0.0, x - centre)
    n = there.T @ there
    rows = np.maximum(n, 1)
    s, q, p = x.T @ there, (x * x).T @ there, x.T @ x
    return {
        "n": n,
        "ma": centre[:, None] + s / rows,
        "mb": centre[None, :] + s.T / rows,
        "maa": q - s * s / rows,
        "mbb": (q - s * s / rows).T,
        "mab": p - s * s.T / rows,
    }


def _merged(x: dict, y: dict, when_empty=np.maximum) -> dict:
    """Moments of two sets of rows together, from their counts and the distance of their means."""
    n = x["n"] + y["n"]
    rows = when_empty(n, 1)
    share, weight = y["n"] / rows, x["n"] * y["n"] / rows
    da, db = y["ma"] - x["ma"], y["mb"] - x["mb"]
    return {
        "n": n,
        "ma": x["ma"] + da * share,
        "mb": x["mb"] + db * share,
        "maa": x["maa"] + y["maa"] + da * da * weight,
        "mbb": x["mbb"] + y["mbb"] + db * db * weight,
        "mab": x["mab"] + y["mab"] + da * db * weight,
    }


def _task_moments(k: int):
    """One row per pair of k columns and task, also where a task has no rows."""

    def moments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = {f: np.zeros((k, k)) for f in _FIELDS}
        for batch in batches:
            x = np.column_stack([c.to_numpy(zero_copy_only=False) for c in batch.columns])
            found = _merged(found, _batch_moments(x.astype("float64")))
        a, b = np.triu_indices(k)
        pairs = {"a": a.astype("int32"), "b": b.astype("int32")}
        yield pa.RecordBatch.from_pydict(pairs | {f: found[f][a, b] for f in _FIELDS})

    return moments


def pair_moments(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(a, b, n, means, centred squares and products) of every pair of columns, by their numbers.

    One pass over the table: batches are merged in their task, and tasks, one row per pair each, in
    the order of their counts and means, with the same formula.
    """
    values = df.select(*[nan_to_null(c).cast("double").alias(f"c{i}") for i, c in enumerate(columns)])
    parts = values.mapInArrow(_task_moments(len(columns)), _MOMENTS)
    listed = parts.groupBy("a", "b").agg(F.sort_array(F.collect_list(F.struct(*_FIELDS))).alias("parts"))
    zero = F.struct(*[F.lit(0.0).alias(k) for k in _FIELDS])

    def add(x: Column, y: Column) -> Column:
        both = _merged({k: x[k] for k in _FIELDS}, {k: y[k] for k in _FIELDS}, lambda n, least: F.greatest(n, F.lit(float(least))))
        return F.struct(*[both[k].alias(k) for k in _FIELDS])

    return listed.select("a", "b", F.aggregate("parts", zero, add).alias("m")).select("a", "b", "m.*")


def _by_matrix(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    def spread(mean: str, squares: str) -> Column:
        # What is left of a constant column is rounding error.
        return F.when(F.col(squares) > F.col("n") * F.col(mean) * F.col(mean) * 1e-26, F.col(squares))

    r = F.try_divide(F.col("mab"), F.sqrt(spread("ma", "maa")) * F.sqrt(spread("mb", "mbb")))
    names = F.array(*[F.lit(c) for c in columns])
    return pair_moments(df, columns).select(
        F.get(names, F.col("a")).alias("a"), F.get(names, F.col("b")).alias("b"), r.alias("r")
    )


def corr_matrix(df: DataFrame, columns: Sequence[str], method: str = "matrix") -> DataFrame:
    """Upper triangle with the diagonal, in long form (a, b, r).

    ``matrix`` is one pass over Arrow batches whose moments are merged, at any number of columns;
    ``pairs`` is one JVM aggregation, for few columns. Both shuffle a few numbers per pair and task.
    """
    pairs = list(combinations_with_replacement(columns, 2))
    if method == "matrix":
        return _by_matrix(df, columns)
    if method != "pairs":
        raise ValueError(f"unknown method {method!r}")
    one = df.agg(*[pair_correlation(a, b).alias(f"r{i}") for i, (a, b) in enumerate(pairs)])
    rows = [
        F.struct(F.lit(a).alias("a"), F.lit(b).alias("b"), F.col(f"r{i}").alias("r"))
        for i, (a, b) in enumerate(pairs)
    ]
    return one.select(F.inline(F.array(*rows)))


def full_matrix(upper: DataFrame) -> DataFrame:
    """Both triangles from the upper one: two rows per pair, without reading the table again."""
    mirrored = F.when(
        F.col("a") != F.col("b"),
        F.array(F.struct("a", "b", "r"), F.struct(F.col("b").alias("a"), F.col("a").alias("b"), "r")),
    ).otherwise(F.array(F.struct("a", "b", "r")))
    return upper.select(F.inline(mirrored))


def label_correlation(df: DataFrame, columns: Sequence[str], label: str = "predicted_label") -> DataFrame:
    """Importance of features as |correlation| with the label, ranked, with the signed value."""
    with_label = _by_matrix(df, [*columns, label]).filter((F.col("b") == label) & (F.col("a") != label))
    signed = with_label.select(F.col("a").alias("feature"), F.col("r").alias("original_correlation"))
    long = signed.select("feature", F.abs("original_correlation").alias("correlation"), "original_correlation")
    # One row per feature here, so a window without a key is no bottleneck.
    strongest = Window.orderBy(F.desc_nulls_last("correlation"), "feature")
    return long.withColumn("rank", F.row_number().over(strongest)).orderBy("correlation", "feature")
