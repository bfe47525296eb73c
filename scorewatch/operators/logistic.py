"""Logistic regression by Newton steps, each of which is one aggregation over the table.

A step needs the gradient and the Hessian at the coefficients so far: sums over rows of
(label - p) x and p (1 - p) x x'. Coefficients enter the plan as literals, the sums come to the
driver (a square of the number of features), and a small linear system is solved there. The
number of steps is fixed, so that another engine that takes the same steps gets the same
coefficients; they converge quadratically, and six to eight are enough.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from dataclasses import asdict, dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from scorewatch.functions.columns import nan_to_null
from scorewatch.operators.clean import fill_missing
from scorewatch.operators.features import fit_ranges
from scorewatch.session import stage
from scorewatch.spec import FeatureSpec


def _probability(margin: Column) -> Column:
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-margin))


@dataclass(frozen=True)
class LinearModel:
    """Min-max ranges of the training rows, and coefficients of the scaled features."""

    features: tuple[str, ...]
    low: tuple[float, ...]
    high: tuple[float, ...]
    weights: tuple[float, ...]
    intercept: float

    def scaled(self) -> list[Column]:
        """Scaled features; a column that was constant in training gives 0.5."""
        return [
            F.when(F.isnan(F.col(f).cast("double")), F.col(f)).otherwise(0.5) if low == high else (F.col(f) - F.lit(low)) / F.lit(high - low)
            for f, low, high in zip(self.features, self.low, self.high, strict=True)
        ]

    def margin(self) -> Column:
        terms = (c * F.lit(w) for c, w in zip(self.scaled(), self.weights, strict=True))
        return sum(terms, F.lit(self.intercept))

    def save(self, spark: SparkSession, path: str) -> None:
        """As one line of JSON; an older model is replaced."""
        row = spark.createDataFrame([(json.dumps(asdict(self)),)], "value string")
        row.coalesce(1).write.mode("overwrite").text(path)

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> LinearModel:
        read = json.loads(spark.read.text(path).first()["value"])
        return cls(**{k: tuple(v) if isinstance(v, list) else v for k, v in read.items()})


def _sums_by_columns(rows: DataFrame, model: LinearModel, label: str) -> tuple[np.ndarray, np.ndarray]:
    """Gradient and Hessian in one JVM aggregation; for tens of features at most."""
    k = len(model.features) + 1
    names = [f"x{i}" for i in range(1, k)]
    # Not so by matrix: a filter on many columns that are renamed later takes Spark's optimizer very
    # long, as it tries every name in every place.
    scaled = rows.na.drop().select(
        F.lit(1.0).alias("x0"),
        *[c.alias(n) for c, n in zip(model.scaled(), names, strict=True)],
        F.col(label).cast("double").alias("y"),
        _probability(model.margin()).alias("p"),
    )
    upper = [(i, j) for i in range(k) for j in range(i, k)]
    weight = F.col("p") * (1 - F.col("p"))
    found = scaled.agg(
        *[F.sum((F.col("y") - F.col("p")) * F.col(f"x{i}")).alias(f"g{i}") for i in range(k)],
        *[F.sum(weight * F.col(f"x{i}") * F.col(f"x{j}")).alias(f"h{i}_{j}") for i, j in upper],
    ).first()
    gradient, hessian = np.zeros(k), np.zeros((k, k))
    for i in range(k):
        gradient[i] = found[f"g{i}"] or 0.0
    for i, j in upper:
        hessian[i, j] = hessian[j, i] = found[f"h{i}_{j}"] or 0.0
    return gradient, hessian


def _sums_by_matrix(rows: DataFrame, model: LinearModel, label: str) -> tuple[np.ndarray, np.ndarray]:
    """The same from matrix products of Arrow batches, one row of sums per task and matrix row."""
    k = len(model.features) + 1
    beta = np.array([model.intercept, *model.weights])

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((k + 1, k))
        for batch in batches:
            columns = np.column_stack([c.to_numpy(zero_copy_only=False) for c in batch.columns]).astype("float64")
            columns = columns[~np.isnan(columns).any(axis=1)]
            x = np.column_stack([np.ones(len(columns)), columns[:, :-1]])
            p = 1.0 / (1.0 + np.exp(-(x @ beta)))
            total[0] += (columns[:, -1] - p) @ x
            total[1:] += (x * (p * (1 - p))[:, None]).T @ x
        yield pa.RecordBatch.from_pydict({"i": np.arange(k + 1, dtype=np.int32), "v": pa.array(total.tolist(), pa.list_(pa.float64()))})

    scaled = rows.select(*[c.cast("double").alias(f"x{i}") for i, c in enumerate(model.scaled())], F.col(label).cast("double").alias("y"))
    parts = scaled.mapInArrow(sums, "i int, v array<double>").select("i", F.posexplode("v").alias("j", "v"))
    total = np.zeros((k + 1, k))
    for r in parts.groupBy("i", "j").agg(F.sum("v").alias("v")).collect():
        total[r.i, r.j] = r.v
    return total[0], total[1:]


def gradient_of(df: DataFrame, model: LinearModel, label: str, ridge: float = 0.0) -> np.ndarray:
    """Gradient of the penalized likelihood at a model; zeros at its maximum."""
    gradient, _ = _sums_by_matrix(df, model, label)
    return gradient - ridge * np.array([model.intercept, *model.weights])


def fit_newton(
    df: DataFrame,
    spec: FeatureSpec,
    steps: int = 8,
    ridge: float = 0.0,
    method: str = "columns",
    partitions: int | None = None,
) -> LinearModel:
    """Fit on rows that have a label and all features, scaled by the ranges of all values.

    ``columns`` sums in generated code, ``matrix`` multiplies Arrow batches at any number of
    features. ``ridge`` keeps coefficients finite where the classes can be parted. Features and
    label are written once, so that a step reads no other column and repeats no other work;
    ``partitions`` deals them out where the table's files are few.
    """
    if method not in ("columns", "matrix"):
        raise ValueError(f"unknown method {method!r}")
    features = tuple(spec.features)
    rows = df.select(*features, spec.label)
    rows = stage(rows if partitions is None else rows.repartition(partitions), "training")
    ranges = fit_ranges(rows, features)
    if any(low is None for low, _ in ranges.values()):
        raise ValueError("a feature has no values")
    low, high = (tuple(float(ranges[f][k]) for f in features) for k in (0, 1))
    beta = np.zeros(len(features) + 1)
    model = LinearModel(features, low, high, tuple(beta[1:].tolist()), 0.0)
    for _ in range(steps):
        gradient, hessian = (_sums_by_columns if method == "columns" else _sums_by_matrix)(rows, model, spec.label)
        # A constant column beside the intercept leaves the system singular without a ridge.
        beta = beta + np.linalg.lstsq(hessian + ridge * np.eye(len(beta)), gradient - ridge * beta, rcond=None)[0]
        model = LinearModel(features, low, high, tuple(beta[1:].tolist()), float(beta[0]))
    return model


def score_linear(df: DataFrame, model: LinearModel, threshold: float = 0.5) -> DataFrame:
    """Add label and both probabilities in generated code. A missing feature counts as 0.0."""
    filled = fill_missing(df, model.features).withColumn("malignant_probability", _probability(model.margin()))
    p1 = F.col("malignant_probability")
    positive = ~F.isnan(p1) & (p1 > F.lit(threshold))
    return filled.select(
        *df.columns,
        F.when(positive, 1).otherwise(0).alias("predicted_label"),
        (F.lit(1.0) - p1).alias("benign_probability"),
        "malignant_probability",
    )
