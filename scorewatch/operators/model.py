"""Training, saving and applying the classifier."""

from __future__ import annotations

from collections.abc import Sequence
from typing import Any

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import MinMaxScalerModel, StandardScalerModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from scorewatch.functions.columns import hash_share
from scorewatch.operators.clean import fill_missing
from scorewatch.operators.features import assembler, scaler
from scorewatch.sources.tables import from_rows
from scorewatch.spec import FeatureSpec


def split(
    df: DataFrame, train: float = 0.8, seed: int = 42, key: str | None = None, method: str = "hash"
) -> tuple[DataFrame, DataFrame]:
    """Training and test rows.

    With ``key`` a row's side depends on its key alone, so it does not change with the
    partitioning, and rows of one key stay together: by a hash, by an MD5 that other engines
    have too (``method="md5"``), or by the last digits of a number (``"mod"``). Without it,
    ``randomSplit`` sorts every partition.
    """
    if key is None:
        first, second = df.randomSplit([train, 1 - train], seed=seed)
        return first, second
    if method not in ("hash", "md5", "mod"):
        raise ValueError(f"unknown split method {method!r}")
    if method == "md5":
        number = hash_share(key, seed)
    else:
        number = F.xxhash64(F.col(key), F.lit(seed)) if method == "hash" else F.col(key)
    # A null key goes to the training side instead of vanishing from both.
    in_train = F.coalesce(F.pmod(number, F.lit(100)) < round(train * 100), F.lit(True))
    return df.filter(in_train), df.filter(~in_train)


def train(
    df: DataFrame,
    spec: FeatureSpec,
    max_iter: int = 10,
    scale_kind: str = "minmax",
    partitions: int | None = None,
) -> PipelineModel:
    """Fit assembler, scaler and logistic regression on the training rows only.

    The scaler never sees test rows, and the label is never a feature. The table is read as
    its files are split, or in the given number of ``partitions`` where those are few; the
    classifier keeps its own compact copy between iterations.
    """
    rows = df.select(*spec.features, spec.label)
    if partitions is not None:
        rows = rows.repartition(partitions)
    stages = [
        assembler(spec, "error"),
        scaler(scale_kind),
        LogisticRegression(featuresCol="scaled_features", labelCol=spec.label, maxIter=max_iter),
    ]
    return Pipeline(stages=stages).fit(rows)


def _scaled(model: MinMaxScalerModel | StandardScalerModel, spec: FeatureSpec) -> list[Column]:
    """The fitted scaler as column arithmetic, one column per feature."""
    if isinstance(model, StandardScalerModel):
        deviations = model.std.toArray()
        return [
            F.col(f) * F.lit(1.0 / float(d) if d > 0 else 0.0)
            for f, d in zip(spec.features, deviations, strict=True)
        ]
    columns = []
    bounds = zip(spec.features, model.originalMin.toArray(), model.originalMax.toArray(), strict=True)
    for f, low, high in bounds:
        if high == low:
            columns.append(F.when(F.isnan(f), F.col(f)).otherwise(0.5))
        else:
            columns.append((F.col(f) - F.lit(float(low))) * F.lit(1.0 / float(high - low)))
    return columns


def score(df: DataFrame, model: PipelineModel, spec: FeatureSpec) -> DataFrame:
    """Add label and both probabilities; the same function for batches and streams.

    The fitted scaler and classifier become column arithmetic with their numbers as
    literals, so that a row is scored in generated code and no vector is built.
    :func:`score_by_stages` gives the same through the stages.

    Null features count as 0.0. NaN passes through and gives NaN probabilities with label
    0, so keep such rows apart first (``functions.messages.parse_messages``).
    """
    _, fitted_scaler, classifier = model.stages
    weights = classifier.coefficients.toArray()
    terms = zip(_scaled(fitted_scaler, spec), weights, strict=True)
    margin = sum((c * F.lit(float(w)) for c, w in terms), F.lit(float(classifier.intercept)))
    filled = fill_missing(df, spec.features).withColumn("_margin", margin)
    p1 = F.lit(1.0) / (F.lit(1.0) + F.exp(-F.col("_margin")))
    scored = filled.withColumn("malignant_probability", p1)
    p1 = F.col("malignant_probability")
    # NaN is greater than any number in Spark, so it needs its own test.
    positive = ~F.isnan(p1) & (p1 > F.lit(float(classifier.getThreshold())))
    return scored.select(
        *df.columns,
        F.when(positive, 1).otherwise(0).alias("predicted_label"),
        (F.lit(1.0) - p1).alias("benign_probability"),
        "malignant_probability",
    )


def score_by_stages(df: DataFrame, model: PipelineModel, spec: FeatureSpec) -> DataFrame:
    """The same through the transform of every stage, for fitted stages of other kinds."""
    assembling = model.stages[0].copy()
    assembling.setHandleInvalid("keep")
    vectors = assembling.transform(fill_missing(df, spec.features))
    for stage in model.stages[1:]:
        vectors = stage.transform(vectors)
    p = vector_to_array("probability")
    return vectors.select(
        *df.columns,
        F.col("prediction").cast("int").alias("predicted_label"),
        F.get(p, F.lit(0)).alias("benign_probability"),
        F.get(p, F.lit(1)).alias("malignant_probability"),
    )


def score_rows(
    spark: SparkSession, rows: Sequence[Any], model: PipelineModel, spec: FeatureSpec
) -> DataFrame:
    """Score hand-made cases, any number in one job."""
    return score(from_rows(spark, rows, spec.schema()), model, spec)


def save_model(model: PipelineModel, spec: FeatureSpec, path: str) -> None:
    """Write the fitted stages, and the feature order beside them; an older model is replaced."""
    model.write().overwrite().save(f"{path}/stages")
    spark = SparkSession.active()
    spec_row = spark.createDataFrame([(spec.to_json(),)], "value string")
    spec_row.coalesce(1).write.mode("overwrite").text(f"{path}/spec")


def load_model(path: str) -> tuple[PipelineModel, FeatureSpec]:
    text = SparkSession.active().read.text(f"{path}/spec").first()
    return PipelineModel.load(f"{path}/stages"), FeatureSpec.from_json(text["value"])
