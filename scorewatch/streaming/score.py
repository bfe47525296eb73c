"""Scoring a stream of messages with the function that scores batches."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scorewatch.functions.messages import VALID, parse_messages, to_message
from scorewatch.operators.model import score
from scorewatch.spec import FeatureSpec

SCORES = ("predicted_label", "benign_probability", "malignant_probability")


def score_stream(
    stream: DataFrame,
    spec: FeatureSpec,
    model: PipelineModel,
    value: str = "value",
    policy: str = "quarantine",
) -> DataFrame:
    """Parse, fill, scale and score messages; works on batches as well.

    Under ``quarantine`` every message stays in the result: a bad one has ``is_valid``
    false, its raw text, and no score. Under ``zero_fill`` it is scored as a case of zeros.
    """
    scored = score(parse_messages(stream, spec.schema(), value, policy), model, spec)
    if policy == "zero_fill":
        return scored
    return scored.withColumns({c: F.when(F.col(VALID), F.col(c)) for c in SCORES})


def scored_message(scored: DataFrame, spec: FeatureSpec, keep: tuple[str, ...] = ()) -> DataFrame:
    """One JSON ``value`` per scored record: features, label, and the probability pair."""
    pair = F.array("benign_probability", "malignant_probability")
    return scored.select(
        *keep,
        to_message(
            [
                *spec.features,
                F.col("predicted_label").cast("double").alias("predicted_label"),
                pair.alias("prediction_probability"),
            ]
        ).alias("value"),
    )
