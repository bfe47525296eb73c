"""Streaming and bounded readers of message topics.

Every reader returns a binary or string column ``value`` beside whatever identifies
the message, so that a Kafka topic and a folder of text files are handled alike.
"""

from __future__ import annotations

from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from scorewatch.functions.messages import VALID, normalize_probability, parse_messages
from scorewatch.spec import FeatureSpec


def kafka_options(
    servers: str,
    topic: str,
    starting: str = "latest",
    fail_on_loss: bool = False,
    max_offsets: int | None = None,
) -> dict[str, str]:
    """Options of a Kafka stream source. The intake limit belongs here, not on the sink."""
    options = {
        "kafka.bootstrap.servers": servers,
        "subscribe": topic,
        "startingOffsets": starting,
        "failOnDataLoss": str(fail_on_loss).lower(),
    }
    if max_offsets is not None:
        options["maxOffsetsPerTrigger"] = str(max_offsets)
    return options


def read_stream(
    spark: SparkSession,
    kind: str = "kafka",
    path: str | None = None,
    fmt: str = "text",
    schema: T.StructType | str | None = None,
    max_files: int | None = None,
    glob: str | None = None,
    **kafka: Any,
) -> DataFrame:
    """A stream from ``kind="kafka"`` (see :func:`kafka_options`) or ``kind="files"``."""
    if kind == "kafka":
        return spark.readStream.format("kafka").options(**kafka_options(**kafka)).load()
    if kind != "files":
        raise ValueError(f"unknown stream kind {kind!r}")
    reader = spark.readStream.format(fmt)
    if schema is not None:
        reader = reader.schema(schema)
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    if glob is not None:
        reader = reader.option("pathGlobFilter", glob)
    return reader.load(path)


def read_topic(
    spark: SparkSession, servers: str, topic: str, starting: str = "earliest", ending: str = "latest"
) -> DataFrame:
    """A bounded batch read of a topic between two offsets: no polling and no time limit."""
    return (
        spark.read.format("kafka")
        .options(**{"kafka.bootstrap.servers": servers, "subscribe": topic})
        .options(startingOffsets=starting, endingOffsets=ending)
        .load()
    )


def message_id(df: DataFrame) -> DataFrame:
    """Add ``message_id``: topic, partition and offset, so that a replayed message keeps its id."""
    return df.withColumn(
        "message_id", F.concat_ws("-", "topic", F.col("partition"), F.col("offset"))
    )


def read_scored(
    messages: DataFrame, spec: FeatureSpec, value: str = "value", policy: str = "quarantine"
) -> DataFrame:
    """Scored messages, batch or stream: label, both probabilities, features.

    The probability may be a serialized vector, a list, or either as a string. Missing fields
    of a good message count as 0.0. ``quarantine`` adds ``is_valid`` and ``raw_value``: what is
    not a message (null, blank, junk, cut off, a field of the wrong type) has its text there and
    no label, probability or feature, so that it is not counted as a case. ``zero_fill`` makes
    such a message a case of zeros.
    """
    fields = [
        T.StructField("predicted_label", T.DoubleType(), True),
        T.StructField("prediction_probability", T.StringType(), True),
    ]
    parsed = parse_messages(messages, T.StructType(fields + spec.schema().fields), value, policy)
    pair = parsed.withColumn("_pair", normalize_probability("prediction_probability"))
    marks = [VALID, "raw_value"] if policy == "quarantine" else []

    def or_zero(c: Column) -> Column:
        filled = F.coalesce(c, F.lit(0.0))
        return F.when(F.col(VALID), filled) if marks else filled

    return pair.select(
        *[c for c in messages.columns if c != value],
        or_zero(F.col("predicted_label")).alias("predicted_label"),
        or_zero(F.get("_pair", F.lit(0))).alias("benign_probability"),
        or_zero(F.get("_pair", F.lit(1))).alias("malignant_probability"),
        *[or_zero(F.col(f)).alias(f) for f in spec.features],
        *marks,
    )
