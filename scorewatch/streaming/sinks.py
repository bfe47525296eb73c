"""Sinks for micro-batches. Each can be run again for the same batch without doubling rows,
and none hides an error: a batch that was not written is not committed."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from scorewatch.functions.messages import VALID
from scorewatch.operators.clean import with_processed_at
from scorewatch.sinks.tables import jdbc_write_options, write_jdbc
from scorewatch.spec import FeatureSpec
from scorewatch.streaming.score import SCORES, scored_message
from scorewatch.streaming.tables import BatchTable

Sink = Callable[[DataFrame, int], None]


def _valid(batch: DataFrame) -> DataFrame:
    return batch.filter(VALID) if VALID in batch.columns else batch


def write_batch(df: DataFrame, path: str, batch_id: int, partition_by: Sequence[str] = ()) -> None:
    """Write one batch to its own folder; a replay replaces what the first try left."""
    df.write.mode("overwrite").partitionBy(*partition_by).parquet(f"{path}/batch_id={batch_id}")


#: Folders merged this often hold FAN_IN ** 3 batches and are not rewritten any more.
HISTORY_LEVELS = 3


def append_table(path: str, partition_by: Sequence[str] = (), files: int | None = None) -> BatchTable:
    """A table that every batch adds rows to; small folders are merged as they pile up."""
    return BatchTable(path, partition_by=tuple(partition_by), levels=HISTORY_LEVELS, files=files)


def _append(table: BatchTable, rows: DataFrame, batch_id: int) -> None:
    table.commit(rows.withColumn("batch_id", F.lit(batch_id).cast("bigint")), batch_id)


def read_appended(spark: SparkSession, path: str) -> DataFrame:
    """What :func:`history_sink`, :func:`message_sink` or :func:`quarantine_sink` has committed."""
    return append_table(path).read(spark)


def history_sink(
    path: str, spec: FeatureSpec, keep: tuple[str, ...] = (), files: int | None = None
) -> Sink:
    """Scored rows with their processing time and batch, by day.

    ``files`` limits the files of a batch where short triggers would leave many small ones.
    """
    table = append_table(path, ["date"], files)

    def write(batch: DataFrame, batch_id: int) -> None:
        stamped = with_processed_at(_valid(batch)).withColumn("date", F.to_date("timestamp"))
        _append(table, stamped.select("timestamp", *keep, *SCORES, *spec.features, "date"), batch_id)

    return write


def message_sink(path: str, spec: FeatureSpec, keep: tuple[str, ...] = ()) -> Sink:
    """Scored messages as JSON text in files: what a results topic would hold."""

    def write(batch: DataFrame, batch_id: int) -> None:
        _append(append_table(path), scored_message(_valid(batch), spec, keep), batch_id)

    return write


def kafka_sink(servers: str, topic: str, spec: FeatureSpec) -> Sink:
    """Scored messages to a topic. Kafka takes a replayed batch twice, so the messages carry
    ``message_id`` as key when the batch has one; readers drop repeats by it."""

    def write(batch: DataFrame, batch_id: int) -> None:
        has_id = "message_id" in batch.columns
        messages = scored_message(_valid(batch), spec, ("message_id",) if has_id else ())
        if has_id:
            messages = messages.withColumnRenamed("message_id", "key")
        options = {"kafka.bootstrap.servers": servers, "topic": topic}
        messages.write.format("kafka").options(**options).save()

    return write


def jdbc_sink(
    url: str, table: str, spec: FeatureSpec, key: str = "message_id", **options: Any
) -> Sink:
    """Scored rows to a database table with columns ``batch_id`` and ``key``.

    A replay reads the keys already there for this batch and leaves those rows out. Put a
    unique constraint on the key column: it turns a task that is retried after its commit
    into an error, and the replay then sorts it out.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        rows = with_processed_at(_valid(batch)).select(
            F.lit(batch_id).cast("bigint").alias("batch_id"),
            key,
            "timestamp",
            *SCORES,
            *spec.features,
        )
        there = f"(SELECT {key} FROM {table} WHERE batch_id = {int(batch_id)}) written"
        read = jdbc_write_options(url, there, **options)
        written = batch.sparkSession.read.format("jdbc").options(**read).load()
        write_jdbc(rows.join(written.toDF(key), key, "left_anti"), url, table, **options)

    return write


def quarantine_sink(path: str, keep: tuple[str, ...] = ()) -> Sink:
    """Messages that could not be read, with their raw text and the time they were seen."""

    def write(batch: DataFrame, batch_id: int) -> None:
        bad = with_processed_at(batch.filter(~F.col(VALID)))
        _append(append_table(path), bad.select("timestamp", *keep, "raw_value"), batch_id)

    return write


def _triggered(writer, trigger: str | None):
    return writer.trigger(availableNow=True) if trigger is None else writer.trigger(processingTime=trigger)


def fan_out(
    stream: DataFrame,
    sinks: Mapping[str, Sink],
    checkpoint: str,
    trigger: str | None = "500 milliseconds",
    mode: str = "append",
) -> StreamingQuery:
    """One query into several sinks: the batch is read and scored once and kept for all.

    ``trigger=None`` works off what is there and stops. The number of rows in and out of a
    batch comes with the progress events, so no sink counts it again.
    """

    def write_all(batch: DataFrame, batch_id: int) -> None:
        kept = batch.persist()
        try:
            for write in sinks.values():
                write(kept, batch_id)
        finally:
            kept.unpersist()

    writer = stream.writeStream.outputMode(mode).option("checkpointLocation", checkpoint)
    return _triggered(writer.foreachBatch(write_all), trigger).start()


def write_stream(
    df: DataFrame,
    kind: str,
    checkpoint: str,
    trigger: str | None = "500 milliseconds",
    mode: str = "append",
    **options: str,
) -> StreamingQuery:
    """One query into a built-in sink: ``kafka`` (servers, topic) or a file format (path).

    The checkpoint folder belongs to this query alone and must outlive the driver.
    """
    if kind == "kafka":
        options = {"kafka.bootstrap.servers": options["servers"], "topic": options["topic"]}
    writer = df.writeStream.format(kind).outputMode(mode).options(**options)
    return _triggered(writer.option("checkpointLocation", checkpoint), trigger).start()
