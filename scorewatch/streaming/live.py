"""Views of a stream that are kept up to date: totals, periods, newest rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from scorewatch.operators.series import last_n
from scorewatch.streaming.sinks import Sink
from scorewatch.streaming.tables import BatchTable


def live_counts(stream: DataFrame, label: str = "predicted_label") -> DataFrame:
    """Running total per label; the state is one row per label."""
    return stream.groupBy(label).agg(F.count(F.lit(1)).alias("n"))


def live_window(
    stream: DataFrame,
    ts: str,
    width: str = "5 seconds",
    watermark: str = "1 minute",
    label: str = "predicted_label",
) -> DataFrame:
    """Rows per period and label, by Spark's watermark. A period is written once the watermark has
    passed its end; rows that come later than that are dropped by Spark and counted in its progress
    events. :func:`window_sink` keeps open periods and late rows as well."""
    # A watermark needs a timestamp with zone.
    timed = stream.withColumn(ts, F.col(ts).cast("timestamp")).withWatermark(ts, watermark)
    return (
        timed.groupBy(F.window(ts, width).alias("_w"), label)
        .agg(F.count(F.lit(1)).alias("n"))
        .select(F.col("_w.start").alias("start"), F.col("_w.end").alias("end"), label, "n")
    )


def _span(watermark: str) -> Column:
    return F.expr(f"INTERVAL {watermark}")


def _window_tables(path: str) -> tuple[BatchTable, BatchTable]:
    def add_up(counts: DataFrame) -> DataFrame:
        keys = [c for c in counts.columns if c != "n"]
        return counts.groupBy(*keys).agg(F.sum("n").alias("n"))

    return BatchTable(f"{path}/counts", add_up), BatchTable(f"{path}/late", levels=3)


def window_sink(
    path: str, ts: str, width: str = "5 seconds", watermark: str = "1 minute", label: str = "predicted_label"
) -> Sink:
    """Rows per period and label, those of open periods too, and late rows by themselves.

    A period is closed once the newest time of all batches before is its end and ``watermark`` more,
    as with a watermark of Spark's. What comes for a closed period, or has no time, is written as it is
    to the late rows and not counted. Every batch adds its own counts to the table, which merges them;
    the newest time stands in its commit, so that a batch run again decides as it did.
    """
    counts, late = _window_tables(path)

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        seen = counts.last_commit(spark, before=batch_id).notes.get("newest")
        ts_type = batch.schema[ts].dataType
        mark = F.lit(seen).cast(ts_type)
        period = F.window(ts, width)
        # A window of a null time would drop the row.
        timed = batch.where(F.col(ts).isNotNull()).withColumn("_w", period)
        closed = F.coalesce(F.col("_w.end") <= mark - _span(watermark), F.lit(False))
        untimed = batch.where(F.col(ts).isNull())
        late.commit(timed.where(closed).drop("_w").unionByName(untimed), batch_id)
        found = timed.where(~closed).groupBy(F.col("_w.start").alias("start"), F.col("_w.end").alias("end"), label)
        newest = batch.agg(F.greatest(F.max(ts), mark).cast("string")).first()[0]
        notes = {"newest": newest, "watermark": watermark}
        counts.commit(found.agg(F.count(F.lit(1)).alias("n")), batch_id, notes)

    return write


def read_windows(spark: SparkSession, path: str) -> DataFrame:
    """(start, end, label, n, closed) of every period that has rows, as of the last batch."""
    counts, _ = _window_tables(path)
    notes = counts.last_commit(spark).notes
    summed = counts.merge(counts.read(spark))
    edge = F.lit(notes["newest"]).cast(summed.schema["end"].dataType) - _span(notes["watermark"])
    return summed.withColumn("closed", F.coalesce(F.col("end") <= edge, F.lit(False)))


def read_late(spark: SparkSession, path: str) -> DataFrame:
    """Rows that came after their period was closed, or without a time."""
    return _window_tables(path)[1].read(spark)


def table_sink(path: str) -> Sink:
    """Every result of a ``complete`` mode query; the one before it is kept, older ones go."""
    return lambda batch, batch_id: BatchTable(path).commit(batch, batch_id, replace=True)


def read_newest(spark: SparkSession, path: str) -> DataFrame:
    """The last complete result written by :func:`table_sink`."""
    return BatchTable(path).read(spark)


def _newest_table(path: str, n: int, order: Sequence[str], by: Sequence[str]) -> BatchTable:
    return BatchTable(path, lambda df: last_n(df, n, order, by))


def last_n_sink(path: str, n: int, order: Sequence[str], by: Sequence[str] = ()) -> Sink:
    """Keep the newest n rows per key.

    A batch writes its own n rows per key; generations are merged to n rows per key as they pile up,
    so that neither the table nor the number of its folders grows with the number of batches.
    """
    table = _newest_table(path, n, order, by)
    return lambda batch, batch_id: table.commit(last_n(batch, n, order, by), batch_id)


def read_last_n(
    spark: SparkSession, path: str, n: int, order: Sequence[str], by: Sequence[str] = ()
) -> DataFrame:
    table = _newest_table(path, n, order, by)
    return table.merge(table.read(spark))
