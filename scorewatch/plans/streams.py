"""Streams over the events table, worked off to the end and read back from what they wrote."""

from __future__ import annotations

from pyspark.sql import functions as F

from scorewatch.functions.messages import to_message
from scorewatch.operators import model
from scorewatch.plans.registry import SCORED_SQL, query, r6, scored_events, table
from scorewatch.session import scratch_folder
from scorewatch.sources.streams import read_scored, read_stream
from scorewatch.spec import FeatureSpec
from scorewatch.streaming import live
from scorewatch.streaming.monitor import ProgressLog, totals_of, wait_for
from scorewatch.streaming.score import score_stream, scored_message
from scorewatch.streaming.sinks import (
    fan_out,
    history_sink,
    message_sink,
    quarantine_sink,
    read_appended,
    write_stream,
)

STREAM_SPEC = FeatureSpec(("value", "k"), "predicted_label")


def _scored_stream(spark, sf_dir):
    """The events table read as a stream, with the columns of a scored record."""
    schema = table(spark, sf_dir, "events").schema
    events = read_stream(spark, "files", sf_dir, "parquet", schema, glob="events.parquet")
    return events.withColumn("predicted_label", F.when(F.col("value") > 30, 1).otherwise(0))


def _messages(events):
    """Flat messages; every ninth is cut off in the middle."""
    k = F.regexp_extract("props", "[0-9]+", 0).cast("double").alias("k")
    text = to_message(["value", k])
    value = F.when(F.col("event_id") % 9 == 0, F.substring(text, 1, 8)).otherwise(text)
    return events.select("event_id", value.alias("value"))


def _model(spark, sf_dir):
    return model.train(scored_events(spark, sf_dir), STREAM_SPEC)


def _fan_out(spark, sf_dir, *wanted):
    root = scratch_folder(spark, "fan-out")
    fitted = _model(spark, sf_dir)
    scored = score_stream(_messages(_scored_stream(spark, sf_dir)), STREAM_SPEC, fitted)
    sinks = {
        "history": history_sink(f"{root}/history", STREAM_SPEC, ("event_id",)),
        "messages": message_sink(f"{root}/messages", STREAM_SPEC, ("event_id",)),
        "quarantine": quarantine_sink(f"{root}/quarantine", ("event_id",)),
    }
    chosen = {n: sinks[n] for n in wanted}
    wait_for([fan_out(scored, chosen, f"{root}/checkpoint", trigger=None)])
    return root, fitted


@query(
    "stream_parsed_messages",
    f"SELECT event_id, value, k FROM {SCORED_SQL} WHERE event_id % 9 <> 0",
)
def stream_parsed_messages(spark, sf_dir):
    """Feature values of the history that the scoring stream wrote beside two other sinks: every
    good message, once."""
    root, _ = _fan_out(spark, sf_dir, "history", "messages", "quarantine")
    return read_appended(spark, f"{root}/history").select("event_id", "value", "k")


@query(
    "stream_equals_batch",
    f"""SELECT count(*) AS rows, count(*) AS same FROM {SCORED_SQL} WHERE event_id % 9 <> 0""",
)
def stream_equals_batch(spark, sf_dir):
    """Scores of the stream beside the scores of the same rows as a batch."""
    root, fitted = _fan_out(spark, sf_dir, "history")
    by_stream = read_appended(spark, f"{root}/history").select(
        "event_id", "predicted_label", F.col("malignant_probability").alias("p_stream")
    )
    batch = scored_events(spark, sf_dir).select("event_id", "value", "k").filter("event_id % 9 <> 0")
    by_batch = model.score(batch, fitted, STREAM_SPEC).select(
        "event_id", F.col("predicted_label").alias("in_batch"), "malignant_probability"
    )
    same = (F.col("predicted_label") == F.col("in_batch")) & (
        F.col("p_stream") == F.col("malignant_probability")
    )
    both = by_stream.join(by_batch, "event_id", "full")
    return both.agg(F.count(F.lit(1)).alias("rows"), F.count_if(same).alias("same"))


@query(
    "stream_quarantine",
    """SELECT event_id, substr('{"value":' || CAST(value AS VARCHAR), 1, 8) AS raw_value
       FROM events WHERE event_id % 9 = 0""",
)
def stream_quarantine(spark, sf_dir):
    root, _ = _fan_out(spark, sf_dir, "quarantine")
    return read_appended(spark, f"{root}/quarantine").select("event_id", "raw_value")


@query("stream_scored_messages")
def stream_scored_messages(spark, sf_dir):
    """Messages of the results topic, parsed again."""
    root, _ = _fan_out(spark, sf_dir, "messages")
    sent = read_appended(spark, f"{root}/messages").select("event_id", "value")
    return read_scored(sent, STREAM_SPEC)


@query("stream_file_sink")
def stream_file_sink(spark, sf_dir):
    """Scored messages through the built-in text sink."""
    root = scratch_folder(spark, "text-sink")
    fitted = _model(spark, sf_dir)
    clean = _messages(_scored_stream(spark, sf_dir))
    messages = scored_message(
        score_stream(clean, STREAM_SPEC, fitted, policy="zero_fill"), STREAM_SPEC
    )
    sink = write_stream(messages, "text", f"{root}/checkpoint", None, path=f"{root}/out")
    wait_for([sink])
    return read_scored(spark.read.text(f"{root}/out"), STREAM_SPEC)


@query(
    "live_counts",
    f"SELECT predicted_label, count(*) AS n FROM {SCORED_SQL} GROUP BY 1",
)
def live_counts(spark, sf_dir):
    root = scratch_folder(spark, "live-counts")
    totals = live.live_counts(_scored_stream(spark, sf_dir))
    sinks = {"table": live.table_sink(f"{root}/out")}
    wait_for([fan_out(totals, sinks, f"{root}/checkpoint", None, "complete")])
    return live.read_newest(spark, f"{root}/out")


_HOUR_SQL = "date_trunc('hour', ts)"


@query(
    "live_window",
    f"""SELECT {_HOUR_SQL} AS start, {_HOUR_SQL} + INTERVAL 1 HOUR AS "end", predicted_label, count(*) AS n,
          {_HOUR_SQL} + INTERVAL 1 HOUR <= (SELECT max(ts) FROM events) - INTERVAL 10 MINUTE AS closed
        FROM {SCORED_SQL} GROUP BY ALL""",
)
def live_window(spark, sf_dir):
    """Every period, those still open when the stream ends too."""
    root = scratch_folder(spark, "live-window")
    sinks = {"periods": live.window_sink(f"{root}/out", "ts", "1 hour", "10 minutes")}
    wait_for([fan_out(_scored_stream(spark, sf_dir), sinks, f"{root}/checkpoint", trigger=None)])
    return live.read_windows(spark, f"{root}/out")


#: Files that the events arrive in: by time, but for every 50th, which comes with the last one.
ARRIVALS = 6


def _arriving(spark, sf_dir, root):
    """The events as a stream of files, one a batch; some rows arrive long after their time."""
    events = table(spark, sf_dir, "events")
    first, last = events.agg(F.min("ts"), F.max("ts")).first()
    share = (F.unix_micros(F.col("ts").cast("timestamp")) - F.unix_micros(F.lit(first).cast("timestamp"))) / (
        max(1.0, (last - first).total_seconds()) * 1e6
    )
    at = F.least(F.lit(ARRIVALS - 1), F.floor(share * ARRIVALS))
    at = F.when(F.col("event_id") % 50 == 0, ARRIVALS - 1).otherwise(at)
    for k in range(ARRIVALS):
        events.where(at == k).coalesce(1).write.parquet(f"{root}/in/part={k}")
    stream = read_stream(spark, "files", f"{root}/in/part=*", "parquet", events.schema, max_files=1)
    return stream.withColumn("predicted_label", F.when(F.col("value") > 30, 1).otherwise(0))


def _arrived_windows(spark, sf_dir):
    root = scratch_folder(spark, "live-arrivals")
    sinks = {"periods": live.window_sink(f"{root}/out", "ts", "1 hour", "10 minutes")}
    log = ProgressLog()
    spark.streams.addListener(log)
    try:
        query = fan_out(_arriving(spark, sf_dir, root), sinks, f"{root}/checkpoint", trigger=None)
        wait_for([query])
        totals = totals_of(log, query)
    finally:
        spark.streams.removeListener(log)
    return f"{root}/out", totals


# What arrives with the last file is late when its hour was over, and ten minutes more, before
# the newest time of the files ahead.
_SPAN_SQL = f"""(
  SELECT *, CASE WHEN event_id % 50 = 0 THEN {ARRIVALS - 1} ELSE least({ARRIVALS - 1}, CAST(floor(
            (epoch_us(ts) - min(epoch_us(ts)) OVER ()) / ((max(epoch_us(ts)) OVER () - min(epoch_us(ts)) OVER ()) / 1.0) * {ARRIVALS}
          ) AS BIGINT)) END AS arrival
  FROM {SCORED_SQL})"""
_LATE_SQL = f"""(
  SELECT *, {_HOUR_SQL} + INTERVAL 1 HOUR
            <= (SELECT max(ts) FROM {_SPAN_SQL} WHERE arrival < {ARRIVALS - 1}) - INTERVAL 10 MINUTE
            AND arrival = {ARRIVALS - 1} AS late
  FROM {_SPAN_SQL})"""


@query(
    "live_window_late",
    f"SELECT event_id, ts, predicted_label FROM {_LATE_SQL} WHERE late",
)
def live_window_late(spark, sf_dir):
    """Rows that came after their period was closed: none is lost."""
    path, _ = _arrived_windows(spark, sf_dir)
    return live.read_late(spark, path).select("event_id", "ts", "predicted_label")


@query(
    "live_window_batches",
    f"""SELECT {_HOUR_SQL} AS start, {_HOUR_SQL} + INTERVAL 1 HOUR AS "end", predicted_label, count(*) AS n,
          {_HOUR_SQL} + INTERVAL 1 HOUR <= (SELECT max(ts) FROM events) - INTERVAL 10 MINUTE AS closed
        FROM {_LATE_SQL} WHERE NOT late GROUP BY ALL""",
)
def live_window_batches(spark, sf_dir):
    """Periods added up over several batches, without the late rows."""
    path, _ = _arrived_windows(spark, sf_dir)
    return live.read_windows(spark, path)


@query(
    "stream_progress",
    f"""SELECT count(*) AS rows, count(DISTINCT arrival) AS batches,
          CAST(max(n) AS BIGINT) AS largest
        FROM (SELECT arrival, count(*) OVER (PARTITION BY arrival) AS n FROM {_SPAN_SQL})""",
)
def stream_progress(spark, sf_dir):
    """Running totals of a stream that takes in one file a batch, from its listener."""
    _, totals = _arrived_windows(spark, sf_dir)
    return spark.createDataFrame([totals], "rows bigint, batches bigint, largest bigint")


@query(
    "live_last_n",
    f"""SELECT user_id, event_id, round(value, 6) AS value FROM {SCORED_SQL}
        QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) <= 50""",
)
def live_last_n(spark, sf_dir):
    root = scratch_folder(spark, "live-last-n")
    rows = _scored_stream(spark, sf_dir).select("user_id", "event_id", "ts", "value")
    order, by = ["ts", "event_id"], ["user_id"]
    sinks = {"newest": live.last_n_sink(f"{root}/out", 50, order, by)}
    wait_for([fan_out(rows, sinks, f"{root}/checkpoint", trigger=None)])
    newest = live.read_last_n(spark, f"{root}/out", 50, order, by)
    return newest.select("user_id", "event_id", r6("value").alias("value"))
