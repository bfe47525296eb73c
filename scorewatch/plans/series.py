"""Records in time order: running counts, newest rows, changes, timelines."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from scorewatch.operators import clean, points, series
from scorewatch.plans.registry import SCORED_SQL, query, r6, scored_events, table
from scorewatch.sinks.tables import append_history, export_csv
from scorewatch.session import scratch_folder
from scorewatch.sources.tables import read_history, read_table
from scorewatch.spec import FeatureSpec

_CUMULATIVE_SQL = """SELECT predicted_label, ts, n,
  CAST(sum(n) OVER (PARTITION BY predicted_label ORDER BY ts) AS BIGINT) AS cumulative
  FROM (SELECT predicted_label, {ts} AS ts, count(*) AS n FROM {source} GROUP BY 1, 2)"""


@query("cumulative_counts", _CUMULATIVE_SQL.format(ts="ts", source=SCORED_SQL))
def cumulative_counts(spark, sf_dir):
    return series.cumulative_counts(scored_events(spark, sf_dir))


@query("cumulative_counts_split", _CUMULATIVE_SQL.format(ts="ts", source=SCORED_SQL))
def cumulative_counts_split(spark, sf_dir):
    """The same with the time line cut into ranges, as on a table too large for one task per label."""
    return series.cumulative_counts(scored_events(spark, sf_dir), ranges=16)


@query("cumulative_counts_daily", _CUMULATIVE_SQL.format(ts="date_trunc('day', ts)", source=SCORED_SQL))
def cumulative_counts_daily(spark, sf_dir):
    return series.cumulative_counts(scored_events(spark, sf_dir), grain="day")


def _hourly(spark, sf_dir):
    """Events with their time cut to the hour, so that equal timestamps follow each other."""
    hour = F.date_trunc("hour", "ts").cast("timestamp_ntz")
    return scored_events(spark, sf_dir).select("event_id", hour.alias("ts"), "event_type", "value")


_DEDUP_SQL = """SELECT event_id, ts, event_type, value FROM (
  SELECT event_id, date_trunc('hour', ts) AS ts, event_type, value,
         lag(date_trunc('hour', ts)) OVER (PARTITION BY event_type ORDER BY event_id) AS before
  FROM events) WHERE before IS NULL OR before <> ts"""


@query("dedup_consecutive", _DEDUP_SQL)
def dedup_consecutive(spark, sf_dir):
    return series.dedup_consecutive(_hourly(spark, sf_dir), "ts", ["event_id"], ["event_type"])


@query("dedup_consecutive_split", _DEDUP_SQL)
def dedup_consecutive_split(spark, sf_dir):
    hourly = _hourly(spark, sf_dir)
    return series.dedup_consecutive(hourly, "ts", ["event_id"], ["event_type"], ranges=16)


@query("last_n", f"SELECT event_id, ts, value FROM {SCORED_SQL} ORDER BY ts DESC, event_id DESC LIMIT 50")
def last_n(spark, sf_dir):
    scored = scored_events(spark, sf_dir).select("event_id", "ts", "value")
    return series.last_n(scored, 50, ["ts", "event_id"])


@query(
    "last_n_per_user",
    f"""SELECT user_id, event_id, ts, value FROM {SCORED_SQL}
        QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) <= 5""",
)
def last_n_per_user(spark, sf_dir):
    scored = scored_events(spark, sf_dir).select("user_id", "event_id", "ts", "value")
    return series.last_n(scored, 5, ["ts", "event_id"], ["user_id"])


@query(
    "last_n_per_type",
    f"""SELECT event_type, event_id, value FROM {SCORED_SQL}
        QUALIFY row_number() OVER (PARTITION BY event_type ORDER BY event_id DESC) <= 1500""",
)
def last_n_per_type(spark, sf_dir):
    """More rows per key than Spark limits before the shuffle, so the salted form runs."""
    scored = scored_events(spark, sf_dir).select("event_type", "event_id", "value")
    return series.last_n(scored, 1500, ["event_id"], ["event_type"])


_DELTA_SQL = f"""SELECT user_id, event_type, event_id, ts, value, round(value - lag(value) OVER (
  PARTITION BY user_id, event_type ORDER BY ts, event_id), 6) AS delta FROM {SCORED_SQL}"""


def _readings(spark, sf_dir):
    return scored_events(spark, sf_dir).select("user_id", "event_type", "event_id", "ts", "value")


@query("with_delta", _DELTA_SQL)
def with_delta(spark, sf_dir):
    readings = _readings(spark, sf_dir)
    changed = series.with_delta(readings, ["user_id", "event_type"], ["ts", "event_id"], "value")
    return changed.withColumn("delta", r6("delta"))


@query("with_delta_split", _DELTA_SQL)
def with_delta_split(spark, sf_dir):
    changed = series.with_delta(
        _readings(spark, sf_dir), ["user_id", "event_type"], ["ts", "event_id"], "value", ranges=16
    )
    return changed.withColumn("delta", r6("delta"))


SIGNALS = ("click", "error", "purchase", "signup", "view")


def _series_sql(filter_sql: str) -> str:
    means = ", ".join(
        f"round(avg(CASE WHEN event_type = '{s}' THEN value END), 6) AS {s}" for s in SIGNALS
    )
    return f"""SELECT user_id, date_trunc('minute', ts) AS minute, {means} FROM (
      SELECT *, max(ts) OVER (PARTITION BY user_id) AS newest FROM events)
      WHERE {filter_sql} AND event_type IN {SIGNALS} GROUP BY ALL"""


def _series(spark, sf_dir, minutes, now=None):
    recent = series.recent_series(
        table(spark, sf_dir, "events"), "user_id", "event_type", "ts", "value", SIGNALS, minutes, now
    )
    return recent.withColumns({s: r6(s) for s in SIGNALS})


@query("recent_series", _series_sql("ts > newest - INTERVAL 2880 MINUTE"))
def recent_series(spark, sf_dir):
    return _series(spark, sf_dir, 2880)


@query(
    "recent_series_until",
    _series_sql(
        "ts > TIMESTAMP '2024-01-20 12:00:00' - INTERVAL 60 MINUTE AND ts <= TIMESTAMP '2024-01-20 12:00:00'"
    ),
)
def recent_series_until(spark, sf_dir):
    return _series(spark, sf_dir, 60, F.lit("2024-01-20 12:00:00").cast("timestamp_ntz"))


_RISK_SQL = f"""SELECT user_id, event_id, round(least(1.0, 0.32 + sum(value / 2000) OVER (
  PARTITION BY user_id ORDER BY ts, event_id)), 6) AS risk FROM {SCORED_SQL}"""


def _risk_steps(spark, sf_dir):
    return scored_events(spark, sf_dir).select(
        "user_id", "event_id", "ts", (F.col("value") / 2000).alias("increment")
    )


def _risk_path(spark, sf_dir, ranges=None):
    return series.capped_cumsum(
        _risk_steps(spark, sf_dir), ["user_id"], ["ts", "event_id"], "increment", 0.32, ranges=ranges
    )


@query("capped_risk_path", _RISK_SQL)
def capped_risk_path(spark, sf_dir):
    return _risk_path(spark, sf_dir).select("user_id", "event_id", r6("risk").alias("risk"))


@query("capped_risk_path_split", _RISK_SQL)
def capped_risk_path_split(spark, sf_dir):
    return _risk_path(spark, sf_dir, 16).select("user_id", "event_id", r6("risk").alias("risk"))


@query(
    "risk_outlook",
    f"""SELECT user_id, CAST(0.32 AS DOUBLE) AS current_risk,
          round(least(1.0, 0.32 + sum(value / 2000)), 6) AS predicted_risk,
          round(least(1.0, 0.32 + sum(value / 2000)) - 0.32, 6) AS difference
        FROM {SCORED_SQL} GROUP BY user_id""",
)
def risk_outlook(spark, sf_dir):
    outlook = series.risk_outlook(_risk_steps(spark, sf_dir), ["user_id"], "increment", 0.32)
    return outlook.withColumns({c: r6(c) for c in ("predicted_risk", "difference")})


@query(
    "recent_predictions",
    f"""SELECT ts, user_id, predicted_label, round(p1, 6) AS p1 FROM {SCORED_SQL}
        ORDER BY ts DESC, event_id DESC LIMIT 10""",
)
def recent_predictions(spark, sf_dir):
    newest = series.recent(
        scored_events(spark, sf_dir), 10, ["ts", "event_id"], ["ts", "user_id", "predicted_label", "p1"]
    )
    return newest.withColumn("p1", r6("p1"))


def _latest_sql(qualify: str) -> str:
    return f"""SELECT user_id, event_id, ts, predicted_label,
        round(CASE WHEN predicted_label = 1 THEN p1 ELSE p0 END * 100, 6) AS confidence
      FROM {SCORED_SQL} QUALIFY row_number() OVER ({qualify} ORDER BY ts DESC, event_id DESC) = 1"""


def _latest(spark, sf_dir, by=()):
    newest = series.latest(scored_events(spark, sf_dir), ["ts", "event_id"], by)
    sure = F.when(F.col("predicted_label") == 1, F.col("p1")).otherwise(F.col("p0")) * 100
    return newest.select("user_id", "event_id", "ts", "predicted_label", r6(sure).alias("confidence"))


@query("latest", _latest_sql(""))
def latest(spark, sf_dir):
    return _latest(spark, sf_dir)


@query("latest_per_user", _latest_sql("PARTITION BY user_id"))
def latest_per_user(spark, sf_dir):
    return _latest(spark, sf_dir, ["user_id"])


@query(
    "since",
    f"""SELECT event_id, ts, value FROM {SCORED_SQL}
        WHERE (ts, event_id) > (TIMESTAMP '2024-01-15 00:00:00', 5000)""",
)
def since(spark, sf_dir):
    scored = scored_events(spark, sf_dir).select("event_id", "ts", "value")
    return series.since(scored, ["ts", "event_id"], [dt.datetime(2024, 1, 15), 5000])


@query(
    "appended",
    f"""SELECT event_id, value, CAST(NULL AS DOUBLE) AS k FROM {SCORED_SQL} WHERE predicted_label = 0
        UNION ALL BY NAME SELECT k, value, event_id FROM {SCORED_SQL} WHERE predicted_label = 1""",
)
def appended(spark, sf_dir):
    scored = scored_events(spark, sf_dir)
    old = clean.by_label(scored, "predicted_label", 0).select("event_id", "value")
    new = clean.by_label(scored, "predicted_label", 1).select("k", "value", "event_id")
    return clean.append(old, new)


@query(
    "enriched_counts",
    """SELECT n_name, c_mktsegment, CAST(sum(n) AS BIGINT) AS n FROM (
         SELECT user_id, count(*) AS n FROM events GROUP BY user_id) e
       LEFT JOIN customer ON user_id = c_custkey LEFT JOIN nation ON c_nationkey = n_nationkey
       GROUP BY ALL""",
)
def enriched_counts(spark, sf_dir):
    """Attributes joined to records, counted. Records are counted per user before the join."""
    people = table(spark, sf_dir, "customer").withColumnsRenamed(
        {"c_custkey": "user_id", "c_nationkey": "n_nationkey"}
    )
    per_user = scored_events(spark, sf_dir).groupBy("user_id").agg(F.count(F.lit(1)).alias("n"))
    joined = clean.enrich(per_user, people, "user_id", ["c_mktsegment", "n_nationkey"])
    named = clean.enrich(joined, table(spark, sf_dir, "nation"), "n_nationkey", ["n_name"])
    return named.groupBy("n_name", "c_mktsegment").agg(F.sum("n").alias("n"))


@query(
    "enriched_records",
    f"""SELECT event_id, predicted_label, c_mktsegment
        FROM {SCORED_SQL} LEFT JOIN customer ON user_id = c_custkey""",
)
def enriched_records(spark, sf_dir):
    people = table(spark, sf_dir, "customer").withColumnRenamed("c_custkey", "user_id")
    scored = scored_events(spark, sf_dir).select("event_id", "user_id", "predicted_label")
    return clean.enrich(scored, people, "user_id", ["c_mktsegment"]).drop("user_id")


# --- timelines ---------------------------------------------------------------------


@query(
    "probability_timeline",
    f"""SELECT event_id, ts, 'p0' AS class, round(p0, 6) AS probability FROM {SCORED_SQL}
        UNION ALL SELECT event_id, ts, 'p1', round(p1, 6) FROM {SCORED_SQL}""",
)
def probability_timeline(spark, sf_dir):
    long = points.probability_timeline(scored_events(spark, sf_dir), "ts", ["p0", "p1"], ["event_id"])
    return long.withColumn("probability", r6("probability"))


@query(
    "confidence_timeline",
    f"""SELECT event_id, ts, predicted_label,
          round(CASE WHEN predicted_label = 1 THEN p1 ELSE p0 END * 100, 6) AS confidence FROM {SCORED_SQL}""",
)
def confidence_timeline(spark, sf_dir):
    line = points.confidence_timeline(
        scored_events(spark, sf_dir), "ts", "predicted_label", F.array("p0", "p1"), ["event_id"]
    )
    return line.withColumn("confidence", r6("confidence"))


@query("feature_trend", f"SELECT ts, predicted_label, value FROM {SCORED_SQL}")
def feature_trend(spark, sf_dir):
    return points.feature_trend(scored_events(spark, sf_dir), "ts", "value", "predicted_label")


@query(
    "feature_trend_hourly",
    f"""SELECT date_trunc('hour', ts) AS ts, predicted_label, round(avg(value), 6) AS value
        FROM {SCORED_SQL} GROUP BY ALL""",
)
def feature_trend_hourly(spark, sf_dir):
    trend = points.feature_trend(scored_events(spark, sf_dir), "ts", "value", "predicted_label", "hour")
    return trend.withColumn("value", r6("value"))


# --- files written and read back ---------------------------------------------------

_HISTORY_SPEC = FeatureSpec(("value", "k"), "predicted_label")
_HISTORY_SQL = f"""SELECT ts AS timestamp, CAST(predicted_label AS DOUBLE) AS predicted_label,
  round(p0, 6) AS benign_probability, round(p1, 6) AS malignant_probability, value, k FROM {SCORED_SQL}"""


def _history_rows(spark, sf_dir):
    return scored_events(spark, sf_dir).select(
        F.col("ts").cast("timestamp").alias("timestamp"),
        F.col("predicted_label").cast("double").alias("predicted_label"),
        r6("p0").alias("benign_probability"),
        r6("p1").alias("malignant_probability"),
        "value",
        "k",
    )


def _without_zone(df):
    return df.withColumn("timestamp", F.col("timestamp").cast("timestamp_ntz"))


@query("history_appended", _HISTORY_SQL)
def history_appended(spark, sf_dir):
    """Two appends to a history partitioned by day, read back."""
    path = scratch_folder(spark, "history")
    rows = _history_rows(spark, sf_dir)
    append_history(clean.by_label(rows, "predicted_label", 0), path)
    append_history(clean.by_label(rows, "predicted_label", 1), path)
    return _without_zone(read_history(spark, path, _HISTORY_SPEC).drop("date"))


@query("history_csv", _HISTORY_SQL)
def history_csv(spark, sf_dir):
    """The history exported as CSV and read with its timestamps parsed."""
    path = scratch_folder(spark, "history-csv")
    export_csv(_history_rows(spark, sf_dir), path)
    return _without_zone(read_history(spark, path, _HISTORY_SPEC, "csv").drop("bad_timestamp"))


@query("csv_with_header", "SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer")
def csv_with_header(spark, sf_dir):
    path = scratch_folder(spark, "csv")
    export_csv(table(spark, sf_dir, "customer"), path)
    read = read_table(spark, path, "csv")
    return read.withColumn("c_custkey", F.col("c_custkey").cast("bigint"))


@query("csv_without_header", "SELECT p_partkey, p_name, p_brand, p_type, p_size, p_retailprice FROM part")
def csv_without_header(spark, sf_dir):
    path = scratch_folder(spark, "csv-bare")
    parts = table(spark, sf_dir, "part")
    parts.write.mode("overwrite").csv(path)
    return read_table(spark, path, "csv", parts.schema, header=False)
