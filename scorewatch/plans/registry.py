"""Names of the runnable queries, and views of the driver's tables they share."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from scorewatch.spec import FeatureSpec

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query, with the SQL that must give the same rows, where SQL can."""

    def register(f: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"query {name!r} is registered twice")
        QUERIES[name] = f
        if sql is not None:
            ORACLES[name] = sql
        return f

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def r6(c: Column | str) -> Column:
    return F.round(c, 6)


# --- lineitem as the feature table -------------------------------------------------

LINE_SPEC = FeatureSpec(("l_quantity", "l_extendedprice", "l_discount", "l_tax"), "label")
LINE_LABEL_SQL = "CASE WHEN l_quantity * l_discount > 1.2 THEN 1 ELSE 0 END"

# Coefficients of a fixed scorer over min-max scaled features, for queries whose result
# has to be the same in SQL.
LINE_WEIGHTS = {"l_quantity": 4.0, "l_extendedprice": -0.5, "l_discount": 5.0, "l_tax": 0.25}
LINE_INTERCEPT = -5.0


def line_label() -> Column:
    return F.when(F.col("l_quantity") * F.col("l_discount") > 1.2, 1).otherwise(0).alias("label")


def feature_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem")
    return lines.select("l_orderkey", "l_linenumber", *LINE_SPEC.features, line_label())


FEATURES_SQL = f"""(
  SELECT l_orderkey, l_linenumber, l_quantity, l_extendedprice, l_discount, l_tax,
         {LINE_LABEL_SQL} AS label
  FROM lineitem)"""


# --- events as scored records ------------------------------------------------------

EVENT_SPEC = FeatureSpec(("value", "k"), "predicted_label")


def scored_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as a scored history: label, both probabilities, two features."""
    p1 = F.col("value") / (F.col("value") + 30)
    props = F.from_json("props", T.StructType([T.StructField("k", T.LongType())]))
    return table(spark, sf_dir, "events").select(
        "event_id",
        "ts",
        "user_id",
        "event_type",
        "value",
        props.getField("k").cast("double").alias("k"),
        F.when(F.col("value") > 30, 1).otherwise(0).alias("predicted_label"),
        (1 - p1).alias("p0"),
        p1.alias("p1"),
    )


SCORED_SQL = """(
  SELECT event_id, ts, user_id, event_type, value,
         CAST(regexp_extract(props, '[0-9]+') AS DOUBLE) AS k,
         CASE WHEN value > 30 THEN 1 ELSE 0 END AS predicted_label,
         1 - value / (value + 30) AS p0, value / (value + 30) AS p1
  FROM events)"""


def with_gaps(df: DataFrame) -> DataFrame:
    """Scored events with missing values made on purpose: the tables hold none."""
    return df.withColumns(
        {
            "value": F.when(F.col("event_id") % 7 != 0, F.col("value")),
            "k": F.when(F.col("event_id") % 5 == 0, F.lit(float("nan"))).otherwise(F.col("k")),
        }
    )


GAPS_SQL = f"""(
  SELECT event_id, ts, user_id, event_type, predicted_label, p0, p1,
         CASE WHEN event_id % 7 <> 0 THEN value END AS value,
         CASE WHEN event_id % 5 = 0 THEN CAST('NaN' AS DOUBLE) ELSE k END AS k
  FROM {SCORED_SQL})"""


def event_messages(scored: DataFrame) -> DataFrame:
    """Scored events as topic messages, in the forms a results topic may hold.

    The probability comes as a serialized vector, a list, either one as a string, or not
    at all; one message in eleven is cut off in the middle.
    """
    pair = F.array("p0", "p1")
    vector = F.struct(F.lit(1).alias("type"), pair.alias("values"))
    fields = ["value", "k", F.col("predicted_label").cast("double").alias("predicted_label")]
    kind = F.col("event_id") % 5

    def message(*extra):
        return F.to_json(F.struct(*fields, *extra))

    text = (
        F.when(kind == 0, message(vector.alias("prediction_probability")))
        .when(kind == 1, message(pair.alias("prediction_probability")))
        .when(kind == 2, message(F.to_json(vector).alias("prediction_probability")))
        .when(kind == 3, message(F.to_json(pair).alias("prediction_probability")))
        .otherwise(message())
    )
    cut = F.when(F.col("event_id") % 11 == 0, F.substring(text, 1, 12)).otherwise(text)
    return scored.select("event_id", cut.alias("value"))


# --- customers as patients ---------------------------------------------------------


def cohort(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers as a cohort: segment as gender, balance as age, sign of it as risk."""
    return table(spark, sf_dir, "customer").select(
        "c_custkey",
        "c_nationkey",
        F.col("c_mktsegment").alias("gender"),
        F.floor(F.col("c_acctbal") / 100).cast("bigint").alias("age"),
        F.when(F.col("c_acctbal") < 0, "High Risk").otherwise("Low Risk").alias("risk"),
    )


COHORT_SQL = """(
  SELECT c_custkey, c_nationkey, c_mktsegment AS gender,
         CAST(floor(c_acctbal / 100) AS BIGINT) AS age,
         CASE WHEN c_acctbal < 0 THEN 'High Risk' ELSE 'Low Risk' END AS risk
  FROM customer)"""
