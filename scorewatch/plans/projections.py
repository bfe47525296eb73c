"""Column work: selecting, filling, encoding, banding, messages."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import functions as F
from pyspark.sql import types as T

from scorewatch.functions import columns as C
from scorewatch.functions import messages as M
from scorewatch.functions.texts import MEASURE_TEXTS, NO_TEXT, STATISTIC_TEXTS, explain_feature
from scorewatch.operators import clean
from scorewatch.plans.registry import (
    COHORT_SQL,
    EVENT_SPEC,
    FEATURES_SQL,
    GAPS_SQL,
    LINE_SPEC,
    SCORED_SQL,
    cohort,
    event_messages,
    feature_table,
    query,
    r6,
    scored_events,
    table,
    with_gaps,
)
from scorewatch.sources.streams import read_scored
from scorewatch.spec import match_columns


@query(
    "select_features",
    f"SELECT l_orderkey, l_quantity, l_extendedprice, l_discount, l_tax FROM {FEATURES_SQL}",
)
def select_features(spark, sf_dir):
    return clean.select_features(feature_table(spark, sf_dir), LINE_SPEC, ["l_orderkey"])


@query(
    "drop_and_rename",
    "SELECT p_partkey AS id, p_type AS diagnosis, p_size AS radius_mean FROM part",
)
def drop_and_rename(spark, sf_dir):
    return clean.clean(
        table(spark, sf_dir, "part"),
        drop=["p_name", "p_brand", "p_retailprice", "not_there"],
        rename={"p_partkey": "id", "p_type": "diagnosis", "p_size": "radius_mean"},
    )


@query("normalize_names", "SELECT s_suppkey, s_acctbal AS account_balance_mean FROM supplier")
def normalize_names(spark, sf_dir):
    raw = table(spark, sf_dir, "supplier").select(
        "s_suppkey", F.col("s_acctbal").alias("account balance mean")
    )
    return clean.normalize_names(raw)


@query(
    "encode_label_positive",
    "SELECT l_orderkey, l_linenumber, CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS label "
    "FROM lineitem",
)
def encode_label_positive(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", C.encode_label("l_returnflag", positive="R").alias("label")
    )


@query(
    "encode_label_mapping",
    "SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN 1 WHEN 'O' THEN 0 END AS label FROM orders",
)
def encode_label_mapping(spark, sf_dir):
    return table(spark, sf_dir, "orders").select(
        "o_orderkey", C.encode_label("o_orderstatus", mapping={"F": 1, "O": 0}).alias("label")
    )


@query(
    "decode_label",
    f"SELECT event_id, CASE WHEN predicted_label = 1 THEN 'Malignant' ELSE 'Benign' END AS result "
    f"FROM {SCORED_SQL}",
)
def decode_label(spark, sf_dir):
    return scored_events(spark, sf_dir).select(
        "event_id", C.decode_label("predicted_label").alias("result")
    )


@query(
    "fill_missing",
    f"SELECT event_id, coalesce(value, 0.0) AS value FROM {GAPS_SQL}",
)
def fill_missing(spark, sf_dir):
    gaps = with_gaps(scored_events(spark, sf_dir))
    return clean.fill_missing(gaps, ["value"]).select("event_id", "value")


@query(
    "fill_missing_with_nan",
    f"""SELECT event_id, coalesce(value, 0.0) AS value,
        CASE WHEN k IS NULL OR isnan(k) THEN 0.0 ELSE k END AS k FROM {GAPS_SQL}""",
)
def fill_missing_with_nan(spark, sf_dir):
    gaps = with_gaps(scored_events(spark, sf_dir))
    return clean.fill_missing(gaps, ["value", "k"], nan=True).select("event_id", "value", "k")


@query(
    "missing_predicate",
    f"""SELECT event_id, value IS NULL AS value_missing, (k IS NULL OR isnan(k)) AS k_missing
        FROM {GAPS_SQL}""",
)
def missing_predicate(spark, sf_dir):
    return with_gaps(scored_events(spark, sf_dir)).select(
        "event_id",
        C.is_missing("value", "double").alias("value_missing"),
        C.is_missing("k", "double").alias("k_missing"),
    )


@query("by_label", f"SELECT event_id, ts, value FROM {SCORED_SQL} WHERE predicted_label = 1")
def by_label(spark, sf_dir):
    return clean.by_label(scored_events(spark, sf_dir), "predicted_label", 1).select(
        "event_id", "ts", "value"
    )


@query(
    "columns_by_name",
    "SELECT l_orderkey, l_partkey, l_suppkey, l_shipdate FROM lineitem",
)
def columns_by_name(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem")
    return lines.select(*match_columns(lines.columns, endswith=("key", "date")))


@query(
    "title_names",
    """SELECT event_type, array_to_string(list_transform(string_split(replace(event_type, '_', ' '), ' '),
         lambda w: upper(w[1]) || lower(w[2:])), ' ') AS title
       FROM (SELECT DISTINCT event_type FROM events)""",
)
def title_names(spark, sf_dir):
    types = clean.distinct_values(table(spark, sf_dir, "events"), "event_type")
    return types.select("event_type", C.title("event_type").alias("title"))


@query(
    "confidence",
    f"""SELECT event_id, round(CASE WHEN predicted_label = 1 THEN p1 ELSE p0 END * 100, 6) AS confidence
        FROM {SCORED_SQL}""",
)
def confidence(spark, sf_dir):
    return scored_events(spark, sf_dir).select(
        "event_id", r6(C.confidence("predicted_label", F.array("p0", "p1"))).alias("confidence")
    )


@query(
    "clamp",
    "SELECT p_partkey, greatest(18, least(p_size, 40)) AS size FROM part",
)
def clamp(spark, sf_dir):
    return table(spark, sf_dir, "part").select("p_partkey", C.clamp("p_size", 18, 40).alias("size"))


@query(
    "cohort_filter",
    f"""SELECT event_id, event_type, value FROM {SCORED_SQL}
        WHERE value BETWEEN 10 AND 60 AND event_type IN ('click', 'error')
          AND predicted_label IN (0, 1)
          AND ts BETWEEN TIMESTAMP '2024-01-24 00:00:00' - INTERVAL 7 DAY
                     AND TIMESTAMP '2024-01-24 00:00:00'""",
)
def cohort_filter(spark, sf_dir):
    inside = C.in_cohort(
        "value",
        10,
        60,
        {"event_type": ["click", "error"], "predicted_label": [0, 1]},
        "ts",
        timedelta(days=7),
        F.lit("2024-01-24 00:00:00").cast("timestamp_ntz"),
    )
    return scored_events(spark, sf_dir).filter(inside).select("event_id", "event_type", "value")


@query(
    "risk_bands",
    f"""SELECT event_id,
          CASE WHEN p1 >= 0.7 THEN 'red' WHEN p1 >= 0.3 THEN 'yellow' ELSE 'green' END AS band,
          p1 >= 0.8 AS alert, round(p1 - 0.5, 6) AS delta
        FROM {SCORED_SQL}""",
)
def risk_bands(spark, sf_dir):
    return scored_events(spark, sf_dir).select(
        "event_id",
        C.risk_band("p1").alias("band"),
        C.alert("p1").alias("alert"),
        r6(C.delta_from("p1")).alias("delta"),
    )


@query(
    "age_groups",
    f"""SELECT c_custkey, age, CASE WHEN age >= 76 THEN '76+' WHEN age >= 61 THEN '61-75'
          WHEN age >= 46 THEN '46-60' WHEN age >= 31 THEN '31-45' WHEN age >= 18 THEN '18-30' END
          AS age_group FROM {COHORT_SQL}""",
)
def age_groups(spark, sf_dir):
    return cohort(spark, sf_dir).select("c_custkey", "age", C.bucket("age").alias("age_group"))


@query(
    "rule_score",
    f"""SELECT event_id, CASE WHEN coalesce(value, 0) + CASE WHEN k IS NULL OR isnan(k) THEN 0 ELSE k END
          > 60 THEN 1 ELSE 0 END AS label FROM {GAPS_SQL}""",
)
def rule_score(spark, sf_dir):
    gaps = with_gaps(scored_events(spark, sf_dir))
    return gaps.select("event_id", C.rule_score(["value", "k"], 60).alias("label"))


@query(
    "ratio_index",
    """SELECT p_partkey, round(p_retailprice / nullif(pow(p_size / 100.0, 2), 0), 4) AS index_value
       FROM part""",
)
def ratio_index(spark, sf_dir):
    index = F.round(C.body_mass_index("p_retailprice", "p_size"), 4)
    return table(spark, sf_dir, "part").select("p_partkey", index.alias("index_value"))


# Event types stand in for feature names: each gets a measure by its length.
_FEATURE_SQL = """(SELECT event_id, CASE event_id % 4 WHEN 0 THEN 'radius_mean'
  WHEN 1 THEN 'concave_points_worst' WHEN 2 THEN event_type ELSE 'fractal_dimension_se' END AS feature
  FROM events)"""


def _named_features(spark, sf_dir):
    kind = F.col("event_id") % 4
    return table(spark, sf_dir, "events").select(
        "event_id",
        F.when(kind == 0, "radius_mean")
        .when(kind == 1, "concave_points_worst")
        .when(kind == 2, F.col("event_type"))
        .otherwise("fractal_dimension_se")
        .alias("feature"),
    )


def _text(measure: str | None, statistic: str | None) -> str:
    first = MEASURE_TEXTS[measure] if measure else NO_TEXT
    return f"'{first}. {STATISTIC_TEXTS[statistic] if statistic else ''}'"


@query(
    "explain_feature",
    f"""SELECT event_id, feature, CASE feature
          WHEN 'radius_mean' THEN {_text('radius', 'mean')}
          WHEN 'concave_points_worst' THEN {_text('concave_points', 'worst')}
          WHEN 'fractal_dimension_se' THEN {_text('fractal_dimension', 'se')}
          ELSE {_text(None, None)} END AS explanation,
        CASE feature
          WHEN 'radius_mean' THEN {_text('radius', 'mean')}
          ELSE {_text(None, None)} END AS legacy_explanation
        FROM {_FEATURE_SQL}""",
)
def explain(spark, sf_dir):
    return _named_features(spark, sf_dir).select(
        "event_id",
        "feature",
        explain_feature("feature").alias("explanation"),
        explain_feature("feature", legacy=True).alias("legacy_explanation"),
    )


@query(
    "lookup_text",
    """SELECT o_orderkey, coalesce(n_name, 'none') AS n_name
       FROM orders LEFT JOIN customer ON o_orderkey = c_custkey
                   LEFT JOIN nation ON c_nationkey = n_nationkey""",
)
def lookup_text(spark, sf_dir):
    names = table(spark, sf_dir, "customer").join(
        table(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey")
    )
    # There are more orders than customers, so most keys are not in the dimension.
    dim = names.select(F.col("c_custkey").alias("o_orderkey"), "n_name")
    orders = table(spark, sf_dir, "orders").select("o_orderkey")
    return clean.lookup_text(orders, dim, "o_orderkey", "n_name", "none")


# --- messages ----------------------------------------------------------------------

_PROPS = T.StructType([T.StructField("k", T.LongType(), True)])


@query(
    "parse_messages",
    """SELECT event_id, event_id % 4 = 0 AS is_valid,
         CASE WHEN event_id % 4 = 0 THEN CAST(regexp_extract(props, '[0-9]+') AS BIGINT) END AS k,
         CASE event_id % 4 WHEN 0 THEN NULL WHEN 1 THEN NULL WHEN 2 THEN '{"k": "' || event_type || '"}'
           ELSE substr(props, 1, 4) END AS raw_value
       FROM events""",
)
def parse_messages(spark, sf_dir):
    """A quarter each of good messages, null messages, wrong types and cut-off text."""
    kind = F.col("event_id") % 4
    value = (
        F.when(kind == 0, F.col("props"))
        .when(kind == 2, F.concat(F.lit('{"k": "'), F.col("event_type"), F.lit('"}')))
        .when(kind == 3, F.substring("props", 1, 4))
    )
    messages = table(spark, sf_dir, "events").select("event_id", value.alias("value"))
    return M.parse_messages(messages, _PROPS)


@query(
    "quarantined_messages",
    """SELECT event_id, substr(props, 1, 4) AS raw_value FROM events WHERE event_id % 4 = 3""",
)
def quarantined_messages(spark, sf_dir):
    value = F.when(F.col("event_id") % 4 == 3, F.substring("props", 1, 4)).otherwise(F.col("props"))
    messages = table(spark, sf_dir, "events").select("event_id", value.alias("value"))
    return M.split_valid(M.parse_messages(messages, _PROPS), _PROPS)[1]


@query(
    "message_round_trip",
    f"SELECT event_id, value, k, predicted_label FROM {SCORED_SQL}",
)
def message_round_trip(spark, sf_dir):
    fields = ["value", "k", "predicted_label"]
    sent = scored_events(spark, sf_dir).select("event_id", M.to_message(fields).alias("value"))
    schema = T.StructType.fromDDL("value double, k double, predicted_label int")
    return M.parse_messages(sent, schema, policy="zero_fill")


_NESTED = T.StructType(
    [
        T.StructField("timestamp", T.StringType()),
        T.StructField("patient_id", T.StringType()),
        T.StructField("features", T.MapType(T.StringType(), T.DoubleType())),
        T.StructField("prediction", T.IntegerType()),
        T.StructField("prediction_probability", T.DoubleType()),
    ]
)


@query(
    "nested_messages",
    f"""SELECT event_id, date_trunc('second', ts) AS ts, CAST(user_id AS VARCHAR) AS patient_id,
          predicted_label AS prediction, round(p1, 6) AS prediction_probability, value,
          CASE WHEN event_id % 3 <> 0 THEN k END AS k
        FROM {SCORED_SQL}""",
)
def nested_messages(spark, sf_dir):
    """Messages with a map of features, a third of them lacking one, sent and flattened."""
    values = F.create_map(F.lit("value"), F.col("value"), F.lit("k"), F.col("k"))
    known = F.when(F.col("event_id") % 3 == 0, F.map_filter(values, lambda n, _: n != "k")).otherwise(values)
    sent = scored_events(spark, sf_dir).select(
        "event_id",
        M.to_message(
            [
                F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("timestamp"),
                F.col("user_id").cast("string").alias("patient_id"),
                known.alias("features"),
                F.col("predicted_label").alias("prediction"),
                F.round("p1", 6).alias("prediction_probability"),
            ]
        ).alias("value"),
    )
    good, _ = M.split_valid(M.parse_messages(sent, _NESTED), _NESTED)
    flat = M.features_from_map(good, "features", ["value", "k"])
    parsed = F.try_to_timestamp("timestamp", F.lit("yyyy-MM-dd HH:mm:ss"))
    return flat.withColumn("ts", parsed.cast("timestamp_ntz")).drop("timestamp")


@query(
    "read_scored_messages",
    f"""SELECT event_id, event_id % 11 <> 0 AS is_valid,
          CAST(CASE WHEN event_id % 11 = 0 THEN 12 END AS INTEGER) AS raw_length,
          CAST(CASE WHEN event_id % 11 <> 0 THEN predicted_label END AS DOUBLE) AS predicted_label,
          CASE WHEN event_id % 11 = 0 THEN NULL WHEN event_id % 5 = 4 THEN 0.0 ELSE round(p0, 6) END
            AS benign_probability,
          CASE WHEN event_id % 11 = 0 THEN NULL WHEN event_id % 5 = 4 THEN 0.0 ELSE round(p1, 6) END
            AS malignant_probability,
          CASE WHEN event_id % 11 <> 0 THEN value END AS value,
          CASE WHEN event_id % 11 <> 0 THEN k END AS k
        FROM {SCORED_SQL}""",
)
def read_scored_messages(spark, sf_dir):
    scored = read_scored(event_messages(scored_events(spark, sf_dir)), EVENT_SPEC)
    scored = scored.withColumn("raw_length", F.length("raw_value")).drop("raw_value")
    return scored.withColumns({c: r6(c) for c in ("benign_probability", "malignant_probability")})


@query(
    "vector_elements",
    """SELECT vec_id, CAST(embedding[1] AS DOUBLE) AS first, CAST(embedding[64] AS DOUBLE) AS last,
              CAST(NULL AS DOUBLE) AS beyond FROM embeddings""",
)
def vector_elements(spark, sf_dir):
    def element(i):
        return F.get("embedding", F.lit(i)).cast("double")

    return table(spark, sf_dir, "embeddings").select(
        "vec_id", element(0).alias("first"), element(63).alias("last"), element(64).alias("beyond")
    )


# --- rows-only ---------------------------------------------------------------------


@query("processed_at")
def processed_at(spark, sf_dir):
    scored = scored_events(spark, sf_dir).select("event_id", "predicted_label")
    return clean.with_processed_at(scored)


@query("random_ids")
def random_ids(spark, sf_dir):
    return clean.with_id(table(spark, sf_dir, "customer").select("c_custkey"))


@query("processed_at_counts", f"SELECT count(*) AS rows, 1::BIGINT AS times, true AS of_today FROM {SCORED_SQL}")
def processed_at_counts(spark, sf_dir):
    """One processing time for all rows of a batch, and not one of another day."""
    stamped = clean.with_processed_at(scored_events(spark, sf_dir))
    near = F.abs(F.datediff(F.max("timestamp"), F.current_date())) <= 1
    return stamped.agg(F.count(F.lit(1)).alias("rows"), F.countDistinct("timestamp").alias("times"), near.alias("of_today"))


@query("random_id_counts", "SELECT count(*) AS rows, count(*) AS ids, true AS well_formed FROM customer")
def random_id_counts(spark, sf_dir):
    """As many ids as rows, all of them in the usual form."""
    with_ids = clean.with_id(table(spark, sf_dir, "customer").select("c_custkey"))
    formed = F.bool_and(F.col("id").rlike("^[0-9a-f]{8}(-[0-9a-f]{4}){3}-[0-9a-f]{12}$"))
    return with_ids.agg(F.count(F.lit(1)).alias("rows"), F.countDistinct("id").alias("ids"), formed.alias("well_formed"))


@query(
    "sample_rows",
    f"SELECT * FROM {SCORED_SQL} ORDER BY md5(CAST(event_id AS VARCHAR) || ':42'), event_id LIMIT 50",
)
def sample_rows(spark, sf_dir):
    return clean.sample_rows(scored_events(spark, sf_dir), "event_id", 50)
