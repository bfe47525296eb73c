"""Scaling, scoring, training, metrics."""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from scorewatch.functions.columns import logistic
from scorewatch.operators import counts, evaluate, features, model
from scorewatch.operators import logistic as logistic_fit
from scorewatch.operators.clean import fill_missing
from scorewatch.plans.registry import (
    FEATURES_SQL,
    LINE_INTERCEPT,
    LINE_SPEC,
    LINE_WEIGHTS,
    SCORED_SQL,
    feature_table,
    line_label,
    query,
    r6,
    scored_events,
    table,
)
from scorewatch.session import scratch_folder
from scorewatch.spec import FeatureSpec

_SCALED_SQL = "(SELECT l_orderkey, l_linenumber, l_shipdate, " + ", ".join(
    f"({c} - min({c}) OVER ()) / (max({c}) OVER () - min({c}) OVER ()) AS {c}" for c in LINE_SPEC.features
) + f", {{label}} AS label FROM lineitem)"
_SCALED_SQL = _SCALED_SQL.format(label="CASE WHEN l_quantity * l_discount > 1.2 THEN 1 ELSE 0 END")
_MARGIN_SQL = f"{LINE_INTERCEPT} + " + " + ".join(f"{w} * {c}" for c, w in LINE_WEIGHTS.items())
_PROBABILITY_SQL = f"1.0 / (1.0 + exp(-({_MARGIN_SQL})))"


def scored_lines(spark, sf_dir):
    """Line items filled, scaled by their own ranges and scored with fixed coefficients."""
    lines = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_shipdate", *LINE_SPEC.features, line_label()
    )
    filled = fill_missing(lines, LINE_SPEC.features)
    scaled = features.minmax_columns(filled, features.fit_ranges(filled, LINE_SPEC.features))
    scored = scaled.withColumn("p1", logistic(LINE_WEIGHTS, LINE_INTERCEPT))
    return scored.withColumn("predicted_label", F.when(F.col("p1") > 0.5, 1).otherwise(0))


@query(
    "monthly_score_summary",
    f"""SELECT month, total, negatives, positives, CAST(0 AS BIGINT) AS unlabeled,
          round(negatives / total * 100, 1) AS negative_percent,
          round(positives / total * 100, 1) AS positive_percent
        FROM (SELECT date_trunc('month', l_shipdate) AS month, count(*) AS total,
                count(CASE WHEN p1 <= 0.5 THEN 1 END) AS negatives,
                count(CASE WHEN p1 > 0.5 THEN 1 END) AS positives
              FROM (SELECT l_shipdate, {_PROBABILITY_SQL} AS p1 FROM {_SCALED_SQL}) GROUP BY 1)""",
)
def monthly_score_summary(spark, sf_dir):
    """The flagship: scan, fill, scale, score, summarize by month of shipping."""
    month = F.date_trunc("month", "l_shipdate").cast("timestamp_ntz").alias("month")
    return counts.summary(scored_lines(spark, sf_dir), [month])


@query(
    "score_fixed_coefficients",
    f"""SELECT l_orderkey, l_linenumber, round(p1, 6) AS p1, CASE WHEN p1 > 0.5 THEN 1 ELSE 0 END
          AS predicted_label
        FROM (SELECT l_orderkey, l_linenumber, {_PROBABILITY_SQL} AS p1 FROM {_SCALED_SQL})""",
)
def score_fixed_coefficients(spark, sf_dir):
    return scored_lines(spark, sf_dir).select(
        "l_orderkey", "l_linenumber", r6("p1").alias("p1"), "predicted_label"
    )


@query(
    "row_contributions",
    " UNION ALL ".join(
        f"SELECT l_orderkey, l_linenumber, '{c}' AS factor, round({c} * {w}, 6) AS contribution "
        f"FROM {_SCALED_SQL}"
        for c, w in LINE_WEIGHTS.items()
    ),
)
def row_contributions(spark, sf_dir):
    parts = features.row_contributions(
        scored_lines(spark, sf_dir), LINE_WEIGHTS, ["l_orderkey", "l_linenumber"]
    )
    return parts.withColumn("contribution", r6("contribution"))


# --- vectors and scaling -----------------------------------------------------------


def _scaled_features(spark, sf_dir, kind):
    lines = feature_table(spark, sf_dir).select("l_orderkey", "l_linenumber", *LINE_SPEC.features)
    scaled = features.scaled_columns(lines, LINE_SPEC.features, kind)
    return scaled.withColumns({c: r6(c) for c in LINE_SPEC.features})


@query(
    "minmax_scaled",
    "SELECT l_orderkey, l_linenumber, "
    + ", ".join(f"round({c}, 6) AS {c}" for c in LINE_SPEC.features)
    + f" FROM {_SCALED_SQL}",
)
def minmax_scaled(spark, sf_dir):
    return _scaled_features(spark, sf_dir, "minmax")


@query(
    "standard_scaled",
    "SELECT l_orderkey, l_linenumber, "
    + ", ".join(f"round({c} / stddev_samp({c}) OVER (), 6) AS {c}" for c in LINE_SPEC.features)
    + " FROM lineitem",
)
def standard_scaled(spark, sf_dir):
    return _scaled_features(spark, sf_dir, "standard")


@query(
    "assembled_vector",
    f"SELECT l_orderkey, l_linenumber, l_quantity, l_extendedprice, l_discount, l_tax FROM {FEATURES_SQL}",
)
def assembled_vector(spark, sf_dir):
    """Through a vector and back: the order of the spec is kept."""
    lines = features.assemble(feature_table(spark, sf_dir), LINE_SPEC, "error")
    vectors = lines.select("l_orderkey", "l_linenumber", "features")
    return features.vector_columns(vectors, "features", LINE_SPEC.features)


@query(
    "assembled_with_gaps",
    f"""SELECT event_id, predicted_label,
          CASE WHEN event_id % 7 = 0 THEN 1 ELSE 0 END AS gaps FROM {SCORED_SQL}""",
)
def assembled_with_gaps(spark, sf_dir):
    """A null becomes NaN in the vector; counted back per row."""
    scored = scored_events(spark, sf_dir).withColumn(
        "value", F.when(F.col("event_id") % 7 != 0, F.col("value"))
    )
    spec = FeatureSpec(("value", "k"), "predicted_label")
    vectors = features.assemble(scored, spec, "keep").select("event_id", "predicted_label", "features")
    nans = F.filter(vector_to_array("features"), lambda v: F.isnan(v))
    return vectors.select("event_id", "predicted_label", F.size(nans).alias("gaps"))


_RADAR_SPEC = FeatureSpec(("radius_mean", "radius_worst", "area_mean", "area_worst"), "label")


def _radar_table(spark, sf_dir):
    """Two measures with two statistics each, under the naming rule."""
    names = dict(zip(LINE_SPEC.features, _RADAR_SPEC.features, strict=True))
    return feature_table(spark, sf_dir).withColumnsRenamed(names)


@query(
    "scaled_long",
    " UNION ALL ".join(
        f"SELECT l_orderkey, l_linenumber, '{r}' AS feature, round({c}, 6) AS scaled FROM {_SCALED_SQL}"
        for c, r in zip(LINE_SPEC.features, _RADAR_SPEC.features, strict=True)
    ),
)
def scaled_long(spark, sf_dir):
    long = features.scaled_long(
        _radar_table(spark, sf_dir), _RADAR_SPEC, ids=["l_orderkey", "l_linenumber"]
    )
    return long.withColumn("scaled", r6("scaled"))


# Order and line number do not identify a line in the test tables, so the radar of a record
# is keyed by the mean record of an order.
@query(
    "radar",
    """WITH o AS (SELECT l_orderkey, """
    + ", ".join(f"avg({c}) AS {c}" for c in LINE_SPEC.features)
    + " FROM lineitem GROUP BY l_orderkey), s AS (SELECT l_orderkey, "
    + ", ".join(
        f"({c} - min({c}) OVER ()) / (max({c}) OVER () - min({c}) OVER ()) AS {c}" for c in LINE_SPEC.features
    )
    + """ FROM o)
    SELECT l_orderkey, 'radius' AS measure, round(l_quantity, 6) AS mean, round(l_extendedprice, 6) AS worst FROM s
    UNION ALL
    SELECT l_orderkey, 'area', round(l_discount, 6), round(l_tax, 6) FROM s""",
)
def radar(spark, sf_dir):
    per_order = (
        _radar_table(spark, sf_dir)
        .groupBy("l_orderkey")
        .agg(*[F.avg(c).alias(c) for c in _RADAR_SPEC.features])
    )
    scaled = features.scaled_columns(per_order, _RADAR_SPEC.features)
    wide = features.radar(scaled, _RADAR_SPEC, ["l_orderkey"], ["mean", "worst"])
    return wide.withColumns({c: r6(c) for c in ("mean", "worst")})


# --- training ----------------------------------------------------------------------


@query(
    "split_by_key",
    f"""SELECT CASE WHEN l_orderkey % 100 < 80 THEN 'train' ELSE 'test' END AS side, count(*) AS n,
          CAST(sum(label) AS BIGINT) AS positives FROM {FEATURES_SQL} GROUP BY 1""",
)
def split_by_key(spark, sf_dir):
    first, second = model.split(feature_table(spark, sf_dir), 0.8, key="l_orderkey", method="mod")
    sides = first.withColumn("side", F.lit("train")).unionByName(second.withColumn("side", F.lit("test")))
    return sides.groupBy("side").agg(F.count(F.lit(1)).alias("n"), F.sum("label").alias("positives"))


def _md5_share_sql(key: str, seed: int = 42) -> str:
    return f"(CAST('0x' || substr(md5(CAST({key} AS VARCHAR) || ':{seed}'), 1, 8) AS BIGINT) % 100)"


@query(
    "split_by_hash",
    f"""SELECT CASE WHEN {_md5_share_sql("l_orderkey")} < 80 THEN 'train' ELSE 'test' END AS side, count(*) AS n,
          CAST(sum(label) AS BIGINT) AS positives FROM {FEATURES_SQL} GROUP BY 1""",
)
def split_by_hash(spark, sf_dir):
    first, second = model.split(feature_table(spark, sf_dir), 0.8, key="l_orderkey", method="md5")
    sides = first.withColumn("side", F.lit("train")).unionByName(second.withColumn("side", F.lit("test")))
    return sides.groupBy("side").agg(F.count(F.lit(1)).alias("n"), F.sum("label").alias("positives"))


NEWTON_STEPS = 7


def _newton_sql(rows: str, names, steps: int = NEWTON_STEPS) -> str:
    """Common tables in which the same Newton steps are taken; the last, ``fitted``, has one row of
    coefficients b0 (intercept), b1, ... Each step solves its system by elimination."""
    k = len(names) + 1
    cells = [(i, j) for i in range(k) for j in range(k + 1)]
    ctes = [
        f"train AS MATERIALIZED ({rows})",
        "span AS MATERIALIZED (SELECT " + ", ".join(f"min({c}) AS low{i}, max({c}) AS high{i}" for i, c in enumerate(names, 1)) + " FROM train)",
        "x AS MATERIALIZED (SELECT 1.0::DOUBLE AS x0, "
        + ", ".join(f"({c} - low{i}) / (high{i} - low{i}) AS x{i}" for i, c in enumerate(names, 1))
        + ", label::DOUBLE AS y FROM train, span)",
        "beta_0 AS MATERIALIZED (SELECT " + ", ".join(f"0.0::DOUBLE AS b{i}" for i in range(k)) + ")",
    ]
    for t in range(steps):
        margin = " + ".join(f"b{i} * x{i}" for i in range(k))
        ctes.append(f"p_{t} AS MATERIALIZED (SELECT x.*, 1 / (1 + exp(-({margin}))) AS p FROM x, beta_{t})")
        sums = [f"sum(p * (1 - p) * x{i} * x{j}) AS a{i}_{j}" if j < k else f"sum((y - p) * x{i}) AS a{i}_{k}" for i, j in cells]
        ctes.append(f"e_{t}_0 AS MATERIALIZED (SELECT {', '.join(sums)} FROM p_{t})")
        for c in range(k - 1):
            rest = [f"a{i}_{j} - a{i}_{c} / a{c}_{c} * a{c}_{j} AS a{i}_{j}" if i > c else f"a{i}_{j}" for i, j in cells]
            ctes.append(f"e_{t}_{c + 1} AS MATERIALIZED (SELECT {', '.join(rest)} FROM e_{t}_{c})")
        ctes.append(f"s_{t}_{k} AS MATERIALIZED (SELECT * FROM e_{t}_{k - 1})")
        for c in reversed(range(k)):
            known = "".join(f" - a{c}_{j} * d{j}" for j in range(c + 1, k))
            ctes.append(f"s_{t}_{c} AS MATERIALIZED (SELECT *, (a{c}_{k}{known}) / a{c}_{c} AS d{c} FROM s_{t}_{c + 1})")
        ctes.append(f"beta_{t + 1} AS MATERIALIZED (SELECT " + ", ".join(f"b{i} + d{i} AS b{i}" for i in range(k)) + f" FROM beta_{t}, s_{t}_0)")
    ctes.append(f"fitted AS MATERIALIZED (SELECT * FROM beta_{steps}, span)")
    return ",\n".join(ctes)


_IN_TRAINING_SQL = f"{_md5_share_sql('l_orderkey')} < 80"
_LINE_NEWTON_SQL = _newton_sql(f"SELECT * FROM {FEATURES_SQL} WHERE {_IN_TRAINING_SQL}", LINE_SPEC.features)
_FITTED_PROBABILITY_SQL = "1 / (1 + exp(-(b0 + " + " + ".join(
    f"b{i} * ({c} - low{i}) / (high{i} - low{i})" for i, c in enumerate(LINE_SPEC.features, 1)
) + ")))"


def train_lines(spark, sf_dir):
    """Model and held-out rows."""
    first, second = model.split(feature_table(spark, sf_dir), 0.8, key="l_orderkey", method="md5")
    cores = spark.sparkContext.defaultParallelism
    return logistic_fit.fit_newton(first, LINE_SPEC, NEWTON_STEPS, partitions=cores), second


@query(
    "newton_coefficients",
    f"WITH {_LINE_NEWTON_SQL}, named AS (SELECT b0 AS intercept, "
    + ", ".join(f"b{i} AS {c}" for i, c in enumerate(LINE_SPEC.features, 1))
    + " FROM fitted) SELECT name, round(weight, 4) AS weight FROM (UNPIVOT named ON COLUMNS(*) INTO NAME name VALUE weight)",
)
def newton_coefficients(spark, sf_dir):
    """Coefficients after a fixed number of steps."""
    fitted, _ = train_lines(spark, sf_dir)
    rows = [("intercept", fitted.intercept), *zip(fitted.features, fitted.weights, strict=True)]
    return spark.createDataFrame(rows, "name string, weight double").withColumn("weight", F.round("weight", 4))


# --- metrics -----------------------------------------------------------------------

_LABELS_SQL = "(SELECT quality AS label, toxic AS prediction FROM labels)"
_LINE_PREDICTIONS_SQL = f"""(SELECT label, p1 AS score, CASE WHEN p1 > 0.5 THEN 1 ELSE 0 END AS prediction
  FROM (SELECT label, {_PROBABILITY_SQL} AS p1 FROM {_SCALED_SQL}))"""


def _labels(spark, sf_dir):
    return table(spark, sf_dir, "labels").select(
        F.col("quality").alias("label"), F.col("toxic").alias("prediction")
    )


def _line_predictions(spark, sf_dir):
    return scored_lines(spark, sf_dir).select(
        "label", F.col("p1").alias("score"), F.col("predicted_label").alias("prediction")
    )


@query("confusion", f"SELECT label, prediction, count(*) AS n FROM {_LABELS_SQL} GROUP BY ALL")
def confusion(spark, sf_dir):
    return evaluate.confusion(_labels(spark, sf_dir))


def _weighted_sql(source: str) -> str:
    return f"""WITH d AS (SELECT * FROM {source}),
      c AS (SELECT k, (SELECT count(*) FROM d WHERE label = k) AS of_class,
                   (SELECT count(*) FROM d WHERE prediction = k) AS as_class,
                   (SELECT count(*) FROM d WHERE label = k AND prediction = k) AS hits
            FROM (SELECT label AS k FROM d UNION SELECT prediction FROM d))
      SELECT round(sum(hits) / sum(of_class), 6) AS accuracy,
        round(sum(CASE WHEN as_class > 0 THEN hits / as_class ELSE 0 END * of_class) / sum(of_class), 6)
          AS weighted_precision,
        round(sum(CASE WHEN of_class > 0 THEN hits / of_class ELSE 0 END * of_class) / sum(of_class), 6)
          AS weighted_recall
      FROM c"""


def _rounded(df):
    return df.select(*[r6(c).alias(c) for c in df.columns])


@query("weighted_metrics", _weighted_sql(_LABELS_SQL))
def weighted_metrics(spark, sf_dir):
    return _rounded(evaluate.weighted_metrics(_labels(spark, sf_dir)))


@query("weighted_metrics_of_scores", _weighted_sql(_LINE_PREDICTIONS_SQL))
def weighted_metrics_of_scores(spark, sf_dir):
    return _rounded(evaluate.weighted_metrics(_line_predictions(spark, sf_dir)))


_POSITIVE_SQL = """SELECT round(tp / (tp + fp), 6) AS precision, round(tp / (tp + fn), 6) AS recall,
          round(tn / (tn + fp), 6) AS specificity, round(2 * tp / (2 * tp + fp + fn), 6) AS f1
        FROM (SELECT count(CASE WHEN label = 1 AND prediction = 1 THEN 1 END) AS tp,
                count(CASE WHEN label <> 1 AND prediction = 1 THEN 1 END) AS fp,
                count(CASE WHEN label = 1 AND prediction <> 1 THEN 1 END) AS fn,
                count(CASE WHEN label <> 1 AND prediction <> 1 THEN 1 END) AS tn
              FROM {source})"""


@query("positive_metrics", _POSITIVE_SQL.format(source=_LINE_PREDICTIONS_SQL))
def positive_metrics(spark, sf_dir):
    return _rounded(evaluate.positive_metrics(_line_predictions(spark, sf_dir)))


# Every quantity is shared by many lines, so a score stands for a group of equal rows.
_ROC_SOURCE_SQL = "(SELECT CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS label, l_quantity AS score FROM lineitem)"
_ROC_SQL = """WITH d AS (SELECT score, sum(label) AS p, sum(1 - label) AS n FROM {source} GROUP BY score),
  c AS (SELECT score, CAST(sum(p) OVER w AS BIGINT) AS tp, CAST(sum(n) OVER w AS BIGINT) AS fp,
               sum(p) OVER () AS ap, sum(n) OVER () AS an
        FROM d WINDOW w AS (ORDER BY score DESC))
  SELECT score AS threshold, tp AS true_positives, fp AS false_positives,
         round(tp / ap, 6) AS tpr, round(fp / an, 6) AS fpr FROM c"""
_AUC_SQL = """WITH d AS (SELECT score, sum(label) AS p, sum(1 - label) AS n FROM {source} GROUP BY score),
  c AS (SELECT score, sum(p) OVER w / sum(p) OVER () AS tpr, sum(n) OVER w / sum(n) OVER () AS fpr
        FROM d WINDOW w AS (ORDER BY score DESC)),
  s AS (SELECT tpr, fpr, coalesce(lag(tpr) OVER (ORDER BY score DESC), 0) AS t0,
               coalesce(lag(fpr) OVER (ORDER BY score DESC), 0) AS f0 FROM c)
  SELECT round(sum((fpr - f0) * (tpr + t0) / 2), 6) AS area_under_roc FROM s"""


def _return_scores(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").select(
        F.when(F.col("l_returnflag") == "R", 1).otherwise(0).alias("label"),
        F.col("l_quantity").alias("score"),
    )


def _price_scores(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").select(
        line_label(), F.col("l_extendedprice").alias("score")
    )


_PRICE_SOURCE_SQL = f"(SELECT {LINE_SPEC.label}, l_extendedprice AS score FROM {FEATURES_SQL})"


def _roc(df, ranges=None):
    curve = evaluate.roc_curve(df, ranges=ranges)
    return curve.withColumns({c: r6(c) for c in ("tpr", "fpr")})


@query("roc_curve", _ROC_SQL.format(source=_ROC_SOURCE_SQL))
def roc_curve(spark, sf_dir):
    return _roc(_return_scores(spark, sf_dir))


@query("roc_curve_split", _ROC_SQL.format(source=_PRICE_SOURCE_SQL))
def roc_curve_split(spark, sf_dir):
    """Nearly as many scores as rows, with the order cut into ranges."""
    return _roc(_price_scores(spark, sf_dir), ranges=16)


@query("area_under_roc", _AUC_SQL.format(source=_LINE_PREDICTIONS_SQL))
def area_under_roc(spark, sf_dir):
    return _rounded(evaluate.area_under_roc(_line_predictions(spark, sf_dir)))


@query("area_under_roc_split", _AUC_SQL.format(source=_PRICE_SOURCE_SQL))
def area_under_roc_split(spark, sf_dir):
    return _rounded(evaluate.area_under_roc(_price_scores(spark, sf_dir), ranges=16))


# --- training and scoring over whole tables ------------------------------------------


def _metrics_sql() -> str:
    source = "predicted"
    one = f"""SELECT * FROM ({_weighted_sql(source)}), ({_POSITIVE_SQL.format(source=source)}), ({_AUC_SQL.format(source=source)})"""
    return f"""WITH {_LINE_NEWTON_SQL},
      predicted AS MATERIALIZED (
        SELECT label, p AS score, CASE WHEN p > 0.5 THEN 1 ELSE 0 END AS prediction
        FROM (SELECT label, {_FITTED_PROBABILITY_SQL} AS p FROM {FEATURES_SQL}, fitted WHERE NOT {_IN_TRAINING_SQL})),
      metrics AS ({one})
      SELECT metric, round(value, 4) AS value FROM (UNPIVOT metrics ON COLUMNS(*) INTO NAME metric VALUE value)"""


def train_and_evaluate(spark, sf_dir):
    """Fit on four fifths of the line items, all metrics on the rest."""
    fitted, held_out = train_lines(spark, sf_dir)
    scored = logistic_fit.score_linear(held_out, fitted)
    metrics = evaluate.evaluate(scored, "label", "predicted_label", "malignant_probability")
    return metrics.withColumn("value", F.round("value", 4))


query("train_and_evaluate", _metrics_sql())(train_and_evaluate)


@query(
    "score_with_saved_model",
    f"""WITH {_LINE_NEWTON_SQL}
      SELECT l_orderkey, l_linenumber, {", ".join(LINE_SPEC.features)}, label,
        CASE WHEN p > 0.5 THEN 1 ELSE 0 END AS predicted_label, round(1 - p, 6) AS benign_probability,
        round(p, 6) AS malignant_probability
      FROM (SELECT l.*, {_FITTED_PROBABILITY_SQL} AS p FROM {FEATURES_SQL} l, fitted)""",
)
def score_with_saved_model(spark, sf_dir):
    """Fit, save, load, and score every line item with what was loaded."""
    fitted, _ = train_lines(spark, sf_dir)
    path = scratch_folder(spark, "model")
    fitted.save(spark, path)
    loaded = logistic_fit.LinearModel.load(spark, path)
    scored = logistic_fit.score_linear(feature_table(spark, sf_dir), loaded)
    return scored.withColumns({c: r6(c) for c in ("benign_probability", "malignant_probability")})


@query(
    "train_by_stages",
    f"SELECT count(*) AS rows, true AS near FROM {FEATURES_SQL}",
)
def train_by_stages(spark, sf_dir):
    """The classifier of the ML library, saved and loaded: it and the Newton steps, which reach the same
    maximum, differ by less than two hundredths in every probability."""
    first, _ = model.split(feature_table(spark, sf_dir), 0.8, key="l_orderkey", method="md5")
    staged = model.train(first, LINE_SPEC, max_iter=60, partitions=spark.sparkContext.defaultParallelism)
    path = scratch_folder(spark, "model")
    model.save_model(staged, LINE_SPEC, path)
    loaded, spec = model.load_model(path)
    by_stages = model.score(feature_table(spark, sf_dir), loaded, spec)
    renamed = by_stages.withColumnRenamed("malignant_probability", "p_stages").drop("benign_probability", "predicted_label")
    both = logistic_fit.score_linear(renamed, logistic_fit.fit_newton(first, LINE_SPEC, NEWTON_STEPS))
    apart = F.abs(F.col("malignant_probability") - F.col("p_stages"))
    return both.agg(F.count(F.lit(1)).alias("rows"), (F.max(apart) < 0.02).alias("near"))


# --- all 64 columns of the embeddings ----------------------------------------------

WIDE = tuple(f"e{i}" for i in range(64))
_WIDE_SPEC = FeatureSpec(WIDE, "label")
_WIDE_WEIGHTS = [float(i % 7 - 3) for i in range(64)]


def _wide(spark, sf_dir):
    vectors = table(spark, sf_dir, "embeddings")
    values = [F.get("embedding", F.lit(i)).cast("double").alias(n) for i, n in enumerate(WIDE)]
    return vectors.select("vec_id", *values, (F.col("label") < 5).cast("int").alias("label"))


@query(
    "wide_scores",
    "SELECT vec_id, round(1 / (1 + exp(-("
    + " + ".join(
        f"{w} * (e{i} - min(e{i}) OVER ()) / (max(e{i}) OVER () - min(e{i}) OVER ())" for i, w in enumerate(_WIDE_WEIGHTS)
    )
    + "))), 6) AS malignant_probability FROM (SELECT vec_id, "
    + ", ".join(f"CAST(embedding[{i + 1}] AS DOUBLE) AS e{i}" for i in range(64))
    + " FROM embeddings)",
)
def wide_scores(spark, sf_dir):
    """All 64 columns scaled and scored with fixed coefficients, in generated code."""
    wide = _wide(spark, sf_dir)
    ranges = features.fit_ranges(wide, WIDE)
    low, high = (tuple(ranges[c][k] for c in WIDE) for k in (0, 1))
    scored = logistic_fit.score_linear(wide, logistic_fit.LinearModel(WIDE, low, high, tuple(_WIDE_WEIGHTS), 0.0))
    return scored.select("vec_id", r6("malignant_probability").alias("malignant_probability"))


@query(
    "wide_training",
    "SELECT count(*) AS rows, 64 AS features, true AS at_maximum FROM embeddings",
)
def wide_training(spark, sf_dir):
    """A classifier over all 64 columns; the gradient of the penalized likelihood at its coefficients,
    summed over every row, is zero but for rounding."""
    wide = _wide(spark, sf_dir)
    fitted = logistic_fit.fit_newton(wide, _WIDE_SPEC, 5, ridge=1.0, method="matrix")
    slope = float(abs(logistic_fit.gradient_of(wide, fitted, "label", ridge=1.0)).max())
    return wide.agg(
        F.count(F.lit(1)).alias("rows"), F.lit(len(fitted.weights)).alias("features"), F.lit(slope < 1e-6).alias("at_maximum")
    )
