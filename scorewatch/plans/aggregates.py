"""Counts, histograms, quartiles, correlations."""

from __future__ import annotations

from itertools import combinations_with_replacement

from pyspark.sql import functions as F

from scorewatch.functions import columns as C
from scorewatch.operators import bins, clean, correlation, counts, points, quality, quantiles
from scorewatch.plans.registry import (
    COHORT_SQL,
    FEATURES_SQL,
    GAPS_SQL,
    LINE_SPEC,
    SCORED_SQL,
    cohort,
    feature_table,
    query,
    r6,
    scored_events,
    table,
    with_gaps,
)

GAP_COLUMNS = ("event_id", "ts", "event_type", "value", "k")


def _missing_sql(column: str, test: str) -> str:
    return f"""SELECT '{column}' AS "column", CAST(sum(CASE WHEN {test} THEN 1 ELSE 0 END) AS BIGINT)
      AS missing_count, round(sum(CASE WHEN {test} THEN 1 ELSE 0 END) * 100.0 / count(*), 4)
      AS missing_percent FROM g"""


@query(
    "missing_report",
    f"WITH g AS (SELECT * FROM {GAPS_SQL}) "
    + " UNION ALL ".join(
        _missing_sql(c, f"{c} IS NULL OR isnan({c})" if c in ("value", "k") else f"{c} IS NULL")
        for c in GAP_COLUMNS
    ),
)
def missing_report(spark, sf_dir):
    report = quality.missing_report(with_gaps(scored_events(spark, sf_dir)), GAP_COLUMNS)
    return report.withColumn("missing_percent", F.round("missing_percent", 4))


@query(
    "feature_ranges",
    " UNION ALL ".join(
        f"""SELECT '{c}' AS feature, CAST(0.0 AS DOUBLE) AS low,
            max(CASE WHEN NOT isnan({c}) THEN {c} END) AS high,
            round(avg(CASE WHEN NOT isnan({c}) THEN {c} END), 6) AS mean FROM {GAPS_SQL}"""
        for c in ("value", "k")
    ),
)
def feature_ranges(spark, sf_dir):
    ranges = quality.feature_ranges(with_gaps(scored_events(spark, sf_dir)), ["value", "k"])
    return ranges.withColumn("mean", r6("mean"))


@query("row_count", f"SELECT count(*) AS n FROM {SCORED_SQL}")
def row_count(spark, sf_dir):
    return counts.row_count(scored_events(spark, sf_dir))


@query(
    "label_counts",
    f"""SELECT l AS predicted_label, count(event_id) AS n
        FROM (SELECT unnest([0, 1, 2]) AS l) LEFT JOIN {SCORED_SQL} ON predicted_label = l GROUP BY l""",
)
def label_counts(spark, sf_dir):
    return counts.label_counts(scored_events(spark, sf_dir), labels=(0, 1, 2))


def _unlabeled(spark, sf_dir):
    scored = scored_events(spark, sf_dir)
    label = F.when(F.col("event_id") % 13 != 0, F.col("predicted_label"))
    return scored.withColumn("predicted_label", label)


_UNLABELED_SQL = f"""(SELECT event_type, CASE WHEN event_id % 13 <> 0 THEN predicted_label END
  AS predicted_label FROM {SCORED_SQL})"""


def _summary_sql(positives: str) -> str:
    return f"""SELECT event_type, total, negatives, {positives} AS positives, unlabeled,
        round(negatives / total * 100, 1) AS negative_percent,
        round(({positives}) / total * 100, 1) AS positive_percent
      FROM (SELECT event_type, count(*) AS total,
              count(CASE WHEN predicted_label = 0 THEN 1 END) AS negatives,
              count(CASE WHEN predicted_label = 1 THEN 1 END) AS positives,
              count(CASE WHEN predicted_label IS NULL THEN 1 END) AS unlabeled
            FROM {_UNLABELED_SQL} GROUP BY event_type)"""


@query("summary", _summary_sql("positives"))
def summary(spark, sf_dir):
    return counts.summary(_unlabeled(spark, sf_dir), ["event_type"])


@query("summary_rest_positive", _summary_sql("total - negatives"))
def summary_rest_positive(spark, sf_dir):
    return counts.summary(_unlabeled(spark, sf_dir), ["event_type"], rest_is_positive=True)


def _bin_sql(c: str, lo: float, hi: float, n: int) -> str:
    inner = f"least(floor(({c} - {lo}) / (({hi} - {lo}) / {n})), {n - 1})"
    return f"CAST(CASE WHEN {c} < {lo} THEN -1 WHEN {c} > {hi} THEN {n} ELSE {inner} END AS BIGINT)"


@query(
    "histogram",
    f"""SELECT {_bin_sql('l_extendedprice', 0.0, 100000.0, 20)} AS bin, label, count(*) AS n
        FROM {FEATURES_SQL} GROUP BY 1, 2""",
)
def histogram(spark, sf_dir):
    lines = feature_table(spark, sf_dir)
    return bins.histogram(lines, "l_extendedprice", ["label"], 20, 0.0, 100000.0)


@query(
    "histogram_found_range",
    f"""SELECT {_bin_sql('value', 'lo', 'hi', 12)} AS bin, event_type, count(*) AS n
        FROM {GAPS_SQL}, (SELECT min(value) AS lo, max(value) AS hi FROM {GAPS_SQL})
        WHERE value IS NOT NULL GROUP BY 1, 2""",
)
def histogram_found_range(spark, sf_dir):
    gaps = with_gaps(scored_events(spark, sf_dir))
    return bins.histogram(gaps, "value", ["event_type"], 12)


@query(
    "weighted_histogram",
    f"""SELECT {_bin_sql('l_quantity', 0.0, 50.0, 10)} AS bin, l_returnflag,
          round(sum(l_extendedprice), 2) AS total
        FROM lineitem WHERE l_quantity BETWEEN 0 AND 50 GROUP BY 1, 2""",
)
def weighted_histogram(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem")
    hist = bins.histogram(
        lines, "l_quantity", ["l_returnflag"], 10, 0.0, 50.0, weight="l_extendedprice"
    )
    return hist.withColumn("total", F.round("total", 2))


@query(
    "confidence_histogram",
    f"""SELECT {_bin_sql('c', 0.0, 100.0, 20)} AS bin, predicted_label, count(*) AS n
        FROM (SELECT predicted_label, CASE WHEN predicted_label = 1 THEN p1 ELSE p0 END * 100 AS c
              FROM {SCORED_SQL}) GROUP BY 1, 2""",
)
def confidence_histogram(spark, sf_dir):
    sure = scored_events(spark, sf_dir).select(
        "predicted_label", C.confidence("predicted_label", F.array("p0", "p1")).alias("c")
    )
    return bins.histogram(sure, "c", ["predicted_label"], 20, 0.0, 100.0)


@query(
    "age_histogram",
    f"""SELECT {_bin_sql('a', 18.0, 90.0, 12)} AS bin, risk, count(*) AS n
        FROM (SELECT greatest(18, least(age, 90)) AS a, risk FROM {COHORT_SQL}) GROUP BY 1, 2""",
)
def age_histogram(spark, sf_dir):
    clamped = cohort(spark, sf_dir).withColumn("age", C.clamp("age", 18, 90))
    return bins.histogram(clamped, "age", ["risk"], 12, 18.0, 90.0)


@query(
    "histogram2d",
    f"""SELECT x AS x_bin, y AS y_bin,
          CASE WHEN grouping(x) = 0 AND grouping(y) = 0 THEN 'cell'
               WHEN grouping(x) = 0 THEN 'x_margin' ELSE 'y_margin' END AS part, count(*) AS n
        FROM (SELECT {_bin_sql('l_quantity', 0.0, 50.0, 10)} AS x,
                     {_bin_sql('l_extendedprice', 0.0, 100000.0, 10)} AS y
              FROM lineitem)
        GROUP BY GROUPING SETS ((x, y), (x), (y))""",
)
def histogram2d(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem")
    return bins.histogram2d(
        lines, "l_quantity", "l_extendedprice", 10, (0.0, 50.0), (0.0, 100000.0)
    )


_BOX_SQL = """WITH d AS (SELECT {by} AS g, {c} AS v FROM {source} WHERE {c} IS NOT NULL),
  q AS (SELECT g, count(*) AS n, quantile_cont(v, 0.25) AS q1, quantile_cont(v, 0.5) AS median,
               quantile_cont(v, 0.75) AS q3 FROM d GROUP BY g)
SELECT q.g AS {by}, n, round(q1, 6) AS q1, round(median, 6) AS median, round(q3, 6) AS q3,
  round(min(CASE WHEN v BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1) THEN v END), 6) AS whisker_low,
  round(max(CASE WHEN v BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1) THEN v END), 6) AS whisker_high,
  count(CASE WHEN NOT v BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1) THEN 1 END) AS outliers
FROM d JOIN q ON d.g = q.g GROUP BY ALL"""


def _box(df, column, by, ranges=None):
    stats = quantiles.box_stats(df, column, [by], ranges)
    return stats.withColumns({c: r6(c) for c in ("q1", "median", "q3", "whisker_low", "whisker_high")})


@query("box_stats", _BOX_SQL.format(by="event_type", c="value", source=GAPS_SQL))
def box_stats(spark, sf_dir):
    return _box(with_gaps(scored_events(spark, sf_dir)), "value", "event_type")


@query("box_stats_split", _BOX_SQL.format(by="l_returnflag", c="l_extendedprice", source="lineitem"))
def box_stats_split(spark, sf_dir):
    """The same with the order cut into ranges, as on a table too large for one task per group."""
    return _box(table(spark, sf_dir, "lineitem"), "l_extendedprice", "l_returnflag", ranges=16)


@query("approximate_quartiles")
def approximate_quartiles(spark, sf_dir):
    return quantiles.approximate_quantiles(
        table(spark, sf_dir, "lineitem"), "l_extendedprice", ["l_returnflag"]
    )


QUARTILE_ACCURACY = 1000


@query(
    "approximate_quartile_errors",
    f"""SELECT l_returnflag, count(*) AS n, true AS q1, true AS median, true AS q3, count(*) // {QUARTILE_ACCURACY} + 1 AS bound
        FROM lineitem GROUP BY 1""",
)
def approximate_quartile_errors(spark, sf_dir):
    """Whether each sketched quartile is within its bound, a thousandth of the rows, of its rank: measured
    against the counted values."""
    lines, by = table(spark, sf_dir, "lineitem"), ["l_returnflag"]
    found = quantiles.approximate_quantiles(lines, "l_extendedprice", by, accuracy=QUARTILE_ACCURACY)
    errors = quantiles.rank_errors(lines, "l_extendedprice", found, by)
    bound = F.floor(F.col("n") / QUARTILE_ACCURACY) + 1
    return errors.select(*by, "n", *[(F.col(q) <= bound).alias(q) for q in quantiles.QUARTILES], bound.alias("bound"))


def _bars_sql(base: str) -> str:
    return f"""SELECT event_type, predicted_label, round(height, 4) AS height, {base} AS base
      FROM (SELECT event_type, predicted_label, sum(value - 30) AS height FROM {SCORED_SQL}
            GROUP BY event_type, predicted_label)"""


def _running_base(keys: str) -> str:
    return f"""round(coalesce(sum(height) OVER (PARTITION BY {keys} ORDER BY predicted_label
      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0), 4)"""


def _bars(spark, sf_dir, mode):
    shifted = scored_events(spark, sf_dir).withColumn("value", F.col("value") - 30)
    bars = counts.bar_table(shifted, "event_type", "value", "predicted_label", mode)
    return bars.withColumns({c: F.round(c, 4) for c in ("height", "base")})


@query("bars_grouped", _bars_sql("CAST(0.0 AS DOUBLE)"))
def bars_grouped(spark, sf_dir):
    return _bars(spark, sf_dir, "group")


@query("bars_stacked", _bars_sql(_running_base("event_type")))
def bars_stacked(spark, sf_dir):
    return _bars(spark, sf_dir, "stack")


@query("bars_relative", _bars_sql(_running_base("event_type, height < 0")))
def bars_relative(spark, sf_dir):
    return _bars(spark, sf_dir, "relative")


@query(
    "hourly_pattern",
    f"""SELECT hour(ts) AS hour,
          nullif(count(CASE WHEN predicted_label = 0 THEN 1 END), 0) AS label_0,
          nullif(count(CASE WHEN predicted_label = 1 THEN 1 END), 0) AS label_1
        FROM {SCORED_SQL} GROUP BY 1""",
)
def hourly_pattern(spark, sf_dir):
    hours = counts.hourly_pattern(scored_events(spark, sf_dir))
    return hours.withColumn("hour", F.col("hour").cast("bigint"))


@query(
    "cohort_counts",
    f"""SELECT gender, CASE WHEN age >= 76 THEN '76+' WHEN age >= 61 THEN '61-75'
          WHEN age >= 46 THEN '46-60' WHEN age >= 31 THEN '31-45' WHEN age >= 18 THEN '18-30' END
          AS age_group, risk, count(*) AS n FROM {COHORT_SQL} GROUP BY ALL""",
)
def cohort_counts(spark, sf_dir):
    people = cohort(spark, sf_dir).withColumn("age_group", C.bucket("age"))
    return counts.cohort_counts(people, ["gender", "age_group", "risk"])


@query(
    "cohort_cube",
    f"""SELECT gender, risk, count(*) AS n, CAST(grouping(gender, risk) AS BIGINT) AS grouping_set
        FROM {COHORT_SQL} GROUP BY CUBE (gender, risk)""",
)
def cohort_cube(spark, sf_dir):
    return counts.cohort_counts(cohort(spark, sf_dir), ["gender", "risk"], totals="cube")


NORMAL = {"click": (5, 60), "error": (10, 50), "purchase": (2, 40), "view": (1, 90), "signup": (15, 45)}
_NORMAL_SQL = "(VALUES " + ", ".join(f"('{s}', {a}, {b})" for s, (a, b) in NORMAL.items()) + ")"


@query(
    "percent_outside",
    f"""SELECT event_type, round(p, 4) AS percent_outside,
          CASE WHEN p > 15 THEN 'red' WHEN p > 10 THEN 'orange' ELSE 'yellow' END AS color
        FROM (SELECT event_type, avg(CASE WHEN value BETWEEN lo AND hi THEN 0 ELSE 1 END) * 100 AS p
              FROM events JOIN {_NORMAL_SQL} r(s, lo, hi) ON event_type = s GROUP BY event_type)""",
)
def percent_outside(spark, sf_dir):
    outside = counts.percent_outside(table(spark, sf_dir, "events"), NORMAL, "event_type", "value")
    return outside.select(
        "event_type",
        F.round("percent_outside", 4).alias("percent_outside"),
        C.severity("percent_outside").alias("color"),
    )


@query(
    "contributions",
    """SELECT event_type, round(w, 4) AS weight, round(w / sum(w) OVER () * 100, 4) AS percent
       FROM (SELECT event_type, sum(value) AS w FROM events GROUP BY event_type)""",
)
def contributions(spark, sf_dir):
    parts = counts.contributions(table(spark, sf_dir, "events"), "event_type", "value")
    return parts.withColumns({c: F.round(c, 4) for c in ("weight", "percent")})


@query(
    "category_share",
    """SELECT p_type, count(*) AS n, round(count(*) / sum(count(*)) OVER () * 100, 1) AS percent
       FROM part GROUP BY p_type""",
)
def category_share(spark, sf_dir):
    return counts.category_share(table(spark, sf_dir, "part"), "p_type")


@query("distinct_values", "SELECT DISTINCT p_type FROM part")
def distinct_values(spark, sf_dir):
    return clean.distinct_values(table(spark, sf_dir, "part"), "p_type")


# --- correlation -------------------------------------------------------------------


def _corr_sql(a: str, b: str, source: str) -> str:
    def known(c: str) -> str:
        return f"CASE WHEN NOT isnan(CAST({c} AS DOUBLE)) THEN CAST({c} AS DOUBLE) END"

    return f"""SELECT '{a}' AS a, '{b}' AS b,
      CASE WHEN isnan(r) THEN NULL ELSE round(r, 6) END AS r
      FROM (SELECT corr({known(a)}, {known(b)}) AS r FROM {source})"""


def _corr_union(columns, source: str) -> str:
    pairs = combinations_with_replacement(columns, 2)
    return " UNION ALL ".join(_corr_sql(a, b, source) for a, b in pairs)


@query("correlation_matrix", _corr_union(LINE_SPEC.features, "lineitem"))
def correlation_matrix(spark, sf_dir):
    upper = correlation.corr_matrix(table(spark, sf_dir, "lineitem"), LINE_SPEC.features)
    return upper.withColumn("r", r6("r"))


_GAP_FEATURES = ("value", "k", "p1", "user_id", "constant")
_GAP_CONSTANT_SQL = f"(SELECT *, 7 AS constant FROM {GAPS_SQL})"


def _gap_correlation(spark, sf_dir, method, columns=_GAP_FEATURES):
    gaps = with_gaps(scored_events(spark, sf_dir)).withColumn("constant", F.lit(7))
    return correlation.corr_matrix(gaps, columns, method).withColumn("r", r6("r"))


@query("correlation_with_gaps", _corr_union(_GAP_FEATURES, _GAP_CONSTANT_SQL))
def correlation_with_gaps(spark, sf_dir):
    return _gap_correlation(spark, sf_dir, "matrix")


@query("correlation_few_columns", _corr_union(_GAP_FEATURES[:3], _GAP_CONSTANT_SQL))
def correlation_few_columns(spark, sf_dir):
    """A few columns in one JVM aggregation, without Python on the executors."""
    return _gap_correlation(spark, sf_dir, "pairs", _GAP_FEATURES[:3])


@query("correlation_with_gaps_by_matrix", _corr_union(_GAP_FEATURES, _GAP_CONSTANT_SQL))
def correlation_with_gaps_by_matrix(spark, sf_dir):
    return _gap_correlation(spark, sf_dir, "matrix")


@query(
    "embedding_correlation",
    """WITH e AS (SELECT vec_id, unnest(range(64)) AS i, CAST(unnest(embedding) AS DOUBLE) AS v FROM embeddings)
       SELECT 'd' || x.i AS a, 'd' || y.i AS b, round(corr(x.v, y.v), 6) AS r
       FROM e x JOIN e y ON x.vec_id = y.vec_id AND x.i <= y.i GROUP BY x.i, y.i""",
)
def embedding_correlation(spark, sf_dir):
    """All 2,080 pairs of 64 dimensions: the wide case, done with matrix products."""
    vectors = table(spark, sf_dir, "embeddings")
    names = [f"d{i}" for i in range(64)]
    wide = vectors.select(*[F.get("embedding", F.lit(i)).alias(n) for i, n in enumerate(names)])
    return correlation.corr_matrix(wide, names).withColumn("r", r6("r"))


@query(
    "correlation_heatmap",
    " UNION ALL ".join(
        _corr_sql(a, b, "lineitem") for a in LINE_SPEC.features for b in LINE_SPEC.features
    ),
)
def correlation_heatmap(spark, sf_dir):
    upper = correlation.corr_matrix(table(spark, sf_dir, "lineitem"), LINE_SPEC.features)
    return correlation.full_matrix(upper).withColumn("r", r6("r"))


@query(
    "label_correlation",
    "WITH c AS ("
    + " UNION ALL ".join(
        f"SELECT '{c}' AS feature, corr({c}, label) AS r FROM {FEATURES_SQL}" for c in LINE_SPEC.features
    )
    + """) SELECT feature, round(abs(r), 6) AS correlation, round(r, 6) AS original_correlation,
          CAST(row_number() OVER (ORDER BY abs(r) DESC, feature) AS INTEGER) AS rank FROM c""",
)
def label_correlation(spark, sf_dir):
    ranked = correlation.label_correlation(
        feature_table(spark, sf_dir), LINE_SPEC.features, LINE_SPEC.label
    )
    return ranked.withColumns({c: r6(c) for c in ("correlation", "original_correlation")})


# --- chart points ------------------------------------------------------------------


@query("points_2d", f"SELECT l_quantity, l_extendedprice, label FROM {FEATURES_SQL}")
def points_2d(spark, sf_dir):
    return points.points(feature_table(spark, sf_dir), ["l_quantity", "l_extendedprice"], "label")


@query("points_3d", f"SELECT l_quantity, l_discount, l_extendedprice, label FROM {FEATURES_SQL}")
def points_3d(spark, sf_dir):
    axes = ["l_quantity", "l_discount", "l_extendedprice"]
    return points.points(feature_table(spark, sf_dir), axes, "label")


@query("line_points", f"SELECT ts, value FROM {SCORED_SQL}")
def line_points(spark, sf_dir):
    return points.points(scored_events(spark, sf_dir), ["ts", "value"], sort=True)
