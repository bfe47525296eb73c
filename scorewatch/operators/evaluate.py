"""Classification metrics from a confusion matrix, and the ROC curve."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scorewatch.functions.columns import nan_to_null
from scorewatch.operators.ordered import running_sums


def confusion(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """Rows per label and prediction; rows without either are left out."""
    return (
        df.filter(F.col(label).isNotNull() & F.col(prediction).isNotNull())
        .groupBy(label, prediction)
        .agg(F.count(F.lit(1)).alias("n"))
    )


def weighted_metrics(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """Accuracy, and precision and recall averaged over the classes by their size.

    A class that is never predicted has precision 0.
    """
    cells = confusion(df, label, prediction).select(
        F.col(label).cast("double").alias("_l"), F.col(prediction).cast("double").alias("_p"), "n"
    )
    # Each cell counts once for its label and once for its prediction: sums per class
    # without joining the matrix to itself.
    hit = F.col("_l") == F.col("_p")
    both = cells.select(
        F.inline(
            F.array(
                F.struct(
                    F.col("_l").alias("class"),
                    F.col("n").alias("of_class"),
                    F.lit(0).cast("bigint").alias("as_class"),
                    F.when(hit, F.col("n")).otherwise(0).alias("hits"),
                ),
                F.struct(
                    F.col("_p").alias("class"),
                    F.lit(0).cast("bigint").alias("of_class"),
                    F.col("n").alias("as_class"),
                    F.lit(0).cast("bigint").alias("hits"),
                ),
            )
        )
    )
    per_class = both.groupBy("class").agg(
        *[F.sum(c).alias(c) for c in ("of_class", "as_class", "hits")]
    )
    precision = F.coalesce(F.try_divide("hits", "as_class"), F.lit(0.0))
    recall = F.coalesce(F.try_divide("hits", "of_class"), F.lit(0.0))
    return per_class.agg(
        F.try_divide(F.sum("hits"), F.sum("of_class")).alias("accuracy"),
        F.try_divide(F.sum(precision * F.col("of_class")), F.sum("of_class")).alias("weighted_precision"),
        F.try_divide(F.sum(recall * F.col("of_class")), F.sum("of_class")).alias("weighted_recall"),
    )


def positive_metrics(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """Precision, recall (sensitivity), specificity and F1 of class 1; null where undefined."""
    is_pos, said_pos = F.col(label) == 1, F.col(prediction) == 1

    def rows(which: Column) -> Column:
        return F.sum(F.when(which, F.col("n")).otherwise(0))

    cells = confusion(df, label, prediction).agg(
        rows(is_pos & said_pos).alias("tp"),
        rows(~is_pos & said_pos).alias("fp"),
        rows(is_pos & ~said_pos).alias("fn"),
        rows(~is_pos & ~said_pos).alias("tn"),
    )
    tp, fp, fn, tn = (F.col(c) for c in ("tp", "fp", "fn", "tn"))
    return cells.select(
        F.try_divide(tp, tp + fp).alias("precision"),
        F.try_divide(tp, tp + fn).alias("recall"),
        F.try_divide(tn, tn + fp).alias("specificity"),
        F.try_divide(2 * tp, 2 * tp + fp + fn).alias("f1"),
    )


def _hits_by_score(
    df: DataFrame, label: str, score: str, bins: int | None, ranges: int | None
) -> DataFrame:
    """Per distinct score: positives and negatives, running sums from the top, and totals."""
    s = nan_to_null(score)
    if bins is not None:
        s = F.floor(s * bins) / bins
    # Ascending order of the negated score is descending order of the score.
    scored = df.select(
        (-s).alias("_down"),
        (F.col(label) == 1).cast("bigint").alias("_pos"),
        (F.col(label) != 1).cast("bigint").alias("_neg"),
    )
    known = scored.filter(F.col("_pos").isNotNull() & F.col("_down").isNotNull())
    grouped = known.groupBy("_down").agg(F.sum("_pos").alias("_pos"), F.sum("_neg").alias("_neg"))
    return running_sums(
        grouped,
        [],
        ["_down"],
        {"true_positives": "_pos", "false_positives": "_neg"},
        {"_all_pos": "_pos", "_all_neg": "_neg"},
        ranges,
    )


def roc_curve(
    df: DataFrame,
    label: str = "label",
    score: str = "score",
    bins: int | None = None,
    ranges: int | None = None,
) -> DataFrame:
    """One point per distinct score, from the highest down.

    Every score at or above ``threshold`` counts as predicted positive. ``bins`` rounds
    scores down to 1/bins for a short curve to draw; without it the curve is exact.
    """
    hits = _hits_by_score(df, label, score, bins, ranges)
    return hits.select(
        (-F.col("_down")).alias("threshold"),
        "true_positives",
        "false_positives",
        F.try_divide("true_positives", "_all_pos").alias("tpr"),
        F.try_divide("false_positives", "_all_neg").alias("fpr"),
    )


def area_under_roc(
    df: DataFrame, label: str = "label", score: str = "score", ranges: int | None = None
) -> DataFrame:
    """Exact area by the trapezoid rule; null unless both classes occur.

    Each step adds its width, the negatives of that score, times its mean height, so no
    second ordered pass is needed for the point before.
    """
    hits = _hits_by_score(df, label, score, None, ranges)
    height: Column = F.col("true_positives") - F.col("_pos") / F.lit(2.0)
    # The totals are the same on every row.
    return hits.agg(
        F.try_divide(
            F.sum(F.col("_neg") * height),
            F.max("_all_pos").cast("double") * F.max("_all_neg").cast("double"),
        ).alias("area_under_roc")
    )


def evaluate(
    df: DataFrame,
    label: str = "label",
    prediction: str = "prediction",
    score: str | None = None,
    ranges: int | None = None,
) -> DataFrame:
    """All metrics in long form (metric, value).

    The metrics of labels come from one confusion matrix, whose shuffle both halves of the
    plan reuse; the area needs the rows by score and so a second pass.
    """
    frames = [weighted_metrics(df, label, prediction), positive_metrics(df, label, prediction)]
    if score is not None:
        frames.append(area_under_roc(df, label, score, ranges))
    long = [f.unpivot([], f.columns, "metric", "value") for f in frames]
    result = long[0]
    for part in long[1:]:
        result = result.unionByName(part)
    return result
