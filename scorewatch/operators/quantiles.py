"""Exact quartiles and box summaries without holding a group in memory."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scorewatch.functions.columns import nan_to_null
from scorewatch.operators.ordered import running_sums

QUARTILES = {"q1": 0.25, "median": 0.5, "q3": 0.75}


def _value_counts(df: DataFrame, column: str, by: Sequence[str]) -> DataFrame:
    return (
        df.select(*by, nan_to_null(column).alias("_value"))
        .filter(F.col("_value").isNotNull())
        .groupBy(*by, "_value")
        .agg(F.count(F.lit(1)).alias("_n"))
    )


def _at_rank(rank: Column) -> Column:
    """The value whose rows cover a rank counted from 0."""
    covers = (F.col("_seen") - F.col("_n") <= rank) & (rank < F.col("_seen"))
    return F.max(F.when(covers, F.col("_value")))


def quantiles(
    df: DataFrame,
    column: str,
    by: Sequence[str] = (),
    probabilities: dict[str, float] = QUARTILES,
    ranges: int | None = None,
) -> DataFrame:
    """Linearly interpolated quantiles per group, and ``n``.

    Equal values are counted first and ranked by running sums of the counts, so a group
    of any size is spread over tasks. ``percentile`` would keep every distinct value of
    a group in the memory of one.
    """
    counts = _value_counts(df, column, by)
    ranked = running_sums(counts, by, ["_value"], {"_seen": "_n"}, {"_total": "_n"}, ranges)
    position = {n: F.lit(p) * (F.col("_total") - 1) for n, p in probabilities.items()}
    found = ranked.groupBy(*by).agg(
        F.sum("_n").alias("n"),
        *[_at_rank(F.floor(r)).alias(f"_low_{n}") for n, r in position.items()],
        *[_at_rank(F.ceil(r)).alias(f"_high_{n}") for n, r in position.items()],
    )

    def between(n: str, p: float) -> Column:
        at = F.lit(p) * (F.col("n") - 1)
        return F.col(f"_low_{n}") + (F.col(f"_high_{n}") - F.col(f"_low_{n}")) * (at - F.floor(at))

    return found.select(*by, "n", *[between(n, p).alias(n) for n, p in probabilities.items()])


def approximate_quantiles(
    df: DataFrame,
    column: str,
    by: Sequence[str] = (),
    probabilities: dict[str, float] = QUARTILES,
    accuracy: int = 10_000,
) -> DataFrame:
    """The same by sketch, in one pass: rank error at most n / accuracy, no interpolation."""
    c = nan_to_null(column)
    sketch = F.percentile_approx(c, list(probabilities.values()), accuracy)
    found = df.groupBy(*by).agg(F.count(c).alias("n"), sketch.alias("_q"))
    return found.select(
        *by, "n", *[F.get("_q", F.lit(i)).alias(n) for i, n in enumerate(probabilities)]
    )


def rank_errors(
    df: DataFrame, column: str, found: DataFrame, by: Sequence[str] = (), probabilities: dict[str, float] = QUARTILES
) -> DataFrame:
    """How far, in rows, each quantile of ``found`` is from the rank it stands for; and ``n``.

    Measured against counted values: a quantile stands for the ranks that its equal rows cover, from
    1 + the rows below it. ``found`` has one row per group, which is joined to value counts.
    """
    key = F.struct(F.lit(0).alias("_0"), *by)
    counts = _value_counts(df, column, by).select(key.alias("_key"), "_value", "_n")
    joined = counts.join(found.select(key.alias("_key"), *[F.col(n).alias(f"_at_{n}") for n in probabilities]), "_key")

    def rows(which: Column) -> Column:
        return F.sum(F.when(which, F.col("_n")).otherwise(0))

    ranks = joined.groupBy("_key").agg(
        F.sum("_n").alias("n"),
        *[rows(F.col("_value") < F.col(f"_at_{n}")).alias(f"_below_{n}") for n in probabilities],
        *[rows(F.col("_value") <= F.col(f"_at_{n}")).alias(f"_upto_{n}") for n in probabilities],
    )

    def error(n: str, p: float) -> Column:
        wanted = F.ceil(F.lit(p) * F.col("n"))
        return F.greatest(F.lit(0), F.col(f"_below_{n}") + 1 - wanted, wanted - F.col(f"_upto_{n}")).cast("bigint")

    return ranks.select(*[F.col(f"_key.{c}").alias(c) for c in by], "n", *[error(n, p).alias(n) for n, p in probabilities.items()])


def box_stats(
    df: DataFrame, column: str, by: Sequence[str] = (), ranges: int | None = None
) -> DataFrame:
    """Quartiles, whiskers (furthest values within 1.5 quartile ranges) and outlier count."""
    quartiles = quantiles(df, column, by, QUARTILES, ranges)
    reach = 1.5 * (F.col("q3") - F.col("q1"))
    fenced = quartiles.withColumns({"_from": F.col("q1") - reach, "_to": F.col("q3") + reach})
    # Joined to value counts, not rows: a hot group has one row per distinct value here.
    key = F.struct(F.lit(0).alias("_0"), *by)
    counts = _value_counts(df, column, by).select(key.alias("_key"), "_value", "_n")
    joined = counts.join(fenced.withColumn("_key", key), "_key")
    inside = F.col("_value").between(F.col("_from"), F.col("_to"))
    return joined.groupBy(*by, "n", "q1", "median", "q3").agg(
        F.min(F.when(inside, F.col("_value"))).alias("whisker_low"),
        F.max(F.when(inside, F.col("_value"))).alias("whisker_high"),
        F.sum(F.when(inside, 0).otherwise(F.col("_n"))).alias("outliers"),
    )
