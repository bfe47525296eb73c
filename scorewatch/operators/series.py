"""Questions about records in time order."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from scorewatch.operators.ordered import previous_row, running_sums


def _same_type(df: DataFrame, ts: str, c: Column) -> Column:
    """date_trunc returns a timestamp with zone; give back the type of the source column."""
    return c.cast(dict(df.dtypes)[ts])


def cumulative_counts(
    df: DataFrame,
    ts: str = "ts",
    label: str = "predicted_label",
    labels: Sequence[int] = (0, 1),
    grain: str | None = None,
    ranges: int | None = None,
) -> DataFrame:
    """Running number of rows per label over time; rows without a timestamp are left out."""
    kept = df.filter(F.col(ts).isNotNull() & F.col(label).isin(list(labels)))
    if grain is not None:
        kept = kept.withColumn(ts, _same_type(df, ts, F.date_trunc(grain, ts)))
    counted = kept.groupBy(label, ts).agg(F.count(F.lit(1)).alias("n"))
    return running_sums(counted, [label], [ts], {"cumulative": "n"}, ranges=ranges)


def dedup_consecutive(
    df: DataFrame, ts: str, order: Sequence[str], by: Sequence[str] = (), ranges: int | None = None
) -> DataFrame:
    """Drop a record whose timestamp equals that of the record before it in ``order``."""
    seen = previous_row(df, by, order, [ts], "_before", ranges)
    keep = F.col("_before").isNull() | ~F.col(ts).eqNullSafe(F.col("_before").getField(ts))
    return seen.filter(keep).drop("_before")


def last_n(
    df: DataFrame, n: int, order: Sequence[str], by: Sequence[str] = (), ranges: int | None = None
) -> DataFrame:
    """The newest n rows, overall or per key.

    Overall, each task keeps its own n rows before they meet. Per key, Spark keeps n rows
    per key on each side of the shuffle as long as n is below
    ``spark.sql.optimizer.windowGroupLimitThreshold``. Above it rows are numbered from both ends by
    counted ranges (``operators.ordered``), so that no task holds all rows of one key, at any n.
    """
    newest = [F.desc(c) for c in order]
    if not by:
        return df.orderBy(*newest).limit(n)
    limit = int(df.sparkSession.conf.get("spark.sql.optimizer.windowGroupLimitThreshold", "1000"))
    if n > limit:
        one = df.withColumn("_one", F.lit(1).cast("bigint"))
        numbered = running_sums(one, by, order, {"_place": "_one"}, {"_all": "_one"}, ranges)
        return numbered.filter(F.col("_all") - F.col("_place") < n).select(*df.columns)
    rank = F.row_number().over(Window.partitionBy(*by).orderBy(*newest))
    return df.withColumn("_rank", rank).filter(F.col("_rank") <= n).drop("_rank")


def recent(df: DataFrame, n: int, order: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """The n most recent rows, a few columns."""
    return last_n(df.select(*dict.fromkeys([*columns, *order])), n, order).select(*columns)


def latest(df: DataFrame, order: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """The last row, overall or per key."""
    return last_n(df, 1, order, by)


def since(df: DataFrame, order: Sequence[str], last_seen: Sequence[object]) -> DataFrame:
    """Rows after the last one seen, compared as a tuple.

    The plain test on the first column is implied; it is there to reach the scan.
    """
    types = dict(df.dtypes)
    seen = [F.lit(v).cast(types[c]) for c, v in zip(order, last_seen, strict=True)]
    first = F.col(order[0]) >= seen[0]
    # Equal field names on both sides: structs compare only when their types agree.
    later = F.struct(*order) > F.struct(*[v.alias(c) for c, v in zip(order, seen, strict=True)])
    return df.filter(first & later)


def with_delta(
    df: DataFrame, by: Sequence[str], order: Sequence[str], value: str, ranges: int | None = None
) -> DataFrame:
    """Add the change from the previous reading of the same key, null on the first."""
    seen = previous_row(df, by, order, [value], "_before", ranges)
    change = F.col(value) - F.col("_before").getField(value)
    return seen.withColumn("delta", change).drop("_before")


def recent_series(
    df: DataFrame,
    entity: str,
    signal: str,
    ts: str,
    value: str,
    signals: Sequence[str],
    minutes: int = 60,
    now: Column | None = None,
) -> DataFrame:
    """The last minutes per entity: one row per minute, one column per signal (mean value).

    The window ends at ``now``, or at the newest reading of each entity. With ``now`` the
    time filter reaches the scan.
    """
    span = F.expr(f"INTERVAL {int(minutes)} MINUTES")
    rows = df.select(entity, signal, ts, value)
    if now is not None:
        rows = rows.filter((F.col(ts) > now - span) & (F.col(ts) <= now))
    else:
        newest = rows.groupBy(entity).agg(F.max(ts).alias("_newest"))
        rows = rows.join(newest, entity).filter(F.col(ts) > F.col("_newest") - span)
    minute = _same_type(df, ts, F.date_trunc("minute", ts)).alias("minute")
    means = [F.avg(F.when(F.col(signal) == s, F.col(value))).alias(s) for s in signals]
    return rows.filter(F.col(signal).isin(list(signals))).groupBy(entity, minute).agg(*means)


def _checked(increment: str) -> Column:
    """The increment, 0.0 where it is missing; a negative one raises."""
    c = F.col(increment).cast("double")
    wrong = F.raise_error(F.lit("increments must not be negative")).cast("double")
    return F.when(c < 0, wrong).otherwise(F.coalesce(c, F.lit(0.0)))


def capped_cumsum(
    df: DataFrame,
    by: Sequence[str],
    order: Sequence[str],
    increment: str,
    start: float,
    cap: float = 1.0,
    ranges: int | None = None,
) -> DataFrame:
    """A score that grows by each increment and stops at the cap.

    Equal to capping after every step because increments are not negative; a negative one
    raises. A missing increment adds nothing.
    """
    summed = running_sums(
        df.withColumn("_step", _checked(increment)), by, order, {"_sum": "_step"}, ranges=ranges
    )
    risk = F.least(F.lit(float(cap)), F.lit(float(start)) + F.col("_sum"))
    return summed.withColumn("risk", risk).drop("_step", "_sum")


def risk_outlook(
    df: DataFrame, by: Sequence[str], increment: str, start: float, cap: float = 1.0
) -> DataFrame:
    """Current and predicted risk per key, and their difference.

    The end of the path of :func:`capped_cumsum`, which needs no order: one aggregation.
    """
    first = F.lit(float(start))
    ends = df.groupBy(*by).agg(F.sum(_checked(increment)).alias("_sum"))
    predicted = F.least(F.lit(float(cap)), first + F.col("_sum"))
    return ends.select(
        *by,
        predicted.alias("predicted_risk"),
        first.alias("current_risk"),
        (predicted - first).alias("difference"),
    )
