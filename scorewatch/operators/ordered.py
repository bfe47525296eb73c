"""Running sums and previous-row lookups that survive a hot key.

``sum(...) OVER (PARTITION BY key ORDER BY ...)`` sorts every row of a key in one task, so a
key with a third of the table stalls the job. Here rows are dealt by range of (key, order),
whatever the size of the table, and written with the number of their partition. The window
runs inside (partition, key). A key that lies in several partitions is the first or the last
of each of them, so what goes before it is known from two rows per partition: its share of
the sums, or its last row. These come back to the rows by partition number and key.

Numbers are read from the written table: dealing the rows a second time might cut them
elsewhere. Rows that are equal in key and order are never parted.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from scorewatch.session import stage

_PART = "_ordered_part"
_KEY = "_ordered_key"
_SHARE = "_ordered_share"


def _key_of(by: Sequence[str]) -> Column:
    # A struct compares null fields as equal, so that rows without a key are one key.
    return F.struct(F.lit(0).alias("_0"), *by)


def dealt(df: DataFrame, by: Sequence[str], order: Sequence[str], ranges: int | None = None) -> DataFrame:
    """The rows, written, with the number of their range of (key, order): ascending, nulls first.

    ``ranges`` is the number of partitions; Spark's setting decides without it.
    """
    columns = [F.col(c) for c in (*by, *order)]
    cut = df.repartitionByRange(*columns) if ranges is None else df.repartitionByRange(ranges, *columns)
    with _full_partitions(df.sparkSession):
        return stage(cut.withColumn(_PART, F.spark_partition_id()), "ordered")


@contextmanager
def _full_partitions(spark: SparkSession) -> Iterator[None]:
    """Small partitions are merged up to the advisory size: every edge between two costs a lookup."""
    name = "spark.sql.adaptive.coalescePartitions.parallelismFirst"
    before = spark.conf.get(name)
    spark.conf.set(name, "false")
    try:
        yield
    finally:
        spark.conf.set(name, before)


def _is_whole(rows: DataFrame) -> bool:
    """One partition, one file: nothing is carried anywhere."""
    return len(rows.inputFiles()) <= 1


def _edges(rows: DataFrame, by: Sequence[str], share: Column) -> DataFrame:
    """(partition, key, share) of the first and the last key of every partition."""
    per_key = rows.groupBy(_PART, _key_of(by).alias(_KEY)).agg(share.alias(_SHARE))
    at = F.struct(_KEY, _SHARE)
    ends = per_key.groupBy(_PART).agg(F.min_by(at, _KEY).alias("first"), F.max_by(at, _KEY).alias("last"))
    # A partition of one key has one end.
    return ends.select(
        _PART, F.inline(F.when(F.col(f"first.{_KEY}") == F.col(f"last.{_KEY}"), F.array("last")).otherwise(F.array("first", "last")))
    )


def _with_carried(rows: DataFrame, by: Sequence[str], carried: DataFrame) -> DataFrame:
    """Rows beside what is carried to their key; at most two rows per partition are broadcast."""
    carried = carried.withColumnsRenamed({_PART: "_carried_part", _KEY: "_carried_key"})
    here = (F.col(_PART) == F.col("_carried_part")) & (_key_of(by) == F.col("_carried_key"))
    return rows.join(F.broadcast(carried), here, "left")


def running_sums(
    df: DataFrame,
    by: Sequence[str],
    order: Sequence[str],
    sums: Mapping[str, str],
    totals: Mapping[str, str] | None = None,
    ranges: int | None = None,
) -> DataFrame:
    """Add inclusive running sums, and per-key totals, over an ascending unique order.

    ``sums`` and ``totals`` map a new column name to the column it adds up; every column must be
    non-null.
    """
    totals = dict(totals or {})
    rows = dealt(df, by, order, ranges)
    here = Window.partitionBy(_PART, *by)
    ahead = here.orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    local = rows.withColumns(
        {n: F.sum(c).over(ahead) for n, c in sums.items()} | {n: F.sum(c).over(here) for n, c in totals.items()}
    )
    if _is_whole(rows):
        return local.drop(_PART)
    parts = {f"s{i}": c for i, c in enumerate(sums.values())} | {f"t{i}": c for i, c in enumerate(totals.values())}
    edges = _edges(rows, by, F.struct(*[F.sum(c).alias(p) for p, c in parts.items()]))
    # As many rows of a key as there are partitions at most.
    of_key = Window.partitionBy(_KEY)
    earlier = of_key.orderBy(_PART).rowsBetween(Window.unboundedPreceding, -1)
    carried = edges.select(
        _PART,
        _KEY,
        *[F.sum(f"{_SHARE}.s{i}").over(earlier).alias(f"_ordered_s{i}") for i in range(len(sums))],
        *[F.sum(f"{_SHARE}.t{i}").over(of_key).alias(f"_ordered_t{i}") for i in range(len(totals))],
    )
    return _with_carried(local, by, carried).select(
        *df.columns,
        *[(F.col(n) + F.coalesce(f"_ordered_s{i}", F.lit(0))).alias(n) for i, n in enumerate(sums)],
        *[F.coalesce(f"_ordered_t{i}", n).alias(n) for i, n in enumerate(totals)],
    )


def previous_row(
    df: DataFrame,
    by: Sequence[str],
    order: Sequence[str],
    columns: Sequence[str],
    into: str = "previous",
    ranges: int | None = None,
) -> DataFrame:
    """Add a struct of the given columns of the row before, null on the first row of a key."""
    wanted = F.struct(*columns)
    rows = dealt(df, by, order, ranges)
    local = rows.withColumn(into, F.lag(wanted).over(Window.partitionBy(_PART, *by).orderBy(*order)))
    if _is_whole(rows):
        return local.drop(_PART)
    edges = _edges(rows, by, F.max_by(wanted, F.struct(*order)))
    before = F.lag(_SHARE).over(Window.partitionBy(_KEY).orderBy(_PART))
    carried = edges.select(_PART, _KEY, before.alias("_ordered_before"))
    return _with_carried(local, by, carried).select(*df.columns, F.coalesce(into, "_ordered_before").alias(into))
