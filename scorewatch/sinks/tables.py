"""Batch writers: history, CSV export, JDBC, connectors."""

from __future__ import annotations

from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def append_history(df: DataFrame, path: str, ts: str = "timestamp") -> None:
    """Append scored rows to the history, in one folder per day.

    Nothing is read back or rewritten. The rebalance hint keeps one task from writing a
    file per day and splits a day that holds most of the rows.
    """
    dated = df.withColumn("date", F.to_date(ts)).hint("rebalance", "date")
    dated.write.mode("append").partitionBy("date").parquet(path)


# Spark writes milliseconds by default.
CSV_TIMES = {
    "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
    "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
}


def export_csv(df: DataFrame, path: str, files: int | None = None) -> None:
    """Write CSV with a header, times to the microsecond; ``files=1`` only for what one task
    can hold."""
    out = df if files is None else df.coalesce(files)
    out.write.mode("overwrite").options(**CSV_TIMES).option("header", True).csv(path)


def jdbc_write_options(
    url: str,
    table: str,
    batchsize: int = 100,
    isolation: str = "READ_COMMITTED",
    *,
    num_partitions: int,
    **properties: str,
) -> dict[str, str]:
    """``num_partitions`` is the number of connections; the writer coalesces to it. There is
    no default: a single one would make the write a single task."""
    return {
        "url": url,
        "dbtable": table,
        "batchsize": str(batchsize),
        "isolationLevel": isolation,
        "numPartitions": str(num_partitions),
    } | properties


def write_jdbc(df: DataFrame, url: str, table: str, **options: Any) -> None:
    df.write.format("jdbc").options(**jdbc_write_options(url, table, **options)).mode("append").save()


def write_connector(df: DataFrame, fmt: str, mode: str = "append", **options: Any) -> None:
    df.write.format(fmt).options(**options).mode(mode).save()
