"""Stores reached through a Spark data source: JDBC, Kafka, Cassandra.

Only the format names are used here; the packages come with the cluster. Passwords
belong in the options given by the caller or in the environment, never in code.
"""

from __future__ import annotations

from typing import Any

from pyspark.sql import DataFrame, SparkSession

CASSANDRA = "org.apache.spark.sql.cassandra"


def read_connector(spark: SparkSession, fmt: str, **options: Any) -> DataFrame:
    return spark.read.format(fmt).options(**options).load()


def jdbc_read_options(
    url: str,
    table: str,
    split_column: str,
    lower: Any,
    upper: Any,
    partitions: int,
    fetch_size: int = 10_000,
    **properties: str,
) -> dict[str, str]:
    """Options of a parallel JDBC scan: ``partitions`` ranges of ``split_column``.
    None of them has a default: without them the scan would be a single task."""
    return {
        "url": url,
        "dbtable": table,
        "fetchsize": str(fetch_size),
        "partitionColumn": split_column,
        "lowerBound": str(lower),
        "upperBound": str(upper),
        "numPartitions": str(partitions),
    } | properties


def read_predictions(spark: SparkSession, url: str, table: str, **options: Any) -> DataFrame:
    """The prediction table, read back for monitoring. See :func:`jdbc_read_options`."""
    return spark.read.format("jdbc").options(**jdbc_read_options(url, table, **options)).load()
