"""Batch readers: files, rows from memory, prediction history."""

from __future__ import annotations

from collections.abc import Sequence
from typing import Any

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from scorewatch.spec import FeatureSpec

BAD_TIMESTAMP = "bad_timestamp"


def read_table(
    spark: SparkSession,
    path: str,
    fmt: str = "parquet",
    schema: T.StructType | str | None = None,
    header: bool = True,
    **options: Any,
) -> DataFrame:
    """A file table. CSV without a schema is inferred, which costs one more pass."""
    reader = spark.read.format(fmt).options(**options)
    if fmt == "csv":
        if schema is None and not header:
            raise ValueError("a CSV file without a header needs a schema")
        reader = reader.option("header", header).option("inferSchema", schema is None)
    if schema is not None:
        reader = reader.schema(schema)
    return reader.load(path)


def from_rows(spark: SparkSession, rows: Sequence[Any], schema: T.StructType | str) -> DataFrame:
    """A small frame from Rows, dicts or tuples; the schema sets the column order.

    Whole numbers given for double columns are accepted.
    """
    if isinstance(schema, str):
        schema = T.StructType.fromDDL(schema)
    names = schema.fieldNames()
    doubles = [isinstance(f.dataType, T.DoubleType) for f in schema.fields]

    def values(row: Any) -> tuple:
        if isinstance(row, T.Row) and hasattr(row, "__fields__"):
            row = row.asDict()
        found = [row.get(n) for n in names] if isinstance(row, dict) else list(row)
        return tuple(float(v) if d and v is not None else v for v, d in zip(found, doubles, strict=True))

    return spark.createDataFrame([values(r) for r in rows], schema)


def history_schema(spec: FeatureSpec) -> T.StructType:
    """Columns of a prediction history."""
    head = [
        T.StructField("timestamp", T.TimestampType(), True),
        T.StructField("predicted_label", T.DoubleType(), True),
        T.StructField("benign_probability", T.DoubleType(), True),
        T.StructField("malignant_probability", T.DoubleType(), True),
    ]
    return T.StructType(head + spec.schema().fields)


def read_history(spark: SparkSession, path: str, spec: FeatureSpec, fmt: str = "parquet") -> DataFrame:
    """The prediction history, or an empty frame of its schema when nothing was written yet.

    From CSV, a timestamp that cannot be read becomes null and its text is kept in
    ``bad_timestamp``; split on that column to set such rows aside.
    """
    schema = history_schema(spec)
    try:
        if fmt != "csv":
            return spark.read.schema(schema).format(fmt).load(path)
        as_text = T.StructType(
            [T.StructField("timestamp", T.StringType(), True)] + schema.fields[1:]
        )
        raw = spark.read.schema(as_text).option("header", True).csv(path)
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)
    parsed = F.try_to_timestamp("timestamp")
    return raw.withColumns(
        {BAD_TIMESTAMP: F.when(parsed.isNull(), F.col("timestamp")), "timestamp": parsed}
    )


def preview(df: DataFrame, n: int = 5) -> DataFrame:
    """The first n rows, as a frame: bounded before anything reaches the driver."""
    return df.limit(n)
