"""Selecting, renaming, filling and stamping columns."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scorewatch.functions.columns import is_missing
from scorewatch.spec import FeatureSpec


def select_features(df: DataFrame, spec: FeatureSpec, extra: Sequence[str] = ()) -> DataFrame:
    """The features in spec order, after the ``extra`` columns."""
    return df.select(*extra, *spec.features)


def clean(df: DataFrame, drop: Sequence[str] = (), rename: Mapping[str, str] | None = None) -> DataFrame:
    """Drop and rename columns; names the frame does not have are ignored."""
    return df.drop(*drop).withColumnsRenamed(dict(rename or {}))


def normalize_names(df: DataFrame) -> DataFrame:
    """Replace blanks in column names with underscores."""
    names = [c.replace(" ", "_") for c in df.columns]
    if len(set(names)) != len(names):
        raise ValueError("two columns get the same name")
    return df.toDF(*names)


def fill_missing(df: DataFrame, columns: Sequence[str], value: float = 0.0, nan: bool = False) -> DataFrame:
    """Replace null, and NaN too with ``nan=True``, in one projection."""
    types = dict(df.dtypes)
    filled = {}
    for c in columns:
        gap = is_missing(c, types[c]) if nan else F.col(c).isNull()
        filled[c] = F.when(gap, F.lit(value)).otherwise(F.col(c))
    return df.withColumns(filled)


def by_label(df: DataFrame, label: str, value: object) -> DataFrame:
    return df.filter(F.col(label) == value)


def with_processed_at(df: DataFrame, name: str = "timestamp") -> DataFrame:
    """Stamp rows with the processing time, one value per batch or micro-batch."""
    return df.withColumn(name, F.current_timestamp())


def with_id(df: DataFrame, name: str = "id") -> DataFrame:
    """A random id. Prefer ``sources.streams.message_id`` where rows may be replayed."""
    return df.withColumn(name, F.uuid())


def sample_rows(df: DataFrame, key: str, n: int, seed: int = 42) -> DataFrame:
    """n rows chosen by a seeded MD5 of the key's text: the same rows under any partitioning, and in
    any engine."""
    return df.orderBy(F.md5(F.concat(F.col(key).cast("string"), F.lit(f":{seed}"))), key).limit(n)


def append(old: DataFrame, new: DataFrame) -> DataFrame:
    """Rows of both, columns matched by name, absent ones null."""
    return old.unionByName(new, allowMissingColumns=True)


def distinct_values(df: DataFrame, column: str) -> DataFrame:
    return df.select(column).distinct()


def lookup_text(df: DataFrame, dim: DataFrame, on: str, text: str, default: str) -> DataFrame:
    """Add a text from a dimension with one row per key, or the default where it has none.

    Spark broadcasts the dimension when its measured size is below the threshold and
    otherwise joins by sort-merge with skew splitting.
    """
    return df.join(dim.select(on, text), on, "left").withColumn(
        text, F.coalesce(text, F.lit(default))
    )


def enrich(df: DataFrame, dim: DataFrame, on: str, columns: Sequence[str]) -> DataFrame:
    """Add attributes of an entity (one row per key in ``dim``) to its records."""
    return df.join(dim.select(on, *columns), on, "left")
