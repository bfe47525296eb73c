"""JSON messages to columns and back."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

CORRUPT = "_corrupt_record"
VALID = "is_valid"


def parse_messages(
    df: DataFrame, schema: T.StructType, value: str = "value", policy: str = "quarantine"
) -> DataFrame:
    """Flatten a JSON value column by schema, beside the other columns of the message.

    ``quarantine`` adds ``is_valid`` (false for a null or blank message, text that is not JSON, a
    field of the wrong type, and NaN or infinite numbers) and the raw text of bad messages,
    so that they can be kept apart instead of being scored as a case of zeros.
    ``zero_fill`` parses alone: bad messages come out as nulls, for filling later.
    """
    if policy not in ("quarantine", "zero_fill"):
        raise ValueError(f"unknown policy {policy!r}")
    text = F.col(value).cast("string")
    others = [c for c in df.columns if c != value]
    fields = [F.col(f"_data.{f.name}").alias(f.name) for f in schema.fields]
    if policy == "zero_fill":
        return df.withColumn("_data", F.from_json(text, schema)).select(*others, *fields)
    with_corrupt = T.StructType(schema.fields + [T.StructField(CORRUPT, T.StringType(), True)])
    options = {"columnNameOfCorruptRecord": CORRUPT}
    parsed = df.withColumn("_data", F.from_json(text, with_corrupt, options))
    finite = F.lit(True)
    for f in schema.fields:
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            c = F.col(f"_data.{f.name}")
            finite = finite & (c.isNull() | (~F.isnan(c) & (F.abs(c) != F.lit(float("inf")))))
    # Blank text gives a null struct without a mark.
    valid = F.col("_data").isNotNull() & F.col(f"_data.{CORRUPT}").isNull() & finite
    return parsed.select(
        *others, *fields, valid.alias(VALID), F.when(~valid, text).alias("raw_value")
    )


def split_valid(parsed: DataFrame, schema: T.StructType) -> tuple[DataFrame, DataFrame]:
    """Rows to score, and rows to set aside with their raw text."""
    good = parsed.filter(VALID).drop(VALID, "raw_value")
    names = {f.name for f in schema.fields}
    bad = parsed.filter(~F.col(VALID)).select(
        *[c for c in parsed.columns if c not in names and c != VALID]
    )
    return good, bad


def features_from_map(df: DataFrame, features: str, names: Sequence[str]) -> DataFrame:
    """Flatten the map of a nested message to one column per feature, null where it has none."""
    others = [c for c in df.columns if c != features]
    return df.select(*others, *[F.try_element_at(features, F.lit(n)).alias(n) for n in names])


def to_message(columns: list[str | Column]) -> Column:
    """One JSON string from the given columns. Probabilities go out as a plain array."""
    return F.to_json(F.struct(*columns))


def normalize_probability(c: Column | str) -> Column:
    """A probability pair from its JSON text.

    Takes an object with ``values`` (how a vector is serialized), a list, or either of
    them quoted as a string; anything else gives [0.0, 0.0].
    """
    text = F.col(c) if isinstance(c, str) else c
    # A quoted form is unwrapped by reading it as the one field of a wrapping object.
    unwrapped = F.get_json_object(F.concat(F.lit('{"p":'), text, F.lit("}")), "$.p")
    inner = F.when(F.startswith(text, F.lit('"')), unwrapped).otherwise(text)
    start = F.substring(F.ltrim(inner), 1, 1)
    pair = F.when(start == "{", F.from_json(inner, "values array<double>").getField("values")).when(
        start == "[", F.from_json(inner, "array<double>")
    )
    return F.coalesce(pair, F.array(F.lit(0.0), F.lit(0.0)))
