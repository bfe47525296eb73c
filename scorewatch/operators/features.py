"""Feature vectors and scaling."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.ml.feature import MinMaxScaler, StandardScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scorewatch.functions.columns import nan_to_null
from scorewatch.spec import FeatureSpec


def assembler(spec: FeatureSpec, invalid: str = "error", output: str = "features") -> VectorAssembler:
    """``error`` stops at a missing value, ``keep`` makes it NaN, ``skip`` drops the row."""
    return VectorAssembler(inputCols=list(spec.features), outputCol=output, handleInvalid=invalid)


def assemble(df: DataFrame, spec: FeatureSpec, invalid: str = "error") -> DataFrame:
    return assembler(spec, invalid).transform(df)


def scaler(kind: str = "minmax") -> MinMaxScaler | StandardScaler:
    """``minmax`` maps the fitted range to [0, 1] and does not clamp; ``standard`` divides by the
    sample standard deviation without centering."""
    if kind == "minmax":
        return MinMaxScaler(inputCol="features", outputCol="scaled_features")
    if kind == "standard":
        return StandardScaler(inputCol="features", outputCol="scaled_features")
    raise ValueError(f"unknown scaler {kind!r}")


def scale(df: DataFrame, kind: str = "minmax", model=None) -> DataFrame:
    """Scale the ``features`` vector with a fitted model, or fit one on these rows first."""
    return (model or scaler(kind).fit(df)).transform(df)


def vector_columns(df: DataFrame, vector: str, names: Sequence[str]) -> DataFrame:
    """Replace a vector by one double column per element."""
    values = df.withColumn("_values", vector_to_array(vector)).drop(vector)
    others = [c for c in values.columns if c not in {*names, "_values"}]
    return values.select(*others, *[F.get("_values", F.lit(i)).alias(n) for i, n in enumerate(names)])


def fit_ranges(df: DataFrame, columns: Sequence[str]) -> dict[str, tuple[float, float]]:
    """Smallest and largest value per column, in one pass: two numbers each reach the driver."""
    found = df.agg(
        *[F.min(nan_to_null(c)).alias(f"{c}_low") for c in columns],
        *[F.max(nan_to_null(c)).alias(f"{c}_high") for c in columns],
    ).first()
    return {c: (found[f"{c}_low"], found[f"{c}_high"]) for c in columns}


def minmax_columns(df: DataFrame, ranges: Mapping[str, tuple[float | None, float | None]]) -> DataFrame:
    """Min-max scaling in plain column arithmetic, with ranges from :func:`fit_ranges`.

    A constant column gives 0.5, as the ML scaler does; one without values gives null.
    """
    scaled = {}
    for c, (low, high) in ranges.items():
        if low is None or high is None:
            scaled[c] = F.lit(None).cast("double")
        elif low == high:
            scaled[c] = F.when(F.col(c).isNotNull(), F.lit(0.5))
        else:
            scaled[c] = (F.col(c) - F.lit(low)) / F.lit(high - low)
    return df.withColumns(scaled)


def fit_deviations(df: DataFrame, columns: Sequence[str]) -> dict[str, float | None]:
    """Sample standard deviation per column, in one pass: one number each reaches the driver."""
    found = df.agg(*[F.stddev_samp(nan_to_null(c)).alias(c) for c in columns]).first()
    return found.asDict()


def standard_columns(df: DataFrame, deviations: Mapping[str, float | None]) -> DataFrame:
    """Division by the sample standard deviation in plain column arithmetic, without centering.

    A constant column gives 0.0, as the ML scaler does; one without a deviation gives null.
    """
    scaled = {}
    for c, deviation in deviations.items():
        if deviation is None:
            scaled[c] = F.lit(None).cast("double")
        elif deviation == 0:
            scaled[c] = F.when(F.col(c).isNotNull(), F.lit(0.0))
        else:
            scaled[c] = F.col(c) / F.lit(deviation)
    return df.withColumns(scaled)


def scaled_columns(df: DataFrame, columns: Sequence[str], kind: str = "minmax") -> DataFrame:
    """Columns scaled by their own ranges or deviations, in generated code."""
    if kind == "minmax":
        return minmax_columns(df, fit_ranges(df, columns))
    if kind == "standard":
        return standard_columns(df, fit_deviations(df, columns))
    raise ValueError(f"unknown scaler {kind!r}")


def scaled_long(df: DataFrame, spec: FeatureSpec, kind: str = "minmax", ids: Sequence[str] = ()) -> DataFrame:
    """Scaled value per record and feature, in long form. A missing value stays null."""
    values = scaled_columns(df.select(*ids, *spec.features), spec.features, kind)
    parts = [F.struct(F.lit(f).alias("feature"), F.col(f).alias("scaled")) for f in spec.features]
    return values.select(*ids, F.inline(F.array(*parts)))


def radar(scaled: DataFrame, spec: FeatureSpec, ids: Sequence[str], statistics: Sequence[str]) -> DataFrame:
    """One row per record and measure, one column per statistic, from :func:`scaled_columns`.

    The measures of a record are known from the names of its columns, so nothing is shuffled.
    Values outside the fitted range stay as they are; clamp them for display. A statistic
    that a measure lacks is null.
    """
    by_measure: dict[str, dict[str, str]] = {}
    for f in spec.features:
        measure, _, statistic = f.rpartition("_")
        by_measure.setdefault(measure or f, {})[statistic if measure else ""] = f
    rows = [
        F.struct(
            F.lit(measure).alias("measure"),
            *[(F.col(of[s]) if s in of else F.lit(None).cast("double")).alias(s) for s in statistics],
        )
        for measure, of in by_measure.items()
    ]
    return scaled.select(*ids, F.inline(F.array(*rows)))


def row_contributions(
    df: DataFrame, weights: Mapping[str, float], ids: Sequence[str] = ()
) -> DataFrame:
    """What each scaled feature adds to the margin of a record: coefficient times value."""
    parts: list[Column] = [
        F.struct(F.lit(c).alias("factor"), (F.col(c) * F.lit(float(w))).alias("contribution"))
        for c, w in weights.items()
    ]
    return df.select(*ids, F.inline(F.array(*parts)))
