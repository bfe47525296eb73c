"""Missing values, labels, shares and bands as column expressions."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import timedelta

from pyspark.sql import Column
from pyspark.sql import functions as F

FLOATING = ("double", "float")


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def is_missing(c: Column | str, dtype: str) -> Column:
    """Null, or NaN too where the type has one."""
    c = _col(c)
    return c.isNull() | F.isnan(c) if dtype in FLOATING else c.isNull()


def nan_to_null(c: Column | str) -> Column:
    c = _col(c).cast("double")
    return F.when(~F.isnan(c), c)


def encode_label(
    c: Column | str, positive: str | None = None, mapping: Mapping[str, int] | None = None
) -> Column:
    """With ``positive``: 1 for that text, 0 for all else, null included.
    With ``mapping``: the mapped number, null for a text it does not hold."""
    c = _col(c)
    if (positive is None) == (mapping is None):
        raise ValueError("give either positive or mapping")
    if positive is not None:
        return F.when(c == positive, 1).otherwise(0)
    coded = F.lit(None).cast("int")
    for text, number in mapping.items():
        coded = F.when(c == text, number).otherwise(coded)
    return coded


def decode_label(c: Column | str, negative: str = "Benign", positive: str = "Malignant") -> Column:
    return F.when(_col(c) == 1, positive).otherwise(negative)


def confidence(label: Column | str, probabilities: Column | str) -> Column:
    """Percent given to the predicted class; 0.0 unless there are exactly two probabilities."""
    p = _col(probabilities)
    of_class = F.when(_col(label) == 1, F.get(p, F.lit(1))).otherwise(F.get(p, F.lit(0)))
    return F.when(F.size(p) == 2, of_class * 100).otherwise(0.0)


def share(n: Column | str, total: Column | str, digits: int = 1) -> Column:
    """Percent of a total, null when the total is zero."""
    return F.round(F.try_divide(_col(n), _col(total)) * 100, digits)


def title(name: Column | str) -> Column:
    return F.initcap(F.replace(_col(name), F.lit("_"), F.lit(" ")))


def clamp(c: Column | str, low: float, high: float) -> Column:
    """Limit to [low, high]; missing stays missing (greatest and least would skip it)."""
    c = _col(c)
    return F.when(c.isNotNull() & ~F.isnan(c.cast("double")), F.greatest(F.lit(low), F.least(c, F.lit(high))))


def in_cohort(
    number: Column | str,
    low: float,
    high: float,
    members: Mapping[str, Sequence[str]],
    ts: Column | str | None = None,
    period: timedelta | None = None,
    now: Column | None = None,
) -> Column:
    """Inclusive range, membership lists, and a period ending at ``now``.

    ``period=None`` is "all time". ``now`` is passed in, so that a rerun gives the same rows.
    """
    inside = _col(number).between(low, high)
    for name, allowed in members.items():
        inside = inside & F.col(name).isin(list(allowed))
    if period is not None:
        if ts is None or now is None:
            raise ValueError("a period needs ts and now")
        inside = inside & _col(ts).between(now - F.lit(period), now)
    return inside


def risk_band(c: Column | str, cuts: tuple[float, float] = (0.3, 0.7)) -> Column:
    """green below the first cut, yellow from it, red from the second."""
    c = _col(c)
    return F.when(c >= cuts[1], "red").when(c >= cuts[0], "yellow").when(c < cuts[0], "green")


def alert(c: Column | str, threshold: float = 0.8) -> Column:
    return _col(c) >= F.lit(threshold)


def delta_from(c: Column | str, reference: float = 0.5) -> Column:
    return _col(c) - F.lit(reference)


# Age groups of the cohort view, by their first year.
AGE_GROUPS = {18: "18-30", 31: "31-45", 46: "46-60", 61: "61-75", 76: "76+"}


def bucket(c: Column | str, groups: Mapping[float, str] = AGE_GROUPS) -> Column:
    """Label of the last group that starts at or below the value; null below the first."""
    c = _col(c)
    chosen = F.lit(None).cast("string")
    for start in sorted(groups):
        chosen = F.when(c >= start, groups[start]).otherwise(chosen)
    return chosen


def severity(percent: Column | str, cuts: tuple[float, float] = (15, 10)) -> Column:
    p = _col(percent)
    return F.when(p > cuts[0], "red").when(p > cuts[1], "orange").when(p.isNotNull(), "yellow")


def rule_score(columns: Sequence[str], threshold: float = 10) -> Column:
    """1 when the features add up to more than the threshold; a missing one adds nothing."""
    total = sum((F.coalesce(nan_to_null(c), F.lit(0.0)) for c in columns), F.lit(0.0))
    return F.when(total > threshold, 1).otherwise(0)


def body_mass_index(weight_kg: Column | str, height_cm: Column | str) -> Column:
    return F.try_divide(_col(weight_kg), F.pow(_col(height_cm) / 100, F.lit(2)))


def logistic(weights: Mapping[str, float], intercept: float) -> Column:
    """Probability of the positive class for a model with known coefficients."""
    margin = sum((F.col(c) * F.lit(float(w)) for c, w in weights.items()), F.lit(float(intercept)))
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-margin))


def hash_share(key: Column | str, seed: int = 42) -> Column:
    """A whole number from 0 to 99 that depends on the key's text and the seed alone, by MD5: the
    same in any engine. Null for a null key."""
    text = F.concat((F.col(key) if isinstance(key, str) else key).cast("string"), F.lit(f":{seed}"))
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("bigint") % 100
