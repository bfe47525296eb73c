"""Plain-language texts for feature names."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

# Explanation of each measure and of each statistic.
MEASURE_TEXTS = {
    "radius": "Average distance from center to points on the perimeter",
    "texture": "Standard deviation of gray-scale values",
    "perimeter": "Size of the core tumor",
    "area": "Area of the core tumor",
    "smoothness": "Local variation in radius lengths",
    "compactness": "Perimeter² / area - 1.0",
    "concavity": "Severity of concave portions of the contour",
    "concave_points": "Number of concave portions of the contour",
    "symmetry": "Symmetry of the cell nuclei",
    "fractal_dimension": "Coastline approximation - 1",
}
STATISTIC_TEXTS = {
    "mean": "Average value for the feature across the cell nuclei",
    "se": "Standard error (standard deviation / sqrt(number of nuclei))",
    "worst": "Mean of the three largest values (indicating the most extreme cases)",
}
NO_TEXT = "No explanation available"


def split_feature(name: Column | str, legacy: bool = False) -> tuple[Column, Column]:
    """Measure and statistic of a feature name.

    The last token is the statistic, so ``concave_points_mean`` gives ``concave_points``.
    ``legacy`` takes the first two tokens instead, which loses such names.
    """
    name = F.col(name) if isinstance(name, str) else name
    tokens = F.split(name, "_")
    if legacy:
        return F.get(tokens, F.lit(0)), F.coalesce(F.get(tokens, F.lit(1)), F.lit(""))
    several = F.size(tokens) > 1
    base = F.when(several, F.regexp_extract(name, "^(.*)_[^_]*$", 1)).otherwise(name)
    return base, F.when(several, F.element_at(tokens, -1)).otherwise("")


def _lookup(key: Column, texts: Mapping[str, str], default: str) -> Column:
    pairs = [F.lit(x) for pair in texts.items() for x in pair]
    return F.coalesce(F.try_element_at(F.create_map(*pairs), key), F.lit(default))


def explain_feature(
    name: Column | str,
    measure_texts: Mapping[str, str] = MEASURE_TEXTS,
    statistic_texts: Mapping[str, str] = STATISTIC_TEXTS,
    legacy: bool = False,
) -> Column:
    base, statistic = split_feature(name, legacy)
    return F.concat(
        _lookup(base, measure_texts, NO_TEXT), F.lit(". "), _lookup(statistic, statistic_texts, "")
    )
