"""Feature lists: which columns are features, in which order, and how their names divide."""

from __future__ import annotations

import json
from collections.abc import Iterable, Sequence
from dataclasses import dataclass

from pyspark.sql import types as T

# The measures and statistics that name the 30 tumour features.
MEASURES = (
    "radius",
    "texture",
    "perimeter",
    "area",
    "smoothness",
    "compactness",
    "concavity",
    "concave_points",
    "symmetry",
    "fractal_dimension",
)
STATISTICS = ("mean", "se", "worst")


@dataclass(frozen=True)
class FeatureSpec:
    """An ordered feature list with its label column.

    The order is part of the model: a vector assembled in another order scores
    wrongly without any error, so the spec is saved beside the model.
    """

    features: tuple[str, ...]
    label: str = "label"

    def __post_init__(self) -> None:
        object.__setattr__(self, "features", tuple(self.features))
        if len(set(self.features)) != len(self.features):
            raise ValueError("a feature name occurs twice")
        if self.label in self.features:
            raise ValueError(f"label {self.label!r} must not be a feature")

    def match(
        self,
        contains: str | None = None,
        endswith: str | Sequence[str] | None = None,
        exclude: Iterable[str] = (),
    ) -> list[str]:
        """Features chosen by name, in spec order."""
        return match_columns(self.features, contains, endswith, exclude)

    def schema(self) -> T.StructType:
        """Schema of a flat message: every feature a nullable double."""
        return T.StructType([T.StructField(f, T.DoubleType(), True) for f in self.features])

    def to_json(self) -> str:
        return json.dumps({"features": list(self.features), "label": self.label})

    @staticmethod
    def from_json(text: str) -> FeatureSpec:
        stored = json.loads(text)
        return FeatureSpec(tuple(stored["features"]), stored["label"])


def match_columns(
    names: Iterable[str],
    contains: str | None = None,
    endswith: str | Sequence[str] | None = None,
    exclude: Iterable[str] = (),
) -> list[str]:
    """Names that hold ``contains``, end with one of ``endswith`` and are not in ``exclude``."""
    ends = (endswith,) if isinstance(endswith, str) else tuple(endswith or ("",))
    left_out = set(exclude)
    return [n for n in names if (contains or "") in n and n.endswith(ends) and n not in left_out]


def tumour_spec(label: str = "diagnosis") -> FeatureSpec:
    """All means, then all standard errors, then all worst values."""
    return FeatureSpec(tuple(f"{m}_{s}" for s in STATISTICS for m in MEASURES), label)
