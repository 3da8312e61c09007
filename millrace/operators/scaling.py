"""Scalers: fitted by one aggregate, applied as column arithmetic."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame, functions as F

from millrace.functions.signals import nan_to_null


@dataclass(frozen=True)
class Scaler:
    """Maps x to (x - offset) / scale per feature; a constant feature has scale 1."""

    features: tuple[str, ...]
    offset: tuple[float, ...]
    scale: tuple[float, ...]

    def values(self, x: np.ndarray) -> np.ndarray:
        """The same for an array whose last axis is the features."""
        return (x - np.array(self.offset)) / np.array(self.scale)

    def apply(self, df: DataFrame) -> DataFrame:
        return df.withColumns({c: (F.col(c) - F.lit(o)) / F.lit(s) for c, o, s in
                               zip(self.features, self.offset, self.scale)})


def _fit(train: DataFrame, features: Sequence[str], offset, spread) -> Scaler:
    types = {f.name: f.dataType for f in train.schema}
    values = [nan_to_null(F.col(c), types[c]) for c in features]
    row = train.agg(*[offset(v) for v in values], *[spread(v) for v in values]).first()
    k = len(values)
    return Scaler(tuple(features), tuple(0.0 if v is None else float(v) for v in row[:k]),
                  tuple(float(v) if v else 1.0 for v in row[k:]))


def minmax_fit(train: DataFrame, features: Sequence[str]) -> Scaler:
    """Range 0..1 of the training rows; NaN is left out of the fit and kept by the transform."""
    return _fit(train, features, F.min, lambda v: F.max(v) - F.min(v))


def standard_fit(train: DataFrame, features: Sequence[str]) -> Scaler:
    """Zero mean and unit sample standard deviation on the training rows."""
    return _fit(train, features, F.avg, F.stddev_samp)


def standard_fit_vectors(train: DataFrame, column: str = "features", name: str = "features_scaled"):
    """MLlib model for an assembled vector column."""
    from pyspark.ml.feature import StandardScaler
    return StandardScaler(inputCol=column, outputCol=name, withStd=True, withMean=True).fit(train)
