"""Moments, principal components and Mahalanobis distance as column arithmetic."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, functions as F

from millrace.operators.features import complete_rows

# 0.999 quantile of the chi-square distribution by degrees of freedom.
CHI2_P999 = {1: 10.8276, 2: 13.8155, 3: 16.2662, 4: 18.4668, 5: 20.5150,
             6: 22.4577, 7: 24.3219, 8: 26.1245, 9: 27.8772, 10: 29.5883}


@dataclass(frozen=True)
class Moments:
    features: tuple[str, ...]
    n: int
    mean: np.ndarray
    cov: np.ndarray      # sample covariance

    @property
    def inverse(self) -> np.ndarray:
        return np.linalg.inv(self.cov)


def moments_frame(df: DataFrame, features: Sequence[str]) -> DataFrame:
    """One row: ``n``, a mean per feature and a sample covariance per pair, in one pass."""
    aggs = [F.count(F.lit(1)).alias("n"), *[F.avg(c).alias(f"mean_{c}") for c in features]]
    for i, a in enumerate(features):
        aggs += [F.covar_samp(a, b).alias(f"cov_{a}_{b}") for b in features[i:]]
    return complete_rows(df, features).agg(*aggs)


def fit_moments(df: DataFrame, features: Sequence[str]) -> Moments:
    row = moments_frame(df, features).first()
    k = len(features)
    cov = np.zeros((k, k))
    for i, a in enumerate(features):
        for j in range(i, k):
            cov[i, j] = cov[j, i] = row[f"cov_{a}_{features[j]}"]
    return Moments(tuple(features), row["n"], np.array([row[f"mean_{c}"] for c in features]), cov)


@dataclass(frozen=True)
class Pca:
    features: tuple[str, ...]
    mean: np.ndarray          # (F,)
    components: np.ndarray    # (k, F), orthonormal rows
    variance: np.ndarray      # (F,), all eigenvalues, largest first

    @property
    def explained_ratio(self) -> np.ndarray:
        return self.variance[:len(self.components)] / self.variance.sum()

    def error(self) -> Column:
        """Mean squared residual after projection, as an expression over the features."""
        centred = [F.col(c) - F.lit(float(m)) for c, m in zip(self.features, self.mean)]
        scores = [_dot(v, centred) for v in self.components]
        total = F.lit(0.0)
        for j, x in enumerate(centred):
            residual = x - _dot(self.components[:, j], scores)
            total = total + residual * residual
        return total / F.lit(float(len(self.features)))

    def error_of(self, rows: np.ndarray) -> np.ndarray:
        """The same for a numpy batch inside a task."""
        centred = rows - self.mean
        residual = centred - centred @ self.components.T @ self.components
        return np.mean(residual ** 2, axis=1)


def _dot(weights, columns) -> Column:
    total = F.lit(0.0)
    for w, x in zip(weights, columns):
        total = total + F.lit(float(w)) * x
    return total


def principal_axes(cov: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(k leading axes as rows, all variances); the largest entry of an axis is positive."""
    values, vectors = np.linalg.eigh(cov)
    order = np.argsort(values)[::-1]
    axes = vectors[:, order[:k]].T
    signs = np.sign(axes[np.arange(len(axes)), np.abs(axes).argmax(axis=1)])
    return axes * signs[:, None], np.clip(values[order], 0.0, None)


def pca_fit(train: DataFrame, features: Sequence[str], k: int = 3) -> Pca:
    """Centred PCA: covariance on Spark, the features x features eigenproblem on the driver."""
    moments = fit_moments(train, features)
    axes, variance = principal_axes(moments.cov, k)
    return Pca(tuple(features), moments.mean, axes, variance)


def mahalanobis_squared(moments: Moments, columns: Sequence[Column] | None = None) -> Column:
    centred = [x - F.lit(float(m)) for x, m in
               zip(columns or [F.col(c) for c in moments.features], moments.mean)]
    total = F.lit(0.0)
    for i, row in enumerate(moments.inverse):
        total = total + centred[i] * _dot(row, centred)
    return total


def mahalanobis(moments: Moments, columns: Sequence[Column] | None = None) -> Column:
    return F.sqrt(mahalanobis_squared(moments, columns))


def mahalanobis_alert(distance: Column, degrees: int, compat: bool = False) -> Column:
    """Distance beyond the 0.999 chi-square quantile.

    The quantile belongs to the squared distance. ``compat`` compares the plain
    distance with it, as the published numbers do.
    """
    limit = F.lit(CHI2_P999[degrees])
    return distance > limit if compat else distance * distance > limit
