"""Window autoencoder: a linear encoder to a few latents and back.

It keeps the contract of a sequence autoencoder (a window goes in; its latent
vector, its reconstruction error and the error per sensor come out) but the model
is a principal subspace of flattened windows, not a recurrent network.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame, functions as F

from millrace.operators.detect.pca import Moments, principal_axes
from millrace.operators.features import complete_rows
from millrace.operators.ordered import ROWS_PER_TASK
from millrace.operators.windows import map_windows, window_moments

ERROR_SCHEMA = "mse double, mae double, latent array<double>, attribution array<double>"


@dataclass(frozen=True)
class WindowModel:
    features: tuple[str, ...]
    size: int
    mean: np.ndarray        # (size * F,)
    axes: np.ndarray        # (latent, size * F)
    variance: np.ndarray    # all variances, largest first

    def encode(self, windows: np.ndarray) -> np.ndarray:
        return (windows.reshape(len(windows), -1) - self.mean) @ self.axes.T

    def reconstruct(self, windows: np.ndarray) -> np.ndarray:
        return (self.encode(windows) @ self.axes + self.mean).reshape(windows.shape)

    def errors(self, windows: np.ndarray) -> dict:
        """mse, mae, latent vector and squared error per sensor (root-cause vector)."""
        latent = self.encode(windows)
        difference = windows - (latent @ self.axes + self.mean).reshape(windows.shape)
        per_sensor = np.mean(difference ** 2, axis=1)
        return {"mse": per_sensor.mean(axis=1), "mae": np.abs(difference).mean(axis=(1, 2)),
                "latent": list(latent), "attribution": list(per_sensor)}


@dataclass(frozen=True)
class MeanModel:
    """Reconstructs a window by each sensor's mean: the simplest model with this contract."""

    features: tuple[str, ...]
    size: int

    def errors(self, windows: np.ndarray) -> dict:
        centre = windows.mean(axis=1, keepdims=True)
        difference = windows - centre
        per_sensor = np.mean(difference ** 2, axis=1)
        return {"mse": per_sensor.mean(axis=1), "mae": np.abs(difference).mean(axis=(1, 2)),
                "latent": list(centre[:, 0, :]), "attribution": list(per_sensor)}


def window_model_fit(train: DataFrame, by: Sequence[str], order_by: Sequence[str],
                     features: Sequence[str], size: int = 60, latent: int = 3, stride: int = 1,
                     rows_per_task: int = ROWS_PER_TASK) -> WindowModel:
    """Fit from the cross-products of all training windows, added up on the workers."""
    means = complete_rows(train, features).agg(*[F.avg(c) for c in features]).first()
    shift = np.array([m or 0.0 for m in means])
    n, total, cross = window_moments(train, by, order_by, features, size, shift, stride, rows_per_task)
    if n < 2:
        raise ValueError("fewer than two full windows to fit from")
    mean = total / n
    cov = (cross - n * np.outer(mean, mean)) / (n - 1)
    axes, variance = principal_axes(cov, latent)
    return WindowModel(tuple(features), size, mean + np.tile(shift, size), axes, variance)


def window_error(df: DataFrame, by: Sequence[str], order_by: Sequence[str], model,
                 stride: int = 1, rows_per_task: int = ROWS_PER_TASK) -> DataFrame:
    """Errors, latent vector and attribution of every full window."""
    return map_windows(df, by, order_by, model.features, model.size, model.errors,
                       ERROR_SCHEMA, stride, rows_per_task)


def latent_moments(errors: DataFrame, latent: int) -> Moments:
    """Mean and covariance of the latent vectors."""
    from millrace.operators.detect.pca import fit_moments
    names = [f"z{i}" for i in range(latent)]
    return fit_moments(errors.select(*[F.col("latent")[i].alias(c) for i, c in enumerate(names)]), names)


def rank_attribution(errors: DataFrame, keys: Sequence[str], features: Sequence[str]) -> DataFrame:
    """Long form of the attribution: one row per sensor, ``rank`` 1 for the smallest error."""
    ordered = F.array_sort(F.transform(
        "attribution", lambda x, i: F.struct(x.alias("error"), i.alias("sensor_index"))))
    names = F.array(*[F.lit(c) for c in features])
    long = errors.select(*keys, F.posexplode(ordered).alias("__p", "__e"))
    return long.select(*keys, F.get(names, F.col("__e.sensor_index")).alias("sensor"),
                       F.col("__e.error").alias("error"),
                       (F.col("__p") + 1).cast("bigint").alias("rank"))
