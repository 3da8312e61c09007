"""Fit all detectors on a training table, keep them as tables, score with them."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.sql import DataFrame, SparkSession

from millrace.operators.detect.consensus import (
    DEFAULT_THRESHOLDS, TripleDetector, detect, percentile_threshold, status_kpi,
)
from millrace.operators.detect.iforest import Forest, iforest_fit
from millrace.operators.detect.pca import Pca, pca_fit
from millrace.operators.detect.window_model import WindowModel, window_error, window_model_fit
from millrace.operators.scaling import Scaler
from millrace.sources.params import load_params, save_params

FOREST_ARRAYS = ("feature", "threshold", "path")


def train_detectors(train: DataFrame, by: Sequence[str], order_by: Sequence[str],
                    features: Sequence[str], size: int = 60, latent: int = 3,
                    components: int = 3, stride: int = 1, trees: int = 100,
                    percent: float = 99.9, scaler: Scaler | None = None) -> TripleDetector:
    """Window model, PCA and forest; thresholds of window and PCA from the training errors.

    ``train`` is scaled; with its ``scaler`` the detector then takes raw rows.
    """
    model = window_model_fit(train, by, order_by, features, size, latent, stride)
    errors = window_error(train, by, order_by, model, stride)
    pca = pca_fit(train, features, components)
    thresholds = {**DEFAULT_THRESHOLDS, "window": percentile_threshold(errors, "mse", percent),
                  "pca": percentile_threshold(train.select(pca.error().alias("e")), "e", percent)}
    forest = iforest_fit(train, features, [*by, *order_by], trees)
    return TripleDetector(tuple(features), size, model, pca, forest, thresholds, scaler)


def save_detector(spark: SparkSession, path: str, detector: TripleDetector) -> None:
    """One small Parquet table per model below ``path``."""
    model, pca, forest = detector.window_model, detector.pca, detector.forest
    names = sorted(detector.thresholds)
    save_params(spark, f"{path}/thresholds", "thresholds",
                {name: [detector.thresholds[name]] for name in names})
    save_params(spark, f"{path}/window", "window", {
        "size": [model.size], "mean": model.mean, "axes": model.axes, "variance": model.variance})
    save_params(spark, f"{path}/pca", "pca", {
        "mean": pca.mean, "components": pca.components, "variance": pca.variance})
    save_params(spark, f"{path}/forest", "forest", {
        **{name: getattr(forest, name) for name in FOREST_ARRAYS},
        "shape": [forest.sample_size, forest.levels, forest.offset]})
    scaler = detector.scaler
    save_params(spark, f"{path}/scaler", "scaler", {
        "offset": scaler.offset, "scale": scaler.scale} if scaler else {"none": [0.0]})


def load_detector(spark: SparkSession, path: str, features: Sequence[str]) -> TripleDetector:
    names = tuple(features)
    window = load_params(spark, f"{path}/window", "window")
    pca = load_params(spark, f"{path}/pca", "pca")
    forest = load_params(spark, f"{path}/forest", "forest")
    scaler = load_params(spark, f"{path}/scaler", "scaler")
    sample, levels, offset = forest["shape"]
    arrays = {name: np.atleast_2d(forest[name]) for name in FOREST_ARRAYS}
    arrays["feature"] = arrays["feature"].astype(np.int64)
    thresholds = {k: float(v[0]) for k, v in load_params(spark, f"{path}/thresholds", "thresholds").items()}
    return TripleDetector(
        names, int(window["size"][0]),
        WindowModel(names, int(window["size"][0]), window["mean"], np.atleast_2d(window["axes"]),
                    window["variance"]),
        Pca(names, pca["mean"], np.atleast_2d(pca["components"]), pca["variance"]),
        Forest(names, **arrays, sample_size=int(sample), levels=int(levels), offset=float(offset)),
        thresholds,
        Scaler(names, tuple(scaler["offset"].tolist()), tuple(scaler["scale"].tolist())) if "offset" in scaler else None)


def score_table(rows: DataFrame, by: Sequence[str], order_by: Sequence[str],
                detector: TripleDetector) -> DataFrame:
    """Scores, alerts, status and health of every full window."""
    return status_kpi(detect(rows, by, order_by, detector))
