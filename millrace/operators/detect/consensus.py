"""Several detectors on one window, and how their verdicts are combined."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import Column, DataFrame, functions as F

from millrace.functions.signals import health, severity, status
from millrace.operators.ordered import ROWS_PER_TASK
from millrace.operators.quantiles import quantiles
from millrace.operators.scaling import Scaler
from millrace.operators.windows import map_windows

# Window threshold without training errors, and the two row thresholds.
FALLBACK_THRESHOLD = 0.15
DEFAULT_THRESHOLDS = {"window": FALLBACK_THRESHOLD, "pca": 0.1, "iso": 0.0}

DETECTION_SCHEMA = ("window_error double, window_alert boolean, pca_score double, "
                    "pca_alert boolean, iso_score double, iso_alert boolean, "
                    "attribution array<double>")


@dataclass(frozen=True)
class TripleDetector:
    """Window model on the window; PCA and forest on its last row. Any model may be absent.

    Models are fitted on scaled rows. With ``scaler`` the detector takes raw rows and scales
    them itself, in batch and on a stream alike.
    """

    features: tuple[str, ...]
    size: int
    window_model: object | None = None
    pca: object | None = None
    forest: object | None = None
    thresholds: dict = field(default_factory=lambda: dict(DEFAULT_THRESHOLDS))
    scaler: Scaler | None = None

    def __call__(self, windows: np.ndarray) -> dict:
        if self.scaler is not None:
            windows = self.scaler.values(windows)
        n, last = len(windows), windows[:, -1, :]
        result = {name: np.zeros(n) for name in ("window_error", "pca_score", "iso_score")}
        result.update({name: np.zeros(n, dtype=bool)
                       for name in ("window_alert", "pca_alert", "iso_alert")})
        result["attribution"] = list(np.zeros((n, windows.shape[2])))
        if self.window_model is not None:
            errors = self.window_model.errors(windows)
            result["window_error"], result["attribution"] = errors["mse"], errors["attribution"]
            result["window_alert"] = errors["mse"] > self.thresholds.get("window", np.inf)
        if self.pca is not None:
            result["pca_score"] = self.pca.error_of(last)
            result["pca_alert"] = result["pca_score"] > self.thresholds.get("pca", np.inf)
        if self.forest is not None:
            result["iso_score"] = self.forest.anomaly(last)
            result["iso_alert"] = result["iso_score"] > self.thresholds.get("iso", 0.0)
        return result


def detect(df: DataFrame, by: Sequence[str], order_by: Sequence[str], detector: TripleDetector,
           stride: int = 1, rows_per_task: int = ROWS_PER_TASK) -> DataFrame:
    """Scores, alerts and attribution for every full window, in one pass over the rows."""
    return map_windows(df, by, order_by, detector.features, detector.size, detector,
                       DETECTION_SCHEMA, stride, rows_per_task)


def percentile_threshold(scores: DataFrame, column: str, percent: float = 99.9,
                         fallback: float = FALLBACK_THRESHOLD) -> float:
    """Exact percentile of training scores; the fallback if there are none."""
    value = quantiles(scores, column, [percent / 100.0])[0]
    return fallback if value is None else value


def detect_or(*alerts: Column) -> Column:
    """Alert if any detector alerts; an unknown verdict counts as none."""
    combined = F.lit(False)
    for alert in alerts:
        combined = combined | F.coalesce(alert, F.lit(False))
    return combined


def status_kpi(detections: DataFrame) -> DataFrame:
    """Status, health score and one severity per detector."""
    return detections.withColumns({
        "status": status(F.col("window_alert")),
        "health": health(F.col("window_error")),
        "window_severity": severity(F.col("window_alert")),
        "pca_severity": severity(F.col("pca_alert")),
        "iso_severity": severity(F.col("iso_alert"), "warning"),
    })
