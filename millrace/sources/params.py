"""Fitted models as small Parquet tables of numbers."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, SparkSession

SCHEMA = "model string, name string, i int, j int, value double"


def params_frame(spark: SparkSession, model: str, arrays: dict[str, np.ndarray]) -> DataFrame:
    """Long form (model, name, i, j, value) of vectors and matrices."""
    rows = []
    for name, array in arrays.items():
        matrix = np.atleast_2d(np.asarray(array, dtype=float))
        rows += [(model, name, i, j, float(matrix[i, j]))
                 for i in range(matrix.shape[0]) for j in range(matrix.shape[1])]
    return spark.createDataFrame(rows, SCHEMA)


def save_params(spark: SparkSession, path: str, model: str, arrays: dict[str, np.ndarray]) -> None:
    params_frame(spark, model, arrays).write.mode("overwrite").parquet(path)


def load_params(spark: SparkSession, path: str, model: str) -> dict[str, np.ndarray]:
    """Arrays of one model; a matrix with one row comes back as a vector."""
    rows = spark.read.parquet(path).filter(f"model = '{model}'").toPandas()
    result = {}
    for name, part in rows.groupby("name"):
        matrix = np.zeros((part["i"].max() + 1, part["j"].max() + 1))
        matrix[part["i"], part["j"]] = part["value"]
        result[name] = matrix[0] if len(matrix) == 1 else matrix
    return result
