"""Dimension look-ups, physics features and quality filters."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import DoubleType, FloatType

from millrace.functions.signals import (
    diameter_from_strength, normalize_code, tensile_strength,
)
from millrace.operators.cleaning import coerce_and_drop, positive_guard
from millrace.operators.sizes import broadcast_if_small

# Key and value of the fixed product dimension: code -> diameter in mm.
# They must equal the published map.
PRODUCT_DIAMETERS = {
    "1": 6.07, "2": 6.01, "3": 8.09, "4": 10.09, "5": 7.0,
    "6": 7.05, "7": 9.08, "8": 11.19, "9": 7.1, "10": 9.07,
    "11": 5.08, "12": 7.07, "13": 6.05, "14": 5.09, "15": 10.08,
    "16": 5.1, "17": 8.07, "18": 6.0, "19": 6.11, "20": 10.07,
    "21": 6.08, "22": 6.04, "23": 8.07, "24": 10.08, "25": 6.1,
}

# Names of the sensor columns.
CORE_SENSORS = ["main_comp", "pre_comp", "tbl_speed", "tbl_fill", "ejection"]
MECHANICAL_SENSORS = ["stiffness", "SREL", "cyl_main", "cyl_pre", "fom"]
ALL_SENSORS = CORE_SENSORS + MECHANICAL_SENSORS
TENSOR_FEATURES = ["dynamic_tensile_strength", "ejection", "tbl_speed", "cyl_main", "tbl_fill"]


def enrich_dimension(df: DataFrame, dimension: DataFrame, code: str,
                     dimension_code: str = "product_code") -> DataFrame:
    """Left look-up of the dimension's attributes by normalised product code.

    Unmapped codes keep null attributes. The dimension (the product map has 25
    rows) is broadcast if a count confirms that it is small; a larger one is joined
    by key, and Spark splits skewed codes at run time.
    """
    attributes = [c for c in dimension.columns if c != dimension_code]
    keyed = broadcast_if_small(
        dimension.select(normalize_code(F.col(dimension_code)).alias("__code"), *attributes))
    return (df.withColumn("__lookup", normalize_code(F.col(code)))
            .join(keyed, F.col("__lookup") == F.col("__code"), "left")
            .drop("__lookup", "__code"))


def any_null(df: DataFrame, column: str) -> DataFrame:
    """One row: whether a look-up left some value empty."""
    return df.agg(F.coalesce(F.bool_or(F.col(column).isNull()), F.lit(False)).alias("any_null"))


def with_tensile_strength(df: DataFrame, force: str = "main_comp", diameter: str = "diameter",
                          thickness: str = "cyl_main",
                          name: str = "dynamic_tensile_strength") -> DataFrame:
    """Rows with a positive thickness, with their tensile strength."""
    guarded = positive_guard(df, thickness)
    return guarded.withColumn(name, tensile_strength(F.col(force), F.col(diameter), F.col(thickness)))


def recover_diameters(lab: DataFrame, code: str = "code", hardness: str = "tbl_av_hardness",
                      strength: str = "tbl_tensile",
                      thickness: str = "tbl_max_thickness") -> DataFrame:
    """(product_code, diameter): mean diameter per product solved from laboratory rows."""
    rows = coerce_and_drop(lab, [code, hardness, strength, thickness])
    rows = rows.filter((F.col(strength) > 0) & (F.col(thickness) > 0))
    solved = diameter_from_strength(F.col(hardness), F.col(strength), F.col(thickness))
    return (rows.groupBy(F.col(code).cast("bigint").cast("string").alias("product_code"))
            .agg(F.round(F.avg(solved), 2).alias("diameter")))


def golden_rows(df: DataFrame, quality: str = "dissolution_av", threshold: float = 80.0) -> DataFrame:
    """Rows of good quality; rows without a quality value are dropped."""
    return df.filter(F.col(quality) >= threshold)


def golden_batches(df: DataFrame, lab: DataFrame, batch: str, quality: str = "dissolution_av",
                   threshold: float = 80.0) -> DataFrame:
    """Rows of batches that the laboratory table calls good."""
    return df.join(golden_rows(lab, quality, threshold).select(batch), batch, "left_semi")


def rejected_batches(df: DataFrame, lab: DataFrame, batch: str, quality: str = "dissolution_av",
                     threshold: float = 80.0) -> DataFrame:
    """Rows of batches that are not known to be good."""
    return df.join(golden_rows(lab, quality, threshold).select(batch), batch, "left_anti")


def select_features(df: DataFrame, features: Sequence[str],
                    keep: Sequence[str] = ("timestamp", "batch")) -> DataFrame:
    """Required features plus the kept columns that exist; missing features are an error."""
    absent = [c for c in features if c not in df.columns]
    if absent:
        raise ValueError(f"missing columns: {absent}")
    return df.select(*[c for c in keep if c in df.columns], *features)


def assemble_vectors(df: DataFrame, columns: Sequence[str], name: str = "features") -> DataFrame:
    """MLlib vector column; rows where an input is null or NaN are skipped."""
    from pyspark.ml.feature import VectorAssembler
    return VectorAssembler(inputCols=list(columns), outputCol=name,
                           handleInvalid="skip").transform(df)


def complete_rows(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows in which every listed column has a value (neither null nor NaN)."""
    for c in columns:
        present = F.col(c).isNotNull()
        if isinstance(df.schema[c].dataType, (DoubleType, FloatType)):
            present = present & ~F.isnan(c)
        df = df.filter(present)
    return df


def union_by_name(*frames: DataFrame) -> DataFrame:
    """All rows of all frames; columns a frame lacks are null."""
    result = frames[0]
    for frame in frames[1:]:
        result = result.unionByName(frame, allowMissingColumns=True)
    return result
