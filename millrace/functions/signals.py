"""Column expressions shared by the operators."""

from __future__ import annotations

from datetime import datetime, timedelta, timezone

from pyspark.sql import Column, functions as F
from pyspark.sql.types import DataType, DoubleType, FloatType, TimestampNTZType, TimestampType


def typed_literal(value, dtype: DataType) -> Column:
    """A collected value as a literal of its own type, whatever the driver's time zone is."""
    if isinstance(value, datetime) and isinstance(dtype, TimestampNTZType):
        return F.lit(value.isoformat(sep=" ")).cast(dtype)
    if isinstance(value, datetime) and isinstance(dtype, TimestampType):
        since = value.astimezone(timezone.utc) - datetime(1970, 1, 1, tzinfo=timezone.utc)
        return F.timestamp_micros(F.lit(since // timedelta(microseconds=1)).cast("bigint"))
    return F.lit(value).cast(dtype)


def missing(column: Column, dtype: DataType) -> Column:
    """Null, or NaN for floating types."""
    if isinstance(dtype, (DoubleType, FloatType)):
        return column.isNull() | F.isnan(column)
    return column.isNull()


def nan_to_null(column: Column, dtype: DataType) -> Column:
    """NaN as null. The column is named once, so a costly expression runs once."""
    if isinstance(dtype, (DoubleType, FloatType)):
        return F.nanvl(column, F.lit(None).cast(dtype))
    return column


def as_timestamp(column: Column, dtype: DataType) -> Column:
    """Instant in UTC; text that does not parse becomes null instead of an error."""
    if isinstance(dtype, TimestampType):
        return column
    if isinstance(dtype, TimestampNTZType):
        return column.cast("timestamp")
    return F.try_to_timestamp(column)


def epoch_seconds(column: Column) -> Column:
    """Whole seconds since the epoch, rounded down (sub-second parts are dropped)."""
    return F.floor(F.unix_micros(column) / F.lit(1_000_000)).cast("bigint")


def seconds_between(later: Column, earlier: Column) -> Column:
    """Difference in seconds with its sub-second part."""
    return (F.unix_micros(later) - F.unix_micros(earlier)) / F.lit(1_000_000.0)


def tensile_strength(force_kn: Column, diameter_mm: Column, thickness_mm: Column) -> Column:
    """Breaking stress of a round tablet in MPa; kN is converted to N."""
    return F.try_divide(force_kn * 2 * 1000, F.pi() * diameter_mm * thickness_mm)


def diameter_from_strength(force_n: Column, strength_mpa: Column, thickness_mm: Column) -> Column:
    """Diameter in mm solved from the same formula."""
    return F.try_divide(force_n * 2, F.pi() * strength_mpa * thickness_mm)


def normalize_code(column: Column) -> Column:
    """Product code as text without a decimal part (``5.0`` becomes ``5``)."""
    return F.substring_index(column.cast("string"), ".", 1)


def clip(column: Column, lower: float, upper: float, nan: str = "keep") -> Column:
    """Limit to [lower, upper]; null stays null. ``nan="upper"`` clips NaN as the largest value."""
    limited = F.when(column > upper, F.lit(upper)).when(column < lower, F.lit(lower)).otherwise(column)
    if nan == "upper":
        return limited
    return F.when(F.isnan(column), column).otherwise(limited)


def health(error: Column) -> Column:
    """Health score 0..100 from a reconstruction error."""
    return F.greatest(F.lit(0.0), F.lit(100.0) - error * 1000)


def status(alert: Column) -> Column:
    """READY before the first result, then ANOMALY or HEALTHY."""
    return (F.when(alert.isNull(), F.lit("READY"))
            .when(alert, F.lit("ANOMALY")).otherwise(F.lit("HEALTHY")))


def severity(alert: Column, raised: str = "alert") -> Column:
    return F.when(alert, F.lit(raised)).otherwise(F.lit("ok"))


def signal_to_noise(anomalous: Column, normal: Column) -> Column:
    return anomalous / (normal + F.lit(1e-9))
