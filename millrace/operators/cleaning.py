"""Row and column cleaning."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import NumericType

from millrace.functions.signals import as_timestamp, clip, missing, nan_to_null
from millrace.operators.quantiles import group_quantiles


def normalize_columns(df: DataFrame) -> DataFrame:
    """Lower-case and trimmed column names."""
    return df.toDF(*[c.lower().strip() for c in df.columns])


def find_column(df: DataFrame, *parts: str) -> str | None:
    """First column whose name contains any of ``parts`` (case-insensitive)."""
    return next((c for c in df.columns if any(p in c.lower() for p in parts)), None)


def parse_timestamp(df: DataFrame, column: str, target: str = "timestamp") -> DataFrame:
    """Parse as UTC into ``target``, drop rows that do not parse, drop a renamed source column."""
    parsed = df.withColumn(target, as_timestamp(F.col(column), df.schema[column].dataType))
    if column != target:
        parsed = parsed.drop(column)
    return parsed.dropna(subset=[target])


def cast_columns(df: DataFrame, columns: Sequence[str], type_name: str = "double") -> DataFrame:
    """Cast the listed columns that exist; values that do not fit become null."""
    return df.withColumns({c: F.col(c).try_cast(type_name) for c in columns if c in df.columns})


def coerce_and_drop(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Listed columns as numbers, without the rows where one is missing or not a number."""
    return cast_columns(df.select(*columns), columns).dropna(how="any")


def clip_outliers(df: DataFrame, column: str, lower: float, upper: float,
                  nan: str = "keep") -> DataFrame:
    return df.withColumn(column, clip(F.col(column), lower, upper, nan))


def drop_duplicates(df: DataFrame, subset: Sequence[str] | None = None,
                    keep_first_by: Sequence[str] = ()) -> DataFrame:
    """Distinct rows, or one row per ``subset``.

    With ``keep_first_by`` the survivor is the smallest row in that order, so the
    result is the same on every run. Both forms combine on the map side: a value
    repeated in a third of all rows leaves each task as one row.
    """
    if not subset:
        return df.dropDuplicates()
    if not keep_first_by:
        return df.dropDuplicates(list(subset))
    rank = F.struct(*[F.col(c) for c in keep_first_by])
    row = F.struct(*[F.col(c) for c in df.columns])
    return (df.groupBy(*subset).agg(F.min_by(row, rank).alias("__row"))
            .select(*[F.col("__row")[c].alias(c) for c in df.columns]))


def impute_missing(df: DataFrame, columns: Sequence[str], strategy: str = "mean") -> DataFrame:
    """Replace null and NaN by zero, the mean or the exact median of the other values.

    Columns that do not exist are ignored; a column without any value is left as
    it is. Only the fill values, one per column, come to the driver.
    """
    types = {f.name: f.dataType for f in df.schema}
    valid = [c for c in columns if isinstance(types.get(c), NumericType)]
    if not valid:
        return df
    if strategy == "zero":
        fill = dict.fromkeys(valid, 0)
    elif strategy == "mean":
        row = df.select(*[F.avg(nan_to_null(F.col(c), types[c])).alias(c) for c in valid]).first()
        fill = row.asDict()
    elif strategy == "median":
        # All columns in one pass, as groups of a long table.
        entries = F.array(*[F.struct(F.lit(i).alias("i"), nan_to_null(F.col(c), types[c]).cast("double").alias("value"))
                            for i, c in enumerate(valid)])
        long = df.select(F.explode(entries).alias("e")).select("e.i", "e.value")
        found = group_quantiles(long, "value", [0.5], ["i"]).select("i", "quantiles").collect()
        fill = {valid[r["i"]]: r["quantiles"][0] for r in found}
    else:
        raise ValueError(f"unknown strategy: {strategy}")
    return df.withColumns({
        c: F.when(missing(F.col(c), types[c]), F.lit(v).cast(types[c])).otherwise(F.col(c))
        for c, v in fill.items() if v is not None})


def drop_silence(df: DataFrame, speed: str) -> DataFrame:
    """Keep rows of a running machine: speed above zero, not missing."""
    return df.filter((F.col(speed) > 0) & ~F.isnan(speed))


def positive_guard(df: DataFrame, column: str) -> DataFrame:
    """Keep rows that may be divided by ``column``."""
    return df.filter(F.col(column) > 0)


def has_mixed_time_format(column: str) -> Column:
    """Aggregate: any value is written with AM or PM."""
    return F.bool_or(F.coalesce(F.col(column).rlike("(?i)AM|PM"), F.lit(False)))


def filter_extension(df: DataFrame, column: str, extensions: Sequence[str]) -> DataFrame:
    """Keep names that end in one of ``extensions``, in any case."""
    name = F.lower(F.col(column))
    keep = F.lit(False)
    for extension in extensions:
        keep = keep | name.endswith(extension.lower())
    return df.filter(keep)


def split_valid(df: DataFrame, valid: Column) -> tuple[DataFrame, DataFrame]:
    """Accepted rows and quarantined rows; an unknown verdict is a rejection."""
    verdict = F.coalesce(valid, F.lit(False))
    return df.filter(verdict), df.filter(~verdict)
