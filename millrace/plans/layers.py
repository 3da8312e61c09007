"""The layered job: raw text files to cleaned rows to scaled training tables."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F

from millrace.operators import cleaning, features
from millrace.operators.scaling import Scaler, minmax_fit
from millrace.operators.sequences import chronological_split, trim_warmup
from millrace.sources.delimited import PROCESS_ROLES, read_process_csv, role
from millrace.sources.layers import write_layer

# Rows of a warm-up (15 minutes at 10 s) and of the smallest fragment.
WARMUP_ROWS, MIN_ROWS = 90, 100
SENSORS = [c.lower() for c in features.ALL_SENSORS]


def silver(raw: DataFrame, dimension: DataFrame, fragment: Sequence[str] = ("source_path",),
           numeric: Sequence[str] = tuple(SENSORS), tie_break: Sequence[str] = ()) -> DataFrame:
    """Raw rows of all files to cleaned rows with ``timestamp`` and ``diameter``.

    Time, speed and code come from the role columns that the reader found file by file. A
    table without them has one layout, in which they are found by name parts. ``tie_break``
    columns order rows of equal time within a fragment; without them a hash of the row does,
    so runs agree.
    """
    rows = cleaning.normalize_columns(raw)
    if role("time") not in rows.columns:
        found = {r: cleaning.find_column(rows, *parts) for r, parts in PROCESS_ROLES.items()}
        for name in ("time", "speed"):
            if found[name] is None:
                raise ValueError(f"no {name} column in {rows.columns}")
        rows = rows.withColumns({role(r): F.col(f"`{c}`") for r, c in found.items() if c}).drop(found["time"])
    time, speed, code = role("time"), role("speed"), role("code")
    rows = cleaning.parse_timestamp(rows, time)
    rows = cleaning.cast_columns(rows, list(dict.fromkeys([*numeric, speed])))
    rows = cleaning.drop_silence(rows, speed).drop(speed)
    if not tie_break:
        rows = rows.withColumn("__tie", F.xxhash64(*rows.columns))
    order = ["timestamp", *(tie_break or ["__tie"])]
    rows = trim_warmup(rows, fragment, order, WARMUP_ROWS, MIN_ROWS).drop("__tie")
    if code not in rows.columns:
        return rows
    return features.enrich_dimension(rows, dimension, code).drop(code)


def silver_job(spark: SparkSession, bronze: str, target: str, dimension: DataFrame,
               fragment: Sequence[str] = ("source_path",), numeric: Sequence[str] = tuple(SENSORS),
               tie_break: Sequence[str] = (), partition_by: Sequence[str] = ()) -> DataFrame:
    """Read the raw folder, write the cleaned table, return the rejected files and rows."""
    raw, rejected = read_process_csv(spark, bronze)
    if raw is None:
        raise ValueError(f"no readable files below {bronze}")
    write_layer(silver(raw, dimension, fragment, numeric, tie_break), target, partition_by)
    return rejected


@dataclass(frozen=True)
class Gold:
    rows: DataFrame      # scaled, with column "split"
    scaler: Scaler


def gold(cleaned: DataFrame, tensor_features: Sequence[str] = tuple(features.TENSOR_FEATURES),
         order_by: Sequence[str] = ("timestamp",), keep: Sequence[str] = ("timestamp", "batch")) -> Gold:
    """Cleaned rows to features, split in time order, scaled by the training range."""
    strong = features.with_tensile_strength(cleaned)
    chosen = features.select_features(strong, tensor_features,
                                      list(dict.fromkeys([*keep, *order_by])))
    # Rows of equal time are told apart by their content, so both readings cut at the same row.
    tied = chosen.withColumn("__tie", F.xxhash64(*chosen.columns))
    split = chronological_split(tied, [*order_by, "__tie"]).drop("__tie")
    scaler = minmax_fit(split.filter(F.col("split") == "train"), tensor_features)
    return Gold(scaler.apply(split), scaler)


def gold_job(spark: SparkSession, source: str, target: str, **options) -> Gold:
    """Read the cleaned table, write the scaled table by split."""
    made = gold(spark.read.parquet(source), **options)
    write_layer(made.rows, target, ["split"])
    return Gold(spark.read.parquet(target), made.scaler)
