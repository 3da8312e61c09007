"""Fault injection and sensitivity of the detectors."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from millrace.functions.signals import signal_to_noise
from millrace.operators.detect.consensus import detect_or
from millrace.operators.detect.pca import Moments, mahalanobis, mahalanobis_alert
from millrace.operators.ordered import POSITION, ROWS_PER_TASK, per_series
from millrace.operators.sampling import sample_n

# The magnitudes and fault names of the published sensitivity tables,
# and the size, length and rate of a fault on a live stream.
MAGNITUDES = (0.1, 0.25, 0.5, 1.0, 2.0, 3.0, 5.0)
ROW_FAULTS = ("none", "spike", "drift_end", "freeze")
WINDOW_FAULTS = ("none", "spike", "drift", "freeze")
STREAM_FAULTS = ("spike", "drift", "freeze")
SPIKE_STEPS = 5
STREAM_SPIKE = 0.5
STREAM_DRIFT_RATE = 0.02
STREAM_STEPS = 40

Scenario = tuple[str, str, float]   # fault type, feature, magnitude


def row_scenarios(features: Sequence[str], magnitudes: Sequence[float] = MAGNITUDES) -> list[Scenario]:
    """Spike on the first feature and end drift on the second at every magnitude; freeze and
    no fault once. ``none`` gives the false-positive rate."""
    grid = [(kind, features[at], float(m)) for m in magnitudes
            for at, kind in enumerate(("spike", "drift_end"))]
    return [*grid, ("freeze", features[0], 0.0), ("none", features[0], 0.0)]


def window_scenarios(spike: str, drift: str, freeze: str,
                     magnitudes: Sequence[float] = MAGNITUDES) -> list[Scenario]:
    grid = [(kind, feature, float(m)) for m in magnitudes
            for kind, feature in (("spike", spike), ("drift", drift))]
    return [*grid, ("freeze", freeze, 0.0), ("none", freeze, 0.0)]


def _check(scenarios: Sequence[Scenario], allowed: Sequence[str]) -> None:
    unknown = sorted({kind for kind, _, _ in scenarios} - set(allowed))
    if unknown:
        raise ValueError(f"unknown fault types: {unknown}; known: {list(allowed)}")


def scenario_grid(df: DataFrame, scenarios: Sequence[Scenario]) -> DataFrame:
    """Every row once per scenario, with ``type``, ``feature`` and ``magnitude``.

    The scenarios are a literal in the projection, so no data moves.
    """
    grid = F.array(*[F.struct(F.lit(t).alias("type"), F.lit(f).alias("feature"),
                              F.lit(m).alias("magnitude")) for t, f, m in scenarios])
    return df.withColumn("__s", F.explode(grid)).select(*df.columns, "__s.*")


def inject_rows(df: DataFrame, features: Sequence[str]) -> DataFrame:
    """Spike and end drift add the magnitude to the scenario's feature; freeze changes nothing."""
    hit = F.col("type").isin("spike", "drift_end")
    return df.withColumns({
        c: F.when(hit & (F.col("feature") == c), F.col(c) + F.col("magnitude")).otherwise(F.col(c))
        for c in features})


def inject_windows(df: DataFrame, features: Sequence[str], size: int,
                   steps: str = "steps", name: str = "injected") -> DataFrame:
    """Add the faulty copy of a window array.

    Spike raises ``SPIKE_STEPS`` steps from the middle, drift rises linearly from 0
    to the magnitude, freeze holds the first value.
    """
    kind, m = F.col("type"), F.col("magnitude")
    first = F.element_at(steps, 1)

    def step(x: Column, i: Column) -> Column:
        ramp = m * i / F.lit(float(max(size - 1, 1)))
        burst = (i >= size // 2) & (i < size // 2 + SPIKE_STEPS)
        fields = []
        for c in features:
            here = F.col("feature") == c
            fields.append(
                F.when(here & (kind == "spike") & burst, x[c] + m)
                .when(here & (kind == "drift"), x[c] + ramp)
                .when(here & (kind == "freeze"), first[c])
                .otherwise(x[c]).alias(c))
        return F.struct(*fields)

    return df.withColumn(name, F.transform(steps, step))


def inject_stream(df: DataFrame, schedule: DataFrame, by: Sequence[str], step: str,
                  features: Sequence[str]) -> DataFrame:
    """Apply scheduled faults (``by``, ``type``, ``sensor`` index, ``start`` step) to rows.

    A fault acts on steps 0..STREAM_STEPS after its start; of several the latest
    start wins. Values are not clipped. Works on streams: the schedule is a static
    table, reduced to one row per key, so rows are never repeated.
    """
    fault = F.struct(F.col("start").cast("bigint").alias("start"), F.col("type"), F.col("sensor"))
    known = schedule.filter(F.col("type").isin(*STREAM_FAULTS))
    per_key = known.groupBy(*by).agg(F.collect_list(fault).alias("__faults"))
    joined = df.join(per_key, list(by), "left")
    running = F.filter("__faults", lambda f: (F.col(step) >= f["start"])
                       & (F.col(step) - f["start"] <= STREAM_STEPS))
    joined = joined.withColumn("__fault", F.array_max(running))
    kind, elapsed = F.col("__fault.type"), F.col(step) - F.col("__fault.start")
    changed = {}
    for i, c in enumerate(features):
        here = F.coalesce(F.col("__fault.sensor") == i, F.lit(False))
        changed[c] = (F.when(here & (kind == "spike"), F.col(c) + STREAM_SPIKE)
                      .when(here & (kind == "drift"), F.col(c) + elapsed * STREAM_DRIFT_RATE)
                      .when(here & (kind == "freeze"), F.lit(0.0)).otherwise(F.col(c)))
    return (joined.withColumns({**changed, "fault": kind})
            .drop("__faults", "__fault").select(*df.columns, "fault"))


def row_sensitivity(rows: DataFrame, features: Sequence[str], keys: Sequence[str],
                    models: dict[str, tuple[Column, float]], n: int = 200,
                    scenarios: Sequence[Scenario] | None = None, seed: int = 42) -> DataFrame:
    """One row per trial: sampled row x scenario x model, with score and verdict.

    ``models`` maps a name to (score expression over the features, threshold).
    """
    scenarios = scenarios or row_scenarios(features)
    _check(scenarios, ROW_FAULTS)
    trials = inject_rows(scenario_grid(sample_n(rows.select(*keys, *features), n, keys, seed),
                                       scenarios), features)
    scored = trials.select(*keys, "type", "magnitude", F.explode(F.array(*[
        F.struct(F.lit(name).alias("model"), score.alias("score"), F.lit(float(limit)).alias("limit"))
        for name, (score, limit) in models.items()])).alias("__m"))
    return scored.select(*keys, "__m.model", "type", "magnitude", "__m.score",
                         (F.col("__m.score") > F.col("__m.limit")).alias("detected"))


def sample_windows(df: DataFrame, by: Sequence[str], order_by: Sequence[str],
                   columns: Sequence[str], size: int, n: int = 100, stride: int = 1,
                   seed: int = 42, rows_per_task: int = ROWS_PER_TASK) -> DataFrame:
    """``n`` random windows with their steps.

    Window numbers are drawn first (n small rows, which fix the draw), then only
    the series they lie in are read and only their rows are gathered.
    """
    def ends(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
        start = F.col(POSITION) - size
        return (rows.filter((start >= 0) & (start % stride == 0))
                .select(*keys, POSITION, start.alias("window_id")))

    keyed = df
    for c in by:
        keyed = keyed.filter(F.col(c).isNotNull())
    all_ids = per_series(keyed.select(*dict.fromkeys([*by, *order_by])), by, order_by, 0, ends,
                         rows_per_task).drop(POSITION)
    drawn = sample_n(all_ids, n, [*by, "window_id"], seed)
    fixed = df.sparkSession.createDataFrame(drawn.collect(), drawn.schema)
    part = keyed.join(F.broadcast(fixed.select(*by).distinct()), list(by), "left_semi") if by else keyed

    def numbered(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
        return rows.select(*dict.fromkeys([*keys, POSITION, *columns]))

    rows = per_series(part, by, order_by, 0, numbered, rows_per_task)
    low = F.col("window_id")
    inside = (F.col(POSITION) > low) & (F.col(POSITION) <= low + size)
    same = [F.col(f"r.{c}") == F.col(f"w.{c}") for c in by]
    match = inside
    for condition in same:
        match = match & condition
    gathered = rows.alias("r").join(F.broadcast(fixed.alias("w")), match)
    step = F.struct(F.col(POSITION), *[F.col(f"r.{c}").alias(c) for c in columns])
    return (gathered.groupBy(*[F.col(f"w.{c}").alias(c) for c in by], "window_id")
            .agg(F.array_sort(F.collect_list(step)).alias("steps"))
            .withColumn("steps", F.transform("steps", lambda x: F.struct(
                *[x[c].alias(c) for c in columns]))))


def _flat(steps: str, features: Sequence[str]) -> Column:
    return F.flatten(F.transform(steps, lambda x: F.array(*[x[c].cast("double") for c in features])))


def window_sensitivity(windows: DataFrame, by: Sequence[str], model, latent: Moments,
                       recon_threshold: float, scenarios: Sequence[Scenario],
                       epsilon: float = 1e-4, compat: bool = False) -> DataFrame:
    """One row per (window, scenario): errors before and after, SNR and three verdicts."""
    _check(scenarios, WINDOW_FAULTS)
    features, size, degrees = list(model.features), model.size, len(latent.mean)
    trials = inject_windows(scenario_grid(windows, scenarios), features, size)
    keys = [*by, "window_id", "type", "feature", "magnitude"]
    flat = trials.select(*keys, _flat("steps", features).alias("before"),
                         _flat("injected", features).alias("after"))

    def score(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            if frame.empty:
                continue
            before, after = (np.stack(frame[c].to_numpy()).reshape(len(frame), size, len(features))
                             for c in ("before", "after"))
            faulty = model.errors(after)
            out = frame[keys].copy()
            out["mae_normal"], out["mae_anomaly"] = model.errors(before)["mae"], faulty["mae"]
            out["latent"] = faulty["latent"]
            out["is_freeze"] = (after.std(axis=1) < epsilon).any(axis=1)
            yield out

    types = {f.name: f.dataType.simpleString() for f in flat.schema}
    schema = ", ".join([*[f"`{k}` {types[k]}" for k in keys], "mae_normal double",
                        "mae_anomaly double", "latent array<double>", "is_freeze boolean"])
    z = [F.col("latent")[i] for i in range(degrees)]
    return (flat.mapInPandas(score, schema)
            .withColumns({"snr": signal_to_noise(F.col("mae_anomaly"), F.col("mae_normal")),
                          "maha_dist": mahalanobis(latent, z),
                          "detected_recon": F.col("mae_anomaly") > recon_threshold})
            .withColumn("detected_maha", mahalanobis_alert(F.col("maha_dist"), degrees, compat))
            .withColumn("detected", detect_or(F.col("is_freeze"), F.col("detected_recon"),
                                              F.col("detected_maha")))
            .drop("latent"))
