import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from millrace.operators import windows


def series(spark, sizes, features=3):
    rng = np.random.default_rng(0)
    rows = [(b, t, *map(float, rng.random(features))) for b, n in sizes.items() for t in range(n)]
    return spark.createDataFrame(rows, ["batch", "timestamp", *[f"x{i}" for i in range(features)]])


@pytest.mark.parametrize("sizes, size, count", [
    ({1: 100, 2: 100}, 10, 182), ({1: 10}, 10, 1), ({1: 15, 2: 25}, 10, 22), ({1: 5, 2: 20}, 10, 11)])
@pytest.mark.parametrize("limit", [10**6, 12])
def test_window_counts(spark, sizes, size, count, limit):
    df = series(spark, sizes)
    got = windows.sliding_windows(df, ["batch"], ["timestamp"], ["x0", "x1", "x2"], size,
                                  rows_per_task=limit).collect()
    assert len(got) == count
    assert all(len(r.steps) == size and len(r.steps[0]) == 3 for r in got)
    assert all(r.end_ts - r.start_ts == size - 1 for r in got)      # no window crosses a batch


def brute(pdf, columns, size, stride):
    out = {}
    for b, g in pdf.groupby("batch"):
        values = g.sort_values("timestamp")[columns].to_numpy()
        for s in range(0, len(values) - size + 1, stride):
            out[(b, s)] = values[s:s + size]
    return out


@pytest.mark.parametrize("limit", [10**6, 40, 13])
@pytest.mark.parametrize("stride", [1, 5])
def test_map_windows_against_brute_force(spark, limit, stride):
    df = series(spark, {1: 100, 2: 31, 3: 9, 4: 13}, 2).repartition(3)
    want = brute(df.toPandas(), ["x0", "x1"], 10, stride)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 17)
    try:
        got = windows.map_windows(df, ["batch"], ["timestamp"], ["x0", "x1"], 10,
                                  lambda w: {"flat": list(w.reshape(len(w), -1))}, "flat array<double>",
                                  stride, limit).collect()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert {(r.batch, r.window_id) for r in got} == set(want) and len(got) == len(want)
    for r in got:
        np.testing.assert_array_equal(r.flat, want[r.batch, r.window_id].ravel())


@pytest.mark.parametrize("limit", [10**6, 15])
def test_moments_count_each_window_once(spark, limit):
    df = series(spark, {1: 100, 2: 31, 3: 9}, 2)
    flat = np.array([w.ravel() for w in brute(df.toPandas(), ["x0", "x1"], 6, 1).values()])
    n, total, cross = windows.window_moments(df, ["batch"], ["timestamp"], ["x0", "x1"], 6, [0.0, 0.0],
                                             rows_per_task=limit)
    assert n == len(flat)
    np.testing.assert_allclose(total, flat.sum(axis=0))
    np.testing.assert_allclose(cross, flat.T @ flat)


def test_rows_without_batch_make_no_window(spark):
    df = spark.createDataFrame([(None, t, 1.0) for t in range(9)], "batch int, timestamp int, x double")
    assert windows.sliding_windows(df, ["batch"], ["timestamp"], ["x"], 3).count() == 0


@pytest.mark.parametrize("limit", [10**6, 8])
def test_without_a_key_the_table_is_one_series(spark, limit):
    df = series(spark, {1: 30}, 1)
    got = windows.sliding_windows(df, [], ["timestamp"], ["x0"], 4, rows_per_task=limit)
    assert sorted(r.start_ts for r in got.collect()) == list(range(27))


@pytest.mark.parametrize("limit", [10**6, 9])
def test_freeze(spark, limit):
    x = [1.0] * 5 + [float(i) for i in range(10)] + [None, 1.0, 1.0, 1.0]
    df = spark.createDataFrame([(1, t, v, float(t)) for t, v in enumerate(x)],
                               "batch int, timestamp int, x double, y double")
    got = windows.freeze_flag(df, ["batch"], ["timestamp"], ["x", "y"], 3, rows_per_task=limit)
    flags = [r.is_freeze for r in got.orderBy("timestamp").collect()]
    assert flags[:2] == [None, None] and flags[2:5] == [True] * 3
    assert not any(flags[5:18]) and flags[18] is True


@pytest.mark.parametrize("limit", [10**6, 25])
def test_history_and_padding(spark, limit):
    df = series(spark, {1: 60, 2: 3}, 1)
    values = df.toPandas().sort_values(["batch", "timestamp"]).groupby("batch")["x0"].apply(list)
    for r in windows.rolling_history(df, ["batch"], ["timestamp"], ["x0"], 10, limit).collect():
        assert r.x0_history == values[r.batch][max(0, r.timestamp - 9):r.timestamp + 1]
    for r in windows.padded_windows(df, ["batch"], ["timestamp"], ["x0"], 10, limit).collect():
        seen = values[r.batch][max(0, r.timestamp - 9):r.timestamp + 1]
        assert [s.x0 for s in r.steps] == [seen[0]] * (10 - len(seen)) + seen


def test_size_one(spark):
    df = series(spark, {1: 4}, 1)
    got = windows.map_windows(df, ["batch"], ["timestamp"], ["x0"], 1, lambda w: {"m": w[:, 0, 0]}, "m double")
    assert got.count() == 4 and got.agg(F.sum("m")).first()[0] == pytest.approx(df.agg(F.sum("x0")).first()[0])
    assert isinstance(pd.DataFrame(got.collect()), pd.DataFrame)
