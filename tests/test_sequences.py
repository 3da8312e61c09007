import datetime as dt

import pandas as pd
import pytest
from pyspark.sql import functions as F

from millrace.operators import sequences
from millrace.operators.profile import drift_profile, histogram, purge_report


def at(seconds):
    return dt.datetime(2024, 1, 1) + dt.timedelta(seconds=seconds)


def ids(df):
    return [r.sequence_id for r in df.orderBy("i").collect()]


@pytest.mark.parametrize("size", [10**6, 2])
def test_gap_boundaries(spark, size):
    times = [0, 0, 600, 1200.9, 1801.9, 1801.95, 2500]
    df = spark.createDataFrame([(i, at(t)) for i, t in enumerate(times)], ["i", "ts"])
    # 600 s and 600.9 s stay together; 601 s splits; equal times share an id.
    assert ids(sequences.split_sequences_by_gap(df, "ts", 600, ["i"], rows_per_task=size)) == [
        1, 1, 1, 1, 2, 2, 3]


@pytest.mark.parametrize("size", [10**6, 2])
@pytest.mark.parametrize("by", [(), ("g",)])
def test_rows_without_time_come_first(spark, size, by):
    df = spark.createDataFrame([(0, "a", None), (1, "a", None), (2, "a", at(5)), (3, "a", at(9000))],
                               "i int, g string, ts timestamp")
    got = sequences.split_sequences_by_gap(df, "ts", 600, ["i"], by, size)
    assert ids(got) == [2, 2, 3, 4]


def test_text_times(spark):
    df = spark.createDataFrame([(0, "2024-01-01 00:00:00"), (1, "2024-01-01 01:00:00"), (2, "bad")],
                               ["i", "ts"])
    assert ids(sequences.split_sequences_by_gap(df, "ts", 600, ["i"])) == [2, 3, 1]


def test_gap_profile_keeps_fractions(spark):
    df = spark.createDataFrame([(0, at(0)), (1, at(10.5)), (2, at(11))], ["i", "ts"])
    gaps = [r.gap_seconds for r in sequences.gap_profile(df, "ts").orderBy("ts").collect()]
    assert gaps == [10.5, 0.5]


def fragments(spark, sizes):
    rows = [(f, i, (i * 7) % n) for f, n in sizes.items() for i in range(n)]
    return spark.createDataFrame(rows, ["f", "i", "o"])


@pytest.mark.parametrize("size", [10**6, 100])
def test_warmup_and_small_fragments(spark, size):
    df = fragments(spark, {"a90": 90, "b91": 91, "c189": 189, "d190": 190, "e400": 400})
    def counts(d):
        return {r.f: r["count"] for r in d.groupBy("f").count().collect()}
    assert counts(sequences.trim_warmup(df, ["f"], ["i"], 90, rows_per_task=size)) == {
        "b91": 1, "c189": 99, "d190": 100, "e400": 310}
    kept = sequences.trim_warmup(df, ["f"], ["i"], 90, 100, size)
    assert counts(kept) == {"d190": 100, "e400": 310}
    assert kept.agg(F.min("i")).first()[0] == 90
    assert counts(sequences.drop_fragments(df, ["f"], 190)) == {"d190": 190, "e400": 400}
    long = fragments(spark, {"a": 200, "b": 900})     # "b" is cut in chunks
    assert counts(sequences.trim_warmup(long, ["f"], ["i"], 90, 100, size)) == {"a": 110, "b": 810}
    report = purge_report(df, kept, ["f"]).first()
    assert (report.fragments_kept, report.rows_retained, report.rows_dropped) == (2, 410, 550)


@pytest.mark.parametrize("size", [10**6, 9])
@pytest.mark.parametrize("n, sizes", [(0, (0, 0, 0)), (1, (0, 0, 1)), (3, (2, 0, 1)), (90, (62, 14, 14))])
def test_chronological_split_sizes(spark, size, n, sizes):
    df = spark.createDataFrame([(i,) for i in range(n)], "t int")
    got = sequences.chronological_split(df, ["t"], rows_per_task=size).toPandas()
    assert tuple((got.split == s).sum() for s in ("train", "val", "test")) == sizes
    assert list(got.sort_values("t").split) == ["train"] * sizes[0] + ["val"] * sizes[1] + ["test"] * sizes[2]


def test_split_is_exact_when_keys_repeat(spark):
    df = spark.createDataFrame([(1,)] * 100, "t int")
    got = sequences.chronological_split(df, ["t"]).groupBy("split").count().collect()
    assert {r.split: r["count"] for r in got} == {"train": 70, "val": 15, "test": 15}


@pytest.mark.parametrize("size", [10**6, 900])
def test_tail(spark, size, monkeypatch):
    monkeypatch.setattr(sequences, "SMALL_LIMIT", 10)
    df = spark.range(5000).withColumn("o", (F.col("id") * 7919) % 5000)
    for n in (5, 1200, 9000):
        got = sequences.tail_rows(df, ["o"], n, size).agg(F.count("*"), F.min("o")).first()
        assert tuple(got) == (min(n, 5000), max(0, 5000 - n))


def test_drift_of_the_longest_batch(spark):
    rows = [("a", i, 2.0 * i) for i in range(50)] + [("b", i, 0.0) for i in range(20)]
    slopes, smooth = drift_profile(spark.createDataFrame(rows, ["b", "t", "x"]), ["b"], ["t"], ["x"], 5,
                                   rows_per_task=12)
    assert slopes.first().x_slope == pytest.approx(2.0)
    last = smooth.orderBy(F.desc("position")).first()
    assert (smooth.count(), last.position, last.x_mean) == (50, 50, pytest.approx(2.0 * 47))


def test_histogram_closes_the_last_bin(spark):
    import numpy as np
    values = [0.0, 0.1, 0.5, 0.9, 1.0, 1.0, 2.5, 5.0]
    got = histogram(spark.createDataFrame([(v,) for v in values], ["x"]), "x", 10).orderBy("bin").toPandas()
    counts, edges = np.histogram(values, 10)
    assert list(got.n) == list(counts)
    assert list(got.lower) == pytest.approx(list(edges[:-1]))
    assert pd.Series(got.upper).iloc[-1] == pytest.approx(5.0)
