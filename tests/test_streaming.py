import datetime as dt
import os

import numpy as np
import pytest
from pyspark.sql import functions as F

from millrace.operators.detect.consensus import DETECTION_SCHEMA, detect
from millrace.operators.windows import map_windows, padded_windows
from millrace.queries.detectors import fixed_detector
from millrace.session import scratch_path
from millrace.streaming import history, live
from millrace.streaming.faults import inject_live
from millrace.streaming.sessions import sessions

SCHEMA = "k string, ts timestamp, t int, x double"
START = dt.datetime(2024, 1, 1)
N, LATE = 240, 40


def rows_of(seed=0):
    rng = np.random.default_rng(seed)
    return [("hot" if rng.random() < 0.6 else str(rng.integers(3)), START + dt.timedelta(seconds=i // 2), i, float(rng.random()))
            for i in range(N)]


def written(spark, files):
    """One file after the other, in the order of their reading."""
    path = scratch_path(spark, "in")
    for rows in files:
        spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(path)
    return path


@pytest.fixture(scope="module", params=["one file", "three shuffled files"])
def files(spark, request):
    rows = rows_of()
    if request.param == "one file":
        return written(spark, [rows])
    # Rows up to LATE seconds out of order, over files that overlap in time.
    order = np.argsort(np.arange(N) + np.random.default_rng(3).uniform(0, LATE, N), kind="stable")
    mixed = [rows[i] for i in order]
    return written(spark, [mixed[80 * i:80 * i + 80] for i in range(3)])


def source(spark, files):
    return (spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).option("latestFirst", "false")
            .parquet(files))


def by_value():
    """A function made here travels to the workers with its code."""
    def mean(windows):
        return {"m": windows[:, :, 0].mean(axis=1), "first": windows[:, 0, 0]}
    return mean


mean = by_value()
LATE_TEXT = f"{LATE} seconds"


@pytest.fixture(autouse=True, scope="module")
def few_partitions(spark):
    """Every state partition takes its time to open."""
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "2")
    yield
    spark.conf.set("spark.sql.shuffle.partitions", before)


def to_the_end(spark, stream, build):
    return live.replay(stream, "ts", build, scratch_path(spark, "s"))


def test_ring_buffer_equals_padded_windows(spark, files):
    got = to_the_end(spark, source(spark, files), lambda rows: live.ring_buffer(
        rows, ["k"], ["ts", "t"], ["x"], 7, mean, "m double, first double", LATE_TEXT, span_ms=3_000))
    got = {(r.k, r.t): (r.m, r.first) for r in got.collect()}
    batch = padded_windows(spark.read.parquet(files), ["k"], ["ts", "t"], ["x"], 7).collect()
    assert len(got) == len(batch) == N
    for r in batch:
        values = [s.x for s in r.steps]
        np.testing.assert_allclose(got[r.k, r.t], (np.mean(values), values[0]))


def test_full_windows_equal_batch(spark, files):
    got = to_the_end(spark, source(spark, files), lambda rows: live.ring_buffer(
        rows, ["k"], ["ts", "t"], ["x"], 7, mean, "m double, first double", LATE_TEXT, pad=False, span_ms=9_000))
    live_rows = sorted((r.k, r.ts, round(r.m, 12), r.first) for r in got.collect())
    batch = map_windows(spark.read.parquet(files), ["k"], ["ts", "t"], ["x"], 7, mean, "m double, first double")
    assert live_rows == sorted((r.k, r.end_ts, round(r.m, 12), r.first) for r in batch.collect())


def histories(rows, n):
    past, out = {}, {}
    for k, ts, t, x in rows:
        past.setdefault(k, []).append(x)
        out[k, t] = past[k][-n:]
    return out


def test_rolling_values(spark, files):
    got = to_the_end(spark, source(spark, files), lambda rows: live.rolling_values(
        rows, ["k"], ["ts", "t"], ["x"], LATE_TEXT, 5, span_ms=13_000)).collect()
    assert len(got) == N and {(r.k, r.t): r.x_history for r in got} == histories(rows_of(), 5)


def test_only_passed_spans_are_released_before_the_end(spark, files):
    got = live.drain(live.rolling_values(source(spark, files), ["k"], ["ts", "t"], ["x"], LATE_TEXT, 5, span_ms=5_000),
                     scratch_path(spark, "s")).collect()
    passed = ((N - 1) // 2 - LATE) // 5 * 5
    assert {(r.k, r.t): r.x_history for r in got} == {
        (k, t): v for (k, t), v in histories(rows_of(), 5).items() if t // 2 < passed}


def test_one_row_windows_and_null_keys(spark):
    rows = [(None if i % 3 else "a", START + dt.timedelta(seconds=i), i, float(i)) for i in range(30)]
    path = written(spark, [rows])
    for n in (1, 4):
        got = to_the_end(spark, source(spark, path), lambda r, n=n: live.rolling_values(
            r, ["k"], ["ts", "t"], ["x"], LATE_TEXT, n, span_ms=7_000)).collect()
        assert {(r.k, r.t): r.x_history for r in got} == histories(rows, n)


def test_a_hot_key_is_split(spark, monkeypatch):
    """No call and no state value holds a key: spans meet in different tasks, and blocks are bounded."""
    monkeypatch.setattr(history, "BLOCK_ROWS", 20)
    rows = [("hot", START + dt.timedelta(seconds=i), i, float(i)) for i in range(400)]
    path = written(spark, [rows])
    sizes = F.struct("k", "lead", F.length("rows").alias("bytes"), F.spark_partition_id().alias("part"))

    def build(stream):
        return history.released_blocks(stream, ["k"], ["ts", "t"], ["x"], 5, LATE_TEXT, 50_000).select(sizes.alias("s"))

    got = to_the_end(spark, source(spark, path), build).select("s.*").collect()
    # Eight spans: their first four rows, and the other 46 in blocks of at most 20 rows.
    assert len(got) == 8 * (1 + 3) and {r.lead for r in got} == {0, 4}
    assert len({r.part for r in got}) > 1
    values = to_the_end(spark, source(spark, path), lambda r: live.rolling_values(
        r, ["k"], ["ts", "t"], ["x"], LATE_TEXT, 5, span_ms=50_000)).collect()
    assert {(r.k, r.t): r.x_history for r in values} == histories(rows, 5)


def test_detector_on_raw_rows_equals_batch(spark):
    rows = [(k, ts, t, 300 * x) for k, ts, t, x in rows_of(1)]
    path = written(spark, [rows[:150], rows[150:]])
    both = lambda df: df.select("k", "ts", "t", F.col("x").alias("value"), (F.col("t") % 60).cast("double").alias("k2"))
    detector = fixed_detector()
    got = to_the_end(spark, both(source(spark, path)), lambda r: live.ring_buffer(
        r, ["k"], ["ts", "t"], ["value", "k2"], detector.size, detector, DETECTION_SCHEMA, LATE_TEXT, pad=False,
        span_ms=30_000))
    pick = ["window_error", "window_alert", "pca_score", "pca_alert", "iso_score", "iso_alert"]
    live_rows = sorted(tuple(round(v, 9) if isinstance(v, float) else v for v in r) for r in got.select("k", "ts", *pick).collect())
    raw = both(spark.read.parquet(path)).withColumnsRenamed({"k": "series", "k2": "k"})
    batch = detect(raw, ["series"], ["ts", "t"], detector).select("series", "end_ts", *pick)
    assert live_rows == sorted(tuple(round(v, 9) if isinstance(v, float) else v for v in r) for r in batch.collect())
    assert 0 < sum(r[3] for r in live_rows) < len(live_rows)


@pytest.mark.parametrize("span", [100_000, 10_000_000])
def test_idle_keys_start_anew(spark, span):
    sec = lambda s: START + dt.timedelta(seconds=s)
    files = [[("a", sec(0), 0, 1.0), ("a", sec(1), 1, 2.0)], [("b", sec(5000), 2, 0.0)], [("b", sec(5001), 3, 0.0)],
             [("a", sec(6000), 4, 3.0), ("a", sec(6060), 5, 4.0), ("a", sec(6121), 6, 5.0)], [("b", sec(9000), 7, 0.0)]]
    path = written(spark, files)
    got = to_the_end(spark, source(spark, path), lambda r: live.rolling_values(
        r, ["k"], ["ts", "t"], ["x"], "0 seconds", 5, expire_ms=60_000, span_ms=span)).collect()
    assert {r.t: r.x_history for r in got if r.k == "a"} == {
        0: [1.0], 1: [1.0, 2.0], 4: [3.0], 5: [3.0, 4.0], 6: [5.0]}


def test_event_time_must_be_a_timestamp(spark, files):
    with pytest.raises(ValueError, match="timestamp"):
        live.rolling_values(source(spark, files), ["k"], ["t"], ["x"], LATE_TEXT)


def session_files(spark, order):
    """One file a second, in the given order."""
    path = scratch_path(spark, "in")
    for k, s in order:
        (spark.createDataFrame([(k, float(s))], "k string, s double").select("k", F.timestamp_micros((F.col("s") * 1e6).cast("long")).alias("ts"))
         .coalesce(1).write.mode("append").parquet(path))
    return spark.readStream.schema("k string, ts timestamp").option("maxFilesPerTrigger", 1).parquet(path)


def test_sessions_close_behind_the_watermark(spark):
    path = scratch_path(spark, "in")
    times = [("a", s) for s in (0, 100, 700, 1301)] + [("b", 5000), (None, 0)]
    rows = spark.createDataFrame(times, "k string, s long").select("k", F.timestamp_seconds("s").alias("ts"))
    rows.write.parquet(path)
    stream = spark.readStream.schema(rows.schema).parquet(path)
    got = live.drain(sessions(stream, ["k"], "ts", "0 seconds", 600), scratch_path(spark, "s"))
    # 600 s apart is still one session; the last session of "b" is open.
    assert {(r.k, r.rows, r.late) for r in got.collect()} == {("a", 1, False), ("a", 3, False), (None, 1, False)}


def test_sessions_do_not_depend_on_the_order_of_files(spark):
    times = [("a", s) for s in (100, 200.9, 5000, 5600.99, 9000, 20000)]
    for order in ([0, 1, 2, 3, 4, 5], [3, 0, 4, 2, 1, 5]):
        stream = session_files(spark, [times[i] for i in order])
        got = to_the_end(spark, stream, lambda r: sessions(r, ["k"], "ts", "10000 seconds", 600)).collect()
        # Whole seconds count: 5000 to 5600.99 is 600.
        assert sorted((r.k, r.rows) for r in got if not r.late) == [("a", 1), ("a", 1), ("a", 2), ("a", 2)]
        assert not any(r.late for r in got)


def test_late_rows_are_counted(spark):
    times = [("a", 1000), ("a", 1100), ("b", 9000), ("a", 1200), ("a", 8950), ("b", 9050), ("a", 3)]
    got = to_the_end(spark, session_files(spark, times), lambda r: sessions(r, ["k"], "ts", "100 seconds", 600)).collect()
    assert sorted((r.k, r.rows) for r in got if not r.late) == [("a", 1), ("a", 2), ("b", 2)]
    assert sorted(r.start_ts.timestamp() for r in got if r.late) == [3, 1200]
    assert sum(r.rows for r in got) == len(times)


def test_sessions_equal_batch(spark, files):
    from millrace.operators.sequences import split_sequences_by_gap
    got = to_the_end(spark, source(spark, files).where("t % 7 < 2"), lambda r: sessions(r, ["k"], "ts", LATE_TEXT, 3))
    numbered = split_sequences_by_gap(spark.read.parquet(files).where("t % 7 < 2"), "ts", 3, ["t"], ["k"])
    batch = numbered.groupBy("k", "sequence_id").agg(F.count(F.lit(1)), F.min("ts"), F.max("ts")).drop("sequence_id")
    assert sorted(tuple(r)[:4] for r in got.collect()) == sorted(tuple(r) for r in batch.collect())


FAULTS = [("hot", 50, "drift", 0), ("hot", 60, "spike", 0), ("1", 10, "freeze", 0), ("2", 20, "unknown", 0), ("2", 30, "spike", 5),
          (None, 0, "spike", 0), ("hot", 118, "freeze", 0), ("hot", 118, "drift", 0)]


@pytest.mark.parametrize("order", [range(8), [6, 1, 0, 3, 7, 2, 5, 4]])
def test_faults_from_a_stream(spark, files, order):
    path, schema = scratch_path(spark, "in"), "k string, at timestamp, type string, sensor int"
    listed = [(k, START + dt.timedelta(seconds=s), kind, sensor) for k, s, kind, sensor in (FAULTS[i] for i in order)]
    for part in (listed[:3], listed[3:]):
        spark.createDataFrame(part, schema).coalesce(1).write.mode("append").parquet(path)
    faults = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(path)
    got = live.replay_all(
        {"rows": (source(spark, files), "ts"), "faults": (faults, "at")},
        lambda rows, faults: inject_live(rows, faults, ["k"], ["ts", "t"], ["x"], LATE_TEXT, "200 seconds", 1, salts=3),
        scratch_path(spark, "s")).collect()
    expected = []
    for k, ts, t, x in rows_of():
        second = (ts - START).seconds
        acting = [(s, kind, sensor) for f, s, kind, sensor in FAULTS
                  if f == k and kind != "unknown" and 0 <= second - s <= 40]
        at, kind, sensor = max(acting, default=(0, None, None))
        if sensor == 0:
            x = {"spike": x + 0.5, "drift": x + (second - at) * 0.02, "freeze": 0.0}[kind]
        expected.append((k, ts, t, x, kind))
    assert sorted(map(tuple, got)) == sorted(expected) and sum(e[4] is not None for e in expected) > 60


def test_a_running_query_goes_on_where_it_stopped(spark, files):
    path = scratch_path(spark, "s")
    stream = source(spark, files).select("k", "t")
    query = live.run(stream, path, "100 milliseconds")
    query.processAllAvailable()
    query.stop()
    assert live.drain(stream, path).count() == N


def counted(function, path):
    """``function``, which leaves a mark in a file at every call, in whatever process."""
    def call(*args):
        with open(path, "ab") as marks:
            marks.write(b".")
        return function(*args)
    return call


def many_keys(spark, n=2_000):
    path = scratch_path(spark, "in")
    keys = spark.range(n).select(F.col("id").cast("string").alias("k"), F.timestamp_seconds(F.col("id") + 1).alias("ts"),
                                 F.col("id").cast("int").alias("t"), F.col("id").cast("double").alias("x"))
    keys.coalesce(1).write.parquet(path)
    return source(spark, path)


def test_state_has_no_call_for_every_key(spark, monkeypatch, tmp_path):
    monkeypatch.setattr(history, "dump", counted(history.dump, str(tmp_path / "calls")))
    got = to_the_end(spark, many_keys(spark), lambda r: live.ring_buffer(
        r, ["k"], ["ts", "t"], ["x"], 7, mean, "m double, first double", LATE_TEXT, span_ms=10_000_000))
    assert got.count() == 2_000 and 0 < (tmp_path / "calls").stat().st_size < 2_000


def test_full_windows_of_keys_in_one_bucket(spark, files):
    got = to_the_end(spark, source(spark, files), lambda rows: live.ring_buffer(
        rows, ["k"], ["ts", "t"], ["x"], 7, mean, "m double, first double", LATE_TEXT, pad=False, span_ms=9_000, buckets=1))
    live_rows = sorted((r.k, r.ts, round(r.m, 12), r.first) for r in got.collect())
    batch = map_windows(spark.read.parquet(files), ["k"], ["ts", "t"], ["x"], 7, mean, "m double, first double")
    assert live_rows == sorted((r.k, r.end_ts, round(r.m, 12), r.first) for r in batch.collect())


def test_padded_windows_of_keys_in_one_bucket(spark, files, monkeypatch):
    monkeypatch.setattr(history, "BLOCK_ROWS", 20)
    got = to_the_end(spark, source(spark, files), lambda rows: live.ring_buffer(
        rows, ["k"], ["ts", "t"], ["x"], 7, mean, "m double, first double", LATE_TEXT, span_ms=9_000, buckets=1))
    got = {(r.k, r.t): (r.m, r.first) for r in got.collect()}
    batch = padded_windows(spark.read.parquet(files), ["k"], ["ts", "t"], ["x"], 7).collect()
    assert len(got) == len(batch) == N
    for r in batch:
        values = [s.x for s in r.steps]
        np.testing.assert_allclose(got[r.k, r.t], (np.mean(values), values[0]))


def test_histories_of_keys_in_one_bucket(spark, files):
    """Pauses of one key do not end those of others."""
    past, expected = {}, {}
    for k, ts, t, x in rows_of():
        since = past.setdefault(k, [])
        if since and (ts - since[-1][0]).total_seconds() > 3:
            since.clear()
        since.append((ts, x))
        expected[k, t] = [x for _, x in since[-5:]]
    got = to_the_end(spark, source(spark, files), lambda r: live.rolling_values(
        r, ["k"], ["ts", "t"], ["x"], LATE_TEXT, 5, expire_ms=3_000, span_ms=11_000, buckets=1)).collect()
    assert len(got) == N and {(r.k, r.t): r.x_history for r in got} == expected


def test_sessions_make_no_call_for_every_key(spark, monkeypatch, tmp_path):
    from millrace.streaming import sessions as module
    monkeypatch.setattr(module, "merged", counted(module.merged, str(tmp_path / "calls")))
    got = to_the_end(spark, many_keys(spark), lambda r: module.sessions(r, ["k"], "ts", LATE_TEXT, 3))
    assert got.where("rows = 1 and not late").count() == 2_000
    assert 0 < (tmp_path / "calls").stat().st_size < 2_000


def test_sessions_of_keys_in_one_bucket(spark, files):
    from millrace.operators.sequences import split_sequences_by_gap
    got = to_the_end(spark, source(spark, files).where("t % 7 < 2"),
                     lambda r: sessions(r, ["k"], "ts", LATE_TEXT, 3, buckets=1))
    numbered = split_sequences_by_gap(spark.read.parquet(files).where("t % 7 < 2"), "ts", 3, ["t"], ["k"])
    batch = numbered.groupBy("k", "sequence_id").agg(F.count(F.lit(1)), F.min("ts"), F.max("ts")).drop("sequence_id")
    assert sorted(tuple(r)[:4] for r in got.collect()) == sorted(tuple(r) for r in batch.collect())


@pytest.mark.parametrize("asked", [None, 3])
def test_parts_of_state_do_not_follow_the_partitions_of_batch_jobs(spark, files, asked):
    before, path = spark.conf.get("spark.sql.shuffle.partitions"), scratch_path(spark, "parts")
    most = asked or max(8, spark.sparkContext.defaultParallelism)
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "40")
        found = live.drain(sessions(source(spark, files), ["k"], "ts", LATE_TEXT, 5), path, asked)
        assert found.count() > 0
        assert spark.conf.get("spark.sql.shuffle.partitions") == "40"
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    state = spark.read.format("state-metadata").load(f"{path}/checkpoint")
    assert {r["numPartitions"] for r in state.collect()} == {most}


@pytest.mark.parametrize("width", [4, 1_000])
def test_parts_that_score_do_not_follow_the_partitions_of_batch_jobs(spark, files, width):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    blocks = spark.range(5).select(F.col("id").cast("string").cast("binary").alias("rows"))
    try:
        spark.conf.set("spark.sql.shuffle.partitions", str(width))
        scored = live._scored(blocks, source(spark, files), ["k"], ["ts"], "m double", lambda rows, start, own: iter(()))
        parts = scored.rdd.getNumPartitions()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert parts == min(width, 3 * max(8, spark.sparkContext.defaultParallelism))


def test_a_replay_releases_rows_once_the_end_is_read(spark, files, tmp_path):
    """A micro-batch for each file, and two for the end."""
    path, read = str(tmp_path), len(spark.read.schema(SCHEMA).parquet(files).inputFiles())
    found = live.replay(source(spark, files), "ts", lambda rows: sessions(rows, ["k"], "ts", LATE_TEXT, 5), path)
    assert found.agg(F.sum("rows")).first()[0] == N
    assert len([f for f in os.listdir(f"{path}/checkpoint/commits") if f.isdigit()]) == read + 2
