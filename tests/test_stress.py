import numpy as np
import pytest
from pyspark.sql import functions as F

from millrace.operators import profile, stress
from millrace.operators.detect import pca, window_model
from millrace.operators.windows import sliding_windows


@pytest.fixture(scope="module")
def frame(spark):
    rng = np.random.default_rng(2)
    rows = [(b, t, float(x), float(y)) for b in range(4) for t, (x, y) in enumerate(rng.random((60, 2)))]
    return spark.createDataFrame(rows, ["batch", "timestamp", "x", "y"]).cache()


def test_row_faults(spark):
    df = spark.createDataFrame([(1, 1.0, 2.0)], ["i", "x", "y"])
    trials = stress.inject_rows(stress.scenario_grid(df, stress.row_scenarios(["x", "y"], [0.5])), ["x", "y"])
    got = {r.type: (r.x, r.y) for r in trials.collect()}
    assert got == {"spike": (1.5, 2.0), "drift_end": (1.0, 2.5), "freeze": (1.0, 2.0), "none": (1.0, 2.0)}


def test_window_faults(spark):
    rows = [(1, t, float(t), float(-t)) for t in range(20)]
    df = spark.createDataFrame(rows, ["batch", "timestamp", "x", "y"])
    found = sliding_windows(df, ["batch"], ["timestamp"], ["x", "y"], 20)
    grid = stress.scenario_grid(found, [("spike", "x", 5.0), ("drift", "y", 2.0), ("freeze", "x", 0.0),
                                        ("none", "x", 0.0)])
    got = {r.type: np.array([(s.x, s.y) for s in r.injected])
           for r in stress.inject_windows(grid, ["x", "y"], 20).collect()}
    base = np.array([(x, y) for _, _, x, y in rows])
    spike, drift, freeze = base.copy(), base.copy(), base.copy()
    spike[10:15, 0] += 5.0
    drift[:, 1] += np.linspace(0, 2.0, 20)
    freeze[:, 0] = 0.0
    for name, want in (("spike", spike), ("drift", drift), ("freeze", freeze), ("none", base)):
        np.testing.assert_allclose(got[name], want)


def test_unknown_faults_are_rejected(frame):
    with pytest.raises(ValueError, match="melt"):
        stress.row_sensitivity(frame, ["x", "y"], ["batch", "timestamp"], {"m": (F.col("x"), 1.0)},
                               scenarios=[("melt", "x", 1.0)])
    with pytest.raises(ValueError, match="drift_end"):
        stress.window_sensitivity(frame, ["batch"], window_model.MeanModel(("x", "y"), 5),
                                  pca.Moments((), 0, np.zeros(2), np.eye(2)), 1.0, [("drift_end", "x", 1.0)])


def test_stream_faults(spark):
    df = spark.createDataFrame([(1, s, 1.0, 1.0) for s in range(60)] + [(2, 5, 1.0, 1.0)], ["k", "step", "x", "y"])
    plan = spark.createDataFrame([(1, "spike", 0, 2), (1, "drift", 1, 10), (1, "melt", 0, 30)],
                                 ["k", "type", "sensor", "start"])
    got = stress.inject_stream(df, plan, ["k"], "step", ["x", "y"]).orderBy("k", "step").collect()
    assert len(got) == 61 and got[60].fault is None
    assert [r.fault for r in got[:3]] == [None, None, "spike"] and got[2].x == 1.5
    assert got[12].fault == "drift" and got[12].y == pytest.approx(1.04) and got[12].x == 1.0
    assert got[50].fault == "drift" and got[51].fault is None
    frozen = stress.inject_stream(df, spark.createDataFrame([(2, "freeze", 1, 0)], plan.columns), ["k"], "step",
                                  ["x", "y"]).filter("k = 2").first()
    assert (frozen.x, frozen.y) == (1.0, 0.0)


def test_row_sensitivity(frame):
    model = pca.pca_fit(frame, ["x", "y"], 1)
    trials = stress.row_sensitivity(frame, ["x", "y"], ["batch", "timestamp"],
                                    {"pca": (model.error(), 0.5), "never": (F.lit(0.0), 1.0)}, n=50)
    rate = {(r.model, r.type, r.magnitude): r for r in profile.detection_rate(trials).collect()}
    assert len(rate) == 32 and all(r.trials == 50 for r in rate.values())
    assert all(r.detection_rate == 0 for (m, _, _), r in rate.items() if m == "never")
    total = rate["pca", "spike", 5.0].detection_rate + rate["pca", "drift_end", 5.0].detection_rate
    assert total >= 100 and rate["pca", "none", 0.0].detection_rate == 0


@pytest.mark.parametrize("limit", [10**6, 20])
def test_sampled_windows_are_true_windows(frame, limit):
    got = stress.sample_windows(frame, ["batch"], ["timestamp"], ["x", "y"], 8, 25, 3, rows_per_task=limit).collect()
    every = {(r.batch, r.window_id): r.steps for r in
             sliding_windows(frame, ["batch"], ["timestamp"], ["x", "y"], 8, 3).collect()}
    assert len(got) == 25 and all(every[r.batch, r.window_id] == r.steps for r in got)


def test_window_sensitivity_against_numpy(frame):
    model = window_model.window_model_fit(frame, ["batch"], ["timestamp"], ["x", "y"], 8, 2)
    errors = window_model.window_error(frame, ["batch"], ["timestamp"], model)
    latent = window_model.latent_moments(errors, 2)
    drawn = stress.sample_windows(frame, ["batch"], ["timestamp"], ["x", "y"], 8, 10).cache()
    trials = stress.window_sensitivity(drawn, ["batch"], model, latent, 0.4,
                                       stress.window_scenarios("x", "y", "x", [0.5, 3.0])).collect()
    base = {(r.batch, r.window_id): np.array([(s.x, s.y) for s in r.steps]) for r in drawn.collect()}
    assert len(trials) == 10 * 6
    for r in trials:
        before = base[r.batch, r.window_id]
        after = before.copy()
        if r.type == "spike":
            after[4:9, 0] += r.magnitude
        elif r.type == "drift":
            after[:, 1] += np.linspace(0, r.magnitude, 8)
        elif r.type == "freeze":
            after[:, 0] = after[0, 0]
        normal, faulty = (np.abs(w - model.reconstruct(w[None])[0]).mean() for w in (before, after))
        z = model.encode(after[None])[0] - latent.mean
        distance = np.sqrt(z @ latent.inverse @ z)
        np.testing.assert_allclose([r.mae_normal, r.mae_anomaly, r.maha_dist], [normal, faulty, distance])
        assert r.snr == pytest.approx(faulty / (normal + 1e-9))
        assert r.is_freeze == (r.type == "freeze")
        assert r.detected_maha == (distance ** 2 > 13.8155)
        assert r.detected == (r.is_freeze or faulty > 0.4 or r.detected_maha)
    summary = profile.stress_summary(drawn.sparkSession.createDataFrame(trials))
    assert {r.level for r in summary.collect()} == {"type", "type_magnitude"} and summary.count() == 6 + 4
