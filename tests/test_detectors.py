import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from millrace.operators import scaling
from millrace.operators.detect import consensus, iforest, pca, window_model
from millrace.operators.profile import leakage_check
from millrace.plans.models import load_detector, save_detector, score_table, train_detectors
from millrace.session import scratch_path

COLUMNS = ["a", "b", "c"]


@pytest.fixture(scope="module")
def rows():
    rng = np.random.default_rng(5)
    base = rng.normal(size=(600, 2))
    x = np.column_stack([base[:, 0], base[:, 0] * 0.8 + 0.1 * base[:, 1], base[:, 1] * 0.3])
    x += rng.normal(scale=0.05, size=x.shape)
    pdf = pd.DataFrame(x, columns=COLUMNS)
    pdf["batch"], pdf["timestamp"] = np.repeat([1, 2, 3], 200), np.tile(np.arange(200), 3)
    return pdf


@pytest.fixture(scope="module")
def frame(spark, rows):
    return spark.createDataFrame(rows).repartition(5).cache()


def test_scalers(spark):
    df = spark.createDataFrame([(0.0, 5.0, 1.0), (10.0, 5.0, float("nan")), (5.0, 5.0, 3.0)], COLUMNS)
    scaled = scaling.minmax_fit(df, COLUMNS).apply(df).orderBy("a").toPandas()
    assert list(scaled.a) == [0.0, 0.5, 1.0] and list(scaled.b) == [0.0, 0.0, 0.0]
    assert list(scaled.c)[:2] == [0.0, 1.0] and np.isnan(scaled.c[2])
    standard = scaling.standard_fit(df, ["a", "b"]).apply(df).orderBy("a").toPandas()
    assert list(standard.a) == [-1.0, 0.0, 1.0] and list(standard.b) == [0.0] * 3
    labelled = scaled.assign(split="train").drop(columns="c")
    assert leakage_check(spark.createDataFrame(labelled), ["a", "b"]).first().max_value == 1.0


def test_vector_scaler(frame):
    from millrace.operators.features import assemble_vectors
    vectors = assemble_vectors(frame, COLUMNS)
    scaled = scaling.standard_fit_vectors(vectors).transform(vectors)
    assert "features_scaled" in scaled.columns


def test_pca_against_numpy(frame, rows):
    model = pca.pca_fit(frame, COLUMNS, 2)
    x = rows[COLUMNS].to_numpy()
    centred = x - x.mean(axis=0)
    _, s, vt = np.linalg.svd(centred, full_matrices=False)
    np.testing.assert_allclose(model.explained_ratio, (s ** 2 / (s ** 2).sum())[:2], rtol=1e-9)
    want = ((centred - centred @ vt[:2].T @ vt[:2]) ** 2).mean(axis=1)
    got = frame.select("batch", "timestamp", model.error().alias("e")).toPandas()
    got = got.sort_values(["batch", "timestamp"]).e.to_numpy()
    np.testing.assert_allclose(got, want, atol=1e-12)
    np.testing.assert_allclose(model.error_of(x), want, atol=1e-12)
    full = pca.pca_fit(frame, COLUMNS, 3)
    assert frame.agg(F.max(full.error())).first()[0] < 1e-20


def test_mahalanobis_against_numpy(frame, rows):
    moments = pca.fit_moments(frame, COLUMNS)
    x = rows[COLUMNS].to_numpy()
    np.testing.assert_allclose(moments.cov, np.cov(x.T), rtol=1e-9)
    delta = x - x.mean(axis=0)
    want = np.sqrt(np.einsum("ij,jk,ik->i", delta, np.linalg.inv(np.cov(x.T)), delta))
    got = frame.select("batch", "timestamp", pca.mahalanobis(moments).alias("d"),
                       pca.mahalanobis_alert(pca.mahalanobis(moments), 3).alias("x"),
                       pca.mahalanobis_alert(pca.mahalanobis(moments), 3, True).alias("y")
                       ).toPandas().sort_values(["batch", "timestamp"])
    np.testing.assert_allclose(got.d, want, rtol=1e-7)
    assert list(got.x) == list(want ** 2 > 16.2662) and list(got.y) == list(want > 16.2662)


def test_forest_structure_and_share(frame):
    nodes = iforest.iforest_nodes(frame, COLUMNS, ["batch", "timestamp"], 20, 64).toPandas()
    assert nodes.tree.nunique() == 20 and nodes.depth.max() <= 6
    for _, tree in nodes.groupby("tree"):
        inner = set(tree[tree.feature >= 0].node)
        assert set(tree.node) == {0} | {2 * n + s for n in inner for s in (1, 2)}
        by_node = tree.set_index("node")["size"]
        assert all(by_node[n] == by_node[2 * n + 1] + by_node[2 * n + 2] for n in inner)
        assert by_node[0] == 64
    forest = iforest.iforest_fit(frame, COLUMNS, ["batch", "timestamp"], 50)
    flagged = frame.filter(forest.score() > 0).count()
    assert abs(flagged - 30) <= 3


def slow_score(nodes, forest, x):
    """Walk every tree from its node table, one row at a time."""
    out = []
    for row in x:
        lengths = []
        for _, tree in nodes.groupby("tree"):
            table, node = tree.set_index("node"), 0
            while table.feature[node] >= 0:
                node = 2 * node + (2 if row[table.feature[node]] > table.threshold[node] else 1)
            lengths.append(table.depth[node] + iforest.path_length(np.array([table["size"][node]]))[0])
        out.append(-2 ** (-np.mean(lengths) / iforest.path_length(np.array([forest.sample_size]))[0]))
    return np.array(out)


def test_forest_score_against_a_walk(frame, rows):
    nodes = iforest.iforest_nodes(frame, COLUMNS, ["batch", "timestamp"], 5, 32).toPandas()
    forest = iforest.forest_from_nodes(nodes, COLUMNS)
    x = rows[COLUMNS].to_numpy()[:40]
    np.testing.assert_allclose(forest.score_samples(x), slow_score(nodes, forest, x))


def test_forest_flags_the_far_point(spark, frame):
    forest = iforest.iforest_fit(frame, COLUMNS, ["batch", "timestamp"])
    far = spark.createDataFrame([(9.0, -9.0, 9.0), (0.0, 0.0, 0.0), (None, 0.0, 0.0)], "a double, b double, c double")
    scores = [r[0] for r in far.select(forest.score()).collect()]
    assert scores[0] > 0 > scores[1] and scores[2] is None


def test_path_length():
    np.testing.assert_allclose(iforest.path_length(np.array([1, 2, 256])), [0.0, 1.0, 10.2447709], rtol=1e-7)


def flat_windows(rows, size, stride=1):
    out = []
    for b, g in rows.groupby("batch"):
        x = g.sort_values("timestamp")[COLUMNS].to_numpy()
        out += [((b, s), x[s:s + size]) for s in range(0, len(x) - size + 1, stride)]
    return out


@pytest.mark.parametrize("limit", [10**6, 50])
def test_window_model_against_numpy(frame, rows, limit):
    model = window_model.window_model_fit(frame, ["batch"], ["timestamp"], COLUMNS, 12, 3, rows_per_task=limit)
    keys, windows = zip(*flat_windows(rows, 12))
    flat = np.array([w.ravel() for w in windows])
    centred = flat - flat.mean(axis=0)
    _, s, vt = np.linalg.svd(centred, full_matrices=False)
    np.testing.assert_allclose(model.mean, flat.mean(axis=0), atol=1e-12)
    np.testing.assert_allclose(model.variance[:3], (s ** 2)[:3] / (len(flat) - 1), rtol=1e-8)
    residual = (centred - centred @ vt[:3].T @ vt[:3]).reshape(-1, 12, 3)
    got = window_model.window_error(frame, ["batch"], ["timestamp"], model, rows_per_task=limit).toPandas()
    got = got.set_index(["batch", "window_id"]).loc[list(keys)]
    np.testing.assert_allclose(got.mse, (residual ** 2).mean(axis=(1, 2)), rtol=1e-7)
    np.testing.assert_allclose(got.mae, np.abs(residual).mean(axis=(1, 2)), rtol=1e-7)
    np.testing.assert_allclose(np.stack(got.attribution), (residual ** 2).mean(axis=1), rtol=1e-7)
    np.testing.assert_allclose(np.abs(np.stack(got.latent)), np.abs(centred @ vt[:3].T), atol=1e-6)


def test_attribution_order(spark):
    errors = spark.createDataFrame([(1, [3.0, 1.0, 2.0])], "i int, attribution array<double>")
    ranked = window_model.rank_attribution(errors, ["i"], COLUMNS).orderBy("rank").collect()
    assert [(r.sensor, r.error) for r in ranked] == [("b", 1.0), ("c", 2.0), ("a", 3.0)]


def test_triple_detector_on_the_last_row(frame, rows):
    detector = train_detectors(frame, ["batch"], ["timestamp"], COLUMNS, 12, trees=20, components=2)
    got = consensus.detect(frame, ["batch"], ["timestamp"], detector).toPandas()
    want = flat_windows(rows, 12)
    got = got.set_index(["batch", "window_id"]).loc[[k for k, _ in want]]
    last = np.array([w[-1] for _, w in want])
    np.testing.assert_allclose(got.pca_score, detector.pca.error_of(last), atol=1e-12)
    np.testing.assert_allclose(got.iso_score, detector.forest.anomaly(last))
    assert list(got.window_alert) == list(got.window_error > detector.thresholds["window"])
    assert 0 < got.window_alert.sum() <= 2


def test_missing_models_never_alert(frame):
    detector = consensus.TripleDetector(tuple(COLUMNS), 12)
    got = consensus.detect(frame, ["batch"], ["timestamp"], detector)
    row = got.agg(F.sum("window_error"), F.sum("iso_score"), F.count_if("pca_alert")).first()
    assert tuple(row) == (0.0, 0.0, 0)


def test_saved_models_score_the_same(spark, frame):
    detector = train_detectors(frame, ["batch"], ["timestamp"], COLUMNS, 12, trees=10, components=1)
    path = scratch_path(spark, "models")
    save_detector(spark, path, detector)
    loaded = load_detector(spark, path, COLUMNS)
    keys = ["batch", "window_id"]
    a = score_table(frame, ["batch"], ["timestamp"], detector).toPandas().sort_values(keys)
    b = score_table(frame, ["batch"], ["timestamp"], loaded).toPandas().sort_values(keys)
    for c in ("window_error", "pca_score", "iso_score", "health"):
        np.testing.assert_allclose(a[c], b[c], rtol=1e-12)
    assert list(a.status) == list(b.status)


def test_threshold_falls_back(spark):
    empty = spark.createDataFrame([], "e double")
    assert consensus.percentile_threshold(empty, "e") == 0.15


def test_status(spark):
    df = spark.createDataFrame([(None, None, None, None), (0.05, True, False, True), (0.2, False, True, False)],
                               "window_error double, window_alert boolean, pca_alert boolean, iso_alert boolean")
    got = consensus.status_kpi(df).collect()
    assert [r.status for r in got] == ["READY", "ANOMALY", "HEALTHY"]
    assert [r.health for r in got][1:] == [50.0, 0.0]
    assert (got[1].window_severity, got[1].pca_severity, got[1].iso_severity) == ("alert", "ok", "warning")
