"""Collision counting: recall and exact scores."""

import numpy as np
import pytest

from millrace.llm import collision
from millrace.llm.collision import nearest

SCHEMA = "vec_id bigint, embedding array<float>, label int, block int, v int, rank int"


def table(spark, rows):
    return spark.createDataFrame([(i, v, 1, 2, 3, 4) for i, v in rows], SCHEMA)


def by_force(rows, every, k):
    good = [(i, np.array(v, np.float32).astype(float)) for i, v in rows
            if i is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v)]
    out = {}
    for q, x in good:
        if q % every == 0:
            scores = sorted((-float(x @ y), i) for i, y in good if i != q and len(y) == len(x))[:k]
            out[q] = [(i, -s) for s, i in scores]
    return out


def found(df):
    out = {}
    for x in sorted(df.collect(), key=lambda x: (x["query_id"], x["rank"])):
        out.setdefault(x["query_id"], []).append((x["vec_id"], x["score"]))
        assert x["rank"] == len(out[x["query_id"]])
    return out


@pytest.mark.parametrize("unit", [True, False])
def test_recall(spark, monkeypatch, unit):
    monkeypatch.setattr(collision, "BLOCK", 700)
    monkeypatch.setattr(collision, "LEAST", 100)
    r = np.random.default_rng(1)
    x = r.standard_normal((2500, 24)) + 0.6 * r.standard_normal((8, 24))[r.integers(0, 8, 2500)]
    x = x / np.linalg.norm(x, axis=1, keepdims=True) if unit else x * r.random((2500, 1)) * 30
    rows = [(int(i), v.astype(np.float32).tolist()) for i, v in zip(r.permutation(10_000)[:2500], x)]
    got, true = found(nearest(table(spark, rows), 20, 20)), by_force(rows, 20, 20)
    assert got.keys() == true.keys()
    recall = np.mean([len({i for i, _ in got[q]} & {i for i, _ in true[q]}) / 20 for q in true])
    assert recall >= 0.9
    vectors = {i: np.array(v, np.float32).astype(float) for i, v in rows}
    for q, hits in got.items():
        assert hits == sorted(hits, key=lambda h: (-h[1], h[0])) and q not in dict(hits)
        for i, score in hits:
            assert score == pytest.approx(float(vectors[q] @ vectors[i]), abs=1e-9)


def test_few_and_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0]), (1, [2.0, 0.0]), (2, [2.0, 0.0]), (3, [-1.0, 5.0]), (4, None), (5, []), (6, [0.0, 0.0]), (7, [nan, 1.0]),
            (8, [inf, 1.0]), (9, [None, 1.0]), (None, [9.0, 9.0]), (20, [0.0, 0.0]), (40, [1.0, 2.0, 3.0]), (60, [3.0, 1.0]), (1, [2.0, 0.0])]
    got = found(nearest(table(spark, rows), 20, 20))
    assert got == {q: hits for q, hits in by_force(rows, 20, 20).items() if hits}
    assert got[0] == [(60, 3.0), (1, 2.0), (1, 2.0), (2, 2.0), (3, -1.0)] and 40 not in got


def test_empty_table(spark):
    assert nearest(table(spark, [])).collect() == []


@pytest.mark.parametrize("folder, least", [("sf0.001", 1.0), ("sf0.01", 1.0), ("sf0.1", 0.95)])
def test_recall_on_given_tables(spark, folder, least):
    """A table of few vectors is searched whole."""
    rows = spark.read.parquet(f"/root/testdata/{folder}/embeddings.parquet")
    got = found(nearest(rows, 20, 20))
    true = by_force([(x["vec_id"], list(x["embedding"])) for x in rows.collect()], 20, 20)
    assert got.keys() == true.keys()
    assert np.mean([len({i for i, _ in got[q]} & {i for i, _ in true[q]}) / 20 for q in true]) >= least
