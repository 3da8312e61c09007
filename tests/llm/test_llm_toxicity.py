"""The chain: held-out accuracy, out-of-fold use, odd rows."""

import random

import numpy as np

from millrace.llm.toxicity import best_threshold, fit_chain, fit_logistic, rate, toxicity_categories

SCHEMA = "doc_id bigint, text string, ratings int, row int, words int, fold int"
BAD = ["vile", "nasty", "foul"]


def corpus(seed, n):
    r = random.Random(seed)
    docs, labels = [], []
    for i in range(n):
        words = [f"w{r.randint(0, 400)}" for _ in range(r.choice([3, 30, 200]))]
        toxic, junk = r.random() < 0.2, r.random() < 0.3
        if toxic:
            words.insert(r.randrange(len(words)), r.choice(BAD) + r.choice(["", ",", "!"]))
        if junk:
            words += ["click", "here"]
        docs.append((i, " ".join(words)))
        labels.append((i, int(not junk), int(toxic)))
    return docs, labels


def test_held_out_accuracy_and_odd_rows(spark):
    docs, labels = corpus(1, 900)
    odd = [(None, "vile"), (5000, None), (5001, ""), (5002, " ... "), (5003, docs[0][1]), (0, docs[0][1]), (5004, "w1 " * 50_000 + "NASTY")]
    df = spark.createDataFrame([(i, t, 1, 2, 3, 4) for i, t in docs + odd], SCHEMA)
    marks = spark.createDataFrame(labels[:600] + [(None, 1, 1), (1, None, None), (7000, 0, 1)], "doc_id bigint, quality int, toxic int")
    chain = fit_chain(df, marks, toxicity_categories())
    rated = rate(df, chain)
    assert [c for c in rated.columns] == ["doc_id", "text", "row", "words", "fold", "ratings"]
    rows = rated.collect()
    assert len(rows) == len(docs) + len(odd)
    by_id = {x["doc_id"]: x["ratings"] for x in rows}
    for column, k in (("is_toxic", 2), ("is_low_quality", None)):
        hits = [by_id[x[0]][column] == (bool(x[2]) if k else not x[1]) for x in labels[600:]]
        assert np.mean(hits) > 0.97
    assert by_id[None]["is_toxic"] and by_id[5004]["is_toxic"]
    assert not any(by_id[i][c] for i in (5000, 5001, 5002) for c in ("is_toxic", "is_low_quality"))
    assert by_id[5003] == by_id[0]


def test_without_labels_nothing_is_toxic(spark):
    df = spark.createDataFrame([(1, "vile", 1, 2, 3, 4)], SCHEMA)
    for marks in ([], [(1, 1, 0)], [(9, 0, 1)]):
        labels = spark.createDataFrame(marks, "doc_id bigint, quality int, toxic int")
        assert not rate(df, fit_chain(df, labels, toxicity_categories())).first()["ratings"]["is_toxic"]


def test_empty_table(spark):
    df = spark.createDataFrame([], SCHEMA)
    labels = spark.createDataFrame([], "doc_id bigint, quality int, toxic int")
    assert rate(df, fit_chain(df, labels, toxicity_categories())).collect() == []


def test_earlier_probabilities_are_used():
    r = np.random.default_rng(1)
    p = r.random((500, 1))
    w, v, b = fit_logistic(np.empty(0, int), np.empty(0, int), 0, p, (p[:, 0] > 0.5).astype(float))
    assert len(w) == 0 and v[0] > 3 and b < 0


def test_threshold():
    assert best_threshold(np.array([0.9, 0.8, 0.3, 0.1]), np.array([1.0, 1, 0, 0])) == (0.8 + 0.3) / 2
    assert best_threshold(np.array([0.9, 0.1]), np.array([0.0, 0])) > 1
    assert best_threshold(np.array([0.5, 0.5]), np.array([1.0, 0])) <= 0.5
