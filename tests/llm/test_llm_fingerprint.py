"""Fingerprints: stability, likeness, order of documents, plans without Python."""

import hashlib
import random

import pytest
from pyspark.sql import functions as F

from millrace.llm.fingerprint import BIN_BITS, fingerprint_edits, likeness, with_fingerprint, with_next

SCHEMA = "doc_id bigint, text string, fingerprint int, next int, _to int, _bins int"


def prose(r, n):
    return " ".join(f"w{r.randint(0, 5000)}" for _ in range(n))


def table(spark, docs):
    return spark.createDataFrame([(i, t, 1, 2, 3, 4) for i, t in docs], SCHEMA)


def ordered(docs):
    """Descending ids, nulls last; equal ids by their text, descending."""
    return sorted(docs, key=lambda d: (d[0] is not None, d[0] or 0, (d[1] or "").encode()), reverse=True)


def edits_by_force(docs):
    rows = ordered(docs)
    out = []
    for (doc_id, text), (_, after) in zip(rows, rows[1:] + rows[:1]):
        text, after = text or "", after or ""
        half = len(text) // 2
        out.append((doc_id, len(text), hashlib.sha256((text[:len(text) - half] + after[:half]).encode()).hexdigest()))
    return out


@pytest.mark.parametrize("seed,n", [(1, 1), (2, 2), (3, 150)])
def test_edits_equal_brute_force(spark, seed, n):
    r = random.Random(seed)
    docs = [(r.choice([i * 7, i * 10**12]) if i else 5, prose(r, r.choice([0, 1, 4, 30, 300])) + r.choice(["", "é😀"]))
            for i in range(n)]
    if n > 2:
        docs += [(None, "a b c"), (None, None), (7001, None), (7002, ""), (docs[9][0], docs[9][1]), (docs[3][0], "other text")]
    got = fingerprint_edits(table(spark, docs)).collect()
    assert sorted((tuple(x)[:3] for x in got), key=repr) == sorted(edits_by_force(docs), key=repr)
    for x in got:
        assert 0 <= x["near_edited"] <= 1 and 0 <= x["near_next"] <= 1
        assert x["fingerprint"] == "" or len(x["fingerprint"]) == 2 ** BIN_BITS


def test_empty_table(spark):
    assert fingerprint_edits(table(spark, [])).collect() == []


def test_next_over_many_ranges(spark):
    ids = list(range(0, 3000, 3))
    df = spark.createDataFrame([(i, f"t{i}") for i in ids], "doc_id bigint, text string")
    for buckets in (1, 2, 7, 64):
        got = {x["doc_id"]: x["next"]["text"] for x in with_next(df, "doc_id", "text", ["text"], buckets).collect()}
        assert got == {i: f"t{i - 3 if i else 2997}" for i in ids}


def test_likeness_follows_jaccard(spark):
    r = random.Random(4)
    pairs = []
    for share in (0.0, 0.3, 0.6, 0.9, 1.0):
        for _ in range(30):
            words = prose(r, 600).split()
            cut = int(len(words) * share)
            pairs.append((share, " ".join(words), " ".join(words[:cut] + prose(r, len(words) - cut).split())))
    df = spark.createDataFrame(pairs, "share double, a string, b string")
    df = with_fingerprint(with_fingerprint(df, "a", "x"), "b", "y").select("share", likeness(F.col("x"), F.col("y")).alias("p"))
    for row in df.groupBy("share").agg(F.avg("p").alias("p"), F.max("p").alias("most")).collect():
        jaccard = row["share"] / (2 - row["share"])
        assert abs(row["p"] - jaccard) < 0.03


def test_short_texts_differ(spark):
    texts = ["one two", "one three", "One  two", "a b c d e f", "a b c d e g", "", None, "  "]
    df = with_fingerprint(spark.createDataFrame(list(enumerate(texts)), "i int, text string"), "text", "f")
    f = {x["i"]: x["f"] for x in df.collect()}
    assert f[0] == f[2] != f[1] and f[3] != f[4] and f[5] == f[6] == f[7] == ""


def test_unrelated_short_texts_are_unlike(spark):
    texts = [f"only{i} three words{i}" for i in range(120)] + [f"a{i} b c d e f{i}" for i in range(120)]
    rows = with_fingerprint(spark.createDataFrame(list(enumerate(texts)), "i int, text string"), "text", "f")
    f = {x["i"]: x["f"] for x in rows.collect()}
    same = [sum(a == b for a, b in zip(f[i], f[j])) / 2 ** BIN_BITS for i in f for j in f if i < j]
    assert max(same) < 0.25 and abs(sum(same) / len(same) - 1 / 16) < 0.01


def test_no_python_in_the_plan(spark):
    plan = fingerprint_edits(table(spark, [(1, "x"), (2, "y")]))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
