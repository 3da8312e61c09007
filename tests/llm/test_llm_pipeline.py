"""The pipeline's stages on a small corpus, each judged on its own input."""

import random
import re
from collections import Counter

import corpus_pipeline as p
import pytest

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    r = random.Random(8)
    docs, labels = [], []
    for i in range(400):
        words = [f"w{r.randint(0, 3000)}" for _ in range(r.choice([8, 60, 400]))]
        toxic = i % 9 == 0
        if toxic:
            words.insert(r.randrange(len(words)), "horrid")
        if i % 11 == 1:
            words.insert(0, f"password=abcd{i}efgh")
        docs.append([i, " ".join(words), r.choice(["en", "de"]), f"src{i % 5}", 0])
        labels.append((i, 1, int(toxic)))
    docs += [[1000 + i, docs[i][1], "en", "src1", 0] for i in range(0, 100, 10)]
    docs += [[2000, None, None, None, None], [2001, "", "en", "src1", 0], [None, "alone " * 3, "en", "src9", 1]]
    path = str(tmp_path_factory.mktemp("corpus"))
    spark.createDataFrame([tuple(d) for d in docs], SCHEMA).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    return path


def test_stages(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    columns = docs.columns
    assert [n for n, _ in p.STAGES] == ["toxicity", "near_dedup", "secrets", "source_mix", "packing"]
    clean = p.toxicity(spark, docs, folder).cache()
    assert clean.columns == columns
    texts = [x["text"] or "" for x in clean.collect()]
    assert not any("horrid" in t for t in texts)
    assert len(texts) == sum("horrid" not in (x["text"] or "") for x in docs.collect())
    single = p.near_dedup(spark, clean, folder).cache()
    kept = Counter(x["text"] for x in single.collect())
    assert single.columns == columns and set(kept) == {x["text"] for x in clean.collect()}
    assert all(n == 1 for n in kept.values())
    masked = p.secrets(spark, single, folder).cache()
    assert masked.columns == columns and masked.count() == single.count()
    before = {x["doc_id"]: x for x in single.collect()}
    for x in masked.collect():
        if x["text"] is not None:
            assert x["text"] == re.sub(r"password=\S+", "[secret]", before[x["doc_id"]]["text"])
    mixed = p.source_mix(spark, masked, folder)
    assert mixed.columns == columns
    ids = [x["doc_id"] for x in mixed.collect()]
    assert len(ids) == len(set(ids)) and set(ids) <= {x["doc_id"] for x in masked.collect()}
    packed = p.packing(spark, mixed, folder).collect()
    assert {x["doc_id"] for x in packed} == set(ids)


def test_run(spark, folder):
    rows = p.run(spark, folder).collect()
    fill = Counter()
    for x in rows:
        fill[x["sequence_id"]] += x["length"]
    assert rows and max(fill.values()) <= p.CAPACITY


def test_a_long_document_leaves_no_source_short(spark):
    docs = [(i, "w " * (500 if i % 10 == 0 else 5), "en", f"src{i % 2}", 0) for i in range(60)]
    tokens = sum(len(d[1].split()) for d in docs)
    mixed = p.source_mix(spark, spark.createDataFrame(docs, SCHEMA), "")
    assert sum(len(x["text"].split()) for x in mixed.collect()) >= tokens * p.PERCENT // 100
