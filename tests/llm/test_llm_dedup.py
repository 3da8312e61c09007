"""Suffix dedup and near-duplicate groups against brute force."""

import hashlib
import random
from collections import Counter

import pytest

from millrace.llm import suffixes
from millrace.llm.minmax import _rare_prefixes, band_count, first_of_groups, near_duplicates
from millrace.llm.suffixes import difference_cover, remove_repeats

SCHEMA = "doc_id bigint, text string, node string, key int, removed int, block int"


def rows(texts):
    return [(i, t, "x", 1, 2, 3) for i, t in texts]


def repeats_by_force(texts, span):
    data = [(t or "").encode() for t in texts]
    seen = Counter(t[i:i + span] for t in data for i in range(len(t) - span + 1))
    out = []
    for t in data:
        gone = [False] * (len(t) + 1)
        for i in range(len(t) - span + 1):
            if seen[t[i:i + span]] > 1:
                gone[i:i + span] = [True] * span
        runs = sum(g and not (i and gone[i - 1]) for i, g in enumerate(gone))
        kept = bytes(c for c, g in zip(t, gone) if not g)
        out.append((len(t), sum(gone), runs, hashlib.sha256(kept).hexdigest()))
    return out


def prose(random_, words):
    return " ".join(random_.choice(["ab", "cé", "d", "efgh", "i"]) + str(random_.randint(0, 40)) for _ in range(words))


@pytest.mark.parametrize("part", [97, 1 << 19])
def test_repeats_equal_brute_force(spark, monkeypatch, part):
    monkeypatch.setattr(suffixes, "PART", part)
    suffixes._powers.cache_clear()
    r = random.Random(part)
    passage = prose(r, 120)
    texts = [passage[a:a + r.randint(0, 300)] + prose(r, r.randint(0, 20)) + passage[b:b + r.randint(0, 90)]
             for a, b in [(r.randint(0, 200), r.randint(0, 200)) for _ in range(40)]]
    texts += [None, "", "short", "x" * 500, "é" * 150, texts[0], texts[0], passage]
    df = spark.createDataFrame(rows(enumerate(texts)) + [(None, texts[1], "x", 1, 2, 3), (3, None, "x", 1, 2, 3)], SCHEMA)
    got = sorted(tuple(x)[1:] for x in remove_repeats(df, span=40).drop("removed").collect())
    assert got == sorted(repeats_by_force([*texts, texts[1], None], 40))
    suffixes._powers.cache_clear()


def test_repeats_of_an_empty_table(spark):
    assert remove_repeats(spark.createDataFrame([], SCHEMA)).collect() == []


@pytest.mark.parametrize("q", [2, 3, 5, 11])
def test_cover_has_every_difference(q):
    cover, v = difference_cover(q), q * q + q + 1
    assert len(cover) == q + 1
    assert {(a - b) % v for a in cover for b in cover} == set(range(v))


def shingles(text):
    words = (text or "").encode().lower().split()
    return {tuple(words[i:i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def groups_by_force(docs, percent):
    sets = [shingles(t) for _, t in docs]
    home = list(range(len(docs)))

    def find(i):
        while home[i] != i:
            i = home[i]
        return i

    for i in range(len(docs)):
        for j in range(i):
            if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j]):
                home[find(i)] = find(j)
    out = []
    for i, (doc_id, _) in enumerate(docs):
        ids = [docs[j][0] for j in range(len(docs)) if find(j) == find(i) and docs[j][0] is not None] if sets[i] else [doc_id]
        least = min(ids, default=None)
        out.append((doc_id, len(sets[i]), least, doc_id == least))
    return out


def near_copies(seed):
    """Chains of edits, exact copies, small sets at the threshold, and lone texts."""
    r = random.Random(seed)
    texts = []
    for _ in range(6):
        words = prose(r, r.choice([4, 11, 60, 200])).split()
        for _ in range(r.randint(1, 12)):
            texts.append(" ".join(words))
            for _ in range(r.randint(0, max(1, len(words) // 40))):
                words[r.randrange(len(words))] = f"w{r.randint(0, 999)}"
    return texts + [prose(r, 30) for _ in range(5)]


@pytest.mark.parametrize("seed,percent", [(1, 85), (2, 80), (3, 60)])
def test_groups_equal_brute_force(spark, seed, percent):
    texts = near_copies(seed)
    docs = [*enumerate(texts), (900, None), (901, ""), (902, " \n\t"), (903, texts[0].upper()), (None, texts[1]),
            (None, ""), (5, texts[5]), (904, "one two three"), (905, "One  two\x0bthree"), (906, "one two")]
    df = spark.createDataFrame(rows(docs), SCHEMA)
    got = sorted((tuple(x) for x in near_duplicates(df, percent).collect()), key=repr)
    assert got == sorted(groups_by_force(docs, percent), key=repr)
    stay = first_of_groups(df, percent)
    assert stay.columns == df.columns
    kept = [(x["doc_id"], x["text"]) for x in stay.collect()]
    expected = groups_by_force(docs, percent)
    assert sorted(i for i, t in kept if shingles(t)) == sorted({e[2] for e, d in zip(expected, docs) if shingles(d[1])})
    assert sorted((repr(k) for k in kept if not shingles(k[1]))) == sorted(repr(d) for d in docs if not shingles(d[1]))


@pytest.mark.parametrize("percent", [80, 85])
def test_a_family_with_shared_edits_equals_brute_force(spark, percent):
    """Every edit is made in many copies of one text, and a passage stands in many others."""
    r = random.Random(percent)
    base = prose(r, 90).split()
    texts = []
    for _ in range(120):
        words = list(base)
        for at in r.sample(range(90), r.randint(0, 4)):
            words[at] = f"edit{at % 30}"
        texts.append(" ".join(words))
    texts += [prose(r, r.randint(2, 25)) + " " + " ".join(base[:60]) + " " + prose(r, r.randint(0, 12)) for _ in range(60)]
    docs = list(enumerate(texts))
    got = sorted(tuple(x) for x in near_duplicates(spark.createDataFrame(rows(docs), SCHEMA), percent).collect())
    assert got == sorted(groups_by_force(docs, percent))


@pytest.mark.parametrize("seed", [1, 2])
def test_rare_prefixes_lose_no_pair(spark, seed):
    r = random.Random(seed)
    least = 6
    sets = {i: set(r.sample(range(40), r.randint(3, 14))) | set(r.sample(range(100, 108), r.randint(0, 8)))
            | ({500, 501, 502} if i % 2 else set()) for i in range(60)}
    sets |= {60: sets[3] | {900}, 61: sets[4], 62: set(range(1000, 1010))}
    table = [(bytes([i]), b"c", s, len(v), len(v) - least + 1) for i, v in sets.items() if len(v) >= least for s in sorted(v)]
    out = _rare_prefixes(spark.createDataFrame(table, "node binary, centre binary, shingle bigint, size int, upto int")).collect()
    entries, behind = {}, {}
    for x in out:
        entries.setdefault(x["node"][0], {})[x["list"]] = x["weight"]
        behind[x["node"][0]] = x["behind"]
    assert 62 not in entries
    met = pruned = 0
    for i in sets:
        for j in range(i):
            mine, other = entries.get(i, {}), entries.get(j, {})
            both = sum(w for key, w in mine.items() if key in other)
            if len(sets[i] & sets[j]) >= least:
                assert both and both + max(behind[i], behind[j]) >= len(sets[i] & sets[j])
                met += 1
            pruned += not both
    assert met and pruned


def test_groups_of_an_empty_table(spark):
    assert near_duplicates(spark.createDataFrame([], SCHEMA)).collect() == []
    assert first_of_groups(spark.createDataFrame([], SCHEMA)).collect() == []


def test_bands_overlook_one_pair_in_a_million():
    for percent in (80, 85):
        assert (1 - (percent / 100) ** 5) ** band_count(percent) <= 1e-6
