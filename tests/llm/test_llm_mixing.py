"""Budgets flow down a tree; leaves give whole epochs and a prefix of one more."""

import hashlib
import random
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from millrace.llm.mixing import leaf_budgets, mix

SCHEMA = "doc_id bigint, text string, lang string, source string, share int, leaf int, epoch int, domain string"
WEIGHTS = {"domain": {"a": 3, "b": 1, "never": 0}, "lang": {"en": 2}}


def fill(budget, children):
    """``children``: (name, room, weight) -> share, by filling up who has least room for its weight."""
    share, left, open_ = {}, budget, [c for c in children if c[2] > 0]
    share = {c[0]: 0 for c in children}
    while open_:
        total = sum(c[2] for c in open_)
        full = [c for c in open_ if c[1] * total <= c[2] * left]
        if not full:
            for name, _, w in open_:
                share[name] = w * left // total
            break
        for name, room, _ in full:
            share[name] = room
        left -= sum(c[1] for c in full)
        open_ = [c for c in open_ if c not in full]
    return share


def budgets_by_force(rooms, weights, budget):
    levels = ("domain", "lang", "source")
    weigh = lambda path: weights.get(levels[len(path) - 1], {}).get(path[-1], 1)
    usable = {leaf: room if all(weigh(leaf[:d]) for d in (1, 2, 3)) else 0 for leaf, room in rooms.items()}
    shares = {(): min(budget, sum(usable.values()))}
    for depth in (1, 2, 3):
        families = defaultdict(Counter)
        for leaf, room in usable.items():
            families[leaf[:depth - 1]][leaf[:depth]] += room
        shares = {path: s for up, kids in families.items()
                  for path, s in fill(shares[up], [(p, r, weigh(p)) for p, r in kids.items()]).items()}
    return shares


@pytest.mark.parametrize("seed", range(4))
def test_budgets_equal_brute_force(spark, seed):
    r = random.Random(seed)
    rooms = {(d, l, f"s{s}"): r.choice([0, 5, 100, 10_000, 10**13]) for d in ("a", "b", "c", None, "never")
             for l in ("en", "de", None) for s in range(r.randint(1, 5))}
    budget = r.choice([0, 7, sum(rooms.values()) // 3, 10 * sum(rooms.values())])
    df = spark.createDataFrame([(*k, v) for k, v in rooms.items()], "domain string, lang string, source string, room bigint")
    got = {tuple(x)[:3]: x["share"] for x in leaf_budgets(df, WEIGHTS, F.lit(budget).cast("bigint")).collect()}
    assert got == budgets_by_force(rooms, WEIGHTS, budget)


def domain_of(source):
    return "never" if source == "never" else (source or "?")[0]


def drawn_by_force(docs, percent, epochs, seed):
    tokens = lambda t: len((t or "").encode().split())
    leaves = defaultdict(list)
    for doc_id, text, lang, source in docs:
        leaves[domain_of(source), lang, source].append((doc_id, text))
    sums = {k: sum(tokens(t) for _, t in v) for k, v in leaves.items()}
    shares = budgets_by_force({k: v * epochs for k, v in sums.items()}, WEIGHTS, sum(sums.values()) * percent // 100)
    md5 = lambda s: hashlib.md5(s.encode()).hexdigest()
    plans, size, left = {}, {}, {}
    for leaf, own in leaves.items():
        whole, rest = divmod(shares[leaf], sums[leaf]) if sums[leaf] else (0, 0)
        upto, order = 0, []
        for doc_id, text in sorted(own, key=lambda d: md5(f"{seed}:{whole}:{'' if d[0] is None else d[0]}:{md5(d[1] or '')}")):
            upto += tokens(text)
            order.append((doc_id, text, upto))
        plans[leaf] = (whole, rest, order)
        if rest:
            used = max([u for *_, u in order if u <= rest], default=0)
            size[leaf], left[leaf] = min(u for *_, u in order if u > rest) - used, rest - used
    # Unused tokens pay for next documents, the shortest first: siblings, the domain, all.
    given = set()
    for depth in (2, 1, 0):
        for family in {leaf[:depth] for leaf in size}:
            own = [leaf for leaf in size if leaf[:depth] == family]
            pool = sum(left[leaf] for leaf in own)
            for leaf in sorted(set(own) - given, key=lambda k: (size[k], *[(x is not None, x or "") for x in k])):
                if pool < (size[leaf] if depth else 1):
                    break
                given.add(leaf)
                pool -= size[leaf]
                left[leaf] -= size[leaf]
    out = Counter()
    for leaf, (whole, rest, order) in plans.items():
        most = min(u for *_, u in order if u > rest) if leaf in given else rest
        for doc_id, text, upto in order:
            for epoch in range(whole + (rest > 0 and upto <= most)):
                out[doc_id, text, *leaf, tokens(text), epoch] += 1
    return out


@pytest.mark.parametrize("percent,epochs", [(0, 1), (50, 1), (100, 1), (150, 4)])
def test_draw_equals_brute_force(spark, percent, epochs):
    r = random.Random(percent)
    docs = [(i, " ".join("w" * r.randint(1, 3) for _ in range(r.choice([0, 1, 9, 80]))), r.choice(["en", "de", None]),
             r.choice(["a1", "a1", "a1", "b1", "b2", "never", None])) for i in range(300)]
    docs += [(None, "x y", "en", "a1"), (None, None, "en", "a1"), (4, *docs[4][1:]), (5, "x\x0by\tz", None, None)]
    df = spark.createDataFrame([(*d, 1, 2, 3, "dom") for d in docs], SCHEMA)
    domain = F.when(F.col("source") == "never", "never").otherwise(F.coalesce(F.substr("source", F.lit(1), F.lit(1)), F.lit("?")))
    drawn = mix(df, WEIGHTS, domain, percent=percent, epochs=epochs, seed=9)
    got = Counter((x["row"]["doc_id"], x["row"]["text"], x["domain"], x["row"]["lang"], x["row"]["source"],
                   x["n_tokens"], x["epoch"]) for x in drawn.collect())
    assert got == drawn_by_force(docs, percent, epochs, 9)


def test_what_leaves_leave_goes_to_others(spark):
    r = random.Random(6)
    docs = [(i, " ".join("w" * r.choice([3, 40, 300])), r.choice(["en", "de"]), f"a{r.randint(0, 9)}") for i in range(400)]
    df = spark.createDataFrame([(*d, 1, 2, 3, "dom") for d in docs], SCHEMA)
    budget = sum(len(d[1].split()) for d in docs) // 2
    for seed in range(3):
        drawn = mix(df, WEIGHTS, F.substr("source", F.lit(1), F.lit(1)), 50, 1, seed).agg(F.sum("n_tokens")).first()[0]
        assert budget <= drawn < budget + 300


def test_empty_table_and_plan(spark):
    df = spark.createDataFrame([], SCHEMA)
    drawn = mix(df, WEIGHTS, F.col("source"), 50, 2)
    assert drawn.collect() == []
    plan = drawn._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


@pytest.mark.parametrize("epochs", [1, 3])
def test_a_long_document_does_not_leave_a_leaf_short(spark, epochs):
    r = random.Random(epochs)
    docs = [(i, " ".join("w" * n), r.choice(["en", "de"]), r.choice(["a1", "b1"]))
            for i, n in enumerate([900] * 4 + [r.choice([0, 1, 9, 30]) for _ in range(120)])]
    df = spark.createDataFrame([(*d, 1, 2, 3, "dom") for d in docs], SCHEMA)
    leaves = defaultdict(list)
    for _, text, lang, source in docs:
        leaves[source[0], lang, source].append(len(text.split()))
    sums = {k: sum(v) for k, v in leaves.items()}
    shares = budgets_by_force({k: n * epochs for k, n in sums.items()}, WEIGHTS, sum(sums.values()) // 2)
    got, short = Counter(), Counter()
    for seed in range(3):
        for reach, count in ((True, got), (False, short)):
            drawn = mix(df, WEIGHTS, F.substr("source", F.lit(1), F.lit(1)), 50, epochs, seed, reach=reach).collect()
            for x in drawn:
                count[seed, x["domain"], x["row"]["lang"], x["row"]["source"]] += x["n_tokens"]
            most = Counter((x["row"]["doc_id"], x["epoch"]) for x in drawn)
            assert all(n == 1 for n in most.values()) and all(e < epochs for _, e in most)
    over = {(seed, *k): (shares[k], got[seed, *k] - shares[k], max(leaves[k])) for seed in range(3) for k in leaves}
    assert all(0 <= more < longest for _, more, longest in over.values())
    for seed in range(3):
        assert 0 <= sum(short[seed, *k] - shares[k] for k in leaves) < 900
