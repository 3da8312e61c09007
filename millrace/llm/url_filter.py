"""URL filters: listed rules, and for all other URLs a logistic regression on character n-grams.

Host and path are cut into n-grams, which are hashed to ``2 ** 16`` buckets apart from each
other. The regression is trained by gradient descent on a small table of labelled URLs, held to
``MOST_LABELLED`` rows. Starting from zero, its weights stay a combination of the labelled rows,
so the steps move one coefficient a row, with the rows' inner products computed before. What is
trained is a table of one weight a bucket; judging is a projection over the URLs, without a shuffle.

Everything is made of DataFrame and SQL functions.

A null URL, or one without ``://``, has an empty host and an empty path: no rule fits, and the
verdict is the regression's for a URL without any n-gram. Labelled rows without a label, or whose
URL is null, are left out. Repeated labelled rows count as often as they occur.
"""

from __future__ import annotations

import json
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
HEX_DIGITS = 4
BUCKETS = 16 ** HEX_DIGITS
SIZES = (3, 4)
# The constant that every row has besides its n-grams.
BIAS = -1
# Bound of the labelled table; the inner products of its rows are held in one row.
MOST_LABELLED = 1_000


@dataclass(frozen=True)
class Rule:
    """``verdict`` for ``host`` and all its subdomains, below ``path``."""
    verdict: str
    host: str
    path: str

    @property
    def name(self) -> str:
        return self.host + self.path


def host_of(url: Column) -> Column:
    found = F.regexp_extract(F.coalesce(url, F.lit("")), "://([^/?#]*)", 1)
    return F.translate(found, UPPER, LOWER)


def path_of(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), "://[^/?#]*([^?#]*)", 1)


def rule_of(host: Column, path: Column, rules: Sequence[Rule]) -> Column:
    """Name of the longest rule that fits; null if none does."""
    out = F.lit(None).cast("string")
    for rule in sorted(rules, key=lambda r: (len(r.name), r.name)):
        fits = ((host == rule.host) | host.endswith("." + rule.host)) & path.startswith(rule.path)
        out = F.when(fits, rule.name).otherwise(out)
    return out


def buckets(host: Column, path: Column) -> Column:
    """Sorted distinct buckets of the n-grams; digits count as one digit."""
    def grams(text: Column, field: str) -> Column:
        plain = F.concat(F.lit(field), F.translate(text, UPPER + "123456789", LOWER + "0" * 9), F.lit(field))

        def cut(letters: Column, n: int) -> Column:
            places = F.sequence(F.lit(1), F.size(letters) - (n - 1))
            return F.transform(places, lambda i: F.concat(F.lit(field), F.array_join(F.slice(letters, i, n), "")))

        # Letters are cut once, and are a variable of what follows; a text without every size has no n-gram.
        listed = F.transform(F.array(F.split(plain, "")), lambda letters: F.when(
            F.size(letters) >= max(SIZES), F.concat(*[cut(letters, n) for n in SIZES]))
            .otherwise(F.array().cast("array<string>")))
        return F.get(listed, 0)

    hashed = F.transform(F.concat(grams(host, "^"), grams(path, "|")),
                         lambda g: F.conv(F.substring(F.md5(g), 1, HEX_DIGITS), 16, 10).cast("int"))
    return F.array_sort(F.array_distinct(hashed))


def fit_url_model(labelled: DataFrame, steps: int = 300, rate: float = 8.0, ridge: float = 1e-3) -> DataFrame:
    """``bucket``, ``weight``: regression of ``blocked`` (boolean) on ``url``, by ``steps`` of descent.

    An n-gram of a URL with m distinct buckets counts 1/sqrt(m). The constant's bucket is ``BIAS``.
    Without labelled rows of both kinds there is nothing to learn, which raises an error.
    """
    rows = labelled.where("url is not null and blocked is not null").select("url", F.col("blocked").cast("boolean"))
    seen = rows.groupBy("blocked").count().collect()
    if len(seen) < 2 or sum(x["count"] for x in seen) > MOST_LABELLED:
        raise ValueError(f"labelled URLs must be of both kinds and at most {MOST_LABELLED}: {seen}")
    # Rows are told apart by their place among equals, in an order that every run agrees on.
    every = F.array_sort(F.collect_list(F.struct("url", F.col("blocked").cast("double").alias("y"))))
    listed = rows.agg(every.alias("rows")).select(F.posexplode("rows").alias("i", "x")).select(
        "i", "x.y", buckets(host_of(F.col("x.url")), path_of(F.col("x.url"))).alias("buckets"))
    value = F.when(F.size("buckets") > 0, 1 / F.sqrt(F.size("buckets"))).otherwise(0.0)
    parts = listed.select("i", "y", F.explode(F.concat(
        F.array(F.struct(F.lit(BIAS).alias("bucket"), F.lit(1.0).alias("x"))),
        F.transform("buckets", lambda b: F.struct(b.alias("bucket"), value.alias("x"))))).alias("part")).select(
        "i", "y", "part.*")
    other = parts.select(F.col("i").alias("j"), "bucket", F.col("x").alias("x_j"))
    inner = parts.join(other, "bucket").groupBy("i", "j").agg(F.sum(F.col("x") * F.col("x_j")).alias("k"))
    lines = inner.groupBy("i").agg(F.transform(F.array_sort(F.collect_list(F.struct("j", "k"))),
                                               lambda x: x["k"]).alias("line"))
    table = lines.join(listed.select("i", "y"), "i").agg(
        F.array_sort(F.collect_list(F.struct("i", "y", "line"))).alias("lines"))
    size = F.size("lines")

    def step(alpha: Column, _: Column) -> Column:
        def one(entry: Column, own: Column) -> Column:
            score = F.aggregate(F.zip_with(entry["line"], alpha, lambda k, a: k * a), F.lit(0.0), lambda s, v: s + v)
            return own * (1 - rate * ridge) - rate / size * (1 / (1 + F.exp(-score)) - entry["y"])
        return F.zip_with("lines", alpha, one)

    start = F.transform("lines", lambda _: F.lit(0.0))
    alpha = table.select(F.posexplode(F.aggregate(F.sequence(F.lit(1), F.lit(steps)), start, step)).alias("i", "alpha"))
    return parts.join(alpha, "i").groupBy("bucket").agg(F.sum(F.col("alpha") * F.col("x")).alias("weight"))


def model_score(host: Column, path: Column, model: DataFrame) -> Column:
    """Log-odds of ``blocked``. ``model`` has at most one row a bucket, so it fits a literal."""
    weights = {x["bucket"]: x["weight"] for x in model.collect()}
    # One array in bucket order, read once as a constant: an entry is found without a search.
    dense = F.from_json(F.lit(json.dumps([weights.get(b, 0.0) for b in range(BUCKETS)])), "array<double>")
    summed = F.aggregate(buckets(host, path), F.struct(F.lit(0.0).alias("total"), F.lit(0).alias("n")),
                         lambda s, b: F.struct((s["total"] + F.get(dense, b)).alias("total"), (s["n"] + 1).alias("n")),
                         lambda s: F.when(s["n"] > 0, s["total"] / F.sqrt(s["n"])).otherwise(0.0))
    return F.lit(float(weights.get(BIAS, 0.0))) + summed


def judge_urls(rows: DataFrame, rules: Sequence[Rule], model: DataFrame, url: str = "url") -> DataFrame:
    """``row`` (all columns of ``rows``), ``host``, ``path``, ``rule``, ``verdict`` (allow or block).

    The longest rule that fits decides, else the regression.
    """
    held = rows.select(F.struct(*[F.col(f"`{c}`") for c in rows.columns]).alias("row"))
    held = held.withColumns({"host": host_of(F.col("row")[url]), "path": path_of(F.col("row")[url])})
    held = held.withColumn("rule", rule_of(F.col("host"), F.col("path"), rules))
    verdict = F.when(model_score(F.col("host"), F.col("path"), model) > 0, "block").otherwise("allow")
    for rule in rules:
        verdict = F.when(F.col("rule") == rule.name, rule.verdict).otherwise(verdict)
    return held.withColumn("verdict", verdict)
