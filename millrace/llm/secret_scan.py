"""Secret scans over a trigram index.

Each rule is a regular expression. From its syntax tree comes a Boolean query over trigrams
that every match must contain. The index holds postings (trigram, document) for the trigrams
that the rules ask for; a rule's query intersects and unites postings into its candidates, and
only those are searched with the expression. Rules without mandatory trigrams search all texts.

Everything runs in DataFrame functions. The index lies over lower-cased text, so it may let
through too much, never too little.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce
from re import _constants as sre, _parser

from pyspark.sql import Column, DataFrame, functions as F

#: Strings of a set that is still spelled out; larger sets end the spelled-out run.
SPELLED = 64


@dataclass(frozen=True)
class Rule:
    """``kind``; ``pattern`` (the common part of Java's and Python's syntax); matches count if
    ``group`` has at least ``least`` characters."""
    kind: str
    pattern: str
    group: int = 0
    least: int = 0


BASE = (
    Rule("assign", r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
         group=2, least=8),
    Rule("access", r"AKIA[A-Z0-9]+", least=16),
    # A run that is too short has no longer one inside, so the length may stand in the pattern.
    Rule("hex", r"[0-9a-f]{32,}", least=32),
)
#: Further kinds; their spans stand beside the base ones.
EXTRA = (
    Rule("pem", r"-----BEGIN [A-Z ]*PRIVATE KEY-----"),
    Rule("hub", r"gh[pousr]_[A-Za-z0-9]{36,}"),
)

# A query is True (any text), a trigram, or ("and" | "or", frozenset of queries).


def trigram_query(pattern: str):
    """What trigrams, lower-cased, a text must contain to match ``pattern``."""
    spelled, query = _walk(_parser.parse(pattern))
    return _both(query, _of_strings(spelled))


def _of_strings(strings):
    if strings is None or any(len(s) < 3 for s in strings):
        return True
    return _any([_all([s[i:i + 3] for i in range(len(s) - 2)]) for s in strings])


def _all(parts):
    parts = frozenset(p for p in parts if p is not True)
    return True if not parts else next(iter(parts)) if len(parts) == 1 else ("and", parts)


def _any(parts):
    parts = frozenset(parts)
    if True in parts:
        return True
    # A conjunction that asks for more than another one adds nothing.
    parts = frozenset(p for p in parts if not any(_terms(q) < _terms(p) for q in parts))
    return next(iter(parts)) if len(parts) == 1 else ("or", parts)


def _terms(query) -> frozenset:
    return query[1] if isinstance(query, tuple) and query[0] == "and" else frozenset([query])


def _both(a, b):
    return _all([a, b])


def _walk(tree):
    """(set of all strings it can match, or None; query of what it contains besides)."""
    spelled, query = {""}, True
    for op, value in tree:
        strings, inner = _step(op, value)
        query = _both(query, inner)
        if strings is not None and spelled is not None and len(spelled) * len(strings) <= SPELLED:
            spelled = {a + b for a in spelled for b in strings}
            continue
        query = _both(query, _of_strings(spelled))
        spelled = strings if strings is None or len(strings) <= SPELLED else None
    return spelled, query


def _step(op, value):
    if op is sre.LITERAL:
        return {chr(value).lower()}, True
    if op is sre.IN:
        chars = set()
        for kind, v in value:
            if kind is sre.LITERAL:
                chars.add(chr(v).lower())
            elif kind is sre.RANGE:
                chars |= {chr(c).lower() for c in range(v[0], v[1] + 1)}
            else:
                return None, True
        return (chars, True) if len(chars) <= 8 else (None, True)
    if op is sre.SUBPATTERN:
        return _walk(value[3])
    if op is sre.BRANCH:
        parts = [_walk(branch) for branch in value[1]]
        if all(strings is not None for strings, _ in parts):
            union = set().union(*(strings for strings, _ in parts))
            return (union if len(union) <= SPELLED else None), _any([q for _, q in parts])
        return None, _any([_both(q, _of_strings(strings)) for strings, q in parts])
    if op in (sre.MAX_REPEAT, sre.MIN_REPEAT):
        least, most, inner = value
        strings, query = _walk(inner)
        if most == 1 and least == 0:
            return ({""} | strings, True) if strings is not None else (None, True)
        return None, _both(query, _of_strings(strings)) if least else True
    return None, True


def trigrams_of(query) -> set[str]:
    if query is True:
        return set()
    return {query} if isinstance(query, str) else set().union(*map(trigrams_of, query[1]))


def _holds(query, postings: Column) -> Column:
    if isinstance(query, str):
        return F.array_contains(postings, query)
    parts = [_holds(q, postings) for q in sorted(query[1], key=str)]
    return reduce(lambda a, b: a & b if query[0] == "and" else a | b, parts)


def _spans(text: Column, rule: Rule, rank: int) -> Column:
    """Spans (start, rank, kind, end) of a rule's matches that count, in code points.

    The text before, between and after the matches alternates with them, so running sums of
    the lengths are the places.
    """
    found = F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(0))
    judged = F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(rule.group))
    before = F.split(text, rule.pattern, -1)
    steps = F.arrays_zip(before.alias("gap"), found.alias("hit"), judged.alias("own"))
    span_type = "array<struct<start:int,rank:int,kind:string,end:int>>"
    start = F.struct(F.lit(0).alias("at"), F.array().cast(span_type).alias("spans"))

    def add(state: Column, step: Column) -> Column:
        begin = state["at"] + F.char_length(step["gap"])
        end = begin + F.coalesce(F.char_length(step["hit"]), F.lit(0))
        span = F.array(F.struct(begin.alias("start"), F.lit(rank).alias("rank"),
                                F.lit(rule.kind).alias("kind"), end.alias("end")))
        counts = step["hit"].isNotNull() & (F.char_length(step["own"]) >= rule.least)
        return F.struct(end.alias("at"),
                        F.when(counts, F.concat(state["spans"], span)).otherwise(state["spans"]).alias("spans"))

    return F.aggregate(steps, start, add, lambda state: state["spans"])


def _index(docs: DataFrame, rules: tuple[Rule, ...]) -> DataFrame:
    """Postings ``(trigram, k1, k2)`` for the trigrams of the rules' queries."""
    wanted = sorted(set().union(*(trigrams_of(trigram_query(r.pattern)) for r in rules)))
    lowered = docs.select("k1", "k2", F.lower("text").alias("low"))
    present = F.array_compact(F.array(*[F.when(F.contains("low", F.lit(t)), F.lit(t)) for t in wanted]))
    return lowered.select(F.explode(present).alias("trigram"), "k1", "k2")


def scan_secrets(docs: DataFrame, rules: tuple[Rule, ...] = BASE + EXTRA, text: str = "text",
                 doc_id: str = "doc_id") -> DataFrame:
    """All rows and columns of ``docs`` with ``secret_spans``: array of (start, rank, kind, end).

    Spans are sorted by start, then by the rules' order; places count code points, ends are
    exclusive. Matches of one kind never overlap. A null or empty text has no spans, whatever
    the id; repeated rows get equal spans; an empty table gives no rows; texts are searched
    whole. A column that is called ``secret_spans`` is replaced, all others are kept.
    """
    names = docs.columns
    keyed = docs.select(F.struct(*[F.col(f"`{c}`") for c in names if c != "secret_spans"]).alias("row"))
    body = F.coalesce(F.col("row")[text], F.lit(""))
    # Two hashes of id and text name a row; rows that share them share their spans as well.
    keyed = keyed.select("row", F.xxhash64(F.col("row")[doc_id], body).alias("k1"),
                         F.xxhash64(body, F.lit(1), F.col("row")[doc_id]).alias("k2"))
    queries = {r.kind: trigram_query(r.pattern) for r in rules}
    indexed = {kind: q for kind, q in queries.items() if q is not True}
    rows = keyed
    if indexed:
        index = _index(keyed.select("k1", "k2", body.alias("text")), tuple(r for r in rules if r.kind in indexed))
        found = index.groupBy("k1", "k2").agg(F.collect_set("trigram").alias("postings"))
        kinds = F.array_compact(F.array(*[F.when(_holds(q, F.col("postings")), F.lit(kind))
                                          for kind, q in indexed.items()]))
        candidates = found.select("k1", "k2", kinds.alias("kinds")).where(F.size("kinds") > 0)
        rows = keyed.join(candidates.hint("shuffle_hash"), ["k1", "k2"], "left")
    none = F.array().cast("array<struct<start:int,rank:int,kind:string,end:int>>")
    each = []
    for rank, rule in enumerate(rules):
        asked = (F.array_contains("kinds", rule.kind) if rule.kind in indexed else F.lit(True)) & \
            F.rlike(body, F.lit(rule.pattern))
        each.append(F.when(asked, _spans(body, rule, rank)).otherwise(none))
    spans = F.sort_array(F.concat(*each))
    return rows.select(*[F.col("row")[c].alias(c) for c in names if c != "secret_spans"],
                       spans.alias("secret_spans"))


def secret_digest(scanned: DataFrame, base: tuple[Rule, ...] = BASE) -> DataFrame:
    """``doc_id, n_assign, n_access, n_hex, base_sha256, spans`` of a scanned table."""
    kinds = [r.kind for r in base]
    spans = F.col("secret_spans")

    def joined(which: Column) -> Column:
        return F.array_join(F.transform(which, lambda s: F.concat_ws(
            ":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")

    def number(kind: str) -> Column:
        return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("bigint").alias(f"n_{kind}")

    of_base = F.filter(spans, lambda s: s["kind"].isin(*kinds))
    return scanned.select(
        "doc_id",
        *map(number, kinds),
        F.sha2(joined(of_base), 256).alias("base_sha256"), joined(spans).alias("spans"))


def redact_secrets(docs: DataFrame, mask: str = "[secret]", rules: tuple[Rule, ...] = BASE + EXTRA) -> DataFrame:
    """``docs`` with every span of a secret replaced by ``mask``; ``n_chars`` follows the text.

    Overlapping spans become one mask. Texts without secrets, null ones too, stay as they are.
    """
    scanned = scan_secrets(docs, rules)
    text, spans = F.col("text"), F.col("secret_spans")

    def cut(state: Column, span: Column) -> Column:
        gap = F.substr(text, state["at"] + 1, F.greatest(span["start"] - state["at"], F.lit(0)))
        return F.struct(F.greatest(state["at"], span["end"]).alias("at"),
                        F.when(span["start"] >= state["at"], F.concat(state["out"], gap, F.lit(mask))).otherwise(state["out"]).alias("out"))

    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))
    cleaned = F.aggregate(spans, start, cut, lambda s: F.concat(
        s["out"], F.substr(text, s["at"] + 1, F.char_length(text))))
    cleaned = F.when(F.size(spans) > 0, cleaned).otherwise(text)
    out = scanned.withColumn("text", cleaned)
    if "n_chars" in docs.columns:
        length = F.char_length("text").cast(docs.schema["n_chars"].dataType)
        out = out.withColumn("n_chars", F.when(F.size("secret_spans") > 0, length).otherwise(F.col("n_chars")))
    return out.select(*docs.columns)
