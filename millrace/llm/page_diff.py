"""Main text of web pages by differencing each page with its nearest neighbour.

Pages of a host are sorted by URL path, and each is paired with the neighbour that shares more
of its path. The text lines (blocks) of both are aligned by a longest common subsequence, and
lines they share are deleted: what two neighbours have in common belongs to the site.

Two limits of the bare method are mended with the markup. Menus, adverts or notices that
differ from page to page are not shared, so lines inside elements for such parts go as well.
And an article that a site shows at two addresses is shared, so lines inside an ``article``
element stay, unless its class or id tells that it is a comment or an advert. Differencing
decides the lines beside articles, and those of ``main`` if the neighbour has not the same main.
Pages beside each other with the same lines, but for parts of the site, are copies and share one
neighbour on each side: the nearest page that differs.
"""

from __future__ import annotations

import bisect
import hashlib
import html
import re
from collections.abc import Iterator
from urllib.parse import urlsplit

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, Window, functions as F

from millrace.llm.common import shuffle_width, slices, written

# Markup, longest reading first; a tag that the text ends in is dropped.
TOKEN = re.compile(
    r"""<!--.*?(?:-->|\Z)
    | <(?P<raw>script|style|title|textarea|noscript|template|iframe|select|object|annotation|annotation-xml)
      (?=[\s/>])[^>]*>.*?(?:</(?P=raw)\s*>|\Z)
    | <svg(?=[\s/>])[^>]*(?<!/)>.*?(?:</svg\s*>|\Z)
    | <(?P<close>/?)(?P<name>[a-zA-Z][^\s/>]*)(?P<rest>(?:[^>"']|"[^"]*"|'[^']*')*)>
    | <(?P<close2>/?)(?P<name2>[a-zA-Z][^\s/>]*)(?P<rest2>[^>]*)>
    | <[!?/][^>]*(?:>|\Z) | <[a-zA-Z][^>]*\Z""", re.S | re.I | re.X)
# Whole names, so that ``data-id`` is no id and a quoted value is not searched for more.
ATTRIBUTE = re.compile(r"""([^\s"'<>/=]+)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+))""")

INLINE = frozenset("a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q "
                   "rp rt ruby s samp small span strike strong sub sup svg time tt u var wbr "
                   # Formulas are part of their line.
                   "math menclose mfrac mi mmultiscripts mn mo mover mpadded mphantom mroot mrow ms mspace msqrt mstyle "
                   "msub msubsup msup mtable mtd mtext mtr munder munderover semantics".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements whose end tag may be missing; a new one of the kind, or the end of a parent, ends them.
LOOSE = frozenset("p li dt dd tr td th thead tbody tfoot option".split())
MAIN = frozenset(["article", "main"])
SITE = frozenset("nav header footer aside form button dialog menu".split())
SITE_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert menu".split())
#: Words of a class or id that name a part which is not the article.
SITE_WORDS = frozenset(
    "ad ads adv advert adverts advertisement advertising banner breadcrumb breadcrumbs comment comments consent cookie "
    "cookies disqus footer form gdpr header masthead menu modal nav navbar navigation newsletter notice popup promo "
    "promotion related respond share sharing sidebar signup social sponsor sponsored subscribe toolbar widget".split())

#: Inside an article; neither; in a part of the site; inside a main element, beside its articles.
CONTENT, OPEN, SITE_PART, WIDE = 0, 1, 2, 3
#: Part of the text of a main element from which a neighbour that shares it is a copy.
COPY = 0.8


#: Inside an article a class must be one of these as a whole; names that only hold such a word, as
#: ``related-work`` or ``form-factor``, may be of the article itself, as may banner, header and masthead.
ARTICLE_SITE = (SITE_WORDS - frozenset("banner header masthead".split())) | frozenset(
    "ad-banner ad-box ad-container ad-slot ad-unit ad-wrapper comment-area comment-body comment-form comment-list "
    "comment-respond comment-section comment-thread comments-area comments-list comments-section cookie-banner "
    "disqus-thread reader-comments user-comments "
    "cookie-consent cookie-notice nav-links newsletter-form newsletter-signup post-navigation related-articles "
    "related-links related-posts related-stories share-bar share-buttons share-links sidebar-widget signup-form "
    "social-buttons social-links social-share sponsored-content subscribe-form widget-area".split())
COUNTED = re.compile(r"(?:div-)?(ad|comment)-?\d+")
#: Elements of running text: an id names a place in it, and a class of theirs may be of its wording.
TEXT = INLINE | frozenset("h1 h2 h3 h4 h5 h6 p section".split())
#: Ids by which a section says that it holds what readers write.
READERS = frozenset("comment-area comment-list comment-section comment-thread comments comments-area comments-list "
                    "comments-section disqus-thread reader-comments respond user-comments".split())
#: Inside an article the id of an item does not count either.
ITEMS = frozenset("blockquote dd dt figcaption figure li pre table td th tr".split())
#: What the class of a text element inside an article tells, whatever the wording.
ADVERTS = frozenset("ad ads adv advert adverts advertisement advertising promo sponsor sponsored".split())
#: What an article element may be that is not the page's.
NOT_THE_ARTICLE = frozenset("ad ads advert advertisement comment comments promo related sidebar widget".split())
#: A class that begins so tells of a page what it has.
ABOUT = ("has-", "is-", "no-", "with-")


def _is_site(name: str, rest: str, inside: bool) -> bool:
    if name in SITE and not (name == "header" and inside):
        return True
    if "=" not in rest or name in ("main", "html", "body"):
        return False
    if name == "article":
        words = NOT_THE_ARTICLE
    elif inside:
        words = ADVERTS if name in TEXT and name != "section" else ARTICLE_SITE
    for key, *values in ATTRIBUTE.findall(rest):
        key, names = key.lower(), "".join(values).lower().split()
        if key not in ("class", "id", "role"):
            continue
        if key == "role":
            if not SITE_ROLES.isdisjoint(names):
                return True
        elif key == "id" and name == "section":
            if any(n.replace("_", "-") in READERS for n in names):
                return True
        elif key == "id" and (name in TEXT or inside and name in ITEMS):
            continue
        elif inside or name == "article":
            whole = (n.replace("_", "-") for n in names)
            if any(COUNTED.sub(r"\1", n) in words for n in whole):
                return True
        elif any(not SITE_WORDS.isdisjoint(re.split(r"[^a-z]+", n)) for n in names if not n.startswith(ABOUT)):
            return True
    return False


def text_lines(page: str) -> tuple[list[str], list[int]]:
    """Lines of a page, in order, and the kind of each: content, open, a part of the site, or wide.

    A line is the text of a block with references decoded and white space made single. Tags
    may be wrong or missing. ``br`` is white space.
    """
    lines, kinds, buffer = [], [], []
    stack: list[tuple[str, int, bool]] = []  # element, kind of its place, in a part of the site
    place, site = OPEN, False

    def flush() -> None:
        if buffer:
            line = " ".join(html.unescape("".join(buffer)).split())
            buffer.clear()
            if line:
                lines.append(line)
                kinds.append(SITE_PART if site else place)

    at = 0
    for token in TOKEN.finditer(page):
        if token.start() > at:
            buffer.append(page[at:token.start()])
        at = token.end()
        name = (token["name"] or token["name2"] or "").lower()
        if not name:
            continue
        closing, rest = token["close"] or token["close2"], token["rest"] or token["rest2"] or ""
        if name in INLINE or name in VOID:
            if name == "br":
                buffer.append(" ")
            elif name in VOID and name not in INLINE:
                flush()
            elif not closing and name not in VOID and rest and not rest.endswith("/") and _is_site(name, rest, place != OPEN):
                flush()
                stack.append((name, place, site))
                site = True
            elif closing and any(s[0] == name for s in stack):
                flush()
                place, site = _leave(stack, name)
            continue
        flush()
        if closing:
            if any(s[0] == name for s in stack):
                place, site = _leave(stack, name)
            continue
        if name in LOOSE and stack and stack[-1][0] == name:
            place, site = _leave(stack, name)
        if rest.endswith("/"):
            continue
        part = _is_site(name, rest, place != OPEN)
        if name in LOOSE and not part:
            continue
        stack.append((name, place, site))
        site = site or part
        if name in MAIN and place != CONTENT:
            place = CONTENT if name == "article" else WIDE
    if at < len(page):
        buffer.append(page[at:])
    flush()
    return lines, kinds


def _leave(stack: list, name: str) -> tuple[int, bool]:
    """Close the innermost ``name`` and all inside it; the state before it."""
    while True:
        top, place, site = stack.pop()
        if top == name:
            return place, site


def shared_lines(a: list[str], b: list[str]) -> set[int]:
    """Places in ``a`` of a longest common subsequence with ``b``."""
    places: dict[str, list[int]] = {}
    for j, line in enumerate(b):
        places.setdefault(line, []).append(j)
    # Longest increasing run of places in b, over the lines of a (Hunt and Szymanski).
    ends, links = [], []
    for i, line in enumerate(a):
        for j in reversed(places.get(line, ())):
            k = bisect.bisect_left(ends, j)
            link = (i, links[k - 1] if k else None)
            if k == len(ends):
                ends.append(j)
                links.append(link)
            else:
                ends[k], links[k] = j, link
    out, link = set(), links[-1] if links else None
    while link:
        out.add(link[0])
        link = link[1]
    return out


def main_text(lines: list[str], kinds: list[int], neighbour: list[str] | None) -> str:
    """Lines of articles, and what the neighbour does not share of the open and the wide ones.

    Shared lines of a main element stay if they are ``COPY`` of its text, as the neighbour then
    shows the same main. Without a neighbour, open lines stay if they outweigh the content.
    """
    shared = shared_lines(lines, neighbour) if neighbour else set()
    weight = [0, 0, 0, 0]
    for line, kind in zip(lines, kinds):
        weight[kind] += len(line)
    decided = {OPEN}
    if sum(len(lines[i]) for i in shared if kinds[i] == WIDE) < COPY * weight[WIDE]:
        decided.add(WIDE)
    gone = {SITE_PART}
    if not neighbour and 0 < weight[CONTENT] + weight[WIDE] >= weight[OPEN]:
        gone.add(OPEN)
    return "\n".join(line for i, (line, kind) in enumerate(zip(lines, kinds))
                     if kind not in gone and not (kind in decided and i in shared))


def address(url: str | None) -> tuple[str, str]:
    """Host and path (with the query) of a URL, whatever its form; the scheme does not count."""
    try:
        parts = urlsplit(url or "")
        return (parts.netloc or "").lower(), parts.path + ("?" + parts.query if parts.query else "")
    except ValueError:
        return "", url or ""


def _common(a: str, b: str) -> int:
    n = min(len(a), len(b))
    return next((i for i in range(n) if a[i] != b[i]), n)


def body_digest(lines: list[str], kinds: list[int]) -> bytes:
    """Equal for copies: of the lines that are not in parts of the site."""
    own = (line for line, kind in zip(lines, kinds) if kind != SITE_PART)
    return hashlib.blake2b("\n".join(own).encode(errors="replace"), digest_size=16).digest()


def _guests(ends: list) -> dict[tuple, list[int]]:
    """Pages that other ranges need, with these ranges, from the rows of all ranges in order.

    ``first`` and ``last`` are the ends of a range; ``after_first`` and ``before_last`` the nearest
    pages that are no copies of them on their host.
    """
    out: dict[tuple, list[int]] = {}

    def meet(at: int, others: list, edge: str, inner: str, own: str) -> None:
        page = ends[at][own]
        for other in others:
            for found in (other[edge], other[inner]):
                if found is None or found["body"] == page["body"] and found["host"] == page["host"]:
                    continue
                if found["host"] == page["host"]:
                    out.setdefault(tuple(found)[:4], []).append(ends[at]["range"])
                return

    for at in range(len(ends)):
        meet(at, ends[at - 1::-1] if at else [], "last", "before_last", "first")
        meet(at, ends[at + 1:], "first", "after_first", "last")
    return out


def extract_main_text(pages: DataFrame) -> DataFrame:
    """``page_id, url, text, n_chars`` for each row of ``pages`` (page_id, url, html).

    A null html is empty and gives an empty text, as does a page without main text. Pages with
    a null or unreadable url form a host of their own, sorted by what there is. Pages with
    equal addresses are neighbours, in order of their ids, then of their html; a page without
    another page on its host keeps all open lines, or none if its articles hold more text. Null and repeated ids are rows like others.
    Other columns are ignored; an empty table gives no rows. Pages are read whole.

    The order of hosts and paths is cut into ranges, so a host with a third of all pages is no
    hot group; the pages next to its ends that are no copies of them also go to a range.
    """
    spark = pages.sparkSession
    rows = pages.select(F.col("page_id").cast("bigint").alias("page_id"), "url", "html")

    # The table of keys is small next to the pages, and several passes read it.
    def key_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            ids, urls, pages_, ties = (c.to_pylist() for c in batch.columns)
            at = [address(u) for u in urls]
            yield pa.RecordBatch.from_arrays(
                [pa.array([a[0] for a in at], pa.string()), pa.array([a[1] for a in at], pa.string()),
                 batch.column(0), batch.column(3),
                 pa.array([body_digest(*text_lines(page or "")) for page in pages_], pa.binary())],
                names=["host", "path", "page_id", "tie", "body"])

    rows = rows.withColumn("tie", F.xxhash64("html"))
    keys = written(rows.select("page_id", "url", "html", "tie").mapInArrow(
        key_of, "host string, path string, page_id bigint, tie bigint, body binary"), "page_keys")
    ranges = max(4, 2 * shuffle_width(spark))
    total = keys.count()
    every = max(1, total // (32 * ranges))
    # About 32 addresses a range reach the driver; which ones depends on the address alone.
    sample = keys.where(F.pmod(F.xxhash64("host", "path", "page_id"), F.lit(every)) == 0).select("host", "path").collect()
    sample = sorted({(r[0], r[1]) for r in sample})
    bounds = sorted({sample[len(sample) * i // ranges] for i in range(1, ranges)}) if sample else []
    shared = spark.sparkContext.broadcast(bounds)

    @F.pandas_udf("int")
    def range_of(host: pd.Series, path: pd.Series) -> pd.Series:
        return pd.Series([bisect.bisect_right(shared.value, at) for at in zip(host, path)], dtype=np.int32)

    page = F.struct("host", "path", "page_id", "tie", "body")
    placed = keys.withColumn("range", range_of("host", "path"))
    edges = placed.groupBy("range").agg(F.min(page).alias("first"), F.max(page).alias("last"))
    # Two rows for each range.
    no_copy = lambda end: (F.col("host") != F.col(f"{end}.host")) | (F.col("body") != F.col(f"{end}.body"))
    inner = placed.join(F.broadcast(edges), "range").groupBy("range").agg(
        F.min(F.when(no_copy("first"), page)).alias("after_first"),
        F.max(F.when(no_copy("last"), page)).alias("before_last"))
    visits = spark.sparkContext.broadcast(_guests(edges.join(inner, "range").orderBy("range").collect()))

    @F.pandas_udf("host string, path string")
    def split_url(urls: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([address(u) for u in urls], columns=["host", "path"])

    ranged = rows.withColumn("at", split_url("url")).withColumn("range", range_of("at.host", "at.path"))

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pack = zstandard.ZstdCompressor(level=3)
        for batch in slices(batches):
            ids, urls, pages_, ties, hosts, paths, own = (c.to_pylist() for c in batch.columns)
            out = []
            for i, page in enumerate(pages_):
                lines, kinds = text_lines(page or "")
                # A line holds no line break, so the lines of a page travel as one packed text.
                row = {"range": own[i], "host": hosts[i], "path": paths[i], "page_id": ids[i], "url": urls[i],
                       "tie": ties[i], "body": body_digest(lines, kinds), "guest": False, "lines": pack.compress("\n".join(lines).encode()), "kinds": bytes(kinds)}
                out.append(row)
                for other in visits.value.get((hosts[i], paths[i], ids[i], ties[i]), ()):
                    out.append(row | {"range": other, "guest": True})
            yield pa.RecordBatch.from_pylist(out, schema=parsed)

    parsed = pa.schema([("range", pa.int32()), ("host", pa.string()), ("path", pa.string()), ("page_id", pa.int64()),
                        ("url", pa.string()), ("tie", pa.int64()), ("body", pa.binary()), ("guest", pa.bool_()),
                        ("lines", pa.binary()), ("kinds", pa.binary())])
    blocks = ranged.select("page_id", "url", "html", "tie", "at.host", "at.path", "range").mapInArrow(
        parse, "range int, host string, path string, page_id bigint, url string, tie bigint, body binary, "
               "guest boolean, lines binary, kinds binary")
    # Within a run of copies, the page before its first and the page after its last; the two orders are one reversed.
    order = ("path", "page_id", "tie", "body", "guest")
    beside = blocks
    for name, near in (("before", Window.partitionBy("range", "host").orderBy(*[F.asc(c) for c in order])),
                       ("after", Window.partitionBy("range", "host").orderBy(*[F.desc(c) for c in order]))):
        begins = F.lag("body").over(near) != F.col("body")
        beside = (beside.withColumn("met", F.when(begins, F.lag(F.struct("path", "lines")).over(near)))
                  .withColumn(name, F.last("met", ignorenulls=True).over(near.rowsBetween(Window.unboundedPreceding, 0)))
                  .drop("met"))
    beside = beside.where("not guest").select("page_id", "url", "path", "lines", "kinds", "before", "after")

    def difference(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack = zstandard.ZstdDecompressor()

        def opened(packed: bytes) -> list[str]:
            return unpack.decompress(packed).decode().split("\n")

        for batch in slices(batches):
            ids, urls, paths, lines, kinds, before, after = batch.columns
            texts = []
            for path, own, kind, a, b in zip(*(c.to_pylist() for c in (paths, lines, kinds, before, after))):
                near = max((x for x in (a, b) if x), key=lambda x: _common(path, x["path"]), default=None)
                texts.append(main_text(opened(own), list(kind), opened(near["lines"]) if near else None))
            yield pa.RecordBatch.from_arrays(
                [ids, urls, pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                names=["page_id", "url", "text", "n_chars"])

    return beside.mapInArrow(difference, "page_id bigint, url string, text string, n_chars bigint")
