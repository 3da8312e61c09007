"""Main text of pages: parsing, alignment, neighbours."""

import random

import pytest

from millrace.llm.page_diff import CONTENT, OPEN, SITE_PART, address, extract_main_text, main_text, shared_lines, text_lines

SCHEMA = "page_id bigint, url string, html string, host int, path int, lines int, text int, guest int"


@pytest.mark.parametrize("page,expected", [
    ("<nav><a>x</a></nav><article><h1>T</h1><p>a<b>b</b> c<br>d<p>e</article><footer>f</footer>", ["T", "ab c d", "e"]),
    ("<article><p>1 &lt; 2 &amp; 3&nbsp;x &#233; &eacute", ["1 < 2 & 3 x é é"]),
    ("<article>a<script>var t='</p>';</script>b<style>p{}</style><!-- <p>no --> c</article>", ["ab c"]),
    ("<article><p>kept</p><aside>no</aside><form>no</form><div class='ad'>no</div><p>also</p><div id=comments>no</div>",
     ["kept", "also"]),
    ("<main><div class='entry-header'><h1>T</h1></div><p title='a>b'>x</p><span class=advert>no</span>y</main>", ["T", "x", "y"]),
    ("<body class='has-sidebar'><div class='sidebar left'>no</div><div role=navigation>no</div><p>open", ["open"]),
    ("<article><p>a</div></p></section>b</article>c", ["a", "b"]),
    ("<article><p>cut <a hre", ["cut"]), ("", []), ("plain text\n only", ["plain text only"]),
    ("<title>no</title><p>1 < 2 <3</p>", ["1 < 2 <3"]),
    ('<article><p>One</p><svg class="i"/><p>Two</p><svg><text>no</text></svg>x<svg-icon></svg-icon>y</article>', ["One", "Two", "x", "y"]),
    ("<title-bar>x</title-bar><article>a</article>", ["a"]), ("<article><select-box>a</select-box><p>b</article>", ["a", "b"]),
    ("<article><p>Let <math><mi>x</mi><mo>=</mo><mn>1</mn><annotation>no</annotation></math> be.</article>", ["Let x=1 be."]),
    ('<article><p>a</p><section id="comments"><p>no</p></section></article><section id=disqus_thread>no</section>', ["a"]),
    ('<article><section id="notice-and-comment">a</section><div data-id="related">b</div><p data-role="menu">c</p>'
     '<div title="its class=ad">d</div><div class="user-comments">no</div><span class="ad"/>e</article>', ["a", "b", "c", "d", "e"]),
    ("<article><p>a<img src=x>b<hr/>c</p><ul><li>d<li>e</ul></article>", ["ab", "c", "d", "e"]),
])
def test_lines(page, expected):
    assert main_text(*text_lines(page), None).split("\n") == (expected or [""])


def longest_by_force(a, b):
    table = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i, x in enumerate(a):
        for j, y in enumerate(b):
            table[i + 1][j + 1] = table[i][j] + 1 if x == y else max(table[i][j + 1], table[i + 1][j])
    return table[-1][-1]


def test_shared_lines_are_a_longest_common_subsequence():
    r = random.Random(2)
    for _ in range(300):
        a, b = ([r.choice("abcde") for _ in range(r.randint(0, 14))] for _ in range(2))
        places = sorted(shared_lines(a, b))
        common = iter(b)
        assert all(a[i] in common for i in places)  # a subsequence of b
        assert len(places) == longest_by_force(a, b)


def page(own, site="<p>Menu</p><p>About us</p>"):
    return f"<div>{site}{''.join(f'<p>{x}</p>' for x in own)}<p>Imprint</p></div>"


def table(spark, rows):
    return spark.createDataFrame([(*x, 1, 2, 3, 4, 5) for x in rows], SCHEMA)


def by_force(rows):
    """Neighbours on the whole sorted list."""
    keyed = sorted(((*address(u), -1 if i is None else i), i, u, h) for i, u, h in rows)
    out = []
    for at, ((host, path, _), i, u, h) in enumerate(keyed):
        near = [keyed[j] for j in (at - 1, at + 1) if 0 <= j < len(keyed) and keyed[j][0][0] == host]
        same = lambda k: next((n for n, (a, b) in enumerate(zip(path, k[0][1])) if a != b), min(len(path), len(k[0][1])))
        best = max(near, key=same, default=None)
        text = main_text(*text_lines(h or ""), text_lines(best[3] or "")[0] if best else None)
        out.append((i, u, text, len(text)))
    return sorted(out, key=repr)


def test_neighbours_over_ranges(spark):
    r = random.Random(5)
    rows = [(i, f"https://{'hot' if i % 3 else f'h{i % 7}'}.example/{r.choice(['a', 'b', 'b/c'])}/{i}",
             page([f"own {i}", r.choice(["x", "y", f"z{i}"])])) for i in range(400)]
    rows += [(900, None, page(["n"])), (901, "http://[bad", page(["m"])), (902, "", None), (None, "https://only/1", page(["o"]))]
    got = sorted((tuple(x) for x in extract_main_text(table(spark, rows)).collect()), key=repr)
    assert got == by_force(rows)
    assert dict((x[0], x[2]) for x in got)[None] == "Menu\nAbout us\no\nImprint"  # no neighbour
    assert all("Menu" not in x[2] for x in got if x[1] and "hot" in x[1])


def test_copies_of_an_article_keep_it(spark):
    body = "<nav>m</nav><article><p>same</p></article>"
    rows = [(1, "http://h/a", body), (2, "http://h/a", body), (2, "http://h/a", body), (3, "http://h/b?x", body)]
    assert [x["text"] for x in extract_main_text(table(spark, rows)).collect()] == ["same"] * 4


def test_empty_table(spark):
    assert extract_main_text(table(spark, [])).collect() == []


def test_kinds():
    assert text_lines("<p>a<nav>b</nav><article>c")[1] == [OPEN, SITE_PART, CONTENT]


SITE = "<div class=x>Menu</div>"
MAIN_OF = "<main><p>Menu</p><p>Follow our pages</p><p>{}</p></main>"


@pytest.mark.parametrize("own,other,expected", [
    # A comment marked up as an article is not the page's text, with a neighbour or without.
    ("<div class=post><p>Body</p></div><article class=comment><p>Nice</p></article>", None, ["Body"]),
    ("<article><p>Body</p><article class=comment><p>Nice</p></article></article>", None, ["Body"]),
    ("<article id=ad-hoc-networks class='post sidebar-left'><p>Body</p></article>", None, ["Body"]),
    # A teaser does not take the body's place; what is shared beside it goes.
    (SITE + "<article>Teaser</article><p>Long body</p>", SITE + "<article>Another</article><p>Other body</p>", ["Teaser", "Long body"]),
    ("<article>Teaser</article><p>Long body</p>", None, ["Teaser", "Long body"]),
    # Shared lines of a main around the whole page go, unless the neighbour shows the same main.
    (MAIN_OF.format("a text of its own"), MAIN_OF.format("the other text here"), ["a text of its own"]),
    ("<p>x</p>" + MAIN_OF.format("same"), "<p>y</p>" + MAIN_OF.format("same"), ["x", "Menu", "Follow our pages", "same"]),
])
def test_differencing_decides_beside_articles(own, other, expected):
    assert main_text(*text_lines(own), text_lines(other)[0] if other else None).split("\n") == expected


@pytest.mark.parametrize("element", [
    "h2 id=related-work", "section id='notice-and-comment'", "section id=commentary", "p id=share-price",
    "div class='form-factor'", "span class='ad-hoc'", "div class='share-price widget-theory'", "span class=comment",
    "p class=notice", "div id=cookie-recipes", "li id=social",
])
def test_text_of_an_article_stays(element):
    page = f"<article><p>a</p><{element}>kept</{element.split()[0]}><p>b</p></article>"
    assert main_text(*text_lines(page), None).split("\n") in (["a", "kept", "b"], ["akeptb"])


@pytest.mark.parametrize("element", [
    "div class=comments", "section class='comments-area'", "ol class=comment-list", "div id=comment-12", "div id=div-comment-7",
    "div class='x related_posts'", "span class=sponsored", "p class=ad", "div class='share'", "section class=related",
    "div role=navigation",
])
def test_parts_of_the_site_inside_an_article_go(element):
    page = f"<article><p>a</p><{element}>no</{element.split()[0]}><p>b</p></article>"
    assert main_text(*text_lines(page), None).split("\n") == ["a", "b"]


def test_ids_of_text_outside_an_article():
    assert main_text(*text_lines("<h2 id=related-work>T</h2><p id=share-price>x</p><div id=site-nav>no</div>"), None) == "T\nx"


def beside_by_force(rows):
    """The nearest page before and after that is no copy, on the whole sorted list."""
    parsed = [text_lines(h or "") for *_, h in rows]
    own = [[x for x, k in zip(*p) if k != SITE_PART] for p in parsed]
    order = sorted(range(len(rows)), key=lambda i: (*address(rows[i][1]), rows[i][0]))
    out = []
    for at, i in enumerate(order):
        host, path = address(rows[i][1])
        near = [next((j for j in side if own[j] != own[i]), None) for side in (order[:at][::-1], order[at + 1:])]
        near = [j for j in near if j is not None and address(rows[j][1])[0] == host]
        same = lambda j: next((n for n, (a, b) in enumerate(zip(path, address(rows[j][1])[1])) if a != b),
                              min(len(path), len(address(rows[j][1])[1])))
        best = max(near, key=same, default=None)
        out.append((rows[i][0], main_text(*parsed[i], parsed[best][0] if best is not None else None)))
    return sorted(out)


@pytest.mark.parametrize("seed", range(3))
def test_copies_meet_the_nearest_page_that_differs(spark, seed):
    r = random.Random(seed)
    rows, i = [], 0
    for _ in range(60):  # runs of copies in path order, some over many ranges
        body = r.choice(["text one", "text two", f"own {i}"])
        for _ in range(r.choice([1, 1, 2, 5, 40])):
            advert = f"<div class=ad>{r.random()}</div>"
            rows.append((i, f"http://{'a' if i < 300 else 'b'}/{i:05}", page([body], f"<p>Menu</p>{advert}")))
            i += 1
    got = sorted((x["page_id"], x["text"]) for x in extract_main_text(table(spark, rows)).collect())
    assert got == beside_by_force(rows)
    assert all(text for _, text in got) and sum("Menu" in text for _, text in got) == 0


def test_copies_alone_on_a_host_keep_their_text(spark):
    rows = [(1, "http://h/a", page(["x"])), (2, "http://h/b", page(["x"])), (2, "http://h/b", page(["x"]))]
    assert [x["text"] for x in extract_main_text(table(spark, rows)).collect()] == ["Menu\nAbout us\nx\nImprint"] * 3
