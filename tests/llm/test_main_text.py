"""Main text: cuts against all labellings, pages with known articles, odd markup."""

import html
import itertools
import random
import re

import pytest

from tidemark.llm import main_text, queries
from tidemark.llm.main_text import Page, minimum_cut


def cost(scores, edges, label):
    wrong = sum(abs(s) for s, x in zip(scores, label) if (s > 0) != x and s)
    return wrong + sum(w for a, b, w in edges if label[a] != label[b])


def test_cut_is_the_cheapest_labelling():
    draw = random.Random(2)
    flows = 0
    for _ in range(300):
        n = draw.randint(1, 9)
        scores = [draw.randint(-6, 6) for _ in range(n)]
        edges = [(a, b, draw.randint(0, 5)) for a, b in itertools.combinations(range(n), 2) if draw.random() < 0.5]
        got = minimum_cut(scores, edges)
        all_labels = list(itertools.product([False, True], repeat=n))
        best = min(cost(scores, edges, x) for x in all_labels)
        assert cost(scores, edges, got) == best
        least = min(sum(x) for x in all_labels if cost(scores, edges, x) == best)
        assert sum(got) == least
        strong = all(abs(s) > sum(w for a, b, w in edges if i in (a, b)) for i, s in enumerate(scores))
        flows += not strong
    assert flows > 100


def test_cut_of_a_long_row():
    draw = random.Random(4)
    n = 20_000
    scores = [draw.randint(-1500, 1500) for _ in range(n)]
    edges = [(i, i + 1, 700) for i in range(n - 1)] + [(i, i + 3, 300) for i in range(n - 3)]
    got = minimum_cut(scores, edges)
    some = list(got)
    for i in draw.sample(range(n), 300):  # no single change makes it cheaper
        some[i] = not some[i]
        near = [e for e in edges[max(0, i - 1) : i + 1] + edges[n - 1 + max(0, i - 3) : n + i] if i in e[:2]]
        assert cost([scores[i]], [], [some[i]]) + sum(w for a, b, w in near if some[a] != some[b]) >= cost(
            [scores[i]], [], [got[i]]
        ) + sum(w for a, b, w in near if got[a] != got[b])
        some[i] = not some[i]


def article_of(source):
    """What the pages of the test tables hold between the article's tags."""
    inner = re.search(r"<article>(.*?)</article>", source, re.S)[1]
    return " ".join(html.unescape(re.sub(r"<[^>]+>", " ", inner)).split())


def test_query_gives_the_articles(spark, sf_dir):
    pages = {r["page_id"]: r for r in spark.read.parquet(f"{sf_dir}/pages.parquet").collect()}
    df = queries.QUERIES["op11_main_text"](spark, sf_dir)
    assert df.columns == ["page_id", "url", "text", "n_chars"]
    got = df.collect()
    assert len(got) == len(pages)
    for r in got:
        assert r["text"] == article_of(pages[r["page_id"]]["html"])
        assert r["url"] == pages[r["page_id"]]["url"] and r["n_chars"] == len(r["text"])


LONG = "The river rose in the night, and by morning the lower meadows were under water again."
FRAME = """<html><head><title>T &amp; t</title><style>p {{ color: red }}</style><script>if (a < b) document.write("<p>no</p>")</script></head>
<body class="has-sidebar header-fixed"><header class="site"><h2>The Daily Page</h2><ul class="menu"><li><a href=/a>Home</a><li><a href=/b>News</a></ul></header>
<div id="cookieConsent"><p>We use cookies to make this page better for you. Please agree to all of them.</p><button>Agree</button></div>
{0}
<div class="sidebar"><h3>Popular</h3><p><a href="/x">Ten things you did not know about rivers, and one you did.</a></p></div>
<section id="comments"><h3>2 comments</h3><div class="comment"><p>I was there and it was not like that at all, believe me. It was far worse.</p></div></section>
<form action="/s"><label>Your mail</label><input name=q><p>Leave your address and we will write to you every single day.</p></form>
<noscript>Turn on scripts.</noscript><footer><p>&copy; 2020 The Daily Page. All rights reserved.</p></footer></body></html>"""


@pytest.mark.parametrize(
    "body",
    [
        f"<article><h1>Flood</h1><p>{LONG}</p><p>So it was.</p></article>",
        f"<main><h1>Flood</h1><p>{LONG}</p><p>So it was.</p></main>",
        f"<div class='content'><h1>Flood</h1><p>{LONG}<p>So it was.</div>",
        f"<h1>Flood</h1><p>{LONG}</p><p>So it was.</p>",
        f"<article><header><h1>Flood</h1></header><p>{LONG}</p><aside><p>{LONG}</p></aside><p>So it was.</p></article>",
        f"<article><h1>Flood</h1><p>{LONG}</p><div class='ad'>Buy boats. Buy them now, before the water comes.</div><p>So it was.</p></article>",
        f"<div role=main><h1>Flood</h1><div>{LONG}</div><div>So it was.</div></div>",
        f"<ARTICLE><H1>Flood</H1><P>{LONG}<P>So it was.</ARTICLE>",
    ],
)
def test_pages_of_other_shapes(body):
    assert main_text.main_text(FRAME.format(body)) == f"Flood {LONG} So it was."


def test_form_around_the_whole_page():
    page = f"<body><form id=all><div class=menu><a href=/>Home</a></div><article><p>{LONG}</p></article></form></body>"
    assert main_text.main_text(page) == LONG


def test_blocks_and_references():
    text = main_text.main_text(
        "<article><p>a&nbsp;&lt;b&gt; &amp;amp; x&eacute;&#233;&#xE9; 1 < 2<br>n<b>ex</b>t\n\t line<!-- gone <p> --> end"
        "<p title='>'>two<script>var p = '<p>no';</script> <i>and</i>three</article>"
    )
    assert text == "a <b> &amp; xééé 1 < 2 next line end two andthree"
    page = Page("<p>one<div>two</p>three</div><ul><li>a<ul><li>b</ul><li>c</ul><table><tr><td>x<td>y<tr><td>z</table>", main_text.Costs())
    assert [b.text for b in page.blocks] == ["one", "two", "three", "a", "b", "c", "x", "y", "z"]
    depth = {b.text: page.elements[b.element].depth for b in page.blocks}
    assert depth["a"] == depth["c"] < depth["b"] and depth["x"] == depth["z"]


def test_odd_markup_does_not_crash():
    for source in ("<", "<>", "</p></p>", "<p", "<a href=\"x>y", "<!--", "<script>", "<!DOCTYPE", "&#xD800;&#0;", "<p " * 500, "\x00<p>\x01"):
        main_text.main_text(f"<article>{source}<p>{LONG}</p></article>")
    deep = "<div>" * 5000 + f"<p>{LONG}</p>" + "</div>" * 5000
    assert main_text.main_text(deep) == LONG


def test_edge_cases(spark):
    many = "".join(f"<p>{LONG} {i}.</p>" for i in range(6000))
    rows = [
        (1, "u", None),
        (2, None, ""),
        (None, "n", f"<article><p>{LONG}</p></article>"),
        (4, "u", f"<article><p>{LONG}</p></article>"),
        (4, "u", f"<article><p>{LONG}</p></article>"),
        (5, "u", "<nav><a href=/>Home</a></nav>"),
        (6, "u", f"<article>{many}</article>"),
    ]
    pages = spark.createDataFrame([(*r, "t", 1) for r in rows], "page_id long, url string, html string, text string, n_chars int")
    got = sorted((tuple(r) for r in main_text.extract(pages).collect()), key=str)
    whole = " ".join(f"{LONG} {i}." for i in range(6000))
    texts = ["", "", LONG, LONG, LONG, "", whole]
    assert got == sorted(((r[0], r[1], t, len(t)) for r, t in zip(rows, texts)), key=str)
    assert main_text.extract(pages.limit(0)).count() == 0
