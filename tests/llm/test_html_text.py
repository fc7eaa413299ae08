"""Main text of pages: against plain computations, cases written by hand, and the given pages."""

import html
import math
import re
import time

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from turnmeter.llm import html_text
from turnmeter.llm.html_text import extract
from turnmeter.llm.html_tree import Run, Tree
from turnmeter.llm.queries import LLM_QUERIES

LONG = "Words of the article that go on for a while, as an article does. " * 4


def article_by_patterns(page):
    """The blocks of the page's article, found without a tree: good for pages of one article of p and h1."""
    inner = page[page.index("<article>") + 9:page.index("</article>")]
    blocks = (" ".join(html.unescape(re.sub("<[^>]*>", " ", b)).split()) for b in re.split("</?(?:p|h1)>", inner))
    return "\n".join(b for b in blocks if b)


def test_given_pages(spark, small_dir):
    got = LLM_QUERIES["op13_html_text"](spark, small_dir)
    assert got.columns == ["page_id", "url", "text", "n_chars"]
    pages = {r.page_id: r for r in spark.read.parquet(f"{small_dir}/pages.parquet").collect()}
    rows = got.collect()
    assert sorted(r.page_id for r in rows) == sorted(pages)
    for r in rows:
        assert r.text == article_by_patterns(pages[r.page_id].html) and r.n_chars == len(r.text)
        assert r.url == pages[r.page_id].url


def plain_densities(tree, kept):
    """Density of every node by recursion, straight from the formula."""
    def counts(item):
        if isinstance(item, Run):
            text, linked = (" ".join("".join(x).split()) for x in (item.pieces, item.linked))
            return [len(text), item.tags, min(len(text), len(linked)), item.link_tags]
        children = [c for c in tree.nodes[item].children if isinstance(c, Run) or kept[c]]
        total = [sum(x) for x in zip([0] * 4, *map(counts, children))]
        total[1] += sum(not isinstance(c, Run) for c in children)
        return total

    page = counts(0)

    def value(item):
        c, t, lc, lt = counts(item)
        if c == 0:
            return 0.0
        not_linked = c - lc if c > lc else 1
        lc0, lt0, t0 = lc or 1, lt or 1, t or 1
        base = math.log(c / not_linked * lc0 + (page[2] or 1) / page[0] * c + math.e)
        return c / t0 * max(0.0, math.log(c / lc0 * t0 / lt0, base))
    sums = [sum(value(c) for c in n.children if isinstance(c, Run) or kept[c]) if kept[i] else 0.0
            for i, n in enumerate(tree.nodes)]
    return [value(i) if kept[i] else 0.0 for i in range(len(tree.nodes))], sums


PIECES = ["<div>", "</div>", "<p>", "</p>", "<a href=x>", "</a>", "<b>", "<br>", "text of some length ", "x", "<ul>", "<li>",
          "</ul>", "<nav>", "</nav>", "<table>", "<td>", "</table>", "&amp;", "<", "<svg>", "</svg>", "<form>", "</form>"]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.sampled_from(PIECES), max_size=40))
def test_densities_against_plain_recursion(pieces):
    tree = Tree("".join(pieces))
    kept = html_text._kept(tree)
    densities, sums, _, _ = html_text._measure(tree, kept)
    want, want_sums = plain_densities(tree, kept)
    assert [d if k else 0.0 for d, k in zip(densities, kept)] == pytest.approx(want)
    assert sums == pytest.approx(want_sums)
    extract("".join(pieces))


def test_article_without_article_element():
    page = (f'<body><div class="menu"><a href="/">Home</a></div><div id="wrap"><div class="content"><h1>Title of it</h1>'
            f"<p>{LONG}</p><p>Short.</p><p>{LONG}</p></div><div class=links><a href=1>one</a> <a href=2>two</a></div></div>"
            "<div class=footer>Imprint</div></body>")
    assert extract(page).split("\n") == ["Title of it", LONG.strip(), "Short.", LONG.strip()]


def test_text_split_by_line_breaks_only():
    page = f"<body><div><a href=1>one</a><a href=2>two</a></div><div>{LONG}<br>{LONG}<br><br>{LONG}</div></body>"
    assert extract(page) == " ".join([LONG.strip()] * 3)


def test_boilerplate_is_left_out():
    page = f"""<header><h1>Site</h1></header><div id="cookie-notice">We use cookies</div>
    <form><p>Search {LONG}</p></form><aside>Aside {LONG}</aside>
    <div class="page has-sidebar"><article class="post has-comments"><header><h2>Head</h2></header><p>{LONG}</p>
    <div class="share-buttons">Share</div><script>if (a < b) {{ "</p>" }}</script><style>p {{}}</style>
    <p>One<svg><path d="M0"/><text>no</text></svg> line <!-- <p>not --> here<button>Buy</button></p></article></div>
    <section id="comments"><article class="comment"><p>Comment {LONG}{LONG}</p></article></section>
    <div class="adBox">Ad {LONG}</div><footer>&copy; me</footer>"""
    assert extract(page).split("\n") == ["Head", LONG.strip(), "One line here"]


def test_page_wrapped_in_a_form():
    assert extract(f"<form><input name=q><main><p>{LONG}</p></main></form>") == LONG.strip()


def test_omitted_end_tags_and_references():
    page = "<article><p>a&amp;b &lt;p&gt; &#233;&nbsp;x &copy &unknown;<p><b>c<br>d<ul><li>e<li>f<p>g</ul>h<table><tr><td>i<td>j</table>k"
    assert extract(page).split("\n") == ["a&b <p> é x © &unknown;", "c d", "e", "f", "g", "h", "i", "j", "k"]


@pytest.mark.parametrize("page, text", [
    (None, ""), ("", ""), (" \n ", ""), ("<p></p>", ""), ("plain text", "plain text"), ("a < b", "a < b"), ("x", "x"),
    ("<!-- open", ""), ("<script>open", ""), ("text <b", "text"), ("<nav>only a menu</nav>", ""), ("</p></div>", ""),
    ("<a href=x>only a link</a>", "only a link"), ("<P CLASS='X'>Upper</P>", "Upper"), ('<p title="a>b">quoted</p>', "quoted"),
    ('<p title="open>not lost</p>', "not lost"), ("a\x00b", "a\x00b")])
def test_small_and_broken_pages(page, text):
    assert extract(page) == text


@pytest.mark.parametrize("piece", ["<", "<div>", '<a x=">"', "<p>", "<b>x", "</p>", "<!--", "<li>x", "<a href=x>y", "<svg><p>",
                                   "<table><tr><td>", "&", "<a x='", "word "])
def test_time_grows_with_length(piece):
    def seconds(n):
        began = time.process_time()
        extract(piece * n)
        return time.process_time() - began
    seconds(1000)
    assert seconds(40_000) < 0.5 + 25 * max(0.02, seconds(4_000))


def test_nulls_repeated_rows_extra_columns_empty_table(spark):
    schema = "page_id bigint, url string, html string, text string, n_chars string"
    page = f"<article><p>{LONG}</article>"
    data = [(1, "u", page, "own", "own"), (1, "u", page, "own", "own"), (None, None, None, None, None), (2, "v", "", "", "")]
    df = spark.createDataFrame(data, schema)
    got = df.select("page_id", "text", html_text.main_text("html").alias("found")).collect()
    assert sorted((r.page_id or 0, r.text, r.found) for r in got if r.text is not None) == [
        (1, "own", LONG.strip()), (1, "own", LONG.strip()), (2, "", "")]
    assert [r.found for r in got if r.page_id is None] == [""]
    assert df.limit(0).select(html_text.main_text("html")).collect() == []
