"""Main text against a plain reading of the tables' pages, and hand-made pages."""

import html
import re
import time

import pytest

from flowwarden.llm import extract
from flowwarden.llm.queries import QUERIES


def plain(page):
    """The blocks between <article> tags; holds for the given tables, whose pages all mark their article."""
    inside = re.search(r"<article>(.*)</article>", page or "", re.S)
    if not inside:
        return ""
    blocks = re.split(r"</?(?:p|h1)>", inside[1].replace("<br>", " "))
    blocks = [" ".join(html.unescape(re.sub(r"<[a-z/][^>]*>", "", b)).split()) for b in blocks]
    return "\n".join(b for b in blocks if b)


def test_every_page_of_the_table(spark, sf):
    pages = spark.read.parquet(f"{sf}/pages.parquet").collect()
    found = {r.page_id: r for r in QUERIES["op12_html_extraction"](spark, sf).collect()}
    assert len(found) == len(pages)
    for p in pages:
        row = found[p.page_id]
        assert (row.url, row.text, row.n_chars) == (p.url, plain(p.html), len(plain(p.html)))


LONG = "This is a sentence of the story that goes on for a while, as sentences do. " * 4


@pytest.mark.parametrize(
    ("page", "text"),
    [
        (None, ""),
        ("", ""),
        ("<html><body></body></html>", ""),
        ("just text, 3 < 4 &amp;amp; &lt;b&gt;", "just text, 3 < 4 &amp; <b>"),
        ("<article><h1>A&nbsp; b</h1><p>one\n two<br>three<p>four</article>", "A b\none two three\nfour"),
        ("<ARTICLE><P>x</P></ARTICLE>", "x"),
        # what is no part of the article, inside it and around it
        (
            "<header><h1>Site</h1></header><nav>menu<a>x</a><article><h1>A</h1><p>b</p><form><input><p>f</p></form><aside>s</aside>"
            "<p>d</p><footer>no</footer><section class='comments'><article><p>troll</p></article></section></article><footer>f</footer>",
            "A\nb\nd",
        ),
        ("<article><p>one <script>var x = '</p>';</script>two<style>p{}</style></p><!-- <p>no</p> --><p>last</article>", "one two\nlast"),
        ("<article><div class='cookie-notice'>We use cookies</div><p>x</p><div id='sidebar'>y</div><div role='complementary'>z</div></article>", "x"),
        # class names of a frame don't take its article away
        ("<body class='has-sidebar'><div class='widget'><main><p>x</p></main></div><div class='sidebar'>y</div></body>", "x"),
        # a page without these elements, by class
        (f"<div id=header><h1>Site</h1></div><div class='post-content'><h2>T</h2><p>{LONG}</p><p>end</p></div><div class=footer>f</div>", f"T\n{LONG.strip()}\nend"),
        # and one by the line blocks alone
        (
            "<div><a href=1>Home</a> <a href=2>About</a></div><div><a>a</a></div><div><a>b</a></div><h1>Title</h1>"
            f"<div>{LONG}</div><div>{LONG}</div><div>tail</div><div><a>a</a></div><div><a>a</a></div><div><a>a</a></div><div>(c) x</div>",
            f"Title\n{LONG.strip()}\n{LONG.strip()}\ntail",
        ),
        ("<article><p>a <a href='x>y'>link > 1</a> b</p>", "a link > 1 b"),
        ("<article><p>open <a href=\"never closed>still</a> here", "open still here"),
        ("<article><ul><li>one<li>two</ul><table><tr><td>c</table></article>", "one\ntwo\nc"),
    ],
)
def test_pages_by_hand(page, text):
    assert extract.main_text(page) == text


def test_blocks_and_holes():
    assert extract.surges([0, 5, 0, 0, 7, 0, 0, 0, 90, 0], False) == [(8, 9)]
    assert extract.surges([0, 5, 0, 0, 7, 0, 0, 0, 90, 0], True) == [(1, 5), (8, 9)]
    assert extract.surges([5, 1], False) == [(0, 2)]
    assert extract.surges([], True) == []


@pytest.mark.parametrize("broken", ['<a "', "<", "<!--", "<p><b>", "<li><b>", "<nav><h1>", "<script>", "<div>", "</div>", "&#"])
def test_time_grows_with_the_page(broken):
    start = time.process_time()
    extract.main_text(broken * 40_000)
    assert time.process_time() - start < 10


def test_clashing_columns_and_empty_table(spark):
    rows = [(1, "<article><p>x</p></article>", "t", 5), (1, "<article><p>x</p></article>", "t", 5), (None, None, None, None)]
    df = spark.createDataFrame(rows, "k0 long, html string, text string, n_chars int")
    got = extract.extract_pages(df, keep=("k0",)).collect()
    assert sorted([(r.k0, r.text, r.n_chars) for r in got], key=str) == [(1, "x", 1), (1, "x", 1), (None, "", 0)]
    assert extract.extract_pages(df.limit(0), keep=("k0",)).count() == 0
