import html
import re

import pytest

from tideline.llm import html_text, queries
from tideline.llm.html_text import extract

LONG = "This is the long text of the article, and it has all of the words that it needs to be good."


def test_registered_query_gives_the_article(spark, data):
    pages = {r.page_id: r.html for r in spark.read.parquet(f"{data}/pages.parquet").collect()}
    rows = queries.op8_html_text(spark, data).collect()
    assert len(rows) == len(pages)
    for r in rows:
        article = re.search(r"<article>(.*?)(</article>|\Z)", pages[r.page_id], re.DOTALL)[1]
        parts = re.split(r"</?(?:p|h1)>", article.replace("<br>", " "))
        plain = (" ".join(html.unescape(re.sub(r"<[^>]*>", "", p)).split()) for p in parts)
        assert r.text == "\n\n".join(p for p in plain if p)
        assert r.n_chars == len(r.text)


@pytest.mark.parametrize(
    "page, text",
    [
        (None, ""),
        ("", ""),
        ("plain", "plain"),
        ("<p>a&amp;b &lt;c&gt; &#233;&nbsp; d\n\te</p>", "a&b <c> é d e"),
        (f"<nav><a href=x>{LONG}</a></nav><p>{LONG}</p><footer>{LONG}</footer>", LONG),
        (f"<article><h1>T</h1><p>{LONG}<p>Short.<br>End</article><p>{LONG}", f"T\n\n{LONG}\n\nShort. End"),
        (f'<div class="ad">{LONG}</div><div id="cookie-notice">{LONG}</div><p>{LONG}</p>', LONG),
        (f"<p>{LONG}</p><form><p>{LONG}</p><button>Go</button></form>", LONG),
        (f'<article><p>{LONG}</p><div class="comments"><p>{LONG}</p></div></article>', LONG),
        (f"<script>if (a<b) '</p>'</script><style>p{{}}</style><p>{LONG}</p><!-- <p>{LONG}</p> -->", LONG),
        (f"<p>{LONG} <b>bold<i>x</b></i> <span class='share'>Share</span></p>", f"{LONG} boldx"),
        (f"<header><h1>Site</h1></header><main><header><h1>Title</h1></header><p>{LONG}</p></main>", f"Title\n\n{LONG}"),
        (f"<p>{LONG}</p><div style='display: none'>{LONG}</div><p hidden>{LONG}</p>", LONG),
        (f"<ul><li><a href=a>One of the links</a><li><a href=b>Other</a></ul><p>{LONG}</p>", LONG),
        (f"<body class='has-sidebar'><div id=main-content><p>{LONG}</p></div><aside>{LONG}</aside>", LONG),
        (f"<div class='layout with-sidebar'><p>{LONG}</p><div class=topnav>{LONG}</div></div>", LONG),
        (f"<div class='page sidebar-right'><main><p>{LONG}</p></main><ul class=commentlist><li>{LONG}</ul></div>", LONG),
        (f"<head><title>x</title><body><p>{LONG}</p><nav>{LONG}", LONG),
        (f"<nav><ul><li>{LONG}<article><p>{LONG}</p></article>", LONG),
        (f"<p>{LONG}</p><script>never closed <p>{LONG}</p>", LONG),
        (f"<table><tr><td>{LONG}</td><td>b</td></tr></table>", f"{LONG} b"),
        ("<article><p>Tiny.</p><p>Also tiny.</p></article><footer>x</footer>", "Tiny.\n\nAlso tiny."),
        ("<p a='>'>x</p><p b=\"unclosed>y</p>", "x\n\ny"),
    ],
)
def test_pages(page, text):
    assert extract(page) == text


def test_short_blocks_take_the_label_of_the_nearer():
    found = html_text.blocks(f"<div><p>{LONG}</p><p>Near.</p></div><div><p>Mid</p><p><a>{LONG}</a></p></div>")
    assert html_text.label(found) == [True, True, False, False]


def test_unknown_languages_are_judged_without_stop_words():
    text = "Lorem ipsumque dolorem sitamet consectetuer adipiscingque elitsed diamnonummy nibheuismod tincidunt"
    assert extract(f"<nav>{text}</nav><p>{text}</p>") == text


@pytest.mark.parametrize(
    "page",
    [
        "<div>" * 100_000 + "<b>y</b></i>" * 100_000,
        "<nav><article>x" * 50_000,
        "<b class=ad>y" * 100_000 + "<p>" * 100_000,
        "<span hidden>x" * 100_000 + "</span>" * 100_000,
    ],
)
def test_open_elements_cost_nothing_per_tag(page):
    import time

    began = time.perf_counter()
    html_text.blocks(page)
    assert time.perf_counter() - began < 2


def test_densities_decide_where_no_name_tells():
    """No article element, no class or id, only lengths, links and stop words."""
    links = "".join(f"<li><a href=/{w}>{w} {w}</a></li>" for w in "home world sport money weather travel".split())
    more = "".join(f"<div><a href=/{i}>Another headline of some length that is a link number {i}</a></div>" for i in range(6))
    body = "".join(f"<div><p>{LONG}</p></div>" for _ in range(4))
    page = f"<html><body><div><ul>{links}</ul></div><div>{body}</div><div>{more}</div><div>&copy; 2024 all of it</div></body></html>"
    assert extract(page) == "\n\n".join([LONG] * 4)


@pytest.mark.parametrize("page", ["<a \"" * 30_000, "<div>" * 30_000 + "x", "<!--" * 30_000, "<p><b>" * 20_000, "&" * 99_999])
def test_time_follows_length(page):
    import time

    began = time.perf_counter()
    extract(page)
    assert time.perf_counter() - began < 5


def test_edges(spark):
    rows = [(1, None, None), (2, "u", ""), (None, "u", "<p>x"), (2, "u", "")]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string").selectExpr("*", "'k' as text")
    found = html_text.main_text(pages).collect()
    assert sorted((str(r.page_id), r.text) for r in found) == [("1", ""), ("2", ""), ("2", ""), ("None", "x")]
    assert html_text.main_text(pages.limit(0)).count() == 0
