"""Main text of pages: what stays, what goes, and broken markup."""

import html
import re

import numpy as np
import pytest

from clientpulse.llm import main_text
from tests.conftest import SF

LONG = "This is a sentence of the article that is long enough to look like content. "


def test_given_pages(spark):
    """In the given pages the article element holds the whole text, one block per heading and paragraph."""
    pages = spark.read.parquet(f"{SF}/pages.parquet").collect()
    for page in pages:
        inner = re.search(r"<article>(.*?)</article>", page.html, re.S)[1].replace("<br>", " ")
        blocks = [" ".join(html.unescape(re.sub(r"<[^>]*>", "", b)).split()) for b in re.split(r"</?(?:p|h1)>", inner)]
        assert main_text.main_text(page.html) == "\n\n".join(b for b in blocks if b)


def test_article_without_the_element():
    page = f"""<html><head><title>t</title><style>p{{}}</style></head><body>
    <header>Site name</header><div class="nav-bar"><a href=x>menu</a></div>
    <div id=wrap><div class="post"><h1>Title &amp; more</h1><p>{LONG * 3}</p><p>Short.</p>
    <ul><li>one<li>two&nbsp;<b>bold</b></ul><div class="ad">Buy &lt;now&gt;</div><p>{LONG}
    <script>var x = "</p>";</script><form><input value=a><p>Your mail</p></form></div>
    <div class="sidebar"><p>{LONG * 2}</p></div><div class="cookie-notice">{LONG}</div>
    <section id="comments"><p>{LONG * 4}</p></section></div><footer>{LONG}</footer></body></html>"""
    assert main_text.main_text(page) == "\n\n".join(
        ["Title & more", (LONG * 3).strip(), "Short.", "one", "two bold", LONG.strip()])


@pytest.mark.parametrize("page,text", [
    (None, ""), ("", ""), ("   ", ""), ("plain words", "plain words"), ("<p>a<p>b", "a\n\nb"), ("<nav>menu</nav>", ""),
    ("<article>one <br> two</article>", "one two"), ("<article><p>x</b></div></p>y", "x\n\ny"), ("<script>never ends", ""),
    ("<p>a &eacute;&#233;&#x1F600; &unknown; & b</p>", "a éé😀 &unknown; & b"), ("<!-- c --><p>z</p><!-- open", "z"), ("<p>a &lt; b</p><div cla", "a < b"),
    ("<main><article><header><h1>H</h1></header><p>t</p></article></main>", "H\n\nt")])
def test_small_and_broken_pages(page, text):
    assert main_text.main_text(page) == text


def test_long_page_is_whole():
    page = "<body><nav>m</nav><div>" + "".join(f"<p>{LONG}{k}</p><p>ok</p>" for k in range(3000)) + "</div>"
    assert main_text.main_text(page).count("\n\n") == 5999


def test_threshold_parts_two_clusters():
    assert main_text.high_cluster(np.array([1.0, 1.2, 9.0, 8.5, 1.1])).tolist() == [False, False, True, True, False]
    assert main_text.high_cluster(np.array([2.0, 2.0])).all() and main_text.high_cluster(np.zeros(0)).size == 0
    flat = main_text.smoothed(np.full(7, 3.0))
    assert np.allclose(flat, 3.0)


def test_table(spark):
    schema = "page_id long, url string, html string, text string, row int"
    pages = spark.createDataFrame([(1, "u", "<p>a</p>", "x", 1), (1, "u", "<p>a</p>", "x", 1), (None, None, None, None, None)],
                                  schema)
    rows = main_text.extracted(pages).collect()
    assert sorted((r.row.page_id or 0, r.row.text or "", r.text) for r in rows) == [(0, "", ""), (1, "x", "a"), (1, "x", "a")]
    assert main_text.extracted(spark.createDataFrame([], schema)).collect() == []


@pytest.mark.parametrize("page,texts", [
    ("<main><p>{0}</p><article><p>{1}</p></article><article><p>{2}</p></article></main>", "012"),
    ("<article><p>{0}</p></article><article><p>{1}</p></article>", "01"),
    ("<article><p>{0}</p><article><p>{1}</p></article><p>{2}</p></article>", "012"),
    ("<body><section><p>{0}</p><p>{1}</p><p>{2}</p></section><section><p>{3}</p><p>{4}</p></section></body>", "01234"),
    ("<body><div><p>{1}</p><ul><li>{0}{0}{0}</ul></div></body>", "1000"), ("<div><p>{1}</p><div>{0}{0}{0}</div></div>", "1000")])
def test_all_regions_stay(page, texts):
    parts = [f"Part {k}. {LONG * 2}" for k in range(5)]
    got = main_text.main_text(page.format(*parts))
    assert re.findall(r"Part (\d)", got) == list(texts)


@pytest.mark.parametrize("page", [
    '<article class="post no-sidebar"><p>{}</p></article>', '<div class="content has-comments"><p>{}</p></div>',
    '<main class="with-sidebar"><p>{}</p></main>', '<article><section id="discussion"><p>{}</p></section></article>',
    '<article><h2 id="search-methods">{}</h2></article>', '<div><section id="related-work"><p>{}</p></section></div>',
    '<div class="sidebar"><main><p>{}</p></main></div>'])
def test_names_that_hold_a_word_stay(page):
    assert main_text.main_text(page.format(LONG)) == LONG.strip()


def test_names_that_mark_other_parts_go():
    page = f"""<main><p>{LONG}</p></main><div class="comment-list"><article class="comment"><p>{LONG * 3}</p></article></div>
    <div class="sidebar-right"><p>{LONG * 3}</p></div><div id="nav-bar">{LONG}</div>"""
    assert main_text.main_text(page) == LONG.strip()


BODY = "".join(f"<p>{'A sentence of the article with enough words to be read. ' * 4}{k}</p>" for k in range(4))
ARTICLE_TEXT = "\n\n".join(("A sentence of the article with enough words to be read. " * 4 + str(k)) for k in range(4))


@pytest.mark.parametrize("extra", [
    '<div class="user-comments"><p>I liked this a lot and say so at length.</p></div>', '<ol class="commentlist"><li>First!</li></ol>',
    '<div class="ad-slot">Buy now</div>', '<div class="google-ad">Buy now</div>', '<div class="advert-300x250">Buy</div>',
    '<ul><li><a href="/">Home</a></li><li><a href="/n">News</a></li></ul>', '<p><a>About</a> <a>Terms</a></p>',
    "<div>Copyright 2026 The Owners</div>"])
def test_parts_beside_the_text_go(extra):
    for page in (f"<article>{extra}{BODY}</article>", f"<article>{BODY}{extra}</article>", f"<div>{extra}{BODY}{extra}</div>"):
        assert main_text.main_text(f"<html><body>{page}</body></html>") == ARTICLE_TEXT


def test_inline_adverts_go_and_links_within_the_text_stay():
    page = f'<article>{BODY}<p>Words before <span class="ad">BUY <span>now</span></span>and after it.</p><ul><li><a>A source</a></li></ul>{BODY}</article>'
    assert main_text.main_text(page) == f"{ARTICLE_TEXT}\n\nWords before and after it.\n\nA source\n\n{ARTICLE_TEXT}"


def test_the_clusters_decide(monkeypatch):
    """Links around the text go because their lines are of the low cluster; with other clusters the result is another."""
    page = f"<div><p><a>Home</a></p><p><a>News</a></p>{BODY}<p><a>Terms</a></p></div>"
    assert main_text.main_text(page) == ARTICLE_TEXT
    monkeypatch.setattr(main_text, "high_cluster", lambda values: np.ones(len(values), bool))
    assert main_text.main_text(page) != ARTICLE_TEXT


def test_deep_nesting_takes_linear_time():
    import time
    for open_, close in (("<div>", "</div>"), ("<div class='x y'>", ""), ("<p><div>", ""), ("<section></b></i></aside>", "")):
        page = open_ * 100_000 + BODY + close * 100_000
        begun = time.perf_counter()
        assert main_text.main_text(page) == ARTICLE_TEXT
        assert time.perf_counter() - begun < 20
