"""Page text, URL filters and WARC archives."""

from __future__ import annotations

import hashlib
import html
import re
import time

import duckdb
import pytest

from spanloom.llm import html_text, urls, warc
from spanloom.llm.common import table


def plain_article(page):
    body = re.search(r"(?s)<article>(.*?)</article>", page or "")
    parts = re.split(r"</?(?:p|h1)>", body[1]) if body else []
    return "\n\n".join(x for x in (" ".join(html.unescape(re.sub("</?b>", "", p.replace("<br>", " "))).split()) for p in parts) if x)


def test_article_of_every_page(spark, sf):
    pages = table(spark, sf, "pages")
    got = {r.page_id: r for r in html_text.extract(pages).collect()}
    for p in pages.collect():
        assert got[p.page_id].text == plain_article(p.html) and got[p.page_id].n_chars == len(got[p.page_id].text)


NOISE = '<header><h1>Site name</h1></header><nav><a href="/">Home, sweet home.</a></nav><div class="cookie-notice"><p>We use cookies, as all sites do. You agree.</p></div>'
REST = '<aside class="sidebar"><p>Elsewhere, other things happened. Read on.</p></aside><form><p>Subscribe, please.</p><input></form><section id="comments"><div class="comment"><p>I liked this a lot, really. Thank you, author!</p></div></section><footer>All rights reserved, 2024.</footer>'


@pytest.mark.parametrize("open_, close", [("<article>", "</article>"), ("<main>", "</main>"), ("<div class=post>", "</div>"), ('<div id="content"><div>', "</div></div>"), ('<div role="main">', "")])
def test_templates(open_, close):
    body = "<h2>A &amp; B</h2><p>First paragraph, with&nbsp;some <a href='#'>linked</a>\n text. It goes on.<p>Short.</p><ul><li>One thing<li>Another, too</ul><blockquote>So they said, once.</blockquote><script>var x = '<p>no</p>';</script><div class='ad'>Buy this, now.</div><p>The last paragraph is as long as the first, or nearly so.</p>"
    page = f"<!DOCTYPE html><html><head><title>T</title><style>p{{}}</style></head><body>{NOISE}{open_}{body}{close}{REST}</body></html>"
    assert html_text.main_text(page).split("\n\n") == ["A & B", "First paragraph, with some linked text. It goes on.", "Short.", "One thing", "Another, too", "So they said, once.", "The last paragraph is as long as the first, or nearly so."]


@pytest.mark.parametrize("page", [None, "", "   ", "<", "<p", "<!-- open", "<nav>only a menu</nav>", "<script>x", "</p></div>", "<html><body></body></html>"])
def test_pages_without_content(page):
    assert html_text.main_text(page) in ("", "<", "<p")


def test_long_page():
    assert html_text.main_text("<article>" + "<p>Some words, again and again.</p>" * 20_000 + "</article>").count("\n\n") == 19_999


URLS = [
    "http://Ex.EXAMPLE.net/en/1", "https://example.net/en", "http://a.example.com/de/x?u=http://b.net/", "ftp://x.org/fr/1#t", "no scheme", None, "http://net/", "http://net", "http://www.casino-win.example.org/a.html?q",
    "http://notexample.net/en/1", "://h.example.com/fr/", "http://m.casino-win.example.org/a/", "http://x.net:80/", "http://ÄB.org/fr/", "a://b://c.net/en/", "http://casino-win.example.org?x",
]


def oracle(pages):
    con = duckdb.connect()
    con.execute("CREATE TABLE pages (page_id BIGINT, url VARCHAR)")
    con.executemany("INSERT INTO pages VALUES (?, ?)", pages)
    return sorted(con.sql(urls.ORACLE).fetchall())


def test_urls(spark):
    rows = list(enumerate(URLS)) + [(3, URLS[3])]
    df = spark.createDataFrame([(*r, "x", "y") for r in rows], "page_id long, url string, host string, canonical string")
    got = sorted(map(tuple, urls.judge(df, urls.site_list(df)).collect()))
    assert got == oracle(rows)
    by = {r[0]: r for r in got}
    assert by[0][3:5] == ("example.net/en/", "allow") and by[1][3:5] == ("net/", "block") and by[2][3:5] == ("example.com/de/", "block") and by[3][3:5] == ("org/fr/", "allow")
    assert by[8][4] == "block" and by[8][3] is None and by[7][3] is None
    assert urls.judge(df.limit(0), urls.site_list(df)).count() == 0
    assert urls.judge(df, df.select("url").limit(0)).where("listed").count() == 0


def test_filter_passes_all_listed_and_few_others(spark):
    listed = spark.range(2000).selectExpr("concat('h', id, '/p') AS url")
    pages = spark.range(6000).selectExpr("id AS page_id", "concat('h', id, '/p') AS canonical")
    got = urls.listed_urls(pages, listed)
    assert got.where("listed").count() == 2000 and got.where("listed AND page_id >= 2000").count() == 0
    assert got.where("possible").count() < 2000 + 0.05 * 4000 and got.count() == 6000


def brute_warc(rows):
    first = {}
    for page_id, _, page in rows:
        data = (page or "").encode()
        if len(data) >= 1000:
            first[data] = max(first.get(data, page_id), page_id)
    out = []
    for page_id, _, page in rows:
        data = (page or "").encode()
        to = first.get(data)
        out.append((page_id, len(data), hashlib.sha1(data).hexdigest(), "response" if to in (None, page_id) else "revisit", None if to in (None, page_id) else to))
    return sorted(out, key=str)


def test_archives(spark):
    long_, magic = "é" * 500, "WARC/1.1\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:page:99>\r\nContent-Length: 3\r\n\r\nabc\r\n\r\n"
    pages = [(1, "http://a/", long_), (2, "http://b/\r\nX: y", long_), (3, None, long_), (4, "u", None), (5, "u", ""), (6, "u", magic * 20), (7, "u", "x" + magic), (8, "u", "é" * 499), (9, "u", "é" * 499), (10, "u", "a\r\n\r\n" * 5), (7, "v", "y")]
    df = spark.createDataFrame([(*p, "d") for p in pages], "page_id long, url string, html string, digest string")
    assert sorted(map(tuple, warc.round_trip(df).collect()), key=str) == brute_warc(pages)
    assert warc.round_trip(df.limit(0)).count() == 0


def test_whole_table(spark, sf):
    pages = table(spark, sf, "pages")
    want = brute_warc([(r.page_id, r.url, r.html) for r in pages.collect()])
    assert sorted(map(tuple, warc.round_trip(pages).collect()), key=str) == want


@pytest.mark.parametrize("open_", ['<div class="content with-sidebar">', '<div id="page-header-offset">', '<article class="post tag-social comment-open">', '<div class="post"><div class="wideSidebarLayout">'])
def test_parts_of_names_exclude_no_article(open_):
    body = "<h2>Title</h2><p>The first paragraph, with some words. It goes on.</p><p>The second one, as long as the first. It ends.</p>"
    page = f"<html><body>{NOISE}{open_}{body}</{open_[1:4] if 'div' in open_ else 'article'}>{'</div>' * (open_.count('<') - 1)}{REST}</body></html>"
    assert html_text.main_text(page).split("\n\n") == ["Title", "The first paragraph, with some words. It goes on.", "The second one, as long as the first. It ends."]


@pytest.mark.parametrize("open_, close", [("<article>", "</article>"), ("<div class=post>", "</div>"), ("", "")])
@pytest.mark.parametrize("top", ["", '<a name="top">', '<p><a href="#top">Top</p>'])
def test_links_in_the_article(open_, close, top):
    text = "<p>The first paragraph, with some words. It goes on.</p>"
    body = f'{top}<h2><a href="#s1">Title</a></h2>{text}<h2><a name="s2">Other</a></h2>{text}'
    sources = '<ul><li><a href="/1">A source, linked</a><li><a href="/2">Another</a></ul>' if open_ else ""
    got = html_text.main_text(f"<html><body>{NOISE}{open_}{body}{sources}{text}{close}{REST}</body></html>").split("\n\n")
    line = "The first paragraph, with some words. It goes on."
    assert [x for x in got if x != "Top"] == ["Title", line, "Other", line, *(["A source, linked", "Another"] if open_ else []), line]


@pytest.mark.parametrize("page", ["<div>" * 400_000, "<div>x" * 300_000, "<p>" * 300_000 + "</td>" * 200_000, "<table><td>" + "<section>" * 150_000 + "</p>" * 150_000, "<svg>" * 400_000, "<a href=x>" * 200_000, "<ul><li>" * 200_000])
def test_two_megabytes_of_nested_tags(page):
    began = time.perf_counter()
    html_text.main_text(page)
    assert time.perf_counter() - began < 10


def test_elements_inside_a_line():
    page = "<article><p>Sum <math><mi>x</mi><annotation>x</annotation></math> of <svg><text>no</text></svg>all, <button>Go</button>and more.</p><p>A second paragraph, as long.</p></article>"
    assert html_text.main_text(page) == "Sum x of all, and more.\n\nA second paragraph, as long."


@pytest.mark.parametrize("order", [1, -1])
def test_article_without_a_name(order):
    """Tag paths alone find the article, before and after lists of links and short notes."""
    prose = [f"<p>Paragraph number {i}, with words that go on for a while; it has marks, and it ends.</p>" for i in range(8)]
    article = f"<table><tr><td>{''.join(prose)}</td></tr></table>"
    links = "<div>" + "".join(f"<span><a href='/{i}'>Entry number {i}</a></span>" for i in range(30)) + "</div>"
    got = html_text.main_text(f"<html><body>{''.join([links, article][::order])}</body></html>")
    assert got.split("\n\n") == [html.unescape(re.sub("<.*?>", "", p)) for p in prose]


def test_tables_of_pages(spark):
    rows = [(1, "u", "<article><p>One sentence, and another.</p></article>", "a", 5)] * 3 + [(None, None, None, None, None)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, text string, n_chars int")
    got = html_text.extract(df).collect()
    assert sorted((r.page_id or 0, r.text, r.n_chars) for r in got) == [(0, "", 0)] + [(1, "One sentence, and another.", 26)] * 3
    assert html_text.extract(df.limit(0)).count() == 0
