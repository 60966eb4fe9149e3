"""Main text of pages: against a plain parser on the given pages, broken markup, rules without an article, edge rows."""

import time
from html.parser import HTMLParser

import pytest

from lakepipe.llm.html_text import BlockRules, extract_text, main_text
from lakepipe.llm.queries import QUERIES

SF = "/root/testdata/sf0.01"
LONG = "It was the best of the times that we have had in the town, and all of the people who were there said that they had not been at such a feast before, nor did they think that it would be the last of them."
MID = "This is what the people of the town said to us when we had asked for it."


class ArticleOnly(HTMLParser):
    """All text of the article element, a block at each p, h1 and article tag."""

    def __init__(self):
        super().__init__()
        self.inside, self.blocks = False, [[]]

    def handle_starttag(self, tag, attrs):
        self.inside |= tag == "article"
        if tag in ("p", "h1", "article"):
            self.blocks.append([])
        if tag == "br":
            self.handle_data(" ")

    def handle_endtag(self, tag):
        self.inside &= tag != "article"
        if tag in ("p", "h1", "article"):
            self.blocks.append([])

    def handle_data(self, data):
        if self.inside:
            self.blocks[-1].append(data)


def plain(page):
    parser = ArticleOnly()
    parser.feed(page)
    parser.close()
    return "\n\n".join(t for t in (" ".join("".join(b).split()) for b in parser.blocks) if t)


def test_given_pages(spark):
    pages = {r.page_id: r for r in spark.read.parquet(f"{SF}/pages.parquet").collect()}
    got = QUERIES["op11_html_text"](spark, SF).collect()
    assert sorted(r.page_id for r in got) == sorted(pages)
    for r in got:
        assert r.url == pages[r.page_id].url
        assert r.text == plain(pages[r.page_id].html)
        assert r.n_chars == len(r.text)


def test_parts_that_are_not_the_article():
    page = f"""<html><head><title>t &amp; u</title><style>p {{x: "</p>"}}</style></head><body class="has-sidebar">
    <header><h1>Site</h1><p>{LONG}</p></header><nav><ul><li><a href="/">Home</a></ul></nav>
    <div class="cookie-notice">{LONG}</div><!-- <p>{LONG}</p> -->
    <article><header><h1>Title &eacute; &#8364;</h1><p>By someone</p></header><p>First&nbsp;  one.\n
    <b>Bold</b> text<script>var a = "<p>no</p>";</script>, more.</p><div class="ad-slot"><p>{LONG}</p></div>
    <p>Short.</p><form><input value="x"><label>Your name</label></form><p>a < b &amp; c</p>
    <p>{LONG}</p><aside>{LONG}</aside><ul class="related-links"><li><a href="x">One</a><li><a href="y">Two</a></ul>
    <section id="comments"><article class="comment"><p>{LONG}</p></article></section></article>
    <div class="sidebar">{LONG}</div><footer>&copy; 2020 {LONG}</footer></body></html>"""
    assert main_text(page) == f"Title é €\n\nFirst one. Bold text , more.\n\nShort.\n\na < b & c\n\n{LONG}"


def test_blocks_without_an_article():
    page = f"""<body><div><a href="/">Home</a> <a href="/b">News</a></div><div>Menu</div><h1>A title</h1><p>{LONG}</p>
    <p>Yes.</p><p>{LONG}</p><p>{MID}</p><div><a href="1">Read this next</a> | <a href="2">and that</a></div>
    <div>Terms</div><div>&copy; Someone</div></body>"""
    assert main_text(page) == f"A title\n\n{LONG}\n\nYes.\n\n{LONG}\n\n{MID}"


def test_places_by_class_and_id():
    def kept(markup):
        return main_text(f"<div><p>{LONG}</p>{markup}<p>{LONG}</p></div>") != f"{LONG}\n\n{LONG}"

    for name in ("ad", "top-ad", "AdSlot", "cookieNotice", "site_footer", "main-nav", "post-comments", "comment-list", "left-side", "alert", "page-header"):
        assert not kept(f"<div class='x {name}'>{LONG}</div>") and not kept(f"<div id='{name}'>{LONG}</div>"), name
    for name in ("add", "has-sidebar", "with-ads", "no-nav", "content-sidebar-wrap", "post-header", "lead", "byline", "adventure", "navy"):
        assert kept(f"<div class='x {name}'>{LONG}</div>"), name
    assert not kept(f"<div hidden>{LONG}</div><div style='display: none'>{LONG}</div><p aria-hidden=true>{LONG}</p><div role=banner>{LONG}</div>")
    assert main_text(f"<div id=header><h1>Site</h1></div><p>{LONG}</p>") == LONG
    assert main_text(f"<main><div class=page-header><h1>Title</h1><p>{MID}</p></div><p>{LONG}</p></main>") == f"Title\n\n{LONG}"


def test_open_blocks_follow_the_nearest_decided_ones():
    links = "<div><a href='#'>One link and another of them</a></div>"
    assert main_text(f"{links}<div>Near links</div>{links}<p>{LONG}</p>") == LONG
    assert main_text(f"{links}<div>x</div><div>y</div><p>{LONG}</p>") == f"y\n\n{LONG}"
    # An item of a list of links goes with it, text between two such lists stays.
    items = "<ul><li><a href='#'>One more</a></li><li>and</li><li><a href='#'>Another</a></li></ul>"
    assert main_text(f"<article><p>{LONG}</p>{items}<p>Between.</p>{items}</article>") == f"{LONG}\n\nBetween."
    assert main_text(f"<article><h1>Top</h1>{items}<p>{LONG}</p><h2>See also</h2>{items}</article>") == f"Top\n\n{LONG}"


def test_broken_markup():
    assert main_text("<article><p>one<p>two<div>three</div></article") == "one\n\ntwo\n\nthree"
    assert main_text("<nav><ul><li><a>x</a><article><p>text</article>") == "text"
    assert main_text("<article><p class='a>text</p><p>more</p></article>") == "text\n\nmore"
    assert main_text('<article><p title="1 > 0">text</p></article>') == "text"
    assert main_text("<article>a<br>b<br><br>c &lt;p&gt; &unknown; &#x41;") == "a b\n\nc <p> &unknown; A"
    assert main_text("<article><p>x</p><script>never closed <p>y</p>") == "x"
    assert main_text("<article><table><tr><td>1<td>2<tr><td><ul><li>3<li>4</ul></table></article>") == "1\n\n2\n\n3\n\n4"


@pytest.mark.parametrize("piece", ["<a href='", "<button>x", "<p>word", "&amp;", "<!--", "<div class=\"", "<br>", "<li>", "</p>", "<div></p>", "<ul><li>"])
def test_long_pages_take_linear_time(piece):
    def seconds(n):
        t = time.perf_counter()
        main_text("<article>" + piece * n)
        return time.perf_counter() - t

    seconds(1000)
    assert seconds(80_000) < 40 * max(seconds(8_000), 0.005)


def test_edge_rows(spark):
    rows = [(1, "u", None, "x", 1), (2, None, "", "x", 1), (None, "u", "<p>no words here</p>", None, 1), (3, "u", "<article>twice</article>", "x", 1)]
    rows += [rows[-1], (4, "u", "<article>" + "<p>word</p>" * 30000 + "</article>", "x", 1), (5, "u", "<script>only", "x", 1)]
    got = extract_text(spark.createDataFrame(rows, "page_id int, url string, html string, text string, n_chars int")).collect()
    assert got[0].asDict().keys() == {"page_id", "url", "text", "n_chars"}
    by = sorted((r.page_id or 0, r.text[:5], r.n_chars) for r in got)
    assert by == [(0, "", 0), (1, "", 0), (2, "", 0), (3, "twice", 5), (3, "twice", 5), (4, "word\n", 30000 * 6 - 2), (5, "", 0)]
    empty = spark.createDataFrame([], "page_id long, url string, html string")
    assert extract_text(empty).count() == 0


def test_rules_are_parameters():
    assert main_text(f"<p>{LONG}</p>", BlockRules(stop_high=2.0, stop_low=2.0)) == ""
    assert main_text(f"<p>{LONG}</p>", stop_words=frozenset()) == ""
