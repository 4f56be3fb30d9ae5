"""Main text of pages of many layouts, host consensus, and odd input."""

import html
import re

import pytest

from riskloom.llm import hostpaths as H

PARAGRAPHS = ["The first paragraph of this article says what it is about, in some detail.", "A second one follows, with a <b>bold</b> word &amp; a <a href='/x'>link</a> in it.", "The third ends the article; it is not short either, so that it counts."]
SHOWN = ["The first paragraph of this article says what it is about, in some detail.", "A second one follows, with a bold word & a link in it.", "The third ends the article; it is not short either, so that it counts."]
TITLE = "A title"
P = "".join(f"<p>{p}</p>" for p in PARAGRAPHS)
MENU = "<ul>" + "".join(f'<li><a href="/{w}">{w}</a></li>' for w in ("home", "news", "about us", "contact")) + "</ul>"
NOTICE = "We use cookies on this site to make it work for you, and to count how often it is read."
COMMENTS = "".join(f"<div class='comment-body'><p>I think number {i} is a long comment on this text by a reader.</p></div>" for i in range(9))
LAYOUTS = {
    "article": f"<nav>{MENU}</nav><article><h1>{TITLE}</h1>{P}</article><footer>&copy; someone</footer>",
    "div names": f"<div id='header'><h1>Site</h1></div><div class='menu-12'>{MENU}</div><div class='post-77'><h1>{TITLE}</h1>{P}</div><div class='sidebar'><p>{NOTICE}</p></div><div id='footer'>x</div>",
    "main": f"<header>Site {MENU}</header><main><h1>{TITLE}</h1>{P}<section class='comments'>{COMMENTS}</section></main><aside><p>{NOTICE}</p></aside>",
    "no names": f"<div>{MENU}</div><div class='c1'><h1>{TITLE}</h1>{P}</div><div class='c2'>{MENU}</div>",
    "title outside": f"<div class='c0'><h1>{TITLE}</h1><div class='c1'>{P}</div></div><div>{MENU}</div>",
    "sections": f"<div class='c1'><h1>{TITLE}</h1><section><p>{PARAGRAPHS[0]}</p></section><section><p>{PARAGRAPHS[1]}</p></section><section><p>{PARAGRAPHS[2]}</p></section></div><div>{MENU}</div>",
    "header kept": f"<header><h1>Site</h1></header><article><header><h1>{TITLE}</h1></header>{P}<footer>by me</footer></article>",
    "table": f"<table><tr><td>{MENU}</td><td><h1>{TITLE}</h1>{P}</td></tr></table>",
    "unclosed": f"<nav>{MENU}</nav><article><h1>{TITLE}</h1><p>{'<p>'.join(PARAGRAPHS)}",
    "inside": f"<article><h1>{TITLE}</h1><div class='ad'>Buy now and save a lot of money on everything.</div>{P}<form><label>Name</label><input></form><div class='cookie-notice'>{NOTICE}</div><div class='share-buttons'>{MENU}</div><button>More</button></article>",
    "form around": f"<form id='aspnet'><div class='nav'>{MENU}</div><article><h1>{TITLE}</h1>{P}</article></form>",
    "comments": f"<article><h1>{TITLE}</h1>{P}</article><div id='comments'><article class='comment'>{COMMENTS}</article></div>",
    "scripts": f"<script>var a='<p>no</p>';</script><style>p{{x:1}}</style><article><h1>{TITLE}</h1><!-- <p>no</p> -->{P}<noscript><p>no</p></noscript><svg><text>no</text></svg></article>",
    "wrapped": f"<div class='content has-sidebar'><div class='breadcrumbs'>{MENU}</div><h1>{TITLE}</h1>{P}</div>",
}


@pytest.mark.parametrize("name", LAYOUTS)
def test_layouts(name):
    page = f"<!DOCTYPE html><html><head><title>x</title></head><body>{LAYOUTS[name]}</body></html>"
    assert H.extract(page, [])[0] == "\n".join([TITLE, *SHOWN])


def test_white_space_references_and_odd_markup():
    assert H.extract("<article><p> a\n\tb&nbsp;c &lt;d&gt; &#233;&eacute; &unknown; x < y &am</p></article>", [])[0] == "a b c <d> éé &unknown; x < y &am"
    assert H.extract("<div class='x'><p title='a>b'>one<br>two</p><p>it's</div>", [])[0] == "one two\nit's"
    assert H.extract("just text", [])[0] == "just text"
    assert H.extract("", []) == ("", "")
    assert H.extract("<nav><p>only a menu</p></nav>", [])[0] == ""
    assert H.extract('<p a="' * 20_000, [])[0] == ""
    assert H.extract("<div><p>deep and deeper " * 3000, [])[0].count("deep and") == 3000


def test_host_consensus_beats_the_page(spark):
    """Where readers wrote more than the author, other pages of the host tell which container is the article."""
    talk = "".join(f"<p>Reader {i} says that this is a long remark, longer than all.</p>" for i in range(30))

    def page(extra):
        return f"<div class='inner'>{P}</div><div class='rest'>{extra}</div>"

    rows = [(i, f"https://H.example:8080/{i}", page("<p>One remark.</p>")) for i in range(5)] + [(9, "http://h.example/9", page(talk)), (10, "http://other.example/", page(talk))]
    got = {r["page_id"]: r for r in H.main_text(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert got[9]["text"] == "\n".join(SHOWN) and got[9]["path"] == "div.inner"
    assert got[10]["path"] == "div.rest"


def test_given_pages_equal_a_plain_cut(spark):
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    got = {r["page_id"]: r["text"] for r in H.main_text(pages).collect()}
    for r in pages.collect():
        inside = re.search(r"<article>(.*)</article>", r["html"], re.DOTALL)[1]
        parts = [" ".join(html.unescape(re.sub("<[^>]+>", " ", x)).split()) for x in re.split(r"</?(?:h1|p)>", inside)]
        assert got[r["page_id"]] == "\n".join(x for x in parts if x)


def test_odd_rows(spark):
    schema = "page_id long, url string, html string, host string, path string, winners string, text string"
    assert H.main_text(spark.createDataFrame([], schema)).count() == 0
    x = ("x", "x", "x", "x")
    same = (4, "http://a.example/1", f"<article>{P}</article>", *x)
    rows = [(1, None, None, *x), (None, "", "", *x), (3, "not a url", "<p>Some text here.", *x), same, same, (5, "http://a.example/2", "<article><p>" + "word " * 400_000 + "</p></article>", *x)]
    got = H.main_text(spark.createDataFrame(rows, schema)).collect()
    assert sorted((r["page_id"] or 0, r["n_chars"]) for r in got) == [(0, 0), (1, 0), (3, 15), (4, len("\n".join(SHOWN))), (4, len("\n".join(SHOWN))), (5, 1_999_999)]
