"""Main text of pages: hand-written pages, the test table, and hostile markup."""

import html
import re

import duckdb
import pytest

from deltarecon.llm.html_text import Tree, extract, page_report, with_main_text

from tests.conftest import SF_CHECK

LONG = "This is a sentence of the article, with enough words in it to be told from a menu. " * 3
P1, P2, P3 = (f"{n} {LONG}".strip() for n in ("First", "Second", "Third"))
P1_, P2_, P3_ = (" ".join(p.split()) for p in (P1, P2, P3))
LINKS = "".join(f'<li><a href="/{i}">Topic {i}</a></li>' for i in range(8))


def page(body, head="<title>T</title>"):
    return f"<!DOCTYPE html><html><head>{head}</head><body>{body}</body></html>"


NOISE = {
    "menu": f"<nav><ul>{LINKS}</ul></nav>",
    "plain link list": f"<ul>{LINKS}</ul>",
    "menu by class": f'<div class="main-menu"><ul>{LINKS}</ul></div>',
    "header": "<header><h1>The Daily Site</h1><p>Your news, every day, since long ago</p></header>",
    "header by id": "<div id=header><h1>The Daily Site</h1></div>",
    "footer": f"<footer><p>&copy; 2020 The Site. {LONG}</p></footer>",
    "footer by class": f'<div class="site-footer">{LONG}</div>',
    "sidebar": f'<aside><h3>About</h3><p>{LONG}</p></aside>',
    "sidebar by class": f'<div class="sidebar"><p>{LONG}</p><p>{LONG}</p></div>',
    "cookie notice": f'<div id="cookie-banner"><p>We use cookies. {LONG}</p><button>Accept</button></div>',
    "notice by role": f'<div role="alert">{LONG}</div>',
    "advert": f'<div class="ad">{LONG}</div>',
    "form": '<form action="/s"><label>Search the site <input name=q></label><button>Go now</button><select><option>One</select></form>',
    "script": f"<script>var x = '<p>{LONG}</p>';</script><style>p {{ color: red }}</style>",
    "noscript": f"<noscript><p>{LONG}</p></noscript>",
    "hidden": f'<div hidden><p>{LONG}</p></div><div style="display: none"><p>{LONG}</p></div><p aria-hidden=true>{LONG}</p>',
    "comments": f'<section id="comments"><h2>Comments</h2><article class="comment"><p>{LONG * 9}</p></article></section>',
    "comments list": f'<ol class="commentlist"><li><p>{LONG * 5}</p></li><li><article><p>{LONG * 5}</p></article></li></ol>',
    "comment markup": f"<!-- <p>{LONG}</p> --><!--> <!---> <? x ?><!DOCTYPE y></ >",
}


@pytest.mark.parametrize("around", [
    "{n}<article><h1>Title</h1><p>{1}</p><p>{2}</p>{m}<p>{3}</p></article>{n}",
    "{n}<main><article><h1>Title</h1>{m}<p>{1}</p><p>{2}</p><p>{3}</p></article>{n}</main>{n}",
    "<div class=has-sidebar>{n}<div class=post><h1>Title</h1><p>{1}</p><p>{2}</p>{m}<p>{3}</p></div>{n}</div>",
    "<table><tr><td>{n}</td><td><h1>Title</h1><p>{1}</p><p>{2}</p>{m}<p>{3}</p></td></tr></table>",
    "<form id=aspnet>{n}<div><h1>Title</h1><p>{1}</p>{m}<p>{2}</p><p>{3}</p></div>{n}</form>",
    "{n}<div><h1>Title</h1><div><p>{1}</p><p>{2}</p></div>{m}<div><p>{3}</p></div></div>{n}",
    "{n}<h1>Title</h1><p>{1}</p><p>{2}</p>{m}<p>{3}</p>{n}",
])
@pytest.mark.parametrize("kind", sorted(NOISE))
def test_noise_around_and_inside(around, kind):
    body = around
    for mark, text in (("{n}", NOISE[kind]), ("{1}", P1), ("{2}", P2), ("{3}", P3), ("{m}", NOISE[kind] if kind != "comment markup" else "")):
        body = body.replace(mark, text)
    if "<form" in around and "<form" in NOISE[kind]:
        body = body.replace("<form action", "<div class=form><form action").replace("</select></form>", "</select></form></div>")
    assert extract(page(body)) == "\n\n".join(["Title", P1_, P2_, P3_])


def test_header_of_the_article_keeps_its_heading():
    body = f"<article><header><h1>Title</h1><span>By A. Writer, in May</span></header><p>{P1}</p><footer>Filed under x</footer></article>"
    assert extract(page(body)) == f"Title\n\n{P1_}"


def test_short_and_empty_paragraphs_stay():
    body = f"<article><h1>T</h1><p>Be.</p><p></p><p> </p><p>{P1}</p><ul><li>One</li><li>Two <a href=x>here</a></li></ul></article>"
    assert extract(page(body)) == f"T\n\nBe.\n\n{P1_}\n\nOne\n\nTwo here"


def test_one_long_paragraph_doesnt_hide_the_others():
    for tag in ("article", "div"):
        body = f"<{tag}><h1>T</h1><p>{P1}</p><p><b>{LONG * 30}</b></p><p>{P2}</p></{tag}><nav>{LINKS}</nav>"
        assert extract(page(body)) == "\n\n".join(["T", P1_, " ".join((LONG * 30).split()), P2_])


def test_sections_of_an_article_in_plain_divs():
    body = f"<div id=a><div><p>{P1}</p><p>{P2}</p></div><div><p>{P3}</p></div></div><ul>{LINKS}</ul><div>Tiny</div>"
    assert extract(page(body)) == "\n\n".join([P1_, P2_, P3_])


def test_character_references_and_white_space():
    body = f"<article><p>a&amp;b &lt;i&gt; &#65;&#x42; &eacute;&nbsp;x &amp &notanentity; \n\t y<br>z</p><p>{P1}</p></article>"
    assert extract(page(body)) == f"a&b <i> AB é x & ¬anentity; y z\n\n{P1_}"


def test_inline_tags_dont_split_blocks():
    body = f"<article><p>one <b>two</b><i>three</i> <a href=x>four</a>,<span>five</span></p><p>{P1}</p></article>"
    assert extract(page(body)) == f"one twothree four,five\n\n{P1_}"


def test_implied_and_missing_end_tags():
    body = f"<article><h1>T<p><b>{P1}<br><p>{P2}<ul><li>x<li>y</ul><p>{P3}<table><tr><td>c1<td>c2<tr><td>d1</table></article><footer>f"
    assert extract(page(body)) == "\n\n".join(["T", P1_, P2_, "x", "y", P3_, "c1", "c2", "d1"])
    stray = f"<div><article></div></span></p></b><p>{P1}</i></p><b><p>{P2}</b> and more</p></article><ul>{LINKS}</ul></div>"
    assert extract(page(stray)) == f"{P1_}\n\n{P2_} and more"


@pytest.mark.parametrize("text,want", [
    (None, ""), ("", ""), ("   ", ""), ("<", "<"), ("<p", ""), ("a < b", "a < b"), ("plain text", "plain text"),
    ("<p>no end", "no end"), ("<script>x", ""), ("<!-- x", ""), ("<p a='x>y", "y"), ("<p class=x don't>t</p>", "t"),
    ('<p title="a>b">t</p>', "t"), ("<P>Upper</P>", "Upper"), ("<textarea><p>x</p></textarea>", ""), ("\x00<p>a\x00</p>", "\x00\n\na\x00"),
    ("<br><br>", ""), ("</p></div>", ""), ("<svg><text>x</text></svg><p>y</p>", "y"),
])
def test_small_and_broken_pages(text, want):
    assert extract(text) == want


@pytest.mark.parametrize("text", [
    "<div>" * 100_000 + "x", "<b>" * 50_000 + "<p>" * 50_000, "<i></b>" * 50_000, "<a <a <a" * 50_000, "<p class='" * 50_000,
    "</x" * 100_000, "<" * 200_000, "<!--" * 100_000, "&" * 200_000, "<b><div>" + "<i>" * 30_000 + "</b>" * 30_000,
    "<table><td>" * 30_000, "<li><ul>" * 30_000, "<p a=" + "x" * 500_000 + ">y", "<p " + "a " * 200_000 + ">y",
    "<article>" * 20_000 + "x", "<header><h1>" * 5_000,
])
def test_hostile_pages_take_linear_time(text):
    import time
    begun = time.time()
    extract(text)
    assert time.time() - begun < 20


def test_tree_of_nested_elements():
    t = Tree("<div>a<p>b</div>c")
    assert list(zip(t.tag, t.parent, t.last)) == [("#", -1, 5), ("div", 0, 4), ("", 1, 2), ("p", 1, 4), ("", 3, 4), ("", 0, 5)]


def test_articles_of_the_test_table(spark):
    """All its pages have one article of headings and paragraphs, unclosed tags in it."""
    rows = duckdb.sql(f"SELECT page_id, url, html FROM '{SF_CHECK}/pages.parquet'").fetchall()
    got = {r["page_id"]: r for r in page_report(spark.read.parquet(f"{SF_CHECK}/pages.parquet")).collect()}
    assert len(got) == len(rows)
    for i, url, text in rows:
        article = re.search(r"<article>(.*?)</article>", text, re.S)[1]
        blocks = (html.unescape(re.sub(r"<[^>]*>", " ", b)) for b in re.split(r"</?(?:p|h1)>", article))
        want = "\n\n".join(" ".join(b.split()) for b in blocks if b.split())
        assert got[i]["text"] == want and got[i]["url"] == url and got[i]["n_chars"] == len(want)


def test_null_pages_repeats_and_clashing_names(spark):
    rows = [(1, "u", None, "a", 5), (1, "u", f"<p>{P1}", "b", 6), (1, "u", f"<p>{P1}", "b", 6), (None, None, "", None, None)]
    pages = spark.createDataFrame(rows, "page_id int, url string, html string, text string, `row` int")
    got = with_main_text(pages).collect()
    assert sorted(r["text_1"] for r in got) == ["", "", P1_, P1_]
    assert {r["text"] for r in got} == {"a", "b", None} and {r["row"] for r in got} == {5, 6, None}
    assert sorted(r["n_chars"] for r in page_report(pages).collect()) == [0, 0, len(P1_), len(P1_)]
    assert page_report(pages.limit(0)).collect() == []
