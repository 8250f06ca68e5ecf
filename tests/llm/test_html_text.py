"""Main text of pages: by rule on the given pages, and page furniture of all kinds."""

import html
import re
import time

import pytest

from pricewright.llm import html_text as H, queries
from pricewright.llm.html_text import main_text

ARTICLE = "<article><h1>Title</h1><p>First, with commas, and more words in it.</p><p>Second &amp; last.</p></article>"
TEXT = "Title\nFirst, with commas, and more words in it.\nSecond & last."
LOUD = "This is loud, long, full of commas, and of no use, to anyone, at all, really."


def test_given_pages(spark):
    pages = queries.table(spark, "/root/testdata/sf0.01", "pages")
    sources = {r["page_id"]: r["html"] for r in pages.collect()}
    for r in H.extracted(pages).collect():
        inner = re.search(r"<article>(.*)</article>", sources[r["page_id"]], re.S)[1]
        inner = re.sub(r"</?b>", "", re.sub(r"</?(?:p|h1)>", "\0", inner).replace("<br>", " "))
        blocks = (re.sub(r"\s+", " ", html.unescape(x)).strip() for x in inner.split("\0"))
        assert r["text"] == "\n".join(x for x in blocks if x) and r["n_chars"] == len(r["text"])


@pytest.mark.parametrize("furniture", [
    f"<nav>{LOUD}</nav>", f"<header><h2>{LOUD}</h2></header>", f"<footer><p>{LOUD}</p></footer>", f"<aside><p>{LOUD}</p></aside>",
    f"<div class='site-header'><p>{LOUD}</p></div>", f'<div id="sidebar"><p>{LOUD}</p><p>{LOUD}</p></div>',
    f"<div class=ad><p>{LOUD}</p></div>", f"<div class='cookie-notice'><p>{LOUD}</p></div>", f"<form><p>{LOUD}</p></form>",
    f"<section id=comments><p>{LOUD}</p><p>{LOUD}</p></section>", f"<article class='comment'><p>{LOUD}</p></article>",
    f"<div id='siteNav'><p>{LOUD}</p></div>", f"<p class='notice'>{LOUD}</p>", f"<ins class=adsense>{LOUD}</ins>",
    f"<div role=navigation><p>{LOUD}</p></div>", f"<div hidden><p>{LOUD}</p></div>", f"<div style='display: none'>{LOUD}</div>",
    f"<script>if (a < b) '<p>{LOUD}</p>'</script>", f"<style>p {{}} {LOUD}</style>", f"<!-- <p>{LOUD}</p> -->",
    f"<noscript>{LOUD}</noscript>", f"<textarea>{LOUD}</textarea>", "<ul class=menu><li><a href=x>Home</a></ul>"])
def test_furniture_goes(furniture):
    assert main_text(f"<html><head><title>T</title></head><body>{furniture}{ARTICLE}{furniture}") == TEXT
    inside = ARTICLE.replace("<p>Second", f"{furniture}<p>Second")
    assert main_text(f"<body><div>{inside}</div></body>") == TEXT
    plain = ARTICLE.replace("article>", "div>")
    assert main_text(f"<body>{furniture}{plain}") == TEXT


def test_tree_scoring_without_an_article():
    links = "<ul>" + "".join(f"<li><a href='/{k}'>Link number {k}, with a comma</a></li>" for k in range(20)) + "</ul>"
    body = "".join(f"<p>Paragraph {k}, with commas, of a length that counts for something.</p>" for k in range(5))
    text = "\n".join(f"Paragraph {k}, with commas, of a length that counts for something." for k in range(5))
    assert main_text(f"<div>{links}</div><div><div>{body}</div></div><div>{links}</div>") == text
    assert main_text(body) == text


PROSE = "<p>Prose of the page, with commas, long enough to count, and to be read by all.</p>"
SAID = "Prose of the page, with commas, long enough to count, and to be read by all."


@pytest.mark.parametrize("names", ["class='content has-sidebar'", "class='post no-sidebar'", "class='page with-header'",
                                   "class='layout--without-sidebar'", "id=searchResults", "class='layout-sidebar-right'"])
def test_wrappers_with_boilerplate_parts_stay(names):
    furniture = f"<div class='sidebar'><p>{LOUD}</p></div><div class='page-header'><p>{LOUD}</p></div>"
    assert main_text(f"<body><div {names}>{furniture}{PROSE}{PROSE}</div></body>") == f"{SAID}\n{SAID}"


def test_named_parts_of_an_article_stay_with_prose():
    for names in ("id='related-work'", "class='search-results'", "class='share-price'"):
        assert main_text(ARTICLE.replace("<p>Second", f"<section {names}>{PROSE}</section><p>Second")) == TEXT.replace(
            "\nSecond", f"\n{SAID}\nSecond")
        menu = "<ul><li><a href=x>A link to one more page of the site</a></ul>"
        assert main_text(ARTICLE.replace("<p>Second", f"<section {names}>{menu}</section><p>Second")) == TEXT
    assert main_text("<article><p>at <span class='share-price'>12 euros</span> a piece</p></article>") == "at 12 euros a piece"
    for names in ("related-posts", "post-comments", "share-buttons", "search-form", "entry-footer"):
        assert main_text(ARTICLE.replace("<p>Second", f"<div class={names}>{PROSE}</div><p>Second")) == TEXT


def test_plain_name_around_nearly_all_prose():
    assert main_text(f"<body><div class='widget'>{PROSE * 5}</div></body>") == "\n".join([SAID] * 5)
    assert main_text(f"<body>{ARTICLE}<div class='widget'>{PROSE * 5}</div></body>") == TEXT
    assert main_text(f"<body><div>{PROSE * 3}</div><div class='comments'>{PROSE * 5}</div></body>") == "\n".join([SAID] * 3)


def test_odd_markup():
    assert main_text(None) == main_text("") == main_text("<p></p>") == main_text("<script>x") == ""
    assert main_text("a < b &lt;b&gt; &#233;") == "a < b <b> é"
    assert main_text("<article><p>a<p>b<ul><li>x<li>y</ul><table><tr><td>1<td>2</table></article>") == "a\nb\nx\ny\n1\n2"
    assert main_text('<p title="a>b">q <a href="u">link</a>\n\t r<br>s</p>') == "q link r s"
    assert main_text("<p>one, <span class='ad'>buy <b>now</b></span>two</p>") == "one, two"
    assert main_text("<div>one<p>two</p>three</div>") == "one\ntwo\nthree"
    assert main_text("<p>" * 3000 + "deep") == "deep"
    assert main_text("<div>" * 3000 + "deep") == "deep"


def test_awkward_rows(spark):
    pages = spark.createDataFrame([(1, "u", None, "x"), (1, None, "", "x"), (None, "u", "<p>t</p>", "x")],
                                  "page_id long, url string, html string, text string")
    got = H.extracted(pages)
    assert sorted((r["text"], r["n_chars"]) for r in got.collect()) == [("", 0), ("", 0), ("t", 1)]
    assert H.extracted(pages.limit(0)).count() == 0


def test_nothing_of_the_content_is_lost():
    head = "<h1>Head line</h1>"
    assert main_text(f"<body>{head}<div>{PROSE}{PROSE}</div></body>") == f"Head line\n{SAID}\n{SAID}"
    assert main_text(f"<body>{head}<div><div>{PROSE}{PROSE}</div></div></body>") == f"Head line\n{SAID}\n{SAID}"
    assert main_text(f"<body><div>{PROSE}{PROSE}</div><p>The end.</p></body>") == f"{SAID}\n{SAID}\nThe end."
    references = "<ul><li><a href=a>Ref one</a></li><li><a href=b>Ref two</a></li></ul>"
    assert main_text(f"<body><div>{PROSE}{PROSE}{references}</div></body>") == f"{SAID}\n{SAID}\nRef one\nRef two"
    assert main_text(f"<body><div>{references}{PROSE}{PROSE}</div></body>") == f"{SAID}\n{SAID}"
    line = "He sold <span class='share'>a share of stock</span> and <b id=notice>a notice</b> came, <i class=ad>Buy!</i>so he left."
    assert main_text(f"<article><p>{line}</p></article>") == "He sold a share of stock and a notice came, so he left."
    assert main_text(f"<body><form action=x><div>{ARTICLE}</div><p>Log in</p></form></body>") == TEXT


@pytest.mark.parametrize("page", ["<a " * 350_000, "<a \"" * 250_000, "</" * 500_000, "<div>word " * 100_000, "</b>" * 250_000,
                                  "<script " * 120_000, "<!-" * 300_000, "<p>" + "<i>" * 100_000 + "x" + "</u>" * 100_000,
                                  "<div class=related>" * 50_000 + PROSE], ids=range(9))
def test_a_megabyte_of_anything_takes_seconds(page):
    began = time.process_time()
    main_text(page)
    assert time.process_time() - began < 5
