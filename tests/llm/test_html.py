import html as H
import re

import pytest
from conftest import SF_SMALL

from agroframe.llm.html import extract, main_text, smooth, threshold

LONG = "These are the words of a paragraph that goes on for quite a while and says things. " * 4
SHORT = "Be."


def article(inner):
    return (f'<!DOCTYPE html><html><head><title>T</title><style>p{{}}</style><script>var t="</p>";</script></head><body>'
            f'<nav><ul><li><a href="/">Home</a></li></ul></nav><!-- x --><div class="ad">Buy {LONG}</div>{inner}'
            f'<footer>&copy; Foot {LONG}</footer></body></html>')


def flat(s):
    return " ".join(s.split())


@pytest.mark.parametrize("inner", [
    "<article><h1>A &amp; B</h1><p>{L}</p><p>{S}</p></article>",
    "<article><h1>A &amp; B</h1><p><b>{L}<br><p>{S}</article>",
    "<main><div class='post'><h1>A &amp; B</h1><div><p>{L}</p></div><p>{S}</p></div></main>",
    "<div id='c'><h1>A &amp; B</h1><p>{L}</p><p>{S}</p></div>",
    "<div><div class='content'><h1>A &amp; B</h1><p>{L}</p><p>{S}</p></div></div>",
    "<article><h1>A &amp; B</h1><p>{L}</p><form><input><p>Name</p></form><p>{S}</p>"
    "<div class='comments'><p>I think {L}</p></div></article><aside><p>{L}</p></aside>",
    "<header><h2>Site</h2></header><article><header><h1>A &amp; B</h1></header><p>{L}</p><p>{S}</p></article>"
    "<section id='comments'><article class='comment'><p>{L}</p></article></section><div class='cookie-notice'>{L}</div>",
    "<nav><a href='/'>unclosed<article><h1>A &amp; B</h1><p>{L}</p><p>{S}</p></article>",
])
def test_article_only(inner):
    assert main_text(article(inner.replace("{L}", LONG).replace("{S}", SHORT))) == flat(f"A & B {LONG} {SHORT}")


@pytest.mark.parametrize("times", [1, 4, 40])
@pytest.mark.parametrize("inner", [
    "<h1>Head</h1><p>lead</p><div><p>{B}</p><p>{B}</p></div>",
    "<div><p>{B}</p><p>{B}</p></div><div><h2>Head</h2><p>A short section.</p><p>Its end.</p></div>",
    "<h1><a href='/x'>Head</a></h1><div><p>{B}</p></div><p>After.</p>",
    "<div><h1>Head</h1><p>By Ann</p></div><div><div><p>{B}</p><h2>Sub</h2><p>{B}</p></div><p>Note.</p></div>",
    "<article><p>{B}</p><p>{B}</p></article><article><h2>Head</h2><p>" + LONG + "</p></article><article><p>Few words.</p></article>",
])
def test_nothing_beside_the_long_text_is_lost(inner, times):
    body = inner.replace("{B}", LONG * times)
    assert main_text(f"<html><body>{body}</body></html>") == flat(re.sub("<[^>]*>", " ", body))


@pytest.mark.parametrize("inner", [
    "<div class='content no-sidebar'><h1>Head</h1><p>{L}</p></div>",
    "<div class='layout has-banner'><main><h1>Head</h1><p>{L}</p></main></div>",
    "<div id='share-wrapper'><article><h1>Head</h1><p>{L}</p></article></div>",
    "<article class='post category-social'><p>{L}</p></article><article class='post tag-comments'><p>{L}</p></article>",
    "<article><h1>Head</h1><div class='entry social-post'><p>{L}</p><p>{L}</p></div></article>",
    "<article><p>{L}</p></article><div id='share-wrapper'><div class='layout-banner'><article><p>{L}</p></article></div></div>",
    "<div class='widget'><div class='banner-page'><h1>Head</h1><p>{L}</p><p>{L}</p></div></div>",
    "<div class='ads-free'><p>{L}</p></div>",
])
def test_class_words_do_not_empty_the_page(inner):
    body, ad = inner.replace("{L}", LONG), "<div class='ad'>Buy</div>"
    want = flat(re.sub("<[^>]*>", " ", body))
    assert main_text(f"<html><body>{body}</body></html>") == want
    assert main_text(f"<html><body>{body.replace('</p>', '</p>' + ad, 1)}<nav>Menu {LONG * 9}</nav>{ad}</body></html>") == want


def test_comments_stay_out_of_the_article():
    talk = f"<div id='comments'><article class='comment'><p>{LONG * 9}</p></article></div>"
    assert main_text(f"<article><h1>Head</h1><p>{LONG}</p>{talk}</article>") == flat(f"Head {LONG}")


@pytest.mark.parametrize("block", [
    "<div id='comments'>{M}</div>", "<ol class='commentlist'><li>{M}</ol>", "<div class='sidebar'>{M}</div>",
    "<div class='widget-area'>{M}</div>", "<div class='left-side-bar'>{M}</div>", "<div class='ad'>{M}</div>",
    "<div class='cookie-banner'>{M}</div>", "<div class='news-letter-box'>{M}</div>", "<section class='sidebar-container'>{M}</section>",
    "<div class='comments-wrapper'><article class='comment'>{M}</article></div>", "<div id='comments'><article>{M}</article></div>",
    "<div class='popup-content'>{M}</div>", "<div class='notice'>{M}</div>",
])
def test_long_blocks_of_no_content_stay_closed(block):
    block = block.replace("{M}", f"<p>{LONG * 5}</p>" * 5)
    body = f"<div id='content'><h1>Head</h1><p>{LONG}</p></div>"
    assert main_text(f"<body>{body}{block}</body>") == flat(f"Head {LONG}")
    assert main_text(f"<body><article><h1>Head</h1><p>{LONG}</p>{block}</article></body>") == flat(f"Head {LONG}")


def test_pages_of_no_content_are_empty():
    for name in ("cookie-banner", "ad", "comments", "sidebar", "newsletter"):
        assert main_text(f"<body><div class='{name}'><p>{LONG}</p></div></body>") == ""


@pytest.mark.parametrize("name", ["content-sidebar-wrap", "sidebar-layout", "page-with-sidebar", "site has-popup"])
def test_frames_named_after_their_parts_are_open(name):
    page = f"<body><div class='{name}'><main><h1>Head</h1><p>{LONG}</p></main><div class='sidebar'>{LONG * 9}</div></div></body>"
    assert main_text(page) == flat(f"Head {LONG}")


@pytest.mark.parametrize("unit", ["<div>", "<li>x<ul>", "<div>x", '<a b="', "<p><button><div>", "<!--", "<![CDATA[", "<table><td>x", "</p>",
                                  "<b><i>", "<a href='x'>y", "&#", "<script>", "<div class='ad'>x", "<dl><dt>x", "<x y='"])
def test_linear_time_on_deep_and_broken_pages(unit):
    import time
    for end in ("", ">", '">', "'>", "-->"):
        took = []
        for n in (5_000, 20_000):
            start = time.process_time()
            main_text(unit * n + end)
            took.append(time.process_time() - start)
        assert took[1] < max(0.6, 9 * took[0]), (end, took)


def test_a_hundred_thousand_nested_tags():
    import time
    start = time.process_time()
    assert main_text("<div>" * 100_000 + "text").strip() == "text"
    assert time.process_time() - start < 3


def test_lists_of_links_beside_the_text_go():
    links = "".join(f"<li><a href='/{i}'>Page {i}</a></li>" for i in range(6))
    page = f"<body><ul>{links}</ul><h1>Head</h1><div><p>{LONG}</p><p>{LONG}</p></div><div><ul>{links}</ul></div></body>"
    assert main_text(page) == flat(f"Head {LONG} {LONG}")
    cards = "<article><a href='/a'>Other story</a></article>" * 8
    assert main_text(f"<main><p>{LONG}</p><p>{LONG}</p></main><p>x</p>" + cards).startswith(flat(f"{LONG} {LONG}"))
    assert main_text(f"<article><p>{LONG}</p><p>{LONG}</p><p>.</p><p>.</p><p>.</p></article>{cards}").count("Other") == 0


def test_blocks_and_references():
    page = "<article><p>a<b>b</b>c&nbsp;&#100; \n e<br>f</p>g<ul><li>h<li>i</ul><![CDATA[x]]><p hidden>no</p></article>"
    assert main_text(page) == "abc d e f g h i"


@pytest.mark.parametrize("page", [None, "", " ", "<", "<p", "<!--", "<![if x]>", "<script>", "</article>", "&", "<a<b"])
def test_broken_pages(page):
    assert isinstance(main_text(page), str)


def test_plain_text_and_menus_only():
    assert main_text("just words") == "just words"
    assert main_text("<nav><a href='/'>Home</a></nav>") == ""


def test_smoothing_and_threshold():
    import numpy as np
    assert np.allclose(smooth(np.ones(5)), 1)
    assert 1 < threshold(np.array([1.0, 1.0, 9.0, 10.0])) < 9


def test_all_pages(spark):
    """Against a plain reading of the generated pages, whose article is one element."""
    rows = spark.read.parquet(f"{SF_SMALL}/pages.parquet").collect()
    got = {r.page_id: r for r in extract(spark.read.parquet(f"{SF_SMALL}/pages.parquet")).collect()}
    assert len(got) == len(rows)
    for r in rows:
        body = re.search(r"<article>(.*?)</article>", r.html, re.S)[1]
        want = flat(H.unescape(re.sub(r"<(?!/?b>)[^>]*>", " ", body).replace("<b>", "").replace("</b>", "")))
        assert got[r.page_id].text == want
        assert got[r.page_id].n_chars == len(want)


def test_nulls_and_extra_columns(spark):
    df = spark.createDataFrame([(None, None, None, "t"), (1, "u", "", "t"), (1, "u", "", "t")],
                               "page_id long, url string, html string, text string")
    assert sorted(map(tuple, extract(df).collect()), key=repr) == [(1, "u", "", 0), (1, "u", "", 0), (None, None, "", 0)]
    assert extract(df.limit(0)).count() == 0
