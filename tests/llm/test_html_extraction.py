"""op9: pages made of known articles and known surroundings."""

import html
import re

import pytest

from prepfold.llm import html_extraction as hx
from prepfold.llm.shared import table

LONG = "Some text of the article that goes on for a while, with a few words more than a menu has. " * 3
BLOCKS = ["The title", LONG.strip(), "Short.", "A & B < C — “quoted”", LONG.strip() + " End."]


def body(blocks=BLOCKS):
    return f"<h1>{blocks[0]}</h1>" + "".join(f"<p>{html.escape(b)}</p>\n" for b in blocks[1:])


AROUND = {
    "menu": '<nav><ul><li><a href="/a">One</a><li><a href="/b">Two</a></ul></nav>',
    "advert": f'<div class="ad">{LONG}</div>',
    "side": f'<aside><p>{LONG}</p></aside><div id="sidebar"><p>{LONG}</p></div>',
    "notice": f'<div class="cookie-notice" role="alert">{LONG}<button>OK</button></div>',
    "form": '<form action="/s"><input name=q><label>Search all of this site now</label></form>',
    "code": '<script>var t="</p><p>' + LONG + '";</script><style>p{margin:0}</style><!-- <p>no</p> -->',
    "comments": f'<section class="comments"><article class="comment"><p>{LONG}</p></article></section>',
    "footer": f"<footer>&copy; {LONG}</footer>",
}


@pytest.mark.parametrize("shape", ["<article>{}</article>", "<main><div class='layout sidebar-right'>{}</div></main>",
                                   '<div class="content">{}</div>', "<div class='sidebar-right'><article>{}</article></div>"])
@pytest.mark.parametrize("name", [*AROUND, None])
def test_article_alone_is_kept(shape, name):
    extra = AROUND.get(name, "".join(AROUND.values()))
    before = "" if name == "comments" else extra
    page = f"<html><head><title>T</title></head><body><header><a href=/>Site</a></header>{before}{shape.format(body())}{extra}</body>"
    if shape.startswith("<main>"):
        page = page.replace("layout sidebar-right", "layout")
    assert hx.main_text(page) == "\n\n".join(BLOCKS)


def test_comments_and_adverts_inside_the_article():
    inner = body().replace("<p>Short.</p>", AROUND["advert"] + "<p>Short.</p>") + AROUND["comments"]
    assert hx.main_text(f"<article><header><h2>Top</h2></header>{inner}</article>") == "\n\n".join(["Top", *BLOCKS])


def test_odd_markup():
    assert hx.main_text("<p>a<br>b&nbsp; c\n d</p><p>e <b>f</b>g</p>") == "a b c d\n\ne fg"
    assert hx.main_text("plain &amp; text &lt;b&gt; <3 a < b") == "plain & text <b> <3 a < b"
    assert hx.main_text('<p>q</p><a title="x > y">r</a> s<p unfinished') == "q\n\nr s"
    assert hx.main_text('<div class="ad">never closed') == "never closed"
    assert hx.main_text("<p>one<p>two<article><p><b>in<br><p>side &#38;amp;") == "in\n\nside &amp;"
    assert hx.main_text("<script>a") == hx.main_text("") == hx.main_text(None) == hx.main_text("<p> &nbsp; </p>") == ""


@pytest.mark.parametrize("name,gone", [("commentList", True), ("adsbygoogle", True), ("advertBox top", True), ("sideBar", True),
                                       ("post has-sidebar", False), ("headline", False), ("adventure", False), ("shared-text", False)])
def test_names(name, gone):
    text = f"<div><p>{LONG}</p><div class='{name}'><p>{LONG}!</p></div></div>"
    assert hx.main_text(text) == LONG.strip() + ("" if gone else f"\n\n{' '.join((LONG + '!').split())}")


def test_stretches_have_surge_and_dive_points():
    assert hx.stretches([0, 0, 0, 90, 0, 5, 0, 0, 0, 7]) == [(1, 6, 95), (7, 10, 7)]
    assert hx.stretches([]) == []


def test_short_stretches_go_where_no_article_is_marked():
    menu = "<div>Home</div>" + "<ul>" + "<li><a href=x>Some longer name of a page</a>" * 4 + "</ul>"
    text = "".join(f"<div><div><p>{html.escape(b)}</p></div></div>" for b in BLOCKS)
    assert hx.main_text(menu + text + menu.removeprefix("<div>Home</div>")) == "\n\n".join(BLOCKS)
    assert hx.main_text(menu + "<h1><a href=y>A title</a></h1>" + text) == "\n\n".join(["A title", *BLOCKS])


def test_an_advert_does_not_cut_short_ends_off():
    text = f"<div><p>{LONG}</p>{AROUND['advert']}<p>Short end.</p></div>"
    assert hx.main_text(text) == f"{LONG.strip()}\n\nShort end."


@pytest.mark.parametrize("shape", ["<article class='post comments-open'>{}</article>", "<div class='entry has-comments'>{}</div>",
                                   "<div class='elementor-widget-text-editor'>{}</div>", "<div class='social-page'>{}</div>",
                                   "<form id='aspnetForm' method=post><div>{}</div></form>",
                                   "<form id='aspnetForm'><article>{}</article></form>"])
def test_an_article_is_not_dropped_with_its_container(shape):
    page = f"<body><header><a href=/>Site</a></header>{AROUND['menu']}{shape.format(body())}{AROUND['footer']}</body>"
    assert hx.main_text(page) == "\n\n".join(BLOCKS)


def test_comments_stay_out_of_pages_without_a_marked_article():
    comments = f"<ol class='comment-list'><li><article class='comment-body'><p>{LONG * 9}</p></article></ol>"
    assert hx.main_text(f"<div class=content>{body()}</div>{comments}") == "\n\n".join(BLOCKS)


def test_a_small_marked_article_is_not_all():
    page = f"<main><p>Only a teaser.</p></main><div class=content>{body()}</div>"
    assert hx.main_text(page) == "\n\n".join(["Only a teaser.", *BLOCKS])


def test_short_ends_and_link_lists_of_the_article_stay():
    links = "".join(f"<li><a href=x>Source {k}</a></li>" for k in range(4))
    menu = "<div>Home</div><div><ul>" + links.replace("Source", "Menu") + "</ul></div>"
    own = [LONG.strip(), *(f"Source {k}" for k in range(4)), "Short closing words."]
    text = f"<div class=content><p>{LONG}</p><ul>{links}</ul><p>Short closing words.</p></div>"
    assert hx.main_text(menu + text + menu) == "\n\n".join(own)
    assert hx.main_text(menu + f"<div><p>{LONG}</p><ul>{links}</ul></div>" + menu) == "\n\n".join(own[:-1])
    parts = f"<div><p>{LONG}</p></div><div><ul>{links}</ul></div><div><p>{LONG}</p></div>"
    assert hx.main_text(menu + parts + menu.removeprefix("<div>Home</div>")) == "\n\n".join([*own[:-1], LONG.strip()])


def test_whole_table(spark):
    pages = {r.page_id: r for r in table(spark, "/root/testdata/sf0.01", "pages").collect()}
    got = hx.op9_html_extraction(spark, "/root/testdata/sf0.01").collect()
    assert len(got) == len(pages)
    for r in got:
        article = re.search(r"<article>(.*)</article>", pages[r.page_id].html, re.S)[1].replace("<br>", " ")
        blocks = [" ".join(html.unescape(re.sub("<[^>]+>", "", b)).split()) for b in re.split("</?(?:p|h1)>", article)]
        assert r.text == "\n\n".join(b for b in blocks if b)
        assert (r.n_chars, r.url) == (len(r.text), pages[r.page_id].url)


def test_edge_rows(spark):
    rows = [(1, None, None, "a"), (1, None, None, "a"), (None, "u", "", None), (3, "v", f"<p>{'word ' * 300_000}</p>", "b")]
    docs = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    got = hx.extract(docs).collect()
    assert [(r.page_id, r.n_chars) for r in got] == [(1, 0), (1, 0), (None, 0), (3, 1_499_999)]
    assert hx.extract(docs.limit(0)).count() == 0
