"""op3: pages whose text is known, and the registered query over whole pages."""

import re
import tracemalloc
from collections import Counter
from html import unescape

from geots.llm import html_extract, queries

SF = "/root/testdata/sf0.01"
LONG = "A sentence long enough to be content, with several plain words and a full stop at its end."


def test_article_without_what_stands_around_it():
    page = f"""<!DOCTYPE html><html><head><title>Title</title><style>p{{}}</style><script>var a = "<p>no</p>";</script></head><body>
    <header><a href="/">Site</a></header><nav><ul><li><a href="/a">One</a></li></ul></nav>
    <div class="cookie-banner">We use cookies. Accept them all, please, or leave this page at once, thank you very much.</div>
    <article><h1>Head &amp; line</h1><p>{LONG}<br>After   the
    break.</p><p>{LONG} <b>Bold</b> &eacute;&#233;&lt;</p><aside>Related: nothing</aside></article>
    <div class="ad">{LONG}</div><section id="comments"><p>{LONG} I agree!</p></section>
    <form><p>{LONG}</p></form><footer>&copy; us</footer></body></html>"""
    assert html_extract.main_text(page) == f"Head & line\n{LONG} After the break.\n{LONG} Bold éé<"


def test_no_article_element():
    body = "".join(f"<p>{LONG} {i}</p>" for i in range(6))
    page = f'<html><body><div class="menu"><a href="/a">Home</a> <a href="/b">News</a></div><div id="content">{body}<p>Short.</p><p>{LONG} end</p></div><div class="sidebar"><p>{LONG}</p></div></body></html>'
    assert html_extract.main_text(page).split("\n") == [*(f"{LONG} {i}" for i in range(6)), "Short.", f"{LONG} end"]


def test_head_of_the_page_and_of_the_article():
    page = f'<body><div class="site-header"><p>{LONG} site</p></div><div class="story"><div class="story-header"><h1>A headline of this story</h1></div><p>{LONG}</p><p>{LONG} 2</p></div></body>'
    assert html_extract.main_text(page) == f"A headline of this story\n{LONG}\n{LONG} 2"


def test_excluded_elements_in_the_middle_of_a_paragraph():
    inner = ['<span class="share">x</span>', "<script>x()</script>", "<svg><title>x</title><path/></svg>", "<button>x</button>", "<noscript>x</noscript>", '<iframe src="x"></iframe>', '<i aria-hidden="true">x</i>', '<span class="share">x <span>y</span> z</span>']
    for x in inner:
        assert html_extract.main_text(f"<article><p>{LONG} {x} Rest.</p><p>{LONG}</p></article>") == f"{LONG} Rest.\n{LONG}", x
    page = f"<div><noscript><div>{LONG} no</div> no</noscript><p>{LONG} <button><div>no</div> no</button></p><p>{LONG}</p></div>"
    assert html_extract.main_text(page) == f"{LONG}\n{LONG}"


def test_wrappers_with_telling_names():
    side = f'<div class="sidebar"><p>{LONG} side</p></div>'
    for name in ("content-sidebar-wrap", "layout no-sidebar", "with-sidebar", "nav-open"):
        article = f"<article><p>{LONG}</p><p>{LONG} 2</p></article>"
        assert html_extract.main_text(f'<body><div class="{name}">{article}{side}</div></body>') == f"{LONG}\n{LONG} 2", name


def test_broken_and_empty_pages():
    assert html_extract.main_text("") == ""
    assert html_extract.main_text("<html><head><title>x</title></head><body></body></html>") == ""
    assert html_extract.main_text(f"<article><p>{LONG}<p>{LONG}") == f"{LONG}\n{LONG}"
    assert html_extract.main_text(f"<nav><ul><li><a href=x>y</a><article><p>{LONG}</p></article>") == LONG
    assert html_extract.main_text(f"<article><p>{LONG}</p></article><aside><article><p>{LONG} teaser</p></article></aside>") == LONG
    assert html_extract.main_text(f"<p>{LONG} 1 < 2 &amp; 3") == f"{LONG} 1 < 2 & 3"
    assert html_extract.main_text("<" * 5000).count("<") <= 5000


def test_whole_long_text_is_kept():
    page = "<article>" + "".join(f"<p>{LONG} {i}</p>" for i in range(20_000)) + "</article>"
    assert html_extract.main_text(page).count("\n") == 19_999


def test_query_returns_the_articles(spark):
    """The test pages' content is their article; a plain reading of it must give the same text."""
    got = {r["page_id"]: r for r in queries.op3_html_text(spark, SF).collect()}
    pages = spark.read.parquet(f"{SF}/pages.parquet").collect()
    assert len(got) == len(pages)
    for p in pages:
        html = p["html"] or ""
        inside = re.search(r"<article[^>]*>(.*?)</article>", html, re.S)
        bare = re.sub(r"<!--.*?-->|<(script|style|aside|nav|form|footer)\b.*?</\1>", "", inside[1] if inside else "", flags=re.S)
        blocks = re.split(r"</?(?:p|h\d|li|ul|ol|blockquote|div|section|pre|table|tr|header)\b[^>]*>", re.sub(r"<br\s*/?>", " ", bare))
        plain = [" ".join(unescape(re.sub(r"</?[a-z][^>]*>", "", b)).split()) for b in blocks]
        assert got[p["page_id"]]["text"] == "\n".join(filter(None, plain)), p["page_id"]
        assert got[p["page_id"]]["n_chars"] == len(got[p["page_id"]]["text"])


def test_method_finds_the_text_without_article_tags_and_names(spark):
    """With article and main tags and all names taken away, ratios and clusters alone find the text."""
    pages = spark.read.parquet(f"{SF}/pages.parquet").select("html").filter("html is not null").collect()
    hit = found = wanted = 0
    for p in pages:
        want = Counter(html_extract.main_text(p["html"]).split())
        bare = re.sub(r"</?(?:article|main)\b[^>]*>", "", re.sub(r"""\s(?:class|id)=("[^"]*"|'[^']*'|[^\s>]+)""", "", p["html"]))
        got = Counter(html_extract.main_text(bare).split())
        hit, found, wanted = hit + (got & want).total(), found + got.total(), wanted + want.total()
    assert 2 * hit / (found + wanted) >= 0.97


def test_an_article_that_is_a_teaser():
    """Cards in article elements beside a body in a plain element: the body outweighs them."""
    cards = "".join(f"<article><h3>Card {i}</h3><p>{LONG}</p></article>" for i in range(3))
    body = [f"{LONG} {LONG} {LONG} {i}" for i in range(14)]
    page = f"<body><div id=story>{''.join(f'<p>{b}</p>' for b in body)}</div><div>{cards}</div></body>"
    assert html_extract.main_text(page).split("\n") == body


def test_menu_without_a_name_inside_an_article():
    links = "".join(f'<li><a href="/{i}">Another story, number {i}</a></li>' for i in range(6))
    assert html_extract.main_text(f"<article><p>{LONG}</p><ul>{links}</ul><p>{LONG} 2</p></article>") == f"{LONG}\n{LONG} 2"
    one = f'<article><p>{LONG}</p><p><a href="/x">A paragraph that is one link</a></p><p>{LONG} 2</p></article>'
    assert html_extract.main_text(one) == f"{LONG}\nA paragraph that is one link\n{LONG} 2"


def test_words_that_tell_only_beside_words_of_layout():
    for name in ("share-price", "side-effects", "notice-of-intent", "widget-economics", "reply-letter"):
        assert html_extract.main_text(f'<article><p>{LONG}</p><div class="{name}"><p>{LONG} 2</p></div></article>') == f"{LONG}\n{LONG} 2", name
    for name in ("share", "share-bar", "notice", "notice-box", "widget", "side-box", "social-links", "wp-comments", "acme-sidebar", "related-posts"):
        assert html_extract.main_text(f'<article><p>{LONG}</p><p>{LONG} 1</p><div class="{name}"><p>{LONG} 2</p></div></article>') == f"{LONG}\n{LONG} 1", name
    assert html_extract.main_text(f'<article><p>{LONG}</p><div class="share-this-story"><p>Share it</p></div></article>') == LONG


def test_names_that_mean_text_and_lists_of_sources_stay():
    for name in ("navy", "recommendations", "menu-prices", "promotion-of-staff", "advertising-history", "hidden-gems", "modal-verbs", "cookies-recipe", "market-share"):
        page = f'<article><p>{LONG}</p><div class="{name}"><h3>A short head</h3><p>{LONG} 1</p><p>{LONG} 2</p></div><p>{LONG} 3</p><p>{LONG} 4</p></article>'
        assert html_extract.main_text(page).split("\n") == [LONG, "A short head", *(f"{LONG} {i}" for i in range(1, 5))], name
    for name in ("recommendations", "menu-picks"):
        links = "".join(f'<li><a href="/{i}">Another story of this site, with a long title, number {i}</a></li>' for i in range(2))
        assert html_extract.main_text(f'<article><p>{LONG}</p><div class="{name}"><ul>{links}</ul></div><p>{LONG} 2</p></article>') == f"{LONG}\n{LONG} 2", name
    for name in ("ad-slot", "nav-primary", "sr-only", "visually-hidden", "cookie-banner", "main-menu", "comments-thread", "newsletter-signup-box"):
        assert html_extract.main_text(f'<article><p>{LONG}</p><p>{LONG} 1</p><div class="{name}"><p>{LONG} 2</p></div></article>') == f"{LONG}\n{LONG} 1", name
    sources = "".join(f'<li><a href="/{i}">On the history of things, part {i}</a> ({1990 + i})</li>' for i in range(4))
    got = html_extract.main_text(f"<article><p>{LONG}</p><p>{LONG}</p><p>{LONG}</p><h2>Sources</h2><ol>{sources}</ol></article>").split("\n")
    assert got == [LONG] * 3 + ["Sources"] + [f"On the history of things, part {i} ({1990 + i})" for i in range(4)]


def test_depth_costs_memory_and_time_in_proportion():
    n = 50_000
    for head in ("<nav>", '<div class="sidebar">', '<div class="menu-prices">', "<article>", "<i hidden>"):
        page = f"<article><p>{LONG}</p></article>" + head * n + "x" + f"</{re.match(r'<(\w+)', head)[1]}>" * n
        tracemalloc.start()
        text = html_extract.main_text(page)
        peak = tracemalloc.get_traced_memory()[1]
        tracemalloc.stop()
        assert text.startswith(LONG) and peak < 300e6, head


def test_nulls_repeats_and_extra_columns(spark):
    df = spark.createDataFrame([(1, None, "old"), (1, "", "old"), (None, f"<p>{LONG}</p>", None)], "page_id long, html string, text string")
    assert sorted(((r["page_id"] or 0), r["text"]) for r in html_extract.extract(df).collect()) == [(0, LONG), (1, ""), (1, "")]
    assert html_extract.extract(df.limit(0)).count() == 0
