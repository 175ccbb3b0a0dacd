"""Main text of pages."""

import pytest

from editsieve.llm import html

LONG = "A paragraph of the article that goes on for a while, with enough words to be dense text."
PAGES = [
    ("", ""),
    ("just text", "just text"),
    (f"<p>{LONG}<p>Short.", f"{LONG}\n\nShort."),
    ("<title>t</title><script>var a='</p>'</script><style>p{}</style><article><h1>T &amp; U</h1><p>a\n b&nbsp;c</p></article>", "T & U\n\na b c"),
    (
        f"<nav><a href=x>Menu one</a></nav><div class=content><h2>Head</h2><p>{LONG}</p><p>x</p></div>"
        f"<div id=sidebar><p>{LONG}</p></div><footer>f</footer>",
        f"Head\n\n{LONG}\n\nx",
    ),
    (
        f"<header>site</header><div class='cookie-notice'>{LONG}</div><main><header><h1>T</h1></header><p>{LONG}</p><ul><li>i</li>"
        f"<li>j</li></ul><aside>a</aside><div class=advert>{LONG}</div><section class=comments><p>{LONG}</p></section></main>"
        "<form>f <input></form>",
        f"T\n\n{LONG}\n\ni\n\nj",
    ),
    (
        f"<div class='page has-sidebar'><div class=header>h</div><div class='entry-content'><p>{LONG}</p><blockquote>q</blockquote>"
        f"</div><div class='post-comments'>{LONG} {LONG}</div></div>",
        f"{LONG}\n\nq",
    ),
    ("<article><p><b>open <i>tags<p>next</article><p>after", "open tags\n\nnext"),
    ("<article>a<br>b<br/>c</article>", "a b c"),
    ("<!-- only --><nav>n</nav>", ""),
    ("<article><table><tr><td>x<td>y</table></article>", "x\n\ny"),
    ("<article>&lt;b&gt; &#x41;&#66; &hellip; &unknown;</article>", "<b> AB … &unknown;"),
]


@pytest.mark.parametrize("page,text", PAGES)
def test_main_text(page, text):
    assert html.main_text(page) == text


WRAPPED = [
    *[
        (f"<div class='{name}'><nav>n</nav><article><h1>T</h1><p>{LONG}</p></article><div class=sidebar>s</div></div>", f"T\n\n{LONG}")
        for name in ("page-with-sidebar", "layout-sidebar-right", "widget-content", "search-results-page", "comments-enabled")
    ],
    (f"<body><form id=aspnetForm><div class=text><p>{LONG}</p><p>x</p></div><div class=advert>a</div></form></body>", f"{LONG}\n\nx"),
    (f"<div class=widget-content><p>{LONG}</p></div><p>f</p><div class=comments>{LONG} {LONG} {LONG}</div>", LONG),
    # teasers, comments and notices stay out, however long
    (f"<div class=text><p>{LONG}</p></div><div class=related><article>{LONG}</article></div>", LONG),
    (f"<div class=text><p>{LONG}</p></div><article class=comment>{LONG} {LONG}</article>", LONG),
    (f"<main><p>{LONG}</p></main><form>{LONG} {LONG} {LONG}</form>", LONG),
    (f"<article><p>{LONG} <span class=share>s <b>t</b></span> end</p></article>", f"{LONG} end"),
]


@pytest.mark.parametrize("page,text", WRAPPED)
def test_wrappers_that_hold_the_page_come_back(page, text):
    assert html.main_text(page) == text


MENU = "<div><ul><li><a href=a>Home</a><li><a href=b>News of the day</a></ul></div>"
SHORT = "".join(f"<p>s{k}</p>" for k in range(9))
UNNAMED = [
    (f"<div class=content><section><p>{LONG * 19}</p></section><section><p>{LONG}</p></section></div>", f"{LONG * 19}\n\n{LONG}"),
    (f"{MENU}<h1>Title</h1><div class=body><p>{LONG}</p></div>{MENU}", f"Title\n\n{LONG}"),
    (
        f"<div><div><p>{LONG}</p><p>{LONG}</p></div><div>{SHORT}</div><div><p>{LONG}</p></div></div>",
        "\n\n".join([LONG, LONG, *(f"s{k}" for k in range(9)), LONG]),
    ),
    (f"{MENU}<div><p>{LONG}</p><p><a href=x>Source</a></p></div>", f"{LONG}\n\nSource"),
    (f"{MENU}{MENU}", "Home\n\nNews of the day\n\nHome\n\nNews of the day"),
]


@pytest.mark.parametrize("page,text", UNNAMED)
def test_all_regions_of_an_unnamed_article_are_kept(page, text):
    assert html.main_text(page) == text


def test_table_with_nulls_and_clashing_columns(spark):
    rows = [(1, "u", "<p>a</p>", 1), (None, None, None, 2), (1, "u", "<p>a</p>", 1), (2, "u", "<p>" + "w " * 200_000, 3)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, text int")
    got = sorted((r["page_id"] or 0, len(r["text"])) for r in html.extract(pages).collect())
    assert got == [(0, 0), (1, 1), (1, 1), (2, 399_999)]
    assert html.extract(pages.limit(0)).collect() == []


def test_smoothing_and_regions():
    import numpy as np

    ratio = np.array([1.0, 1, 80, 90, 5, 85, 1, 1])
    assert html.smooth(np.full(5, 3.0)) == pytest.approx(np.full(5, 3.0))
    (region,) = [r for r in html.regions(html.smooth(ratio)) if r[1] - r[0] > 1][:1]
    assert region[0] in (1, 2) and region[1] in (6, 7)
