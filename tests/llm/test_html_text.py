import math

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from kerbside.llm import html_text as h

LONG = "A paragraph of the article that is long enough to be taken for content, whatever stands around it."
NOISE = {
    "menu": f'<div class="nav-menu"><ul><li><a href="/">{LONG}</a></li></ul></div>',
    "header": f"<header><p>{LONG}</p></header>",
    "footer": f"<footer>{LONG}</footer>",
    "sidebar": f'<div id="sideBar"><p>{LONG}</p></div><aside>{LONG}</aside>',
    "notice": f'<div class="cookie_notice">{LONG}</div>',
    "advert": f'<div class="ad">{LONG}</div><section class="sponsored">{LONG}</section>',
    "form": f"<form><label>{LONG}</label><textarea>{LONG}</textarea></form>",
    "script": f"<script>var t='</p>{LONG}';</script><style>p{{}}</style><noscript>{LONG}</noscript>",
    "comments": f'<section class="comments"><article class="comment"><p>{LONG} {LONG}</p></article></section>',
}
ARTICLE = f"<h1>Head &amp; line</h1><p>{LONG}</p><p>Short.</p><ul><li>one<li>two</ul><p>{LONG} <b>bold</b> &#233;&nbsp;x<br>y</p>"
WANT = f"Head & line\n{LONG}\nShort.\none\ntwo\n{LONG} bold é x y"


@pytest.mark.parametrize("holder", ["article", "main", 'div class="story"'])
@pytest.mark.parametrize("noise", sorted(NOISE))
def test_noise_goes_and_the_article_stays(holder, noise):
    end = holder.split()[0]
    page = f"<html><head><title>T</title></head><body>{NOISE[noise]}<{holder}>{ARTICLE}</{end}>{NOISE[noise]}</body></html>"
    assert h.main_text(page) == WANT


def test_advert_inside():
    assert h.main_text(f'<article><p>{LONG}</p><div class="advert">buy</div><p>End.</p></article>') == f"{LONG}\nEnd."


@pytest.mark.parametrize(
    "part",
    [
        f'<section id="discussion"><h2>Discussion</h2><p>{LONG}</p><p>Short.</p></section>',
        f'<h2 id="user-login-flow">Login</h2><p>{LONG}</p>',
        f'<h3 id="how-to-share">How to share</h3><p id="notice">{LONG}</p>',
        f'<div class="article-header"><h1>Title</h1></div><p>{LONG}</p>',
        f'<div class="header">Title</div><p class="footer-like toc">{LONG}</p>',
        f'<h2 class="menu-title">Menu</h2><p>{LONG}</p><p>a <span class="search-term">b</span> c</p>',
        f'<div id="discussion"><h2>Discussion</h2><p>{LONG} {LONG}</p><p>Short.</p></div>',
    ],
)
@pytest.mark.parametrize("holder", ["article", "main", "article class='post has-sidebar'"])
def test_marked_words_inside_an_article_do_not_drop_its_text(holder, part):
    import re

    page = f"<body><nav>{LONG}</nav><{holder}><p>{LONG}</p>{part}<p>{LONG}</p></{holder.split()[0]}><footer>{LONG}</footer></body>"
    want = [LONG, *(re.sub("<[^>]*>", "", x) for x in re.split("</(?:p|h.|div|section)>", part)), LONG]
    assert h.main_text(page).split("\n") == [x for x in want if x]


def test_short_marked_parts_of_an_article_stay_out():
    share = '<div class="share"><a href="/">Share</a> this page</div>'
    comments = '<section class="comments"><p>Nice.</p><p>Thanks.</p></section>'
    assert h.main_text(f"<article><p>{LONG}</p>{share}<p>{LONG}</p>{comments}</article>") == f"{LONG}\n{LONG}"


def test_linked_sources_of_a_page_without_an_article_stay():
    sources = "".join(f'<li><a href="/{i}">Source number {i}</a></li>' for i in range(6))
    cells = '<table><tr><td><a href="/t">A linked cell</a></td><td>7</td></tr></table>'
    menu = '<div><ul><li><a href="/">Home page</a></li><li><a href="/n">News page</a></li></ul></div>'
    page = f'<body>{menu}<div class="story"><p>{LONG}</p>{cells}<p>{LONG}</p><h2>Sources</h2><ul>{sources}</ul></div>{menu}</body>'
    want = [LONG, "A linked cell", "7", LONG, "Sources", *(f"Source number {i}" for i in range(6))]
    assert h.main_text(page).split("\n") == want
    assert h.main_text(f"<body>{menu}<p>{LONG}</p><p>{LONG}</p></body>") == f"{LONG}\n{LONG}"


def test_all_articles_with_content_stay():
    page = "<body>" + "".join(f"<article><h2>Part {i}</h2><p>{LONG}</p><p>{LONG}</p></article>" for i in range(3)) + "</body>"
    assert h.main_text(page).count(LONG) == 6
    unequal = f"<body><article>{ARTICLE * 3}</article><article>{ARTICLE}</article><article class='comment'><p>{LONG}</p></article></body>"
    assert h.main_text(unequal) == "\n".join([WANT] * 4)


def test_open_menu_does_not_cover_the_article():
    assert h.main_text(f"<body><nav><ul><li><a>Home</a><article><p>{LONG}</article></body>") == LONG


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet="<>/abp =\"'&;!-\n", max_size=80))
def test_broken_markup(html):
    assert isinstance(h.main_text(html), str)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(0, 400), min_size=1, max_size=30), st.sampled_from([0.5, 1.0, 2.0]))
def test_smoothing_against_its_definition(values, sigma):
    got, reach = h.smooth(np.array(values, float), sigma), max(1, round(3 * sigma))
    for i, found in enumerate(got):
        near = range(max(0, i - reach), min(len(values), i + reach + 1))
        weights = [math.exp(-0.5 * ((j - i) / sigma) ** 2) for j in near]
        assert abs(found - sum(w * values[j] for w, j in zip(weights, near, strict=True)) / sum(weights)) < 1e-9


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(0, 400), min_size=2, max_size=30))
def test_threshold_against_all_cuts(values):
    """The border lies between the means of the two clusters it makes, halfway: one of the cuts that are stable."""
    border = h.threshold(np.array(values, float))
    stable = []
    for cut in sorted(set(values))[1:]:
        low, high = [v for v in values if v < cut], [v for v in values if v >= cut]
        middle = (sum(low) / len(low) + sum(high) / len(high)) / 2
        if max(low) < middle <= min(high):
            stable.append(middle)
    assert border == min(values) if not stable else any(abs(border - m) < 1e-6 for m in stable)


@settings(max_examples=200, deadline=None)
@given(
    st.lists(st.sampled_from(["long", "short", "list", "heading"]), min_size=1, max_size=12),
    st.lists(st.sampled_from(sorted(NOISE)), max_size=6),
    st.lists(st.sampled_from(sorted(NOISE)), max_size=6),
    st.sampled_from(["article", "main"]),
)
def test_made_pages(blocks, before, after, holder):
    """Pages of blocks in any order, whose article is known from how they are made."""
    made = {"long": (f"<p>{LONG}</p>", [LONG]), "short": ("<p>Short&#33;</p>", ["Short!"]), "list": ("<ul><li>one<li>two</ul>", ["one", "two"])}
    made["heading"] = ("<h2>Of\n it</h2>", ["Of it"])
    blocks = ["long", *blocks]
    page = "".join(NOISE[n] for n in before) + f"<{holder}>" + "".join(made[b][0] for b in blocks) + f"</{holder}>" + "".join(NOISE[n] for n in after)
    assert h.main_text(f"<html><body>{page}</body></html>") == "\n".join(line for b in blocks for line in made[b][1])


def test_threshold_and_smoothing():
    assert 1 < h.threshold(np.array([0.0, 1, 0, 9, 10])) < 9
    assert np.allclose(h.smooth(np.ones(7)), 1)


def test_frames(spark):
    rows = [(1, "u", f"<article><p>{LONG}</p></article>", "x"), (2, None, None, "x"), (3, "u", "", "x"), (1, "u", f"<article><p>{LONG}</p></article>", "x")]
    rows += [(4, "u", "<article>" + "<p>word " * 30_000 + "</article>", "x"), (None, None, "plain text", "x")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    out = [tuple(r) for r in h.extract(pages).collect()]
    assert sorted(r[3] for r in out) == [0, 0, len("plain text"), len(LONG), len(LONG), 30_000 * 5 - 1]
    assert h.extract(pages.limit(0)).count() == 0
