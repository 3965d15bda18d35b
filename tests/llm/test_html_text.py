"""HTML extraction: text that must not be lost, malformed pages, and a plain twin of the windows."""

import random
import time

import numpy as np
import pytest

from forgeline.llm import html_text as H

LONG = ("Words of a long paragraph. " * 20).strip()
OTHER = ("Another part of the article follows here. " * 12).strip()


@pytest.mark.parametrize("anchor", ['<a name="top">', "<a id=x>", '<a name="x"/>', '<a href="/x">', "<a>", '<A NAME=top class="href">'])
def test_an_open_anchor_loses_nothing(anchor):
    for page in (f"<body>{anchor}<article><h1>Head</h1><p>{LONG}</p><p>{OTHER}</p></article>", f"<article><h1>Head</h1><p>{anchor}{LONG}</p><p>{OTHER}</p></article>",
                 f"<article><h1>{anchor}Head</h1><p>{LONG}</p><p>{OTHER}</p></article><div><a href=/n>Next</a></div>"):
        text = H.main_text(page)
        assert OTHER in text and (LONG in text or anchor in ('<a href="/x">', "<a>") and f"<p>{anchor}" in page), page[:60]


def test_links_around_blocks_stay_links():
    cards = "".join(f"<a href=/{i}><div><h3>Card {i}</h3><p>A teaser of card {i} that goes on for quite a while here.</p></div></a>" for i in range(6))
    assert H.main_text(f"<div><p>{LONG}</p></div><div>{cards}</div>") == LONG


@pytest.mark.parametrize("name", ["share-prices", "social-policy", "alert-systems", "related-work", "search-results-explained", "hidden-gems", "notice-periods",
                                  "banner-years", "advert-history", "comment-on-the-law"])
def test_subjects_are_no_side_names(name):
    for where in (f'class="{name}"', f'id="{name}"', f'class="part {name}"'):
        page = f"<article><h1>Head</h1><p>{LONG}</p><section {where}><h2>Part</h2><p>{OTHER}</p><p>Short.</p></section></article>"
        assert H.main_text(page) == "\n\n".join(["Head", LONG, "Part", OTHER, "Short."]), where


@pytest.mark.parametrize("name", ["ad", "ad-slot-3", "cookie-notice", "newsletter-signup", "comments", "article-comments", "comment-list", "site-header", "sidebar",
                                  "related-posts", "share-buttons", "social-links", "footer_links", "promo-box", "notice"])
@pytest.mark.parametrize("paragraphs", [1, 30])
def test_side_names_hide_on_short_and_long_pages(name, paragraphs):
    box = f"<div class='{name}'><p>Something beside the article.</p><a href=/s>Go</a></div>"
    page = f"<body><article><h1>Head</h1>{f'<p>{LONG}</p>' * paragraphs}{box}</article>{box}"
    assert H.main_text(page) == "\n\n".join(["Head"] + [LONG] * paragraphs)


def test_hints_are_believed_of_links_and_short_lines():
    links = "".join(f"<p><a href=/{i}>{OTHER}</a></p>" for i in range(4))
    assert H.main_text(f"<article><p>{LONG}</p><div class='related'>{links}</div></article>") == LONG
    assert H.main_text(f"<article><p>{LONG}</p><div class='search'><p>{OTHER}</p></div></article>") == f"{LONG}\n\n{OTHER}"
    assert H.main_text(f"<div class='notice'><p>{LONG}</p></div>") == LONG                # all the page has


def test_short_paragraphs_in_containers_of_their_own():
    page = f"<body><div id=wrap><div><p>Opening.</p></div><div><p>{LONG}</p></div><div><p>Short.</p></div><div><p>Closing.</p></div></div><div>tiny</div></body>"
    assert H.main_text(page) == "\n\n".join(["Opening.", LONG, "Short.", "Closing."])
    page = f"<article><div><p>{LONG}</p></div><p>The end.</p><ul><li><a href=/1>One</a><li><a href=/2>Two</a></ul><div><p>Accept.</p></div></article>"
    assert H.main_text(page) == f"{LONG}\n\nThe end."


def test_deep_and_malformed_pages_take_linear_time():
    def seconds(n):
        page = "<div>" * n + "</span>" * n + f"<p>{LONG}</p>" + "<b><div class=x>" * n + "</i></p>" * n
        began = time.process_time()
        assert LONG in H.main_text(page)
        return time.process_time() - began
    seconds(1000)
    assert seconds(40_000) < 12 * max(seconds(8000), 0.05)
    for page in ("<" * 5000, "<a" * 5000, "<!--" * 2000, "<p class='" * 500, "</" * 3000, "&" * 5000, "<a href=x>" * 5000 + "t", "\x00<p>퟿</p>"):
        assert isinstance(H.main_text(page), str)


def plain_passages(weight):
    """Sum every window, then walk the lines: text runs from a surge to the dive after it."""
    out, within = [], False
    for i, own in enumerate(weight):
        total = sum(weight[i:i + H.WINDOW_LINES])
        if not within and total >= H.SURGE_CHARS and own > 0:
            within = True
        elif within and total < H.DIVE_CHARS:
            within = False
        out.append(within)
    return out


def test_windows_equal_the_plain_twin():
    rnd = random.Random(9)
    for _ in range(300):
        weight = [rnd.choice([0, 0, 1, 5, 19, 20, 30, 79, 80, 200]) for _ in range(rnd.randint(1, 40))]
        assert H.passages(np.array(weight)) == plain_passages(weight)


def test_clashing_columns_and_repeated_rows(spark):
    rows = [(1, "u", f"<p>{LONG}</p>", "text", 5, "x")] * 2 + [(None, None, None, None, None, None)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, text string, n_chars int, place string")
    got = H.extract_text(df.repartition(2)).collect()
    assert sorted((r.page_id or 0, r.text, r.n_chars) for r in got) == [(0, "", 0), (1, LONG, len(LONG)), (1, LONG, len(LONG))]
