"""Main text of web pages by line-block distribution.

Markup is stripped into lines, one a block; lines of menus, adverts, forms and the like are left
out.  The lengths of the lines are summed over sliding windows.  Where the sums surge above a
threshold text starts, where they dive to almost nothing it ends, and all lines between are kept.
A short line outside these passages is kept too if it lies in the same container as a kept one.
"""

from __future__ import annotations

import html as entities
import re
from collections import Counter
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from forgeline.llm.common import table

WINDOW_LINES = 3
SURGE_CHARS = 80              # a window with as much text starts a passage
DIVE_CHARS = 20               # a window with less ends it
ARTICLE_BONUS = 20            # a line in an article element counts for so many more, or double if that is less
ARTICLE_ELEMENTS = {"article", "main"}

# elements whose content is no text of the page
RAW_ELEMENTS = {"script", "style", "title", "textarea", "noscript", "template", "svg", "iframe", "select", "object", "math"}
# elements that hold no part of an article
SIDE_ELEMENTS = {"nav", "footer", "aside", "form", "menu", "dialog", "button"}
BLOCK_ELEMENTS = {"address", "article", "aside", "blockquote", "body", "caption", "center", "dd", "details", "dialog", "dir", "div", "dl", "dt",
                  "fieldset", "figcaption", "figure", "footer", "form", "h1", "h2", "h3", "h4", "h5", "h6", "header", "hr", "html", "legend",
                  "li", "main", "menu", "nav", "ol", "option", "p", "pre", "section", "summary", "table", "tbody", "td", "tfoot", "th",
                  "thead", "tr", "ul"}
# elements that hold lines together; all others belong to the container around them
CONTAINER_ELEMENTS = {"html", "body", "div", "section", "center", "td", "th", "fieldset", *ARTICLE_ELEMENTS}
VOID_ELEMENTS = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
# a start tag of the same kind (or of any block, for p) ends these without an end tag
SELF_ENDING = {"p": BLOCK_ELEMENTS, "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "td": {"td", "th", "tr"}, "th": {"td", "th", "tr"}, "tr": {"tr"}}

# words of class and id names by which an element lies beside an article
SIDE_WORDS = {"ad", "ads", "advert", "adverts", "advertisement", "advertising", "sponsor", "sponsored", "promo", "promotion", "banner", "cookie", "cookies",
              "consent", "gdpr", "notice", "notices", "popup", "modal", "overlay", "newsletter", "subscribe", "subscription", "paywall", "sidebar",
              "menu", "nav", "navbar", "navigation", "breadcrumb", "breadcrumbs", "footer", "masthead", "topbar", "toolbar", "comment", "comments",
              "commentlist", "respond", "replies", "disqus", "pagination", "pager", "login", "signin", "signup", "copyright"}
# words that may as well be what an article is about: believed only of short lines or links
HINT_WORDS = {"alert", "alerts", "share", "sharing", "social", "related", "recommended", "trending", "widget", "widgets", "search", "hidden"}
# words that may stand beside them in a name and say nothing of its subject
FRAME_WORDS = {"article", "articles", "post", "posts", "blog", "story", "stories", "page", "site", "entry", "reader", "readers", "user", "header", "top",
               "bottom", "left", "right", "main", "global", "primary", "secondary", "content", "form", "card", "cards", "leaderboard", "text", "link",
               "links", "button", "buttons", "btn", "icon", "icons", "list", "item", "items", "box", "wrap", "wrapper", "container", "block", "area",
               "section", "inner", "outer", "bar", "panel", "unit", "slot", "row", "col", "column", "columns", "group", "module", "region", "zone",
               "strip", "title", "label", "thread", "count", "more", "tools", "message", "warning", "mobile", "desktop", "sticky", "fixed", "field"}
# two words that make one
SIDE_PAIRS = {("site", "header"), ("page", "header"), ("skip", "link"), ("side", "bar")}
# the state of a part, not the part
STATE_WORDS = {"open", "opened", "closed", "enabled", "disabled", "on", "off", "active", "inactive", "none"}
READER_WORDS = {"comment", "comments", "commentlist", "respond", "replies", "disqus"}
# what a container has or lacks says nothing of what it is
_HAS_NAMES = re.compile(r"(?<![^\s_-])(?:no|non|has|with|without)[_-]\S*", re.I)
_ATTRIBUTE = re.compile(r"""\b(class|id|role|aria-hidden|hidden|style)\b(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""", re.I)
_SIDE_ROLES = {"navigation", "banner", "contentinfo", "complementary", "search", "dialog", "alert", "alertdialog", "menu", "menubar", "form"}
_TAG_REST = re.compile(r"""(?:[^>"']+|"[^"]*"|'[^']*')*+>""")
_NAME = re.compile(r"/?([a-zA-Z][^\s/>]*)")
_ANCHOR = re.compile(r"<(?:(/)a|a)(?=[\s/>])", re.I)
_HREF = re.compile(r"(?:^|[\s\"'])href\s*=", re.I)
_TARGET = re.compile(r"(?:^|[\s\"'])(?:name|id)\s*=", re.I)


def _is_target(attributes: str) -> bool:
    """Whether an anchor is a place to jump to, not a link."""
    return attributes.endswith("/") or bool(_TARGET.search(attributes)) and not _HREF.search(attributes)


def _is_side(tag: str, attributes: str, in_article: bool) -> bool:
    """Whether the element, its role or its style sets it beside the article."""
    if tag in SIDE_ELEMENTS or tag == "header" and not in_article:
        return True
    if not attributes or tag in ("html", "body", *ARTICLE_ELEMENTS):
        return False
    for m in _ATTRIBUTE.finditer(attributes):
        name, value = m[1].lower(), (m[2] or m[3] or m[4] or "").strip()
        if name == "role" and value.lower() in _SIDE_ROLES or name == "aria-hidden" and value.lower() == "true":
            return True
        if name == "hidden" or name == "style" and "display:none" in value.replace(" ", "").lower():
            return True
    return False


SIDE, HINT = 2, 1


def _side_name(tag: str, attributes: str) -> int:
    """How strongly the class or id says that an element lies beside the article: SIDE, HINT or 0.

    A name counts if all its words (between dashes) do: "related-posts" is a hint, "related-work" is a subject.
    """
    if not attributes or tag in ("html", "body", *ARTICLE_ELEMENTS):
        return 0
    said = 0
    for m in _ATTRIBUTE.finditer(attributes):
        if m[1].lower() not in ("class", "id"):
            continue
        for name in _HAS_NAMES.sub("", m[2] or m[3] or m[4] or "").lower().split():
            words = [w for w in re.split("[_-]+", name) if w and not w.isdigit()]
            known = set(words)
            if known & STATE_WORDS:
                continue
            if tuple(words[:2]) in SIDE_PAIRS:
                said = SIDE
            elif known <= SIDE_WORDS | HINT_WORDS | FRAME_WORDS:
                said = max(said, SIDE if known & SIDE_WORDS else HINT if known & HINT_WORDS else 0)
    return said


class _Named(NamedTuple):
    """An element that seems to lie beside the article by its name."""
    outer: int         # such an element around it, or -1
    said: int          # SIDE or HINT


def _hidden(named: list[_Named], out: list[tuple], articles: dict[int, int]) -> list[bool]:
    """Of each element named so, whether its name is believed.

    A hint is believed of links and short lines, not of text that would surge by itself.  No name is believed
    that holds the page's largest article element, or outside of which the page has no text.
    """
    if not named:
        return []
    held, linked, longest, free = [0] * len(named), [0] * len(named), [0] * len(named), 0
    sizes: dict[int, int] = {}
    for block, beside, _, links, _, name, article in out:
        if beside:
            continue
        size = len(block) - links
        free += size if name < 0 else 0
        if article >= 0:
            sizes[article] = sizes.get(article, 0) + size
        while name >= 0:
            held[name] += len(block)
            linked[name] += links
            longest[name] = max(longest[name], size)
            name = named[name].outer
    largest = max(sizes, key=lambda a: sizes[a], default=-1)
    around, at = set(), articles.get(largest, -1)
    while at >= 0 and sizes[largest] > free:
        around.add(at)
        at = named[at].outer
    hidden: list[bool] = []
    for i, n in enumerate(named):
        believed = i not in around and (n.said == SIDE or longest[i] < SURGE_CHARS or 3 * linked[i] >= held[i])
        hidden.append(believed or n.outer >= 0 and hidden[n.outer])
    if not any(len(block) > links and not beside and (name < 0 or not hidden[name]) for block, beside, _, links, _, name, _ in out):
        return [False] * len(named)
    return hidden


class Line(NamedTuple):
    text: str
    beside: bool       # beside the article
    inside: bool       # in an article element
    links: int         # characters of links
    place: int         # its container, as an element number
    around: int        # the container of that, -1 for the page itself


def lines(page: str) -> list[Line]:
    """The blocks with text."""
    out: list[tuple[str, bool, bool, int, int, int, int]] = []
    # open elements: name, beside, in article, number of the container, of the element named so, of the article element
    stack: list[tuple[str, bool, bool, int, int, int]] = []
    outside = ("", False, False, 0, -1, -1)
    named: list[_Named] = []
    articles: dict[int, int] = {}                      # of each outermost article element: the element named so around it
    parents, holds = [0], [True]                       # of each element: number of its container, whether it holds blocks
    whole = {0}                                        # the page itself: the root, html and body
    opened: Counter = Counter()                        # open elements by name
    text: list[str] = []
    links = 0
    anchor = 0                                         # 1: in a link, 2: in one without an end tag, which ends with its block

    def flush() -> None:
        nonlocal links, anchor
        anchor = 0 if anchor == 2 else anchor
        block = " ".join("".join(text).split())
        if block:
            _, beside, inside, number, name, article = stack[-1] if stack else outside
            out.append((block, beside, inside, min(links, len(block)), number, name, article))
        text.clear()
        links = 0

    at, end = 0, len(page)
    while at < end:
        lt = page.find("<", at)
        if lt < 0:
            lt = end
        if lt > at:
            piece = page[at:lt]
            if "&" in piece:
                piece = entities.unescape(piece)
            text.append(piece)
            links += len(piece) if anchor else 0
        if lt == end:
            break
        follows = page[lt + 1:lt + 2]
        if page.startswith("<!--", lt):
            close = page.find("-->", lt + 4)
            at = end if close < 0 else close + 3
            continue
        if follows in ("!", "?"):
            close = page.find(">", lt)
            at = end if close < 0 else close + 1
            continue
        name = _NAME.match(page, lt + 1)
        if not name:
            text.append("<")
            at = lt + 1
            continue
        rest = _TAG_REST.match(page, name.end())
        close = rest.end() if rest else page.find(">", lt) + 1
        attributes = page[name.end():close - 1] if close else ""
        at = close or end
        tag, ends = name[1].lower(), follows == "/"
        if tag == "a":
            if ends or _is_target(attributes):
                anchor = 0 if ends else anchor
            else:
                ahead = _ANCHOR.search(page, at)
                anchor = 1 if ahead and ahead[1] else 2
            continue
        if tag == "br":
            text.append(" ")
            continue
        block = tag in BLOCK_ELEMENTS
        if ends:
            if block or opened[tag]:
                flush()
            while opened[tag]:                         # to the nearest of the name, and what lies in it
                last = stack.pop()[0]
                opened[last] -= 1
                if last == tag:
                    break
            continue
        if tag in RAW_ELEMENTS:
            done = re.compile(rf"</{re.escape(tag)}\s*>", re.I).search(page, at)
            if not attributes.endswith("/"):
                at = done.end() if done else end
            continue
        while block and stack and tag in SELF_ENDING.get(stack[-1][0], ()):
            flush()
            opened[stack.pop()[0]] -= 1
        _, beside, inside, number, within, article = stack[-1] if stack else outside
        if block:
            flush()
        side, called = _is_side(tag, attributes, inside), _side_name(tag, attributes)
        if tag not in VOID_ELEMENTS and not attributes.endswith("/") and (block or side or called):
            if not block:
                flush()
            if called:
                named.append(_Named(within, called))
                within = len(named) - 1
            # a section of an article is a part of it
            if tag in CONTAINER_ELEMENTS and not (inside and tag == "section"):
                holds[number] = True
                parents.append(number)
                holds.append(False)
                number = len(parents) - 1
                if tag in ("html", "body"):
                    whole.add(number)
            elif block and tag not in CONTAINER_ELEMENTS:
                holds[number] = True
            if tag in ARTICLE_ELEMENTS and not inside:
                article = number
                articles[article] = within
            stack.append((tag, beside or side, inside or tag in ARTICLE_ELEMENTS, number, within, article))
            opened[tag] += 1
    flush()
    hidden = _hidden(named, out, articles)
    found = []
    for block, beside, inside, links, number, name, _ in out:
        place = number if holds[number] else parents[number]      # a container without blocks is a line of the one around it
        found.append(Line(block, beside or name >= 0 and hidden[name], inside, links, place, -1 if place in whole or parents[place] in whole else parents[place]))
    return found


def passages(weight: np.ndarray) -> list[bool]:
    """Whether each line lies between a surge and the next dive of the sums over windows of lines that start there."""
    sums, within, out = np.convolve(weight, np.ones(WINDOW_LINES, np.int64))[WINDOW_LINES - 1:], False, []
    for total, own in zip(sums, weight):
        within = total >= DIVE_CHARS if within else total >= SURGE_CHARS and own > 0
        out.append(bool(within))
    return out


def _joins(line: Line, kept: Line) -> bool:
    """Whether a short line belongs to a kept neighbour in another container: one within the other, or both in one below the page."""
    return line.inside == kept.inside and 2 * line.links <= len(line.text) and (
        line.around >= 0 and line.around in (kept.place, kept.around) or kept.around >= 0 and line.place == kept.around)


def main_text(page: str | None) -> str:
    """Text of a page's article: its blocks, white space collapsed, joined by an empty line."""
    rows = [line for line in lines(page or "") if not line.beside]
    plain = np.array([len(line.text) - line.links for line in rows], np.int64)
    if not plain.any():
        return ""
    inside = np.array([line.inside for line in rows])
    # an article element is evidence, no verdict: its lines count for more, the others must surge by themselves
    weight = plain + np.where(inside, np.minimum(plain, ARTICLE_BONUS), 0)
    edges = [0, *(np.flatnonzero(np.diff(inside)) + 1), len(rows)]
    kept = [k for a, b in zip(edges, edges[1:]) for k in passages(weight[a:b])]
    if not any(kept):                                  # nothing surges: a short page's text as it stands
        kept = (inside if plain[inside].any() else ~inside).tolist()
        return "\n\n".join(line.text for line, k in zip(rows, kept) if k)
    places = {line.place for line, k in zip(rows, kept) if k}
    kept = [k or line.place in places and 2 * line.links <= len(line.text) for line, k in zip(rows, kept)]
    for step in (1, -1):                               # short lines next to a kept one, and next to those
        order = range(len(rows))[::step]
        for i, j in zip(order, order[1:]):
            kept[j] = kept[j] or kept[i] and _joins(rows[j], rows[i])
    return "\n\n".join(line.text for line, k in zip(rows, kept) if k)


def _extract(batches):
    for batch in batches:
        texts = [main_text(page.as_py()) for page in batch.column("html")]
        yield pa.RecordBatch.from_arrays(
            [batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
            ["page_id", "url", "text", "n_chars"])


def extract_text(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """One row per page: page_id, url, text, n_chars (code points).

    A null or empty page, or one without an article's text, gives an empty text; ids and urls may be
    null or repeated and come back unchanged, an empty table gives no rows, other columns are not read.
    """
    rows = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url"), F.col(html_col).alias("html"))
    schema = T.StructType([rows.schema["page_id"], rows.schema["url"], T.StructField("text", T.StringType()), T.StructField("n_chars", T.LongType())])
    return rows.mapInArrow(_extract, schema)


def op3_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every row of ``pages``."""
    return extract_text(table(spark, sf_dir, "pages"))
