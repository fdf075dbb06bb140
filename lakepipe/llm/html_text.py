"""Main text of web pages by the distribution of text over lines.

Markup is stripped into one line per block element. Lines inside elements that are never the article
(scripts, styles, menus, page headers and footers, sidebars, forms, adverts, notices, reader comments)
and lines outside the article that consist of links only count as blank, unless such a line is a paragraph
beside a line of text. Class, id and role values say so as whole tokens: a hint, or hints joined with words of
layout only (``cookie-notice``, ``left-sidebar``, but not ``has-sidebar``), and for reader comments a hint beside
any word (``wp-comments-area``); a content hint beside them wins. Skipping by hint, or of a form, is undone for
an element that holds most of the page's text, comments excepted, and for all if nothing else is left. The text
lengths of ``WINDOW`` neighbouring lines are summed. Where a sum rises from zero to the threshold there is a
surge, where it falls back to zero a dive, and the lines between them are kept. A page on which no sum reaches
the threshold keeps the stretches with its highest sum. A stretch that reaches it nowhere stays if only skipped
elements inside the same parent element part it from one that does: it is the same text, interrupted.

An article or main element does not choose lines, it only shapes the distribution: stretches end at its
edges, skipped elements inside it do not end them, and if such elements hold most of the page's text, text
outside them counts half. So a teaser in an article element goes where its sums are low, and text outside
all article elements stays where its sums are high.

Defined results: a null, empty or markup-only page has an empty text; text without any markup is one
line; elements left open end with the page, and an advert or menu left open ends where an article begins;
pages of any length are read whole, repeated rows each by itself. Other columns are ignored.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

WINDOW, SURGE = 3, 86  # lines; characters

# Element names and the words of class, id and role attributes by their meaning.
RAW = "script style noscript template svg math iframe object textarea select head title".split()
BOILERPLATE = set("nav header footer aside form menu dialog button".split())
BLOCKS = set(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer "
    "form h1 h2 h3 h4 h5 h6 header hr html li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul".split()
)
ENDS_IMPLIED = set("p li dt dd td th tr option".split())
ARTICLE = {"article", "main"}
VOID = set("area base br col embed hr img input link meta source track wbr".split())
HINTS = set(
    "ad ads advert adverts advertisement advertising sponsor sponsored promo promotion nav navbar navigation menu "
    "breadcrumb breadcrumbs sidebar aside footer masthead notice notices alert cookie cookies consent gdpr banner popup "
    "modal overlay newsletter subscribe subscription share sharing social related recommended comment comments disqus "
    "reply replies respond widget toolbar pagination pager login signup search copyright disclaimer contentinfo "
    "complementary hidden".split()
)
HEADER_HINTS, CONTENT_HINTS = {"header", "topbar"}, set("article entry post content story".split())
COMMENT_HINTS = set("comment comments disqus reply replies respond".split())
#: Beside a comment hint these say something about an element that need not hold the comments.
STATES = set("has no with without open opened closed on off enabled disabled allow allowed show hide count number link toggle".split())
CONTAINERS = BLOCKS - ENDS_IMPLIED - set("hr h1 h2 h3 h4 h5 h6 pre".split())
LAYOUT = set(
    "main site page global top bottom left right center primary secondary first second container wrapper wrap inner outer "
    "box block area section region column col row bar list item items link links icon icons button buttons unit slot text "
    "title body form group panel posts articles stories news media user desktop mobile".split()
)

#: Attributes: a quoted value may hold any character, also the one that ends a tag; a quote left open ends with the tag.
_REST = r"""(?:[^>"'=]++|=\s*+"[^"]*+"|=\s*+'[^']*+'|["'=])*+"""
_RAW = re.compile(
    r"<!--.*?(?:-->|\Z)|<(" + "|".join(RAW) + r")(?=[\s/>])" + _REST + r">.*?(?:</\1\s*>|\Z)|<[!?][^>]*>", re.S | re.I
)
_TAG = re.compile(r"<(/?)([a-zA-Z][^\s/>]*)(" + _REST + ")>")
_NAMED = re.compile(r"""\b(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
_HIDDEN = re.compile(r"""(?:^|\s)hidden(?:\s|=|$)|aria-hidden\s*=\s*["']?true|display\s*:\s*none""", re.I)


def _parts(token: str) -> set[str]:
    return set(re.split(r"[^a-z]+", token)) - {""}


def _hints(attributes: str) -> set[str]:
    """The hints of the class, id and role tokens that consist of hints and layout words; none beside a content token."""
    hints = set()
    for groups in _NAMED.findall(attributes):
        for token in "".join(groups).lower().split():
            parts = _parts(token)
            if parts & CONTENT_HINTS and parts <= CONTENT_HINTS | LAYOUT:
                return set()
            if parts <= HINTS | HEADER_HINTS | CONTENT_HINTS | LAYOUT:
                hints |= parts & (HINTS | HEADER_HINTS)
            elif not parts & STATES:
                hints |= parts & COMMENT_HINTS
    return hints


def _kind(name: str, attributes: str, inside_article: bool) -> str:
    """Why an element is skipped: "named" by its name, "hinted" for comments, "doubtful" otherwise, or ""."""
    if name in BOILERPLATE:
        kept = name == "header" and inside_article
        return "" if kept else "doubtful" if name == "form" else "named"
    if not attributes or name in ("html", "body") or name in ARTICLE:
        return ""
    hints = _hints(attributes)
    if hints:
        return "hinted" if hints & COMMENT_HINTS else "doubtful"
    return "doubtful" if _HIDDEN.search(attributes) else ""


class Line(NamedTuple):
    text: str
    article: int  # number of the outermost article element, or 0
    skipped: bool  # inside an element that is never the article
    links: bool  # outside all articles, and mostly links
    paragraph: bool
    inside: int  # number of the element it lies in, headings and paragraphs aside


def _parse(page: str, skips: bool, reopened: set[int]) -> tuple[list[Line], dict[int, int]]:
    """The lines, and the characters in each element that is skipped but might be the text, by the place of its tag."""
    lines: list[Line] = []
    held: dict[int, int] = {}
    parts: list[str] = []
    linked, depth, article, articles, link = 0, 0, 0, 0, 0
    skipped, doubtful = "", -1  # the element being skipped, and its place if it might be the text
    around: list[tuple[str, int]] = [("", 0)]  # open containers
    containers, block = 0, ""

    def flush() -> None:
        nonlocal linked
        text = " ".join(html.unescape("".join(parts)).split())
        if text:
            if skipped and doubtful >= 0:
                held[doubtful] = held.get(doubtful, 0) + len(text)
            links = not article and 2 * linked >= len(text)
            lines.append(Line(text, articles if article else 0, bool(skipped), links, block == "p", around[-1][1]))
        parts.clear()
        linked = 0

    at = 0
    for tag in _TAG.finditer(page):
        text = page[at : tag.start()]
        at = tag.end()
        if text:
            parts.append(text)
            linked += len(text.strip()) if link else 0
        closing, name, attributes = tag.group(1), tag.group(2).lower(), tag.group(3)
        if name in BLOCKS:
            flush()
            block = "" if closing else name
            if name in CONTAINERS and not closing:
                containers += 1
                around.append((name, containers))
            elif name in CONTAINERS and (outer := next((k for k in range(len(around) - 1, 0, -1) if around[k][0] == name), 0)):
                del around[outer:]
        elif name == "br":
            parts.append(" ")
        if name == "a":
            link = 0 if closing else 1
        if skipped:
            if name in ARTICLE and not closing and not article:
                skipped = ""
                held.pop(doubtful, None)
            elif skipped in ENDS_IMPLIED and name in BLOCKS and not (closing and name != skipped):
                skipped = ""
            elif name == skipped:
                depth += -1 if closing else 0 if attributes.endswith("/") else 1
                if depth == 0:
                    skipped = ""
                continue
            else:
                continue
            if closing:
                continue
        if name in ARTICLE:
            articles += not closing and not article
            article = max(0, article + (-1 if closing else 1))
        elif not closing and name not in VOID and not attributes.endswith("/") and tag.start() not in reopened:
            kind = _kind(name, attributes, article > 0)
            if kind == "named" or kind and skips:
                flush()
                skipped, depth, doubtful = name, 1, tag.start() if kind == "doubtful" else -1
    parts.append(page[at:])
    flush()
    return lines, held


def _holders(page: str) -> set[int]:
    """The places of all elements, however nested, that would be skipped but hold most of the page's text."""
    total, at, article = 0, 0, False
    level: dict[str, int] = {}
    opened: list[tuple[str, int, int, int]] = []  # name, its level, place, characters before it
    named: dict[str, list[int]] = {}  # the levels of those in ``opened``
    sealed, sealed_level = "", 0  # an element that is skipped whatever it holds
    held: dict[int, int] = {}

    def close(name: str) -> None:
        while opened:
            last, _, place, before = opened.pop()
            named[last].pop()
            held[place] = total - before
            if last == name:
                break

    for tag in _TAG.finditer(page):
        total += len(" ".join(html.unescape(page[at : tag.start()]).split()))
        at = tag.end()
        closing, name, attributes = tag.group(1), tag.group(2).lower(), tag.group(3)
        if name in VOID or attributes.endswith("/"):
            continue
        if opened and opened[-1][0] in ENDS_IMPLIED and name in BLOCKS and not (closing and name != opened[-1][0]):
            close(opened[-1][0])
        level[name] = max(0, level.get(name, 0) + (-1 if closing else 1))
        if closing:
            if sealed == name and level[name] < sealed_level:
                sealed = ""
            if named.get(name) and named[name][-1] > level[name]:
                close(name)
            continue
        if name in ARTICLE:
            article, sealed = True, ""
            opened.clear()
            named.clear()
            continue
        kind = "" if sealed else _kind(name, attributes, article)
        if kind == "doubtful":
            opened.append((name, level[name], tag.start(), total))
            named.setdefault(name, []).append(level[name])
        elif kind:
            sealed, sealed_level = name, level[name]
    total += len(" ".join(html.unescape(page[at:]).split()))
    while opened:
        close("")
    return {place for place, size in held.items() if 2 * size > total}


def lines_of(page: str) -> list[tuple[str, int, bool, int]]:
    """The page's lines as (text, number of the outermost article or 0, blank for the distribution, element it lies in)."""
    page = _RAW.sub("", page)
    reopened: set[int] = set()
    lines, held = _parse(page, True, reopened)
    if 2 * max(held.values(), default=0) > sum(len(line.text) for line in lines):
        reopened = _holders(page)
        lines, _ = _parse(page, True, reopened)
    if lines and all(line.skipped or line.links for line in lines):
        lines, _ = _parse(page, False, reopened)
    out = []
    for k, line in enumerate(lines):
        beside = [n for n in (*lines[max(0, k - 1) : k], *lines[k + 1 : k + 2]) if n.inside == line.inside]
        text_beside = any(not n.skipped and not n.links for n in beside)
        blank = line.skipped or (line.links and not (line.paragraph and text_beside))
        out.append((line.text, line.article, blank, line.inside))
    return out


def _chosen(stretches: list[tuple[int, int, float]], level: float, inside: list[int]) -> list[bool]:
    """Which stretches reach the level, or are parted from one that is kept by skipped elements alone."""
    kept = [highest >= level for _, _, highest in stretches]
    order = range(1, len(stretches))
    for later, earlier in [(k, k - 1) for k in order] + [(k - 1, k) for k in reversed(order)]:
        first, second = sorted((later, earlier))
        if kept[earlier] and inside[stretches[first][1] - 1] == inside[stretches[second][0]]:
            kept[later] = True
    return kept


def main_text(page: str | None, window: int = WINDOW, surge: int = SURGE) -> str:
    lines = [line for line in lines_of(page or "") if not (line[1] and line[2])]
    lengths = np.array([0 if blank else len(text) for text, _, blank, _ in lines], np.int64)
    if not lengths.any():
        return ""
    article = np.array([number for _, number, _, _ in lines], np.int64)
    outside = 0.5 if 2 * lengths[article > 0].sum() > lengths.sum() else 1.0
    weighted = np.where(article > 0, 1.0, outside) * lengths
    edges = np.flatnonzero(np.diff(np.where(lengths > 0, article, -1), prepend=-2, append=-2))
    stretches = []  # from a surge or its foot to the next dive: (begin, end, highest sum)
    for begin, end in zip(edges[:-1], edges[1:], strict=True):
        if lengths[begin]:
            sums = np.convolve(weighted[begin:end], np.ones(window))
            stretches.append((begin, end, sums.max()))
    level = min(surge, max(s[2] for s in stretches))
    kept = _chosen(stretches, level, [inside for _, _, _, inside in lines])
    return "\n".join(lines[i][0] for (begin, end, _), stays in zip(stretches, kept, strict=True) if stays for i in range(begin, end))


def extract(pages: DataFrame) -> DataFrame:
    """(page_id, url, text, n_chars) per row of ``pages`` (page_id, url, html)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for begin in range(0, batch.num_rows, 500):
                part = batch.slice(begin, 500)
                texts = [main_text(page) for page in part.column("html").to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [part.column("page_id"), part.column("url"), pa.array(texts, pa.string()),
                     pa.array([len(t) for t in texts], pa.int64())],
                    names=["page_id", "url", "text", "n_chars"],
                )

    kinds = {f.name: f.dataType.simpleString() for f in pages.schema}
    schema = f"page_id {kinds['page_id']}, url {kinds['url']}, text string, n_chars long"
    return pages.select("page_id", "url", "html").mapInArrow(run, schema)
