"""Main text of HTML pages by line-block distribution.

Markup is stripped to lines, one for each block element. Lines of scripts, menus, notices, comments and the like weigh nothing,
link text weighs nothing (an element that holds the page's article, or most of its unlinked text, is never left out by its name).
A marked article that holds most of the unlinked text is the text. Elsewhere weights are summed over windows of ``WINDOW``
lines with text; text begins where a sum surges (over ``SURGE``, or over the mean line of the page, if that is less and the
window's links are outweighed), runs on until a whole window has no weight, the dive, and all lines between the two are kept.
"""

from __future__ import annotations

import html as entities
import re
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tidebars.llm.common import bounded_batches, name, tidy

WINDOW, SURGE = 3, 80
#: Elements of HTML by their part in a page.
RAW = frozenset("script style noscript template svg annotation annotation-xml head title textarea select iframe object canvas audio video".split())
APART = frozenset("nav aside footer form menu dialog button fieldset address".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label mark meter q rp rt ruby s samp small span "
    "strike strong sub sup time tt u var wbr "
    "math semantics mi mn mo ms mtext mspace mrow mfrac msqrt mroot mstyle merror mpadded mphantom mfenced menclose msub msup msubsup "
    "munder mover munderover mmultiscripts mprescripts mtable mtr mtd mlabeledtr maction annotation annotation-xml".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
ARTICLE = frozenset("article main".split())
#: Words of class, id and role names of parts that aren't the article; a name counts if all its words are in one of the three lists.
MARKS = frozenset(
    "ad ads adv advert adverts advertisement advertising banner banners sponsor sponsored promo promotion sidebar sidebars side menu "
    "nav navbar navigation breadcrumb breadcrumbs footer cookie cookies consent gdpr notice notices notification alert popup modal overlay "
    "newsletter subscribe subscription signup login share sharing social related recommended recommendations teaser comment comments "
    "commentlist reply replies respond disqus discussion widget widgets toolbar pagination pager copyright legal disclaimer search "
    "contentinfo complementary skip".split())
HEAD_MARKS = frozenset("header masthead topbar".split())  # outside an article only
PARTS = frozenset(
    "area articles bar block body bottom box btn button buttons container form group icon icons inner item items left link links list "
    "main message messages outer posts primary right secondary section site slot sticky stories text title top unit wrap wrapper".split())
#: Ids that headings and sections of an article have as well, where they don't count.
ANCHORS = frozenset(
    "ad ads alert banner comment consent copyright cookie cookies discussion disclaimer legal menu navigation notice notices notification "
    "promotion related reply respond search share sharing side social subscription widget widgets".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*+)((?:\"[^\"]*\"|'[^']*'|[^'\">])*+)(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*+)([^>]*+)(?:>|\Z)",
    re.DOTALL)
_ATTRIBUTE = re.compile(r"([^\s=\"'>/]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?")
_ASKED = re.compile(r"class|id|role|hidden|style", re.IGNORECASE)
_UNSEEN = re.compile(r"display\s*:\s*none", re.IGNORECASE)
_WORDS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")


@lru_cache(4096)
def _marked(attributes: str, inside: bool, heading: bool = False) -> bool:
    """Whether an element is hidden, or named as a part that isn't the article."""
    if not _ASKED.search(attributes):
        return False
    own: dict[str, str] = {}
    for m in _ATTRIBUTE.finditer(attributes):
        own.setdefault(m[1].lower(), m[2] or m[3] or m[4] or "")
    if own.get("hidden", "until-found").lower() != "until-found" or own.get("aria-hidden", "").lower() == "true" or _UNSEEN.search(own.get("style", "")):
        return True
    ids = [] if heading else [n for n in own.get("id", "").split() if not inside or n.lower() not in ANCHORS]
    marks = MARKS if inside else MARKS | HEAD_MARKS
    for known in [*own.get("class", "").split(), *own.get("role", "").split(), *ids]:
        words = {w.lower() for w in _WORDS.findall(known) if len(w) > 1}
        if words & marks and words <= marks | PARTS:
            return True
    return False


def _tags(page: str) -> list[tuple[int, int, bool, str, str]]:
    """``start, end, closing, element, attributes`` of tags; comments and declarations have no element."""
    out, at, raw = [], 0, None
    while m := _TOKEN.search(page, at):
        closing, element = m[1] or m[4], (m[2] or m[5] or "").lower()
        at = m.end()
        out.append((m.start(), at, bool(closing), element, m[3] or m[6] or ""))
        if element in RAW and element != "head" and not closing and not (m[3] or m[6] or "").endswith("/"):
            raw = re.compile(rf"</{re.escape(element)}(?![a-zA-Z0-9-])", re.IGNORECASE).search(page, at)
            at = raw.start() if raw else len(page)
    return out


def _ends(tags: list[tuple]) -> dict[int, int]:
    """For each opening tag that is closed, the place of its closing tag."""
    opened: dict[str, list[int]] = {}
    ends = {}
    for k, (_, _, closing, element, attributes) in enumerate(tags):
        if not element or element in VOID:
            continue
        if not closing:
            if not attributes.endswith("/"):
                opened.setdefault(element, []).append(k)
        elif opened.get(element):
            ends[opened[element].pop()] = k
    return ends


class _Shares:
    """How the unlinked text of a page is spread over its elements."""

    def __init__(self, page: str, tags: list[tuple], ends: dict[int, int]):
        self.before = []  # characters before each tag
        n = at = linked = 0
        raw = -1
        for k, (start, end, closing, element, _) in enumerate(tags):
            if k > raw and not linked and start > at:
                n += len(" ".join(page[at:start].split()))
            self.before.append(n)
            at = end
            if element == "a":
                linked = max(0, linked + (-1 if closing else 1))
            elif element and element not in INLINE:
                linked = 0
            if k > raw and not closing and element in RAW:
                raw = ends.get(k, k if element == "head" else len(tags))
        self.total = n + (len(" ".join(page[at:].split())) if raw < len(tags) and not linked else 0)
        spans = ((self.before[e] - self.before[k], k) for k, e in ends.items()
                 if tags[k][3] == "main" or tags[k][3] == "article" and not _marked(tags[k][4], False))
        self.most, self.article = max(spans, default=(0, -1))  # the longest article, and where it begins

    def kept(self, start: int, end: int, element: str) -> bool:
        """Whether the part from one tag to another has the page's article; an aside, footer or the like seldom has."""
        named = element not in APART or element in ("form", "fieldset")
        if start < self.article < end:
            return named or 2 * self.most > self.total
        return named and self.most < SURGE and 2 * (self.before[end] - self.before[start]) > self.total


def lines_of(page: str) -> list[tuple[str, int, bool]]:
    """``text, weight, inside`` of the lines of a page; lines to be left out are empty. ``inside``: a marked article."""
    tags = _tags(page)
    ends = _ends(tags)
    shares = None
    lines, words, links = [], [], 0
    until, inside, linked = -1, 0, 0  # left out up to this tag; depth of articles; depth of links

    def close() -> None:
        nonlocal words, links
        text = " ".join(entities.unescape("".join(words)).split())
        lines.append((text, max(0, len(text) - links) if links else len(text), inside > 0))
        words, links = [], 0

    def take(text: str) -> None:
        nonlocal links
        words.append(text)
        if linked:
            links += len(" ".join(entities.unescape(text).split()))

    at = 0
    for k, (start, end, closing, element, attributes) in enumerate(tags):
        if k > until and start > at:
            take(page[at:start])
        at = end
        if not element:
            continue
        if k == until:
            if element not in INLINE or element not in RAW:
                close()
            continue
        if k < until:
            continue
        if not closing and (element in RAW or element in APART or (element == "header" and not inside) or attributes):
            apart = element in RAW or element in APART or (element == "header" and not inside) or (
                element not in ARTICLE and element not in ("html", "body") and _marked(attributes, inside > 0, element in HEADINGS))
            if apart and element not in RAW and k in ends:
                shares = shares or _Shares(page, tags, ends)
                apart = not shares.kept(k, ends[k], element)
            if apart and element not in VOID:
                if element not in INLINE or element not in RAW:
                    close()
                if k in ends:
                    until = ends[k]
                elif element in RAW and element != "head":
                    until = len(tags)
                    break
                continue
        if element == "a":
            linked = max(0, linked + (-1 if closing else 1))
        elif element not in INLINE:
            close()
            linked = 0
            if element in ARTICLE:
                inside = max(0, inside + (-1 if closing else 1))
    if until < len(tags) and at < len(page):
        take(page[at:])
    close()
    return lines


def surges(weights: np.ndarray, links: np.ndarray, least: float) -> list[tuple[int, int]]:
    """Runs of lines from each surge of the window sums to the dive after it; a sum under ``SURGE`` must outweigh its links.

    Up to ``WINDOW`` lines of unlinked text right before a surge, headings and the like, belong to it.
    """
    n = len(weights)
    ends = np.minimum(np.arange(n) + WINDOW, n)
    total, linked = (np.concatenate([[0], np.cumsum(x)]) for x in (weights, links))
    sums, beside = total[ends] - total[:-1], linked[ends] - linked[:-1]  # of the windows that begin at each line
    begins = (weights > 0) & (sums >= least) & ((sums >= SURGE) | (sums >= beside))
    out, i, done = [], 0, 0
    while i < n:
        if not begins[i]:
            i += 1
            continue
        j = i
        while j < n and sums[j] > 0:
            j += 1
        first = i
        while first > max(done, i - WINDOW) and weights[first - 1] > 0 and not links[first - 1]:
            first -= 1
        out.append((first, j))
        i = done = j
    return out


def main_text(page: str | None) -> str:
    """The text of a page's article, blocks joined by one space; empty if there is none.

    The windows decide on every page. In a marked article that holds most of the text every line weighs a surge more, also one that is a link,
    and lines outside of it weigh nothing.
    """
    lines = [line for line in lines_of(page or "") if line[0]]
    weights = np.array([weight for _, weight, _ in lines], np.int64)
    inside = np.array([inside for _, _, inside in lines], bool)
    links = np.array([len(text) for text, _, _ in lines], np.int64) - weights
    marked = inside.any() and 2 * weights[inside].sum() >= weights.sum()
    if marked:
        weights, links = np.where(inside, weights + SURGE, 0), np.where(inside, 0, links)
    if not weights.any():
        return ""
    runs = surges(weights, links, min(SURGE, weights[weights > 0].mean()))
    return " ".join(lines[i][0] for a, b in runs for i in range(a, b) if inside[i] or not marked)


def extract_text(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """``id, url, text, n_chars`` of each page; ``n_chars`` counts code points.

    Null and empty html, and pages without an article, have an empty text. Whole pages are read, however long, in one pass each.
    A page cut off in a tag, comment or script is read as far as it goes. Null ids and URLs and repeated rows pass
    through. An empty table gives no rows; other columns are not read.
    """
    bounded_batches(pages.sparkSession)
    rows = pages.select(name(id_col).alias("id"), name(url_col).alias("url"), name(html_col).cast("string").alias("html"))

    @tidy
    def work(batches):
        for batch in batches:
            texts = [main_text(p) for p in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                names=["id", "url", "text", "n_chars"])

    kinds = {f.name: f.dataType.simpleString() for f in rows.schema}
    return rows.mapInArrow(work, f"id {kinds['id']}, url {kinds['url']}, text string, n_chars bigint")
