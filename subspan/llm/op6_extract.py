"""HTML extraction (6): line-block distribution.

Markup is stripped into lines, one for each block element's own text; whatever can't be part of an article (menus, headers, footers,
side columns, notices, adverts, forms, scripts, styles, comments of readers) leaves a blank line, by element or by a class, id or role
that begins or ends with such a word. Forms and elements known by these words alone hold the text all the same where the rest of the page has next to none
(``_exempt``), so a wrapper named after its side column or its fixed header loses nothing. A line counts with the length of its text outside links. Over windows of ``WINDOW`` lines these lengths are
summed. A region lies between two places where the sum dives to 0 or an ``<article>`` or ``<main>`` has its edge, and is text where the
sum surges to ``SURGE`` anywhere in it. It stays from its first line to its last, with lines that are only links; a region
without a surge stays where no more than ``NEAR`` lines outside of elements are between it and one that surges. Links alone between two regions are a menu.

These two elements are a weight. The length of the lines in one counts ``ARTICLE`` or ``MAIN`` times and is compared with the length of
all regions outside. What is less than a ``SHARE``-th of the heaviest is left out: the regions outside where an element is
heaviest, or each element by itself where they are. So a long text beside articles that are cards stays, and an article whose class, id
or role marks it as a comment or an advert is excluded unless the page has no other text. Of an element that stays all lines do.
Without any surge or element the largest run between two dives is the text.

Character references are decoded after the tags are gone, white space inside a block becomes one space, ``<br>`` and table cells
count as white space, blocks are trimmed and joined by two line feeds. Texts are whole whatever their length.

Nulls and odd input: a null or empty page, or one without text, gives an empty text of 0 characters. Broken markup ends where the
page ends; an element that is never closed excludes nothing. Null ids and repeated rows are kept as they are; extra columns are not read.
"""

from __future__ import annotations

import html
import re
from bisect import bisect_left
from collections.abc import Iterator
from heapq import heapify, heappop, heappush

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from subspan.llm.registry import query
from subspan.llm.tables import table
from subspan.llm.words import slices

WINDOW, SURGE, NEAR = 3, 86, 12
ARTICLE, MAIN, SHARE = 2, 512, 8
LARGE = 512  # characters of a large element

_MARKUP = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<(?P<raw>script|style|textarea|title|noscript|template|iframe|xmp)\b[^>]*>.*?(?:</(?P=raw)\s*>|\Z)"
    r"|<(?P<end>/?)(?P<name>[a-z][a-z0-9:-]*)(?P<attributes>(?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+|[^>]*)>"
    r"|<[!?][^>]*>",
    re.IGNORECASE | re.DOTALL,
)
_ATTRIBUTE = re.compile(r"(?:^|\s)(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.IGNORECASE)
_PARTS = re.compile(r"[^a-z]+")

# Elements that don't end a block.
_INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label mark q rp rt ruby s samp small span strike "
    "strong sub sup time tt u var wbr".split()
)
_SPACE = frozenset(("br", "td", "th"))
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_BODY = frozenset(("article", "main"))
_EXCLUDED = frozenset("aside button dialog footer head header menu nav object select svg".split())
_EXCLUDED_WORDS = frozenset(
    "ad ads advert adverts advertisement alert banner breadcrumb breadcrumbs comment comments complementary consent contentinfo cookie "
    "cookies copyright dialog disqus footer form gdpr header login masthead menu modal nav navbar navigation newsletter notice popup "
    "promo promoted promotion related respond search share sharing sidebar signup skip social sponsor sponsored subscribe toolbar "
    "widget widgets".split()
)
_CONTENT_WORDS = frozenset("article content entry main post story".split())
_STATES = frozenset("has is no not with without".split())  # a class that begins so says what a page has
_HEADS = frozenset(("article", "h1", "main"))


def _named_so(attributes: str) -> bool:
    """Whether a class, id or role begins or ends with a word for what is no article, and none is a word for one."""
    found = False
    for _, *values in _ATTRIBUTE.findall(attributes):
        for token in "".join(values).lower().split():
            parts = [x for x in _PARTS.split(token) if x]
            if not parts or parts[0] in _STATES:
                continue
            if not _CONTENT_WORDS.isdisjoint(parts):
                return False
            found = found or parts[0] in _EXCLUDED_WORDS or parts[-1] in _EXCLUDED_WORDS
    return found


class _Soft:
    """An element that is excluded unless the page's text is in it."""

    def __init__(self, parent: int, name: str) -> None:
        self.parent, self.name = parent, name
        self.own = self.mass = 0  # weighted length of its lines, without and with those of such elements inside
        self.heads = False


def _exempt(softs: list[_Soft], rest: int) -> set[int]:
    """Numbers of the elements that hold the text; ``rest``: the weighted length of the lines outside of all of them.

    The longest comes first. It is the text where it holds a heading or a main element and more than all outside; where it is large and
    ``SHARE`` times as much; or where nothing is outside and it is large, a form or holds an article. What is inside is judged then.
    """
    inside: dict[int, list[int]] = {}
    for k in range(len(softs) - 1, 0, -1):
        inside.setdefault(softs[k].parent, []).append(k)
        if softs[k].parent:
            above = softs[softs[k].parent]
            above.mass, above.heads = above.mass + softs[k].mass, above.heads or softs[k].heads
    out = set()
    todo = [(-softs[k].mass, k) for k in inside.get(0, ())]
    heapify(todo)
    while todo:
        mass, k = heappop(todo)
        x, mass = softs[k], -mass
        alone = not rest and (mass >= LARGE or x.name == "form" or x.heads)
        if mass >= SURGE and (alone or (x.heads and mass > rest) or (mass >= LARGE and mass >= SHARE * rest)):
            out.add(k)
            rest += x.own
            for c in inside.get(k, ()):
                heappush(todo, (-softs[c].mass, c))
    return out


def _lines(page: str, marked: bool = False) -> tuple[list[tuple[str, int, int]], list[int]]:
    """Text, length outside links and element of each line, a blank one for what is excluded; and the weight of each element.

    Element 0 is what is outside of any ``<article>`` or ``<main>``; nested ones are one element. ``marked`` keeps articles whatever
    their class, id or role. One pass over the page and one over its lines.
    """
    lines: list[tuple[str, int, int, int]] = []  # the last: the innermost soft element
    weights, softs = [1], [_Soft(0, "")]
    text: list[str] = []
    linked, in_link, inside, at = 0, 0, 0, 0
    skipping, depth = "", 0
    open_: list[list] = []  # soft elements: name, depth of that name, number, what was open outside
    closed: dict[str, int] = {}

    def closes(name: str, begin: int) -> bool:
        """Whether an end tag of that name follows; a page is searched once for each name."""
        if closed.get(name, 0) is not None and closed.get(name, 0) < begin:
            found = re.compile(f"</{re.escape(name)}", re.IGNORECASE).search(page, begin)
            closed[name] = found.start() if found else None
        return closed[name] is not None

    def add(piece: str) -> None:
        nonlocal linked
        text.append(piece)
        if in_link:
            linked += len(html.unescape(piece).strip())

    def flush() -> None:
        nonlocal linked
        line = " ".join(html.unescape("".join(text)).split())
        if line:
            place(line, max(0, len(line) - linked))
        text.clear()
        linked = 0

    def place(line: str, size: int) -> None:
        lines.append((line, size, len(weights) - 1 if inside else 0, open_[-1][2] if open_ else 0))

    for m in _MARKUP.finditer(page):
        if not skipping and m.start() > at:
            add(page[at : m.start()])
        at = m.end()
        name = (m["name"] or "").lower()
        if not name:  # a comment, a declaration or an element whose content is no markup
            if m["raw"] and not skipping:
                flush()
            continue
        closing = bool(m["end"])
        whole = m["attributes"].endswith("/")
        if skipping:
            if name == skipping and not whole:
                depth += -1 if closing else 1
                if not depth:
                    skipping = ""
            continue
        if name == "a":
            in_link = max(0, in_link + (-1 if closing else 1))
        if not closing and name not in _VOID and name not in ("main", "body", "html") and not (name == "article" and marked):
            hard = name in _EXCLUDED and not (name == "header" and inside)
            soft = name == "form" or name not in _EXCLUDED and _named_so(m["attributes"])
            if (hard or soft) and closes(name, at):
                if name not in _INLINE:
                    flush()
                if hard or name in _INLINE:
                    skipping, depth = name, 1
                    if name not in _INLINE:
                        place("", 0)
                    continue
                softs.append(_Soft(open_[-1][2] if open_ else 0, name))
                open_.append([name, 0, len(softs) - 1, inside, in_link])
                place("", 0)
        if open_ and name == open_[-1][0] and not whole:
            open_[-1][1] += -1 if closing else 1
            if not open_[-1][1]:
                flush()
                *_, inside, in_link = open_.pop()
                continue
        if open_ and name in _HEADS and not (name == open_[-1][0] and open_[-1][1] == 1):
            softs[open_[-1][2]].heads = True
        if name in _SPACE:
            add(" ")
        elif name not in _INLINE:
            flush()
            if name in _BODY:
                if not closing and not inside:
                    weights.append(ARTICLE)
                inside = max(0, inside + (-1 if closing else 1))
                if not closing and name == "main":
                    weights[-1] = MAIN
    if not skipping:
        add(page[at:])
    flush()
    rest = 0
    for _, size, element, cover in lines:
        if cover:
            softs[cover].own += size * weights[element]
        else:
            rest += size * weights[element]
    for x in softs[1:]:
        x.mass = x.own
    exempt = _exempt(softs, rest)
    outermost = [0] * len(softs)  # of the excluded elements that each stands in
    for k in range(1, len(softs)):
        outermost[k] = outermost[softs[k].parent] or (0 if k in exempt else k)
    out, begun = [], set()
    for line, size, element, cover in lines:
        top = outermost[cover]
        if not top and (line or not cover):
            out.append((line, size, element))
        elif top and top not in begun:
            begun.add(top)
            out.append(("", 0, element))
    return out, weights


def extract(page: str | None, window: int = WINDOW, surge: int = SURGE) -> str:
    lines, weights = _lines(page or "")
    if not any(text for text, _, _ in lines):
        lines, weights = _lines(page or "", marked=True)
    sizes = np.array([size for _, size, _ in lines], dtype=np.int64)
    elements = np.array([element for _, _, element in lines], dtype=np.int64)
    keep = elements > 0
    if sizes.any():
        masses = np.bincount(elements, sizes, len(weights)) * weights
        regions = _regions(sizes, elements, window, surge)
        kept = [r for r in regions if r[2]]
        if not kept and not masses[1:].any():
            kept = [max(regions, key=lambda r: sizes[r[0] : r[1]].sum())]
        masses[0] = sum(sizes[a:b].sum() for a, b, _ in kept)
        stays = SHARE * masses >= masses.max()
        if masses[0] < masses.max():
            stays[1:] = True
        keep &= stays[elements]
        place = np.cumsum(elements == 0)  # lines of elements don't part regions
        for a, b, _ in regions if stays[0] else ():
            i = bisect_left(kept, (a,))
            if any(place[a] - place[d - 1] <= NEAR + 1 and place[c] - place[b - 1] <= NEAR + 1 for c, d, _ in kept[max(i - 1, 0) : i + 1]):
                keep[a:b] = True
    return "\n\n".join(text for (text, _, _), k in zip(lines, keep, strict=True) if k and text)


def _regions(sizes: np.ndarray, elements: np.ndarray, window: int, surge: int) -> list[tuple[int, int, bool]]:
    """First line, line after the last and whether it surges, of each region outside of any element."""
    regions = []
    at = np.flatnonzero((sizes > 0) & (elements == 0))
    # Lines further apart than a window have one of sum 0 between them.
    for run in np.split(at, np.flatnonzero((np.diff(at) > window) | (np.diff(np.cumsum(elements)[at]) > 0)) + 1):
        if len(run):
            a, b = int(run[0]), int(run[-1]) + 1
            sums = np.convolve(sizes[a:b], np.ones(window, dtype=np.int64))[window - 1 :]  # of the lines i to i + window - 1
            regions.append((a, b, bool((sums >= surge).any())))
    return regions


def _extracted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches, "html"):
        texts = [extract(x) for x in batch.column("html").to_pylist()]
        columns = [batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())]
        yield pa.RecordBatch.from_arrays(columns, names=["page_id", "url", "text", "n_chars"])


def main_texts(pages: DataFrame) -> DataFrame:
    """page_id, url, text and n_chars of every row of ``pages`` (page_id, url, html)."""
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html"))
    return rows.mapInArrow(_extracted, "page_id long, url string, text string, n_chars long")


@query("op6_extract_text")
def op6_extract_text(spark: SparkSession, folder: str) -> DataFrame:
    return main_texts(table(spark, folder, "pages"))
