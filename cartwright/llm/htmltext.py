"""Main text of web pages: text-to-tag ratios per block, smoothed and clustered."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Element names by their role in a page.
BLOCKS = frozenset(
    "address article aside blockquote body center dd details dialog div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol p pre section summary table tbody td tfoot "
    "th thead tr ul".split()
)
SELF_CLOSING = frozenset({"p", "li", "dt", "dd", "tr", "td", "th"})
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
UNREAD = frozenset(
    "script style noscript template head title nav footer aside form button select option textarea iframe svg "
    "canvas dialog menu object audio video".split()
)
BOUNDARY = frozenset({"article", "main"})
#: Elements that are parts of a text, so never its region.
PARTS = SELF_CLOSING | frozenset(
    "h1 h2 h3 h4 h5 h6 hgroup address blockquote pre figure figcaption details summary ul ol dl "
    "table thead tbody tfoot legend fieldset".split()
)
#: Blocks of running text, which belong to the content they adjoin, however short.
PROSE = frozenset("h1 h2 h3 h4 h5 h6 hgroup p pre blockquote figure figcaption".split())
#: Words in class, id or role that mark what isn't the article, if a name has no other words than these and PLACES.
MARKS = frozenset(
    "ad ads advert adverts advertisement banner sponsor sponsored promo promotion nav navbar navigation menu "
    "breadcrumb breadcrumbs sidebar complementary cookie cookies consent notice popup modal overlay newsletter "
    "subscribe subscription share sharing social related recommended comment comments disqus reply replies "
    "footer contentinfo masthead copyright login signup search widget toolbar pagination pager".split()
)
#: Words that say where or what shape such an element is, not what is in it.
PLACES = frozenset(
    "site post posts entry area list section box block container wrapper wrap inner outer bar buttons button links link "
    "item items form thread primary secondary top bottom left right header global sticky".split()
)
_WORDS = re.compile(r"[a-z]+")
_CUT_TAG = re.compile(r"<(?:[a-zA-Z/!?][^<>]*)?\Z")


def marks(names: str) -> int:
    """2 if a whole name of class, id or role says that the element isn't the article, 1 if a word within a
    name does, which a layout wrapper can have too, else 0."""
    found = 0
    for name in names.lower().split():
        words = set(_WORDS.findall(name))
        if words & MARKS:
            found = max(found, 2 if words <= MARKS | PLACES else 1)
    return found


@dataclass(frozen=True)
class Ratios:
    """``sigma``: of the Gaussian over neighbouring blocks; ``share``: a block is content at this
    share of the standard deviation of the smoothed ratios; ``cover``: article and main elements that hold this
    share of the content's characters hold the region."""

    sigma: float = 1.0
    share: float = 1.0
    cover: float = 0.9


class Outline(HTMLParser):
    """Turns parser events into blocks: text, tags met, innermost container, and
    whether the kind of an element around it says that it is something else than content."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.parent, self.name, self.mark = [-1], [""], [0]  # of each container; 0 is the page
        self.open: list[tuple[str, int, bool, bool]] = [("", 0, False, False)]  # element, container, unread, unread or marked
        self.times: Counter[str] = Counter()  # of the names of open elements
        self.blocks: list[tuple[str, int, int, bool]] = []
        self._text: list[str] = []
        self._tags = 0

    def end_block(self) -> None:
        text = " ".join("".join(self._text).split())
        if text:
            _, container, unread, _ = self.open[-1]
            self.blocks.append((text, self._tags, container, unread))
            self._tags = 0
        self._text.clear()

    def handle_starttag(self, tag: str, attrs: list) -> None:
        self._tags += 1
        if tag == "br":
            self._text.append(" ")
        if tag not in BLOCKS and tag not in UNREAD:
            return
        self.end_block()
        if tag in VOID:
            return
        if tag in BOUNDARY:
            # An article never stands in a menu or an advert: those were left open.
            while self.open[-1][3] and len(self.open) > 1:
                self.times[self.open.pop()[0]] -= 1
        elif tag in SELF_CLOSING:
            self._close(tag, stop=BLOCKS - SELF_CLOSING)
        _, container, unread, aside = self.open[-1]
        in_article = any(self.times[name] for name in BOUNDARY)
        other = tag in UNREAD or tag == "header" and not in_article
        mark = 0
        if not other and tag not in BOUNDARY and tag not in ("body", "html"):
            mark = marks(" ".join(v for k, v in attrs if k in ("class", "id", "role") and v))
        self.parent.append(container)
        self.name.append(tag)
        self.mark.append(mark)
        self.times[tag] += 1
        self.open.append((tag, len(self.parent) - 1, unread or other, aside or other or mark == 2))

    def _close(self, tag: str, stop: frozenset = frozenset()) -> None:
        if not self.times[tag]:
            return
        for k in range(len(self.open) - 1, 0, -1):
            name = self.open[k][0]
            if name == tag:
                self.times.subtract(one[0] for one in self.open[k:])
                del self.open[k:]
                return
            if name in stop:
                return

    def handle_endtag(self, tag: str) -> None:
        self._tags += 1
        if tag in BLOCKS or tag in UNREAD:
            self.end_block()
            self._close(tag)

    def handle_data(self, data: str) -> None:
        if not self.open[-1][2]:
            self._text.append(data)
        elif data.strip():
            self._text.append(data)


def outline(html: str) -> Outline:
    found = Outline()
    found.feed(_CUT_TAG.sub("", html))
    found.close()
    found.end_block()
    return found


def smoothed(ratios: np.ndarray, sigma: float) -> np.ndarray:
    reach = max(1, int(3 * sigma))
    weights = np.exp(-0.5 * (np.arange(-reach, reach + 1) / sigma) ** 2)
    total = np.convolve(ratios, weights)[reach : reach + len(ratios)]
    return total / np.convolve(np.ones(len(ratios)), weights)[reach : reach + len(ratios)]


def summed(page: Outline, values: np.ndarray) -> list[int]:
    """Sums of a value of the blocks in each container and all below it."""
    out = [0] * len(page.parent)
    for (_, _, container, _), value in zip(page.blocks, values):
        out[container] += int(value)
    for k in range(len(out) - 1, 0, -1):  # children come after their parents
        out[page.parent[k]] += out[k]
    return out


def in_boundary(page: Outline) -> list[bool]:
    """For each container, whether it is an article or main element or in one."""
    out = [False] * len(page.parent)
    for k in range(1, len(out)):
        out[k] = page.name[k] in BOUNDARY or out[page.parent[k]]
    return out


def unmarked(page: Outline, level: np.ndarray, least: float, cover: float) -> np.ndarray:
    """For each block, whether no mark of an element around it counts.

    A whole name counts unless its element holds most of the page's text, and ``cover`` of that in article and main
    elements if there are any; a word within a name counts if also the smoothed ratio of most of
    the element's text is low and no article or main element is inside.
    """
    sizes = np.array([0 if unread else len(text) for text, _, _, unread in page.blocks])
    size, low = summed(page, sizes), summed(page, np.where(level < least, sizes, 0))
    bounded = in_boundary(page)
    theirs = summed(page, np.where([bounded[container] for _, _, container, _ in page.blocks], sizes, 0))
    away = [False] * len(page.parent)
    for k in range(1, len(away)):
        most = 2 * size[k] > size[0] and theirs[k] >= cover * theirs[0]
        weak = 2 * low[k] > size[k] and (bounded[k] or theirs[k] == 0)
        counts = page.mark[k] > 0 and not most and (page.mark[k] == 2 or weak)
        away[k] = away[page.parent[k]] or counts
    return np.array([not unread and not away[container] for _, _, container, unread in page.blocks], bool)


def main_text(html: str | None, settings: Ratios = Ratios()) -> str:
    """The article's blocks in page order, joined by one space; empty if there are none.

    Blocks whose smoothed text-to-tag ratio passes the threshold are content, with the headings and paragraphs
    next to them; the
    innermost container that holds all of them is their region, widened to the
    article or main element around it. Where article or main elements hold most of the content,
    only theirs counts. All of the region's blocks belong to the text, short
    ones too, but for those that an element marks as menu, notice, comment and so on.
    """
    page = outline(html or "")
    ratios = np.array([len(text) / max(1, tags) for text, tags, _, _ in page.blocks])
    if not len(ratios):
        return ""
    level = smoothed(ratios, settings.sigma)
    least = settings.share * level.std()
    readable = unmarked(page, level, least, settings.cover)
    if not readable.any():
        return ""
    content = readable & (level >= least)
    if not content.any():
        content = readable
    for order in (range(len(content)), range(len(content) - 1, -1, -1)):
        near = False
        for k in order:
            near = bool(content[k]) or near and bool(readable[k]) and page.name[page.blocks[k][2]] in PROSE
            content[k] = near
    bounded = in_boundary(page)
    theirs = content & np.array([bounded[container] for _, _, container, _ in page.blocks], bool)
    sizes = np.array([len(text) for text, _, _, _ in page.blocks])
    if sizes[theirs].sum() >= settings.cover * sizes[content].sum():
        content = theirs
    inside = summed(page, content)
    region = 0
    for k in range(1, len(page.parent)):  # the last that qualifies is the innermost
        if inside[k] == inside[0]:
            region = k
    up = region
    while up > 0 and page.name[up] not in BOUNDARY:
        up = page.parent[up]
    region = up or region
    while page.name[region] in PARTS:
        region = page.parent[region]
    within = {region}
    for k in range(region + 1, len(page.parent)):
        if page.parent[k] in within:
            within.add(k)
    return " ".join(b[0] for b, mine in zip(page.blocks, readable) if mine and b[2] in within)


def extract(pages: DataFrame, settings: Ratios = Ratios(), key: str = "page_id") -> DataFrame:
    """``key, url, text, n_chars`` of each row; null html is empty, repeated rows stay."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(html, settings) for html in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())],
                names=[key, "url", "text", "n_chars"],
            )

    rows = pages.select(F.col(key), F.col("url"), F.col("html"))
    return rows.mapInArrow(run, f"{key} {dict(rows.dtypes)[key]}, url string, text string, n_chars long")
