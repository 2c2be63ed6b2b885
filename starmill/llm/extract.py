"""Main text of web pages by tag-path ratios.

A page's text blocks are grouped by their path of block-level tags from the
root. A path's ratio is its text length per block, another its punctuation per
block; each is smoothed over the page's blocks in order, and both are fused
into one weight, together with the path's ratios before smoothing. Blocks whose
weight passes a threshold, set from the mean weight of the page's text, are
content, and so is what stands in one element with them, such as headings and
short paragraphs. Article and main elements are content as a whole.

Elements that are navigation, headers, footers, sidebars, forms or dialogs by
their tag take no part. Words of class, id and role attributes that say so are
evidence against an element: it is left out unless no article stands free of
such marks and it holds more than half of the page's weighted text, as a wrapper
does; reader comments are left out unless there is nothing else.
"""

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

from starmill.llm.common import map_arrow

#: Names of HTML elements.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
SILENT = frozenset("script style noscript template head title svg math iframe object canvas audio video select option button textarea".split())
ASIDE = frozenset("nav header footer aside form menu dialog".split())
INLINE = frozenset("a abbr b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q rp rt ruby s samp small span strike strong sub sup time tt u var wbr".split())
#: Words of class, id and role attributes that mark what is not the article.
MARKS = frozenset(
    "ad ads advert adverts advertisement advertising sponsor sponsored promo promotion banner cookie cookies consent gdpr notice notices alert alerts popup modal overlay "
    "nav navbar navigation menu breadcrumb breadcrumbs sidebar aside widget footer header masthead topbar toolbar pagination pager share sharing social subscribe newsletter signup login "
    "search comment comments reply replies disqus respond discussion related recommended trending teaser contentinfo complementary".split()
)
#: Elements that end an open paragraph, and those that close an open one of their own kind.
_ENDS_P = frozenset("address article aside blockquote details div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr main menu nav ol p pre section table ul".split())
_SIBLINGS = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th")}
_REGIONS = ("article", "main")


#: Those of them that mark what readers wrote, and words around them that say something else.
COMMENTS = frozenset("comment comments reply replies disqus respond discussion".split())
_BEFORE, _AFTER = frozenset("no has with without".split()), frozenset("open closed enabled disabled".split())
#: Elements of running text: what holds them is one piece of content with them.
_RUNNING = frozenset("p li dt dd ul ol dl blockquote h1 h2 h3 h4 h5 h6 hgroup table caption thead tbody tfoot tr td th figure figcaption pre details summary address".split())


@dataclass
class Element:
    parent: int
    tag: str
    #: Number of its path: the same for all elements with the same tags from the root.
    path: int
    cut: bool
    mark: str


@dataclass
class Block:
    text: str
    #: Number of its element on the page, and of the element's path.
    node: int
    path: int


def _mark(tag: str, attributes: list[tuple[str, str | None]]) -> str:
    """What an element's attributes say against it: "comment", "mark" or nothing."""
    if tag in ("html", "body"):
        return ""
    words = set()
    for key, value in attributes:
        if key in ("class", "id", "role"):
            for name in (value or "").lower().split():
                parts = [x for x in re.split(r"[^a-z0-9]+", name) if x]
                if parts and not (len(parts) > 1 and (parts[0] in _BEFORE or parts[-1] in _AFTER)):
                    words.update(parts)
    if words & COMMENTS:
        return "comment"
    # an article is left out for being a comment only
    return "mark" if words & MARKS and tag not in _REGIONS else ""


def _hidden(attributes: list[tuple[str, str | None]]) -> bool:
    return any(key == "hidden" or (key == "aria-hidden" and value == "true") for key, value in attributes)


class _Blocks(HTMLParser):
    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.blocks: list[Block] = []
        self.elements = [Element(-1, "", 0, False, "")]
        self.paths: dict[tuple[int, str], int] = {}
        self.open = [0]  # numbers of the open elements, the page itself first
        self.held: Counter = Counter()  # open elements by tag
        self.words: list[str] = []

    def flush(self) -> None:
        text = " ".join("".join(self.words).split())
        self.words = []
        node = self.open[-1]
        if text and not self.elements[node].cut:
            self.blocks.append(Block(text, node, self.elements[node].path))

    def handle_starttag(self, tag: str, attributes: list) -> None:
        mark, hidden = _mark(tag, attributes), tag not in ("html", "body") and _hidden(attributes)
        if tag in INLINE and not mark and not hidden:
            if tag == "br":
                self.words.append(" ")
            return
        if tag in VOID:
            if tag == "hr":
                self.flush()
            return
        self.flush()
        closes = _SIBLINGS.get(tag, ()) + (("p",) if tag in _ENDS_P else ())
        if any(self.held[t] for t in closes):
            self._close(lambda t: t in closes, within=tag in _SIBLINGS)
        parent = self.elements[self.open[-1]]
        path = self.paths.setdefault((parent.path, tag), len(self.paths) + 1)
        self.elements.append(Element(self.open[-1], tag, path, parent.cut or hidden or tag in SILENT or tag in ASIDE, mark))
        self.open.append(len(self.elements) - 1)
        self.held[tag] += 1

    def handle_startendtag(self, tag: str, attributes: list) -> None:
        self.handle_starttag(tag, attributes)

    def _leave(self, i: int) -> None:
        self.flush()
        for node in self.open[i:]:
            self.held[self.elements[node].tag] -= 1
        del self.open[i:]

    def _close(self, fits, within: bool = False) -> None:  # type: ignore[no-untyped-def]
        """Closes the innermost fitting element, unless a container stands between."""
        for i in range(len(self.open) - 1, 0, -1):
            tag = self.elements[self.open[i]].tag
            if fits(tag):
                self._leave(i)
                return
            if tag in ("ul", "ol", "dl", "table") if within else tag in ("table", "td", "th", "button", "object"):
                return

    def handle_endtag(self, tag: str) -> None:
        if tag in VOID or not self.held[tag]:
            return
        for i in range(len(self.open) - 1, 0, -1):
            if self.elements[self.open[i]].tag == tag:
                self._leave(i)
                return

    def handle_data(self, data: str) -> None:
        self.words.append(data)

    def close(self) -> None:
        super().close()
        self.flush()


def blocks_of(html: str) -> tuple[list[Block], list[Element]]:
    """Text blocks in page order, and all elements by number; a parent comes before its children."""
    parser = _Blocks()
    parser.feed(html)
    parser.close()
    return parser.blocks, parser.elements


def _smoothed(x: np.ndarray, reach: int = 2) -> np.ndarray:
    kernel = np.exp(-0.5 * np.arange(-reach, reach + 1) ** 2)
    padded = np.pad(x, reach, mode="edge")
    return np.convolve(padded, kernel / kernel.sum(), mode="valid")


_MARKS = re.compile(r"[^\w\s]")


def path_weights(blocks: list[Block]) -> np.ndarray:
    """Fused weight of every block: text per block of its path times punctuation per block, before and after smoothing."""
    text, marks, nodes = Counter(), Counter(), Counter()
    for b in blocks:
        text[b.path] += len(b.text)
        marks[b.path] += len(_MARKS.findall(b.text))
        nodes[b.path] += 1
    ratio = np.array([text[b.path] / nodes[b.path] for b in blocks])
    dots = np.array([marks[b.path] / nodes[b.path] for b in blocks])
    return np.sqrt(ratio * (1 + dots) * _smoothed(ratio) * (1 + _smoothed(dots)))


def _left_out(blocks: list[Block], elements: list[Element]) -> list[bool]:
    """For every element, whether it or one around it is marked and no wrapper of the page's text.

    Where an article with text stands free of marks, nothing marked is a wrapper.
    """
    held = [0.0] * len(elements)
    for b, weight in zip(blocks, path_weights(blocks), strict=True):
        held[b.node] += float(weight) * len(b.text)
    for node in range(len(elements) - 1, 0, -1):
        held[elements[node].parent] += held[node]
    under = [False] * len(elements)  # marked, or in something marked
    for node, e in enumerate(elements[1:], 1):
        under[node] = under[e.parent] or bool(e.mark)
    if any(e.tag in _REGIONS and held[node] and not under[node] for node, e in enumerate(elements)):
        return under
    out = [False] * len(elements)
    for node, e in enumerate(elements[1:], 1):
        enough = 1 - 1e-9 if e.mark == "comment" else 0.5
        out[node] = out[e.parent] or (bool(e.mark) and held[node] <= enough * held[0])
    return out


def main_text(html: str, spread: float = 0.5) -> str:
    """Blocks of content in page order, two line feeds between them; empty if a page has no text.

    ``spread`` is the share of the text's mean weight that a block must reach.
    """
    blocks, elements = blocks_of(html)
    if not blocks:
        return ""
    out = _left_out(blocks, elements)
    blocks = [b for b in blocks if not out[b.node]]
    if not blocks:
        return ""
    weights, sizes = path_weights(blocks), np.array([len(b.text) for b in blocks])
    content = weights >= spread * (weights * sizes).sum() / sizes.sum()
    kept = [e.tag in _REGIONS for e in elements]
    for b, chosen in zip(blocks, content, strict=True):
        if chosen:
            node = b.node
            while elements[node].tag in _RUNNING:
                node = elements[node].parent
            # beside an article, a block is kept for itself; text that lies bare in the page takes its neighbours along
            kept[node if elements[node].tag not in ("", "html", "body") or not any(kept) else b.node] = True
    for node, e in enumerate(elements[1:], 1):
        kept[node] = kept[node] or kept[e.parent]
    return "\n\n".join(b.text for b in blocks if kept[b.node])


def extract(pages: DataFrame) -> DataFrame:
    """One row per page: page_id, url, text, n_chars.

    Null html, an empty page and a page without text give an empty text.
    Repeated rows each give theirs; an empty table gives none. Whole pages are
    read, however long or deep. Other columns are left out.
    """
    thin = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html"))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(h.as_py() or "") for h in batch.column("html")]
            yield pa.record_batch([batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())], names=["page_id", "url", "text", "n_chars"])

    return map_arrow(thin, read, "page_id long, url string, text string, n_chars long")
