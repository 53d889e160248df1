"""Main text of web pages by smoothed text-to-tag ratios (operator 3).

The standard library's parser streams events. Block tags cut the page into lines; each
line has its characters and its tags, hence a text-to-tag ratio. The ratios are smoothed
with a Gaussian over neighbouring lines, and lines above half a standard deviation over
zero form clusters. All clusters together name the content region: the innermost element
around them, or around those inside an ``article`` (else ``main``) if the cluster with most
text is. Every line of the region is kept, so that tables, lists and short paragraphs
between clusters stay; where the region is the whole page, lines before the first and after
the last cluster go.

Elements that never hold the article (``nav``, ``footer``, ``aside``, ``form``, ``script``,
...; ``header`` outside an article) are left out of lines. So are elements whose class, id or
role names are such a word as a whole (``ad``, ``comments``); a word that is only part of a
name (``cookie-notice``, ``related-work``) counts outside ``article`` and ``main`` alone.

Time and memory are linear in the page: elements know their parent only, and the innermost
common element comes from counts of lines passed up once.

Defined results: null or empty html, and pages without text, give an empty text with
``n_chars`` 0; unclosed or stray tags never fail; null ids stay; equal rows give equal
rows; other columns are ignored. Whole pages are parsed, of any length.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

SCHEMA = "page_id bigint, url string, text string, n_chars bigint"

# fixed values: elements of HTML
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption figure footer "
    "form h1 h2 h3 h4 h5 h6 header hr html legend li main nav ol option p pre section summary table tbody td tfoot th "
    "thead tr ul".split()
)
BOILERPLATE = frozenset(
    "aside button dialog footer form head header iframe input nav noscript object option script select style svg "
    "template textarea title".split()
)
HINTS = frozenset(
    "ad ads advert advertisement adverts banner breadcrumb breadcrumbs comment comments consent cookie cookies footer "
    "header masthead menu modal nav navbar navigation newsletter notice notices popup promo promoted related share sharing sidebar "
    "social sponsor sponsored subscribe toolbar widget".split()
)
CLOSES_P = BLOCK - {"body", "html", "td", "th", "tr", "tbody", "thead", "tfoot", "caption", "legend", "option"}
REGION = ("article", "main")  # the narrower first

_SIGMA = 1.0
_KERNEL = np.exp(-0.5 * (np.arange(-3, 4) / _SIGMA) ** 2)
_KERNEL /= _KERNEL.sum()
_TOKENS = re.compile(r"[a-z0-9]+")


class _Lines(HTMLParser):
    """Lines of a page, each with text, number of tags and open elements."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        # tag, number, inside boilerplate, inside an article or main
        self.open: list[tuple[str, int, bool, bool]] = [("", 0, False, False)]
        self.opened: Counter[str] = Counter()  # open elements by tag
        self.parent: list[int] = [0]
        self.name: list[str] = [""]
        self.text: list[str] = []
        self.tags = 0
        self.lines: list[tuple[str, int, int]] = []  # text, tags, element

    def cut(self) -> None:
        if self.text:
            text = " ".join("".join(self.text).split())
            self.text = []
            if text:
                self.lines.append((text, self.tags, self.open[-1][1]))
                self.tags = 0

    def push(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        _, above, out, inside = self.open[-1]
        inside = inside or tag in REGION
        out = out or (tag in BOILERPLATE and not (tag == "header" and inside))
        if not out and tag not in ("html", "body"):
            out = any(key == "hidden" or (key in ("class", "id", "role") and value and _hinted(value, inside)) for key, value in attrs)
        self.parent.append(above)
        self.name.append(tag)
        self.open.append((tag, len(self.parent) - 1, out, inside))
        self.opened[tag] += 1

    def close_from(self, k: int) -> None:
        """Close the element at place ``k`` of those open, and what is open inside it."""
        self.opened.subtract(entry[0] for entry in self.open[k:])
        del self.open[k:]

    def close_to(self, tag: str) -> None:
        """Close the innermost open ``tag``; one that is not open is passed over."""
        if self.opened[tag] > 0:
            k = len(self.open) - 1
            while self.open[k][0] != tag:
                k -= 1
            self.close_from(k)

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        if tag in BLOCK or tag in BOILERPLATE:
            self.cut()
        elif tag == "br":
            self.text.append(" ")
        self.tags += 1
        if tag in VOID:
            return
        if tag in CLOSES_P and (self.opened["p"] > 0 or (tag == "li" and self.opened["li"] > 0)):
            for k in range(len(self.open) - 1, 0, -1):
                name = self.open[k][0]
                if name == "p" or name == "li" == tag:
                    self.close_from(k)
                    break
                if name in BLOCK:
                    break
        self.push(tag, attrs)

    def handle_startendtag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        self.handle_starttag(tag, attrs)

    def handle_endtag(self, tag: str) -> None:
        if tag in BLOCK or tag in BOILERPLATE:
            self.cut()
        self.tags += 1
        if tag not in VOID:
            self.close_to(tag)

    def handle_data(self, data: str) -> None:
        if not self.open[-1][2]:
            self.text.append(data)


def _hinted(value: str, inside: bool) -> bool:
    """Whether a class, id or role names what is no content; see the module."""
    names = value.lower().split()
    if not HINTS.isdisjoint(names):
        return True
    return not inside and not HINTS.isdisjoint(_TOKENS.findall(value.lower()))


def high_lines(parser: _Lines) -> np.ndarray:
    """True for lines whose smoothed ratio is over the threshold."""
    ratio = np.array([len(text) / max(1, tags) for text, tags, _ in parser.lines])
    smooth = np.convolve(np.pad(ratio, 3), _KERNEL, mode="valid")
    return smooth >= min(0.5 * smooth.std(), smooth.max())


def _kept(parser: _Lines, high: np.ndarray) -> list[int]:
    """Places of the lines of the content region."""
    lines, parent, name = parser.lines, parser.parent, parser.name
    best, run, longest = 0, 0, 0
    for k, (text, _, _) in enumerate(lines):
        run = run + len(text) if high[k] else 0
        if run > longest:
            best, longest = k, run
    # Elements are numbered as they open, so parents come first.
    around: dict[str, list[bool]] = {tag: [False] * len(parent) for tag in REGION}
    for tag, held in around.items():
        for element in range(1, len(parent)):
            held[element] = name[element] == tag or held[parent[element]]
    scope = next((around[tag] for tag in REGION if around[tag][lines[best][2]]), None)
    marked = [element for k, (_, _, element) in enumerate(lines) if high[k] and (scope is None or scope[element])]
    below = [0] * len(parent)
    for element in marked:
        below[element] += 1
    for element in range(len(parent) - 1, 0, -1):
        below[parent[element]] += below[element]
    # Of elements around all marked lines, which lie inside one another, the innermost.
    top = max(element for element in range(len(parent)) if below[element] == len(marked))
    wanted = ("article", "main") if scope is not None and scope[top] else ("article", "main", "body", "div", "section", "td")
    while top and name[top] not in wanted:
        top = parent[top]
    inside = [False] * len(parent)
    inside[top] = True
    for element in range(top + 1, len(parent)):
        inside[element] = inside[parent[element]]
    if top == 0 or name[top] == "body":
        ends = np.flatnonzero(high)
        first, last = int(ends[0]), int(ends[-1])
    else:
        first, last = 0, len(lines) - 1
    return [k for k in range(first, last + 1) if inside[lines[k][2]]]


def main_text(html: str | None) -> str:
    """Main text of one page, blocks joined by an empty line."""
    if not html:
        return ""
    parser = _Lines()
    parser.feed(html)
    parser.close()
    parser.cut()
    if not parser.lines:
        return ""
    return "\n\n".join(parser.lines[k][0] for k in _kept(parser, high_lines(parser)))


def _run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for first in range(0, batch.num_rows, 500):
            part = batch.slice(first, 500)
            texts = [main_text(html) for html in part.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [part.column(0), part.column(1), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())],
                names=["page_id", "url", "text", "n_chars"],
            )


def extract_main_text(pages: DataFrame) -> DataFrame:
    """One row per page: page_id, url, text, n_chars."""
    return pages.selectExpr(
        "cast(page_id as bigint) page_id", "cast(url as string) url", "cast(html as string) html"
    ).mapInArrow(_run, SCHEMA)
