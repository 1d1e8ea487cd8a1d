"""Main-text extraction: flat text blocks, classified by a decision tree on their own and their neighbours' features.

A page is cut into flat blocks at block-level tags. The tree sees of each block its number of words, the share of its
characters that are links, both again for the blocks before and after it, whether it ends like a sentence, whether it is
a paragraph, a heading or a list item, and the share of the page's words that lies in main regions. What open elements say
(a main region, a side region, reader comments) is three more features, and a split takes one of them only where it is
clearly better (``NAME_HANDICAP``). The tree is grown here on the labelled pages of ``training_rows``, half of which have no
names of regions at all.

Names count only as whole class or id tokens whose parts are all known, so ``related-work`` says nothing. The open elements
are kept with positions by tag and by what they say, so a page takes time in proportion to its length however deep it is.

Unseen elements are open elements like others, their text is left out. A head ends at the first tag or text that
cannot stand in it. An unseen element that is never closed ends with an element around it or at the next tag of a block
or landmark; a title or frame without an end tag likewise, a script or style at an end tag of its parent or the next
landmark.

Defined cases: null and empty pages, and pages without a kept block, give the empty text; unclosed comments, and unclosed
tags where nothing named above follows, end with the page; unknown tags are block-level; unfinished character references
stay as they are. Pages do not depend on each other, so repeated rows give equal results; other columns pass through.
"""

from __future__ import annotations

import html
import re
from bisect import bisect_left
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

TOKEN = re.compile(r"""<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(?P<end>/?)(?P<tag>[a-zA-Z][^\s/>]*)(?P<rest>(?:[^>"']|"[^"]*"|'[^']*')*+)(?:>|\Z)|<(?P<end2>/?)(?P<tag2>[a-zA-Z][^\s/>]*)(?P<rest2>[^>]*)(?:>|\Z)|(?P<text>[^<]+|<)""", re.S)
NAMES = re.compile(r"""(?:class|id|role|itemprop)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
NAME_PART = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")

# HTML's elements without content, of running text, of unseen content, and its landmarks; and names in
# use for regions.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
MATH = frozenset("math mi mn mo ms mtext mspace mrow mfrac msqrt mroot mstyle merror mpadded mphantom msub msup msubsup munder mover munderover mmultiscripts mprescripts mtable mtr mtd semantics".split())
INLINE = MATH | frozenset("a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q rp rt ruby s samp small span strike strong sub sup time tt u var wbr".split())
UNSEEN = frozenset("script style noscript template textarea title select iframe svg object canvas button audio video head datalist annotation annotation-xml".split())
RAW = frozenset("script style textarea title iframe".split())
IN_HEAD = frozenset("base link meta noscript script style template title".split())
SEALED = frozenset("noscript object select template".split())  # no end tag of an element around them ends them
FOREIGN = frozenset("svg math".split())  # where a slash closes a tag
REGION = frozenset("nav footer aside form menu dialog search".split())
MAIN = frozenset("article main".split())
ENDS_PARAGRAPH = frozenset("address article aside blockquote details div dl fieldset figure footer form h1 h2 h3 h4 h5 h6 header hr li main menu nav ol p pre section table ul".split())
LANDMARK = REGION | MAIN | frozenset("body header".split())
LANDMARK_TAG, BLOCK_TAG = ("<(?:" + "|".join(sorted(tags)) + r")(?=[\s/>])" for tags in (LANDMARK, LANDMARK | ENDS_PARAGRAPH))
SIDE_NAMES = frozenset(
    "ad ads adv advert advertisement advertising banner promo promotion sponsor sponsored sponsors cookie cookies consent notice notices gdpr alert newsletter subscribe subscription signup popup modal overlay "
    "menu nav navbar navigation breadcrumb breadcrumbs sidebar widget widgets related recommended recommendations share sharing social footer masthead copyright login search searchbox toolbar skip "
    "pagination pager tagcloud topbar sidenav complementary contentinfo privacy disclaimer".split()
)
COMMENT_NAMES = frozenset("comment comments commentlist reply replies respond disqus guestbook".split())
MAIN_NAMES = frozenset("article articlebody main content post entry story".split())
GENERIC_NAMES = frozenset("area bar block body box button buttons container footer group header inner item items left link links list outer panel right row section site text title top bottom wrap wrapper".split())
KNOWN_NAMES = SIDE_NAMES | COMMENT_NAMES | MAIN_NAMES | GENERIC_NAMES
PARAGRAPHS = frozenset("p blockquote pre figcaption summary dd".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6 hgroup".split())
LIST_ITEMS = frozenset("li dt td th".split())


@dataclass
class Element:
    """An open element and what it says about the blocks inside it."""

    tag: str
    side: bool = False
    comment: bool = False
    main: bool = False
    unseen_from: int | None = None  # where the tag of an unseen element is
    closed: bool = False  # an unseen element with an end tag of its own


@dataclass
class Block:
    """A flat run of text."""

    tag: str
    side: bool
    comment: bool
    main: bool
    parts: list[str] = field(default_factory=list)
    linked: list[str] = field(default_factory=list)


FEATURES = ("words", "links", "words_before", "links_before", "words_after", "links_after", "sentence", "paragraph", "heading", "item", "main_share", "side", "comment", "main")


def _element(tag: str, rest: str) -> Element:
    side, comment, main = tag in REGION, False, tag in MAIN
    if "=" in rest and tag not in ("body", "html"):  # their names describe a layout, not a region
        for groups in NAMES.findall(rest):
            for token in "".join(groups).split():
                parts = {part.lower() for part in NAME_PART.findall(token)}
                if parts and parts <= KNOWN_NAMES:
                    side |= bool(parts & SIDE_NAMES)
                    comment |= bool(parts & COMMENT_NAMES)
                    main |= bool(parts & MAIN_NAMES) and not parts & (SIDE_NAMES | COMMENT_NAMES)
    return Element(tag, side, comment, main)


class OpenElements:
    """A stack of elements with the positions of each tag, and of those that say something, at hand."""

    def __init__(self) -> None:
        self.stack: list[Element] = []
        self.by_tag: defaultdict[str, list[int]] = defaultdict(list)
        self.lists: dict[str, list[int]] = {name: [] for name in ("side", "comment", "main", "block", "sealed", "unclosed", "unseen")}

    def _says(self, element: Element) -> Iterator[str]:
        if element.side:
            yield "side"
        if element.comment:
            yield "comment"
        if element.main:
            yield "main"
        if element.tag not in INLINE:
            yield "block"
        if element.unseen_from is not None:
            yield "unseen"
            if element.closed and element.tag in SEALED:
                yield "sealed"
            if not element.closed and element.tag != "head":
                yield "unclosed"

    def push(self, element: Element) -> None:
        place = len(self.stack)
        self.stack.append(element)
        self.by_tag[element.tag].append(place)
        for name in self._says(element):
            self.lists[name].append(place)

    def cut(self, place: int) -> None:
        """The elements from this place end."""
        while len(self.stack) > place:
            element = self.stack.pop()
            self.by_tag[element.tag].pop()
            for name in self._says(element):
                self.lists[name].pop()

    def last(self, tag: str) -> int | None:
        places = self.by_tag.get(tag)
        return places[-1] if places else None

    def first_of(self, name: str) -> int | None:
        return self.lists[name][0] if self.lists[name] else None

    def last_of(self, name: str) -> int | None:
        return self.lists[name][-1] if self.lists[name] else None

    def holds_block(self, begin: int, end: int | None) -> bool:
        """Whether an element that is not inline lies between two places."""
        places = self.lists["block"]
        at = len(places) if end is None else bisect_left(places, end)
        return at > 0 and places[at - 1] >= begin

    def block(self) -> Block:
        """A block with what the open elements say; the innermost main region parts inner from outer names."""
        main, side, inner = self.last_of("main"), self.last_of("side"), self.last_of("block")
        header = main is None and self.last("header") is not None
        return Block(
            self.stack[inner].tag if inner is not None else "",
            side is not None and side >= (main or 0) or header,
            bool(self.lists["comment"]),
            main is not None,
        )


def _raw_end(page: str, tag: str, at: int, parent: str | None, foreign: bool, without_end: set[str]) -> int:
    """Where the raw text of an element ends that begins at ``at``; ``without_end`` collects tags with no end tag left."""
    if foreign:
        stop = re.compile(rf"</(?:{tag}(?=[\s/>])[^>]*>|(?=svg|math))", re.I).search(page, at)
        if stop:
            return stop.end() if stop[0] != "</" else stop.start()
    if tag not in without_end:
        stop = re.compile(rf"</{tag}(?=[\s/>]|\Z)[^>]*(?:>|\Z)", re.I).search(page, at)
        if stop:
            return stop.end()
        without_end.add(tag)
    ends = LANDMARK_TAG if tag in ("script", "style") else BLOCK_TAG  # code may hold tags as text
    if parent:
        ends = rf"</{re.escape(parent)}(?=[\s/>])|{ends}"
    stop = re.compile(ends, re.I).search(page, at)
    return stop.start() if stop else len(page)


def _closed(page: str) -> set[int]:
    """Places of the tags of unseen elements that have an end tag of their own."""
    out: set[int] = set()
    opened: dict[str, list[int]] = {tag: [] for tag in UNSEEN | FOREIGN}
    without_end: set[str] = set()
    at = 0
    while at < len(page):
        found = TOKEN.match(page, at)
        start, at = at, found.end()
        tag = (found["tag"] or found["tag2"] or "").lower()
        if tag not in opened:
            continue
        slash = (found["rest"] or "").endswith("/")
        if found["end"] or found["end2"]:
            if opened[tag]:
                out.add(opened[tag].pop())
        elif tag in RAW:
            foreign = any(opened[t] for t in FOREIGN)
            if not (foreign and slash):
                at = _raw_end(page, tag, at, None, foreign, without_end)
        elif not slash:
            opened[tag].append(start)
    return out


def flat_blocks(page: str) -> list[tuple[str, float, Block]]:
    """Text, share of linked characters and region of every block with text, in page order."""
    out: list[tuple[str, float, Block]] = []
    opened = OpenElements()
    stack = opened.stack
    block: Block | None = None
    closed: set[int] | None = None
    without_end: set[str] = set()
    at = 0

    def close() -> None:
        nonlocal block
        if block is not None:
            text = " ".join("".join(block.parts).split())
            if text:
                out.append((text, min(1.0, len(" ".join("".join(block.linked).split())) / len(text)), block))
            block = None

    def is_closed(start: int) -> bool:
        nonlocal closed
        if closed is None:
            closed = _closed(page)
        return start in closed

    while at < len(page):
        found = TOKEN.match(page, at)
        start, at = at, found.end()
        text = found["text"]
        unseen = opened.first_of("unseen")  # place of the outermost unseen element
        if text is not None:
            if unseen is not None and stack[-1].tag == "head" and not text.isspace():
                opened.cut(len(stack) - 1)
                unseen = opened.first_of("unseen")
            if unseen is None:
                block = block or opened.block()
                text = html.unescape(text)
                block.parts.append(text)
                if opened.last("a") is not None:
                    block.linked.append(text)
            continue
        tag = (found["tag"] or found["tag2"] or "").lower()
        if not tag:
            continue
        rest = found["rest"] or ""
        if found["end"] or found["end2"]:
            place = opened.last(tag)
            if unseen is not None:
                if place is None:
                    continue
                if place >= unseen:
                    opened.cut(place)
                    continue
                if opened.lists["sealed"]:
                    continue
            if tag not in INLINE:
                close()
            elif tag == "br" and block is not None:
                block.parts.append(" ")
            if tag not in VOID and place is not None and not (tag in INLINE and opened.holds_block(place, unseen)):
                opened.cut(place)
            continue
        if unseen is not None:
            if tag in ENDS_PARAGRAPH or tag in LANDMARK:
                place = opened.first_of("unclosed")
                if place is not None:
                    opened.cut(place)
            if opened.lists["unseen"] and stack[-1].tag == "head" and tag not in IN_HEAD:
                opened.cut(len(stack) - 1)
            unseen = opened.first_of("unseen")
        foreign = (tag in RAW or rest.endswith("/")) and any(opened.last(t) is not None for t in FOREIGN)
        if foreign and rest.endswith("/") and tag not in VOID:
            continue
        if tag in RAW:
            at = _raw_end(page, tag, at, stack[-1].tag if stack else None, foreign, without_end)
            continue
        if tag in UNSEEN:
            if not rest.endswith("/"):
                opened.push(Element(tag, unseen_from=start, closed=is_closed(start)))
            continue
        if unseen is not None:
            if tag not in VOID:
                opened.push(Element(tag))
            continue
        if tag not in INLINE:
            close()
        elif tag == "br" and block is not None:
            block.parts.append(" ")
        if tag in VOID:
            continue
        if tag in ENDS_PARAGRAPH:
            place = opened.last_of("block")
            if place is not None and (stack[place].tag == "p" or tag == "li" and stack[place].tag == "li"):
                opened.cut(place)
        opened.push(_element(tag, rest or found["rest2"] or ""))
    close()
    return out


def features(blocks: list[tuple[str, float, Block]]) -> np.ndarray:
    """One row per block, in the order of ``FEATURES``."""
    size = np.array([len(text.split()) for text, _, _ in blocks], float)
    links = np.array([share for _, share, _ in blocks], float)
    total = max(size.sum(), 1.0)
    shift = lambda x, by: np.concatenate([[0.0], x])[: len(x)] if by < 0 else np.append(x, 0.0)[1:]
    says = np.array([[b.side, b.comment, b.main] for _, _, b in blocks], float).reshape(-1, 3)
    # Words of the page in main regions, without what names or neighbours set apart there.
    inside = says[:, 2] * (1 - says[:, 0]) * (1 - says[:, 1])
    shape = np.array([[text[-1:] in ".!?…:;\"'”»)", b.tag in PARAGRAPHS, b.tag in HEADINGS, b.tag in LIST_ITEMS] for text, _, b in blocks], float).reshape(-1, 4)
    share = np.full(len(size), (size * inside).sum() / total)
    return np.column_stack([size, links, shift(size, -1), shift(links, -1), shift(size, 1), shift(links, 1), shape, share, says])


# The labelled table: pages of the usual kinds, every block marked + (main text) or - (not). A number stands for that
# many words of text, so each page is read once for every factor in SIZES.
SIZES = (1, 2, 4)
LABELLED = (
    # Pages with names of regions.
    "<nav><ul><li><a>-1</a><li><a>-2</a><li><a>-1</a></ul></nav><div class=ad>-6</div><article><h1>+7</h1><p>+40<p>+3<p>+12</article><footer>-5</footer>",
    "<header><div>-2</div><a>-1</a></header><main><h1>+5</h1><p>+20</p><p>+1</p><ul><li>+6<li>+9</ul><aside>-12</aside><p>+30</p></main><footer><p>-8</p><a>-2</a></footer>",
    "<div id=menu><a>-1</a><a>-1</a></div><div class=content><h2>+4</h2><p>+25</p><div class='share social'><a>-2</a></div><p>+18</p><div class=comments><p>-20</p><p>-9</p></div></div><div id=sidebar><p>-15</p><a>-3</a></div>",
    "<div class='layout sidebar'><article class=post><h1>+6</h1><p>+3</p><p>+33</p><p>+2</p></article></div><div class=comment><article><p>-16</p></article></div>",
    "<div class=cookie-notice><p>-14</p></div><article><p>+9</p><form><p>-7</p></form><section class=newsletter><h3>-3</h3><p>-10</p></section><p>+11</p><blockquote>+8</blockquote></article>",
    "<main><nav><a>-2</a></nav><p>+5</p><p>+1</p><section id=related><h2>-2</h2><a>-6</a><p>-12</p></section><section class=comments><h2>-2</h2><p>-25</p></section></main>",
    "<article><h1>+3</h1><p>+2</p><p><a>+1</a> +9</p><div class=advert>-11</div><p>+1</p></article><div class=disclaimer>-30</div>",
    "<div class=story><p>+7</p><p>+4</p><div id=respond><p>-6</p></div></div><form><p>-4</p><label>-2</label></form>",
    "<nav><a>-2</a></nav><article><h1>+5</h1><p><a>+6</a></p><p>+12</p><ul><li><a>+4</a><li><a>+3</a><li><a>+5</a></ul></article><div>-20</div><div>-9</div>",
    "<ul><li><a>-1</a><li><a>-2</a></ul><div id=content><h1>+4</h1><ul><li><a>+3</a><li><a>+4</a><li><a>+3</a></ul><p>+8</p></div><div>-3</div><p>-12</p>",
    "<article><h1>+4</h1><div>+22</div><div>+9</div><div>+2</div></article><p>-18</p><p>-25</p><ul><li><a>-3</a></ul>",
    "<main><p>+3</p><p><a>+9</a></p><div>+14</div></main><div>-16</div><footer><div>-22</div></footer>",
    "<p>-30</p><div>-25</div><article><h1>+3</h1><p>+8</p><ul><li>+6<li>+5<li>+7</ul></article><div>-1</div><p>-28</p>",
    "<nav><a>-2</a></nav><main><div>+9</div><div>+5</div><div>+3</div></main><div>-1</div><p>-40</p><p>-30</p><footer><p>-9</p></footer>",
    "<div id=sidebar><p>-40</p><p>-35</p></div><div class=content><p>+6</p><table><tr><td>+2<td>+3<tr><td>+1<td>+4</table><div>+8</div></div><div class=comments><p>-50</p><p>-30</p></div>",
    "<aside><p>-20</p></aside><article><p>+4</p><dl><dt>+2<dd>+9<dt>+1<dd>+12</dl></article><aside><h2>-2</h2><p>-25</p></aside>",
    # Pages without any.
    "<div><a>-3</a></div><div><p>+40</p><p>+35</p><p>+6</p><p>+22</p></div><div><a>-2</a> -1</div><div>-3</div>",
    "<table><tr><td><a>-1</a><td><a>-2</a></table><p>+30<p>+28<p>+14<p><a>-4</a><p><a>-3</a>",
    "<ul><li><a>-2</a></li><li><a>-1</a></li></ul><h1>+6</h1><p>+21</p><p>+17</p><div>-2</div><div>-3</div>",
    "<div>-1</div><div>-2</div><p>+26</p><p>+31</p><p>+24</p><div>-4</div><div><a>-3</a></div>",
    "<ul><li><a>-1</a><li><a>-1</a><li><a>-2</a></ul><h1>+5</h1><p>+9</p><p>+7</p><p>+11</p><div>-3</div>",
    "<h1>+4</h1><p>+6</p><p>+5</p><p>+8</p>",
    "<h1>+3</h1><p>+10</p><p>+3</p><p>+4</p><ul><li><a>-2</a><li><a>-3</a></ul>",
    "<div><a>-1</a> <a>-1</a> <a>-2</a></div><h2>+4</h2><p>+12</p><h3>+2</h3><p>+6</p><ul><li>+5<li>+7<li>+3</ul><p>+9</p><div><a>-2</a></div><div>-4</div>",
    "<table><tr><td><a>-2</a><td><a>-1</a></table><h1>+6</h1><div>+33</div><div>+28</div><div>+41</div><table><tr><td>-2<td><a>-1</a></table>",
    "<div><a>-2</a></div><p>+16</p><blockquote>+12</blockquote><p>+5</p><p>+19</p><p><a>-5</a></p><p><a>-4</a></p><div>-6</div>",
    "<h1>+5</h1><p>+14 <a>+3</a> +6</p><p>+4 <a>+2</a> +9</p><pre>+8</pre><p>+2</p><div><a>-3</a> <a>-2</a></div>",
    "<ul><li><a>-1</a><li><a>-3</a></ul><div>-2</div><h1>+8</h1><h2>+3</h2><p>+7</p><p>+15</p><h2>+2</h2><p>+6</p><ul><li><a>-4</a><li><a>-2</a></ul><div>-5</div>",
)


def _cut(page: str) -> Iterator[str]:
    """The page, and the page without the words that come before or after its main text: either may be absent."""
    yield page
    first, last = page.index("+"), page.rindex("+")
    before = re.sub(r"-\d+", "", page[:first])
    after = re.sub(r"-\d+", "", page[last:])
    yield before + page[first:]
    yield page[:last] + after
    yield before + page[first:last] + after


def training_rows() -> tuple[np.ndarray, np.ndarray]:
    """Features and labels of the blocks of the labelled pages."""
    rows, labels = [], []
    for page in (part for labelled in LABELLED for part in _cut(labelled)):
        for factor in SIZES:
            marked = re.sub(r"([+-])(\d+)", lambda m: ("kept " if m[1] == "+" else "gone ") * (int(m[2]) * factor - (int(m[2]) * factor > 2)) + (("kept." if m[1] == "+" else "gone.") if int(m[2]) * factor > 2 else ""), page)
            blocks = flat_blocks(marked)
            rows.append(features(blocks))
            labels += ["kept" in text for text, _, _ in blocks]
    return np.concatenate(rows), np.array(labels, int)


MOST_DEPTH = 10
# Factor on the impurity left by a split on what names say.
NAME_HANDICAP = 1.2
NAMED = tuple(FEATURES.index(name) for name in ("side", "comment", "main"))


def grown(rows: np.ndarray, labels: np.ndarray, depth: int = MOST_DEPTH):
    """A decision tree as nested (feature, threshold, below, above), its leaves the labels; splits by Gini impurity."""
    if depth == 0 or labels.min() == labels.max():
        return int(2 * labels.sum() >= len(labels))
    best = None
    for column in range(rows.shape[1]):
        values = np.unique(rows[:, column])
        for threshold in (values[1:] + values[:-1]) / 2:
            low = rows[:, column] < threshold
            impurity = sum(n * p * (1 - p) for n, p in ((m.sum(), labels[m].mean()) for m in (low, ~low)))
            impurity *= NAME_HANDICAP if column in NAMED else 1
            if best is None or impurity < best[0] - 1e-9:
                best = impurity, column, threshold, low
    if best is None:
        return int(2 * labels.sum() >= len(labels))
    _, column, threshold, low = best
    return column, float(threshold), grown(rows[low], labels[low], depth - 1), grown(rows[~low], labels[~low], depth - 1)


@cache
def tree():
    """The tree of the labelled table, grown once per process."""
    return grown(*training_rows())


def keeps(row: np.ndarray) -> bool:
    """What the tree says of a block."""
    node = tree()
    while not isinstance(node, int):
        column, threshold, below, above = node
        node = below if row[column] < threshold else above
    return bool(node)


def main_text(page: str | None) -> str:
    """Kept blocks in page order, joined by two line feeds."""
    blocks = flat_blocks(page or "")
    if not blocks:
        return ""
    return "\n\n".join(text for (text, _, _), row in zip(blocks, features(blocks), strict=True) if keeps(row))


def extract(pages: DataFrame, html_column: str = "html", text_column: str = "text") -> DataFrame:
    """The pages with their main text instead of their html."""
    kept = [c for c in pages.columns if c not in (html_column, text_column)]
    schema = T.StructType([*[pages.schema[c] for c in kept], T.StructField(text_column, T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(page) for page in batch.column(html_column).to_pylist()]
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in kept], pa.array(texts, pa.string())], [*kept, text_column])

    return pages.mapInArrow(run, schema)


def extraction_report(pages: DataFrame) -> DataFrame:
    """Per page: its main text and its length in code points."""
    found = extract(pages.select("page_id", "url", "html"))
    return found.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))
