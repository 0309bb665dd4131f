"""Main text of web pages from shallow features of flat text blocks.

A page is cut into text blocks where block elements begin and end. A block is described by its number of words
and its link density, those of the blocks before and after it, and by the kind of element around it; a
decision tree, trained on the labelled blocks of ``html_labelled``, tells main text from the rest. Counts and
densities alone cannot tell a paragraph of one word from an advert of one word, so what surrounds a block is
among the tree's features.

The reader of HTML is lenient: tags may be unclosed or cut off, and what cannot be a tag is text.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from settle.llm.common import map_batches, prepare, texts
from settle.llm.html_labelled import pages as labelled_pages

# --- fixed values ---------------------------------------------------------------------------------

#: Elements whose content is not text of the page.
SKIPPED = frozenset(
    "head title script style noscript template svg math iframe object canvas audio video select"
    " datalist option button textarea".split()
)
#: Elements whose content is not parsed.
RAW = frozenset("script style title textarea iframe noscript".split())
#: Elements without content.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements that do not end a block.
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i img input ins kbd label mark"
    " nobr q rp rt ruby s samp small span strike strong sub sup time tt u var wbr br".split()
)
#: Elements that are around a page's text, and the roles and names that mark other elements as such.
AROUND = frozenset("nav footer aside form dialog menu".split())
AROUND_ROLES = frozenset(
    "navigation banner contentinfo complementary search form alert alertdialog dialog menu menubar".split()
)
AROUND_NAMES = frozenset(
    "ad ads adv advert adverts advertisement advertising adsbygoogle sponsor sponsored promo promoted"
    " promotion banner cookie cookies consent gdpr notice notices notification alert sidebar widget"
    " widgets menu nav navbar navigation breadcrumb breadcrumbs footer masthead topbar toolbar comment"
    " comments commentlist reply replies respond disqus share sharing social related recommended"
    " newsletter subscribe signup login search pagination pager popup modal overlay skip copyright"
    " disclaimer".split()
)
#: Names beside which the others do not count, as in ``has-sidebar``.
NEGATED = frozenset("has with without no not".split())
HEADER_NAMES = frozenset("header site page top global main wrapper".split())
MAIN = frozenset("article main".split())
#: Elements that begin the body, where a head was left open.
STARTS_BODY = frozenset(
    "body div p nav header footer article main section aside form ul ol table h1 h2 h3 h4 h5 h6"
    " blockquote pre center dl figure address".split()
)
#: Open elements that an element ends.
ENDS_SAME = {
    "li": ("li",), "td": ("td", "th"), "th": ("td", "th"), "tr": ("tr", "td", "th"),
    "dt": ("dt", "dd"), "dd": ("dt", "dd"),
}
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())

# --- blocks ---------------------------------------------------------------------------------------

OPENING = re.compile(r"<(?:!--|[a-zA-Z/!?])")
NAME = re.compile(r"[a-zA-Z][^\s/>]*")
ATTRIBUTE = re.compile(r"([^\s\"'>/=]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
QUOTE = re.compile(r"=\s*([\"'])")
PARTS = re.compile(r"[a-z]+")
CAMEL = re.compile(r"(?<=[a-z])(?=[A-Z])")


@dataclass
class Block:
    """Text between two block borders; ``labelled`` is only ever set on training pages."""

    text: str
    words: int
    linked: int
    around: bool
    main: bool
    heading: bool
    labelled: bool

    @property
    def density(self) -> float:
        return self.linked / self.words if self.words else 0.0


class Element:
    __slots__ = ("name", "around", "main", "heading", "skipped", "labelled")

    def __init__(self, name, around, main, heading, skipped, labelled) -> None:
        self.name, self.around, self.main = name, around, main
        self.heading, self.skipped, self.labelled = heading, skipped, labelled


def tag_end(page: str, at: int, unclosed: set[str]) -> int:
    """The place of the ``>`` that ends the tag at ``at``, -1 if there is none; values in quotes may hold others.

    A quote that nothing closes is no quote; ``unclosed`` remembers those signs, so that a page is
    searched to its end once for each.
    """
    first = end = page.find(">", at)
    while end >= 0:
        quote = QUOTE.search(page, at, end)
        if quote is None:
            return end
        sign = quote.group(1)
        other = -1 if sign in unclosed else page.find(sign, quote.end())
        if other < 0:
            unclosed.add(sign)
            return end
        at = other + 1
        if at > end:
            end = page.find(">", at)
    return first


def is_around(name: str, attributes: dict[str, str]) -> bool:
    """Whether an element's kind, role or name says that it is around the text of the page."""
    if name in AROUND or attributes.get("role", "").lower() in AROUND_ROLES:
        return True
    if "hidden" in attributes or attributes.get("aria-hidden") == "true":
        return True
    if "display:none" in attributes.get("style", "").replace(" ", "").lower():
        return True
    if name in ("html", "body", "main"):
        return False
    return any(p & AROUND_NAMES and not p & NEGATED for p in name_parts(attributes))


def is_header(name: str, attributes: dict[str, str]) -> bool:
    """Whether an element is the header of the page, unless it is within the main text."""
    return name == "header" or any(
        "header" in p and p <= HEADER_NAMES for p in name_parts(attributes)
    )


def name_parts(attributes: dict[str, str]) -> list[set[str]]:
    """The words of each class and of the id, as in ``site-header`` and ``siteHeader``."""
    values = (*attributes.get("class", "").split(), attributes.get("id", ""))
    return [set(PARTS.findall(CAMEL.sub(" ", value).lower())) for value in values if value]


def blocks(page: str) -> list[Block]:
    """The text blocks of a page in its order, white space turned into one space, none empty."""
    out: list[Block] = []
    pieces: list[tuple[str, bool]] = []
    stack = [Element("", False, False, False, False, False)]
    opened = Counter()  # elements on the stack by name
    unclosed: set[str] = set()
    links = 0

    def add(text: str) -> None:
        if text and not stack[-1].skipped:
            pieces.append((html.unescape(text), links > 0))

    def flush() -> None:
        text = " ".join("".join(piece for piece, _ in pieces).split())
        if text:
            linked = sum(len(piece.split()) for piece, link in pieces if link)
            top = stack[-1]
            words = text.count(" ") + 1
            out.append(Block(text, words, linked, top.around, top.main, top.heading, top.labelled))
        pieces.clear()

    def pop() -> str:
        name = stack.pop().name
        opened[name] -= 1
        return name

    def close(name: str) -> None:
        nonlocal links
        if stack[-1].skipped and not opened[name]:
            return
        if name == "a":
            links = max(0, links - 1)
        if name not in INLINE and name not in SKIPPED:
            flush()
        if opened[name]:
            if name in INLINE:
                flush()
            while pop() != name:
                pass

    def open_(name: str, attributes: dict[str, str]) -> None:
        nonlocal links
        if stack[-1].skipped:
            if not (opened["head"] and name in STARTS_BODY):
                return
            close("head")
        if name == "a":
            links += 1
        around = is_around(name, attributes)
        if name in INLINE and not around:
            return
        if name not in SKIPPED:
            flush()
        if name not in INLINE and name not in SKIPPED:
            links = 0
            if stack[-1].name == "p" or stack[-1].name in ENDS_SAME.get(name, ()):
                pop()
        top = stack[-1]
        in_main = top.main or name in MAIN or attributes.get("role", "").lower() in MAIN
        around = around or (not top.main and is_header(name, attributes))
        stack.append(
            Element(
                name,
                top.around or around,
                in_main,
                name in HEADINGS,
                name in SKIPPED,
                top.labelled or "data-main" in attributes,
            )
        )
        opened[name] += 1

    at = 0
    while (found := OPENING.search(page, at)) is not None:
        start = found.start()
        add(page[at:start])
        if page.startswith("<!--", start):
            end = page.find("-->", start + 4)
            at = end + 3 if end >= 0 else len(page)
            continue
        end = tag_end(page, start + 1, unclosed)
        at = end + 1 if end >= 0 else len(page)  # or cut off within a tag
        closing = page[start + 1] == "/"
        named = NAME.match(page, start + 1 + closing, end) if end >= 0 else None
        if named is None:
            continue
        name = named.group().lower()
        if closing:
            close(name)
        elif name == "br":
            add(" ")
        elif name in VOID:
            if name == "hr":
                flush()
        else:
            body = page[named.end() : end]
            pairs = ATTRIBUTE.findall(body) if body.strip(" /") else ()
            open_(name, {key.lower(): a or b or c or "" for key, a, b, c in pairs})
            if name in RAW:
                closes = re.compile(rf"</{name}(?=[\s/>])", re.IGNORECASE).search(page, at)
                at = closes.start() if closes else len(page)
            elif body.endswith("/") and name in SKIPPED and stack[-1].name == name:
                pop()
    add(page[at:])
    flush()
    return out


# --- the tree -------------------------------------------------------------------------------------

FEATURES = (
    "words", "density", "words_before", "density_before", "words_after", "density_after",
    "around", "place", "heading",
)


def features(found: list[Block]) -> np.ndarray:
    """A row of numbers for each block; beyond the ends of the page there are empty blocks.

    The place is 2 within an element that says it is main text, 0 outside it, and 1 on pages without one.
    """
    words = np.array([0, *(b.words for b in found), 0], float)
    density = np.array([0, *(b.density for b in found), 0], float)
    outside = 0 if any(b.main and not b.around for b in found) else 1
    marks = [(b.around, 2 if b.main else outside, b.heading) for b in found]
    near = words[1:-1], density[1:-1], words[:-2], density[:-2], words[2:], density[2:]
    return np.column_stack([*near, np.array(marks, float).reshape(-1, 3)])


class Tree:
    """A binary decision tree that was grown until its leaves are pure or hold few blocks."""

    def __init__(self, rows: np.ndarray, labels: np.ndarray, depth: int = 8, least: int = 2) -> None:
        self.mean = float(labels.mean()) if len(labels) else 0.0
        self.feature = -1
        if depth == 0 or len(labels) < 2 * least or self.mean in (0.0, 1.0):
            return
        best = (self._impurity(labels) * len(labels) - 1e-9, -1, 0.0)
        for feature in range(rows.shape[1]):
            values = np.unique(rows[:, feature])
            for cut in (values[1:] + values[:-1]) / 2:
                below = rows[:, feature] < cut
                n = int(below.sum())
                if n < least or len(labels) - n < least:
                    continue
                cost = self._impurity(labels[below]) * n
                cost += self._impurity(labels[~below]) * (len(labels) - n)
                if cost < best[0] - 1e-9:
                    best = (cost, feature, float(cut))
        _, self.feature, self.cut = best
        if self.feature >= 0:
            below = rows[:, self.feature] < self.cut
            self.low = Tree(rows[below], labels[below], depth - 1, least)
            self.high = Tree(rows[~below], labels[~below], depth - 1, least)

    @staticmethod
    def _impurity(labels: np.ndarray) -> float:
        share = labels.mean()
        return 2 * share * (1 - share)

    def predict(self, rows: np.ndarray) -> np.ndarray:
        """Whether each row is main text."""
        if self.feature < 0:
            return np.full(len(rows), self.mean > 0.5)
        out = np.empty(len(rows), bool)
        below = rows[:, self.feature] < self.cut
        out[below] = self.low.predict(rows[below])
        out[~below] = self.high.predict(rows[~below])
        return out


@lru_cache(maxsize=1)
def trained() -> Tree:
    """The tree of the labelled pages, a few hundred blocks; trained once in a process."""
    parsed = [blocks(page) for page in labelled_pages()]
    rows = np.vstack([features(found) for found in parsed])
    labels = np.array([b.labelled for found in parsed for b in found], float)
    return Tree(rows, labels)


def main_blocks(page: str, tree: Tree) -> list[tuple[Block, bool]]:
    found = blocks(page)
    return list(zip(found, tree.predict(features(found)).tolist(), strict=True)) if found else []


# --- the corpus -----------------------------------------------------------------------------------


def extract(pages: DataFrame, text: str = "html") -> DataFrame:
    """(page_id, url, text, n_chars) of every page: its main blocks in their order, joined by newlines.

    Character references are decoded and white space within a block is one space. Null and empty pages,
    and pages without a block that the tree accepts, have an empty text. Every page is read whole, on its
    own, so repeated rows give repeated rows, ties cannot arise, and an empty table gives an empty one.
    Only ``page_id``, ``url`` and the page itself are read; further columns cannot clash.
    """
    prepare(pages.sparkSession)
    tree = trained()

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        out = ["\n".join(b.text for b, is_main in main_blocks(p, tree) if is_main) for p in texts(batch.column(2))]
        return pa.RecordBatch.from_arrays(
            [
                batch.column(0),
                batch.column(1),
                pa.array(out, pa.string()),
                pa.array([len(t) for t in out], pa.int64()),
            ],
            ["page_id", "url", "text", "n_chars"],
        )

    return map_batches(
        pages.select("page_id", "url", text), run, "page_id long, url string, text string, n_chars long"
    )


def block_table(pages: DataFrame, text: str = "html") -> DataFrame:
    """A row for each text block: its place in the page, text, words, linked words and whether it is main."""
    prepare(pages.sparkSession)
    tree = trained()
    schema = "page_id long, block int, text string, words int, linked int, is_main boolean"

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        rows: list[tuple] = []
        for page_id, page in zip(batch.column(0).to_pylist(), texts(batch.column(1)), strict=True):
            for place, (b, is_main) in enumerate(main_blocks(page, tree)):
                rows.append((page_id, place, b.text, b.words, b.linked, is_main))
        kinds = (pa.int64(), pa.int32(), pa.string(), pa.int32(), pa.int32(), pa.bool_())
        columns = list(zip(*rows, strict=True)) or [()] * len(kinds)
        names = [field.split()[0] for field in schema.split(", ")]
        arrays: Iterator[pa.Array] = (pa.array(c, kind) for c, kind in zip(columns, kinds, strict=True))
        return pa.RecordBatch.from_arrays(list(arrays), names)

    return map_batches(pages.select("page_id", text), run, schema)
