"""Main text of web pages: blocks of text, costs from a classifier, and a minimum cut.

A page is read tag by tag into blocks, each with the elements around it. A linear classifier
over a block's own looks (words, links, sentence ends, tag) and its surroundings
(article, main, navigation, names of classes) gives its gain as content; that is the
capacity to a terminal. Neighbours in page order, and blocks of the same container, are joined by edges
that weigh more the closer they stand in the tree; the least cut parts content from the rest.

What stands around a block counts by how sure it is. Elements, roles, hidden parts and reader comments are
firm. Names of classes and ids are hints: the last word that says anything names the thing (a `post-sidebar` is a
sidebar, a `social-page` a page), other words weigh little, and `no-sidebar` or `has-sidebar` say nothing about the
element itself. Where a page's only article or main stands inside hints, those outside it are void.

Rows: a null page, one without text or one without content has the text ''. Pages may be cut
off anywhere, tags may be unclosed or stray. Repeated pages count each. Whole pages are
read; a page is worked on by itself, in memory in proportion to it.
"""

from __future__ import annotations

import html
import math
import re
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strataloom.llm.common import table
from strataloom.llm.mincut import min_cut

# Names of HTML elements, by how they part text (fixed values of the public standard).
BLOCKS = frozenset("address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption figure footer form frameset h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol optgroup option p pre search section summary table tbody td tfoot th thead title tr ul".split())
EMPTY = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("iframe noembed noframes script style textarea title xmp".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
CLOSES_P = BLOCKS - frozenset("body caption dd dt head html legend li optgroup option summary tbody td tfoot th thead title tr".split())
#: Elements that a start tag ends when one is open, up to the container named behind.
ENDS = {
    "li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}), "tr": ({"tr", "td", "th"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}), "option": ({"option"}, {"select"}),
}
NO_TEXT = frozenset("applet audio button canvas datalist head map noscript object select svg template video math".split()) | RAW

#: Elements and roles that stand around what is not the article.
BAD_ELEMENTS = frozenset("nav footer aside form dialog menu search fieldset".split())
#: Elements that belong to an article if they are in one.
BAD_OUTSIDE = frozenset(["header", "address"])
BAD_ROLES = frozenset("navigation banner contentinfo complementary search form alert alertdialog dialog menu menubar toolbar note".split())
#: Words in names of classes and ids: of reader comments, of other things beside the article, of the article, and those that only say what shape a thing has.
COMMENT_WORDS = frozenset("comment comments commentlist commenters disqus replies reply respond responses".split())
BAD_WORDS = frozenset(
    "ad ads adv advert adverts advertisement advertising adsense adslot banner breadcrumb breadcrumbs byline consent cookie cookies copyright disclaimer "
    "dropdown footer gdpr header hidden legal login masthead menu message modal nav navbar navigation newsletter notice notices notification outbrain overlay pager pagination popup promo promos promotion "
    "recommended related search share sharing sidebar sidenav signup skip social sponsor sponsored sponsors subscribe subscription taboola tags teaser toolbar topbar "
    "tracking trending widget widgets warning alert".split()
)
GOOD_WORDS = frozenset("article articlebody body content entry main page post story text".split())
SHAPE_WORDS = frozenset("area articles bar block bottom box buttons col column container group inner item items large left link links list module outer panel posts right row section site slot small top unit wrap wrapper".split())
#: First words of names that speak of what an element has or lacks, not of what it is.
ABOUT_WORDS = frozenset("has hide is no non not show with without".split())
MAIN_ELEMENTS = frozenset(["article", "main"])
#: Weight of a firm sign, of a name that is a thing beside the article, and of a word in another name.
FIRM, NAMED, HINT = 8.0, 4.0, 1.0

_TAG = re.compile(r"""<(/?)([a-zA-Z][^\s/>]*)((?:[^>"']|"[^"]*"|'[^']*')*+)>""")
_LOOSE = re.compile(r"<(/?)([a-zA-Z][^\s/>]*)([^>]*)>")
_ATTRIBUTE = re.compile(r"""([^\s=/"']+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")
_WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")


def name_signs(names: str) -> tuple[bool, float, bool]:
    """What the names of an element say: reader comments, weight of things beside the article, and article."""
    named = hints = 0
    comments = good = False
    for name in names.split():
        words = [w.lower() for w in _WORD.findall(name)]
        if not words or words[0] in ABOUT_WORDS:
            continue
        says = [w for w in words if w not in SHAPE_WORDS] or words
        comments |= says[-1] in COMMENT_WORDS or says[0] in COMMENT_WORDS
        good |= says[-1] in GOOD_WORDS
        named += says[-1] in BAD_WORDS
        hints += any(w in BAD_WORDS for w in says[:-1])
    weight = NAMED if named and not good else HINT * min(named + hints, 2)
    return comments, weight, good


_NO_SHOW = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)


class Element:
    """An element with what it and those around it say: `firm` signs against it, `hints` by name, `inner` hints since the article or main around it."""

    __slots__ = ("above", "depth", "name", "block", "main", "firm", "hints", "inner", "good", "silent", "link")

    def __init__(self, name: str, above: Element | None, attributes: str):
        self.name, self.above = name, above
        self.depth = above.depth + 1 if above else 0
        self.block = self if name in BLOCKS or above is None else above.block
        self.main = above.main if above else False
        self.firm, self.hints, self.inner, self.good = (above.firm, above.hints, above.inner, above.good) if above else (0.0, 0.0, 0.0, 0)
        self.silent = (above.silent if above else False) or name in NO_TEXT
        self.link = (above.link if above else False) or name == "a"
        if name in BAD_ELEMENTS or (name in BAD_OUTSIDE and not self.main):
            self.firm += FIRM
        whole = name in ("html", "body")
        is_main = name in MAIN_ELEMENTS
        if attributes.strip():
            found = {k.lower(): html.unescape(a or b or c) for k, a, b, c in _ATTRIBUTE.findall(attributes)}
            role = found.get("role", "").lower()
            is_main = is_main or role in MAIN_ELEMENTS or "articlebody" in found.get("itemprop", "").lower()
            if role in BAD_ROLES:
                self.firm += FIRM
            if not whole and ("hidden" in found or found.get("aria-hidden", "").lower() == "true" or _NO_SHOW.search(found.get("style", ""))):
                self.firm += FIRM
            if not whole:
                comments, weight, good = name_signs(f"{found.get('class', '')} {found.get('id', '')}")
                if comments and name not in HEADINGS:
                    self.firm += FIRM
                if not is_main:
                    self.hints += weight
                    self.inner += weight
                    self.good = min(self.good + (good and not weight), 2)
        if is_main and not self.firm:
            if not self.main:
                self.inner = 0.0
            self.main = True


class Block:
    __slots__ = ("text", "at", "linked")

    def __init__(self, text: str, at: Element, linked: int):
        self.text, self.at, self.linked = text, at, linked


def blocks(page: str) -> list[Block]:
    """Texts of a page between block-level tags, with the element that holds each."""
    out: list[Block] = []
    root = Element("html", None, "")
    stack = [root]
    places: dict[str, list[int]] = {"html": [0]}  # of the open elements of each name, so that no tag walks the stack
    parts: list[str] = []
    linked = 0

    def flush() -> None:
        nonlocal linked
        if parts:
            if text := " ".join(html.unescape("".join(parts)).split()):
                out.append(Block(text, stack[-1].block, min(linked, len(text))))
            parts.clear()
            linked = 0

    def say(text: str) -> None:
        nonlocal linked
        if text and not stack[-1].silent:
            parts.append(text)
            if stack[-1].link:
                linked += len(text)

    def innermost(names: Iterable[str]) -> int:
        return max((places[name][-1] for name in names if places.get(name)), default=0)

    def drop(k: int) -> None:
        """End element k and all inside it."""
        for e in stack[k:]:
            places[e.name].pop()
        del stack[k:]

    def close(names: Iterable[str], within: Iterable[str]) -> None:
        """End the innermost open element of these names, if none of `within` stands between."""
        k = innermost(names)
        if k > 0 and k > innermost(within):
            flush()
            drop(k)

    at, n = 0, len(page)
    while at < n:
        lt = page.find("<", at)
        if lt < 0:
            say(page[at:])
            break
        say(page[at:lt])
        if page.startswith("<!--", lt):
            end = page.find("-->", lt + 4)
            at = n if end < 0 else end + 3
            continue
        after = page[lt + 1 : lt + 2]
        if after in ("!", "?"):
            end = page.find(">", lt)
            at = n if end < 0 else end + 1
            continue
        if not (after.isascii() and (after.isalpha() or after == "/")):
            say("<")
            at = lt + 1
            continue
        m = _TAG.match(page, lt) or _LOOSE.match(page, lt)
        if not m:
            end = page.find(">", lt)
            at = n if end < 0 else end + 1  # a tag that is cut off, or </ without a name
            continue
        at = m.end()
        name = m[2].lower()
        if m[1]:
            if name in ("br", "p") and not places.get(name):
                flush() if name == "p" else say(" ")
                continue
            if name in BLOCKS:
                close({name}, frozenset() if name in ("body", "html", "article", "main", "nav", "footer", "header", "aside", "form", "section") else {"article", "main", "nav", "footer", "header", "aside", "td", "th"} - {name})
            elif (k := innermost([name])) > 0 and stack[-1].block is stack[k].block:
                if stack[k].silent and name in NO_TEXT:
                    flush()
                drop(k)
            continue
        if name == "br":
            say(" ")
            continue
        if name in BLOCKS:
            flush()
            if name in CLOSES_P:
                close({"p"}, {"article", "main", "nav", "footer", "header", "aside", "td", "th", "li", "dd", "div", "section", "button", "table"})
            if name in ENDS:
                close(*ENDS[name])
            if name in HEADINGS and stack[-1].name in HEADINGS:
                drop(len(stack) - 1)
        if name in EMPTY:
            continue
        element = Element(name, stack[-1], m[3])
        if name in RAW:
            found = re.compile(rf"</{re.escape(name)}(?=[\s/>])", re.I).search(page, at)
            end = page.find(">", found.end()) if found else -1
            at = n if end < 0 else end + 1
            continue
        if not m[3].rstrip().endswith("/") or name in BLOCKS or name == "a":
            places.setdefault(name, []).append(len(stack))
            stack.append(element)
    flush()
    return out


def gain(block: Block, has_main: bool, inside_only: bool = False) -> float:
    """How much a block looks like content: positive for content, negative for the rest."""
    words = block.text.split()
    around = block.at
    links = block.linked / len(block.text)
    g = -2.2 + 1.1 * math.log1p(len(words)) - 3.5 * links
    g += 0.8 * (block.text[-1] in ".!?…\"'”»:;。") + 0.6 * (around.name in ("p", "pre", "blockquote", "figcaption"))
    g += 0.8 * (around.name in HEADINGS) + 2.0 * (around.name == "h1")
    g += around.good
    hints = around.inner if inside_only and around.main else around.hints
    if around.main:
        g = max(g, -1.0) + (5 if hints < NAMED else 1)
    elif has_main:
        g -= 4
    return min(g, 9.0) - 2.0 * (around.firm + hints)


def distance(a: Element, b: Element) -> int:
    """Steps in the tree between two elements."""
    steps = 0
    while a is not b:
        if a.depth >= b.depth:
            a = a.above
        else:
            b = b.above
        steps += 1
    return steps


def main_text(page: str) -> str:
    """The main text of a page: content blocks in order, with a space between two."""
    found = blocks(page)
    if not found:
        return ""
    mains = [b.at for b in found if b.at.main and not b.at.firm]
    inside_only = bool(mains) and all(e.hints >= NAMED for e in mains)
    has_main = any((e.inner if inside_only else e.hints) < NAMED for e in mains)
    # A firm sign parts a block from those without one, so it hardly pulls them along.
    hold = lambda i, j: 1.0 if bool(found[i].at.firm) == bool(found[j].at.firm) else 0.3
    edges = [(i, i + 1, hold(i, i + 1) * (0.2 + 1.6 / (1 + distance(found[i].at, found[i + 1].at)))) for i in range(len(found) - 1)]
    last: dict[int, int] = {}
    for i, b in enumerate(found):
        box = id(b.at.above)
        if (j := last.get(box, i - 1)) < i - 1:
            edges.append((j, i, hold(j, i) * 0.5))  # the same container, with something else between
        last[box] = i
    keep = min_cut([gain(b, has_main, inside_only) for b in found], edges)
    return " ".join(b.text for b, k in zip(found, keep, strict=True) if k)


def extract(pages: DataFrame, html_col: str = "html", keep: tuple[str, ...] = ("page_id", "url")) -> DataFrame:
    """The columns `keep` with text and n_chars (code points)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(0, len(batch), 64):
                part = batch.slice(i, 64)
                texts = [main_text(x) if x else "" for x in part.column(len(keep)).to_pylist()]
                yield pa.RecordBatch.from_arrays([*part.columns[: len(keep)], pa.array(texts, pa.string()), pa.array(list(map(len, texts)), pa.int64())], [*keep, "text", "n_chars"])

    kinds = ", ".join(f"{c} {pages.schema[c].dataType.simpleString()}" for c in keep)
    return pages.select(*keep, F.col(html_col)).mapInArrow(run, f"{kinds}, text string, n_chars long")


def op5_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The main text of every page."""
    return extract(table(spark, sf_dir, "pages"))
