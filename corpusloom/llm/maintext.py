"""The main text of web pages by the distribution of text over their lines.

Markup is stripped first, in one pass over the characters: comments, scripts, styles and
other elements without prose go, every block element begins a new line, and references are
decoded.  Elements that say what they are - by name, role, or a word of their class or id
such as ``sidebar``, ``advert`` or ``comments`` - leave a gap of empty lines.  On a page that
marks its content (``article``, ``main``) all lines but the content's are empty.

Then the lengths of ``WINDOW`` lines in a row are summed at every line, text of links not
counted.  Where these sums rise from nothing is a surge, where they fall back to nothing a
dive; what lies between is a stretch of text.  The highest stretch is kept, and so are the
others whose sums reach ``DENSE`` characters, or a quarter of the highest where that is less.
A short line inside a stretch stays, as its window is not empty.

White space within a line is one space, lines are joined by one space.  A null or empty page
has an empty text; marks that do not belong to a tag are text; elements left open end with
the one around them.  Very long pages are read whole, in linear time.  Rows are independent:
repeated ones have equal results, an empty table has none, and other columns may have any
names.
"""

from __future__ import annotations

import html
import re
import sys
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import islice

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusloom.llm.worker import sliced

cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Lines of a window.
WINDOW = 3

#: Characters of a window that mark a stretch as text whatever the rest of the page holds.
DENSE = 86

#: Elements whose content is not text to read; it is skipped to their end tag.
UNREAD = frozenset("script style title textarea xmp iframe noembed noframes".split())

#: Elements without prose, and those that hold what a page shows around its text.
WITHOUT_PROSE = frozenset(
    (
        "noscript template svg math canvas object audio video map select datalist button dialog menu nav aside footer form"
        " fieldset"
    ).split()
)

CONTENT = frozenset("article main".split())

#: Elements that have no content.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())

#: Elements within a line.
INLINE = frozenset(
    (
        "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark nobr q rp rt ruby s samp small span"
        " strike strong sub sup time tt u var"
    ).split()
)

#: Elements that end where the next one of their kind begins.
LEFT_OPEN = frozenset("p li dt dd tr td th option optgroup thead tbody tfoot".split())

ROLES = frozenset("navigation banner contentinfo complementary search dialog alertdialog alert menu menubar toolbar form".split())

#: Words of a class or id that say an element is not main text.
HINTS = frozenset(
    (
        "ad ads adv advert adverts advertisement advertising adsense sponsor sponsored sponsors promo promotion banner"
        " cookie cookies consent gdpr notice notices notification alert disclaimer newsletter subscribe subscription signup"
        " paywall nav navbar navigation menu submenu breadcrumb breadcrumbs crumbs toc sidebar aside rail footer masthead"
        " header topbar toolbar comment comments commentlist respond reply replies disqus related recommended"
        " recommendations share sharing social popup modal overlay pagination pager login search skip copyright"
    ).split()
)

#: Hints that do not hold within content, or beside one of the words that name it.
OF_PAGES = frozenset("header masthead banner topbar".split())
OF_TEXTS = frozenset("article post entry story content title".split())

#: Words before a hint that turn it round, as in ``no-sidebar``.
NEGATIONS = frozenset("no not has with without non".split())

#: A form of so many paragraphs and headings is a frame around the page; only its controls go.
FORM_TEXTS = 3

#: Unmatched end tags of inline elements look no further than this.
NEAR = 64

_TAG = re.compile(
    r"""<(/?)([A-Za-z][^\s/><]*+)((?:[^<>"'=]|=\s*+(?:"[^"]*+"|'[^']*+')|["'=])*+)>|<!--|<[!?]""",
)
_ATTRIBUTE = re.compile(r"""([^\s=/"'<>]++)(?:\s*+=\s*+("[^"]*+"|'[^']*+'|[^\s"'>]++))?+""")
_WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|[0-9]+")
_FORM_TEXT = re.compile(r"<(?:p|h[1-6])[\s>]", re.I)


def attributes(text: str) -> dict[str, str]:
    found: dict[str, str] = {}
    for name, value in _ATTRIBUTE.findall(text):
        found.setdefault(name.lower(), html.unescape(value.strip("\"'")))
    return found


def hinted(value: str, in_content: bool) -> bool:
    """Whether a class or id has a name with one of the words that say: not main text."""
    for name in value.split():
        words = [w.lower() for w in _WORD.findall(name)]
        of_text = in_content or not OF_TEXTS.isdisjoint(words)
        for i, word in enumerate(words):
            if word in HINTS and not (i and words[i - 1] in NEGATIONS) and not (of_text and word in OF_PAGES):
                return True
    return False


class Lines:
    """The lines of a page: text, its length without links, number of the content around it."""

    def __init__(self) -> None:
        self.text: list[str] = []
        self.plain: list[int] = []
        self.inside: list[int] = []
        self._parts: list[str] = []
        self._linked = 0

    def put(self, text: str, linked: bool) -> None:
        self._parts.append(text)
        if linked:
            self._linked += len(" ".join(html.unescape(text).split()))

    def _add(self, text: str, plain: int, inside: int) -> None:
        self.text.append(text)
        self.plain.append(plain)
        self.inside.append(inside)

    def end(self, inside: int) -> None:
        if self._parts:
            text = " ".join(html.unescape("".join(self._parts)).split())
            if text:
                self._add(text, max(len(text) - self._linked, 0), inside)
            self._parts, self._linked = [], 0

    def gap(self, inside: int) -> None:
        """Empty lines, unless within marked content, which is one text."""
        self.end(inside)
        for _ in range(0 if inside else WINDOW):
            self._add("", 0, inside)


@dataclass
class Element:
    """An open element, and what held around it."""

    name: str
    content: int
    dropped: bool
    links: int


class Stripper:
    """One pass over a page; ``lines`` holds what is left of it."""

    def __init__(self, page: str) -> None:
        self.page, self.lines = page, Lines()
        self.open: list[Element] = []
        self.count: Counter[str] = Counter()  # open elements by name
        self.content, self.dropped, self.links, self.n_contents = 0, False, 0, 0
        self.absent: set[str] = set()  # ends that do not come any more
        at = 0
        while at < len(page):
            tag = _TAG.search(page, at)
            upto = tag.start() if tag else len(page)
            if upto > at and not self.dropped:
                self.lines.put(page[at:upto], self.links > 0)
            if tag is None:
                break
            at = self.after(tag)
        self.lines.end(self.content)

    def find(self, mark: str, at: int) -> int:
        """Where ``mark`` comes next, or -1; a mark that has ended is not sought again."""
        found = -1 if mark in self.absent else self.page.find(mark, at)
        if found < 0:
            self.absent.add(mark)
        return found

    def after(self, tag: re.Match) -> int:
        """Take up a tag; where the page goes on."""
        if tag[2] is None:
            stop = self.find("-->", tag.end() - 2) if tag[0] == "<!--" else -1
            if stop >= 0:
                return max(stop + 3, tag.end())
            stop = self.find(">", tag.end())
            return stop + 1 if stop >= 0 else len(self.page)
        name = tag[2].lower()
        if name not in INLINE and name not in VOID or name == "hr":
            self.lines.end(self.content)
        if tag[1]:
            self.close(name)
        elif name in UNREAD:
            stop = re.compile(f"</{name}[\\s/>]", re.I).search(self.page, tag.end())
            close = self.page.find(">", stop.end() - 1) if stop else -1
            return close + 1 if close >= 0 else len(self.page)
        elif name == "br":
            if not self.dropped:
                self.lines.put(" ", False)
        elif name not in VOID:
            self.enter(name, tag)
        return tag.end()

    def close(self, name: str) -> None:
        if not self.count[name]:
            return
        index = len(self.open) - 1
        while self.open[index].name != name:
            index -= 1
            if name in INLINE and (self.open[index + 1].name not in INLINE or index < len(self.open) - NEAR):
                return
        self.leave(index)

    def leave(self, index: int) -> None:
        """Close the open elements from ``index`` on."""
        around = self.open[index]
        if self.dropped and not around.dropped:
            self.lines.gap(around.content)
        elif self.content != around.content:
            self.lines.end(self.content)
        self.count.subtract(e.name for e in self.open[index:])
        del self.open[index:]
        self.content, self.dropped, self.links = around.content, around.dropped, around.links

    def enter(self, name: str, tag: re.Match) -> None:
        if name in LEFT_OPEN and self.open and self.open[-1].name == name:
            self.leave(len(self.open) - 1)
        self.open.append(Element(name, self.content, self.dropped, self.links))
        self.count[name] += 1
        self.links += name == "a"
        if self.dropped:
            return
        about = attributes(tag[3]) if tag[3] else {}
        names = about.get("class", "") + " " + about.get("id", "")
        marked = name in CONTENT or about.get("role") in CONTENT or about.get("itemprop", "").lower() == "articlebody"
        if marked and not self.content and not hinted(names, True):
            self.n_contents += 1
            self.content = self.n_contents
        elif self.surrounds(name, about, names, tag.end()):
            self.lines.gap(self.content)
            self.dropped = True

    def surrounds(self, name: str, about: dict[str, str], names: str, at: int) -> bool:
        if name in ("html", "body", "h1"):
            return False
        if name == "form":
            stop = self.find("</form", at)
            texts = _FORM_TEXT.finditer(self.page, at, stop if stop >= 0 else len(self.page))
            return len(list(islice(texts, FORM_TEXTS))) < FORM_TEXTS
        return (
            name in WITHOUT_PROSE
            or (name == "header" and not self.content)
            or about.get("role", "").lower() in ROLES
            or "hidden" in about
            or about.get("aria-hidden") == "true"
            or re.search(r"display\s*:\s*none", about.get("style", "")) is not None
            or hinted(names, self.content > 0)
        )


def stretches(plain: list[int]) -> list[tuple[int, int, int]]:
    """``surge, dive, height`` of every stretch of lines whose window sums are not empty."""
    found, surge, height, n = [], None, 0, len(plain)
    total = sum(plain[: WINDOW - 1])
    for i in range(n):
        total += plain[i + WINDOW - 1] if i + WINDOW - 1 < n else 0
        if total and plain[i] and surge is None:
            surge, height = i, 0
        if surge is not None:
            height = max(height, total)
            if not total:
                found.append((surge, i, height))
                surge = None
        total -= plain[i]
    if surge is not None:
        found.append((surge, n, height))
    return found


def main_text(page: str | None) -> str:
    lines = Stripper(page or "").lines
    lengths = lines.plain
    held = Counter()
    for inside, text in zip(lines.inside, lines.text):
        held[inside] += len(text) if inside else 0
    if +held:  # of several marked contents the longest; the rest of the page is empty lines
        longest = max(held, key=lambda k: (held[k], -k))
        lengths = [len(t) if inside == longest else 0 for inside, t in zip(lines.inside, lines.text)]
    found = stretches(lengths)
    least = min(DENSE, max((height for *_, height in found), default=0) / 4)
    return " ".join(t for surge, dive, height in found if height >= least for t in lines.text[surge:dive] if t)


def extract_main_text(pages: DataFrame, page: str = "html", text: str = "text", n_chars: str = "n_chars") -> DataFrame:
    """The rows of ``pages`` with their main text and its code points instead of ``page``.

    Columns that are named as the results are replaced.
    """
    kept = [c for c in pages.columns if c not in (page, text, n_chars)]
    rows = pages.select(*kept, F.col(page).alias("__page"))
    schema = T.StructType([*(rows.schema[c] for c in kept), T.StructField(text, T.StringType()), T.StructField(n_chars, T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches, len(kept)):
            texts = [main_text(p) for p in batch.column(len(kept)).to_pylist()]
            results = [pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], *results], [*kept, text, n_chars])

    return rows.mapInArrow(run, schema)
