"""Main text of web pages from the events of a streaming parser and the density of text against tags.

The parser's events become lines: one per block, with its text, its tags, its links and the elements around it. Lines
in menus, headers, footers, sidebars, notices, adverts, forms and comments are set aside by their elements. What is set
aside by a name or as a form only is a wrapper: its lines wait, and come back if it turns out to hold the page. The ratio
of text to tags of the other lines, smoothed by a Gaussian along the page and clustered by a threshold of its spread,
finds the content regions. Where the page names its article, the one with the weightiest region is taken; else the innermost
element around all regions is the article. All of its lines are kept, short ones too.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from editsieve.llm.exchange import arrow_schema, extended

SIGMA = 1.0
THRESHOLD = 0.5  # standard deviations of the smoothed ratio below its mean that still count as content
SPARSE = 25  # a ratio from which on a line without links counts as content, however dense the others are

# Elements by their role in a page.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
HIDDEN = frozenset(
    "script style noscript template head title svg math canvas iframe object audio video select option datalist "
    "button textarea form input label fieldset legend dialog map".split()
)
ASIDE = frozenset("nav aside footer menu search".split())
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure "
    "footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol p pre section summary table tbody "
    "td tfoot th thead tr ul".split()
)
CLOSES_P = BLOCKS - frozenset("html body caption td th tr tbody thead tfoot li dd dt".split())
MAIN_ROLES = frozenset(["main", "article"])
ASIDE_ROLES = frozenset(
    "navigation banner contentinfo complementary search form dialog alertdialog alert menu menubar toolbar".split()
)
BOILERPLATE = frozenset(
    "ad ads adv advert adverts advertisement advertising adsense adbox adslot sponsor sponsored promo promoted promotion "
    "banner cookie cookies consent gdpr notice notices notification alert popup modal overlay newsletter subscribe "
    "subscription signup login paywall nav navbar navigation menu menus breadcrumb breadcrumbs pagination pager "
    "sidebar sidebars aside footer masthead topbar toolbar share sharing social related recommended recommendations "
    "trending popular comment comments commentlist disqus respond reply replies discussion widget widgets copyright "
    "skip search form".split()
)
# A header with one of these names belongs to the article.
CONTENT_NAMES = frozenset("content article post entry main body story text title section".split())
_READERS = frozenset("comment comments reply replies".split())
# Wrappers of these names come back only if nothing else is left, as they may well be longer than the article.
_APART = _READERS | frozenset(
    "commentlist disqus respond discussion cookie cookies consent gdpr related recommended recommendations trending popular".split()
)
_STATES = frozenset("no has with without is".split())
_WORD = re.compile(r"[a-z]+|\d+")
_CAMEL = re.compile(r"(?<=[a-z])(?=[A-Z])")
_GAPS = re.compile(r"[ \t\n\r\f\v   -     　\u0085]+")


@dataclass
class Line:
    """A block of text: ``home`` is the number of the element that holds it."""

    home: int
    events: list[tuple[int, str | None, bool]] = field(default_factory=list)  # wrapper, text (None: a tag), whether linked
    tags: int = 0
    linked: int = 0
    text: str = ""

    def read(self, back: list[bool]) -> bool:
        """Text, tags and links without wrappers that are not ``back``; whether there is any text."""
        parts: list[str] = []
        self.tags = self.linked = 0
        for wrapper, data, linked in self.events:
            if data is None:
                self.tags += bool(parts)
            elif back[wrapper] and (parts or data.strip()):
                parts.append(data)
                self.linked += len(data) * linked
        self.text = _GAPS.sub(" ", "".join(parts)).strip(" ")
        return bool(self.text)


class Page(HTMLParser):
    """Collects the lines of a page and its tree of block elements."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.names, self.parent, self.main = ["#page"], [-1], [False]
        self.open: list[tuple[str, int, bool, int]] = []  # name, element, whether it is set aside, wrapper
        self.wrappers: list[tuple[int, int, bool, int]] = [(0, 0, False, 0)]  # outer one, element around it, if ``_APART``, element
        self.lines: list[Line] = []
        self.line: Line | None = None
        self.links = 0

    # ---- state ----

    def _home(self) -> int:
        return self.open[-1][1] if self.open else 0

    def _aside(self) -> bool:
        return bool(self.open) and self.open[-1][2]

    def _wrapper(self) -> int:
        return self.open[-1][3] if self.open else 0

    def _break(self) -> None:
        self.line = None

    # ---- events ----

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        if tag in CLOSES_P:
            self._close("p", BLOCKS - {"p"})
        elif tag in ("li", "dd", "dt", "tr", "td", "th", "option"):
            self._close(tag, frozenset(["ul", "ol", "dl", "table", "select", "menu"]))
        if tag in VOID:
            if tag == "br":
                self.handle_data(" ")
            elif tag == "hr":
                self._break()
            return
        if self.line is not None and tag not in BLOCKS:
            self.line.events.append((self._wrapper(), None, False))
        home = outside = self._home()
        if tag in BLOCKS:
            self._break()
            self.names.append(tag)
            self.parent.append(home)
            self.main.append(tag in ("article", "main") or _value(attrs, "role") in MAIN_ROLES)
            home = len(self.names) - 1
        if tag == "a":
            self.links += 1
        aside, wrapper = self._aside() or self._is_aside(tag, attrs), self._wrapper()
        if not aside and (names := self._set_aside_names(tag, attrs)) is not None:
            self.wrappers.append((wrapper, outside, not _APART.isdisjoint(names), home))
            wrapper = len(self.wrappers) - 1
        self.open.append((tag, home, aside, wrapper))

    def handle_startendtag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        self.handle_starttag(tag, attrs)  # a browser reads <p/> as <p>

    def handle_endtag(self, tag: str) -> None:
        if tag == "br":
            self.handle_data(" ")
        elif tag == "p" and not any(x[0] == "p" for x in self.open):
            self._break()
        else:
            scope = BLOCKS if tag not in BLOCKS else frozenset(["article", "main", "nav", "aside", "footer"]) - {tag}
            self._close(tag, scope if tag not in ("html", "body", "article", "main", "section", "div") else frozenset())

    def _close(self, tag: str, scope: frozenset[str]) -> None:
        """Closes the innermost ``tag`` unless an element of ``scope`` is open inside it."""
        for k in range(len(self.open) - 1, -1, -1):
            name = self.open[k][0]
            if name == tag:
                gone = self.open[k:]
                self.links -= sum(x[0] == "a" for x in gone)
                if any(x[0] in BLOCKS for x in gone):
                    self._break()
                del self.open[k:]
                return
            if name in scope:
                return

    def handle_data(self, data: str) -> None:
        if self._aside():
            return
        if self.line is None:
            if not data.strip():
                return
            self.line = Line(self._home())
            self.lines.append(self.line)
        self.line.events.append((self._wrapper(), data, self.links > 0))

    def _is_aside(self, tag: str, attrs: list[tuple[str, str | None]]) -> bool:
        if tag in HIDDEN and tag != "form" or tag in ASIDE:
            return True
        if tag == "header":
            return not any(self.main[x[1]] for x in self.open)
        if not attrs or tag in ("html", "body"):
            return False
        named = dict(attrs)
        if "hidden" in named or (named.get("aria-hidden") or "").lower() == "true":
            return True
        if (named.get("role") or "").lower() in ASIDE_ROLES:
            return True
        style = (named.get("style") or "").replace(" ", "").lower()
        return "display:none" in style or "visibility:hidden" in style

    def _set_aside_names(self, tag: str, attrs: list[tuple[str, str | None]]) -> set[str] | None:
        """The words in the names of a wrapper, None for other elements."""
        if tag in ("html", "body", "header"):
            return None
        found, all_names = tag == "form", set()
        named = dict(attrs)
        inside_main = any(self.main[x[1]] for x in self.open)
        for value in (named.get("class"), named.get("id")):
            for word in (value or "").split():
                words = _WORD.findall(_CAMEL.sub("-", word).lower())
                # what follows a state is not what the element is: no-sidebar, page-with-sidebar
                words = words[: next((k for k, x in enumerate(words) if x in _STATES), len(words))]
                all_names.update(words)
                if tag in ("article", "main"):
                    found |= not _READERS.isdisjoint(words)
                else:
                    found |= not BOILERPLATE.isdisjoint(words)
                    found |= "header" in words and not inside_main and CONTENT_NAMES.isdisjoint(words)
        return all_names if found else None


def _value(attrs: list[tuple[str, str | None]], name: str) -> str:
    return next(((v or "").lower() for k, v in attrs if k == name), "")


def parse(html: str) -> Page:
    page = Page()
    page.feed(html)
    page.close()
    back = wrappers_back(page)
    page.lines = [line for line in page.lines if line.read(back)]
    return page


def wrappers_back(page: Page) -> list[bool]:
    """Which wrappers' lines count after all; the first stands for text that is in none.

    A wrapper comes back if it holds most of the weighted text of the page, or of the article that it is in; text that is
    ``_APART`` does not count for that. So do those around a <main>, and around an <article> that outweighs all that is in
    no wrapper. If nothing is left then, all come back, those of ``_APART`` last.
    """
    wrappers = page.wrappers
    count = len(wrappers)
    if count == 1:
        return [True]
    apart, article = [False] * count, [0] * len(page.names)
    for w in range(1, count):
        apart[w] = wrappers[w][2] or apart[wrappers[w][0]]
    for k in range(1, len(page.names)):  # the outermost article around
        article[k] = article[page.parent[k]] or k * page.main[k]
    inside, scope, own = [0.0] * count, {0: 0.0}, {}
    for line in page.lines:
        tags = sum(data is None for _, data, _ in line.events)
        for w, data, linked in line.events:
            if data is not None and not linked and (mass := len(data.strip()) / (1 + tags)):
                inside[w] += mass
                own[w, article[line.home]] = own.get((w, article[line.home]), 0.0) + mass
                if not apart[w]:
                    for k in {0, article[line.home]}:
                        scope[k] = scope.get(k, 0.0) + mass
    free = {k: mass for (w, k), mass in own.items() if not w}
    named = any(free.get(k) for k in free if k)
    rest = sum(mass for k, mass in free.items() if k or not named)
    back = [True] + [False] * (count - 1)
    for w in range(count - 1, 0, -1):
        if not apart[w]:
            inside[wrappers[w][0]] += inside[w]
            back[w] = inside[w] > 0.5 * scope.get(article[wrappers[w][1]], 0.0)
    for (w, k), mass in own.items():
        # only those around the article: of what is set aside in it nothing comes back by this
        if w and k and article[wrappers[w][1]] != k != wrappers[w][3] and not named and (page.names[k] == "main" or mass > rest):
            while w:
                back[w], w = True, wrappers[w][0]
    for also in ([not x for x in apart], [True] * count):
        seen = [True] * count
        for w in range(1, count):
            seen[w] = back[w] and seen[wrappers[w][0]]
        if any(line.read(seen) for line in page.lines):
            return seen
        back = also
    return back


def smooth(ratio: np.ndarray, sigma: float = SIGMA) -> np.ndarray:
    """Gaussian smoothing along the page; the edges count the nearest line again."""
    reach = max(1, int(3 * sigma))
    kernel = np.exp(-0.5 * (np.arange(-reach, reach + 1) / sigma) ** 2)
    return np.convolve(np.pad(ratio, reach, mode="edge"), kernel / kernel.sum(), mode="valid")


def regions(ratio: np.ndarray) -> list[tuple[int, int]]:
    """Runs of lines whose smoothed ratio is not below mean less ``THRESHOLD`` deviations."""
    dense = np.concatenate([[False], ratio >= ratio.mean() - THRESHOLD * ratio.std(), [False]])
    edges = np.flatnonzero(dense[1:] != dense[:-1])
    return list(zip(edges[::2].tolist(), edges[1::2].tolist(), strict=True))


def main_text(html: str) -> str:
    """Text of the article: blocks in page order, joined by an empty line."""
    page = parse(html)
    if not page.lines:
        return ""
    return "\n\n".join(line.text for line in article(page))


def article(page: Page) -> list[Line]:
    chain = {0: [0]}
    for k in range(1, len(page.names)):
        chain[k] = [*chain[page.parent[k]], k]
    lines = page.lines
    marked = [k for k in range(len(page.main)) if page.main[k]]
    inside = [any(page.main[k] for k in chain[line.home]) for line in lines]
    if marked and any(inside):
        # where the page names its article, only the lines in it compete
        lines = [line for line, ok in zip(lines, inside, strict=True) if ok]
    ratio = np.array([max(0, len(line.text) - line.linked) / (1 + line.tags) for line in lines], float)
    found = regions(smooth(ratio))
    if not any(inside):
        return around(page, lines, chain, ratio, found)
    best, region = -1.0, (0, len(lines))
    for a, b in found:
        if (mass := float(ratio[a:b].sum())) > best:
            best, region = mass, (a, b)
    weight: dict[int, float] = {}
    # the element that holds most of the region: as deep as it keeps nine tenths of the region's text
    for line, mass in zip(lines[slice(*region)], ratio[slice(*region)], strict=True):
        for k in chain[line.home]:
            weight[k] = weight.get(k, 0.0) + float(mass)
    home = 0
    for k in sorted(weight, key=lambda k: len(chain[k])):
        if weight[k] >= 0.9 * max(best, 1e-9) and page.names[k] in _HOLDERS and home in chain[k]:
            home = k
    outer = [k for k in chain[home] if page.main[k]]
    home = outer[0] if outer else home
    return [line for line in lines if home in chain[line.home]]


def around(page: Page, lines: list[Line], chain: dict[int, list[int]], ratio: np.ndarray, found: list[tuple[int, int]]) -> list[Line]:
    """On a page that doesn't name its article, the lines of the innermost element around all regions and the headings before.

    Lines from ``SPARSE`` on are regions too, lines full of links are none. Those before the first or after the last region stay behind, if they are in
    elements of their own.
    """
    linked = [2 * line.linked > len(line.text) for line in lines]
    within = {k for a, b in found for k in range(a, b)}
    dense = [k for k in range(len(lines)) if not linked[k] and (k in within or ratio[k] >= SPARSE)]
    if not dense:
        dense = sorted(within)
    titles = [k for k in range(dense[0]) if not linked[k] and not _HEADINGS.isdisjoint(page.names[x] for x in chain[lines[k].home])]
    dense = titles + dense
    common = chain[lines[dense[0]].home]
    for k in dense:
        common = [x for x, y in zip(common, chain[lines[k].home]) if x == y]
    home = [x for x in common if page.names[x] in _HOLDERS][-1]
    holders = [[x for x in chain[line.home] if page.names[x] in _HOLDERS] for line in lines]
    held = {x for k in dense for x in holders[k]}
    return [
        line for k, line in enumerate(lines)
        if home in holders[k] and (dense[0] < k < dense[-1] or not linked[k] or holders[k][-1] in held)
    ]


_HEADINGS = frozenset("h1 h2 h3 h4 h5 h6 hgroup".split())
_HOLDERS = frozenset("body div section article main td center html #page".split())


def extract(pages: DataFrame, html_col: str = "html", text_col: str = "text") -> DataFrame:
    """``pages`` with the main text of each whole page.

    A null or empty page, and one without text, gives an empty text. All rows and other columns are kept; a column
    named like the new one is replaced.
    """
    pages = pages.drop(text_col)
    schema = extended(pages.schema, f"`{text_col}` string")

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        arrow = arrow_schema(schema)
        for batch in batches:
            texts = [main_text(html.as_py()) if html.is_valid else "" for html in batch.column(html_col)]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.string())], schema=arrow)

    return pages.mapInArrow(each, schema)
