"""Main text of web pages from the standard library's parser events.

The parser's events are turned into lines, one a block of text. Each line has a text-to-tag
ratio: its characters over the tags seen with it. Lines in elements that are no content (menus,
footers, forms, adverts, notices, comments, ...) and lines of links count 0; lines in an article
or main element count more. A Gaussian smooths the ratios over the lines, and a threshold on
the smoothed ratios clusters lines into content and the rest. The lines of one container make
a region, and its mass is the sum of the smoothed ratios of its clustered lines. If the heaviest
region is an article, the page's content is that article, whole, and other articles of some mass;
else the clusters outside articles are the content, each filled up between its first and its last
line in one container, and an article stays only if it has a good part of the heaviest's mass.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from html.parser import HTMLParser
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from .common import map_batches, with_columns

# Elements by what they mean for the text.
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 head header hr html legend li main nav ol p pre section summary table tbody tfoot thead tr ul".split()
)
CONTAINERS = frozenset("article aside body details dialog div fieldset footer form head header html main nav ol section table td ul".split())
OUTSIDE = frozenset(
    "nav footer aside form script style noscript template iframe svg math select button textarea title head dialog object audio video canvas menu".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
CONTENT = frozenset("article main".split())
ROLES = frozenset("navigation banner contentinfo complementary search dialog alert alertdialog menu menubar form".split())
#: Words for side matter. A name tells if it ends with one, words of layout after it aside ("acme-sidebar", "ad-slot").
STRONG = frozenset(
    "ad ads adv advert adverts advertisement advertisements sponsored promo promos banner banners nav navbar navigation navmenu breadcrumb breadcrumbs "
    "sidebar sidebars footer footers masthead topbar gdpr popup popups newsletter comment comments commentlist disqus pagination pager hidden".split()
)
#: Words that tell as much only with nothing but such words and words of layout beside: in other names they may well mean text.
WEAK = frozenset(
    "menu menus modal consent cookie cookies subscribe signup sponsor sponsors promotion promotions advertising recommended "
    "side notice notices overlay login share sharing social related replies reply response responses widget toolbar skip".split()
)
#: Words that never exclude an element, but have its text weighed against its tags, as weak and strong ones do in other names.
FAINT = frozenset("recommend recommends recommendation recommendations".split())
LAYOUT = frozenset(
    "area articles bar block body bottom box btn button buttons card cards col column container content desktop fixed form global group header holder icons "
    "inner item items label left link links list main media mobile module panel placeholder posts primary rail right row secondary section site slot sr "
    "sticky stories strip text thread title tools top unit wrap wrapper zone".split()
)
#: Class and id words that name a page's own head where no article is open.
HEADS = frozenset("header site-header page-header main-header top-header site_header page_header top".split())
PRIOR = 4.0  # how much more a line in an article or main element counts
SIGMA, RADIUS = 1.0, 2  # of the Gaussian, in lines
SHARE = 0.5  # the threshold, in standard deviations of the smoothed ratios
HOLDS, ALL = 0.5, 0.9  # shares of a page's text from which a name excludes no element, with an article in it and without
GAP = 2  # lines below the threshold that a region bridges
ARTICLES, BESIDE = 0.1, 0.5  # an article's least share of the heaviest region's mass, if that is an article and if not
MENU, FREE = 3, 0.04  # so many lines of links in a row are a menu, in an article too, if less than this share of their text is outside links
TEXT = 20  # characters outside links a tag from which an element with a faint name is text


class Line(NamedTuple):
    words: str
    tags: int
    linked: int  # characters in links
    free: int  # letters and digits outside links
    hard: bool  # in an element that its markup excludes
    named: int  # the innermost element that its name excludes, 0 for none
    article: bool
    container: int
    faint: int  # the innermost element with a faint name, 0 for none


class Open(NamedTuple):
    tag: str
    hard: bool
    named: int
    article: bool
    container: int
    faint: int


ROOT = Open("", False, 0, False, 0, 0)


class Lines(HTMLParser):
    """Collects lines. An open element holds what it inherits in numbers, so that depth costs no more than its elements."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.lines: list[Line] = []
        self.stack: list[Open] = []
        self.open: Counter[str] = Counter()  # tags on the stack
        self.parents = [0]  # of an element that its name excludes, the next such one around it
        self.containers = self.faints = 0
        self.text: list[str] = []
        self.tags = self.linked = self.free = self.in_link = 0
        self.inside = 0  # open elements, counted from an excluded one in the middle of a line
        self.within = ""  # the tag of that one

    def state(self) -> Open:
        return self.stack[-1] if self.stack else ROOT

    def push(self, element: Open) -> None:
        self.stack.append(element)
        self.open[element.tag] += 1

    def pop(self) -> str:
        tag = self.stack.pop().tag
        self.open[tag] -= 1
        return tag

    def end_line(self) -> None:
        words = " ".join("".join(self.text).split())
        if words:
            self.lines.append(Line(words, self.tags, self.linked, self.free, *self.state()[1:]))
            self.tags = self.linked = self.free = 0
        self.text.clear()

    def handle_starttag(self, tag: str, attrs: list) -> None:
        if self.inside:
            if tag not in BLOCKS:
                self.inside += tag == self.within
                return
            # A block inside: the line before it ends, and the excluded element holds what follows.
            self.end_line()
            held = self.state()._replace(tag=self.within, hard=True)
            for _ in range(self.inside):
                self.push(held)
            self.inside = 0
        elif tag not in BLOCKS and tag not in VOID and not self.state().hard and (self.excludes(tag, dict(attrs), self.state().article) or self.is_named(dict(attrs))):
            self.inside, self.within = 1, tag
            return
        if tag in BLOCKS:
            self.end_line()
        elif tag in ("br", "td", "th"):
            self.text.append(" ")
        self.tags += 1
        if tag == "a":
            self.in_link += 1
        if tag in VOID:
            return
        if tag == "body":  # whatever the head left open ends here
            while self.stack and self.stack[-1].tag != "html":
                self.pop()
        within = self.state()
        if tag in CONTENT and (within.hard or within.named) and not self.is_named(dict(attrs)):
            at = next(k for k, x in enumerate(self.stack) if x.hard or x.named)
            if self.stack[at].tag in ("nav", "header"):  # an article in a menu: the menu was never closed
                while len(self.stack) > at:
                    self.pop()
        _, hard, named, article, container, faint = self.state()
        own = self.excludes(tag, dict(attrs), article)
        telling = not own and tag not in ("html", "body") and self.is_named(dict(attrs))
        if telling:
            self.parents.append(named)
            named = len(self.parents) - 1
        weighed = not own and not telling and tag not in ("html", "body") and self.is_faint(dict(attrs))
        if weighed:
            self.faints += 1
            faint = self.faints
        if own or telling or weighed or tag in CONTAINERS or tag in OUTSIDE:
            if tag in CONTAINERS and not article:
                self.containers += 1
                container = self.containers
            self.push(Open(tag, hard or own, named, article or tag in CONTENT, container, faint))

    def excludes(self, tag: str, attrs: dict, article: bool) -> bool:
        if tag in OUTSIDE or tag == "header" and not article:
            return True
        if "hidden" in attrs or (attrs.get("aria-hidden") or "").lower() == "true" or (attrs.get("role") or "").lower() in ROLES:
            return True
        if re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", attrs.get("style") or "", re.IGNORECASE):
            return True
        if tag in ("html", "body"):
            return False
        if not article and tag not in CONTENT and HEADS & {w.lower() for k in ("class", "id") for w in (attrs.get(k) or "").split()}:
            return True
        return False

    def is_named(self, attrs: dict) -> bool:
        """A name that ends with a strong word, or has a weak one with nothing but words of layout beside it."""
        for words in _names(attrs):
            last = next((w for w in reversed(words) if w not in LAYOUT), None)
            if last in STRONG or words == ["sr", "only"] or not WEAK.isdisjoint(words) and (STRONG | WEAK | LAYOUT).issuperset(words):
                return True
        return False

    def is_faint(self, attrs: dict) -> bool:
        return any(not (STRONG | WEAK | FAINT).isdisjoint(words) for words in _names(attrs))

    def handle_endtag(self, tag: str) -> None:
        if self.inside:
            if tag == self.within:
                self.inside -= 1
                return
            if tag not in BLOCKS:
                return
            self.inside = 0
        if tag in BLOCKS:
            self.end_line()
        elif tag in ("td", "th"):
            self.text.append(" ")
        self.tags += 1
        if tag == "a" and self.in_link:
            self.in_link -= 1
        if self.open[tag]:
            if tag not in BLOCKS and self.stack[-1].hard:
                self.end_line()
            while self.pop() != tag:
                pass

    def handle_startendtag(self, tag: str, attrs: list) -> None:
        self.handle_starttag(tag, attrs)
        if tag not in VOID:
            self.handle_endtag(tag)

    def handle_data(self, data: str) -> None:
        if self.inside:
            return
        if self.state().hard and self.stack[-1].tag not in BLOCKS and not self.text:
            return  # scripts, styles and the like inside a block of text
        self.text.append(data)
        if self.in_link:
            self.linked += len(data)
        else:
            self.free += sum(map(str.isalnum, data))


def _names(attrs: dict) -> Iterator[list[str]]:
    """The words of each class and of the id; numbers are left out."""
    for k in ("class", "id"):
        for name in (attrs.get(k) or "").lower().split():
            yield [w for w in re.split(r"[_-]+|\d+", name) if w]


def smooth(ratios: np.ndarray) -> np.ndarray:
    kernel = np.exp(-np.square(np.arange(-RADIUS, RADIUS + 1)) / (2 * SIGMA**2))
    padded = np.pad(ratios, RADIUS)
    weights = np.convolve(np.pad(np.ones(len(ratios)), RADIUS), kernel, "valid")
    return np.convolve(padded, kernel, "valid") / weights


def _outside(lines: list[Line], parents: list[int]) -> list[bool]:
    """For each element with a telling name whether it excludes its lines: it, or one around it, is side matter.

    An element that holds so much of the page's text is none. Elements are numbered as they begin,
    so sizes go up to the parents from the last on, and exclusion comes down from the first on.
    """
    whole, own, articles = 0, [0] * len(parents), [False] * len(parents)
    for x in lines:
        if not x.hard:
            whole += len(x.words)
            own[x.named] += len(x.words)
            articles[x.named] |= x.article
    for k in range(len(parents) - 1, 0, -1):
        own[parents[k]] += own[k]
        articles[parents[k]] |= articles[k]
    out = [False] * len(parents)
    for k in range(1, len(parents)):
        out[k] = out[parents[k]] or own[k] < (HOLDS if articles[k] else ALL) * whole
    return out


def _thin(lines: list[Line], faints: int) -> np.ndarray:
    """Lines in an element of a faint name whose text outside links is little for its tags."""
    of = np.array([x.faint for x in lines])
    free = np.bincount(of, [max(0, len(x.words) - x.linked) for x in lines], faints + 1)
    tags = np.bincount(of, [max(1, x.tags) for x in lines], faints + 1)
    return (of > 0) & (free[of] < TEXT * tags[of])


def main_text(html: str) -> str:
    """The page's content lines, joined by newlines; empty if it has none."""
    parser = Lines()
    parser.feed(html)
    parser.close()
    parser.end_line()
    lines = parser.lines
    outside = _outside(lines, parser.parents)
    usable = np.array([not x.hard and not outside[x.named] for x in lines], bool)
    if not usable.any():
        return ""
    size = np.array([len(x.words) for x in lines], float)
    tags = np.array([max(1, x.tags) for x in lines], float)
    linked = np.array([x.linked for x in lines], float) > size / 2
    prior = np.array([x.article for x in lines], bool)
    usable &= ~_thin(lines, parser.faints)
    ratio = np.where(usable & ~linked, size / tags, 0.0) * np.where(prior, PRIOR, 1.0)
    level = smooth(ratio)
    chosen = usable & (level >= SHARE * level.std()) & (level > 0)
    container = np.array([x.container for x in lines])
    mass = np.bincount(container[chosen], level[chosen], int(container.max()) + 1)
    articles = np.zeros(len(mass), bool)
    articles[container[prior]] = True
    heaviest = mass.max()
    if not heaviest:  # nothing but links
        return "\n".join(lines[k].words for k in np.flatnonzero(usable & prior))
    by_article = bool(articles[int(mass.argmax())])
    kept = articles & (mass >= (ARTICLES if by_article else BESIDE) * heaviest)
    # Articles that stay, whole but for menus; clusters outside articles, if none outweighs them.
    keep = kept[container] & prior & usable & ~_menus(linked, np.array([x.free for x in lines]), size)
    if not by_article:
        chosen &= ~prior
        keep |= chosen
        for c in np.unique(container[chosen]):
            inside = np.flatnonzero(chosen & (container == c))
            keep[inside[0] : inside[-1] + 1] |= usable[inside[0] : inside[-1] + 1] & (container[inside[0] : inside[-1] + 1] == c)
        at = np.flatnonzero(keep)
        for a, b in zip(at[:-1], at[1:]):
            if 1 < b - a <= GAP + 1:
                keep[a + 1 : b] |= (usable & ~linked & ~prior)[a + 1 : b]
    return "\n".join(lines[k].words for k in np.flatnonzero(keep))


def _menus(linked: np.ndarray, free: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Lines in a run of MENU lines of links or more with hardly any text of their own; a list of sources has some."""
    edges = np.flatnonzero(np.diff(np.concatenate(([0], linked.view(np.int8), [0]))))
    menus = np.zeros(len(linked), bool)
    for a, b in zip(edges[::2], edges[1::2]):
        menus[a:b] = b - a >= MENU and free[a:b].sum() < FREE * size[a:b].sum()
    return menus


def extract(pages: DataFrame, html: str = "html", into: str = "text") -> DataFrame:
    """``pages`` with ``into``: the main text of the whole page.

    Character references are decoded, white space inside a block becomes one space, and blocks
    are joined in page order by one newline. Edge cases: null and empty pages, and pages without
    content, give an empty text; markup that is never closed ends where the page does; memory
    and time grow with the page's length, however deep its elements are nested; repeated rows give equal texts; an existing column ``into`` is replaced.
    """
    pages = pages.drop(into)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = pa.array((main_text(h or "") for h in batch.column(html).to_pylist()), pa.string())
            yield pa.RecordBatch.from_arrays([*batch.columns, texts], names=[*batch.schema.names, into])

    return map_batches(pages, run, with_columns(pages, (into, T.StringType())))
