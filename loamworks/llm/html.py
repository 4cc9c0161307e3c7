"""Main text of HTML pages by text density.

The standard library's parser is fed the page and its events build lines: a line is
the text of one block element, with the number of tags and of linked characters met in
it. Its ratio is its unlinked characters by tags. Tag and class names only weigh: in
blocks that they mark (navigation, footers, asides, forms; class, id or role of a menu,
advert, notice, sidebar or comment) a line's ratio is 0, and so it is outside article
and main on pages that have one of these, and in blocks of links on pages without. The
ratios are smoothed with a Gaussian along the page and split into two clusters. A line
is dense if its own ratio and the smoothed one both belong to the upper cluster.

Dense lines say where the content is. If an article or main element holds one, all lines of
these elements are kept whatever their own ratio, short articles and text of main beside an
article too, but articles that are mostly links. A part of an article whose name may be what it is
about (id ``related`` or ``copyright``, class ``social-history``) is kept if most of it is at least half as dense; names of
layout, adverts and reader comments decide alone. Without article and main the smallest container
around a dense line that holds other lines too is kept, and the containers beside it of the
same element that are mostly sentences, without what is marked or in blocks of links. Without dense
lines there is no text. A form is a marked element unless it holds most of the page's unmarked text.

Null and empty pages give an empty text, and so do pages of nothing but menus. Very long
pages are parsed whole; time grows with their length. Repeated rows and equal pages give
equal texts. An empty table gives no rows. Other columns stay as they are; one named as
the result is replaced. White space inside a block (line breaks by ``br`` too) becomes one
space. Ends that HTML implies (of head, paragraphs, list items and table cells) are set;
other unclosed and crossed tags are closed with their parent.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from html.parser import HTMLParser
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from loamworks.llm.common import wider

# Element names and naming habits of HTML.
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr html "
    "legend li main nav ol option p pre section summary table tbody td tfoot th thead tr ul".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
TEXTLESS = frozenset("title script style noscript template button select textarea iframe object svg canvas audio video map".split())
MARKED = frozenset("nav header footer aside dialog".split())
#: Words of a class or id that name a block beside the article, and those that only tell how its name is meant.
MARKED_WORDS = frozenset(
    "ad ads advert adverts advertisement advertising adbox adsense adsbygoogle banner taboola outbrain sponsor sponsors sponsored promo promos promotion cookie cookies consent gdpr notice notices alert alerts announcement disclaimer toast snackbar overlay paywall popup modal newsletter subscribe subscription signup "
    "sidebar sidebars widget widgets menu menus nav navbar topnav subnav sidenav topbar navigation breadcrumb breadcrumbs pagination pager toolbar masthead header footer copyright comment comments commentlist reply replies respond responses disqus "
    "share sharing social related recommended recommendations login search".split()
)
#: Those that say so inside an article whatever stands beside them, and those that may well be what a part of it is about.
STRONG_WORDS = frozenset("ad ads advert adverts advertisement advertising adbox adsense adsbygoogle taboola outbrain sponsor sponsors sponsored promo promos promotion comment comments commentlist reply replies respond responses disqus".split())
TOPIC_WORDS = frozenset("related recommended recommendations copyright cookie cookies consent social share sharing search login notice notices alert alerts announcement disclaimer header footer banner menu menus navigation subscription widget widgets".split())
#: What goes with them in the name of a block.
FILLER_WORDS = frozenset("area article articles bar block body box bottom button buttons card cards container content div group icons info inner item items left link links list main module news outer page panel part post posts right row section site stories story text title top wrap wrapper".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
TELLING_WORDS = frozenset("no not non has have with without free open closed off enabled disabled hide show".split())
#: What may be called a header and holds a title all the same, and the marks that an article element itself may bear.
TITLED_WORDS = frozenset("post entry article story content title page".split())
OTHER_ARTICLES = frozenset("ad ads advert advertisement sponsored promo comment reply related recommended".split())
CONTAINERS = frozenset("body div section td th center article main".split())
WORDS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|[0-9]+")
IN_HEAD = frozenset("head title script style noscript template meta link base".split())
#: Starts that end an open paragraph, and what keeps an open one out of their reach.
ENDS_P = BLOCKS - frozenset("body caption html legend option tbody td tfoot th thead tr".split())
P_SCOPE = frozenset("html body table caption td th button object template".split())
#: Starts that end open elements of these names, sought up to the nearest of those.
_ITEM_SCOPE = BLOCKS - frozenset("address div p".split())
ENDS = (
    {"li": (frozenset(["li"]), _ITEM_SCOPE), "option": (frozenset(["option"]), frozenset(["select"]))}
    | dict.fromkeys(("dt", "dd"), (frozenset(["dt", "dd"]), _ITEM_SCOPE))
    | dict.fromkeys(("td", "th"), (frozenset(["td", "th"]), frozenset(["tr", "table"])))
    | {"tr": (frozenset(["tr"]), frozenset(["table"]))}
    | dict.fromkeys(("thead", "tbody", "tfoot"), (frozenset(["thead", "tbody", "tfoot"]), frozenset(["table"])))
)
MARKED_ROLES = frozenset("navigation banner contentinfo complementary search dialog alert alertdialog menu menubar form".split())
HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)
#: What an element's name and attributes say.
MARK, ASK = 1, 2
#: A line that reads like a sentence.
SENTENCE = re.compile(r"\S+\s+\S+\s+\S.*[.!?…。！？:]['\"»”’)\]]*$")
#: Smoothing width in lines.
SIGMA = 1.5


def marks(value: str, titled: bool) -> list[tuple[frozenset[str], frozenset[str]]]:
    """For each name in a class or id value that names a block beside the article: the words that say so, and its others.

    A name is judged by its first and its last word, whole: ``cookie-notice`` and ``sidebar_left`` name such a block,
    ``has-sidebar``, ``page-with-sidebar``, ``ad-free`` and ``leading`` do not. ``titled``: inside an article, where headers hold titles.
    """
    out = []
    for name in value.split():
        words = [w.lower() for w in WORDS.findall(name)]
        if not words or TELLING_WORDS.intersection(words):
            continue
        found = MARKED_WORDS.intersection((words[0], words[-1]))
        if found == {"header"} and (titled or TITLED_WORDS.intersection(words)):
            continue
        if found:
            out.append((found, frozenset(words) - MARKED_WORDS))
    return out


class Open(NamedTuple):
    """What holds inside an open element: its name, whether text counts, the region, whether that is marked, or in question, the form, the container."""

    name: str
    textless: bool = False
    region: int = 0
    marked: bool = False
    asked: bool = False
    article: bool = False
    form: int = 0
    container: int = 0


class Line(NamedTuple):
    text: str
    tags: int
    linked: int
    region: int
    marked: bool
    asked: bool
    form: int
    container: int


class Lines(HTMLParser):
    """Collects a Line for each block in page order. Regions and forms count from 1; container 0 is the page."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.open: list[Open] = []
        self.lines: list[Line] = []
        self.parts: list[str] = []
        self.parents, self.names = [0], [""]
        self.tags = self.linked = self.regions = self.forms = 0

    def here(self) -> Open:
        return self.open[-1] if self.open else Open("")

    def end_line(self) -> None:
        if text := " ".join("".join(self.parts).split()):
            here = self.here()
            self.lines.append(Line(text, self.tags, self.linked, here.region, here.marked, here.asked, here.form, here.container))
        self.parts, self.tags, self.linked = [], 0, 0

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        if tag in BLOCKS:
            self.end_line()
        self.imply_ends(tag)
        around = self.here()
        if tag == "br":
            self.parts.append(" ")
        self.tags += 1
        if tag in VOID:
            return
        now = around._replace(name=tag, textless=around.textless or tag in TEXTLESS)
        if tag in CONTAINERS:
            self.parents.append(around.container)
            self.names.append(tag)
            now = now._replace(container=len(self.parents) - 1)
        if tag == "form" and not around.form:
            self.forms += 1
            now = now._replace(form=self.forms)
        if not around.marked:
            kind = next((value for name, value in attrs if name == "role" and value in ("article", "main")), tag)
            how = self.is_marked(tag, attrs, around)
            if how == MARK or how == ASK and not around.asked:
                self.regions += 1
                now = now._replace(region=self.regions, marked=how == MARK, asked=how == ASK)
            elif not around.asked and (kind == "article" and not around.article or kind == "main" and not around.region):
                self.regions += 1
                now = now._replace(region=self.regions, article=kind == "article")
        self.open.append(now)

    def imply_ends(self, tag: str) -> None:
        """Closes what HTML ends before this start tag."""
        if tag == "body" or tag not in IN_HEAD and self.here().name == "head":
            self.close_to(frozenset(["head"]), frozenset())
        if tag in ENDS_P:
            self.close_to(frozenset(["p"]), P_SCOPE)
        if tag in ENDS:
            self.close_to(*ENDS[tag])

    def close_to(self, names: frozenset[str], scope: frozenset[str]) -> None:
        """Closes the innermost open element of these names, if none of ``scope`` is nearer; links go on behind it."""
        for at in range(len(self.open) - 1, -1, -1):
            if self.open[at].name in names:
                around = self.open[at - 1] if at else Open("")
                self.open[at:] = [around._replace(name="a") for x in self.open[at:] if x.name == "a"]
                return
            if self.open[at].name in scope:
                return

    @staticmethod
    def is_marked(tag: str, attrs: list[tuple[str, str | None]], around: Open) -> int:
        """MARK if the element, by its name or attributes, is none of the article's; ASK if it lies in one and only a name speaks against it."""
        if tag in ("html", "body", "main"):
            return 0
        if tag == "article":
            names = [token.lower().replace("_", "-").split("-") for name, value in attrs if name in ("class", "id") and value for token in value.split()]
            return MARK if any(words[0] in OTHER_ARTICLES and not TELLING_WORDS.intersection(words) for words in names) else 0
        if tag in MARKED and not (tag == "header" and around.region):
            return MARK
        how = 0
        for name, value in attrs:
            if name == "role" and value in MARKED_ROLES or name == "hidden" or name == "aria-hidden" and value == "true" or name == "style" and value and HIDDEN.search(value):
                return MARK
            for found, rest in marks(value, bool(around.region)) if name in ("class", "id") and value else ():
                asked = found <= TOPIC_WORDS and len(found) == 1 and not rest if name == "id" else bool(rest - FILLER_WORDS)
                if not around.region or found & STRONG_WORDS or not asked:
                    return MARK
                if not (name == "id" and tag in HEADINGS):  # a heading's id is where links lead to
                    how = ASK
        return how

    def handle_startendtag(self, tag, attrs) -> None:
        self.handle_starttag(tag, attrs)
        if tag not in VOID:
            self.handle_endtag(tag)

    def handle_endtag(self, tag: str) -> None:
        self.tags += 1
        at = next((i for i in range(len(self.open) - 1, -1, -1) if self.open[i].name == tag), None)
        if tag in BLOCKS:
            self.end_line()
        if at is not None:
            # an inline end tag does not close the blocks inside which it was crossed
            if tag in BLOCKS or tag in TEXTLESS or not any(x.name in BLOCKS for x in self.open[at + 1 :]):
                del self.open[at:]
            else:
                del self.open[at]

    def handle_data(self, data: str) -> None:
        if self.here().name == "head" and data.strip():
            self.open.pop()  # text ends the head
        if self.here().textless:
            return
        self.parts.append(data)
        if any(x.name == "a" for x in self.open[-3:]):
            self.linked += len(data)


def smooth(values: np.ndarray, sigma: float = SIGMA) -> np.ndarray:
    """Gaussian smoothing; at the ends the kernel is cut and its rest scaled up."""
    reach = int(3 * sigma)
    kernel = np.exp(-0.5 * (np.arange(-reach, reach + 1) / sigma) ** 2)
    cut = lambda a: np.convolve(a, kernel)[reach : reach + len(a)]
    return cut(values) / cut(np.ones(len(values)))


def threshold(values: np.ndarray) -> float:
    """Between the two clusters of one-dimensional 2-means; of equal values, all are in the upper one, but zeros are in none."""
    low, high = float(values.min()), float(values.max())
    if low == high:
        return low if low > 0 else np.inf
    while True:
        upper = values > (low + high) / 2
        if not upper.any():
            return high
        new = float(values[~upper].mean()), float(values[upper].mean())
        if new == (low, high):
            return (low + high) / 2
        low, high = new


def main_text(html: str) -> str:
    """The main text of one page."""
    if not html:
        return ""
    parser = Lines()
    parser.feed(html)
    parser.close()
    parser.end_line()
    lines = parser.lines
    if not lines:
        return ""
    sizes = np.array([len(x.text) for x in lines])
    marked = np.array([x.marked for x in lines])
    forms = np.array([x.form for x in lines])
    in_form = np.bincount(forms, sizes * ~marked, parser.forms + 1)
    marked |= (forms > 0) & (2 * in_form[forms] <= in_form.sum())
    region = np.array([x.region for x in lines])
    region[(region == 0) & marked] = parser.regions + 1
    named = bool((~marked & (region > 0)).any())
    linked = np.minimum(np.array([x.linked for x in lines]), sizes)
    aside = marked | ((region == 0) if named else smooth(linked / sizes) > 0.5)
    ratios = np.where(aside, 0.0, (sizes - linked) / (1 + np.array([x.tags for x in lines])))
    smoothed = smooth(ratios)
    least = threshold(smoothed)
    dense = (smoothed >= least) & (ratios >= least)
    if not dense.any():  # lines much alike: the smoothed ratio may peak where no line's own does
        dense = (smoothed >= least) & (2 * ratios >= least)
    if named:
        keep = in_regions(region, np.array([x.asked for x in lines]), sizes, linked, dense, 2 * ratios >= least, parser.regions + 2) & (~marked | dense)
    else:
        prose = np.array([bool(SENTENCE.search(x.text)) for x in lines]) & ~aside
        keep = dense | around_dense(np.array([x.container for x in lines]), dense, prose, sizes, parser) & ~aside
    return "\n".join(x.text for x, k in zip(lines, keep, strict=True) if k)


def in_regions(region: np.ndarray, asked: np.ndarray, sizes: np.ndarray, linked: np.ndarray, dense: np.ndarray, near: np.ndarray, regions: int) -> np.ndarray:
    """Lines of the articles, if one has a dense line: of all whose text is not mostly links; of parts in question, those of mostly (``near``) dense text."""
    if not dense[region > 0].any():
        return np.zeros(len(region), bool)
    total, links, thick, close = (np.bincount(region, x, regions) for x in (sizes, linked, sizes * dense, sizes * near))
    whole = (thick > 0) | (2 * links <= total)
    whole[0] = False
    return np.where(asked, (2 * close >= total)[region], whole[region])


def around_dense(container: np.ndarray, dense: np.ndarray, prose: np.ndarray, sizes: np.ndarray, parser: Lines) -> np.ndarray:
    """Lines in the smallest container around a dense line that holds other lines too, and in those beside it of the same element that are mostly sentences."""
    parents, names = parser.parents, parser.names
    held, total, told = (np.bincount(container, x, len(parents)) for x in (np.ones(len(container)), sizes, sizes * prose))
    for k in range(len(parents) - 1, 0, -1):  # a container comes after the one around it
        for count in (held, total, told):
            count[parents[k]] += count[k]
    chosen = np.zeros(len(parents), bool)
    for k in set(container[dense].tolist()):
        while k and held[k] == 1:
            k = parents[k]
        chosen[k] = True
    beside = {(parents[k], names[k]) for k in np.flatnonzero(chosen).tolist() if k}
    for k in range(1, len(parents)):
        chosen[k] |= bool(chosen[parents[k]]) or ((parents[k], names[k]) in beside and 2 * told[k] >= total[k] > 0)
    return chosen[container]


def extract(pages: DataFrame, html: str = "html", text: str = "text") -> DataFrame:
    """All columns of ``pages`` but ``html``, with ``text``; a column of that name is replaced."""
    kept = pages.select(*dict.fromkeys([*(c for c in pages.columns if c != text), html]))
    schema = wider(kept.drop(html), f"{text} string")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names = [n for n in batch.schema.names if n != html]
            found = pa.array([main_text(h) for h in batch[html].to_pylist()], pa.string())
            yield pa.RecordBatch.from_arrays([*(batch[n] for n in names), found], [*names, text])

    return kept.mapInArrow(run, schema)
