"""Main text of web pages: parser events, text-to-tag ratio per line, Gaussian smoothing, threshold clusters.

The standard library's streaming HTML parser turns a page into lines, one per block element.  Each line has the
ratio of its text's length to the tags inside it; text of links counts as tags do, and lines in page furniture
(menus, headers, footers, asides, notices, adverts, forms, comments) have ratio 0.  A form around an article or around
most of the page's text is no furniture; only its controls and labels go.  Nor is an element whose class name marks it,
if it holds most of the page's text and no article or main stands beside it (a wrapper like "layout-sidebar"; one named for comments, adverts or teasers must also hold the heading or <main>).  The ratios are smoothed with a
Gaussian kernel, and lines above the threshold (a share of the smoothed ratios' mean plus deviation) form clusters.

A cluster selects the region it lies in: the outermost <article> or <main> around it; regions stand unless the clusters
outside them hold more text (teaser articles below the content).  On a page without regions, or where they do not stand, it is
everything from the first cluster to the last and the lines around them in the same block: the heading before, short
paragraphs after (directly in the page itself only paragraphs, headings and lists, up to the next line of links).  All lines of a selected region are content, short ones too, except
furniture.  If nothing reaches the threshold the region with the most text stands.

Character references are decoded, white space inside a block becomes one space, blocks are joined by an empty line.
Null or empty pages have the empty text; unclosed, misnested or cut-off markup is read as far as it goes (a button or
list of choices left open ends at the next paragraph or heading); blocks know their parent only, so memory follows the page however deeply it is nested; extra
columns pass through; repeated rows get equal results each.
"""

from __future__ import annotations

import re
from collections import Counter
from dataclasses import dataclass
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from snapmerge.llm import common as C

SIGMA = 1.0
THRESHOLD = 0.5

# fixed values: elements by role, and words in class, id or role that mark page furniture
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCK = frozenset("""address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption figure footer form
    h1 h2 h3 h4 h5 h6 header hr html li main nav ol p pre section summary table tbody td tfoot th thead tr ul""".split())
#: blocks of running text, as opposed to boxes around it
RUNNING = frozenset("address blockquote caption center dd details dl dt figcaption figure h1 h2 h3 h4 h5 h6 li ol p pre summary ul".split())
SILENT = frozenset("button canvas datalist head iframe noscript object option script select style svg template textarea title".split())
#: elements that name the controls of a form
LABELS = frozenset("label legend".split())
FURNITURE = frozenset("aside footer header menu nav dialog".split())
MARKS = frozenset("""ad ads advert advertisement advertising adverts banner breadcrumb breadcrumbs comment commentlist comments consent cookie
    cookies disclaimer disqus footer gdpr header masthead menu modal nav navbar navigation newsletter notice pagination popup promo promoted
    related reply replies respond share sharing sidebar signup social sponsor sponsored subscribe subscription toolbar topbar widget""".split())
#: marks that name a part of the article when they stand inside one, and those that tell a comment or teaser from the article
HEADS = frozenset("banner header masthead".split())
ASIDE_ARTICLES = frozenset("ad ads advert comment comments promo promoted related reply replies sponsored widget".split())
#: marks that do not become a wrapper by the text they hold alone
SET_APART = frozenset("""ad ads advert advertisement advertising adverts comment commentlist comments consent cookie cookies disqus gdpr modal
    newsletter popup promo promoted related reply replies respond sponsor sponsored subscribe subscription""".split())
#: silent elements that a paragraph or heading ends if they were left open
CHOICES = frozenset("button datalist option select".split())
#: words that make a class name tell about other elements ("has-sidebar")
RELATIVE = frozenset("has is no not with without".split())
ROLES = frozenset("alert banner complementary contentinfo dialog form menu menubar navigation search toolbar".split())
INSIDE = BLOCK - {"body", "form", "html"}
CLOSES_P = BLOCK - {"body", "html"}
SAME = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
SCOPE = {"li": {"ul", "ol", "menu"}, "dt": {"dl"}, "dd": {"dl"}, "tr": {"table"}, "td": {"tr", "table"}, "th": {"tr", "table"}, "option": {"select"}}


#: a tag that the end of the page cuts off
_OPEN_TAG = re.compile(r"<[A-Za-z/!?][^<>]*\Z")


def _marked(tag: str, attrs: list, in_region: bool) -> str:
    """Whether an element is page furniture or hidden: "" (no), "named" (by its class names only), "apart" (by names that set it apart) or "sure"."""
    if tag in FURNITURE and not (tag == "header" and in_region):
        return "sure"
    a = {k: (v or "").lower() for k, v in attrs}
    if tag == "form" and a.get("role") == "form":
        del a["role"]
    if "hidden" in a or a.get("aria-hidden") == "true" or "display:none" in a.get("style", "").replace(" ", "") or a.get("role") in ROLES:
        return "sure"
    if tag == "article":
        return "" if ASIDE_ARTICLES.isdisjoint(_words(a)) else "sure"
    if tag in ("html", "body", "main", "p", "h1", "h2", "h3", "h4", "h5", "h6"):
        return ""
    words = _words(a) & (MARKS - HEADS if in_region else MARKS)
    return "" if not words else "named" if SET_APART.isdisjoint(words) else "apart"


def _words(attrs: dict) -> set[str]:
    """Words of the class and id names, without those of names that speak of other elements."""
    out: set[str] = set()
    for name in f"{attrs.get('class', '')} {attrs.get('id', '')}".split():
        parts = set(re.split("[-_]+", name))
        if parts.isdisjoint(RELATIVE):
            out |= parts
    return out


class Block:
    """An open block of the page: its number in page order, the last number inside it, and boxes (no running text) down to it."""
    __slots__ = ("boxes", "last", "number", "parent", "tag")

    def __init__(self, number: int, tag: str, parent: "Block | None"):
        self.number, self.tag, self.parent = number, tag, parent
        self.last = 1 << 62
        self.boxes = (parent.boxes if parent else 0) + (tag not in RUNNING)

    def holds(self, other: "Block") -> bool:
        return self.number <= other.number <= self.last


def around_all(blocks: list[Block]) -> Block:
    """The innermost block around all of some blocks; numbers follow the page, so the outer two decide."""
    low, high = min(blocks, key=lambda b: b.number), max(blocks, key=lambda b: b.number)
    while not low.holds(high):
        low = low.parent
    return low


@dataclass
class Holder:
    """A form or a marked element, and the lines it holds."""
    kind: str  # "form", "named" or "apart"
    start: int
    stop: int = -1
    region: bool = False  # holds an article or main element
    heading: bool = False  # holds a first heading or a main element


class _Lines(HTMLParser):
    """Lines of a page: [text parts, tags, link characters, region, furniture, innermost block], and the forms and marked elements."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.page = Block(0, "", None)
        self.lines: list[tuple[str, int, int, int, bool, Block]] = []
        # tag, furniture for sure, region inside, silent inside, block or None, holder or None
        self.open: list[tuple[str, bool, int, bool, Block | None, Holder | None]] = []
        self.names: Counter = Counter()
        self.blocks = [self.page]
        self.n_blocks = 0
        self.holders: list[Holder] = []
        self.within: list[Holder] = []  # the open ones
        self.forms = 0
        self.regions = 0
        self.links = 0
        self._new()

    def _new(self):
        self.parts, self.tags, self.linked = [], 1, 0

    def _state(self):
        return self.open[-1][1:4] if self.open else (False, 0, False)

    def _flush(self):
        text = " ".join("".join(self.parts).split())
        if text:
            furniture, region, _ = self._state()
            self.lines.append((text, self.tags, self.linked, region, furniture, self.blocks[-1]))
        self._new()

    def _pop_to(self, i: int):
        gone = self.open[i:]
        if any(e[0] in BLOCK for e in gone):
            self._flush()
        for tag, _, _, _, block, holder in reversed(gone):
            self.names[tag] -= 1
            self.links -= tag == "a"
            self.forms -= tag == "form"
            if block is not None:
                block.last = self.n_blocks
                self.blocks.pop()
            if holder is not None:
                holder.stop = len(self.lines)
                self.within.pop()
                if self.within:
                    self.within[-1].region |= holder.region
                    self.within[-1].heading |= holder.heading
        del self.open[i:]

    def handle_starttag(self, tag, attrs):
        furniture, region, silent = self._state()
        if silent and tag in RUNNING:
            self._end_choices()
        if tag in CLOSES_P or tag in SAME:
            self._imply_ends(tag)
        if tag == "article" and self._state()[0] or tag == "main" and (self._state()[0] or any(h.kind != "form" for h in self.within)):
            self._leave_menu(tag)
        furniture, region, silent = self._state()
        if tag in BLOCK:
            self._flush()
        self.tags += 1
        if tag in ("br", "hr", "img"):
            self.parts.append(" ")
        if tag in VOID:
            return
        mark = "" if furniture else _marked(tag, attrs, region > 0)
        furniture = furniture or mark == "sure"
        block = holder = None
        if not furniture and (mark or tag == "form"):
            # a form with a marked name is one element with two reasons; the form's rule is the milder one
            holder = Holder("form" if tag == "form" and not mark else mark, len(self.lines))
            self.holders.append(holder)
            self.within.append(holder)
        if tag in ("article", "main") and not furniture:
            if not region:
                self.regions += 1
                region = self.regions
            if self.within:
                self.within[-1].region = True
        if tag in ("h1", "main") and self.within:
            self.within[-1].heading = True
        self.links += tag == "a"
        self.forms += tag == "form"
        if tag in INSIDE:
            self.n_blocks += 1
            block = Block(self.n_blocks, tag, self.blocks[-1])
            self.blocks.append(block)
        self.names[tag] += 1
        self.open.append((tag, furniture, region, silent or tag in SILENT or tag in LABELS and self.forms > 0, block, holder))

    def _end_choices(self):
        """A paragraph or heading ends the outermost silent element if that is a button or list of choices left open."""
        first = next(i for i, e in enumerate(self.open) if e[3])
        if self.open[first][0] in CHOICES:
            self._pop_to(first)

    def _leave_menu(self, tag):
        """No menu or page header holds the article: one still open there was not closed; <main> ends any furniture."""
        first = next(i for i, e in enumerate(self.open) if e[1] or e[5] is not None and e[5].kind != "form")
        if self.open[first][0] in ("nav", "header") or tag == "main":
            self._pop_to(first)

    def _imply_ends(self, tag):
        """A block ends an open paragraph; a list item, cell or row ends its open sibling."""
        for i in range(len(self.open) - 1, -1, -1):
            name = self.open[i][0]
            if tag in SAME and name in SAME[tag] or tag in CLOSES_P and name == "p":
                self._pop_to(i)
                return
            if name in SCOPE.get(tag, ()) or name in BLOCK:
                return

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in VOID and self.open and self.open[-1][0] == tag:
            self.handle_endtag(tag)

    def handle_endtag(self, tag):
        self.tags += 1
        if not self.names[tag]:
            return
        for i in range(len(self.open) - 1, -1, -1):
            if self.open[i][0] == tag:
                self._pop_to(i)
                return

    def handle_data(self, data):
        if not self._state()[2]:
            self.parts.append(data)
            if self.links:
                self.linked += len(data)


def page_lines(html: str) -> list[tuple[str, int, int, int, bool, Block]]:
    """(text, tags, link characters, region, furniture, innermost block) of each block with text, in page order."""
    p = _Lines()
    p.feed(_OPEN_TAG.sub("", html))
    p.close()
    p._flush()
    p._pop_to(0)
    n = len(p.lines)
    size = np.array([0 if x[4] else max(0, len(x[0]) - x[2]) for x in p.lines] or [0])
    in_region = np.array([bool(x[3]) and not x[4] for x in p.lines] or [False])
    held, regions = (np.concatenate([[0], np.cumsum(v)]) for v in (size, in_region))
    named = np.zeros(n + 1, np.int64)  # lines in marked elements; articles in those do not stand beside a wrapper
    for h in p.holders:
        if h.kind != "form":
            named[h.start] += 1
            named[h.stop] -= 1
    free = np.concatenate([[0], np.cumsum(in_region[:n] & (np.cumsum(named)[:n] == 0))])
    cover = np.zeros(n + 1, np.int64)
    for h in p.holders:
        most = 2 * (held[h.stop] - held[h.start]) > held[-1]
        beside = free[-1] - (free[h.stop] - free[h.start]) > 0
        if h.kind == "form":
            wrapper = h.region or most
        else:
            wrapper = most and not beside and (h.kind == "named" or h.heading)
        if not wrapper:
            cover[h.start] += 1
            cover[h.stop] -= 1
    covered = np.cumsum(cover)
    return [(*x[:4], True, x[5]) if c and not x[4] else x for x, c in zip(p.lines, covered.tolist())]


def smooth(values: np.ndarray, sigma: float = SIGMA) -> np.ndarray:
    """Gaussian smoothing over a window of three deviations each way; ends are weighted by what is there."""
    reach = int(np.ceil(3 * sigma))
    kernel = np.exp(-0.5 * (np.arange(-reach, reach + 1) / sigma) ** 2)
    full = lambda v: np.convolve(v, kernel)[reach:reach + len(v)]
    return full(values) / full(np.ones(len(values)))


def _grown(lines: list, chosen: list[int]) -> tuple[int, int]:
    """First and last line of the text around the chosen lines: what shares their block, and the page's heading before it."""
    around = around_all([lines[i][5] for i in chosen])
    if len(chosen) == 1 and around.parent is not None:
        around = around.parent
    while around.tag in RUNNING:
        around = around.parent
    page = around.holds(around_all([x[5] for x in lines]))

    def reach(edge, order):
        for i in order:
            text, _, linked, _, furniture, block = lines[i]
            if furniture:
                continue
            links = 2 * linked >= len(text)
            if not around.holds(block) or page and links:
                break
            if not links and not (page and block.boxes > around.boxes):
                edge = i
        return edge

    first, last = reach(chosen[0], range(chosen[0] - 1, -1, -1)), reach(chosen[-1], range(chosen[-1] + 1, len(lines)))
    for i in range(first, -1, -1):
        text, _, linked, _, furniture, block = lines[i]
        if not furniture and 2 * linked >= len(text) and i < first:
            break
        if not furniture and block.tag == "h1":
            return i, last
    return first, last


def main_text(html: str | None) -> str:
    """The main text of a page."""
    lines = page_lines(html or "")
    usable = [i for i, x in enumerate(lines) if not x[4]]
    if not usable:
        return ""
    ratio = np.array([0.0 if x[4] else max(0, len(x[0]) - x[2]) / x[1] for x in lines])
    level = smooth(ratio)
    top = level >= THRESHOLD * (level.mean() + level.std())
    chosen = [i for i in usable if top[i]]
    kept: list[int] = []
    if any(lines[i][3] for i in usable):
        regions = {lines[i][3] for i in chosen if lines[i][3]}
        if not regions:
            size: dict[int, int] = {}
            for i in usable:
                if lines[i][3]:
                    size[lines[i][3]] = size.get(lines[i][3], 0) + len(lines[i][0])
            regions = {max(size, key=size.get)}
        kept = [i for i in usable if lines[i][3] in regions]
        outside = [i for i in chosen if not lines[i][3]]
        if sum(len(lines[i][0]) for i in outside) > sum(len(lines[i][0]) for i in kept):  # articles beside the content
            lines = [(*x[:4], True, x[5]) if x[3] else x for x in lines]
            usable, chosen, kept = [i for i in usable if not lines[i][3]], outside, []
    if not kept:
        chosen = chosen or usable
        first, last = _grown(lines, chosen)
        kept = [i for i in usable if first <= i <= last]
    return "\n\n".join(lines[i][0] for i in kept)


def extract(pages: DataFrame) -> DataFrame:
    """Columns of ``pages`` without html, plus text and n_chars."""
    C.ship(pages.sparkSession)
    return C.beside(pages, ["html"], ["text", "n_chars"], _extracted)


def _extracted(pages: DataFrame) -> DataFrame:
    keep = [c for c in pages.columns if c != "html"]

    def scan(batches):
        for b in batches:
            for part in C.slices(b, "html"):
                texts = [main_text(h) for h in part.column(part.schema.get_field_index("html")).to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [*(part.column(part.schema.get_field_index(c)) for c in keep), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                    names=[*keep, "text", "n_chars"])

    return pages.mapInArrow(scan, C.with_fields(pages, ("html",), "text string, n_chars long"))
