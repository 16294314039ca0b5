"""Main text of web pages by minimum-cut labelling.

A page becomes a row of text blocks.  A linear classifier gives each block a cost
for either label, which are the capacities of its edges to the two terminals;
blocks that are neighbours on the page or near in the element tree are joined by
smoothness edges.  The minimum cut separates content from boilerplate: a short
paragraph follows the long ones around it, a long advert stays with its box.

What the name of an element says holds for all text in it, unless the element is
the frame of the page's body: one that holds nearly all its paragraphs, or the
`main` or `article` with most of them.
"""

from __future__ import annotations

import html
import re
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame

from lakemart.llm.common import per_batch, texts

_TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*[^>]*)(?:>|\Z)|</[^>]*(?:>|\Z)", re.S)
_ATTRIBUTE = re.compile(r"([^\s=/\"'>]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
_NAME_PART = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|[0-9]+")

# fixed values: element kinds of HTML
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
BLOCK = frozenset(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form frameset h1 h2 h3 h4 h5 h6 "
    "head header hgroup hr html legend li main menu nav ol optgroup option p pre search section select summary table tbody tfoot thead tr ul caption "
    "template noscript object canvas video audio svg button".split()
)
#: Elements whose text never is part of a page's body.
SILENT = frozenset("head script style textarea title template noscript iframe noembed noframes object canvas video audio svg math select datalist".split())
# an element that ends when another of its kind, or a block, begins
CLOSES = {
    "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"},
    "tbody": {"tr", "td", "th", "thead", "tbody"}, "tfoot": {"tr", "td", "th", "tbody"},
}
KEEPS_P = frozenset("body html article section div td th li blockquote main".split())

# fixed values: what names of classes, ids and roles say
NEGATIVE = frozenset(
    "ad ads adv advert adverts advertisement advertising adsense adslot banner sponsor sponsored promo promotion promoted cookie cookies consent gdpr "
    "notice notification alert popup popover modal overlay lightbox newsletter subscribe subscription signup login signin register paywall comment "
    "comments disqus reply replies respond discussion share sharing social follow related recommended recommendations recommendation more trending "
    "popular sidebar aside rail widget widgets nav navbar navigation menu menus breadcrumb breadcrumbs pagination pager toolbar topbar masthead footer "
    "copyright legal disclaimer search form skip hidden complementary contentinfo dialog taboola outbrain teaser teasers".split()
)
NEGATIVE_START = ("advert", "sponsor", "cookie", "newsletter", "comment", "sidebar", "recommend", "breadcrumb")
POSITIVE = frozenset("article content main post entry story body text prose page hentry".split())
NEGATIVE_TAGS = frozenset("nav footer aside menu dialog button search".split())
#: Elements that count like a negative name, since some pages are one form.
NEGATIVE_FRAMES = frozenset("form fieldset".split())
# of the negative names, those of reader comments and of adverts
COMMENTS = frozenset("comment comments disqus reply replies respond discussion".split())
ADVERTS = frozenset("ad ads adv advert adverts advertisement advertising adsense adslot sponsor sponsored promo promotion promoted".split())
# what stands after these in a name describes the element's state or subject, not its kind
MODIFIERS = frozenset("no not non without with has have is category cat tag format type status layout term topic".split())
STATES = frozenset("open closed enabled disabled on off".split())

#: Weights of the classifier; positive speaks for content.
WEIGHTS = {"bias": -0.8, "boilerplate": -12.0, "header": -4.0, "article": 3.5, "positive": 1.0, "paragraph": 0.6, "words": 0.25, "links": -4.0, "rights": -1.5}
#: Smoothness of neighbours on the page and of blocks of one parent, over their distance in the tree.
NEIGHBOUR, SIBLING = 2.0, 1.5
LONGEST_WORDS = 60
#: Words that make a block a paragraph, and the share of the paragraphs' text that makes an element the page's frame.
PARAGRAPH_WORDS, FRAME_SHARE = 10, 0.9


@dataclass(eq=False)
class _Element:
    tag: str
    parent: _Element | None = None
    depth: int = 0
    marks: frozenset[str] = frozenset()
    #: what its own name says: "" nothing, "comments", or "boilerplate"
    named: str = ""
    #: characters of the paragraphs in it
    paragraphs: int = 0
    vetoed: bool = False


@dataclass
class Block:
    text: str
    within: _Element
    marks: frozenset[str]
    tag: str
    link_chars: int
    chars: int


@dataclass
class _Page:
    """Blocks of one page while its tags are read."""

    root: _Element = field(default_factory=lambda: _Element(""))
    open: list[_Element] = field(default_factory=list)
    elements: list[_Element] = field(default_factory=list)
    found: list[Block] = field(default_factory=list)
    parts: list[str] = field(default_factory=list)
    linked: int = 0

    def text(self, raw: str) -> None:
        if raw and not (self.open and "silent" in self.open[-1].marks):
            plain = html.unescape(raw) if "&" in raw else raw
            self.parts.append(plain)
            if self.open and "link" in self.open[-1].marks:
                self.linked += len(plain.strip())

    def flush(self) -> None:
        if self.parts:
            words = "".join(self.parts).split()
            if words:
                text = " ".join(words)
                inner = next((e for e in reversed(self.open) if e.tag in BLOCK), None)
                within = self.open[-1] if self.open else self.root
                self.found.append(Block(text, within, within.marks, inner.tag if inner else "", min(self.linked, len(text)), len(text)))
            self.parts, self.linked = [], 0

    def start(self, tag: str, attributes: str, closed: bool) -> None:
        if tag in BLOCK:
            self.flush()
            self._end_paragraph()
        elif tag in ("br", "td", "th"):
            self.parts.append(" ")
        ends = CLOSES.get(tag)
        while ends and self.open and self.open[-1].tag in ends:
            self.open.pop()
        if tag in VOID or closed:
            return
        parent = self.open[-1] if self.open else self.root
        marks, named = _marks(tag, attributes, parent.marks)
        element = _Element(tag, parent, parent.depth + 1, parent.marks | marks if marks else parent.marks, named)
        self.open.append(element)
        self.elements.append(element)

    def _end_paragraph(self) -> None:
        for at in range(len(self.open) - 1, -1, -1):
            if self.open[at].tag == "p":
                del self.open[at:]
                return
            if self.open[at].tag in KEEPS_P:
                return

    def end(self, tag: str) -> None:
        if tag in BLOCK:
            self.flush()
        for at in range(len(self.open) - 1, -1, -1):
            if self.open[at].tag == tag:
                if tag not in BLOCK and any(e.tag in BLOCK for e in self.open[at + 1 :]):
                    return  # a stray end of an inline element does not end blocks
                del self.open[at:]
                return


def _name_words(value: str) -> tuple[set[str], set[str]]:
    """The words of the names in a class, id or role that tell its kind, and of
    these the words that speak against content."""
    words: set[str] = set()
    for name in value.split():
        parts = [w.lower() for w in _NAME_PART.findall(name)]
        cut = next((i for i, w in enumerate(parts) if w in MODIFIERS), len(parts))
        if cut == len(parts) and len(parts) > 1 and parts[-1] in STATES:
            cut = 0
        words.update(parts[:cut])
    return words, {w for w in words if w in NEGATIVE or w.startswith(NEGATIVE_START)}


def _marks(tag: str, attributes: str, outer: frozenset[str]) -> tuple[set[str], str]:
    """What an element says about the text in it, and what its name says."""
    out = set()
    named = ""
    if tag in SILENT:
        out.add("silent")
    if tag == "a":
        out.add("link")
    if tag in ("article", "main"):
        out.add("article")
    if tag in NEGATIVE_TAGS:
        out.add("boilerplate")
    if tag in NEGATIVE_FRAMES:
        named = "boilerplate"
    if tag == "header" and "article" not in outer:
        out.add("header")
    if attributes and tag not in ("html", "body", "a"):
        for m in _ATTRIBUTE.finditer(attributes):
            name = m[1].lower()
            value = m[2] or m[3] or m[4] or ""
            if name in ("class", "id", "role"):
                words, bad = _name_words(value)
                if tag in ("article", "main"):
                    bad = {w for w in bad if w in COMMENTS or w in ADVERTS or w.startswith(NEGATIVE_START)}
                good = words & POSITIVE
                if bad:
                    comments = any(w in COMMENTS or w.startswith("comment") for w in bad)
                    named = "comments" if comments or named == "comments" else "boilerplate"
                elif name == "role" and words & {"main", "article"}:
                    out.add("article")
                elif "header" in words and "article" not in outer and not good:
                    out.add("header")
                elif good:
                    out.add("positive")
            elif name == "hidden" or name == "aria-hidden" and value.strip().lower() == "true":
                out.add("boilerplate")
            elif name == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value.lower()):
                out.add("boilerplate")
    return out, named


def _veto(state: _Page) -> None:
    """Mark the elements whose text a negative name rules out.

    The name of an element that frames the page's body says nothing, unless it
    is one of reader comments.  Paragraphs of these do not count.
    """
    for element in state.elements:  # outer elements first
        element.vetoed = element.parent.vetoed or element.named == "comments"
    for block in state.found:
        if not block.within.vetoed and "boilerplate" not in block.marks and block.text.count(" ") + 1 >= PARAGRAPH_WORDS:
            block.within.paragraphs += block.chars - block.link_chars
    for element in reversed(state.elements):  # inner elements first
        element.parent.paragraphs += element.paragraphs
    whole = state.root.paragraphs
    bodies = [e for e in state.elements if e.tag in ("main", "article") and not e.named]
    body = max(bodies, key=lambda e: e.paragraphs, default=None)
    frames = set()
    if body is not None and 2 * body.paragraphs > whole:
        while body is not None:
            frames.add(id(body))
            body = body.parent
    for element in state.elements:
        framing = id(element) in frames or 0 < whole * FRAME_SHARE <= element.paragraphs
        element.vetoed = element.parent.vetoed or element.vetoed or element.named != "" and not framing


def read_blocks(page: str) -> list[Block]:
    """The text blocks of a page in order; broken markup never fails."""
    state = _Page()
    at = 0
    size = len(page)
    while at < size:
        m = _TOKEN.search(page, at)
        if m is None:
            rest = page[at:]
            # an unfinished tag at the end of a cut page is no text
            cut = re.search(r"<[/!a-zA-Z][^<]*\Z", rest)
            state.text(rest[: cut.start()] if cut else rest)
            break
        if m.start() > at:
            state.text(page[at : m.start()])
        at = m.end()
        if m[0].startswith("<![CDATA["):
            state.text(m[0][9:].removesuffix("]]>"))
        elif m[2]:
            tag = m[2].lower()
            if m[1]:
                state.end(tag)
            else:
                closed = m[3].endswith("/")
                state.start(tag, m[3], closed)
                if tag in RAW and not closed:
                    end = re.compile(rf"</{re.escape(tag)}\s*(?:>|\Z)", re.I).search(page, at)
                    at = end.end() if end else size
                    state.end(tag)
    state.flush()
    _veto(state)
    return state.found


def score(block: Block) -> float:
    """Cost of calling the block boilerplate less that of calling it content."""
    w = WEIGHTS
    words = min(LONGEST_WORDS, block.text.count(" ") + 1)
    out = w["bias"] + w["words"] * words**0.5 + w["links"] * block.link_chars / block.chars
    if block.within.vetoed or "boilerplate" in block.marks:
        out += w["boilerplate"]
    for mark in ("header", "article", "positive"):
        if mark in block.marks:
            out += w[mark]
    if block.tag in ("p", "blockquote", "pre", "h1", "h2", "h3", "figcaption"):
        out += w["paragraph"]
    if words < 30 and ("©" in block.text or "all rights reserved" in block.text.lower()):
        out += w["rights"]
    return out


def _steps(a: _Element, b: _Element) -> int:
    """How many steps lead from one element to the other in the tree."""
    steps = 0
    while a is not b:
        if a.depth >= b.depth:
            a = a.parent
        else:
            b = b.parent
        steps += 1
    return steps


def _edges(blocks: list[Block]) -> list[tuple[int, int, float]]:
    out = []
    last_of: dict[int, int] = {}
    for i, block in enumerate(blocks):
        if i:
            out.append((i - 1, i, NEIGHBOUR / (1 + _steps(blocks[i - 1].within, block.within))))
        parent = id(block.within.parent or block.within)
        before = last_of.get(parent)
        if before is not None:
            out.append((before, i, SIBLING / 3))
        last_of[parent] = i
    return out


def minimum_cut(scores: list[float], edges: list[tuple[int, int, float]]) -> list[bool]:
    """Which nodes lie on the source side of a minimum cut.

    A positive score is the capacity from the source, a negative one that to the
    sink; edges bind both ways.  Flow is pushed in rounds: one search gives each
    node its distance from the nodes with capacity left at the source, then all
    shortest paths to nodes with capacity left at the sink are filled.  Weak
    edges fill up near the sources, so a page needs few rounds.
    """
    n = len(scores)
    left = list(scores)
    near: list[dict[int, float]] = [{} for _ in range(n)]
    for a, b, capacity in edges:
        near[a][b] = near[a].get(b, 0.0) + capacity
        near[b][a] = near[b].get(a, 0.0) + capacity
    tiny = 1e-9
    while True:
        far = [-1] * n
        layer = [i for i in range(n) if left[i] > tiny]
        for i in layer:
            far[i] = 0
        sources, reached = layer, False
        while layer and not reached:
            following = []
            for i in layer:
                for j, room in near[i].items():
                    if room > tiny and far[j] < 0:
                        far[j] = far[i] + 1
                        reached = reached or left[j] < -tiny
                        following.append(j)
            layer = following
        if not reached:
            return [d >= 0 for d in far]
        ahead: list[list[int] | None] = [None] * n  # what is still to be tried from a node in this round
        for source in sources:
            path = [source]
            while path and left[source] > tiny:
                i = path[-1]
                if left[i] < -tiny:
                    flow = min(left[source], -left[i], *(near[a][b] for a, b in zip(path, path[1:])))
                    left[source] -= flow
                    left[i] += flow
                    for a, b in zip(path, path[1:]):
                        near[a][b] -= flow
                        near[b][a] += flow
                    path = [source]
                    continue
                if ahead[i] is None:
                    ahead[i] = [j for j in near[i] if far[j] == far[i] + 1]
                while ahead[i] and near[i][ahead[i][-1]] <= tiny:
                    ahead[i].pop()
                if ahead[i]:
                    path.append(ahead[i][-1])
                else:
                    path.pop()
                    if path:  # a dead end: the node before it goes on with its next one
                        ahead[path[-1]].pop()


def main_text(page: str | None) -> tuple[str, int]:
    """The blocks that the cut leaves to the content, joined by blank lines, and
    the number of all blocks."""
    blocks = read_blocks(page or "")
    content = minimum_cut([score(b) for b in blocks], _edges(blocks))
    return "\n\n".join(b.text for b, good in zip(blocks, content) if good), len(blocks)


def extract(pages: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """Add the main text of each page, its length in code points and its number of blocks.

    Null and empty pages, and pages without content, give an empty text; text
    outside any element counts as a block.  A page of any length
    is read whole, in time that grows with its length.  Repeated rows are read each; a column
    of `pages` that has the name of a result is replaced; an empty table gives no
    rows.
    """

    def run(batch: pa.RecordBatch) -> dict:
        found = [main_text(p) for p in texts(batch, "html")]
        return {"text": [t for t, _ in found], "n_chars": [len(t) for t, _ in found], "n_blocks": [n for _, n in found]}

    return per_batch(pages, run, "text string, n_chars long, n_blocks int", keep)
