"""Main text of web pages by minimum-cut labelling.  A page is a sequence of
text blocks.  A linear classifier's score of a block gives its two terminal
capacities; blocks that follow each other, and blocks of one parent element,
are tied by smoothness edges that weaken with their distance in the tree.  The
minimum cut separates content from boilerplate."""

from __future__ import annotations

import html
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from threadloom.llm.mincut import source_side

# Element and attribute words of HTML practice.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style title textarea noscript template iframe svg math xmp noembed noframes".split())
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd mark q rp rt ruby s samp "
                   "small span strike strong sub sup time tt u var img wbr br label output picture".split())
BOILERPLATE_TAGS = frozenset("nav footer aside form menu dialog button select option fieldset label datalist "
                             "address".split())
CONTENT_TAGS = frozenset("article main".split())
BOILERPLATE_WORDS = frozenset(
    "ad ads advert adverts advertisement advertising sponsor sponsored promo promos promotion banner menu nav navbar "
    "navigation breadcrumb breadcrumbs sidebar side aside footer masthead cookie cookies consent gdpr notice notices "
    "notification alert popup modal overlay newsletter subscribe subscription signup login register share sharing "
    "social related recommended recommendations comment comments commentlist disqus discussion replies reply respond "
    "widget toolbar pagination pager tags form search copyright legal disclaimer paywall hidden".split())
CONTENT_WORDS = frozenset("article content post entry story main body text prose".split())
BOILERPLATE_ROLES = frozenset("navigation banner contentinfo complementary search form alert alertdialog dialog menu "
                              "menubar status".split())
CLOSED_BY = {"p": frozenset("address article aside blockquote details div dl fieldset figcaption figure footer form "
                            "h1 h2 h3 h4 h5 h6 header hr main menu nav ol p pre section table ul".split()),
             "li": frozenset(["li"]), "dt": frozenset(["dt", "dd"]), "dd": frozenset(["dt", "dd"]),
             "tr": frozenset(["tr"]), "td": frozenset(["td", "th", "tr"]), "th": frozenset(["td", "th", "tr"]),
             "option": frozenset(["option"])}

# A tag whose quotes do not pair up within bounds ends at the next ">".
_TAG = re.compile(r"""<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)"""
                  r"""((?:[^>"']{1,2000}|"[^"]{0,9999}"|'[^']{0,9999}'){0,2000}+|[^>]*)>""", re.S)
#: A comment or declaration that runs to the page's end.
_UNCLOSED = re.compile(r"<[!?]")
_ATTRIBUTE = re.compile(r"""([a-zA-Z-]+)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+))""")
_WORDS = re.compile(r"[a-z0-9]+")


@dataclass
class Element:
    tag: str
    depth: int
    parent: "Element | None"
    score: float = 0.0  # of this element and those around it
    article: bool = False


@dataclass
class Block:
    parent: Element
    tag: str
    parts: list[str] = field(default_factory=list)
    linked: int = 0  # characters inside links


@dataclass(frozen=True)
class Weights:
    """Scores above 0 speak for content; smoothness is the cost of separating two blocks."""

    content_tag: float = 4.0
    content_word: float = 2.0
    boilerplate: float = -9.0
    header: float = -6.0
    base: float = -1.0
    words: float = 2.0       # reached at 25 words
    sentence: float = 0.5    # ends as a sentence does
    links: float = -4.0      # all text linked
    paragraph: float = 1.0
    heading: float = 0.5
    adjacent: float = 0.8
    siblings: float = 0.6


def _opened(tag: str, attributes: str, parent: Element, w: Weights) -> Element:
    e = Element(tag, parent.depth + 1, parent, parent.score, parent.article)
    if tag in CONTENT_TAGS:
        e.score += w.content_tag * (not parent.article)
        e.article = True
    elif tag in BOILERPLATE_TAGS:
        e.score += w.boilerplate
    elif tag == "header" and not parent.article:
        e.score += w.header
    if attributes and tag not in ("html", "body"):
        found = {m[1].lower(): m[2] or m[3] or m[4] or "" for m in _ATTRIBUTE.finditer(attributes)}
        words = set(_WORDS.findall(f"{found.get('class', '')} {found.get('id', '')}".lower()))
        role = found.get("role", "").lower()
        if (words & BOILERPLATE_WORDS or role in BOILERPLATE_ROLES or found.get("aria-hidden") == "true"
                or "display:none" in found.get("style", "").replace(" ", "")):
            e.score += w.boilerplate
        elif "header" in words and not parent.article:
            e.score += w.header
        elif role in ("main", "article"):
            e.score += w.content_tag
            e.article = True
        elif words & CONTENT_WORDS:
            e.score += w.content_word
    return e


def blocks_of(page: str, w: Weights) -> list[Block]:
    """Blocks with text, in page order.  Inline elements, links among them, do
    not end a block; a line break is white space inside it."""
    root = Element("", 0, None)
    here, links = root, 0
    out: list[Block] = []
    block: Block | None = None

    def text(raw: str) -> None:
        nonlocal block
        if not raw:
            return
        if block is None:
            if not raw.strip():
                return
            own = here
            while own.tag in INLINE and own.parent is not None and own.tag not in BOILERPLATE_TAGS:
                own = own.parent
            block = Block(own, own.tag)
            out.append(block)
        block.parts.append(raw)
        if links:
            block.linked += len(raw)

    at, end = 0, len(page)
    closed = page.rfind(">") + 1  # no tag ends behind it: looked for no further, scanning stays linear
    while at < end:
        m = _TAG.search(page, at, closed)
        if m is None:
            rest = _UNCLOSED.search(page, max(at, closed))
            text(page[at:rest.start() if rest else end])
            break
        text(page[at:m.start()])
        at = end if m[0].startswith("<!--") and not m[0][4:].endswith("-->") else m.end()
        tag = (m[2] or "").lower()
        if not tag:
            continue
        if m[1]:
            e = here
            while e is not root and e.tag != tag:
                e = e.parent
            if e is not root:
                while here is not e:
                    links -= here.tag == "a"
                    here = here.parent
                links -= here.tag == "a"
                here = here.parent
            if tag not in INLINE:
                block = None
            continue
        if tag == "br":
            text(" ")
            continue
        if tag in RAW:
            close = re.compile(rf"</{re.escape(tag)}(?=[\s/>])[^>]*>", re.I).search(page, at, max(at, closed))
            at = end if close is None else close.end()
            if tag == "title" or tag not in INLINE:
                block = block if tag in ("svg", "math", "script", "style") else None
            continue
        if tag not in INLINE:
            block = None
            e = here  # an element whose end tag was left out
            while e is not root and e.tag in INLINE:
                e = e.parent
            if e.tag in CLOSED_BY and tag in CLOSED_BY[e.tag]:
                while here is not e:
                    links -= here.tag == "a"
                    here = here.parent
                here = e.parent
        if tag in VOID:
            continue
        here = _opened(tag, m[3], here, w)
        links += tag == "a"
    return out


def _distance(a: Element, b: Element) -> int:
    n = 0
    while a is not b:
        if a.depth >= b.depth:
            a = a.parent
        else:
            b = b.parent
        n += 1
    return n


def main_text(page: str | None, w: Weights = Weights()) -> str:
    """The content blocks of a page, one to a line; empty if there are none."""
    if not page:
        return ""
    blocks, texts, scores = [], [], []
    for b in blocks_of(page, w):
        text = " ".join(html.unescape("".join(b.parts)).split())
        if not text:
            continue
        n = text.count(" ") + 1
        score = b.parent.score + w.base + w.words * min(n, 25) / 25
        score += w.sentence * (text[-1] in ".!?…。\"'”»)")
        score += w.links * min(1.0, b.linked / max(1, sum(map(len, b.parts))))
        score += w.paragraph * (b.tag in ("p", "blockquote", "pre")) + w.heading * (b.tag[:1] == "h" and b.tag[1:].isdigit())
        blocks.append(b)
        texts.append(text)
        scores.append(score)
    edges = [(i, i + 1, w.adjacent / (1 + _distance(blocks[i].parent, blocks[i + 1].parent) / 2))
             for i in range(len(blocks) - 1)]
    last: dict[int, int] = {}
    for i, b in enumerate(blocks):
        around = b.parent.parent if b.parent.parent is not None else b.parent
        if id(around) in last:
            edges.append((last[id(around)], i, w.siblings))
        last[id(around)] = i
    return "\n".join(t for t, kept in zip(texts, source_side(scores, edges), strict=True) if kept)


def _extract(weights: Weights):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            page_id, url, pages = batch.columns
            texts = [main_text(p.as_py(), weights) for p in pages]
            yield pa.RecordBatch.from_arrays(
                [page_id, url, pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                ["page_id", "url", "text", "n_chars"])
    return run


def extract_text(pages: DataFrame, weights: Weights = Weights(), page_id: str = "page_id", url: str = "url",
                 html_column: str = "html") -> DataFrame:
    """One row per row of ``pages``: page_id, url, text, n_chars (code points).

    A null or empty page, and one without content, gives the empty text; null
    ids and urls stay null; repeated rows each keep their row; an empty table
    gives no rows; other columns of ``pages`` do not take part.  Pages are
    handled alone and whole, without a shuffle.
    """
    rows = pages.select(F.col(page_id).alias("page_id"), F.col(url).alias("url"), F.col(html_column).alias("html"))
    return rows.mapInArrow(_extract(weights), "page_id long, url string, text string, n_chars long")
