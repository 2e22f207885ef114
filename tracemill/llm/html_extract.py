"""Main text of HTML pages: flat text blocks judged by a decision tree.

A page is cut into text blocks at block-level tags. Each block has a few numbers: its words and
link density, those of the blocks before and after it, and what the markup around it says
(the innermost container that names page furniture or the article, and whether the block
stands outside of an article element). Names of headings and paragraphs inside an article say
nothing unless they name adverts, notices, menus or comments; a header that opens an article
belongs to it. A decision tree, grown on the small labelled table below, tells article from furniture. The tree is a few arrays that
travel with the task; pages are parsed where they lie, nothing is shuffled.

Defined results: a null or empty page, and one without article text, gives an empty text.
Character references are decoded once, white space inside a block becomes one space, blocks
are joined by an empty line in page order. Unclosed and misplaced tags, cut-off pages and
stray `<` are read as far as they make sense. Repeated rows are extracted alike and other
columns are kept.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

MARKUP = re.compile(
    r"""<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)((?:\s+|/|[^\s"'<>=/]+|=\s*"[^"]*"|=\s*'[^']*'|=\s*[^\s"'<>]+|["'=])*)(?:>|\Z|(?=<))|<[!?/][^>]*(?:>|\Z)""",
    re.S,
)
ATTRIBUTE = re.compile(r"""\b(class|id|role|hidden|aria-hidden)\b(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""", re.I)
NAME = re.compile(r"[a-z0-9]+")
#: Elements whose content is no text of the page.
SKIPPED = frozenset("script style noscript template title textarea select option button svg math iframe object canvas head datalist".split())
#: Of these, those whose content is not markup.
RAW = frozenset("script style title textarea iframe".split())
#: Elements that do not end a block.
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label mark nobr q rp rt ruby s samp small span strike strong sub sup time tt u var wbr br input".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements, and words of class, id and role, that name furniture or the article.
FURNITURE_TAGS = frozenset("nav footer aside form menu dialog fieldset".split())
ARTICLE_TAGS = frozenset("article main".split())
FURNITURE_WORDS = frozenset(
    """ad ads adv advert adverts advertisement advertising adsense adbox sponsor sponsored promo promotion
    nav navbar navigation menu menubar breadcrumb breadcrumbs footer copyright sidebar
    aside cookie cookies consent gdpr notice notices alert popup modal overlay comment comments
    commentlist respond disqus reply replies form login signup subscribe newsletter share sharing social
    pagination pager toolbar complementary contentinfo""".split()
)
#: These name furniture around an article; inside one they may as well name a part of it.
DOUBTFUL_WORDS = frozenset("banner header masthead topbar widget widgets search related recommended tags".split())
#: Of these, those that name what an article opens with.
OPENING_WORDS = frozenset("banner header masthead".split())
ARTICLE_WORDS = frozenset("article content post entry story main maincontent articlebody body text".split())
#: Before `header` these name the head of an article, wherever it stands.
HEADED_WORDS = frozenset("article post entry story".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
ITEMS = frozenset("li td th dt dd".split())
#: Elements that hold running text; their names say little inside an article.
TEXT_TAGS = frozenset("p blockquote pre figure figcaption".split()) | HEADINGS | ITEMS
#: After these a name says something else: `has-sidebar`, `no-ads`.
NEGATING = frozenset("has with no without".split())
#: Hints of a block: the article, something doubtful in it, nothing, furniture.
ARTICLE, DOUBTFUL, NEITHER, FURNITURE = 1.0, 0.5, 0.0, -1.0

FEATURES = ("words", "links", "words_before", "links_before", "words_after", "links_after", "hint", "heading", "item", "outside")


@dataclass
class Block:
    text: str
    words: int
    links: float
    hint: float
    heading: bool
    item: bool  # in a list or table
    inside: bool  # in an article element
    outside: bool = False  # in none, on a page whose text has one


@dataclass
class _Open:
    """An open element; all but the tag hold for what is inside it, too."""

    tag: str
    hint: float = NEITHER
    heading: bool = False
    item: bool = False
    #: Blocks there were when the innermost article began, -1 outside of any.
    begun: int = -1
    inside: bool = False


def _names(attributes: str, ids: bool) -> set[str] | None:
    """Words of class, id and role; None if the element is hidden."""
    names: set[str] = set()
    for match in ATTRIBUTE.finditer(attributes):
        name, value = match[1].lower(), (match[2] or match[3] or match[4] or "").lower()
        if name == "hidden" or name == "aria-hidden":
            if value in ("", "hidden", "true"):
                return None
        elif ids or name != "id":
            found = NAME.findall(value)
            names.update(n for i, n in enumerate(found) if not (i and found[i - 1] in NEGATING))
    return names


def _hint(tag: str, attributes: str, around: _Open, blocks: int) -> float:
    """What an element says about its text; an opening header belongs to its article."""
    if tag in ("html", "body"):
        return NEITHER
    within = around.hint > 0
    names = _names(attributes, not (within and tag in HEADINGS)) if attributes else set()
    if names is None or tag in FURNITURE_TAGS or names & FURNITURE_WORDS:
        return FURNITURE
    if within and tag in TEXT_TAGS:
        return NEITHER
    if tag == "header" or names & DOUBTFUL_WORDS:
        opening = tag == "header" or names & OPENING_WORDS
        if opening and (within and around.begun == blocks or names & HEADED_WORDS and tag not in ARTICLE_TAGS):
            return ARTICLE
        return DOUBTFUL if within and not opening else FURNITURE
    return ARTICLE if tag in ARTICLE_TAGS or names & ARTICLE_WORDS else NEITHER


def blocks(page: str) -> list[Block]:
    """Text blocks of a page, in page order."""
    out: list[Block] = []
    root = _Open("")
    stack: list[_Open] = []
    open_of: dict[str, int] = {}
    parts: list[tuple[str, bool]] = []
    in_link = skipping = 0
    at = 0

    def close_block() -> None:
        if parts:
            text = " ".join(html.unescape("".join(t for t, _ in parts)).split())
            if text:
                linked = sum(len(" ".join(html.unescape(t).split())) for t, link in parts if link)
                here = stack[-1] if stack else root
                out.append(Block(text, len(text.split()), min(1.0, linked / len(text)), here.hint, here.heading, here.item, here.inside))
            parts.clear()

    def enter(tag: str, attributes: str) -> None:
        around = stack[-1] if stack else root
        own = _hint(tag, attributes, around, len(out))
        article = own == ARTICLE and tag in ARTICLE_TAGS
        begun = len(out) if own == ARTICLE and around.hint <= 0 else around.begun
        stack.append(_Open(tag, own or around.hint, around.heading or tag in HEADINGS, around.item or tag in ITEMS, begun, around.inside or article))
        open_of[tag] = open_of.get(tag, 0) + 1

    def leave() -> _Open:
        last = stack.pop()
        open_of[last.tag] -= 1
        return last

    while at < len(page):
        match = MARKUP.search(page, at)
        if match is None:
            if not skipping:
                parts.append((page[at:], in_link > 0))
            break
        if match.start() > at and not skipping:
            parts.append((page[at : match.start()], in_link > 0))
        at = max(match.end(), match.start() + 1)
        tag = (match[2] or "").lower()
        if not tag:
            continue
        if match[1]:
            if tag == "a":
                in_link = max(0, in_link - 1)
            elif tag not in INLINE:
                close_block()
                if open_of.get(tag):
                    found = ""
                    while found != tag:
                        found = leave().tag
                        skipping -= found in SKIPPED
                    in_link = 0
            continue
        if tag in RAW:
            end = re.compile(rf"</{tag}\b[^>]*(?:>|\Z)", re.I).search(page, at)
            at = end.end() if end else len(page)
            if tag not in INLINE:
                close_block()
            continue
        if tag == "br":
            parts.append((" ", in_link > 0))
        elif tag == "a":
            in_link += 1
        elif tag not in INLINE:
            close_block()
            if tag in VOID or match[0].endswith("/>"):
                continue
            if tag == "body":  # a head that was never closed ends here
                skipping = 0
                while stack:
                    leave()
            # A paragraph or list item ends where the next block of its kind begins.
            if stack and stack[-1].tag == "p" or stack and stack[-1].tag == tag and tag in ("li", "td", "th", "tr", "dt", "dd", "option"):
                leave()
            enter(tag, match[3])
            skipping += tag in SKIPPED
    close_block()
    if any(b.inside for b in out):
        for b in out:
            b.outside = not b.inside
    return out


def features(page: list[Block]) -> np.ndarray:
    """One row of FEATURES per block."""
    own = np.array([(b.words, b.links) for b in page], float).reshape(-1, 2)
    zero = np.zeros((1, 2))
    rest = np.array([(b.hint, b.heading, b.item, b.outside) for b in page], float).reshape(-1, 4)
    return np.hstack([own, np.vstack([zero, own])[:-1], np.vstack([own, zero])[1:], rest])


@dataclass
class DecisionTree:
    """Flat arrays: a node tests `feature` against `limit`, or is a leaf with feature -1."""

    feature: list[int] = field(default_factory=list)
    limit: list[float] = field(default_factory=list)
    low: list[int] = field(default_factory=list)
    high: list[int] = field(default_factory=list)
    share: list[float] = field(default_factory=list)

    @classmethod
    def grow(cls, x: np.ndarray, y: np.ndarray, depth: int = 6, least: int = 2) -> DecisionTree:
        """Splits by Gini impurity until leaves are pure, small or deep enough."""
        tree = cls()
        tree._add(x, y.astype(float), depth, least)
        return tree

    def _add(self, x: np.ndarray, y: np.ndarray, depth: int, least: int) -> int:
        node = len(self.feature)
        for column, value in zip((self.feature, self.limit, self.low, self.high, self.share), (-1, 0.0, -1, -1, float(y.mean())), strict=True):
            column.append(value)
        best = (y.var() * len(y) - 1e-9, None)
        if depth and best[0] > 0:
            for k in range(x.shape[1]):
                for limit in np.unique(x[:, k])[:-1]:
                    left = x[:, k] <= limit
                    if least <= left.sum() <= len(y) - least:
                        cost = sum(y[side].var() * side.sum() for side in (left, ~left))
                        if cost < best[0]:
                            best = (cost, (k, limit))
        if best[1] is not None:
            k, limit = best[1]
            above = x[x[:, k] > limit, k].min()
            left = x[:, k] <= limit
            self.feature[node], self.limit[node] = k, float((limit + above) / 2)
            self.low[node] = self._add(x[left], y[left], depth - 1, least)
            self.high[node] = self._add(x[~left], y[~left], depth - 1, least)
        return node

    def predict(self, x: np.ndarray) -> np.ndarray:
        """Share of article blocks in the leaf of each row."""
        feature, limit, low, high = map(np.array, (self.feature, self.limit, self.low, self.high))
        at = np.zeros(len(x), int)
        while len(inner := np.flatnonzero(feature[at] >= 0)):
            k = at[inner]
            at[inner] = np.where(x[inner, feature[k]] <= limit[k], low[k], high[k])
        return np.array(self.share)[at]


#: The labelled table: pages as pieces of markup; + holds article text, - furniture.
_LONG = "The committee met in the morning to discuss the plan, and after some hours of talk it agreed on most of the points that had been left open. "
_NAV = '<nav><ul><li><a href="/">Home</a></li><li><a href="/n">News</a></li><li><a href="/c">Contact us</a></li></ul></nav>'
LABELLED: list[list[tuple[str, str]]] = [
    [("-", _NAV), ("-", '<div class="ad">Buy two and get one free this week.</div>'), ("+", f"<article><h1>Plan agreed</h1><p>{_LONG * 3}</p><p>Then lunch.</p><p>{_LONG}</p><p>End.</p></article>"),
     ("-", "<footer>&copy; example.org &middot; All rights reserved by the owners.</footer>")],
    [("-", f"<header><h1>The Daily</h1><p>News since 1900</p></header>{_NAV}"), ("+", f"<main><h2>Rain</h2><p>{_LONG * 2}</p><ul><li>First point</li><li>Second point of the list</li></ul><p>See <a href='/x'>the report</a></p></main>"),
     ("-", '<aside><h3>Most read</h3><ul><li><a href="/1">One story</a></li><li><a href="/2">Another story</a></li></ul></aside><footer><a href="/p">Privacy</a> <a href="/t">Terms</a></footer>')],
    [("-", '<div id="cookie-notice">We use cookies to make this page better. <button>OK</button></div><div class="menu"><a href="/">Start</a> <a href="/a">About</a></div>'),
     ("+", f'<div class="content"><h1>Title of the story</h1><p>{_LONG}</p><blockquote>Short quote.</blockquote><p>{_LONG * 2}</p><table><tr><td>1</td><td>apples</td></tr></table></div>'),
     ("-", f'<div class="comments"><h3>Comments</h3><p>{_LONG}</p><p>Great post, thanks!</p></div><div class="footer">Imprint</div>')],
    [("-", '<ul><li><a href="/">Home</a></li><li><a href="/b">Blog</a></li><li><a href="/i">Index of pages</a></li></ul>'), ("+", f"<h1>A plain page</h1><p>{_LONG * 2}</p><p>{_LONG * 2}</p><p>{_LONG}</p>"),
     ("-", '<p><a href="/prev">Previous</a> <a href="/next">Next</a></p><p>Copyright 2020</p>')],
    [("-", '<div><a href="/">Home</a> | <a href="/s">Shop</a> | <a href="/k">Cart</a></div>'), ("+", f"<div><p>{_LONG * 4}</p><p>{_LONG * 2}</p></div>"), ("-", '<div><a href="/x">More of this</a></div><div>Share</div>')],
    [("-", '<ul><li><a href="/">Start</a></li><li><a href="/t">All topics</a></li></ul>'), ("+", f"<p>{_LONG * 3}</p><p>{_LONG}</p>"), ("-", '<p><a href="/m">More like this</a></p><p><a href="/z">Last page</a></p>')],
    [("-", '<p><a href="/">Back to the list</a></p>'), ("+", f"<h2>What was said</h2><p>{_LONG * 2}</p><h2>What came of it</h2><p>{_LONG * 3}</p>"), ("-", '<div><a href="/a">Older</a></div><div><a href="/b">Newer</a></div>')],
    [("-", '<div><a href="/de">Deutsch</a> <a href="/en">English</a></div><div><a href="/l">Sign in</a></div>'), ("+", f"<h1>On the river</h1><div>{_LONG * 2}</div><div>{_LONG * 4}</div>"), ("-", "<div>Top</div><div>Share</div>")],
    [("-", f"<header><p>{_LONG * 3}</p></header><aside><p>{_LONG * 4}</p><p>{_LONG * 2}</p></aside>"), ("+", f"<main><p>{_LONG * 2}</p><p>{_LONG * 2}</p></main>"),
     ("-", f'<div class="comments"><p>{_LONG * 3}</p><p>{_LONG * 5}</p></div><div class="cookie-banner"><p>{_LONG * 2}</p></div><footer><p>{_LONG * 4}</p></footer>')],
    [("-", f'<div class="advert"><p>{_LONG * 2}</p></div>'), ("+", f"<div><p>{_LONG * 2}</p><p>{_LONG * 3}</p></div>"), ("-", f'<form><p>{_LONG * 2}</p></form><div id="sidebar"><div>{_LONG * 3}</div></div>')],
    [("+", f"<article><p>{_LONG}</p><p><a href='/a'>The whole report</a></p><p>End.</p></article>")],
    [("+", f"<article><h1>One line</h1></article>")],
    [("+", f"<main><h1>Links of the week</h1><ul><li><a href='/1'>First find</a></li><li><a href='/2'>Second find</a></li></ul><p>{_LONG * 6}</p><p>Bye.</p></main>")],
    [("+", f"<article><p>{_LONG * 8}</p><p>Yes.</p><p>{_LONG * 8}</p><p>No.</p><p><a href='/s'>Source</a></p></article>")],
    [("-", "<div><a href='/'>Home</a></div>"), ("+", "<article><p>Short news.</p></article>")],
    [("-", f'{_NAV}<form><label>Search</label><p>Type a word and press enter to look it up in all of our pages</p></form><div class="sidebar"><p>{_LONG}</p></div>'),
     ("+", f'<article class="post has-sidebar"><h1>Long read</h1><p>Yes.</p><p>{_LONG * 5}</p>'), ("-", '<div class="related"><a href="/r">Read this too</a><p>One more idea for you</p></div>'), ("+", f"<p>{_LONG}</p><p>No.</p></article>"),
     ("-", f'<section id="comments"><article class="comment"><p>{_LONG}</p></article><p>I agree.</p></section>')],
    [("-", _NAV), ("+", f'<article><header><h1>With a header</h1><p>By a writer</p></header><p>{_LONG * 2}</p><section id="related-work"><h2>Other work</h2><p>{_LONG}</p><p>Few words.</p></section><h2 id="search">How to find it</h2>'),
     ("-", '<div class="related"><p><a href="/1">One more story</a></p><ul><li><a href="/2">Another one</a></li></ul></div>'), ("+", "<p>The end.</p></article>"),
     ("-", f"<div><p>{_LONG}</p><p>I do not think so.</p><p>{_LONG * 3}</p></div>")],
    [("-", f"<div><p>{_LONG * 2}</p></div><p>Yes.</p>"), ("+", f'<main><h1>Heads</h1><p>{_LONG}</p><div class="tags"><p>Some text about tags</p></div><p>{_LONG * 4}</p></main>'), ("-", f"<div>So it is, I think.</div><div>{_LONG * 2}</div><div><a href='/m'>More</a></div>")],
]


def labelled_blocks() -> tuple[np.ndarray, np.ndarray]:
    """Features and labels of the labelled pages' blocks."""
    x, y = [], []
    for page in LABELLED:
        found = blocks("".join(piece for _, piece in page))
        labels = [label == "+" for label, piece in page for _ in blocks(piece)]
        if len(labels) != len(found):
            raise ValueError("a labelled piece does not end with its last block")
        x.append(features(found))
        y.extend(labels)
    return np.vstack(x), np.array(y)


def train() -> DecisionTree:
    return DecisionTree.grow(*labelled_blocks())


def main_text(page: str, tree: DecisionTree) -> str:
    found = blocks(page)
    if not found:
        return ""
    return "\n\n".join(b.text for b, share in zip(found, tree.predict(features(found)), strict=True) if share >= 0.5)


def extract(pages: DataFrame, tree: DecisionTree, html_column: str = "html", name: str = "text") -> DataFrame:
    """`pages` with the main text in place of the HTML column; `name` replaces a column of that name."""
    fields = [f for f in pages.schema.fields if f.name not in (html_column, name)]
    schema = T.StructType([*fields, T.StructField(name, T.StringType())])

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(page or "", tree) for page in batch.column(len(fields)).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(texts, pa.string())], names=schema.names)

    return pages.select(*(f.name for f in fields), html_column).mapInArrow(read, schema)
