"""Main text of a web page: flat text blocks classified by a decision tree.

A page is cut into text blocks at block-level tags. Each block has its word
count, link density and number of links, those of its neighbours in the same
element, the plain words before it in its article, and what the elements
around it say (an article or main element; a menu, header, footer, sidebar,
notice, advert, form or comment section by tag, role, class or id; an article
or main element inside such a part is none, unless it is one itself). A
decision tree of limited depth, grown from the blocks of the small labelled
pages below, decides which blocks are main text. Pages are independent rows,
so the work is one pass without a shuffle.

Defined results: a null or empty page, and one without a main block, has an
empty text. Broken markup is read on: a tag that is never closed ends with
the page, an unfinished tag at the end is dropped. Repeated rows are
extracted alike; pages of any length are read whole; extra columns are
ignored.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from functools import cache
from html import unescape

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rivulet.llm.common import map_texts

# Fixed values of HTML: elements that begin a new block, have no text of
# their own, have no end tag, or hold no page text.
BLOCK_TAGS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt "
    "fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend "
    "li main menu nav ol optgroup option p pre search section summary table tbody td tfoot th "
    "thead title tr ul".split())
HOLDERS = frozenset(
    "address article aside blockquote button details dialog dir div dl fieldset figure footer "
    "form head header iframe main menu nav noscript object ol search section select svg table "
    "template ul".split())
RAW = frozenset("script style textarea xmp noembed noframes".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
MAIN_TAGS = frozenset("article main".split())
OTHER_TAGS = frozenset(
    "aside button dialog footer form head header iframe menu nav noscript object search select "
    "svg template".split())
# What pages call their other parts, in class, id or role.
OTHER_NAMES = frozenset(
    "ad ads advert advertisement advertising adsense sponsor sponsored promo promotion banner "
    "menu nav navbar navigation breadcrumb breadcrumbs pagination pager toc "
    "header masthead topbar footer copyright legal contentinfo "
    "sidebar aside complementary related recommended widget share sharing social "
    "cookie cookies consent gdpr notice notification alert popup modal newsletter subscribe "
    "comment comments reply replies disqus respond form search login signup hidden".split())
# Of these, the ones that hold articles which are not the page's own; an article
# or main element inside another of them is the page's own all the same.
HOLD_ARTICLES = frozenset(
    "ad ads advert advertisement sponsor sponsored comment comments reply replies disqus respond "
    "related recommended hidden".split())
# A name that begins or ends so tells of the layout or a state (has-sidebar,
# comments-open), not of what the element is.
LAYOUT = frozenset(
    "has with without no free overflow layout open closed enabled disabled allowed on off".split())
# Names of parts that are also topics: of a text, where the name ends so (legal-news).
TOPICS = frozenset(
    "advertising alert copyright form legal notice notification search sponsor".split())
TEXTS = frozenset("article articles blog content news page post posts stories story text".split())

_TOKEN = re.compile(
    r"""<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:"[^"]*"|'[^']*'|[^'">])*)(>|\Z)"""
    r"""|<(/?)([a-zA-Z][^\s/>]*)([^>]*)(?:>|\Z)""", re.S)
_NAMES = re.compile(r"""\b(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
_HIDDEN = re.compile(r"""(?:^|\s)hidden(?:\s|=|$)|display\s*:\s*none|aria-hidden\s*=\s*["']?true""",
                     re.I)
_PART = re.compile(r"[a-z0-9]+")

# What an element says of itself and what is in it. WEAK: by a name that is not
# the head of its compound (menu-page). Articles inside a WEAK or SOFT part are
# the page's own, main elements also inside a FIRM one.
NOT, WEAK, SOFT, FIRM, HIDDEN = range(5)
INERT_TAGS = frozenset("dialog iframe noscript object select svg template".split())


@dataclass
class Block:
    text: str
    words: int
    linked: int
    links: int
    within: int  # the element it is in
    main: int  # the article or main element it is in; 0: none
    other: int  # NOT to FIRM
    heading: bool


def _named(attributes: str) -> int:
    """How far class, id and role name the element as another part."""
    found = NOT
    for name in " ".join(a or b or c for a, b, c in _NAMES.findall(attributes)).lower().split():
        parts = _PART.findall(name)
        of = OTHER_NAMES.intersection(parts)
        if not of or len(parts) > 1 and (parts[0] in LAYOUT or parts[-1] in LAYOUT):
            continue
        if len(parts) > 1 and parts[-1] in TEXTS:
            of = of - TOPICS
        if not HOLD_ARTICLES.isdisjoint(of):
            found = FIRM
        elif of:
            found = max(found, SOFT if parts[-1] in of else WEAK)
    return found


def _other(tag: str, attributes: str) -> int:
    """How far an element is another part than main text: NOT to HIDDEN."""
    if tag in INERT_TAGS:
        return HIDDEN
    named = NOT
    if attributes and tag not in ("html", "body", "main"):
        if _HIDDEN.search(attributes):
            return HIDDEN
        named = _named(attributes)
    if tag in OTHER_TAGS:
        return max(named, SOFT if tag == "form" else FIRM)
    return named


def _inside(around: int, tag: str, own: int) -> int:
    """What holds inside an element, by what holds around it and its own."""
    if own == NOT and (tag == "article" and around <= SOFT or tag == "main" and around < HIDDEN):
        return NOT
    return max(around, own)


@dataclass
class Open:
    """An open holder: its tag and number, the article it is in, how far it is
    another part, and how far a heading in it is."""
    tag: str = ""
    number: int = 0
    main: int = 0
    other: int = NOT
    heading: int = NOT


def text_blocks(html: str) -> list[Block]:
    """The text blocks of a page in page order, other parts included."""
    out: list[Block] = []
    page, numbers = Open(), 0
    stack: list[Open] = []
    pieces: list[str] = []
    linked: list[str] = []
    links = 0
    in_link = heading = False
    own_other = NOT

    def close_block() -> None:
        nonlocal pieces, linked, links
        if pieces:
            words = unescape("".join(pieces)).split()
            if words:
                at = stack[-1] if stack else page
                other = max(at.heading if heading else at.other, own_other)
                out.append(Block(" ".join(words), len(words), len(unescape(" ".join(linked)).split()),
                                 links, at.number, at.main, min(other, FIRM), heading))
        pieces, linked, links = [], [], int(in_link)

    def opened(tag: str, attributes: str) -> Open:
        nonlocal numbers
        numbers += 1
        around, own = stack[-1] if stack else page, _other(tag, attributes)
        other = _inside(around.other, tag, own)
        # The header of an article holds the article's own headline.
        headline = tag == "header" and around.main and own == FIRM and _named(attributes) == NOT
        return Open(tag, numbers, numbers if tag in MAIN_TAGS else around.main, other,
                    around.heading if headline else _inside(around.heading, tag, own))

    def take(text: str) -> None:
        pieces.append(text)
        if in_link:
            linked.append(text)

    at, end = 0, len(html)
    while at < end:
        m = _TOKEN.search(html, at)
        if m is None:
            take(html[at:])
            break
        if m.start() > at:
            take(html[at:m.start()])
        at = m.end()
        tag = (m[2] or m[6] or "").lower()
        if not tag:
            continue
        closing, attributes = (m[1] or m[5]) == "/", m[3] or m[7] or ""
        if tag in RAW:
            if not closing:
                stop = re.compile(rf"</{re.escape(tag)}\b[^>]*(?:>|\Z)", re.I).search(html, at)
                at = stop.end() if stop else end
        elif tag == "a":
            in_link = not closing
            links += in_link
        elif tag == "br":
            take(" ")
        elif tag in BLOCK_TAGS or tag in HOLDERS:
            close_block()
            own_other = NOT
            if tag in HOLDERS:
                heading = False
                if not closing:
                    stack.append(opened(tag, attributes))
                elif any(o.tag == tag for o in stack):
                    while stack.pop().tag != tag:
                        pass
            else:
                if tag == "body":
                    stack.clear()  # the head is over, closed or not
                own_other = NOT if closing else _other(tag, attributes)
                heading = not closing and tag in HEADINGS
            in_link = in_link and tag not in HOLDERS
            links = int(in_link)
    close_block()
    return out


FEATURES = ("words", "link_density", "links", "words_before", "links_before", "words_after",
            "links_after", "text_before", "in_main", "in_other", "heading")


def features(blocks: list[Block]) -> list[tuple]:
    """The ``FEATURES`` of each block. Only blocks of the same element are
    neighbours: a menu is none of the article that follows it."""
    density = [b.linked / b.words for b in blocks]
    plain: dict[int, int] = {}  # unlinked words so far, by article
    out = []
    for k, b in enumerate(blocks):
        near = []
        for n in (k - 1, k + 1):
            beside = 0 <= n < len(blocks) and blocks[n].within == b.within
            near += [blocks[n].words, density[n]] if beside else [0, 0.0]
        out.append((b.words, density[k], b.links, *near, plain.get(b.main, 0), b.main > 0, b.other,
                    b.heading))
        if b.other < FIRM:
            plain[b.main] = plain.get(b.main, 0) + b.words - b.linked
    return out


# Labelled pages, of many kinds of layout: what is written in capitals is main
# text. {0} to {2} stand for texts, in lower case outside main text, of the
# lengths below; a menu is put in for MENU, in one of the ways below.
MENUS = (
    "<nav><a href=/>home</a> <a href=/b>about us</a></nav>",
    "<nav><ul><li><a href=/>home</a></li><li><a href=/b>about</a></li><li><a href=/c>shop</a></li></ul></nav>",
    "<ul><li><a href=/>home</a></li><li><a href=/b>about us</a></li><li><a href=/c>news</a></li></ul>",
    "<div><a href=/>home</a> <a href=/b>about</a> <a href=/c>contact us</a></div>",
    "<div><div><a href=/>home</a></div><div><a href=/b>about</a></div></div>",
    "<table><tr><td><a href=/>home</a></td><td><a href=/b>about</a></td></tr></table>",
    "<p><a href=/>home</a> | <a href=/b>about</a> | <a href=/c>contact</a></p>",
    "<ul><li>home</li><li><a href=/b>about us</a></li><li><a href=/c>news</a></li></ul>",
    "",
)
LAYOUTS = (
    "MENU<article><h1>HEAD LINE</h1><p>{0}</p><p>{1}</p></article><footer>small print</footer>",
    "MENU<article><p>{0}</p></article>",
    "MENU<article><p>{0}</p><p>YES.</p><p>{1}</p></article>",
    "MENU<main><p>{0}</p></main><footer>&copy; us, all rights</footer>",
    "MENU<main><div><p>{0}</p></div><div><p>{1}</p></div></main>",
    "<article>MENU<p>{0}</p><p>{1}</p></article>",
    "<main>MENU<h2>HEAD</h2><p>{0}</p></main>",
    "<main>MENU<div><p>{0}</p></div></main>",
    "MENU<div><p>{0}</p></div>",
    "MENU<div><h1>HEAD LINE HERE</h1><p>{0}</p><p>{1}</p></div>",
    "MENU<p>{0}</p>",
    "MENU<p>{0}</p><p>{1}</p>MENU",
    "MENU<div><p>{0}</p><h3>A HEAD</h3><p>{1}</p></div><div class=footer>{2} and so on</div>",
    "MENU<table><tr><td><p>{0}</p></td></tr></table>",
    "<table><tr><td>MENU</td><td><p>{0}</p><p>{1}</p></td></tr></table>",
    "MENU<article><h1><a href=/x>LINKED HEAD LINE</a></h1><p>{0}</p></article>",
    "MENU<div><h2><a href=/x>LINKED HEAD LINE</a></h2><p>{0}</p></div>",
    "<article><header><h1>HEAD LINE</h1><p>by someone</p></header><p>{0}</p></article>",
    "<article><p>{0}</p><p><a href=/x>LINKED WORDS</a></p><p>{1}</p></article>",
    "<article><p>{0}</p><ul><li><a href=/x>LINKED</a></li><li><a href=/y>WORDS</a></li></ul></article>",
    "<article><p>SEE <a href=/x>THIS AND</a> THAT</p><p>{0}</p></article>",
    "<article><p>{0}</p><div class=share><a href=/x>share</a> <a href=/y>print</a></div><p>{1}</p></article>",
    "<article><p>{0}</p><div class=advert>{2}</div><p>{1}</p></article>",
    "<article><p>{0}</p><div class=newsletter>{2}</div></article>",
    "<article><p>{0}</p><form><p>your name</p></form><div id=comments><p>{2}</p><p>{2}</p></div></article>",
    "<div class=sidebar><p>{2}</p></div><article><p>{0}</p></article>",
    "<aside><h3>also</h3><p>{2}</p><p>{2}</p></aside><div><p>{0}</p></div>",
    "<header><p>{2}</p></header><main><p>{0}</p></main>",
    "<div class=cookie-notice><p>{2}</p></div><div><p>{0}</p></div>",
    "<div class=widget><p>{2}</p></div><div><p>{0}</p><p>{1}</p></div>",
    "<div class=menu><p>{2}</p><p>choose</p></div><article><p>{0}</p></article>",
    "<div class=page-header><p>some words</p></div><div class=content><p>{0}</p></div>",
)
LENGTHS = ((8, 10, 5), (14, 9, 12), (30, 45, 25), (90, 60, 40), (400, 120, 60), (800, 500, 110))
# Long plain text in a part that only its name makes another one is main text;
# how long, depends on the name. Not beside a longer text of that kind.
NAMED = (
    ("<div class=menu-page><p>{0}</p><p>{1}</p></div>", 25), ("<div id=toc-content><p>{0}</p></div>", 25),
    ("<div class=social-studies><p>{0}</p><p>{1}</p></div>", 25),
    ("<article><div class=form-group><p>{0}</p><p>{1}</p></div></article>", 25),
    ("<div class=widget><p>{0}</p><p>{1}</p></div>", 130), ("<div class=sidebar><p>{0}</p></div>", 600),
    ("<article><div class=menu><p>{0}</p></div></article>", 700),
    ("<div class=comments><p>{0}</p><p>{1}</p></div>", 10 ** 9),
    ("<aside><p>{0}</p><p>{1}</p></aside>", 10 ** 9), ("<footer><p>{0}</p></footer>", 10 ** 9),
    ("<header><h2>{0}</h2><p>{1}</p></header>", 10 ** 9),
    ("<article><div class=replies><p>{0}</p><p>{1}</p></div></article>", 10 ** 9),
    ("<main><nav><p>{0}</p><p>{1}</p></nav></main>", 10 ** 9),
    ("<div class=advert><div><p>{0}</p></div><div><p>{1}</p></div></div>", 10 ** 9),
)
NAMED_LENGTHS = (*LENGTHS, (5, 4, 0), (18, 20, 0), (60, 70, 0), (150, 160, 0), (650, 700, 0), (900, 850, 0))
DEPTH, LEAF = 9, 2


def labelled() -> np.ndarray:
    """The blocks of the labelled pages as ``FEATURES`` and 1 for main text."""

    def text(n: int, main: bool) -> str:
        return " ".join(["WORD" if main else "word"] * n)

    pages = [layout.replace("MENU", menu).format(text(a, True), text(b, True), text(c, False))
             for layout in LAYOUTS for menu in (MENUS if "MENU" in layout else ("",))
             for a, b, c in LENGTHS]
    pages += [layout.format(*[text(n, n >= least) for n in (a, b)])
              for layout, least in NAMED for a, b, _ in NAMED_LENGTHS]
    rows = set()
    for page in pages:
        blocks = text_blocks(page)
        rows |= {(*map(float, x), float(b.text.isupper())) for b, x in zip(blocks, features(blocks))}
    return np.array(sorted(rows))


def grow(rows: np.ndarray, depth: int = DEPTH, leaf: int = LEAF):
    """A decision tree (feature, threshold, at most, above), or a leaf's label,
    grown by Gini impurity."""
    y = rows[:, -1]
    if not depth or len(set(y)) == 1:
        return int(y.mean() >= 0.5)
    best = None
    for f in range(rows.shape[1] - 1):
        order = np.argsort(rows[:, f], kind="stable")
        x, ones = rows[order, f], np.cumsum(y[order])
        n = np.arange(1, len(x))
        at = np.flatnonzero((x[1:] > x[:-1]) & (n >= leaf) & (len(x) - n >= leaf))
        if not len(at):
            continue
        low, n_low = ones[at], at + 1.0
        high, n_high = ones[-1] - low, len(x) - n_low
        impurity = low * (1 - low / n_low) + high * (1 - high / n_high)
        k = int(np.argmin(impurity))
        if best is None or impurity[k] < best[0] - 1e-12:
            best = float(impurity[k]), f, float(x[at[k]] + x[at[k] + 1]) / 2
    if best is None:
        return int(y.mean() >= 0.5)
    _, f, t = best
    low = rows[:, f] <= t
    return f, t, grow(rows[low], depth - 1, leaf), grow(rows[~low], depth - 1, leaf)


@cache
def main_text_tree():
    return grow(labelled())


def depth_of(tree) -> int:
    return 0 if isinstance(tree, int) else 1 + max(depth_of(tree[2]), depth_of(tree[3]))


def is_main(tree, x: tuple) -> bool:
    while not isinstance(tree, int):
        f, t, low, high = tree
        tree = low if x[f] <= t else high
    return tree == 1


def main_text(html: str, tree) -> str:
    blocks = text_blocks(html)
    return "\n".join(b.text for b, x in zip(blocks, features(blocks)) if is_main(tree, x))


def html_text(pages: DataFrame, html: str = "html", keep: tuple[str, ...] = ("page_id", "url")
              ) -> DataFrame:
    """``keep`` columns of every row of ``pages``, ``text`` and ``n_chars``."""
    tree = main_text_tree()
    d = pages.select(*keep, F.col(html).alias("__html"))
    schema = ", ".join([f"`{c}` {t}" for c, t in d.dtypes if c != "__html"]
                       + ["text string", "n_chars bigint"])

    def make():
        def block(batch: pa.RecordBatch, texts: list[str]) -> pa.RecordBatch:
            made = [main_text(t, tree) for t in texts]
            return pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], pa.array(made, pa.string()),
                 pa.array([len(t) for t in made], pa.int64())],
                [*batch.schema.names[:-1], "text", "n_chars"])
        return block

    return map_texts(d, "__html", schema, make)
