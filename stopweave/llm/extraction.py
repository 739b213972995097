"""Main text of web pages: a linear-chain conditional random field over the blocks of a page.

A page's blocks are the runs of text between the borders of block elements, in page order.
Each block has features of the elements around it (tags, words of class, id and
role) and of its text; neighbouring labels depend on each other, otherwise inside one part
of the page than across two. The field is trained on pages whose main
text is marked, and decoded by Viterbi.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import lru_cache
from random import Random

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stopweave.llm.common import batches_of
from stopweave.session import stored

#: An element with this attribute marks main text, up to an element that has it with ``0``.
MARK = "data-main"
#: Pages to learn from, and code points of such a page, at most.
LEARNED_PAGES, LEARNED_CHARS = 200, 65_536
#: Pages laid out anew from their texts, about.
LAYOUTS = 800
#: Steps and first step width of the training, and the weight of its penalty.
STEPS, RATE, PENALTY = 200, 0.3, 0.0001

BLOCK_TAGS = frozenset(
    """address article aside blockquote body button caption center dd details dialog dir div dl dt fieldset
    figcaption figure footer form frameset h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav
    ol optgroup option p pre search section select summary table tbody td textarea tfoot th thead tr ul""".split()
)
VOID_TAGS = frozenset("area base br col embed frame hr img input link meta param source track wbr".split())
#: Elements whose content is no text of the page, up to their end tag.
RAW_TAGS = frozenset("script style title textarea xmp iframe noembed noframes noscript template svg".split())
#: What a start tag ends, if it is open within the innermost of the scopes.
ENDS = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
SCOPES = {"li": {"ul", "ol", "menu", "dir"}, "dt": {"dl"}, "dd": {"dl"}, "option": {"select"}}
TABLE = {"table"}

_TOKEN = re.compile(
    r"""<!--(?:>|->|.*?(?:--!?>|\Z))            # a comment, to the end if it is not closed
      | <[!?][^>]*(?:>|\Z)                      # a declaration
      | <(?P<end>/?)(?P<name>[a-zA-Z][^\s/>]*)(?P<rest>(?:[^>"']++|"[^"]*+"|'[^']*+')*+)>
      | <(?P<end2>/?)(?P<name2>[a-zA-Z][^\s/>]*)(?P<rest2>[^>]*)(?:>|\Z)   # quotes not closed""",
    re.S | re.X,
)
_ATTRIBUTE = re.compile(r"""([^\s=/"'>]+)\s*=\s*(?:"([^"]*)"?|'([^']*)'?|([^\s>]+))|\b(hidden)\b""")
_WORDS = re.compile(r"[A-Z]?[a-z]{2,}|[A-Z]{2,}|\d+")
_RAW_ENDS = {tag: re.compile(rf"</{tag}(?=[\s/>]|\Z)", re.I) for tag in RAW_TAGS}

#: Features that the elements around a block give it, at most; far more than any real page has.
_MOST_FEATURES = 256
#: Block elements that hold a piece of text rather than a part of the page.
_PIECES = frozenset(
    """p h1 h2 h3 h4 h5 h6 li ul ol dl dt dd pre blockquote table caption thead tbody tfoot tr td th figure figcaption
    option legend summary button""".split()
)
_SECTIONS = frozenset("article aside dialog figure footer form header main nav section table".split())


@dataclass(slots=True)
class Element:
    tag: str
    features: frozenset[str]
    #: Features that only the innermost element of their kind gives.
    near: dict[str, tuple[str, ...]]
    marked: bool


@dataclass(slots=True)
class Block:
    text: str
    features: frozenset[str]
    near: tuple[str, ...]
    parent: int
    linked: int
    marked: bool


def _names(rest: str) -> tuple[str, ...]:
    """The words of class, id, role and item property, and whether the element is hidden."""
    found = []
    for name, a, b, c, hidden in _ATTRIBUTE.findall(rest):
        name, value = name.lower(), a or b or c
        if name in ("class", "id", "role", "itemprop", "aria-label"):
            found += [w.lower() for w in _WORDS.findall(value[:512]) if not w.isdigit()]
        elif hidden or (name == "style" and "none" in value) or (name == "aria-hidden" and value == "true"):
            found.append("hidden")
    return tuple(dict.fromkeys(found))


@lru_cache(1 << 14)
def _own(tag: str, rest: str) -> tuple[frozenset[str], dict[str, tuple[str, ...]]]:
    """What an element adds for all inside it, and what it replaces of the elements around it."""
    words = _names(rest) if rest else ()
    shared = {f"t:{tag}", *(f"c:{w}" for w in words)}
    # Beginnings and ends of words stand for words never seen: comment-list, subnav.
    shared |= {f"b:{w[:4]}" for w in words if len(w) > 4} | {f"e:{w[-3:]}" for w in words if len(w) > 4}
    near = {"n": (f"n:{tag}",)} if tag in BLOCK_TAGS else {}
    if tag in _SECTIONS:
        near["s"] = (f"s:{tag}",)
    if words:
        near["k"] = tuple(f"k:{w}" for w in words) + tuple(f"j:{w[:4]}" for w in words if len(w) > 4)
    return frozenset(shared), near


def _element(parent: Element | None, tag: str, rest: str) -> Element:
    shared, near = _own(tag, rest if len(rest) < 2048 else rest[:2048])
    around = parent.features if parent else frozenset()
    if not shared <= around and len(around) < _MOST_FEATURES:
        around |= shared
    marked = parent.marked if parent else False
    if MARK in rest:
        marked = f'{MARK}="0"' not in rest
    held = parent.near if parent else {}
    return Element(tag, around, {**held, **near} if near else held, marked)


@dataclass
class _Page:
    """The open elements while a page is read, and the blocks so far."""

    open: list[Element] = field(default_factory=list)
    counts: dict[str, int] = field(default_factory=dict)
    blocks: list[Block] = field(default_factory=list)
    parts: list[str] = field(default_factory=list)
    linked: int = 0
    parent: int = 0
    #: Numbers of the open parts of the page, the innermost last.
    numbers: list[int] = field(default_factory=lambda: [0])

    def text(self, piece: str) -> None:
        if "&" in piece:
            piece = html.unescape(piece)
        self.parts.append(piece)
        if self.counts.get("a"):
            self.linked += len(piece.strip())

    def flush(self) -> None:
        if self.parts:
            text = " ".join("".join(self.parts).split())
            if text:
                top = self.open[-1] if self.open else _element(None, "body", "")
                near = tuple(x for key in ("n", "s", "k") for x in top.near.get(key, ()))
                self.blocks.append(Block(text, top.features, near, self.numbers[-1], self.linked, top.marked))
            self.parts, self.linked = [], 0

    def push(self, tag: str, rest: str) -> None:
        self.open.append(_element(self.open[-1] if self.open else None, tag, rest))
        self.counts[tag] = self.counts.get(tag, 0) + 1
        if tag in BLOCK_TAGS:
            self.parent += tag not in _PIECES
            self.numbers.append(self.numbers[-1] if tag in _PIECES else self.parent)

    def pop(self) -> str:
        tag = self.open.pop().tag
        self.counts[tag] -= 1
        if tag in BLOCK_TAGS:
            self.numbers.pop()
        return tag

    def start(self, tag: str, rest: str) -> None:
        if tag == "br":
            self.parts.append("\n")
            return
        if tag in BLOCK_TAGS:
            self.flush()
            if self.counts.get("p"):
                self.end("p", TABLE)
            ends, scopes = ENDS.get(tag), SCOPES.get(tag, TABLE)
            if ends and any(self.counts.get(x) for x in ends):
                self.end_any(ends, scopes)
        elif tag == "a" and self.counts.get("a"):
            self.end("a", TABLE)
        if tag not in VOID_TAGS:
            self.push(tag, rest)

    def end(self, tag: str, scopes=frozenset()) -> None:
        if self.counts.get(tag):
            self.end_any({tag}, scopes)

    def end_any(self, tags: set[str], scopes) -> None:
        """Closes the innermost of ``tags`` and all inside it, unless a scope begins in between."""
        for at in range(len(self.open) - 1, -1, -1):
            if self.open[at].tag in tags:
                if any(x.tag in BLOCK_TAGS for x in self.open[at:]):
                    self.flush()
                # The innermost link or emphasis ends alone: blocks inside stay open.
                if self.open[at].tag not in BLOCK_TAGS and any(x.tag in BLOCK_TAGS for x in self.open[at + 1 :]):
                    self.counts[self.open[at].tag] -= 1
                    del self.open[at]
                else:
                    while len(self.open) > at:
                        self.pop()
                return
            if self.open[at].tag in scopes:
                return


def blocks_of(page: str) -> list[Block]:
    """The blocks of text of a page; character references decoded, white space one space."""
    read, at, size = _Page(), 0, len(page)
    while at < size:
        found = _TOKEN.search(page, at)
        if found is None:
            read.text(page[at:])
            break
        if found.start() > at:
            read.text(page[at : found.start()])
        at = found.end()
        name = found["name"] or found["name2"]
        if name is None:
            continue
        tag, rest = name.lower(), found["rest"] or found["rest2"] or ""
        if found["end"] or found["end2"]:
            if tag == "br":
                read.parts.append("\n")
            elif tag == "p" and not read.counts.get("p"):
                read.flush()
            else:
                read.end(tag, frozenset() if tag in ("body", "html", "table", "tr", "td", "th", "tbody", "thead", "tfoot") else TABLE)
        elif tag in RAW_TAGS:
            if not rest.endswith("/") or tag != "svg":
                end = _RAW_ENDS[tag].search(page, at)
                at = end.start() if end else size
        else:
            read.start(tag, rest)
    read.flush()
    return read.blocks


def _text_features(block: Block, place: int, count: int) -> list[str]:
    text = block.text
    words = text.count(" ") + 1
    return [
        f"w:{words.bit_length()}", f"l:{4 * min(block.linked, len(text)) // len(text)}",
        f"p:{'.' if text[-1] in '.!?…:;»”’\")' else 'x'}", f"v:{min(text.count(', '), 3)}",
        f"u:{'C' if text[0].isupper() else 'x'}", f"m:{'s' if '©' in text or '|' in text or '·' in text else 'x'}",
        f"o:{'first' if place == 0 else 'last' if place == count - 1 else 'x'}",
    ]


# --- training -----------------------------------------------------------------------


@dataclass(frozen=True)
class Extractor:
    """Weights of a trained field: for main text against all else, and for neighbouring labels."""

    weights: dict[str, float]
    #: By same part of the page or not, label before, label now.
    following: np.ndarray
    #: What a page begins with.
    first: np.ndarray


_FEATURES = "page bigint, place int, features array<string>, same boolean, marked boolean"


def _learnable(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = []
        for page, text in zip(batch.column("page").to_pylist(), batch.column("html").to_pylist(), strict=True):
            blocks = blocks_of(text)
            for k, b in enumerate(blocks):
                features = sorted({*b.features, *b.near, *_text_features(b, k, len(blocks))})
                rows.append((page, k, features, k > 0 and b.parent == blocks[k - 1].parent, b.marked))
        columns = list(zip(*rows, strict=True)) or [(), (), (), (), ()]
        types = (pa.int64(), pa.int32(), pa.list_(pa.string()), pa.bool_(), pa.bool_())
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=["page", "place", "features", "same", "marked"])


class _Chains:
    """Pages side by side, the longest first: forward and backward sums of all at once."""

    def __init__(self, page: np.ndarray, place: np.ndarray, same: np.ndarray, label: np.ndarray):
        _, row, lengths = np.unique(page, return_inverse=True, return_counts=True)
        order = np.argsort(-lengths, kind="stable")
        rank = np.empty(len(order), int)
        rank[order] = np.arange(len(order))
        self.at = rank[row], place
        self.last = np.arange(len(order)), lengths[order] - 1
        self.shape = len(lengths), int(lengths.max())
        #: How many pages have a block at each place.
        self.reach = np.bincount(place)
        self.same, self.label = np.zeros(self.shape, int), np.zeros(self.shape, int)
        self.same[self.at], self.label[self.at] = same, label
        later = place > 0
        self.now = self.at[0][later], place[later]
        self.before = self.at[0][later], place[later] - 1
        self.inside = self.same[self.now] == 1
        pair = self.same[self.now] * 4 + self.label[self.before] * 2 + self.label[self.now]
        self.observed = np.bincount(pair, minlength=8).reshape(2, 2, 2)

    def gradients(self, main: np.ndarray, following: np.ndarray, first: np.ndarray):
        """Observed less expected: for main text at each block, neighbours' labels, first labels."""
        pages, length = self.shape
        unary = np.zeros((pages, length, 2))
        unary[*self.at, 1] = main
        forward, backward = np.zeros_like(unary), np.zeros_like(unary)
        forward[:, 0] = unary[:, 0] + first
        for t in range(1, length):
            n = self.reach[t]
            step = forward[:n, t - 1, :, None] + following[self.same[:n, t]]
            forward[:n, t] = np.logaddexp(step[:, 0], step[:, 1]) + unary[:n, t]
        for t in range(length - 2, -1, -1):
            n = self.reach[t + 1]
            step = following[self.same[:n, t + 1]] + (unary[:n, t + 1] + backward[:n, t + 1])[:, None, :]
            backward[:n, t] = np.logaddexp(step[..., 0], step[..., 1])
        total = np.logaddexp(*forward[self.last].T)
        chance = np.exp(forward[self.at] + backward[self.at] - total[self.at[0], None])
        to_main = self.label[self.at] - chance[:, 1]
        begins = np.exp(forward[:, 0] + backward[:, 0] - total[:, None])
        to_first = np.bincount(self.label[:, 0], minlength=2) - begins.sum(axis=0)
        ahead = unary[self.now] + backward[self.now] - total[self.now[0], None]
        joint = np.exp(forward[self.before][:, :, None] + following[self.same[self.now]] + ahead[:, None, :])
        expected = np.stack([joint[~self.inside].sum(axis=0), joint[self.inside].sum(axis=0)])
        return to_main, self.observed - expected, to_first


def fitted(page, place, features: pa.ListArray, same, label, steps: int = STEPS) -> Extractor:
    """The field of greatest penalised likelihood, by adaptive steps over all given pages."""
    chains = _Chains(np.asarray(page), np.asarray(place), np.asarray(same, int), np.asarray(label, int))
    coded = features.flatten().dictionary_encode()
    names, columns = coded.dictionary.to_pylist(), coded.indices.to_numpy()
    rows = np.repeat(np.arange(len(features)), features.value_lengths().to_numpy())
    sizes = len(names), 8, 2
    held = np.zeros(sum(sizes))
    mean, square = np.zeros_like(held), np.zeros_like(held)
    ends = np.cumsum(sizes)
    for step in range(1, steps + 1):
        weights, following, first = held[: ends[0]], held[ends[0] : ends[1]].reshape(2, 2, 2), held[ends[1] :]
        main = np.bincount(rows, weights[columns], minlength=len(features))
        to_main, to_following, to_first = chains.gradients(main, following, first)
        slope = np.concatenate([np.bincount(columns, to_main[rows], minlength=len(names)), to_following.ravel(), to_first])
        slope = slope / chains.shape[0] - PENALTY * held
        mean, square = 0.9 * mean + 0.1 * slope, 0.99 * square + 0.01 * slope**2
        held = held + RATE * (mean / (1 - 0.9**step)) / (np.sqrt(square / (1 - 0.99**step)) + 1e-8)
    weights = dict(zip(names, held[: ends[0]].tolist(), strict=True))
    return Extractor(weights, held[ends[0] : ends[1]].reshape(2, 2, 2), held[ends[1] :])


def train_extractor(annotated: DataFrame, steps: int = STEPS) -> Extractor:
    """The field learned from ``annotated(page, html)``, whose main text lies in marked elements.

    The table is a bounded sample: its features are fetched, its texts are not. Without any
    block, nothing is main text.
    """
    found = annotated.mapInArrow(_learnable, _FEATURES).toArrow()
    if not found.num_rows:
        return Extractor({}, np.zeros((2, 2, 2)), np.array([1.0, 0.0]))
    found = found.sort_by([("page", "ascending"), ("place", "ascending")])
    page, place, same, marked = (found.column(c).to_numpy() for c in ("page", "place", "same", "marked"))
    return fitted(page, place, found.column("features").combine_chunks(), same, marked, steps)


# --- labelled pages -----------------------------------------------------------------

#: Markup that pages commonly have around the parts of a page.
MAIN_SHELLS = (
    "<article>", "<article>", "<article>", "<article>", "<main>", '<div class="post-content">', '<div id="content">', '<div class="entry-content">',
    '<section class="story-body">', '<div class="article-body">', '<div itemprop="articleBody">', '<article class="post hentry">',
    '<div class="main-text">', '<div role="main">', '<div class="blog-post">', '<section id="article">', '<div class="page-body text">', "<div>",
)
PAGE_SHELLS = ("", "", '<div id="wrapper">', '<div class="container">', '<div class="page site">', '<div class="layout row">')
PARAGRAPHS = ("<p>", "<p>", "<p>", '<p class="lead">', '<p class="paragraph">', '<div class="text">', '<p class="intro">', "<blockquote>")
OTHER_PARTS = {
    "menu": ("<nav>", '<nav class="main-nav">', '<ul class="menu">', '<div class="navbar">', '<div id="navigation">', '<div class="breadcrumbs">', '<div role="navigation">', '<div class="nav-links tabs">', '<div class="pagination">', "<menu>"),
    "header": ("<header>", '<header class="site-header">', '<div class="header">', '<div id="masthead">', '<div class="top-bar">', '<div class="logo branding">', '<div role="banner">', '<div class="page-header">'),
    "footer": ("<footer>", '<footer class="site-footer">', '<div class="footer">', '<div id="colophon">', '<div class="copyright">', '<div role="contentinfo">', '<div class="legal bottom">'),
    "sidebar": ("<aside>", '<aside class="sidebar">', '<div class="sidebar">', '<div id="secondary" class="widget-area">', '<div class="widget">', '<div class="related-posts">', '<div class="recommended">', '<div class="popular trending">', '<div class="right-rail">', '<div class="side-column">', '<div role="complementary">', '<div class="author-bio">'),
    "notice": ('<div class="cookie-notice">', '<div id="cookie-banner">', '<div class="consent gdpr">', '<div class="alert notice">', '<div class="newsletter-signup">', '<div class="modal popup">', '<div class="subscribe-box">', '<div class="paywall">', '<div class="disclaimer">', "<dialog>", '<div role="alert">', '<div class="notification message">', '<section class="privacy-notice">', '<div class="warning">'),
    "advert": ('<div class="ad">', '<div class="ad">', '<div class="ads">', '<div id="ad">', '<div class="advert">', '<div class="advertisement">', '<div class="sponsored">', '<div class="promo">', '<aside class="ad-slot">', '<div id="google-ads">', '<div class="banner-ad">', '<div class="promotion sponsor">'),
    "form": ("<form>", '<form class="search-form">', '<div class="login-form">', '<form id="contact">', '<div class="search-box">', "<fieldset>"),
    "comments": ('<section class="comments">', '<div id="comments">', '<ol class="comment-list">', '<div class="discussion">', '<div id="disqus_thread">', '<div class="replies">', '<div class="reader-comments">', '<div class="user-comment">', '<section class="responses">', '<section id="comments" class="comments-area">'),
    "sharing": ('<div class="share-buttons">', '<div class="social">', '<ul class="sharing">', '<div class="post-meta">', '<div class="tags">'),
}
#: Words of class that say nothing of what an element holds.
PLAIN_WORDS = "container wrapper inner outer box block section area content item row col module body list group".split()
#: Words of class of whole pages.
PAGE_WORDS = "home blog post page single article main menu sidebar comments left right news story ads content theme site text header nav".split()
#: Prose for the layouts where the given pages have too little.
FILLER = (
    "The river rose overnight, and by morning the lower road was closed.", "Work on the second bridge begins in spring.",
    "Few expected the old mill to reopen, but its wheel turns again, and visitors come every day.", "About us", "Read more",
    "Contact", "Home", "Nobody was hurt.", "It took three years to gather the records, and one more to read them all.",
    "Why does the harvest fail in some valleys and not in others?", "Our best offers of the week, only in this shop!",
    "I have been there twice, and I agree with every word of it.", "All rights reserved", "Terms of use", "Next page",
    "The council meets again in autumn; until then nothing will change.", "Send", "Your name", "Three replies", "Summary",
    "This site stores small files on your device to remember what you chose.", "Sources", "More from this author",
)


def _closing(opening: str) -> str:
    return "".join(f"</{tag}>" for tag in reversed(re.findall(r"<([a-z0-9]+)", opening)))


def _dressed(opening: str, rng: Random) -> str:
    """The start tag with a plain word joined to its class, or as its class."""
    word = rng.choice(PLAIN_WORDS)
    if 'class="' in opening:
        return re.sub('class="([^"]*)"', rng.choice((rf'class="{word} \1"', rf'class="\1-{word}"', rf'class="{word}-\1"')), opening, count=1)
    return opening.replace(">", f' class="{word}">', 1)


def layout(texts: list[str], seed: int) -> str:
    """A page with the given texts in common markup, chosen by ``seed``; its main text is marked."""
    rng = Random(seed)
    texts = [html.escape(x) for x in [*texts, *FILLER]]
    long = [x for x in texts if len(x) > 60]
    short = [" ".join(x.split()[: rng.randrange(1, 6)]) for x in texts]

    def prose() -> str:
        some = long if rng.random() < 0.7 else texts
        return " ".join(rng.choice(some) for _ in range(rng.choice((1, 1, 1, 2, 3))))

    def link() -> str:
        return f'<a href="/{rng.randrange(99)}">{rng.choice(short)}</a>'

    def main_block(heading: bool) -> str:
        if heading:
            tag = rng.choice(("h1", "h1", "h2"))
            return f"<{tag}>{rng.choice(texts)[:80]}</{tag}>"
        kind = rng.random()
        if kind < 0.08:
            return f"<h{(n := rng.randrange(2, 5))}>{rng.choice(short)}</h{n}>"
        if kind < 0.16:
            tag = rng.choice(("ul", "ol"))
            return f"<{tag}>" + "".join(f"<li>{rng.choice((prose, lambda: rng.choice(short)))()}</li>" for _ in range(rng.randrange(1, 5))) + f"</{tag}>"
        if kind < 0.2:
            return f"<table><tr><td>{rng.choice(short)}</td><td>{rng.choice(short)}</td></tr></table>"
        if kind < 0.24:
            return f"<figure><img src='x.png'><figcaption>{rng.choice(short)}</figcaption></figure>"
        if kind < 0.28:
            return f"<pre>{rng.choice(short)}</pre>"
        opening = rng.choice(PARAGRAPHS)
        text = prose()
        if rng.random() < 0.2:
            text = f"{text} {link()} <b>{rng.choice(short)}</b>."
        return f"{opening}{text}{_closing(opening) if rng.random() < 0.85 or opening != '<p>' else ''}"

    def other(kind: str) -> str:
        opening = rng.choice(OTHER_PARTS[kind])
        if rng.random() < 0.5:
            opening = _dressed(opening, rng)
        inner = []
        for _ in range(rng.randrange(1, 6)):
            if kind == "form":
                inner.append(rng.choice((f"<label>{rng.choice(short)}</label><input name='q'>", f"<button>{rng.choice(short)}</button>", f"<select><option>{rng.choice(short)}</option></select>", f"<p>{rng.choice(short)}</p>")))
            elif kind in ("menu", "sharing") or rng.random() < 0.3:
                inner.append(f"<li>{link()}</li>" if rng.random() < 0.7 else f"<p>{link()}</p>")
            elif kind == "comments":
                inner.append(f'<div class="{rng.choice(("comment", "reply", "c"))}"><p>{prose()}</p></div>' if rng.random() < 0.6 else f"<p>{prose()}</p>")
            else:
                inner.append(rng.choice((f"<p>{prose()}</p>", f"<p>{rng.choice(short)}</p>", f"<h3>{rng.choice(short)}</h3>", prose(), f"&copy; {rng.choice(short)} &middot; {rng.choice(short)}")))
        return f'{opening.replace(">", f" {MARK}=\"0\">", 1)}{"".join(inner)}{_closing(opening)}'

    shell, page = rng.choice(MAIN_SHELLS), rng.choice(PAGE_SHELLS)
    if rng.random() < 0.3:
        shell = _dressed(shell, rng)
    body = [main_block(k == 0 and rng.random() < 0.8) for k in range(rng.randrange(1, 14))]
    # Parts that are no main text also stand inside it.
    for kind in ("advert", "comments", "sharing", "notice", "sidebar", "form"):
        if rng.random() < 0.5:
            body.insert(len(body) if kind == "comments" else rng.randrange(1, len(body) + 1), other(kind))
    before = [other(k) for k in ("header", "menu", "notice", "advert", "sidebar", "form") if rng.random() < 0.4]
    after = [other(k) for k in ("sidebar", "advert", "comments", "form", "notice", "menu", "footer") if rng.random() < 0.4]
    marked = shell.replace(">", f" {MARK}>", 1)
    # What is said of the whole page says nothing of its parts.
    about = " ".join(rng.sample(PAGE_WORDS, rng.randrange(4)))
    return f'<html><head><title>{rng.choice(short)}</title></head><body class="{about}">{page}{"".join(before)}{marked}{"".join(body)}{_closing(shell)}{"".join(after)}{_closing(page)}</body></html>'


_ARTICLE = re.compile(r"<article(?=[\s>])", re.I)
_PARTS_INSIDE = re.compile(r"<article(?=[\s>]).*<(?:div|section|aside|nav|form|header|footer|dialog|button|fieldset)(?=[\s>]).*</article", re.I | re.S)


def own_label(page: str) -> str | None:
    """The page with its article marked, if it has just one and that holds no other part of the page."""
    if len(_ARTICLE.findall(page)) != 1 or _PARTS_INSIDE.search(page):
        return None
    return _ARTICLE.sub(f"<article {MARK}", page)


def _annotated(batches: Iterator[pa.RecordBatch], layouts: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for number, page in zip(batch.column("number").to_pylist(), batch.column("html").to_pylist(), strict=True):
            own = [x for x in [own_label(page)] if x is not None]
            texts = [b.text for b in blocks_of(page)]
            pages = own + [layout(texts, number * layouts + k) for k in range(layouts)]
            numbers = [number * (layouts + 1) + k for k in range(len(pages))]
            yield pa.RecordBatch.from_arrays([pa.array(numbers, pa.int64()), pa.array(pages, pa.string())], names=["page", "html"])


def annotated_pages(pages: DataFrame, most: int = LEARNED_PAGES, chars: int = LEARNED_CHARS) -> DataFrame:
    """``(page, html)``: labelled pages made of a bounded sample of ``pages(page_id, html)``.

    At most ``most`` pages of up to ``chars`` code points, chosen by hash. A page with just one
    article element of plain text is labelled by it. Besides, texts of each page are laid out anew,
    in varied common markup that says what is main text; few pages are laid out more often.
    """
    order = F.xxhash64(F.col("page_id").cast("string"), F.col("html").cast("string"))
    short = pages.where(F.length("html").between(1, chars)).select(order.alias("_order"), F.col("html").cast("string").alias("html"))
    # Of very many pages a share that surely holds enough is sorted, chosen by the same hash.
    share = min(1.0, 16 * most / max(pages.count(), 1))
    some = short if share == 1 else short.where(F.col("_order") < F.lit(int((2 * share - 1) * (1 << 63))))
    chosen = stored(some.orderBy("_order", "html").limit(most))
    # One window over all, as there are ``most`` rows at most.
    number = F.row_number().over(Window.orderBy("_order", "html")).cast("bigint")
    rows = chosen.select(number.alias("number"), "html")
    layouts = -(-LAYOUTS // max(chosen.count(), 1))
    return rows.repartition(8, "number").mapInArrow(lambda batches: _annotated(batches, layouts), "page bigint, html string")


# --- decoding -----------------------------------------------------------------------


class _Decoder:
    def __init__(self, model: Extractor):
        self.model = model
        self.around: dict[frozenset[str], float] = {}
        self.following = model.following.tolist()
        self.first = model.first.tolist()

    def score(self, block: Block, place: int, count: int) -> float:
        weights = self.model.weights
        if block.features not in self.around:
            if len(self.around) > 1 << 14:
                self.around.clear()
            self.around[block.features] = sum(weights.get(x, 0.0) for x in block.features)
        own = (*block.near, *_text_features(block, place, count))
        return self.around[block.features] + sum(weights.get(x, 0.0) for x in own)

    def main(self, blocks: list[Block]) -> list[bool]:
        """The likeliest labels of all blocks together; on a tie, not main text."""
        if not blocks:
            return []
        count = len(blocks)
        score = self.score(blocks[0], 0, count)
        no, yes = self.first[0], self.first[1] + score
        origins = []
        for k in range(1, count):
            step = self.following[blocks[k].parent == blocks[k - 1].parent]
            score = self.score(blocks[k], k, count)
            to_no = (no + step[0][0], yes + step[1][0])
            to_yes = (no + step[0][1], yes + step[1][1])
            origins.append((to_no[1] > to_no[0], to_yes[1] > to_yes[0]))
            no, yes = max(to_no), max(to_yes) + score
        labels = [yes > no]
        for origin in reversed(origins):
            labels.append(origin[labels[-1]])
        return labels[::-1]


def main_text(page: str | None, decoder: _Decoder) -> str:
    blocks = blocks_of(page or "")
    return "\n".join(b.text for b, main in zip(blocks, decoder.main(blocks), strict=True) if main)


def _extracted(batches: Iterator[pa.RecordBatch], model: Extractor) -> Iterator[pa.RecordBatch]:
    decoder = _Decoder(model)
    for whole in batches:
        for batch in batches_of(whole, "html"):
            texts = [main_text(page, decoder) for page in batch.column("html").to_pylist()]
            columns = [batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()), pa.array(list(map(len, texts)), pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, names=["page_id", "url", "text", "n_chars"])


def extract(pages: DataFrame, model: Extractor) -> DataFrame:
    """``(page_id, url, text, n_chars)`` of each row of ``pages``.

    Null and empty pages have no text; repeated rows stay repeated; extra columns play no part. No
    shuffle: each page is read, labelled and joined where it lies, whole.
    """
    plain = pages.select("page_id", "url", F.col("html").cast("string").alias("html"))
    kind = plain.schema["page_id"].dataType.simpleString()
    url = plain.schema["url"].dataType.simpleString()
    return plain.mapInArrow(lambda batches: _extracted(batches, model), f"page_id {kind}, url {url}, text string, n_chars bigint")
