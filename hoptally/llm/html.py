"""Main text of web pages: boosted trees over DOM nodes, decoded so that no node contradicts its ancestors.

A page is parsed to its block elements. Each gets features of its tag, depth, attribute tokens (its own and its
ancestors'), the density of text, links and punctuation in its subtree, and its place among its siblings. Gradient-
boosted trees give the chance that a node holds main text. A labelling is consistent if every node above
a main one is main too; the likeliest consistent labelling is found from the leaves up, and the text blocks of
its main nodes are the result.

The trees are trained on a bounded sample of the pages: the pages as they are, where the article or main element tells
what is main text; these pages in disguise, with that element renamed and attributes taken off or dealt to other
elements, so that density, depth and siblings have to tell; and pages put together anew from their blocks in other
layouts (other elements, attribute names, side columns, notices, adverts, forms, reader comments), of which the labels
are known.
"""

from __future__ import annotations

import re
from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass, field
from html import escape

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hoptally.llm.common import map_arrow, read, slices
from hoptally.llm.markup import scan

#: Bounds of the training sample: pages, and characters of a page.
SAMPLE_PAGES, SAMPLE_CHARS, LAYOUTS, DISGUISES = 150, 60_000, 4, 3
TREES, DEPTH, BINS, RATE, SEED = 80, 4, 32, 0.2, 11

BLOCK = set(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 "
    "header hgroup hr html legend li main menu nav ol p pre search section summary table tbody td tfoot th thead tr ul".split()
)
VOID = set("area base br col embed hr img input link meta source track wbr".split())
SKIP = set("script style noscript template svg iframe head title button select textarea option object canvas math audio video".split())
#: What a head holds: anything else that begins is of the body, where </head> is left out.
HEAD = set("base basefont bgsound link meta title style script noscript template".split())
#: Skipped elements that end where another of their kind begins.
ANEW = set("button option".split())
#: An open element of the first kind ends when one of the second begins.
ENDS = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "td": {"td", "th", "tr"}, "th": {"td", "th", "tr"}, "tr": {"tr"}}
TAGS = ["p", "div", "li", "ul", "article", "section", "main", "nav", "header", "footer", "aside", "form", "h1", "h2", "h3", "body", "html", "blockquote", "pre", "table", "td", "figure", "ol", "dl"]
TOKENS = {
    "content": "article content post entry story body main text articlebody blog maincontent page prose copy",
    "nav": "nav navbar menu breadcrumb breadcrumbs pagination pager toc tabs navigation links skip",
    "side": "sidebar aside widget related recommended trending popular promo more tags teaser rail secondary complementary",
    "ad": "ad ads advert advertisement advertising adsense sponsor sponsored dfp adslot commercial",
    "foot": "footer copyright legal colophon bottom contentinfo",
    "head": "header masthead topbar logo banner top branding",
    "note": "cookie cookies consent gdpr notice alert popup modal newsletter subscribe overlay paywall warning disclaimer privacy",
    "comment": "comment comments respond reply replies disqus discussion reviews commentlist thread feedback",
    "social": "share sharing social follow like tweet buttons",
    "form": "form search login signup signin register contact",
}
_GROUP = {w: k for k, words in enumerate(TOKENS.values()) for w in words.split()}
_SPLIT = re.compile(r"[^a-z]+")
_CAMEL = re.compile(r"(?<=[a-z])(?=[A-Z])")
N_TOKENS = len(TOKENS)
NAMES = [
    "depth", "text", "link", "link_share", "nodes", "density", "punctuation", "words_a_block", "children", "place", "siblings", "of_parent",
    "sibling_text", "of_page", "starts_at", "hidden", *(f"tag_{t}" for t in TAGS), *(f"own_{k}" for k in TOKENS), *(f"above_{k}" for k in TOKENS), "parent_tag", "above_nav", "above_main",
]


@dataclass
class Node:
    tag: str
    parent: int
    depth: int
    tokens: np.ndarray
    hidden: bool
    mark: int  # of training pages: 1 main text, 0 not, -1 as the parent
    text: int = 0
    link: int = 0
    punctuation: int = 0
    blocks: int = 0
    children: list[int] = field(default_factory=list)


class Page:
    """The block elements of a page, and its text blocks in page order with the node that each belongs to.

    Open elements are known by their tags, so that an end tag doesn't look through those that are open: time is in proportion to the page."""

    def __init__(self, html: str):
        self.nodes = [Node("html", -1, 0, np.zeros(N_TOKENS, bool), False, -1)]
        self.blocks: list[tuple[int, str]] = []
        self.open: list[tuple[str, int]] = [("html", 0)]  # inline elements too, with the block element that they are in
        self.places: dict[str, list[int]] = defaultdict(list)  # where elements of a tag are in open, but for the first
        self.block_places: list[int] = []
        self.skip, self.inside, self.within = "", [], Counter()  # the skipped element that is open, and what is open in it
        self.run, self.linked = [], 0
        scan(html, self)
        self.flush()

    def push(self, tag: str, node: int) -> None:
        self.places[tag].append(len(self.open))
        if tag in BLOCK:
            self.block_places.append(len(self.open))
        self.open.append((tag, node))

    def cut(self, k: int) -> None:
        """Ends all open elements from the k-th on."""
        while len(self.open) > k:
            tag, _ = self.open.pop()
            self.places[tag].pop()
            if tag in BLOCK:
                self.block_places.pop()

    def last(self, tag: str) -> int:
        return self.places[tag][-1] if self.places.get(tag) else 0

    def unskip(self) -> None:
        self.skip, self.inside, self.within = "", [], Counter()

    def flush(self) -> None:
        if not self.run:
            return
        text = " ".join("".join(self.run).split())
        if text:
            at = self.open[-1][1]
            self.blocks.append((at, text))
            node = self.nodes[at]
            node.text += len(text)
            node.link += min(self.linked, len(text))
            node.punctuation += sum(map(text.count, ".,;!?"))
            node.blocks += 1
        self.run, self.linked = [], 0

    def handle_starttag(self, tag: str, attrs: list) -> None:
        if tag == "body" or tag == "html":
            if tag == "body" and not self.last("body"):
                self.unskip()
            elif tag == "html":
                return
        if self.skip == "head" and tag not in HEAD and not any(self.within[t] for t in SKIP):
            self.unskip()  # the body begins
        if self.skip:
            if tag == self.skip and tag in ANEW:
                self.inside, self.within = [], Counter()
            elif tag not in VOID:
                self.inside.append(tag)
                self.within[tag] += 1
            return
        if tag in SKIP:
            self.skip = tag
            return
        if tag in BLOCK:
            self.flush()
            self.shut("p")
            for kind in ENDS.get(tag, ()):
                self.shut(kind, {"ul", "ol", "dl", "table", "menu"})
            parent = self.open[-1][1]
            words = [x for k, v in attrs if k in {"class", "id", "role", "itemprop", "aria-label", "name"} and v for x in _SPLIT.split(_CAMEL.sub(" ", v).lower())]
            own = np.zeros(N_TOKENS, bool)
            own[[_GROUP[x] for x in words if x in _GROUP]] = True
            given = dict(attrs)
            hidden = "hidden" in given or given.get("aria-hidden") == "true" or "display:none" in (given.get("style") or "").replace(" ", "")
            mark = int(given["data-main"]) if given.get("data-main") in {"0", "1"} else -1
            self.nodes.append(Node(tag, parent, self.nodes[parent].depth + 1, own, hidden, mark))
            self.nodes[parent].children.append(len(self.nodes) - 1)
            if tag not in VOID:
                self.push(tag, len(self.nodes) - 1)
        elif tag == "br":
            self.run.append(" ")
        elif tag not in VOID:
            self.push(tag, self.open[-1][1])

    def shut(self, tag: str, fence: set | frozenset = frozenset()) -> None:
        """Ends the innermost open element of that tag, and what is open in it; not beyond an element of fence, and a p only if it is
        the innermost block."""
        k = self.last(tag)
        if tag == "p" and k and k != self.block_places[-1]:
            return
        if k and k > max((self.last(t) for t in fence if t != tag), default=0):
            self.flush()
            self.cut(k)

    def handle_endtag(self, tag: str) -> None:
        if self.within[tag]:
            while True:
                gone = self.inside.pop()
                self.within[gone] -= 1
                if gone == tag:
                    return
        if self.skip:
            ends, outer = tag == self.skip, self.last(tag) > 0
            if ends or outer:
                self.unskip()
            if ends or not outer:
                return
        if tag in BLOCK:
            if tag not in {"html", "body"}:
                self.shut(tag)
        elif (k := self.last(tag)) and k > (self.block_places[-1] if self.block_places else 0):
            self.cut(k)

    def handle_data(self, data: str) -> None:
        if self.skip == "head" and not self.inside and data.strip():
            self.skip = ""
        if not self.skip:
            self.run.append(data)
            if self.places.get("a"):
                self.linked += len(data.strip())


def features(page: Page) -> np.ndarray:
    """A row of NAMES for each node."""
    nodes = page.nodes
    n = len(nodes)
    total = np.array([[x.text, x.link, x.punctuation, x.blocks, 1] for x in nodes], float)
    start = np.zeros(n)
    parent = np.array([x.parent for x in nodes])
    own_text = total[:, 0].copy()
    for i in range(n - 1, 0, -1):  # children come after their parents
        total[parent[i]] += total[i]
    before = np.concatenate([[0], np.cumsum(own_text)[:-1]])
    all_text = max(total[0, 0], 1)
    start = before / all_text
    out = np.zeros((n, len(NAMES)))
    text, link, punctuation, blocks, inside = total.T
    some = np.maximum(text, 1)
    children = np.array([len(x.children) for x in nodes])
    place, siblings, sibling_text = np.zeros(n), np.ones(n), np.zeros(n)
    for x in nodes:
        k = len(x.children)
        if k:
            place[x.children] = np.arange(k) / k
            siblings[x.children] = k
            sibling_text[x.children] = text[x.children].mean()
    above = np.zeros((n, N_TOKENS + 2), bool)
    for i in range(1, n):
        p = parent[i]
        above[i] = above[p]
        above[i, :N_TOKENS] |= nodes[p].tokens
        above[i, N_TOKENS] |= nodes[p].tag in {"nav", "aside", "footer", "header", "form"}
        above[i, N_TOKENS + 1] |= nodes[p].tag in {"article", "main"}
    out[:, :16] = np.stack(
        [np.array([x.depth for x in nodes]), np.log1p(text), np.log1p(link), link / some, np.log1p(inside), text / inside, 100 * punctuation / some, text / np.maximum(blocks, 1),
         children, place, siblings, text / some[np.maximum(parent, 0)], np.log1p(sibling_text), text / all_text, start, np.array([x.hidden for x in nodes])], 1,
    )
    index = {t: k for k, t in enumerate(TAGS)}
    tag = np.array([index.get(x.tag, -1) for x in nodes])
    at = np.flatnonzero(tag >= 0)
    out[at, 16 + tag[at]] = 1
    out[:, 16 + len(TAGS) : 16 + len(TAGS) + N_TOKENS] = [x.tokens for x in nodes]
    out[:, 16 + len(TAGS) + N_TOKENS : 16 + len(TAGS) + 2 * N_TOKENS] = above[:, :N_TOKENS]
    out[:, -3] = tag[np.maximum(parent, 0)]
    out[:, -2:] = above[:, N_TOKENS:]
    return out


@dataclass(frozen=True)
class Forest:
    edges: list[np.ndarray]  # of each feature, the bounds of its bins
    feature: np.ndarray  # trees x inner nodes of a full tree
    bound: np.ndarray  # the last bin that goes left
    leaf: np.ndarray  # trees x leaves
    start: float


def binned(edges: list[np.ndarray], x: np.ndarray) -> np.ndarray:
    return np.stack([np.searchsorted(e, x[:, k], "right") for k, e in enumerate(edges)], 1).astype(np.int64)


def boost(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> Forest:
    """Gradient boosting with logistic loss on histograms."""
    edges = [np.unique(np.quantile(x[:, k], np.linspace(0, 1, BINS + 1)[1:-1])) for k in range(x.shape[1])]
    b, n = binned(edges, x), len(x)
    flat = b + np.arange(x.shape[1]) * BINS
    start = float(np.log((weight @ y + 1) / (weight @ (1 - y) + 1)))
    score = np.full(n, start)
    feature, bound = np.zeros((TREES, 2**DEPTH - 1), np.int64), np.full((TREES, 2**DEPTH - 1), BINS)
    leaf = np.zeros((TREES, 2**DEPTH))
    for t in range(TREES):
        p = 1 / (1 + np.exp(-score))
        g, h = weight * (p - y), weight * p * (1 - p)
        at = np.zeros(n, np.int64)
        for level in range(DEPTH):
            width = x.shape[1] * BINS
            cell = (at[:, None] * width + flat).ravel()
            left = [np.bincount(cell, np.repeat(v, x.shape[1]), (1 << level) * width).reshape(1 << level, x.shape[1], BINS).cumsum(2) for v in (g, h)]
            whole = [v[:, :, -1:] for v in left]
            right = [w - v for w, v in zip(whole, left, strict=True)]
            gain = left[0] ** 2 / (left[1] + 1) + right[0] ** 2 / (right[1] + 1) - whole[0] ** 2 / (whole[1] + 1)
            gain[(left[1] < 2) | (right[1] < 2)] = 0
            best = gain.reshape(1 << level, -1).argmax(1)
            chosen, cut = best // BINS, best % BINS
            cut = np.where(gain.reshape(1 << level, -1).max(1) > 1e-6, cut, BINS)
            base = (1 << level) - 1
            feature[t, base : base + (1 << level)], bound[t, base : base + (1 << level)] = chosen, cut
            at = 2 * at + (b[np.arange(n), chosen[at]] > cut[at])
        leaf[t] = -RATE * np.bincount(at, g, 2**DEPTH) / (np.bincount(at, h, 2**DEPTH) + 1)
        score += leaf[t][at]
    return Forest(edges, feature, bound, leaf, start)


def predicted(forest: Forest, x: np.ndarray) -> np.ndarray:
    """The log-odds of each row."""
    b, n = binned(forest.edges, x), np.arange(len(x))
    score = np.full(len(x), forest.start)
    for feature, bound, leaf in zip(forest.feature, forest.bound, forest.leaf, strict=True):
        at = np.zeros(len(x), np.int64)
        for level in range(DEPTH):
            k = (1 << level) - 1 + at
            at = 2 * at + (b[n, feature[k]] > bound[k])
        score += leaf[at]
    return score


def decoded(page: Page, score: np.ndarray) -> np.ndarray:
    """The likeliest labels of the nodes of which none is main below one that isn't."""
    n = len(page.nodes)
    yes, no = -np.logaddexp(0, -score), -np.logaddexp(0, score)
    for i in range(n - 1, 0, -1):
        p = page.nodes[i].parent
        no[p] += no[i]
        yes[p] += max(yes[i], no[i])
    main = np.zeros(n, bool)
    main[0] = yes[0] > no[0]
    for i in range(1, n):
        main[i] = main[page.nodes[i].parent] and yes[i] > no[i]
    return main


def extracted(htmls: list[str], forest: Forest) -> list[str]:
    pages = [Page(x) for x in htmls]
    if not pages:
        return []
    scores = np.split(predicted(forest, np.concatenate([features(p) for p in pages])), np.cumsum([len(p.nodes) for p in pages])[:-1])
    out = []
    for page, score in zip(pages, scores, strict=True):
        main = decoded(page, score)
        out.append("\n\n".join(text for at, text in page.blocks if main[at]))
    return out


def labels(page: Page) -> np.ndarray:
    """Of a training page: whether a node holds text that is marked as main, at any depth."""
    nodes = page.nodes
    mark = np.zeros(len(nodes), int)
    for i in range(1, len(nodes)):
        mark[i] = nodes[i].mark if nodes[i].mark >= 0 else mark[nodes[i].parent]
    has = np.zeros(len(nodes), bool)
    for at, _ in page.blocks:
        has[at] |= mark[at] == 1
    for i in range(len(nodes) - 1, 0, -1):
        has[nodes[i].parent] |= has[i]
    return has


_TAG, _NAMED = re.compile(r"<[a-zA-Z][^<>]*>"), re.compile(r"""\s(?:class|id|role|name|itemprop|aria-label)\s*=\s*(?:"[^"]*"|'[^']*'|[^\s"'>]+)""")


def disguised(rng: np.random.Generator, html: str) -> str:
    """The page with its article and main elements renamed, and the names of elements taken off or dealt to others."""
    tag = str(rng.choice(["div", "div", "div", "section"]))
    html = re.sub(r"<(/?)(?:article|main)\b", rf"<\1{tag}", html)
    names = [x for t in _TAG.findall(html) for x in _NAMED.findall(t)]
    if rng.random() < 0.5:
        names = [""] * len(names)
    else:
        rng.shuffle(names)
    given = iter(names)
    return _TAG.sub(lambda t: _NAMED.sub(lambda _: next(given), t[0]), html)


def layout(rng: np.random.Generator, body: list[str], others: list[str]) -> str:
    """A page of the blocks of body as its main text, in a layout drawn at random; others fill the rest."""
    pick = lambda *x: x[rng.integers(len(x))]
    chance = lambda p: rng.random() < p
    some = lambda low, high: [escape(others[i]) for i in rng.integers(len(others), size=rng.integers(low, high))]
    words = lambda n: [escape(w) for w in " ".join(some(1, 2)).split()[:n]]
    blank = lambda: f' class="{pick("c", "x", "box", "col", "row", "wrap", "inner")}{rng.integers(99)}"'

    def named(tags: tuple, names: tuple, inner: str, mark: str = "") -> str:
        tag = pick(*tags)
        name = blank() if chance(0.15) else f' {pick("class", "class", "id")}="{pick(*names)}"'
        name = "" if tag not in {"div", "section", "ul", "ol", "table"} and chance(0.4) else name
        return f"<{tag}{name}{mark}>{inner}</{tag}>"

    links = lambda n: "".join(f'<li><a href="/{w}">{w}</a></li>' for w in words(n))
    prose = lambda low, high: "".join(f"<p>{t}</p>" for t in some(low, high))
    menu = lambda: named(("nav", "div", "nav"), ("menu", "nav", "navbar", "main-nav", "breadcrumbs"), f"<ul>{links(rng.integers(3, 12))}</ul>")
    ad = lambda mark="": named(("div", "aside", "section"), ("ad", "ads", "advert", "sponsored", "ad-slot", "promo"), pick(" ".join(words(12)), prose(1, 2), f'<a href="/b">{" ".join(words(6))}</a>'), mark)
    notice = lambda mark="": named(("div", "section"), ("cookie-banner", "notice", "consent", "newsletter", "alert", "popup", "disclaimer"), pick(f"<p>{' '.join(words(20))}</p>", " ".join(words(15)), prose(1, 2)), mark)
    side = lambda: named(("aside", "div", "aside"), ("sidebar", "related", "widget", "recommended", "side-column", "popular"), f"<h3>{' '.join(words(3))}</h3>" + pick(f"<ul>{links(6)}</ul>", prose(1, 4), "".join(f"<div><a href='/r'>{' '.join(words(8))}</a><p>{' '.join(words(15))}</p></div>" for _ in range(3))))
    form = lambda mark="": f'<form action="/s"{mark}><label>{" ".join(words(3))}</label><input name="q"><p>{" ".join(words(8))}</p><button>Go</button></form>'
    replies = lambda mark="": named(("section", "div", "ol"), ("comments", "comment-list", "responses", "discussion", "reader-comments", "disqus-thread"), f"<h3>{' '.join(words(2))}</h3>" + "".join(
        named(("div", "li", "article"), ("comment", "comment-body", "reply"), f"<span>{' '.join(words(2))}</span>" + prose(1, 3)) for _ in range(rng.integers(1, 6))), mark)
    head = lambda: named(("header", "div"), ("header", "masthead", "topbar", "site-header", "banner"), f"<a href='/'>{' '.join(words(3))}</a>" + pick("", f"<p>{' '.join(words(9))}</p>", f"<h1>{' '.join(words(3))}</h1>"))
    foot = lambda: named(("footer", "div"), ("footer", "site-footer", "copyright", "bottom"), pick(f"&copy; {' '.join(words(12))}", f"<p>{' '.join(words(25))}</p>", f"<ul>{links(7)}</ul><p>{' '.join(words(12))}</p>", prose(1, 2)))

    zero = ' data-main="0"'
    parts = [f"<h1>{escape(' '.join(body[0].split()[:9]))}</h1>"] if chance(0.6) else []
    for t in body:
        t = escape(t)
        parts.append(pick(f"<p>{t}</p>", f"<p>{t}</p>", f"<p>{t}", f"<p><b>{t}</b></p>", f"<div>{t}</div>" if chance(0.3) else f"<p>{t}</p>", f"<blockquote><p>{t}</p></blockquote>" if chance(0.1) else f"<p>{t}</p>", f"<h2>{t}</h2>" if len(t) < 60 else f"<p>{t}</p>"))
        if chance(0.06):
            parts.append(pick(ad, notice, form)(zero))
    if chance(0.15):
        parts.append(f"<ul>{''.join(f'<li>{escape(t)}</li>' for t in body[:3])}</ul>")
    if chance(0.2):
        parts.append(replies(zero))
    if chance(0.2):
        parts.append(named(("div",), ("share", "social", "tags", "related-links"), f"<ul>{links(4)}</ul>", zero))
    main = named(("article", "main", "div", "div", "section", "td"), ("content", "post", "article-body", "entry-content", "story", "main", "post-content", "text", "page-content"), "".join(parts), ' data-main="1"')
    if main.startswith("<td"):
        main = f"<table><tr>{main}{'<td>' + side() + '</td>' if chance(0.7) else ''}</tr></table>"
    for _ in range(rng.integers(0, 3)):
        main = f"<div{blank() if chance(0.5) else ''}>{main}{side() if chance(0.2) else ''}</div>"
    top = [f() for f, p in ((notice, 0.3), (head, 0.6), (menu, 0.7), (ad, 0.4), (form, 0.2)) if chance(p)]
    rest = [f() for f, p in ((side, 0.5), (ad, 0.3), (replies, 0.5), (form, 0.2), (notice, 0.2), (menu, 0.2), (foot, 0.8)) if chance(p)]
    return f"<html><head><title>{' '.join(words(4))}</title></head><body>{''.join(top)}{main}{''.join(rest)}</body></html>"


def marked(html: str) -> str:
    """A page with its main element marked: the article, else main."""
    kind = "article" if "<article" in html else "main"
    return re.sub(rf"<{kind}\b", f'<{kind} data-main="1"', html)


def sampled(pages: DataFrame) -> DataFrame:
    """turn, page_id, html of the SAMPLE_PAGES pages of the smallest hash of page_id that have a main element and at most SAMPLE_CHARS characters."""
    usable = pages.where((F.length("html") <= SAMPLE_CHARS) & (F.col("html").contains("<article") | F.col("html").contains("<main")))
    chosen = usable.select("page_id", F.xxhash64("page_id").alias("turn")).orderBy("turn", "page_id").limit(SAMPLE_PAGES)
    return usable.join(F.broadcast(chosen), "page_id").select("turn", "page_id", "html").dropDuplicates(["page_id"])


def train(pages: DataFrame) -> Forest:
    rows = sampled(pages).collect()
    htmls = [r["html"] for r in sorted(rows, key=lambda r: (r["turn"], r["page_id"]))]
    rng = np.random.default_rng(SEED)
    made: list[Page] = []
    bodies, others = [], []
    for x in htmls:
        page = Page(marked(x))
        mark = labels(page)
        made += [page, *(Page(disguised(rng, marked(x))) for _ in range(DISGUISES))]
        body = [t for at, t in page.blocks if mark[at]]
        bodies += [body] if body else []
        others += [t for at, t in page.blocks if not mark[at]] + body[:4]
    if not bodies:  # nothing to learn the language from
        bodies, others = [["One sentence, and another. " * 6] * 4], ["One sentence, and another. " * 6, "A menu"]
    for body in bodies:
        for _ in range(LAYOUTS):
            low = rng.integers(len(body))
            made.append(Page(layout(rng, body[low : low + rng.integers(1, 25)], others)))
    x, y = np.concatenate([features(p) for p in made]), np.concatenate([labels(p) for p in made]).astype(float)
    weight = np.concatenate([np.full(len(p.nodes), 30 / (30 + len(p.nodes))) for p in made])
    return boost(x, y, weight)


def extract(pages: DataFrame, forest: Forest) -> DataFrame:
    """page_id, url, text, n_chars of every row of pages (page_id, url, html).

    A null or empty html, and one without main text, give an empty text. Repeated rows give a row each; null ids and
    urls stay null. Other columns are ignored; no rows give no rows."""
    shared = pages.sparkSession.sparkContext.broadcast(forest)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "html", 4 << 20):
            texts = extracted(batch.column("html").fill_null("").to_pylist(), shared.value)
            yield pa.RecordBatch.from_arrays(
                [batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()), pa.array([len(x) for x in texts], pa.int64())], ["page_id", "url", "text", "n_chars"]
            )

    kind = dict(pages.dtypes)["page_id"]
    return map_arrow(pages.select("page_id", F.col("url").cast("string"), F.col("html").cast("string")), run, f"page_id {kind}, url string, text string, n_chars long")


def op3_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = read(spark, sf_dir, "pages")
    return extract(pages, train(pages))
