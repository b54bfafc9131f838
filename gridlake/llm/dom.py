"""Main text of web pages: gradient-boosted trees over the nodes of the DOM.

Every block element is a node with features of its own (tag, class, id and
role tokens, depth, text and link density of its subtree), of its ancestors
and of its siblings. Boosted trees give each node the odds of being part of
the article. Decoding is hierarchical: the set of nodes is chosen that is best
in sum while no node can be in without its parent, so a kept paragraph never
stands in a dropped menu.

No table has labels for this, so the trees are trained on pages that a layout
generator builds with known labels, out of words of a bounded sample of pages.
"""

from __future__ import annotations

import html
import re
from bisect import bisect_right
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: pages whose words fill the training pages, and the training pages made
SAMPLE, TRAINING_PAGES = 200, 700
TREES, DEPTH, RATE, BINS = 60, 4, 0.3, 32

#: fixed values of HTML
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript iframe xmp noembed noframes".split())
#: elements that are parsed and whose content is left out; a block's start tag ends those of the second kind
DROPPED = frozenset("svg math select object template".split())
NO_BLOCKS = frozenset("svg math select".split())
BLOCK = frozenset(
    "address article aside blockquote body button center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 header hgroup hr html label legend li main menu nav ol p pre search section summary table tbody td "
    "tfoot th thead tr ul".split())
CLOSES_P = BLOCK - frozenset("html body button label td th tr tbody thead tfoot".split())
#: a start tag closes these open elements, up to one of the bounds
IMPLIED = {"li": ("li", "ul ol menu dir"), "dt": ("dt dd", "dl"), "dd": ("dt dd", "dl"), "tr": ("tr td th", "table"),
           "td": ("td th", "tr table"), "th": ("td th", "tr table"), "option": ("option", "select"),
           "tbody": ("tr td th thead tbody", "table"), "tfoot": ("tr td th thead tbody", "table")}
IMPLIED = {k: (frozenset(a.split()), frozenset(b.split())) for k, (a, b) in IMPLIED.items()}

#: tokens of class, id and role that say what an element is for
TOKENS = {
    "menu": "nav navbar navigation menu menubar breadcrumb breadcrumbs toolbar tabs pagination pager skip toc topbar",
    "head": "header masthead logo branding tagline banner hero sitename",
    "foot": "footer copyright legal colophon bottom credits",
    "side": "sidebar aside widget rail related recommended trending popular archive tags tagcloud more complementary",
    "ad": "ad ads advert advertisement sponsor sponsored promo promotion adsense dfp outbrain taboola affiliate",
    "notice": "cookie cookies consent gdpr notice alert popup modal overlay newsletter subscribe signup paywall toast disclaimer",
    "comment": "comment comments disqus reply replies respond discussion reactions reviews",
    "share": "share social sharing follow buttons author byline meta rating search form login",
    "text": "article content post entry story body main text maincontent page prose blog single",
}
_GROUP = {w: k for k, g in enumerate(TOKENS.values()) for w in g.split()}
TAGS = ("p", "div", "h", "li", "list", "nav", "header", "footer", "aside", "article", "main", "section", "form", "cell", "quote", "pre", "body")
_TAG = {"p": 0, "div": 1, **{f"h{i}": 2 for i in range(1, 7)}, "li": 3, "dd": 3, "dt": 3, "ul": 4, "ol": 4, "dl": 4, "menu": 5, "nav": 5,
        "header": 6, "footer": 7, "aside": 8, "article": 9, "main": 10, "section": 11, "form": 12, "fieldset": 12, "button": 12,
        "label": 12, "search": 12, "dialog": 12, "td": 13, "th": 13, "tr": 13, "table": 13, "tbody": 13, "blockquote": 14, "pre": 15,
        "body": 16, "html": 16}
_G = len(TOKENS)

_NAME = re.compile(r"[a-zA-Z][^\s/>]*")
_SPECIAL = re.compile(r"[>\"']")
_RAW_END = {tag: re.compile(rf"</{tag}\s*>", re.I) for tag in RAW}
#: an end tag of no block does not reach over these open elements
WALLS = frozenset("td th article main section nav footer aside header div form".split())
_ATTRIBUTE = re.compile(r"""([^\s=/"'>]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")
_PART = re.compile(r"[a-z]+")


class Node:
    __slots__ = ("tag", "attrs", "parent", "kids", "text", "link", "order")

    def __init__(self, tag: str, attrs: str, parent):
        self.tag, self.attrs, self.parent = tag, attrs, parent
        self.kids, self.text, self.link, self.order = [], [], 0, []


class Scanner:
    """The tags of a page, each place looked at a bounded number of times
    however broken the page is: what a search found, or that it found nothing,
    holds for all later searches that begin before its end."""

    def __init__(self, page: str):
        self.page, self.names_end = page, (0, 0)
        self.special, self.special_from = -2, 0
        self.quotes: dict[int, int] = {}        # opening quote -> end of its tag, -1 if it has none
        self.no_end: set[str] = set()           # quotes, '>' and raw elements without an end from here on

    def _tag_end(self, at: int) -> int:
        """The place of the first '>' outside quotes from ``at`` on, or -1."""
        if not (self.special_from <= at <= self.special or self.special == -1 and self.special_from <= at):
            m = _SPECIAL.search(self.page, at)
            self.special, self.special_from = (m.start() if m else -1), at
        k, opened = self.special, []
        while k >= 0 and self.page[k] != ">":
            if k in self.quotes:
                k = self.quotes[k]
                break
            opened.append(k)
            quote = self.page[k]
            closing = -1 if quote in self.no_end else self.page.find(quote, k + 1)
            if closing < 0:
                self.no_end.add(quote)
                k = -1
                break
            m = _SPECIAL.search(self.page, closing + 1)
            k = m.start() if m else -1
        self.quotes.update((o, k) for o in opened)
        return k

    def next(self, at: int):
        """(start, end, closing, name, attributes) of the next tag from ``at``
        on; the name is None for a comment or declaration. None at the end."""
        page = self.page
        at = page.find("<", at)
        while at >= 0:
            two = page[at + 1:at + 2]
            if page.startswith("<!--", at):
                end = page.find("-->", at + 4)
                return at, len(page) if end < 0 else end + 3, False, None, ""
            if two and two in "!?":
                end = -1 if ">" in self.no_end else page.find(">", at + 2)
                if end >= 0:
                    return at, end + 1, False, None, ""
                self.no_end.add(">")
            else:
                closing = two == "/"
                first = at + 1 + closing
                if page[first:first + 1].isascii() and page[first:first + 1].isalpha():
                    begin, end = self.names_end
                    name_end = end if begin <= first < end else _NAME.match(page, first).end()
                    self.names_end = (first, name_end)
                    close = self._tag_end(name_end)
                    if close >= 0:
                        return at, close + 1, closing, page[first:name_end].lower(), page[name_end:close]
            at = page.find("<", at + 1)
        return None

    def after_raw(self, tag: str, at: int) -> int:
        """Where an element whose content is no markup ends."""
        end = _RAW_END[tag].search(self.page, at)
        return end.end() if end else len(self.page)


class Open:
    """The open elements, with the places of each name and kind, so that no
    search walks over them."""

    def __init__(self, root: Node):
        self.stack = [("html", root)]           # with the block that an element is, or is in
        self.places: dict[str, list[int]] = {}
        self.held: dict[str, list[list[int]]] = {}
        self.walls, self.solid, self.hidden = [], [], []

    def _of(self, tag: str) -> list[list[int]]:
        """The lists that hold the places of elements of a name."""
        own = self.places[tag] = []
        kinds = ((self.walls, WALLS), (self.hidden, DROPPED), (self.solid, BLOCK | DROPPED))
        self.held[tag] = [own, *[places for places, kind in kinds if tag in kind]]
        return self.held[tag]

    def push(self, tag: str, block: Node) -> None:
        for held in self.held.get(tag) or self._of(tag):
            held.append(len(self.stack))
        self.stack.append((tag, block))

    def close(self, k: int) -> None:
        while len(self.stack) > k:
            for held in self.held[self.stack.pop()[0]]:
                held.pop()

    def last(self, tag: str) -> int:
        """The innermost open element of a name, 0 if there is none."""
        held = self.places.get(tag)
        return held[-1] if held else 0

    def end(self, tag: str) -> None:
        k = self.last(tag)
        if k and (tag in BLOCK or not self.walls or self.walls[-1] <= k):
            self.close(k)

    def end_paragraph(self) -> None:
        if self.solid and self.stack[self.solid[-1]][0] == "p":
            self.close(self.solid[-1])

    def end_implied(self, tag: str) -> None:
        """Closes the outermost of the elements that a start tag ends, inside
        the innermost of its bounds."""
        own, bound = IMPLIED[tag]
        inside = max([self.last(t) for t in bound] + self.hidden[-1:])
        held = [self.places.get(t, []) for t in own]
        ended = [h[k] for h, k in zip(held, (bisect_right(h, inside) for h in held)) if k < len(h)]
        if ended:
            self.close(min(ended))

    def end_hidden(self) -> None:
        """A block's start tag ends the elements that can hold no blocks."""
        while self.hidden:
            k = self.hidden[-1]
            if self.stack[k][0] not in NO_BLOCKS or self.last("foreignobject") > k:
                return
            self.close(k)


def parse(page: str) -> list[Node]:
    """The block elements of a page, parents first. ``order`` of a node holds
    its pieces of text and its child blocks, in page order. The time is linear
    in the page, well-formed or not."""
    root = Node("html", "", None)
    nodes, opened, scan = [root], Open(root), Scanner(page)
    at = 0

    def put(raw: str) -> None:
        if opened.hidden:
            return
        block = opened.stack[-1][1]
        if not block.order or isinstance(block.order[-1], Node):
            block.order.append([])
        text = html.unescape(raw)
        block.order[-1].append(text)
        if opened.last("a"):
            block.link += len(text)

    while (found := scan.next(at)) is not None:
        start, end, closing, tag, attrs = found
        if start > at:
            put(page[at:start])
        at = end
        if tag is None:
            continue
        if closing:
            opened.end(tag)
            continue
        if tag in RAW:
            at = scan.after_raw(tag, at)
            continue
        if tag in VOID:
            if tag in ("br", "hr", "img", "input"):
                put(" ")
            continue
        if tag in DROPPED:
            if not attrs.endswith("/"):
                opened.push(tag, opened.stack[-1][1])
            continue
        if tag in BLOCK:
            opened.end_hidden()
        if tag in CLOSES_P:
            opened.end_paragraph()
        if tag in IMPLIED:
            opened.end_implied(tag)
        if tag == "html" or tag == "body" and opened.last("body"):
            continue
        inside = opened.stack[-1][1]
        if tag in BLOCK and not opened.hidden:
            node = Node(tag, attrs, inside)
            inside.order.append(node)
            inside.kids.append(node)
            nodes.append(node)
            opened.push(tag, node)
        else:
            opened.push(tag, inside)
    if at < len(page):
        put(page[at:])
    for n in nodes:
        n.order = [x if isinstance(x, Node) else " ".join("".join(x).split()) for x in n.order]
        n.order = [x for x in n.order if x != ""]
    return nodes


FEATURES = (len(TAGS) * 2 + _G * 2 + 22)


def features(nodes: list[Node]) -> np.ndarray:
    """One row for each node."""
    n = len(nodes)
    out = np.zeros((n, FEATURES), dtype=np.float32)
    place = {id(x): i for i, x in enumerate(nodes)}
    parent = np.array([place[id(x.parent)] if x.parent is not None else 0 for x in nodes])
    text = np.array([sum(len(t) for t in x.order if not isinstance(t, Node)) for x in nodes], dtype=np.float64)
    words = np.array([sum(t.count(" ") + 1 for t in x.order if not isinstance(t, Node)) for x in nodes], dtype=np.float64)
    stops = np.array([sum(t.count(".") + t.count(",") for t in x.order if not isinstance(t, Node)) for x in nodes], dtype=np.float64)
    link = np.array([min(x.link, t) for x, t in zip(nodes, text)], dtype=np.float64)
    total = {k: v.copy() for k, v in (("text", text), ("words", words), ("stops", stops), ("link", link))}
    count, height = np.ones(n), np.zeros(n)
    paragraphs = np.array([x.tag == "p" for x in nodes], dtype=np.float64)
    for i in range(n - 1, 0, -1):
        p = parent[i]
        for v in total.values():
            v[p] += v[i]
        count[p] += count[i]
        paragraphs[p] += paragraphs[i]
        height[p] = max(height[p], height[i] + 1)
    depth = np.zeros(n)
    t, g = len(TAGS), _G
    for i, x in enumerate(nodes):
        own = out[i]
        k = _TAG.get(x.tag)
        if k is not None:
            own[k] = 1
        if x.attrs:
            for a in _ATTRIBUTE.finditer(x.attrs):
                if a[1].lower() in ("class", "id", "role", "itemprop", "aria-label"):
                    for w in _PART.findall((a[2] or a[3] or a[4] or "").lower()):
                        w = _GROUP.get(w)
                        if w is not None:
                            own[2 * t + w] += 1
        if i:
            up = out[parent[i]]
            depth[i] = depth[parent[i]] + 1
            own[t:2 * t] = np.maximum(up[t:2 * t], up[:t])                                         # tags above
            own[2 * t + g:2 * t + 2 * g] = np.maximum(up[2 * t + g:2 * t + 2 * g], up[2 * t:2 * t + g])    # tokens above
    kids = np.array([len(x.kids) for x in nodes], dtype=np.float64)
    at = np.zeros(n)
    before, after, alike = np.zeros(n), np.zeros(n), np.zeros(n)
    for x in nodes:
        rows = [place[id(c)] for c in x.kids]
        tags = Counter(c.tag for c in x.kids)
        for j, r in enumerate(rows):
            at[r] = j / max(1, len(rows) - 1)
            before[r] = total["text"][rows[j - 1]] if j else 0
            after[r] = total["text"][rows[j + 1]] if j + 1 < len(rows) else 0
            alike[r] = tags[nodes[r].tag] / len(rows)
    whole = max(total["text"][0], 1)
    c = 2 * t + 2 * g
    some = np.maximum(total["text"], 1)
    columns = [
        depth, height, kids, np.log1p(count), np.log1p(text), np.log1p(total["text"]), np.log1p(total["words"]), total["text"] / whole,
        total["link"] / some, link / np.maximum(text, 1), total["stops"] / np.maximum(total["words"], 1), stops / np.maximum(words, 1),
        total["text"] / count, np.log1p(paragraphs), paragraphs / count, at, np.log1p(before), np.log1p(after), alike,
        kids[parent], np.log1p(total["text"][parent]), (total["link"] / some)[parent]]
    for k, v in enumerate(columns):
        out[:, c + k] = v
    return out


def decode(nodes: list[Node], odds: np.ndarray) -> list[bool]:
    """The best set of nodes in which every node's parent is in too."""
    best = [0.0] * len(nodes)
    place = {id(x): i for i, x in enumerate(nodes)}
    for i in range(len(nodes) - 1, -1, -1):
        best[i] = max(0.0, float(odds[i]) + sum(best[place[id(c)]] for c in nodes[i].kids))
    kept = [False] * len(nodes)
    for i, x in enumerate(nodes):
        kept[i] = best[i] > 0 and (x.parent is None or kept[place[id(x.parent)]])
    return kept


def text_of(nodes: list[Node], kept: list[bool]) -> str:
    """The kept blocks' text in page order, a block on each line."""
    keep = {id(x) for x, k in zip(nodes, kept) if k}
    out, todo = [], [nodes[0]]
    while todo:
        x = todo.pop()
        if not isinstance(x, Node):
            out.append(x)
        elif id(x) in keep:
            todo.extend(reversed(x.order))
    return "\n".join(out)


# -- trees ---------------------------------------------------------------------

def grow(x: np.ndarray, y: np.ndarray) -> dict:
    """Boosted trees for log odds: Newton steps on binned features."""
    edges = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, BINS + 1)[1:-1])) for f in range(x.shape[1])]
    binned = np.stack([np.searchsorted(e, x[:, f], side="left") for f, e in enumerate(edges)], axis=1)
    base = float(np.log((y.sum() + 1) / (len(y) - y.sum() + 1)))
    odds, trees = np.full(len(y), base), []
    for _ in range(TREES):
        p = 1 / (1 + np.exp(-odds))
        grad, hess = y - p, np.maximum(p * (1 - p), 1e-6)
        size = 2 ** DEPTH
        feature, cut = np.zeros(size, dtype=np.int64), np.full(size, np.inf)
        at = np.ones(len(y), dtype=np.int64)
        for level in range(DEPTH):
            first, width = 2 ** level, 2 ** level
            best = np.full(width, 1e-3)
            choice = [(0, None)] * width
            for f, e in enumerate(edges):
                if not len(e):
                    continue
                cell = (at - first) * (BINS + 1) + binned[:, f]
                gs = np.bincount(cell, grad, width * (BINS + 1)).reshape(width, -1).cumsum(1)
                hs = np.bincount(cell, hess, width * (BINS + 1)).reshape(width, -1).cumsum(1)
                g, h = gs[:, -1:], hs[:, -1:]
                gain = gs ** 2 / (hs + 1) + (g - gs) ** 2 / (h - hs + 1) - g ** 2 / (h + 1)
                gain = gain[:, :len(e)]
                for k in range(width):
                    b = int(gain[k].argmax())
                    if gain[k, b] > best[k]:
                        best[k], choice[k] = gain[k, b], (f, e[b])
            for k, (f, c) in enumerate(choice):
                if c is not None:
                    feature[first + k], cut[first + k] = f, c
            at = 2 * at + (x[np.arange(len(y)), feature[at]] > cut[at])
        g, h = np.bincount(at - size, grad, size), np.bincount(at - size, hess, size)
        leaf = RATE * g / (h + 1)
        odds = odds + leaf[at - size]
        trees.append((feature, cut, leaf))
    return {"base": base, "trees": trees}


def log_odds(model: dict, x: np.ndarray) -> np.ndarray:
    out, rows = np.full(len(x), model["base"]), np.arange(len(x))
    for feature, cut, leaf in model["trees"]:
        at = np.ones(len(x), dtype=np.int64)
        for _ in range(DEPTH):
            at = 2 * at + (x[rows, feature[at]] > cut[at])
        out += leaf[at - len(leaf)]
    return out


# -- training pages ------------------------------------------------------------

class Layouts:
    """Pages with known labels: blocks of the article carry ``data-kept``."""

    def __init__(self, words: list[str], seed: int = 7):
        self.words, self.rng = words, np.random.default_rng(seed)

    def pick(self, *options):
        return options[int(self.rng.integers(len(options)))]

    def chance(self, p: float) -> bool:
        return bool(self.rng.random() < p)

    def say(self, low: int, high: int) -> str:
        n = int(self.rng.integers(low, high + 1))
        return " ".join(html.escape(self.words[i], quote=False) for i in self.rng.integers(len(self.words), size=n))

    def wrap(self, names: str, inner: str) -> str:
        """``inner`` in one of the named elements (tag, or tag.class)."""
        tag, _, name = self.pick(*names.split()).partition(".")
        own = f' {self.pick("class", "class", "id")}="{name}"' if name else ""
        return f"<{tag}{own}>{inner}</{tag}>"

    def links(self, low: int, high: int, plain: bool = False) -> str:
        items = [f'<a href="/{i}">{self.say(1, 5)}</a>' for i in range(int(self.rng.integers(low, high + 1)))]
        if plain:
            return self.pick(" | ", " ").join(items)
        return "<ul>" + "".join(f"<li>{x}" + ("</li>" if self.chance(0.9) else "") for x in items) + "</ul>"

    def article(self) -> str:
        tiny = self.chance(0.1)

        def p():
            low, high = (1, 2) if tiny else self.pick((1, 6), (5, 30), (20, 90), (60, 200))
            body = self.say(low, high)
            if self.chance(0.15):
                body = f"<b>{body}" + self.pick("</b>", "", "<br>")
            if self.chance(0.1):
                body += f' <a href="#">{self.say(1, 3)}</a> {self.say(2, 8)}'
            return f"<p data-kept>{body}" + ("</p>" if self.chance(0.9) else "")
        parts = [f"<h1 data-kept>{self.say(1, 2 if tiny else 10)}</h1>"] if self.chance(0.85) else []
        for _ in range(int(self.pick(1, 1, 2, 4, 7, 12))):
            kind = self.rng.random()
            if kind < 0.8:
                parts.append(p())
            elif kind < 0.86:
                parts.append(f"<h2 data-kept>{self.say(1, 6)}</h2>")
            elif kind < 0.91:
                parts.append("<ul>" + "".join(f"<li data-kept>{self.say(2, 20)}</li>" for _ in range(4)) + "</ul>")
            elif kind < 0.95:
                parts.append(f"<blockquote data-kept>{self.say(5, 40)}</blockquote>")
            else:
                parts.append(f"<div data-kept>{self.say(10, 80)}</div>")
        for _ in range(int(self.chance(0.25)) + int(self.chance(0.1))):
            parts.insert(int(self.rng.integers(1, len(parts) + 1)), self.aside())
        body = "".join(parts)
        body = self.wrap("article article article article.post main div.content div.entry-content div.post-body div.article-body section.story div "
                         "div.main-content section", body)
        if self.chance(0.4):
            body = self.wrap("main div.container div section div.wrapper div.main", body)
        return body

    def aside(self) -> str:
        kind = int(self.rng.integers(9))
        if kind == 0:
            return self.wrap("div.ad div.ads div.advert aside.sponsored div.promo section.advertisement div.ad-banner", self.pick(
                self.say(3, 30), f"<p>{self.say(3, 30)}</p>", f'<a href="#">{self.say(3, 12)}</a>'))
        if kind == 1:
            return self.wrap("aside aside.sidebar div.sidebar div.widget section.widget", f"<h3>{self.say(1, 4)}</h3>" + self.pick(
                self.links(2, 7), f"<p>{self.say(5, 40)}</p>"))
        if kind == 2:
            return self.wrap("div.cookie-notice div.cookie-consent div.notice div.alert section.gdpr div.popup", self.pick(
                f"<p>{self.say(5, 40)}</p><button>{self.say(1, 2)}</button>", self.say(5, 30), f"<p>{self.say(5, 30)}</p>"))
        if kind == 3:
            each = "".join(self.wrap("div.comment li.comment article.comment div p", self.pick(
                f"<p>{self.say(3, 60)}</p>", f"<b>{self.say(1, 2)}</b><p>{self.say(3, 60)}</p>", self.say(3, 40))) for _ in range(int(self.rng.integers(1, 6))))
            return self.wrap("section.comments div.comments div.comment-list ol.comments div.discussion", f"<h3>{self.say(1, 3)}</h3>" * self.chance(0.6) + each)
        if kind == 4:
            return self.wrap("form form.search form.newsletter div.newsletter div.subscribe form.login", f"<label>{self.say(1, 6)}</label><input type=text>"
                             f"<button>{self.say(1, 2)}</button>" + f"<p>{self.say(4, 20)}</p>" * self.chance(0.4))
        if kind == 5:
            return self.wrap("div.related section.related aside.more div.recommended div.trending", f"<h3>{self.say(1, 4)}</h3>" + self.links(2, 8))
        if kind == 6:
            return self.wrap("div.share ul.social div.social-buttons div.follow", self.links(2, 5, True))
        if kind == 7:
            return self.wrap("div.breadcrumb nav.breadcrumbs nav div.pagination ul.menu div.nav", self.links(2, 6, self.chance(0.5)))
        return self.wrap("div.promo aside div.banner", f"<p>{self.say(4, 25)}</p>")

    def page(self) -> str:
        parts = []
        if self.chance(0.35):
            parts.append(self.wrap("header header.site-header div.header div.masthead", self.pick(
                f"<div>{self.say(1, 4)}</div>", f"<h1>{self.say(1, 4)}</h1><p>{self.say(2, 10)}</p>", f'<a href="/">{self.say(1, 3)}</a>')
                + (self.wrap("nav ul.menu", self.links(2, 7)) if self.chance(0.4) else "")))
        if self.chance(0.8):
            parts.append(self.wrap("nav nav nav div.menu div.navbar nav.navigation div.nav", self.links(2, 9, self.chance(0.2))))
        for _ in range(int(self.rng.integers(0, 3))):
            parts.append(self.aside())
        if self.chance(0.4):
            parts.append(f'<div class="ad">{self.say(3, 25)}</div>')
        parts.append(self.article())
        for _ in range(int(self.rng.integers(0, 4))):
            parts.append(self.aside())
        if self.chance(0.8):
            parts.append(self.wrap("footer footer footer div.footer div.copyright footer.site-footer", self.pick(
                f"&copy; {self.say(1, 3)} &middot; {self.say(2, 14)}", f"<p>&copy; {self.say(1, 12)}</p>", self.links(2, 6, True) + f"<p>{self.say(2, 20)}</p>")))
        return "<!DOCTYPE html><html><head><title>t</title></head><body>" + "".join(parts) + self.pick("</body></html>", "")


def training_rows(words: list[str], pages: int = TRAINING_PAGES) -> tuple[np.ndarray, np.ndarray]:
    made, xs, ys = Layouts(words), [], []
    for _ in range(pages):
        nodes = parse(made.page())
        kept = {id(n): "data-kept" in n.attrs for n in nodes}
        for n in reversed(nodes):
            if n.parent is not None and kept[id(n)]:
                kept[id(n.parent)] = True
        xs.append(features(nodes))
        ys.append(np.array([kept[id(n)] for n in nodes], dtype=np.float64))
    return np.concatenate(xs), np.concatenate(ys)


_SPARE = ["the", "of", "and", "to", "in", "it", "is", "was", "that", "with", "morning", "river", "people", "letter.", "over,", "small"]


def fit(pages: DataFrame) -> dict:
    """Trees trained on generated pages with the words of ``SAMPLE`` pages
    (those of the smallest hash of page_id)."""
    rows = pages.filter("html is not null").select(
        F.xxhash64(F.lit("dom"), "page_id").alias("k"), F.substring("html", 1, 20000).alias("h"))
    # the hashes are chosen before any text comes to the driver
    keys = [r.k for r in rows.select("k").distinct().orderBy("k").limit(SAMPLE).collect()]
    rows = rows.filter(F.col("k").isin(keys)).groupBy("k").agg(F.min("h").alias("h")).collect()
    words = [w for r in rows for n in parse(r.h) for t in n.order if not isinstance(t, Node) for w in t.split()]
    return grow(*training_rows(sorted(words) or _SPARE))


def extract(pages: DataFrame, model: dict | None = None) -> DataFrame:
    """page_id, url, text and n_chars (code points) of each row of ``pages
    (page_id, url, html)``.

    * null or empty html, or no article: text is empty, n_chars 0;
    * broken markup: unclosed elements end where HTML lets them;
    * null page_id or url: returned as they are; repeated rows: each returned;
    * extra columns are not read; an empty table gives an empty result.
    """
    model = model or fit(pages)

    def run(batches):
        for batch in batches:
            source, texts = batch.column("html").to_pylist(), []
            for a in range(0, len(source), 64):
                trees = [parse(s or "") for s in source[a:a + 64]]
                rows = [features(t) for t in trees]
                odds = np.split(log_odds(model, np.concatenate(rows)), np.cumsum([len(r) for r in rows])[:-1])
                texts += [text_of(t, decode(t, o)) for t, o in zip(trees, odds)]
            yield pa.RecordBatch.from_pydict({
                "page_id": batch.column("page_id").cast(pa.int64()), "url": batch.column("url"),
                "text": pa.array(texts, type=pa.string()), "n_chars": pa.array([len(t) for t in texts], type=pa.int64())})

    return pages.select("page_id", "url", "html").mapInArrow(run, "page_id long, url string, text string, n_chars long")
