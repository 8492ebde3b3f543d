"""Main text of web pages by gradient-boosted trees over the nodes of their trees, decoded from the top down.

Pages are parsed into nodes. A node's features are its tag's kind, words of its tag, class, id and role (hashed tokens), its
depth and place, the text, links, paragraphs and tags below it, its text in proportion to its tags, parent and page, and
the same of its neighbours. Boosted trees tell main-text nodes from boilerplate; the page's log-odds then go down the tree:
a node that is rejected takes its subtree along, and the subtrees that give the largest sum of log-odds are kept, so no
descendant contradicts an ancestor.

A sentence is never cut: a link, a bold word or another inline element takes the verdict of the block whose running text it
stands in, and only elements that lay out a page (blocks, and inline ones that stand alone) are judged. A container that
is rejected weighs on what lies in it: its negative log-odds are added to theirs.

There are no labelled pages. The trees learn from nodes that their own markup declares: semantic containers (article, main
and what lies in them; nav, header, footer, aside, forms, scripts and elements named as adverts, menus, comments and so
on). What the markup declares is the label only: a node's features never say it, and in a share ``MASKED`` of the examples
tag and attributes are masked as a whole, so that the trees also learn density, links, depth and neighbours and find the
main text of pages whose markup declares nothing. They are fitted on the nodes of at most ``TRAIN_PAGES`` different pages,
those of lowest hash, and on each of these pages written again in other forms (``varied``): its main text as lists, tables,
quotes, definitions, figures, sections and plain divs with links in the sentences, with asides, adverts, comments, forms and
menus between its blocks and around it.

Text is the kept nodes' text with character references decoded, white space inside a block made one space, trimmed, and
blocks joined by an empty line in page order; nothing is dropped or capped beyond the rejected nodes. A null or empty page,
or one without main text, gives an empty text. Text outside any element counts as the body's. Equal pages give equal texts;
an empty table gives an empty table; other columns are ignored.
"""

from __future__ import annotations

import html
import re
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from placemetrics.llm.common import slices, table

TRAIN_PAGES = 400
TREES, LEAVES_DEPTH, RATE, BINS, DRAWN = 60, 5, 0.3, 32, 0.5
MASKED = 0.5
TOKENS = 128

# Fixed values of HTML and of how sites name their parts.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCK = frozenset(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form frameset h1 h2 h3 h4 h5 h6 "
    "header hr html legend li main menu nav ol option p pre section select summary table tbody td tfoot th thead tr ul".split()
)
HIDDEN = frozenset("head script style noscript template iframe object svg title textarea select button canvas audio video".split())
RAW = frozenset("script style textarea title noscript iframe xmp".split())
MAIN = frozenset("article main".split())
ASIDE = frozenset("nav header footer aside form menu dialog button select".split())
#: Names that a page written again gives to boilerplate and to the container of its main text; fixed values of the same kind.
NOISE_NAMES = (
    "ad ads advert advertisement sponsor sponsored promo banner cookie-notice consent notice menu navigation breadcrumbs sidebar footer header masthead "
    "share social comments comment reply related recommended newsletter subscribe popup modal login search pager pagination widget"
).split()
GOOD_NAMES = "content main-content article article-body post post-body entry entry-content story body-text".split()
KINDS = ("p", "div", "li", "ul", "a", "h1", "h2", "h3", "table", "td", "section", "span", "b", "blockquote", "pre", "article", "main", "nav", "header", "footer", "aside", "form")
NOISE = re.compile(
    r"(?:^|[\W_])(?:ads?|advert\w*|sponsor\w*|promo\w*|banner|cookie\w*|consent|notice|menu|nav\w*|breadcrumbs?|side-?bar|footer|header|masthead|share|social|comments?|disqus|reply|replies|related|recommend\w*|newsletter|subscribe|popup|modal|login|search|pager|pagination|widget)(?:$|[\W_])"
)
GOOD = re.compile(r"(?:^|[\W_])(?:article\w*|main\w*|content|post\w*|entry\w*|story|body-?text)(?:$|[\W_])")
CLOSES = {"p": BLOCK - {"li", "dd", "dt", "td", "th", "tr", "tbody", "thead", "tfoot", "option", "body", "html", "legend", "summary", "figcaption"}, "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr"}, "td": {"td", "th", "tr"}, "th": {"td", "th", "tr"}, "option": {"option"}}

_TAG = re.compile(r"<(?:!--(.*?)(?:-->|\Z)|([!?])[^>]*(?:>|\Z)|(/?)([a-zA-Z][^\s/>]*)((?:=\s*(?:\"[^\"]*\"|'[^']*')|[^>])*+)(>|\Z))", re.S)
_ATTRIBUTE = re.compile(r"""\b(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
_HEAD_TAGS = frozenset("base link meta title style script noscript template".split())


@lru_cache(maxsize=4096)
def _tokens(tag: str, names: str) -> tuple[str, ...]:
    return (f"<{tag}>", *re.findall(r"[a-z]+", names))


@lru_cache(maxsize=4096)
def _marks(tag: str, names: str) -> np.ndarray:
    """Which kind the tag is, and the hashed tokens of tag and names."""
    out = np.zeros(len(KINDS) + TOKENS)
    if tag in KINDS:
        out[KINDS.index(tag)] = 1
    for token in _tokens(tag, names):
        out[len(KINDS) + zlib.crc32(token.encode()) % TOKENS] = 1
    return out


class Page:
    """Nodes of a page in order: tag, parent, names (class, id and role), and the text chunks with the node that holds each."""

    def __init__(self, source: str):
        self.tags, self.parents, self.names = ["body"], [-1], [""]
        self.texts: list[tuple[int, str]] = []
        self.breaks: list[int] = []  # number of text chunks before each block boundary
        stack, at, n = [0], 0, len(source)
        while at < n:
            m = _TAG.search(source, at)
            if not m:
                self._text(stack[-1], source[at:])
                break
            if m.start() > at:
                self._text(stack[-1], source[at : m.start()])
            at = m.end()
            tag = m[4]
            if tag is None or not m[6]:
                continue  # a comment, a declaration, or a tag that the page's end cuts off
            tag = tag.lower()
            if m[3]:
                if tag in BLOCK:
                    self.breaks.append(len(self.texts))
                for i in range(len(stack) - 1, 0, -1):
                    if self.tags[stack[i]] == tag:
                        del stack[i:]
                        break
                    if tag not in BLOCK and self.tags[stack[i]] in BLOCK:
                        break  # an inline end tag does not close a block
                continue
            if tag in ("html", "body"):
                continue
            if self.tags[stack[-1]] == "head" and tag not in _HEAD_TAGS:
                stack.pop()
            for i in range(len(stack) - 1, 0, -1):
                open_ = self.tags[stack[i]]
                if tag in CLOSES.get(open_, ()):
                    del stack[i:]
                    break
                if open_ in ("table", "ul", "ol", "dl", "article", "section", "div", "main", "td", "aside", "nav", "footer", "header"):
                    break
            if tag in BLOCK:
                self.breaks.append(len(self.texts))
            self.tags.append(tag)
            self.parents.append(stack[-1])
            self.names.append(" ".join(a or b or c for _, a, b, c in _ATTRIBUTE.findall(m[5])).lower() if m[5] else "")
            if tag in RAW:
                end = re.compile(rf"</{tag}[\s/>]", re.I).search(source, at)
                at = (source.find(">", end.end() - 1) + 1 or n) if end else n  # never shown, so its text is not kept
            elif tag == "br":
                self.texts.append((stack[-1], " "))
            elif tag not in VOID and not m[5].endswith("/"):
                stack.append(len(self.tags) - 1)

    def _text(self, node: int, raw: str) -> None:
        self.texts.append((node, html.unescape(raw) if "&" in raw else raw))

    def features(self, evidence: dict[str, float]) -> np.ndarray:
        """A row for each node; ``evidence`` is the log-odds of tokens in the nodes that the trees learned from."""
        n = len(self.tags)
        parent = np.array(self.parents)
        text, words, tags, links, paragraphs, commas = (np.zeros(n) for _ in range(6))
        for node, t in self.texts:
            text[node] += len(t)
            words[node] += t.count(" ")
            commas[node] += t.count(",") + t.count(".")
        own = text.copy()
        depth, nth, children = np.zeros(n), np.zeros(n), np.zeros(n)
        for i in range(1, n):
            p = self.parents[i]
            depth[i], nth[i] = depth[p] + 1, children[p]
            children[p] += 1
            paragraphs[i] = self.tags[i] == "p"
            links[i] = text[i] * (self.tags[i] == "a")
        for i in range(n - 1, 0, -1):
            p = self.parents[i]
            text[p] += text[i]
            words[p] += words[i]
            commas[p] += commas[i]
            tags[p] += tags[i] + 1
            links[p] += max(links[i], 0.0) if self.tags[i] != "a" else text[i]
            paragraphs[p] += paragraphs[i]
        up = np.maximum(parent, 0)
        density, link = text / (tags + 1), links / (text + 1)
        before, after = np.zeros((n, 3)), np.zeros((n, 3))
        last: dict[int, int] = {}
        shape = np.stack([np.log1p(text), link, np.log1p(density)], axis=1)
        for i in range(1, n):
            p = self.parents[i]
            if p in last:
                before[i], after[last[p]] = shape[last[p]], shape[i]
            last[p] = i
        columns = [depth, nth, children, children[up], np.log1p(own), np.log1p(text), np.log1p(words), np.log1p(tags), link, link[up], np.log1p(paragraphs),
                   np.log1p(density), text / (text[up] + 1), text / (text[0] + 1), np.log1p(commas), commas / (words + 1), np.arange(n) / n, np.log1p(density)[up],
                   text / (text[up[up]] + 1), link[up[up]], np.log1p(tags)[up], np.log1p(text)[up], own / (text + 1)]
        named, lowest, above = np.zeros(n), np.zeros(n), np.zeros(n)
        for i in range(1, n):
            tag, *rest = (evidence.get(t, 0.0) for t in _tokens(self.tags[i], self.names[i]))
            named[i], lowest[i], above[i] = sum(rest), min(tag, *rest, 0.0), min(above[self.parents[i]], lowest[self.parents[i]])
        own_marks = np.stack([_marks(tag, name) for tag, name in zip(self.tags, self.names, strict=True)])
        tokens = own_marks[:, len(KINDS) :].copy()
        for level in range(2, int(depth.max()) + 1):  # an ancestor's tokens count half
            at = np.flatnonzero(depth == level)
            tokens[at] = np.maximum(tokens[at], 0.5 * (tokens[parent[at]] > 0))
        return np.hstack([np.stack(columns, axis=1), before, after, np.stack([named, lowest, above], axis=1), own_marks[:, : len(KINDS)], tokens])

    def judged(self) -> np.ndarray:
        """For each node the node whose verdict it takes: its own, or that of the block in whose running text it stands."""
        n = len(self.tags)
        lays_out, mixed, said = [t in BLOCK or t in HIDDEN for t in self.tags], [False] * n, [False] * n
        for node, t in self.texts:
            said[node] = said[node] or bool(t.strip())
        for i in range(n - 1, 0, -1):
            if lays_out[i] and self.tags[i] not in HIDDEN:
                lays_out[self.parents[i]] = mixed[self.parents[i]] = True
        out = np.arange(n)
        for i in range(1, n):
            p = self.parents[i]
            if not lays_out[i] and p and (out[p] != p or said[p] or not mixed[p]):
                out[i] = out[p]
        return out

    def settled(self, odds: np.ndarray) -> np.ndarray:
        """Log-odds in which inline elements follow their block and rejected containers weigh on what lies in them."""
        out, judge = odds.copy(), self.judged()
        for i in range(1, len(out)):
            p = self.parents[i]
            out[i] = out[judge[i]] if judge[i] != i else out[i] + (min(0.0, out[p]) if p else 0.0)
        return out

    def declared(self) -> np.ndarray:
        """1, 0 or -1 for nodes that the markup declares main text or boilerplate, or says nothing about."""
        out = np.full(len(self.tags), -1)
        for i in range(1, len(self.tags)):
            tag, name, above = self.tags[i], f" {self.names[i]} ", out[self.parents[i]]
            if above == 0 or tag in HIDDEN or (tag in ASIDE and not (tag == "header" and above == 1)) or (name != "  " and NOISE.search(name)):
                out[i] = 0
            elif above == 1 or tag in MAIN or GOOD.search(name):
                out[i] = 1
        return out

    def extract(self, odds: np.ndarray) -> str:
        """Text of the kept nodes. A node's worth is its log-odds times its own text; a subtree is kept if its best worth is above 0."""
        n = len(self.tags)
        own = np.zeros(n)
        for node, t in self.texts:
            own[node] += len(t.strip())
        best = odds * own
        for i in range(n - 1, 0, -1):
            if self.tags[i] in HIDDEN:
                best[i] = 0.0
            elif best[i] > 0:
                best[self.parents[i]] += best[i]
        kept = np.zeros(n, dtype=bool)
        shown = np.zeros(n, dtype=bool)
        kept[0], shown[0] = True, odds[0] > 0
        for i in range(1, n):
            kept[i] = kept[self.parents[i]] and best[i] > 0 and self.tags[i] not in HIDDEN
            # a kept container shows its own text only if it is itself main text
            shown[i] = kept[i] and odds[i] > 0
        return "\n\n".join(self.blocks(shown))

    def blocks(self, shown: np.ndarray) -> list[str]:
        """The text of the shown nodes, block by block."""
        blocks, block, k = [], [], 0
        for number, (node, t) in enumerate(self.texts):
            if k < len(self.breaks) and self.breaks[k] <= number:
                blocks.append("".join(block))
                block = []
                while k < len(self.breaks) and self.breaks[k] <= number:
                    k += 1
            if shown[node]:
                block.append(t)
        blocks.append("".join(block))
        return [b for b in (" ".join(b.split()) for b in blocks) if b]


class _Grower:
    """Grows trees over dense columns, binned at their quantiles, and marks, which are 0, a half (an ancestor's) or 1 (the node's own)."""

    def __init__(self, x: np.ndarray, marks: int):
        self.x, self.dense, self.marks = x, x.shape[1] - marks, marks
        self.edges = np.quantile(x[:, : self.dense], np.linspace(0, 1, BINS + 1)[1:-1], axis=0)
        codes = [np.searchsorted(self.edges[:, f], x[:, f], side="left") + f * BINS for f in range(self.dense)]
        self.codes = np.stack(codes, axis=1)
        held = np.hstack([x[:, self.dense :] > 0, x[:, self.dense :] > 0.5])
        live = np.flatnonzero(held.any(axis=0))
        self.held = held[:, live].astype(np.float32)
        cuts = np.arange(self.dense * (BINS - 1))
        self.feature = np.concatenate([cuts // (BINS - 1), self.dense + live % marks])
        self.limit = np.concatenate([self.edges.T.ravel(), 0.5 * (live // marks)])

    def _above(self, rows: np.ndarray, weights: np.ndarray) -> np.ndarray:
        """For each row of weights, their sum over the rows above each cut; the sum of all at the end."""
        codes, weights = self.codes[rows].ravel(), weights[:, rows]
        each = np.stack([np.bincount(codes, np.repeat(w, self.dense), self.dense * BINS) for w in weights]).reshape(len(weights), self.dense, BINS)
        over = (each.sum(axis=2, keepdims=True) - np.cumsum(each, axis=2))[:, :, :-1].reshape(len(weights), -1)
        return np.hstack([over, weights.astype(np.float32) @ self.held[rows], weights.sum(axis=1, keepdims=True)])

    def grow(self, rows: np.ndarray, g: np.ndarray, h: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Feature and limit of each inner node, value of each leaf."""
        inner, weights = (1 << depth) - 1, np.stack([g, h])
        feature, limit, value = np.zeros(inner, dtype=int), np.full(inner, np.inf), np.zeros(1 << depth)
        parts: list[np.ndarray] = [rows] + [rows[:0]] * (2 * inner)
        sums: dict[int, np.ndarray] = {0: self._above(rows, weights)}
        for node in range(inner):
            at = parts[node]
            if len(at) >= 20:
                a, b = sums[node][:, :-1]
                total_g, total_h = sums[node][:, -1]
                gain = a**2 / (b + 1) + (total_g - a) ** 2 / (total_h - b + 1) - total_g**2 / (total_h + 1)
                k = int(gain.argmax())
                if gain[k] > 1e-6:
                    feature[node], limit[node] = self.feature[k], self.limit[k]
            over = self.x[at, feature[node]] > limit[node]
            low, high = 2 * node + 1, 2 * node + 2
            parts[low], parts[high] = at[~over], at[over]
            if high < inner and node in sums:
                small, large = (low, high) if len(parts[low]) < len(parts[high]) else (high, low)
                sums[small] = self._above(parts[small], weights)  # the larger part has the rest
                sums[large] = sums[node] - sums[small]
            sums.pop(node, None)
        for leaf in range(1 << depth):
            at = parts[inner + leaf]
            value[leaf] = g[at].sum() / (h[at].sum() + 1)
        return feature, limit, value


class Boosted:
    """Trees over real-valued features, each grown on a share ``DRAWN`` of the training rows."""

    def __init__(self, x: np.ndarray, y: np.ndarray, evidence: dict[str, float], seed: int = 7):
        self.evidence = evidence
        rng, grower = np.random.default_rng(seed), _Grower(x, len(KINDS) + TOKENS)
        self.start = float(np.log((y.sum() + 1) / (len(y) - y.sum() + 1)))
        z, self.trees = np.full(len(y), self.start), []
        for _ in range(TREES):
            p = 1 / (1 + np.exp(-z))
            feature, limit, value = grower.grow(np.flatnonzero(rng.random(len(y)) < DRAWN), y - p, p * (1 - p), LEAVES_DEPTH)
            self.trees.append((feature, limit, RATE * value))
            z += self._one(x, *self.trees[-1])

    @staticmethod
    def _one(x: np.ndarray, feature: np.ndarray, limit: np.ndarray, value: np.ndarray) -> np.ndarray:
        node, rows = np.zeros(len(x), dtype=int), np.arange(len(x))
        for _ in range(LEAVES_DEPTH):
            node = 2 * node + 1 + (x[rows, feature[node]] > limit[node])
        return value[node - len(feature)]

    def log_odds(self, x: np.ndarray) -> np.ndarray:
        return self.start + sum(self._one(x, *t) for t in self.trees)


def _pieces(words: list[str], rng: np.random.Generator, mean: int) -> list[str]:
    """These words as runs of about ``mean`` words."""
    out, at = [], 0
    while at < len(words):
        n = 1 + int(rng.poisson(mean))
        out.append(" ".join(words[at : at + n]))
        at += n
    return out


def _linked(text: str, rng: np.random.Generator) -> str:
    """A sentence with some runs of words in links and other inline elements."""
    out = []
    for piece in _pieces(text.split(), rng, 9):
        tag = rng.choice(["", "", "a", "em", "strong", "span", "code"])
        out.append(piece if not tag else f'<a href="/{len(out)}">{piece}</a>' if tag == "a" else f"<{tag}>{piece}</{tag}>")
    return " ".join(out)


def _written(text: str, rng: np.random.Generator) -> str:
    """A block of main text in one of many forms."""
    words = text.split()
    form = rng.choice("p p linked div div divs list items table quote pre terms figure section details lines".split())
    if form == "linked":
        return f"<p>{_linked(text, rng)}</p>"
    if form == "div":
        return f"<div>{_linked(text, rng)}</div>"
    if form == "divs":
        return "<div>" + "".join(f"<div>{_linked(x, rng)}</div>" for x in _pieces(words, rng, 25)) + "</div>"
    if form in ("list", "items"):
        tag, each = ("ul", "ol")[int(rng.integers(2))], int(rng.choice([3, 12]))
        inner = "".join(f"<li>{_linked(x, rng) if form == 'items' else x}</li>" for x in _pieces(words, rng, each))
        return f"<{tag}>{inner}</{tag}>"
    if form == "table":
        cells = _pieces(words, rng, int(rng.choice([2, 6])))
        return "<table>" + "".join("<tr>" + "".join(f"<td>{c}</td>" for c in cells[i : i + 3]) + "</tr>" for i in range(0, len(cells), 3)) + "</table>"
    if form == "quote":
        return f"<blockquote><p>{text}</p></blockquote>"
    if form == "pre":
        return f"<pre>{text}</pre>"
    if form == "terms":
        return "<dl>" + "".join(f"<dt>{x.split()[0]}</dt><dd>{x}</dd>" for x in _pieces(words, rng, 10)) + "</dl>"
    if form == "figure":
        return f'<figure><img src="f.png"><figcaption>{" ".join(words[:20])}</figcaption></figure><p>{" ".join(words[20:])}</p>'
    if form == "section":
        head = f"h{rng.integers(2, 5)}"
        return f"<section><{head}>{' '.join(words[:4])}</{head}><p>{' '.join(words[4:])}</p></section>"
    if form == "details":
        return f"<details><summary>{' '.join(words[:5])}</summary><p>{' '.join(words[5:])}</p></details>"
    if form == "lines":
        return "<p>" + "<br>".join(_pieces(words, rng, 15)) + "</p>"
    return f"<p>{text}</p>"


def _unwanted(words: list[str], rng: np.random.Generator) -> str:
    """A menu, notice, advert, form, sidebar or thread of comments made of a page's words."""
    at = int(rng.integers(max(1, len(words) - 40)))
    few = words[at : at + int(rng.integers(3, 60))] or ["more"]
    name = NOISE_NAMES[int(rng.integers(len(NOISE_NAMES)))]
    tag = rng.choice(["div", "div", "div", "section", "aside", "aside", "nav", "form", "footer"])
    body = {
        "links": "<ul>" + "".join(f'<li><a href="/{i}">{x}</a></li>' for i, x in enumerate(_pieces(few, rng, 1))) + "</ul>",
        "row": " ".join(f'<a href="/{i}">{x}</a>' for i, x in enumerate(_pieces(few, rng, 1))),
        "text": " ".join(few),
        "paragraphs": "".join(f"<p>{x}</p>" for x in _pieces(few, rng, 15)),
        "thread": "".join(f"<div><b>{x.split()[0]}</b><p>{x}</p></div>" for x in _pieces(few, rng, 12)),
        "head": f"<h3>{few[0]}</h3><p>{' '.join(few[1:])}</p>",
        "items": "<ul>" + "".join(f"<li>{x}</li>" for x in _pieces(few, rng, 8)) + "</ul>",
    }[str(rng.choice("links links row text paragraphs thread head items".split()))]
    return f'<{tag} class="{name}">{body}</{tag}>' if tag in ("div", "section") or rng.random() < 0.5 else f"<{tag}>{body}</{tag}>"


def varied(source: str, rng: np.random.Generator) -> str | None:
    """The page's declared main text written in other forms, with boilerplate of its words around and inside it."""
    page = Page(source)
    main = [html.escape(b, quote=False) for b in page.blocks(page.declared() == 1)]
    if not main:
        return None
    words = " ".join(main).split()
    body = []
    for b in main:
        body.append(f"<h1>{b}</h1>" if not body and rng.random() < 0.5 else _written(b, rng))
        if rng.random() < 0.4:
            body.append(_unwanted(words, rng))
    inner = "".join(body) + "".join(_unwanted(words, rng) for _ in range(int(rng.integers(2))))
    good = GOOD_NAMES[int(rng.integers(len(GOOD_NAMES)))]
    tag = str(rng.choice(["article", "main", "div", "section"]))
    inner = f'<{tag} class="{good}">{inner}</{tag}>' if tag in ("div", "section") or rng.random() < 0.3 else f"<{tag}>{inner}</{tag}>"
    before, after = ("".join(_unwanted(words, rng) for _ in range(int(rng.integers(4)))) for _ in range(2))
    around = f"{before}{inner}{after}"
    for _ in range(int(rng.integers(3))):
        around = f"<div>{around}</div>"
    return f"<html><head><title>{words[0]}</title></head><body>{around}</body></html>"


def train(pages: list[str], seed: int = 5) -> Boosted | None:
    """Trees from the declared nodes of these pages, as given and in other forms; None if nothing is declared either way."""
    rng, rows, counts = np.random.default_rng(seed), [], {}
    for source in [form for given in pages for form in (given, varied(given, rng)) if form]:
        page = Page(source)
        y, main = page.declared(), np.zeros(len(page.tags))
        own = y.copy()
        for node, t in page.texts:
            main[node] += len(t.strip()) * (1 if own[node] == 1 else -1)
        for i in range(len(y) - 1, 0, -1):
            main[page.parents[i]] += main[i]
            if y[i] < 0 and main[i] > 0:
                y[i] = 1  # a container of mostly main text
        y[page.judged() != np.arange(len(y))] = -1
        rows.append((page, own, y))
        for i in np.flatnonzero(y >= 0):
            if y[i] or own[page.parents[i]]:  # what lies in boilerplate says nothing of its own
                for token in _tokens(page.tags[i], page.names[i]):
                    counts.setdefault(token, [0.5, 0.5])[y[i]] += 1
    evidence = {token: float(np.log(one / none)) for token, (none, one) in counts.items()}
    xs, ys = [], []
    for page, own, y in rows:
        x = page.features(evidence)
        # what is declared boilerplate inside main text cannot be told where nothing is declared
        inside = np.array([own[i] == 0 and own[p] == 1 for i, p in enumerate(page.parents)])
        for i in range(1, len(y)):
            inside[i] |= inside[page.parents[i]]
        xs.append(x[y >= 0])
        ys.append(y[y >= 0])
        hide = (rng.random(len(x)) < MASKED) & ~inside & (y >= 0)
        tags = x.shape[1] - len(KINDS) - TOKENS
        x[hide, tags + len(KINDS) :] = 0
        x[hide, tags - 3 : tags] = 0
        x[hide & (rng.random(len(x)) < 0.5), tags : tags + len(KINDS)] = 0
        xs.append(x[hide])
        ys.append(y[hide])
    if not xs or len(set(np.concatenate(ys).tolist())) < 2:
        return None
    return Boosted(np.concatenate(xs), np.concatenate(ys).astype(float), evidence)


def fit(pages: DataFrame, column: str = "html") -> Boosted | None:
    """Fit on at most TRAIN_PAGES pages, those of lowest hash."""
    rows = pages.filter(F.col(column).isNotNull()).select(F.col(column).alias("html")).withColumn("mark", F.xxhash64("html"))
    n = rows.agg(F.approx_count_distinct("mark")).first()[0]
    few = rows.withColumn("draw", F.pmod("mark", F.lit(1 << 30))).filter(F.col("draw") < int(min(1.0, 1.5 * TRAIN_PAGES / max(n, 1)) * (1 << 30)))
    few = few.groupBy("mark", "draw").agg(F.any_value("html").alias("html"))  # copies are one page of the sample
    return train(few.orderBy("draw", "html").limit(TRAIN_PAGES).toArrow()["html"].to_pylist())


def log_odds(pages: list[Page], model: Boosted | None) -> list[np.ndarray]:
    """Of each page's nodes; the trees run over the nodes of all these pages at once."""
    if model is None:
        return [p.declared().astype(float) - 0.5 for p in pages]
    odds = model.log_odds(np.concatenate([p.features(model.evidence) for p in pages]))
    each = np.split(odds, np.cumsum([len(p.tags) for p in pages])[:-1])
    return [p.settled(o) for p, o in zip(pages, each, strict=True)]


def extract(pages: DataFrame, model: Boosted | None, keep: list[str], column: str = "html") -> DataFrame:
    """``keep`` columns and text. Without a model the declared nodes decide."""
    rows = pages.select(*keep, F.col(column).alias("__html"))
    shared = pages.sparkSession.sparkContext.broadcast(model)  # TREES trees

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            for part in slices(batch, "__html", 1 << 20):
                parsed = [Page(t.as_py() or "") for t in part.column("__html")]
                texts = [p.extract(o) for p, o in zip(parsed, log_odds(parsed, shared.value), strict=True)]
                yield pa.RecordBatch.from_arrays([*(part.column(j) for j in range(len(keep))), pa.array(texts, pa.string())], names=[*keep, "text"])

    schema = rows.select(*keep).schema.add("text", "string")
    return rows.mapInArrow(run, schema)


def op4_html_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    return extract(pages, fit(pages), ["page_id", "url"]).withColumn("n_chars", F.length("text").cast("long"))


QUERIES = {"op4_html_extract": op4_html_extract}
SQL: dict[str, str] = {}
