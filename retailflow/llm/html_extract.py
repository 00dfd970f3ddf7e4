"""Main text of web pages with a tree-structured graphical model.

Every block element of a page is a binary variable: its own text is content or not. A
node has a potential from its tag, its names, its text and its links; parent and child
share a potential that depends on the child's tag. Messages pass once from the leaves
to the root and once back (sum-product), which gives each node's exact marginal. Potentials
are trained on labelled pages: pages built from layouts whose blocks are labelled, and
pages of the input that mark their article by tag themselves.
"""

from __future__ import annotations

import html
import random
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from retailflow.llm.common import small_batches

#: Bounds of the training pages: built from layouts, and taken from the input by id hash.
BUILT_PAGES = 400
MARKED_PAGES = 200

# Fixed lists of HTML: elements within a line of text, without content, with raw text, without
# text of the page, and those whose start closes an open paragraph or an open element of their kind.
INLINE = set("a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q rp rt ruby s samp small span strike strong sub sup time tt u var wbr input".split())
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
RAW = set("script style textarea title xmp".split())
ASIDE = set("noscript template iframe svg math select object audio video canvas".split())
NESTED = set("svg math template object".split())
CLOSES_P = set("address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr main menu nav ol p pre section table ul".split())
SIBLINGS = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}, "thead": set(), "tbody": {"thead", "tr", "td", "th"}, "tfoot": {"tbody", "tr", "td", "th"}}
SCOPES = {"li": {"ul", "ol", "menu"}, "dt": {"dl"}, "dd": {"dl"}, "tr": {"table"}, "td": {"table"}, "th": {"table"}, "tbody": {"table"}, "tfoot": {"table"}, "option": {"select"}}

#: Parts of class, id and role names that tell a block's purpose.
NAMES = (
    "nav menu footer header head sidebar side aside widget comment reply respond discuss ad ads advert sponsor promo banner cookie "
    "consent notice alert popup modal newsletter subscribe signup form search login share social related recommend breadcrumb crumb "
    "pager pagination tags meta byline author date copyright legal toolbar skip content article post entry main body text story "
    "section paragraph caption figure quote title headline summary lead intro wrapper container page site row col list item"
).split()

_MARKUP = re.compile(
    r"<!--.*?(?:-->|$)|<!\[CDATA\[.*?(?:\]\]>|$)|<[!?][^>]*(?:>|$)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*'|[\"'])*?)(?:>|$)", re.S
)
_NAMED = re.compile(r"(?:class|id|role|itemprop|aria-label)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
_LABEL = re.compile(r"data-content=\"([01])\"")
_WORDS = re.compile(r"[a-z]+")


@dataclass
class Node:
    """A block element: the text pieces that belong to it and to no block inside it."""

    tag: str
    parent: int
    names: frozenset[str] = frozenset()
    label: int = -1
    #: (place in the page, text) of every run of text.
    runs: list[list] = field(default_factory=list)
    chars: int = 0
    linked: int = 0


@lru_cache(maxsize=256)
def _tags(tag: str) -> re.Pattern:
    return re.compile(rf"<(/?){re.escape(tag)}(?=[\s/>])[^>]*>", re.I)


def subtree_end(page: str, tag: str, at: int, around: str) -> int | None:
    """Where an element without text of the page ends, if its end tag stands inside the element around it.

    None for an element without such an end tag: it is then taken to be empty, so that
    nothing that follows is lost. A further start before the end says the same, except
    for elements that may hold their own kind.
    """
    limit = next((m.start() for m in _tags(around).finditer(page, at) if m[1]), len(page))
    depth = 1
    for mark in _tags(tag).finditer(page, at, limit):
        if mark[1]:
            depth -= 1
            if not depth:
                return mark.end()
        elif tag not in NESTED:
            return None
        elif not mark[0].endswith("/>"):
            depth += 1
    return None


def parse(page: str) -> list[Node]:
    """Block elements of a page in page order, parents before children."""
    nodes = [Node("#page", -1)]
    open_ = [("#page", 0)]  # open elements with the block that holds their text
    links, at, place = 0, 0, 0

    def text(raw: str) -> None:
        nonlocal place
        if not raw:
            return
        node = nodes[open_[-1][1]]
        value = html.unescape(raw) if "&" in raw else raw
        if node.runs and node.runs[-1][0] == place:
            node.runs[-1][1].append(value)
        elif value.strip():
            place += 1
            node.runs.append([place, [value]])
        else:
            return
        size = len(value.strip())
        node.chars += size
        node.linked += size if links else 0

    def close(upto: int) -> None:
        nonlocal links, place
        for tag, _ in open_[upto:]:
            links -= tag == "a"
            if tag not in INLINE:
                place += 1
        del open_[upto:]

    def find(tags: set[str], barrier: set[str]) -> int | None:
        for n in range(len(open_) - 1, 0, -1):
            if open_[n][0] in tags:
                return n
            if open_[n][0] in barrier:
                return None
        return None

    for mark in _MARKUP.finditer(page):
        if mark.start() < at:
            continue
        text(page[at : mark.start()])
        at = mark.end()
        tag = (mark[2] or "").lower()
        if not tag:
            continue
        if mark[1]:
            found = find({tag}, {"td", "th", "table"} - {tag} if tag in INLINE or tag == "p" else set())
            if found is not None:
                close(found)
            elif tag == "br":
                text(" ")
            continue
        if tag == "br":
            text(" ")
            continue
        if tag in ASIDE:
            if not (tag in ("svg", "math") and mark[3].rstrip().endswith("/")):
                around = next((t for t, _ in reversed(open_) if t not in INLINE), "#page")
                at = subtree_end(page, tag, at, around) or at
            continue
        if tag in RAW:
            # Without an end tag raw text goes on to the end of the page.
            end = re.compile(rf"</{re.escape(tag)}\b[^>]*>", re.I).search(page, at)
            at = end.end() if end else len(page)
            continue
        if tag in CLOSES_P and (found := find({"p"}, {"td", "th", "li", "div", "article", "section", "body", "button"})) is not None:
            close(found)
        if tag in SIBLINGS and (found := find(SIBLINGS[tag], SCOPES.get(tag, {"table"}))) is not None:
            close(found)
        if tag in VOID:
            if tag == "hr":
                place += 1
            continue
        if tag in INLINE:
            if tag == "a":
                if (found := find({"a"}, CLOSES_P)) is not None:
                    close(found)
                links += 1
            open_.append((tag, open_[-1][1]))
            continue
        attributes = mark[3]
        names, label = frozenset(), -1
        if "=" in attributes:
            values = " ".join(a or b or c for a, b, c in _NAMED.findall(attributes)).lower()
            names = frozenset(_WORDS.findall(values))
            if found := _LABEL.search(attributes):
                label = int(found[1])
        place += 1
        nodes.append(Node(tag, open_[-1][1], names, label))
        open_.append((tag, len(nodes) - 1))
    text(page[at:])
    return nodes


GROUPS = {"p": "para", "blockquote": "para", "pre": "para", "td": "cell", "th": "cell", "li": "item", "dd": "item", "dt": "item"}
GROUPS |= {f"h{n}": "head" for n in range(1, 7)}
GROUPS |= {t: "list" for t in ("ul", "ol", "dl")} | {t: t for t in ("article", "main", "nav", "aside", "footer", "header", "form")}
EDGES = sorted({*GROUPS.values(), "box"})


def edge_kind(tag: str) -> int:
    """Which parent-child potential a child's tag takes."""
    return EDGES.index(GROUPS.get(tag, "box"))


def features(nodes: list[Node]) -> list[list[str]]:
    """Names of the binary features of each node, apart from its relatives."""
    out = []
    for node in nodes:
        own = ["bias", f"tag {node.tag}" if node.tag in GROUPS or node.tag in ("div", "section", "body", "#page", "button", "figcaption", "address") else "tag other"]
        own += [f"name {n}" for n in sorted(node.names) if n in _KNOWN]
        if node.chars:
            share = node.linked / node.chars
            own.append("links all" if share > 0.9 else "links many" if share > 0.4 else "links some" if share else "links none")
            own.append(f"chars {min(5, int(np.log10(node.chars) * 2))}")
            text = "".join(node.runs[0][1]) if node.runs else ""
            own.append("sentence" if text.rstrip()[-1:] in ".!?:…\"”»" else "phrase")
            if "©" in text or "copyright" in text.lower():
                own.append("copyright")
        else:
            own.append("no text")
        out.append(own)
    return out


_KNOWN = set(NAMES)


class TreeModel:
    """Node weights and edge potentials, and inference on whole batches of trees."""

    def __init__(self, pages: list[str]) -> None:
        trees = [t for t in map(parse, pages) if any(n.label >= 0 for n in t)]
        for nodes in trees:
            spread_labels(nodes)
        self._fit(trees)

    def _fit(self, trees: list[list[Node]]) -> None:
        rows = [f for nodes in trees for f in features(nodes)]
        y = np.array([n.label for nodes in trees for n in nodes], dtype=np.float64)
        self.columns = {f: n for n, f in enumerate(sorted({f for r in rows for f in r}))}
        x = np.zeros((len(rows), len(self.columns)))
        for at, row in enumerate(rows):
            x[at, [self.columns[f] for f in row]] = 1
        # Node weights: what the features say about a node that knows no relatives.
        weights = np.zeros(x.shape[1])
        for _ in range(25):
            p = 1 / (1 + np.exp(-x @ weights))
            gradient = x.T @ (p - y) + 0.5 * weights
            curvature = (x * (p * (1 - p))[:, None]).T @ x + 0.5 * np.eye(len(weights))
            weights -= np.linalg.solve(curvature, gradient)
        self.weights = weights
        # Edge potentials: how much likelier two labels are together than apart.
        joint = np.full((len(EDGES), 2, 2), 0.5)
        for nodes in trees:
            for node in nodes:
                if node.parent >= 0:
                    joint[edge_kind(node.tag), nodes[node.parent].label, node.label] += 1
        joint /= joint.sum(axis=(1, 2), keepdims=True)
        apart = joint.sum(axis=2, keepdims=True) * joint.sum(axis=1, keepdims=True)
        self.edges = np.log(joint) - np.log(apart)
        child = joint.sum(axis=1)
        self.usual = np.log(child[:, 1]) - np.log(child[:, 0])

    def marginals(self, trees: list[list[Node]]) -> list[np.ndarray]:
        """Probability of content for each node of each tree, by two sweeps of messages."""
        sizes = [len(t) for t in trees]
        first = np.concatenate([[0], np.cumsum(sizes)[:-1]]).astype(np.int64)
        parent = np.concatenate([[n.parent + f if n.parent >= 0 else -1 for n in t] for t, f in zip(trees, first)]).astype(np.int64)
        kinds = np.concatenate([[edge_kind(n.tag) for n in t] for t in trees]).astype(np.int64)
        own = np.zeros((len(parent), 2))
        own[:, 1] = np.concatenate([self.node_potentials(t) for t in trees])
        return np.split(self.sum_product(parent, kinds, own), np.cumsum(sizes)[:-1])

    def node_potentials(self, nodes: list[Node]) -> np.ndarray:
        """Log odds of content that each node shows by itself.

        Children of one parent that look alike are one observation, not many: they share
        what sets them apart from a usual child of their kind. Thousands of equal
        paragraphs thus say no more about their parent than one.
        """
        rows = features(nodes)
        kinds = [edge_kind(n.tag) for n in nodes]
        alike = [(n.parent, k, *row) for n, k, row in zip(nodes, kinds, rows)]
        count = Counter(alike)
        odds = np.array([sum(self.weights[self.columns[f]] for f in row if f in self.columns) for row in rows])
        usual = self.usual[kinds]
        return usual + (odds - usual) / np.array([count[a] for a in alike])

    def sum_product(self, parent: np.ndarray, kinds: np.ndarray, own: np.ndarray) -> np.ndarray:
        """Marginals of a forest whose parents stand before their children."""
        depth = np.zeros(len(parent), dtype=np.int64)
        for n in range(len(parent)):
            if parent[n] >= 0:
                depth[n] = depth[parent[n]] + 1
        levels = [np.flatnonzero(depth == d) for d in range(depth.max(initial=0) + 1)]
        below = own.copy()  # own potential and all messages from children
        up = np.zeros_like(own)
        for level in reversed(levels[1:]):
            up[level] = _log_sum(self.edges[kinds[level]] + below[level][:, None, :], axis=2)
            np.add.at(below, parent[level], up[level])
        belief = below.copy()
        for level in levels[1:]:
            # What the parent believes without this child, sent down the edge.
            rest = belief[parent[level]] - up[level]
            belief[level] = below[level] + _log_sum(self.edges[kinds[level]] + rest[:, :, None], axis=1)
        return 1 / (1 + np.exp(np.clip(belief[:, 0] - belief[:, 1], -700, 700)))

    def extract(self, pages: list[str | None]) -> list[str]:
        """Main text of each page: its content blocks in page order."""
        trees = [parse(p or "") for p in pages]
        out = []
        for nodes, content in zip(trees, self.marginals(trees) if trees else []):
            runs = [(place, "".join(parts)) for n, c in zip(nodes, content) if c > 0.5 for place, parts in n.runs]
            blocks = (" ".join(text.split()) for _, text in sorted(runs))
            out.append("\n".join(b for b in blocks if b))
        return out


def _log_sum(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis=axis, keepdims=True)
    return np.log(np.exp(x - top).sum(axis=axis)) + np.squeeze(top, axis)


def spread_labels(nodes: list[Node]) -> None:
    """Blocks without a label take their parent's; the page itself is no content."""
    for node in nodes:
        if node.label < 0:
            node.label = nodes[node.parent].label if node.parent >= 0 else 0


def mark_article(page: str) -> str | None:
    """A page that has exactly one article or main element, labelled by it.

    Blocks inside are content, but for those whose tag says otherwise.
    """
    starts = re.findall(r"<(article|main)\b", page, re.I)
    if len(starts) != 1:
        return None
    label = {"article": 1, "main": 1, "nav": 0, "aside": 0, "footer": 0, "header": 0, "form": 0}
    opened = re.compile(r"<(article|main|nav|aside|footer|header|form)\b", re.I)
    return opened.sub(lambda m: f'{m[0]} data-content="{label[m[1].lower()]}"', page)


# Layouts of labelled pages: {s} is a sentence, {p} some sentences, {w} one or two words.
ARTICLES = (
    '<article{y}><h1>{s}</h1><p>{p}</p><p>{p}</p><p>{p}</p></article>',
    '<main{y}><h1>{w}</h1><p>{p}</p><h2>{w}</h2><ul><li>{s}</li><li>{s}</li></ul><p>{p}</p></main>',
    '<div class="post-content"{y}><h2>{s}</h2><p>{p}</p><blockquote>{s}</blockquote><p>{p}</p></div>',
    '<div id="content"{y}><h1>{s}</h1><div>{p}</div><div>{p}</div><table><tr><td>{w}</td><td>{s}</td></tr></table></div>',
    '<div class="entry-body"{y}><p>{p} <a href="#">{w}</a> {s}</p><pre>{s}</pre><p>{p}</p><ol><li>{p}</li></ol></div>',
    '<section class="story"{y}><h1>{s}</h1><p>{p}<br>{p}</p><figure><figcaption>{s}</figcaption></figure><p>{s}</p></section>',
    '<article class="post"{y}><header><h1>{s}</h1></header><section><h2>{w}</h2><p>{p}</p></section><p><b>{s}<br><p>{p}</p></article>',
    '<div class="page"{y}>{p}<p>{p}<p>{p}</div>',
    '<main id="main"{n}><article{y}><h1>{w}</h1><p>{p}</p><p>{p}</p></article></main>',
)
EXTRAS = (
    '<nav{n}><ul><li><a href="/a">{w}</a></li><li><a href="/b">{w}</a></li><li><a href="/c">{w}</a></li></ul></nav>',
    '<div class="menu"{n}><a href="/a">{w}</a> <a href="/b">{w}</a> <a href="/c">{w}</a></div>',
    '<header{n}><h1><a href="/">{w}</a></h1><p>{s}</p></header>',
    '<div id="header" class="site-header"{n}><h2>{w}</h2><div>{s}</div></div>',
    '<footer{n}>&copy; {w} &middot; {s}</footer>',
    '<div class="footer"{n}><p>&copy; 2020 {w}</p><ul><li><a href="#">{w}</a></li><li><a href="#">{w}</a></li></ul></div>',
    '<aside{n}><h3>{w}</h3><p>{s}</p><ul><li><a href="#">{s}</a></li><li><a href="#">{s}</a></li></ul></aside>',
    '<div class="sidebar widget"{n}><h3>{w}</h3><p>{p}</p></div>',
    '<div class="ad"{n}>{s} {s}</div>',
    '<div class="advert sponsor"{n}><p>{s}</p><a href="#">{w}</a></div>',
    '<div class="promo banner"{n}><p>{s}</p></div>',
    '<div class="cookie-notice"{n}><p>{s} {s}</p><button>{w}</button></div>',
    '<div id="consent" role="alert"{n}>{p}</div>',
    '<div class="popup modal"{n}><h3>{w}</h3><p>{s}</p></div>',
    '<form class="newsletter"{n}><label>{s}</label><input type="text"><p>{s}</p><button>{w}</button></form>',
    '<form action="/search"{n}><label>{w}</label><input><button>{w}</button></form>',
    '<section class="comments"{n}><h3>{w}</h3><div class="comment"><p>{w}</p><p>{p}</p></div><div class="comment"><p>{s}</p></div></section>',
    '<div id="comments"{n}><ol><li class="reply"><p>{p}</p></li><li><p>{s}</p></li></ol></div>',
    '<div class="related"{n}><h4>{w}</h4><ul><li><a href="#">{s}</a></li><li><a href="#">{s}</a></li></ul></div>',
    '<div class="share social"{n}><a href="#">{w}</a><a href="#">{w}</a></div>',
    '<div class="breadcrumb"{n}><a href="#">{w}</a> / <a href="#">{w}</a></div>',
    '<ul class="pagination"{n}><li><a href="#">{w}</a></li><li><a href="#">{w}</a></li></ul>',
    '<div class="meta byline"{n}>{w}</div>',
)
WORDS = "time people water house light story paper city river morning work music garden road summer table window market letter teacher".split()


def built_pages(count: int = BUILT_PAGES, seed: int = 11) -> list[str]:
    """Labelled pages: one article among other blocks, some of these inside its wrapper."""
    rng = random.Random(seed)

    def words(low: int, high: int) -> str:
        return " ".join(rng.choices(WORDS, k=rng.randint(low, high))).capitalize()

    def fill(layout: str) -> str:
        out = re.sub(r"\{s\}", lambda _: words(4, 14) + rng.choice("...!?"), layout)
        out = re.sub(r"\{p\}", lambda _: " ".join(words(5, 20) + "." for _ in range(rng.randint(1, 6))), out)
        out = re.sub(r"\{w\}", lambda _: words(1, 2), out)
        return out.replace("{y}", ' data-content="1"').replace("{n}", ' data-content="0"')

    pages = []
    for _ in range(count):
        article = fill(rng.choice(ARTICLES))
        extras = [fill(x) for x in rng.sample(EXTRAS, rng.randint(2, 9))]
        cut = rng.randint(0, len(extras))
        if rng.random() < 0.3 and extras:  # one block inside the article, before its end
            inner = extras.pop()
            at = article.rindex("</")
            article, cut = article[:at] + inner + article[at:], min(cut, len(extras))
        body = "".join(extras[:cut]) + article + "".join(extras[cut:])
        if rng.random() < 0.4:
            body = f'<div class="{rng.choice(["wrapper", "container", "page", "site", "row"])}">{body}</div>'
        pages.append(f"<!DOCTYPE html><html><head><title>{words(2, 5)}</title></head><body>{body}</body></html>")
    return pages


def train(pages: DataFrame) -> TreeModel:
    """Fit on built pages and on at most ``MARKED_PAGES`` pages that mark their article, by id hash.

    A repeated id gives its smallest page.
    """
    rows = pages.select(F.col("page_id").alias("i"), F.col("html").alias("h")).filter(
        F.col("h").rlike("(?i)<(article|main)\\b")
    )
    ids = rows.select("i").distinct().orderBy(F.xxhash64("i"), "i").limit(MARKED_PAGES)
    picked = pages.sparkSession.createDataFrame([(r["i"],) for r in ids.collect() if r["i"] is not None], "i long")
    found = rows.join(F.broadcast(picked), "i").groupBy("i").agg(F.min("h").alias("h")).collect()
    marked = [mark_article(r["h"]) for r in sorted(found, key=lambda r: (r["i"], r["h"]))]
    return TreeModel(built_pages() + [m for m in marked if m])


def extract(pages: DataFrame, model: TreeModel, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """``id_col, url_col, text, n_chars`` of every row, in one pass without a shuffle.

    Null, empty and text-free pages give an empty text. White space inside a block is one
    space; blocks are joined in page order by a line feed. Nothing is cut. Repeated rows and
    null ids are kept; other columns do not matter; an empty table gives an empty result.
    """
    small_batches(pages.sparkSession)
    sent = pages.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("string")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            yield pd.Series(sent.value.extract(batch.tolist()), dtype="object")

    rows = pages.select(F.col(id_col).alias("i"), F.col(url_col).alias("u"), F.col(html_col).alias("h"))
    texts = rows.select("i", "u", run("h").alias("t"))
    return texts.select(
        F.col("i").alias(id_col), F.col("u").alias(url_col), F.col("t").alias("text"), F.length("t").cast("long").alias("n_chars")
    )
