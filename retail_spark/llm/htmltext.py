"""Main text of web pages by a tree-structured graphical model.

Every element and text of a page is a node with a hidden label, content or
not. A node's own potential comes from its tag, its class, id and role, the
length, punctuation and link share of its text and its depth; a potential for
each edge ties a child's label to its parent's. One sum-product pass up the
tree and one down give each text its exact marginal, for a whole batch of pages
at a time, level by level. Texts more likely content than not make the result.

Both kinds of potentials are learned from labelled pages: a bounded sample of
the pages themselves that mark their article (the mark being hidden in half of
them, so that other signs are learned too), and the annotated pages below for
parts that such pages may lack.
"""

from __future__ import annotations

import re
from html import unescape

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from retail_spark.llm.common import map_arrow
from retail_spark.llm.toxicity import Logistic

#: Pages of the training sample at most, and characters of one of them at most.
SAMPLE, SAMPLE_CHARS = 300, 100_000

#: Fixed values of HTML: elements without content, elements that begin a block of text, elements whose content is no markup.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCK = frozenset("address article aside blockquote body button caption center dd details dialog dir div dl dt fieldset figcaption figure footer form "
                  "frameset h1 h2 h3 h4 h5 h6 header hgroup html legend li main menu nav ol optgroup option p pre search section select summary "
                  "table tbody td tfoot th thead title tr ul".split())
RAW = frozenset("iframe noembed noframes script style template textarea title xmp".split())
#: Never content, whatever the model says: what a page doesn't show, and what a reader fills in.
HIDDEN = frozenset("button datalist head iframe input noembed noframes noscript option script select style svg template textarea title xmp".split())
#: An element that begins closes an open one of these, up to the elements that hold them.
CLOSES = {"li": ({"li"}, {"ul", "ol", "menu", "dir"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
          "tr": ({"tr"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}),
          "option": ({"option"}, {"select", "datalist"}), "body": ({"head"}, {"html"})}
#: Elements that an open paragraph doesn't reach out of.
P_SCOPE = frozenset("button caption html object table td template th".split())

_TOKEN = re.compile(r"""<!--.*?(?:-->|--!>|\Z)|<(?P<end>/?)(?P<tag>[a-zA-Z][^\s/>]*+)(?P<rest>(?:[^>"']++|"[^"]*+"|'[^']*+')*+>|[^>]*+(?:>|\Z))"""
                    r"""|<[!?/][^>]*+(?:>|\Z)|(?P<text>[^<]++|<)""", re.S)
_NAMES = re.compile(r"""(?:\s|["'/])(?:class|id|role|itemprop|aria-label)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
_PIECE = re.compile(r"[a-z]+")
_PUNCTUATION = re.compile(r"[.,;:!?。、，！？؟।]")

#: Kinds of edges: what the child is.
TEXT, INLINE, BLOCKS, SECTION = range(4)
_SECTION = frozenset("article aside body div footer form header html main nav section".split())


class Tree:
    """A page as parallel lists, parents before children: ``parent``, ``depth``, ``key`` (tag, name pieces, those of the section around), ``kind``, ``text``.

    A text node has its decoded text and the number of the block that it is part of.
    """

    def __init__(self, html: str | None):
        self.parent, self.depth, self.key, self.kind, self.text, self.block, self.link = [-1], [0], [("#root", "", "")], [SECTION], [None], [0], [False]
        self._under = [""]
        self._blocks, open_ = 0, [0]
        tags = [""]
        html, at, gap = html or "", 0, False  # gap: white space or a line break before the next text
        while m := _TOKEN.match(html, at):
            at = m.end()
            if at == m.start():
                break
            if (text := m["text"]) is not None:
                text = unescape(text)
                if text.isspace():
                    gap = True
                else:
                    self._add(open_, tags, "#text", "", TEXT, " " + text if gap else text)
                    gap = False
                continue
            if (tag := m["tag"]) is None:
                continue
            tag = tag.lower()
            if m["end"]:
                self._close(open_, tags, tag)
                continue
            self._make_room(open_, tags, tag)
            rest = m["rest"]
            if tag in VOID:
                gap |= tag == "br"
                if tag == "hr":
                    self._blocks += 1
                continue
            pieces = ""
            if "=" in rest:
                pieces = " ".join(sorted({p for x in _NAMES.findall(" " + rest) for p in _PIECE.findall("".join(x).lower())}))
            if tag in RAW:
                end = re.compile(rf"</{re.escape(tag)}(?=[\s/>])[^>]*>?", re.I).search(html, at)
                if rest.endswith("/>") and tag not in ("script", "style", "textarea", "title", "iframe"):
                    continue
                at = end.end() if end else len(html)
                continue
            kind = SECTION if tag in _SECTION else BLOCKS if tag in BLOCK else INLINE
            self._add(open_, tags, tag, pieces, kind, None)
            if not rest.endswith("/>") or tag in BLOCK:
                open_.append(len(self.parent) - 1)
                tags.append(tag)
        self.n = len(self.parent)

    def _add(self, open_, tags, tag, pieces, kind, text):
        up = open_[-1]
        if kind >= BLOCKS:
            self._blocks += 1
        self.parent.append(up)
        self.depth.append(self.depth[up] + 1)
        # a text is known by the element around it; under: the nearest element around that has a name or is a section
        self.key.append((tag, pieces, self._under[up]) if text is None else (tags[-1] + "#", "", self._under[up]))
        self._under.append(f"{tag} {pieces}" if text is None and (pieces or kind == SECTION) else self._under[up])
        self.kind.append(kind)
        self.text.append(text)
        self.block.append(self._blocks)
        self.link.append(self.link[up] or tag == "a")

    def _close(self, open_, tags, tag):
        for k in range(len(tags) - 1, 0, -1):
            if tags[k] == tag:
                if any(t in BLOCK for t in tags[k:]):
                    self._blocks += 1
                del open_[k:], tags[k:]
                return
            if tag not in BLOCK and tags[k] in BLOCK:
                return

    def _make_room(self, open_, tags, tag):
        if tag in BLOCK and tag not in ("body", "html", "title", "option", "optgroup"):
            for k in range(len(tags) - 1, 0, -1):
                if tags[k] == "p":
                    self._blocks += 1
                    del open_[k:], tags[k:]
                    break
                if tags[k] in P_SCOPE:
                    break
        if tag in CLOSES:
            ends, stops = CLOSES[tag]
            for k in range(len(tags) - 1, 0, -1):
                if tags[k] in ends:
                    self._blocks += 1
                    del open_[k:], tags[k:]
                    break
                if tags[k] in stops:
                    break

    def hidden(self) -> np.ndarray:
        out = np.zeros(self.n, bool)
        for i in range(1, self.n):
            out[i] = out[self.parent[i]] or self.key[i][0] in HIDDEN
        return out

    def extract(self, content: np.ndarray) -> str:
        """Blocks of the texts marked, in page order, white space turned into one blank, joined by an empty line."""
        blocks: dict[int, list[str]] = {}
        for i, t in enumerate(self.text):
            if t is not None and content[i]:
                blocks.setdefault(self.block[i], []).append(t)
        found = (" ".join("".join(b).split()) for b in blocks.values())
        return "\n\n".join(b for b in found if b)


def measures(trees: list[Tree]) -> dict[str, np.ndarray]:
    """Numbers of all nodes of a batch, pages one after the other, as bins."""
    base = np.cumsum([0] + [t.n for t in trees])
    parent = np.concatenate([np.where((p := np.array(t.parent)) < 0, -1, p + b) for t, b in zip(trees, base)])
    depth = np.concatenate([np.array(t.depth) for t in trees])
    texts = [x for t in trees for x in t.text]
    size = np.array([0 if x is None else len(x) for x in texts], dtype=np.float64)
    marks = np.array([0 if x is None else len(_PUNCTUATION.findall(x)) for x in texts], dtype=np.float64)
    linked = size * np.concatenate([np.array(t.link) for t in trees])
    own = size.copy()
    order = np.argsort(depth, kind="stable")
    ends = np.searchsorted(depth[order], np.arange(int(depth.max(initial=0)) + 2))
    levels = [order[ends[d] : ends[d + 1]] for d in range(len(ends) - 1)]
    for level in reversed(levels[1:]):
        for x in (size, marks, linked):
            np.add.at(x, parent[level], x[level])
    page = np.repeat(np.arange(len(trees)), np.diff(base))
    whole = np.maximum(size[base[:-1]], 1)[page]
    bins = {"size": np.digitize(size, [1, 10, 30, 100, 300, 1000, 3000]), "marks": np.digitize(marks / np.maximum(size, 1), [1e-6, 0.01, 0.02, 0.04]),
            "links": np.digitize(linked / np.maximum(size, 1), [0.01, 0.2, 0.5, 0.9]), "share": np.digitize(size / whole, [0.02, 0.1, 0.3, 0.6, 0.9]),
            "depth": np.minimum(depth, 12)}
    return {"parent": parent, "levels": levels, "base": base, "own": own, **bins}


BINNED = ("size", "marks", "links", "share", "depth")


#: How far a node's own potential counts beside those of its edges, which say much of the same.
TEMPER = 0.6


def _static(key: tuple[str, str, str]) -> list[str]:
    return [f"tag={key[0]}", *(f"name={p}" for p in key[1].split()), *(f"under={p}" for p in key[2].split())]


class ContentModel:
    """Weights of signs (``own``), bias, and log potentials of edges by kind, parent's and child's label."""

    def __init__(self, own: dict[str, float], bias: float, edges: np.ndarray):
        self.own, self.bias, self.edges = own, bias, edges
        self.bins = {b: np.array([own.get(f"{b}={k}", 0.0) for k in range(16)]) for b in BINNED}
        self.keys: dict[tuple[str, str, str], float] = {}

    def _key(self, key: tuple[str, str, str]) -> float:
        if key not in self.keys:
            if len(self.keys) > 100_000:
                self.keys.clear()
            self.keys[key] = sum(self.own.get(s, 0.0) for s in _static(key))
        return self.keys[key]

    def marginals(self, trees: list[Tree]) -> np.ndarray:
        """The probability of being content of every node of the batch, by messages up and down the trees."""
        x = measures(trees)
        odds = self.bias + np.array([self._key(k) for t in trees for k in t.key])
        for b, w in self.bins.items():
            odds = odds + w[x[b]]
        kind = np.concatenate([np.array(t.kind) for t in trees])
        belief = np.stack([np.zeros(len(odds)), np.clip(TEMPER * odds, -20, 20)], axis=1)
        message = np.zeros_like(belief)
        parent, levels = x["parent"], x["levels"]
        for level in reversed(levels[1:]):
            pair = self.edges[kind[level]]  # (nodes, parent's label, own label)
            message[level] = np.logaddexp.reduce(pair + belief[level][:, None, :], axis=2)
            np.add.at(belief, parent[level], message[level])
        for level in levels[1:]:
            above = belief[parent[level]] - message[level]
            pair = self.edges[kind[level]]
            belief[level] += np.logaddexp.reduce(pair + above[:, :, None], axis=1)
            belief[level] -= belief[level].max(axis=1, keepdims=True)
        return 1 / (1 + np.exp(np.clip(belief[:, 0] - belief[:, 1], -50, 50)))

    def texts(self, pages: list[str | None]) -> list[str]:
        trees = [Tree(p) for p in pages]
        if not trees:
            return []
        p, at, out = self.marginals(trees), 0, []
        for t in trees:
            shown = ~t.hidden()
            text = t.extract((p[at : at + t.n] > 0.5) & shown)
            # a piece of a page with nothing around it: all that it shows is its text
            out.append(text or ("" if marked(t) else t.extract(shown)))
            at += t.n
        return out


#: Elements that hold a page's article, those inside of it that are no part of it, and name pieces that say so.
_MAIN, _NOT_MAIN = {"article", "main"}, {"nav", "aside", "footer", "form"}
_ASIDE = {"ad", "ads", "advert", "banner", "comment", "comments", "cookie", "menu", "nav", "navigation", "newsletter", "notice", "promo", "related", "share",
          "sidebar", "sponsor", "subscribe", "widget"}
_FRAME = _ASIDE | {"footer", "header"}


def marked(tree: Tree) -> bool:
    """Whether any element says that it is no part of an article, by its tag or names."""
    return any(tag in _NOT_MAIN or tag in ("header", "menu") or not _FRAME.isdisjoint(names.split()) for tag, names, _ in tree.key)


def taught(tree: Tree, mark: str | None = None) -> np.ndarray | None:
    """Labels of all nodes by the page's own marks (or by ``mark``, a name piece), None if it has none."""
    label = np.zeros(tree.n, bool)
    seen = False
    for i in range(1, tree.n):
        tag, pieces, _ = tree.key[i]
        names = set(pieces.split())
        if mark:
            starts, stops = mark in names, "not" + mark in names
        else:
            starts, stops = tag in _MAIN or "articlebody" in names, tag in _NOT_MAIN or bool(names & _ASIDE)
        seen |= starts
        label[i] = (label[tree.parent[i]] or starts) and not stops
    return label if seen else None


def _without_marks(names: str) -> str:
    return " ".join(p for p in names.split() if p not in ("truth", "nottruth"))


def train(pages: list[str]) -> ContentModel:
    """A model of the pages that mark their article, and of the annotated ones."""
    trees, labels = [], []
    for k, page in enumerate(pages):
        tree = Tree(page)
        label = taught(tree)
        if label is None or not label.any():
            continue
        if k % 2:  # without the mark itself
            tree.key = [(*(("div", "") if t in _MAIN else (t, n)), " ".join("div" if x in _MAIN else x for x in u.split())) for t, n, u in tree.key]
        trees.append(tree)
        labels.append(label)
    for page in ANNOTATED * max(3, len(trees) // (2 * len(ANNOTATED))):
        tree = Tree(page)
        labels.append(taught(tree, "truth"))
        tree.key = [(t, _without_marks(n), _without_marks(u)) for t, n, u in tree.key]
        trees.append(tree)
    x = measures(trees)
    y, keys = np.concatenate(labels).astype(int), [k for t in trees for k in t.key]
    index: dict[str, int] = {}
    rows = []
    for i, key in enumerate(keys):
        signs = [*_static(key), *(f"{b}={int(x[b][i])}" for b in BINNED)]
        rows.append(np.array([index.setdefault(s, len(index)) for s in signs]))
    linear = Logistic(rows, y.astype(float), len(index), epochs=200, decay=1e-5)
    kind = np.concatenate([np.array(t.kind) for t in trees])
    edges = np.ones((4, 2, 2))
    child = np.flatnonzero(x["parent"] >= 0)
    np.add.at(edges, (kind[child], y[x["parent"][child]], y[child]), 1)
    edges = np.log(edges / edges.sum(axis=2, keepdims=True)) - np.log(edges.sum(axis=1, keepdims=True) / edges.sum(axis=(1, 2), keepdims=True))
    return ContentModel({s: float(linear.weights[k]) for s, k in index.items()}, linear.bias, edges)


def learn(pages: DataFrame, sample: int = SAMPLE) -> ContentModel:
    """Trained on at most ``sample`` pages of at most ``SAMPLE_CHARS`` characters, chosen by a hash of the page."""
    some = (pages.filter(f"html is not null and length(html) <= {SAMPLE_CHARS}").select("html", F.xxhash64("html").alias("h"))
            .orderBy("h").limit(sample).select("html").collect())
    return train([r["html"] for r in some])


def main_text(pages: DataFrame, model: ContentModel) -> DataFrame:
    """(page_id, url, text, n_chars) for every row of ``pages(page_id, url, html)``; the whole html is read.

    Null and empty html, and pages without content, give an empty text. A page
    in which the model finds no content, and no element is marked as menu,
    header, footer, sidebar, notice, advert, form or comment, is a fragment:
    all its visible text is its main text.
    Broken markup is read as browsers do: open paragraphs and list items end
    where the next begins, the rest of an unfinished comment or script is part
    of it. Other columns are ignored; repeated rows give repeated rows.
    """
    held = pages.sparkSession.sparkContext.broadcast((model.own, model.bias, model.edges))

    def start():
        own = ContentModel(*held.value)

        def step(batch):
            html = batch.column(2).to_pylist()
            texts = [t for k in range(0, len(html), 500) for t in own.texts(html[k : k + 500])]
            return {"page_id": batch.column(0), "url": batch.column(1), "text": texts, "n_chars": [len(t) for t in texts]}

        return step

    rows = pages.select(F.col("page_id").cast("bigint").alias("page_id"), F.col("url").cast("string").alias("url"), "html")
    return map_arrow(rows, start, "page_id bigint, url string, text string, n_chars bigint")


#: Labelled pages for parts that the sample may lack: ``truth`` begins content, ``nottruth`` ends it.
_WORDS = ("The committee met on Tuesday to look at the report, which had been ready since spring. Nobody expected a quick decision, but the chair asked "
          "for one. Several members spoke; two of them disagreed with the figures, and one left early.")
_SHORT = "It rained all week."
_LINKS = "".join(f'<li><a href="/{w}">{w}</a></li>' for w in ("Home", "News", "Sport", "Weather", "Contact"))
_COMMENTS = ('<div class="nottruth comments" id="comments"><h3>Comments</h3><div class="comment"><span class="author">reader</span>'
             f"<p>I was there and it was not like that at all. {_SHORT}</p></div></div>")
ANNOTATED = [
    f'<html><body><header class="site-header"><div class="logo">Daily</div><ul class="menu">{_LINKS}</ul></header><div class="cookie-notice"><p>We use '
    f'cookies to improve this site. By reading on you agree.</p><button>OK</button></div><div class="wrapper"><div class="content truth"><h1>Committee meets'
    f"</h1><p>{_WORDS}</p><p>{_SHORT}</p><h2>What is next</h2><p>{_WORDS}</p><ul><li>{_SHORT}</li><li>{_WORDS}</li></ul></div><div class=\"sidebar\">"
    f'<h3>Most read</h3><ul>{_LINKS}</ul></div></div>{_COMMENTS}<footer><p>Copyright 2020. All rights reserved.</p></footer></body></html>',
    f'<html><body><nav>{_LINKS}</nav><main class="truth"><h1>A week of rain</h1><p>{_SHORT}</p><p>{_WORDS} <a href="/x">Read the report</a>, it is long.</p>'
    f'<blockquote>{_SHORT}</blockquote><aside class="nottruth related"><h4>Related</h4><ul>{_LINKS}</ul></aside><div class="nottruth advert ad-slot">Buy now, '
    f'only today!</div><p>{_WORDS}</p><form class="nottruth newsletter"><label>Sign up for our letter</label><p>Weekly news by mail.</p></form></main>'
    f'<section class="comments"><h2>3 comments</h2><p>{_WORDS}</p><p>First!</p></section><footer>Imprint</footer></body></html>',
    f'<div id="page"><div id="nav" role="navigation">{_LINKS}</div><div id="story" class="post entry truth"><h2>Notes</h2>{_WORDS}<br><br>{_SHORT}<p>{_SHORT}'
    f'</p><table><tr><td>{_SHORT}</td><td>{_SHORT}</td></tr></table><pre>{_SHORT}</pre></div><div class="ad banner">{_SHORT}</div><div class="promo"><p>'
    f'{_SHORT}</p></div><div id="footer">Contact us. Terms.</div></div>',
    f'<html><body><div class="notice alert">This page has moved. Please change your bookmarks.</div><header><h1>My site</h1><p>Words about things</p></header>'
    f'<article class="truth"><header><h1>Title of it</h1></header><p>{_WORDS}</p><figure><img src="a.png"><figcaption>{_SHORT}</figcaption></figure><p>{_SHORT}</p>'
    f'<div class="nottruth share">Share this on</div><footer class="nottruth">Filed under rain</footer></article><aside><p>{_WORDS}</p></aside>'
    f'<div id="disqus" class="reader-comments"><div class="comment-body"><p>{_WORDS}</p></div></div></body></html>',
    f'<html><body class="truth"><h1>Plain</h1><p>{_WORDS}</p><p>{_SHORT}</p></body></html>',
    f'<div class="truth"><p>{_SHORT}</p></div>',
    f'<html><body><ul id="menu">{_LINKS}</ul><div id="ads" class="ads">{_WORDS}</div><div id="main" class="main truth"><p>{_SHORT}</p></div><div class="widget '
    f'subscribe"><form><p>{_SHORT}</p></form></div><div id="comments"><ol><li><p>{_WORDS}</p></li></ol></div><div class="footer">{_LINKS}</div></body></html>',
]
