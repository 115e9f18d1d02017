"""Main text of web pages by a tree-structured graphical model.

Each page becomes a tree of its structural elements.  Every node carries a binary label
(content or not) with node potentials from a few features and a potential on every
parent-child edge.  Messages pass upward from the leaves and downward from the root
(sum-product); text is kept where the content marginal reaches one half.  All pages of a
batch are one forest, so each step is a numpy operation on one depth level.

The potentials are smoothed frequencies counted over a sample of about ``TRAIN_PAGES``
pages, chosen by the hash of page_id, of which those that mark their article are labelled.
There a node is content if the nearest element that tells its role is the article.

Pages are read where they lie (no shuffle).  Null or empty html gives an empty text;
broken markup is closed as it comes; repeated rows are read each; other columns pass through.
"""

from __future__ import annotations

import re
from collections import Counter
from html import unescape

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import hash_share

TRAIN_PAGES = 2_000
PSEUDO = 0.5       # added to every count
BATCH_CHARS = 4_000_000

# Element groups and the words of class, id and role attributes that tell an element's part.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
RAW = set("script style".split())
HIDDEN = set("head template svg math object iframe noscript canvas audio video".split())
HEADING = set("h1 h2 h3 h4 h5 h6".split())
PARAGRAPH = set("p blockquote pre figcaption address".split())
LIST = set("ul ol li dl dt dd".split())
CONTAINER = set("html body div section article main table thead tbody tfoot tr td th figure details summary fieldset center".split())
BOILER_TAGS = set("nav header footer aside form button select textarea dialog menu label option".split())
CONTENT_WORDS = set("article content main post entry story articlebody".split())
BOILER_WORDS = set("""nav navbar navigation menu header masthead footer sidebar aside ad ads advert adverts advertisement
    advertising banner promo promotion sponsor sponsored cookie cookies consent notice notification alert popup modal
    overlay newsletter subscribe form search comment comments reply replies disqus respond share sharing social related
    recommended breadcrumb breadcrumbs pagination pager login signup widget toolbar copyright legal disclaimer
    complementary contentinfo skip""".split())
BLOCK = HEADING | PARAGRAPH | LIST | CONTAINER | BOILER_TAGS - {"label", "button"} | {"head", "hr"}
CLOSES_P = BLOCK - {"html", "body", "head"}
SIBLINGS = {"li": {"ul", "ol", "menu"}, "dt": {"dl"}, "dd": {"dl"}, "tr": {"table", "thead", "tbody", "tfoot"},
            "td": {"tr"}, "th": {"tr"}, "option": {"select"}}

_TAG = re.compile(r"""<!--.*?(?:-->|\Z)|<[!?][^>]*+>|<(/?)([a-zA-Z][a-zA-Z0-9:-]*+)((?:[^>"']++|"[^"]*+"|'[^']*+')*+)>"""
                  r"""|<(/?)([a-zA-Z][a-zA-Z0-9:-]*+)([^>]*+)>""", re.S)
_ROLE = re.compile(r"""(?:^|\s)(?:class|id|role|itemprop)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
_NAME = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")

# features of a node and the number of values of each
FEATURES = {"group": 5, "part": 3, "size": 5, "links": 4, "stop": 3}
NONE, CONTENT, BOILER = 0, 1, 2


def part_of(tag: str, attributes: str) -> int:
    """What an element says about its part: boilerplate words win over content words."""
    if tag in BOILER_TAGS or tag in HIDDEN:
        return BOILER
    part = CONTENT if tag in ("article", "main") else NONE
    if "=" in attributes:
        for m in _ROLE.finditer(attributes):
            words = {w.lower() for w in _NAME.findall(m[1] or m[2] or m[3] or "")}
            if words & BOILER_WORDS:
                return BOILER
            if words & CONTENT_WORDS:
                part = CONTENT
    return part


class Page:
    """The nodes of a page (parent, depth, group, own part, nearest part) and its text runs
    (node, in a link, starts a new block, text)."""

    def __init__(self, html: str | None):
        self.parent, self.depth, self.group, self.own, self.near = [-1], [0], [4], [NONE], [NONE]
        self.runs: list[tuple[int, bool, bool, str]] = []
        html = html or ""
        stack = [("", 0, False)]        # (tag, node, inside a link)
        count: Counter[str] = Counter()  # open elements by tag, so that no walk looks for what is not there
        at, fresh = 0, True
        size, find = len(html), _TAG.search
        while at < size:
            m = find(html, at)
            text = html[at:m.start()] if m else html[at:]
            if text:
                self.runs.append((stack[-1][1], stack[-1][2], fresh, text))
                fresh = False
            if not m:
                break
            at = m.end()
            tag = (m[2] or m[5] or "").lower()
            if not tag:
                continue
            if m[1] or m[4]:
                for k in range(len(stack) - 1, 0, -1) if count[tag] else ():
                    if stack[k][0] == tag:
                        self._cut(stack, count, k)
                        break
                fresh = fresh or tag in BLOCK
                continue
            if tag == "br":
                self.runs.append((stack[-1][1], stack[-1][2], fresh, " "))
            if tag in RAW:
                end = re.compile(rf"</{tag}\b[^>]*>", re.I).search(html, at)
                at = end.end() if end else size
                continue
            self._imply_ends(stack, count, tag)
            fresh = fresh or tag in BLOCK
            if tag in VOID or (m[3] or m[6] or "").endswith("/") and tag not in BLOCK:
                continue
            attributes = m[3] or m[6] or ""
            own = part_of(tag, attributes)
            node = stack[-1][1]
            if own or tag in BLOCK:
                group = 0 if tag in HEADING else 1 if tag in PARAGRAPH else 2 if tag in LIST else 3 if tag not in CONTAINER else 4
                self.parent.append(node)
                self.depth.append(self.depth[node] + 1)
                self.group.append(group)
                self.own.append(own)
                self.near.append(BOILER if own == NONE and self.near[node] == BOILER else own or self.near[node])
                node = len(self.parent) - 1
            stack.append((tag, node, stack[-1][2] or tag == "a"))
            count[tag] += 1

    @staticmethod
    def _cut(stack, count, k):
        count.subtract(t for t, _, _ in stack[k:])
        del stack[k:]

    @classmethod
    def _imply_ends(cls, stack, count, tag):
        """A block ends an open paragraph; an item ends the item before it."""
        limit = SIBLINGS.get(tag)
        ended = ["p"] * (tag in CLOSES_P)
        if limit:
            ended += {"dt": ["dt", "dd"], "dd": ["dt", "dd"], "td": ["td", "th"], "th": ["td", "th"]}.get(tag, [tag])
        if not any(count[t] for t in ended):
            return
        for k in range(len(stack) - 1, 0, -1):
            name = stack[k][0]
            if name == "p" and tag in CLOSES_P or limit and (name == tag or {name, tag} == {"dt", "dd"} or {name, tag} == {"td", "th"}):
                cls._cut(stack, count, k)
                return
            if limit and name in limit or not limit and name in CONTAINER | {"li"}:
                return


def node_features(page: Page) -> np.ndarray:
    """One row per node, a value of each of ``FEATURES``."""
    n = len(page.parent)
    chars, linked, stops = [0] * n, [0] * n, [0] * n
    for node, link, _, text in page.runs:
        c = len(text) - text.count(" ")
        if c:
            chars[node] += c
            if link:
                linked[node] += c
            if text.rstrip().endswith((".", "!", "?", ":", ";", '"')):
                stops[node] = 1
    c = np.array(chars)
    share = np.array(linked) / np.maximum(c, 1)
    return np.stack([np.array(page.group), np.array(page.near), np.searchsorted([1, 25, 80, 200], c, "right"),
                     np.where(c == 0, 0, 1 + (share >= 0.3) + (share >= 0.8)), np.where(c == 0, 0, 1 + np.array(stops))], axis=1)


class Potentials:
    """Logarithms of the smoothed frequencies: node features given the label, child label given
    the parent's label and the child's own part, and the root's label."""

    def __init__(self, counts: np.ndarray):
        """``counts``: the flat table of :func:`count_page`, summed over pages."""
        edge = counts[:18].reshape(3, 2, 3)[:, :, :2] + PSEUDO
        self.edge = np.log(edge / edge.sum(axis=2, keepdims=True))
        self.node, at = [], 18
        for name, values in FEATURES.items():
            table = counts[at:at + 2 * values].reshape(values, 2) + PSEUDO
            log = np.log(table / table.sum(axis=0))
            if name == "part":
                log[NONE] = 0.0  # an element that tells nothing is no evidence
            self.node.append(log)
            at += 2 * values


COUNTS = 18 + 2 * sum(FEATURES.values())


def count_page(page: Page, counts: np.ndarray) -> None:
    """Add the labels and features of one labelled page to ``counts``."""
    label = (np.array(page.near) == CONTENT).astype(int)
    parent = np.array(page.parent[1:], int)
    np.add.at(counts, np.array(page.own[1:], int) * 6 + label[parent] * 3 + label[1:], 1)
    at = 18
    for f, (name, values) in enumerate(FEATURES.items()):
        np.add.at(counts, at + node_features(page)[:, f] * 2 + label, 1)
        at += 2 * values


def marginals(pages: list[Page], p: Potentials) -> np.ndarray:
    """Content marginal of every node of all pages, by one upward and one downward pass."""
    base = np.cumsum([0] + [len(x.parent) for x in pages])
    parent = np.concatenate([np.array(x.parent) + b for x, b in zip(pages, base)])
    depth = np.concatenate([x.depth for x in pages])
    own = np.concatenate([x.own for x in pages])
    features = np.concatenate([node_features(x) for x in pages])
    belief = sum(table[features[:, f]] for f, table in enumerate(p.node))
    belief = belief + np.zeros((len(parent), 2))
    order = np.argsort(depth, kind="stable")
    levels = np.split(order, np.searchsorted(depth[order], np.arange(1, int(depth.max()) + 1)))
    message = np.zeros_like(belief)  # of a node to its parent, by the parent's label
    for rows in reversed(levels[1:]):
        message[rows] = np.logaddexp.reduce(p.edge[own[rows]] + belief[rows][:, None, :], axis=2)
        np.add.at(belief, parent[rows], message[rows])
    belief[levels[0], 1] -= 5.0  # the document node itself is not content
    for rows in levels[1:]:
        outside = belief[parent[rows]] - message[rows]
        belief[rows] += np.logaddexp.reduce(p.edge[own[rows]] + outside[:, :, None], axis=1)
    return 1 / (1 + np.exp(np.clip(belief[:, 0] - belief[:, 1], -50, 50)))


def page_text(page: Page, content: np.ndarray) -> str:
    """Texts of the content nodes: one line per block, character references decoded, white space collapsed."""
    blocks, now = [], []
    for node, _, fresh, text in page.runs:
        if fresh and now:
            blocks.append("".join(now))
            now = []
        if content[node]:
            now.append(text)
    blocks.append("".join(now))
    lines = (" ".join(unescape(b).split()) for b in blocks)
    return "\n".join(x for x in lines if x)


def _count(batches):
    counts = np.zeros(COUNTS, np.int64)
    for batch in batches:
        for html in batch.column("html").to_pylist():
            page = Page(html)
            if CONTENT in page.near:
                count_page(page, counts)
    yield pa.RecordBatch.from_arrays([pa.array(np.arange(COUNTS)), pa.array(counts)], ["k", "n"])


def train(pages: DataFrame, limit: int = TRAIN_PAGES) -> Potentials:
    """Count the potentials over the labelled ones of about ``limit`` pages, chosen by the hash of page_id.
    They are counted where they lie; only the counts move.  Without any labelled
    page only the built-in observations below speak."""
    share = limit / max(pages.count(), 1)
    sample = (pages.where(hash_share("page_id", share)) if share < 1 else pages).where(
        F.lower(F.col("html")).rlike("<(article|main)[\\s>]")).select("html")
    counts = np.zeros(COUNTS, np.int64)
    for row in sample.mapInArrow(_count, "k long, n long").groupBy("k").agg(F.sum("n").alias("n")).collect():
        counts[row.k] = row.n
    known = Page("<body><nav><ul><li><a>Home</a><li><a>News</a></ul></nav><aside>More of it</aside><article><h1>Title</h1><p>"
                 + "A sentence of the article. " * 9 + "<p>Short end.</article><footer>All rights</footer></body>")
    count_page(known, counts)
    return Potentials(counts)


def extract(pages: DataFrame, potentials: Potentials) -> DataFrame:
    """``pages`` (any columns, among them ``html``; without html) with ``main_text``.  An input column of that name is replaced."""
    names = [c for c in pages.columns if c not in ("html", "main_text")]

    def run(batches):
        for batch in batches:
            texts, group, size = [], [], 0

            def flush():
                content = marginals(group, potentials) >= 0.5
                at = 0
                for page in group:
                    texts.append(page_text(page, content[at:at + len(page.parent)]))
                    at += len(page.parent)

            for html in batch.column("html").to_pylist():
                group.append(Page(html))
                size += len(html or "")
                if size >= BATCH_CHARS:
                    flush()
                    group, size = [], 0
            if group:
                flush()
            yield pa.RecordBatch.from_arrays([batch.column(c) for c in names] + [pa.array(texts, pa.string())], [*names, "main_text"])

    schema = T.StructType([pages.schema[c] for c in names] + [T.StructField("main_text", T.StringType())])
    return pages.select(*names, "html").mapInArrow(run, schema)


def q_html(spark, sf_dir: str) -> DataFrame:
    from .common import table
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    done = extract(pages, train(pages))
    return done.select("page_id", "url", F.col("main_text").alias("text"), F.char_length("main_text").cast("long").alias("n_chars"))
