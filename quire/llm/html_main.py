"""Main text of web pages by gradient-boosted trees over DOM nodes.

A page becomes a tree of blocks (``dom``). Boosted trees give each node the
log odds of being main text from its tag, the words in its attributes, those
of its ancestors, depth, text and link density of its subtree, and how it
compares with its siblings; a decoding over the tree then takes or leaves
whole subtrees, so that a node is never kept inside one that is dropped.

The trees are fitted here, on a bounded sample: the ``FIT_PAGES`` distinct
pages with the smallest hashes, those with an ``article`` or ``main`` element
before others. Their text blocks are laid out ``LAYOUTS`` times or more in
differing page frames (which elements and attributes hold the article, and
which hold menus, notices, adverts, forms and comments around and inside it),
together with the pages as they are where these elements mark the article;
elsewhere attributes and density (``Rule``) say which blocks are main text.
Extraction reads every page whole.

Defined results: null or empty html, and pages without main text, give an
empty text; repeated rows are treated alike; an empty table gives an empty
result (and is not fitted on); where no block of the sample looks like main
text nothing is fitted and ``Rule`` decides; other columns are ignored.
"""

from __future__ import annotations

import html as entities
import random
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.llm.common import pages, portions, written
from quire.llm.dom import FEATURES, Node, Page, decode

FIT_PAGES, LAYOUTS = 150, 6
#: Of one page: characters of main text in its layouts, nodes learned as they are.
FIT_CHARS, FIT_NODES = 60_000, 5_000
#: Layouts of each page where few are distinct.
MOST_LAYOUTS = 60
TREES, DEPTH = 24, 5
MAX_ODDS = 4.0
MAIN = ("article", "main")
ASIDE = ("nav", "header", "footer", "aside", "form", "menu")


class Trees:
    """The fitted trees as arrays; ``odds`` scores many nodes at once."""

    def __init__(self, model):
        self.trees = []
        for tree, weight in zip(model._java_obj.trees(), model.treeWeights):
            rows: list[list[float]] = []

            def add(node) -> int:
                at = len(rows)
                rows.append([-1, 0.0, at, at, node.prediction() * weight])
                if node.getClass().getSimpleName() == "InternalNode":
                    split = node.split()
                    rows[at][:2] = [split.featureIndex(), split.threshold()]
                    rows[at][2] = add(node.leftChild())
                    rows[at][3] = add(node.rightChild())
                return at

            add(tree.rootNode())
            self.trees.append(np.array(rows))

    def odds(self, x: np.ndarray) -> np.ndarray:
        total = np.zeros(len(x))
        each = np.arange(len(x))
        for t in self.trees:
            feature, left, right = (t[:, i].astype(np.int64) for i in (0, 2, 3))
            at = np.zeros(len(x), dtype=np.int64)
            for _ in range(DEPTH):
                f = feature[at]
                go = x[each, np.maximum(f, 0)] <= t[at, 1]
                at = np.where(f < 0, at, np.where(go, left[at], right[at]))
            total += t[at, 4]
        return np.clip(2 * total, -MAX_ODDS, MAX_ODDS)  # the classifier's margin is half the log odds


class Rule:
    """Log odds from attributes and density alone."""

    def odds(self, x: np.ndarray) -> np.ndarray:
        nearest, link, words = (x[:, FEATURES.index(k)] for k in ("nearest", "link_share", "words_per_block"))
        neutral = np.where(words >= 10, 1.0, np.where(words >= 4, 0.25, -0.25))
        return np.where((nearest < 0) | (link > 0.5), -2.0, np.where(nearest > 0, 1.5, neutral))


# -- fitting ------------------------------------------------------------------

def _marks(page: Page) -> list[int]:
    """1 for nodes that hold main text only, 0 for none, -1 for both: from
    ``data-part`` marks where a layout set them, else from the elements."""
    part: list[str | None] = []
    for node in page.nodes:
        up = part[node.parent] if node.parent >= 0 else None
        own = node.mark or ("aside" if node.tag in ASIDE or up == "aside" else "main" if node.tag in MAIN else None)
        part.append("aside" if up == "aside" else own or up)
    held = [[0, 0] for _ in page.nodes]
    for i in range(len(page.nodes) - 1, -1, -1):
        node = page.nodes[i]
        if node.parts:
            held[i][part[i] == "main"] += 1
        if node.parent >= 0:
            for k in (0, 1):
                held[node.parent][k] += held[i][k]
    return [1 if m and not o else 0 if o and not m else -1 for o, m in held]


def _lay_out(main: list[tuple[str, str]], other: list[str], seed: int) -> str:
    """A page with the main blocks (tag, text) and bits of other text in a
    frame drawn by ``seed``."""
    r = random.Random(seed)
    esc = lambda t: entities.escape(t, quote=False)
    bits = other or ["Home"]
    bit = lambda: esc(r.choice(bits))
    if r.random() < 0.4:  # articles of a few words
        main = [(g, " ".join(t.split()[:r.randint(1, 20)])) for g, t in main[:r.randint(1, 4)]]
    prose = [t for g, t in main if g not in ("h1", "h2")] or ["x"]

    def box(kind: str, inner: str) -> str:
        tag, attr = r.choice({
            "nav": [("nav", ""), ("div", 'class="menu"'), ("ul", 'class="nav-links"'), ("div", 'id="breadcrumb"')],
            "header": [("header", ""), ("div", 'id="header"'), ("div", 'class="site-banner"'), ("div", 'class="masthead"')],
            "footer": [("footer", ""), ("div", 'id="footer"'), ("div", 'class="copyright"')],
            "side": [("aside", ""), ("div", 'class="sidebar"'), ("div", 'class="widget"'), ("section", 'id="side"')],
            "ad": [("div", 'class="ad"'), ("div", 'class="advert"'), ("aside", 'class="sponsored"'), ("div", 'id="promo"')],
            "notice": [("div", 'class="cookie-notice"'), ("div", 'id="consent"'), ("div", 'class="alert notice"'), ("section", 'class="popup"')],
            "comment": [("section", 'id="comments"'), ("div", 'class="comments"'), ("ol", 'class="commentlist"'), ("div", 'id="disqus_thread"')],
            "form": [("form", ""), ("form", 'class="search"'), ("div", 'class="newsletter subscribe"')],
            "more": [("div", 'class="related"'), ("div", 'class="share"'), ("ul", 'class="tags"'), ("section", 'class="recommended"')],
        }[kind])
        return f'<{tag} {attr} data-part="aside">{inner}</{tag}>'

    def links(n: int) -> str:
        return "<ul>" + "".join(f'<li><a href="/{i}">{bit()[:r.randint(4, 40)]}</a></li>' for i in range(n)) + "</ul>"

    def piece(kind: str) -> str:
        if kind in ("nav", "more"):
            return box(kind, links(r.randint(2, 9)))
        if kind == "comment":
            said = [f'<p>{esc(r.choice(prose)[:r.randint(20, 600)])}</p>' for _ in range(r.randint(1, 5))]
            wrap = r.choice(["{}", '<div class="comment">{}</div>', '<li class="reply">{}</li>'])
            return box(kind, r.choice(["", "<h3>" + bit()[:30] + "</h3>"]) + "".join(wrap.format(s) for s in said))
        if kind == "form":
            return box(kind, f'<label>{bit()[:40]}</label><input name="q"><p>{bit()}</p><button>Go</button>')
        inner = r.choice([bit(), f"<p>{bit()}</p>", f"<p>{bit()}</p><p>{bit()}</p>", f'<h3>{bit()[:30]}</h3><p>{bit()} <a href="/x">{bit()[:12]}</a></p>'])
        return box(kind, inner)

    blocks = []
    for g, t in main:
        text = esc(t)
        if g == "#text":
            g = "p"
        if r.random() < 0.1 and len(t) > 40:
            text = f'<b>{text[:0]}</b><a href="/y">{esc(t[:15])}</a>{esc(t[15:])}'
        blocks.append(f"<{g}>{text}</{g}>")
    inside = [k for k in ("ad", "more", "notice", "form", "nav") if r.random() < 0.25]
    for k in inside:
        blocks.insert(r.randint(0, len(blocks)), piece(k))
    if r.random() < 0.3:
        blocks.append(piece("comment"))
    tag, attr = r.choice([("article", ""), ("main", ""), ("div", 'class="content"'), ("div", 'id="content"'), ("div", 'class="post-content"'),
                          ("div", 'class="entry-content"'), ("div", 'class="article-body"'), ("section", 'class="story"'),
                          ("div", 'class="text"'), ("article", 'class="post"')])
    body = f'<{tag} {attr} data-part="main">{"".join(blocks)}</{tag}>'
    if r.random() < 0.5:
        body = r.choice(['<div class="wrapper">{}</div>', '<div id="page"><div class="row">{}</div></div>', "<div>{}</div>", "<main>{}</main>"]).format(
            body + "".join(piece(k) for k in ("side", "comment") if r.random() < 0.4))
    before = "".join(piece(k) for k in ("notice", "header", "nav", "ad") if r.random() < 0.55)
    after = "".join(piece(k) for k in ("comment", "more", "side", "ad", "form", "notice", "footer") if r.random() < 0.45)
    if not (before or after):
        after = piece("footer")
    return f"<html><body>{before}{body}{after}</body></html>"


def _examples(html: str, seed: int, layouts: int = LAYOUTS) -> Iterator[tuple[list[float], int]]:
    page = Page(html)
    marks = _marks(page)
    own = [page] * 2
    if not any(m == 1 and node.parts and node.parts[0] for node, m in zip(page.nodes, marks)):
        own = []  # nothing marked: a guess of the blocks is good for layouts only
        marks = [int(k) for k in decode(page.nodes, Rule().odds(np.array(page.features())).tolist())]
    main, other = [], []
    for node, m in zip(page.nodes, marks):
        if node.parts and node.parts[0]:
            tag = page.nodes[node.parent].tag if node.tag == "#text" else node.tag
            (main.append((tag if tag in ("h1", "h2", "h3", "p", "li", "blockquote", "pre") else "p", node.parts[0]))
             if m == 1 else other.append(node.parts[0]))
    held = 0
    for n, (_, text) in enumerate(main):
        held += len(text)
        if held > FIT_CHARS:
            main = main[:n] + [(main[n][0], text[:FIT_CHARS - held + len(text)])]
            break
    made = own + ([Page(_lay_out(main, other, seed * 1000 + k)) for k in range(layouts)] if main else [])
    for p in made:
        found = [(x, y) for x, y in zip(p.features(), _marks(p)) if y >= 0]
        yield from found if len(found) <= FIT_NODES else random.Random(seed).sample(found, FIT_NODES)


def fit(spark: SparkSession, rows: DataFrame, fit_pages: int = FIT_PAGES) -> Trees | None:
    """Trees fitted on nodes of a bounded sample of ``rows`` (html)."""
    usable = rows.select(F.col("html").cast("string").alias("html")).where(F.length(F.trim("html")) > 0)
    h = F.xxhash64("html")
    marked = F.col("html").rlike(r"(?i)<(article|main)[\s/>]")
    # distinct pages: copies neither crowd others out nor lower the number drawn
    drawn = [r["h"] for r in usable.select(h.alias("h"), marked.alias("marked")).distinct()
             .orderBy(F.desc("marked"), "h").limit(fit_pages).collect()]
    if not drawn:
        return None
    layouts = max(LAYOUTS, min(MOST_LAYOUTS, LAYOUTS * FIT_PAGES // len(drawn)))
    some = (usable.where(h.isin(drawn)).groupBy("html").agg(F.lit(1)).select("html", F.pmod(h, F.lit(1_000_000)).alias("seed"))
            .orderBy("seed", "html").limit(2 * fit_pages))

    def nodes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for text, seed in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                got = list(_examples(text, seed, layouts))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([x for x, _ in got], pa.list_(pa.float64())), pa.array([float(y) for _, y in got])],
                    names=["x", "label"])

    table = written(spark, some.mapInArrow(nodes, "x array<double>, label double"), "html-nodes")
    if table.select("label").distinct().count() < 2:
        return None
    data = table.select(array_to_vector("x").alias("features"), "label")
    return Trees(GBTClassifier(maxIter=TREES, maxDepth=DEPTH, maxBins=32, stepSize=0.3, seed=1).fit(data))


# -- extraction ---------------------------------------------------------------

def extract(rows: DataFrame, trees: Trees | None) -> DataFrame:
    """page_id, url, text and n_chars of every row of ``rows`` (page_id, url, html)."""
    model = trees or Rule()

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for s, m in portions(batch.column(2), 500_000):
                part = batch.slice(s, m)
                found = [Page(h or "") for h in part.column(2).to_pylist()]
                odds = model.odds(np.concatenate([p.features() for p in found]))
                texts, at = [], 0
                for p in found:
                    n = len(p.nodes)
                    kept = decode(p.nodes, odds[at:at + n].tolist())
                    texts.append(" ".join(v.parts[0] for v, k in zip(p.nodes, kept) if k and v.parts and v.parts[0]))
                    at += n
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                    names=["page_id", "url", "text", "n_chars"])

    return (rows.select(F.col("page_id").cast("long"), F.col("url").cast("string"), F.col("html").cast("string"))
            .mapInArrow(work, "page_id long, url string, text string, n_chars long"))


def op10_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = pages(spark, sf_dir)
    return extract(rows, fit(spark, rows))
