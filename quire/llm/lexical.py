"""Ranked lexical search by dual trees.

Documents and items are vectors over the items' terms: what an occurrence
count gives a document (its impact, which falls with the document's length),
and a term's weight times its repeats in the item. Both sides are put in an
order that brings equal strongest terms together and get a binary tree over
that order whose nodes hold the maximum of each coordinate. The product of an
item node and a document node bounds the score of every pair below them; where
it stays below the weakest k-th score that any item of the node has so far, the
whole batch of pairs is skipped, else both nodes are opened. Pairs of leaves
are scored exactly, the most promising document leaves first.

Texts are read once for a block of items (about ``BLOCK_BYTES`` of text): what
is left of a document is a short list of terms and counts. These rows are
ranged by their strongest terms, and a task searches its range one tree of
bounded size after the other, keeping k rows an item. Before that, the search
runs over one of ``SEEDS`` of the documents; the k-th scores found there are
reached in the whole table too and start every other task. The seed only saves
work: all documents are searched.

Defined results: null texts and texts without terms are no candidates and count
nowhere; null or empty items have no rows; every row of either table stands
for itself, so equal documents each have a rank and equal items each a list; a
null doc_id comes after others with its score; empty tables give an empty
result; other columns are ignored.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quire.llm.common import documents, portions, written

K = 20
#: Bytes of item texts searched together, and documents of which one starts the bounds.
BLOCK_BYTES, SEEDS = 128 << 10, 16
#: Documents of a leaf and of a tree, items of a leaf, and numbers in a tree's table.
DOC_LEAF, DOC_TREE, ITEM_LEAF, CELLS = 32, 2048, 4, 16 << 20
#: Letters, digits and everything beyond ASCII belong to terms; A-Z are lower-cased.
TABLE = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or chr(b).isalnum() else 32 for b in range(256))
FOUND = "item int, item_id long, doc_id long, score long"


def terms(text: bytes | None) -> list[bytes]:
    return (text or b"").translate(TABLE).split()


def item_terms(items: DataFrame) -> DataFrame:
    """item (row number), item_id, bytes (size of the text), term, n for each
    distinct term of each row of ``items``."""
    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = (pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.int64())
        for batch in batches:
            for s, m in portions(batch.column(2)):
                rows: tuple[list, ...] = ([], [], [], [], [])
                for item, item_id, text in zip(*(c.slice(s, m).to_pylist() for c in batch.columns)):
                    counts = Counter(terms(text))
                    for column, values in zip(rows, ([item] * len(counts), [item_id] * len(counts), [len(text or b"")] * len(counts),
                                                     counts.keys(), counts.values())):
                        column.extend(values)
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(rows, kinds)],
                                                 names=["item", "item_id", "bytes", "term", "n"])

    numbered = items.select(F.monotonically_increasing_id().alias("item"), F.col("item_id").cast("long"),
                            F.col("text").cast("string").cast("binary"))
    return numbered.mapInArrow(split, "item long, item_id long, bytes long, term binary, n long")


def vectors(docs: DataFrame, shared) -> DataFrame:
    """doc_id, n (terms in the text), terms (numbers of those in ``shared``'s
    dictionary) and tf of every row with a term."""
    schema = "doc_id long, n long, terms array<int>, tf array<int>"

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = shared.value.get
        for batch in batches:
            for s, m in portions(batch.column(1)):
                keep, sizes, at, tf = [], [], [], []
                for i, text in enumerate(batch.column(1).slice(s, m).to_pylist()):
                    words = terms(text)
                    if words:
                        found, counts = np.unique([x for x in map(number, words) if x is not None], return_counts=True)
                        keep.append(i)
                        sizes.append(len(words))
                        at.append(found.astype(np.int32))
                        tf.append(counts.astype(np.int32))
                ends = pa.array(np.cumsum([0] + [len(x) for x in at]).astype(np.int32))
                none = np.zeros(0, np.int32)
                lists = [pa.ListArray.from_arrays(ends, pa.array(np.concatenate([none, *x]))) for x in (at, tf)]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(s, m).take(pa.array(keep, pa.int64())), pa.array(sizes, pa.int64()), *lists],
                    names=["doc_id", "n", "terms", "tf"])

    return (docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string").cast("binary"))
            .mapInArrow(count, schema))


def impacts(rows: DataFrame, n_docs: int, n_terms: int, weight: np.ndarray) -> DataFrame:
    """doc_id, terms and impact of ``rows`` (of ``vectors``), with each
    document's two strongest terms (s1, s2: -1 without one)."""
    schema = "s1 int, s2 int, doc_id long, terms array<int>, impact array<int>"

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            offsets, at = np.asarray(batch.column(2).offsets), np.asarray(batch.column(2).flatten()).astype(np.int64)
            tf = np.asarray(batch.column(3).flatten()).astype(np.int64)
            offsets = offsets - offsets[0]
            size = np.diff(offsets)
            m = 75 + (25 * np.asarray(batch.column(1)) * n_docs) // n_terms
            impact = (1_000_000_000 * tf) // (1000 * tf + 12 * np.repeat(m, size))
            # within each document, terms by falling strength
            order = np.lexsort((at, -impact * weight[at], np.repeat(np.arange(len(size)), size)))
            best = np.concatenate((at[order], [-1, -1]))
            s1 = np.where(size > 0, best[offsets[:-1]], -1)
            s2 = np.where(size > 1, best[offsets[:-1] + 1], -1)
            lists = [pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(x.astype(np.int32))) for x in (at, impact)]
            yield pa.RecordBatch.from_arrays([pa.array(s1.astype(np.int32)), pa.array(s2.astype(np.int32)), batch.column(0), *lists],
                                             names=["s1", "s2", "doc_id", "terms", "impact"])

    return rows.where(F.size("terms") > 0).mapInArrow(score, schema)


class ItemTree:
    """Items in an order that brings equal strongest terms together; level 0
    has nodes of ``ITEM_LEAF`` items, each level above joins two. A node knows
    the terms below it and the largest value of each."""

    def __init__(self, items: list[tuple[int, int | None, dict[int, int]]]):
        strongest = lambda q: sorted(q, key=lambda t: (-q[t], t))
        self.items = sorted(items, key=lambda x: (strongest(x[2]), x[0]))
        self.levels: list[list[tuple[int, int, np.ndarray, np.ndarray]]] = []
        self.total = max((sum(q.values()) for _, _, q in items), default=0)
        width = ITEM_LEAF
        while self.items:
            nodes = []
            for s in range(0, len(self.items), width):
                top: dict[int, int] = {}
                for _, _, q in self.items[s:s + width]:
                    for t, v in q.items():
                        top[t] = max(top.get(t, 0), v)
                cols = np.array(sorted(top), np.int64)
                nodes.append((s, min(s + width, len(self.items)), cols, np.array([top[t] for t in cols.tolist()], np.float64)))
            self.levels.append(nodes)
            if len(nodes) == 1:
                break
            width *= 2
        # scores are sums of products of integers: exact in doubles below 2^53, else in 64-bit integers
        self.kind = np.float64 if self.total * 1_000_000 < 1 << 53 else np.int64
        self.leaves = []
        for s, e, cols, _ in self.levels[0] if self.levels else []:
            table = np.zeros((len(cols), e - s), self.kind)
            place = {t: i for i, t in enumerate(cols.tolist())}
            for i, (_, _, q) in enumerate(self.items[s:e]):
                for t, v in q.items():
                    table[place[t], i] = v
            self.leaves.append(table)


class Search:
    """The k best documents of each item so far, over one tree of documents
    after the other. ``floor`` are scores that k documents are known to reach."""

    def __init__(self, tree: ItemTree, k: int, floor: np.ndarray):
        self.tree, self.k = tree, k
        self.weakest = floor.astype(np.float64)
        none = np.zeros(0, np.int64)
        self.best = [(none, none, none) for _ in tree.items]  # score, null doc_id, doc_id

    def add(self, table: np.ndarray, absent: np.ndarray, ids: np.ndarray) -> None:
        """Search ``table`` (documents in order x terms: impacts)."""
        self.rows, self.absent, self.ids = table, absent, ids
        self.nodes = [np.maximum.reduceat(table, np.arange(0, len(table), DOC_LEAF), axis=0)]
        while len(self.nodes[-1]) > 1:
            self.nodes.append(np.maximum.reduceat(self.nodes[-1], np.arange(0, len(self.nodes[-1]), 2), axis=0))
        if self.tree.levels:
            self._open(len(self.tree.levels) - 1, 0, len(self.nodes) - 1, np.zeros(1, np.int64))

    def _open(self, level: int, node: int, height: int, docs: np.ndarray) -> None:
        """Pairs of one item node and document nodes of one height."""
        s, e, cols, top = self.tree.levels[level][node]
        bound = self.nodes[height][docs][:, cols] @ top
        # half a unit more than rounding may lose: a bound is never too low
        docs = docs[(bound > 0) & (bound * (1 + 1e-12) + 0.5 >= self.weakest[s:e].min())]
        if not len(docs):
            return
        if level == 0 and height == 0:
            return self._score(node, docs)
        if height:
            docs = np.concatenate((2 * docs, 2 * docs + 1))
            height -= 1
            docs = np.sort(docs[docs < len(self.nodes[height])])
        if level:
            for child in (2 * node, 2 * node + 1):
                if child < len(self.tree.levels[level - 1]):
                    self._open(level - 1, child, height, docs)
        else:
            self._open(0, node, height, docs)

    def _score(self, node: int, leaves: np.ndarray) -> None:
        s, e, cols, top = self.tree.levels[0][node]
        bound = self.nodes[0][leaves][:, cols] @ top
        order = np.argsort(-bound, kind="stable")
        for i in range(0, len(order), 8):
            part = order[i:i + 8]
            part = part[bound[part] * (1 + 1e-12) + 0.5 >= self.weakest[s:e].min()]
            if not len(part):
                return
            rows = (leaves[part][:, None] * DOC_LEAF + np.arange(DOC_LEAF)).ravel()
            rows = rows[rows < len(self.rows)]
            scores = self.rows[np.ix_(rows, cols)].astype(self.tree.kind) @ self.tree.leaves[node]
            for j in range(s, e):
                mine = scores[:, j - s]
                good = np.flatnonzero((mine > 0) & (mine >= self.weakest[j]))
                if len(good):
                    self._take(j, mine[good].astype(np.int64), rows[good])

    def _take(self, item: int, score: np.ndarray, rows: np.ndarray) -> None:
        held = self.best[item]
        new = [np.concatenate(c) for c in zip(held, (score, self.absent[rows], self.ids[rows]))]
        order = np.lexsort((new[2], new[1], -new[0]))[:self.k]
        self.best[item] = tuple(c[order] for c in new)
        if len(order) == self.k:
            self.weakest[item] = max(self.weakest[item], float(new[0][order[-1]]))

    def found(self) -> list[tuple]:
        return [(item, item_id, None if absent else doc, score)
                for (item, item_id, _), best in zip(self.tree.items, self.best)
                for score, absent, doc in zip(*(c.tolist() for c in best))]


def _searched(ranked: DataFrame, shared, k: int) -> DataFrame:
    """The k best rows of each item in each partition of ``ranked`` (of ``impacts``)."""
    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tree, floor, width = shared.value
        run, many = Search(tree, k, floor), max(DOC_LEAF, min(DOC_TREE, CELLS // max(1, width)))
        table = np.zeros((many, width), np.int32)
        absent, ids, held = np.zeros(many, np.int64), np.zeros(many, np.int64), 0
        for batch in batches:
            offsets = np.asarray(batch.column(1).offsets)
            offsets = (offsets - offsets[0]).tolist()
            at, impact = np.asarray(batch.column(1).flatten()), np.asarray(batch.column(2).flatten())
            null = np.asarray(batch.column(0).is_null()).astype(np.int64)
            doc = np.asarray(batch.column(0).fill_null(0))
            for i in range(batch.num_rows):
                s, e = offsets[i], offsets[i + 1]
                table[held, at[s:e]] = impact[s:e]
                absent[held], ids[held] = null[i], doc[i]
                held += 1
                if held == many:
                    run.add(table, absent, ids)
                    table[:] = 0
                    held = 0
        if held:
            run.add(table[:held], absent[:held], ids[:held])
        cols = list(zip(*run.found())) or [[]] * 4
        kinds = (pa.int32(), pa.int64(), pa.int64(), pa.int64())
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, kinds)], names=["item", "item_id", "doc_id", "score"])

    return ranked.select("doc_id", "terms", "impact").mapInArrow(search, FOUND)


def _ranked(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("item").orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_last())
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def rank_documents(spark: SparkSession, docs: DataFrame, items: DataFrame, k: int = K, block_bytes: int = BLOCK_BYTES,
                   seeds: int = SEEDS) -> DataFrame:
    """item_id, rank, doc_id and score of each item's k best documents."""
    split = written(spark, item_terms(items), "item-terms")
    size = split.groupBy("item").agg(F.max("bytes").alias("bytes")).agg(F.sum("bytes")).first()[0] or 0
    blocks = max(1, -(-size // block_bytes))
    results = []
    for b in range(blocks):
        rows = split.where(F.pmod(F.xxhash64("item"), F.lit(blocks)) == b).collect()  # about ``block_bytes`` of text
        if rows:
            results.append(_block(spark, docs, rows, k, seeds))
    if not results:
        return spark.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    out = results[0]
    for more in results[1:]:
        out = out.unionByName(more)
    return out


def _block(spark: SparkSession, docs: DataFrame, rows: list, k: int, seeds: int) -> DataFrame:
    words = sorted({r["term"] for r in rows})
    number = {bytes(w): i for i, w in enumerate(words)}
    found = written(spark, vectors(docs, spark.sparkContext.broadcast(number)), "item-vectors")
    n_docs, n_terms = found.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
    df = np.zeros(len(words), np.int64)
    for r in found.select(F.explode("terms").alias("t")).groupBy("t").agg(F.count("*").alias("c")).collect():  # a row a term of the block
        df[r["t"]] = r["c"]
    weight = np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * int(c) + 1))) for c in df], np.int64)
    of: dict[int, tuple[int | None, dict[int, int]]] = {}
    for r in rows:
        t = number[bytes(r["term"])]
        if df[t] and weight[t] > 0:
            of.setdefault(r["item"], (r["item_id"], {}))[1][t] = int(r["n"] * weight[t])
    places = {item: i for i, item in enumerate(sorted(of))}
    tree = ItemTree([(places[item], item_id, q) for item, (item_id, q) in of.items()])

    share = F.pmod(F.xxhash64("doc_id", "terms"), F.lit(seeds))
    scored = impacts(found, n_docs, max(1, n_terms), weight)
    start = spark.sparkContext.broadcast((tree, np.zeros(len(tree.items)), len(words)))
    first = _ranked(_searched(impacts(found.where(share == 0), n_docs, max(1, n_terms), weight), start, k), k).where(F.col("rank") == k).select("item", "score").collect()
    floor = np.zeros(len(tree.items))
    position = {item: i for i, (item, _, _) in enumerate(tree.items)}
    for r in first:
        floor[position[r["item"]]] = r["score"]
    ready = spark.sparkContext.broadcast((tree, floor, len(words)))
    # the hash parts documents with equal strongest terms, so that no range is stuck with them
    ranged = scored.withColumn("h", F.xxhash64("doc_id", "terms")).repartitionByRange("s1", "s2", "h").sortWithinPartitions("s1", "s2", "h")
    best = _ranked(_searched(ranged, ready, k), k)
    return best.select("item_id", "rank", "doc_id", "score")


def op13_lexical(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rank_documents(spark, documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


OP13_SQL = rf"""
WITH words AS (
  SELECT r, doc_id, unnest(w) AS term FROM (
    SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS w FROM documents)
), lengths AS (SELECT r, any_value(doc_id) AS doc_id, count(*) AS n FROM words GROUP BY r
), total AS (SELECT count(*)::BIGINT AS all_docs, sum(n)::BIGINT AS all_terms FROM lengths
), items AS (
  SELECT i, item_id, term, count(*) AS q FROM (
    SELECT i, item_id, unnest(w) AS term FROM (
      SELECT row_number() OVER () AS i, item_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS w FROM benchmark))
  GROUP BY i, item_id, term
), tf AS (SELECT r, term, count(*) AS tf FROM words WHERE term IN (SELECT term FROM items) GROUP BY r, term
), weights AS (
  SELECT term, floor(1000 * ln((2 * all_docs + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE))::BIGINT AS w
  FROM tf CROSS JOIN total GROUP BY term, all_docs
), impact AS (
  SELECT tf.r, doc_id, term, (1000000000 * tf) // (1000 * tf + 12 * (75 + (25 * n * all_docs) // all_terms)) AS v
  FROM tf JOIN lengths ON tf.r = lengths.r CROSS JOIN total
), scores AS (
  SELECT i, item_id, r, any_value(doc_id) AS doc_id, sum(q * w * v)::BIGINT AS score
  FROM items JOIN weights USING (term) JOIN impact USING (term) GROUP BY i, item_id, r
)
SELECT item_id, rank::INTEGER AS rank, doc_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY i ORDER BY score DESC, doc_id ASC NULLS LAST) AS rank FROM scores WHERE score > 0)
WHERE rank <= {K}
"""
