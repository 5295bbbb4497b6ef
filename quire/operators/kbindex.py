"""Stored inverted index of a knowledge base.

The index is a folder of tables in segments. A build writes one segment; a
sync adds a segment with the chunks of changed documents and a tombstone for
each document whose older rows are dead, so its cost follows the change, not
the corpus; a compaction writes the live rows as one segment again.

======== =============================================================
chunks   doc_id, chunk_no, dl, text, the filter columns and a bucket of doc_id:
         in files as the chunks came, sorted by bucket
postings term, doc_id, chunk_no, dl, tf, block and the filter columns: in
         partitions by bucket of the term's hash, sorted by term and block
stats    term, df: what the segment adds to (a tombstone: takes from) each
         term's number of chunks; the sum over segments is exact
blocks   term, block, max_tf, min_dl, df: the largest count and least length in
         any chunk of a document block, bounds that stay true when rows die;
         and the block's number of chunks in this segment
totals   n_chunks, sum_dl, likewise to be summed
dead     doc_id: rows of older segments no longer count
manifest which segments a version has; written last, under the next number
         by a claim that only one writer can get
======== =============================================================

A search reads the buckets of its terms only, and in them the row groups whose
statistics admit a term. Filters are columns of the postings: they reach the
scan and restrict what is ranked; term statistics are those of the whole index.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, replace
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quire.functions import text as tx
from quire.functions.filters import compile_filter
from quire.operators.chunk import chunk_fixed
from quire.operators.retrieve import BM25_B, BM25_K1, PART_CHUNKS, LexicalIndex, _bcast_if_small, _query_terms, _topk, _with_id
from quire.operators.sync import ADD, DELETE, UPDATE
from quire.sources.sinks import children, claim_next

#: Partitions of the postings by term and of the chunks by document; blocks of documents for bounds.
TERM_BUCKETS, DOC_BUCKETS, BLOCKS = 32, 32, 64
#: Chunks whose postings a bucket has in one file.
DEAL_CHUNKS = 1 << 16
#: Most frequent terms whose weights go to the postings; postings of others move to their term.
COMMON_TERMS = 1 << 18
#: Question terms that go into the scan as literals; beyond, buckets alone prune.
MAX_LITERALS = 2000
EMPTY = {"chunks": "doc_id long, chunk_no int, text string, dl int, bucket int",
         "postings": "doc_id long, chunk_no int, dl int, term string, tf long, block int, bucket int",
         "stats": "term string, df long, bucket int", "blocks": "term string, block int, max_tf long, min_dl int, df long, bucket int"}


def _bucket(col: str | Column, n: int) -> Column:
    return F.pmod(F.xxhash64(col), F.lit(n)).cast("int")


@dataclass
class StoredIndex(LexicalIndex):
    """A version of a stored index. ``chunks`` and ``postings`` are its live
    rows; the scores of :mod:`quire.operators.retrieve` work on it as on an
    index in memory."""
    path: str = ""
    segments: tuple[int, ...] = ()
    version: int = 0
    meta: tuple[str, ...] = ()
    pruned: Column | None = None  # what admits the terms of a batch of questions

    def where(self, flt: dict | None) -> "StoredIndex":
        """The same index with a metadata filter on what is ranked. Nothing is
        rebuilt: the predicate goes into the scans of both tables."""
        if flt is None:
            return self
        keep = compile_filter(flt)
        return replace(self, chunks=self.chunks.where(keep), postings=self.postings.where(keep))

    def for_terms(self, q: DataFrame) -> "StoredIndex":
        """The same index, reading postings and statistics of the terms in
        ``q`` (a term column) from their buckets and row groups alone."""
        spark = self.chunks.sparkSession
        named = q.select("term").distinct().select("term", _bucket("term", TERM_BUCKETS).alias("bucket"))
        found = named.limit(MAX_LITERALS + 1).collect()
        if len(found) > MAX_LITERALS:  # too many for literals: the join with the terms selects
            return self
        keep = F.col("bucket").isin(sorted({r["bucket"] for r in found})) & F.col("term").isin([r["term"] for r in found])
        return replace(self, postings=self.postings.where(keep), pruned=keep, _idf=None, _sem_max=None)

    def term_stats(self) -> DataFrame:
        """Chunk counts and both idf forms of every term, summed over segments."""
        if self._idf is None:
            n = float(self.n_chunks)
            df_ = self._dfs()
            k = F.lit(BM25_K1) * (F.lit(1.0 - BM25_B) + F.lit(BM25_B) * F.col("min_dl") / F.lit(self.avgdl or 1.0))
            top = self._sums("blocks").groupBy("bucket", "term").agg(F.max(F.col("max_tf") / (F.col("max_tf") + k)).alias("max_tfn"))
            self._idf = df_.join(top, ["bucket", "term"]).select(
                "bucket", "term", "df", "max_tfn",
                F.log(F.lit(1.0) + (F.lit(n) - F.col("df") + 0.5) / (F.col("df") + 0.5)).alias("idf_bm25"),
                self._idf_of("df").alias("idf"))
        return self._idf

    def _dfs(self) -> DataFrame:
        """Each live term's number of chunks."""
        return self._sums("stats").groupBy("bucket", "term").agg(F.sum("df").alias("df")).where("df > 0")

    def _idf_of(self, df: str) -> Column:
        return F.log((F.lit(float(self.n_chunks)) + 1.0) / (F.col(df) + 1.0))

    def _sums(self, table: str) -> DataFrame:
        """Rows of a table of sums or bounds, of all segments."""
        rows = _union([_table(self.chunks.sparkSession, self.path, s, table) for s in self.segments])
        return rows if self.pruned is None else rows.where(self.pruned)

    def norms(self) -> DataFrame:
        """L2 norms of the chunks' TF-IDF vectors. They depend on all term
        statistics, so they are computed once for a version and stored with it.

        The weights of the most frequent terms, which most postings have, go to
        the postings; only postings of rarer terms are shuffled. Of both, one
        sum a chunk and task moves on."""
        if self._norms is None:
            spark, at = self.chunks.sparkSession, f"{self.path}/norms/version={self.version}"
            if "_SUCCESS" not in children(spark, at):
                whole = open_index(spark, self.path, self.version)
                idf = whole._dfs().select("bucket", "term", "df", whole._idf_of("df").alias("idf")).persist()  # a row a term
                bar = _common_bar(idf)
                common, rare = (idf.where(c).drop("df") for c in (F.col("df") >= bar, F.col("df") < bar))
                posts = whole.postings.select("bucket", "term", "doc_id", "chunk_no", "tf")
                squares = posts.join(F.broadcast(common), ["bucket", "term"])
                if bar > 1:
                    others = posts.join(F.broadcast(common.select("bucket", "term")), ["bucket", "term"], "left_anti")
                    squares = squares.unionByName(others.join(rare, ["bucket", "term"]))
                (squares.groupBy("doc_id", "chunk_no").agg(F.sqrt(F.sum((F.col("tf") * F.col("idf")) ** 2)).alias("tfidf_norm"))
                 .write.mode("overwrite").parquet(at))
                idf.unpersist()
            self._norms = spark.read.parquet(at)
        return self._norms

    def unpersist(self) -> None:
        """Nothing is held in memory."""

    def sync(self, plan: DataFrame, new_docs: DataFrame, **chunk_kw) -> "StoredIndex":
        """The version after a sync plan (doc_id, action): documents to add
        or update are chunked and indexed, older rows of updated and deleted
        ones get tombstones, and their terms are taken from the statistics."""
        spark = self.chunks.sparkSession
        self = open_index(spark, self.path, self.version)  # without the filters of a view
        plan = plan.where(F.col("action").isin(ADD, UPDATE, DELETE)).select("doc_id", "action").persist()  # keys of changed documents
        stale = plan.where(F.col("action").isin(UPDATE, DELETE)).select("doc_id")
        fresh = plan.where(F.col("action").isin(ADD, UPDATE)).select("doc_id")
        docs = new_docs.join(fresh, "doc_id", "left_semi")
        stale_at = stale.withColumn("bucket", _bucket("doc_id", DOC_BUCKETS))
        buckets = [r[0] for r in stale_at.select("bucket").distinct().collect()]  # DOC_BUCKETS at most
        old = self.chunks.where(F.col("bucket").isin(buckets)).join(stale_at, ["bucket", "doc_id"], "left_semi")
        segment = claim_next(spark, self.path, "segment")
        _write_segment(spark, self.path, segment, chunk_fixed(docs, **chunk_kw), self.meta, old, stale)
        plan.unpersist()
        return _publish(spark, self.path, (*self.segments, segment), self.version)

    def compact(self) -> "StoredIndex":
        """The live rows as one segment, without tombstones."""
        spark = self.chunks.sparkSession
        self = open_index(spark, self.path, self.version)
        segment = claim_next(spark, self.path, "segment")
        _write_segment(spark, self.path, segment, self.chunks.select("doc_id", "chunk_no", "text", *self.meta), self.meta, None, None)
        return _publish(spark, self.path, (segment,), self.version)


def _at(path: str, segment: int, table: str) -> str:
    return f"{path}/segment={segment}/{table}"


def _union(parts: list[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def _table(spark: SparkSession, path: str, segment: int, table: str) -> DataFrame:
    at = _at(path, segment, table)
    if table in EMPTY and all(c.startswith(("_", ".")) for c in children(spark, at)):
        return spark.createDataFrame([], EMPTY[table])  # a partitioned table without rows has no files
    return spark.read.parquet(at)


def _deal(n: int) -> Column:
    """A number below ``n`` for each chunk: a frequent term or a long document spreads over files."""
    return F.pmod(F.xxhash64("doc_id", "chunk_no"), F.lit(n)).cast("int")


@F.arrow_udf(T.ArrayType(T.StructType([T.StructField("bucket", T.IntegerType()), T.StructField("terms", T.StringType()),
                                       T.StructField("tfs", T.ArrayType(T.IntegerType()))])))
def _counted(words: pa.Array, buckets: pa.Array) -> pa.Array:
    """Each row's distinct words with their counts, one entry a bucket: the
    words joined by a space (a word has none), and a count for each."""
    flat = pc.dictionary_encode(words.flatten())
    code, names = flat.indices.to_numpy(zero_copy_only=False).astype(np.int64), flat.dictionary
    row = np.repeat(np.arange(len(words)), pc.fill_null(pc.list_value_length(words), 0).to_numpy(zero_copy_only=False))
    bucket = np.zeros(len(names), np.int64)
    bucket[code] = buckets.flatten().to_numpy()
    seen, tf = np.unique((row * TERM_BUCKETS + bucket[code]) * max(1, len(names)) + code, return_counts=True)
    group, start = np.unique(seen // max(1, len(names)), return_index=True)
    ends = pa.array(np.r_[start, len(seen)].astype(np.int32))
    terms = pc.binary_join(pa.ListArray.from_arrays(ends, names.take(pa.array(seen % max(1, len(names))))), " ")
    entries = pa.StructArray.from_arrays([pa.array((group % TERM_BUCKETS).astype(np.int32)), terms, pa.ListArray.from_arrays(ends, pa.array(tf.astype(np.int32)))],
                                         names=["bucket", "terms", "tfs"])
    return pa.ListArray.from_arrays(pa.array(np.searchsorted(group // TERM_BUCKETS, np.arange(len(words) + 1)).astype(np.int32)), entries)


def _common_bar(dfs: DataFrame) -> int:
    """The least power of two that at most ``COMMON_TERMS`` terms reach in
    their number of chunks; 1 where all terms are as few."""
    of = {r["e"]: r["n"] for r in dfs.groupBy((F.length(F.bin("df")) - 1).alias("e")).agg(F.count(F.lit(1)).alias("n")).collect()}
    total, bar = 0, 1 + max(of, default=-1)  # a row a power of two
    while bar > 0 and total + of.get(bar - 1, 0) <= COMMON_TERMS:
        bar, total = bar - 1, total + of.get(bar - 1, 0)
    return 1 << bar


def _postings(chunks: DataFrame, meta: tuple[str, ...], deals: int, parts: int) -> DataFrame:
    """The postings of ``chunks``, in order within their files. Words are
    counted inside the chunk's row, and a chunk's words of a bucket move as one
    row, so that no posting carries the chunk's columns through the shuffle."""
    keys = ("doc_id", "chunk_no", "dl", *meta)
    # rows that repeat a chunk's key count together
    twice = bool(chunks.groupBy("doc_id", "chunk_no").count().where("count > 1").limit(1).count())
    w = chunks.select(*keys, tx.word_tokens("text").alias("_w"))
    packed = (w.select(*keys, F.explode(_counted("_w", F.transform("_w", lambda x: _bucket(x, TERM_BUCKETS)))).alias("_p"))
              .select(*keys, "_p.*").withColumn("_deal", _deal(deals)).repartition(parts, "bucket", "_deal"))
    x = packed.select(*keys, "bucket", "_deal", F.explode(F.arrays_zip(F.split("terms", " ").alias("term"), F.col("tfs").alias("tf"))).alias("_t"))
    x = x.select(*keys, "bucket", "_deal", "_t.term", F.col("_t.tf").cast("long").alias("tf"))
    if twice:
        x = x.groupBy("bucket", "_deal", *keys, "term").agg(F.sum("tf").alias("tf"))
    return (x.select("doc_id", "chunk_no", "dl", *meta, "term", "tf", "bucket", _bucket("doc_id", BLOCKS).alias("block"))
            .sortWithinPartitions("bucket", "term", "block", "doc_id", "chunk_no"))


def _write_segment(spark: SparkSession, path: str, segment: int, chunks: DataFrame, meta: tuple[str, ...],
                   old: DataFrame | None, stale: DataFrame | None) -> None:
    """Tables of one segment: rows of ``chunks``, less the counts of ``old``."""
    rows = (chunks.select(F.col("doc_id").cast("long"), "chunk_no", "text", *meta).withColumn("_w", tx.word_tokens("text"))
            .withColumn("dl", F.size("_w")).drop("_w").withColumn("bucket", _bucket("doc_id", DOC_BUCKETS)))
    # texts stay where they are; a file's pages are skipped by its order
    rows.sortWithinPartitions("bucket", "doc_id", "chunk_no").write.parquet(_at(path, segment, "chunks"))
    written = _table(spark, path, segment, "chunks")

    n = written.count()
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), n // PART_CHUNKS)
    (_postings(written, meta, 1 + n // DEAL_CHUNKS, parts)
     .write.partitionBy("bucket").option("parquet.bloom.filter.enabled#term", "true").parquet(_at(path, segment, "postings")))
    own = _table(spark, path, segment, "postings")
    bounds = own.groupBy("bucket", "term", "block").agg(F.max("tf").alias("max_tf"), F.min("dl").alias("min_dl"), F.count(F.lit(1)).alias("df"))
    _write_small(bounds, _at(path, segment, "blocks"))
    df = _table(spark, path, segment, "blocks").groupBy("bucket", "term").agg(F.sum("df").alias("df"))
    totals = written.agg(F.count(F.lit(1)).alias("n_chunks"), F.coalesce(F.sum("dl"), F.lit(0)).cast("long").alias("sum_dl"))
    if old is not None:
        # the terms of each chunk once: the inner key keeps rows that repeat a chunk's key together
        gone = (old.select("doc_id", "chunk_no", "dl", F.explode(F.array_distinct(tx.word_tokens("text"))).alias("term")).distinct()
                .withColumn("bucket", _bucket("term", TERM_BUCKETS)).groupBy("bucket", "term").agg((-F.count(F.lit(1))).alias("df")))
        df = df.unionByName(gone).groupBy("bucket", "term").agg(F.sum("df").alias("df"))
        totals = totals.unionByName(old.agg((-F.count(F.lit(1))).alias("n_chunks"), (-F.coalesce(F.sum("dl"), F.lit(0))).cast("long").alias("sum_dl")))
    _write_small(df, _at(path, segment, "stats"))
    totals.coalesce(1).write.parquet(_at(path, segment, "totals"))
    dead = stale if stale is not None else spark.createDataFrame([], "doc_id long")
    dead.distinct().write.parquet(_at(path, segment, "dead"))


def _write_small(df: DataFrame, path: str) -> None:
    df.repartition("bucket").sortWithinPartitions("bucket", "term").write.partitionBy("bucket").parquet(path)


def _versions(spark: SparkSession, path: str) -> list[int]:
    """Complete versions, in order."""
    found = sorted(int(c.split("=")[1]) for c in children(spark, f"{path}/manifest") if c.startswith("version="))
    return [v for v in found if "_SUCCESS" in children(spark, f"{path}/manifest/version={v}")]


def _publish(spark: SparkSession, path: str, segments: tuple[int, ...], base: int | None = None) -> StoredIndex:
    """The next version. Raises where it builds on ``base`` and another writer
    has published since: its changes would be lost."""
    version = claim_next(spark, f"{path}/manifest", "version")
    if base is not None and _versions(spark, path)[-1] != base:
        raise RuntimeError(f"the index at {path} has moved on from version {base}; sync with the newest one")
    (spark.createDataFrame([(s,) for s in segments], "segment int").coalesce(1)
     .write.mode("overwrite").parquet(f"{path}/manifest/version={version}"))
    return open_index(spark, path, version)


def _live(spark: SparkSession, path: str, segments: tuple[int, ...], table: str) -> DataFrame:
    """Rows of all segments, without those that a later tombstone ended."""
    rows = _union([_table(spark, path, s, table).withColumn("_segment", F.lit(s)) for s in segments])
    if len(segments) > 1:
        ends = _union([_table(spark, path, s, "dead").withColumn("_until", F.lit(s)) for s in segments])
        ends = ends.groupBy(F.col("doc_id").alias("_doc")).agg(F.max("_until").alias("_until"))
        rows = rows.join(ends, (F.col("doc_id") == F.col("_doc")) & (F.col("_segment") < F.col("_until")), "left_anti")
    return rows.drop("_segment")


def open_index(spark: SparkSession, path: str, version: int | None = None) -> StoredIndex:
    """A complete version of the index at ``path``, by default the newest."""
    done = _versions(spark, path)
    if not done or (version is not None and version not in done):
        raise FileNotFoundError(f"no complete index version under {path}")
    version = done[-1] if version is None else version
    segments = tuple(sorted(r[0] for r in spark.read.parquet(f"{path}/manifest/version={version}").collect()))  # a row a segment
    n, dl = _union([_table(spark, path, s, "totals") for s in segments]).agg(
        F.sum("n_chunks"), F.sum("sum_dl")).first()
    chunks = _live(spark, path, segments, "chunks")
    meta = tuple(c for c in chunks.columns if c not in ("doc_id", "chunk_no", "text", "dl", "bucket"))
    return StoredIndex(chunks, _live(spark, path, segments, "postings"), int(n or 0), float(dl / n) if n else 0.0,
                       path=path, segments=segments, version=version, meta=meta)


def write_index(chunks: DataFrame, path: str, meta: tuple[str, ...] = ()) -> StoredIndex:
    """Build the index of ``chunks`` (doc_id, chunk_no, text and the ``meta``
    columns that filters may use) under ``path``, a folder of its own. An empty
    ``path`` gets version 1; an existing index gets a new version of one segment."""
    spark = chunks.sparkSession
    segment = claim_next(spark, path, "segment")
    _write_segment(spark, path, segment, chunks, meta, None, None)
    return _publish(spark, path, (segment,))


def bm25_topk_blocks(idx: StoredIndex, questions: DataFrame, k: int, first: int = 2, qid: str = "qid",
                     question: str = "question") -> DataFrame:
    """R4 with block maxima: exact BM25 top-k that scores, for each question,
    only document blocks that could still hold one of the k best.

    A block's bound is the sum over the question's terms of the score of the
    block's largest count in its shortest chunk. The ``first`` best-bounded
    blocks of a question are scored; their k-th score is the bar that other
    blocks' bounds must reach."""
    qt = _query_terms(questions, qid, question)
    idx = idx.for_terms(qt)
    q = _bcast_if_small(qt.join(idx.term_stats().select("term", "idf_bm25"), "term"))

    def score(tf: str, dl: str) -> Column:
        norm = F.lit(BM25_K1) * (F.lit(1.0 - BM25_B) + F.lit(BM25_B) * F.col(dl) / F.lit(idx.avgdl or 1.0))
        return F.sum(F.col("qtf") * F.col("idf_bm25") * F.col(tf) * (BM25_K1 + 1.0) / (F.col(tf) + norm))

    bounds = (idx._sums("blocks").groupBy("term", "block").agg(F.max("max_tf").alias("max_tf"), F.min("min_dl").alias("min_dl"))
              .join(q, "term").groupBy("qid", "block").agg(score("max_tf", "min_dl").alias("bound")))
    best = _topk(bounds, "qid", F.col("bound"), first, "block", rank="_at").select("qid", "block")

    def scored(pairs: DataFrame) -> DataFrame:
        wanted = q.join(pairs, "qid")
        return _with_id(idx.postings.join(wanted, ["term", "block"]).groupBy("qid", "doc_id", "chunk_no").agg(score("tf", "dl").alias("score")))

    cols = ["qid", "doc_id", "chunk_no", "score", "chunk_id"]
    top = _topk(scored(best), "qid", F.col("score"), k, "chunk_id").select(*cols)
    bar = top.groupBy("qid").agg(F.when(F.count(F.lit(1)) >= k, F.min("score")).otherwise(F.lit(-math.inf)).alias("bar"))
    rest = (bounds.join(best, ["qid", "block"], "left_anti").join(bar, "qid", "left")
            .where(F.col("bound") >= F.coalesce("bar", F.lit(-math.inf)) - 1e-9).select("qid", "block"))
    return _topk(top.unionByName(scored(rest).select(*cols)), "qid", F.col("score"), k, "chunk_id")
