"""Retrieval (R1-R7): lexical, sparse-semantic, dense and hybrid top-k.

Design for scale:

* Lexical and sparse-semantic search are **postings equi-joins on term**,
  never query x corpus products. The index (postings, term and chunk
  statistics) is built once per corpus by grouped aggregates.
* A posting moves once for a batch of questions, to the task that has its
  chunk, however many questions ask for its term. The task holds a bounded
  part of the chunks, sums their scores and passes on the best k a question:
  no (question, chunk) pair is shuffled, sorted or spilled.
* Dense exact search partitions the corpus into KMeans cells and joins
  queries to cells; a triangle-inequality bound decides which further cells
  can still hold a closer vector, so the answer is exact while most
  query/cell pairs are never compared. The approximate variant stops after
  the first ``nprobe`` cells.
* Per-query top-k over the parts' lists is ``row_number() <= k`` over a window,
  which Spark plans with a window-group-limit before the shuffle.
* Scores are doubles; ranking uses the score rounded to 9 places and then
  the id, so ties are broken the same way on every engine.
"""

from __future__ import annotations

import hashlib
import math
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quire.functions import text as tx
from quire.functions.filters import compile_filter
from quire.sources.tables import cluster_by

BM25_K1 = 1.2
BM25_B = 0.75
RRF_K = 60


def _topk(df: DataFrame, key: str, score: Column, k: int, tie: str, desc: bool = True,
          rank: str = "rank") -> DataFrame:
    s = F.round(score, 9)
    w = W.partitionBy(key).orderBy(s.desc() if desc else s.asc(), F.col(tie).asc())
    return df.withColumn(rank, F.row_number().over(w)).where(F.col(rank) <= k)


# -- index
# Largest side (bytes, as stored once computed) this module broadcasts;
# beyond it the join shuffles, with AQE's skew handling.
BROADCAST_MAX_BYTES = 32 << 20


def _measured(df: DataFrame) -> tuple[DataFrame, int]:
    """``df`` persisted, which is what measures it, and its bytes; it is the
    (small) query side or the vocabulary, never the corpus."""
    df = df.persist()
    df.count()
    return df, int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def _bcast_if_small(df: DataFrame, max_bytes: int = BROADCAST_MAX_BYTES) -> DataFrame:
    """Broadcast only behind a check of the measured size; otherwise leave the
    join to a shuffle."""
    df, stored = _measured(df)
    return F.broadcast(df) if stored <= max_bytes else df


def chunk_key_id(doc: str = "doc_id", chunk_no: str = "chunk_no") -> Column:
    """The public chunk id, derived from the compact key only where output."""
    return F.sha2(F.concat(F.col(doc).cast("string"), F.lit(":"), F.col(chunk_no).cast("string")), 256)


@dataclass
class LexicalIndex:
    """Postings clustered by ``doc_id``: scoring joins the (broadcast) query
    terms on the map side and aggregates per chunk without a shuffle."""
    chunks: DataFrame        # doc_id, chunk_no, dl, text   (hash-partitioned by doc_id, cached)
    postings: DataFrame      # doc_id, chunk_no, dl, term, tf  (same partitioning, cached)
    n_chunks: int
    avgdl: float
    _idf: DataFrame | None = None
    _norms: DataFrame | None = None
    _sem_max: DataFrame | None = None

    def term_stats(self) -> DataFrame:
        """df and both idf forms for every term (partial aggregation, then a
        shuffle of one row per term and partition)."""
        if self._idf is None:
            n = float(self.n_chunks)
            df_ = self.postings.groupBy("term").agg(
                F.count(F.lit(1)).alias("df"),
                F.max(_tf_norm(BM25_K1, BM25_B, self.avgdl)).alias("max_tfn"))
            self._idf = df_.select(
                "term", "df", "max_tfn",
                F.log(F.lit(1.0) + (F.lit(n) - F.col("df") + 0.5) / (F.col("df") + 0.5)).alias("idf_bm25"),
                F.log((F.lit(n) + 1.0) / (F.col("df") + 1.0)).alias("idf")).persist()
        return self._idf

    def norms(self) -> DataFrame:
        """L2 norm of every chunk's TF-IDF vector; the idf table is broadcast
        when the vocabulary passes the size check, and the aggregate reuses
        the postings' doc_id partitioning."""
        if self._norms is None:
            idf = _bcast_if_small(self.term_stats().select("term", "idf"))
            w = self.postings.join(idf, "term")
            self._norms = (w.groupBy("doc_id", "chunk_no")
                           .agg(F.sqrt(F.sum((F.col("tf") * F.col("idf")) ** 2)).alias("tfidf_norm"))).persist()
        return self._norms

    def sem_term_max(self) -> DataFrame:
        """Per term, the largest normalised TF-IDF weight ``tf*idf/norm`` any
        chunk gives it (the semantic score's per-term upper bound). One pass
        over the postings joined with the co-partitioned norms."""
        if self._sem_max is None:
            idf = _bcast_if_small(self.term_stats().select("term", "idf"))
            w = (self.postings.join(idf, "term").join(self.norms().where(F.col("tfidf_norm") > 0),
                                                      ["doc_id", "chunk_no"]))
            self._sem_max = (w.groupBy("term")
                             .agg(F.max(F.col("tf") * F.col("idf") / F.col("tfidf_norm")).alias("max_w"))).persist()
        return self._sem_max

    def for_terms(self, q: DataFrame) -> "LexicalIndex":
        """What a batch of questions with the terms of ``q`` needs of the index."""
        return self

    def where(self, flt: dict | None) -> "LexicalIndex":
        """The index with a metadata filter on what is ranked; term statistics
        stay those of the whole. Its chunks must hold the filter's columns."""
        if flt is None:
            return self
        chunks = self.chunks.where(compile_filter(flt))
        rows = self.postings.join(chunks.select("doc_id", "chunk_no"), ["doc_id", "chunk_no"], "left_semi")
        return LexicalIndex(chunks, rows, self.n_chunks, self.avgdl, self.term_stats(), self.norms())

    def unpersist(self) -> None:
        for d in (self.postings, self.chunks, self._idf, self._norms, self._sem_max):
            if d is not None:
                d.unpersist()


def build_index(chunks: DataFrame, text: str = "text", partitions: int | None = None) -> LexicalIndex:
    """Tokenise once and keep postings clustered by document.

    At most one shuffle moves the chunk rows (not the exploded terms) by
    ``doc_id`` - none when the input is already clustered that way; term frequencies then aggregate on ``(doc_id, chunk_no, term)`` inside
    each partition. Chunk count and mean length are two scalars read back
    from the cached chunk table.
    """
    from pyspark import StorageLevel
    meta = [m for m in chunks.columns if m not in ("doc_id", "chunk_no", "text", text)]
    c = (cluster_by(chunks.select("doc_id", "chunk_no", F.col(text).alias("text"), *meta), "doc_id", partitions)
         .withColumn("_w", tx.word_tokens("text")).withColumn("dl", F.size("_w")))
    c = c.persist(StorageLevel.MEMORY_AND_DISK)
    postings = (c.select("doc_id", "chunk_no", "dl", F.explode("_w").alias("term"))
                .groupBy("doc_id", "chunk_no", "dl", "term").agg(F.count(F.lit(1)).alias("tf")))
    postings = postings.persist(StorageLevel.MEMORY_AND_DISK)
    st = c.agg(F.count(F.lit(1)).alias("n"), F.avg("dl").alias("avgdl")).first()
    # Spark's cache manager shares these blocks with any index built from the
    # same plan; the block manager spills or drops them under memory
    # pressure, and ``LexicalIndex.unpersist`` releases them explicitly.
    return LexicalIndex(c.drop("_w"), postings, int(st["n"]), float(st["avgdl"] or 0.0))


def _query_terms(questions: DataFrame, qid: str, question: str) -> DataFrame:
    return (questions.select(F.col(qid).alias("qid"), F.explode(tx.word_tokens(question)).alias("term"))
            .groupBy("qid", "term").agg(F.count(F.lit(1)).alias("qtf")))


def _with_id(df: DataFrame) -> DataFrame:
    return df.withColumn("chunk_id", chunk_key_id())


def _tf_norm(k1: float, b: float, avgdl: float) -> Column:
    """BM25 saturation ``tf / (tf + k1*(1-b+b*dl/avgdl))`` of a posting."""
    return F.col("tf") / (F.col("tf") + F.lit(k1) * (F.lit(1.0 - b) + F.lit(b) * F.col("dl") / F.lit(avgdl or 1.0)))


# -- scores: a question's weight of a term times what a chunk gives the term
#: Chunks a task scores together, and questions whose lists it passes on at once.
PART_CHUNKS, PART_QUESTIONS = 8192, 64
#: Values nearer than this may round to the same 9 places.
ROUND_SLACK = 2e-9


def _pair_scores(idx: LexicalIndex, q: DataFrame, bm25: tuple[float, float] | None) -> DataFrame:
    """``score`` and ``essential`` of every (question, chunk) with a common
    term; ``q`` holds qid, term, w, essential (size-checked into the postings
    scan). ``bm25`` has (k1, b), ``None`` means TF-IDF over the chunk's norm."""
    x = _tf_norm(*bm25, idx.avgdl) if bm25 else F.col("tf")
    hits = (idx.postings.join(_bcast_if_small(q), "term").groupBy("qid", "doc_id", "chunk_no")
            .agg(F.sum(F.col("w") * x).alias("score"), F.max("essential").alias("essential")))
    if bm25:
        return hits
    hits = hits.join(idx.norms().where(F.col("tfidf_norm") > 0), ["doc_id", "chunk_no"])
    return hits.withColumn("score", F.col("score") / F.col("tfidf_norm")).drop("tfidf_norm")


def _best(v: np.ndarray, k: int, order) -> np.ndarray:
    """Places of the k largest of ``v`` above zero, with those that rounding
    may raise to them; of equal values the first k in ``order()``."""
    at = np.flatnonzero(v > 0)
    if len(at) > k:
        at = at[v[at] >= np.partition(v[at], len(at) - k)[len(at) - k] - ROUND_SLACK]
    if len(at) > k and order is not None:
        at = at[np.lexsort((order()[at], -v[at]))]
        first = np.flatnonzero(np.r_[True, v[at[1:]] != v[at[:-1]]])
        at = at[np.arange(len(at)) - np.repeat(first, np.diff(np.r_[first, len(at)])) < k]
    return at


def _codes(values: pa.ChunkedArray) -> tuple[np.ndarray, pa.Array]:
    """Each value's place among the distinct ones (null is one), and these."""
    d = pc.dictionary_encode(pa.concat_arrays(values.chunks), null_encoding="encode")
    return d.indices.to_numpy(zero_copy_only=False).astype(np.int64), d.dictionary


def _part_scorer(asked, qids: pa.Array, k: int, bm25: tuple[float, float] | None, avgdl: float, candidates: bool, named: bool):
    """The task of :func:`_best_of_parts`. ``asked`` is a broadcast of the
    questions' terms, by question: numbers of question and term, weight,
    essential."""

    def run(batches):
        batches = [x for x in batches if x.num_rows]
        if not batches:
            return
        t = pa.Table.from_batches(batches)
        (doc, docs), (no, nos) = _codes(t["doc_id"]), _codes(t["chunk_no"])
        keys, chunk = np.unique(doc * len(nos) + no, return_inverse=True)
        n, term, x = len(keys), t["tid"].to_numpy(), t["tf"].to_numpy().astype(np.float64)
        norm = np.ones(n)
        if bm25:
            x = x / (x + bm25[0] * ((1.0 - bm25[1]) + bm25[1] * t["dl"].to_numpy() / (avgdl or 1.0)))
        else:  # rows without a term are norms; a chunk without one has no score
            of = term < 0
            norm[:] = np.inf
            norm[chunk[of]] = t["norm"].to_numpy()[of]
            term, chunk, x = term[~of], chunk[~of], x[~of]
        by = np.lexsort((chunk, term))
        term, chunk, x = term[by], chunk[by], x[by]
        # a chunk key that comes with several lengths has a posting for each
        first = np.flatnonzero(np.r_[True, (term[1:] != term[:-1]) | (chunk[1:] != chunk[:-1])][:len(term)])
        term, chunk, x = term[first], chunk[first], np.add.reduceat(x, first) if len(first) else x
        cached: list[np.ndarray] = []

        def by_id() -> np.ndarray:
            """Rank of each chunk by its public id (:func:`chunk_key_id`)."""
            if not cached:
                d, c = docs.to_pylist(), nos.to_pylist()
                pairs = [(d[x // len(c)], c[x % len(c)]) for x in keys.tolist()]
                ids = ["" if None in x else hashlib.sha256(f"{x[0]}:{x[1]}".encode()).hexdigest() for x in pairs]
                rank = np.empty(n, np.int64)
                rank[sorted(range(n), key=ids.__getitem__)] = np.arange(n)
                cached.append(rank)
            return cached[0]

        question, number, w, essential = asked.value
        lo, hi = np.searchsorted(term, number, "left"), np.searchsorted(term, number, "right")
        ends = np.searchsorted(question, np.arange(len(qids) + 1))
        for q0 in range(0, len(qids), PART_QUESTIONS):
            found = []
            for q in range(q0, min(q0 + PART_QUESTIONS, len(qids))):
                total, candidate = np.zeros(n), np.zeros(n, bool)
                for j in range(ends[q], ends[q + 1]):
                    at = chunk[lo[j]:hi[j]]
                    total[at] += w[j] * x[lo[j]:hi[j]]
                    if candidates and essential[j]:
                        candidate[at] = True
                total = np.where(candidate, total / norm, 0.0) if candidates else total / norm
                at = _best(total, k, by_id if named else None)
                found.append((np.full(len(at), q), keys[at], total[at]))
            q, at, v = (np.concatenate(c) for c in zip(*found, strict=True))
            yield pa.RecordBatch.from_arrays([qids.take(pa.array(q)), docs.take(pa.array(at // len(nos))), nos.take(pa.array(at % len(nos))),
                                              pa.array(v)], names=["qid", "doc_id", "chunk_no", "score"])

    return run


def _best_of_parts(idx: LexicalIndex, q: DataFrame, k: int, bm25: tuple[float, float] | None = None, candidates: bool = False) -> DataFrame:
    """The scores of :func:`_pair_scores` above zero (``candidates``: of chunks
    with an essential term) that can be among a question's k best.

    The batch's postings are dealt by chunk, so that a task sums all scores of
    a bounded number of chunks in arrays and returns each question's best k of
    them. A batch of questions beyond the size check is joined and shuffled."""
    q, stored = _measured(q)
    if stored > BROADCAST_MAX_BYTES:
        s = _pair_scores(idx, q, bm25).where(F.col("score") > 0)
        return (s.where("essential") if candidates else s).select("qid", "doc_id", "chunk_no", "score")
    spark, posts = q.sparkSession, idx.postings
    rows = q.select("qid", "term", "w", "essential").orderBy("qid", "term").toArrow()  # the measured batch of questions
    if not rows.num_rows:
        return spark.createDataFrame([], T.StructType([q.schema["qid"], posts.schema["doc_id"], posts.schema["chunk_no"], T.StructField("score", T.DoubleType())]))
    (question, qids), (number, terms) = _codes(rows["qid"]), _codes(rows["term"])
    asked = spark.sparkContext.broadcast((question, number, rows["w"].to_numpy(), rows["essential"].to_numpy()))
    tids = spark.createDataFrame([(x, i) for i, x in enumerate(terms.to_pylist())], "term string, tid int")
    hits = posts.join(F.broadcast(tids), "term").select("doc_id", "chunk_no", "tid", "tf", *(["dl"] if bm25 else []))
    if not bm25:
        norms = idx.norms().where((F.col("tfidf_norm") > 0) & F.col("doc_id").isNotNull() & F.col("chunk_no").isNotNull())
        hits = hits.withColumn("norm", F.lit(None).cast("double")).unionByName(norms.select(
            "doc_id", "chunk_no", F.lit(-1).alias("tid"), F.lit(0).cast("long").alias("tf"), F.col("tfidf_norm").alias("norm")))
    of = {f.name: f for f in hits.schema.fields}
    named = all(isinstance(of[c].dataType, (T.IntegralType, T.StringType)) for c in ("doc_id", "chunk_no"))
    schema = T.StructType([T.StructField("qid", q.schema["qid"].dataType), T.StructField("doc_id", of["doc_id"].dataType),
                           T.StructField("chunk_no", of["chunk_no"].dataType), T.StructField("score", T.DoubleType())])
    parts = max(1, -(-idx.n_chunks // PART_CHUNKS))
    return hits.repartition(parts, "doc_id", "chunk_no").mapInArrow(_part_scorer(asked, qids, k, bm25, idx.avgdl, candidates, named), schema)


def _bm25_weights(idx: LexicalIndex, qt: DataFrame, k1: float) -> DataFrame:
    """Questions' terms with their weight; only these terms' idf rows are computed."""
    idf = idx.term_stats().select("term", "df", "idf_bm25", "max_tfn").join(qt.select("term").distinct(), "term", "left_semi")
    return qt.join(idf, "term").withColumn("w", F.col("qtf") * F.col("idf_bm25") * F.lit(k1 + 1.0)).withColumn("essential", F.lit(True))


def bm25_scores(idx: LexicalIndex, questions: DataFrame, qid: str = "qid",
                question: str = "question", k1: float = BM25_K1, b: float = BM25_B) -> DataFrame:
    """R4 scores of every (question, chunk) with a common term: sum over query
    terms of qtf * idf * tf*(k1+1)/(tf + k1*(1-b+b*dl/avgdl))."""
    qt = _query_terms(questions, qid, question)
    idx = idx.for_terms(qt)
    q = _bm25_weights(idx, qt, k1).select("qid", "term", "w", "essential")
    return _pair_scores(idx, q, (k1, b)).drop("essential")


def _bm25_topk_full(idx: LexicalIndex, questions: DataFrame, k: int, qid: str = "qid", question: str = "question",
                    k1: float = BM25_K1, b: float = BM25_B) -> DataFrame:
    qt = _query_terms(questions, qid, question)
    idx = idx.for_terms(qt)
    q = _bm25_weights(idx, qt, k1).select("qid", "term", "w", "essential")
    return _topk(_with_id(_best_of_parts(idx, q, k, (k1, b))), "qid", F.col("score"), k, "chunk_id")


COMMON_DF_FRACTION = 0.05


def _settled(top: DataFrame, bound: DataFrame, k: int) -> DataFrame:
    """Questions whose candidates hold their k best: no other chunk reaches
    ``ub_ne``, which is below the k-th candidate."""
    theta = top.groupBy("qid").agg(F.min("score").alias("theta"), F.count(F.lit(1)).alias("n"))
    return _bcast_if_small(theta.join(bound, "qid", "left").where(
        (F.col("n") >= k) & (F.coalesce(F.col("ub_ne"), F.lit(0.0)) < F.col("theta") - F.lit(1e-9))).select("qid"))


def bm25_topk(idx: LexicalIndex, questions: DataFrame, k: int, prune: bool = False,
              common_df_fraction: float = COMMON_DF_FRACTION,
              qid: str = "qid", question: str = "question",
              k1: float = BM25_K1, b: float = BM25_B) -> DataFrame:
    """Exact BM25 top-k, with ``prune`` by max-score pruning of common
    terms.

    Terms in more than ``common_df_fraction`` of the chunks are
    *non-essential*. Candidates are the chunks matching an essential term;
    their full score adds the non-essential terms. A chunk outside the
    candidates matches only non-essential terms, so its score is at most
    ``sum(qtf * idf * (k1+1) * max_tfn)`` over those terms. Where that bound
    is below the k-th candidate score the candidate top-k is exact; the
    remaining questions are scored over all postings. The result equals the
    unpruned ranking.
    """
    if not prune or (k1, b) != (BM25_K1, BM25_B):
        return _bm25_topk_full(idx, questions, k, qid=qid, question=question, k1=k1, b=b)
    qs = questions.select(F.col(qid).alias("qid"), F.col(question).alias("question"))
    qt = _query_terms(qs, "qid", "question")
    idx = idx.for_terms(qt)
    q = _bm25_weights(idx, qt, k1).withColumn("essential", F.col("df") <= F.lit(common_df_fraction * idx.n_chunks)).persist()
    top = _topk(_with_id(_best_of_parts(idx, q, k, (k1, b), candidates=True)), "qid", F.col("score"), k, "chunk_id").persist()
    bound = q.where(~F.col("essential")).groupBy("qid").agg(F.sum(F.col("w") * F.col("max_tfn")).alias("ub_ne"))
    exact = _settled(top, bound, k)
    rest = qs.join(exact, "qid", "left_anti")
    return top.join(exact, "qid", "left_semi").unionByName(_bm25_topk_full(idx, rest, k, k1=k1, b=b).select(*top.columns))


def _semantic_weights(idx: LexicalIndex, qt: DataFrame) -> DataFrame:
    """Questions' terms with their weight in the cosine, of questions with a norm above zero."""
    idf = idx.term_stats().select("term", "df", "idf").join(qt.select("term").distinct(), "term", "left_semi")
    q = qt.join(idf, "term").withColumn("wq", F.col("qtf") * F.col("idf"))
    qn = q.groupBy("qid").agg(F.sqrt(F.sum(F.col("wq") ** 2)).alias("qnorm")).where(F.col("qnorm") > 0)
    return q.join(qn, "qid").withColumn("w", F.col("wq") * F.col("idf") / F.col("qnorm")).withColumn("essential", F.lit(True))


def _distances(scores: DataFrame) -> DataFrame:
    return _with_id(scores.select("qid", "doc_id", "chunk_no", "score",
                                  F.sqrt(F.greatest(F.lit(0.0), F.lit(2.0) - F.lit(2.0) * F.col("score"))).alias("distance")))


def semantic_scores(idx: LexicalIndex, questions: DataFrame, qid: str = "qid",
                    question: str = "question") -> DataFrame:
    """Sparse semantic similarity: cosine of L2-normalised TF-IDF vectors
    (IDF ``ln((N+1)/(df+1))``), as a postings join. ``distance`` is the L2
    distance of the unit vectors, ``sqrt(2 - 2 cos)``. Chunks sharing no
    term with the question have similarity 0 and are not returned."""
    qt = _query_terms(questions, qid, question)
    idx = idx.for_terms(qt)
    return _distances(_pair_scores(idx, _semantic_weights(idx, qt).select("qid", "term", "w", "essential"), None))


def _semantic_topk_full(idx: LexicalIndex, questions: DataFrame, k: int) -> DataFrame:
    qt = _query_terms(questions, "qid", "question")
    idx = idx.for_terms(qt)
    q = _semantic_weights(idx, qt).select("qid", "term", "w", "essential")
    return _topk(_distances(_best_of_parts(idx, q, k)), "qid", F.col("score"), k, "chunk_id")


def semantic_topk(idx: LexicalIndex, questions: DataFrame, k: int, prune: bool = False,
                  common_df_fraction: float = COMMON_DF_FRACTION,
                  qid: str = "qid", question: str = "question") -> DataFrame:
    """Sparse semantic top-k with the same exact max-score pruning as
    :func:`bm25_topk`: a chunk matching only common terms has cosine at most
    ``sum(wq / qnorm * max_w)`` over those terms."""
    qs = questions.select(F.col(qid).alias("qid"), F.col(question).alias("question"))
    if not prune:
        return _semantic_topk_full(idx, qs, k)
    qt = _query_terms(qs, "qid", "question")
    idx = idx.for_terms(qt)
    q = _semantic_weights(idx, qt).withColumn("essential", F.col("df") <= F.lit(common_df_fraction * idx.n_chunks)).persist()
    top = _topk(_distances(_best_of_parts(idx, q, k, candidates=True)), "qid", F.col("score"), k, "chunk_id").persist()
    bound = (q.where(~F.col("essential")).join(idx.sem_term_max(), "term")
             .groupBy("qid").agg(F.sum(F.col("wq") / F.col("qnorm") * F.col("max_w")).alias("ub_ne")))
    exact = _settled(top, bound, k)
    rest = qs.join(exact, "qid", "left_anti")
    return top.join(exact, "qid", "left_semi").unionByName(_semantic_topk_full(idx, rest, k).select(*top.columns))


def hybrid_topk(idx: LexicalIndex, questions: DataFrame, k: int, depth: int = 10,
                search_type: str = "HYBRID", **kw) -> DataFrame:
    """``SEMANTIC`` or ``HYBRID``. Hybrid fuses the top-``depth`` lexical
    and semantic lists (at least ``k`` of each) by reciprocal rank fusion
    (constant 60). The fusion is a union + grouped sum, not a join."""
    depth = max(depth, k)
    if search_type == "SEMANTIC":
        return semantic_topk(idx, questions, k, **kw).select("qid", "doc_id", "chunk_no", "chunk_id", "score", "rank")
    if search_type != "HYBRID":
        raise ValueError(f"search_type must be HYBRID or SEMANTIC, got {search_type!r}")
    cols = ["qid", "doc_id", "chunk_no", "chunk_id", "rank"]
    lex = bm25_topk(idx, questions, depth, **kw).select(*cols)
    sem = semantic_topk(idx, questions, depth, **kw).select(*cols)
    fused = (lex.unionByName(sem)
             .groupBy("qid", "doc_id", "chunk_no", "chunk_id")
             .agg(F.sum(F.lit(1.0) / (F.lit(float(RRF_K)) + F.col("rank"))).alias("score")))
    return _topk(fused, "qid", F.col("score"), k, "chunk_id")


# -- dense
def l2(a, b) -> Column:
    """Euclidean distance of two numeric arrays, in double."""
    a = F.col(a) if isinstance(a, str) else a
    b = F.col(b) if isinstance(b, str) else b
    sq = F.zip_with(a, b, lambda x, y: (x.cast("double") - y.cast("double")) * (x.cast("double") - y.cast("double")))
    return F.sqrt(F.aggregate(sq, F.lit(0.0), lambda acc, v: acc + v))


@dataclass
class CellIndex:
    corpus: DataFrame          # id, vec, cell
    cells: DataFrame           # cell, c (centroid), r (radius), n (size): n_cells rows
    n_cells: int


def build_cells(corpus: DataFrame, id_col: str = "vec_id", vec: str = "embedding",
                n_cells: int | None = None, seed: int = 7, max_iter: int = 10) -> CellIndex:
    """Partition vectors into KMeans cells (Spark ML, distributed Lloyd
    steps). ``n_cells`` defaults to a quarter of the square root of the number
    of vectors, 16 at least, so cells grow in number and in size with the
    corpus and the centroid table stays small (8,000 rows for a billion
    vectors); radius and size per cell come from one grouped aggregate; the
    corpus stays distributed and keeps its other columns for filters."""
    from pyspark.ml.clustering import KMeans
    from pyspark.ml.functions import array_to_vector

    spark = corpus.sparkSession
    n_cells = n_cells or max(16, math.isqrt(corpus.count()) // 4)
    others = [c for c in corpus.columns if c not in (id_col, vec, "id", "vec", "cell")]
    v = corpus.select(F.col(id_col).alias("id"), F.col(vec).alias("vec"), *others,
                      array_to_vector(F.col(vec)).alias("_features"))
    model = KMeans(k=n_cells, seed=seed, maxIter=max_iter, featuresCol="_features",
                   predictionCol="cell", initMode="k-means||").fit(v)
    cents = spark.createDataFrame([(i, [float(x) for x in c]) for i, c in enumerate(model.clusterCenters())],
                                  "cell int, c array<double>")
    assigned = model.transform(v).drop("_features").join(F.broadcast(cents), "cell")
    assigned = assigned.withColumn("dcell", l2(F.col("vec"), F.col("c"))).drop("c")
    st = assigned.groupBy("cell").agg(F.max("dcell").alias("r"), F.count(F.lit(1)).alias("n"))
    cells = (cents.join(st, "cell", "left")
             .select("cell", "c", F.coalesce("r", F.lit(0.0)).alias("r"), F.coalesce("n", F.lit(0)).alias("n"))
             .persist())
    cells.count()
    return CellIndex(assigned.select("id", "vec", "cell", *others), cells, len(model.clusterCenters()))


def _with_cell_dists(q: DataFrame, idx: CellIndex) -> DataFrame:
    """Adds ``_cd``: the query's non-empty cells as ``struct<d, cell, r, n>``
    sorted by distance to the centroid. Each query meets each centroid by an
    equi-join on the cell id against the bounded, broadcast centroid table."""
    qc = (q.select("qid", "qvec", F.explode(F.sequence(F.lit(0), F.lit(idx.n_cells - 1))).alias("cell"))
          .join(F.broadcast(idx.cells.where(F.col("n") > 0)), "cell"))
    cd = (qc.select("qid", F.struct(l2(F.col("qvec"), F.col("c")).alias("d"), "cell", "r", "n").alias("s"))
          .groupBy("qid").agg(F.array_sort(F.collect_list("s")).alias("_cd")))
    return q.join(cd, "qid")


def _probe(queries: DataFrame, idx: CellIndex, cells_col: str, k: int) -> DataFrame:
    """Nearest vectors of each query in the cells it opens, at least its k
    best. A task reads vectors and keeps the best k of each query, so that
    pairs are never shuffled; a batch of queries beyond the size check is
    joined and shuffled."""
    queries, stored = _measured(queries.select("qid", "qvec", F.col(cells_col).alias("cells")))
    if stored > BROADCAST_MAX_BYTES:
        j = queries.select("qid", "qvec", F.explode("cells").alias("cell")).join(idx.corpus, "cell")
        pairs = j.select("qid", F.col("id"), l2("qvec", "vec").alias("distance"))
    else:
        types = T.StructType([T.StructField("qid", queries.schema["qid"].dataType), T.StructField("id", idx.corpus.schema["id"].dataType),
                              T.StructField("distance", T.DoubleType())])
        rows = queries.where(F.size("cells") > 0).orderBy("qid").toArrow()  # the measured batch of queries
        if not rows.num_rows:
            return queries.sparkSession.createDataFrame([], types)
        vecs = np.array(rows["qvec"].to_pylist(), np.float64)
        opened: dict[int, list[int]] = {}
        for q, cells in enumerate(rows["cells"].to_pylist()):
            for c in set(cells):
                opened.setdefault(c, []).append(q)
        asked = queries.sparkSession.sparkContext.broadcast((vecs, {c: np.array(q) for c, q in opened.items()}))
        corpus = idx.corpus.select("id", "vec", F.col("cell").cast("int").alias("cell")).where(F.col("cell").isin(sorted(opened)))
        pairs = corpus.mapInArrow(_nearest(asked, pa.concat_arrays(rows["qid"].chunks), k), types)
    # a vector may stand in several of the opened cells
    return pairs.dropDuplicates(["qid", "id"])


def _nearest(asked, qids: pa.Array, k: int):
    """The task of :func:`_probe`. ``asked`` is a broadcast of the query
    vectors and, for each cell, the numbers of the queries that open it."""

    def cut(ids: list, d: np.ndarray) -> list[int]:
        """Places of a query's k nearest ids, each once, with those that
        rounding may raise to them; of equal distances the k first by id."""
        at, most = np.arange(len(d)), 2 * k  # an id may come more than once
        while most < len(d):
            at = np.flatnonzero(~(d > np.partition(d, most - 1)[most - 1] + ROUND_SLACK))
            if len({ids[i] for i in at}) >= k:
                break
            at, most = np.arange(len(d)), 4 * most
        keep, seen, equal, bar = [], set(), 0, math.inf
        # NaN comes last and null first, as in Spark's order
        for i in sorted(at.tolist(), key=lambda i: (d[i] != d[i], d[i], ids[i] is not None, ids[i])):
            if len(seen) >= k and d[i] > bar + ROUND_SLACK:
                break
            if ids[i] in seen:
                continue
            equal = equal + 1 if keep and d[i] == d[keep[-1]] else 1
            seen.add(ids[i])
            if equal <= k:
                keep.append(i)
            if len(seen) == k:
                bar = d[i]
        return keep

    def run(batches):
        vecs, opened = asked.value
        norms = (vecs * vecs).sum(1)
        best: dict[int, tuple[list, np.ndarray]] = {}
        id_type = None
        for t in batches:
            if not t.num_rows:
                continue
            id_type, ids, cell = t["id"].type, t["id"].to_pylist(), t["cell"].to_numpy()
            x = t["vec"].flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(t.num_rows, -1)
            for c in np.unique(cell):
                qs, rows = opened[int(c)], np.flatnonzero(cell == c)
                y = x[rows]
                y2 = (y * y).sum(1)
                near = norms[qs][:, None] - 2.0 * vecs[qs] @ y.T + y2[None]  # squared distances, but for rounding
                for q, v, slack in zip(qs.tolist(), near, 1e-11 * (norms[qs] + y2.max()), strict=True):
                    ids_q, d_q = best.get(q, ([], np.zeros(0)))
                    bar = np.partition(d_q, k - 1)[k - 1] if len(d_q) >= k else math.inf
                    at = np.flatnonzero(~(v > (bar + ROUND_SLACK) ** 2 + slack))
                    if len(at):
                        diff = y[at] - vecs[q]
                        got, d = ids_q + [ids[i] for i in rows[at].tolist()], np.r_[d_q, np.sqrt((diff * diff).sum(1))]
                        keep = cut(got, d)
                        best[q] = [got[i] for i in keep], d[keep]
        for q, (got, d) in best.items():
            yield pa.RecordBatch.from_arrays([qids.take(pa.array(np.full(len(got), q))), pa.array(got, id_type), pa.array(d)],
                                             names=["qid", "id", "distance"])

    return run


def knn(idx: CellIndex, queries: DataFrame, k: int, nprobe: int = 2, exact: bool = True,
        qid: str = "qid", qvec: str = "qvec") -> DataFrame:
    """Top-k nearest by L2 for a batch of query vectors (R1 exact, R2 approx).

    Pass 1 probes each query's ``nprobe`` nearest cells. When ``exact``,
    pass 2 probes every other cell whose lower bound ``d(q, centroid) -
    radius`` does not exceed the k-th distance found so far (all of them if
    fewer than k were found), then the two candidate sets are merged.
    """
    q = queries.select(F.col(qid).alias("qid"), F.col(qvec).alias("qvec"))
    q = _with_cell_dists(q, idx)
    first = q.withColumn("_p1", F.transform(F.slice("_cd", 1, nprobe), lambda s: s["cell"]))
    c1 = _topk(_probe(first, idx, "_p1", k), "qid", F.col("distance"), k, "id", desc=False).persist()  # k rows a query
    if not exact:
        return c1
    kth = c1.groupBy("qid").agg(F.max("distance").alias("_dk"), F.count(F.lit(1)).alias("_nk"))
    second = (q.join(kth, "qid", "left")
              .withColumn("_bound", F.when(F.coalesce(F.col("_nk"), F.lit(0)) < k, F.lit(math.inf))
                          .otherwise(F.col("_dk")))
              .withColumn("_p2", F.transform(
                  F.filter(F.slice("_cd", nprobe + 1, 1 << 30),
                           lambda s: (s["d"] - s["r"]) <= F.col("_bound") + F.lit(1e-9)),
                  lambda s: s["cell"])))
    c2 = _probe(second, idx, "_p2", k)
    both = c1.select("qid", "id", "distance").unionByName(c2).dropDuplicates(["qid", "id"])
    return _topk(both, "qid", F.col("distance"), k, "id", desc=False)


def knn_filtered(corpus: DataFrame, queries: DataFrame, k: int, flt: dict | None,
                 id_col: str = "vec_id", vec: str = "embedding", **kw) -> DataFrame:
    """R1 with a metadata filter applied **before** ranking: cells belong to
    the whole corpus (pass ``idx`` to use them for many filters; a cell's
    radius bounds any part of it) and the rows compared are the filtered ones."""
    idx = kw.pop("idx", None) or build_cells(corpus, id_col, vec, n_cells=kw.pop("n_cells", None))
    return knn(CellIndex(idx.corpus.where(compile_filter(flt)), idx.cells, idx.n_cells), queries, k, **kw)


def knn_sharded(idx: CellIndex, queries: DataFrame, k: int, shards: int = 2, **kw) -> DataFrame:
    """Each shard of the corpus (by hash of the id) is searched for its
    own top-k, and the shards' lists are merged per query."""
    of = F.pmod(F.xxhash64("id"), F.lit(shards))
    local = [knn(CellIndex(idx.corpus.where(of == s), idx.cells, idx.n_cells), queries, k, **kw)
             .select("qid", "id", "distance") for s in range(shards)]
    return _topk(reduce(DataFrame.unionByName, local), "qid", F.col("distance"), k, "id", desc=False)


# -- answering
# Own wording of the answer prompt; placeholders are filled in one pass.
ANSWER_PROMPT = ("You answer questions using only the search results below. If they do not contain "
                 "the answer, say that no exact answer was found. Answer in one or two sentences.\n"
                 "Search results in numbered order:\n$search_results$\n"
                 "Current time: $current_time$\n"
                 "Question: $query$\n"
                 "$output_format_instructions$")


def fill_template(template: str, values: dict[str, Column]) -> Column:
    """Replace ``$name$`` placeholders in one pass (text inserted for one
    placeholder is never re-scanned for another)."""
    import re
    parts = re.split(r"(\$[a-z_]+\$)", template)
    cols = []
    for p in parts:
        if p.startswith("$") and p.endswith("$") and p[1:-1] in values:
            cols.append(values[p[1:-1]])
        elif p:
            cols.append(F.lit(p))
    return F.concat(*cols)


def numbered_results(results: Column) -> Column:
    """``1. text\\n2. text ...`` from ``array<struct<rank, text>>`` (sorted)."""
    return F.array_join(F.transform(F.array_sort(results), lambda x: F.concat(
        x["rank"].cast("string"), F.lit(". "), x["text"])), "\n")


def with_text(ranked: DataFrame, idx: LexicalIndex) -> DataFrame:
    """Ranked chunks with their text: the lists (size-checked) go to the chunks."""
    return _bcast_if_small(ranked).join(idx.chunks.select("doc_id", "chunk_no", "text"), ["doc_id", "chunk_no"])


def context_prompt(ranked: DataFrame, questions: DataFrame, current_time: str,
                   template: str = ANSWER_PROMPT, output_format: str = "") -> DataFrame:
    """One prompt per question from its ranked results."""
    ctx = (ranked.groupBy("qid")
           .agg(F.array_sort(F.collect_list(F.struct("rank", "text"))).alias("results")))
    j = questions.join(ctx, "qid", "left").withColumn(
        "results", F.coalesce("results", F.array().cast("array<struct<rank:int,text:string>>")))
    prompt = fill_template(template, {"search_results": numbered_results(F.col("results")),
                                      "current_time": F.lit(current_time), "query": F.col("question"),
                                      "output_format_instructions": F.lit(output_format)})
    return j.withColumn("prompt", prompt)


CITATIONS = ("array<struct<retrievedReferences:array<struct<content:struct<text:string>,"
             "location:struct<uri:string>>>>>")


def flatten_citations(citations) -> Column:
    """Citations -> references -> text, order and duplicates kept."""
    c = F.col(citations) if isinstance(citations, str) else citations
    return F.flatten(F.transform(c, lambda ci: F.transform(ci["retrievedReferences"],
                                                          lambda r: r["content"]["text"])))
