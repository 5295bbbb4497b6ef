"""Approximate nearest neighbours by inner product with a hash-prefix forest.

Vectors get one more component, sqrt(M^2 - |x|^2) with M the largest norm,
which turns the largest inner product into the smallest angle. A tree is the
sorted array of the vectors' hash strings: ``BITS`` signs of random
projections, as integers. A query descends each tree to its longest common
prefix by binary search and all trees then ascend together, one bit shorter at
a time, until the ranges under the prefixes hold enough different rows. Those
are scored exactly, in double precision on the vectors as given.

Every row is indexed: rows are dealt by hash into shards of about
``SHARD_ROWS``, each with a forest of its own; queries go to all shards in
blocks of about ``BLOCK_ROWS`` and the shards' best are merged per query.
``SHARE`` is the part of a shard a query scores at least; on vectors without
any structure (uniform on the sphere) it sets the recall, on others the
prefixes find the neighbours earlier.

Defined results: vectors that are null, empty, zero or hold a null or
non-finite component take no part, nor do rows without vec_id; of rows with
one vec_id the smallest vector counts; shorter vectors count as padded with
zeros; equal scores go to the smaller vec_id; fewer than k candidates give
fewer rows; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quire.llm.common import embeddings, written

K = 20
TREES, BITS = 128, 32
SHARE = 0.4
SHARD_ROWS, BLOCK_ROWS = 8192, 4096
RESULT = "query_id long, vec_id long, score double"


def usable(vectors: DataFrame) -> DataFrame:
    """vec_id and v (doubles), one row per vec_id."""
    v = F.col("embedding").cast("array<double>")
    fine = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    return (vectors.where(F.col("vec_id").isNotNull() & F.forall(v, fine) & F.exists(v, lambda x: x != 0))
            .groupBy(F.col("vec_id").cast("long").alias("vec_id")).agg(F.min(v).alias("v")))


def _matrix(rows: pd.Series, width: int) -> np.ndarray:
    out = np.zeros((len(rows), width))
    for i, r in enumerate(rows):
        out[i, :len(r)] = r
    return out


class Forest:
    """Sorted hash arrays of one shard."""

    def __init__(self, x: np.ndarray, norm: float, trees: int = TREES, bits: int = BITS, seed: int = 7):
        self.x, self.trees, self.bits = x, trees, bits
        self.planes = np.random.default_rng(seed).standard_normal((x.shape[1] + 1, trees * bits)).astype(np.float32)
        rest = np.sqrt(np.maximum(norm * norm - (x * x).sum(axis=1), 0))
        hashes = self._hash(x, rest)
        self.order = np.argsort(hashes, axis=0, kind="stable").astype(np.int32)
        self.sorted = np.ascontiguousarray(np.take_along_axis(hashes, self.order, axis=0).T)
        self.order = np.ascontiguousarray(self.order.T)

    def _hash(self, x: np.ndarray, rest: np.ndarray) -> np.ndarray:
        """One integer a row and tree, first projection in the highest bit."""
        out = np.zeros((len(x), self.trees), dtype=np.int64)
        for s in range(0, len(x), 1024):
            part = np.column_stack((x[s:s + 1024], rest[s:s + 1024])).astype(np.float32)
            signs = (part @ self.planes > 0).reshape(len(part), self.trees, self.bits)
            for b in range(self.bits):
                out[s:s + 1024] = (out[s:s + 1024] << 1) | signs[:, :, b]
        return out

    def _ranges(self, q: np.ndarray, length: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """First and last place of the rows that share each query's prefix of
        that length, for every tree."""
        drop = (self.bits - length)[:, None]
        low = (q >> drop) << drop
        high = low + (np.int64(1) << drop)
        lo = np.stack([np.searchsorted(self.sorted[t], low[:, t]) for t in range(self.trees)], axis=1)
        hi = np.stack([np.searchsorted(self.sorted[t], high[:, t]) for t in range(self.trees)], axis=1)
        return lo, hi

    def candidates(self, queries: np.ndarray, least: int):
        """For each query, the rows under its prefixes at the longest length
        at which they are ``least`` or more."""
        q = self._hash(queries, np.zeros(len(queries)))
        least = min(least, len(self.x))
        # descend: the longest length at which the ranges could hold enough
        low, high = np.zeros(len(q), dtype=np.int64), np.full(len(q), self.bits, dtype=np.int64)
        while (low < high).any():
            mid = (low + high + 1) // 2
            lo, hi = self._ranges(q, mid)
            enough = (hi - lo).sum(axis=1) >= least
            low, high = np.where(enough, mid, low), np.where(enough, high, mid - 1)
        # ascend: a row may lie in several trees' ranges, so count different ones
        length, todo = low, np.arange(len(q))
        while len(todo):
            lo, hi = self._ranges(q[todo], length[todo])
            short = []
            for j, i in enumerate(todo.tolist()):
                hit = np.zeros(len(self.x), dtype=bool)
                for t in range(self.trees):
                    hit[self.order[t, lo[j, t]:hi[j, t]]] = True
                rows = np.flatnonzero(hit)
                if len(rows) >= least or length[i] == 0:
                    yield i, rows
                else:
                    short.append(i)
            todo = np.array(short, dtype=np.int64)
            length[todo] -= 1


def nearest(spark: SparkSession, vectors: DataFrame, queries: DataFrame | None = None, k: int = K, trees: int = TREES,
            bits: int = BITS, share: float = SHARE, shard_rows: int = SHARD_ROWS,
            block_rows: int = BLOCK_ROWS) -> DataFrame:
    """query_id, rank, vec_id and score of the ``k`` best found for each of
    ``queries`` (vec_id, embedding; default: rows of ``vectors`` whose vec_id
    is divisible by 20) among the rows of ``vectors`` with another vec_id."""
    rows = written(spark, usable(vectors), "vectors")
    asked = rows.where(F.col("vec_id") % 20 == 0) if queries is None else written(spark, usable(queries), "queries")
    size = F.aggregate("v", F.lit(0.0), lambda a, x: a + x * x)
    n, norm, width = rows.agg(F.count("*"), F.max(F.sqrt(size)), F.max(F.size("v"))).first()
    m, most = asked.agg(F.count("*"), F.max(F.size("v"))).first()
    shards, blocks = max(1, -(-n // shard_rows)), max(1, -(-m // block_rows))
    width = max(width or 0, most or 0, 1)
    norm = norm or 0.0
    every = lambda count: F.explode(F.sequence(F.lit(0), F.lit(count - 1)))
    dealt = lambda count: F.pmod(F.xxhash64("vec_id"), F.lit(count)).cast("int")
    data = rows.select("vec_id", "v", dealt(shards).alias("shard"), every(blocks).alias("block"))
    ask = asked.select("vec_id", "v", dealt(blocks).alias("block"), every(shards).alias("shard"))

    def search(have: pd.DataFrame, want: pd.DataFrame) -> pd.DataFrame:
        out: tuple[list, list, list] = ([], [], [])
        if len(have) and len(want):
            have = have.sort_values("vec_id")
            ids, x = have["vec_id"].to_numpy(np.int64), _matrix(have["v"], width)
            q, names = _matrix(want["v"], width), want["vec_id"].to_numpy(np.int64)
            forest = Forest(x, norm, trees, bits)
            for i, found in forest.candidates(q, int(np.ceil(share * len(x))) + k):
                found = found[ids[found] != names[i]]
                near = x[found] @ q[i]
                if len(near) > k:
                    cut = np.partition(near, len(near) - k)[len(near) - k]
                    found = found[near >= cut - 1e-9 * (1 + abs(cut))]
                # the same order of operations for every row: equal vectors score equally
                exact = np.einsum("ij,j->i", x[found], q[i])
                best = np.lexsort((ids[found], -exact))[:k]
                out[0].append(np.full(len(best), names[i]))
                out[1].append(ids[found][best])
                out[2].append(exact[best])
        kinds = (np.int64, np.int64, np.float64)
        cols = [np.concatenate(c) if c else np.zeros(0, t) for c, t in zip(out, kinds)]
        return pd.DataFrame(dict(zip(("query_id", "vec_id", "score"), cols)))

    found = (data.groupBy("shard", "block").cogroup(ask.groupBy("shard", "block")).applyInPandas(search, RESULT))
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))


def op1_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest(spark, embeddings(spark, sf_dir))
