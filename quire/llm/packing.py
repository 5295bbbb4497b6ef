"""Sum-of-squares packing of documents into sequences of a fixed length.

A document becomes the ids of its whole text plus an end id; only a longer
one is cut, into full pieces and a shorter last piece. A piece goes where the
sum of N(g)^2 grows least, N(g) being the number of open sequences with g
free tokens: that keeps the gaps varied, so later pieces find one they fill
exactly. Longer pieces go first within a shard, which leaves the short ones
to close the gaps.

Shards of about ``per_shard`` pieces, dealt by row number so that no key can
gather rows, are packed in parallel; sequences a shard leaves at most half
full are packed once more across shards as if they were pieces. Only lengths
move, never texts or ids.

Defined results: a null text is empty and gives the end id alone; a null
doc_id is kept; repeated rows are packed once each; empty input gives an empty
result; other columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.llm.common import documents, portions, small_batches, written
from quire.llm.tokens import HELD, default_tokenizer, encoder

CAPACITY = 4096
PER_SHARD = 20_000
PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


def sum_of_squares(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Bin and offset of each length, placed longest first.

    Moving a bin from gap g to g - n changes the sum by
    2 * (N(g - n) - N(g) + 1), closing one (g = n) by 1 - 2 * N(g) and opening
    one by 2 * N(capacity - n) + 1. Ties take the smaller gap, and an open bin
    rather than a new one.
    """
    bins = np.empty(len(lengths), dtype=np.int64)
    offsets = np.empty(len(lengths), dtype=np.int64)
    count = np.zeros(capacity + 1, dtype=np.int64)
    open_at: list[list[int]] = [[] for _ in range(capacity + 1)]
    none = np.iinfo(np.int64).max
    made = 0
    for i in np.argsort(-lengths, kind="stable").tolist():
        n = int(lengths[i])
        gaps = count[n:capacity]  # of open bins with room
        g, least = capacity, none
        if n < capacity:
            grown = np.where(gaps > 0, 2 * (count[:capacity - n] - gaps + 1), none)
            if gaps[0]:
                grown[0] = 1 - 2 * gaps[0]  # closes the bin
            g = int(grown.argmin()) + n
            least = int(grown[g - n])
        if least <= 2 * count[capacity - n] + 1 and least < none:
            b = open_at[g].pop()
            count[g] -= 1
        else:
            b, g, made = made, capacity, made + 1
        bins[i], offsets[i] = b, capacity - g
        if g > n:
            open_at[g - n].append(b)
            count[g - n] += 1
    return bins, offsets


def pieces(docs: DataFrame, tokenizer: str | None = None, end_id: int = 1, capacity: int = CAPACITY,
           with_ids: bool = False) -> DataFrame:
    """One row per piece of each document: place in it, length, crc32 of its
    ids and, if asked for, the ids."""
    path = tokenizer or default_tokenizer()
    end = np.array([end_id], dtype="<u4").tobytes()
    width = 4 * capacity

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(path)
        for batch in batches:
            ids, texts = batch.column(0).to_pylist(), batch.column(1)
            for a, size in portions(texts, HELD):
                rows: list[list] = [[], [], [], [], [], []]
                for doc, raw in zip(ids[a:a + size], enc.encode(texts.slice(a, size))):
                    raw += end
                    for k, s in enumerate(range(0, len(raw), width)):
                        part = raw[s:s + width]
                        for col, v in zip(rows, (doc, k, s // 4, len(part) // 4, zlib.crc32(part), part)):
                            col.append(v)
                kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
                cols = [pa.array(c, t) for c, t in zip(rows, kinds)]
                if with_ids:
                    cols.append(pa.array([np.frombuffer(p, "<u4").astype(np.int32) for p in rows[5]],
                                         pa.list_(pa.int32())))
                yield pa.RecordBatch.from_arrays(cols, names=names)
        enc.forget()

    schema = PIECES + (", ids array<int>" if with_ids else "")
    names = [c.strip().split(" ")[0] for c in schema.split(",")]
    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(cut, schema)


def _pack_shards(rows: DataFrame, size: str, capacity: int, per_shard: int, bin_col: str, place_col: str) -> DataFrame:
    """``rows`` plus their bin (unique over shards) and place in it."""
    shards = max(1, -(-rows.count() // per_shard))
    out = ", ".join(f"{c} {t}" for c, t in rows.dtypes) + f", {bin_col} long, {place_col} long"

    def place(pdf: pd.DataFrame) -> pd.DataFrame:
        bins, places = sum_of_squares(pdf[size].to_numpy(np.int64), capacity)
        first = int(pdf["_shard"].iloc[0]) << 32
        return pdf.drop(columns="_shard").assign(**{bin_col: first + bins, place_col: places})

    rid = F.monotonically_increasing_id()
    return (rows.withColumn("_shard", F.pmod(F.xxhash64(rid), F.lit(shards)))
            .groupBy("_shard").applyInPandas(place, out))


def pack(spark: SparkSession, cut: DataFrame, capacity: int = CAPACITY, per_shard: int = PER_SHARD) -> DataFrame:
    """``cut`` (a ``length`` column of 1 to ``capacity``) plus sequence_id and
    offset. ``cut`` should be a written table, since row numbers deal its rows."""
    cols = cut.columns
    first = written(spark, _pack_shards(cut.where(F.col("length") < capacity), "length", capacity, per_shard,
                                        "_bin", "_place"), "packed")
    low = written(spark, first.groupBy("_bin").agg(F.sum("length").alias("_fill"))
                  .where(F.col("_fill") <= capacity // 2), "half-open")
    again = _pack_shards(low.withColumnRenamed("_bin", "_from"), "_fill", capacity, per_shard, "_to", "_shift")
    placed = (first.join(again, F.col("_bin") == F.col("_from"), "left")
              .select(*cols,
                      F.coalesce(F.col("_to") * 2 + 1, F.col("_bin") * 2).alias("sequence_id"),
                      (F.col("_place") + F.coalesce("_shift", F.lit(0))).alias("offset")))
    # a full piece is a sequence by itself; negative numbers keep them apart
    alone = cut.where(F.col("length") >= capacity).select(
        *cols, (-1 - F.monotonically_increasing_id()).alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    return placed.unionByName(alone)


def pack_documents(spark: SparkSession, docs: DataFrame, tokenizer: str | None = None, end_id: int = 1,
                   capacity: int = CAPACITY, per_shard: int = PER_SHARD) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id and offset of every piece."""
    with small_batches(spark):
        cut = written(spark, pieces(docs, tokenizer, end_id, capacity), "pieces")
    return pack(spark, cut, capacity, per_shard)


def sequences(packed: DataFrame) -> DataFrame:
    """Training rows of pieces packed with their ids: sequence_id, ids (joined
    by offset) and the documents in them. A sequence holds ``capacity`` ids at
    most, so each group is bounded."""
    part = F.struct("offset", "doc_id", "piece", "ids")
    return (packed.groupBy("sequence_id").agg(F.array_sort(F.collect_list(part)).alias("parts"))
            .select("sequence_id", F.flatten("parts.ids").alias("ids"), F.col("parts.doc_id").alias("doc_ids")))


def op9_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(spark, documents(spark, sf_dir))
