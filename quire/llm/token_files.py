"""Token ids in ORC files: integer run-length encoding, row indexes and Bloom
filters on document ids.

Documents are range-partitioned and sorted by doc_id, tokenised in place and
written as one ORC file per range. Each row holds its document's ids, their
number, and where they start within the file (running sums, which the integer
encoding stores in next to nothing). Stripes are the unit a reader splits a
file by; their column statistics, the row index inside them and the Bloom
filters let a look-up by doc_id skip what cannot hold it. A document's place
in the whole corpus is its place in the file plus the ids of the files before,
one number a file, read from the count column alone.

Defined results: a null text is empty and gives the end id alone; null
doc_ids come first; rows with equal doc_ids follow each other, as many as
there are; an empty table gives files without rows; other columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quire.llm.common import documents, new_folder, portions
from quire.llm.tokens import HELD, default_tokenizer, encoder

END_ID = 2
FILE_SCHEMA = "doc_id long, part int, local_start long, n_tokens long, ids array<int>"
#: Bytes of a stripe and rows between two row-index entries.
STRIPE_BYTES, INDEX_ROWS = 16 << 20, 1000


def write_tokens(docs: DataFrame, path: str, tokenizer: str | None = None, end_id: int = END_ID) -> None:
    """Tokenise ``docs`` (doc_id, text) into ORC files under ``path``."""
    vocabulary = tokenizer or default_tokenizer()
    names = [c.split(" ")[0] for c in FILE_SCHEMA.split(", ")]

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, part, start = encoder(vocabulary), TaskContext.get().partitionId(), 0
        for batch in batches:
            docs_, texts = batch.column(0), batch.column(1)
            for a, size in portions(texts, HELD):
                own = enc.ids(texts.slice(a, size))
                at = np.asarray(own.offsets)
                ends = at[1:] + np.arange(1, size + 1)
                n = np.diff(ends, prepend=0)
                ids = pa.ListArray.from_arrays(pa.array(np.concatenate(([0], ends)).astype(np.int32)),
                                               pa.array(np.insert(np.asarray(own.values), at[1:], end_id)))
                yield pa.RecordBatch.from_arrays(
                    [docs_.slice(a, size), pa.array(np.full(size, part, dtype=np.int32)),
                     pa.array(start + ends - n), pa.array(n), ids], names=names)
                start += int(ends[-1])
        enc.forget()

    # the row number parts equal doc_ids, so that no range is stuck with them; the ranges are found without texts
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    keyed = rows.withColumn("_r", F.monotonically_increasing_id())
    ranged = keyed.repartitionByRange("doc_id", "_r").sortWithinPartitions("doc_id", "_r")
    (ranged.select("doc_id", "text").mapInArrow(encode, FILE_SCHEMA).write
     .option("compression", "zstd")
     .option("orc.stripe.size", str(STRIPE_BYTES))
     .option("orc.row.index.stride", str(INDEX_ROWS))
     .option("orc.bloom.filter.columns", "doc_id")
     .option("orc.bloom.filter.fpp", "0.01")
     .orc(path))


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """The rows of the files, as written. Filters on doc_id reach the stripe
    statistics, the row index and the Bloom filters."""
    return spark.read.schema(FILE_SCHEMA).orc(path)


def lookup(spark: SparkSession, path: str, doc_ids: list[int]) -> DataFrame:
    """doc_id and ids of some documents."""
    return read_tokens(spark, path).where(F.col("doc_id").isin([int(d) for d in doc_ids])).select("doc_id", "ids")


def file_starts(spark: SparkSession, path: str) -> DataFrame:
    """For each file (part), the number of ids in those before it. Reads the
    counts only; its one-partition window has a row for each file."""
    totals = read_tokens(spark, path).groupBy("part").agg(F.sum("n_tokens").alias("n"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    return totals.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))


def digest(spark: SparkSession, path: str) -> DataFrame:
    """Per document of the files: place in the corpus, length and crc32 of its ids."""
    schema = "doc_id long, part int, local_start long, n_tokens long, ids_crc32 long"

    def crc(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(4)
            at = np.asarray(ids.offsets)
            raw = memoryview(np.ascontiguousarray(np.asarray(ids.values), dtype="<i4")).cast("B")
            sums = [zlib.crc32(raw[4 * s:4 * e]) for s, e in zip(at[:-1].tolist(), at[1:].tolist())]
            lengths = pa.array(np.diff(at).astype(np.int64))
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], lengths, pa.array(sums, pa.int64())],
                                             names=["doc_id", "part", "local_start", "n_tokens", "ids_crc32"])

    rows = read_tokens(spark, path).mapInArrow(crc, schema)
    return (rows.join(file_starts(spark, path), "part")
            .select("doc_id", (F.col("base") + F.col("local_start")).alias("start"), "n_tokens", "ids_crc32"))


def op7_token_orc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_folder(spark, "tokens-orc")
    write_tokens(documents(spark, sf_dir), path)
    return digest(spark, path)
