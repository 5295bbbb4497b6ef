"""Tables and scratch space of the operators in this subpackage."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from uuid import uuid4

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.session import scratch_path

#: The white space that separates words, and so the words, in every operator here.
WORD = r"[^\x20\x09-\x0D]+"
SPACES = b" \t\n\x0b\x0c\r"
#: Bytes of a row group in tables written between steps.
ROW_GROUP = 32 << 20
#: 64-bit words of the bit table of ``maybe_among``: as many whatever the input's size.
FILTER_WORDS = 1 << 20


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/pages.parquet")


def embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/embeddings.parquet")


def new_folder(spark: SparkSession, name: str) -> str:
    """A folder of its own under the shared one that the session names."""
    return scratch_path(spark, f"{name}-{uuid4().hex}")


def written(spark: SparkSession, df: DataFrame, name: str) -> DataFrame:
    """``df`` as a table in the shared folder, read back: short lineage that
    outlives lost executors."""
    path = new_folder(spark, name)
    # small row groups: a task that writes whole texts holds less of them
    df.write.option("parquet.block.size", str(ROW_GROUP)).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def small_batches(spark: SparkSession, rows: int = 500) -> Iterator[None]:
    """Within, Spark hands Python at most ``rows`` rows at a time: rows of whole
    texts are long, and both sides hold a batch of them."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, str(rows if int(before) <= 0 else min(rows, int(before))))
    try:
        yield
    finally:
        spark.conf.set(key, before)


def maybe_among(rows: DataFrame, columns: list[str], keys: DataFrame, words: int = FILTER_WORDS) -> DataFrame:
    """``rows`` with ``_maybe``: false where ``columns`` surely equal no row of
    ``keys`` (the same number of columns), so that only the others need to move
    to be joined. The bits of the keys' hashes are broadcast, a table of at most
    ``words`` rows; more keys make it less sharp, never wrong."""
    def place(names: list[str], df: DataFrame) -> DataFrame:
        h = F.xxhash64(*names)
        bit = F.expr("shiftleft(1L, cast(shiftright(_key, 56) & 63 as int))")
        return df.withColumn("_key", h).withColumn("_word", F.pmod("_key", F.lit(words))).withColumn("_bit", bit).drop("_key")

    table = place(keys.columns, keys).groupBy(F.col("_word").alias("_at")).agg(F.bit_or("_bit").alias("_bits"))
    joined = place(columns, rows).join(F.broadcast(table), F.col("_word") == F.col("_at"), "left")
    return (joined.withColumn("_maybe", F.coalesce(F.col("_bits").bitwiseAND(F.col("_bit")) != 0, F.lit(False)))
            .drop("_word", "_bit", "_at", "_bits"))


def packed(docs: DataFrame, name: str = "row") -> Column:
    """All columns as one struct: what an operator adds cannot clash with
    columns that it only passes through."""
    return F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias(name)


def unpacked(docs: DataFrame, name: str = "row", **new: Column) -> list[Column]:
    """The columns of ``docs`` from the struct, some replaced."""
    return [(new[c] if c in new else F.col(name).getField(c)).alias(c) for c in docs.columns]


def portions(texts: pa.Array, held: int = 2_000_000) -> Iterator[tuple[int, int]]:
    """Ranges (start, length) of a binary or string array that hold about
    ``held`` bytes each, so that a batch of long texts is taken bit by bit."""
    if len(texts):
        size = np.asarray(pc.fill_null(pc.binary_length(texts), 0), dtype=np.int64)
        slot = np.cumsum(size) // held
        starts = np.flatnonzero(np.diff(slot, prepend=slot[0] - 1))
        yield from zip(starts.tolist(), np.diff(starts, append=len(slot)).tolist())
