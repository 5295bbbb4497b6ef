"""Object and file sources."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

GOLDEN_SCHEMA = T.StructType([T.StructField("question", T.StringType(), False),
                              T.StructField("ground_truth", T.StringType(), False)])


def scan_objects(spark: SparkSession, root: str, suffixes=None) -> DataFrame:
    """Files under ``root`` as ``path, modificationTime, length, content``.

    Suffixes become a path glob so the listing itself is pruned (no bytes of
    other files are read).
    """
    r = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    if suffixes:
        globs = ",".join("*" + s for s in suffixes)
        r = r.option("pathGlobFilter", "{" + globs + "}" if len(suffixes) > 1 else "*" + suffixes[0])
    return r.load(root)


def read_golden(spark: SparkSession, path: str) -> DataFrame:
    """Golden CSV with a declared schema (``4`` stays the string "4")."""
    return spark.read.schema(GOLDEN_SCHEMA).option("header", "true").option("multiLine", "true") \
        .option("escape", '"').csv(path)


def read_tabular(spark: SparkSession, path: str, fmt: str = "csv") -> DataFrame:
    """A spreadsheet already exported as CSV or Parquet; every cell is a
    string (no inference, so nothing is re-typed behind the user's back)."""
    if fmt == "csv":
        return spark.read.option("header", "true").option("inferSchema", "false").csv(path)
    if fmt == "parquet":
        df = spark.read.parquet(path)
        return df.select(*[F.col(f"`{c}`").cast("string").alias(c) for c in df.columns])
    raise ValueError(f"unsupported tabular format {fmt!r}")
