"""Parquet table access.

Column pruning and filter pushdown are left to Catalyst: callers select
what they need and the scan reads only that.

A Parquet row group is the unit of a scan split, so a table stored as one
large row group is read by a single task and every narrow step after it
(tokenising, regexes, chunking) would run on one core. When a scan yields
fewer partitions than the cluster's parallelism, :func:`table` spreads it
right after the scan: by its unique id where one exists (so later per-id
grouping and windows need no further shuffle), round-robin otherwise (no
key, hence no skew). A scan that is already wide, or a table of a few MB,
is left alone.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()

# Unique id per table (spread by hash of it); None = round-robin.
SPREAD_KEY = {"documents": "doc_id", "pages": "page_id", "embeddings": "vec_id", "orders": "o_orderkey",
              "benchmark": "item_id", "labels": "doc_id", "customer": "c_custkey", "part": "p_partkey",
              "events": None, "conversations": None}
# lineitem is not spread: every operator over it starts with a hash shuffle
# (window or aggregate) that parallelises it anyway, so a round-robin pass
# first would only add a stage.


# Below this many bytes on storage a table is not worth an extra stage.
SPREAD_MIN_BYTES = 4 * 1024 * 1024


def _stored_bytes(spark: SparkSession, path: str) -> int:
    """Size on storage through the Hadoop FileSystem of the path (works for
    any scheme the cluster can read); -1 when unknown."""
    try:
        jvm = spark.sparkContext._jvm
        p = jvm.org.apache.hadoop.fs.Path(path)
        fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        return int(fs.getContentSummary(p).getLength())
    except Exception:  # noqa: BLE001 - size unknown: behave as if large
        return -1


def table(spark: SparkSession, sf_dir: str, name: str, spread: bool = True) -> DataFrame:
    if name not in TABLES:
        raise ValueError(f"unknown table {name!r}")
    path = f"{sf_dir.rstrip('/')}/{name}.parquet"
    df = spark.read.parquet(path)
    if spread and name in SPREAD_KEY:
        target = spark.sparkContext.defaultParallelism
        size = _stored_bytes(spark, path)
        if (size < 0 or size >= SPREAD_MIN_BYTES) and df.rdd.getNumPartitions() < target:
            key = SPREAD_KEY[name]
            df = df.repartition(target, key) if key else df.repartition(target)
    return df


def is_clustered_by(df: DataFrame, key: str) -> bool:
    """True when the planned output is already hash-partitioned by ``key``
    alone (so a per-``key`` aggregate or window needs no shuffle)."""
    try:
        p = df._jdf.queryExecution().sparkPlan().outputPartitioning().toString()
    except Exception:  # noqa: BLE001 - be conservative
        return False
    if not p.startswith("hashpartitioning("):
        return False
    inner = p[len("hashpartitioning("):].rsplit(",", 1)[0]
    return inner.split("#")[0] == key and "," not in inner


def cluster_by(df: DataFrame, key: str, partitions: int | None = None) -> DataFrame:
    """Hash-partition by ``key`` unless the plan already is."""
    if is_clustered_by(df, key):
        return df
    # without an explicit count AQE may coalesce small partitions
    return df.repartition(partitions, key) if partitions else df.repartition(key)
