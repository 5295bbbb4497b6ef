"""Session construction and the shared scratch folder."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession


def build_session(cpus: str | int = "*", app: str = "quire",
                  shuffle_partitions: int | None = None,
                  extra: dict | None = None) -> SparkSession:
    """A local session configured the way the library expects a cluster one.

    On a cluster the caller's session is used as is; this builder is for
    tests, the bench and the smoke entry.
    """
    parts = shuffle_partitions or (int(cpus) * 2 if str(cpus).isdigit() else 16)
    b = (SparkSession.builder.master(f"local[{cpus}]").appName(app)
         .config("spark.ui.enabled", "false")
         .config("spark.ui.showConsoleProgress", "false")
         .config("spark.sql.shuffle.partitions", str(parts))
         .config("spark.sql.adaptive.enabled", "true")
         .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
         .config("spark.sql.adaptive.skewJoin.enabled", "true")
         # co-partitioned inputs clustered on a subset of the join keys (e.g.
         # doc_id for a (doc_id, chunk_no) join) are joined without a shuffle
         .config("spark.sql.requireAllClusterKeysForCoPartition", "false")
         .config("spark.sql.session.timeZone", "UTC")
         .config("spark.driver.memory", "16g")
         .config("spark.sql.execution.arrow.pyspark.enabled", "true")
         .config("spark.sql.autoBroadcastJoinThreshold", str(32 * 1024 * 1024)))
    for k, v in (extra or {}).items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder named by ``spark.checkpoint.dir``.

    A cluster names it. Where it is unset, a local master gets a scratch folder
    (tests); any other raises, since a folder of the driver's own machine would
    be out of the executors' reach.
    """
    d = spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        d = tempfile.mkdtemp(prefix="quire-ckpt-")
        spark.conf.set("spark.checkpoint.dir", d)
    spark.sparkContext.setCheckpointDir(d)
    return d


def scratch_path(spark: SparkSession, name: str) -> str:
    """A sub-folder of the shared checkpoint folder for written tables."""
    return os.path.join(checkpoint_dir(spark), name)
