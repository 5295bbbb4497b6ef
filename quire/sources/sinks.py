"""Sinks (S10-S14). Everything lands as files in a shared folder, written by
the executors; nothing passes through the driver."""

from __future__ import annotations

import json

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def children(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder of any file system the cluster reads; none if it is absent."""
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return sorted(s.getPath().getName() for s in fs.listStatus(at)) if fs.exists(at) else []


def write_documents(docs: DataFrame, path: str, key: str = "key", text: str = "text",
                    mode: str = "overwrite") -> None:
    """Assembled document text keyed by ``{source_key}.txt``. One
    Parquet table instead of one object per document (millions of tiny
    objects are the wrong shape for a cluster file system)."""
    docs.select(key, text).write.mode(mode).parquet(path)


def write_labels_json(labels: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Label documents as JSON lines."""
    labels.write.mode(mode).json(path)


def write_report_text(reports: DataFrame, path: str, col: str = "report", mode: str = "overwrite") -> None:
    """Combined reports as text (one record per report)."""
    reports.select(F.col(col).alias("value")).write.mode(mode).text(path)


def _claimed(spark: SparkSession, path: str) -> bool:
    """Create a marker file that is not there yet; False if another writer has
    it. On a local disk by exclusive creation, elsewhere by the file system's
    creation without overwriting."""
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    fs.mkdirs(at.getParent())
    if fs.getUri().getScheme() == "file":
        try:
            open(at.toUri().getPath(), "x").close()
        except FileExistsError:
            return False
        return True
    try:
        fs.create(at, False).close()
    except Py4JJavaError as e:
        if fs.exists(at):
            return False
        raise e
    return True


def claim_next(spark: SparkSession, path: str, kind: str, after: int = 0) -> int:
    """The next number of a ``kind`` of thing in the folder ``path``, beyond
    ``after`` and all earlier claims. No two writers get the same one: each
    number has a marker that only one of them can create."""
    markers = f"{path}/_claims"
    taken = [int(n.rsplit("-", 1)[1]) for n in children(spark, markers) if n.startswith(f"{kind}-")]
    number = max([after, *taken]) + 1
    while not _claimed(spark, f"{markers}/{kind}-{number}"):
        number += 1
    return number


def next_serial(spark: SparkSession, path: str) -> int:
    """``coalesce(max(serial), 0) + 1`` over the experiments table; 1 if
    there is none. Any other trouble in reading it is raised."""
    if not [n for n in children(spark, path) if not n.startswith("_")]:
        return 1
    return int(spark.read.parquet(path).agg(F.max("serial")).first()[0] or 0) + 1


def append_experiment(row: DataFrame, path: str) -> int:
    """Append one experiment record under the next free serial id, which
    no other writer gets."""
    spark = row.sparkSession
    serial = claim_next(spark, path, "serial", next_serial(spark, path) - 1)
    # a write's temporary folder is its target's; the first of two writers into one folder removes both's
    own = f"{path}/_writing/serial-{serial}"
    row.withColumn("serial", F.lit(serial).cast("bigint")).coalesce(1).write.parquet(own)
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
    fs = hadoop.Path(path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    for name in children(spark, own):
        if not name.startswith(("_", ".")) and not fs.rename(hadoop.Path(f"{own}/{name}"), hadoop.Path(f"{path}/{name}")):
            raise OSError(f"could not add {own}/{name} to {path}")
    fs.delete(hadoop.Path(own), True)
    return serial


#: Buckets of a keyed store by the hash of the key; a new store may choose others.
KEY_BUCKETS = 32


def _key_bucket(key: str, n: int):
    return F.pmod(F.xxhash64(F.col(key).cast("string")), F.lit(n)).cast("int")


def _store(spark: SparkSession, path: str) -> tuple[int, dict[int, str]]:
    """The newest complete manifest: number of buckets and the folder of each
    bucket that has records."""
    names = [n for n in children(spark, f"{path}/manifest") if n.startswith("version=")]
    for n in sorted(names, key=lambda n: -int(n.split("=")[1])):
        if "_SUCCESS" in children(spark, f"{path}/manifest/{n}"):
            rows = spark.read.parquet(f"{path}/manifest/{n}").collect()  # a row a bucket
            return rows[0]["buckets"], {r["bucket"]: r["folder"] for r in rows if r["bucket"] >= 0}
    raise FileNotFoundError(f"no complete version under {path}")


def _put(spark: SparkSession, path: str, records: DataFrame, key: str, n: int, keep: dict[int, str], among: list[int] | None) -> None:
    """Write ``records`` by bucket and publish them beside the folders kept."""
    data = claim_next(spark, path, "data")
    folder = f"data={data}"
    # one more hash parts the rows of a bucket, so that a hot one is written by several tasks
    (records.withColumn("bucket", _key_bucket(key, n)).repartition("bucket", F.pmod(F.xxhash64(key), F.lit(4)))
     .write.partitionBy("bucket").parquet(f"{path}/{folder}"))
    new = {int(c.split("=")[1]): f"{folder}/{c}" for c in children(spark, f"{path}/{folder}") if c.startswith("bucket=")}
    left = {b: f for b, f in keep.items() if among is None or b not in among}
    rows = [(n, b, f) for b, f in sorted((left | new).items())] or [(n, -1, "")]
    schema = spark.createDataFrame([(records.schema.json(),)], "schema string")
    version = claim_next(spark, f"{path}/manifest", "version")
    schema.coalesce(1).write.mode("overwrite").parquet(f"{path}/schema/version={version}")
    spark.createDataFrame(rows, "buckets int, bucket int, folder string").coalesce(1).write.mode("overwrite").parquet(
        f"{path}/manifest/version={version}")


def write_keyed_store(records: DataFrame, path: str, key: str | None = None, buckets: int = KEY_BUCKETS) -> None:
    """The key-value store as its next version, hash-bucketed by ``key``
    (default: the first column). ``records`` may be computed from the current
    one, which stays; readers move on when the new version is complete."""
    _put(records.sparkSession, path.rstrip("/"), records, key or records.columns[0], buckets, {}, None)


def update_keyed_store(updates: DataFrame, path: str, key: str, version: str) -> int:
    """Upsert ``updates`` (newest ``version`` per key wins) into the store
    and return how many buckets were written: those that hold an updated key,
    no others. The next version shares all other buckets with the current one."""
    from quire.operators.sync import keyed_upsert

    spark, path = updates.sparkSession, path.rstrip("/")
    n, folders = _store(spark, path)
    among = [r[0] for r in updates.select(_key_bucket(key, n)).distinct().collect()]  # at most ``n``
    if not among:
        return 0
    base = _read(spark, path, [f for b, f in folders.items() if b in among])
    _put(spark, path, keyed_upsert(base, updates, key, version), key, n, folders, among)
    return len(among)


def _read(spark: SparkSession, path: str, folders: list[str]) -> DataFrame:
    newest = max((n for n in children(spark, f"{path}/schema")), key=lambda n: int(n.split("=")[1]))
    schema = T.StructType.fromJson(json.loads(spark.read.parquet(f"{path}/schema/{newest}").first()["schema"]))
    return spark.read.schema(schema).parquet(*[f"{path}/{f}" for f in folders]) if folders else spark.createDataFrame([], schema)


def read_keyed_store(spark: SparkSession, path: str) -> DataFrame:
    """The newest complete version."""
    path = path.rstrip("/")
    return _read(spark, path, list(_store(spark, path)[1].values()))


def write_kb_table(records: DataFrame, path: str | None = None, table: str | None = None,
                   n_buckets: int = 64) -> None:
    """KB records (id, text, metadata, vector). With a catalog table the
    data is bucketed by ``doc_id``, the key of syncs and deletions, so they
    join without a shuffle; a plain path gets hash-bucket partitions.
    ``n_buckets`` should follow the volume (a few hundred MB a bucket)."""
    if table:
        (records.write.mode("overwrite").bucketBy(n_buckets, "doc_id").sortBy("doc_id", "chunk_id")
         .format("parquet").saveAsTable(table))
        return
    if not path:
        raise ValueError("path or table is required")
    (records.withColumn("bucket", F.pmod(F.xxhash64("doc_id"), F.lit(n_buckets)))
     .repartition(n_buckets, "bucket").write.mode("overwrite").partitionBy("bucket").parquet(path))
