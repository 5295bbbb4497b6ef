"""Efraimidis-Spirakis mixing of sources to target weights.

Targets: sources in code-point order (null last) weigh 5, 2, 1, repeating, and
share ``SHARE`` of all words; a target stops at twice its source's words and
the excess goes to the others by weight. Each document gets the key
``-ln(u) / w`` with u drawn by hash from seed, doc_id and text and w its
quality weight. Within a source documents are sorted by key and their words
summed: complete epochs first, then documents in key order while more than
half of a document still fits the rest of the budget.

The sort is split: a key belongs to one of ``BUCKETS`` ranges, the sums of the
ranges precede those within a range, so a hot source spreads over many tasks.
Equal rows are one row with a count until the end. Texts never move: a pass
over the documents compares each key with its source's last selected key.

Defined results: a null text or doc_id counts as such (size 0 for a null
text, which is taken 0 words); null source is a source; equal rows get equal
treatment except that a budget may end among them; ties in key go by doc_id,
then size; an empty table gives an empty result; other columns are ignored or
pass through ``mix_documents``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quire.llm.common import WORD, documents, packed, unpacked, written

WEIGHTS = (5, 2, 1)
SHARE = 1.5
MOST = 2
SEED = "mix-1"
BUCKETS = 1024
JUNK = "#*$%&|<>0123456789"
LOW = -(2 ** 63)


def size() -> Column:
    return F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long")


def quality_weight() -> Column:
    """1 for plain prose, down to 0.1 as digits and symbols reach a fifth of the text."""
    n = F.length("text")
    junk = (n - F.length(F.translate("text", JUNK, ""))) / F.greatest(n, F.lit(1))
    return F.greatest(F.lit(0.1), 1 - 5 * F.coalesce(junk, F.lit(0.0)))


def sample_key(seed: str = SEED, weight: Column | None = None) -> Column:
    drawn = F.md5(F.concat_ws("|", F.lit(seed), F.coalesce(F.col("doc_id").cast("string"), F.lit("null")),
                              F.md5(F.coalesce("text", F.lit("")))))
    u = (F.conv(F.substring(drawn, 1, 13), 16, 10).cast("double") + 0.5) / float(2 ** 52)
    return -F.log(u) / (quality_weight() if weight is None else weight)


def _keyed(docs: DataFrame, seed: str) -> list[Column]:
    src = F.when(F.col("source").isNull(), "1").otherwise(F.concat(F.lit("0"), F.col("source").cast("string")))
    return [src.alias("_src"), F.coalesce(F.col("doc_id").cast("long"), F.lit(LOW)).alias("_doc"),
            size().alias("size"), sample_key(seed).alias("_key")]


def targets(sizes: DataFrame, weights: tuple = WEIGHTS, share: float = SHARE, most: float = MOST) -> DataFrame:
    """_src, source_size, target. One row per source.

    With caps c and weights w, the targets are min(c, level * w). In the order
    of c / w, the first k sources are capped where the level left for the
    others does not reach the next one's ratio."""
    order = Window.orderBy("_src")
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]),
                          ((F.row_number().over(order) - 1) % len(weights) + 1).cast("int"))
    of_all = Window.partitionBy()
    rows = (sizes.select("_src", F.col("n").alias("source_size"), weight.cast("double").alias("w"))
            .withColumn("cap", F.col("source_size") * float(most)))
    rising = Window.orderBy(F.col("cap") / F.col("w"), "_src").rowsBetween(Window.unboundedPreceding, -1)
    rows = (rows.withColumn("all", F.sum("source_size").over(of_all) * share)
            .withColumn("capped", F.coalesce(F.sum("cap").over(rising), F.lit(0.0)))
            .withColumn("open", F.sum("w").over(of_all) - F.coalesce(F.sum("w").over(rising), F.lit(0.0)))
            .withColumn("level", (F.col("all") - F.col("capped")) / F.col("open")))
    ratio = F.col("cap") / F.col("w")
    level = F.min(F.when(F.col("level") <= ratio, F.struct(ratio, "_src", "level"))).over(of_all)["level"]
    return rows.select("_src", "source_size",
                       F.least("cap", F.coalesce(level, F.lit(float("inf"))) * F.col("w")).alias("target"))


def choose(rows: DataFrame) -> DataFrame:
    """Groups of equal rows (_src, _doc, size, _key, n) with source_size,
    target, epochs and ``extra``, how many of the n are taken once more."""
    bucket = F.floor(F.col("_key") / (1 + F.col("_key")) * BUCKETS).cast("int")
    groups = (rows.groupBy("_src", "_doc", "size", "_key").agg(F.count("*").alias("n"))
              .withColumn("_bucket", bucket))
    sums = groups.groupBy("_src", "_bucket").agg(F.sum(F.col("size") * F.col("n")).alias("_sum"))
    before = Window.partitionBy("_src").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select(F.col("_src").alias("_s"), F.col("_bucket").alias("_b"),
                       F.coalesce(F.sum("_sum").over(before), F.lit(0)).alias("_before"))
    aims = targets(rows.groupBy("_src").agg(F.sum("size").alias("n"))).withColumnRenamed("_src", "_t")
    within = (Window.partitionBy("_src", "_bucket").orderBy("_key", "_doc", "size")
              .rowsBetween(Window.unboundedPreceding, -1))
    placed = groups.withColumn("_within", F.coalesce(F.sum(F.col("size") * F.col("n")).over(within), F.lit(0)))
    joined = (placed.join(sums, (F.col("_src") == F.col("_s")) & (F.col("_bucket") == F.col("_b")))
              .join(aims, F.col("_src") == F.col("_t")))
    epochs = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("long")
    left = F.col("target") - epochs * F.col("source_size") - F.col("_before") - F.col("_within")
    fits = F.floor(left / F.col("size") + 0.5).cast("long")
    extra = F.when(F.col("size") > 0, F.least(F.col("n"), F.greatest(F.lit(0).cast("long"), fits))).otherwise(F.lit(0))
    return joined.select("_src", "_doc", "size", "_key", "n", "source_size", "target",
                         epochs.alias("epochs"), extra.cast("long").alias("extra"))


def mix(spark: SparkSession, docs: DataFrame, seed: str = SEED) -> DataFrame:
    """doc_id, source, size, source_size, target and taken of every row."""
    rows = written(spark, docs.select(*_keyed(docs, seed)), "mix-keys")
    each = choose(rows).withColumn("_i", F.explode(F.sequence(F.lit(1), F.col("n"))))
    return each.select(
        F.when(F.col("_doc") != LOW, F.col("_doc")).alias("doc_id"),
        F.when(F.col("_src") != "1", F.expr("substring(_src, 2)")).alias("source"),
        "size", "source_size", "target",
        (F.col("size") * (F.col("epochs") + (F.col("_i") <= F.col("extra")).cast("long"))).alias("taken"))


def mix_documents(spark: SparkSession, docs: DataFrame, seed: str = SEED) -> DataFrame:
    """The rows of ``docs``, each as often as the mix takes it."""
    rows = written(spark, docs.select(*_keyed(docs, seed)), "mix-keys")
    place = F.struct("_key", "_doc", "size")
    # per source: epochs, the last group taken once more, and how many of it
    ends = choose(rows).groupBy(F.col("_src").alias("_s")).agg(
        F.max("epochs").alias("_epochs"),
        F.max(F.when(F.col("extra") > 0, F.struct(place.alias("at"), "n", "extra"))).alias("_last"))
    ends = written(spark, ends, "mix-ends")
    keyed = docs.select(packed(docs), *_keyed(docs, seed)).join(ends, F.col("_src") == F.col("_s"))
    whole = F.col("_last.n") == F.col("_last.extra")
    once = F.coalesce((place < F.col("_last.at")) | ((place == F.col("_last.at")) & whole), F.lit(False))
    split = F.coalesce((place == F.col("_last.at")) & ~whole, F.lit(False))
    most = keyed.where(~split).select("row", (F.col("_epochs") + once.cast("long")).alias("_copies"))
    # a budget that ends among equal rows: count them, then take as many as fit
    equal = (keyed.where(split)  # rows are told apart by a digest, which a column of any type has
             .groupBy(F.sha2(F.to_json("row"), 256).alias("_digest"), "_src", "_epochs", F.col("_last.extra").alias("_extra"))
             .agg(F.count("*").alias("_n"), F.first("row").alias("row")))
    earlier = Window.partitionBy("_src").orderBy("_digest").rowsBetween(Window.unboundedPreceding, -1)
    took = F.greatest(F.lit(0).cast("long"), F.least(
        F.col("_n"), F.col("_extra") - F.coalesce(F.sum("_n").over(earlier), F.lit(0))))
    rest = equal.select("row", (F.col("_epochs") * F.col("_n") + took).alias("_copies"))
    every = most.unionByName(rest).where(F.col("_copies") > 0)
    return (every.withColumn("_c", F.explode(F.sequence(F.lit(1).cast("long"), F.col("_copies"))))
            .select(*unpacked(docs)))


def op6_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(spark, documents(spark, sf_dir)).select("doc_id", "size", "source_size", "target", "taken")


OP6_SQL = rf"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
    -ln((('0x' || substr(md5('{SEED}|' || coalesce(doc_id::VARCHAR, 'null') || '|' || md5(coalesce(text, ''))), 1, 13))::BIGINT::DOUBLE
        + 0.5) / {float(2 ** 52)!r}::DOUBLE)
      / greatest(0.1::DOUBLE, 1 - 5 * coalesce((length(text) - length(translate(text, '{JUNK}', '')))::DOUBLE
        / greatest(length(text), 1), 0)) AS key
  FROM documents
), s AS (
  SELECT source, sum(size)::BIGINT AS n, [5, 2, 1][((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::INT]::DOUBLE AS w
  FROM d GROUP BY source
), l AS (
  SELECT *, ((sum(n) OVER ())::DOUBLE * {SHARE}::DOUBLE
      - coalesce(sum({float(MOST)}::DOUBLE * n) OVER (ORDER BY 2.0::DOUBLE * n / w, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
    / ((sum(w) OVER ()) - coalesce(sum(w) OVER (ORDER BY 2.0::DOUBLE * n / w, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)) AS level
  FROM s
), t AS (
  SELECT source, n, least({float(MOST)}::DOUBLE * n, w * (SELECT first(level ORDER BY 2.0::DOUBLE * n / w, source NULLS LAST) FROM l WHERE level <= 2.0::DOUBLE * n / w)) AS target FROM l
), p AS (
  SELECT doc_id, size, n, target, CASE WHEN n > 0 THEN floor(target / n) ELSE 0 END AS epochs,
    coalesce(sum(size) OVER (PARTITION BY d.source ORDER BY key, coalesce(doc_id, {LOW + 1} - 1), size, r
      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source
)
SELECT doc_id, size, n AS source_size, target,
  (size * (epochs + CASE WHEN size > 0 AND (target - epochs * n - before) / size + 0.5 >= 1 THEN 1 ELSE 0 END))::BIGINT AS taken
FROM p
"""
