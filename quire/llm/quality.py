"""Quality rules with thresholds taken from the data itself.

Each document gets counts of words, symbols, repeated lines and repeated
three-word windows, and shares derived from them. Per language and source the
shares go into mergeable quantile sketches: counts per logarithmic bucket
(values are known to 1 %), which add up in any order, so map tasks combine
them and a hot source costs one row per bucket and task. A group's sketch is
merged with ``PRIOR`` documents' worth of its language's sketch, which steadies
small groups. A document is rejected when a share lies beyond
``median + SPREAD * (upper quartile - median) + slack`` of its group (for the
mean word length also beyond the mirrored lower bound), or by the base rule.

Defined results: a null or blank text has no words and fails the base rule;
null and empty lang or source form one group; repeated rows each count and
each get their verdict; an empty table gives an empty result; columns other
than those named pass through ``keep_documents`` untouched.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from quire.llm.common import SPACES, documents, packed, portions, unpacked, written

COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines")
SYMBOLS = b"#*$%&|<>"
GAMMA = 1.02
PRIOR = 100.0
SPREAD = 6.0
#: share -> (numerator, denominator, slack in the share's unit, also a lower bound)
SHARES = {
    "symbols": ("n_symbols", "n_words", 0.1, False),
    "dup_lines": ("n_dup_lines", "n_lines", 0.4, False),
    "repeats": ("n_repeat_words", "n_words", 0.35, False),
    "word_length": ("word_chars", "n_words", 1.0, True),
}
MIN_WORDS, MAX_REPEAT_PERCENT = 50, 50


def _counts(text: bytes) -> tuple[int, ...]:
    words = text.split()  # bytes split at exactly the six ASCII spaces
    n = len(words)
    kept = text.translate(None, SPACES)
    chars = len(kept) if kept.isascii() else len(kept.decode("utf-8", "replace"))
    lines = [x for x in text.split(b"\n") if x.strip(SPACES)]
    repeated = 0
    if n > 3:
        windows = list(zip(words, words[1:], words[2:]))
        if len(set(windows)) < len(windows):
            seen: dict = {}
            hit = bytearray(n)
            for i, w in enumerate(windows):
                first = seen.setdefault(w, i)
                if first != i:
                    hit[first:first + 3] = hit[i:i + 3] = b"\x01\x01\x01"
            repeated = sum(hit)
    return n, chars, len(kept) - len(kept.translate(None, SYMBOLS)), len(lines) - len(set(lines)), repeated, len(lines)


def with_counts(docs: DataFrame, row: Column | None = None) -> DataFrame:
    """row (by default all columns of ``docs`` in a struct), lang and source
    (null as empty) and the counts in a struct. Only the text goes through
    Python; the rows wait in the JVM, which spills them where it must."""
    kind = StructType([StructField(c, LongType()) for c in COUNTS])

    def count(texts: pa.Array) -> pa.Array:
        found = [np.array([_counts(t or b"") for t in texts.slice(s, n).to_pylist()], np.int64).reshape(-1, len(COUNTS))
                 for s, n in portions(texts)]
        cols = np.concatenate(found or [np.zeros((0, len(COUNTS)), np.int64)]).T
        return pa.StructArray.from_arrays([pa.array(c) for c in cols], list(COUNTS))

    counts = F.arrow_udf(count, kind)(F.col("text").cast("string").cast("binary"))
    return docs.select((packed(docs) if row is None else row).alias("row"), _group("lang").alias("lang"),
                       _group("source").alias("source"), counts.alias("counts"))


def _group(col: str):
    return F.coalesce(F.col(col).cast("string"), F.lit(""))


def base_failed():
    c = F.col
    return ((c("counts.n_words") < MIN_WORDS)
            | (c("counts.n_repeat_words") * 100 > c("counts.n_words") * MAX_REPEAT_PERCENT))


def _shares(counted: DataFrame) -> DataFrame:
    """One row per document and share, for documents that pass the base rule."""
    value = [F.struct(F.lit(k).alias("share"),
                      (F.col(f"counts.{a}") / F.greatest(F.col(f"counts.{b}"), F.lit(1))).alias("v"))
             for k, (a, b, _, _) in SHARES.items()]
    return (counted.where(~base_failed())
            .select("lang", "source", F.explode(F.array(*value)).alias("x"))
            .select("lang", "source", "x.share", "x.v"))


def sketches(counted: DataFrame) -> DataFrame:
    """lang, source, share, bucket, n: bucket b holds values in
    (GAMMA^(b-1), GAMMA^b]; the least bucket holds zeros."""
    bucket = F.when(F.col("v") > 0, F.ceil(F.log(F.col("v")) / F.log(F.lit(GAMMA)))).otherwise(F.lit(-100000))
    return (_shares(counted).groupBy("lang", "source", "share", bucket.cast("int").alias("bucket"))
            .agg(F.count("*").alias("n")))


def thresholds(sketch: DataFrame) -> DataFrame:
    """lang, source, share, low, high. All tables here have a row per group
    and bucket at most."""
    key = ["lang", "source", "share"]
    by_lang = sketch.groupBy("lang", "share", "bucket").agg(F.sum("n").alias("n"))
    of_lang = Window.partitionBy("lang", "share")
    prior = by_lang.select("lang", "share", "bucket", (F.lit(PRIOR) * F.col("n") / F.sum("n").over(of_lang)).alias("n"))
    groups = sketch.select(*key).distinct()
    merged = (groups.join(prior, ["lang", "share"]).select(*key, "bucket", "n")
              .unionByName(sketch.select(*key, "bucket", F.col("n").cast("double").alias("n")))
              .groupBy(*key, "bucket").agg(F.sum("n").alias("n")))
    up = Window.partitionBy(*key).orderBy("bucket")
    ranked = merged.select(*key, "bucket", F.sum("n").over(up).alias("upto"),
                           F.sum("n").over(Window.partitionBy(*key)).alias("total"))
    value = F.when(F.col("bucket") == -100000, 0.0).otherwise(
        F.pow(F.lit(GAMMA), F.col("bucket")) * (2 / (1 + GAMMA)))
    # a ten-thousandth of a document guards against the order of summation
    at = lambda q: F.min(F.when(F.col("upto") + 1e-4 >= F.col("total") * q, value))
    quantiles = ranked.groupBy(*key).agg(at(0.25).alias("q25"), at(0.5).alias("q50"), at(0.75).alias("q75"))
    slack = reduce(lambda e, k: e.when(F.col("share") == k, SHARES[k][2]), SHARES, F).otherwise(0.0)
    two_sided = F.col("share").isin([k for k in SHARES if SHARES[k][3]])
    return quantiles.select(
        *key,
        F.when(two_sided, F.col("q50") - SPREAD * (F.col("q50") - F.col("q25")) - slack).alias("low"),
        (F.col("q50") + SPREAD * (F.col("q75") - F.col("q50")) + slack).alias("high"))


def judge(spark: SparkSession, counted: DataFrame, basis: DataFrame | None = None) -> DataFrame:
    """``counted`` plus ``base_failed`` and ``kept``, by the thresholds of
    ``basis`` (default: ``counted`` itself, then a written table)."""
    limits = thresholds(sketches(counted if basis is None else basis))
    wide = limits.groupBy(F.col("lang").alias("_lang"), F.col("source").alias("_source")).agg(
        *[F.max(F.when(F.col("share") == k, F.col(side))).alias(f"_{k}_{side}")
          for k, (_, _, _, both) in SHARES.items() for side in (("low", "high") if both else ("high",))])
    # written, so that the join knows its size before it would move the texts
    wide = written(spark, wide, "quality-limits")
    value = {k: F.col(f"counts.{a}") / F.greatest(F.col(f"counts.{b}"), F.lit(1)) for k, (a, b, _, _) in SHARES.items()}
    tests = [value[k] <= F.col(f"_{k}_high") for k in SHARES]
    tests += [value[k] >= F.col(f"_{k}_low") for k, v in SHARES.items() if v[3]]
    fine = reduce(lambda a, b: a & b, tests)
    joined = counted.join(wide, (F.col("lang") == F.col("_lang")) & (F.col("source") == F.col("_source")), "left")
    return joined.select(*[counted[c] for c in counted.columns], base_failed().alias("base_failed"),
                         (~base_failed() & F.coalesce(fine, F.lit(False))).alias("kept"))


def keep_documents(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that pass, with their columns. The counts alone are
    written for the thresholds; the texts are counted once more on their way
    through instead of being stored twice."""
    basis = written(spark, with_counts(docs, F.lit(None).cast("int")), "quality-counts")
    return judge(spark, with_counts(docs), basis).where("kept").select(*unpacked(docs))


def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    counted = written(spark, with_counts(docs, F.struct("doc_id")), "quality-counts")
    return judge(spark, counted).select("row.doc_id", *[F.col(f"counts.{c}").alias(c) for c in COUNTS[:5]],
                                        "base_failed", "kept")


def _oracle() -> str:
    share = " UNION ALL ".join(
        f"SELECT lang, source, '{k}' AS share, {a} / greatest({b}, 1) AS v FROM base WHERE NOT base_failed"
        for k, (a, b, _, _) in SHARES.items())
    slack = " ".join(f"WHEN '{k}' THEN {v[2]}" for k, v in SHARES.items())
    test = " AND ".join(
        [f"{a} / greatest({b}, 1) <= max(high) FILTER (share = '{k}')" for k, (a, b, _, _) in SHARES.items()]
        + [f"{a} / greatest({b}, 1) >= max(low) FILTER (share = '{k}')" for k, (a, b, _, two) in SHARES.items() if two])
    return rf"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
    coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w,
    list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines
  FROM documents
), win AS (
  SELECT r, i, [w[i], w[i + 1], w[i + 2]] AS g FROM (SELECT r, w, unnest(range(1, len(w) - 1)) AS i FROM d)
), rep AS (
  SELECT r, count(DISTINCT p) AS n FROM (
    SELECT r, unnest([i, i + 1, i + 2]) AS p FROM (SELECT r, i, count(*) OVER (PARTITION BY r, g) AS c FROM win) WHERE c > 1)
  GROUP BY r
), base AS (
  SELECT *, n_words < {MIN_WORDS} OR 100 * n_repeat_words > {MAX_REPEAT_PERCENT} * n_words AS base_failed FROM (
    SELECT d.r, doc_id, lang, source, len(w) AS n_words,
      length(regexp_replace(text, '[\x20\x09-\x0D]+', '', 'g')) AS word_chars,
      length(regexp_replace(text, '[^#*$%&|<>]+', '', 'g')) AS n_symbols,
      len(lines) - len(list_distinct(lines)) AS n_dup_lines,
      coalesce(rep.n, 0) AS n_repeat_words, len(lines) AS n_lines
    FROM d LEFT JOIN rep USING (r))
), shares AS ({share}
), sk AS (
  SELECT lang, source, share, CASE WHEN v > 0 THEN ceil(ln(v) / ln({GAMMA})) ELSE -100000 END AS bucket,
    count(*)::DOUBLE AS n FROM shares GROUP BY ALL
), prior AS (
  SELECT lang, share, bucket, {PRIOR} * n / sum(n) OVER (PARTITION BY lang, share) AS n
  FROM (SELECT lang, share, bucket, sum(n) AS n FROM sk GROUP BY ALL)
), merged AS (
  SELECT lang, source, share, bucket, sum(n) AS n FROM (
    SELECT * FROM sk UNION ALL
    SELECT g.lang, g.source, g.share, p.bucket, p.n
    FROM (SELECT DISTINCT lang, source, share FROM sk) g JOIN prior p ON g.lang = p.lang AND g.share = p.share)
  GROUP BY ALL
), ranked AS (
  SELECT *, sum(n) OVER (PARTITION BY lang, source, share ORDER BY bucket) AS upto,
    sum(n) OVER (PARTITION BY lang, source, share) AS total,
    CASE WHEN bucket = -100000 THEN 0.0::DOUBLE ELSE pow({GAMMA}, bucket) * (2 / (1 + {GAMMA}::DOUBLE)) END AS v
  FROM merged
), q AS (
  SELECT lang, source, share, min(v) FILTER (upto + 1e-4 >= total * 0.25) AS q25,
    min(v) FILTER (upto + 1e-4 >= total * 0.5) AS q50, min(v) FILTER (upto + 1e-4 >= total * 0.75) AS q75
  FROM ranked GROUP BY ALL
), lim AS (
  SELECT lang, source, share, q50 - {SPREAD} * (q50 - q25) - s AS low, q50 + {SPREAD} * (q75 - q50) + s AS high
  FROM (SELECT *, CASE share {slack} END::DOUBLE AS s FROM q)
)
SELECT doc_id, n_words::BIGINT AS n_words, word_chars::BIGINT AS word_chars, n_symbols::BIGINT AS n_symbols,
  n_dup_lines::BIGINT AS n_dup_lines, n_repeat_words::BIGINT AS n_repeat_words, base_failed,
  NOT base_failed AND coalesce(fine, false) AS kept
FROM (SELECT base.r, doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, {test} AS fine
  FROM base LEFT JOIN lim ON base.lang = lim.lang AND base.source = lim.source
  GROUP BY base.r, doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_lines, base_failed)
"""


OP5_SQL = _oracle()
