"""Language identification by prediction by partial matching (PPM).

For every language a tree of byte contexts up to ``ORDER`` bytes holds how
often each byte followed; statistics are frozen after fitting. A byte's code
length is -log2 p in the longest context the language has seen if it followed
there, else the escape (method C: distinct followers against followers plus
distinct) and so on down to 8 bits. A text's code length is the sum over all
its bytes; the shortest language wins and the score is its posterior.

Because the statistics are frozen, the code length of a byte after a context
is a number: each worker unfolds the counts into a table (context, byte) ->
bits per language and adds up look-ups.

Fitting uses a bounded sample: about ``FIT_DOCS`` distinct texts a language
(all where there are fewer), long ones cut to ``FIT_CHARS`` characters, drawn
by hash from the whole table among rows with a language that are not held out. Scoring reads whole texts.

Defined results: a null text or one without letters is ``und`` with score 0,
as is every text where nothing could be learned; a null doc_id is not held
out and not learned from; ties go to the smaller language code; repeated rows
are scored each; an empty table gives an empty result; other columns are
ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.llm.common import documents, written

ORDER = 3
FIT_DOCS = 400
FIT_CHARS = 20_000
#: Bytes scored at once.
CHUNK = 1 << 20
LETTERISH = re.compile(r"[^\W\d_]")


def held_out() -> Column:
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 4 == 2, F.lit(False))


def sample(spark: SparkSession, docs: DataFrame, per_lang: int = FIT_DOCS) -> DataFrame:
    """lang and text of a bounded, hash-drawn set of labelled texts."""
    usable = (docs.where(F.col("doc_id").isNotNull() & ~held_out() & F.col("lang").isNotNull())
              .select("lang", F.substring("text", 1, FIT_CHARS).alias("text")).where(F.length("text") > 0))
    # distinct texts are counted: copies do not lower the rate
    hashes = usable.select(F.col("lang").alias("_l"), F.xxhash64("text").alias("_h")).distinct()
    counts = written(spark, hashes.groupBy("_l").agg(F.count("*").alias("_n")), "lang-counts")
    drawn = F.pmod(F.xxhash64("text"), F.lit(1_000_000)) / 1_000_000
    return (usable.select("lang", "text", drawn.alias("_u"))
            .join(counts, F.col("lang") == F.col("_l"))
            .where(F.col("_u") * F.col("_n") < per_lang)
            .groupBy("lang", "text").agg(F.lit(1)).select("lang", "text"))


class Counts:
    """Sparse context counts of all languages, small enough to ship to tasks."""

    def __init__(self, texts: dict[str, list[bytes]], order: int = ORDER):
        self.langs, self.order = sorted(texts), order
        used = sorted(set().union(*(set(t) for ts in texts.values() for t in ts))) if texts else []
        self.classes = np.zeros(256, dtype=np.uint8)
        self.classes[used] = np.arange(1, len(used) + 1)
        self.size = a = len(used) + 1  # class 0: a byte never seen, or the start of a text
        self.seen: list[list[tuple[np.ndarray, np.ndarray]]] = []  # [order][language] -> keys, counts
        for k in range(order + 1):
            row = []
            for lang in self.langs:
                keys = []
                for t in texts[lang]:
                    c = np.concatenate((np.zeros(k, np.int64), self.classes[np.frombuffer(t, np.uint8)]))
                    key = np.zeros(len(c) - k, dtype=np.int64)
                    for j in range(k + 1):
                        key = key * a + c[j:len(c) - k + j]
                    keys.append(key)
                row.append(np.unique(np.concatenate(keys), return_counts=True))
            self.seen.append(row)


class Model:
    """Bits of each (context, byte) in each language."""

    def __init__(self, counts: Counts):
        a, langs = counts.size, counts.langs
        self.langs, self.classes, self.size, self.order = langs, counts.classes, a, counts.order
        tables, base = [], 0
        longest = np.zeros(1, dtype=np.int64)  # of each context, the row of its longest seen end
        parent = np.full((1, a, len(langs)), 8.0, dtype=np.float32)
        previous = None
        for k, row in enumerate(counts.seen):
            contexts = np.unique(np.concatenate([keys // a for keys, _ in row])) if row else np.zeros(0, np.int64)
            bits = np.empty((len(contexts), a, len(langs)), dtype=np.float32)
            if k:  # the context without its first byte, one order lower
                up = parent[np.searchsorted(previous, contexts % a ** (k - 1))]
            else:
                up = np.broadcast_to(parent[0], bits.shape)
            for i, (keys, n) in enumerate(row):
                count = np.zeros((len(contexts), a), dtype=np.float32)
                count[np.searchsorted(contexts, keys // a), keys % a] = n
                total, kinds = count.sum(axis=1, keepdims=True), (count > 0).sum(axis=1, keepdims=True)
                whole = np.maximum(total + kinds, 1)
                with np.errstate(divide="ignore"):
                    escape = np.where(total > 0, -np.log2(kinds / whole), 0)
                    bits[:, :, i] = np.where(count > 0, -np.log2(count / whole), escape + up[:, :, i])
            longest = np.tile(longest, a) if k else np.zeros(1, dtype=np.int64)
            longest[contexts] = base + np.arange(len(contexts))
            tables.append(bits)
            parent, previous, base = bits, contexts, base + len(contexts)
        self.longest = longest.astype(np.int32)
        self.bits = np.concatenate(tables).reshape(-1, len(langs)) if base else np.zeros((0, 0), np.float32)

    def code_lengths(self, text: bytes) -> np.ndarray:
        a, k = self.size, self.order
        c = np.concatenate((np.zeros(k, np.int32), self.classes[np.frombuffer(text, np.uint8)].astype(np.int32)))
        total = np.zeros(len(self.langs))
        for s in range(0, len(text), CHUNK):
            e = min(len(text), s + CHUNK)
            context = c[s:e].copy() if k else np.zeros(e - s, np.int32)
            for j in range(1, k):
                context *= a
                context += c[s + j:e + j]
            at = self.longest[context].astype(np.int64) * a + c[s + k:e + k]
            total += self.bits[at].sum(axis=0, dtype=np.float64)
        return total

    def predict(self, text: str | None) -> tuple[str, float]:
        if not text or not self.langs or not has_letter(text):
            return "und", 0.0
        n = self.code_lengths(text.encode("utf-8", "replace"))
        best = int(n.argmin())
        return self.langs[best], float(1 / np.exp2(np.minimum(n[best] - n, 0)).sum())


def has_letter(text: str) -> bool:
    m = LETTERISH.search(text)
    return bool(m) and (m.group().isalpha() or any(map(str.isalpha, text)))


def fit(spark: SparkSession, docs: DataFrame, per_lang: int = FIT_DOCS) -> Counts:
    """Counts from a bounded sample: at most about ``per_lang * FIT_CHARS``
    characters a language reach the driver."""
    texts: dict[str, list[bytes]] = {}
    for lang, text in sample(spark, docs, per_lang).toLocalIterator():
        texts.setdefault(lang, []).append(text.encode("utf-8", "replace"))
    return Counts(texts)


@lru_cache(maxsize=1)
def _unfolded(shared) -> Model:
    return Model(shared.value)


def identify(spark: SparkSession, docs: DataFrame, counts: Counts) -> DataFrame:
    """doc_id, held_out, lang_pred and score of every row."""
    shared = spark.sparkContext.broadcast(counts)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = _unfolded(shared)
        for batch in batches:
            found = [model.predict(t) for t in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array([f[0] for f in found], pa.string()),
                 pa.array([f[1] for f in found], pa.float64())], names=["doc_id", "held_out", "lang_pred", "score"])

    return (docs.select(F.col("doc_id").cast("long"), held_out().alias("held_out"), F.col("text").cast("string"))
            .mapInArrow(score, "doc_id long, held_out boolean, lang_pred string, score double"))


def op4_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    return identify(spark, docs, fit(spark, docs))
