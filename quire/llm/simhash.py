"""SimHash near-duplicates over pigeonhole blocks.

A document's fingerprint has a bit for each of the 64 bits of its shingles'
XXH64 hashes (seed 42), set where more than half of them, repeats included,
set it. Fingerprints link when at most ``DISTANCE`` bits differ.

Those bits lie in at most ``DISTANCE`` of ``blocks`` blocks, so two linked
fingerprints agree in at least ``blocks - DISTANCE`` whole blocks. Each
distinct fingerprint is listed once under every choice of so many blocks, with
what it holds there (20 keys of 31 to 33 bits for six blocks); members of a key
are compared by exclusive or and bit count. More blocks give longer keys and
more of them: keys should have at least as many values as there are distinct
fingerprints (six blocks for some billions, seven: 35 keys of 36 bits beyond).

Equal fingerprints are one from the start. Keys with more than ``SHARE``
members are cut into shares by hash and each pair of shares is a group of its
own, so that no task holds a hot key; of a group's links only as many stay as
connect what they connect. Components then come from hooking and contraction.

Defined results: null texts and texts without words have the fingerprint zero
and link like any other; fewer than n words are one shingle, the whole
sequence; a row without doc_id has its fingerprint, links with nothing and has
a null component; repeated rows and equal doc_ids each get a row; an empty
table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import accumulate, combinations, repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.llm.common import documents, portions, written
from quire.llm.components import components

WORDS, SEED, DISTANCE, BLOCKS = 3, 42, 3, 6
#: Members of a key that are compared in one group.
SHARE = 4096
#: Keys of so many members or fewer are compared a whole batch at a time.
FEW = 12
#: Shingles whose bits are counted at once.
COUNTED = 1 << 16


def shingle_hashes(text: bytes | None, n: int = WORDS, seed: int = SEED) -> np.ndarray:
    """XXH64 of each shingle of n words in a row, A-Z lower-cased."""
    words = (text or b"").lower().split()  # bytes: lower-cases A-Z, splits at the six ASCII spaces
    if not words:
        return np.zeros(0, np.uint64)
    if len(words) <= n:
        return np.array([xxhash.xxh64_intdigest(b" ".join(words), seed)], dtype=np.uint64)
    joined = b" ".join(words)
    ends = list(accumulate(len(w) + 1 for w in words))
    cuts = map(slice, [0, *ends[:len(words) - n]], [e - 1 for e in ends[n - 1:]])
    return np.fromiter(map(xxhash.xxh64_intdigest, map(joined.__getitem__, cuts), repeat(seed)),
                       np.uint64, len(words) - n + 1)


def fingerprint(text: bytes | None, n: int = WORDS, seed: int = SEED) -> int:
    """The fingerprint as an unsigned integer."""
    h = shingle_hashes(text, n, seed).astype(">u8")
    ones = np.zeros(64, np.int64)
    for s in range(0, len(h), COUNTED):
        part = h[s:s + COUNTED]
        ones += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int32)
    return int.from_bytes(np.packbits(2 * ones > len(h)).tobytes(), "big") if len(h) else 0


def fingerprints(docs: DataFrame, n: int = WORDS, seed: int = SEED) -> DataFrame:
    """doc_id and fp, the fingerprint as a signed long, of every row."""
    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, texts = batch.columns
            for s, m in portions(texts):
                found = np.array([fingerprint(t, n, seed) for t in texts.slice(s, m).to_pylist()], dtype=np.uint64)
                yield pa.RecordBatch.from_arrays([ids.slice(s, m), pa.array(found.view(np.int64))], names=["doc_id", "fp"])

    return (docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").cast("binary").alias("text"))
            .mapInArrow(build, "doc_id long, fp long"))


def key_masks(blocks: int, distance: int) -> list[int]:
    """One mask for each choice of ``blocks - distance`` of the blocks."""
    if not 1 <= distance < blocks <= 64:
        raise ValueError("there must be more blocks than bits that may differ")
    edge = [64 * i // blocks for i in range(blocks + 1)]
    block = [(1 << edge[i + 1]) - (1 << edge[i]) for i in range(blocks)]
    return [sum(c) for c in combinations(block, blocks - distance)]


def _signed(mask: int) -> int:
    return mask - (1 << 64) if mask >> 63 else mask


def _joined(labels: np.ndarray, u: np.ndarray, v: np.ndarray) -> np.ndarray:
    """``labels`` (each member's least reached so far) after links u - v."""
    while True:
        a, b = labels[u], labels[v]
        if np.array_equal(a, b):
            return labels
        least = np.minimum(a, b)
        np.minimum.at(labels, a, least)
        np.minimum.at(labels, b, least)
        while not np.array_equal(labels, labels[labels]):
            labels = labels[labels]


def _stars(fp: np.ndarray, first: np.ndarray, distance: int) -> tuple[np.ndarray, np.ndarray]:
    """Links that connect what the links of one group connect: members (of the
    share ``first`` against the rest, or all against all if one is empty)."""
    cross = bool(first.any() and not first.all())
    rows = np.flatnonzero(first) if cross else np.arange(len(fp))
    cols = np.flatnonzero(~first) if cross else rows
    labels = np.arange(len(fp))
    for s in range(0, len(rows), 256):
        some = rows[s:s + 256]
        u, v = np.nonzero(np.bitwise_count(fp[some, None] ^ fp[None, cols]) <= distance)
        labels = _joined(labels, some[u], cols[v])
    moved = np.flatnonzero(labels != np.arange(len(fp)))
    return fp[moved], fp[labels[moved]]


def near(classes: DataFrame, distance: int = DISTANCE, blocks: int = BLOCKS, share: int = SHARE) -> DataFrame:
    """Links (a, b) between the distinct fingerprints of ``classes`` (fp) that
    connect all those within ``distance`` bits of each other."""
    masks = key_masks(blocks, distance)
    unsigned = np.array(masks, dtype=np.uint64)
    listed = classes.select("fp", F.explode(F.array(*[
        F.struct(F.lit(j).alias("j"), F.col("fp").bitwiseAND(F.lit(_signed(m))).alias("key")) for j, m in enumerate(masks)])).alias("k"))
    listed = listed.select("k.j", "k.key", "fp")
    hot = (listed.groupBy("j", "key").agg(F.count("*").alias("c")).where(F.col("c") > share)
           .select(F.col("j").alias("_j"), F.col("key").alias("_key"), F.ceil(F.col("c") / share).cast("int").alias("shares")))
    hot = written(classes.sparkSession, hot, "hot-keys")  # a row for each key of more than ``share`` members
    dealt = (listed.join(hot, (F.col("j") == F.col("_j")) & (F.col("key") == F.col("_key")), "left")
             .withColumn("shares", F.coalesce("shares", F.lit(1)))
             .withColumn("own", F.when(F.col("shares") > 1, F.pmod(F.xxhash64("fp"), F.col("shares")).cast("int")).otherwise(0)))
    groups = (dealt.select("j", "key", "fp", "own", F.explode(F.sequence(F.lit(0), F.col("shares") - 1)).alias("other"))
              .select("j", "key", F.least("own", "other").alias("lo"), F.greatest("own", "other").alias("hi"), "own", "fp"))

    def few(j, fp, start, size) -> tuple[np.ndarray, np.ndarray]:
        """Links of all groups of at most FEW members; rows of a group lie side by side."""
        out = []
        for d in range(1, min(FEW, int(size.max(initial=1)))):
            i = np.flatnonzero((start[:-d] == start[d:]) & (size[:-d] <= FEW))
            x = fp[i] ^ fp[i + d]
            i, x = i[close := np.bitwise_count(x) <= distance], x[close]
            # a pair that agrees on the blocks of an earlier key is found there
            first = ((x[:, None] & unsigned) == 0).argmax(axis=1)
            i = i[first == j[i]]
            out.append((fp[i], fp[i + d]))
        return tuple(np.concatenate(c) if out else fp[:0] for c in zip(*out)) if out else (fp[:0], fp[:0])

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] | None = None

        def links(cols: list[np.ndarray]) -> pa.RecordBatch:
            j, key, lo, hi, own, fp = cols
            new = np.ones(len(fp), bool)
            new[1:] = (j[1:] != j[:-1]) | (key[1:] != key[:-1]) | (lo[1:] != lo[:-1]) | (hi[1:] != hi[:-1])
            at = np.flatnonzero(new)
            length = np.diff(at, append=len(fp))
            start, size = np.repeat(at, length), np.repeat(length, length)
            found = [few(j, fp, start, size)]
            found += [_stars(fp[s:s + n], own[s:s + n] == lo[s], distance)
                      for s, n in zip(at[length > FEW].tolist(), length[length > FEW].tolist())]
            a, b = (np.concatenate(c).view(np.int64) for c in zip(*found))
            return pa.RecordBatch.from_arrays([pa.array(np.maximum(a, b)), pa.array(np.minimum(a, b))], names=["a", "b"])

        for batch in batches:
            cols = [np.asarray(c) for c in batch.columns]
            cols[5] = cols[5].view(np.uint64)
            if held is not None:
                cols = [np.concatenate(c) for c in zip(held, cols)]
            # the last group may go on in the next batch
            last = np.flatnonzero(np.logical_or.reduce([c[1:] != c[:-1] for c in cols[:4]]))
            cut = int(last[-1]) + 1 if len(last) else 0
            held = [c[cut:] for c in cols]
            if cut:
                yield links([c[:cut] for c in cols])
        if held is not None and len(held[0]):
            yield links(held)

    order = ["j", "key", "lo", "hi"]
    return groups.repartition(*order).sortWithinPartitions(*order).mapInArrow(compare, "a long, b long")


def link(spark: SparkSession, docs: DataFrame, n: int = WORDS, distance: int = DISTANCE, blocks: int = BLOCKS,
         share: int = SHARE) -> DataFrame:
    """doc_id, fp and component_id (smallest doc_id reached over links) of every row."""
    rows = written(spark, fingerprints(docs, n), "fingerprints")
    classes = written(spark, rows.where(F.col("doc_id").isNotNull()).groupBy("fp")
                      .agg(F.min("doc_id").alias("rep"), F.count("*").alias("c")), "fingerprint-classes")
    edges = written(spark, near(classes.select("fp"), distance, blocks, share), "fingerprint-links")
    over = components(spark, edges).select(F.col("node").alias("_fp"), "root")
    named = classes.join(over, F.col("fp") == F.col("_fp"), "left").select("fp", "rep", "c", F.coalesce("root", "fp").alias("root"))
    named = written(spark, named, "fingerprint-roots")
    least = (named.groupBy(F.col("root").alias("_root")).agg(F.min("rep").alias("component"), F.sum("c").alias("rows"))
             .where("rows > 1"))  # a row that nothing links with is its own component
    ids = written(spark, named.join(least, F.col("root") == F.col("_root")).select(F.col("fp").alias("_fp"), "component"),
                  "fingerprint-components")
    own = F.col("doc_id")
    return (rows.join(ids, F.col("fp") == F.col("_fp"), "left")
            .select("doc_id", "fp", F.when(own.isNotNull(), F.coalesce("component", own)).alias("component_id")))


def op11_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = link(spark, documents(spark, sf_dir))
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")
