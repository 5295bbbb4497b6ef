"""N-gram Jaccard join with grouped prefixes.

A document's set holds 64-bit hashes of its distinct word n-grams. Equal sets
are one class from the start. With threshold t two sets can only be similar if
they have ``SHARED`` elements in common (or all that so small sets must have)
among the first ``n - ceil(t n) + SHARED`` of each, in one order common to all
sets. Rare elements come first; how rare they are comes from a count table of
fixed size over all documents (``COUNTERS`` sums by leading hash bits), so
passages found in many documents stay out of nearly all prefixes. The order
alone depends on it, never the result.

Classes with equal size and prefix form a group, and only groups are listed
under their prefix elements. Each list streams by size: groups within the sizes
that allow a link are a pair, and pairs that occur in fewer than ``SHARED``
lists fall away. What is left is expanded to its classes and tested on the whole
sets, computed anew from the texts of the classes concerned.

Where more than ``WINDOW`` groups of a list could pair with one, where a list
has more than ``HOT`` rows, and where a group has several classes, pairs are not
listed. There classes are placed in the list with the parity bitmaps of their
sets (``BITS`` bits, one toggled per element), which differ in no more bits than
the sets may differ in elements; sizes, positions and bitmaps are exact bounds.
Stars come first: in each such list, split into shares of about ``SHARE``
classes, all members are compared with the first ``PIVOTS`` in an order by hash,
and what links is joined into components. Then, in lists that still hold several
components, members outside the list's largest component are tested against the
members of other components. Pairs within a component need no test.

Defined results: texts without words and null texts have an empty set, link
with nothing and are their own component; fewer than n words are one element,
the whole sequence; rows without doc_id link with nothing and have a null
component; repeated rows and equal doc_ids each get a row; an empty table
gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
import zlib

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.llm.common import documents, maybe_among, packed, portions, small_batches, unpacked, written
from quire.llm.components import components

WORDS, PERCENT = 3, 90
COUNTERS, BLOCKS = 1 << 20, 64
#: Prefix elements that two similar sets surely share.
SHARED = 3
#: Groups of a list that one may pair with, and rows of a list that streams through one task.
WINDOW, HOT = 32, 20_000
#: Bits of a set's parity bitmap.
BITS = 512
#: Members of a share of a list that all others are compared with, and its size.
PIVOTS, SHARE = 8, 20_000
MAX_WORDS = 100_000
PRIMES = np.array([0x9E3779B185EBCA87, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x85EBCA77C2B2AE63,
                   0x27D4EB2F165667C5, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F], dtype=np.uint64)


class WordHashes(dict):
    """word -> 64-bit hash, kept for words met before."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= MAX_WORDS:
            self.clear()
        value = self[word] = xxhash.xxh64_intdigest(word)
        return value


_hashes = WordHashes()


def forget() -> None:
    """At a task's end: the worker lives on, its table and free buffers need not."""
    _hashes.clear()
    pa.default_memory_pool().release_unused()


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(32))) * PRIMES[5]
    h = (h ^ (h >> np.uint64(29))) * PRIMES[6]
    return h ^ (h >> np.uint64(32))


def shingle_set(text: bytes | None, n: int = WORDS) -> np.ndarray:
    """Sorted distinct hashes of the n-grams of the words, A-Z lower-cased."""
    words = (text or b"").lower().split()  # bytes: lower-cases A-Z, splits at the six ASCII spaces
    if not words:
        return np.zeros(0, np.uint64)
    if len(words) < n:
        return np.array([xxhash.xxh64_intdigest(b" ".join(words), seed=1)], dtype=np.uint64)
    w = np.fromiter(map(_hashes.__getitem__, words), np.uint64, len(words))
    h = np.zeros(len(w) - n + 1, dtype=np.uint64)
    for i in range(n):
        h = (h ^ (h >> np.uint64(31))) * PRIMES[i % 5] + w[i:len(w) - n + 1 + i]
    return np.unique(_mix(h))


def count_table(docs: DataFrame, n: int = WORDS) -> np.ndarray:
    """How many documents hold n-grams of each hash range: ``COUNTERS`` sums,
    whatever the input's size."""
    width = COUNTERS // BLOCKS
    shift = np.uint64(64 - (COUNTERS - 1).bit_length())

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros(COUNTERS, dtype=np.int64)
        for batch in batches:
            for s, m in portions(batch.column(0)):
                for text in batch.column(0).slice(s, m).to_pylist():
                    # a text that repeats a range counts it as often; order is all that matters
                    np.add.at(sums, (shingle_set(text, n) >> shift).astype(np.int64), 1)
        forget()
        parts = [zlib.compress(sums[i * width:(i + 1) * width].tobytes(), 1) for i in range(BLOCKS)]
        yield pa.RecordBatch.from_arrays([pa.array(range(BLOCKS), pa.int32()), pa.array(parts, pa.binary())],
                                         names=["block", "sums"])

    def add(pdf: pd.DataFrame) -> pd.DataFrame:
        total = np.zeros(width, dtype=np.int64)
        for part in pdf["sums"]:
            total += np.frombuffer(zlib.decompress(part), np.int64)
        return pd.DataFrame({"block": [pdf["block"].iloc[0]], "sums": [zlib.compress(total.tobytes(), 1)]})

    rows = (docs.select(F.col("text").cast("binary")).mapInArrow(count, "block int, sums binary")
            .groupBy("block").applyInPandas(add, "block int, sums binary").collect())
    out = np.zeros(COUNTERS, dtype=np.int64)
    for block, sums in rows:
        out[block * width:(block + 1) * width] = np.frombuffer(zlib.decompress(sums), np.int64)
    return np.minimum(out, 0xFFFFFFFF).astype(np.uint32)


def prefix_length(n: int, percent: int) -> int:
    return min(n, n - -(-percent * n // 100) + SHARED)


def sets(docs: DataFrame, n: int, percent: int, shared) -> DataFrame:
    """doc_id, th (hash of the text), n_shingles, sid (128-bit name of the
    set, null if empty), gid (hash of its size and prefix), its prefix, from
    which place on that may have lists of more than HOT rows, and its parity
    bitmap."""
    shift = np.uint64(64 - (COUNTERS - 1).bit_length())
    schema = "doc_id long, th long, n_shingles long, sid binary, gid long, prefix array<long>, bits array<long>, often int"

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = shared.value
        for batch in batches:
            for s, m in portions(batch.column(2)):
                yield one(batch.slice(s, m), counts)
        forget()

    def one(batch: pa.RecordBatch, counts: np.ndarray) -> pa.RecordBatch:
        size, names, groups, prefixes, bits, often = [], [], [], [], [], []
        for text in batch.column(2).to_pylist():
            h = shingle_set(text, n)
            size.append(len(h))
            if not len(h):
                for column in (names, groups, prefixes, bits, often):
                    column.append(None)
                continue
            names.append(xxhash.xxh3_128_digest(h.tobytes()))
            key = (counts[h >> shift].astype(np.uint64) << np.uint64(32)) | (h & np.uint64(0xFFFFFFFF))
            first = np.argsort(key, kind="stable")[:prefix_length(len(h), percent)]
            prefixes.append(h[first].view(np.int64))
            # the table counts an element's whole range, so rarer ranges have shorter lists
            often.append(int(np.searchsorted(key[first] >> np.uint64(32), HOT, "right")))
            groups.append(xxhash.xxh64_intdigest(h[first].tobytes(), seed=len(h)) - (1 << 63))
            odd = np.bincount((h & np.uint64(BITS - 1)).astype(np.int64), minlength=BITS) & 1
            bits.append(np.packbits(odd.astype(np.uint8)).view(np.int64))
        return pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array(size, pa.int64()), pa.array(names, pa.binary()),
             pa.array(groups, pa.int64()), pa.array(prefixes, pa.list_(pa.int64())), pa.array(bits, pa.list_(pa.int64())),
             pa.array(often, pa.int32())],
            names=["doc_id", "th", "n_shingles", "sid", "gid", "prefix", "bits", "often"])

    return (docs.select(F.col("doc_id").cast("long"), F.xxhash64("text").alias("th"), F.col("text").cast("binary"))
            .mapInArrow(build, schema))


def _could(n1: Column, n2: Column, percent: int) -> Column:
    """Sizes that allow a link."""
    return (F.least(n1, n2) * 100 >= F.greatest(n1, n2) * percent)


def _room(n1: Column, p1: Column, n2: Column, p2: Column, percent: int) -> Column:
    """If this is the first element both share, what follows it could still be
    enough: (100 + percent) * overlap >= percent * (n1 + n2)."""
    return F.least(n1 - p1, n2 - p2) * (100 + percent) >= (n1 + n2) * percent


def _alike(n1: Column, b1: str, n2: Column, b2: str, percent: int) -> Column:
    """Bits that differ belong to elements of one set only, and a link allows
    (100 - percent) / (100 + percent) of n1 + n2 such elements."""
    words = [F.bit_count(F.col(b1)[i].bitwiseXOR(F.col(b2)[i])) for i in range(BITS // 64)]
    return reduce(lambda x, y: x + y, words) * (100 + percent) <= (n1 + n2) * (100 - percent)


def _lists(posted: DataFrame, percent: int) -> DataFrame:
    """Rows of ``posted`` (tok, n, pos, gid) become pairs of groups (a, b; n the
    larger size) whose sizes allow a link, or, in lists with too many of these,
    come out as they are (a null b; a the gid)."""
    schema = "tok long, n int, pos int, a long, b long"

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] | None = None

        def paired(tok: np.ndarray, n: np.ndarray, pos: np.ndarray, gid: np.ndarray) -> Iterator[pa.RecordBatch]:
            start = np.concatenate(([True], tok[1:] != tok[:-1]))
            place = np.cumsum(start) - 1
            span = np.int64(1) << 32
            # rows of a list rise by size: one's partners are those after it up to the largest size allowed
            ends = np.searchsorted(place * span + n, place * span + np.minimum(n.astype(np.int64) * 100 // percent, span - 1), "right")
            width = ends - np.arange(len(n)) - 1
            thick = (np.maximum.reduceat(width, np.flatnonzero(start)) > WINDOW)[place]
            out = np.flatnonzero(thick)
            if len(out):
                yield pa.RecordBatch.from_arrays([*(pa.array(c[out]) for c in (tok, n, pos, gid)), pa.nulls(len(out), pa.int64())],
                                                 names=["tok", "n", "pos", "a", "b"])
            width[thick] = 0
            upto = np.cumsum(width)
            cuts = np.searchsorted(upto, np.arange(0, int(upto[-1]), 1 << 20))  # about a million pairs at once
            for s, e in zip(cuts.tolist(), [*cuts[1:].tolist(), len(n)]):
                w = width[s:e]
                i = np.repeat(np.arange(s, e), w)
                j = i + 1 + np.arange(len(i)) - np.repeat(np.cumsum(w) - w, w)
                x, y = gid[i], gid[j]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(tok[i]), pa.array(n[j]), pa.array(pos[j]), pa.array(np.minimum(x, y)), pa.array(np.maximum(x, y))],
                    names=["tok", "n", "pos", "a", "b"])

        for batch in batches:
            cols = [np.asarray(c) for c in batch.columns]
            if held is not None:
                cols = [np.concatenate(c) for c in zip(held, cols)]
            last = np.flatnonzero(cols[0][1:] != cols[0][:-1])
            cut = int(last[-1]) + 1 if len(last) else 0  # the last list may go on
            held = [c[cut:] for c in cols]
            if cut:
                yield from paired(*(c[:cut] for c in cols))
        if held is not None and len(held[0]):
            yield from paired(*held)

    return (posted.select("tok", "n", "pos", "gid").repartition("tok").sortWithinPartitions("tok", "n", "gid")
            .mapInArrow(scan, schema))


def _stars(placed: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b: sids) of each list's members and pivots whose sizes and
    bitmaps allow a link. Rows stream by list; only the pivots are held."""
    schema = "a binary, b binary"
    width = BITS // 64

    def star(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, names, sizes, maps = None, [], [], []
        for batch in batches:
            keys = list(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()))
            n, ids = batch.column(2).to_pylist(), batch.column(3).to_pylist()
            bits = np.asarray(batch.column(4).flatten()).view(np.uint64).reshape(-1, width)
            out: tuple[list, list] = ([], [])
            for i, key in enumerate(keys):
                if key != current:
                    current, names, sizes, maps = key, [], [], []
                for name, size, other in zip(names, sizes, maps):
                    both = n[i] + size
                    if (name != ids[i] and min(n[i], size) * 100 >= max(n[i], size) * percent
                            and int(np.bitwise_count(bits[i] ^ other).sum()) * (100 + percent) <= both * (100 - percent)):
                        out[0].append(max(name, ids[i]))
                        out[1].append(min(name, ids[i]))
                if len(names) < PIVOTS:
                    names.append(ids[i])
                    sizes.append(n[i])
                    maps.append(bits[i].copy())
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.binary()) for c in out], names=["a", "b"])

    share = F.pmod(F.xxhash64("sid"), F.ceil(F.col("c") / SHARE)).cast("int")
    rows = placed.select("tok", share.alias("share"), F.col("n").cast("long").alias("n"), "sid", "bits")
    return (rows.repartition("tok", "share").sortWithinPartitions("tok", "share", F.xxhash64("sid"))
            .mapInArrow(star, schema))


def _verified(spark: SparkSession, pairs: DataFrame, texts: DataFrame, n: int, percent: int) -> DataFrame:
    """Those of ``pairs`` (a, b: sids) whose sets are similar; ``texts`` has
    sid and text of the classes in them."""
    schema = "a binary, b binary"

    def test(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b, ta, tb = (batch.column(i) for i in range(4))
            keep, last, left = [], None, None
            for s, m in portions(ta):  # the texts of similar sizes come in twos, so both are held bit by bit
                for i, (x, y) in enumerate(zip(ta.slice(s, m).to_pylist(), tb.slice(s, m).to_pylist()), s):
                    if y != last:
                        last, left = y, shingle_set(y, n)
                    right = shingle_set(x, n)
                    both = len(np.intersect1d(left, right, assume_unique=True))
                    if 100 * both >= percent * (len(left) + len(right) - both):
                        keep.append(i)
            keep = pa.array(keep, pa.int64())
            yield pa.RecordBatch.from_arrays([a.take(keep), b.take(keep)], names=["a", "b"])
        forget()

    one = texts.select(F.col("sid").alias("_a"), F.col("text").alias("_ta")).hint("merge")
    two = texts.select(F.col("sid").alias("_b"), F.col("text").alias("_tb")).hint("merge")
    return (pairs.join(one, F.col("a") == F.col("_a")).join(two, F.col("b") == F.col("_b"))
            .select("a", "b", "_ta", "_tb").mapInArrow(test, schema))


def _texts(spark: SparkSession, docs: DataFrame, classes: DataFrame, pairs: DataFrame) -> DataFrame:
    """sid and text (binary) of the classes named in ``pairs``."""
    named = pairs.select(F.col("a").alias("sid")).union(pairs.select("b")).distinct()
    wanted = classes.join(named, "sid", "left_semi").select("sid", F.col("rep").alias("_rep"), F.col("th").alias("_th"))
    wanted = written(spark, wanted, "wanted")
    found = (docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("th"), F.col("text").cast("binary").alias("text"))
             .where(F.col("doc_id").isNotNull()))
    # texts move once, and at no size more than the wanted ones and some that share their bits
    found = maybe_among(found, ["doc_id", "th"], wanted.select("_rep", "_th")).where("_maybe").drop("_maybe")
    rows = found.join(wanted.hint("merge"), (F.col("doc_id") == F.col("_rep")) & (F.col("th") == F.col("_th")))
    return written(spark, rows.dropDuplicates(["doc_id", "th", "sid"]).select("sid", "text"), "class-texts")


def link(spark: SparkSession, docs: DataFrame, n: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """doc_id, th, n_shingles, component_id (the smallest doc_id reached over
    links) and root (a name of the component, null for rows that cannot link)
    of every row."""
    with small_batches(spark):
        shared = spark.sparkContext.broadcast(count_table(docs, n))
        rows = written(spark, sets(docs, n, percent, shared), "sets")
    first = F.min(F.struct("doc_id", "th"))
    classes = written(spark, rows.where(F.col("sid").isNotNull() & F.col("doc_id").isNotNull())
                      .groupBy("sid").agg(first.alias("f"), F.first("n_shingles").alias("n"), F.first("gid").alias("gid"),
                                            F.first("bits").alias("bits"))
                      .select("sid", "gid", F.col("f.doc_id").alias("rep"), F.col("f.th").alias("th"), "n", "bits"), "classes")
    # groups: classes of equal size and prefix; one document of each lists its prefix
    groups = written(spark, classes.groupBy("gid").agg(F.count("*").alias("m"), F.min("sid").alias("one"), F.first("n").cast("int").alias("n"),
                                                       F.min(F.struct("rep", "th")).alias("f")), "groups")
    # tables here grow with the input on both sides: they are joined by sorting at every size
    heads = groups.select(F.col("gid").alias("_g"), F.col("f.rep").alias("_rep"), F.col("f.th").alias("_th")).hint("merge")
    posted = (rows.join(heads, (F.col("doc_id") == F.col("_rep")) & (F.col("th") == F.col("_th")) & (F.col("gid") == F.col("_g")))
              .select("gid", F.col("n_shingles").cast("int").alias("n"), "often", F.posexplode("prefix").alias("pos", "tok")))
    hot = written(spark, posted.where(F.col("pos") >= F.col("often")).groupBy("tok").agg(F.count("*").alias("c")).where(F.col("c") > HOT).select(F.col("tok").alias("_tok")), "hot-lists")
    listed = posted.join(hot, F.col("tok") == F.col("_tok"), "left")
    found = written(spark, _lists(listed.where(F.col("_tok").isNull()), percent).withColumnRenamed("a", "gid").unionByName(
        listed.where(F.col("_tok").isNotNull()).select("tok", "n", "pos", "gid", F.lit(None).cast("long").alias("b"))), "lists")

    # pairs of groups that share enough elements; those of single classes are pairs of classes
    enough = F.least(F.lit(SHARED), F.ceil(F.col("n") * percent / 100))
    near = (found.where(F.col("b").isNotNull()).groupBy(F.col("gid").alias("a"), "b").agg(F.count("*").alias("k"), F.max("n").alias("n"))
            .where(F.col("k") >= enough).select("a", "b"))
    side = lambda x: groups.select(F.col("gid").alias(x), F.col("m").alias(f"m{x}"), F.col("one").alias(f"s{x}"), F.col("n").alias(f"n{x}"))
    near = written(spark, near.join(side("a"), "a").join(side("b"), "b"), "group-pairs")
    alone = (F.col("ma") == 1) & (F.col("mb") == 1)
    bits = lambda x: classes.select(F.col("sid").alias(f"_{x}"), F.col("bits").alias(f"b{x}"))
    single = (near.where(alone).join(bits("sa"), F.col("sa") == F.col("_sa")).join(bits("sb"), F.col("sb") == F.col("_sb"))
              .where(_alike(F.col("na"), "bsa", F.col("nb"), "bsb", percent))
              .select(F.greatest("sa", "sb").alias("a"), F.least("sa", "sb").alias("b")))
    # all other pairs and each group of several classes are lists of their own
    own = lambda tok, gid, n: F.struct(tok.alias("tok"), n.alias("n"), F.lit(0).alias("pos"), gid.alias("gid"))
    both = F.xxhash64("a", "b")
    dense = (near.where(~alone).select(F.explode(F.array(own(both, F.col("a"), F.col("na")), own(both, F.col("b"), F.col("nb")))).alias("x")).select("x.*")
             .unionByName(groups.where("m > 1").select(own(F.xxhash64("gid"), F.col("gid"), F.col("n")).alias("x")).select("x.*"))
             .unionByName(found.where(F.col("b").isNull()).select("tok", "n", "pos", "gid")))
    dense = written(spark, dense, "dense-lists")  # rows of 24 bytes, without names of classes
    sizes = dense.join(groups.select(F.col("gid").alias("_g"), "m"), F.col("gid") == F.col("_g")).groupBy(F.col("tok").alias("_tok")).agg(F.sum("m").alias("c"))
    dense = written(spark, dense.join(sizes, F.col("tok") == F.col("_tok")).select("tok", "c", "n", "pos", "gid"), "sized-lists")
    members = classes.select(F.col("gid").alias("_g"), "sid", "bits").hint("merge")
    # bitmaps travel to the stars alone; later steps fetch those of the few classes that are left
    mapped = dense.join(members, F.col("gid") == F.col("_g")).select("tok", "c", "n", "sid", "bits")
    placed = dense.join(members, F.col("gid") == F.col("_g")).select("tok", "n", "pos", "sid")

    def rooted(df: DataFrame, over: DataFrame) -> DataFrame:
        """``root`` replaced by the root of its component in ``over``."""
        new = over.select(F.col("node").alias("_x"), F.col("root").alias("_over"))
        return (df.join(new, F.col("root") == F.col("_x"), "left").withColumn("root", F.coalesce("_over", "root"))
                .drop("_x", "_over"))

    def test(pairs: DataFrame) -> DataFrame:
        """Edges between the roots (ra, rb) of those pairs (a, b, ra, rb) that link."""
        pairs = written(spark, pairs.groupBy("a", "b").agg(F.first("ra").alias("ra"), F.first("rb").alias("rb")), "pairs")
        if pairs.isEmpty():
            return pairs.select(F.col("ra").alias("a"), F.col("rb").alias("b"))
        good = _verified(spark, pairs.select("a", "b"), _texts(spark, docs, classes, pairs), n, percent)
        back = pairs.select(F.col("a").alias("_a"), F.col("b").alias("_b"), "ra", "rb")
        with small_batches(spark):
            return written(spark, good.join(back, (F.col("a") == F.col("_a")) & (F.col("b") == F.col("_b")))
                           .select(F.col("ra").alias("a"), F.col("rb").alias("b")), "links")

    def several(df: DataFrame) -> DataFrame:
        """Rows in lists of more than one component, with the list's largest."""
        parts = df.groupBy("tok", "root").agg(F.count("*").alias("c"))
        mixed = (parts.groupBy("tok").agg(F.count("*").alias("k"), F.max(F.struct("c", "root")).alias("h")).where("k > 1")
                 .select(F.col("tok").alias("_tok"), F.col("h.root").alias("hub")))
        return df.join(mixed, F.col("tok") == F.col("_tok")).drop("_tok")

    near_ = lambda n1, b1, n2, b2: (
        _could(F.col(n1), F.col(n2), percent) & _alike(F.col(n1), b1, F.col(n2), b2, percent))
    found = test(_stars(mapped, percent).unionByName(single).select("a", "b", F.col("a").alias("ra"), F.col("b").alias("rb")))
    over = components(spark, found)
    placed = written(spark, rooted(placed.withColumn("root", F.col("sid")), over), "placed")
    named = written(spark, rooted(classes.select("sid", "rep", F.col("sid").alias("root")), over), "roots")

    # the rest: members outside a list's largest component against other components
    left = written(spark, several(placed), "several")
    open_ = written(spark, left.join(classes.select(F.col("sid").alias("_s"), "bits"), F.col("sid") == F.col("_s")).drop("_s"), "open")
    x = open_.where(F.col("root") != F.col("hub")).select(
        *[F.col(c).alias(f"x{c}") for c in ("tok", "n", "pos", "sid", "bits", "root")])
    cross = (x.join(open_, (F.col("xtok") == F.col("tok")) & (F.col("xroot") != F.col("root"))
                    & near_("xn", "xbits", "n", "bits")
                    & _room(F.col("xn"), F.col("xpos"), F.col("n"), F.col("pos"), percent))
             .select(F.greatest("xsid", "sid").alias("a"), F.least("xsid", "sid").alias("b"),
                     F.col("xroot").alias("ra"), F.col("root").alias("rb")))
    late = test(cross)
    if not late.isEmpty():
        named = rooted(named, components(spark, late))

    least = named.groupBy("root").agg(F.min("rep").alias("component"))
    ids = written(spark, named.join(least.withColumnRenamed("root", "_r").hint("merge"), F.col("root") == F.col("_r"))
                  .select(F.col("sid").alias("_sid"), "component", "root"), "class-components").hint("merge")
    own = F.col("doc_id")
    return (rows.join(ids, F.col("sid") == F.col("_sid"), "left")
            .select("doc_id", "th", "n_shingles", F.when(own.isNotNull(), F.coalesce("component", own)).alias("component_id"),
                    F.when(own.isNotNull(), F.col("root")).alias("root")))


def keep_one(spark: SparkSession, docs: DataFrame, n: int = 5, percent: int = 80) -> DataFrame:
    """``docs`` without near copies: of each component the row with the
    smallest doc_id stays (of several with one doc_id, one)."""
    rows = (link(spark, docs, n, percent).where(F.col("root").isNotNull())
            .groupBy("root", "doc_id", "th").agg(F.count("*").alias("m")))
    rows = written(spark, rows, "linked")
    first = rows.groupBy(F.col("root").alias("_root")).agg(F.min(F.struct("doc_id", "th")).alias("_first"))
    stays = F.struct("doc_id", "th") == F.col("_first")
    acts = (rows.join(first, F.col("root") == F.col("_root")).where(~stays | (F.col("m") > 1))
            .groupBy(F.col("doc_id").alias("_doc"), F.col("th").alias("_th")).agg(F.max(stays).alias("_once")))
    acts = written(spark, acts, "drops")
    keyed = docs.select(packed(docs), F.col("doc_id").cast("long").alias("_d"), F.xxhash64("text").alias("_h"))

    def met(some: DataFrame, how: str) -> DataFrame:
        """Of the rows that may be in ``some``, those that are or are not."""
        near = maybe_among(keyed, ["_d", "_h"], some).where(F.col("_maybe") & F.col("_d").isNotNull())
        return near.join(some.hint("merge"), (F.col("_d") == F.col("_doc")) & (F.col("_h") == F.col("_th")), how)

    some = acts.select("_doc", "_th")
    clear = maybe_among(keyed, ["_d", "_h"], some).where(~F.col("_maybe") | F.col("_d").isNull()).select("row")
    rest = met(some, "left_anti").select("row")
    once = met(acts.where("_once").select("_doc", "_th"), "left_semi").dropDuplicates(["_d", "_h"]).select("row")
    return clear.unionByName(rest).unionByName(once).select(*unpacked(docs))


def op8_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return link(spark, documents(spark, sf_dir)).select("doc_id", "n_shingles", "component_id")


OP8_SQL = rf"""
WITH RECURSIVE d AS (
  SELECT row_number() OVER () AS r, doc_id,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
  FROM documents
), g AS (
  SELECT r, doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < {WORDS} THEN [array_to_string(w, ' ')]
    ELSE list_distinct(list_transform(range(1, len(w) - {WORDS} + 2), lambda i: array_to_string(w[i:i + {WORDS} - 1], ' '))) END AS s
  FROM d
), t AS MATERIALIZED (SELECT r, len(s) AS n, unnest(s) AS tok FROM g WHERE doc_id IS NOT NULL
), links AS MATERIALIZED (
  SELECT a, b FROM (SELECT x.r AS a, y.r AS b, any_value(x.n) AS na, any_value(y.n) AS nb, count(*) AS c
    FROM t x JOIN t y ON x.tok = y.tok AND x.r <> y.r AND least(x.n, y.n) * 100 >= greatest(x.n, y.n) * {PERCENT} GROUP BY 1, 2)
  WHERE 100 * c >= {PERCENT} * (na + nb - c)
), reach(a, b) AS (
  SELECT r, r FROM g UNION SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a
)
SELECT any_value(g.doc_id) AS doc_id, any_value(len(g.s))::BIGINT AS n_shingles,
  CASE WHEN any_value(g.doc_id) IS NOT NULL THEN min(o.doc_id) END AS component_id
FROM g JOIN reach ON reach.a = g.r JOIN g o ON o.r = reach.b GROUP BY g.r
"""
