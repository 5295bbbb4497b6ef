"""Alignment of two tokenizers' tokens, with corpus-wide counts of linked ids.

Both tokenizers cut the bytes of a space and the text. Byte offsets where a
token of A and a token of B both end cut the text into groups; tokens whose
byte ranges overlap are linked. Between two neighbouring ends of either side
lies exactly one token of A and one of B, so each such segment is one link.

Neither tokenizer joins what lies before and after a space or line feed that
follows a letter, digit or other visible character (A splits there before it
merges; no piece of B spans it, which is tested when the models are loaded).
Texts are cut at these places and each distinct chunk is encoded and aligned
once per worker, as long as its bounded table lasts.

Counts: first, each task sums the pairs of its part of the corpus, by
``SHARDS`` ranges of the pairs' hash. The distinct pairs of a shard get a
minimal perfect hash (levels of bit arrays: a pair whose place in a level no
other pair has is settled there and is numbered by the rank of its bit), and
the tasks' sums become dense vectors indexed by it, added up in a tree. A
shard's pairs stand beside its counts in the same order, so that every look-up
is verified. Second, documents are aligned again and their links look up their
counts. There can be no more pairs than the product of the vocabularies; a
look-up table holds ``SLICE`` pairs or one shard, and where there are more,
the documents are read once for each slice and the sums are added.

Defined results: texts that are null or empty, or that a tokenizer does not
give back byte for byte, have no tokens: zeros and an empty digest; rows with
null doc_id and repeated rows each get a row; an empty table gives an empty
result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
from collections.abc import Callable, Iterator
from functools import lru_cache
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.llm.common import documents, portions, written
from quire.llm.tokens import byte_letters

SHARDS, BRANCHES, SLICE = 256, 16, 4_000_000
#: Chunks in a worker's table; longer ones are aligned each time; chunks encoded in one call.
MAX_CHUNKS, MAX_CHUNK, AT_ONCE = 300_000, 64, 2_000
#: Fixed value: the pattern by which byte-level vocabularies split a text.
BYTE_LEVEL = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: Bits of a level for each pair that it still has to place.
GAMMA = 2.0
#: A cut may follow these characters and stands before a space or line feed.
CUT = re.compile(r"(?<=[!-~\w])(?=[ \n])")
SAFE = re.compile(r"[!-~\w]")
OUT = ("doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string")


def default_tokenizers() -> tuple[str, str]:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


class Aligner:
    """Both tokenizers over single texts and over many chunks at once."""

    def __init__(self, path_a: str, path_b: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(path_a)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=path_b)
        letters = byte_letters()
        vocab = self.a.get_vocab(with_added_tokens=False)
        self.ranked = self._ranked(path_a, {t: bytes(letters[c] for c in t) for t in vocab})
        a_bytes = [b""] * (max(vocab.values()) + 1)
        for token, i in vocab.items():
            a_bytes[i] = bytes(letters[c] for c in token)
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        if any("▁" in p.lstrip("▁") or "\n" in p for p in pieces):
            raise ValueError("a piece spans words: chunks cannot be encoded alone")
        b_bytes = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(pieces)]
        self.a_place, self.a_all = self._laid(a_bytes)
        self.b_place, self.b_all = self._laid(b_bytes)
        self.decimal = [b"%d%c" % (i, c) for i in range(max(len(a_bytes), len(b_bytes))) for c in b",|;"]
        self.decimal_size = np.array([len(d) for d in self.decimal])
        self.lead = tuple(len(x) for x in self.encode(" -"))

    def _ranked(self, path: str, tokens: dict[str, bytes]):
        """The same vocabulary as an encoder of ranks, several times as fast;
        it merges alike where ids rise with the order of the merges."""
        import tiktoken

        model = json.loads(Path(path).read_text())["model"]
        merged = ["".join(m.split(" ") if isinstance(m, str) else m) for m in model["merges"]]
        ids = [model["vocab"][m] for m in merged]
        if ids != list(range(256, 256 + len(ids))):
            return None
        ranks = {tokens[t]: i for t, i in model["vocab"].items() if i < 256 + len(ids)}
        return tiktoken.Encoding("ranked", pat_str=BYTE_LEVEL, mergeable_ranks=ranks, special_tokens={})

    @staticmethod
    def _laid(tokens: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Where each token's bytes begin and end in one array of them all."""
        ends = np.cumsum([0] + [len(t) for t in tokens])
        return ends, np.frombuffer(b"".join(tokens), np.uint8)

    @staticmethod
    def _bytes(ids: np.ndarray, place: np.ndarray, every: np.ndarray) -> bytes:
        size = place[ids + 1] - place[ids]
        at = np.arange(int(size.sum())) + np.repeat(place[ids] - np.cumsum(size) + size, size)
        return every[at].tobytes()

    def encode(self, text: str) -> tuple[np.ndarray, np.ndarray] | None:
        """Ids of A and B over ``text``, which begins with a space; None if
        their bytes are not those of the text."""
        if self.ranked is not None:
            a = self.ranked.encode_ordinary(text)
        else:
            a = self.a.encode_batch_fast([text], add_special_tokens=False)[0].ids
        a, b = np.array(a, np.int64), np.array(self.b.encode(text[1:]), np.int64)
        raw = text.encode()
        if self._bytes(a, self.a_place, self.a_all) != raw or self._bytes(b, self.b_place, self.b_all) != raw:
            return None
        return a, b

    def joint(self, chunks: list[str]) -> list[tuple[np.ndarray, np.ndarray]] | None:
        """Ids of A and B of chunks in a row, after a first word that is dropped."""
        got = self.encode(" -" + "".join(chunks))
        return got and (got[0][self.lead[0]:], got[1][self.lead[1]:])

    def many(self, chunks: list[str]) -> list[tuple[list[str], tuple | None]]:
        """Parts of ``chunks`` (each begins with a space or line feed and ends
        in a character that a cut may follow) and their ids, None if not given back."""
        got = self.joint(chunks)
        if got is not None or len(chunks) == 1:
            return [(chunks, got)]
        half = len(chunks) // 2
        return self.many(chunks[:half]) + self.many(chunks[half:])

    def lay_out(self, a: np.ndarray, b: np.ndarray, sizes: np.ndarray, texts: bool):
        """For chunks of ``sizes`` bytes with ids ``a`` and ``b`` in a row:
        n_a, n_b, n_groups and n_links of each, all links' pairs and, if asked
        for, each chunk's groups as text with a semicolon after each."""
        ends = np.concatenate(([0], np.cumsum(sizes)))
        a_end = np.cumsum(self.a_place[a + 1] - self.a_place[a])
        b_end = np.cumsum(self.b_place[b + 1] - self.b_place[b])
        in_a, in_b = np.zeros(int(ends[-1]) + 1, bool), np.zeros(int(ends[-1]) + 1, bool)
        in_a[a_end] = in_b[b_end] = True
        group, link = in_a & in_b, np.flatnonzero(in_a | in_b)
        if not group[ends[1:][np.asarray(sizes) > 0]].all():
            raise ValueError("a token spans two chunks")
        upto_a, upto_b, upto_g = np.cumsum(in_a), np.cumsum(in_b), np.cumsum(group)
        n_a, n_b, n_g = (np.diff(c[ends]) for c in (upto_a, upto_b, upto_g))
        pairs = a[upto_a[link] - in_a[link]] << 32 | b[upto_b[link] - in_b[link]]
        n = np.stack((n_a, n_b, n_g, n_a + n_b - n_g), 1)
        if not texts:
            return n, pairs, [b""] * len(n)
        last_a, last_b = group[a_end], group[b_end]
        of_a, of_b = upto_g[a_end] - last_a, upto_g[b_end] - last_b
        order = np.argsort(np.concatenate((2 * of_a, 2 * of_b + 1)), kind="stable")
        codes = np.concatenate((3 * a + last_a, 3 * b + 2 * last_b))[order]
        joined = b"".join(map(self.decimal.__getitem__, codes.tolist()))
        at = np.concatenate(([0], np.cumsum(self.decimal_size[codes])))[np.concatenate(([0], np.cumsum(n_a + n_b)))].tolist()
        return n, pairs, [joined[s:e] for s, e in zip(at[:-1], at[1:])]

    def align(self, chunk: str, texts: bool = True):
        """As ``lay_out`` for one chunk that ends in any way; None if not given back."""
        got = self.joint([chunk])
        return got and self.lay_out(*got, np.array([len(chunk.encode())]), texts)


@lru_cache(maxsize=2)
def aligner(path_a: str, path_b: str) -> Aligner:
    """One pair of tokenizers per worker process."""
    return Aligner(path_a, path_b)


def _chunk(key: str) -> str:
    """The chunk that a table key names: a space before it is left out unless
    white space follows."""
    return key if key[0] in " \n" else " " + key


def chunk_keys(text: str) -> list[str]:
    """Keys of the chunks of a space and ``text`` (not empty)."""
    keys = text.replace("\n", " \n").split(" ")
    if not all(SAFE.match(c) for c in {k[-1:] for k in keys}):  # runs of white space: cut with care
        return [c[1:] if c[0] == " " and c[1:2] not in ("", " ", "\n") else c for c in CUT.split(" " + text)]
    return keys


class Table:
    """Chunks met so far and what their links give: ``of(keys)`` are their
    numbers. ``n`` has columns n_a, n_b, n_groups, n_links; ``bad`` marks
    chunks that a tokenizer does not give back."""

    def __init__(self, tokens: Aligner, texts: bool, most: int = MAX_CHUNKS):
        self.tokens, self.texts, self.most = tokens, texts, most
        self.clear()

    def clear(self) -> None:
        self.number: dict[str, int] = {}
        self.n, self.bad = np.zeros((0, 4), np.int64), np.zeros(0, bool)
        self.pairs: list[np.ndarray] = []
        self.words: list[bytes] = []

    def learn(self, keys: list[str]) -> np.ndarray:
        """Numbers for new ``keys``; returns their links' pairs, one after the other."""
        joint = [k for k in keys if len(k) <= MAX_CHUNK and SAFE.match(k[-1])]
        other = [k for k in keys if len(k) > MAX_CHUNK or not SAFE.match(k[-1])]
        none = np.zeros(0, np.int64)
        a, b, sizes, bad = [none], [none], [], []
        for s in range(0, len(joint), AT_ONCE):
            for part, got in self.tokens.many([_chunk(k) for k in joint[s:s + AT_ONCE]]):
                bad += [got is None] * len(part)
                sizes += [0] if got is None else [len(c.encode()) for c in part]
                a.append(none if got is None else got[0])
                b.append(none if got is None else got[1])
        found = [self.tokens.lay_out(np.concatenate(a), np.concatenate(b), np.array(sizes, np.int64), self.texts)]
        for key in other:
            got = self.tokens.align(_chunk(key), self.texts)
            bad.append(got is None)
            found.append((np.zeros((1, 4), np.int64), none, [b""]) if got is None else got)
        base = len(self.number)
        self.number.update(zip(joint + other, range(base, base + len(keys))))
        self.n = np.concatenate((self.n, *[f[0] for f in found]))
        self.bad = np.concatenate((self.bad, np.array(bad, bool)))
        new = np.concatenate([f[1] for f in found])
        self.pairs.append(new)
        for f in found:
            self.words += f[2]
        return new


def _mix(keys: np.ndarray, level: int) -> np.ndarray:
    h = keys.view(np.uint64) + np.uint64((0x9E3779B97F4A7C15 * (level + 1)) & ((1 << 64) - 1))
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def shard_of(keys: np.ndarray) -> np.ndarray:
    return (_mix(keys, -1) >> np.uint64(56)).astype(np.int64) * SHARDS >> 8


def perfect_hash(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Level sizes and bits of a minimal perfect hash of distinct ``keys``,
    and the keys in the order of their numbers."""
    sizes, bits, order, rest = [], [], [], keys
    while len(rest):
        size = max(8, int(GAMMA * len(rest)))
        at = (_mix(rest, len(sizes)) % np.uint64(size)).astype(np.int64)
        alone = np.bincount(at, minlength=size) == 1
        settled = alone[at]
        order.append(rest[settled][np.argsort(at[settled])])
        sizes.append(size)
        bits.append(alone)
        rest = rest[~settled]
    empty = np.zeros(0, np.int64)
    return np.array(sizes, np.int64), np.concatenate(bits) if bits else empty.astype(bool), np.concatenate(order) if order else empty


class PairNumbers:
    """Minimal perfect hash over the pairs of several shards."""

    def __init__(self, shards: dict[int, tuple[np.ndarray, np.ndarray]]):
        levels = max([len(s) for s, _ in shards.values()], default=0)
        self.size, self.start = np.zeros((SHARDS, levels), np.int64), np.zeros((SHARDS, levels), np.int64)
        place, bits = 0, []
        for shard, (sizes, raw) in sorted(shards.items()):
            self.size[shard, :len(sizes)] = sizes
            self.start[shard, :len(sizes)] = place + np.cumsum(sizes) - sizes
            bits.append(raw)
            place += int(sizes.sum())
        self.bits = np.concatenate(bits) if bits else np.zeros(0, bool)
        self.rank = np.cumsum(self.bits, dtype=np.int32)

    def of(self, keys: np.ndarray) -> np.ndarray:
        """Numbers of ``keys``; of keys not hashed: -1 or any number."""
        out, left, shard = np.full(len(keys), -1, np.int64), np.arange(len(keys)), shard_of(keys)
        for level in range(self.size.shape[1]):
            size = self.size[shard[left], level]
            left, size = left[size > 0], size[size > 0]
            if not len(left):
                break
            at = self.start[shard[left], level] + (_mix(keys[left], level) % size.astype(np.uint64)).astype(np.int64)
            hit = self.bits[at]
            out[left[hit]] = self.rank[at[hit]] - 1
            left = left[~hit]
        return out


class PairCounts:
    """Counts of pairs by number, verified by the pair that stands beside each."""

    def __init__(self, rows: list, best: np.ndarray):
        rows = sorted(rows, key=lambda r: r["shard"])
        self.numbers = PairNumbers({r["shard"]: (_longs(r["sizes"]), _bits(r["bits"], r["sizes"])) for r in rows})
        join = lambda c: np.concatenate([_longs(r[c]) for r in rows]) if rows else np.zeros(0, np.int64)
        self.keys, self.counts, self.best = join("keys"), join("counts"), best

    def of(self, pairs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Count of each pair and whether it is its B id's highest; 0 for pairs of other shards."""
        if not len(self.keys):
            return np.zeros(len(pairs), np.int64), np.zeros(len(pairs), bool)
        at = self.numbers.of(pairs)
        here = (at >= 0) & (self.keys[at] == pairs)
        count = np.where(here, self.counts[at], 0)
        return count, here & (count == self.best[pairs & 0xFFFFFFFF])


def _longs(raw: bytes) -> np.ndarray:
    return np.frombuffer(raw, np.int64)


def _bits(raw: bytes, sizes: bytes) -> np.ndarray:
    return np.unpackbits(np.frombuffer(raw, np.uint8), count=int(_longs(sizes).sum())).astype(bool)


def _fold(df: DataFrame, keys: list[str], schema: str, start: Callable, add: Callable, end: Callable) -> DataFrame:
    """One row for each value of ``keys`` (int columns): rows stream through
    ``state = add(start() or the state so far, row)`` and ``end(state)`` gives
    the further columns. Only one state is held at a time."""
    names = [c.strip().split(" ")[0] for c in schema.split(",")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, state = None, None

        def row():
            values = [*current, *end(state)]
            types = [pa.int32() if i < len(keys) else pa.binary() for i in range(len(values))]
            return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(values, types)], names=names)

        for batch in batches:
            for i in range(batch.num_rows):
                values = {n: batch.column(k)[i].as_py() for k, n in enumerate(batch.schema.names)}
                key = tuple(values[k] for k in keys)
                if key != current:
                    if current is not None:
                        yield row()
                    current, state = key, start()
                state = add(state, values)
        if current is not None:
            yield row()

    return df.repartition(*keys).sortWithinPartitions(*keys).mapInArrow(run, schema)


def _sums(docs: DataFrame, paths: tuple[str, str]) -> DataFrame:
    """Per task: shard, branch of the tree, pairs and how many links hold each."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = Table(aligner(*paths), False)
        seen = np.zeros(MAX_CHUNKS, np.int64)
        keys, sums = np.zeros(0, np.int64), np.zeros(0, np.int64)

        def settle() -> None:
            nonlocal keys, sums, seen
            if not table.pairs:
                return
            times = np.repeat(seen[:len(table.n)], table.n[:, 3])
            every = np.concatenate((keys, *table.pairs))
            keys, at = np.unique(every, return_inverse=True)
            sums = np.bincount(at, np.concatenate((sums, times)), len(keys)).astype(np.int64)
            keys, sums = keys[sums > 0], sums[sums > 0]
            table.clear()
            seen = np.zeros(MAX_CHUNKS, np.int64)

        for batch in batches:
            for s, m in portions(batch.column(0), 2_000_000):
                split = [chunk_keys(t) if t else [] for t in batch.column(0).slice(s, m).to_pylist()]
                new = list(set().union(*split).difference(table.number))
                if len(table.number) + len(new) > MAX_CHUNKS:
                    settle()
                    new = list(set().union(*split))
                table.learn(new)
                if len(table.number) > len(seen):
                    seen = np.concatenate((seen, np.zeros(len(table.number) - len(seen), np.int64)))
                of, fine = table.number.__getitem__, [np.zeros(0, np.int64)]
                for chunks in split:
                    at = np.fromiter(map(of, chunks), np.int64, len(chunks))
                    if not table.bad[at].any():
                        fine.append(at)
                seen += np.bincount(np.concatenate(fine), minlength=len(seen))
        settle()
        shard = shard_of(keys)
        order = np.argsort(shard, kind="stable")
        cuts = np.searchsorted(shard[order], np.arange(SHARDS + 1))
        branch = TaskContext.get().partitionId() % BRANCHES
        rows = [(i, branch, keys[o].tobytes(), sums[o].tobytes())
                for i in range(SHARDS) if len(o := order[cuts[i]:cuts[i + 1]])]
        for s in range(0, len(rows), 16):
            cols = list(zip(*rows[s:s + 16]))
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, (pa.int32(), pa.int32(), pa.binary(), pa.binary()))],
                                             names=["shard", "branch", "keys", "counts"])

    spark = docs.sparkSession
    # a task's pairs soon stop growing, so fewer and longer tasks keep the sums small beside the texts
    leaves = 8 * spark.sparkContext.defaultParallelism
    return (docs.select(F.col("text").cast("string").alias("text")).coalesce(leaves)
            .mapInArrow(count, "shard int, branch int, keys binary, counts binary"))


def pair_table(spark: SparkSession, docs: DataFrame, paths: tuple[str, str] | None = None) -> DataFrame:
    """One row per shard: its perfect hash (sizes, bits), its pairs in the
    order of their numbers (keys: A id << 32 | B id) and their counts."""
    sums = written(spark, _sums(docs, paths or default_tokenizers()), "pair-sums")
    none = lambda: np.zeros(0, np.int64)
    union = lambda state, row: np.union1d(state, _longs(row["keys"]))
    part = _fold(sums.select("shard", "branch", "keys"), ["shard", "branch"], "shard int, branch int, keys binary",
                 none, union, lambda s: [s.tobytes()])

    def hashed(state: np.ndarray) -> list[bytes]:
        sizes, bits, keys = perfect_hash(state)
        return [sizes.tobytes(), np.packbits(bits).tobytes(), keys.tobytes()]

    hashes = written(spark, _fold(part.select("shard", "keys"), ["shard"], "shard int, sizes binary, bits binary, keys binary",
                                  none, union, hashed), "pair-hash")
    levels = hashes.select(F.col("shard").alias("_s"), "sizes", "bits")

    def dense(state: dict, row: dict) -> dict:
        if "vector" not in state:
            state["numbers"] = PairNumbers({row["shard"]: (_longs(row["sizes"]), _bits(row["bits"], row["sizes"]))})
            state["vector"] = np.zeros(int(state["numbers"].bits.sum()), np.int64)
        state["vector"][state["numbers"].of(_longs(row["keys"]))] += _longs(row["counts"])
        return state

    parts = _fold(sums.join(levels, F.col("shard") == F.col("_s")).select("shard", "branch", "sizes", "bits", "keys", "counts"),
                  ["shard", "branch"], "shard int, branch int, counts binary", dict, dense, lambda s: [s["vector"].tobytes()])
    total = _fold(parts.select("shard", "counts"), ["shard"], "shard int, counts binary", list,
                  lambda s, row: _longs(row["counts"]) + (s if len(s) else 0), lambda s: [s.tobytes()])
    counts = total.select(F.col("shard").alias("_s"), "counts")
    return written(spark, hashes.join(counts, F.col("shard") == F.col("_s")).drop("_s"), "pair-counts")


def pair_counts(table: DataFrame) -> DataFrame:
    """a, b, n: how many links corpus-wide hold the pair."""
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for keys, counts in zip(*(batch.column(i).to_pylist() for i in (0, 1))):
                k = _longs(keys)
                yield pa.RecordBatch.from_arrays([pa.array((k >> 32).astype(np.int32)), pa.array((k & 0xFFFFFFFF).astype(np.int32)),
                                                  pa.array(_longs(counts))], names=["a", "b", "n"])

    return table.select("keys", "counts").mapInArrow(rows, "a int, b int, n long")


def _digest(docs: DataFrame, paths: tuple[str, str], shared) -> DataFrame:
    """th (hash of the text) and the columns of OUT, with the counts that
    ``shared`` holds."""
    names = ["th", *[c.strip().split(" ")[0] for c in OUT.split(",")]]

    def look_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, table = shared.value, Table(aligner(*paths), True)
        gain = np.zeros((0, 2), np.int64)
        for batch in batches:
            for s, m in portions(batch.column(2), 2_000_000):
                split = [chunk_keys(t) if t else [] for t in batch.column(2).slice(s, m).to_pylist()]
                new = list(set().union(*split).difference(table.number))
                if len(table.number) + len(new) > MAX_CHUNKS:
                    table.clear()
                    gain, new = gain[:0], list(set().union(*split))
                base = len(table.n)
                count, best = counts.of(table.learn(new))
                table.pairs.clear()
                ends = np.cumsum(table.n[base:, 3])
                run = np.concatenate((np.zeros((1, 2), np.int64), np.cumsum(np.stack((best, count), 1), axis=0)))
                gain = np.concatenate((gain, run[ends] - run[ends - table.n[base:, 3]]))
                every = np.concatenate((table.n, gain), axis=1)
                rows, digests, of, words = [], [], table.number.__getitem__, table.words
                for chunks in split:
                    at = np.fromiter(map(of, chunks), np.int64, len(chunks))
                    if len(at) and not table.bad[at].any():
                        rows.append(every[at].sum(axis=0))
                        digests.append(hashlib.sha256(b"".join(map(words.__getitem__, at.tolist()))[:-1]).hexdigest())
                    else:
                        rows.append(np.zeros(6, np.int64))
                        digests.append("")
                cols = np.array(rows, np.int64).T
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(s, m), batch.column(1).slice(s, m), *[pa.array(c) for c in cols], pa.array(digests)], names=names)

    return (docs.select(F.xxhash64("text").alias("th"), F.col("doc_id").cast("long"), F.col("text").cast("string"))
            .mapInArrow(look_up, "th long, " + OUT))


def align_documents(spark: SparkSession, docs: DataFrame, paths: tuple[str, str] | None = None, slice_pairs: int = SLICE) -> DataFrame:
    """The columns of OUT for every row of ``docs``."""
    paths = paths or default_tokenizers()
    table = pair_table(spark, docs, paths)
    # the highest count of each B id: a row per id of the vocabulary at most
    top = pair_counts(table).groupBy("b").agg(F.max("n").alias("n")).collect()
    best = np.zeros(max([r["b"] for r in top], default=0) + 1, np.int64)
    for r in top:
        best[r["b"]] = r["n"]
    slices: list[list[int]] = []
    room = 0
    for shard, n in sorted(table.select("shard", (F.length("keys") / 8).cast("long").alias("n")).collect()):
        if not slices or n > room:
            slices.append([])
            room = slice_pairs
        slices[-1].append(shard)
        room -= n
    found = []
    for shards in slices or [[]]:
        rows = table.where(F.col("shard").isin(shards)).collect() if shards else []
        found.append(_digest(docs, paths, spark.sparkContext.broadcast(PairCounts(rows, best))))
    columns = [c.strip().split(" ")[0] for c in OUT.split(",")]
    if len(found) == 1:
        return found[0].select(*columns)
    # one reading for each slice: equal rows of it have equal sums, and the copies of a row are counted in the first
    each = [written(spark, f, "slice").groupBy("doc_id", "th").agg(
        *[F.first(c).alias(c) for c in columns if c not in ("doc_id", "n_best", "count_sum")],
        F.first("n_best").alias("n_best"), F.first("count_sum").alias("count_sum"),
        (F.count("*") if i == 0 else F.lit(0)).alias("copies")) for i, f in enumerate(found)]
    total = each[0]
    for more in each[1:]:
        total = total.unionByName(more)
    total = total.groupBy("doc_id", "th").agg(
        *[F.first(c).alias(c) for c in columns if c not in ("doc_id", "n_best", "count_sum")],
        F.sum("n_best").alias("n_best"), F.sum("count_sum").alias("count_sum"), F.sum("copies").cast("int").alias("copies"))
    return total.withColumn("_i", F.explode(F.sequence(F.lit(1), F.col("copies")))).select(*columns)


def groups(docs: DataFrame, paths: tuple[str, str] | None = None) -> DataFrame:
    """doc_id and the groups of each text: byte range (of a space and the text)
    and the ids of both sides. Encodes whole texts."""
    paths = paths or default_tokenizers()
    schema = "doc_id long, groups array<struct<start:long,end:long,a:array<int>,b:array<int>>>"
    kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("a", pa.list_(pa.int32())), ("b", pa.list_(pa.int32()))]))

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = aligner(*paths)
        for batch in batches:
            for s, m in portions(batch.column(1), 1_000_000):
                out = []
                for text in batch.column(1).slice(s, m).to_pylist():
                    got = tokens.encode(" " + text) if text else None
                    if got is None:
                        out.append([])
                        continue
                    a_end, b_end = (np.cumsum(p[i + 1] - p[i]) for i, p in zip(got, (tokens.a_place, tokens.b_place)))
                    group = np.intersect1d(a_end, b_end, assume_unique=True)
                    at_a, at_b = (np.searchsorted(e, group, "right")[:-1] for e in (a_end, b_end))
                    out.append([{"start": x, "end": y, "a": a, "b": b} for x, y, a, b in zip(
                        [0, *group[:-1].tolist()], group.tolist(), np.split(got[0], at_a), np.split(got[1], at_b))])
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(s, m), pa.array(out, kind)], names=["doc_id", "groups"])

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(split, schema)


def op12_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return align_documents(spark, documents(spark, sf_dir))
