"""Token ids of whole texts with a public tokenizer, encoded word by word.

The tokenizer splits on white space before anything else, so the ids of a
text are the ids of its words in a row. Words repeat, so texts are split and
their words numbered as Arrow columns, each distinct word is encoded once and
its ids are taken for every place it has. Words of plain Latin letters are one
piece each, lower-cased: they are merged by an encoder of ranks with the same
vocabulary, in which a control character stands for the end of a word. Marks
behind them are a piece of their own. Other words go to the tokenizer together,
kept apart by a separator word whose single id no other word can produce; each
worker keeps a bounded table of these.
"""

from __future__ import annotations

import json
import os
from functools import lru_cache
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Entries kept per worker (about 125 MB); beyond it the table starts anew.
MAX_WORDS = 300_000
#: Longer words are encoded each time instead of being kept.
MAX_WORD = 64
#: A control character that is neither white space nor letter nor number to
#: the tokenizer: alone between spaces it gives one id of its own.
SEPARATOR = "\x1f"
#: Stands for the end of a word in the encoder of ranks.
END = "\x1e"
#: Letters that are normal as they stand and lower-case to one letter: up to
#: U+017F, without the dotted capital I and the n after an apostrophe. ASCII
#: marks may follow, but for the apostrophe and those of the special tokens.
LATIN = ("^(?P<core>[A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u012f\u0131-\u0148\u014a-\u017f]+)"
         r"(?P<tail>[!\"#$%&()*+,\-./:;=?@\[\\\]^_`{}~]*)$")
#: Words that are encoded in one call.
AT_ONCE = 2_000
#: Bytes of text to give at a time: a word is encoded once in each.
HELD = 4_000_000


def byte_letters() -> dict[str, int]:
    """The letter that stands for each byte in a byte-level vocabulary: itself
    where it is visible in Latin-1, else the next one from U+0100 on."""
    visible = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in visible]
    return {chr(b): b for b in visible} | {chr(256 + i): b for i, b in enumerate(hidden)}


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


class WordEncoder:
    """``encode(texts)`` gives each text's ids as little-endian uint32 bytes."""

    def __init__(self, path: str, max_words: int = MAX_WORDS):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.max_words = max_words
        sep = self._plain(SEPARATOR)
        if len(sep) != 4:
            raise ValueError("the tokenizer gives the separator no single id")
        self.sep = int(np.frombuffer(sep, "<u4")[0])
        vocab = self.tokenizer.get_vocab()
        self.ends = np.zeros(max(vocab.values()) + 1, dtype=bool)
        self.ends[[i for w, i in vocab.items() if w.endswith("</w>")]] = True
        self.words: dict[str, bytes] = {"": b""}
        self.ranked = self._ranked(path, vocab)

    @staticmethod
    def _ranked(path: str, vocab: dict[str, int]):
        """The vocabulary as an encoder of ranks over words that each end in
        END; None if ids do not rise with the order of the merges, single
        letters first, or the normaliser is not the one known here."""
        import tiktoken

        spec = json.loads(Path(path).read_text())
        kinds = [n["type"] for n in (spec["normalizer"] or {}).get("normalizers", [])]
        merged = ["".join(m.split(" ") if isinstance(m, str) else m) for m in spec["model"]["merges"]]
        ids = [vocab[m] for m in merged]
        if (kinds != ["NFC", "Replace", "Lowercase"] or spec["model"].get("end_of_word_suffix") != "</w>"
                or ids != list(range(512, 512 + len(ids)))):
            return None
        letters = byte_letters()
        raw = {t: bytes(letters[c] for c in t.removesuffix("</w>")) + END.encode() * t.endswith("</w>")
               for t, i in vocab.items() if i < 512 + len(ids)}
        ranks = {raw[t]: i for t, i in vocab.items() if t in raw}
        if len(ranks) != 512 + len(ids):
            return None
        return tiktoken.Encoding("words", pat_str=f"[^{END}]+{END}", mergeable_ranks=ranks, special_tokens={})

    def _plain(self, text: str) -> bytes:
        enc = self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0]
        return np.array(enc.ids, dtype="<u4").tobytes()

    def _letters(self, words: list[str]) -> pa.ListArray:
        """Ids of words of lower-case Latin letters: each ends with its one
        end-of-word id, so no separator is needed."""
        got = [np.zeros(0, dtype="<u4")]
        for i in range(0, len(words), AT_ONCE):
            part = words[i:i + AT_ONCE]
            if self.ranked is None:
                got.append(np.frombuffer(self._plain(" ".join(part)), "<u4"))
            else:
                got.append(np.array(self.ranked.encode_ordinary(END.join(part) + END), dtype="<u4"))
        ids = np.concatenate(got)
        at = np.flatnonzero(self.ends[ids]) + 1
        if len(at) != len(words):  # cannot happen for plain letters
            return as_lists([self._plain(w) for w in words])
        return pa.ListArray.from_arrays(pa.array(np.concatenate(([0], at)), pa.int32()), pa.array(ids.view("<i4")))

    def _many(self, words: list[str]) -> list[bytes]:
        joined = f" {SEPARATOR} ".join(words)
        ids = np.frombuffer(self._plain(joined), "<u4")
        at = np.flatnonzero(ids == self.sep)
        if len(at) != len(words) - 1:  # cannot happen for words without the separator
            return [self._plain(w) for w in words]
        raw, out, s = ids.tobytes(), [], 0
        for e in (at * 4).tolist():
            out.append(raw[s:e])
            s = e + 4
        out.append(raw[s:])
        return out

    def _learn(self, new: set[str]) -> dict[str, bytes]:
        """Ids of unseen words. A full stop or comma after a letter is a token
        of its own, so those variants share one encoding; not after a letter
        whose lower case ends with a mark."""
        plan, rest = [], {".", ","}
        for w in new:
            if SEPARATOR in w:
                plan.append((w, None, ""))
            elif w[-1] in ".," and w[-2:-1].lower().isalpha():
                plan.append((w, w[:-1], w[-1]))
                rest.add(w[:-1])
            else:
                plan.append((w, w, ""))
                rest.add(w)
        got: dict[str, bytes] = {}
        order = list(rest.difference(self.words))
        for i in range(0, len(order), AT_ONCE):
            part = order[i:i + AT_ONCE]
            got.update(zip(part, self._many(part)))
        known = self.words
        end = {t: got[t] if t in got else known[t] for t in ".,"} | {"": b""}
        for w, core, tail in plan:
            got[w] = self._plain(w) if core is None else (got[core] if core in got else known[core]) + end[tail]
        return got

    def _kept(self, words: list[str]) -> list[bytes]:
        """Ids of words from the table, into which unseen ones go."""
        new = {w for w in words if w not in self.words}
        found = self._learn(new) if new else {}
        out = [found[w] if w in found else self.words[w] for w in words]
        keep = {w: ids for w, ids in found.items() if len(w) <= MAX_WORD}
        if len(self.words) + len(keep) > self.max_words:
            self.words = {"": b""}
        if len(keep) <= self.max_words:
            self.words.update(keep)
        return out

    def _distinct(self, words: pa.Array) -> pa.ListArray:
        """Ids of distinct words: those of two parts each, the second empty but
        for the marks behind Latin letters."""
        form = pc.extract_regex(words, LATIN)
        plain = form.is_valid()
        core, tail = form.filter(plain).flatten()
        core, tail = pc.utf8_lower(core).dictionary_encode(), tail.dictionary_encode()
        other = words.filter(pc.invert(plain)).to_pylist()
        rest = as_lists(self._kept(["", *tail.dictionary.to_pylist(), *other]))
        none = len(core.dictionary)
        latin = np.asarray(plain)
        parts = np.full((len(words), 2), none, dtype=np.int64)
        parts[latin, 0] = core.indices
        parts[latin, 1] = none + 1 + np.asarray(tail.indices)
        parts[~latin, 0] = none + 1 + len(tail.dictionary) + np.arange(len(other))
        pool = pa.concat_arrays([self._letters(core.dictionary.to_pylist()), rest])
        both = pool.take(pa.array(parts.ravel()))
        return pa.ListArray.from_arrays(both.offsets[::2], both.values)

    def forget(self) -> None:
        """At a task's end: the worker lives on, its table and free buffers need not."""
        self.words = {"": b""}
        pa.default_memory_pool().release_unused()

    def ids(self, texts: pa.Array) -> pa.ListArray:
        """Each text's ids, a list of 32-bit integers; a null text has none."""
        words = pc.ascii_split_whitespace(texts.fill_null(""))
        numbered = words.flatten().dictionary_encode()
        got = self._distinct(numbered.dictionary).take(numbered.indices)
        return pa.ListArray.from_arrays(got.offsets.take(words.offsets), got.values)

    def encode(self, texts: list[str | None] | pa.Array) -> list[bytes]:
        lists = self.ids(texts if isinstance(texts, pa.Array) else pa.array(texts, pa.string()))
        raw, at = np.asarray(lists.values).astype("<i4").tobytes(), (4 * np.asarray(lists.offsets, dtype=np.int64)).tolist()
        return [raw[s:e] for s, e in zip(at, at[1:])]


def as_lists(raw: list[bytes]) -> pa.ListArray:
    """Lists of 32-bit integers from their little-endian bytes."""
    ends = np.cumsum([0, *map(len, raw)]) // 4
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.frombuffer(b"".join(raw), "<i4")))


@lru_cache(maxsize=2)
def encoder(path: str) -> WordEncoder:
    """One encoder per worker process and vocabulary."""
    return WordEncoder(path)
