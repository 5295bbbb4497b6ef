"""Cross-tokenizer alignment against whole texts aligned token by token."""

import hashlib
from collections import Counter

import numpy as np
import pytest
import sentencepiece
from tokenizers import Tokenizer

from quire.llm import alignment as al
from quire.llm.common import documents
from quire.llm.tokens import byte_letters
from tests.conftest import SF_SMALL
from tests.llm.conftest import odd_rows

TRICKY = ["two  spaces", " lead", "trail ", "line\nline\n\nnext \n x", "tab\tand\r\nreturn", "<|endoftext|> <s> </s> <unk>", "▁x y",
          "a　b \xa0 c", "é \x00 zero", "9 12345 it's we'll", "\n", " ", "字 漢字 かな", "x" * 200 + " y", "é ﬁ ① 🙂🙂 z",
          "a\x85 b ​ c", "the the the"]


@pytest.fixture(scope="module")
def plain():
    """(n_a, n_b, groups, links) of a whole text, one token after the other."""
    path_a, path_b = al.default_tokenizers()
    a, b = Tokenizer.from_file(path_a), sentencepiece.SentencePieceProcessor(model_file=path_b)
    a.encode_special_tokens = True
    letters = byte_letters()

    def run(text):
        if not text:
            return 0, 0, [], []
        raw = (" " + text).encode()
        ea = a.encode(" " + text, add_special_tokens=False)
        ia, eb = ea.ids, b.encode(text)
        ta = [bytes(letters[c] for c in t) for t in ea.tokens]
        tb = [bytes([int(p[3:5], 16)]) if b.is_byte(i) else p.replace("▁", " ").encode()
              for i, p in ((i, b.id_to_piece(i)) for i in eb)]
        if b"".join(ta) != raw or b"".join(tb) != raw:
            return 0, 0, [], []
        xs, ys = np.cumsum([len(t) for t in ta]).tolist(), np.cumsum([len(t) for t in tb]).tolist()
        links, groups, i, j = [], [([], [])], 0, 0
        groups[-1][0].append(ia[0]), groups[-1][1].append(eb[0])
        while True:
            links.append((ia[i], eb[j]))
            x, y = xs[i], ys[j]
            i, j = i + (x <= y), j + (y <= x)
            if i == len(xs):
                break
            if x == y:
                groups.append(([], []))
            if x <= y:
                groups[-1][0].append(ia[i])
            if y <= x:
                groups[-1][1].append(eb[j])
        return len(xs), len(ys), groups, links

    return run


def expected(plain, rows):
    found = [(d, *plain(t)) for d, t in rows]
    count = Counter(pair for f in found for pair in f[4])
    best = {}
    for (_, b), n in count.items():
        best[b] = max(best.get(b, 0), n)
    digest = lambda gs: hashlib.sha256(";".join(
        ",".join(map(str, a)) + "|" + ",".join(map(str, b)) for a, b in gs).encode()).hexdigest() if gs else ""
    return count, Counter((d, na, nb, len(gs), len(ls), sum(count[p] == best[p[1]] for p in ls), sum(count[p] for p in ls), digest(gs))
                          for d, na, nb, gs, ls in found)


def test_alignment(spark, odd, none, plain):
    count, want = expected(plain, [r[:2] for r in odd_rows()])
    assert Counter(tuple(r) for r in al.align_documents(spark, odd).collect()) == want
    assert {(r["a"], r["b"]): r["n"] for r in al.pair_counts(al.pair_table(spark, odd)).collect()} == count
    # one reading for each slice of the counts gives the same
    assert Counter(tuple(r) for r in al.align_documents(spark, odd, slice_pairs=1500).collect()) == want
    assert al.align_documents(spark, none).count() == 0


def test_alignment_of_tricky_texts(spark, plain):
    rows = [(i, t) for i, t in enumerate(TRICKY + [" ".join(TRICKY), "\n".join(TRICKY), "".join(TRICKY)])]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(2)
    assert Counter(tuple(r) for r in al.align_documents(spark, df).collect()) == expected(plain, rows)[1]
    for r in al.groups(df).collect():
        gs = plain(rows[r["doc_id"]][1])[2]
        assert [(g["a"], g["b"]) for g in r["groups"]] == gs
        assert all(x["end"] == y["start"] for x, y in zip(r["groups"], r["groups"][1:]))


def test_alignment_of_a_table(spark, plain):
    docs = documents(spark, SF_SMALL)
    want = expected(plain, [tuple(r) for r in docs.select("doc_id", "text").collect()])[1]
    assert Counter(tuple(r) for r in al.align_documents(spark, docs).collect()) == want


def test_small_tables_of_chunks(spark, plain, monkeypatch):
    """A worker's table that starts anew again and again changes nothing."""
    tokens = al.Aligner(*al.default_tokenizers())
    texts = [r[1] for r in odd_rows() if r[1]]
    for text in texts:
        table = al.Table(tokens, True)
        keys = al.chunk_keys(text)
        table.learn(list(dict.fromkeys(keys)))
        na, nb, gs, ls = plain(text)
        at = [table.number[k] for k in keys]
        assert tuple(table.n[at].sum(axis=0)) == (na, nb, len(gs), len(ls))


def test_perfect_hash():
    keys = np.unique(np.random.default_rng(1).integers(0, 1 << 47, 30_000))
    sizes, bits, order = al.perfect_hash(keys)
    assert sorted(order.tolist()) == keys.tolist() and bits.sum() == len(keys)
    shard = al.shard_of(keys)
    assert shard.min() >= 0 and shard.max() < al.SHARDS
    parts = {s: al.perfect_hash(keys[shard == s]) for s in range(al.SHARDS) if (shard == s).any()}
    numbers = al.PairNumbers({s: p[:2] for s, p in parts.items()})
    order = np.concatenate([parts[s][2] for s in sorted(parts)])
    assert np.array_equal(order[numbers.of(keys)], keys)
