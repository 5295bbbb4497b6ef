"""Ranked search by dual trees against scoring every pair."""

import math
import re
from collections import Counter

import numpy as np
import pytest

from quire.llm import lexical
from quire.llm.common import documents
from tests.conftest import SF_SMALL
from tests.llm.conftest import DOCS, odd_rows, prose

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = {c: c + 32 for c in range(65, 91)}


def ranked(docs, items, k=20):
    split = lambda t: TERM.findall((t or "").translate(LOWER))
    bags = [(d, Counter(split(t))) for d, t in docs if split(t)]
    n_docs, all_terms = len(bags), sum(sum(b.values()) for _, b in bags)
    df = Counter(t for _, b in bags for t in b)
    out = Counter()
    for item_id, text in items:
        scores = []
        for doc, bag in bags:
            m = 100 - 25 + (25 * sum(bag.values()) * n_docs) // all_terms
            score = sum(q * math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((10**9 * bag[t]) // (1000 * bag[t] + 12 * m))
                        for t, q in Counter(split(text)).items() if t in bag)
            if score > 0:
                scores.append((-score, doc is None, doc or 0))
        out.update((item_id, i + 1, None if absent else doc, -s) for i, (s, absent, doc) in enumerate(sorted(scores)[:k]))
    return out


def test_terms():
    for text in [r[1] for r in odd_rows()] + ["Déjà-vu_x9 É", "\x7f{a}[b]`c@d", "İ ſ"]:
        assert [t.decode() for t in lexical.terms(text and text.encode())] == TERM.findall((text or "").translate(LOWER))


@pytest.mark.parametrize("block", [128 << 10, 300])
def test_odd_rows(spark, odd, none, block):
    texts = [r[1] for r in odd_rows()]
    items = [(1, " ".join(texts[0].split()[:30])), (2, None), (3, ""), (4, "absentword"), (5, "WORD word x"), (5, "WORD word x"),
             (None, texts[7][:80]), (6, texts[12]), (7, " ".join(t for t in texts if t and len(t) < 2000))]
    df = spark.createDataFrame([(*i, "clash") for i in items], "item_id long, text string, rank string")
    got = Counter(tuple(r) for r in lexical.rank_documents(spark, odd, df, block_bytes=block, seeds=3).collect())
    assert got == ranked([r[:2] for r in odd_rows()], items)
    assert lexical.rank_documents(spark, none, df).count() == 0
    assert lexical.rank_documents(spark, odd, df.limit(0)).count() == 0


def test_many_copies(spark, monkeypatch):
    """Ties over many equal documents, and every bound on small trees."""
    rng = np.random.default_rng(2)
    words = prose(11, 60).split()
    docs = [(i, " ".join(rng.choice(words, rng.integers(1, 40)))) for i in range(300)] + [(1000 - i, " ".join(words[:9])) for i in range(200)]
    items = [(i, " ".join(rng.choice(words, 12))) for i in range(40)] + [(90, " ".join(words[:9]))]
    df = spark.createDataFrame([(d, t, None, None, None, None, None, None) for d, t in docs], DOCS).repartition(4)
    got = lexical.rank_documents(spark, df, spark.createDataFrame(items, "item_id long, text string"), k=7)
    assert Counter(tuple(r) for r in got.collect()) == ranked(docs, items, 7)


def test_search_skips_batches():
    """Documents of other terms are never scored, with whole results."""
    table = np.zeros((4096, 64), np.int32)
    for i in range(4096):
        table[i, (i // 64):(i // 64) + 1] = 1000 + i
    tree = lexical.ItemTree([(i, i, {i: 5, (i + 1) % 64: 1}) for i in range(64)])
    run = lexical.Search(tree, 3, np.zeros(64))
    scored = []
    score = run._score
    run._score = lambda node, leaves: (scored.append(len(leaves)), score(node, leaves))
    run.add(table, np.zeros(4096, np.int64), np.arange(4096))
    whole = table.astype(np.int64)
    for item, _, doc, value in run.found():
        q = next(q for i, _, q in tree.items if i == item)
        exact = sum(whole[:, t] * v for t, v in q.items())
        assert exact[doc] == value and (exact > value).sum() < 3
    assert sum(scored) * lexical.DOC_LEAF < 4096 * 64 / 8


def test_a_table(spark):
    docs, items = documents(spark, SF_SMALL), spark.read.parquet(f"{SF_SMALL}/benchmark.parquet")
    got = Counter(tuple(r) for r in lexical.rank_documents(spark, docs, items).collect())
    pairs = lambda df, c: [tuple(r) for r in df.select(c, "text").collect()]
    assert got == ranked(pairs(docs, "doc_id"), pairs(items, "item_id"))
