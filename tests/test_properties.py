"""Property test: fixed-size chunking equals a direct reading of its rule
(brute force in Python) on random texts and parameters."""

from hypothesis import given, settings
from hypothesis import strategies as st

from quire.operators import chunk as C

WORD = st.text(alphabet="abcxyz", min_size=1, max_size=4)
TEXT = st.lists(WORD, min_size=0, max_size=60).map(" ".join)


def brute(tokens, mx, pct):
    ov = mx * pct // 100
    stride = mx - ov
    out, s = [], 0
    while s == 0 or s + ov < len(tokens):
        out.append((s, " ".join(tokens[s:s + mx])))
        s += stride
        if s >= max(len(tokens), 1):
            break
    return out


@settings(max_examples=4, deadline=None)
@given(texts=st.lists(TEXT, min_size=1, max_size=25), mx=st.integers(1, 12), pct=st.integers(0, 99))
def test_chunking_matches_rule(spark, texts, mx, pct):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    got = {}
    for r in C.chunk_fixed(df, mx, pct).collect():
        got.setdefault(r.doc_id, []).append((r.chunk_no, r.start_token, r.text))
    for i, t in enumerate(texts):
        want = brute(t.split(), mx, pct)
        rows = sorted(got.get(i, []))
        assert [(s, x) for _, s, x in rows] == want
        assert [n for n, _, _ in rows] == list(range(len(want)))
