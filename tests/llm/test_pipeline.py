"""The pipeline, stage by stage, against brute force on what each was given."""

import zlib
from collections import Counter

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from quire.llm import pii
from quire.llm.common import documents, new_folder, written
from quire.llm.mixing import OP6_SQL
from quire.llm.quality import OP5_SQL
from quire.llm.tokens import default_tokenizer
from tests.conftest import SF_SMALL
from tests.llm.conftest import odd_rows, prose


def rows_of(df):
    return [tuple(r) for r in df.collect()]


def in_duckdb(df, sql):
    con = duckdb.connect()
    con.register("documents", df.toArrow())
    return con.execute(sql).fetchall()


def least_of_each_class(rows):
    """Rows without near copies: five words, similarity 0.8, over links."""
    def shingles(text):
        w = (text or "").encode().lower().split()
        return frozenset(tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))) if w else frozenset()

    sets = [shingles(r[1]) for r in rows]
    up = list(range(len(rows)))

    def top(i):
        while up[i] != i:
            i = up[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            a, b = sets[i], sets[j]
            if a and b and rows[i][0] is not None and rows[j][0] is not None and min(len(a), len(b)) >= 0.8 * max(len(a), len(b)):
                both = len(a & b)
                if 100 * both >= 80 * (len(a) + len(b) - both):
                    up[top(i)] = top(j)
    classes = {}
    for i, r in enumerate(rows):
        if sets[i] and r[0] is not None:
            classes.setdefault(top(i), []).append(r)
    single = [r for i, r in enumerate(rows) if not sets[i] or r[0] is None]
    return Counter(min(c, key=lambda r: r[0])[0] for c in classes.values()) + Counter(r[0] for r in single)


@pytest.fixture(scope="module", params=["odd", "table"])
def stages(request, spark):
    """What each stage was given and what it made."""
    if request.param == "table":
        docs = documents(spark, SF_SMALL)
    else:
        rows = [r[:5] for r in odd_rows() if not r[1] or len(r[1]) < 100_000] + [(100 + i, prose(100 + i, 90), "en", "s1", 1) for i in range(8)]
        path = new_folder(spark, "test-docs")
        spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{path}/documents.parquet")
        docs = documents(spark, path)
    made = [docs]
    for name, stage in corpus_pipeline.STAGES:
        made.append(written(spark, stage(spark, made[-1], ""), f"test-{name}"))
    return made


def test_stages_keep_the_columns(stages):
    assert all(s.columns == stages[0].columns for s in stages[:5])


def test_quality_and_near_copies(stages):
    docs, kept, unlike = stages[:3]
    kept_sql = Counter(r[0] for r in in_duckdb(docs, f"SELECT doc_id FROM ({OP5_SQL}) WHERE kept"))
    assert Counter(r[0] for r in kept.select("doc_id").collect()) == kept_sql
    got = Counter(r[0] for r in unlike.select("doc_id").collect())
    assert got == least_of_each_class(rows_of(kept.select("doc_id", "text")))


def test_pseudonyms_and_mix(stages):
    unlike, private, mixed = stages[2:5]
    assert Counter(rows_of(private)) == Counter(rows_of(pii.pseudonymise(unlike)))
    assert private.count() == unlike.count()
    # the mix takes each document as often as the query's SQL says
    sizes = Counter()
    for doc, size, _, _, taken in in_duckdb(private, f"SELECT doc_id, size, source_size, target, taken FROM ({OP6_SQL})"):
        sizes[doc] += taken // size if size else 0
    assert Counter(r[0] for r in mixed.select("doc_id").collect()) == +sizes
    assert set(rows_of(mixed)) <= set(rows_of(private))


def test_packing(stages):
    mixed, packed = stages[4:]
    tokenizer = Tokenizer.from_file(default_tokenizer())
    want = Counter()
    for doc, text in rows_of(mixed.select("doc_id", "text")):
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids + [1]
        for k, s in enumerate(range(0, len(ids), 4096)):
            part = np.array(ids[s:s + 4096], dtype="<u4")
            want[doc, k, s, len(part), zlib.crc32(part.tobytes())] += 1
    rows = packed.collect()
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows) == want
    ends = {}
    for r in sorted(rows, key=lambda r: (r.sequence_id, r.offset)):
        assert r.offset == ends.get(r.sequence_id, 0)
        ends[r.sequence_id] = r.offset + r.length
    assert max(ends.values(), default=0) <= 4096


def test_run_is_its_stages(spark, stages):
    if stages[0].count() == documents(spark, SF_SMALL).count():
        got = corpus_pipeline.run(spark, SF_SMALL).select("doc_id", "piece", "length", "ids_crc32")
        assert Counter(rows_of(got)) == Counter(rows_of(stages[5].select("doc_id", "piece", "length", "ids_crc32")))


def test_rows_of_any_type_are_mixed(spark):
    docs = spark.createDataFrame([(i % 3, prose(i, 20), "en", "s", {"k": "v" * i}) for i in range(9)],
                                 "doc_id long, text string, lang string, source string, props map<string,string>")
    assert corpus_pipeline.mixing(spark, docs.union(docs), "").columns == docs.columns
    assert corpus_pipeline.mixing(spark, docs.union(docs), "").where(F.col("props").isNull()).count() == 0
