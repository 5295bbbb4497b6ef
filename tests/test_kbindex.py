"""Stored index: search, filters, syncs and compaction against fresh builds."""

import math
import threading
from uuid import uuid4

import pytest
from pyspark.sql import functions as F

from quire.operators import kbindex as KB
from quire.operators import retrieve as RT
from quire.operators.answer import answer_questions
from quire.operators.chunk import chunk_fixed
from quire.operators.sync import sync_plan
from quire.plans import fixtures as FX
from quire.session import scratch_path
from quire.sources import sinks as SK
from tests.conftest import SF_SMALL

WORDS = "ash birch cedar fir gum hazel iroko juniper larch maple oak pine rowan spruce teak willow yew elm".split()


def docs(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string, kind string")


def text(i, n=30):
    return " ".join(WORDS[(i * 7 + j * (i % 5 + 1)) % len(WORDS)] for j in range(n)) + f" only{i}"


@pytest.fixture()
def path(spark):
    return scratch_path(spark, f"kb-{uuid4().hex}")


@pytest.fixture(scope="module")
def questions(spark):
    return spark.createDataFrame([(1, "ash cedar only3"), (2, "willow yew elm oak"), (3, "only5 only40 pine"), (4, "absent"), (5, "only11")],
                                 "qid long, question string")


def same(a, b, cols=("qid", "rank", "doc_id", "chunk_no", "score")):
    pick = lambda d: sorted(tuple(r) for r in d.select(*cols[:-1], F.round(cols[-1], 9).alias("s")).collect())
    assert pick(a) == pick(b)


def test_searches_equal_those_of_an_index_in_memory(spark, path, questions):
    chunks = chunk_fixed(docs(spark, [(i, text(i, 20 + i), "a" if i % 3 else "b") for i in range(60)]), 16, 25)
    stored, memory = KB.write_index(chunks, path, ("kind",)), RT.build_index(chunks)
    assert (stored.n_chunks, stored.avgdl) == (memory.n_chunks, pytest.approx(memory.avgdl))
    for k in (1, 5, 500):
        same(RT.bm25_topk(stored, questions, k), RT.bm25_topk(memory, questions, k))
        same(KB.bm25_topk_blocks(stored, questions, k), RT.bm25_topk(memory, questions, k))
    same(RT.semantic_topk(stored, questions, 5), RT.semantic_topk(memory, questions, 5))
    same(RT.hybrid_topk(stored, questions, 5, prune=True), RT.hybrid_topk(memory, questions, 5))
    flt = {"equals": {"key": "kind", "value": "b"}}
    same(RT.bm25_topk(stored.where(flt), questions, 5), RT.bm25_topk(memory.where(flt), questions, 5))
    same(KB.bm25_topk_blocks(stored.where(flt), questions, 5), RT.bm25_topk(memory.where(flt), questions, 5))
    same(RT.hybrid_topk(stored.where(flt), questions, 5), RT.hybrid_topk(memory.where(flt), questions, 5))
    got = answer_questions(None, questions, k=5, idx=stored.where(flt)).select("qid", F.size("contexts").alias("n")).collect()
    assert {r.qid: r.n for r in got}[4] == 0 and {r.qid: r.n for r in got}[2] == 5


def test_the_scan_is_pruned(spark, path, questions):
    stored = KB.write_index(chunk_fixed(docs(spark, [(i, text(i), "a") for i in range(40)]), 16, 25), path, ("kind",))
    one = stored.where({"equals": {"key": "kind", "value": "a"}}).for_terms(spark.createDataFrame([("only3",)], "term string"))
    plan = one.postings._jdf.queryExecution().executedPlan().toString()
    scan = next(line for line in plan.splitlines() if "FileScan" in line)
    assert "EqualTo(kind,a)" in scan and "PushedFilters" in scan
    assert "bucket" in scan.split("PartitionFilters: [")[1].split("]")[0] and "term" in scan.split("DataFilters: [")[1]


def test_a_sync_equals_a_fresh_build(spark, path, questions):
    old = [(i, text(i), "a") for i in range(50)]
    new = [(i, text(i + 1000) if i % 6 == 1 else text(i), "a") for i in range(56) if i % 7 != 3]
    later = [r for r in new if r[0] % 10 != 4] + [(11, "only11 returns", "b")]
    later = list({r[0]: r for r in later}.values())
    kw = dict(max_tokens=16, overlap_pct=25)
    idx = KB.write_index(chunk_fixed(docs(spark, old), **kw), path, ("kind",))
    for before, after in ((old, new), (new, later)):
        b, a = docs(spark, before), docs(spark, after)
        idx = idx.sync(sync_plan(b, a), a, **kw)
        fresh = KB.write_index(chunk_fixed(a, **kw), scratch_path(spark, f"kb-{uuid4().hex}"), ("kind",))
        assert idx.n_chunks == fresh.n_chunks and idx.avgdl == pytest.approx(fresh.avgdl)
        stats = lambda x: sorted(tuple(r) for r in x.term_stats().select("term", "df").collect())
        assert stats(idx) == stats(fresh)
        flt = {"equals": {"key": "kind", "value": "a"}}
        for view, other in ((idx, fresh), (KB.open_index(spark, path), fresh), (idx.where(flt), fresh.where(flt))):
            same(RT.bm25_topk(view, questions, 4), RT.bm25_topk(other, questions, 4))
            same(KB.bm25_topk_blocks(view, questions, 4), RT.bm25_topk(other, questions, 4))
        same(RT.hybrid_topk(idx, questions, 4), RT.hybrid_topk(fresh, questions, 4))
    whole = idx.compact()
    assert len(whole.segments) == 1 and whole.n_chunks == idx.n_chunks
    same(RT.hybrid_topk(whole, questions, 4), RT.hybrid_topk(idx, questions, 4))


def test_a_sync_writes_what_changed_only(spark, path):
    old = docs(spark, [(i, text(i), "a") for i in range(200)])
    idx = KB.write_index(chunk_fixed(old, 16, 25), path, ("kind",))
    new = docs(spark, [(i, text(i) + (" more" if i == 9 else ""), "a") for i in range(200) if i != 10])
    after = idx.sync(sync_plan(old, new), new, max_tokens=16, overlap_pct=25)
    segment = after.segments[-1]
    written = KB._table(spark, path, segment, "postings")
    assert {r[0] for r in written.select("doc_id").distinct().collect()} == {9}
    assert {r[0] for r in KB._table(spark, path, segment, "dead").collect()} == {9, 10}
    with pytest.raises(RuntimeError):
        idx.sync(sync_plan(old, new), new, max_tokens=16, overlap_pct=25)  # built on an older version


def test_empty_index_and_total_deletion(spark, path, questions):
    some = docs(spark, [(i, text(i), "a") for i in range(5)])
    idx = KB.write_index(chunk_fixed(some.limit(0)), path)
    assert RT.bm25_topk(idx, questions, 3).count() == 0
    idx = idx.sync(sync_plan(some.limit(0), some), some)
    assert RT.bm25_topk(idx, questions, 3).count() > 0
    idx = idx.sync(sync_plan(some, some.limit(0)), some.limit(0))
    assert idx.n_chunks == 0 and RT.bm25_topk(idx, questions, 3).count() == 0
    assert KB.bm25_topk_blocks(idx, questions, 3).count() == 0


def test_two_writers_get_two_serials(spark, path):
    got, row = [], spark.createDataFrame([(1,)], "x int")
    threads = [threading.Thread(target=lambda: got.append(SK.append_experiment(row, path))) for _ in range(4)]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    assert sorted(got) == [1, 2, 3, 4]
    assert sorted(r.serial for r in spark.read.parquet(path).collect()) == [1, 2, 3, 4]


def test_table_of_the_app(spark):
    q = FX.golden(spark, SF_SMALL)
    from quire.plans import q_retrieve as Q
    rows = Q.answer_questions_filtered(spark, SF_SMALL).collect()
    assert len(rows) == q.count() and all(len(r.contexts) <= 5 for r in rows)


@pytest.mark.parametrize("search", [RT.bm25_topk, RT.semantic_topk])
@pytest.mark.parametrize("prune", [False, True])
def test_a_search_shuffles_postings_not_pairs(spark, path, search, prune, monkeypatch):
    """Copies tie, parts hold few chunks; the first of the copies' ids win."""
    monkeypatch.setattr(RT, "PART_CHUNKS", 16)
    rows = [(i, text(3, 12) if i % 3 else text(i, 12), "a") for i in range(150)]
    chunks = chunk_fixed(docs(spark, rows), 16, 25)
    idx = KB.write_index(chunks, path, ("kind",))
    asked = spark.createDataFrame([(1, "ash cedar only3"), (2, "willow yew elm oak oak"), (3, "absent"), (4, "only9 pine")], "qid long, question string")
    found = search(idx, asked, 4, prune=prune)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "MapInArrow" in plan and "hashpartitioning(qid#" in plan and "keys=[qid" not in plan.split("MapInArrow")[0]
    scores = (RT.bm25_scores if search is RT.bm25_topk else RT.semantic_scores)(idx, asked)
    scores = scores.select("qid", "doc_id", "chunk_no", "score", RT.chunk_key_id().alias("chunk_id")).where("score > 0").collect()
    want = []
    for q in (1, 2, 4):
        best = sorted((r for r in scores if r.qid == q), key=lambda r: (-round(r.score, 9), r.chunk_id))[:4]
        want += [(q, i + 1, r.doc_id, r.chunk_no, round(r.score, 9)) for i, r in enumerate(best)]
    got = sorted((r.qid, r["rank"], r.doc_id, r.chunk_no, round(r.score, 9)) for r in found.collect())
    assert got == want


def test_words_are_counted_before_the_shuffle(spark, path):
    chunks = docs(spark, [(1, "Ash ash, birch", "a"), (2, "", "a"), (3, None, "b"), (4, "ash 42 ümlaut ümlaut", "b"), (4, "ash 42 ümlaut ümlaut", "b")])
    chunks = chunks.withColumn("chunk_no", F.lit(0))
    posted = KB._postings(chunks.withColumn("dl", F.size(RT.tx.word_tokens("text"))), ("kind",), 3, 5)
    plan = posted._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Generate") < plan.index("RepartitionByExpression")  # a posting is made after its row moved
    got = sorted((r.doc_id, r.kind, r.dl, r.term, r.tf) for r in posted.collect())
    assert got == [(1, "a", 3, "ash", 2), (1, "a", 3, "birch", 1), (4, "b", 4, "42", 2), (4, "b", 4, "ash", 2), (4, "b", 4, "ümlaut", 4)]
    idx = KB.write_index(chunks, path, ("kind",))
    assert sorted((r.doc_id, r.term, r.tf) for r in idx.postings.collect()) == [(a, d, e) for a, _, _, d, e in got]


def test_ranked_lists_go_to_the_texts(spark, path, questions):
    idx = KB.write_index(chunk_fixed(docs(spark, [(i, text(i), "a") for i in range(40)]), 16, 25), path, ("kind",))
    was = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # what a large table of chunks meets
    try:
        found = RT.with_text(RT.bm25_topk(idx, questions, 3), idx)
        plan = found._jdf.queryExecution().executedPlan().toString().split("InMemoryTableScan")[0]
        assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
        texts = {(r.doc_id, r.chunk_no): r.text for r in idx.chunks.collect()}
        got = found.collect()
        assert len(got) == RT.bm25_topk(idx, questions, 3).count() and all(r.text == texts[r.doc_id, r.chunk_no] for r in got)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", was)


def test_texts_are_not_shuffled_by_a_build(spark):
    """An id of several documents has a row of metadata for each, null has none."""
    from quire.plans import q_retrieve as Q
    folder = scratch_path(spark, f"docs-{uuid4().hex}")
    rows = [(1, text(1)), (2, text(2)), (2, text(9)), (3, None), (4, ""), (None, text(5)), (367, text(6))]
    (spark.createDataFrame(rows, "doc_id long, text string").withColumn("source", F.lit("s")).withColumn("lang", F.lit("en"))
     .write.parquet(f"{folder}/documents.parquet"))
    chunks, meta = FX.kb_chunks(spark, folder).select("doc_id", "chunk_no", "text"), FX.kb_meta(spark, folder).select("doc_id", *Q.META)
    got = FX.kb_chunks_meta(spark, folder)
    key = lambda d: sorted(map(repr, d.select("doc_id", "chunk_no", "text", *Q.META).collect()))
    assert key(got) == key(chunks.join(meta, "doc_id")) and got.where("doc_id = 2").count() == 4
    plan = got._jdf.queryExecution().executedPlan().toString().split("InMemoryTableScan")[0]
    assert "SortMergeJoin" not in plan and "hashpartitioning" not in plan
    idx = Q.build_kb(spark, folder)
    assert idx.n_chunks == got.count()
    files = {r[0].rsplit("/", 1)[1] for r in idx.chunks.select(F.input_file_name()).distinct().collect()}
    assert len(files) <= got.rdd.getNumPartitions()  # a file a task, not one for each bucket


@pytest.mark.parametrize("common", [0, 3, 1 << 18])
def test_norms_move_rare_terms_only(spark, path, common, monkeypatch):
    monkeypatch.setattr(KB, "COMMON_TERMS", common)
    idx = KB.write_index(chunk_fixed(docs(spark, [(i, text(i), "a") for i in range(40)]), 16, 25), path, ("kind",))
    bar, dfs = KB._common_bar(idx._dfs()), {r.term: r.df for r in idx._dfs().collect()}
    assert sum(n >= bar for n in dfs.values()) <= common and (bar == 1 or sum(n >= bar // 2 for n in dfs.values()) > common)
    want = {}
    for r in idx.postings.collect():
        at = (r.doc_id, r.chunk_no)
        want[at] = want.get(at, 0.0) + (r.tf * math.log((idx.n_chunks + 1.0) / (dfs[r.term] + 1.0))) ** 2
    got = {(r.doc_id, r.chunk_no): r.tfidf_norm for r in idx.norms().collect()}
    assert got == {k: pytest.approx(math.sqrt(v)) for k, v in want.items()}
    counted = {r.term: r.n for r in idx._sums("blocks").groupBy("term").agg(F.sum("df").alias("n")).collect()}
    assert counted == dfs
