"""What large tables need: rows that move once, work done once."""

import datetime

from pyspark.sql import functions as F

from quire.functions import text as tx
from quire.operators import pages as PG
from quire.operators import sequence as SQ
from quire.operators import vectors as VX
from quire.plans import fixtures as FX
from quire.plans import q_retrieve as QR
from quire.plans import q_text as QT


def _lineitem(spark, folder, odd=True):
    """Orders of 1 to 30 lines; ``odd``: without a number, repeated, without an order."""
    rows = [(o, i * 7 + o, i, i % 5 + 1, float(i), 1.5 * o, 0.1, 0.0, "AN"[i % 2], "OF"[(i + o) % 2], datetime.datetime(2024, 1, 1 + i % 9))
            for o in range(1, 41) for i in range(1, 2 + (o * 7) % 30)]
    if odd:
        rows += [(o, o, i, None, 1.0, 2.0, 0.0, 0.0, "A", "O", None) for o in (2, 3, 5, 10, 50) for i in range(1, 2 + o % 3)]
        rows += [(None, o, 1, 1 + o % 2, 1.0, 2.0, 0.0, 0.0, "A", "O", None) for o in range(4)]
        rows += [(o, 1, None, 1 + o % 2, None, 2.0, 0.0, 0.0, None, None, None) for o in range(4)] + rows[:30]
    (spark.createDataFrame(rows, "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_extendedprice double, "
                                 "l_discount double, l_tax double, l_returnflag string, l_linestatus string, l_shipdate timestamp")
     .write.parquet(f"{folder}/lineitem.parquet"))
    return str(folder)


def _exchanges(df):
    return df._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning")


def test_stitch_tables_moves_lines_once(spark, tmp_path):
    sf = _lineitem(spark, tmp_path, odd=False)
    df = QT.stitch_tables(spark, sf)
    assert df.count() >= 40 and _exchanges(df) == 1


def test_normalize_table_moves_lines_once(spark, tmp_path):
    sf = _lineitem(spark, tmp_path, odd=False)
    df = QT.normalize_table(spark, sf)
    assert df.count() > 0 and _exchanges(df) == 1


def test_pages_of_hot_orders_are_those_of_others(spark, tmp_path, monkeypatch):
    """All orders spread over tasks, some, and none but the lines without an order."""
    sf = _lineitem(spark, tmp_path)
    rows = lambda df: sorted(df.collect(), key=str)
    monkeypatch.setattr(SQ, "HOT_ROWS", -1)
    spread, blocks = rows(FX.order_pages(spark, sf)), rows(QT.stitch_tables(spark, sf))
    assert len(spread) > 200 and any(r.page_no is None for r in spread) and any(r.doc_id is None for r in spread)
    for most in (20, 1 << 17):
        monkeypatch.setattr(SQ, "HOT_ROWS", most)
        parts = FX.order_page_parts(spark, sf)
        assert len(parts) == 2 and all(p.count() for p in parts)
        assert rows(FX.order_pages(spark, sf)) == spread
        assert rows(QT.stitch_tables(spark, sf)) == blocks


def test_stitch_tables_of_pages_that_are_together(spark):
    table, text = "| a | b |", "words"
    pages = [(d, p, "\n".join([table if (d + p) % 3 else text, text if p % 4 == 1 else table])) for d in (1, 2, 300) for p in range(1, 600, d)]
    pages += [(1, None, table), (None, 1, table), (None, 2, table), (None, None, text), (7, 1, None), (7, 2, table)]
    df = spark.createDataFrame(pages, "doc_id long, page_no int, content string")
    want = sorted(PG.stitch_tables(df, page_bucket=16).collect(), key=str)
    assert sorted(PG.stitch_tables(df.repartition("doc_id")).collect(), key=str) == want


def test_words_are_the_pieces_between_separators(spark):
    texts = ["", " ", "a", "A b", "--A--b--", "x\n", "x \u2028", "\u2028x,", "\u0130stanbul \u03a3\u03a3", "e\u0301a 1\u00b2\u0663", "a\ud7ffb\U0001d400c \U0001f600", "\t9_8\n\n", None]
    df = spark.createDataFrame([(i, x) for i, x in enumerate(texts)], "i int, t string")
    was = tx._split_nonempty(F.lower("t"), tx.WORD_SPLIT)
    got = df.select("t", tx.word_tokens("t").alias("w"), was.alias("was")).collect()
    assert [r.w for r in got] == [r.was for r in got] and sum(len(r.w or []) for r in got) > 12


def test_dense_build_cuts_texts_into_words_once(spark, monkeypatch):
    from tests.conftest import SF_SMALL
    cut, calls = tx.word_tokens, []
    monkeypatch.setattr(tx, "word_tokens", lambda c: calls.append(c) or cut(c))
    path = QR.build_dense(spark, SF_SMALL)
    assert len(calls) == 1
    chunks = FX.kb_chunks(spark, SF_SMALL).select("chunk_id", "text")
    model = VX.fit_embedder(chunks)
    assert VX.Embedder.load(spark, f"{path}/model") == model
    got = {r.chunk_id: r.embedding for r in spark.read.parquet(f"{path}/embedded").collect()}
    want = {r.chunk_id: r.embedding for r in model.embed(chunks, "chunk_id").collect() if any(r.embedding)}
    assert got == want
