"""Registered queries: chunking, KB records, embedding."""

from __future__ import annotations

from pyspark.sql import functions as F

from quire.operators import chunk as C
from quire.plans import fixtures as FX
from quire.plans.catalog import register
from quire.plans.sql_fixtures import chunks_sql, cte, with_ctes, ws_tokens
from quire.sources.tables import table

cte("chunks500", ("object_keys",), chunks_sql(500, 20))


@register("chunk_fixed", with_ctes(
    "SELECT doc_id, chunk_no, start_token, n_tokens, text FROM chunks512", "chunks512"))
def chunk_fixed(spark, sf):
    d = table(spark, sf, "documents").select("doc_id", "text")
    return C.chunk_fixed(d, 512, 20).select("doc_id", "chunk_no", "start_token", "n_tokens", "text")


@register("chunk_fixed_500", with_ctes(
    "SELECT doc_id, chunk_no, start_token, n_tokens, text FROM chunks500", "chunks500"))
def chunk_fixed_500(spark, sf):
    d = table(spark, sf, "documents").select("doc_id", "text")
    return C.chunk_fixed(d, 500, 20).select("doc_id", "chunk_no", "start_token", "n_tokens", "text")


@register("chunk_none", f"""
SELECT doc_id, 0 AS chunk_no, 0 AS start_token, CAST(len({ws_tokens('text')}) AS INTEGER) AS n_tokens, text
FROM documents""")
def chunk_none(spark, sf):
    return C.chunk_none(table(spark, sf, "documents").select("doc_id", "text"))


@register("kb_records", with_ctes("SELECT * FROM kb_chunks", "kb_chunks"))
def kb_records(spark, sf):
    return FX.kb_chunks(spark, sf)


@register("embed_chunks", with_ctes("""
SELECT chunk_id, CAST(len(v) AS INTEGER) AS dim, list_transform(v, lambda x: round(x, 6)) AS embedding FROM emb_chunks""", "emb_chunks"))
def embed_chunks(spark, sf):
    return C.embed_chunks(FX.kb_chunks(spark, sf).select("chunk_id", "text"), "hashing-64") \
        .select("chunk_id", F.size("embedding").alias("dim"), F.transform("embedding", lambda x: F.round(x, 6)).alias("embedding"))
