"""Chunking, KB records and the offline embedding job.

Chunking is a narrow transformation: tokens, chunk starts and slices are
array expressions on the document row, and ``posexplode`` emits the chunks.
No shuffle, so it scales with the scan.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quire.functions import text as tx
from quire.operators.routing import MODEL_DIMS, MODEL_MAX_TOKENS

FIXED_SIZE = "FIXED_SIZE"
NONE = "NONE"
DEFAULT_MAX_TOKENS = 512
DEFAULT_OVERLAP_PCT = 20


def chunk_params(strategy: str = FIXED_SIZE, max_tokens: int | None = DEFAULT_MAX_TOKENS,
                 overlap_pct: int | None = DEFAULT_OVERLAP_PCT, model: str | None = None):
    """Validate the chunking config; returns ``(max_tokens, overlap, stride)``.

    FIXED_SIZE needs both numbers; max is clamped to the model's cap; the
    overlap percentage must be in [0, 100).
    """
    if strategy == NONE:
        return None
    if strategy != FIXED_SIZE:
        raise ValueError(f"unsupported chunking strategy {strategy!r}")
    if max_tokens is None or overlap_pct is None:
        raise ValueError("max_tokens and overlap_pct must be provided for FIXED_SIZE chunking")
    if model is not None:
        if model not in MODEL_MAX_TOKENS:
            raise ValueError(f"unsupported embedding model {model!r}")
        max_tokens = min(max_tokens, MODEL_MAX_TOKENS[model])
    if max_tokens < 1:
        raise ValueError("max_tokens must be positive")
    if not 0 <= overlap_pct < 100:
        raise ValueError("overlap_pct must be in [0, 100)")
    overlap = (max_tokens * overlap_pct) // 100
    return max_tokens, overlap, max_tokens - overlap


def chunk_fixed(df: DataFrame, max_tokens: int = DEFAULT_MAX_TOKENS, overlap_pct: int = DEFAULT_OVERLAP_PCT,
                model: str | None = None, text: str = "text") -> DataFrame:
    """Fixed-size token windows with overlap.

    Tokens are non-empty whitespace-separated strings. Starts are 0, stride,
    2*stride, ... kept while ``start = 0 OR start + overlap < n`` so that no
    chunk lies wholly inside its predecessor. Every other column of ``df``
    is carried to each chunk.
    """
    mx, overlap, stride = chunk_params(FIXED_SIZE, max_tokens, overlap_pct, model)
    keep = [c for c in df.columns if c != text]
    t = df.select(*keep, tx.ws_tokens(text).alias("_tok"))
    n = F.size("_tok")
    starts = F.filter(F.sequence(F.lit(0), F.greatest(n - 1, F.lit(0)), F.lit(stride)),
                      lambda s: (s == 0) | (s + overlap < n))
    # the slices are cut inside the document's row, so a chunk carries its own tokens only
    pieces = F.transform(starts, lambda s: F.struct(s.alias("start_token"), F.slice("_tok", s + 1, F.lit(mx)).alias("piece")))
    x = t.select(*keep, F.posexplode(pieces).alias("chunk_no", "_p"))
    return x.select(*keep, "chunk_no", F.col("_p.start_token").alias("start_token"),
                    F.size("_p.piece").alias("n_tokens"), F.array_join("_p.piece", " ").alias("text"))


def chunk_none(df: DataFrame, text: str = "text") -> DataFrame:
    """One chunk per document, text unchanged."""
    keep = [c for c in df.columns if c != text]
    return df.select(*keep, F.lit(0).alias("chunk_no"), F.lit(0).alias("start_token"),
                     F.size(tx.ws_tokens(text)).alias("n_tokens"), F.col(text).alias("text"))


def chunk(df: DataFrame, strategy: str = FIXED_SIZE, **kw) -> DataFrame:
    return chunk_none(df) if strategy == NONE else chunk_fixed(df, **kw)


def chunk_id(doc="doc_id", chunk_no="chunk_no"):
    return F.sha2(F.concat(F.col(doc).cast("string"), F.lit(":"), F.col(chunk_no).cast("string")), 256)


def kb_records(chunks: DataFrame, source_uri: str = "raw_key") -> DataFrame:
    """The M9 record: id, text, metadata JSON with the source key."""
    meta = F.to_json(F.struct(F.col(source_uri).alias("source_uri"), "doc_id", "chunk_no"))
    return chunks.select(chunk_id().alias("chunk_id"), "doc_id", "chunk_no", "text", meta.alias("metadata"))


def embed_chunks(chunks: DataFrame, model: str = "hashing-64", text: str = "text",
                 id_col: str = "chunk_id") -> DataFrame:
    """C4: offline embedding - hashed term frequency, IDF, L2 normalised,
    at the model's dimension, by a model fitted on these chunks (one grouped
    count); :mod:`quire.operators.vectors` stores and applies such models."""
    from quire.operators.vectors import fit_embedder

    return fit_embedder(chunks, model, text).embed(chunks, id_col, text)


def embed_with(chunks: DataFrame, fn, model: str, text: str = "text", id_col: str = "chunk_id",
               batch_size: int = 64, dims: dict[str, int] | None = None) -> DataFrame:
    """C4 with a user embedding model (U2): ``fn(list[str]) -> list[list[float]]``
    is called on batches inside ``mapInPandas`` (Arrow transfer, one model
    client per task). Vectors whose length is not the model's dimension are
    flagged (P13) instead of failing the job. ``dims`` adds models to the
    table of dimensions."""
    from pyspark.sql import types as T

    dim = (MODEL_DIMS | (dims or {})).get(model)
    if dim is None:
        raise ValueError(f"unsupported embedding model {model!r}")
    schema = T.StructType([T.StructField(id_col, chunks.schema[id_col].dataType),
                           T.StructField("embedding", T.ArrayType(T.FloatType())),
                           T.StructField("dim_ok", T.BooleanType())])

    def run(batches):
        import pandas as pd
        for pdf in batches:
            vecs = []
            texts = pdf[text].tolist()
            for i in range(0, len(texts), batch_size):
                vecs.extend(fn(texts[i:i + batch_size]))
            yield pd.DataFrame({id_col: pdf[id_col], "embedding": [list(map(float, v)) for v in vecs],
                                "dim_ok": [len(v) == dim for v in vecs]})

    return chunks.select(id_col, text).mapInPandas(run, schema)
