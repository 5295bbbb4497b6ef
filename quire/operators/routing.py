"""Scalar routing and validation operators."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quire.functions import keys as K
from quire.functions import text as tx

FALLBACK_ANSWER = "No relevant information found in the knowledge base."

# Agent function schemas (required, optional parameters).
CALL_SCHEMAS = {
    "createClaim": (["claimType", "policyNumber"], []),
    "gatherEvidence": (["claimId"], []),
    "sendReminder": (["claimId"], ["reminderType"]),
}

# Embedding dimension by model.
MODEL_DIMS = {
    "text-embed-v1": 1536,
    "embed-english-v3": 1024,
    "embed-multilingual-v3": 1024,
    "hashing-64": 64,
}
# Maximum chunk tokens by model.
MODEL_MAX_TOKENS = {
    "text-embed-v1": 8192,
    "embed-english-v3": 512,
    "embed-multilingual-v3": 512,
    "hashing-64": 8192,
}


def with_prefixes(df: DataFrame, prefixes, key: str = "raw_key") -> DataFrame:
    """Keep keys starting with any prefix; no prefixes keeps all."""
    if not prefixes:
        return df
    return df.where(reduce(lambda a, b: a | b, [F.col(key).startswith(p) for p in prefixes]))


def route_objects(df: DataFrame, key: str = "raw_key", ignore_case: bool = False) -> DataFrame:
    """Add ``route`` (pdf / office / video / NULL)."""
    return df.withColumn("route", K.route(key, ignore_case))


def page_order(df: DataFrame, name: str = "name", doc: str = "doc_id", page_bucket: int = 256) -> DataFrame:
    """Numeric page order inside a document; non-matching names last.

    The ordinal is a running count per ``(doc, page range)`` plus the counts
    of earlier ranges, so one document with a huge share of all pages is
    still numbered by many tasks."""
    from quire.operators.sequence import running_count
    x = df.withColumn("page_no", K.page_ordinal(name))
    last = F.lit((1 << 31) - 1)
    x = x.withColumn("_pk", F.coalesce(F.col("page_no"), last)).withColumn("_one", F.lit(1))
    bucket = F.floor(F.col("_pk") / F.lit(page_bucket)).cast("bigint")
    x = running_count(x, doc, ["_pk", name], bucket, "_one", "ord")
    return x.withColumn("ord", F.col("ord").cast("int")).drop("_pk", "_one", "_b")


def answer_or_fallback(df: DataFrame, output: str = "output", error: str | None = None) -> DataFrame:
    """P10 + P11: last line of the reply; fixed sentence when there is none;
    ``Error ...`` text when the call failed."""
    ans = F.coalesce(tx.last_line(output), F.lit(FALLBACK_ANSWER))
    if error is not None:
        ans = F.when(F.col(error).isNotNull(),
                     F.concat(F.lit("Error querying knowledge base: "), F.col(error))).otherwise(ans)
    return df.withColumn("answer", ans)


def validate_calls(df: DataFrame, fn: str = "function", params: str = "params") -> DataFrame:
    """Required parameters present, nothing outside required+optional.

    The schema table is a literal map (a handful of entries), so this is a
    projection - no join, no shuffle.
    """
    req = F.create_map(*[x for k, (r, _) in CALL_SCHEMAS.items()
                         for x in (F.lit(k), F.array(*map(F.lit, r)).cast("array<string>"))])
    opt = F.create_map(*[x for k, (_, o) in CALL_SCHEMAS.items()
                         for x in (F.lit(k), F.array(*map(F.lit, o)).cast("array<string>"))])
    r, o = F.element_at(req, F.col(fn)), F.element_at(opt, F.col(fn))
    keys = F.map_keys(F.col(params))
    missing = F.array_sort(F.array_except(r, keys))
    unknown = F.array_sort(F.array_except(keys, F.array_union(r, o)))
    return (df.withColumn("missing", missing).withColumn("unknown", unknown)
            .withColumn("valid", F.coalesce((F.size("missing") == 0) & (F.size("unknown") == 0),
                                            F.lit(False))))


def embedding_dim_check(df: DataFrame, model: str = "model", emb: str = "embedding",
                        models: dict[str, int] | None = None) -> DataFrame:
    """``ok`` / ``dim_mismatch`` / ``unknown_model`` per vector. ``models``
    (id -> dimension) adds the ids a deployment uses."""
    dims = F.create_map(*[x for k, v in (MODEL_DIMS | (models or {})).items() for x in (F.lit(k), F.lit(v))])
    exp = F.element_at(dims, F.col(model))
    status = (F.when(exp.isNull(), F.lit("unknown_model"))
              .when(F.size(F.col(emb)) == exp, F.lit("ok"))
              .otherwise(F.lit("dim_mismatch")))
    return (df.withColumn("expected_dim", exp).withColumn("dim", F.size(F.col(emb)))
            .withColumn("status", status))


def model_dim(model: str, models: dict[str, int] | None = None) -> int:
    known = MODEL_DIMS | (models or {})
    if model not in known:
        raise ValueError(f"unsupported embedding model {model!r}; supported: {sorted(known)}")
    return known[model]


def eval_subset(df: DataFrame, n: int, order: str = "qid") -> DataFrame:
    """The first n rows of the evaluation set (a limit is the feature)."""
    return df.orderBy(order).limit(n)
