"""Batch inference.

The model is a user function ``prompt -> str | dict``; it runs inside
``mapInPandas`` so requests travel in Arrow batches and every executor calls
the model for its own partition. Timeouts are retried with a doubling delay;
other errors become rows (``error`` column), never job failures.
"""

from __future__ import annotations

import time
from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quire.functions import text as tx

MAX_RETRIES = 3
RETRY_DELAY_S = 10.0
MAX_TOKENS = 4096

OUT_FIELDS = [T.StructField("output_text", T.StringType()),
              T.StructField("input_tokens", T.LongType()),
              T.StructField("output_tokens", T.LongType()),
              T.StructField("stop_reason", T.StringType()),
              T.StructField("attempts", T.IntegerType()),
              T.StructField("error", T.StringType())]


class ModelTimeout(Exception):
    """Raised by a model function when the call timed out (retryable)."""


def extractive_stub(prompt: str) -> dict:
    """Deterministic offline model: answers with the first sentence of the
    first numbered search result, else of the prompt's last line."""
    import re
    text = prompt or ""
    m = re.search(r"^1\. (.*)$", text, flags=re.M)
    src = m.group(1) if m else text.strip().split("\n")[-1]
    first = re.split(r"[.!?]+(?:\s+|$)", src.strip())[0].strip()
    return {"text": first, "input_tokens": len(text.split()), "output_tokens": len(first.split()),
            "stop_reason": "end_turn"}


def _call(fn: Callable, prompt, max_retries: int, delay: float, sleep: Callable):
    attempt, wait = 0, delay
    while True:
        attempt += 1
        try:
            r = fn(prompt)
            if isinstance(r, str):
                r = {"text": r}
            text = r.get("text")
            return (text, r.get("input_tokens", len((prompt or "").split())),
                    r.get("output_tokens", len((text or "").split())),
                    r.get("stop_reason", "end_turn"), attempt, None)
        except ModelTimeout as e:
            if attempt >= max_retries:
                return (None, None, None, None, attempt, f"timeout: {e}")
            sleep(wait)
            wait *= 2
        except Exception as e:  # noqa: BLE001 - errors are data
            return (None, None, None, None, attempt, f"{type(e).__name__}: {e}")


def batch_infer(df: DataFrame, fn: Callable = extractive_stub, prompt: str = "prompt",
                max_retries: int = MAX_RETRIES, delay: float = RETRY_DELAY_S,
                sleep: Callable = time.sleep) -> DataFrame:
    """Apply ``fn`` to every prompt; adds the M19 usage columns."""
    schema = T.StructType(df.schema.fields + OUT_FIELDS)
    names = [f.name for f in OUT_FIELDS]

    def run(batches):
        import pandas as pd
        for pdf in batches:
            rows = [_call(fn, p, max_retries, delay, sleep) for p in pdf[prompt].tolist()]
            out = pd.DataFrame(rows, columns=names, index=pdf.index)
            out["input_tokens"] = out["input_tokens"].astype("Int64")
            out["output_tokens"] = out["output_tokens"].astype("Int64")
            out["attempts"] = out["attempts"].astype("int32")
            yield pd.concat([pdf, out], axis=1)

    return df.mapInPandas(run, schema)


def token_usage(usage: DataFrame, key: str = "doc_id", max_tokens_reason: str = "max_tokens") -> DataFrame:
    """Token totals and stop reasons per document (map-side combined)."""
    return usage.groupBy(key).agg(
        F.count(F.lit(1)).alias("n_requests"),
        F.sum("input_tokens").cast("bigint").alias("input_tokens"),
        F.sum("output_tokens").cast("bigint").alias("output_tokens"),
        (F.sum("input_tokens") + F.sum("output_tokens")).cast("bigint").alias("total_tokens"),
        F.sum(F.when(F.col("stop_reason") == max_tokens_reason, 1).otherwise(0)).cast("bigint")
        .alias("n_truncated"))


def native_extractive(contexts) -> "F.Column":
    """The stub model as a native expression (no Python rows): first sentence
    of the best-ranked context, NULL when there is none."""
    c = F.col(contexts) if isinstance(contexts, str) else contexts
    first = F.get(c, 0)
    return F.when(first.isNotNull(), tx.first_sentence(first))
