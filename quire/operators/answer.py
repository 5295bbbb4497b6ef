"""Retrieve-and-generate over a batch of questions."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quire.operators import retrieve as RT
from quire.operators.infer import batch_infer, native_extractive
from quire.operators.routing import answer_or_fallback


def answer_questions(chunks: DataFrame | None, questions: DataFrame, k: int = 3, now: str = "",
                     search_type: str = "HYBRID", model: Callable | None = None,
                     template: str = RT.ANSWER_PROMPT, idx: RT.LexicalIndex | None = None,
                     flt: dict | None = None) -> DataFrame:
    """Per question: top-k contexts (hybrid or semantic), the numbered
    prompt, the model's reply cut to its last line, fallback when empty.

    ``model=None`` uses the extractive stub as a native expression; any
    other model runs through ``batch_infer`` (Arrow batches). ``flt`` is a
    metadata filter, applied to what is ranked, on columns that the index
    holds; term statistics stay those of the whole index. ``chunks`` is only
    needed where no index (``idx``, in memory or stored) is given.
    """
    idx = (idx or RT.build_index(chunks)).where(flt)
    ranked = RT.with_text(RT.hybrid_topk(idx, questions, k, search_type=search_type), idx)
    per_q = ranked.groupBy("qid").agg(
        F.array_sort(F.collect_list(F.struct("rank", "text", "doc_id"))).alias("_r"))
    j = questions.join(per_q, "qid", "left")
    j = (j.withColumn("contexts", F.coalesce(F.transform("_r", lambda x: x["text"]),
                                              F.array().cast("array<string>")))
          .withColumn("top_doc_id", F.get(F.col("_r"), 0)["doc_id"]))
    j = j.withColumn("prompt", RT.fill_template(template, {
        "search_results": RT.numbered_results(F.coalesce(
            F.transform("_r", lambda x: F.struct(x["rank"].alias("rank"), x["text"].alias("text"))),
            F.array().cast("array<struct<rank:int,text:string>>"))),
        "current_time": F.lit(now), "query": F.col("question"),
        "output_format_instructions": F.lit("")})).drop("_r")
    if model is None:
        return answer_or_fallback(j.withColumn("output", native_extractive("contexts")), "output")
    j = batch_infer(j, model, "prompt").withColumnRenamed("output_text", "output")
    return answer_or_fallback(j, "output", "error")
