"""Headline-query timing.

Runs the headline queries at ``$BENCH_SF_DIR`` (default /root/testdata/sf0.1)
on ``local[$BENCH_CPUS]`` and prints one JSON line. Each query is executed
to completion with the ``noop`` sink (full plan, nothing collected to the
driver): one warm-up pass, then the median of ``$BENCH_REPEATS`` timed runs.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = ["answer_questions", "bm25_topk", "hybrid_topk", "knn_l2", "chunk_fixed", "kb_records",
            "html_to_text", "stitch_tables", "assemble_document", "parse_events", "video_labels",
            "transcript_label_join", "sync_apply", "agent_sessions", "pending_reminders", "run_summary",
            "table_continuation", "drop_repeat_queries", "sync_plan", "embed_chunks", "knn_ivf", "bm25_topk_pruned",
            "bm25_topk_blocks", "bm25_topk_filtered", "bm25_topk_synced"]


def main() -> None:
    from quire.plans.catalog import load
    from quire.session import build_session

    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    repeats = int(os.environ.get("BENCH_REPEATS", "3"))
    only = [q for q in os.environ.get("BENCH_QUERIES", "").split(",") if q]
    spark = build_session(cpus, app="quire-bench")
    reg = load()
    names = only or [q for q in HEADLINE if q in reg]

    def run(name: str) -> float:
        t0 = time.perf_counter()
        reg[name][0](spark, sf_dir).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - t0

    def index_build() -> float:
        """Build of the stored KB index (chunks, postings, statistics, block
        maxima, norms, all written) from an empty cache."""
        from quire.plans.q_retrieve import build_kb
        spark.catalog.clearCache()
        t0 = time.perf_counter()
        build_kb(spark, sf_dir).norms().count()
        return time.perf_counter() - t0

    for n in names:  # warm-up: JIT, file listing, Python workers
        run(n)
    out = {}
    if not only:
        # The retrieval queries below read the stored index, as a KB serves
        # many queries from one build; the cost of the build is reported here.
        out["kb_index_build_cold"] = round(statistics.median(index_build() for _ in range(repeats)), 3)
    for n in names:
        out[n] = round(statistics.median(run(n) for _ in range(repeats)), 3)
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(json.dumps({"metric": "headline_total_seconds", "value": round(sum(out.values()), 3), "unit": "sec",
                      "queries": out, "sf": sf, "cpus": cpus, "repeats": repeats}))
    spark.stop()


if __name__ == "__main__":
    main()
