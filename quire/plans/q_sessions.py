"""Registered queries: sync, jobs, keyed store, sessions, reminders, queue
timing (C5-C7, S13, R9-R13, W2-W3)."""

from __future__ import annotations

from pyspark.sql import functions as F

from quire.operators import sessions as SS
from quire.operators import sync as SY
from quire.operators.chunk import chunk_fixed
from quire.plans import fixtures as FX
from quire.plans.catalog import register
from quire.plans.sql_fixtures import chunks_sql, cte, with_ctes
from quire.sources.tables import table

NOW = FX.QUEUE_NOW

cte("snapshot_old", (), "SELECT doc_id, text FROM documents WHERE doc_id % 10 <> 1")
cte("snapshot_new", (), """
  SELECT doc_id, CASE WHEN doc_id % 10 = 3 THEN text || ' appendix' ELSE text END AS text
  FROM documents WHERE doc_id % 10 <> 2""")
cte("sync_plan", ("snapshot_old", "snapshot_new"), """
  SELECT coalesce(o.doc_id, n.doc_id) AS doc_id,
         CASE WHEN o.doc_id IS NULL THEN 'ADD' WHEN n.doc_id IS NULL THEN 'DELETE'
              WHEN sha256(o.text) <> sha256(n.text) THEN 'UPDATE' ELSE 'UNCHANGED' END AS action
  FROM snapshot_old o FULL OUTER JOIN snapshot_new n ON o.doc_id = n.doc_id""")
cte("new_chunks", ("snapshot_new", "object_keys"), chunks_sql(512, 20, "snapshot_new"))


def _plan(spark, sf):
    return SY.sync_plan(FX.snapshot_old(spark, sf), FX.snapshot_new(spark, sf))


@register("sync_plan", with_ctes("SELECT * FROM sync_plan", "sync_plan"))
def sync_plan(spark, sf):
    return _plan(spark, sf)


@register("sync_stats", with_ctes("SELECT action, count(*) AS n FROM sync_plan GROUP BY action", "sync_plan"))
def sync_stats(spark, sf):
    return SY.sync_stats(_plan(spark, sf))


@register("sync_apply", with_ctes(
    "SELECT doc_id, chunk_no, start_token, n_tokens, text FROM new_chunks", "new_chunks"))
def sync_apply(spark, sf):
    old_chunks = chunk_fixed(FX.snapshot_old(spark, sf), 512, 20)
    out = SY.sync_apply(old_chunks, FX.snapshot_new(spark, sf), _plan(spark, sf),
                        max_tokens=512, overlap_pct=20)
    return out.select("doc_id", "chunk_no", "start_token", "n_tokens", "text")


@register("latest_job_status", """
SELECT data_source_id, arg_max(event_id, (ts, event_id)) AS job_id, max(ts) AS started_at,
       arg_max(CASE WHEN event_type = 'signup' THEN 'COMPLETE' WHEN event_type = 'error' THEN 'FAILED'
                    ELSE 'IN_PROGRESS' END, (ts, event_id)) AS status
FROM (SELECT user_id // 10 AS data_source_id, event_id, ts, event_type FROM events) e
GROUP BY data_source_id""")
def latest_job_status(spark, sf):
    return SY.latest_job_status(FX.jobs(spark, sf))


@register("keyed_upsert", """
SELECT claim_id, arg_max(status, (updated_at, status)) AS status, max(updated_at) AS updated_at
FROM (SELECT o_orderkey AS claim_id, o_orderstatus AS status, o_orderdate AS updated_at FROM orders
      UNION ALL
      SELECT l_orderkey, 'RET_' || l_returnflag, l_shipdate FROM lineitem) u
GROUP BY claim_id""")
def keyed_upsert(spark, sf):
    base = table(spark, sf, "orders").select(F.col("o_orderkey").alias("claim_id"),
                                             F.col("o_orderstatus").alias("status"),
                                             F.col("o_orderdate").alias("updated_at"))
    upd = table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("claim_id"),
                                              F.concat(F.lit("RET_"), "l_returnflag").alias("status"),
                                              F.col("l_shipdate").alias("updated_at"))
    return SY.keyed_upsert(base, upd, "claim_id", "updated_at")


@register("first_chunk", """
SELECT conv_id, min_by(text, turn) FILTER (WHERE role = 'assistant') AS reply
FROM conversations GROUP BY conv_id""")
def first_chunk(spark, sf):
    return SS.first_chunk(FX.agent_events(spark, sf))


@register("drop_repeat_queries", """
SELECT session, ts, event_id, query FROM (
  SELECT *, lag(query) OVER (PARTITION BY session ORDER BY ts, event_id) AS prev
  FROM (SELECT user_id AS session, ts, event_id, CASE WHEN value < 1 THEN '' ELSE event_type END AS query
        FROM events) e) x
WHERE query <> '' AND query IS DISTINCT FROM prev""")
def drop_repeat_queries(spark, sf):
    return SS.drop_repeat_queries(FX.query_log(spark, sf))


@register("dedupe_uploads", """
SELECT session, file_name, min(ts) AS ts, arg_min(event_id, (ts, event_id)) AS event_id, count(*) AS n_uploads
FROM (SELECT user_id AS session, event_type || '.pdf' AS file_name, ts, event_id FROM events) u
GROUP BY session, file_name""")
def dedupe_uploads(spark, sf):
    return SS.dedupe_uploads(FX.uploads(spark, sf))


@register("agent_sessions", """
SELECT session, min(ts) AS session_start, max(ts) + INTERVAL 300 SECOND AS session_end, count(*) AS n_events
FROM (SELECT *, sum(CASE WHEN prev IS NULL OR ts >= prev + INTERVAL 300 SECOND THEN 1 ELSE 0 END)
                OVER (PARTITION BY session ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS sid
      FROM (SELECT user_id AS session, ts, event_id,
                   lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS prev FROM events) a) b
GROUP BY session, sid""")
def agent_sessions(spark, sf):
    return SS.agent_sessions(FX.query_log(spark, sf))


@register("pending_reminders", """
SELECT claim_id, list_sort(list(DISTINCT doc_no)) AS pending_docs, CAST(count(DISTINCT doc_no) AS INTEGER) AS n_pending
FROM (SELECT l_orderkey AS claim_id, l_linenumber AS doc_no FROM lineitem WHERE l_returnflag = 'N') d
WHERE claim_id IN (SELECT o_orderkey FROM orders WHERE o_orderstatus = 'O')
GROUP BY claim_id""")
def pending_reminders(spark, sf):
    return SS.pending_reminders(FX.claims(spark, sf), FX.claim_docs(spark, sf))


@register("due_messages", f"""
SELECT event_id AS id, ts AS sent_at FROM events
WHERE ts + INTERVAL 60 SECOND <= TIMESTAMP '{NOW}' AND ts > TIMESTAMP '{NOW}' - INTERVAL 345600 SECOND""")
def due_messages(spark, sf):
    return SS.due_messages(FX.messages(spark, sf), NOW)
