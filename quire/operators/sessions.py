"""Session-level operators (R9-R13) and queue timing (W2-W3, batch form)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quire.operators.sequence import DEFAULT_BUCKET_S, bucketed_prev, sessions

IDLE_TTL_S = 300
DELIVERY_DELAY_S = 60
RETENTION_S = 4 * 24 * 3600


def first_chunk(events: DataFrame, key: str = "conv_id", seq: str = "seq", chunk: str = "chunk") -> DataFrame:
    """The first event that carries a chunk; NULL when none does.
    ``min_by`` ignores rows whose ordering value is NULL, so non-chunk
    events are masked out of the ordering."""
    return events.groupBy(key).agg(
        F.min_by(F.col(chunk), F.when(F.col(chunk).isNotNull(), F.col(seq))).alias("reply"))


def drop_repeat_queries(log: DataFrame, session: str = "session", ts: str = "ts", tie: str = "event_id",
                        query: str = "query", bucket_s: int = DEFAULT_BUCKET_S) -> DataFrame:
    """Skip empty queries and a query equal to the session's previous
    submission (null-safe compare). The previous query comes from a
    bucketed lag, so a session with a third of all rows is still spread
    over many tasks."""
    x = bucketed_prev(log, session, ts, tie, [query], bucket_s)
    keep = (F.col(query) != "") & ~F.col(query).eqNullSafe(F.col(f"prev_{query}"))
    return x.where(keep).select(*log.columns)


def dedupe_uploads(uploads: DataFrame, session: str = "session", name: str = "file_name",
                   ts: str = "ts", tie: str = "event_id") -> DataFrame:
    """The first upload of each file name in a session; later ones are
    skipped. Grouped ``min_by`` (map-side combined)."""
    g = uploads.groupBy(session, name).agg(
        F.min_by(F.struct(ts, tie), F.struct(ts, tie)).alias("_f"), F.count(F.lit(1)).alias("n_uploads"))
    return g.select(session, name, F.col("_f")[ts].alias(ts), F.col("_f")[tie].alias(tie), "n_uploads")


def agent_sessions(log: DataFrame, session: str = "session", ts: str = "ts", tie: str = "event_id",
                   gap_s: int = IDLE_TTL_S, bucket_s: int = DEFAULT_BUCKET_S) -> DataFrame:
    """Idle-TTL sessions; an event ``gap_s`` or more after the previous
    one starts a new session, and a session ends ``gap_s`` after its last
    event. Batch form: skew-proof gaps-and-islands (``operators.sequence``)
    followed by a map-side-combined aggregate. The streaming form
    (``streaming.session_stream``) uses ``session_window``; the tests check
    that both agree."""
    s = sessions(log, session, ts, tie if tie in log.columns else None, gap_s, bucket_s)
    s = s.drop("_b")
    g = s.groupBy(session, "session_no").agg(F.min(ts).alias("session_start"), F.max(ts).alias("_last"),
                                             F.count(F.lit(1)).alias("n_events"))
    return g.select(session, "session_start",
                    (F.col("_last") + F.expr(f"INTERVAL {gap_s} SECONDS")).alias("session_end"), "n_events")


def session_gap(gap_s: int) -> str:
    """Window gap that starts a new session at exactly ``gap_s`` seconds."""
    return f"{gap_s * 1_000_000 - 1} microseconds"


def pending_reminders(claims: DataFrame, docs: DataFrame, open_status: str = "O",
                      pending_state: str = "pending") -> DataFrame:
    """Open claims with pending documents, and which ones.

    The pending documents are aggregated first (distinct doc numbers per
    claim, combined map-side), then semi-joined to the open claims."""
    pend = (docs.where(F.col("state") == pending_state)
            .groupBy("claim_id").agg(F.array_sort(F.collect_set("doc_no")).alias("pending_docs")))
    open_ = claims.where(F.col("status") == open_status).select("claim_id")
    return (pend.join(open_, "claim_id", "left_semi")
            .withColumn("n_pending", F.size("pending_docs")))


def due_messages(messages: DataFrame, now: str, ts: str = "sent_at",
                 delay_s: int = DELIVERY_DELAY_S, retention_s: int = RETENTION_S) -> DataFrame:
    """W2 + W3 (batch): delivered no earlier than ``delay_s`` after sending
    and gone after ``retention_s``."""
    t = F.col(ts)
    n = F.lit(now).cast("timestamp_ntz")
    return messages.where((t + F.expr(f"INTERVAL {delay_s} SECONDS") <= n)
                          & (t > n - F.expr(f"INTERVAL {retention_s} SECONDS")))
