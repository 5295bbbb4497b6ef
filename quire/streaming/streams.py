"""Streaming operators.

Every function takes and returns a streaming DataFrame (or builds a sink
function for ``foreachBatch``); the batch twin of each is the operator of the
same name in ``quire.operators`` and the tests check stream = batch.
Event-time columns must be ``timestamp`` (not ``timestamp_ntz``) before a
watermark is set; :func:`as_event_time` does the cast.
"""

from __future__ import annotations

import json
import pickle

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quire.functions import keys as K
from quire.operators import media as M
from quire.operators import pages as PG
from quire.operators.sessions import DELIVERY_DELAY_S, RETENTION_S, session_gap
from quire.sources.sinks import children

RETENTION = "4 days"


def as_event_time(df: DataFrame, col: str) -> DataFrame:
    return df.withColumn(col, F.col(col).cast("timestamp"))


# W1
BINARY_FILE = T.StructType([T.StructField("path", T.StringType(), False),
                            T.StructField("modificationTime", T.TimestampType(), False),
                            T.StructField("length", T.LongType(), False),
                            T.StructField("content", T.BinaryType(), True)])

def file_arrivals(spark: SparkSession, root: str, suffixes=None, ignore_case: bool = False,
                  max_files_per_trigger: int | None = None) -> DataFrame:
    """Every object created under ``root`` once, with its route and, where
    it is selected, its content. The
    file source records processed files in the checkpoint, so a restart
    never re-reads them."""
    r = spark.readStream.format("binaryFile").schema(BINARY_FILE).option("recursiveFileLookup", "true")
    if suffixes:
        r = r.option("pathGlobFilter", "{" + ",".join("*" + s for s in suffixes) + "}")
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", str(max_files_per_trigger))
    s = r.load(root)
    return s.select("path", "length", "modificationTime", K.route("path", ignore_case).alias("route"), "content")


# W2 / W3
def _hold(key, pdf_iter, state, ts: str, names: list[str], clock, delay_s: int, retention_s: int):
    """Rows of one message id: kept until ``delay_s`` after they were sent,
    delivered once, forgotten after ``retention_s``."""
    import pandas as pd

    now = pd.Timestamp(clock() if clock else state.getCurrentProcessingTimeMs(), unit="ms")
    held = pickle.loads(state.get[0]) if state.exists else pd.DataFrame(columns=names)
    if not state.hasTimedOut:
        parts = [p for p in (held, *pdf_iter) if len(p)]
        held = pd.concat(parts, ignore_index=True) if parts else held
    age = now - held[ts]
    held, age = held[age < pd.Timedelta(seconds=retention_s)], age[age < pd.Timedelta(seconds=retention_s)]
    due = age >= pd.Timedelta(seconds=delay_s)
    wait = held[~due]
    if len(wait):
        left = pd.Timedelta(seconds=delay_s) - age[~due].max()
        state.update((pickle.dumps(wait.reset_index(drop=True)),))  # rows as they came, whatever their types
        state.setTimeoutDuration(max(1, int(left.total_seconds() * 1000)))
    elif state.exists:
        state.remove()
    if due.any():
        yield held[due][names]


def due_messages(messages: DataFrame, key: str = "id", ts: str = "sent_at", clock=None,
                 delay_s: int = DELIVERY_DELAY_S, retention_s: int = RETENTION_S) -> DataFrame:
    """W2 + W3: every message once, not before the delivery delay and not
    after retention. A message younger than the delay waits in the state of
    its ``key``, with columns of any type, until a processing-time timer
    releases it (Spark returns no null elements of arrays from such state).
    ``clock`` (milliseconds) replaces the processing time, as in
    tests."""
    m = as_event_time(messages, ts)
    names = m.columns

    def hold(k, pdf_iter, state):
        return _hold(k, pdf_iter, state, ts, names, clock, delay_s, retention_s)

    return m.groupBy(key).applyInPandasWithState(hold, m.schema, "rows binary", "append", "ProcessingTimeTimeout")


# W4
CARRY_OUT = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("page_no", T.IntegerType()),
                          T.StructField("continued", T.BooleanType()),
                          T.StructField("previous_text", T.StringType()),
                          T.StructField("after_gap", T.BooleanType())])
CARRY_STATE = T.StructType([T.StructField("next_page", T.IntegerType()),
                            T.StructField("prev_content", T.StringType()),
                            T.StructField("prev_last", T.BooleanType()),
                            T.StructField("pending", T.StringType())])


def _carry(key, pdf_iter, state, idle_ms: int = 0, forget_ms: int = 0):
    import pandas as pd

    doc_id = int(key[0])
    fresh = not state.exists
    if fresh:
        nxt, prev_content, prev_last, pending = 1, None, False, {}
    else:
        nxt, prev_content, prev_last, pending_json = state.get
        pending = {int(k): tuple(v) for k, v in json.loads(pending_json).items()}
    late = state.hasTimedOut
    if late and not pending:
        state.remove()  # nothing waits, and what could come again is past its retention
        return
    if not late:
        for pdf in pdf_iter:
            if fresh and len(pdf) and "page_counter" in pdf and pd.notna(pdf["page_counter"].iloc[0]):
                # a document that another run left off: go on after its last page
                start = pdf.iloc[0]
                nxt, prev_content, prev_last = int(start["page_counter"]) + 1, start["previous_text"], bool(start["previous_last"])
            fresh = False
            for p, c, f, l in zip(pdf["page_no"], pdf["content"], pdf["first_is_table"], pdf["last_is_table"]):
                if int(p) >= nxt:      # a page already released was delivered again
                    pending[int(p)] = (c, bool(f), bool(l))
    out = []
    # the contiguous run after the last page released; after the timeout, all that waits
    while nxt in pending or (late and pending):
        page = nxt if nxt in pending else min(pending)
        content, first, last = pending.pop(page)
        cont = page == nxt and page > 1 and bool(prev_last) and first
        out.append((doc_id, page, cont, prev_content if cont else None, page != nxt))
        prev_content, prev_last, nxt = content, last, page + 1
    # a text that cannot be carried on (no table at its end) is not kept
    state.update((nxt, prev_content if prev_last else None, prev_last, json.dumps({str(k): list(v) for k, v in pending.items()})))
    if pending and idle_ms:
        state.setTimeoutDuration(idle_ms)
    elif not pending and forget_ms:
        state.setTimeoutDuration(forget_ms)
    if out:
        yield pd.DataFrame(out, columns=[f.name for f in CARRY_OUT.fields]).astype({"page_no": "int32"})


def page_carry(pages: DataFrame, row_regex: str = PG.TABLE_ROW_RE, idle_evict_ms: int = 0,
               forget_ms: int = RETENTION_S * 1000, resume: DataFrame | None = None) -> DataFrame:
    """The stateful form of T3. Per document the state keeps the next
    page to emit, the previous page's text where it ends with a table, and
    pages that arrived early; pages are released in order, so the continuation
    of page n is decided with page n-1 even when they arrive in different
    micro-batches.

    With ``idle_evict_ms`` a document whose pages wait that long (processing
    time) for a missing one releases them, in order, with ``after_gap`` where
    the page before is missing. A document for which nothing waits and nothing
    comes for ``forget_ms`` (by default the queue's retention, past which
    nothing is delivered again) leaves the state, so the state holds documents
    of one retention and not all there ever were; 0 keeps them.

    ``resume`` (doc_id, page_counter, previous_text; a static table of
    :func:`quire.sources.events.parse_resume`) starts documents where an
    earlier run left off: pages up to the counter are not released again and
    the next one is judged against the message's ``previous_text``."""
    idle, forget = int(idle_evict_ms), int(forget_ms)

    def carry(key, pdf_iter, state):
        return _carry(key, pdf_iter, state, idle, forget)

    flagged = PG.table_flags(pages, row_regex).select("doc_id", "page_no", "content",
                                                      "first_is_table", "last_is_table")
    if resume is not None:
        last = resume.groupBy("doc_id").agg(F.max_by(F.struct("page_counter", "previous_text"), "page_counter").alias("_r"))
        start = last.select(F.col("doc_id").alias("_doc"), "_r.page_counter", F.col("_r.previous_text").alias("content"))
        start = (PG.table_flags(start, row_regex).select("_doc", "page_counter", F.col("content").alias("previous_text"),
                                                         F.col("last_is_table").alias("previous_last")))
        flagged = flagged.join(start, F.col("doc_id") == F.col("_doc"), "left").drop("_doc")
    return flagged.groupBy("doc_id").applyInPandasWithState(
        carry, CARRY_OUT, CARRY_STATE, "append",
        "ProcessingTimeTimeout" if idle or forget else "NoTimeout")


# W5
def transcript_label_stream(transcripts: DataFrame, labels: DataFrame, delay: str = "10 minutes",
                            bound_s: int = RETENTION_S) -> DataFrame:
    """Left outer stream-stream join on (basename, request id) with
    watermarks on both sides and a time bound (the retention), so join state
    is dropped once no match can arrive; unmatched transcripts come out with
    status 500. Transcript and label body are carried on where present."""
    t = M.split_media_key(as_event_time(transcripts, "t_time").withColumnRenamed("key", "t_key"),
                          "t_key", M.TRANSCRIPT_KEY_RE, "").withWatermark("t_time", delay)
    lab = M.split_media_key(as_event_time(labels, "l_time").withColumnRenamed("key", "l_key"),
                            "l_key", M.LABELS_KEY_RE, "l_").withWatermark("l_time", delay)
    cond = ((t["base"] == lab["l_base"]) & (t["request_id"] == lab["l_request_id"])
            & (lab["l_time"] >= t["t_time"] - F.expr(f"INTERVAL {bound_s} SECONDS"))
            & (lab["l_time"] <= t["t_time"] + F.expr(f"INTERVAL {bound_s} SECONDS")))
    j = t.join(lab, cond, "leftOuter")
    carried = [F.col(c) if c in j.columns else F.lit(None).cast("string").alias(c) for c in ("transcript",)]
    body = F.col("body").alias("labels_body") if "body" in j.columns else F.lit(None).cast("string").alias("labels_body")
    return j.select("base", "request_id", "t_key", *carried, body,
                    F.when(F.col("l_key").isNull(), F.lit(500)).otherwise(F.lit(200)).alias("status"),
                    K.json_to_txt("t_key").alias("out_key"))


# W6
def session_stream(log: DataFrame, session: str = "session", ts: str = "ts", gap_s: int = 300,
                   delay: str = RETENTION) -> DataFrame:
    """Idle-TTL sessions in append mode; a session is final once the
    watermark passes its end."""
    s = as_event_time(log, ts).withWatermark(ts, delay)
    g = s.groupBy(session, F.session_window(F.col(ts), session_gap(gap_s)).alias("w")) \
        .agg(F.count(F.lit(1)).alias("n_events"), F.max(ts).alias("_last"))
    return g.select(session, F.col("w.start").alias("session_start"),
                    (F.col("_last") + F.expr(f"INTERVAL {gap_s} SECONDS")).alias("session_end"), "n_events")


# W7
def dedupe_upload_stream(uploads: DataFrame, keys=("session", "file_name"), ts: str = "ts",
                         delay: str = RETENTION) -> DataFrame:
    """A re-upload of a name already seen in the session (within the
    watermark delay) is skipped; state is bounded by the delay."""
    return as_event_time(uploads, ts).withWatermark(ts, delay).dropDuplicatesWithinWatermark(list(keys))


# W8 / S9
def idempotent_page_sink(path: str):
    """``foreachBatch`` function appending page text keyed by
    ``(doc_id, page_no)``. Each micro-batch has a folder of its own, named by
    the streaming query (whose id lives in the checkpoint) and the epoch, so a
    replayed batch rewrites the same files and a query with a new checkpoint,
    whose epochs start at 0 again, adds to what is there. ``run`` numbers the
    queries in the order of their first batch."""
    root = path.rstrip("/")

    def write(batch: DataFrame, epoch_id: int) -> None:
        spark = batch.sparkSession
        query = spark.sparkContext.getLocalProperty("sql.streaming.queryId") or "none"
        runs = {n.split("-", 1)[1]: n for n in children(spark, root) if n.startswith("run=")}
        name = runs.get(query) or f"run={len(runs):06d}-{query}"
        batch.select("doc_id", "page_no", "content").write.mode("overwrite").parquet(f"{root}/{name}/epoch={int(epoch_id)}")
    return write


def read_appended_pages(spark: SparkSession, path: str) -> DataFrame:
    """Current page text: the newest run and epoch win per ``(doc_id,
    page_no)``, so a page re-delivered in a later batch replaces, never
    duplicates."""
    p = spark.read.parquet(path)
    newest = F.struct(F.substring("run", 1, 6), F.col("epoch"))
    g = p.groupBy("doc_id", "page_no").agg(F.max_by("content", newest).alias("content"))
    return g
