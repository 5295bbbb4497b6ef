"""Registered queries: media (V1-V6)."""

from __future__ import annotations

from pyspark.sql import functions as F

from quire.functions import text as tx
from quire.operators import media as M
from quire.plans import fixtures as FX
from quire.plans.catalog import register
from quire.plans.sql_fixtures import first_sentence, labels_json_sql, with_ctes
from quire.sources import events as EV

NL = "chr(10)"


def _indent4_sql(frames: str) -> str:
    lab = ("CASE WHEN len(f.labels) = 0 THEN '[]' ELSE '[' || chr(10) || array_to_string(list_transform(f.labels, "
           "lambda l: '            \"' || l || '\"'), ',' || chr(10)) || chr(10) || '        ]' END")
    one = ("'    {' || chr(10) || '        \"Frame ' || CAST(f.frame_no AS VARCHAR) || '\": ' || " + lab +
           " || chr(10) || '    }'")
    return (f"CASE WHEN len({frames}) = 0 THEN '[]' ELSE '[' || chr(10) || array_to_string(list_transform("
            f"{frames}, lambda f: {one}), ',' || chr(10)) || chr(10) || ']' END")


@register("frame_labels", with_ctes("SELECT * FROM frame_lab", "frame_lab"))
def frame_labels(spark, sf):
    return M.frame_labels(FX.detections(spark, sf))


@register("frame_limit", with_ctes("SELECT * FROM frame_lab WHERE frame_no <= 3", "frame_lab"))
def frame_limit(spark, sf):
    return M.frame_labels(M.frame_limit(FX.detections(spark, sf), 3))


@register("video_labels", with_ctes(
    "SELECT video, n_frames, " + labels_json_sql("frames") + " AS labels_json FROM video_frames", "video_frames"))
def video_labels(spark, sf):
    return M.video_labels(FX.detections(spark, sf)).select("video", "n_frames", "labels_json")


_JOIN_SQL = """
tj AS (
  SELECT regexp_extract(t.key, '^(.*)_transcription_([0-9a-f]+)\\.json$', 1) AS base,
         regexp_extract(t.key, '^(.*)_transcription_([0-9a-f]+)\\.json$', 2) AS request_id,
         t.doc_id, t.key AS t_key, json_extract_string(t.body, '$.results.transcripts[0].transcript') AS transcript,
         l.body AS labels_body,
         CASE WHEN l.key IS NULL THEN 500 ELSE 200 END AS status, replace(t.key, '.json', '.txt') AS out_key
  FROM transcripts t LEFT JOIN label_files l
    ON regexp_extract(t.key, '^(.*)_transcription_([0-9a-f]+)\\.json$', 1)
       = regexp_extract(l.key, '^(.*)_labels_([0-9a-f]+)\\.json$', 1)
   AND regexp_extract(t.key, '^(.*)_transcription_([0-9a-f]+)\\.json$', 2)
       = regexp_extract(l.key, '^(.*)_labels_([0-9a-f]+)\\.json$', 2))"""


def _join_sql(body: str) -> str:
    s = with_ctes("SELECT 1", "transcripts", "label_files")
    return s[: s.rindex("SELECT 1")].rstrip() + ",\n" + _JOIN_SQL + "\n" + body


def _joined(spark, sf):
    t = EV.parse_transcript(FX.transcripts(spark, sf)).select("key", "transcript")
    return M.transcript_label_join(t, FX.label_files(spark, sf))


@register("transcript_label_join", _join_sql(
    "SELECT base, request_id, t_key, transcript, status, out_key FROM tj"))
def transcript_label_join(spark, sf):
    return _joined(spark, sf).select("base", "request_id", "t_key", "transcript", "status", "out_key")


@register("combined_report", _join_sql("""
SELECT base, request_id, 'Transcript:' || chr(10) || transcript || chr(10) || chr(10) || 'Video Labels:' || chr(10)
       || """ + _indent4_sql("v.frames") + """ || chr(10) || chr(10) || 'Model Insights:' || chr(10)
       || """ + first_sentence("transcript") + """ || chr(10) AS report
FROM tj JOIN video_frames v ON tj.doc_id // 10 = v.video WHERE status = 200"""))
def combined_report(spark, sf):
    j = _joined(spark, sf).where(F.col("status") == 200)
    frames = F.transform(F.from_json("labels_body", EV.FRAME_LABELS), lambda m: F.struct(
        F.regexp_extract(F.element_at(F.map_keys(m), 1), r"Frame (\d+)", 1).cast("int").alias("frame_no"),
        F.element_at(F.map_values(m), 1).alias("labels")))
    return j.select("base", "request_id",
                    M.combined_report(F.col("transcript"), frames, tx.first_sentence("transcript")).alias("report"))


@register("insight_requests", _join_sql("""
SELECT base, request_id, '""" + M.INSIGHT_PROMPT.split("{labels}")[0].replace("\n", "' || chr(10) || '") + """'
       || labels_body || '""" + M.INSIGHT_PROMPT.split("{labels}")[1].split("{transcript}")[0].replace("\n", "' || chr(10) || '")
    + """' || transcript || '""" + M.INSIGHT_PROMPT.split("{transcript}")[1].replace("\n", "' || chr(10) || '") + """' AS prompt
FROM tj WHERE status = 200"""))
def insight_requests(spark, sf):
    j = _joined(spark, sf).where(F.col("status") == 200)
    return j.select("base", "request_id", M.insight_request(F.col("labels_body"), F.col("transcript")).alias("prompt"))
