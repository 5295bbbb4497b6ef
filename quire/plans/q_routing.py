"""Registered queries: scans, envelopes, routing, key algebra, filters and
scalar checks (S2-S6, P1-P13, P15)."""

from __future__ import annotations

from pyspark.sql import functions as F

from quire.functions import keys as K
from quire.functions import text as tx
from quire.functions.filters import compile_filter
from quire.operators import routing as R
from quire.plans import fixtures as FX
from quire.plans.catalog import register
from quire.plans.sql_fixtures import last_line, url_decode, with_ctes
from quire.sources import events as EV
from quire.sources.tables import table

PREFIXES = ["raw/src1/", "raw/src12/"]
EQUALS_FILTER = {"equals": {"key": "exposure", "value": "external"}}
RANGE_FILTER = {"andAll": [
    {"greaterThan": {"key": "created_date_epoch", "value": 1704067200 + 86400 * 30}},
    {"lessThan": {"key": "created_date_epoch", "value": 1704067200 + 86400 * 200}},
    {"startsWith": {"key": "title", "value": "E"}},
]}
ARN_PREFIX = "arn:cloud:store:::"


@register("inclusion_prefixes", with_ctes("""
SELECT doc_id, raw_key FROM object_keys
WHERE starts_with(raw_key, 'raw/src1/') OR starts_with(raw_key, 'raw/src12/')""", "object_keys"))
def inclusion_prefixes(spark, sf):
    return R.with_prefixes(FX.object_keys(spark, sf), PREFIXES).select("doc_id", "raw_key")


_EVENTS_SQL = """
ev AS (SELECT doc_id, CASE WHEN json_valid(body) THEN json_transform(body,
  '{"Records":[{"s3":{"bucket":{"name":"VARCHAR"},"object":{"key":"VARCHAR"}},"body":"VARCHAR","receiptHandle":"VARCHAR"}]}')
  END AS j FROM event_json),
recs AS (
  SELECT doc_id, CAST(i - 1 AS INTEGER) AS rec_no, j.Records[i] AS rec
  FROM (SELECT doc_id, j, unnest(range(1, len(j.Records) + 1)) AS i FROM ev
        WHERE j IS NOT NULL AND len(j.Records) > 0) x
  UNION ALL
  SELECT doc_id, NULL, NULL FROM ev WHERE j IS NULL OR j.Records IS NULL OR len(j.Records) = 0),
parsed AS (
  SELECT doc_id, rec_no,
         CASE WHEN rec IS NULL THEN 'error' WHEN rec.s3 IS NOT NULL THEN 'object'
              WHEN rec.body IS NOT NULL THEN 'resume' ELSE 'error' END AS kind,
         rec.s3.bucket.name AS bucket, """ + url_decode("rec.s3.object.key") + """ AS key,
         rec.body AS message
  FROM recs)"""


def _events_sql(body: str) -> str:
    s = with_ctes("SELECT 1", "event_json")
    head = s[: s.rindex("SELECT 1")].rstrip()
    return head + ",\n" + _EVENTS_SQL + "\n" + body


@register("parse_events", _events_sql("SELECT * FROM parsed"))
def parse_events(spark, sf):
    return EV.parse_events(FX.event_json(spark, sf))


@register("parse_resume", _events_sql("""
SELECT doc_id, rec_no, m.source_bucket AS source_bucket, """ + url_decode("m.source_key") + """ AS source_key,
       m.page_counter AS page_counter, m.previous_text AS previous_text, """ + url_decode("m.s3_output_key") + """ AS s3_output_key,
       CASE WHEN m IS NULL OR (m.source_bucket IS NULL AND m.source_key IS NULL AND m.page_counter IS NULL
                               AND m.previous_text IS NULL AND m.s3_output_key IS NULL) THEN 'bad_json'
            """ + " ".join(f"WHEN NOT list_contains(k, '{f}') THEN 'missing_{f}'" for f in EV.RESUME_REQUIRED) + """ END AS error
FROM (SELECT doc_id, rec_no, CASE WHEN json_valid(message) THEN json_keys(message) END AS k, CASE WHEN json_valid(message) THEN json_transform(message,
        '{"source_bucket":"VARCHAR","source_key":"VARCHAR","page_counter":"INTEGER","previous_text":"VARCHAR","s3_output_key":"VARCHAR"}')
        END AS m
      FROM parsed WHERE kind = 'resume') r"""))
def parse_resume(spark, sf):
    return EV.parse_resume(EV.parse_events(FX.event_json(spark, sf)))


@register("parse_transcript", with_ctes("""
SELECT key, json_extract_string(body, '$.results.transcripts[0].transcript') AS transcript
FROM transcripts""", "transcripts"))
def parse_transcript(spark, sf):
    return EV.parse_transcript(FX.transcripts(spark, sf)).select("key", "transcript")


@register("parse_frame_labels", with_ctes("""
SELECT key, CAST(regexp_extract(frame, 'Frame (\\d+)', 1) AS INTEGER) AS frame_no,
       CASE WHEN len(labels) = 0 THEN NULL ELSE CAST(i - 1 AS INTEGER) END AS label_no,
       CASE WHEN len(labels) = 0 THEN NULL ELSE labels[i] END AS label
FROM (SELECT key, frame, labels, unnest(range(1, greatest(len(labels), 1) + 1)) AS i
      FROM (SELECT key, json_keys(f)[1] AS frame,
                   CAST(json_extract(f, '$."' || json_keys(f)[1] || '"') AS VARCHAR[]) AS labels
            FROM (SELECT key, unnest(CAST(body AS JSON[])) AS f FROM label_files) a) b) c""", "label_files"))
def parse_frame_labels(spark, sf):
    return EV.parse_frame_labels(FX.label_files(spark, sf).select("key", "body"))


@register("route_by_suffix", with_ctes("""
SELECT doc_id, raw_key, CASE
  WHEN ends_with(raw_key, '.pdf') THEN 'pdf'
  WHEN ends_with(raw_key, '.ppt') OR ends_with(raw_key, '.pptx') OR ends_with(raw_key, '.docx')
    OR ends_with(raw_key, '.xlsx') OR ends_with(raw_key, '.xls') OR ends_with(raw_key, '.excel')
    OR ends_with(raw_key, '.html') THEN 'office'
  WHEN ends_with(raw_key, '.mp4') THEN 'video' END AS route
FROM object_keys""", "object_keys"))
def route_by_suffix(spark, sf):
    return R.route_objects(FX.object_keys(spark, sf)).select("doc_id", "raw_key", "route")


@register("conversion_profile", with_ctes("""
SELECT doc_id, raw_key, CASE
  WHEN lower(e) IN ('.doc', '.docx') THEN 'doc'
  WHEN lower(e) IN ('.xls', '.xlsx', '.csv') THEN 'sheet'
  WHEN lower(e) IN ('.ppt', '.pptx') THEN 'slide' ELSE 'other' END AS profile
FROM (SELECT doc_id, raw_key, regexp_extract(string_split(raw_key, '/')[-1], '(\\.[^./]*)$', 1) AS e
      FROM object_keys) x""", "object_keys"))
def conversion_profile(spark, sf):
    return FX.object_keys(spark, sf).select("doc_id", "raw_key", K.conversion_profile("raw_key").alias("profile"))


@register("upload_type", with_ctes("""
SELECT doc_id, name, CASE string_split(lower(name), '.')[-1]
  WHEN 'csv' THEN 'csv' WHEN 'doc' THEN 'doc' WHEN 'docx' THEN 'docx' WHEN 'htm' THEN 'html'
  WHEN 'html' THEN 'html' WHEN 'md' THEN 'md' WHEN 'pdf' THEN 'pdf' WHEN 'txt' THEN 'txt'
  WHEN 'xls' THEN 'sheet' WHEN 'xlsx' THEN 'sheet' ELSE 'unsupported' END AS upload_type
FROM (SELECT doc_id, string_split(""" + url_decode("raw_key") + """, '/')[-1] AS name FROM object_keys) x""",
                                   "object_keys"))
def upload_type(spark, sf):
    k = FX.object_keys(spark, sf).select("doc_id", K.basename(K.decode_key("raw_key")).alias("name"))
    return k.select("doc_id", "name", K.upload_type("name").alias("upload_type"))


@register("decode_keys", with_ctes(
    "SELECT doc_id, raw_key, " + url_decode("raw_key") + " AS key FROM object_keys", "object_keys"))
def decode_keys(spark, sf):
    return FX.object_keys(spark, sf).select("doc_id", "raw_key", K.decode_key("raw_key").alias("key"))


@register("derive_keys", with_ctes("""
SELECT doc_id, key, base AS basename, key || '.txt' AS txt_key,
       substr(key, 1, length(key) - length(base)) || regexp_replace(base, '(\\.[^./]*)$', '') || '.pdf' AS pdf_key,
       'converted/' || regexp_replace(base, '(\\.[^./]*)$', '') || '.pdf' AS converted_key,
       replace(t_key, '.json', '.txt') AS report_key,
       string_split('""" + ARN_PREFIX + """' || bucket, ':')[-1] AS bucket
FROM (SELECT o.doc_id, o.bucket, """ + url_decode("o.raw_key") + """ AS key,
             string_split(""" + url_decode("o.raw_key") + """, '/')[-1] AS base, t.key AS t_key
      FROM object_keys o JOIN transcripts t ON o.doc_id = t.doc_id) x""", "object_keys", "transcripts"))
def derive_keys(spark, sf):
    o = FX.object_keys(spark, sf).select("doc_id", "bucket", K.decode_key("raw_key").alias("key"))
    t = FX.transcripts(spark, sf).select("doc_id", F.col("key").alias("t_key"))
    j = o.join(t, "doc_id")
    return j.select("doc_id", "key", K.basename("key").alias("basename"), K.txt_key("key").alias("txt_key"),
                    K.pdf_key("key").alias("pdf_key"), K.converted_key("key").alias("converted_key"),
                    K.json_to_txt("t_key").alias("report_key"),
                    K.bucket_from_arn(F.concat(F.lit(ARN_PREFIX), "bucket")).alias("bucket"))


@register("page_ordinal", with_ctes("""
SELECT doc_id, name, page_no,
       CAST(row_number() OVER (PARTITION BY doc_id ORDER BY page_no ASC NULLS LAST, name) AS INTEGER) AS ord
FROM (SELECT doc_id, name, TRY_CAST(nullif(regexp_extract(name, 'page_(\\d+)\\.png', 1), '') AS INTEGER) AS page_no
      FROM page_names) x""", "page_names"))
def page_ordinal(spark, sf):
    return R.page_order(FX.page_names(spark, sf)).select("doc_id", "name", "page_no", "ord")


@register("filter_equals", with_ctes(
    "SELECT * FROM kb_meta WHERE exposure = 'external'", "kb_meta"))
def filter_equals(spark, sf):
    return FX.kb_meta(spark, sf).where(compile_filter(EQUALS_FILTER))


@register("filter_range_and_prefix", with_ctes(f"""
SELECT * FROM kb_meta WHERE created_date_epoch > {1704067200 + 86400 * 30}
  AND created_date_epoch < {1704067200 + 86400 * 200} AND starts_with(title, 'E')""", "kb_meta"))
def filter_range_and_prefix(spark, sf):
    return FX.kb_meta(spark, sf).where(compile_filter(RANGE_FILTER))


@register("parse_verdict", """
SELECT conv_id, turn, coalesce(contains(text, 'Yes'), false) AS verdict FROM conversations""")
def parse_verdict(spark, sf):
    c = table(spark, sf, "conversations")
    return c.select("conv_id", "turn", tx.contains_yes("text").alias("verdict"))


@register("last_line", with_ctes(
    "SELECT doc_id, " + last_line("output") + " AS answer FROM answers_raw", "answers_raw"))
def last_line_q(spark, sf):
    return FX.answers_raw(spark, sf).select("doc_id", tx.last_line("output").alias("answer"))


@register("answer_or_fallback", with_ctes(
    "SELECT doc_id, coalesce(" + last_line("output") + ", '" + R.FALLBACK_ANSWER + "') AS answer FROM answers_raw",
    "answers_raw"))
def answer_or_fallback(spark, sf):
    return R.answer_or_fallback(FX.answers_raw(spark, sf)).select("doc_id", "answer")


@register("validate_calls", with_ctes("""
SELECT call_id, function, missing, unknown, coalesce(len(missing) = 0 AND len(unknown) = 0, false) AS valid
FROM (SELECT call_id, function,
             list_sort(list_filter(req, lambda r: NOT list_contains(param_keys, r))) AS missing,
             list_sort(list_filter(param_keys, lambda p: NOT list_contains(list_concat(req, opt), p))) AS unknown
      FROM (SELECT call_id, function, param_keys,
                   CASE function WHEN 'createClaim' THEN ['claimType', 'policyNumber']
                                 WHEN 'gatherEvidence' THEN ['claimId']
                                 WHEN 'sendReminder' THEN ['claimId'] END AS req,
                   CASE function WHEN 'sendReminder' THEN ['reminderType'] ELSE []::VARCHAR[] END AS opt
            FROM calls) a) b""", "calls"))
def validate_calls(spark, sf):
    return R.validate_calls(FX.calls(spark, sf)).select("call_id", "function", "missing", "unknown", "valid")


_MODELS = list(R.MODEL_DIMS) + ["unknown-model"]


@register("embedding_dim_check", """
SELECT vec_id, model, expected_dim, dim,
       CASE WHEN expected_dim IS NULL THEN 'unknown_model' WHEN dim = expected_dim THEN 'ok'
            ELSE 'dim_mismatch' END AS status
FROM (SELECT vec_id, model, CAST(len(embedding) AS INTEGER) AS dim,
             CASE model """ + " ".join(f"WHEN '{m}' THEN {d}" for m, d in R.MODEL_DIMS.items()) + """ END AS expected_dim
      FROM (SELECT vec_id, embedding, """ + str(_MODELS) + f"""[(vec_id % {len(_MODELS)}) + 1] AS model
            FROM embeddings) a) b""")
def embedding_dim_check(spark, sf):
    e = table(spark, sf, "embeddings")
    model = F.element_at(F.array(*map(F.lit, _MODELS)), (F.col("vec_id") % len(_MODELS) + 1).cast("int"))
    return R.embedding_dim_check(e.select("vec_id", model.alias("model"), "embedding")) \
        .select("vec_id", "model", "expected_dim", "dim", "status")


@register("eval_subset", with_ctes("SELECT * FROM golden ORDER BY qid LIMIT 10", "golden"))
def eval_subset(spark, sf):
    return R.eval_subset(FX.golden(spark, sf), 10)
