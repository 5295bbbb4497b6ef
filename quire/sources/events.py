"""Event and JSON-document scans.

All parsing is ``from_json`` / ``get_json_object`` in the JVM. A malformed
envelope is kept as an ``error`` row instead of failing the job.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quire.functions.keys import decode_key

# M2: object-created / queue envelope.
RECORD = T.StructType([
    T.StructField("s3", T.StructType([
        T.StructField("bucket", T.StructType([T.StructField("name", T.StringType())])),
        T.StructField("object", T.StructType([T.StructField("key", T.StringType())])),
    ])),
    T.StructField("body", T.StringType()),
    T.StructField("receiptHandle", T.StringType()),
])
ENVELOPE = T.StructType([T.StructField("Records", T.ArrayType(RECORD))])

# M3: resume message carried in a queue record body.
RESUME = T.StructType([
    T.StructField("source_bucket", T.StringType()),
    T.StructField("source_key", T.StringType()),
    T.StructField("page_counter", T.IntegerType()),
    T.StructField("previous_text", T.StringType()),
    T.StructField("s3_output_key", T.StringType()),
])

# A resume message needs every key (a value may be null); the first absent
# one names the error.
RESUME_REQUIRED = ("source_key", "source_bucket", "page_counter", "previous_text", "s3_output_key")

# M6: frame labels, a list of single-key maps.
FRAME_LABELS = T.ArrayType(T.MapType(T.StringType(), T.ArrayType(T.StringType())))


def parse_events(df: DataFrame, body: str = "body") -> DataFrame:
    """S3: one row per record with ``kind`` in object / resume / error.

    Every record is read (not only the first); keys are URL-decoded once.
    """
    env = F.from_json(F.col(body), ENVELOPE)
    keep = [c for c in df.columns if c != body]
    x = df.select(*keep, F.posexplode_outer(env["Records"]).alias("rec_no", "rec"))
    rec = F.col("rec")
    kind = (F.when(rec.isNull(), F.lit("error"))
            .when(rec["s3"].isNotNull(), F.lit("object"))
            .when(rec["body"].isNotNull(), F.lit("resume"))
            .otherwise(F.lit("error")))
    return x.select(*keep, "rec_no", kind.alias("kind"),
                    rec["s3"]["bucket"]["name"].alias("bucket"),
                    decode_key(rec["s3"]["object"]["key"]).alias("key"),
                    rec["body"].alias("message"))


def parse_resume(events: DataFrame, message: str = "message") -> DataFrame:
    """Resume records -> M3 columns plus an ``error`` column (bad_json /
    ``missing_`` and the first key that is absent / NULL). Both object keys
    are URL-decoded."""
    keep = [c for c in events.columns if c not in (message, "kind", "bucket", "key")]
    m = F.from_json(F.col(message), RESUME)
    x = events.where(F.col("kind") == "resume").select(*keep, m.alias("m"), F.json_object_keys(message).alias("_keys"))
    m = F.col("m")
    all_null = F.lit(True)
    for f in RESUME.fieldNames():
        all_null = all_null & m[f].isNull()
    err = F.when(m.isNull() | all_null, F.lit("bad_json"))
    for f in RESUME_REQUIRED:
        err = err.when(~F.array_contains("_keys", f), F.lit("missing_" + f))
    return x.select(*keep, m["source_bucket"].alias("source_bucket"),
                    decode_key(m["source_key"]).alias("source_key"),
                    m["page_counter"].alias("page_counter"),
                    m["previous_text"].alias("previous_text"),
                    decode_key(m["s3_output_key"]).alias("s3_output_key"),
                    err.alias("error"))


def parse_transcript(df: DataFrame, body: str = "body") -> DataFrame:
    """M7 JSON -> transcript text (NULL when absent or malformed)."""
    return df.withColumn("transcript",
                         F.get_json_object(F.col(body), "$.results.transcripts[0].transcript"))


def parse_frame_labels(df: DataFrame, body: str = "body") -> DataFrame:
    """``[{"Frame n": [labels]}, ...]`` -> (frame_no, label_no, label).

    A frame with an empty label list yields one row with NULL label so the
    frame count survives. A malformed body, or one without frames, yields one
    row with NULLs only.
    """
    keep = [c for c in df.columns if c != body]
    frames = df.select(*keep, F.explode_outer(F.from_json(F.col(body), FRAME_LABELS)).alias("m"))
    kv = frames.select(*keep, F.explode_outer("m").alias("frame", "labels"))
    out = kv.select(*keep,
                    F.regexp_extract("frame", r"Frame (\d+)", 1).try_cast("int").alias("frame_no"),
                    F.posexplode_outer("labels").alias("label_no", "label"))
    return out
