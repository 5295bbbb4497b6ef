"""Media operators (V1-V6): frame labels, per-video label documents,
transcript/label join and the combined report.

Detection and transcription are delegated; the inputs are a detections
table ``(video, frame_no, label, confidence)`` and transcript/label JSON
objects keyed like the ingestion functions write them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from quire.functions import keys as K

MIN_CONFIDENCE = 70.0
MAX_LABELS = 10
TRANSCRIPT_KEY_RE = r"^(.*)_transcription_([0-9a-f]+)\.json$"
LABELS_KEY_RE = r"^(.*)_labels_([0-9a-f]+)\.json$"


def frame_labels(det: DataFrame, min_confidence: float = MIN_CONFIDENCE,
                 max_labels: int = MAX_LABELS) -> DataFrame:
    """V1: labels with confidence >= min, at most ``max_labels`` a frame,
    ranked by confidence desc then label. Spark plans the rank filter as a
    window group limit, so each task pre-trims before the shuffle."""
    w = W.partitionBy("video", "frame_no").orderBy(F.col("confidence").desc(), F.col("label"))
    return (det.where(F.col("confidence") >= min_confidence)
            .withColumn("rank", F.row_number().over(w))
            .where(F.col("rank") <= max_labels))


def frame_limit(det: DataFrame, n: int) -> DataFrame:
    """V2: only the first ``n`` frames of each video."""
    return det.where(F.col("frame_no") <= n)


def _json_string(s: Column) -> Column:
    """A JSON string literal, escaped."""
    one = F.to_json(F.array(s))
    return F.substring(one, F.lit(2), F.length(one) - 2)


def _quoted(arr: Column) -> Column:
    return F.transform(arr, _json_string)


def labels_json(frames: Column) -> Column:
    """``json.dumps`` (default separators) of ``[{"Frame n": [labels]}, ...]``
    from ``array<struct<frame_no, labels>>`` sorted by frame."""
    one = F.transform(frames, lambda f: F.concat(
        F.lit('{"Frame '), f["frame_no"].cast("string"), F.lit('": ['),
        F.array_join(_quoted(f["labels"]), ", "), F.lit("]}")))
    return F.concat(F.lit("["), F.array_join(one, ", "), F.lit("]"))


def labels_json_indent4(frames: Column) -> Column:
    """``json.dumps(..., indent=4)`` of the same list (Spark's pretty JSON
    uses two spaces and a spaced colon, so it is built here)."""
    def lab(f):
        ls = f["labels"]
        return F.when(F.size(ls) == 0, F.lit("[]")).otherwise(F.concat(
            F.lit("[\n"),
            F.array_join(F.transform(ls, lambda l: F.concat(F.lit("            "), _json_string(l))), ",\n"),
            F.lit("\n        ]")))
    one = F.transform(frames, lambda f: F.concat(
        F.lit('    {\n        "Frame '), f["frame_no"].cast("string"), F.lit('": '), lab(f), F.lit("\n    }")))
    return F.when(F.size(frames) == 0, F.lit("[]")).otherwise(
        F.concat(F.lit("[\n"), F.array_join(one, ",\n"), F.lit("\n]")))


def video_frames(det: DataFrame, min_confidence: float = MIN_CONFIDENCE,
                 max_labels: int = MAX_LABELS) -> DataFrame:
    """Per video: every analysed frame (also those with no label) with its
    ranked labels, as ``array<struct<frame_no, labels>>``."""
    labs = frame_labels(det, min_confidence, max_labels)
    frames = det.select("video", "frame_no").distinct()
    per_frame = (frames.join(labs.select("video", "frame_no", "rank", "label"), ["video", "frame_no"], "left")
                 .groupBy("video", "frame_no")
                 .agg(F.transform(F.sort_array(F.collect_list(
                     F.when(F.col("label").isNotNull(), F.struct("rank", "label")))),
                     lambda x: x["label"]).alias("labels")))
    return (per_frame.groupBy("video")
            .agg(F.sort_array(F.collect_list(F.struct("frame_no", "labels"))).alias("frames"))
            .withColumn("n_frames", F.size("frames")))


def video_labels(det: DataFrame, **kw) -> DataFrame:
    """V3: labels document per video plus frame count."""
    v = video_frames(det, **kw)
    return v.select("video", "n_frames", labels_json("frames").alias("labels_json"), "frames")


def split_media_key(df: DataFrame, key: str, pattern: str, prefix: str) -> DataFrame:
    """Anchored parse of ``{base}_{kind}_{request}.json`` keys (not the
    replace-every-occurrence derivation)."""
    return (df.withColumn(f"{prefix}base", F.regexp_extract(F.col(key), pattern, 1))
            .withColumn(f"{prefix}request_id", F.regexp_extract(F.col(key), pattern, 2)))


def transcript_label_join(transcripts: DataFrame, label_files: DataFrame) -> DataFrame:
    """V4: every transcript with its frame-label file matched on
    ``(basename, request id)``; a missing label file gives status 500."""
    t = split_media_key(transcripts.select(F.col("key").alias("t_key"), F.col("transcript")),
                        "t_key", TRANSCRIPT_KEY_RE, "")
    lab = split_media_key(label_files.select(F.col("key").alias("l_key"), F.col("body").alias("labels_body")),
                          "l_key", LABELS_KEY_RE, "")
    j = t.join(lab, ["base", "request_id"], "left")
    return j.select("base", "request_id", "t_key", "transcript", "labels_body",
                    F.when(F.col("l_key").isNull(), F.lit(500)).otherwise(F.lit(200)).alias("status"),
                    K.json_to_txt("t_key").alias("out_key"))


def combined_report(transcript: Column, frames: Column, insights: Column,
                    insights_title: str = "Model Insights") -> Column:
    """V5: ``Transcript / Video Labels (indent 4) / Insights`` text. The last
    section's title names the model's service; callers pass theirs."""
    return F.concat(F.lit("Transcript:\n"), transcript, F.lit("\n\nVideo Labels:\n"),
                    labels_json_indent4(frames), F.lit(f"\n\n{insights_title}:\n"), insights, F.lit("\n"))


# Own wording of the insight request (the model is delegated).
INSIGHT_PROMPT = ("Video analysis. Labels detected per frame: {labels}.\n"
                  "Transcript of the audio: {transcript}.\n"
                  "Summarise what happens in the video and the audio and give insights that use both.")


def insight_request(labels: Column, transcript: Column) -> Column:
    """V6: the insight prompt from the compact labels JSON and transcript."""
    a, rest = INSIGHT_PROMPT.split("{labels}")
    b, c = rest.split("{transcript}")
    return F.concat(F.lit(a), labels, F.lit(b), transcript, F.lit(c))
