"""Sources and sinks on hand-written files."""

import os
import tempfile

from pyspark.sql import functions as F

from quire.plans import fixtures as FX
from quire.sources import objects as O
from quire.sources import sinks as SK
from tests.conftest import SF_SMALL


def test_scan_objects_by_suffix(spark):
    d = tempfile.mkdtemp(prefix="quire-io-")
    os.makedirs(os.path.join(d, "a", "b"))
    for n in ("x.pdf", "a/y.mp4", "a/b/z.txt", "a/b/w.pdf"):
        with open(os.path.join(d, n), "wb") as f:
            f.write(b"bytes of " + n.encode())
    got = sorted(os.path.basename(r.path) for r in O.scan_objects(spark, d, [".pdf", ".mp4"]).collect())
    assert got == ["w.pdf", "x.pdf", "y.mp4"]
    one = O.scan_objects(spark, d, [".txt"]).first()
    assert one.content == b"bytes of a/b/z.txt" and one.length == len(one.content)


def test_golden_csv_keeps_strings(spark):
    d = tempfile.mkdtemp(prefix="quire-io-")
    p = os.path.join(d, "golden.csv")
    with open(p, "w") as f:
        f.write('question,ground_truth\n"How many wheels does the cart have?",4\n'
                '"What is the limit, in units?",100\n"Who signs the form?","The applicant, in ink."\n'
                '"Which colour is the lid?",Blue\n')
    rows = O.read_golden(spark, p).collect()
    assert [r.ground_truth for r in rows] == ["4", "100", "The applicant, in ink.", "Blue"]
    assert dict(O.read_golden(spark, p).dtypes) == {"question": "string", "ground_truth": "string"}


def test_tabular_source_all_strings(spark):
    d = tempfile.mkdtemp(prefix="quire-io-")
    p = os.path.join(d, "sheet.csv")
    with open(p, "w") as f:
        f.write("a,b\n1,x\n2,y\n")
    df = O.read_tabular(spark, p)
    assert df.dtypes == [("a", "string"), ("b", "string")] and df.count() == 2


def test_tabular_parquet_is_all_strings_too(spark):
    p = os.path.join(tempfile.mkdtemp(prefix="quire-io-"), "sheet")
    spark.createDataFrame([(1, 2.5), (None, 3.0)], "a int, b double").write.parquet(p)
    df = O.read_tabular(spark, p, "parquet")
    assert df.dtypes == [("a", "string"), ("b", "string")]
    assert sorted((r.a or "", r.b) for r in df.collect()) == [("", "3.0"), ("1", "2.5")]


def test_experiment_serials_increase(spark):
    d = os.path.join(tempfile.mkdtemp(prefix="quire-io-"), "experiments")
    row = spark.createDataFrame([("HYBRID", 0.5)], "kb_search_type string, faithfulness double")
    assert SK.append_experiment(row, d) == 1
    assert SK.append_experiment(row, d) == 2
    assert sorted(r.serial for r in spark.read.parquet(d).collect()) == [1, 2]


def test_experiment_log_errors_are_raised(spark):
    import pytest
    d = os.path.join(tempfile.mkdtemp(prefix="quire-io-"), "broken")
    os.makedirs(d)
    with open(os.path.join(d, "part-0.parquet"), "w") as f:
        f.write("not parquet")
    with pytest.raises(Exception):
        SK.next_serial(spark, d)


def test_keyed_store_rewritten_from_itself(spark):
    d = os.path.join(tempfile.mkdtemp(prefix="quire-io-"), "store")
    SK.write_keyed_store(spark.createDataFrame([(1, "a"), (2, "b")], "k long, v string"), d)
    for i in range(2):
        now = SK.read_keyed_store(spark, d)
        SK.write_keyed_store(now.union(spark.createDataFrame([(10 + i, "n")], now.schema)), d)
    assert sorted(r.k for r in SK.read_keyed_store(spark, d).collect()) == [1, 2, 10, 11]


def test_an_update_of_one_key_writes_one_bucket(spark):
    d = os.path.join(tempfile.mkdtemp(prefix="quire-io-"), "store")
    schema = "claim string, at int, note string"
    SK.write_keyed_store(spark.createDataFrame([(f"c{i}", 1, "old") for i in range(200)], schema), d, "claim", buckets=16)
    before = set(SK._store(spark, d)[1].values())
    assert len(before) == 16
    assert SK.update_keyed_store(spark.createDataFrame([("c7", 2, "new"), ("c7", 1, "late")], schema), d, "claim", "at") == 1
    after = set(SK._store(spark, d)[1].values())
    assert len(after - before) == 1 and len(after) == 16      # fifteen buckets are shared with the version before
    assert SK.update_keyed_store(spark.createDataFrame([("c8", 0, "older"), ("x", 5, "added")], schema), d, "claim", "at") in (1, 2)
    got = {r.claim: (r["at"], r.note) for r in SK.read_keyed_store(spark, d).collect()}
    assert len(got) == 201 and got["c7"] == (2, "new") and got["c8"] == (1, "old") and got["x"] == (5, "added")
    assert SK.update_keyed_store(spark.createDataFrame([], schema), d, "claim", "at") == 0


def test_kb_table_round_trip(spark):
    d = os.path.join(tempfile.mkdtemp(prefix="quire-io-"), "kb")
    recs = FX.kb_chunks(spark, SF_SMALL)
    SK.write_kb_table(recs, d, n_buckets=4)
    back = spark.read.parquet(d).drop("bucket")
    assert back.count() == recs.count()
    assert back.select("chunk_id").distinct().count() == recs.count()
    assert back.where(F.col("metadata").contains('"source_uri":"raw/')).count() == recs.count()


def test_document_label_and_report_sinks(spark):
    import json

    from quire.operators import media as M
    from quire.operators import pages as PG
    d = tempfile.mkdtemp(prefix="quire-io-")
    docs = PG.assemble_document(FX.doc_pages(spark, SF_SMALL)).withColumn(
        "key", F.concat(F.col("doc_id").cast("string"), F.lit(".txt")))
    SK.write_documents(docs, os.path.join(d, "docs"))
    back = spark.read.parquet(os.path.join(d, "docs"))
    assert back.count() == docs.count() and back.columns == ["key", "text"]
    labels = M.video_labels(FX.detections(spark, SF_SMALL)).select("video", "labels_json")
    SK.write_labels_json(labels, os.path.join(d, "labels"))
    row = spark.read.json(os.path.join(d, "labels")).orderBy("video").first()
    assert isinstance(json.loads(row.labels_json), list)
    rep = labels.select(F.concat(F.lit("Video Labels:\n"), F.col("labels_json")).alias("report"))
    SK.write_report_text(rep, os.path.join(d, "reports"))
    assert spark.read.text(os.path.join(d, "reports")).count() >= labels.count()
