from __future__ import annotations

import json

import pandas as pd
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusflow.operators import eligibility
from corpusflow.plans import ingest, synthesis
from corpusflow.sources import readers, writers
from corpusflow.sources.commit_log import read_table
from corpusflow.streaming import ledger as streams


def test_jsonl(spark, tmp_path):
    (tmp_path / "a.jsonl").write_text('{"a":1,"b":"x"}\n\n   \n{"a":2,"b":null}\n')
    schema = T.StructType([T.StructField("a", T.LongType(), False), T.StructField("b", T.StringType())])
    assert sorted(tuple(r) for r in readers.read_jsonl(spark, str(tmp_path / "a.jsonl"), schema).collect()) == [(1, "x"), (2, None)]
    for n, (bad, code) in enumerate((('{"a":1,"a":2}', "DUPLICATE_JSON_KEY"), ('{"a":1,"c":2}', "UNKNOWN_FIELD"), ('{"b":"x"}', "FIELD_MISSING:a"), ("[1]", "JSON_ROOT_NOT_OBJECT"))):
        path = tmp_path / f"bad{n}.jsonl"
        path.write_text('{"a":1,"b":"x"}\n' + bad + "\n")
        with pytest.raises(eligibility.ManifestError, match=f"{code}: .*bad{n}.jsonl:2$"):
            readers.read_jsonl(spark, str(path), schema)
        assert readers.read_jsonl(spark, str(path), schema, strict=False).count() == 1


def test_first_bad_line_is_named(spark, tmp_path):
    schema = T.StructType([T.StructField("a", T.LongType(), False)])
    lines = ['{"a":%d}' % k if k % 7 else "" for k in range(20_000)]
    lines[12_345] = "no json"
    lines[17_000] = "[]"
    (tmp_path / "long.jsonl").write_text("\n".join(lines))
    (tmp_path / "a.jsonl").write_text('{"a":1}\n')
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    try:
        with pytest.raises(eligibility.ManifestError, match="INVALID_JSON: .*long.jsonl:12346$"):
            readers.read_jsonl(spark, str(tmp_path), schema)
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_metadata_header_is_parsed(spark, tmp_path):
    path = tmp_path / "m.csv"
    path.write_text('"ImageID","Author, full","License"\n01,x,y\n')
    assert readers.read_metadata(spark, str(path), ["ImageID", "Author, full"]).first().asDict() == {"ImageID": "01", "Author, full": "x", "License": "y"}


def test_metadata_csv(spark, tmp_path):
    path = tmp_path / "m.csv"
    path.write_text('ImageID,Author,License\n01,"Doe, ""J""",x\n02,,y\n')
    got = [tuple(r) for r in readers.read_metadata(spark, str(path), ["ImageID", "License"]).collect()]
    assert got == [("01", 'Doe, "J"', "x"), ("02", "", "y")]
    for text, code in (("ImageID,Author\n", "missing"), ("ImageID,License,License\n", "repeated")):
        path.write_text(text)
        with pytest.raises(eligibility.ManifestError, match=code):
            readers.read_metadata(spark, str(path), ["ImageID", "License"])


def test_yaml(tmp_path):
    path = tmp_path / "c.yaml"
    path.write_text("a: 1\nb:\n  c: [1, 2]\n")
    assert readers.load_yaml(path) == {"a": 1, "b": {"c": [1, 2]}}
    for bad in ("a: 1\na: 2\n", "1: x\n"):
        path.write_text(bad)
        with pytest.raises(eligibility.ManifestError):
            readers.load_yaml(path)


def test_images_and_digests(spark, tmp_path):
    (tmp_path / "root" / "d").mkdir(parents=True)
    (tmp_path / "root" / "d" / "a.jpg").write_bytes(b"abc")
    wanted = spark.createDataFrame([("d/a.jpg",), ("../x",), ("d/none.jpg",)], "image_path string")
    got = {r["image_path"]: (r["content"], r["reason"]) for r in readers.read_images(spark, str(tmp_path / "root"), wanted).collect()}
    assert bytes(got["d/a.jpg"][0]) == b"abc" and got["d/a.jpg"][1] is None and got["../x"] == (None, "IMAGE_PATH_ESCAPE") and got["d/none.jpg"] == (None, "IMAGE_NOT_FILE")
    assert readers.file_digests(spark, str(tmp_path / "root")).first()["sha256"] == "ba7816bf8f01cfea414140de5dae2223b00361a396177a9cb410ff61f20015ad"


def test_fixtures(spark):
    f = readers.fixtures(spark, ["en", "ja"], 3, 7)
    assert f.count() == 2 * 8 * 2 * 3 * 2 == f.select("fixture_id").distinct().count()
    assert f.where("expected_accept").count() * 2 == f.count()


def test_writers(spark, tmp_path):
    df = spark.createDataFrame([(1, "é", None)], "b long, a string, c string")
    assert writers.json_lines(df).first()[0] == '{"a":"é","b":1,"c":null}'
    assert writers.json_lines(df, spaced=True).first()[0] == '{"b": 1, "a": "é", "c": null}'
    odd = spark.sql("select 1.5D as z, named_struct('b', 1, 'a', 'x') as s, array('é', null) as l, true as t")
    assert writers.json_lines(odd).first()[0] == '{"l":["é",null],"s":{"a":"x","b":1},"t":true,"z":1.5}'
    plain = odd.select("t", "l", F.lit("a\"/\n\u2028\x01\\").alias("q"))
    assert writers.json_lines(plain).first()[0] == json.dumps({"l": ["é", None], "q": "a\"/\n\u2028\x01\\", "t": True}, ensure_ascii=False, separators=(",", ":"))
    writers.write_jsonl(df, str(tmp_path / "out"))
    with pytest.raises(Exception, match="PATH_ALREADY_EXISTS"):
        writers.write_jsonl(df, str(tmp_path / "out"))
    writers.write_json({"b": 1, "a": [2]}, tmp_path / "r.json")
    assert json.loads((tmp_path / "r.json").read_text()) == {"a": [2], "b": 1}
    table = str(tmp_path / "blobs")
    rows = spark.createDataFrame([("x",), ("x",), ("y",), (None,)], "t string")
    assert writers.put_blobs(spark, rows, "t", "texts", table) == 2
    assert writers.put_blobs(spark, rows.unionByName(spark.createDataFrame([("z",)], "t string")), "t", "texts", table) == 1
    writers.copy_table(spark, table, str(tmp_path / "copy"))
    with pytest.raises(Exception, match="PATH_ALREADY_EXISTS"):
        writers.copy_table(spark, table, str(tmp_path / "copy"))


def test_a_run_is_copied_whole_or_not_at_all(spark, tmp_path):
    from hashlib import sha256

    digest = lambda x: sha256(x.encode()).hexdigest()
    blobs = spark.createDataFrame([(digest(x), x) for x in "abc"], "digest string, content string")
    calls = lambda *xs: spark.createDataFrame([("COMPLETE", digest(x)) for x in xs], "status string, response_hash string")
    run = str(tmp_path / "run")
    blobs.write.parquet(f"{run}/blobs")
    calls("a", "b").write.parquet(f"{run}/ledger")
    writers.copy_run(spark, run, str(tmp_path / "copy"))
    writers.copy_run(spark, str(tmp_path / "copy"), str(tmp_path / "again"))
    assert spark.read.parquet(str(tmp_path / "again" / "blobs")).count() == 3 and (tmp_path / "again" / "_COMPLETE").exists()
    with pytest.raises(eligibility.ManifestError, match="DESTINATION_NOT_EMPTY"):
        writers.copy_run(spark, run, str(tmp_path / "copy"))
    calls("lost").write.mode("append").parquet(f"{run}/ledger")
    with pytest.raises(eligibility.ManifestError, match="BACKUP_INCONSISTENT: 0 corrupt, 1 missing"):
        writers.copy_run(spark, run, str(tmp_path / "bad"))
    assert not (tmp_path / "bad" / "_COMPLETE").exists()


def test_export_bundle(spark, tmp_path):
    m = spark.createDataFrame([("c1", 0, "user", "q"), ("c1", 1, "assistant", "a"), ("c2", 0, "user", "q2")], "conversation_id string, position int, role string, content string")
    selected = spark.createDataFrame([(0, "c1", "img")], "ordinal int, conversation_id string, image_id string")
    other = spark.createDataFrame([("c1", "x"), ("c2", "y")], "conversation_id string, v string")
    writers.export_bundle(selected, m, other, other, str(tmp_path / "b"))
    lines = [r[0] for r in spark.read.text(str(tmp_path / "b" / "training")).collect()]
    record = json.loads(lines[0])
    assert len(lines) == 1 and [x["type"] for x in record["messages"][0]["content"]] == ["image", "text"] and [x["type"] for x in record["messages"][1]["content"]] == ["text"]
    assert spark.read.text(str(tmp_path / "b" / "ratings")).count() == 1
    with pytest.raises(eligibility.ManifestError):
        writers.export_bundle(spark.createDataFrame([(0, "zz", "i")], "ordinal int, conversation_id string, image_id string"), m, other, other, str(tmp_path / "b2"))


def test_ingest(spark):
    sources = spark.createDataFrame([("s1", "r", "training", ["g"]), ("s2", "r", "evaluation", []), ("s3", "r", "training", ["g"]), ("s4", "r", "training", []), ("s5", "r", "training", [])], "source_id string, rights_record_id string, purpose string, source_group_ids array<string>")
    rights = spark.sql("select 'r' as rights_record_id, true as processing_allowed, true as qa_redistribution_allowed, true as training_allowed, timestamp '2020-01-01' as valid_from, cast(null as timestamp) as valid_until")
    decoded = spark.createDataFrame([("s1", "p1"), ("s2", "p1"), ("s3", "p3"), ("s4", "p4")], "source_id string, canonical_pixel_sha256 string")
    decoded = decoded.selectExpr("*", "100 as n_bytes", "'PNG' as format", "1 as frames", "case when source_id = 's4' then 64 else 256 end as width", "256 as height")
    images, failures = ingest.ingest(sources, rights, decoded, F.expr("timestamp '2024-01-01'"))
    got = {r["source_id"]: (r["purpose"], r["split"]) for r in images.collect()}
    assert got == {k: ("evaluation", "evaluation") for k in ("s1", "s2", "s3")}
    assert {r["source_id"]: r["reason"] for r in failures.collect()} == {"s4": "IMAGE_EDGE_TOO_SHORT", "s5": "IMAGE_NOT_FILE"}
    again, failed = ingest.ingest(sources.repartition(3), rights, decoded, F.expr("timestamp '2024-01-01'"))
    assert ingest.manifest_hash(images, failures) == ingest.manifest_hash(again, failed)
    with pytest.raises(eligibility.ManifestError, match="DUPLICATE_SOURCE_ID"):
        ingest.ingest(sources.unionByName(sources), rights, decoded, F.expr("timestamp '2024-01-01'"))


class Scripted:
    """A model double: answers everything, and fails the second turn of conversation c2."""

    def run(self, stage: str, rows: pd.DataFrame) -> pd.DataFrame:
        out = rows.copy()
        bad = (rows["conversation_id"] == "c2") & (rows["turn_index"] == 2)
        out["output"] = ["NOT_MET" if b else "MET" for b in bad] if stage == "holistic_review" else [f"{stage} {t}" for t in rows["turn_index"]]
        return out


def test_synthesis(spark):
    jobs = spark.createDataFrame([("c1", "i1", 3), ("c2", "i2", 3)], "conversation_id string, image_id string, planned_turns int")
    evidence = spark.createDataFrame([("i1", ["visible_entity"], []), ("i2", ["readable_text"], ["top"])], "image_id string, capabilities array<string>, visible_scopes array<string>")
    turns = synthesis.synthesize(jobs, evidence, Scripted, 4)
    got = sorted((r["conversation_id"], r["turn_index"], r["task_id"], r["status"]) for r in turns.collect())
    assert got == [("c1", k, "object_identification", "COMMITTED") for k in (1, 2, 3)] + [("c2", 1, "text_transcription", "COMMITTED"), ("c2", 2, "text_transcription", "REJECTED")]
    assert {r["conversation_id"]: r["status"] for r in synthesis.finish(turns).collect()} == {"c1": "QUALITY_CANDIDATE", "c2": "REJECTED"}


def test_rating(spark):
    votes = [("c", 1, "R_CORE", "turn", v) for v in ("MET", "MET")] + [("c", 1, "C_COVERAGE", "turn", v) for v in ("MET", "MET")] + [("c", 2, "Q_HOLISTIC", "turn", v) for v in ("MET", "NOT_MET")] + [("c", 3, "R_FOCUS", "turn", v) for v in ("NOT_MET", "NOT_MET")]
    df = spark.createDataFrame(votes, "conversation_id string, turn_index int, template_id string, subject_id string, verdict string")
    assert {r["turn_index"]: r["status"] for r in synthesis.rate_turns(df).collect()} == {1: "COMMITTED", 2: "ABSTAINED", 3: "COMMITTED"}
    checks = spark.createDataFrame([("c", 1, "NOT_MET", None, None)], "conversation_id string, turn_index int, coverage string, computation string, set_check string")
    assert synthesis.rate_turns(df, checks).where("turn_index = 1").first()["status"] == "ABSTAINED"


def test_append_stream_is_exactly_once(spark, tmp_path):
    source, table, check = (str(tmp_path / x) for x in ("in", "out", "check"))
    spark.createDataFrame([("a", 1), ("a", 1), ("b", 2)], "k string, v int").write.parquet(source)
    read = lambda: spark.readStream.schema("k string, v int").parquet(source)
    streams.append_once(read(), table, ["k"], check).awaitTermination()
    spark.createDataFrame([("b", 9), ("c", 3)], "k string, v int").write.mode("append").parquet(source)
    streams.append_once(read(), table, ["k"], check).awaitTermination()
    streams.append_once(read(), table, ["k"], check).awaitTermination()
    assert sorted((r["k"], r["v"]) for r in read_table(spark, table).collect()) == [("a", 1), ("b", 2), ("c", 3)]


def test_requirement_stream_equals_the_table(spark, tmp_path):
    from corpusflow.operators import requirements

    kind = "conversation_id string, turn_index int, seq long, action string, previous_requirement_id string, requirement_id string, lifetime string"
    first = [("a", 1, 1, "introduce", None, "r1", "persistent"), ("a", 1, 2, "introduce", None, "r2", "current_turn"), ("b", 1, 1, "introduce", None, "r1", "persistent")]
    second = [("a", 2, 3, "override", "r1", "r3", "persistent"), ("a", 2, 4, "retain", "r2", None, None), ("b", 2, 2, "revoke", "r1", None, None)]
    source = str(tmp_path / "in")
    query = None
    for rows in (first, second):
        spark.createDataFrame(rows, kind).coalesce(1).write.mode("append").parquet(source)
        stream = spark.readStream.schema(kind).parquet(source)
        query = streams.requirement_stream(stream).writeStream.foreachBatch(lambda df, n: df.write.mode("append").parquet(str(tmp_path / "out"))).option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start()
        query.awaitTermination()
    rows = lambda df: sorted(tuple(map(str, r)) for r in df.select("conversation_id", "turn_index", "seq", "error", "n_active").collect())
    assert rows(spark.read.parquet(str(tmp_path / "out"))) == rows(requirements.ledger(spark.createDataFrame(first + second, kind)))


def test_call_rates(spark):
    calls = spark.sql("select * from values (timestamp '2024-01-01 00:01:00', 's', 3L), (timestamp '2024-01-01 00:04:00', 's', 4L), (timestamp '2024-01-01 00:06:00', 's', 5L) as t(created_at, stage, output_tokens)")
    assert [(r["calls"], r["output_tokens"]) for r in streams.call_rates(calls).orderBy("start").collect()] == [(2, 7), (1, 5)]
