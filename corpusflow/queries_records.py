"""Registered queries over records: sources and sinks read back, gates, references, identities, commits, exports.

Like those of ``queries``, each applies an operator to the whole of the supplied tables; files that a
query writes go to the shared folder.
"""

from __future__ import annotations

import contextlib
import hashlib
import uuid
from concurrent.futures import ThreadPoolExecutor
from functools import partial

import pandas as pd
from pyspark.accumulators import Accumulator
from pyspark.errors import PythonException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusflow.functions import catalogs, hashing, text
from corpusflow.functions.hashing import SEED, bucket, sha
from corpusflow.operators import consensus, eligibility, ledger, planning, pool, requirements, rules, similarity, transcript
from corpusflow.operators.eligibility import ManifestError
from corpusflow.plans import stages, synthesis
from corpusflow.plans.ingest import image_ids, ingest
from corpusflow.queries import RIGHTS_ROWS, _calls, _evidence, _messages, _metadata, _pool, _s, _t, _turns, requirement_events
from corpusflow.session import placed, saved, shared_dir
from corpusflow.sources import readers, writers
from corpusflow.sources.commit_log import read_table
from corpusflow.streaming import ledger as streams


def _place(spark: SparkSession, name: str) -> str:
    return placed(f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}")


# -- sources and sinks ----------------------------------------------------------------------


def metadata_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Metadata written as CSV and scanned with its header checked, by subset and licence."""
    path = _place(spark, "metadata")
    _metadata(spark, sf_dir).drop("page_id").write.options(header="true", quote='"', escape='"', quoteAll="true").csv(path)
    return readers.read_metadata(spark, path, ["ImageID", "Subset", "License"]).groupBy("Subset", "License").agg(F.count(F.lit(1)).alias("n"))


def jsonl_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents written as JSON lines and read back strictly, by language."""
    path = _place(spark, "lines")
    writers.write_jsonl(_t(spark, sf_dir, "documents").select("doc_id", "lang", "text"), path)
    schema = T.StructType([T.StructField("doc_id", T.LongType(), False), T.StructField("lang", T.StringType()), T.StructField("text", T.StringType())])
    return readers.read_jsonl(spark, path, schema).groupBy("lang").agg(F.count(F.lit(1)).alias("n"), F.sum(F.length("text")).alias("chars"))


def json_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents without their texts as compact and as spaced JSON lines."""
    d = _t(spark, sf_dir, "documents").select("source", "doc_id", "lang")
    compact, spaced = writers.json_lines(d).withColumnRenamed("value", "line"), writers.json_lines(d, spaced=True).withColumnRenamed("value", "line")
    return compact.select("line", F.lit("compact").alias("form")).unionByName(spaced.select("line", F.lit("spaced").alias("form")))


def file_digests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Length and digest of a file for each benchmark item."""
    path = _place(spark, "files")
    _t(spark, sf_dir, "benchmark").select("item_id", F.col("text").alias("value")).write.partitionBy("item_id").text(path)
    found = readers.file_digests(spark, path).where("length > 0")
    return found.select(F.regexp_extract("path", "item_id=([0-9]+)/", 1).cast("long").alias("item_id"), "length", "sha256")


def fixture_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Answer-keyed fixtures of every language of the documents."""
    langs = sorted(r[0] for r in _t(spark, sf_dir, "documents").select("lang").where("lang is not null").distinct().collect())
    f = readers.fixtures(spark, langs, 3, SEED)
    return f.select("fixture_id", "image_id", "split", "stratum", "target_language", F.col("index").alias("number"), "expected_accept")


def blob_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Blobs that a content-addressed table has after all documents were put there, and put there again."""
    table, docs = _place(spark, "blobs"), _t(spark, sf_dir, "documents")
    first = writers.put_blobs(spark, docs, "text", "texts", table)
    return spark.createDataFrame([(first, first + writers.put_blobs(spark, docs, "text", "texts", table))], "first_count long, second_count long")


def two_writers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two writers at once: each puts the documents of its half and of the middle; blobs and call records by kind of table."""
    docs, calls = _t(spark, sf_dir, "documents"), _calls(spark, sf_dir)
    blobs, records = _place(spark, "blobs"), _place(spark, "ledger")
    jobs = [lambda k=k: writers.put_blobs(spark, docs.where(F.col("doc_id") % 3 != k), "text", "texts", blobs) for k in (0, 1)]
    jobs += [lambda k=k: writers.record_calls(spark, calls.where(F.col("seq") % 3 != k), records) for k in (0, 1)]
    with ThreadPoolExecutor(len(jobs)) as pool_:
        added = [f.result() for f in [pool_.submit(j) for j in jobs]]
    tables = ((read_table(spark, blobs), ["digest"], sum(added[:2])), (read_table(spark, records), list(ledger.KEY), sum(added[2:])))
    rows = [(name, t.count(), t.select(*keys).distinct().count(), n) for name, (t, keys, n) in zip(("blobs", "calls"), tables, strict=True)]
    return spark.createDataFrame(rows, "kind string, n_rows long, n_keys long, n_added long")


def run_copy(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A ledger with its responses, backed up, restored and verified."""
    run = _place(spark, "run")
    calls = _calls(spark, sf_dir)
    calls.write.parquet(f"{run}/ledger")
    calls.select(F.col("response_hash").alias("digest"), _s("seq").alias("content")).write.parquet(f"{run}/blobs")
    writers.copy_run(spark, run, f"{run}-backup")
    writers.copy_run(spark, f"{run}-backup", f"{run}-restored")
    return ledger.verify(spark.read.parquet(f"{run}-restored/blobs"), spark.read.parquet(f"{run}-restored/ledger"))


def ledger_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A ledger written before calls had durations, read as one of today, by stage."""
    path = _place(spark, "old-ledger")
    _calls(spark, sf_dir).drop("duration_ms").write.parquet(path)
    return readers.read_ledger(spark, path).groupBy("stage").agg(F.count(F.lit(1)).alias("calls"), F.sum("duration_ms").cast("long").alias("duration_ms"))


def image_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files asked for by path: those that are there, that are not, and paths that leave the root."""
    root = _place(spark, "images")
    _t(spark, sf_dir, "benchmark").select("item_id", F.col("text").alias("value")).write.partitionBy("item_id").text(root)
    there = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(root).where("length > 0").select(F.regexp_extract("path", "/(item_id=[0-9]+/[^/]+)$", 1).alias("image_path"))
    made = lambda form: _t(spark, sf_dir, "benchmark").select(F.format_string(form, "item_id").alias("image_path"))
    asked = there.unionByName(made("item_id=%d/none.png")).unionByName(made("../%d.png"))
    return readers.read_images(spark, root, asked).groupBy(F.coalesce("reason", F.lit("read")).alias("reason")).agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(F.length("content")), F.lit(0)).cast("long").alias("bytes"))


def ingest_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages as sources through the whole ingest: images by purpose and split, failures by reason."""
    k = F.col("page_id")
    pages = _t(spark, sf_dir, "pages").select("page_id", F.concat(F.lit("p"), _s("page_id")).alias("source_id"))
    sources = pages.select("source_id", F.concat(F.lit("r"), (k % 5).cast("string")).alias("rights_record_id"), F.when(k % 3 == 1, "evaluation").otherwise("training").alias("purpose"), F.array().cast("array<string>").alias("source_group_ids"))
    names = "rights_record_id, processing_allowed, qa_redistribution_allowed, training_allowed, valid_from, valid_until"
    rights = spark.sql(f"select * from values {RIGHTS_ROWS} as t({names})")
    decoded = pages.where(k % 13 != 0).select("source_id", F.sha2(F.expr("cast(page_id div 40 as string)"), 256).alias("canonical_pixel_sha256"), F.lit(1000).alias("n_bytes"), F.when(k % 10 == 0, "GIF").otherwise("PNG").alias("format"), F.lit(1).alias("frames"), F.lit(640).alias("width"), (k % 200 + 100).alias("height"))
    images, failures = ingest(sources, rights, decoded, F.expr("timestamp '2026-01-01 00:00:00'"))
    done = images.groupBy("purpose", "split").agg(F.count(F.lit(1)).alias("n"))
    return done.unionByName(failures.groupBy(F.col("reason").alias("purpose")).agg(F.lit("failed").alias("split"), F.count(F.lit(1)).alias("n")))


def export_bundle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The four parts of an export of every third conversation, counted as they were written."""
    m = _messages(spark, sf_dir).where("conversation_id is not null")
    ids = m.select("conversation_id").distinct().where("cast(conversation_id as long) % 3 = 0")
    selected = planning.ordinals(ids, ["conversation_id"], F.substring("conversation_id", 1, 1)).withColumn("image_id", F.concat(F.lit("img-"), "conversation_id"))
    rated = m.select("conversation_id", "position", F.when(F.col("role") == "user", "MET").otherwise("UNKNOWN").alias("verdict"))
    path = _place(spark, "bundle")
    writers.export_bundle(selected.select("ordinal", "conversation_id", "image_id"), m, rated, m.select("conversation_id", "role"), path)
    out = None
    for part in ("training", "ratings", "provenance", "selection"):
        rows = spark.read.text(f"{path}/{part}")
        one = rows.agg(F.lit(part).alias("part"), F.count(F.lit(1)).alias("n"), F.countDistinct(F.get_json_object("value", "$.conversation_id")).alias("conversations"))
        out = one if out is None else out.unionByName(one)
    return out


def stream_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Kinds of events of each user, appended from a stream, each key once, by kind."""
    events = _t(spark, sf_dir, "events")
    table, source = _place(spark, "appended"), _place(spark, "arrivals")
    events.select("event_type", "user_id").write.parquet(source)
    arriving = spark.readStream.schema("event_type string, user_id long").option("maxFilesPerTrigger", 2).parquet(source)
    streams.append_once(arriving, table, ["event_type", "user_id"], _place(spark, "progress")).awaitTermination()
    return read_table(spark, table).groupBy("event_type").agg(F.count(F.lit(1)).alias("n"))


def requirement_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The requirement ledger of all events over a stream that stops twice and goes on from its state, by error."""
    rows, source, out, progress = saved(requirement_events(spark, sf_dir), "events"), _place(spark, "arrivals"), _place(spark, "ledger"), _place(spark, "progress")
    last = rows.agg(F.max("seq")).first()[0] or 0
    for part in range(3):
        rows.where(f"seq * 3 >= {part} * {last + 1} and seq * 3 < {part + 1} * {last + 1}").write.mode("append").parquet(source)
        arriving = spark.readStream.schema(rows.schema).parquet(source)
        streams.requirement_stream(arriving).writeStream.format("parquet").option("path", out).option("checkpointLocation", progress).trigger(availableNow=True).start().awaitTermination()
    return spark.read.parquet(out).groupBy(F.coalesce("error", F.lit("none")).alias("error")).agg(F.count(F.lit(1)).alias("n"), F.max("n_active").alias("most_active"))


def windowed_rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Calls and tokens by stage and hour of completion."""
    r = streams.call_rates(_calls(spark, sf_dir), "1 hour")
    return r.select(F.date_format("start", "yyyy-MM-dd HH").alias("hour"), "stage", "calls", "output_tokens")


class ScriptedModel:
    """A model double for ``synthesis_resume``: what it says follows from a hash of the call; ``calls`` counts, ``stop`` is where it breaks off."""

    def __init__(self, calls: Accumulator, stop: str | None = None):
        self.calls, self.stop = calls, stop

    def run(self, stage: str, rows: pd.DataFrame) -> pd.DataFrame:
        if stage == self.stop and len(rows):
            raise RuntimeError(f"stopped before {stage}")
        self.calls.add(len(rows))
        return rows.assign(output=[self.said(stage, r) for r in rows.itertuples()])

    @staticmethod
    def said(stage: str, r: tuple) -> str:
        bucket = lambda *parts: int(hashlib.sha256(":".join(map(str, (r.conversation_id, r.turn_index, *parts))).encode()).hexdigest()[:4], 16)
        if bucket(r.call, r.attempt) % 4 == 0:
            return " "
        if stage == "holistic_review":
            return "NOT_MET" if bucket("verdict", "repair" in r.call) % 3 == 0 else "MET"
        return f"{stage} {r.conversation_id} {r.turn_index}"


def synthesis_resume(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A synthesis over all conversations that broke off after two stages and was run again: turns by state, records by call and attempt, calls made.

    Each conversation plans a turn for each pair of its messages, two at most.
    """
    c = _t(spark, sf_dir, "conversations").groupBy(_s("conv_id").alias("conversation_id")).agg(F.least(F.lit(2), F.greatest(F.lit(1), F.expr("count(1) div 2"))).cast("int").alias("planned_turns"))
    jobs = saved(c.select("conversation_id", F.col("conversation_id").alias("image_id"), "planned_turns"), "jobs")
    evidence = jobs.select("image_id", F.array(F.lit("visible_entity")).alias("capabilities"), F.array().cast("array<string>").alias("visible_scopes"))
    calls, table, limits = spark.sparkContext.accumulator(0), _place(spark, "calls"), stages.Limits(attempts=2)
    for stop in ("holistic_review", None):
        with contextlib.suppress(PythonException) if stop else contextlib.nullcontext():
            turns = synthesis.synthesize(jobs, evidence, partial(ScriptedModel, calls, stop), 2, table, limits)
    states = turns.groupBy(F.concat_ws(" ", F.col("turn_index").cast("string"), "status", F.col("repaired").cast("string"), F.coalesce("failure", F.lit("-"))).alias("name")).agg(F.count(F.lit(1)).alias("n"))
    records = read_table(spark, table).groupBy(F.concat_ws(" ", "stage", F.col("attempt").cast("string")).alias("name")).agg(F.count(F.lit(1)).alias("n"))
    made = spark.createDataFrame([("calls made", calls.value)], "name string, n long")
    return states.unionByName(records).unionByName(made)


# -- catalogs, stages, scopes ---------------------------------------------------------------


def catalog_capabilities(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many tasks of the catalog need each capability, and how many documents show it by hash."""
    need = catalogs.tasks_table(spark).select(F.explode("required").alias("capability")).groupBy("capability").agg(F.count(F.lit(1)).alias("tasks"))
    shown = _evidence(spark, sf_dir).select(F.explode("capabilities").alias("capability")).groupBy("capability").agg(F.count(F.lit(1)).alias("images"))
    return need.join(shown, "capability", "left").select("capability", "tasks", F.coalesce("images", F.lit(0)).alias("images"))


def rubric_catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rubric items by axis, scope and use."""
    return catalogs.rubric_table(spark).groupBy("axis", "input_scope", "use").agg(F.count(F.lit(1)).alias("n"))


def _outcome(run) -> str:
    """OK, or the code of the error that ``run`` raises."""
    try:
        run()
    except (ManifestError, PermissionError) as e:
        return str(e).partition(":")[0]
    return "OK"


def stage_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What every model stage is given of a table with its fields, and what it says to fields it may not see."""
    rows = []
    for stage, fields in catalogs.STAGE_FIELDS.items():
        frame = lambda *extra: spark.createDataFrame([], ", ".join(f"{c} string" for c in (*fields.split(), *extra)))  # noqa: B023, E731
        seen = transcript.stage_input(frame(), stage).columns
        rows.append((stage, ",".join(seen), _outcome(lambda: transcript.stage_input(frame("gold_answer", "zzz"), stage)), _outcome(lambda: transcript.stage_input(frame("zzz"), stage))))  # noqa: B023
    return spark.createDataFrame(rows, "stage string, fields string, forbidden string, unknown string")


def scope_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages as the rubric's scopes see them: which of five fields are there, with the number of messages."""
    m = _messages(spark, sf_dir).select(F.lit("en").alias("target_language"), F.col("content").alias("question"), F.col("content").alias("candidate_answer"), F.col("role").alias("image_views"), F.col("role").alias("other_judge"))
    out = None
    for scope in sorted(catalogs.SCOPES):
        seen = transcript.scope_projection(m, scope)
        one = seen.agg(F.lit(scope).alias("input_scope"), F.lit(",".join(sorted(seen.columns))).alias("fields"), F.count(F.lit(1)).alias("n"))
        out = one if out is None else out.unionByName(one)
    return out


# -- gates and texts ------------------------------------------------------------------------


def language_gates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents (some replaced by signs or blanks) by whether they have letters and are blank."""
    k = F.col("doc_id")
    t = F.when(k % 9 == 0, " \t ").when(k % 9 == 1, "12 % !").otherwise(F.col("text"))
    d = _t(spark, sf_dir, "documents").select("lang", text.has_letters(t).alias("letters"), text.not_blank(t).alias("filled"))
    return d.groupBy("lang", "letters", "filled").agg(F.count(F.lit(1)).alias("n"))


def model_outputs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages as a model family may give them, cleaned of empty wrappers; leaks are null."""
    k = F.col("position") % 4
    raw = F.when(k == 0, F.concat(F.lit("<|channel|>thought\n<|channel|>"), "content")).when(k == 1, F.concat(F.lit("<|channel>thought\n<channel|>"), "content")).when(k == 2, F.concat("content", F.lit(" <|channel>thought"))).otherwise(F.col("content"))
    m = _messages(spark, sf_dir).select("conversation_id", "position", text.clean_output(raw).alias("cleaned"))
    return m.select("conversation_id", "position", transcript.text_status(F.col("cleaned")).alias("status"), F.length("cleaned").alias("chars"))


def joined_reasons(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language, source and text of each document as reasons, joined and cut."""
    reason = text.joined_reason(F.array("lang", "source", F.substring("text", 1, 400)))
    return _t(spark, sf_dir, "documents").select("doc_id", F.length(reason).alias("chars"), F.sha2(reason, 256).alias("digest"))


def evaluation_spread(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents by language and purpose once a group of equal texts with an evaluation member is for evaluation."""
    d = _t(spark, sf_dir, "documents").select("lang", F.sha2("text", 256).alias("g"), (F.col("doc_id") % 37 == 0).alias("e"))
    return eligibility.spread_evaluation(d, "g", "e").groupBy("lang", "purpose").agg(F.count(F.lit(1)).alias("n"))


def training_exclusions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of pinned rows and of two evaluation references, once each."""
    m = _metadata(spark, sf_dir).select("ImageID", "page_id")
    pinned = m.where("page_id % 5 = 0").select(F.col("ImageID").alias("image_id"))
    images = m.select(F.concat(F.lit("set:"), "ImageID").alias("source_id"), F.lit("evaluation").alias("purpose"), "page_id")
    return eligibility.excluded_ids(pinned, images.where("page_id % 3 = 0"), images.where("page_id % 7 = 0"))


def manifest_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a rights manifest with a repeated id, an empty window or a missing record aborts with; and uniqueness of keys."""
    names = "rights_record_id, processing_allowed, qa_redistribution_allowed, training_allowed, valid_from, valid_until"
    rights = spark.sql(f"select * from values {RIGHTS_ROWS} as t({names})")
    docs = lambda n: _t(spark, sf_dir, "documents").select(F.concat(F.lit("r"), (F.col("doc_id") % n).cast("string")).alias("rights_record_id"))
    at, training = F.expr("timestamp '2026-01-01 00:00:00'"), F.lit(False)
    empty = rights.withColumn("valid_until", F.coalesce("valid_until", "valid_from"))
    rows = [
        ("rights", _outcome(lambda: eligibility.attach_rights(docs(5), rights, at, training))),
        ("rights repeated", _outcome(lambda: eligibility.attach_rights(docs(5), rights.unionByName(rights), at, training))),
        ("rights window", _outcome(lambda: eligibility.attach_rights(docs(5), empty, at, training))),
        ("rights missing", _outcome(lambda: eligibility.attach_rights(docs(6), rights, at, training))),
    ]
    for table, key in (("documents", "doc_id"), ("documents", "source"), ("embeddings", "vec_id"), ("lineitem", "l_orderkey"), ("orders", "o_orderkey")):
        rows.append((f"{table}.{key}", _outcome(lambda: eligibility.require_unique(_t(spark, sf_dir, table), key, "DUPLICATE_ID"))))  # noqa: B023
    return spark.createDataFrame(rows, "checked string, outcome string")


# -- transcripts and plans ------------------------------------------------------------------


def chosen_instructions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each image's chosen candidate: one that was offered, none, or one that never was."""
    offered = planning.candidates(_evidence(spark, sf_dir))
    at = F.expr("cast(image_id as long) % 10")
    images = _evidence(spark, sf_dir).select("image_id", "turn_index", at.alias("at"))
    wanted = images.join(offered.select("image_id", "turn_index", F.col("position").cast("long").alias("at"), "candidate_id"), ["image_id", "turn_index", "at"], "left")
    asked = wanted.select("image_id", "turn_index", F.when(F.col("at") == 9, "unknown").otherwise(F.col("candidate_id")).alias("candidate_id"))
    return transcript.chosen(asked, offered)


def message_references(spark: SparkSession, sf_dir: str) -> DataFrame:
    """References to the message before, as a model gives them, put back to ids; the first one's is unknown."""
    m = _messages(spark, sf_dir)
    rows = m.select("conversation_id", "position", F.concat(F.lit("m"), (F.col("position") - 1).cast("string")).alias("source_message_id"))
    return transcript.resolved(rows, m)


def first_dialogues(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first 100 images in order of id, with their ordinals."""
    return transcript.first_images(_t(spark, sf_dir, "documents").select(F.lpad(_s("doc_id"), 12, "0").alias("image_id")), 100).select("ordinal", "image_id")


def detailed_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Terminal statuses where every planned turn must be committed."""
    t = _turns(spark, sf_dir)
    planned = t.select("conversation_id").distinct().select("conversation_id", hashing.planned_turns(F.col("conversation_id")).alias("planned_turns"))
    return transcript.accepted_prefixes(t, planned=planned).select("conversation_id", "committed_turns", "status")


def export_reasons(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversations by the first reason why they can't be exported."""
    k = F.col("conversation_id").cast("long")
    c = _messages(spark, sf_dir).groupBy("conversation_id").agg(F.count(F.lit(1)).alias("messages"))
    rows = c.select(
        F.when(k % 23 == 0, "pilot").otherwise("standard").alias("profile"),
        F.when(k % 19 == 0, F.lit(None).cast("string")).otherwise(_s("conversation_id")).alias("audit_hash"),
        F.when(k % 17 == 0, "REJECTED").otherwise("QUALITY_CANDIDATE").alias("status"),
        F.when(k % 13 == 0, "evaluation").otherwise("training").alias("purpose"),
        F.expr("messages div 2").alias("n_turns"),
        F.when(k % 11 == 0, F.lit(1)).otherwise(F.expr("messages div 2")).alias("committed_turns"),
    )
    return rows.select(F.coalesce(pool.export_reason(), F.lit("EXPORTED")).alias("reason")).groupBy("reason").agg(F.count(F.lit(1)).alias("n"))


def candidate_patterns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Family, task hash and profile path of each conversation's questions."""
    q = _messages(spark, sf_dir).where("role = 'user'")
    turn = F.struct("position", F.concat(F.lit("family"), (F.col("position") % 3).cast("string")).alias("family"), F.concat(F.lit("task"), _s("position")).alias("task_id"), F.when(F.col("position") % 4 == 0, "normal").otherwise("limitation").alias("profile"))
    g = q.groupBy("conversation_id").agg(F.array_sort(F.collect_list(turn)).alias("turns"))
    return g.select("conversation_id", *[v.alias(k) for k, v in pool.candidate(F.col("turns")).items()])


def progress_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Running counts of events by kind in order of id."""
    return ledger.progress(_t(spark, sf_dir, "events").select(F.col("event_id").alias("ordinal"), F.col("event_type").alias("status")))


# -- inventories ----------------------------------------------------------------------------


def set_verification(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two inventories of each order's parts, as sets or as counts, that must be complete and agree."""
    part, key = F.lpad(_s("l_partkey"), 8, "0"), F.col("l_orderkey")
    g = _t(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.collect_set(part).alias("expected"), F.collect_set(F.when(F.col("l_returnflag") != "R", part)).alias("reported"), F.count(F.lit(1)).cast("int").alias("n"))
    rows = g.select("*", F.explode(F.array(F.lit("a"), F.lit("b"))).alias("judge"))
    b = F.col("judge") == "b"
    listed = F.when(b & (key % 13 == 0), F.array(F.lit("other"))).when(b, F.reverse(F.array_sort("expected"))).otherwise(F.array_sort("expected"))
    counts = F.array(F.struct(F.lit("all").alias("scope"), F.col("n").alias("expected"), F.when(key % 5 == 0, F.col("n") + 1).otherwise(F.col("n")).alias("reported")))
    inv = rows.select(
        key.alias("key"), F.when(b & (key % 11 == 0), "UNKNOWN").otherwise("MET").alias("coverage"), F.when(key % 2 == 0, "count").otherwise("set").alias("mode"),
        counts.alias("counts"), listed.alias("expected_members"), F.col("reported").alias("reported_members"), F.lit(False).alias("empty_scope_is_explicit"),
    )
    return rules.verify_sets(inv).select(F.col("key").alias("l_orderkey"), "verdict")


def _asked(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = transcript.with_ids(_messages(spark, sf_dir)).where("role = 'user'")
    return m.select("message_id", "role", F.concat(F.lit("  Please "), "content", F.lit(" ?!")).alias("content"))


def _specs(asked: DataFrame) -> DataFrame:
    """Two quotes of each question: all of it, and one whose offsets are off."""
    whole = F.struct(F.lit("content").alias("kind"), F.col("content").alias("text"), F.lit("persistent").alias("lifetime"), F.lit(0).alias("start"), F.length("content").alias("end"))
    part = F.substring("content", 10, 12)
    shifted = F.struct(F.lit("format").alias("kind"), part.alias("text"), F.lit("local").alias("lifetime"), F.lit(2).alias("start"), (F.lit(2) + F.length(part)).alias("end"))
    return asked.select(F.col("message_id").alias("source_message_id"), F.explode(F.array(whole, shifted)).alias("s")).select("source_message_id", "s.*")


def requirement_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quoted requirements with exact spans, without courtesy and outer punctuation."""
    asked = _asked(spark, sf_dir)
    return requirements.canonical_specs(_specs(asked), asked).select("source_message_id", "kind", F.col("start").cast("long").alias("start_at"), F.col("end").cast("long").alias("end_at"), F.sha2("text", 256).alias("text_hash"))


def requirement_inventories(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Requirement ids of questions whose two inventories agree (one judge drops a quote, or doesn't finish, now and then)."""
    asked = _asked(spark, sf_dir)
    judges = F.explode(F.array(F.lit("a"), F.lit("b"))).alias("judge")
    mark = bucket(sha(F.col("source_message_id")), 10)
    rows = _specs(asked).withColumn("key", F.col("source_message_id")).select("*", judges).where((F.col("kind") == "content") | ((mark != 3) | (F.col("judge") == "a")) & (mark % 2 == 1))
    unfinished = (bucket(sha(F.col("key")), 10) == 5) & (F.col("judge") == "b")
    whole = asked.select(F.col("message_id").alias("key"), judges).select("key", "judge", (~unfinished).alias("extraction_complete"))
    r = requirements.reconcile(whole, rows, asked)
    return r.select("key", F.when(F.col("requirement_ids").isNotNull(), F.size("requirement_ids")).alias("n"), F.array_join("requirement_ids", ",").alias("ids"))


def claim_unions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The union of two judges' claims about each answer."""
    m = _messages(spark, sf_dir).where("role = 'assistant'").select(F.concat_ws(":", "conversation_id", _s("position")).alias("key"), "content")
    claim = lambda first, n, start: F.struct(F.substring("content", first, n).alias("text"), F.lit(start).alias("start"), (F.lit(start) + F.length(F.substring("content", first, n))).alias("end"))
    claims = m.select("key", F.explode(F.array(claim(1, 6, 0), claim(4, 9, 3), claim(4, 9, 5))).alias("c")).select("key", "c.*")
    u = requirements.claim_union(claims, m)
    return u.select("key", F.when(F.col("claims").isNotNull(), F.size("claims")).alias("n"), F.array_join(F.transform("claims", lambda c: F.concat_ws(":", c["start"].cast("string"), c["end"].cast("string"))), ",").alias("spans"))


# -- identities and ledgers -----------------------------------------------------------------


def identities(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Request and call ids of every event."""
    e = _t(spark, sf_dir, "events").select("event_id", "event_type", _s("user_id").alias("request"))
    request = ledger.request_hash(F.lit("lock"), F.col("request"))
    return e.select("event_id", request.alias("request_hash"), ledger.call_id(F.lit("run"), F.col("event_type"), request).alias("call_id"))


def image_identities(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Image ids of pages from source and pixels."""
    p = _t(spark, sf_dir, "pages").select("page_id", F.col("url").alias("source_id"), F.sha2("html", 256).alias("canonical_pixel_sha256"))
    return image_ids(p).select("page_id", "image_id")


def item_identities(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of the rubric items that apply to every turn of a conversation."""
    turns = _messages(spark, sf_dir).where("role = 'user'").select("conversation_id", F.expr("cast(position div 2 as int) + 1").alias("turn_index"))
    items = turns.crossJoin(F.broadcast(catalogs.rubric_table(spark).where("applies_when = 'always'").select("template_id"))).withColumn("subject_id", F.lit("turn"))
    return items.select("conversation_id", "turn_index", "template_id", consensus.item_id(F.lit(0), F.lit("context")).alias("item_id"))


def pool_identity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The identity of the whole selection pool."""
    return spark.createDataFrame([(pool.pool_hash(_pool(spark, sf_dir)),)], "pool_hash string")


def commits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What commits of new turns, of turns already there and of repeated turns, and openings of runs, come to."""
    done = _messages(spark, sf_dir).select("conversation_id", F.col("position").alias("turn_index"))
    new = done.withColumn("turn_index", F.col("turn_index") + 1000)
    keys = ["conversation_id", "turn_index"]
    runs = done.select(F.concat(F.lit("run"), "conversation_id").alias("run_id"), F.lit("c").alias("config_hash"), F.lit("standard").alias("profile")).distinct()
    opened = lambda *a: lambda: ledger.open_run(runs, *a).count()
    rows = [
        ("new turns", _outcome(lambda: ledger.commit(done, new, keys)), new.count()),
        ("turns already there", _outcome(lambda: ledger.commit(done, done, keys)), 0),
        ("repeated turns", _outcome(lambda: ledger.commit(done, new.unionByName(new), keys)), 0),
        ("new run", _outcome(opened("run", "c", "standard")), opened("run", "c", "standard")()),
        ("same run", _outcome(opened("run0", "c", "standard")), opened("run0", "c", "standard")()),
        ("other configuration", _outcome(opened("run0", "d", "standard")), 0),
    ]
    return spark.createDataFrame(rows, "attempt string, outcome string, rows long")


def visual_grouping(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Visual groups over exact pixels, declared groups and near copies of vectors."""
    v = _t(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("image_id"), "embedding")
    k = F.col("image_id")
    images = v.select("image_id", F.sha2(F.when(k % 5 == 0, F.expr("image_id div 15")).otherwise(-k).cast("string"), 256).alias("canonical_pixel_sha256"), F.when(k % 7 == 0, F.array(F.concat(F.lit("g"), F.expr("cast(image_id div 21 as string)")))).otherwise(F.array().cast("array<string>")).alias("source_group_ids"))
    return similarity.visual_groups(images, v, 0.45)


QUERIES = {
    f.__name__: f
    for f in (
        metadata_scan, jsonl_roundtrip, json_lines, file_digests, fixture_keys, blob_store, run_copy, ledger_columns, image_files, ingest_plan, export_bundle, two_writers, stream_append, requirement_stream, synthesis_resume, windowed_rates,
        catalog_capabilities, rubric_catalog, stage_fields, scope_fields, language_gates, model_outputs, joined_reasons, evaluation_spread, training_exclusions, manifest_errors,
        chosen_instructions, message_references, first_dialogues, detailed_status, export_reasons, candidate_patterns, progress_counts,
        set_verification, requirement_spans, requirement_inventories, claim_unions, identities, image_identities, item_identities, pool_identity, commits, visual_grouping,
    )
}
