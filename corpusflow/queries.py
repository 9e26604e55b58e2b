"""Registered queries: each applies operators to the whole of the supplied tables.

Tables play roles: ``documents`` are sources with content, ``benchmark`` is the evaluation
reference, ``labels`` are two judges, ``conversations`` are transcripts, ``events`` is a call
ledger, ``orders`` with ``customer`` a selection pool, ``pages`` metadata rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from corpusflow.functions import catalogs, hashing, numbers, text
from corpusflow.functions.hashing import SEED, bucket, sha
from corpusflow.operators import components, consensus, eligibility, ledger, planning, pool, requirements, rules, similarity, transcript
from corpusflow.session import importable, saved, spread


def _t(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    df = importable(spark).read.parquet(f"{sf_dir}/{name}.parquet")
    return spread(df) if name in ("documents", "conversations") else df


def _s(x: str) -> Column:
    return F.col(x).cast("string")


# -- ingest ---------------------------------------------------------------------------------


def split_after_contamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records by language and split after exact-copy grouping and spread of evaluation."""
    docs = _t(spark, sf_dir, "documents").select("doc_id", "lang", "text")
    refs = _t(spark, sf_dir, "benchmark").select(F.col("item_id").alias("id"), "text")
    hits = eligibility.containments(docs.select(F.col("doc_id").alias("id"), "text"), refs).select("long_id").distinct()
    own = docs.select("doc_id", "lang", F.sha2("text", 256).alias("digest")).join(hits, F.col("doc_id") == F.col("long_id"), "left")
    own = own.select("doc_id", "lang", "digest", F.col("long_id").isNotNull().alias("hit"))
    groups = own.groupBy("digest").agg(F.min("doc_id").alias("group_id"), F.max("hit").alias("evaluation"))
    named = own.select("lang", "digest").join(groups, "digest")
    split = F.when(F.col("evaluation"), "evaluation").otherwise(hashing.split_of(F.col("group_id")))
    return named.groupBy("lang", split.alias("split")).agg(F.count(F.lit(1)).alias("n"))


RIGHTS_ROWS = """
    ('r0', true, true, true, timestamp '2020-01-01 00:00:00', cast(null as timestamp)),
    ('r1', true, true, false, timestamp '2020-01-01 00:00:00', cast(null as timestamp)),
    ('r2', false, true, true, timestamp '2020-01-01 00:00:00', cast(null as timestamp)),
    ('r3', true, true, true, timestamp '2020-01-01 00:00:00', timestamp '2026-01-01 00:00:00'),
    ('r4', true, false, true, timestamp '2020-01-01 00:00:00', timestamp '2026-01-01 00:00:01')"""


def rights_window_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents by rights record and the reason why they may not be used at an instant."""
    rights = spark.sql(f"select * from values {RIGHTS_ROWS} as t(rights_record_id, processing_allowed, qa_redistribution_allowed, training_allowed, valid_from, valid_until)")
    docs = _t(spark, sf_dir, "documents").select("doc_id", F.concat(F.lit("r"), (F.col("doc_id") % 6).cast("string")).alias("rights_record_id"))
    joined = eligibility.attach_rights(docs, rights, F.expr("timestamp '2026-01-01 00:00:00'"), F.col("doc_id") % 2 == 0, strict=False)
    return joined.groupBy("rights_record_id", F.coalesce("reason", F.lit("usable")).alias("reason")).agg(F.count(F.lit(1)).alias("n"))


def _metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("page_id")
    digest = F.substring(F.sha2("url", 256), 1, 16)
    return _t(spark, sf_dir, "pages").select(
        F.when(k % 17 == 0, F.upper(F.concat(digest, F.lit("x")))).otherwise(digest).alias("ImageID"),
        F.when(k % 11 == 0, "validation").otherwise("train").alias("Subset"),
        F.when(k % 7 == 0, "https://example.org/nc/").otherwise(F.concat(F.lit("https://creativecommons.org/licenses/by/"), F.element_at(F.array(*map(F.lit, ("2.0", "2.5", "3.0", "4.0"))), (k % 4 + 1).cast("int")), F.lit("/"))).alias("License"),
        F.when(k % 13 == 0, " ").otherwise(F.concat(F.lit("author "), k.cast("string"))).alias("Author"),
        F.col("url").alias("OriginalLandingURL"),
        F.element_at(F.array(*map(F.lit, ("0", "90.0", "270", "45", "0.0"))), (k % 5 + 1).cast("int")).alias("Rotation"),
        F.col("url").alias("OriginalURL"),
        F.lit("").alias("Thumbnail300KURL"),
        k.alias("page_id"),
    )


def eligibility_reason_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Training metadata rows by the first check that they fail."""
    m = _metadata(spark, sf_dir)
    return eligibility.reason_counts(m.withColumn("reason", eligibility.train_reason(F.col("page_id") % 19 == 0)))


def validation_eligibility(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Validation metadata rows by eligibility and normalized rotation."""
    m = _metadata(spark, sf_dir)
    return m.groupBy(eligibility.validation_eligible().alias("eligible"), eligibility.validation_rotation(F.col("Rotation")).alias("rotation")).agg(F.count(F.lit(1)).alias("n"))


def train_metadata_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A hash-ranked sample of eligible training rows without excluded ids."""
    m = _metadata(spark, sf_dir)
    excluded = m.where(F.col("page_id") % 19 == 0).select(F.col("ImageID").alias("image_id"))
    picked = eligibility.train_sample(m.drop("page_id"), excluded, 20)
    return picked.select("ImageID", "rank_hash", eligibility.rotation_degrees(F.col("Rotation")).alias("rotation"))


def probed_train_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same where two of three images are absent when probed: the next ranks step in."""
    m = _metadata(spark, sf_dir)
    excluded = m.where(F.col("page_id") % 19 == 0).select(F.col("ImageID").alias("image_id"))
    present = lambda rows: rows.withColumn("present", bucket(sha("file", F.col("ImageID")), 3) == 0)
    return eligibility.train_sample(m.drop("page_id"), excluded, 4, probe=present).select("ImageID", "rank_hash")


def near_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pairs of cosine 0.9 or more among all vectors and changed copies of them, by banded codes that miss a pair once in ten million.

    Copies have every fifth coordinate at 0.4 of its value.
    """
    v = _vectors(spark, sf_dir).select("image_id", F.transform("embedding", lambda x: x.cast("double")).alias("embedding"))
    changed = F.transform("embedding", lambda x, i: F.when(i % 5 == 0, x * F.lit(0.4)).otherwise(x))
    p = similarity.banded_pairs(v.unionByName(v.select((F.col("image_id") + 1_000_000_000).alias("image_id"), changed.alias("embedding"))), 0.9, 1 - 1e-7)
    return p.select("left_id", "right_id", F.round("cosine", 6).alias("cosine"))


def pinned_provenance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pinned rows that the metadata lacks or contradicts."""
    m = _metadata(spark, sf_dir)
    who = F.when(F.col("page_id") % 3 == 0, F.lit("someone else")).otherwise(eligibility.attribution(F.col("Author"), F.col("OriginalLandingURL")))
    pinned = m.select(F.when(F.col("page_id") % 5 == 0, F.concat(F.lit("gone"), _s("page_id"))).otherwise(F.col("ImageID")).alias("image_id"), F.col("License").alias("license_uri"), who.alias("attribution"), F.col("OriginalLandingURL").alias("landing_url"))
    return eligibility.pinned_failures(pinned, m).groupBy("reason").agg(F.count(F.lit(1)).alias("n"))


def image_gates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Decoded images by the first gate that they fail."""
    k = F.col("p_partkey")
    img = _t(spark, sf_dir, "part").select(
        (k * 20011).alias("n_bytes"),
        F.element_at(F.array(*map(F.lit, ("JPEG", "PNG", "GIF", "WEBP"))), (k % 4 + 1).cast("int")).alias("format"),
        (F.when(k % 9 == 0, 2).otherwise(1)).alias("frames"),
        (k % 9000 + 100).alias("width"),
        (F.col("p_size") * 150).alias("height"),
    )
    return eligibility.reason_counts(img.withColumn("reason", eligibility.image_reason()))


def hash_rank_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 50 documents of smallest hash."""
    d = _t(spark, sf_dir, "documents").select("doc_id")
    return eligibility.hash_sample(d, "doc_id", 50).select("doc_id", "rank_hash")


def hash_rank_first_successes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first 10 labelled documents of good quality among the 200 of smallest hash."""
    d = _t(spark, sf_dir, "documents").select("doc_id").join(_t(spark, sf_dir, "labels"), "doc_id", "left")
    return eligibility.first_successes(d, "doc_id", F.col("quality") == 1, 10).select("doc_id", "rank_hash")


def exact_copy_antijoin(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents by language that are no copies of evaluation texts and carry no evaluation id."""
    d = _t(spark, sf_dir, "documents").select("doc_id", "lang", F.sha2("text", 256).alias("digest"))
    ref = _t(spark, sf_dir, "benchmark").select("item_id", F.sha2("text", 256).alias("digest"))
    left = eligibility.without_copies(d, ref, [("digest", "digest"), ("doc_id", "item_id")])
    return left.groupBy("lang").agg(F.count(F.lit(1)).alias("n"))


def duplicate_ids_semijoin(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of sampled documents that the whole table repeats."""
    d = _t(spark, sf_dir, "documents").select("doc_id", F.sha2("text", 256).alias("digest"))
    chosen = eligibility.hash_sample(d, "doc_id", 100)
    return eligibility.repeated_ids(d, chosen, "digest")


def _vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _t(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("image_id"), "embedding")


def similar_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pairs of vectors of cosine 0.40 or more."""
    p = similarity.similar_pairs(_vectors(spark, sf_dir), 0.40)
    return p.select("left_id", "right_id", F.round("cosine", 6).alias("cosine"))


def visual_components(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Visual groups by near copies, with the hash of their sorted members."""
    v = _vectors(spark, sf_dir)
    roots = components.components(similarity.similar_links(v, 0.40))
    return similarity.group_ids(v.select("image_id"), roots)


def declared_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of orders by exact key (customer and day) and declared groups (clerk-like keys)."""
    o = _t(spark, sf_dir, "orders").where("o_orderkey is not null")
    images = o.select(F.col("o_orderkey").alias("image_id"), F.concat_ws("|", _s("o_custkey"), F.date_format("o_orderdate", "yyyy-MM")).alias("canonical_pixel_sha256"), F.array(F.concat_ws("|", _s("o_custkey"), "o_orderpriority")).alias("source_group_ids"))
    edges = similarity.key_edges(images, "image_id", F.col("canonical_pixel_sha256")).unionByName(similarity.key_edges(images.select("image_id", F.explode("source_group_ids").alias("g")), "image_id", F.col("g")))
    roots = components.components(edges)
    named = images.select("image_id").join(roots, F.col("image_id") == F.col("node"), "left").select("image_id", F.coalesce("root", "image_id").alias("root"))
    return named.groupBy("root").agg(F.count(F.lit(1)).alias("n"), F.max("image_id").alias("last_id"))


# -- planning -------------------------------------------------------------------------------


def _language_weights(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _t(spark, sf_dir, "documents").groupBy(F.col("lang").alias("tag")).agg(F.count(F.lit(1)).alias("weight"))


def apportion_quotas(spark: SparkSession, sf_dir: str) -> DataFrame:
    """97 places over languages by largest remainder."""
    return planning.apportion(_language_weights(spark, sf_dir), F.lit(97))


def exact_schedule(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A schedule with a place for each document over languages, zipped by position with documents in order of id."""
    docs = _t(spark, sf_dir, "documents").select("doc_id")
    weights = _language_weights(spark, sf_dir).withColumn("weight", F.col("weight") + 3)
    plan = planning.schedule(planning.apportion(weights, F.lit(docs.count())), "languages")
    own = planning.ordinals(docs, ["doc_id"], F.expr("doc_id div 64"))
    return planning.positional(plan, own).select("ordinal", "doc_id", "tag")


def weighted_roles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A generator for each conversation by cumulative weights."""
    c = _t(spark, sf_dir, "conversations").select(_s("conv_id").alias("conversation_id")).distinct()
    return c.select("conversation_id", planning.weighted_role(F.col("conversation_id"), {"generator_a": 3, "generator_b": 1, "generator_c": 2}).alias("role"))


def planned_turns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Planned number of turns of each conversation's image."""
    c = _t(spark, sf_dir, "conversations").select(_s("conv_id").alias("image_id")).distinct()
    return c.select("image_id", hashing.planned_turns(F.col("image_id")).alias("planned_turns"))


def _evidence(spark: SparkSession, sf_dir: str) -> DataFrame:
    caps = F.array(*map(F.lit, catalogs.capabilities()))
    have = lambda c: bucket(sha(F.col("image_id"), c), 100) < 50
    img = _t(spark, sf_dir, "documents").select(_s("doc_id").alias("image_id"))
    scopes = F.when(F.col("image_id").cast("long") % 3 == 0, F.array().cast("array<string>")).otherwise(F.array(F.lit("left"), F.lit("right")))
    return img.select("image_id", F.lit(1).alias("turn_index"), F.filter(caps, have).alias("capabilities"), scopes.alias("visible_scopes"))


def instruction_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first eight candidates of each image by hash."""
    return planning.candidates(_evidence(spark, sf_dir)).select("image_id", "task_id", "family", "visible_scope", "candidate_id", F.col("position").cast("int").alias("position"))


# -- judging --------------------------------------------------------------------------------


def _judged(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = _t(spark, sf_dir, "documents").select("doc_id", "lang").join(_t(spark, sf_dir, "labels"), "doc_id", "left")
    a = F.when(F.col("quality") == 1, "MET").when(F.col("quality") == 0, "NOT_MET").otherwise("UNKNOWN")
    b = F.when(F.col("toxic") == 0, "MET").when(F.col("toxic") == 1, "NOT_MET").otherwise("UNKNOWN")
    return d.select("doc_id", "lang", a.alias("a"), b.alias("b"))


def judge_consensus(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Consensus of two judges by language and verdict."""
    v = _judged(spark, sf_dir).select("doc_id", "lang", F.explode(F.array("a", "b")).alias("verdict"))
    return consensus.paired(v, ["doc_id", "lang"]).groupBy("lang", "verdict").agg(F.count(F.lit(1)).alias("n"))


def question_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Question-fit aggregates of each document's three verdicts, and their consensus with judge b."""
    c = F.when(F.col("doc_id") % 5 == 0, "UNKNOWN").otherwise("MET")
    j = _judged(spark, sf_dir).select("doc_id", consensus.question_fit(F.col("a"), c).alias("fit"), "b")
    return j.groupBy("fit", consensus.agree(F.col("fit"), F.col("b")).alias("agreed")).agg(F.count(F.lit(1)).alias("n"))


def _items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdicts of every rubric item of every labelled document, by hash."""
    lab = _t(spark, sf_dir, "labels").select("doc_id", "quality", "toxic")
    r = F.broadcast(catalogs.rubric_table(spark).select("template_id", "use"))
    rows = lab.crossJoin(r).withColumn("b", bucket(sha(F.col("doc_id"), F.col("template_id")), 100))
    raw = F.when(F.col("b") < 90, "MET").when(F.col("b") < 93, "NOT_MET").when(F.col("b") < 96, "UNKNOWN").when(F.col("b") < 99, "NOT_APPLICABLE").otherwise("ERROR")
    rows = rows.withColumn("raw", raw)
    cover = F.when(F.col("quality") == 1, "MET").otherwise("NOT_MET")
    computed = F.when(F.col("doc_id") % 4 == 0, F.lit(None).cast("string")).when(F.col("doc_id") % 4 == 1, "UNKNOWN").otherwise("MET")
    sets = F.when(F.col("doc_id") % 3 == 0, F.lit(None).cast("string")).when(F.col("toxic") == 1, "NOT_MET").otherwise("MET")
    return rows.select("doc_id", "template_id", "use", consensus.overridden(F.col("template_id"), F.col("raw"), cover, computed, sets).alias("verdict"))


def gate_aggregate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Gate aggregate of each labelled document after overrides."""
    return consensus.gate_aggregate(_items(spark, sf_dir), ["doc_id"]).select("doc_id", F.col("n_items").cast("long").alias("n_items"), "aggregate")


def rubric_applicability(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many rubric items with their subjects apply, by template."""
    k, none = F.col("doc_id"), F.array().cast("array<string>")
    listed = lambda n, name: F.when(k % n == 0, F.array(F.lit(name + "1"), F.lit(name + "2"))).otherwise(none)
    ctx = _t(spark, sf_dir, "documents").select(
        k.alias("conversation_id"),
        (k % 4 + 1).cast("int").alias("turn_index"),
        (k % 2 == 0).alias("has_natural_language_answer"),
        listed(3, "b").alias("history_binding_ids"),
        listed(5, "c").alias("computation_ids"),
        listed(7, "s").alias("exhaustive_scope_ids"),
        listed(2, "f").alias("format_requirements"),
        listed(4, "r").alias("requirements"),
        listed(6, "a").alias("claims"),
        F.when(k % 10 == 0, "limitation").when(k % 10 == 1, "false_premise").otherwise("normal").alias("profile"),
        F.lit(False).alias("requires_witness_check"),
    )
    rows = consensus.with_subjects(consensus.applicable(ctx))
    return rows.groupBy("template_id", "subject_id").agg(F.count(F.lit(1)).alias("n"))


def capability_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Correct and unknown outcomes by split and stratum."""
    j = _judged(spark, sf_dir)
    out = j.select(hashing.split_of(F.col("doc_id")).alias("split"), F.col("lang").alias("stratum"), (F.col("doc_id") % 2 == 0).alias("expected_accept"), consensus.agree(F.col("a"), F.col("b")).alias("verdict"))
    return consensus.capability_report(out)


# -- transcripts ------------------------------------------------------------------------------


def _messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _t(spark, sf_dir, "conversations").select(_s("conv_id").alias("conversation_id"), F.col("turn").cast("int").alias("position"), "role", F.col("text").alias("content"))


def transcript_validity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contiguous positions and alternating roles of each conversation."""
    return transcript.validity(_messages(spark, sf_dir))


def history_prefix_hash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Identity of the history before each turn."""
    h = transcript.histories(_messages(spark, sf_dir))
    return h.select("conversation_id", "turn_index", F.col("n_history").cast("long").alias("n_history"), "history_hash")


def _turns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All events as turns: a user's events are one conversation, however long."""
    t = _t(spark, sf_dir, "events").select(_s("user_id").alias("conversation_id"), "event_id")
    t = t.withColumn("turn_index", F.row_number().over(W.partitionBy("conversation_id").orderBy("event_id")))
    b = bucket(sha(F.col("conversation_id"), F.col("turn_index")), 100)
    return t.select("conversation_id", "turn_index", F.when(b < 80, "COMMITTED").when(b < 90, "REJECTED").when(b < 97, "ABSTAINED").otherwise("ERROR").alias("status"))


def accepted_prefix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Committed prefix and terminal status of each conversation."""
    return transcript.accepted_prefixes(_turns(spark, sf_dir))


def trailing_turns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Turns after a stop, by status."""
    return transcript.trailing_turns(_turns(spark, sf_dir)).groupBy("status").agg(F.count(F.lit(1)).alias("n"))


def conversation_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sparse counts by dataset of statuses, conversations and committed turns."""
    p = transcript.accepted_prefixes(_turns(spark, sf_dir))
    dataset = F.when(F.col("conversation_id").cast("int") % 3 == 0, F.lit(None).cast("string")).otherwise(F.concat(F.lit("set"), (F.col("conversation_id").cast("int") % 3).cast("string")))
    return transcript.summary(p.withColumn("dataset", dataset))


def repeated_questions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Questions repeated in another case and with other punctuation (every second conversation gets one)."""
    m = _messages(spark, sf_dir)
    again = m.where((F.col("role") == "user") & (F.col("conversation_id").cast("int") % 2 == 0))
    again = again.select("conversation_id", (F.col("position") + 100).alias("position"), "role", F.concat(F.lit("  "), F.upper("content"), F.lit(" ?!")).alias("content"))
    return transcript.repeated_questions(m.unionByName(again))


def prompt_echo(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that hold a passage of 80 characters or more, or lie in one, in folded case."""
    texts = _t(spark, sf_dir, "documents").select(F.col("doc_id").alias("id"), "text")
    prompts = _t(spark, sf_dir, "benchmark").select(F.col("item_id").alias("id"), "text")
    return transcript.prompt_echoes(texts, prompts)


def answer_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Number and identity of each message's tokens with their offsets."""
    m = _messages(spark, sf_dir).withColumn("t", text.tokens(F.col("content")))
    shown = F.array_join(F.transform("t", lambda x: F.concat_ws(":", x["start"].cast("string"), x["end"].cast("string"), x["text"])), " ")
    return m.select("conversation_id", "position", F.size("t").cast("long").alias("n_tokens"), F.sha2(shown, 256).alias("tokens_hash"))


def claim_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens 2 to 5 of each answer bound to text and offsets; too short answers have none."""
    m = _messages(spark, sf_dir).where("role = 'assistant'").withColumn("t", text.tokens(F.col("content")))
    s = m.withColumn("s", text.bind_span(F.col("content"), F.col("t"), F.lit(2), F.lit(6)))
    return s.select("conversation_id", "position", F.col("s.text").alias("span"), F.col("s.start").cast("long").alias("start_at"), F.col("s.end").cast("long").alias("end_at"))


def span_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quotes with a wrong offset, put right where they occur once."""
    m = _messages(spark, sf_dir).where("role = 'user'")
    q = m.withColumn("quote", F.substring("content", 4, 5))
    fixed = text.repaired_span(F.col("content"), F.col("quote"), F.lit(7), F.lit(7) + F.length("quote"))
    return q.select("conversation_id", "position", "quote", fixed.cast("long").alias("start_at"))


def training_export(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Identity of each valid conversation's public training record."""
    m = _messages(spark, sf_dir)
    ok = transcript.validity(m).where("contiguous and alternating and n_messages between 4 and 12").select("conversation_id")
    records = transcript.training_parts(m.join(ok, "conversation_id"), ok.withColumn("image_id", F.concat(F.lit("img-"), "conversation_id")))
    return transcript.training_hash(records).select("conversation_id", F.col("n_messages").cast("long").alias("n_messages"), "record_hash")


# -- exact checks -----------------------------------------------------------------------------


def set_compare(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts of each order: expected by one rule, reported by another, compared as sets."""
    li = _t(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", F.lpad(_s("l_partkey"), 8, "0").alias("part"), "l_returnflag")
    g = li.groupBy("l_orderkey").agg(F.collect_set("part").alias("expected"), F.collect_list(F.when(F.col("l_returnflag") != "R", F.col("part"))).alias("some"), F.max(F.when(F.col("l_linenumber") == 2, F.col("part"))).alias("twice"))
    g = g.withColumn("reported", F.concat("some", F.when(F.col("twice").isNotNull() & (F.col("l_orderkey") % 3 == 0), F.array("twice", F.lit("extra"))).otherwise(F.array().cast("array<string>"))))
    c = g.select("l_orderkey", rules.compare_sets(F.col("expected"), F.col("reported")).alias("c"))
    return c.select("l_orderkey", F.col("c.verdict").alias("verdict"), *[F.array_join(F.col(f"c.{k}"), ",").alias(k) for k in ("missing", "unexpected", "duplicates")])


def count_compare(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line counts of each order by return flag against every flag's quota of two."""
    li = _t(spark, sf_dir, "lineitem").groupBy("l_orderkey", "l_returnflag").agg(F.count(F.lit(1)).cast("int").alias("reported"))
    g = li.groupBy("l_orderkey").agg(F.array_sort(F.collect_list(F.struct(F.col("l_returnflag").alias("scope"), F.lit(2).alias("expected"), "reported"))).alias("counts"))
    c = g.select("l_orderkey", rules.compare_counts(F.col("counts")).alias("c"))
    return c.select("l_orderkey", F.col("c.verdict").alias("verdict"), F.array_join("c.missing", ",").alias("missing"), F.array_join("c.unexpected", ",").alias("unexpected"))


def exact_arithmetic(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sum of each order's prices as written, against a reported total that is off by a cent now and then."""
    li = _t(spark, sf_dir, "lineitem").select("l_orderkey", numbers.lexeme_value(F.col("l_extendedprice").cast("decimal(18,2)").cast("string")).alias("v"))
    total = li.withColumn("reported", F.sum("v").over(W.partitionBy("l_orderkey")) + F.when(F.col("l_orderkey") % 5 == 0, F.lit(0.01).cast("decimal(38,6)")).otherwise(F.lit(0).cast("decimal(38,6)")))
    out = rules.exact_sum_check(total, "l_orderkey", "v", "reported")
    return out.select("l_orderkey", "n", (F.col("total") * 100).cast("bigint").alias("total_cents"), "verdict")


def computation_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two inventories of each order's quantity times its highest price, as lexemes with units, verified exactly."""
    li = _t(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.sum("l_quantity").alias("l_quantity"), F.max("l_extendedprice").alias("l_extendedprice"))
    lex = lambda v, unit: F.struct(v.alias("value"), F.lit(".").alias("decimal_separator"), F.lit(None).cast("string").alias("group_separator"), unit.alias("unit"))
    q, p = F.col("l_quantity").cast("decimal(18,2)"), F.col("l_extendedprice").cast("decimal(18,2)")
    eur, bare = F.lit("EUR"), F.lit(None).cast("string")
    product = (q * p + F.when(F.col("l_orderkey") % 7 == 0, F.lit(1)).otherwise(F.lit(0))).cast("decimal(36,4)")
    judge = F.explode(F.array(F.lit("a"), F.lit("b")))
    rows = li.select("l_orderkey", judge.alias("judge"), q.alias("q"), p.alias("p"), product.alias("r"))
    inv = rows.select(
        F.col("l_orderkey").alias("key"),
        F.when((F.col("l_orderkey") % 11 == 0) & (F.col("judge") == "b"), "UNKNOWN").otherwise("MET").alias("coverage"),
        F.lit("multiply").alias("operation"),
        F.array(lex(_s("q"), bare), lex(_s("p"), eur)).alias("operands"),
        lex(_s("r"), F.when(F.col("l_orderkey") % 13 == 0, F.lit("USD")).otherwise(eur)).alias("reported_result"),
    )
    return rules.verify_computations(inv).select(F.col("key").alias("l_orderkey"), "verdict")


def requirement_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events of users in the role of requirement actions of conversations."""
    e = _t(spark, sf_dir, "events")
    kind = F.element_at(F.array(*map(F.lit, ("introduce", "retain", "override", "revoke", "introduce"))), (F.col("event_id") % 5 + 1).cast("int"))
    w = W.partitionBy("user_id").orderBy("event_id")
    return e.select(
        _s("user_id").alias("conversation_id"),
        F.expr("cast(row_number() over (partition by user_id order by event_id) as int)").alias("turn_index"),
        F.col("event_id").alias("seq"),
        kind.alias("action"),
        F.lag(F.concat(F.lit("q"), _s("event_id"))).over(w).alias("previous_requirement_id"),
        F.concat(F.lit("q"), _s("event_id")).alias("requirement_id"),
        F.lit("persistent").alias("lifetime"),
    )


def requirement_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Requirement events of each user folded into active requirements and the first error."""
    rows = requirement_events(spark, sf_dir)
    return requirements.ledger(rows).groupBy(F.coalesce("error", F.lit("none")).alias("error")).agg(F.count(F.lit(1)).alias("n"), F.max("n_active").alias("most_active"))


# -- selection --------------------------------------------------------------------------------


def _pool(spark: SparkSession, sf_dir: str) -> DataFrame:
    o, c = _t(spark, sf_dir, "orders"), _t(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment", "c_nationkey")
    j = o.join(c, o["o_custkey"] == c["c_custkey"])
    return j.select(
        _s("o_orderkey").alias("conversation_id"),
        F.col("c_mktsegment").alias("language"),
        _s("o_custkey").alias("image_id"),
        _s("c_nationkey").alias("visual_group_id"),
        F.col("o_orderstatus").alias("task_family"),
        _s("o_orderkey").alias("semantic_family"),
        F.lit("normal/normal").alias("pattern"),
        F.when(F.col("o_orderkey") % 9 == 0, "evaluation").otherwise("training").alias("purpose"),
    )


def pool_bounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many conversations of each language the caps let through."""
    p = _pool(spark, sf_dir).where("purpose = 'training'")
    return pool.bounds(p, "language", {"image_id": 3, "visual_group_id": 6})


def capped_selection(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversations that stay when images and groups are capped in turn by hash."""
    p = _pool(spark, sf_dir).where("purpose = 'training'")
    return pool.capped(p, {"image_id": 1, "visual_group_id": 6}).select("conversation_id", "image_id", "visual_group_id")


def selection_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The capped selection recounted by language and family, with its maxima and violations."""
    p = _pool(spark, sf_dir)
    chosen = saved(pool.capped(p.where("purpose = 'training'"), {"image_id": 1, "visual_group_id": 6}).select("conversation_id"), "chosen")
    policy = pool.Policy(target_count=150, language_quotas={"BUILDING": 30}, max_per_image=1, max_per_visual_group=5)
    r = pool.audit(p, chosen, policy)
    rows = [("selected", r["selected_count"]), ("image_maximum", r["image_maximum"]), ("visual_group_maximum", r["visual_group_maximum"])]
    rows += [(f"family:{k}", v) for k, v in r["family_counts"].items()] + [(f"violation:{v}", 1) for v in r["violations"]]
    return spark.createDataFrame(rows, "key string, n long")


#: Exact numbers by language, least by family, most by image and group.
SELECTION = pool.Policy(target_count=60, language_quotas={"BUILDING": 15, "AUTOMOBILE": 15, "MACHINERY": 10, "HOUSEHOLD": 10, "FURNITURE": 10}, family_minimums={"F": 10, "O": 10}, max_per_image=1, max_per_visual_group=6)


def constrained_selection(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A feasible selection of 60 under quotas, minimums and caps, with its audit's status."""
    p = _pool(spark, sf_dir)
    found = pool.select_candidates(p, SELECTION)
    chosen = spark.createDataFrame([(x,) for x in found.selected_ids], "conversation_id string")
    report = pool.audit(p, chosen, SELECTION)
    return chosen.withColumn("solver_status", F.lit(found.status)).withColumn("audit_status", F.lit(report["status"]))


def tight_selection(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A selection where every group of a language is full: languages with what they have to offer and what was selected.

    As many rows as the caps let through at most are asked of the two languages with the
    fewest groups' rooms to spare, so rounds alone rarely find them and exchange paths must.
    """
    p = saved(_pool(spark, sf_dir).where("purpose = 'training' and language in ('BUILDING', 'MACHINERY')"), "pool")
    groups = p.select("visual_group_id").distinct().count()
    policy = pool.Policy(target_count=2 * (groups // 2), language_quotas={"BUILDING": groups // 2, "MACHINERY": groups // 2}, max_per_image=1, max_per_visual_group=1)
    found = pool.select_candidates(p, policy)
    chosen = spark.createDataFrame([(x,) for x in found.selected_ids], "conversation_id string")
    met = pool.audit(p, chosen, policy)["status"] == "MET"
    own = chosen.join(p, "conversation_id").groupBy("language").agg(F.count(F.lit(1)).alias("selected"))
    have = p.groupBy("language").agg(F.count(F.lit(1)).alias("available"))
    return have.join(own, "language", "left").select("language", "available", F.coalesce("selected", F.lit(0)).cast("long").alias("selected"), F.lit(found.status).alias("status"), F.lit(met).alias("met"))


# -- ledgers ----------------------------------------------------------------------------------


def _calls(spark: SparkSession, sf_dir: str, recorded: bool = False) -> DataFrame:
    tokens = F.coalesce(F.get_json_object("props", "$.k").cast("bigint"), F.lit(0).cast("bigint"))
    ms = F.round(F.col("value")).cast("bigint") if recorded else F.lit(0).cast("bigint")
    return _t(spark, sf_dir, "events").select(
        F.col("event_id").alias("seq"),
        F.col("event_type").alias("stage"),
        F.concat(F.lit("model"), (F.col("user_id") % 2).cast("string")).alias("model_repo"),
        F.lit("lock").alias("model_lock_hash"),
        F.sha2(F.concat_ws(":", "event_type", (F.col("user_id") % 50).cast("string")), 256).alias("request_hash"),
        F.sha2(_s("event_id"), 256).alias("response_hash"),
        tokens.alias("input_tokens"),
        (tokens * 2).alias("output_tokens"),
        ms.alias("duration_ms"),
        F.when(F.col("event_id") % 10 == 3, "INVALID").otherwise("COMPLETE").alias("status"),
        F.col("ts").cast("timestamp").alias("created_at"),
    )


def call_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Calls by stage and model with recorded durations."""
    return ledger.profile(_calls(spark, sf_dir, True))


def completion_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Calls by stage and model where durations are gaps between completions."""
    return ledger.profile(_calls(spark, sf_dir)).drop("mean_duration_ms")


def run_wall(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Wall time and calls per minute of the run."""
    return ledger.wall(_calls(spark, sf_dir))


def first_write_wins(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first call of each key, complete or not."""
    return ledger.first_writes(_calls(spark, sf_dir)).select("stage", "request_hash", "seq", "status")


def cache_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Requests that a complete first call answers, by stage: each event asks again, every seventh for something new."""
    c = _calls(spark, sf_dir)
    asked = c.select("model_lock_hash", "stage", F.when(F.col("seq") % 7 == 0, F.sha2(_s("seq"), 256)).otherwise(F.col("request_hash")).alias("request_hash"))
    got = ledger.cached(asked, c)
    return got.groupBy("stage").agg(F.count(F.lit(1)).alias("requests"), F.count("response_hash").alias("hits"))


def budget_running(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Running budget of each run (user) over reservations, releases and final counts."""
    e = _t(spark, sf_dir, "events")
    action = F.element_at(F.array(*map(F.lit, ("reserve", "reserve", "finalize", "release"))), (F.expr("row_number() over (partition by user_id order by event_id)") % 4 + 1).cast("int"))
    rows = e.select((F.col("user_id")).alias("run_id"), F.col("event_id").alias("seq"), action.alias("action"), F.lit(100).alias("reserved"), (F.col("event_id") % 90).alias("actual"))
    return ledger.budget(rows, 20, 1200)


def content_addressing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct texts as blobs with their paths, sizes and numbers of rows."""
    return ledger.blobs(_t(spark, sf_dir, "documents").select("text"), "text", "texts")


def blob_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows whose text comes back unchanged from the table of distinct blobs, by language."""
    d = _t(spark, sf_dir, "documents").select("doc_id", "lang", "text")
    rows, table = ledger.extract_blobs(d, "text")
    back = ledger.restore_blobs(rows, table).select("doc_id", F.sha2("text", 256).alias("h"))
    same = d.select("doc_id", "lang", F.sha2("text", 256).alias("h0")).join(back, "doc_id").where("h = h0")
    return same.groupBy("lang").agg(F.count(F.lit(1)).alias("n"))


def ledger_verification(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Artifacts, corrupt blobs, calls and missing responses of a ledger."""
    d = _t(spark, sf_dir, "events").select(_s("event_id").alias("e"), "event_id")
    content = F.when(F.col("event_id") % 50 == 7, F.concat("e", F.lit("!"))).otherwise(F.col("e"))
    blobs = d.where("event_id % 20 <> 1").select(F.sha2("e", 256).alias("digest"), content.alias("content"))
    return ledger.verify(blobs, _calls(spark, sf_dir))


def strict_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Event properties, and broken forms of them, by what strict parsing says."""
    e = _t(spark, sf_dir, "events").select("event_id", "props")
    k = F.col("event_id") % 6
    broken = F.when(k == 1, F.concat("props", F.lit(" x"))).when(k == 2, F.concat(F.lit("["), "props", F.lit("]"))).when(k == 3, F.lit('{"a":NaN}')).when(k == 4, F.lit('{"a":1,"a":2}')).otherwise(F.col("props"))
    return e.select(F.coalesce(text.strict_json_error(broken), F.lit("OK")).alias("outcome")).groupBy("outcome").agg(F.count(F.lit(1)).alias("n"))


def completion_envelopes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Completions by the first thing wrong with them."""
    k = F.col("event_id")
    reason = text.completion_error(
        F.when(k % 7 == 0, "length").when(k % 17 == 0, "error").otherwise("stop"), F.when(k % 31 == 0, 2).otherwise(1), F.when(k % 11 == 0, "  ").when(k % 2 == 0, '{"a":[1').otherwise('{"a":"x'), F.when(k % 13 == 0, 1).otherwise(0), k % 100, k % 1100, 1024
    )
    return _t(spark, sf_dir, "events").select(F.coalesce(reason, F.lit("OK")).alias("outcome")).groupBy("outcome").agg(F.count(F.lit(1)).alias("n"))


def media_suffixes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """File suffixes of pages by media type or URL."""
    p = _t(spark, sf_dir, "pages").select("page_id", "url")
    kind = F.when(F.col("page_id") % 3 == 0, "image/png").when(F.col("page_id") % 3 == 1, "text/html")
    url = F.when(F.col("page_id") % 2 == 0, F.concat(F.lit("https://example.org/"), _s("page_id"), F.lit(".JPEG?x=1"))).otherwise(F.col("url"))
    return p.select(F.coalesce(text.media_suffix(kind, url), F.lit("unsupported")).alias("suffix")).groupBy("suffix").agg(F.count(F.lit(1)).alias("n"))


def remaining_turns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Turns left to do of each conversation, after a committed prefix."""
    c = _t(spark, sf_dir, "conversations").select(_s("conv_id").alias("conversation_id")).distinct()
    planned = c.select("conversation_id", hashing.planned_turns(F.col("conversation_id")).alias("planned_turns"))
    done = planned.select("conversation_id", F.explode(F.sequence(F.lit(1), F.lit(2))).alias("turn_index")).where("cast(conversation_id as int) % 2 = 0")
    return ledger.remaining_turns(planned, done)


QUERIES = {
    f.__name__: f
    for f in (
        split_after_contamination, rights_window_filter, eligibility_reason_counts, validation_eligibility, train_metadata_sample, probed_train_sample, pinned_provenance, image_gates,
        hash_rank_sample, hash_rank_first_successes, exact_copy_antijoin, duplicate_ids_semijoin, similar_pairs, near_vectors, visual_components, declared_groups,
        apportion_quotas, exact_schedule, weighted_roles, planned_turns, instruction_candidates, judge_consensus, question_fit, gate_aggregate, rubric_applicability, capability_report,
        transcript_validity, history_prefix_hash, accepted_prefix, trailing_turns, conversation_summary, repeated_questions, prompt_echo, answer_tokens, claim_spans, span_repair, training_export,
        set_compare, count_compare, exact_arithmetic, computation_check, requirement_ledger, pool_bounds, capped_selection, selection_audit, constrained_selection, tight_selection,
        call_profile, completion_gaps, run_wall, first_write_wins, cache_lookup, budget_running, content_addressing, blob_roundtrip, ledger_verification, strict_json, completion_envelopes, media_suffixes, remaining_turns,
    )
}

__all__ = ["QUERIES", "SEED"]
