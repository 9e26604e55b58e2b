"""Transcripts: validity, histories, prefixes, terminal states, repeated questions, exports."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from corpusflow.functions.catalogs import FORBIDDEN_FIELDS, SCOPES, STAGE_FIELDS
from corpusflow.functions.hashing import json_column
from corpusflow.functions.text import ECHO_LEAST, folded, normalized_question
from corpusflow.operators.eligibility import containments
from corpusflow.session import saved

MIN_TURNS, MAX_TURNS = 2, 6


def validity(messages: DataFrame) -> DataFrame:
    """conversation_id, n_messages, contiguous (positions 0..n-1), alternating (user first, then in turn)."""
    w = W.partitionBy("conversation_id").orderBy("position")
    rows = messages.select("conversation_id", "position", "role", (F.row_number().over(w) - 1).alias("expected"))
    role = F.when(F.col("expected") % 2 == 0, "user").otherwise("assistant")
    return rows.groupBy("conversation_id").agg(
        F.count(F.lit(1)).alias("n_messages"),
        F.min((F.col("position") == F.col("expected")).cast("int")).cast("boolean").alias("contiguous"),
        F.min(F.col("role").eqNullSafe(role).cast("int")).cast("boolean").alias("alternating"),
    )


def with_ids(messages: DataFrame) -> DataFrame:
    """Messages by position (0-based, question and answer in turn) with turn_index and message_id."""
    turn = F.expr("cast(position div 2 as int) + 1")
    kind = F.when(F.col("position") % 2 == 0, "q").otherwise("a")
    return messages.withColumn("turn_index", turn).withColumn("message_id", F.concat_ws(":", "conversation_id", kind, turn.cast("string")))


def histories(messages: DataFrame) -> DataFrame:
    """conversation_id, turn_index, n_history, history_hash: the identity of all messages before a turn.

    The hash is over the canonical JSON list of message objects, ``[]`` for the first turn.
    Messages pass in order through a running hash, so none is held or hashed twice.
    """
    one = json_column(**{c: F.col(c) for c in ("content", "message_id", "role", "turn_index")})
    rows = with_ids(messages).select("conversation_id", "turn_index", F.expr("coalesce(position % 2 = 0, false)").alias("first"), one.alias("j"), "position")
    rows = rows.repartition("conversation_id").sortWithinPartitions("conversation_id", "position", "j")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, n, digest, any_yet = None, 0, hashlib.sha256(b"["), False
        for batch in batches:
            hashes, counts = [], []
            for k, first, j in zip(*(batch.column(c).to_pylist() for c in ("conversation_id", "first", "j")), strict=True):
                if not any_yet or k != key:
                    key, n, digest, any_yet = k, 0, hashlib.sha256(b"["), True
                if first:
                    whole = digest.copy()
                    whole.update(b"]")
                hashes.append(whole.hexdigest() if first else None)
                counts.append(n)
                digest.update((b"," if n else b"") + j.encode("utf-8"))
                n += 1
            yield pa.RecordBatch.from_arrays([batch.column("conversation_id"), batch.column("turn_index"), pa.array(counts, pa.int32()), pa.array(hashes, pa.string())], ["conversation_id", "turn_index", "n_history", "history_hash"])

    kind = messages.schema["conversation_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"conversation_id {kind}, turn_index int, n_history int, history_hash string").where("history_hash is not null")


def accepted_prefixes(turns: DataFrame, retain: bool = True, min_turns: int = MIN_TURNS, planned: DataFrame | None = None) -> DataFrame:
    """Terminal state of conversations from their turns (conversation_id, turn_index, status).

    Columns: conversation_id, n_turns, committed_turns (before the first turn that isn't
    committed), stop_status, status. A stop decides the status: REJECTED, ABSTAINED or ERROR;
    with ``retain`` a committed prefix of ``min_turns`` or more of a rejected or abstained
    conversation is still a candidate. Conversations that are too short are rejected. With
    ``planned`` (conversation_id, planned_turns; the detailed mode) a candidate whose committed
    turns aren't all that were planned is rejected too.
    """
    stops = F.when(F.col("status") != "COMMITTED", F.struct("turn_index", "status"))
    g = turns.groupBy("conversation_id").agg(F.count(F.lit(1)).alias("n_turns"), F.min(stops).alias("stop"))
    at = g.where("stop is not null").select(F.col("conversation_id").alias("__c"), F.col("stop.turn_index").alias("__at"))
    early = turns.join(at, F.col("conversation_id").eqNullSafe(F.col("__c")) & (F.col("turn_index") < F.col("__at"))).groupBy("__c").agg(F.count(F.lit(1)).alias("__n"))
    g = g.join(early, F.col("conversation_id").eqNullSafe(F.col("__c")), "left")
    g = g.withColumn("committed_turns", F.when(F.col("stop").isNull(), F.col("n_turns")).otherwise(F.coalesce("__n", F.lit(0))).cast("long"))
    stop = F.col("stop.status")
    kept = F.lit(retain) & stop.isin("REJECTED", "ABSTAINED") & (F.col("committed_turns") >= min_turns)
    status = F.when(stop.isNull() & (F.col("n_turns") >= min_turns), "QUALITY_CANDIDATE").when(stop.isNull(), "REJECTED").when(kept, "QUALITY_CANDIDATE").otherwise(stop)
    g = g.select("conversation_id", "n_turns", "committed_turns", stop.alias("stop_status"), status.alias("status"))
    if planned is None:
        return g
    whole = planned.select(F.col("conversation_id").alias("__p"), F.col("planned_turns").alias("__m"))
    short = (F.col("status") == "QUALITY_CANDIDATE") & ~F.col("committed_turns").eqNullSafe(F.col("__m").cast("long"))
    return g.join(whole, F.col("conversation_id").eqNullSafe(F.col("__p")), "left").withColumn("status", F.when(short, "REJECTED").otherwise(F.col("status"))).drop("__p", "__m")


def trailing_turns(turns: DataFrame) -> DataFrame:
    """Turns that follow one that isn't committed, which no valid conversation has.

    The first stop of each conversation is a minimum by partial aggregation, joined back.
    """
    stop = turns.where("status <> 'COMMITTED'").groupBy("conversation_id").agg(F.min("turn_index").alias("__stop"))
    return turns.join(stop, "conversation_id").where("turn_index > __stop").drop("__stop")


def repeated_questions(messages: DataFrame) -> DataFrame:
    """User messages that repeat an earlier one of their conversation after normalization: with ``first_position``."""
    users = messages.where(F.col("role") == "user").withColumn("__n", normalized_question(F.col("content")))
    first = F.min("position").over(W.partitionBy("conversation_id", "__n"))
    return users.withColumn("first_position", first).where("first_position < position").select("conversation_id", "position", "first_position")


def prompt_echoes(texts: DataFrame, prompts: DataFrame) -> DataFrame:
    """Pairs (text_id, prompt_id) of which one holds the other, in folded case, in at least 80 characters."""
    # folded once: both directions read it more than once
    t = saved(texts.select("id", folded(F.col("text")).alias("text")), "folded")
    p = prompts.select("id", folded(F.col("text")).alias("text"))
    inside = containments(t, p, ECHO_LEAST).select(F.col("long_id").alias("text_id"), F.col("short_id").alias("prompt_id"))
    # a text longer than every prompt lies in none
    longest = p.agg(F.max(F.length("text")).alias("n"))
    short = t.join(F.broadcast(longest), F.length("text") <= F.col("n")).select("id", "text")
    around = containments(p, short, ECHO_LEAST, reference="long").select(F.col("short_id").alias("text_id"), F.col("long_id").alias("prompt_id"))
    return inside.unionByName(around).distinct()


def summary(conversations: DataFrame) -> DataFrame:
    """dataset, key, n: sparse counts of statuses, conversations and committed turns; null datasets are ``unclassified``."""
    d = conversations.withColumn("dataset", F.coalesce("dataset", F.lit("unclassified")))
    by = d.groupBy("dataset", "status").agg(F.count(F.lit(1)).alias("n"), F.sum("committed_turns").cast("long").alias("turns"))
    one = F.explode(F.array(*[F.struct(k.alias("key"), v.cast("long").alias("n")) for k, v in ((F.col("status"), F.col("n")), (F.lit("conversations"), F.col("n")), (F.lit("committed_turns"), F.col("turns")))]))
    return by.select("dataset", one.alias("e")).groupBy("dataset", "e.key").agg(F.sum("e.n").cast("long").alias("n"))


def training_parts(messages: DataFrame, images: DataFrame | None = None) -> DataFrame:
    """Public records for training: conversation_id and messages, the image once in the first user message.

    Only role and content go out: ids, votes and other columns stay behind.
    """
    text = F.struct(F.lit("text").alias("type"), F.col("content").alias("text"), F.lit(None).cast("string").alias("image"))
    m = messages.select("conversation_id", F.struct("position", "role", text.alias("part")).alias("m"))
    g = m.groupBy("conversation_id").agg(F.array_sort(F.collect_list("m")).alias("ms"))
    g = g.join(images.select("conversation_id", "image_id"), "conversation_id") if images is not None else g.withColumn("image_id", F.lit(None).cast("string"))
    image = F.struct(F.lit("image").alias("type"), F.lit(None).cast("string").alias("text"), F.col("image_id").alias("image"))
    parts = F.transform("ms", lambda x, k: F.struct(F.when((k == 0) & F.col("image_id").isNotNull(), F.array(image, x["part"])).otherwise(F.array(x["part"])).alias("content"), x["role"].alias("role")))
    return g.select("conversation_id", parts.alias("messages"))


def training_hash(records: DataFrame) -> DataFrame:
    """conversation_id, n_messages, record_hash of the canonical record."""
    return records.select("conversation_id", F.size("messages").alias("n_messages"), F.sha2(json_column(conversation_id=F.col("conversation_id").cast("string"), messages=F.col("messages")), 256).alias("record_hash"))


#: What every rubric item may see.
COMMON_FIELDS = ("target_language", "public_history", "question", "criterion")


def scope_projection(df: DataFrame, scope: str) -> DataFrame:
    """The fields of ``df`` that rubric items of a scope may see, and nothing else."""
    return df.select(*[c for c in (*COMMON_FIELDS, *SCOPES[scope]) if c in df.columns])


def stage_input(df: DataFrame, stage: str) -> DataFrame:
    """``df`` if a stage may see all its columns; forbidden ones are checked first, then unknown ones.

    Rubric items (column template_id beside the stage's fields) see an inventory of claims
    only where the item is about coverage; the column is null for all others.
    """
    if stage not in STAGE_FIELDS:
        raise PermissionError(f"UNKNOWN_MODEL_STAGE: {stage}")
    leaks = sorted(set(df.columns) & set(FORBIDDEN_FIELDS))
    if leaks:
        raise PermissionError(f"MODEL_INFORMATION_LEAK: {', '.join(leaks)}")
    allowed = STAGE_FIELDS[stage].split() + ["template_id"] * (stage == "rubric_item")
    extra = sorted(set(df.columns) - set(allowed))
    if extra:
        raise PermissionError(f"MODEL_PAYLOAD_FIELD: {', '.join(extra)}")
    if "template_id" in df.columns and "candidate_claim_inventory" in df.columns:
        df = df.withColumn("candidate_claim_inventory", F.when(F.col("template_id") == "C_COVERAGE", F.col("candidate_claim_inventory")))
    return df.select(*[c for c in allowed if c in df.columns])


def references(messages: DataFrame) -> DataFrame:
    """conversation_id, reference (``m0``, ``m1``, ... by position), message_id: what a model is shown instead of ids."""
    return with_ids(messages).select("conversation_id", F.concat(F.lit("m"), F.col("position").cast("string")).alias("reference"), "message_id")


def resolved(rows: DataFrame, messages: DataFrame, column: str = "source_message_id") -> DataFrame:
    """``rows`` with references put back to ids; an unknown reference becomes null."""
    names = references(messages).withColumnRenamed("reference", column)
    return rows.join(names, ["conversation_id", column], "left").drop(column).withColumnRenamed("message_id", column)


def chosen(selections: DataFrame, candidates: DataFrame) -> DataFrame:
    """Selected candidates: keys, candidate_id and task_id; both null where nothing, or nothing offered, was chosen."""
    keys = ["image_id", "turn_index"]
    offered = candidates.select(*keys, "candidate_id", "task_id", F.lit(True).alias("__in"))
    j = selections.join(offered, [*keys, "candidate_id"], "left")
    return j.select(*keys, F.when(F.col("__in"), F.col("candidate_id")).alias("candidate_id"), "task_id", selection_status(F.col("candidate_id")).alias("status"))


def selection_status(candidate_id: Column) -> Column:
    """A selection's status follows from its id alone."""
    return F.when(candidate_id.isNotNull(), "SELECTED").otherwise("NO_SUITABLE_CANDIDATE")


def text_status(text: Column) -> Column:
    """A text's status follows from its presence alone."""
    return F.when(text.isNotNull(), "OK").otherwise("UNSUPPORTED")


def first_images(images: DataFrame, n: int) -> DataFrame:
    """The first ``n`` images in order of id, with ordinals from 0: what positional zips start from."""
    from corpusflow.operators.planning import ordinals

    top = images.orderBy("image_id").limit(n)
    return ordinals(top, ["image_id"], F.lit(0))
