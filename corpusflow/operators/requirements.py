"""Public requirements: canonical spans, reconciled inventories, and the ledger of active ones."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusflow.functions.hashing import json_column
from corpusflow.functions.text import repaired_span

_COURTESY = r"(?i)^(?:please\s+|can you\s+)"
_LEFT, _RIGHT = r"(?U)^\s+", r"[ \t\r\n.,;:?!]+\z"


def canonical_specs(specs: DataFrame, messages: DataFrame) -> DataFrame:
    """Specs with exact spans, without outer punctuation and courtesy: text, start, end (null: no such span).

    ``specs``: kind, text, lifetime, source_message_id, start, end; ``messages``:
    message_id, role, content. Only user messages can be the source.
    """
    m = messages.select(F.col("message_id").alias("source_message_id"), F.col("role").alias("__role"), F.col("content").alias("__content"))
    j = specs.join(m, "source_message_id", "left")
    at = F.when(F.col("__role") == "user", repaired_span(F.col("__content"), F.col("text"), F.col("start"), F.col("end")))
    j = j.withColumn("__at", at).withColumn("__t", F.regexp_replace("text", _RIGHT, ""))
    j = j.withColumn("__left", F.length("text") - F.length(F.regexp_replace("text", _LEFT, "")))
    j = j.withColumn("__inner", F.expr("substring(__t, __left + 1)"))
    courtesy = F.when(F.col("kind") == "content", F.length("__inner") - F.length(F.regexp_replace("__inner", _COURTESY, ""))).otherwise(0)
    j = j.withColumn("__cut", F.col("__left") + courtesy)
    valid = F.col("__at").isNotNull() & (F.col("__cut") < F.length("__t"))
    start, end = F.col("__at") + F.col("__cut"), F.col("__at") + F.length("__t")
    out = j.withColumn("text", F.when(valid, F.expr("substring(__t, __cut + 1)"))).withColumn("start", F.when(valid, start)).withColumn("end", F.when(valid, end))
    return out.drop("__role", "__content", "__at", "__t", "__left", "__inner", "__cut")


def claim_union(claims: DataFrame, answers: DataFrame) -> DataFrame:
    """key and claims: the union of all judges' claims about an answer, each once, in order of (start, end, text).

    ``claims``: key, text, start, end; ``answers``: key, content. A claim whose quote is not at
    its place is put right where the answer holds it once; else the key's union is null.
    """
    at = repaired_span(F.col("content"), F.col("text"), F.col("start"), F.col("end"))
    placed = claims.join(answers.select("key", "content"), "key").select("key", at.alias("start"), (at + F.length("text")).alias("end"), "text")
    one = F.when(F.col("start").isNotNull(), F.struct("start", "end", "text"))
    g = placed.groupBy("key").agg(F.array_sort(F.collect_set(one)).alias("claims"), F.max(F.col("start").isNull().cast("int")).alias("__lost"))
    return g.select("key", F.when(F.col("__lost") == 0, F.col("claims")).alias("claims"))


def requirement_id() -> Column:
    """Identity of a canonical spec."""
    return F.sha2(json_column(kind=F.col("kind"), text=F.col("text"), lifetime=F.col("lifetime"), source_message_id=F.col("source_message_id"), start=F.col("start"), end=F.col("end")), 256)


def reconcile(inventories: DataFrame, specs: DataFrame, messages: DataFrame) -> DataFrame:
    """Requirement ids of each key whose two inventories are complete and agree; null otherwise.

    ``inventories``: key, judge, extraction_complete; ``specs``: key, judge and a spec's columns.
    """
    ids = canonical_specs(specs, messages).select("key", "judge", F.when(F.col("text").isNotNull(), F.struct("source_message_id", "start", "end", "kind", "lifetime", requirement_id().alias("requirement_id"))).alias("r"))
    lists = ids.groupBy("key", "judge").agg(F.array_sort(F.collect_list("r")).alias("rs"), F.sum(F.col("r").isNull().cast("int")).alias("bad"))
    j = inventories.join(lists, ["key", "judge"], "left").withColumn("rs", F.coalesce("rs", F.array().cast(lists.schema["rs"].dataType)))
    g = j.groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.min(F.col("extraction_complete").cast("int")).alias("whole"), F.sum(F.coalesce("bad", F.lit(0))).alias("bad"), F.min("rs").alias("a"), F.max("rs").alias("b"))
    found = F.transform("a", lambda x: x["requirement_id"])
    usable = (F.col("n") == 2) & (F.col("whole") == 1) & (F.col("bad") == 0) & (F.col("a") == F.col("b")) & (F.size(F.array_distinct(found)) == F.size(found))
    return g.select("key", F.when(usable, found).alias("requirement_ids"))


class Ledger:
    """Active requirements of one conversation: id to (lifetime, turn)."""

    def __init__(self) -> None:
        self.turn: int | None = None
        self.active: dict[str, tuple[str, int]] = {}

    def apply(self, turn: int, action: str, old: str | None, new: str | None, lifetime: str | None) -> str | None:
        """Apply one event; the code of what is wrong with it, or null. Local requirements end with their turn."""
        if turn != self.turn:
            self.turn = turn
            self.active = {k: v for k, v in self.active.items() if v[0] == "persistent" or v[1] == turn}
        if action != "introduce":
            if old not in self.active:
                return "UNKNOWN_REQUIREMENT"
            if action == "retain":
                return None
            if action == "override" and new in self.active and new != old:
                return "DUPLICATE_REQUIREMENT"
            del self.active[old]
            if action == "revoke":
                return None
        elif new in self.active:
            return "DUPLICATE_REQUIREMENT"
        self.active[new] = (lifetime or "persistent", turn)
        return None


def ledger(events: DataFrame) -> DataFrame:
    """Fold requirement events: conversation_id, turn_index, seq, error, n_active after each event.

    ``events``: conversation_id, turn_index, seq, action, previous_requirement_id,
    requirement_id, lifetime. A conversation stops at its first error; its later events
    have the error ``STOPPED``. Rows are dealt by conversation, sorted, and streamed, so a
    long conversation needs memory for its active requirements only.
    """

    def fold(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        own, state, stopped = None, Ledger(), False
        for pdf in batches:
            out = []
            clean = pdf.astype(object).where(pdf.notna(), None)
            for r in clean.itertuples(index=False):
                if r.conversation_id != own:
                    own, state, stopped = r.conversation_id, Ledger(), False
                error = "STOPPED" if stopped else state.apply(int(r.turn_index), r.action, r.previous_requirement_id, r.requirement_id, r.lifetime)
                stopped = stopped or error is not None
                out.append((r.conversation_id, int(r.turn_index), int(r.seq), error, len(state.active)))
            yield pd.DataFrame(out, columns=["conversation_id", "turn_index", "seq", "error", "n_active"])

    cols = [F.col("conversation_id").cast("string"), F.col("turn_index").cast("int"), F.col("seq").cast("long"), *["action", "previous_requirement_id", "requirement_id", "lifetime"]]
    dealt = events.select(*cols).repartition("conversation_id").sortWithinPartitions("conversation_id", "turn_index", "seq")
    return dealt.mapInPandas(fold, "conversation_id string, turn_index int, seq long, error string, n_active int")
