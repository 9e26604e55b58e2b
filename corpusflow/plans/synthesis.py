"""The synthesis plan around a model backend: turn by turn over all conversations at once."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from typing import Protocol

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusflow.functions.catalogs import rubric_table
from corpusflow.operators import consensus, planning, transcript
from corpusflow.plans import stages
from corpusflow.session import forget, saved, shared_dir


class ModelBackend(Protocol):
    """What a model behind the engine does: a batch of rows of one stage in, the same rows with ``output`` (and maybe ``output_tokens``) out."""

    def run(self, stage: str, rows: pd.DataFrame) -> pd.DataFrame: ...


def rate_turns(votes: DataFrame, checks: DataFrame | None = None) -> DataFrame:
    """Status of each turn from recorded votes: conversation_id, turn_index, aggregate, status.

    ``votes``: conversation_id, turn_index, template_id, subject_id, verdict (two for each
    key); ``checks``: conversation_id, turn_index, coverage, computation, set_check.
    """
    keys = ["conversation_id", "turn_index", "template_id", "subject_id"]
    agreed = consensus.paired(votes, keys)
    if checks is not None:
        agreed = agreed.join(checks, ["conversation_id", "turn_index"], "left")
        agreed = agreed.withColumn("verdict", consensus.overridden(F.col("template_id"), F.col("verdict"), F.col("coverage"), F.col("computation"), F.col("set_check")))
    uses = rubric_table(votes.sparkSession, holistic=True).select("template_id", "use")
    rated = consensus.gate_aggregate(agreed.join(F.broadcast(uses), "template_id"), ["conversation_id", "turn_index"])
    status = F.when(F.col("aggregate") == "PASS", "COMMITTED").when(F.col("aggregate") == "FAIL", "REJECTED").when(F.col("aggregate") == "ABSTAIN", "ABSTAINED").otherwise("ERROR")
    return rated.select("conversation_id", "turn_index", "aggregate", status.alias("status"))


def finish(turns: DataFrame, retain: bool = True) -> DataFrame:
    """Terminal state of conversations whose turns were rated."""
    return transcript.accepted_prefixes(turns, retain)


def synthesize(jobs: DataFrame, evidence: DataFrame, backend: Callable[[], ModelBackend], turns: int = transcript.MAX_TURNS, ledger: str | None = None, limits: stages.Limits = stages.Limits()) -> DataFrame:  # noqa: B008
    """Turns made in at most ``turns`` rounds: conversation_id, turn_index, task_id, question, answer, repaired, status, failure.

    ``jobs``: conversation_id, image_id, planned_turns; ``evidence``: image_id, capabilities,
    visible_scopes. In each round all conversations that are still open get their first
    candidate task, a question and an answer from the backend, and a verdict from two
    judging calls. An answer that fails is repaired once, with the votes against it, and
    judged again. A turn that isn't committed ends its conversation; one whose stage gave
    nothing well-formed in all attempts is an ERROR with that as its failure.

    Every call is a record of the table at ``ledger`` (a new one in the shared folder if
    none is given): run again, after a stop or with a larger budget, only calls without a
    record are made (``stages.run_stage``).
    """
    log = stages.CommitLog(jobs.sparkSession, ledger or f"{shared_dir(jobs.sparkSession).rstrip('/')}/calls-{uuid.uuid4().hex}")

    def ask(rows: DataFrame, stage: str, column: str, name: str | None = None) -> DataFrame:
        """Rows with the stage's output; rows that failed before are not asked."""
        open_rows, failed = rows.where("failure is null").drop("failure"), rows.where("failure is not null")
        got = stages.run_stage(log, open_rows, stage, backend, name, limits).withColumnRenamed("output", column)
        return got.unionByName(failed, allowMissingColumns=True)

    def judged(rows: DataFrame, stage: str, column: str) -> DataFrame:
        a = ask(rows, f"{stage}_a", f"{column}_a", "holistic_review")
        b = ask(a, f"{stage}_b", f"{column}_b", "holistic_review")
        return b.withColumn(column, F.when(F.col("failure").isNull(), consensus.agree(F.col(f"{column}_a"), F.col(f"{column}_b"))))

    done: DataFrame | None = None
    open_ = jobs
    for turn in range(1, turns + 1):
        e = evidence.join(open_.where(F.col("planned_turns") >= turn).select("image_id").distinct(), "image_id", "left_semi").withColumn("turn_index", F.lit(turn))
        task = planning.candidates(e).where("position = 0").select("image_id", "task_id", "visible_scope")
        rows = open_.where(F.col("planned_turns") >= turn).join(task, "image_id").withColumn("turn_index", F.lit(turn)).withColumn("failure", F.lit(None).cast("string"))
        told = ask(ask(rows, "question_generation", "question"), "answer_generation", "answer")
        first = saved(judged(told, "review", "verdict"), "judged")
        wrong = F.coalesce(F.col("verdict") == "NOT_MET", F.lit(False))
        kept = first.where(~wrong).withColumn("repaired", F.lit(False))
        failed = first.where(wrong).withColumnRenamed("verdict", "first_verdict").drop("verdict_a", "verdict_b")
        mended = ask(failed, "answer_repair", "better").withColumn("answer", F.coalesce("better", "answer"))
        again = judged(mended, "repaired_review", "verdict")
        again = again.withColumn("repaired", F.col("better").isNotNull()).withColumn("verdict", F.when(F.col("better").isNull(), F.col("first_verdict")).otherwise(F.col("verdict")))
        # a repair that gives nothing leaves the first verdict
        again = again.withColumn("failure", F.when(F.col("better").isNotNull(), F.col("failure")))
        both = kept.unionByName(again, allowMissingColumns=True)
        verdict = F.col("verdict")
        status = F.when(F.col("failure").isNotNull(), "ERROR").when(verdict == "MET", "COMMITTED").when(verdict == "NOT_MET", "REJECTED").when(verdict == "ERROR", "ERROR").otherwise("ABSTAINED")
        now = saved(both.withColumn("status", status).select("conversation_id", "turn_index", "task_id", "question", "answer", "repaired", "status", "failure"), f"turn{turn}")
        forget(first)
        done = now if done is None else done.unionByName(now)
        open_ = open_.join(now.where("status = 'COMMITTED'").select("conversation_id"), "conversation_id", "left_semi")
        if not now.limit(1).count():
            break
    return done
