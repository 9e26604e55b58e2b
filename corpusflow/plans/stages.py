"""Stages of a synthesis as tables: a call is recorded once, and no recorded call is made again.

A record is (conversation_id, turn_index, stage, attempt) with what was sent and what came
back. A stage looks up the records of its rows, calls the model only for those without one,
and appends what it gets to a table with a commit log, where the first record of a key wins.
So a run that stopped goes on where it was, two runs at once agree, and rows whose output
is malformed get a further attempt with another seed and a hint, each attempt a key of its own.

Calls are charged to a budget before they are made: a stage calls as many rows, in order of
a hash of their keys, as requests and reserved tokens allow, records them, and then fails.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusflow.functions.hashing import SEED, sha
from corpusflow.functions.text import not_blank
from corpusflow.operators.eligibility import ManifestError
from corpusflow.session import forget, saved
from corpusflow.sources.commit_log import CommitLog

#: What is added to the seed for each further attempt, and for a repair.
ATTEMPT_SEED, REPAIR_SEED = 100_000, 10_000
KEY = ("conversation_id", "turn_index", "stage", "attempt")
RECORD = "conversation_id string, turn_index int, stage string, attempt int, seed long, status string, reason string, output string, reserved long, used long"
#: Stages whose output is a verdict; the others give text.
VERDICTS = ("MET", "NOT_MET", "UNKNOWN", "NOT_APPLICABLE", "ERROR")
HINTS = {"MODEL_CONTENT_EMPTY": "The previous response was empty. Answer in full.", "MODEL_SCHEMA_MISMATCH": "The previous response was none of the verdicts allowed. Answer with one of them alone."}


@dataclass(frozen=True)
class Limits:
    """Requests and output tokens that a run may use, tokens reserved for a call, and attempts for each call."""

    requests: int = 10_000_000
    tokens: int = 10_000_000_000
    tokens_per_call: int = 1024
    attempts: int = 3


def malformed(stage: str, output: Column) -> Column:
    """Why an output is no answer of its stage, or null."""
    if "review" in stage:
        return F.when(output.isNull() | ~output.isin(*VERDICTS), "MODEL_SCHEMA_MISMATCH")
    return F.when(~F.coalesce(not_blank(output), F.lit(False)), "MODEL_CONTENT_EMPTY")


def _called(rows: DataFrame, name: str, backend: Callable) -> DataFrame:
    """Rows with the backend's ``output`` and ``output_tokens`` (null if it doesn't say). The backend is made once for each task."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model = backend()
        for pdf in batches:
            out = model.run(name, pdf)
            yield out if "output_tokens" in out else out.assign(output_tokens=None)

    return rows.mapInPandas(run, rows.withColumn("output", F.lit(None).cast("string")).withColumn("output_tokens", F.lit(None).cast("long")).schema)


def used(log: CommitLog) -> tuple[int, int]:
    """Requests and output tokens of all records."""
    records = log.read()
    if records is None:
        return 0, 0
    r = records.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum("used"), F.lit(0)).alias("used")).first()
    return r["n"], r["used"]


def _first(rows: DataFrame, n: int) -> DataFrame:
    """The first ``n`` rows in order of a hash of their keys: whole buckets of the hash, and the first of one more bucket."""
    d = rows.withColumn("__h", sha(F.col("conversation_id"), F.col("turn_index"))).withColumn("__b", F.substring("__h", 1, 4))
    total = 0
    for r in d.groupBy("__b").count().orderBy("__b").collect():
        if total + r["count"] > n:
            part = d.where(F.col("__b") == r["__b"]).orderBy("__h", "conversation_id", "turn_index").limit(n - total)
            return d.where(F.col("__b") < r["__b"]).unionByName(part).drop("__h", "__b")
        total += r["count"]
    return rows


def run_stage(log: CommitLog, rows: DataFrame, stage: str, backend: Callable, name: str | None = None, limits: Limits = Limits(), seed: int = SEED) -> DataFrame:  # noqa: B008
    """``rows`` (conversation_id and turn_index, unique, and what the backend needs) with ``output`` and ``failure``.

    ``stage`` names the records, ``name`` (by default the same) is what the backend is asked
    for. The backend sees the rows with ``attempt``, ``seed``, ``hint`` and ``call`` (the stage's name, which tells two judges apart). A row whose attempts were
    all malformed has no output and the last attempt's reason as its failure.
    """
    spark, keys = rows.sparkSession, ["conversation_id", "turn_index"]
    name = name or stage
    asked = saved(rows, "asked")
    while True:
        version = log.version()
        known = _records(spark, log, stage, version)
        tried = known.groupBy(*keys).agg(F.max("attempt").alias("__tried"), F.max((F.col("status") == "COMPLETE").cast("int")).alias("__ok"), F.max_by("reason", "attempt").alias("__reason"))
        joined = asked.join(tried, keys, "left").where(F.coalesce("__ok", F.lit(0)) == 0).withColumn("__next", F.coalesce("__tried", F.lit(-1)) + 1).where(F.col("__next") < limits.attempts)
        waiting = {r["__next"]: r["count"] for r in joined.groupBy("__next").count().collect()}
        if not waiting:
            break
        attempt = min(waiting)
        pending = waiting[attempt]
        joined = joined.where(F.col("__next") == attempt)
        said = F.coalesce(F.create_map(*[F.lit(x) for kv in HINTS.items() for x in kv])[F.col("__reason")], F.lit(""))
        base = F.lit(seed + attempt * ATTEMPT_SEED + (REPAIR_SEED if "repair" in stage else 0)) + F.col("turn_index")
        todo = joined.select(*asked.columns, F.lit(attempt).alias("attempt"), base.cast("long").alias("seed"), said.alias("hint"), F.lit(stage).alias("call"))
        requests, tokens = used(log)
        room = max(0, min(limits.requests - requests, (limits.tokens - tokens) // limits.tokens_per_call))
        short = pending > room
        if short:
            reason = "REQUEST_BUDGET_EXHAUSTED" if limits.requests - requests <= room else "OUTPUT_TOKEN_BUDGET_EXHAUSTED"
            todo = _first(todo, room)
        if room:
            got = _called(todo, name, backend)
            wrong = malformed(stage, F.col("output"))
            record = got.select(*keys, F.lit(stage).alias("stage"), "attempt", "seed", F.when(wrong.isNull(), "COMPLETE").otherwise("INVALID").alias("status"), wrong.alias("reason"), "output", F.lit(limits.tokens_per_call).cast("long").alias("reserved"), F.coalesce("output_tokens", F.lit(limits.tokens_per_call)).cast("long").alias("used"))
            log.append(record, list(KEY), since=version)
        if short:
            forget(asked)
            raise ManifestError(reason, f"{stage}, attempt {attempt}: {room} of {pending} calls made")
    last = known.groupBy(*keys).agg(F.max(F.when(F.col("status") == "COMPLETE", F.col("output"))).alias("output"), F.max_by("reason", "attempt").alias("failure"))
    out = saved(asked.join(last, keys, "left").withColumn("failure", F.when(F.col("output").isNull(), F.coalesce("failure", F.lit("NO_RECORD")))), "answered")
    forget(asked)
    return out


def _records(spark: SparkSession, log: CommitLog, stage: str, version: int) -> DataFrame:
    records = log.read(version)
    return spark.createDataFrame([], RECORD) if records is None else records.where(F.col("stage") == stage)
