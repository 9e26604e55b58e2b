"""Sinks: canonical and spaced JSON lines, bundles, content-addressed blobs, backups."""

from __future__ import annotations

import json
from pathlib import Path
from typing import Any

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusflow.functions.hashing import canonical_json
from corpusflow.operators import ledger, transcript
from corpusflow.operators.eligibility import ManifestError
from corpusflow.sources.commit_log import CommitLog, read_table


@F.pandas_udf(T.StringType())
def _compact(rows: pd.Series) -> pd.Series:
    return rows.map(lambda x: canonical_json(json.loads(x)))


@F.pandas_udf(T.StringType())
def _spaced(rows: pd.Series) -> pd.Series:
    return rows.map(lambda x: json.dumps(json.loads(x), ensure_ascii=False, allow_nan=False))


def _plain(kind: T.DataType) -> bool:
    """Whether Spark writes values of a type as the canonical form does: no doubles, no keys to be sorted."""
    if isinstance(kind, T.ArrayType):
        return _plain(kind.elementType)
    if isinstance(kind, T.StructType):
        return kind.names == sorted(kind.names) and all(_plain(f.dataType) for f in kind.fields)
    return isinstance(kind, T.StringType | T.BooleanType | T.ByteType | T.ShortType | T.IntegerType | T.LongType)


def json_lines(df: DataFrame, spaced: bool = False) -> DataFrame:
    """One column ``value``: each row as JSON, compact with sorted keys, or in column order with spaces. Nulls are kept.

    The compact form is written by Spark where the columns' types allow it; doubles, and keys
    that are still to be sorted, take a pass through Python, as spaces do.
    """
    names = df.columns if spaced else sorted(df.columns)
    whole = F.to_json(F.struct(*names), {"ignoreNullFields": "false"})
    if spaced:
        return df.select(_spaced(whole).alias("value"))
    return df.select((whole if all(_plain(f.dataType) for f in df.schema.fields) else _compact(whole)).alias("value"))


def write_jsonl(df: DataFrame, path: str, spaced: bool = False, order: list[str] | None = None) -> None:
    """JSON lines in a new folder; the commit protocol shows all files or none."""
    rows = df.orderBy(*order) if order else df
    json_lines(rows, spaced).write.mode("errorifexists").text(path)


def write_json(value: Any, path: str | Path) -> None:
    """A small report in readable JSON, replaced at once."""
    target = Path(path)
    part = target.with_name(f".{target.name}.part")
    part.write_text(json.dumps(value, indent=2, sort_keys=True, ensure_ascii=False, allow_nan=False) + "\n", encoding="utf-8")
    part.replace(target)


def export_bundle(selected: DataFrame, messages: DataFrame, ratings: DataFrame, provenance: DataFrame, path: str) -> None:
    """training, ratings, provenance and selection as four folders of JSON lines, each for the selected conversations only.

    ``selected`` has ordinal, conversation_id, image_id; an id without messages is an error.
    """
    lost = selected.join(messages.select("conversation_id").distinct(), "conversation_id", "left_anti").select("conversation_id").limit(1).collect()
    if lost:
        raise ManifestError("SELECTED_CONVERSATION_MISSING", lost[0][0])
    own = lambda df: df.join(selected.select("conversation_id"), "conversation_id", "left_semi")
    write_jsonl(transcript.training_parts(own(messages), selected), f"{path}/training", spaced=True, order=["conversation_id"])
    write_jsonl(own(ratings), f"{path}/ratings", spaced=True, order=["conversation_id"])
    write_jsonl(own(provenance), f"{path}/provenance", spaced=True, order=["conversation_id"])
    write_jsonl(selected.select("ordinal", "conversation_id"), f"{path}/selection", spaced=True, order=["ordinal"])


def put_blobs(spark: SparkSession, df: DataFrame, payload: str, kind: str, table: str) -> int:
    """Append blobs that the content-addressed table at a path lacks (by digest) and return how many these were.

    The table has a commit log, so of several writers with the same blob one adds it.
    """
    data = F.col(payload).cast("binary")
    new = df.where(F.col(payload).isNotNull()).select(F.sha2(data, 256).alias("digest"), F.lit(kind).alias("kind"), data.alias("content"))
    return CommitLog(spark, table).append(new, ["digest"])


def record_calls(spark: SparkSession, calls: DataFrame, table: str) -> int:
    """Append call records of keys that the ledger at a path lacks and return how many: the first write of a key wins, whoever writes."""
    return CommitLog(spark, table).append(ledger.first_writes(calls).select(*calls.columns), list(ledger.KEY))


def commit_turns(spark: SparkSession, turns: DataFrame, table: str, keys: tuple[str, ...] = ("conversation_id", "branch", "turn_index")) -> int:
    """Append turns whose keys must be new; a key that is there already, also by another writer just now, is an error."""
    return CommitLog(spark, table).append(turns, list(keys), strict=True)


def copy_table(spark: SparkSession, source: str, target: str) -> None:
    """A copy of a table: a target that exists is an error."""
    read_table(spark, source).write.mode("errorifexists").parquet(target)


#: What a backup holds.
PARTS = ("ledger", "blobs")


def copy_run(spark: SparkSession, source: str, target: str) -> None:
    """Backup or restore of a ledger with its blobs (``PARTS`` under a path) as one consistent copy.

    The ledger's files are fixed first. Blobs are written before the calls that name them, so blobs
    copied after that hold every response of the copied ledger; the copy is checked for this,
    and each blob against its digest, before a mark says that it is whole. A target that
    holds anything is an error.
    """
    there = spark._jvm.org.apache.hadoop.fs.Path(target)
    files = there.getFileSystem(spark._jsc.hadoopConfiguration())
    if files.exists(there) and files.listStatus(there):
        raise ManifestError("DESTINATION_NOT_EMPTY", target)
    calls = read_table(spark, f"{source}/ledger")
    for name, df in zip(PARTS, (calls, read_table(spark, f"{source}/blobs")), strict=True):
        df.write.parquet(f"{target}/{name}")
    check_run(spark, target)
    files.create(spark._jvm.org.apache.hadoop.fs.Path(f"{target}/_COMPLETE")).close()


def check_run(spark: SparkSession, path: str) -> None:
    """An error unless every blob is what its digest says and every complete call has its response."""
    found = ledger.verify(spark.read.parquet(f"{path}/blobs"), spark.read.parquet(f"{path}/ledger")).first()
    if found["corrupt"] or found["missing_responses"]:
        raise ManifestError("BACKUP_INCONSISTENT", f"{found['corrupt']} corrupt, {found['missing_responses']} missing")
