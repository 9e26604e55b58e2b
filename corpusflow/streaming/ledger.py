"""Streams: results appended once, summaries by event time, requirement state by conversation."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from corpusflow.operators.requirements import Ledger
from corpusflow.sources.commit_log import CommitLog


#: Keeps the keys of a stream on disk, whatever their number.
STATE = ("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")


def append_once(stream: DataFrame, table: str, keys: list[str], checkpoint: str) -> StreamingQuery:
    """Append rows of new keys to a table with a commit log, each key once, also after a restart.

    Keys are state of the stream, dealt by key, so a batch looks up its own keys only and
    never reads the table. The batch's number is the append's name in the log: a batch that
    runs again adds nothing. The stream is the table's only writer.
    """
    spark = stream.sparkSession
    log, name = CommitLog(spark, table), hashlib.sha256(checkpoint.encode()).hexdigest()

    def write(batch: DataFrame, number: int) -> None:
        log.append(batch, txn=(name, number))

    before = spark.conf.get(STATE[0], None)
    spark.conf.set(*STATE)
    try:
        return stream.dropDuplicates(keys).writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    finally:
        spark.conf.set(STATE[0], before) if before else spark.conf.unset(STATE[0])


def call_rates(calls: DataFrame, width: str = "5 minutes", late: str = "10 minutes") -> DataFrame:
    """Calls and tokens by stage and window of completion time; rows later than ``late`` are left out.

    Works on a stream and, with the same result, on a table.
    """
    timed = calls.withWatermark("created_at", late) if calls.isStreaming else calls
    g = timed.groupBy(F.window("created_at", width), "stage").agg(F.count(F.lit(1)).alias("calls"), F.sum("output_tokens").alias("output_tokens"))
    return g.select(F.col("window.start").alias("start"), "stage", "calls", "output_tokens")


_STATE = "turn int, ids string, lifetimes string, turns string, stopped boolean"
_OUT = "conversation_id string, turn_index int, seq long, error string, n_active int"


def requirement_stream(events: DataFrame) -> DataFrame:
    """The requirement ledger over a stream: state by conversation is its active requirements.

    Rows of a conversation must come in order of batches; within one they are sorted here.
    """
    from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

    def fold(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        book, stopped = Ledger(), False
        if state.exists:
            turn, ids, lifetimes, turns, stopped = state.get
            book.turn = turn
            book.active = {i: (x, int(t)) for i, x, t in zip(ids.split("\n"), lifetimes.split("\n"), turns.split("\n"), strict=True) if i}
        rows = pd.concat(list(batches)).sort_values(["turn_index", "seq"]).astype(object)
        out = []
        for r in rows.where(rows.notna(), None).itertuples(index=False):
            error = "STOPPED" if stopped else book.apply(int(r.turn_index), r.action, r.previous_requirement_id, r.requirement_id, r.lifetime)
            stopped = stopped or error is not None
            out.append((key[0], int(r.turn_index), int(r.seq), error, len(book.active)))
        a = book.active
        state.update((book.turn or 0, "\n".join(a), "\n".join(v[0] for v in a.values()), "\n".join(str(v[1]) for v in a.values()), stopped))
        yield pd.DataFrame(out, columns=[c.split()[0] for c in _OUT.split(", ")])

    return events.groupBy("conversation_id").applyInPandasWithState(fold, T._parse_datatype_string(_OUT), T._parse_datatype_string(_STATE), "append", GroupStateTimeout.NoTimeout)
