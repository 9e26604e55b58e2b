"""Call ledgers: first-write-wins records, caches, budgets, profiles, content-addressed blobs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from corpusflow.functions.hashing import artifact_path, json_column
from corpusflow.operators.eligibility import ManifestError

KEY = ("model_lock_hash", "stage", "request_hash")


def request_hash(model_lock: Column, request: Column) -> Column:
    return F.sha2(json_column(model_lock=model_lock, request=request), 256)


def call_id(run: Column, stage: Column, request: Column) -> Column:
    return F.sha2(json_column(run=run, stage=stage, request=request), 256)


def first_writes(calls: DataFrame, keys: tuple[str, ...] = KEY, order: str = "seq") -> DataFrame:
    """The first record of each key in order of ``order``, whatever its status: later ones are ignored.

    A minimum by key is pre-aggregated where the rows are, so a hot key costs one row for each task.
    """
    rest = [c for c in calls.columns if c not in keys and c != order]
    one = F.min(F.struct(F.col(order), *[F.col(c) for c in rest])).alias("__f")
    return calls.groupBy(*keys).agg(one).select(*keys, f"__f.{order}", *[f"__f.{c}" for c in rest])


def append_new(ledger: DataFrame, rows: DataFrame, keys: list[str]) -> DataFrame:
    """Rows to append: keys that the ledger lacks, once each (the first by all columns)."""
    own = rows.join(ledger.select(*keys).distinct(), keys, "left_anti")
    rest = [c for c in rows.columns if c not in keys]
    if not rest:
        return own.distinct()
    return own.groupBy(*keys).agg(F.min(F.struct(*rest)).alias("__f")).select(*keys, *[f"__f.{c}" for c in rest])


def commit(ledger: DataFrame, rows: DataFrame, keys: list[str]) -> DataFrame:
    """Rows to append where any key already there, or there twice, is an error."""
    if rows.groupBy(*keys).count().where("count > 1").limit(1).count() or rows.join(ledger.select(*keys), keys, "left_semi").limit(1).count():
        raise ManifestError("DUPLICATE_COMMIT", ", ".join(keys))
    return rows


def cached(requests: DataFrame, ledger: DataFrame) -> DataFrame:
    """Requests with ``response_hash`` of a complete call of the same key, null on a miss."""
    done = first_writes(ledger).where((F.col("status") == "COMPLETE") & F.col("response_hash").isNotNull()).select(*KEY, "response_hash")
    return requests.join(done, list(KEY), "left")


def profile(calls: DataFrame) -> DataFrame:
    """Calls by stage and model: calls, tokens, total and mean milliseconds, in order of total.

    If any call has a recorded duration all are used as recorded; otherwise a call's duration
    is the time since the completion before it (the first: none).
    """
    measured = timed(calls)
    g = measured.groupBy("stage", "model_repo").agg(F.count(F.lit(1)).alias("calls"), F.sum("input_tokens").cast("long").alias("input_tokens"), F.sum("output_tokens").cast("long").alias("output_tokens"), F.sum("ms").cast("long").alias("total_duration_ms"))
    return g.withColumn("mean_duration_ms", F.round(F.col("total_duration_ms") / F.col("calls"), 2)).orderBy(F.desc("total_duration_ms"), "stage", "model_repo")


def timed(calls: DataFrame) -> DataFrame:
    """Complete calls with ``ms``. The global order of completions is followed in ranges of ``seq``.

    The lag needs the row before in one global order; instead of one sorted task, rows
    are dealt by day of completion, and the last completion of the day before is joined on.
    """
    done = calls.where(F.col("status") == "COMPLETE")
    recorded = (done.agg(F.max("duration_ms")).first()[0] or 0) > 0
    if recorded:
        return done.withColumn("ms", F.col("duration_ms").cast("long"))
    d = done.withColumn("__day", F.expr("seq div 100000"))
    edges = d.groupBy("__day").agg(F.max(F.struct("seq", "created_at")).alias("__last")).select("__day", "__last.created_at")
    before = edges.select("__day", F.lag("created_at").over(W.orderBy("__day")).alias("__before"))
    own = d.join(before, "__day").withColumn("__p", F.coalesce(F.lag("created_at").over(W.partitionBy("__day").orderBy("seq")), F.col("__before")))
    gap = F.round((F.unix_micros("created_at") - F.unix_micros("__p")) / 1000).cast("long")
    return own.withColumn("ms", F.coalesce(F.greatest(gap, F.lit(0)), F.lit(0)).cast("long")).drop("__day", "__before", "__p")


def wall(calls: DataFrame) -> DataFrame:
    """completed_calls, wall_duration_ms (last minus first in order of ``seq``), calls_per_minute (0 if no time passed)."""
    done = calls.where(F.col("status") == "COMPLETE")
    g = done.agg(F.count(F.lit(1)).alias("completed_calls"), F.min(F.struct("seq", "created_at")).alias("a"), F.max(F.struct("seq", "created_at")).alias("b"))
    ms = F.greatest(F.lit(0), F.round((F.unix_micros("b.created_at") - F.unix_micros("a.created_at")) / 1000)).cast("long")
    g = g.select("completed_calls", ms.alias("wall_duration_ms"))
    return g.withColumn("calls_per_minute", F.when(F.col("wall_duration_ms") > 0, F.round(F.col("completed_calls") / (F.col("wall_duration_ms") / 60000), 2)).otherwise(F.lit(0.0)))


def budget(events: DataFrame, request_limit: int = 10_000_000, token_limit: int = 1_000_000_000) -> DataFrame:
    """Running budget over reservation events (run_id, seq, action, reserved, actual), checked at each event.

    Columns: run_id, seq, requests, output_tokens, reserved_tokens, error. A release keeps
    its request; a reservation beyond a limit is an error at that event. A long run is
    summed in ranges of ``seq``.
    """
    is_ = lambda a: F.col("action") == a
    steps = {
        "requests": F.when(is_("reserve"), 1).otherwise(0),
        "output_tokens": F.when(is_("finalize"), F.col("actual")).otherwise(0),
        "reserved_tokens": F.when(is_("reserve"), F.col("reserved")).otherwise(-F.col("reserved")),
    }
    d = running_sums(events.select("run_id", "seq", "action", *[v.cast("long").alias(k) for k, v in steps.items()]), "run_id", "seq", list(steps))
    error = (
        F.when(is_("reserve") & (F.col("requests") > request_limit), "REQUEST_BUDGET_EXHAUSTED")
        .when(is_("reserve") & (F.col("output_tokens") + F.col("reserved_tokens") > token_limit), "OUTPUT_TOKEN_BUDGET_EXHAUSTED")
        .when(F.col("reserved_tokens") < 0, "BUDGET_RESERVATION_MISMATCH")
    )
    return d.select("run_id", "seq", "requests", "output_tokens", "reserved_tokens", error.alias("error"))


def blobs(df: DataFrame, payload: str, kind: str) -> DataFrame:
    """Distinct payloads by content: digest, path, n_bytes, n_rows."""
    data = F.col(payload).cast("binary")
    d = df.where(F.col(payload).isNotNull()).select(F.sha2(data, 256).alias("digest"), F.length(data).cast("long").alias("n_bytes"))
    return d.groupBy("digest").agg(F.max("n_bytes").alias("n_bytes"), F.count(F.lit(1)).alias("n_rows")).select("digest", artifact_path(kind, F.col("digest")).alias("path"), "n_bytes", "n_rows")


def extract_blobs(df: DataFrame, payload: str, reference: str = "blob") -> tuple[DataFrame, DataFrame]:
    """``df`` with a reference for the payload, and the table of distinct blobs that restores it."""
    marked = df.withColumn(reference, F.sha2(F.col(payload).cast("binary"), 256))
    table = marked.where(F.col(payload).isNotNull()).groupBy(reference).agg(F.min(payload).alias(payload))
    return marked.drop(payload), table


def restore_blobs(df: DataFrame, table: DataFrame, reference: str = "blob") -> DataFrame:
    return df.join(table, reference, "left").drop(reference)


def verify(blob_rows: DataFrame, calls: DataFrame) -> DataFrame:
    """Integrity of a ledger: artifacts, corrupt (content isn't the digest), calls, missing responses; one row."""
    ok = F.sha2(F.col("content").cast("binary"), 256) == F.col("digest")
    a = blob_rows.agg(F.count(F.lit(1)).alias("artifacts"), F.coalesce(F.sum((~ok).cast("long")), F.lit(0)).alias("corrupt"))
    lost = calls.where(F.col("status") == "COMPLETE").join(blob_rows.select("digest"), calls["response_hash"] == blob_rows["digest"], "left_anti").agg(F.count(F.lit(1)).alias("missing_responses"))
    return a.crossJoin(calls.agg(F.count(F.lit(1)).alias("model_calls"))).crossJoin(lost)


def remaining_turns(planned: DataFrame, commits: DataFrame) -> DataFrame:
    """Turns still to do: planned (conversation_id, planned_turns) less the committed prefix, which must be contiguous."""
    done = commits.groupBy("conversation_id").agg(F.count(F.lit(1)).alias("__n"), F.max("turn_index").alias("__m"))
    broken = done.where("__n <> __m").limit(1).collect()
    if broken:
        raise ManifestError("TURN_COMMIT_GAP", str(broken[0]["conversation_id"]))
    j = planned.join(done, "conversation_id", "left").withColumn("__n", F.coalesce(F.col("__n").cast("int"), F.lit(0))).where("__n < planned_turns")
    return j.select("conversation_id", F.explode(F.expr("sequence(__n + 1, planned_turns)")).alias("turn_index"))


def progress(results: DataFrame) -> DataFrame:
    """Running counts of statuses in input order: ordinal, status, n_so_far. Few statuses hold all rows: they are counted in ranges."""
    return running_sums(results.select("ordinal", "status", F.lit(1).cast("long").alias("n_so_far")), "status", "ordinal", ["n_so_far"])


#: Width of a range of an order in which running sums are made in one task.
RANGE = 100_000


def running_sums(df: DataFrame, key: str, order: str, columns: list[str], width: int = RANGE) -> DataFrame:
    """``df`` with each of ``columns`` replaced by its running sum within ``key`` in order of ``order`` (a unique integer).

    Rows are summed in ranges of ``width`` values of the order, and moved up by the totals of
    the ranges before, so that a key with a large share of all rows is spread over tasks.
    Null keys are one key.
    """
    d = df.withColumn("__r", F.floor(F.col(order) / width))
    totals = d.groupBy(key, "__r").agg(*[F.sum(c).alias(f"__t_{c}") for c in columns])
    earlier = W.partitionBy(key).orderBy("__r").rowsBetween(W.unboundedPreceding, -1)
    before = totals.select(F.col(key).alias("__key"), F.col("__r").alias("__range"), *[F.coalesce(F.sum(f"__t_{c}").over(earlier), F.lit(0)).alias(f"__t_{c}") for c in columns])
    own = W.partitionBy(key, "__r").orderBy(order).rowsBetween(W.unboundedPreceding, 0)
    summed = d.select(*[F.sum(c).over(own).alias(c) if c in columns else F.col(c) for c in df.columns], "__r")
    j = summed.join(before, F.col(key).eqNullSafe(F.col("__key")) & (F.col("__r") == F.col("__range")))
    return j.select(*[(F.col(c) + F.col(f"__t_{c}")).cast("long").alias(c) if c in columns else F.col(c) for c in df.columns])


def open_run(runs: DataFrame, run_id: str, config_hash: str, profile_name: str) -> DataFrame:
    """The row to append for a new run, or no row for one that is resumed with the same configuration."""
    known = runs.where(F.col("run_id") == run_id).limit(1).collect()
    if known and (known[0]["config_hash"], known[0]["profile"]) != (config_hash, profile_name):
        raise ManifestError("RUN_CONFIG_MISMATCH", run_id)
    row = runs.sparkSession.createDataFrame([(run_id, config_hash, profile_name, "CREATED")], "run_id string, config_hash string, profile string, status string")
    return row.limit(0) if known else row
