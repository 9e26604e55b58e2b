"""The selection pool: freezing, bounds, constrained selection, independent audit, export checks."""

from __future__ import annotations

import hashlib
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import asdict, dataclass, field

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from corpusflow.functions.hashing import SEED, canonical_hash, json_array, json_column, sha
from corpusflow.operators import exchange
from corpusflow.operators.eligibility import ManifestError, require_unique
from corpusflow.session import forget, saved

POOL = ("conversation_id", "language", "image_id", "visual_group_id", "task_family", "semantic_family", "pattern", "purpose")


@dataclass(frozen=True)
class Policy:
    target_count: int
    language_quotas: dict[str, int]
    family_minimums: dict[str, int] = field(default_factory=dict)
    max_per_image: int = 3
    max_per_visual_group: int = 6
    max_per_semantic_family: int = 1
    allow_evaluation_sources: bool = False
    #: Part of a policy's identity; the rounds of the selection end by themselves.
    time_limit_seconds: float = 120
    seed: int = SEED

    @property
    def caps(self) -> dict[str, int]:
        return {"image_id": self.max_per_image, "visual_group_id": self.max_per_visual_group, "semantic_family": self.max_per_semantic_family}


@dataclass(frozen=True)
class Selection:
    selected_ids: tuple[str, ...]
    status: str


def candidate(turns: Column) -> dict[str, Column]:
    """First family, hash of tasks and path of profiles of a conversation's turns."""
    return {
        "task_family": F.element_at(turns, 1)["family"],
        "semantic_family": F.sha2(json_array(F.transform(turns, lambda t: t["task_id"])), 256),
        "pattern": F.array_join(F.transform(turns, lambda t: t["profile"]), "/"),
    }


#: Characters of the list of rows that travel as one compressed chunk.
CHUNK = 1 << 22


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The JSON of a partition's rows in order, comma-joined, as compressed chunks (part, place, chunk)."""
    part, place, held, size = None, 0, [], 0

    def closed() -> pa.RecordBatch:
        packed = zlib.compress(",".join(held).encode("utf-8"), 1)
        return pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), pa.array([place], pa.int64()), pa.array([packed], pa.binary())], ["part", "place", "chunk"])

    for batch in batches:
        for part, j in zip(batch.column("part").to_pylist(), batch.column("j").to_pylist(), strict=True):  # noqa: B007
            held.append(j)
            size += len(j) + 1
            if size >= CHUNK:
                yield closed()
                place, held, size = place + 1, [], 0
    if held:
        yield closed()


def _digest(chunks: Iterator[Row]) -> Iterator[str]:
    """The hash of the list whose chunks come in order."""
    digest, first = hashlib.sha256(b"["), True
    for row in chunks:
        digest.update((b"" if first else b",") + zlib.decompress(row["chunk"]))
        first = False
    digest.update(b"]")
    yield digest.hexdigest()


def pool_hash(pool: DataFrame) -> str:
    """Identity of the whole pool in order of id: one hash over the list of rows.

    Rows are sorted and written as JSON in ranges of ids. The order of a hash over everything
    is sequential by definition, so the chunks of these ranges (about 4 MB, compressed) pass in
    order through one running hash in a task; only the digest reaches the driver.
    """
    require_unique(pool, "conversation_id", "DUPLICATE_POOL_ID")
    row = json_column(**{c: F.col(c).cast("string") for c in POOL})
    ranged = pool.select(*POOL).repartitionByRange("conversation_id").sortWithinPartitions("conversation_id")
    chunks = ranged.select(F.spark_partition_id().alias("part"), row.alias("j")).mapInArrow(_chunks, "part int, place long, chunk binary")
    # rows of an RDD reach Python in batches by size, not by number
    found = chunks.repartition(1).sortWithinPartitions("part", "place").select("chunk").rdd.mapPartitions(_digest).collect()
    return found[0] if found else hashlib.sha256(b"[]").hexdigest()


def bounds(pool: DataFrame, by: str, caps: dict[str, int]) -> DataFrame:
    """For each value of ``by``, the most rows that each cap alone lets through: ``value``, available, and a column for each cap."""
    out = pool.groupBy(by).agg(F.count(F.lit(1)).alias("available"))
    for column, cap in caps.items():
        c = pool.groupBy(by, column).agg(F.least(F.count(F.lit(1)), F.lit(cap)).alias("n")).groupBy(by).agg(F.sum("n").cast("long").alias(f"by_{column}"))
        out = out.join(c, by)
    return out


def capped(pool: DataFrame, caps: dict[str, int], seed: int = SEED) -> DataFrame:
    """Rows that stay when each cap in turn keeps the first by hash of each value."""
    d = pool.withColumn("__h", sha(seed, F.col("conversation_id")))
    for column, cap in caps.items():
        d = d.withColumn("__r", F.row_number().over(W.partitionBy(column).orderBy("__h", "conversation_id"))).where(F.col("__r") <= cap).drop("__r")
    return d.drop("__h")


def select_candidates(pool: DataFrame, policy: Policy) -> Selection:
    """A feasible subset, deterministic for a seed: OPTIMAL, INFEASIBLE, or UNKNOWN.

    There is nothing to optimize, so any feasible subset is optimal. Rows are taken in rounds:
    a round ranks what still fits by hash within each image, group, semantic family and
    language, and takes the rows whose ranks all fit; first those of families that miss their
    minimum, then any. A round takes at least one row if any fits, and only rows taken, of which
    there are never more than the target, leave Spark. What the rounds leave missing is found
    by exchange paths (``exchange.complete``). INFEASIBLE is said if counts prove it or the
    tree of paths was searched whole; UNKNOWN only where the bounds of that search cut it.
    """
    quotas = policy.language_quotas
    if sum(quotas.values()) > policy.target_count or any(n < 0 for n in quotas.values()):
        return Selection((), "INFEASIBLE")
    usable = pool if policy.allow_evaluation_sources else pool.where(F.col("purpose") == "training")
    # a language without a quota shares the places that no quota names
    seat = F.when(F.col("language").isin(*quotas), F.col("language")).otherwise(F.lit("")) if quotas else F.lit("")
    # rows without an image, say, share one value for the cap, as in the audit
    limited = [F.coalesce(F.col(c), F.lit("\0")).alias(c) for c in policy.caps]
    rows = saved(usable.select("conversation_id", seat.alias("seat"), "task_family", *limited, sha(policy.seed, F.col("conversation_id")).alias("h")), "usable")
    try:
        if _too_few(rows, policy):
            return Selection((), "INFEASIBLE")
        taken: list[Row] = []
        for needed in (True, False):
            while len(taken) < policy.target_count and (more := _round(rows, policy, taken, needed).collect()):
                taken += more
        seats = {**quotas, "": policy.target_count - sum(quotas.values())}
        taken, found, whole = exchange.complete(rows, taken, seats, policy.family_minimums, policy.caps)
    finally:
        forget(rows)
    if not found:
        return Selection((), "INFEASIBLE" if whole else "UNKNOWN")
    return Selection(tuple(sorted(r["conversation_id"] for r in taken)), "OPTIMAL")


def _too_few(rows: DataFrame, policy: Policy) -> bool:
    """Whether a cap alone leaves fewer rows than a quota, a minimum or the target asks for."""
    asked = (("seat", policy.language_quotas), ("task_family", policy.family_minimums), ("all", {"": policy.target_count}))
    for by, least in asked:
        if not any(least.values()):
            continue
        found = bounds(rows.withColumn("all", F.lit("")), by, policy.caps).where(F.col(by).isin(*least)).collect()
        most = {r[by]: min(r[c] for c in ("available", *(f"by_{c}" for c in policy.caps))) for r in found}
        if any(most.get(value, 0) < n for value, n in least.items()):
            return True
    return False


def _left(taken: list[Row], policy: Policy) -> tuple[dict[str, int], dict[str, int]]:
    """Places left by seat, and rows that families still need."""
    seats = Counter(policy.language_quotas)
    seats[""] = policy.target_count - sum(policy.language_quotas.values())
    seats.subtract(r["seat"] for r in taken)
    need = Counter(policy.family_minimums)
    need.subtract(r["task_family"] for r in taken)
    return {k: n for k, n in seats.items() if n > 0}, {k: n for k, n in need.items() if n > 0}


def _room(rows: DataFrame, column: str, room: dict[str, int], name: str, otherwise: int) -> DataFrame:
    """``rows`` with what is left of each value of ``column`` (a small table, or ``otherwise``), without values that are used up."""
    table = rows.sparkSession.createDataFrame(list(room.items()), f"{column} string, {name} int")
    return rows.join(F.broadcast(table), column, "left").withColumn(name, F.coalesce(name, F.lit(otherwise))).where(F.col(name) > 0)


def _round(rows: DataFrame, policy: Policy, taken: list[Row], needed: bool) -> DataFrame:
    """Rows that fit beside ``taken`` and beside each other; with ``needed`` only of families that miss their minimum."""
    seats, need = _left(taken, policy)
    gone = rows.sparkSession.createDataFrame([(r["conversation_id"],) for r in taken], "conversation_id string")
    d = _room(rows.join(F.broadcast(gone), "conversation_id", "left_anti"), "seat", seats, "room_seat", 0)
    limits = [("seat", "room_seat")]
    for column, cap in policy.caps.items():
        used = Counter(r[column] for r in taken)
        d = _room(d, column, {k: cap - n for k, n in used.items()}, f"room_{column}", cap)
        limits.insert(0, (column, f"room_{column}"))
    if needed:
        d = _room(d, "task_family", need, "room_task_family", 0)
        limits.insert(-1, ("task_family", "room_task_family"))
    for column, room in limits:
        rank = F.row_number().over(W.partitionBy(column).orderBy("h", "conversation_id"))
        # the literal lets every task cut its own part of a language before rows meet
        d = d.withColumn("rank", rank).where((F.col("rank") <= policy.target_count) & (F.col("rank") <= F.col(room)))
    return d.select(*rows.columns).orderBy("h", "conversation_id").limit(policy.target_count - len(taken))


def audit(pool: DataFrame, selected: DataFrame, policy: Policy, same_pool: bool = True) -> dict:
    """Recount a selection from its ids alone: counts and violations, shared with nothing of the search.

    ``selected`` has conversation_id; repeated ids count as often as they are there.
    """
    have = saved(selected.join(pool, "conversation_id").select("language", "task_family", "image_id", "visual_group_id", "semantic_family", "purpose"), "audit")
    n = have.count()
    given = selected.agg(F.count(F.lit(1)).alias("n"), F.countDistinct("conversation_id").alias("d")).first()
    outside = selected.join(pool, "conversation_id", "left_anti").limit(1).count()
    sets = [("language",), ("task_family",), ("image_id",), ("visual_group_id",), ("semantic_family",)]
    grouped = have.groupingSets([[F.col(c) for c in s] for s in sets], *[F.col(s[0]) for s in sets]).agg(F.grouping_id().alias("g"), F.count(F.lit(1)).alias("n"))
    bit = {c: 31 ^ (1 << (4 - k)) for k, (c,) in enumerate(sets)}
    counts = {c: {r[c]: r["n"] for r in grouped.where(F.col("g") == bit[c]).select(c, "n").collect()} for c in ("language", "task_family")}
    # all values of the five groupings are counted in one pass; only small results leave it
    tops = {r["g"]: r["m"] for r in grouped.groupBy("g").agg(F.max("n").alias("m")).collect()}
    most = {c: tops.get(bit[c], 0) for c in policy.caps}
    evaluation = not policy.allow_evaluation_sources and have.where(F.col("purpose") == "evaluation").limit(1).count()
    forget(have)
    checks = {
        "POOL_HASH_MISMATCH": not same_pool,
        "DUPLICATE_SELECTED_ID": given["n"] != given["d"],
        "SELECTED_ID_OUTSIDE_POOL": bool(outside),
        "TARGET_COUNT_MISMATCH": n != policy.target_count,
        "LANGUAGE_QUOTA_MISMATCH": counts["language"] != policy.language_quotas,
        "FAMILY_MINIMUM_MISMATCH": any(counts["task_family"].get(f, 0) < m for f, m in policy.family_minimums.items()),
        "IMAGE_MAXIMUM_EXCEEDED": most["image_id"] > policy.max_per_image,
        "VISUAL_GROUP_MAXIMUM_EXCEEDED": most["visual_group_id"] > policy.max_per_visual_group,
        "SEMANTIC_FAMILY_MAXIMUM_EXCEEDED": most["semantic_family"] > policy.max_per_semantic_family,
        "EVALUATION_SOURCE_SELECTED": bool(evaluation),
    }
    return {
        "status": "NOT_MET" if any(checks.values()) else "MET",
        "selected_count": n,
        "language_counts": dict(sorted(counts["language"].items())),
        "family_counts": dict(sorted(counts["task_family"].items())),
        "image_maximum": most["image_id"],
        "visual_group_maximum": most["visual_group_id"],
        "violations": sorted(k for k, v in checks.items() if v),
    }


def report_hash(report: dict, frozen: str, selected_ids: list[str], policy: Policy) -> str:
    """Identity of an audit with what it was about."""
    body = {k: v for k, v in report.items() if k != "status"}
    return canonical_hash({**body, "pool_hash": frozen, "selected_ids": selected_ids, "policy": asdict(policy)})


def bind(selection: Selection, frozen: str, report: dict, audit_hash: str) -> dict:
    """The selection manifest bound to its audit; a failed audit can't be bound."""
    if report["status"] != "MET":
        raise ManifestError("SELECTION_AUDIT_FAILED", ", ".join(report["violations"]))
    manifest = {"pool_hash": frozen, "selected_ids": list(selection.selected_ids), "solver_status": selection.status}
    return {**manifest, "audit_report_hash": audit_hash, "audit_hash": canonical_hash({"selection": manifest, "audit_report_hash": audit_hash})}


def export_reason() -> Column:
    """Why a selected conversation can't be exported: first of profile, audit, status, purpose, length, turns; or null."""
    return (
        F.when(F.col("profile") != "standard", "PILOT_EXPORT_FORBIDDEN")
        .when(F.col("audit_hash").isNull(), "AUDIT_REQUIRED")
        .when(F.col("status") != "QUALITY_CANDIDATE", "CONVERSATION_NOT_ACCEPTED")
        .when(F.col("purpose") != "training", "EVALUATION_IMAGE_EXPORT")
        .when(~F.col("n_turns").between(2, 6), "TURN_COUNT_INVALID")
        .when(F.col("committed_turns") != F.col("n_turns"), "UNCOMMITTED_TURN_EXPORT")
    )
