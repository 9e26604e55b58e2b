"""Quotas, schedules, roles and instruction candidates: all decided by hashes and ranks."""

from __future__ import annotations

from collections.abc import Mapping
from fractions import Fraction
from math import lcm

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from corpusflow.functions.catalogs import tasks_table
from corpusflow.functions.hashing import SEED, bucket, sha

DEFAULT_SCOPE = "the visible image"
CANDIDATES = 8


def integer_weights(weights: Mapping[str, int | str]) -> dict[str, int]:
    """Positive rational weights ("1/3", 2) as integers of the same proportions; floats and booleans are errors."""
    exact = {}
    for tag, w in weights.items():
        if isinstance(w, bool | float):
            raise ValueError(f"invalid weight of {tag}")
        try:
            exact[tag] = Fraction(w)
        except (ValueError, ZeroDivisionError) as e:
            raise ValueError(f"invalid weight of {tag}") from e
        if exact[tag] <= 0:
            raise ValueError(f"the weight of {tag} must be positive")
    if not exact:
        raise ValueError("no weights")
    scale = lcm(*(w.denominator for w in exact.values()))
    return {t: int(w * scale) for t, w in exact.items()}


def apportion(weights: DataFrame, total: Column) -> DataFrame:
    """Largest-remainder quotas of a table (tag, weight: positive long): tag, quota.

    Ties go to the smaller tag. Weights are a small table: one row for each tag.
    """
    whole = weights.agg(F.sum(F.col("weight").cast("decimal(38,0)")).alias("__sum"))
    wide = weights.crossJoin(F.broadcast(whole)).withColumn("__p", total.cast("decimal(38,0)") * F.col("weight").cast("decimal(19,0)"))
    parts = wide.select("tag", F.expr("cast(__p div __sum as bigint)").alias("floor"), (F.col("__p") % F.col("__sum")).alias("rest"), total.cast("long").alias("total"))
    left = F.col("total") - F.sum("floor").over(W.partitionBy())
    rank = F.row_number().over(W.partitionBy().orderBy(F.desc("rest"), "tag"))
    return parts.select("tag", (F.col("floor") + (rank <= left).cast("long")).alias("quota"))


def quotas(spark, total: int, weights: Mapping[str, int | str]) -> DataFrame:
    """Quotas of given weights as a table."""
    if total < 0:
        raise ValueError("the total can't be negative")
    return apportion(spark.createDataFrame(sorted(integer_weights(weights).items()), "tag string, weight long"), F.lit(total))


def schedule(quota: DataFrame, namespace: str, seed: int = SEED) -> DataFrame:
    """Each tag as often as its quota, in order of a hash: ordinal (from 0), tag.

    Positions are ranks in one order over all; the rows are ranked in ranges of the hash
    and moved up by the counts of the ranges before, so no single task sorts them all.
    """
    rows = quota.where("quota > 0").select("tag", F.explode(F.sequence(F.lit(0).cast("long"), F.col("quota") - 1)).alias("occurrence"))
    ranked = rows.withColumn("rank_hash", sha(seed, namespace, F.col("tag"), F.col("occurrence")))
    return ordinals(ranked, ["rank_hash", "tag"], F.substring("rank_hash", 1, 2)).select("ordinal", "tag")


def ordinals(df: DataFrame, order: list[str], ranges: Column) -> DataFrame:
    """``df`` with ``ordinal``: the rank from 0 in ``order``, of which ``ranges`` is a monotone prefix."""
    d = df.withColumn("__r", ranges)
    counts = d.groupBy("__r").agg(F.count(F.lit(1)).alias("__n"))
    before = counts.select("__r", F.coalesce(F.sum("__n").over(W.orderBy("__r").rowsBetween(W.unboundedPreceding, -1)), F.lit(0)).alias("__before"))
    own = d.withColumn("__i", F.row_number().over(W.partitionBy("__r").orderBy(*order)) - 1)
    return own.join(before, "__r").withColumn("ordinal", F.col("__i") + F.col("__before")).drop("__r", "__i", "__before")


def weighted_role(conversation_id: Column, allocation: Mapping[str, int]) -> Column:
    """The role of a conversation by cumulative weights in order of name."""
    if not allocation or min(allocation.values()) <= 0:
        raise ValueError("weights must be positive")
    position = bucket(F.sha2(conversation_id.cast("string"), 256), sum(allocation.values()))
    out, cursor = None, 0
    for role in sorted(allocation):
        cursor += allocation[role]
        out = F.when(position < cursor, role) if out is None else out.when(position < cursor, role)
    return out


def candidates(evidence: DataFrame, seed: int = SEED, limit: int = CANDIDATES) -> DataFrame:
    """Instruction candidates: image_id, turn_index, task_id, family, visible_scope, candidate_id, position.

    ``evidence`` has image_id, turn_index, capabilities and visible_scopes. A task is
    eligible if all its capabilities are there; scopes are dealt in turn over the eligible
    tasks in catalog order; the first ``limit`` by hash stay. The catalog is 24 rows, so the
    tasks are an array in each row's expression and only the chosen ones become rows.
    """
    tasks = tasks_table(evidence.sparkSession)
    catalog = F.broadcast(tasks.agg(F.array_sort(F.collect_list(F.struct("position", "task_id", "family", "required"))).alias("tasks")))
    own = evidence.crossJoin(catalog)
    scopes = F.when(F.size("visible_scopes") > 0, F.col("visible_scopes")).otherwise(F.array(F.lit(DEFAULT_SCOPE)))
    eligible = own.select("image_id", "turn_index", scopes.alias("scopes"), F.filter("tasks", lambda t: F.size(F.array_except(t["required"], F.col("capabilities"))) == 0).alias("eligible"))
    with_scope = F.transform("eligible", lambda t, k: F.struct(t["task_id"].alias("task_id"), t["family"].alias("family"), F.element_at("scopes", (k % F.size("scopes")).cast("int") + 1).alias("visible_scope")))

    def ranked(x: Column) -> Column:
        cid = sha(seed, F.col("image_id"), F.col("turn_index"), x["task_id"], x["visible_scope"])
        order = sha(seed, F.col("image_id"), F.col("turn_index"), cid)
        return F.struct(order.alias("order"), cid.alias("candidate_id"), x["task_id"].alias("task_id"), x["family"].alias("family"), x["visible_scope"].alias("visible_scope"))

    best = eligible.withColumn("c", F.slice(F.array_sort(F.transform(with_scope, ranked)), 1, limit))
    return best.select("image_id", "turn_index", F.posexplode("c").alias("position", "c")).select("image_id", "turn_index", "c.task_id", "c.family", "c.visible_scope", "c.candidate_id", "position")


def positional(left: DataFrame, right: DataFrame) -> DataFrame:
    """Rows of equal ``ordinal`` side by side: zip by position."""
    return left.join(right, "ordinal")
