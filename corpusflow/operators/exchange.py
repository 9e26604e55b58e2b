"""Exchange paths: complete a selection under quotas, minimums and caps that greedy rounds leave short.

A path puts a row in where a quota or minimum misses one. Where that exceeds a cap, one of
the selected rows there goes out, which may make another quota miss one, and so on. Any
feasible selection T can be reached from any selection S in this way: something that is
missing is always offered by a row of T that isn't in yet, and where a row of T is one too
many there is always a row outside of T to go. So the tree of all paths, where rows put in
stay and rows taken out don't return, has a path to T, or none exists.

All paths of one length are rows of one table; the next length is a join of it with the rows
outside (by what is missing) and with the selected rows (by the cap that is exceeded), which
are never more than the target and are broadcast. The first path that leaves less missing
is taken. Tables are bounded by ``WIDTH``, ``PER_CLASS`` and ``PER_NEED``; whether one of
these bounds has cut anything is said, and only an uncut search proves that nothing is feasible.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from corpusflow.session import forget, saved

#: Paths of one length that are followed.
WIDTH = 2048
#: Rows outside that are alike to the selection: same seat and family, same values where these are in use.
PER_CLASS = 64
#: Rows outside that a missing seat or family is offered.
PER_NEED = 4096
ITEM = ("conversation_id", "seat", "task_family", "image_id", "visual_group_id", "semantic_family")


def _missing(ins: Column, outs: Column, needs: list[tuple[str, str, int]]) -> Column:
    """What the selection misses after a path: kind, value and number, in fixed order."""
    table = F.array(*[F.struct(F.lit(k).alias("kind"), F.lit(v).alias("value"), F.lit(n).cast("long").alias("left")) for k, v, n in needs])

    def lack(need: Column) -> Column:
        of = lambda x: F.coalesce(F.when(need["kind"] == "seat", x["seat"]).otherwise(x["task_family"]) == need["value"], F.lit(False))
        n = F.greatest(F.lit(0).cast("long"), need["left"] - F.size(F.filter(ins, of)) + F.size(F.filter(outs, of)))
        return F.struct(need["kind"].alias("kind"), need["value"].alias("value"), n.alias("n"))

    return F.transform(table, lack)


def _used(rows: DataFrame, taken: list[Row], column: str, limits: Mapping[str, int] | int) -> DataFrame:
    """value, used and room's end of each value of ``column`` that is in use or has a limit of its own."""
    counts = Counter(r[column] for r in taken)
    own = {v: limits for v in counts} if isinstance(limits, int) else limits
    table = [(v, counts.get(v, 0), n) for v, n in own.items()]
    return rows.sparkSession.createDataFrame(table, f"{column}_value string, {column}_used int, {column}_limit int")


def _outside(rows: DataFrame, taken: list[Row], used: dict[str, DataFrame]) -> tuple[DataFrame, bool]:
    """Rows that may be put in, and whether a bound has left some out. Rows with fewer values in use come first."""
    spark = rows.sparkSession
    gone = spark.createDataFrame([(r["conversation_id"],) for r in taken], "conversation_id string")
    d = rows.join(F.broadcast(gone), "conversation_id", "left_anti")
    caps = [c for c in used if c != "seat"]
    for c in caps:
        d = d.join(F.broadcast(used[c].select(F.col(f"{c}_value"))), F.col(c) == F.col(f"{c}_value"), "left")
    load = sum((F.col(f"{c}_value").isNotNull().cast("int") for c in caps), F.lit(0))
    d = d.withColumn("load", load).withColumn("__r", F.row_number().over(W.partitionBy("seat", "task_family", *[f"{c}_value" for c in caps]).orderBy("h", "conversation_id")))
    d = d.where(F.col("__r") <= PER_CLASS)
    for need in ("seat", "task_family"):
        d = d.withColumn(f"__{need}", F.row_number().over(W.partitionBy(need).orderBy("load", "h", "conversation_id")))
    d = saved(d.where((F.col("__seat") <= PER_NEED) | (F.col("__task_family") <= PER_NEED)).select(*ITEM), "outside")
    return d, d.count() + len(taken) < rows.count()


def _alike(path: str, column: str) -> Column:
    """Rows of a path with the same value as the new row."""
    return F.size(F.filter(path, lambda x: x[column] == F.col(f"new.{column}")))


def _longer(paths: DataFrame, outside: DataFrame, held: DataFrame, used: dict[str, DataFrame], caps: dict[str, int]) -> DataFrame:
    """All paths one row longer: what is missing is put in, and for each cap that this exceeds a selected row goes out."""
    item = F.struct(*ITEM)
    seat = paths.where("kind = 'seat'").join(outside, F.col("value") == F.col("seat"))
    family = paths.where("kind = 'task_family'").join(outside, F.col("value") == F.col("task_family"))
    d = seat.unionByName(family).select("ins", "outs", item.alias("new")).where(~F.exists("ins", lambda x: x["conversation_id"] == F.col("new.conversation_id")))
    for c, table in used.items():
        value = F.col(f"new.{c}")
        d = d.join(F.broadcast(table), value == F.col(f"{c}_value"), "left")
        count = F.coalesce(F.col(f"{c}_used"), F.lit(0)) + _alike("ins", c) - _alike("outs", c)
        limit = F.coalesce(F.col(f"{c}_limit"), F.lit(caps.get(c, 0)))
        d = d.withColumn("over", count >= limit).drop(f"{c}_value", f"{c}_used", f"{c}_limit")
        options = F.broadcast(held.select(F.col(c).alias("of"), item.alias("old")))
        on = F.col("over") & (value == F.col("of")) & ~F.exists("outs", lambda x: x["conversation_id"] == F.col("old.conversation_id"))
        d = d.join(options, on, "left").where("not over or old is not null")
        d = d.withColumn("outs", F.when(F.col("over"), F.array_append("outs", F.col("old"))).otherwise(F.col("outs"))).drop("over", "of", "old")
    return d.select(F.array_sort(F.array_append("ins", F.col("new"))).alias("ins"), F.array_sort("outs").alias("outs")).distinct()


def complete(rows: DataFrame, taken: list[Row], quotas: dict[str, int], minimums: dict[str, int], caps: dict[str, int]) -> tuple[list[Row], bool, bool]:
    """``taken`` after as many exchanges as help, whether nothing is missing, and whether the search was whole.

    ``rows`` has the columns of ``ITEM``, without nulls in the capped ones, and ``h``; ``quotas`` are the exact numbers of
    all seats, ``minimums`` those of families, ``caps`` the most rows of a value by column.
    """
    by = {r["conversation_id"]: r for r in taken}
    whole = True
    kind = rows.select(F.struct(*ITEM).alias("x")).schema["x"].dataType.simpleString()
    while True:
        now = list(by.values())
        seats, families = Counter(r["seat"] for r in now), Counter(r["task_family"] for r in now)
        needs = [("seat", k, n - seats[k]) for k, n in sorted(quotas.items())] + [("task_family", k, n - families[k]) for k, n in sorted(minimums.items())]
        short = sum(max(0, n) for *_, n in needs)
        if not short:
            return now, True, whole
        used = {c: _used(rows, now, c, cap) for c, cap in caps.items()} | {"seat": _used(rows, now, "seat", quotas)}
        held = rows.sparkSession.createDataFrame([tuple(r[c] for c in ITEM) for r in now], ", ".join(f"{c} string" for c in ITEM))
        outside, cut = _outside(rows, now, used)
        whole &= not cut
        paths = rows.sparkSession.createDataFrame([([], [])], f"ins array<{kind}>, outs array<{kind}>")
        paths = _with_need(paths, needs)
        found = None
        try:
            for _ in range(sum(quotas.values())):
                before, paths = paths, saved(_with_need(_longer(paths, outside, held, used, caps), needs), "paths")
                forget(before)
                n = paths.count()
                if not n:
                    break
                found = paths.where(F.col("short") < short).orderBy("short", "ins", "outs").first()
                if found:
                    break
                if n > WIDTH:
                    whole, before = False, paths
                    paths = saved(paths.orderBy("short", F.size("outs"), F.xxhash64(F.to_json("ins"), F.to_json("outs"))).limit(WIDTH), "paths")
                    forget(before)
        finally:
            forget(outside)
            forget(paths)
        if not found:
            return now, False, whole
        for x in found["outs"]:
            del by[x["conversation_id"]]
        for x in found["ins"]:
            by[x["conversation_id"]] = x


def _with_need(paths: DataFrame, needs: list[tuple[str, str, int]]) -> DataFrame:
    """Paths with ``short``, how much is missing at their end, and the first thing that is (``kind``, ``value``)."""
    d = paths.select("ins", "outs", F.filter(_missing(F.col("ins"), F.col("outs"), needs), lambda x: x["n"] > 0).alias("miss"))
    first = F.get("miss", F.lit(0))
    return d.select("ins", "outs", F.aggregate("miss", F.lit(0).cast("long"), lambda s, x: s + x["n"]).alias("short"), first["kind"].alias("kind"), first["value"].alias("value"))
