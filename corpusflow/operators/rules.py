"""Exact set, count and arithmetic checks over pairs of inventories."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusflow.functions.numbers import plain_verdict, verdict_of


def compare_sets(expected: Column, reported: Column, empty_is_explicit: Column | None = None) -> Column:
    """verdict, missing, unexpected, duplicates (sorted). Null where the expected set is unsound.

    Unsound: empty without being so explicitly, repeated or empty members.
    """
    missing, unexpected = F.array_sort(F.array_except(expected, reported)), F.array_sort(F.array_except(reported, expected))
    ordered = F.array_sort(reported)
    again = F.array_distinct(F.filter(ordered, lambda x, k: (k > 0) & (x == F.get(ordered, k - 1))))
    empty = F.coalesce(empty_is_explicit, F.lit(False)) if empty_is_explicit is not None else F.lit(False)
    blank = F.exists(F.concat(expected, reported), lambda x: x.isNull() | (x.cast("string") == ""))
    sound = ((F.size(expected) > 0) | empty) & (F.size(F.array_distinct(expected)) == F.size(expected)) & ~blank
    met = (F.size(missing) == 0) & (F.size(unexpected) == 0) & (F.size(again) == 0)
    return F.when(sound, F.struct(F.when(met, "MET").otherwise("NOT_MET").alias("verdict"), missing.alias("missing"), unexpected.alias("unexpected"), again.alias("duplicates")))


def compare_counts(counts: Column) -> Column:
    """verdict, missing (reported too few), unexpected (too many) over an array of (scope, expected, reported)."""
    low = F.transform(F.filter(counts, lambda c: c["reported"] < c["expected"]), lambda c: c["scope"])
    high = F.transform(F.filter(counts, lambda c: c["reported"] > c["expected"]), lambda c: c["scope"])
    met = (F.size(low) == 0) & (F.size(high) == 0)
    return F.struct(F.when(met, "MET").otherwise("NOT_MET").alias("verdict"), low.alias("missing"), high.alias("unexpected"))


def verify_sets(inventories: DataFrame) -> DataFrame:
    """key, verdict of two inventories that are complete and agree; null verdict otherwise.

    ``inventories``: key, coverage, mode, counts, expected_members, reported_members,
    empty_scope_is_explicit. Order within lists doesn't matter.
    """
    counts = F.array_sort(F.transform("counts", lambda c: F.struct(c["scope"].alias("scope"), c["expected"].alias("expected"), c["reported"].alias("reported"))))
    one = F.struct("mode", counts.alias("counts"), F.array_sort("expected_members").alias("expected"), F.array_sort("reported_members").alias("reported"), "empty_scope_is_explicit")
    g = inventories.select("key", "coverage", one.alias("b")).groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.min((F.col("coverage") == "MET").cast("int")).alias("whole"), F.min("b").alias("b"), F.max("b").alias("b2"))
    usable = (F.col("n") == 2) & (F.col("whole") == 1) & (F.col("b") == F.col("b2"))
    by_count = compare_counts(F.col("b.counts"))["verdict"]
    by_set = compare_sets(F.col("b.expected"), F.col("b.reported"), F.col("b.empty_scope_is_explicit"))["verdict"]
    return g.select("key", F.when(usable, F.when(F.col("b.mode") == "count", by_count).otherwise(by_set)).alias("verdict"))


_LEX = "struct<value: string, decimal_separator: string, group_separator: string, unit: string>"


@F.pandas_udf(T.StringType())
def _computed(operation: pd.Series, operands: pd.Series, reported: pd.DataFrame) -> pd.Series:
    clean = lambda x: None if x is None or x != x else x
    rows = zip(operation, operands, reported.to_dict("records"), strict=True)
    return pd.Series([verdict_of(op, [{k: clean(v) for k, v in dict(o).items()} for o in xs], {k: clean(v) for k, v in r.items()}) for op, xs, r in rows], dtype=object)


def verify_computations(inventories: DataFrame) -> DataFrame:
    """key, verdict of two complete inventories that agree: MET, NOT_MET; UNKNOWN otherwise (an unknown coverage isn't complete).

    ``inventories``: key, coverage, operation, operands (array of lexemes), reported_result.
    Exact for numbers of any length. Plain ones are decided in decimals by built-in functions; only the others
    (other scripts or separators, groups, more digits) go through Arrow batches. Each row is decided before the
    rows of a key meet as a few numbers: two inventories agree if two 64-bit hashes of their JSON do, so no
    lexemes are sorted or kept for a group.
    """
    whole = F.coalesce(F.col("coverage") == "MET", F.lit(False))
    rows = inventories.select("key", whole.alias("whole"), "operation", "operands", "reported_result", plain_verdict(F.col("operation"), F.col("operands"), F.col("reported_result")).alias("plain"))
    asked = F.col("plain").isNull() & F.col("whole")
    content = F.to_json(F.struct("operation", "operands", "reported_result"), {"ignoreNullFields": "false"})
    marks = ["key", F.col("whole").cast("int").alias("whole"), F.xxhash64(F.lit(1), content).alias("h"), F.xxhash64(F.lit(2), content).alias("k")]
    decided = rows.where(~asked).select(*marks, (F.col("plain") == "MET").cast("int").alias("met"))
    others = rows.where(asked).select(*marks, (_computed("operation", "operands", "reported_result") == "MET").cast("int").alias("met"))
    ends = [f(c).alias(f"{c}_{name}") for c in ("h", "k") for name, f in (("low", F.min), ("high", F.max))]
    g = decided.unionByName(others).groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.min("whole").alias("whole"), F.max("met").alias("met"), *ends)
    usable = (F.col("n") == 2) & (F.col("whole") == 1) & (F.col("h_low") == F.col("h_high")) & (F.col("k_low") == F.col("k_high"))
    return g.select("key", F.when(usable, F.when(F.col("met") == 1, "MET").otherwise("NOT_MET")).otherwise("UNKNOWN").alias("verdict"))


def exact_sum_check(rows: DataFrame, key: str, operand: str, reported: str) -> DataFrame:
    """The same check for plain decimals, in SQL decimals: key, total, verdict. Operands are rows, so their number has no limit."""
    g = rows.groupBy(key).agg(F.sum(operand).alias("total"), F.first(reported).alias("__r"), F.count(F.lit(1)).alias("n"))
    verdict = F.when(F.col("n") < 2, "NOT_MET").when(F.col("total") == F.col("__r"), "MET").otherwise("NOT_MET")
    return g.select(key, "n", "total", verdict.alias("verdict"))
