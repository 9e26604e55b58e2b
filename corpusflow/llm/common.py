"""What the operators of this subpackage share: reading tables, shared storage, labels."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from corpusflow.session import importable, saved, shared_dir

__all__ = ["bounded_sample", "free_name", "held_out", "joined_by_hot_key", "numbered", "saved", "shared_dir", "table"]

#: At most so many keys can hold more than this part of all rows each.
HOT_PARTS = 1024


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table of a data set, read by Spark, so that any store that Spark reads will do."""
    return importable(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def held_out(doc_id: Column) -> Column:
    """True where crc32(doc_id as text) mod 3 is 1: such rows never train a model. Null id: false."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def bounded_sample(df: DataFrame, key: str, by: str, rows: int) -> DataFrame:
    """At most ``rows`` rows of each value of ``by`` (a few classes), by rank of a hash of ``key``.

    The bound is for model fitting only. Each class is a top-k by hash (no shuffle of
    its rows), so the sample does not depend on partitioning.
    """
    rank = F.xxhash64(F.col(key).cast("string"), F.lit("sample"))
    classes = sorted(r[0] for r in df.select(by).where(F.col(by).isNotNull()).distinct().collect())
    out = None
    for c in classes:
        part = df.where(F.col(by) == F.lit(c)).orderBy(rank, key).limit(rows)
        out = part if out is None else out.unionByName(part)
    return df.limit(0) if out is None else out


def free_name(df: DataFrame, name: str) -> str:
    """A column name like ``name`` that ``df`` doesn't have, in any case of its letters."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def joined_by_hot_key(rows: DataFrame, facts: DataFrame, key: str, count: str) -> DataFrame:
    """``rows`` joined with ``facts`` (one row for each value of ``key``, with the number of its rows in ``count``).

    Values with more than 1 of ``HOT_PARTS`` parts of all rows, of which there are fewer than
    ``HOT_PARTS``, are broadcast, so that none of them lands in one task; the others meet in
    a shuffle. Where all values are of one kind there is one join, so that the driver plans
    and broadcasts nothing for the other. The column ``count`` is dropped, and rows without a fact too.
    """
    total, most, least = facts.agg(F.sum(count), F.max(count), F.min(count)).first()
    bound = (total or 0) / HOT_PARTS
    if (most or 0) <= bound:
        return rows.join(facts.drop(count), key)
    if least > bound:
        return rows.join(F.broadcast(facts.drop(count)), key)
    hot = facts.where(F.col(count) > bound).drop(count)
    rest = facts.where(F.col(count) <= bound).drop(count)
    spread = rows.join(F.broadcast(hot), key)
    dealt = rows.join(F.broadcast(hot.select(key)), key, "left_anti").join(rest, key)
    return spread.unionByName(dealt)


def numbered(rows: DataFrame, group: str, *order: Column) -> DataFrame:
    """``rows`` with ``idx`` (from 0, in ``order``) and ``n`` (the number of rows) within each value of ``group``, which has no nulls.

    Rows are dealt by ranges of group and order, sorted and numbered inside of a range; each
    range's first number comes from the counts of the ranges before it. So a group of any
    size is spread over tasks. Rows alike in group and order should be alike altogether.
    """
    ranged = rows.repartitionByRange(group, *order).sortWithinPartitions(group, *order)
    ranged = saved(ranged.withColumn("__at", F.monotonically_increasing_id()), "ranged").withColumn("__range", F.shiftright("__at", 33))
    counts = ranged.groupBy(group, "__range").agg(F.min("__at").alias("__first"), F.count(F.lit(1)).alias("__rows"))
    before = W.partitionBy(group).orderBy("__range").rowsBetween(W.unboundedPreceding, -1)
    bases = counts.select(group, "__range", (F.coalesce(F.sum("__rows").over(before), F.lit(0)) - F.col("__first")).alias("__base"), F.sum("__rows").over(W.partitionBy(group)).alias("n"))
    return ranged.join(bases, [group, "__range"]).withColumn("idx", F.col("__at") + F.col("__base")).drop("__at", "__range", "__base")
