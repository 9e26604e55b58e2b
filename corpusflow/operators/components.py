"""Connected components as DataFrame rounds of large-star and small-star."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusflow.session import forget, saved


def _mark(edges: DataFrame) -> tuple:
    """Edge count and order-independent sums over the edges; equal marks mean equal sets."""
    sums = [F.sum(F.xxhash64("u", "v", F.lit(salt)).cast("decimal(38,0)")) for salt in (1, 2)]
    return tuple(edges.agg(F.count(F.lit(1)), *sums).first())


def _on_driver(edges: DataFrame) -> DataFrame:
    """The same by union-find, for a number of edges known to be small."""
    parent: dict = {}

    def find(x):
        while parent.setdefault(x, x) != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for u, v in edges.collect():
        a, b = find(u), find(v)
        parent[max(a, b)] = min(a, b)
    kind = edges.schema["u"].dataType.simpleString()
    return edges.sparkSession.createDataFrame([(x, find(x)) for x in list(parent)], f"node {kind}, root {kind}")


def components(edges: DataFrame, max_rounds: int = 60, small: int = 0) -> DataFrame:
    """Smallest node reachable from each node: columns ``node`` and ``root``.

    ``edges`` has columns ``u`` and ``v`` of one orderable type; null ends, self loops and
    repeats are ignored, and an empty input gives an empty result. A node's edges are never
    gathered in one place: each round takes minima by partial aggregation and joins them
    back, so a node with very many neighbours is split by the skew handling of the join.
    Each round is written to the shared folder, which keeps the plan short and survives
    lost executors. Rounds grow with the logarithm of the longest path. Up to ``small``
    edges (default: none) are solved on the driver instead, with the same result.
    """
    e = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"), (F.col("u").isNotNull() & F.col("v").isNotNull()).alias("whole"))
    e = saved(e.where("whole and u <> v").select("u", "v").distinct(), "edges")
    mark = _mark(e)
    if mark[0] <= small:
        return _on_driver(e)
    for _ in range(max_rounds):
        if not mark[0]:
            break
        both = e.select("u", "v").unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(low, "u").where("v > u and v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        pair = F.array(F.struct(F.col("v").alias("u"), F.col("m").alias("v")), F.struct("u", F.col("m").alias("v")))
        tight = large.join(low, "u").select(F.explode(pair).alias("e")).select("e.u", "e.v")
        before, e = e, saved(tight.where("u <> v").distinct(), "edges")
        new = _mark(e)
        forget(before)
        if new == mark:
            break
        mark = new
    else:
        raise RuntimeError(f"no fixed point after {max_rounds} rounds")
    stars = e.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(e.select(F.col("v").alias("node"), F.col("v").alias("root")))
    return stars.groupBy("node").agg(F.min("root").alias("root"))
