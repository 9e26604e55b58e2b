"""Merkle manifest of a table: a root that any change alters, and a proof for each row.

Each row is a leaf, the SHA-256 of its fields. The leaves of a source, in order of their id,
are reduced by runs of ``fanout`` to the source's root, and these, in order of the sources,
to the root of all. H is lowercase hex SHA-256, of digests as hex text one after the other.

The reduction goes by superblocks: leaves are dealt by (source, index div fanout^levels), a
group of at most fanout^levels rows collapses ``levels`` levels at once, and the groups'
roots are leaves of the next reduction, until every source has one. A row's proof is the
proof inside its group and then that of its group's root. So a source of any size is dealt
over groups of bounded size, and the number of shuffles is the depth divided by ``levels``.

A proof is one string: of each level, lowest first, the other digests of the run, left to
right. Where each of them belongs follows from the row's index and the number of leaves, so
``fold`` can recompute a root from a leaf and its proof, with built-in functions only.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusflow.llm.common import joined_by_hot_key, numbered, saved

FANOUT = 3
#: Levels that one group collapses: 729 leaves at most.
LEVELS = 6
#: Fields of a leaf.
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
_DIGITS = 64


def field(value: Column) -> Column:
    """A field's part of a leaf: ``-`` if null, else its bytes in UTF-8, ``:`` and the value."""
    said = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(said).cast("string"), F.lit(":"), said), F.lit("-"))


def leaf(*values: Column) -> Column:
    """The digest of a row's fields."""
    return F.sha2(F.concat(*map(field, values)).cast("binary"), 256)


def _digest(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def collapse(nodes: list[str], levels: int, fanout: int = FANOUT) -> tuple[list[str], list[str]]:
    """The nodes that ``levels`` reductions leave of consecutive nodes, and each node's proof up to there."""
    proofs: list[list[str]] = [[] for _ in nodes]
    at = list(range(len(nodes)))
    for _ in range(levels):
        runs = [nodes[i : i + fanout] for i in range(0, len(nodes), fanout)]
        others = ["".join(run[:k] + run[k + 1 :]) for run in runs for k in range(len(run))]
        for k, place in enumerate(at):
            proofs[k].append(others[place])
            at[k] = place // fanout
        nodes = [_digest("".join(run)) for run in runs]
    return nodes, ["".join(p) for p in proofs]


def depth(n: int, fanout: int = FANOUT) -> int:
    """Levels from ``n`` leaves to one node."""
    levels = 0
    while fanout**levels < n:
        levels += 1
    return levels


def _collapsed(levels: int, fanout: int) -> Callable[[pd.DataFrame], pd.DataFrame]:
    def run(block: pd.DataFrame) -> pd.DataFrame:
        block = block.sort_values("idx", kind="stable")
        top, proofs = collapse(block["node"].tolist(), min(levels, depth(int(block["n"].iloc[0]), fanout)), fanout)
        return block.assign(proof=proofs, top=top[0])

    return run


def reduced(nodes: DataFrame, fanout: int = FANOUT, levels: int = LEVELS) -> DataFrame:
    """``nodes`` (group, idx, n, node and further columns) with ``proof`` and ``top``, the one node that its group is reduced to."""
    size = fanout**levels
    block = F.expr(f"idx div {size}")
    schema = nodes.withColumn("block", block).schema.add("proof", "string").add("top", "string")
    lower = saved(nodes.withColumn("block", block).groupBy("group", "block").applyInPandas(_collapsed(levels, fanout), schema), "collapsed")
    if (lower.agg(F.max("n")).first()[0] or 0) <= size:
        return lower.drop("block")
    roots = lower.groupBy("group", "block").agg(F.max("top").alias("node"), F.expr(f"max((n + {size - 1}) div {size})").alias("n"))
    upper = reduced(roots.select("group", F.col("block").alias("idx"), "n", "node"), fanout, levels)
    joined = lower.drop("top").join(upper.select("group", F.col("idx").alias("block"), F.col("proof").alias("higher"), "top"), ["group", "block"])
    return joined.withColumn("proof", F.concat("proof", "higher")).drop("block", "higher")


def fold(node: str, proof: str, idx: str, n: str, fanout: int = FANOUT) -> Column:
    """The root that a leaf and its proof give, from the names of their columns, as a struct (node, used).

    ``used`` is the number of the proof's characters that belong to this tree.
    """
    powers = ", ".join(f"{fanout**k}L" for k in range(64) if fanout**k < 1 << 62)
    at = f"({idx} div p)"
    place = f"({at} % {fanout})"
    others = f"(least({fanout}, ({n} + p - 1) div p - ({at} - {place})) - 1)"
    left = f"substr({proof}, int(acc.used + 1), int({place} * {_DIGITS}))"
    right = f"substr({proof}, int(acc.used + {place} * {_DIGITS} + 1), int(({others} - {place}) * {_DIGITS}))"
    step = f"named_struct('node', sha2(cast(concat({left}, acc.node, {right}) as binary), 256), 'used', acc.used + {others} * {_DIGITS}L)"
    return F.expr(f"aggregate(filter(array({powers}), p -> p < {n}), named_struct('node', {node}, 'used', 0L), (acc, p) -> {step})")


def manifest(docs: DataFrame, doc_id: str = "doc_id", source: str = "source", fields: tuple[str, ...] = FIELDS, also: dict[str, Column] | None = None, fanout: int = FANOUT, levels: int = LEVELS) -> DataFrame:
    """One row for each row: doc_id, leaf, subroot, root, proof, and where the leaf stands.

    ``idx`` of ``n`` is its place in its source, ``source_idx`` of ``n_sources`` that of its
    source; ``fold_both`` needs them beside the proof. ``also`` names further values to
    carry along, computed from ``docs``; its other columns are ignored.

    A null field is ``-`` in the leaf, an empty text ``0:``; texts of any length are hashed
    whole. Null sources are one source, the first. Leaves of one id, and those without an id,
    which come first, are in order of their digests, so repeated rows are leaves one after
    the other. A lone leaf is its source's root. An empty table gives an empty result.
    """
    group = F.when(F.col(source).isNull(), "").otherwise(F.concat(F.lit("="), F.col(source).cast("string")))
    own = docs.select(F.col(doc_id).cast("long").alias("doc_id"), group.alias("group"), leaf(*map(F.col, fields)).alias("node"), *[v.alias(k) for k, v in (also or {}).items()])
    leaves = reduced(numbered(own, "group", F.col("doc_id").asc_nulls_first(), F.col("node")), fanout, levels)
    tops = leaves.groupBy("group").agg(F.max("top").alias("node"), F.max("n").alias("rows")).select(F.lit("").alias("group"), F.col("group").alias("name"), "node", "rows")
    trees = reduced(numbered(tops, "group", F.col("name").asc()), fanout, levels)
    trees = trees.select(F.col("name").alias("group"), "rows", F.col("idx").alias("source_idx"), F.col("n").alias("n_sources"), F.col("node").alias("subroot"), F.col("proof").alias("upper"), F.col("top").alias("root"))
    both = joined_by_hot_key(leaves, saved(trees, "trees"), "group", "rows")
    return both.select("doc_id", F.col("node").alias("leaf"), "subroot", "root", F.concat("proof", "upper").alias("proof"), "idx", "n", "source_idx", "n_sources", *(also or {}))


def fold_both(rows: DataFrame, node: str, fanout: int = FANOUT) -> DataFrame:
    """``rows`` of ``manifest`` with ``folded_root``, the root that ``node`` and the row's proof give."""
    lower = rows.withColumn("__f", fold(node, "proof", "idx", "n", fanout)).withColumn("__rest", F.expr("substr(proof, int(__f.used + 1))")).withColumn("__node", F.col("__f.node"))
    return lower.withColumn("folded_root", fold("__node", "__rest", "source_idx", "n_sources", fanout)["node"]).drop("__f", "__rest", "__node")
