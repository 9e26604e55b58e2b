"""Trie of conversations that begin alike, by rounds over its levels.

A node of depth d is a distinct sequence of the first d turns; its members are the
conversations that begin with it, and it is named by its depth and its smallest member.

Downwards, a round for each level: the live conversations, those that share their node with
another one, meet their turn of that depth and are grouped by (parent node, turn); a group is
a node. A conversation alone in its node leaves the rounds: what follows in it is a chain of
nodes of its own, which need no grouping and are made for all such conversations at once. So
there are as many rounds as turns in the longest beginning that two conversations share.
Upwards, level by level, the nodes of a level are joined with the sums over their children.

Turns are compared by the SHA-256 of role and text; texts themselves never move.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusflow.llm.common import joined_by_hot_key, numbered, saved
from corpusflow.session import forget

#: Ids whose text is put together at once.
CHUNK = 4096
COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
_NO_ENDS = hashlib.sha256(b"").hexdigest()


def turns_of(conversations: DataFrame) -> DataFrame:
    """conv_id, idx (from 0, by turn, null first), n (turns of the conversation), digest and n_bytes of each turn.

    Turns alike in number are in order of their digests. Rows without a conv_id belong to no
    conversation and are left out. Long conversations are numbered in ranges.
    """
    role, text = F.coalesce(F.col("role").cast("string"), F.lit("")), F.coalesce(F.col("text").cast("string"), F.lit(""))
    digest = F.unhex(F.sha2(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text).cast("binary"), 256))
    rows = conversations.where("conv_id is not null").select(F.col("conv_id").cast("long").alias("conv_id"), "turn", digest.alias("digest"), F.octet_length(text).cast("long").alias("n_bytes"))
    return numbered(rows, "conv_id", F.col("turn").asc_nulls_first(), F.col("digest")).drop("turn")


def branched(turns: DataFrame, base: Column, kept: Column, most: int) -> tuple[DataFrame, DataFrame]:
    """Conversations that begin with the first turns of another one, as branches of a dialogue do.

    ``turns`` is as ``turns_of`` gives it. ``base`` and ``kept`` are functions of conv_id: each
    conversation becomes the first ``kept`` turns (at most ``most``) of conversation ``base``
    (fewer if it has fewer, none if it doesn't exist), then its own turns from number ``kept``
    on. Returns turns (conv_id, depth from 1, digest, n_bytes) and conversations (conv_id,
    length), also those left without a turn.
    """
    convs = saved(turns.groupBy("conv_id").agg(F.max("n").alias("n")).withColumn("base", base).withColumn("kept", kept), "conversations")
    based = convs.join(convs.select(F.col("conv_id").alias("base"), F.col("n").alias("there")), "base", "left").withColumn("taken", F.least("kept", F.coalesce("there", F.lit(0))))
    based = saved(based.select("conv_id", "n", "base", "kept", "taken"), "based")
    rows = turns.select("conv_id", "idx", "digest", "n_bytes")
    own = joined_by_hot_key(rows, based.select("conv_id", "n", "kept", "taken"), "conv_id", "n").where("idx >= kept")
    own = own.select("conv_id", (F.col("taken") + F.col("idx") - F.col("kept") + 1).alias("depth"), "digest", "n_bytes")
    heads = rows.where(F.col("idx") < most).select(F.col("conv_id").alias("base"), "idx", "digest", "n_bytes")
    given = heads.join(based.where("taken > 0").select("conv_id", "base", "taken"), "base").where("idx < taken").select("conv_id", (F.col("idx") + 1).alias("depth"), "digest", "n_bytes")
    lengths = based.select("conv_id", (F.col("taken") + F.greatest(F.col("n") - F.col("kept"), F.lit(0))).cast("long").alias("length"))
    return own.unionByName(given), lengths


def _hashed(ends: DataFrame) -> DataFrame:
    """ends_sha256 of each (depth, node): the digest of its ids, ascending, joined by commas.

    Ids are joined in chunks by ranges of their values first; the chunks of a node pass in
    order through a running hash, so no node's ids are ever one row.
    """
    chunk = F.floor(F.col("conv_id") / CHUNK)
    said = F.array_join(F.transform(F.array_sort(F.collect_list("conv_id")), lambda x: x.cast("string")), ",")
    rows = ends.groupBy("depth", "node", chunk.alias("chunk")).agg(said.alias("said")).repartition("depth", "node").sortWithinPartitions("depth", "node", "chunk")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, digest = None, None

        def closed(done: list[tuple[int, int, str]]) -> pa.RecordBatch:
            columns = list(zip(*done, strict=True)) or [(), (), ()]
            return pa.RecordBatch.from_arrays([pa.array(columns[0], pa.int64()), pa.array(columns[1], pa.int64()), pa.array(columns[2], pa.string())], ["depth", "node", "ends_sha256"])

        for batch in batches:
            done = []
            for depth, node, text in zip(*(batch.column(c).to_pylist() for c in ("depth", "node", "said")), strict=True):
                if (depth, node) == key:
                    digest.update(b"," + text.encode())
                    continue
                if key is not None:
                    done.append((*key, digest.hexdigest()))
                key, digest = (depth, node), hashlib.sha256(text.encode())
            yield closed(done)
        if key is not None:
            yield closed([(*key, digest.hexdigest())])

    return rows.mapInArrow(run, "depth long, node long, ends_sha256 string")


def trie(turns: DataFrame, convs: DataFrame) -> DataFrame:
    """Nodes of the trie over conversations (conv_id, length) and their turns (conv_id, depth from 1, digest, n_bytes).

    A row for each node: conv_id (its smallest member), depth, parent_conv_id (null for the
    root), n_convs, n_children, n_leaves (childless nodes of its subtree, itself included),
    saved_tokens (summed over its subtree, members but one times the bytes of its last
    text: what a cache of prefixes saves), ends_sha256 (digest of the ids of members that end
    there). Conversations without turns are members of the root. Conversations alike
    share all their nodes. Without conversations there is no root: an empty result.
    """
    spark = turns.sparkSession
    turns = saved(turns.select("conv_id", F.col("depth").cast("long").alias("depth"), "digest", "n_bytes").sortWithinPartitions("depth"), "turns")
    root = convs.agg(F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("n_convs"), F.max("length").alias("length"), F.lit(0).cast("long").alias("n_bytes"))
    root = root.where("n_convs > 0").select("conv_id", F.lit(None).cast("long").alias("parent"), "n_convs", "length", "n_bytes", F.lit(0).cast("long").alias("depth"))
    first = root.first()
    if first is None:
        return spark.createDataFrame([], "conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, ends_sha256 string")
    made = [saved(root, "level")]
    members = [saved(convs.select("conv_id", "length", F.lit(first["conv_id"]).cast("long").alias("node"), F.lit(0).cast("long").alias("depth")), "members")]
    shared = first["n_convs"] > 1
    while shared:
        depth = len(made)
        live = members[-1].where(F.col("length") >= depth).select("conv_id", "length", F.col("node").alias("parent"))
        here = saved(turns.where(F.col("depth") == depth).join(live, "conv_id").select("conv_id", "length", "n_bytes", F.struct("parent", "digest").alias("turn")), "here")
        nodes = here.groupBy("turn").agg(F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("n_convs"), F.max("length").alias("length"), F.max("n_bytes").alias("n_bytes"))
        nodes = saved(nodes.select("conv_id", F.col("turn.parent").alias("parent"), "n_convs", "length", "n_bytes", F.lit(depth).cast("long").alias("depth"), "turn"), "level")
        made.append(nodes)
        many = nodes.where("n_convs > 1")
        shared = bool(many.take(1))
        if shared:
            within = joined_by_hot_key(here.select("conv_id", "length", "turn"), many.select("turn", F.col("conv_id").alias("node"), "n_convs"), "turn", "n_convs")
            members.append(saved(within.select("conv_id", "length", "node", F.lit(depth).cast("long").alias("depth")), "members"))
        forget(here)

    every = _read(made, "conv_id", "parent", "n_convs", "length", "n_bytes", "depth")
    lone = saved(every.where("n_convs = 1").select("conv_id", F.col("depth").alias("top"), "length", (F.col("length") - F.col("depth") + 1).alias("rows")), "lone")
    chain = joined_by_hot_key(turns.select("conv_id", "depth"), lone, "conv_id", "rows").where("depth > top")
    chain = chain.select("conv_id", "depth", F.col("conv_id").alias("parent"), "length")
    alone = chain.unionByName(every.where("n_convs = 1").select("conv_id", "depth", "parent", "length"))
    ended = F.when(F.col("depth") == F.col("length"), F.sha2(F.col("conv_id").cast("string").cast("binary"), 256)).otherwise(_NO_ENDS)
    one, none = F.lit(1).cast("long"), F.lit(0).cast("long")
    alone = alone.select("conv_id", "depth", F.col("parent").alias("parent_conv_id"), one.alias("n_convs"), (F.col("depth") < F.col("length")).cast("long").alias("n_children"), one.alias("n_leaves"), none.alias("saved_tokens"), ended.alias("ends_sha256"))

    done: list[DataFrame] = []
    sums = None
    for level in reversed(made):
        own = level.where("n_convs > 1").select("conv_id", "depth", "parent", "n_convs", ((F.col("n_convs") - 1) * F.col("n_bytes")).alias("saving"))
        if sums is not None:
            up = own.join(sums, own["conv_id"] == sums["of"], "left")
            up = up.select("conv_id", "depth", "parent", "n_convs", F.coalesce("n_children", none).alias("n_children"), F.coalesce("n_leaves", one).alias("n_leaves"), (F.col("saving") + F.coalesce("below", none)).alias("saved_tokens"))
            done.append(saved(up, "rolled"))
            both = done[-1].select("parent", "n_leaves", "saved_tokens").unionByName(level.where("n_convs = 1").select("parent", one.alias("n_leaves"), none.alias("saved_tokens")))
        else:
            both = level.select("parent", one.alias("n_leaves"), none.alias("saved_tokens"))
        sums = both.groupBy(F.col("parent").alias("of")).agg(F.count(F.lit(1)).alias("n_children"), F.sum("n_leaves").alias("n_leaves"), F.sum("saved_tokens").alias("below"))
    if not done:
        return alone.select(COLUMNS)
    rolled = _read(done, *done[0].columns)
    ends = _hashed(_read(members, "conv_id", "length", "node", "depth").where("length = depth").select("conv_id", "node", "depth"))
    rolled = rolled.join(ends.select(F.col("node").alias("conv_id"), "depth", "ends_sha256"), ["conv_id", "depth"], "left")
    rolled = rolled.select("conv_id", "depth", F.col("parent").alias("parent_conv_id"), "n_convs", "n_children", "n_leaves", "saved_tokens", F.coalesce("ends_sha256", F.lit(_NO_ENDS)).alias("ends_sha256"))
    return rolled.unionByName(alone).select(COLUMNS)


def _read(frames: list[DataFrame], *columns: str) -> DataFrame:
    """The rows of several saved tables as one scan, however many they are."""
    first = frames[0].select(*columns)
    return first.sparkSession.read.schema(first.schema).parquet(*[f._saved_path for f in frames])
