"""Near copies by cosine, exact and declared copies by key, groups as components."""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusflow.functions.hashing import SEED, json_array
from corpusflow.operators.components import components
from corpusflow.session import saved

THRESHOLD = 0.95
#: Blocks of vectors that meet in one task, and tiles of them that meet in one matrix product, whose candidates are verified in parts.
BLOCK_BYTES, TILE, CANDIDATES = 1 << 24, 512, 1 << 16
#: Signs of a sketch, rows that meet a row by chance under each code, and rows that are coded at a time.
SKETCH, CHANCE, CODED = 128, 16, 256


def checked_vectors(vectors: DataFrame, key: str = "image_id", vector: str = "embedding") -> DataFrame:
    """Unit vectors in doubles: (key, unit). Empty, non-finite, zero vectors and different dimensions are errors."""
    v = vectors.select(F.col(key), F.transform(vector, lambda x: x.cast("double")).alias("v"))
    bad = (F.size("v") <= 0) | F.exists("v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    norm = F.sqrt(F.aggregate("v", F.lit(0.0), lambda s, x: s + x * x))
    # one pass checks all rows; a check inside the plan could be moved before a filter of the caller
    shape = v.agg(F.min(F.size("v")).alias("low"), F.max(F.size("v")).alias("high"), F.max(bad.cast("int")).alias("bad"), F.min(norm).alias("norm")).first()
    if shape["bad"]:
        raise ValueError("an embedding is empty or not finite")
    if shape["low"] != shape["high"]:
        raise ValueError("embeddings must have one dimension")
    if shape["norm"] == 0:
        raise ValueError("an embedding is zero")
    return v.withColumn("norm", norm).select(F.col(key), F.transform("v", lambda x: F.try_divide(x, F.col("norm"))).alias("unit"))


def _tile_pairs(left: tuple[pa.Array, np.ndarray], right: tuple[pa.Array, np.ndarray], threshold: float, same: bool) -> Iterator[pa.RecordBatch]:
    """Pairs (left_id < right_id, cosine) of at least ``threshold`` between two blocks, or inside of one, tile by tile."""
    (left_ids, x), (right_ids, y) = left, right
    # single precision finds the candidates, with room for its rounding; these are then added up in doubles
    room = (x.shape[1] + 8) * 2.0**-22
    narrow, wide = x.astype(np.float32), y.astype(np.float32)
    for a in range(0, len(x), TILE):
        for b in range(a if same else 0, len(y), TILE):
            part = wide[b : b + TILE]
            at = np.flatnonzero(narrow[a : a + TILE] @ part.T >= threshold - room)
            for k in range(0, len(at), CANDIDATES):
                i, j = np.divmod(at[k : k + CANDIDATES], len(part))
                i, j = i + a, j + b
                if same:
                    i, j = i[i < j], j[i < j]
                # products are added up from the first coordinate on
                cosine = np.zeros(len(i))
                for d in range(x.shape[1]):
                    cosine += x[i, d] * y[j, d]
                near = cosine >= threshold
                u, v = left_ids.take(pa.array(i[near])), right_ids.take(pa.array(j[near]))
                order = pc.less(u, v)
                pairs = pa.RecordBatch.from_arrays([pc.if_else(order, u, v), pc.if_else(order, v, u), pa.array(cosine[near])], ["left_id", "right_id", "cosine"])
                yield pairs.filter(pc.not_equal(u, v))


def _cell_pairs(batches: Iterator[pa.RecordBatch], threshold: float) -> Iterator[pa.RecordBatch]:
    """Pairs of each cell, whose rows (cell, second, same, id, unit) come together: first with second block, or all rows of one block."""
    cell, same, sides = None, False, ([], [])

    def closed() -> Iterator[pa.RecordBatch]:
        first, second = [(pa.concat_arrays([ids for ids, _ in s]), np.concatenate([x for _, x in s])) if s else None for s in sides]
        if first and (same or second):
            yield from _tile_pairs(first, first if same else second, threshold, same)

    for batch in batches:
        cells = np.asarray(batch.column("cell"))
        cuts = [0, *(np.flatnonzero(np.diff(cells)) + 1).tolist(), len(cells)]
        for start, end in zip(cuts[:-1], cuts[1:], strict=True):
            if end == start:
                continue
            if cells[start] != cell:
                yield from closed()
                cell, same, sides = cells[start], batch.column("same")[start].as_py(), ([], [])
            part = batch.slice(start, end - start)
            units, second = np.asarray(part.column("unit").flatten()).reshape(len(part), -1), np.asarray(part.column("second").to_pylist(), bool)
            for side, mask in enumerate((~second, second)):
                if mask.any():
                    sides[side].append((part.column("id").filter(pa.array(mask)), units[mask]))
    yield from closed()


def similar_pairs(vectors: DataFrame, threshold: float = THRESHOLD, key: str = "image_id", vector: str = "embedding", block: int | None = None) -> DataFrame:
    """All pairs (left_id < right_id, cosine) of cosine at least ``threshold``.

    Exact, and quadratic: among directions spread evenly in many dimensions no bound prunes, so all
    pairs meet; ``banded_pairs`` is the way for large tables. Vectors are dealt into blocks by a hash
    of the key, and each two blocks meet in one task (a cell) in tiles of bounded size, so that
    only pairs that reach the threshold become rows. A vector is shuffled once for each block:
    as many as occupy the cores, or as many as keep a block at ``BLOCK_BYTES`` (``block`` vectors if given).
    """
    unit = saved(checked_vectors(vectors, key, vector).where(F.col(key).isNotNull()), "unit")
    ids = dict(unit.dtypes)[key]
    shape = unit.agg(F.count(F.lit(1)).alias("n"), F.max(F.size("unit")).alias("d")).first()
    n, most = shape["n"], block or max(TILE, BLOCK_BYTES // (8 * (shape["d"] or 1)))
    busy = math.ceil(math.sqrt(6 * unit.sparkSession.sparkContext.defaultParallelism))
    blocks = max(1, math.ceil(n / most), min(busy, n // TILE))
    own, other = F.pmod(F.xxhash64(F.col(key)), F.lit(blocks)), F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))
    dealt = unit.select(F.col(key).alias("id"), "unit", own.cast("int").alias("own"), other.alias("other"))
    # cells (i, j) with i <= j are numbered along their rows
    i, j = F.least("own", "other"), F.greatest("own", "other")
    cell = (i * blocks - F.floor(i * (i - 1) / 2) + j - i).cast("int")
    met = dealt.select(cell.alias("cell"), (F.col("own") > F.col("other")).alias("second"), (F.col("own") == F.col("other")).alias("same"), "id", "unit")
    met = met.repartitionById(blocks * (blocks + 1) // 2, "cell").sortWithinPartitions("cell")
    return met.mapInArrow(lambda batches: _cell_pairs(batches, threshold), f"left_id {ids}, right_id {ids}, cosine double")


def similar_links(vectors: DataFrame, threshold: float = THRESHOLD, key: str = "image_id", vector: str = "embedding") -> DataFrame:
    """Links (u, v) that give the same components as ``similar_pairs``: equal vectors are linked to the least of them, which alone meets others."""
    if threshold > 1 - 1e-9:  # the rounded cosine of equal vectors may be less
        return similar_pairs(vectors, threshold, key, vector).select(F.col("left_id").alias("u"), F.col("right_id").alias("v"))
    known = vectors.where(F.col(key).isNotNull()).select(key, vector)
    least = saved(known.groupBy(vector).agg(F.min(key).alias(key), F.count(F.lit(1)).alias("n")), "distinct")
    copies = known.join(least.where("n > 1").select(vector, F.col(key).alias("v")), vector).where(F.col(key) != F.col("v")).select(F.col(key).alias("u"), "v")
    pairs = similar_pairs(least.select(key, vector), threshold, key, vector)
    return copies.unionByName(pairs.select(F.col("left_id").alias("u"), F.col("right_id").alias("v")))


def bands(rows: int, threshold: float, recall: float) -> tuple[int, int]:
    """Signs in a code and number of codes, so that a pair at the threshold shares a code with probability ``recall``.

    A random plane has two vectors on one side with probability ``1 - angle / pi``. Codes are as
    long as it takes to number the rows, so that chance meetings stay few.
    """
    agree = 1 - math.acos(max(-1.0, min(1.0, threshold))) / math.pi
    signs = min(60, max(4, math.ceil(math.log2(rows + 1))))
    return signs, max(1, math.ceil(math.log(1 - recall) / math.log(1 - min(agree**signs, 1 - 1e-12))))


def sketch_cut(threshold: float, miss: float, bits: int = SKETCH) -> int:
    """Most bits in which sketches differ: a pair at the threshold differs in more with probability ``miss`` at most."""
    q = math.acos(max(-1.0, min(1.0, threshold))) / math.pi
    tail, cut = 0.0, bits
    while cut > 0 and tail + math.comb(bits, cut) * q**cut * (1 - q) ** (bits - cut) <= miss:
        tail += math.comb(bits, cut) * q**cut * (1 - q) ** (bits - cut)
        cut -= 1
    return cut


def banded_pairs(vectors: DataFrame, threshold: float = THRESHOLD, recall: float = 0.95, key: str = "image_id", vector: str = "embedding", seed: int = SEED) -> DataFrame:
    """Pairs (left_id < right_id, cosine) of cosine at least ``threshold``: each is found with probability ``recall`` or more.

    Codes of signs by random planes are joined. Codes are a little shorter than it takes to number the rows, so
    that few are needed; what meets by chance is dropped inside the join by a sketch of ``SKETCH`` more signs, and
    only the pairs left fetch their vectors and are verified exactly. Codes and sketch may each lose half of what
    ``recall`` allows. Work follows the rows and the pairs that meet, not all pairs; planes depend on the seed alone.
    Meant for thresholds of about 0.8 and more: below, codes that keep the recall become too many.
    """
    unit = saved(checked_vectors(vectors, key, vector), "unit")
    first = unit.select(F.size("unit").alias("d")).first()
    if first is None:
        return similar_pairs(vectors, threshold, key, vector)
    miss = (1 - recall) / 2
    signs, codes = bands(unit.count() // CHANCE, threshold, 1 - miss)
    cut = sketch_cut(threshold, miss)
    planes = np.random.default_rng(seed).standard_normal((first["d"], codes * signs + SKETCH))
    powers = 1 << np.arange(signs, dtype=np.int64)
    named = np.arange(codes, dtype=np.int64) << signs

    @F.pandas_udf("codes array<long>, sketch array<long>")
    def coded(units: pd.Series) -> pd.DataFrame:
        found, sketches = [], []
        for k in range(0, len(units), CODED):
            side = np.stack(units[k : k + CODED]) @ planes > 0
            found += list(side[:, : codes * signs].reshape(len(side), codes, signs) @ powers + named)
            sketches += list(np.packbits(side[:, codes * signs :], axis=1).view(np.int64))
        return pd.DataFrame({"codes": found, "sketch": sketches})

    marked = saved(unit.select(F.col(key).alias("id"), coded("unit").alias("c")).select("id", "c.codes", "c.sketch"), "codes")
    words = [F.col("sketch")[k].alias(f"s{k}") for k in range(SKETCH // 64)]
    dealt = marked.select("id", *words, F.explode("codes").alias("code"))
    left, right = (dealt.select("code", F.col("id").alias(f"{side}_id"), *[F.col(f"s{k}").alias(f"{side}{k}") for k in range(SKETCH // 64)]) for side in ("left", "right"))
    differ = "+".join(f"bit_count(left{k} ^ right{k})" for k in range(SKETCH // 64))
    met = left.join(right, "code").where(F.expr(f"left_id < right_id and {differ} <= {cut}")).select("left_id", "right_id").distinct()
    x, y = unit.select(F.col(key).alias("left_id"), F.col("unit").alias("x")), unit.select(F.col(key).alias("right_id"), F.col("unit").alias("y"))
    cosine = F.aggregate(F.zip_with("x", "y", lambda a, b: a * b), F.lit(0.0), lambda s, v: s + v)
    return met.join(x, "left_id").join(y, "right_id").select("left_id", "right_id", cosine.alias("cosine")).where(F.col("cosine") >= threshold)


def key_edges(df: DataFrame, key: str, value: Column) -> DataFrame:
    """Star edges (u, v) from each row to the smallest id of its value: links of equal values without pairs."""
    k = df.select(F.col(key).alias("u"), value.alias("__x")).where("__x is not null")
    return k.join(k.groupBy("__x").agg(F.min("u").alias("v")), "__x").where("u <> v").select("u", "v")


def visual_groups(images: DataFrame, vectors: DataFrame | None = None, threshold: float = THRESHOLD, recall: float | None = None) -> DataFrame:
    """image_id and visual_group_id: components of exact, declared and near copies.

    A group's id is the hash of its sorted members; an image alone is a group of one.
    Vectors of unknown images are ignored, images without one are linked by keys alone. Near
    copies are all pairs, or with ``recall`` those that ``banded_pairs`` finds.
    """
    edges = key_edges(images, "image_id", F.col("canonical_pixel_sha256"))
    declared = images.select("image_id", F.explode("source_group_ids").alias("g"))
    edges = edges.unionByName(key_edges(declared, "image_id", F.col("g")))
    if vectors is not None:
        known = vectors.join(images.select("image_id").distinct(), "image_id", "left_semi")
        near = similar_links(known, threshold) if recall is None else banded_pairs(known, threshold, recall).select(F.col("left_id").alias("u"), F.col("right_id").alias("v"))
        edges = edges.unionByName(near)
    return group_ids(images.select("image_id"), components(edges))


def group_ids(nodes: DataFrame, roots: DataFrame) -> DataFrame:
    """Group id of each node from its root: ``sha256`` of the JSON list of sorted members.

    Members pass in order through a running hash; a group is never one row.
    """
    named = nodes.join(roots, nodes["image_id"] == roots["node"], "left").select("image_id", F.coalesce("root", "image_id").alias("root"))
    members = named.where("root is not null and image_id is not null").select("root", F.col("image_id").cast("string").alias("member"))
    rows = members.select("root", "member", json_array(F.array("member")).alias("j")).repartition("root").sortWithinPartitions("root", "member")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = None
        root, digest = None, None
        for batch in batches:
            kind = batch.column("root").type
            done: list[tuple] = []
            for r, j in zip(batch.column("root").to_pylist(), batch.column("j").to_pylist(), strict=True):
                if digest is None or r != root:
                    if digest is not None:
                        done.append((root, digest))
                    root, digest = r, hashlib.sha256(b"[")
                    digest.update(j[1:-1].encode("utf-8"))
                else:
                    digest.update(b"," + j[1:-1].encode("utf-8"))
            yield _closed(done, kind)
        if digest is not None:
            yield _closed([(root, digest)], kind)

    groups = rows.mapInArrow(run, f"root {rows.schema['root'].dataType.simpleString()}, visual_group_id string")
    return named.join(groups, "root").select("image_id", "visual_group_id")


def _closed(groups: list[tuple], kind: pa.DataType) -> pa.RecordBatch:
    hashes = []
    for _, digest in groups:
        digest.update(b"]")
        hashes.append(digest.hexdigest())
    return pa.RecordBatch.from_arrays([pa.array([g[0] for g in groups], kind), pa.array(hashes, pa.string())], ["root", "visual_group_id"])
