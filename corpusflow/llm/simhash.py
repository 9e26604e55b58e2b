"""SimHash near-duplicates: 64-bit fingerprints, pigeonhole blocks, Hamming verification.

A pair that differs in at most ``max_bits`` of 64 bits leaves at least ``blocks - max_bits``
of ``blocks`` blocks untouched. With seven blocks and four bits, three blocks are equal, so
the pair shares one of the 35 keys made of three blocks (27 bits or so each). Longer keys
than the plain five blocks of 13 bits give keep the number of chance candidates small; a
larger corpus is cut into more blocks (``blocks_for``), which changes the plan, not the links.

``near_duplicates`` links fingerprints of 4-word shingles. ``keep_one`` also links documents by
fingerprints of their words alone, which change less when single words are edited, if the
shingles' fingerprints bear the pair out. Word keys that many share are searched in two
passes: each node against a few hubs, then, exactly, what is still in different components.
"""

from __future__ import annotations

from collections import Counter
from itertools import combinations
from math import log2

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusflow.llm.common import free_name, joined_by_hot_key, saved
from corpusflow.operators.components import components

SHINGLE = 4
MAX_BITS = 4
#: Blocks of a fingerprint, at least.
BLOCKS = 7
#: A word counts up to so many times in the fingerprint of words.
WORD_TIMES = 2
#: Documents linked by their words must differ in at most so many bits of their shingles' fingerprints.
#: Texts that share 0.8 of their 5-word shingles differ in 9 bits on average, unrelated ones in 32.
SHINGLE_BITS = 11
#: Keys that more fingerprints than this share are linked through midpoints, not pairs.
DENSE = 2048
#: In the search by words, keys that more than this share are linked through this many hubs first, then exactly.
WORD_DENSE, HUBS = 16, 8
#: Blocks of a shingles' fingerprint: at most ``SHINGLE_BITS`` differing bits leave three of them untouched.
FINE_BLOCKS = SHINGLE_BITS + 3
#: Nodes outside of a key's largest component that are compared with all its nodes; more are dealt by fine blocks.
STRAY = 364
#: Up to so many links between components are joined on the driver, in the same way; more are joined in rounds on Spark.
FEW_LINKS = 8192
_CHUNK = 1 << 16


def fingerprint_int(text: str | None, width: int = SHINGLE) -> int:
    """The fingerprint of one text as an unsigned integer; null and wordless texts give zero."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    n = max(1, len(words) - width + 1)
    ends = np.cumsum(np.fromiter(map(len, words), dtype=np.int64, count=len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    digest = xxhash.xxh64_intdigest
    if len(words) < width:
        hashes = np.array([digest(joined, 42)], dtype=np.uint64)
    else:
        hashes = np.fromiter((digest(joined[a:b], 42) for a, b in zip(starts[:n].tolist(), ends[width - 1 :].tolist(), strict=True)), dtype=np.uint64, count=n)
    return _majority(hashes)


def _majority(hashes: np.ndarray) -> int:
    """The bits that over half of the hashes have."""
    ones = np.zeros(64, dtype=np.int64)
    for k in range(0, len(hashes), _CHUNK):
        part = hashes[k : k + _CHUNK].astype(">u8").view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > len(hashes)).tobytes(), "big")


def word_print(text: str | None, times: int = WORD_TIMES) -> int:
    """The fingerprint of a text's words without their order, each up to ``times`` times; null and wordless texts give zero."""
    counts = Counter((text or "").encode("utf-8", "surrogatepass").lower().split())
    if not counts:
        return 0
    digest = xxhash.xxh64_intdigest
    return _majority(np.array([digest(w, 42 + k) for w, n in counts.items() for k in range(min(n, times))], dtype=np.uint64))


@F.pandas_udf(T.LongType())
def _fingerprint(texts: pd.Series) -> pd.Series:
    out = np.fromiter((fingerprint_int(t) for t in texts), dtype=np.uint64, count=len(texts))
    return pd.Series(out.view(np.int64))


@F.pandas_udf(T.StructType([T.StructField("fp", T.LongType()), T.StructField("words", T.LongType())]))
def _both_prints(texts: pd.Series) -> pd.DataFrame:
    pair = np.array([(fingerprint_int(t), word_print(t)) for t in texts], dtype=np.uint64).reshape(-1, 2)
    return pd.DataFrame({"fp": pair[:, 0].view(np.int64), "words": pair[:, 1].view(np.int64)})


def fingerprints(docs: DataFrame, text: str = "text") -> Column:
    """Column expression: the signed 64-bit fingerprint of a text column."""
    return _fingerprint(docs[text])


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def _block_masks(blocks: int) -> list[int]:
    edges = [64 * i // blocks for i in range(blocks + 1)]
    return [((1 << (b - a)) - 1) << a for a, b in zip(edges[:-1], edges[1:], strict=True)]


def blocks_for(prints: int, max_bits: int = MAX_BITS) -> int:
    """Blocks whose keys have three bits more than it takes to number the fingerprints, so that chance meetings stay few."""
    blocks = max(BLOCKS, max_bits + 1)
    while 64 * (blocks - max_bits) / blocks < log2(prints + 1) + 3 and blocks < max_bits + 6:
        blocks += 1
    return blocks


def _dealt(prints: DataFrame, keys: list[int]) -> DataFrame:
    """A row (fp, p, i, k) for each key: its number, and the bits of ``p`` that it keeps."""
    dealt = F.explode(F.array(*[F.struct(F.lit(i).alias("i"), F.col("p").bitwiseAND(F.lit(_signed(k))).alias("k")) for i, k in enumerate(keys)]))
    return prints.select("fp", "p", dealt.alias("d")).select("fp", "p", F.col("d.i").alias("i"), F.col("d.k").alias("k"))


def _keys(blocks: int, max_bits: int) -> list[int]:
    masks = _block_masks(blocks)
    return [sum(masks[b] for b in c) for c in combinations(range(blocks), blocks - max_bits)]


def full_keys(prints: DataFrame, dense: int, max_bits: int = MAX_BITS, blocks: int | None = None, key: str = "fp") -> DataFrame:
    """The keys (i, k) that more than ``dense`` of ``prints`` share, and their number ``n``: counted by partial aggregation, never gathered."""
    if blocks is None:
        blocks = blocks_for(prints.count(), max_bits)
    by = _dealt(prints.select("fp", F.col(key).alias("p")), _keys(blocks, max_bits))
    return saved(by.groupBy("i", "k").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > dense), "full")


def links(
    prints: DataFrame, max_bits: int = MAX_BITS, blocks: int | None = None, dense: int = DENSE, key: str = "fp", node_bits: int | None = None, full: DataFrame | None = None
) -> DataFrame:
    """Links ``u``, ``v`` between the nodes ``fp`` of ``prints`` whose ``key`` columns differ in at most ``max_bits`` bits.

    By default a node is its own key, and ``fp`` has no repeats: any two fingerprints at most
    ``max_bits`` apart end up linked, directly or through fingerprints that are themselves at
    most ``max_bits`` from the next. With another ``key`` the rows (fp, key) have no repeats,
    and only nodes that also differ in at most ``node_bits`` bits are linked.

    Fingerprints are dealt out by block key and meet under their key. Pairs are verified inside
    the join and kept only under the first key they share, so a pair is made once. A key that
    more than ``dense`` fingerprints share (counted by partial aggregation, and never gathered)
    does not make pairs: each fingerprint there is sent to all values at most
    ``max_bits // 2`` flips of the key's free bits away. Two values up to ``max_bits`` apart
    meet in such a midpoint and no others do, so the links are the same, and the rows grow
    with the number of fingerprints, not of pairs.

    With ``node_bits`` keys shared by over ``dense`` are left out here and are the business of ``hub_links`` and ``stray_links``.
    A caller that has ``full_keys`` of the same prints, blocks and ``dense`` gives them as ``full``.
    """
    if blocks is None:
        blocks = blocks_for(prints.count(), max_bits)
    full = full_keys(prints, dense, max_bits, blocks, key) if full is None else full
    masks, take = _block_masks(blocks), blocks - max_bits
    combos, keys = list(combinations(range(blocks), take)), _keys(blocks, max_bits)
    by = _dealt(prints.select("fp", F.col(key).alias("p")), keys)

    # without such keys the driver neither plans nor broadcasts for them
    plain = full.isEmpty()
    few = by if plain else by.join(full.select("i", "k"), ["i", "k"], "left_anti")
    left, right = few.select("i", "k", F.col("fp").alias("u"), F.col("p").alias("x")), few.select(F.col("i").alias("i2"), F.col("k").alias("k2"), F.col("fp").alias("v"), F.col("p").alias("y"))
    equal = "+".join(f"case when (x ^ y) & {_signed(m)}L = 0 and {b} <= element_at(array({','.join(str(c[-1]) for c in combos)}), i + 1) then 1 else 0 end" for b, m in enumerate(masks))
    near_nodes = F.lit(True) if node_bits is None else F.expr(f"bit_count(u ^ v) <= {node_bits}")
    on = (F.col("i") == F.col("i2")) & (F.col("k") == F.col("k2")) & (F.col("u") < F.col("v")) & F.expr(f"bit_count(x ^ y) <= {max_bits}") & near_nodes & F.expr(f"{equal} = {take}")
    pairs = left.join(right.hint("merge"), on).select("u", "v")

    if plain or node_bits is not None:
        return pairs
    many = by.join(full.select("i", "k"), ["i", "k"])

    flips = []
    for k in keys:
        free = [b for b in range(64) if not k >> b & 1]
        flips.append([_signed(sum(1 << b for b in c)) for r in range(max_bits // 2 + 1) for c in combinations(free, r)])
    # the flips are a table of one row for each key, joined by the key's number
    ball = prints.sparkSession.createDataFrame(list(enumerate(flips)), "i int, flips array<long>")
    near = many.join(F.broadcast(ball), "i").select("fp", "i", "p", F.explode("flips").alias("flip"))
    near = near.selectExpr("fp", "i", "p ^ flip as mid")
    met = near.groupBy("i", "mid").agg(F.min("fp").alias("v"), F.max("fp").alias("w")).where("v < w").select("i", "mid", "v")
    through = near.join(met, ["i", "mid"]).where("fp <> v").select(F.col("fp").alias("u"), "v").distinct()
    return pairs.unionByName(through)


def crowded(pairs: DataFrame, dense: int, max_bits: int = MAX_BITS, blocks: int | None = None, full: DataFrame | None = None) -> DataFrame:
    """Rows (fp, p, key) of the word keys that more than ``dense`` of ``pairs`` (fp, words) share (``full``), and their number ``n``."""
    if blocks is None:
        blocks = blocks_for(pairs.count(), max_bits)
    full = full_keys(pairs, dense, max_bits, blocks, "words") if full is None else full
    by = _dealt(pairs.select("fp", F.col("words").alias("p")), _keys(blocks, max_bits))
    keyed = by.select("fp", "p", F.struct("i", "k").alias("key"))
    named = full.select(F.struct("i", "k").alias("key"), "n", F.col("n").alias("rows"))
    return saved(joined_by_hot_key(keyed, named, "key", "rows"), "crowded")


def _masked(rows: DataFrame, others: DataFrame, most: int, max_bits: int, node_bits: int) -> DataFrame:
    """``rows`` (key, fp, p) with the ``others`` (at most ``most``: fp, p; ``n`` rows) of their key and bits m0, m1, ... (64 in each) that say which of these are near."""
    met = joined_by_hot_key(rows, others, "key", "n")
    near = lambda o: (o["fp"] != F.col("fp")) & (F.bit_count(o["p"].bitwiseXOR(F.col("p"))) <= max_bits) & (F.bit_count(o["fp"].bitwiseXOR(F.col("fp"))) <= node_bits)
    none = F.struct(F.lit(0).cast("long").alias("m"), F.lit(1).cast("long").alias("bit"))
    seen = lambda a, o: F.struct(F.when(near(o), a["m"].bitwiseOR(a["bit"])).otherwise(a["m"]).alias("m"), F.shiftleft(a["bit"], 1).alias("bit"))
    bits = [F.aggregate(F.slice("others", k + 1, 64), none, seen, lambda a: a["m"]).alias(f"m{k // 64}") for k in range(0, most, 64)]
    return met.select(*rows.columns, "others", *bits)


def _unmasked(masked: DataFrame, others: DataFrame, by: str) -> DataFrame:
    """Links of the nodes ``by`` with all others that any row of their key and ``by`` is near to: bits meet in a hash aggregation, so rows don't become pairs."""
    bits = [c for c in masked.columns if c[0] == "m"]
    met = masked.groupBy("key", by).agg(*[F.bit_or(m).alias(m) for m in bits]).where(" or ".join(f"{m} <> 0" for m in bits)).join(others, "key")
    near = F.filter("others", lambda o, i: F.getbit(F.get(F.array(*bits), F.shiftright(i, 6)), i % 64) == 1)
    return met.select(F.col(by).alias("u"), F.explode(near).alias("o")).select("u", F.col("o.fp").alias("v"))


def hub_links(many: DataFrame, max_bits: int = MAX_BITS, node_bits: int = SHINGLE_BITS) -> DataFrame:
    """Links of the nodes of crowded keys with ``HUBS`` nodes of their key, picked by hashes: a cheap pass that joins most of what belongs together.

    A node is linked with the first hub that it is near to, and that hub with the node's
    others, which is said once for a key: the components are those of all such links, and a
    row of ``many`` gives one link at most.
    """
    hub = F.struct(F.xxhash64("fp", F.lit(0)).alias("h"), "fp", "p")
    picked = [F.min(hub.withField("h", F.xxhash64("fp", F.lit(seed)))) for seed in range(HUBS)]
    hubs = many.groupBy("key").agg(F.max("n").alias("n"), F.array(*picked).alias("hubs"))
    hubs = saved(hubs.select("key", "n", F.array_distinct(F.transform("hubs", lambda x: F.struct(x["fp"].alias("fp"), x["p"].alias("p")))).alias("others")), "hubs")
    met = _masked(many.select("key", "fp", "p"), hubs, HUBS, max_bits, node_bits).where("m0 <> 0")
    met = saved(met.select("key", "fp", F.expr("others[bit_count((m0 & -m0) - 1)].fp").alias("hub"), "m0"), "met")
    between = _unmasked(met.where("m0 & (m0 - 1) <> 0").select("key", "hub", "m0"), hubs, "hub").where("u <> v")
    return met.select(F.col("fp").alias("u"), F.col("hub").alias("v")).unionByName(between).distinct()


def forest(fps: np.ndarray, ps: np.ndarray, max_bits: int, node_bits: int) -> np.ndarray:
    """A spanning forest of the near ones of a few nodes: for each its parent's place, or -1."""
    fps, ps = fps.view(np.uint64), ps.view(np.uint64)
    parent, new = np.full(len(fps), -1, dtype=np.int32), np.ones(len(fps), dtype=bool)
    for start in range(len(fps)):
        todo = [start] if new[start] else []
        new[start] = False
        while todo:
            x = todo.pop()
            near = np.flatnonzero(new & (np.bitwise_count(ps ^ ps[x]) <= max_bits) & (np.bitwise_count(fps ^ fps[x]) <= node_bits))
            new[near], parent[near] = False, x
            todo += near.tolist()
    return parent


def _forest_links(outside: DataFrame, max_bits: int, node_bits: int) -> DataFrame:
    """Links between ``others`` (fp, p, root) of different roots in each row: those of a forest, so fewer than there are others."""

    @F.pandas_udf(T.ArrayType(T.IntegerType()))
    def parents(fps: pd.Series, ps: pd.Series) -> pd.Series:
        return pd.Series([forest(np.array(a, dtype=np.int64), np.array(b, dtype=np.int64), max_bits, node_bits) for a, b in zip(fps, ps, strict=True)], dtype=object)

    found = outside.select("others", parents(F.col("others")["fp"], F.col("others")["p"]).alias("parents"))
    joined = F.transform("others", lambda o, i: F.struct(o["fp"].alias("u"), o["root"].alias("root"), F.get("others", F.get("parents", i)).alias("parent")))
    between = F.filter(joined, lambda x: x["root"] != x["parent"]["root"])
    return found.select(F.explode(between).alias("e")).select("e.u", F.col("e.parent.fp").alias("v"))


def stray_links(many: DataFrame, roots: DataFrame, max_bits: int = MAX_BITS, node_bits: int = SHINGLE_BITS, stray: int = STRAY) -> DataFrame:
    """Links in crowded keys between nodes of different components (``roots``: node, root): with those known, all that is missing.

    A key whose nodes are in one component already needs no look. Elsewhere each link
    between components has an end outside of the key's largest one. Where at most ``stray``
    nodes are outside, these are compared with all nodes of the key; of what is found, a link for
    each that is near to the largest component and a forest of those outside remain. Where there are more, nodes
    are dealt by three of ``FINE_BLOCKS`` blocks of their own fingerprint, of which a pair at
    most ``SHINGLE_BITS`` apart has three in common, and in each such part the nodes outside are
    compared with the others. Both lead to the same components, so ``stray`` changes the work, not the result.
    """
    placed = saved(joined_by_hot_key(many.withColumnRenamed("n", "size"), _root_of(many, roots), "fp", "times").withColumnRenamed("size", "n"), "placed")
    sizes = placed.groupBy("key", "root").agg(F.count(F.lit(1)).alias("m"), F.max("n").alias("n"))
    keys = sizes.groupBy("key").agg(F.max("n").alias("n"), F.max(F.struct("m", "root")).alias("top")).where("top.m < n")
    keys = saved(keys.select("key", "n", F.col("top.root").alias("top"), (F.col("n") - F.col("top.m")).alias("outside")), "keys")
    most = keys.agg(F.max("outside")).first()[0]
    if most is None:
        return many.select(F.col("fp").alias("u"), F.col("fp").alias("v")).limit(0)
    rows = saved(joined_by_hot_key(placed.drop("n"), keys.withColumn("rows", F.col("n")), "key", "rows"), "rows")

    small = rows.where(F.col("outside") <= stray)
    outside = saved(small.where("root <> top").groupBy("key").agg(F.max("n").alias("n"), F.collect_list(F.struct("fp", "p", "root")).alias("others")), "outside")
    met = _masked(small.where("root = top").select("key", "fp", "p", "root"), outside, max(1, min(most, stray)), max_bits, node_bits)
    direct = _unmasked(met.drop("others", "fp", "p"), outside, "root").unionByName(_forest_links(outside, max_bits, node_bits)).distinct()
    if most <= stray:
        return direct

    masks = _block_masks(node_bits + 3)
    fine = F.array(*[F.lit(_signed(sum(masks[b] for b in c))) for c in combinations(range(node_bits + 3), 3)])
    dealt = rows.where(F.col("outside") > stray).select("key", "fp", "p", "root", (F.col("root") != F.col("top")).alias("out"), F.posexplode(fine).alias("j", "mask"))
    dealt = dealt.select("key", "fp", "p", "root", "out", "j", F.col("fp").bitwiseAND(F.col("mask")).alias("part"))
    left = dealt.where("out").select("key", "j", "part", F.col("fp").alias("u"), F.col("p").alias("x"), F.col("root").alias("a"))
    right = dealt.select("key", "j", "part", F.col("fp").alias("v"), F.col("p").alias("y"), F.col("root").alias("b"))
    met = left.hint("merge").join(right, ["key", "j", "part"]).where(F.expr(f"a <> b and bit_count(x ^ y) <= {max_bits} and bit_count(u ^ v) <= {node_bits}"))
    return direct.unionByName(met.select("u", "v").distinct())


def _between(more: DataFrame, roots: DataFrame) -> DataFrame:
    """Links between nodes as links between their components."""
    for end in ("u", "v"):
        more = more.join(roots.select(F.col("node").alias(end), F.col("root").alias("__r")), end, "left").withColumn(end, F.coalesce("__r", end)).drop("__r")
    return more


def _root_of(many: DataFrame, roots: DataFrame) -> DataFrame:
    """Each node of ``many`` with its component and the number of its rows."""
    times = many.groupBy("fp").agg(F.count(F.lit(1)).alias("times"))
    return times.join(roots, F.col("fp") == F.col("node"), "left").select("fp", "times", F.coalesce("root", "fp").alias("root"))


def _nodes(own: DataFrame) -> DataFrame:
    return saved(own.groupBy("fp").agg(F.min("doc_id").alias("least"), F.count(F.lit(1)).alias("n")), "nodes")


def _with_component(own: DataFrame, nodes: DataFrame, roots: DataFrame) -> DataFrame:
    """``own`` (with doc_id and fp) and ``component_id``: the smallest doc_id of the component of ``fp``.

    A fingerprint, or a component, that holds a large share of all rows is spread over tasks
    in both joins.
    """
    named = saved(nodes.join(roots, nodes["fp"] == roots["node"], "left").select("fp", "least", "n", F.coalesce("root", "fp").alias("root")), "named")
    whole = named.groupBy("root").agg(F.min("least").alias("component_id"), F.count(F.lit(1)).alias("m"))
    found = joined_by_hot_key(named.select("root", "fp", "n"), whole, "root", "m")
    return joined_by_hot_key(own, found.select("fp", "component_id", "n"), "fp", "n")


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", max_bits: int = MAX_BITS, dense: int = DENSE) -> DataFrame:
    """One row per document: ``doc_id``, ``fingerprint`` (16 hex digits), ``component_id``.

    ``component_id`` is the smallest doc_id that can be reached over links of at most
    ``max_bits`` bits. Documents of equal fingerprints are one node from the start, so any
    number of copies costs one row in the search for links. Null and empty texts have
    fingerprint zero and link like others; repeated rows give repeated rows; a null doc_id
    gets the component of its fingerprint and is never its smallest member. Other columns
    of ``docs`` are ignored. An empty table gives an empty result. Texts of any length are
    read whole.
    """
    own = saved(docs.select(F.col(doc_id).cast("long").alias("doc_id"), _fingerprint(docs[text]).alias("fp")), "prints")
    nodes = _nodes(own)
    found = _with_component(own, nodes, components(links(nodes.select("fp"), max_bits, dense=dense)))
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def _through_crowded(edges: DataFrame, many: DataFrame, max_bits: int) -> DataFrame:
    """Components (node, root) of ``edges`` and of the links in the crowded keys ``many``."""
    roots = saved(components(edges.unionByName(hub_links(many, max_bits))), "roots")
    more = saved(stray_links(many, roots, max_bits), "more")
    if more.isEmpty():
        return roots
    # what was found joins whole components, so only their roots are looked at again
    joined = components(_between(more, roots), small=FEW_LINKS)
    over = joined.select(F.col("node").alias("root"), F.col("root").alias("over"))
    return roots.join(over, "root", "left").select("node", F.coalesce("over", "root").alias("root")).unionByName(joined.join(roots, "node", "left_anti"))


def keep_one(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", max_bits: int = MAX_BITS, dense: int = DENSE, word_dense: int = WORD_DENSE) -> DataFrame:
    """The rows of ``docs`` without near-duplicates: of each component the document of smallest id.

    Documents are linked as in ``near_duplicates``, and also if the fingerprints of their
    words differ in at most ``max_bits`` bits and those of their shingles in at most
    ``SHINGLE_BITS``. A document is an id with a text: where one id has several texts, each
    is kept or dropped by its own component, so that no component is lost, and rows of one
    id and text stay or go together. A null id is the largest: such rows go if their
    component holds a document with an id, and else stay. Null and empty texts are
    near-duplicates of each other. An empty table gives an empty result. Columns and texts
    stay as they are, whatever the columns are called, and texts of any length are read whole.
    """
    prints = F.struct(F.col(doc_id).cast("long").alias("doc_id"), F.xxhash64(text).alias("own"), _both_prints(docs[text]).alias("p"))
    own = saved(docs.select(prints.alias("r")).select("r.doc_id", "r.own", "r.p.fp", "r.p.words"), "prints")
    nodes, pairs = _nodes(own), saved(own.select("fp", "words").distinct(), "pairs")
    by_shingles = links(nodes.select("fp"), max_bits, dense=dense)
    # word keys are counted once, for the plain pairs and for the crowded keys
    blocks = blocks_for(pairs.count(), max_bits)
    full = full_keys(pairs, word_dense, max_bits, blocks, "words")
    edges = by_shingles.unionByName(links(pairs, max_bits, blocks, word_dense, "words", SHINGLE_BITS, full))
    if full.isEmpty():
        roots = saved(components(edges), "roots")
    else:
        roots = _through_crowded(edges, crowded(pairs, word_dense, max_bits, blocks, full), max_bits)
    found = _with_component(own.select("doc_id", "own", "fp"), nodes, roots)
    gone_id, gone_text = free_name(docs, "gone_id"), free_name(docs, "gone_text")
    gone = saved(found.where("component_id is not null and (doc_id is null or doc_id <> component_id)").select(F.col("doc_id").alias(gone_id), F.col("own").alias(gone_text)).distinct(), "gone")
    same = docs[doc_id].cast("long").eqNullSafe(gone[gone_id]) & (F.xxhash64(docs[text]) == gone[gone_text])
    return docs.join(gone, same, "left_anti")
