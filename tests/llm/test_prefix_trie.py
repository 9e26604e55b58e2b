"""The trie against a plain one built turn by turn."""

import hashlib
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from corpusflow.llm import prefix_trie, queries

SCHEMA = "conv_id long, turn long, role string, text string"


def digest(role, text):
    role, text = role or "", text or ""
    return hashlib.sha256(f"{len(role.encode())}:{role}{text}".encode()).digest()


def plain(rows, rebuild=True):
    turns = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            turns[c].append((turn is not None, turn or 0, digest(role, text), role or "", text or ""))
    turns = {c: [(r, t) for *_, r, t in sorted(ts)] for c, ts in turns.items()}
    if rebuild:
        old, turns = turns, {}
        for c, own in old.items():
            h, base = zlib.crc32(str(c).encode()) % 9, (abs(c) - abs(c) % 5) * (1 if c >= 0 else -1)
            turns[c] = old.get(base, [])[:h] + own[h:]
    members, ends = defaultdict(set), defaultdict(list)
    for c, ts in turns.items():
        for d in range(len(ts) + 1):
            members[tuple(ts[:d])].add(c)
        ends[tuple(ts)].append(c)
    children = defaultdict(int)
    leaves, saved = defaultdict(int), defaultdict(int)
    for node in members:
        if node:
            children[node[:-1]] += 1
    for node, own in members.items():
        leaf = not children[node]
        saving = (len(own) - 1) * len(node[-1][1].encode()) if node else 0
        for d in range(len(node) + 1):
            leaves[node[:d]] += leaf
            saved[node[:d]] += saving
    hashed = lambda ids: hashlib.sha256(",".join(map(str, sorted(ids))).encode()).hexdigest()
    return sorted((min(m), len(n), min(members[n[:-1]]) if n else None, len(m), children[n], leaves[n], saved[n], hashed(ends[n])) for n, m in members.items())



def same(a, b):
    key = lambda r: (r[1], r[0])
    assert sorted(a, key=key) == sorted(b, key=key)


def test_whole_table(spark, small):
    rows = [tuple(r) for r in spark.read.parquet(f"{small}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    same([tuple(r) for r in queries.op11_prefix_trie(spark, small).collect()], plain(rows))


def rebuilt(rows, spark):
    turns = prefix_trie.turns_of(spark.createDataFrame(rows, SCHEMA + ", node string, depth string, digest string, idx string") if len(rows[0]) > 4 else spark.createDataFrame(rows, SCHEMA))
    kept = F.crc32(F.col("conv_id").cast("string").cast("binary")) % 9
    return prefix_trie.trie(*prefix_trie.branched(turns, F.col("conv_id") - F.col("conv_id") % 5, kept, 8))


def test_odd_rows(spark, monkeypatch):
    monkeypatch.setattr(prefix_trie, "CHUNK", 3)
    rows = []
    for c in [*range(24), -7, -3, 1000]:
        for t in range(c % 4 + 1):
            rows.append((c, t, "user" if t % 2 == 0 else None, f"text {t} é" if c % 3 else "same"))
    rows += [(None, 0, "user", "nobody's"), (30, None, None, None), (30, 0, "", ""), (30, 0, "user", "tie"), (30, 0, "user", "tie"), (31, 0, "user", "x" * 300_000)]
    rows += [(40 + k, t, "user", f"long {t}") for k in range(3) for t in range(14 + k)]
    same([tuple(r) for r in rebuilt([(*r, "a", "b", "c", "d") for r in rows], spark).collect()], plain(rows))


def test_without_rebuilding_and_many_equal_conversations(spark, monkeypatch):
    monkeypatch.setattr(prefix_trie, "CHUNK", 4)
    rows = [(c, t, "user", f"t{t}") for c in range(60) for t in range(3)] + [(c, 0, "user", "other") for c in range(100, 120)]
    turns = prefix_trie.turns_of(spark.createDataFrame(rows, SCHEMA))
    convs = turns.groupBy("conv_id").agg(F.max("n").alias("length"))
    out = prefix_trie.trie(turns.withColumn("depth", F.col("idx") + 1), convs)
    same([tuple(r) for r in out.collect()], plain(rows, rebuild=False))


@pytest.mark.parametrize("rows", [[(5, 0, "user", "only")], [(1, 0, "user", "gone")]])
def test_one_conversation(spark, rows):
    same([tuple(r) for r in rebuilt(rows, spark).collect()], plain(rows))


def test_empty(spark):
    turns = prefix_trie.turns_of(spark.createDataFrame([], SCHEMA))
    out = prefix_trie.trie(*prefix_trie.branched(turns, F.col("conv_id"), F.lit(0), 8))
    assert out.count() == 0 and out.columns == prefix_trie.COLUMNS


def test_sql_says_the_same(spark, small):
    import duckdb

    con = duckdb.connect()
    for name in ("conversations", "documents"):
        con.execute(f"create view {name} as select * from read_parquet('{small}/{name}.parquet')")
    want = con.sql(queries.ORACLE_SQL["op11_prefix_trie"])
    got = queries.QUERIES["op11_prefix_trie"](spark, small)
    assert sorted(got.columns) == sorted(want.columns)
    assert sorted((tuple(r) for r in got.select(*want.columns).collect()), key=repr) == sorted(want.fetchall(), key=repr)
