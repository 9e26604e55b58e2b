"""The manifest against a plain reduction, and its proofs against changed rows."""

import hashlib
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from corpusflow.llm import merkle, queries


def H(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(doc_id, source, lang, n_chars, text):
    said = ("-" if v is None else f"{len(str(v).encode())}:{v}" for v in (doc_id, source, lang, n_chars, text))
    return H("".join(said))


def tree(nodes):
    """Root, and the siblings and place of each leaf, level by level."""
    paths, at = [[] for _ in nodes], list(range(len(nodes)))
    while len(nodes) > 1:
        runs = [nodes[i : i + 3] for i in range(0, len(nodes), 3)]
        for k, p in enumerate(at):
            paths[k].append((runs[p // 3][: p % 3], runs[p // 3][p % 3 + 1 :]))
            at[k] = p // 3
        nodes = [H(*run) for run in runs]
    return nodes[0], paths


def fold(node, path):
    for left, right in path:
        node = H(*left, node, *right)
    return node


def plain(rows):
    """Rows are (doc_id, source, lang, n_chars, text); sorted tuples of the query's columns."""
    by = defaultdict(list)
    for r in rows:
        by[r[1]].append((r[0] is not None, r[0] or 0, leaf(*r), r))
    names = sorted(by, key=lambda s: (s is not None, (s or "").encode()))
    tops, paths = [], {}
    for s in names:
        by[s].sort(key=lambda x: x[:3])
        top, paths[s] = tree([x[2] for x in by[s]])
        tops.append(top)
    root, upper = tree(tops)
    out = []
    for s, top, higher in zip(names, tops, upper, strict=True):
        for (_, _, own, r), path in zip(by[s], paths[s], strict=True):
            path = path + higher
            hit = r[0] is not None and zlib.crc32(str(r[0]).encode()) % 2 == 0
            now = leaf(*r[:4], r[4].replace("\n", "") if hit and r[4] is not None else r[4])
            folded = fold(now, path)
            out.append((r[0], own, top, root, H(*("".join(a + b) for a, b in path)), folded, folded == root))
    return sorted(out, key=repr)


COLUMNS = ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]


def test_whole_table(spark, small):
    rows = [tuple(r) for r in spark.read.parquet(f"{small}/documents.parquet").select(*merkle.FIELDS).collect()]
    got = queries.op12_merkle(spark, small)
    assert got.columns == COLUMNS
    assert sorted((tuple(r) for r in got.collect()), key=repr) == plain(rows)


@pytest.mark.parametrize("levels", [1, 2, 6])
def test_odd_rows_and_any_number_of_levels_at_once(spark, odd, levels):
    more = spark.createDataFrame([(k, f"a\nb {k}", "en", "big" if k % 4 else "ä" * (k % 7), k) for k in range(100, 350)], "doc_id long, text string, lang string, source string, n_chars long")
    docs = odd.unionByName(more, allowMissingColumns=True)
    rows = [tuple(r) for r in docs.select(*merkle.FIELDS).collect()]
    out = merkle.fold_both(merkle.manifest(docs, levels=levels), "leaf")
    want = plain(rows)
    assert sorted((tuple(r) for r in out.select("doc_id", "leaf", "subroot", "root", F.sha2(F.col("proof").cast("binary"), 256)).collect()), key=repr) == sorted((w[:5] for w in want), key=repr)
    assert all(r["folded_root"] == r["root"] for r in out.collect())


@pytest.mark.parametrize("n", [1, 2, 3, 4, 27, 28])
def test_sizes_around_powers(spark, n):
    docs = spark.createDataFrame([(k, "t\n", "en", "s", 1) for k in range(n)], "doc_id long, text string, lang string, source string, n_chars long")
    out = merkle.fold_both(merkle.manifest(docs, levels=2), "leaf").collect()
    root, paths = tree([leaf(k, "s", "en", 1, "t\n") for k in range(n)])
    assert {r["root"] for r in out} == {root} and all(r["folded_root"] == root for r in out)
    assert {r["doc_id"]: r["proof"] for r in out} == {k: "".join("".join(a + b) for a, b in p) for k, p in enumerate(paths)}


def test_a_changed_leaf_does_not_verify(spark, odd):
    rows = merkle.fold_both(merkle.manifest(odd, also={"other": F.sha2(F.lit(b"x"), 256)}), "other")
    assert rows.where("folded_root = root").count() == 0


def test_empty(spark, none):
    assert merkle.fold_both(merkle.manifest(none), "leaf").count() == 0


def test_sql_says_the_same(spark, small):
    import duckdb

    con = duckdb.connect()
    for name in ("conversations", "documents"):
        con.execute(f"create view {name} as select * from read_parquet('{small}/{name}.parquet')")
    want = con.sql(queries.ORACLE_SQL["op12_merkle"])
    got = queries.QUERIES["op12_merkle"](spark, small)
    assert sorted(got.columns) == sorted(want.columns)
    assert sorted((tuple(r) for r in got.select(*want.columns).collect()), key=repr) == sorted(want.fetchall(), key=repr)
