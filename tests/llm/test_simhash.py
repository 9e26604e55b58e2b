import random
from itertools import combinations

import pytest
import xxhash

from corpusflow.llm import simhash


def brute_fingerprint(text):
    data = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words, here = [], ""
    for c in data + " ":
        if c in " \t\n\x0b\x0c\r":
            if here:
                words.append(here)
            here = ""
        else:
            here += c
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 4]) for i in range(len(words) - 3)] or [" ".join(words)]
    h = [xxhash.xxh64_intdigest(s.encode("utf-8"), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute_components(rows):
    """Union over all pairs: rows are (doc_id, fingerprint)."""
    parent = list(range(len(rows)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, j in combinations(range(len(rows)), 2):
        if bin(rows[i][1] ^ rows[j][1]).count("1") <= 4:
            parent[find(i)] = find(j)
    least = {}
    for i, (d, _) in enumerate(rows):
        least[find(i)] = min(least.get(find(i), d), d)
    return [least[find(i)] for i in range(len(rows))]


def test_fingerprint_is_exact():
    texts = [None, "", "  \t", "One", "one two three", "A b C d", "a b c d e f " * 30, "É é x y z w", "x\x0by z\x0cw v", "🙂 " * 9]
    assert [simhash.fingerprint_int(t) for t in texts] == [brute_fingerprint(t) for t in texts]


def test_spark_hash_is_the_same(spark):
    from pyspark.sql import functions as F

    got = spark.range(1).select(F.xxhash64(F.lit("a b c d"))).first()[0]
    assert got % (1 << 64) == xxhash.xxh64_intdigest(b"a b c d", 42)


def links_of(spark, prints, dense):
    signed = [(p - (1 << 64) if p >> 63 else p,) for p in prints]
    got = simhash.links(spark.createDataFrame(signed, "fp long"), dense=dense).collect()
    return {tuple(sorted((r["u"] % (1 << 64), r["v"] % (1 << 64)))) for r in got}


def test_links_are_exactly_the_close_pairs(spark):
    rng = random.Random(2)
    prints = set()
    for _ in range(40):
        base = rng.getrandbits(64)
        prints.add(base)
        for bits in (1, 2, 3, 4, 5, 6):
            x = base
            for b in rng.sample(range(64), bits):
                x ^= 1 << b
            prints.add(x)
    close = {tuple(sorted(p)) for p in combinations(prints, 2) if bin(p[0] ^ p[1]).count("1") <= 4}
    assert links_of(spark, prints, 10_000) == close


def test_dense_keys_give_the_same_components(spark):
    rng = random.Random(3)
    base, prints = rng.getrandbits(64), set()
    for _ in range(60):
        x = base
        for b in rng.sample(range(64), rng.randint(0, 5)):
            x ^= 1 << b
        prints.add(x)
    prints |= {rng.getrandbits(64) for _ in range(20)}
    order = sorted(prints)
    truth = brute_components(list(enumerate(order)))
    through = links_of(spark, prints, 3)
    assert all(bin(a ^ b).count("1") <= 4 * 2 for a, b in through)
    parent = {p: p for p in order}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in through:
        parent[find(a)] = find(b)
    groups = lambda key: sorted(sorted(i for i in range(len(order)) if key(i) == k) for k in {key(i) for i in range(len(order))})
    assert groups(lambda i: find(order[i])) == groups(lambda i: truth[i])


def test_whole_tables_match_brute_force(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    rows = [(r["doc_id"], brute_fingerprint(r["text"])) for r in docs.select("doc_id", "text").collect()]
    truth = {d: (f"{fp:016x}", c) for (d, fp), c in zip(rows, brute_components(rows), strict=True)}
    got = {r["doc_id"]: (r["fingerprint"], r["component_id"]) for r in simhash.near_duplicates(docs).collect()}
    assert got == truth


def test_odd_rows(spark, odd, none):
    out = [tuple(r) for r in simhash.near_duplicates(odd).collect()]
    assert len(out) == odd.count()
    assert {c for d, f, c in out if d in (2, 3, 4)} == {2} and {f for d, f, _ in out if d in (2, 3, 4)} == {"0" * 16}
    assert [c for d, _, c in out if d is None] == [1] and [c for d, _, c in out if d == 1] == [1, 1]
    assert simhash.near_duplicates(none).count() == 0
    kept = simhash.keep_one(odd)
    assert kept.columns == odd.columns
    assert sorted(str(r["doc_id"]) for r in kept.collect()) == ["1", "1", "2", "5", "6"]


def test_one_id_with_several_texts_loses_none(spark):
    x, y = "the quick brown fox jumps over the lazy dog", "an entirely other text about harbours and lighthouses at night"
    rows = spark.createDataFrame([(1, x), (5, x), (5, y), (9, y), (None, y), (None, "a third one that nobody copies")], "doc_id long, text string")
    kept = sorted((str(r["doc_id"]), r["text"]) for r in simhash.keep_one(rows).collect())
    assert kept == [("1", x), ("5", y), ("None", "a third one that nobody copies")]


def brute_word_print(text):
    words = (text or "").encode("utf-8").lower().split()
    feats = [xxhash.xxh64_intdigest(w, 42 + k) for w in sorted(set(words)) for k in range(min(2, words.count(w)))]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in feats) > len(feats))


def edited(rng, words, share):
    return [rng.choice(["alpha", "beta", "gamma", "delta"]) + str(rng.randrange(1000)) if rng.random() < share else w for w in words]


def test_kept_documents_match_brute_force_and_recall_is_stated(spark):
    rng = random.Random(11)
    rows, family = [], {}
    for f in range(60):
        base = [f"w{rng.randrange(600)}" for _ in range(rng.randrange(80, 400))]
        for k in range(rng.randrange(1, 4)):
            family[len(rows)] = f
            rows.append((len(rows), " ".join(base if k == 0 else edited(rng, base, 0.012))))
    both = [(brute_fingerprint(t), brute_word_print(t)) for _, t in rows]
    assert [simhash.word_print(t) for _, t in rows] == [b for _, b in both]
    parent = list(range(len(rows)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    far = lambda a, b: bin(a ^ b).count("1")
    near = alike = caught = 0
    sets = [{tuple(t.split()[i : i + 5]) for i in range(len(t.split()) - 4)} for _, t in rows]
    for i, j in combinations(range(len(rows)), 2):
        linked = far(both[i][0], both[j][0]) <= 4 or (far(both[i][1], both[j][1]) <= 4 and far(both[i][0], both[j][0]) <= simhash.SHINGLE_BITS)
        if linked:
            near += 1
            assert family[i] == family[j]
            a, b = sorted((find(i), find(j)))
            parent[b] = a
        if len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j]):
            alike += 1
            caught += linked
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    want = sorted({find(i) for i in range(len(rows))})
    for dense in (simhash.WORD_DENSE, 1, 10**9):
        kept = sorted(r["doc_id"] for r in simhash.keep_one(docs, word_dense=dense).collect())
        assert kept == want
        assert {family[d] for d in kept} == set(family.values())
    assert near and alike > 20 and caught >= 0.85 * alike


def test_a_large_group_of_near_copies_is_one_group(spark):
    rng = random.Random(7)
    base = [f"w{rng.randrange(900)}" for _ in range(400)]
    rows = [(k, " ".join(edited(rng, base, 0.006))) for k in range(150)] + [(1000 + k, " ".join(f"x{rng.randrange(900)}" for _ in range(200))) for k in range(20)]
    kept = sorted(r["doc_id"] for r in simhash.keep_one(spark.createDataFrame(rows, "doc_id long, text string")).collect())
    assert [d for d in kept if d >= 1000] == [1000 + k for k in range(20)]
    assert len(kept) - 20 <= 3


@pytest.mark.parametrize(("pairs", "dense", "stray"), [(20, 16, 364), (20, 16, 3), (20, 10**9, 364), (60, 1, 10)])
def test_crowded_word_keys_lose_no_link(spark, monkeypatch, pairs, dense, stray):
    """Near copies of many texts of one bag of words: all share every word key, and only the shingles tell the pairs apart."""
    monkeypatch.setattr(simhash.stray_links, "__defaults__", (*simhash.stray_links.__defaults__[:2], stray))
    rng = random.Random(3)
    bag = [f"w{k}" for k in range(240)]
    rows = []
    while len(rows) < 2 * pairs:
        base = rng.sample(bag, len(bag))
        other = list(base)
        for _ in range(3):
            k = rng.randrange(len(bag) - 1)
            other[k], other[k + 1] = other[k + 1], other[k]
        a, b = " ".join(base), " ".join(other)
        if 5 <= (brute_fingerprint(a) ^ brute_fingerprint(b)).bit_count() <= simhash.SHINGLE_BITS:
            rows += [(len(rows), a), (len(rows) + 1, b)]
    kept = sorted(r["doc_id"] for r in simhash.keep_one(spark.createDataFrame(rows, "doc_id long, text string"), word_dense=dense).collect())
    assert kept == list(range(0, 2 * pairs, 2))


def test_links_between_components_are_all_found(spark):
    """Random prints in one word key, some near: the components afterwards are those of all pairs."""
    rng = random.Random(9)
    prints = set()
    while len(prints) < 120:
        base = rng.getrandbits(64)
        prints.add(base)
        for bits in (3, 9, 11, 12):
            x = base
            for b in rng.sample(range(64), bits):
                x ^= 1 << b
            prints.add(x)
    order = sorted(prints)
    root = {x: x for x in order}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in combinations(order, 2):
        if (a ^ b).bit_count() <= simhash.SHINGLE_BITS:
            low, high = sorted((find(a), find(b)))
            root[high] = low
    pairs = spark.createDataFrame([(simhash._signed(x), 5) for x in order], "fp long, words long")
    many = simhash.crowded(pairs, 1)
    edges = simhash.hub_links(many)
    for stray in (1000, 0):
        more = simhash.stray_links(many, simhash.components(edges), stray=stray)
        got = {r["node"]: r["root"] for r in simhash.components(edges.unionByName(more)).collect()}
        groups = lambda of: sorted(sorted(g) for g in {k: [x for x in order if of(x) == k] for k in {of(x) for x in order}}.values())
        assert groups(find) == groups(lambda x: got.get(simhash._signed(x), simhash._signed(x)))


def test_links_of_a_crowded_key_grow_with_its_nodes(spark):
    """All nodes near each other: the hubs, and the search between components, give links in proportion to the nodes."""
    rng, base = random.Random(4), 0x0123456789ABCDEF
    prints = {base}
    while len(prints) < 200:
        prints.add(base ^ sum(1 << b for b in rng.sample(range(64), 5)))
    order = sorted(prints)
    many = simhash.crowded(spark.createDataFrame([(simhash._signed(x), 5) for x in order], "fp long, words long"), 16)
    found = simhash.hub_links(many)
    assert found.distinct().count() == found.count() <= len(order) + 28
    assert simhash.components(found).where("root = (%d)" % min(map(simhash._signed, order))).count() == len(order)

    # as if no links were known but those of half of the nodes with each other
    half = spark.createDataFrame([(simhash._signed(x), simhash._signed(order[0])) for x in order[:100]], "node long, root long")
    more = simhash.stray_links(many, half)
    assert more.count() <= 2 * len(order)
    joined = simhash.components(half.selectExpr("node as u", "root as v").unionByName(more).unionByName(half.selectExpr("root as u", "node as v")))
    assert joined.count() == len(order) and joined.select("root").distinct().count() == 1


def test_the_forest_joins_what_is_near():
    import numpy as np

    rng = random.Random(6)
    fps = [rng.getrandbits(64) for _ in range(40)]
    fps += [x ^ (1 << 63) ^ 7 for x in fps[:20]] + [x ^ (0xFF << 20) for x in fps[:10]]
    ps = [-1 if i % 7 else 5 for i in range(len(fps))]
    parent = simhash.forest(np.array([simhash._signed(x) for x in fps]), np.array(ps), 4, 11)

    def near(i, j):
        return (fps[i] ^ fps[j]).bit_count() <= 11 and ps[i] == ps[j]

    assert all(p == -1 or near(i, p) for i, p in enumerate(parent))
    top = list(range(len(fps)))
    for _ in fps:
        top = [top[i] if p == -1 else top[p] for i, p in enumerate(parent)]
    assert all(top[i] == top[j] for i, j in combinations(range(len(fps)), 2) if near(i, j))
    assert 0 < sum(p >= 0 for p in parent) < len(fps)


def test_more_blocks_give_the_same_links(spark):
    rng = random.Random(5)
    prints = set()
    for _ in range(25):
        base = rng.getrandbits(64)
        prints.add(base)
        for bits in (1, 2, 4, 5):
            x = base
            for b in rng.sample(range(64), bits):
                x ^= 1 << b
            prints.add(x)
    signed = spark.createDataFrame([(p - (1 << 64) if p >> 63 else p,) for p in prints], "fp long")
    found = [{(r["u"], r["v"]) for r in simhash.links(signed, blocks=b).collect()} for b in (5, 7, 8)]
    assert found[0] == found[1] == found[2] and found[0]
    assert [simhash.blocks_for(n) for n in (0, 10**5, 10**7, 10**9)] == [7, 7, 7, 9] and simhash.blocks_for(5 * 10**10) == 10


def test_hot_keys_join_like_others(spark):
    from corpusflow.llm.common import joined_by_hot_key

    rows = spark.range(6000).selectExpr("id", "case when id < 3000 then -1 when id < 3100 then -2 else id end as k")
    facts = rows.groupBy("k").count().selectExpr("k", "count as n", "k * 10 as v")
    got = joined_by_hot_key(rows, facts, "k", "n")
    assert got.count() == 6000 and got.where("v <> k * 10").count() == 0 and set(got.columns) == {"k", "id", "v"}


def test_keys_of_one_kind_join_once(spark):
    """Hot keys alone, or none: one join, not three; the driver has less to plan and to broadcast."""
    from corpusflow.llm.common import joined_by_hot_key

    for k in ("id % 5", "id % 2000"):
        rows = spark.range(6000).selectExpr("id", f"{k} as k")
        facts = rows.groupBy("k").count().selectExpr("k", "count as n", "k * 10 as v")
        got = joined_by_hot_key(rows, facts, "k", "n")
        assert got.count() == 6000 and got.where("v <> k * 10").count() == 0 and set(got.columns) == {"k", "id", "v"}
        assert got._jdf.queryExecution().analyzed().toString().count("Join ") == 1
    assert joined_by_hot_key(rows, facts.limit(0), "k", "n").count() == 0


def test_texts_without_crowded_keys_take_few_jobs(spark):
    rng = random.Random(11)
    texts = [" ".join("".join(rng.choices("abcdefgh", k=5)) for _ in range(30)) for _ in range(40)]
    docs = spark.createDataFrame(list(enumerate(texts + texts[:5])), "doc_id long, text string")
    spark.sparkContext.setJobGroup("few", "few")
    try:
        kept = sorted(r["doc_id"] for r in simhash.keep_one(docs).collect())
    finally:
        spark.sparkContext.setJobGroup("others", "others")
    jobs = len(spark.sparkContext.statusTracker().getJobIdsForGroup("few"))
    assert kept == list(range(40)) and jobs <= 50, jobs
