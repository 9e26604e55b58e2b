import random

from corpusflow.llm import decontaminate as D

PASSAGE = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau upsilon"


def brute_tiles(doc, item, least):
    """Greedy string tiling by trying all pairs of places again and again."""
    used_d, used_i, tiles = set(), set(), []
    while True:
        best = (0, 0, 0)
        for i in range(len(doc)):
            for j in range(len(item)):
                n = 0
                while i + n < len(doc) and j + n < len(item) and doc[i + n] == item[j + n] and i + n not in used_d and j + n not in used_i:
                    n += 1
                if n > best[0]:
                    best = (n, i, j)
        if best[0] < least:
            return tiles
        n, i, j = best
        tiles.append((i, j, n))
        used_d |= set(range(i, i + n))
        used_i |= set(range(j, j + n))


def test_tiles_match_brute_force():
    rng = random.Random(4)
    for _ in range(60):
        doc, item = [rng.randrange(3) for _ in range(rng.randint(0, 40))], [rng.randrange(3) for _ in range(rng.randint(5, 20))]
        assert D.tile(doc, item, D.places(doc, item, 3), 3) == brute_tiles(doc, item, 3)


def test_rolling_hashes_are_those_of_the_windows():
    ids = [5, 0, 7, 7, 2, 9, 0, 0]
    assert D.rolling(ids, 3) == [D.rolling(ids[k : k + 3], 3)[0] for k in range(6)]
    assert D.rolling([1, 2], 3) == []


def test_finds_reordered_passages(spark):
    words = PASSAGE.split()
    moved = " ".join(words[10:] + ["filler"] + words[:10])
    short = " ".join([*words[15:18], "x", *words[6:15], "y", *words[3:6], "z", *words[:3]])
    partly = " ".join(words[:12] + ["filler"] * 8)
    rows = [(1, "x " + PASSAGE.upper() + " y"), (2, moved), (3, partly), (4, "nothing here"), (5, " ".join(reversed(words))), (6, None), (7, short)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    bench = spark.createDataFrame([(7, PASSAGE), (8, "another text altogether with other words"), (9, None), (10, "")], "item_id long, text string")
    got = {(r["doc_id"], r["item_id"]): (r["coverage"], r["n_tiles"]) for r in D.leaks(docs, bench).collect()}
    assert got == {(1, 7): (1.0, 1), (2, 7): (1.0, 2), (7, 7): (0.9, 4)}
    assert sorted(r["doc_id"] for r in D.keep_unleaked(docs, bench).collect()) == [3, 4, 5, 6]
    blocks = {(r["doc_id"], r["item_id"]) for r in D.leaks(docs, bench, block_chars=10).collect()}
    assert blocks == set(got)
    assert sorted(r["doc_id"] for r in D.keep_unleaked(docs, bench, block_chars=10).collect()) == [3, 4, 5, 6]


def test_repetitive_texts_stay_cheap():
    doc, item = [1] * 50_000, [1] * 300
    starts = D.places(doc, item, 3)
    assert len(starts) < 50_300
    assert D.tile(doc, item, starts, 3) == [(0, 0, 300)]
    doc, item = [1, 2, 3] * 4000 + [9], [1, 2, 3] * 30 + [7]
    assert sum(t[2] for t in D.tile(doc, item, D.places(doc, item, 3), 3)) == 90


def test_whole_tables_match_brute_force(spark, small):
    docs, bench = spark.read.parquet(f"{small}/documents.parquet"), spark.read.parquet(f"{small}/benchmark.parquet")
    got = {(r["doc_id"], r["item_id"], round(r["coverage"], 9)) for r in D.leaks(docs, bench).collect()}
    items = [(r["item_id"], D.tokens(r["text"])) for r in bench.collect()]
    truth = set()
    for r in docs.select("doc_id", "text").collect():
        doc = D.tokens(r["text"])
        grams = {tuple(doc[k : k + 5]) for k in range(len(doc) - 4)}
        for key, item in items:
            if any(tuple(item[k : k + 5]) in grams for k in range(len(item) - 4)):
                share = sum(t[2] for t in brute_tiles(doc, item, 3)) / len(item)
                if share >= 0.8:
                    truth.add((r["doc_id"], key, round(share, 9)))
    assert got == truth and got


def test_odd_rows(spark, odd, none):
    bench = spark.createDataFrame([(1, "the quick brown fox jumps"), (1, "the quick brown fox jumps"), (2, "lazy dog")], "item_id long, text string")
    got = sorted((str(r["doc_id"]), r["item_id"]) for r in D.leaks(odd, bench).collect())
    assert set(got) == {("1", 1), ("1", 2), ("None", 1), ("None", 2)}
    empty = spark.createDataFrame([], "item_id long, text string")
    assert D.leaks(odd, empty).count() == 0 and D.leaks(none, bench).count() == 0
    assert D.keep_unleaked(odd, empty).count() == odd.count() and D.keep_unleaked(odd, bench).columns == odd.columns
