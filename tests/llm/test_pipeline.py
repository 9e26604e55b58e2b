from itertools import combinations

import corpus_pipeline
from corpusflow.llm import decontaminate, quality, simhash, toxicity


def test_stages_are_what_their_operators_decide(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    labels, bench = spark.read.parquet(f"{small}/labels.parquet"), spark.read.parquet(f"{small}/benchmark.parquet")
    rows = {r["doc_id"]: r for r in docs.collect()}
    ids = set(rows)
    tox = {r["doc_id"] for r in toxicity.classify(docs, labels).collect() if r["flagged"]}
    ids -= tox
    ids &= {r["doc_id"] for r in quality.rate(docs, labels).collect() if r["keep"]}
    prints = {d: (simhash.fingerprint_int(rows[d]["text"]), simhash.word_print(rows[d]["text"])) for d in ids}
    root = {d: d for d in ids}

    def find(d):
        while root[d] != d:
            d = root[d]
        return d

    for a, b in combinations(sorted(ids), 2):
        (x, p), (y, q) = prints[a], prints[b]
        if (x ^ y).bit_count() <= 4 or ((p ^ q).bit_count() <= 4 and (x ^ y).bit_count() <= simhash.SHINGLE_BITS):
            low, high = sorted((find(a), find(b)))
            root[high] = low
    ids = {find(d) for d in ids}
    leaked = {r["doc_id"] for r in decontaminate.leaks(docs, bench).collect()}
    ids -= leaked
    out = corpus_pipeline.run(spark, small).collect()
    assert {r["doc_id"] for r in out} == ids and len(out) == len(ids)
    assert all(r["text"] == rows[r["doc_id"]]["text"] for r in out)
    assert len({r["position"] for r in out}) == len(out)


def test_stages_keep_columns_and_take_empty_tables(spark, small, odd, none):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "quality", "near_duplicates", "decontamination", "mixing"]
    for name, stage in corpus_pipeline.STAGES:
        for df in (odd, none):
            out = stage(spark, df, small)
            if name != "mixing":
                assert out.columns == df.columns
            assert out.count() <= df.count()
