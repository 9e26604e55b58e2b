import random
from zlib import crc32

import numpy as np

from corpusflow.llm import toxicity


def corpus(n, seed=3):
    rng, out = random.Random(seed), []
    letters = "abcdefghijklmnop"
    for k in range(n):
        words = ["".join(rng.choice(letters) for _ in range(rng.randint(2, 7))) for _ in range(rng.randint(5, 120))]
        bad = k % 3 == 0
        if bad:
            for _ in range(2):
                words.insert(rng.randrange(len(words) + 1), "zzgrob" + rng.choice(letters) + rng.choice(letters))
        out.append((k, " ".join(words), rng.choice(["en", "de"]), int(bad)))
    return out


def test_finds_unseen_forms_of_a_stem(spark):
    rows = corpus(900)
    docs = spark.createDataFrame([(i, t, lang, "s", 0) for i, t, lang, _ in rows], "doc_id long, text string, lang string, source string, n_chars long")
    labels = spark.createDataFrame([(i, 1, y) for i, _, _, y in rows], "doc_id long, quality int, toxic int")
    out = toxicity.classify(docs, labels).toPandas().set_index("doc_id")
    truth = {i: y for i, _, _, y in rows}
    held = out[out.held_out]
    assert len(out) == 900 and 200 < len(held) < 400
    right = np.mean([truth[i] == p for i, p in held["predicted"].items()])
    assert right > 0.97
    assert ((out["score"] >= 0) & (out["score"] <= 1)).all()
    assert ((out["score"] >= 0.7).astype(int) == out["predicted"]).all()


def test_score_reads_only_the_text(spark):
    rows = corpus(300)
    make = lambda other: spark.createDataFrame([(i, t, lang, "s", 0) for i, t, lang, _ in rows] + [(10_000 + len(other), rows[0][1], other, other, 5)], "doc_id long, text string, lang string, source string, n_chars long")
    labels = spark.createDataFrame([(i, 1, y) for i, _, _, y in rows], "doc_id long, quality int, toxic int")
    got = toxicity.classify(make("fr"), labels).toPandas().set_index("doc_id")["score"]
    assert got[10_002] == got[0]


def test_held_out_labels_change_nothing(spark):
    import zlib

    rows = corpus(300)
    docs = spark.createDataFrame([(i, t, lang, "s", 0) for i, t, lang, _ in rows], "doc_id long, text string, lang string, source string, n_chars long")
    held = lambda i: zlib.crc32(str(i).encode()) % 3 == 1
    a = toxicity.train(docs, spark.createDataFrame([(i, 1, y) for i, _, _, y in rows], "doc_id long, quality int, toxic int"))
    b = toxicity.train(docs, spark.createDataFrame([(i, 1, 1 - y if held(i) else y) for i, _, _, y in rows], "doc_id long, quality int, toxic int"))
    texts = [r[1] for r in rows]
    assert np.array_equal(a.score(texts), b.score(texts))


def test_odd_rows_and_empty_tables(spark, odd, none, labels):
    some = spark.createDataFrame([(1, 1, 1), (2, 0, 0), (3, 1, None), (5, 1, 0), (6, 1, 0), (None, 1, 1)], "doc_id long, quality int, toxic int")
    out = toxicity.classify(odd, some).collect()
    assert len(out) == odd.count()
    assert all(0 <= r["score"] <= 1 for r in out)
    assert len({r["score"] for r in out if r["doc_id"] in (2, 3, 4)}) == 1  # wordless texts are alike
    assert len({r["score"] for r in out if r["doc_id"] in (1, None)}) == 1
    assert toxicity.classify(none, some).count() == 0
    blank = toxicity.classify(odd, labels).collect()
    assert {r["predicted"] for r in blank} == {0}
    assert toxicity.keep_clean(odd, odd, labels).columns == odd.columns


def test_pieces_of_a_long_text_pool_like_the_whole(monkeypatch):
    rows = corpus(200)
    model = toxicity.ConvText().fit([r[1] for r in rows], np.array([r[3] for r in rows]))
    texts = [r[1] for r in rows[:20]]
    whole = model.raw(texts)
    monkeypatch.setattr(toxicity, "_PIECE", 7)
    assert np.allclose(whole, model.raw(texts), atol=1e-5)


def test_a_label_repeated_over_many_rows_is_one_row_of_the_sample(spark):
    rows = corpus(120)
    frame = lambda more: spark.createDataFrame([(i, t, lang, "s", 0) for i, t, lang, _ in rows + more], "doc_id long, text string, lang string, source string, n_chars long")
    labels = spark.createDataFrame([(i, 1, y) for i, _, _, y in rows], "doc_id long, quality int, toxic int")
    texts = [r[1] for r in rows]
    once, often = toxicity.train(frame([]), labels), toxicity.train(frame(rows[:5] * 40), labels)
    assert np.array_equal(once.score(texts), often.score(texts))


def brute_pooled(model, text):
    """Each filter's largest response over the places of a text, word by word, from the embeddings on."""
    words = [w for w in "".join(c.lower() if c.isalpha() else " " for c in text or "").split()]
    vectors = []
    for w in words:
        parts = ["w" + w, "3" + w[:3], "4" + w[:4], "5" + w[:5], "6" + w[:6], "s" + w[-4:]]
        vectors.append(sum(model.emb[crc32(p.encode()) % toxicity.BUCKETS].astype(float) for p in parts) / 6)
    out = []
    for conv in model.conv:
        for f in range(toxicity.FILTERS):
            best = 0.0
            for start in range(len(words) - len(conv) + 1):
                best = max(best, sum(float(vectors[start + k] @ conv[k, :, f].astype(float)) for k in range(len(conv))))
            out.append(best)
    return np.array(out)


def test_scores_match_a_forward_pass_by_hand():
    rows = corpus(150)
    model = toxicity.ConvText().fit([r[1] for r in rows], np.array([r[3] for r in rows]))
    model.calibrate([r[1] for r in rows], np.array([r[3] for r in rows]), [r[2] for r in rows])
    texts = [r[1] for r in rows[:25]] + [None, "", "one", "Two WORDS", "a, b; c! d"]
    want = [1 / (1 + np.exp(-(model.scale * (float(brute_pooled(model, t) @ model.out.astype(float)) + model.bias) + model.shift))) for t in texts]
    assert np.allclose(model.score(texts), want, atol=1e-4)


def test_a_step_goes_against_the_numeric_gradient(monkeypatch):
    monkeypatch.setattr(toxicity, "RATE", 1.0)
    rng = np.random.default_rng(0)
    texts, y = [r[1] for r in corpus(12, 8)] + [""], np.array([r[3] for r in corpus(12, 8)] + [0], np.float32)
    model = toxicity.ConvText()
    model.emb = model.emb.astype(float)
    model.conv = [rng.standard_normal(c.shape) for c in model.conv]
    model.out = rng.standard_normal(model.out.shape)
    weight = rng.random(len(y)) + 0.5
    vocab = {}
    docs = [np.array([vocab.setdefault(w, len(vocab)) for w in toxicity.words_of(t)], np.int32) for t in texts]

    def loss():
        z = np.array([brute_pooled(model, t) @ model.out + model.bias for t in texts])
        p = 1 / (1 + np.exp(-z))
        return float(-(weight * (y * np.log(p) + (1 - y) * np.log(1 - p))).sum() / len(y))

    # what Adagrad adds up is the square of each gradient
    before = (model.emb.copy(), [c.copy() for c in model.conv], model.out.copy(), model.bias)
    sums = [np.zeros(x.shape) + 1e-12 for x in (model.emb, *model.conv, model.out)]
    model._step(docs, y, weight, toxicity.parts_table(vocab), sums)
    moved = model.bias - before[3]
    model.emb, model.conv, model.out, model.bias = before[0], before[1], before[2], before[3]

    def numeric(array, at, eps=1e-5):
        old = array[at]
        array[at] = old + eps
        up = loss()
        array[at] = old - eps
        down = loss()
        array[at] = old
        return (up - down) / (2 * eps)

    for k in range(0, len(model.out), 3):
        assert np.isclose(abs(numeric(model.out, k)), np.sqrt(sums[-1][k]), atol=1e-4)
    for n, c in enumerate(model.conv):
        for at in [(0, 0, 0), (len(c) - 1, 3, 2), (0, 5, 1)]:
            assert np.isclose(abs(numeric(c, at)), np.sqrt(sums[1 + n][at]), atol=1e-4)
    rows = np.argsort(-sums[0].sum(axis=1))[:5]
    for r in rows:
        assert np.isclose(abs(numeric(model.emb, (r, 1))), np.sqrt(sums[0][r, 1]), atol=1e-4)
    model.bias = before[3] + 1e-5
    up = loss()
    model.bias = before[3] - 1e-5
    assert np.isclose((up - loss()) / 2e-5, -moved, atol=1e-4)


def test_rows_beyond_the_first_sample_train_the_model_too(spark):
    rows = corpus(900)
    # forms that no row of the sample has
    late = [(10_000 + k, f"{rows[k][1]} quxxo{'abc'[k % 3]}", "en", 1) for k in range(0, 900, 2) if not rows[k][3]]
    every = rows + late
    docs = spark.createDataFrame([(i, t, lang, "s", 0) for i, t, lang, _ in every], "doc_id long, text string, lang string, source string, n_chars long")
    labels = spark.createDataFrame([(i, 1, y) for i, _, _, y in every], "doc_id long, quality int, toxic int")
    model = toxicity.train(docs, labels, rows=40)
    again = toxicity.train(docs.repartition(3), labels.repartition(2), rows=40)
    truth = [(t, y) for i, t, _, y in every if crc32(str(i).encode()) % 3 == 1]
    right = np.mean([(p >= 0.7) == y for p, (_, y) in zip(model.score([t for t, _ in truth]), truth, strict=True)])
    few = [(t, y) for i, t, _, y in every if crc32(str(i).encode()) % 3 != 1][:80]
    small = toxicity.ConvText().fit([t for t, _ in few], np.array([y for _, y in few]))
    assert right > 0.9
    assert not np.allclose(small.emb, model.emb)
    assert np.allclose(model.score([t for t, _ in truth]), again.score([t for t, _ in truth]), atol=1e-4)
