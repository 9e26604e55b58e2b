import itertools
import math
import random

import numpy as np

from corpusflow.llm import quality


def test_orders_grades(spark):
    rng, rows = random.Random(5), []
    for k in range(600):
        words = ["".join(rng.choice("abcdefgh") for _ in range(4)) for _ in range(40)]
        grade = k % 3
        if grade == 0:
            words = [w.upper() + "!!" for w in words]
        elif grade == 1:
            words += ["badword"] * 6
        rows.append((k, " ".join(words), grade))
    docs = spark.createDataFrame([(i, t, "en", "s", 0) for i, t, _ in rows], "doc_id long, text string, lang string, source string, n_chars long")
    labels = spark.createDataFrame([(i, int(g > 0), int(g == 1)) for i, _, g in rows], "doc_id long, quality int, toxic int")
    out = quality.rate(docs, labels).toPandas().set_index("doc_id")
    held = out[out.held_out]
    mean = {g: held["expected_grade"][[i for i in held.index if i % 3 == g]].mean() for g in range(3)}
    assert mean[0] < 0.4 < mean[1] < mean[2] and mean[2] > 1.5
    assert held["keep"][[i for i in held.index if i % 3]].mean() > 0.97
    assert (~held["keep"][[i for i in held.index if i % 3 == 0]]).mean() > 0.97
    assert np.allclose(out["p_tail"] + out["p_top"], out["expected_grade"])
    assert (out["p_tail"] >= out["p_top"]).all()


def brute_loss(weights, theta, rows, grades, share):
    """Penalised negative log-likelihood of the cumulative-link model, from its definition."""
    below = lambda k, s: 1.0 if k >= quality.GRADES - 1 else 0.0 if k < 0 else 1 / (1 + math.exp(-(theta[k] - s)))
    out = 0.0
    for (idx, val), y, w in zip(rows, grades, share, strict=True):
        s = sum(weights[i] * v for i, v in zip(idx, val, strict=True))
        out -= w * math.log(below(y, s) - below(y - 1, s))
    return out


def test_first_step_follows_the_numeric_gradient(monkeypatch):
    rng = np.random.default_rng(1)
    rows = [(rng.integers(0, 40, 5).astype(np.int32), rng.random(5).astype(np.float32)) for _ in range(60)]
    grades = rng.integers(0, 3, 60)
    share = np.array([1 / len(set(grades)) / (grades == g).sum() for g in grades])
    monkeypatch.setattr(quality, "STEPS", 1)
    model = quality.CumulativeLink().fit(rows, grades)
    theta, eps = np.array([-0.5, 0.5]), 1e-5
    for i in range(40):
        weights = np.zeros(quality.BUCKETS)
        weights[i] = eps
        up = brute_loss(weights, theta, rows, grades, share)
        weights[i] = -eps
        slope = (up - brute_loss(weights, theta, rows, grades, share)) / (2 * eps)
        # the first step of Adam has the length of the rate, against the gradient
        if abs(slope) > 1e-5:
            assert np.isclose(model.weights[i], -quality.RATE * np.sign(slope), rtol=0.02), i
    both = lambda d: brute_loss(np.zeros(quality.BUCKETS), theta + d, rows, grades, share)
    assert np.sign(model.theta[0] - -0.5) == -np.sign(both(eps) - both(-eps) + 2 * eps * 1e-3 * -0.5)


def test_fitting_lowers_the_loss_and_keeps_thresholds_in_order():
    rng = np.random.default_rng(2)
    rows = [(rng.integers(0, 40, 5).astype(np.int32), rng.random(5).astype(np.float32)) for _ in range(90)]
    value = [sum(v if i < 13 else -v if i < 26 else 0 for i, v in zip(*r, strict=True)) for r in rows]
    grades = np.digitize(value, np.quantile(value, [1 / 3, 2 / 3]))
    model = quality.CumulativeLink().fit(rows, grades)
    share = np.full(90, 1 / 90)
    assert model.theta[0] < model.theta[1]
    assert brute_loss(model.weights, model.theta, rows, grades, share) < 0.6 * brute_loss(np.zeros(quality.BUCKETS), [-0.5, 0.5], rows, grades, share)


def test_tails_match_the_definition():
    texts = ["plain words here", "MANY SHOUTED!!! WORDS!!!", "", None, "a a a a b", "x1 y2 " * 50]
    model = quality.CumulativeLink()
    model.weights = np.random.default_rng(4).standard_normal(quality.BUCKETS)
    model.theta = np.array([-0.3, 0.9])
    for t, got in zip(texts, model.tails(texts), strict=True):
        tokens = (t or "").split()
        total = 0.0
        if not tokens:
            total = model.weights[quality._bucket("d", "empty")]
        for w in set(tokens):
            part = tokens.count(w) / len(tokens)
            shape = "".join(k for k, _ in itertools.groupby("A" if c.isupper() else "a" if c.isalpha() else "0" if c.isdigit() else c for c in w))
            total += part * model.weights[quality._bucket("w", w.lower())] + 4 * part * model.weights[quality._bucket("s", shape)]
        if tokens:
            n, same = len(tokens), sum(a == b for a, b in itertools.pairwise(tokens)) / len(tokens)
            for name in (f"same{min(9, int(same * 20))}", f"fresh{int(len(set(tokens)) / n * 10)}.{min(5, n.bit_length() // 3)}", f"long{n.bit_length()}"):
                total += 0.5 * model.weights[quality._bucket("d", name)]
        assert np.allclose(got, [1 - 1 / (1 + math.exp(-(th - total))) for th in model.theta])


def test_one_grade_and_none(spark, odd, none, labels):
    some = spark.createDataFrame([(1, 1, 0), (5, 1, 0), (6, 0, None), (2, None, 1)], "doc_id long, quality int, toxic int")
    out = quality.rate(odd, some).collect()
    assert len(out) == odd.count() and all(0 <= r["expected_grade"] <= 2 for r in out)
    assert quality.rate(none, some).count() == 0
    blank = quality.rate(odd, labels).collect()
    assert all(r["keep"] for r in blank)
    kept = quality.keep_good(odd, odd, labels)
    assert kept.columns == odd.columns and kept.count() == odd.count()


def test_shapes():
    assert quality.shape_of("Word***") == "Aa*" and quality.shape_of("IN!!") == "A!" and quality.shape_of("x1-2") == "a0-0"
