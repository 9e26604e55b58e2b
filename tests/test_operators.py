from __future__ import annotations

import random
from collections import Counter
from itertools import combinations, product

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from corpusflow.functions import hashing, numbers
from corpusflow.operators import consensus, eligibility, exchange, ledger, planning, pool, requirements, rules, similarity, transcript
from corpusflow.operators.components import components
from corpusflow.operators.eligibility import ManifestError

# -- eligibility and samples -----------------------------------------------------------------


def test_rights(spark):
    rights = spark.sql("select * from values ('a', true, true, true, timestamp '2020-01-01', timestamp '2021-01-01'), ('b', true, true, false, timestamp '2020-01-01', null) as t(rights_record_id, processing_allowed, qa_redistribution_allowed, training_allowed, valid_from, valid_until)")
    sources = spark.createDataFrame([("s1", "a", True), ("s2", "b", True), ("s3", "b", False)], "source_id string, rights_record_id string, training boolean")
    at = lambda t: F.expr(f"timestamp '{t}'")
    got = lambda t: {r["source_id"]: r["reason"] for r in eligibility.attach_rights(sources, rights, at(t), F.col("training")).collect()}
    assert got("2020-01-01") == {"s1": None, "s2": "RIGHTS_NOT_PERMITTED", "s3": None}
    assert got("2021-01-01")["s1"] == "RIGHTS_NOT_PERMITTED" and got("2019-12-31")["s3"] == "RIGHTS_NOT_PERMITTED"
    with pytest.raises(ManifestError, match="RIGHTS_REFERENCE_MISSING"):
        eligibility.attach_rights(sources.withColumn("rights_record_id", F.lit("z")), rights, at("2020-01-01"), F.col("training"))
    with pytest.raises(ManifestError, match="RIGHTS_WINDOW"):
        eligibility.attach_rights(sources, rights.withColumn("valid_until", F.col("valid_from")), at("2020-01-01"), F.col("training"))


def test_samples_do_not_depend_on_order(spark):
    ids = [(f"{k:016x}",) for k in range(400)]
    a = [r["ImageID"] for r in eligibility.hash_sample(spark.createDataFrame(ids, "ImageID string"), "ImageID", 20).collect()]
    b = [r["ImageID"] for r in eligibility.hash_sample(spark.createDataFrame(ids[::-1], "ImageID string").repartition(7), "ImageID", 20).collect()]
    assert a == b and len(set(a)) == 20


def test_train_sample_errors(spark):
    row = lambda k: (f"{k:016x}", "train", "https://creativecommons.org/licenses/by/2.0/", "me", "https://x", "0")
    meta = lambda rows: spark.createDataFrame(rows, eligibility.METADATA)
    none = spark.createDataFrame([], "image_id string")
    assert eligibility.train_sample(meta([row(k) for k in range(5)]), none, 3).count() == 3
    with pytest.raises(ManifestError, match="SHORTFALL"):
        eligibility.train_sample(meta([row(k) for k in range(5)]), none, 6)
    with pytest.raises(ManifestError, match="DUPLICATE_SOURCE_ID"):
        eligibility.train_sample(meta([row(1), row(1)]), none, 1)
    assert eligibility.train_sample(meta([row(k) for k in range(5)]), spark.createDataFrame([(row(0)[0],)], "image_id string"), 4).count() == 4


def test_containments_match_brute_force(spark):
    rng = random.Random(3)
    words = ["a", "bb", "ccc", "dd", "e f", "x\ny"]
    long = [(k, " ".join(rng.choice(words) for _ in range(rng.randint(0, 30)))) for k in range(60)]
    short = [(k, " ".join(rng.choice(words) for _ in range(rng.randint(0, 6)))) for k in range(60)] + [(99, None), (98, "")]
    make = lambda rows: spark.createDataFrame(rows, "id long, text string")
    got = {(r["long_id"], r["short_id"]) for r in eligibility.containments(make([*long, (77, None)]), make(short)).collect()}
    assert got == {(i, j) for i, t in long for j, s in short if s and s in t}


def test_winnowed_containments(spark, monkeypatch):
    """Long passages meet by smallest hashes through a filter on either side: no pair is lost, few rows go out."""
    rng = random.Random(8)
    word = lambda: rng.choice("abcdefgh") * rng.randint(1, 4)
    long = [(k, " ".join(word() for _ in range(rng.randint(0, 400)))) for k in range(150)] + [(997, None), (998, ""), (999, "aa " * 500)]
    short = [(k, f"passage {k} " + " ".join(word() for _ in range(rng.randint(12, 40)))) for k in range(60)]
    for k, text in long[:150:2]:
        at = rng.randint(0, len(text))
        # cut inside of words, so the first and last are not whole
        short.append((1000 + k, text[at : at + rng.randint(60, 300)]))
    short += [(5000, None), (5001, ""), (5002, "a " * 30)]
    make = lambda rows: spark.createDataFrame(rows, "id long, text string")
    want = {(i, j) for i, t in long if t for j, s in short if s and len(s) >= 60 and s in t}
    assert len(want) > 40
    for reference, most in (("short", eligibility.FILTER_BITS_MOST), ("short", 1 << 9), ("long", 1 << 9)):
        # the small filters are full: results stay, hashes are winnowed
        monkeypatch.setattr(eligibility, "FILTER_BITS_MOST", most)
        got = {(r["long_id"], r["short_id"]) for r in eligibility.containments(make(long), make(short), 60, reference).collect()}
        assert got == want
    monkeypatch.undo()
    keys = eligibility.short_keys(make([r for r in short if r[1] and len(r[1].split()) > 13])).select("mode", "k")
    modes = {r["mode"] for r in keys.select("mode").distinct().collect()}
    assert modes == {eligibility.WINDOW + 1}
    words = sum(len(t.split()) for _, t in long if t)
    winnowed = eligibility.long_keys(make(long), modes)
    assert winnowed.count() < words / 3
    passed = winnowed.where(eligibility.hash_filter(keys.select("k"), keys.count())(F.col("k")))
    known = {r["k"] for r in keys.collect()}
    assert {r["k"] for r in passed.collect()} >= known & {r["k"] for r in winnowed.collect()}
    assert passed.count() < words / 10


def test_plain_arithmetic_is_the_exact_one(spark):
    """Decimals on the JVM decide as exact fractions do; what they can't hold is left to these."""
    rng = random.Random(12)
    lex = "struct<value: string, decimal_separator: string, group_separator: string, unit: string>"
    number = lambda: rng.choice(["0", "-0.0", "+2", "2.50", "-3", "0.000001", "999999999999.999999", "12", "0.5", "4"])
    odd = lambda: rng.choice(["1e3", "", " 7 ", "1,000", "1234567890123", "\u0663", ".5", "5.", "0.1234567", "\u22125"])
    unit = lambda: rng.choice([None, None, "EUR", "EUR", "m", ""])
    rows = []
    for key in range(1500):
        operation = rng.choice([*numbers.OPERATIONS, *numbers.OPERATIONS, "power", None])
        operands = [(odd() if rng.random() < 0.05 else number(), ".", "," if rng.random() < 0.05 else None, unit()) for _ in range(rng.choice([0, 1, 2, 2, 2, 2, 3]))]
        if rng.random() < 0.7:
            # terms of one unit, or a factor with one and the other without
            shared = rng.choice([None, "EUR"])
            operands = [(*x[:3], shared if k == 0 or operation in ("add", "subtract") else None) for k, x in enumerate(operands)]
        reported, named = number(), unit()
        if operation and len(operands) > 1 and rng.random() < 0.7:
            try:
                value, named = numbers.calculate(operation, [numbers.parse_lexeme(x[0]) for x in operands], [x[3] for x in operands])
                places = (value * 10**12).numerator
                if (value * 10**12).denominator == 1:
                    reported = f"{'-' if places < 0 else ''}{abs(places) // 10**12}.{abs(places) % 10**12:012d}".rstrip("0").rstrip(".")
            except numbers.Inexact:
                pass
        rows.append((key, operation, operands, (reported, ".", None, named)))
    names = ("value", "decimal_separator", "group_separator", "unit")
    want = {k: numbers.verdict_of(op, [dict(zip(names, x, strict=True)) for x in xs], dict(zip(names, r, strict=True))) for k, op, xs, r in rows}
    df = spark.createDataFrame(rows, f"key long, operation string, operands array<{lex}>, reported_result {lex}")
    plain = {r["key"]: r["v"] for r in df.select("key", numbers.plain_verdict(F.col("operation"), F.col("operands"), F.col("reported_result")).alias("v")).collect()}
    decided = {k: v for k, v in plain.items() if v}
    assert decided == {k: want[k] for k in decided}
    assert sum(v == "MET" for v in decided.values()) > 80 and len(decided) > 1000
    both = df.crossJoin(spark.range(2)).drop("id").withColumn("coverage", F.lit("MET"))
    assert {r["key"]: r["verdict"] for r in rules.verify_computations(both).collect()} == want


def test_copies_and_evaluation(spark):
    df = spark.createDataFrame([(1, "x", "g", False), (2, "y", "g", True), (3, "z", None, False), (4, "z", "h", False)], "id long, d string, g string, e boolean")
    ref = spark.createDataFrame([("x", 9), (None, 4)], "d string, id long")
    assert [r["id"] for r in eligibility.without_copies(df, ref, [("d", "d"), ("id", "id")]).orderBy("id").collect()] == [2, 3]
    got = {r["id"]: r["purpose"] for r in eligibility.spread_evaluation(df.where("g is not null"), "g", "e").collect()}
    assert got == {1: "evaluation", 2: "evaluation", 4: "training"}


def test_paths(spark):
    df = spark.createDataFrame([("a/b.jpg",), ("/a",), ("../a",), ("a/../b",), ("a..b",), ("",), (None,)], "p string")
    assert [r[0] for r in df.select(eligibility.safe_path(F.col("p"))).collect()] == [True, False, False, False, True, False, False]


# -- components and similarity ---------------------------------------------------------------


def groups_of(edges):
    parent = {}

    def find(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in edges:
        if a is not None and b is not None and a != b:
            parent[find(a)] = find(b)
    out = {}
    for x in list(parent):
        out.setdefault(find(x), []).append(x)
    return {x: min(g) for g in out.values() for x in g}


@pytest.mark.parametrize("seed", range(3))
def test_components_match_union_find(spark, seed):
    rng = random.Random(seed)
    edges = [(rng.randrange(60), rng.randrange(60)) for _ in range(40)] + [(100 + k, 101 + k) for k in range(17)] + [(5, 5), (None, 3)]
    df = spark.createDataFrame(edges, "u long, v long")
    truth = groups_of(edges)
    assert {r["node"]: r["root"] for r in components(df).collect()} == truth
    assert {r["node"]: r["root"] for r in components(df, small=10_000).collect()} == truth
    text = spark.createDataFrame([(f"n{a}", f"n{b}") for a, b in edges if a is not None], "u string, v string")
    assert {r["node"]: r["root"] for r in components(text).collect()} == groups_of([(f"n{a}", f"n{b}") for a, b in edges if a is not None])
    assert components(df.limit(0)).count() == 0


def test_similar_pairs_match_brute_force(spark):
    rng = random.Random(1)
    vectors = [(k, [rng.gauss(0, 1) for _ in range(5)]) for k in range(80)]
    vectors += [(100 + k, [x + rng.gauss(0, 0.05) for x in vectors[k][1]]) for k in range(30)] + [(200, vectors[0][1])]
    df = spark.createDataFrame(vectors, "image_id long, embedding array<double>")
    unit = {k: [x / sum(y * y for y in v) ** 0.5 for x in v] for k, v in vectors}
    for threshold in (0.95, 0.5, -1.0):
        truth = {(a, b) for a, b in combinations(sorted(unit), 2) if sum(x * y for x, y in zip(unit[a], unit[b], strict=True)) >= threshold}
        got = {(r["left_id"], r["right_id"]) for r in similarity.similar_pairs(df, threshold, block=7).collect()}
        assert got == truth
    for bad in ([], [0.0, 0.0], [float("nan"), 1.0], [1.0]):
        with pytest.raises(Exception, match="embedding"):
            similarity.similar_pairs(spark.createDataFrame([(1, [1.0, 2.0]), (2, bad)], "image_id long, embedding array<double>")).collect()


def test_visual_groups(spark):
    images = spark.createDataFrame([("a", "p1", ["g1"]), ("b", "p1", []), ("c", "p2", ["g1"]), ("d", "p3", []), ("e", "p4", ["g9"])], "image_id string, canonical_pixel_sha256 string, source_group_ids array<string>")
    vectors = spark.createDataFrame([("d", [1.0, 0.0]), ("e", [0.99, 0.01]), ("zz", [0.0, 0.0])], "image_id string, embedding array<double>")
    got = {r["image_id"]: r["visual_group_id"] for r in similarity.visual_groups(images, vectors).collect()}
    assert got["a"] == got["b"] == got["c"] != got["d"] == got["e"]
    from corpusflow.functions.hashing import canonical_hash

    assert got["a"] == canonical_hash(["a", "b", "c"])
    alone = {r["image_id"]: r["visual_group_id"] for r in similarity.visual_groups(images).collect()}
    assert alone["d"] == canonical_hash(["d"])


# -- planning ---------------------------------------------------------------------------------


@settings(max_examples=15, deadline=None)
@given(st.dictionaries(st.text("abcdef", min_size=1, max_size=3), st.integers(1, 50), min_size=1, max_size=6), st.integers(0, 200))
def test_quotas_sum_and_stay_near(spark, weights, total):
    got = {r["tag"]: r["quota"] for r in planning.quotas(spark, total, weights).collect()}
    whole = sum(weights.values())
    assert sum(got.values()) == total and all(abs(got[t] - total * w / whole) < 1 for t, w in weights.items())


def test_weights():
    assert planning.integer_weights({"a": "1/3", "b": 1}) == {"a": 1, "b": 3}
    for bad in (True, 0, -1, 0.5, "nan", "1/0"):
        with pytest.raises(ValueError):
            planning.integer_weights({"a": bad})


def test_schedule(spark):
    import hashlib

    quota = spark.createDataFrame([("en", 7), ("fr", 3), ("de", 0)], "tag string, quota long")
    got = [r["tag"] for r in planning.schedule(quota, "languages").orderBy("ordinal").collect()]
    want = sorted((hashlib.sha256(f"20260915:languages:{t}:{k}".encode()).hexdigest(), t) for t, n in (("en", 7), ("fr", 3)) for k in range(n))
    assert got == [t for _, t in want]


# -- judging ------------------------------------------------------------------------------------

V = ("MET", "NOT_MET", "UNKNOWN", "NOT_APPLICABLE", "NOT_EVALUATED", "ERROR")


def agreed(votes):
    if len(votes) != 2 or "ERROR" in votes:
        return "ERROR"
    return votes[0] if votes[0] == votes[1] and votes[0] in ("MET", "NOT_MET") else "UNKNOWN"


def test_consensus(spark):
    keys = [*product(V, V), ("MET",), ("MET", "MET", "MET")]
    votes = spark.createDataFrame([(k, v) for k, vs in enumerate(keys) for v in vs], "k int, verdict string")
    got = {r["k"]: r["verdict"] for r in consensus.paired(votes, ["k"]).collect()}
    assert got == {k: agreed(vs) for k, vs in enumerate(keys)}
    pairs = spark.createDataFrame([k for k in keys if len(k) == 2], "a string, b string")
    assert all(r["x"] == agreed((r["a"], r["b"])) for r in pairs.withColumn("x", consensus.agree(F.col("a"), F.col("b"))).collect())


def test_overrides(spark):
    rows = [
        ("C_COVERAGE", "MET", "NOT_MET", None, None, "UNKNOWN"), ("C_COVERAGE", "MET", "MET", None, None, "MET"),
        ("C_COMPUTATION", "NOT_MET", None, "UNKNOWN", None, "UNKNOWN"), ("C_COMPUTATION", "NOT_MET", None, "MET", None, "NOT_MET"), ("C_COMPUTATION", "MET", None, "NOT_MET", None, "NOT_MET"), ("C_COMPUTATION", "MET", None, None, None, "MET"),
        ("C_SET_COMPLETE", "MET", None, None, None, "UNKNOWN"), ("C_SET_COMPLETE", "NOT_MET", None, None, None, "NOT_MET"), ("C_SET_COMPLETE", "MET", None, None, "NOT_MET", "NOT_MET"), ("C_SET_COMPLETE", "UNKNOWN", None, None, "MET", "UNKNOWN"),
        ("OTHER", "MET", "NOT_MET", "NOT_MET", "NOT_MET", "MET"),
    ]
    df = spark.createDataFrame(rows, "t string, v string, cov string, comp string, sets string, want string")
    for r in df.withColumn("x", consensus.overridden(*map(F.col, ("t", "v", "cov", "comp", "sets")))).collect():
        assert r["x"] == r["want"], r


def test_gates(spark):
    rows = [(1, "gate", "MET"), (1, "annotate", "ERROR"), (2, "gate", "NOT_MET"), (2, "gate", "ERROR"), (3, "gate", "NOT_MET"), (3, "gate", "UNKNOWN"), (4, "gate", "NOT_EVALUATED"), (5, "gate", "NOT_APPLICABLE")]
    got = {r["k"]: r["aggregate"] for r in consensus.gate_aggregate(spark.createDataFrame(rows, "k int, use string, verdict string"), ["k"]).collect()}
    assert got == {1: "PASS", 2: "ERROR", 3: "FAIL", 4: "ABSTAIN", 5: "PASS"}


# -- transcripts --------------------------------------------------------------------------------


@pytest.mark.parametrize(("statuses", "want"), [("CC", (2, "QUALITY_CANDIDATE")), ("C", (1, "REJECTED")), ("CCR", (2, "QUALITY_CANDIDATE")), ("CR", (1, "REJECTED")), ("CCA", (2, "QUALITY_CANDIDATE")), ("CCE", (2, "ERROR")), ("A", (0, "ABSTAINED")), ("CCCE", (3, "ERROR"))])
def test_prefixes(spark, statuses, want):
    names = {"C": "COMMITTED", "R": "REJECTED", "A": "ABSTAINED", "E": "ERROR"}
    turns = spark.createDataFrame([("x", k + 1, names[s]) for k, s in enumerate(statuses)], "conversation_id string, turn_index int, status string")
    r = transcript.accepted_prefixes(turns).first()
    assert (r["committed_turns"], r["status"]) == want
    assert transcript.accepted_prefixes(turns, retain=False).first()["status"] in (want[1], {"R": "REJECTED", "A": "ABSTAINED"}.get(statuses[-1]))


def test_groups_and_histories_are_not_gathered(spark):
    rows = [(c, k, "user" if k % 2 == 0 else "assistant", f'é"{c}{k}') for c, n in (("a", 400), ("b", 1), ("c", 3), (None, 2)) for k in range(n)]
    m = spark.createDataFrame(rows, "conversation_id string, position int, role string, content string").repartition(5)
    h = transcript.histories(m)
    for df in (h, transcript.accepted_prefixes(h.select("conversation_id", "turn_index", F.lit("COMMITTED").alias("status")))):
        assert "collect_list" not in df._jdf.queryExecution().optimizedPlan().toString()
    got = {(r["conversation_id"], r["turn_index"]): (r["n_history"], r["history_hash"]) for r in h.collect()}
    want = {}
    for c, k, _, _ in rows:
        if k % 2 == 0:
            before = [{"content": x[3], "message_id": x[0] and f"{x[0]}:{'qa'[x[1] % 2]}:{x[1] // 2 + 1}", "role": x[2], "turn_index": x[1] // 2 + 1} for x in rows if x[0] == c and x[1] < k]
            if c is None:
                before = [{**x, "message_id": f"{'qa'[n % 2]}:{n // 2 + 1}"} for n, x in enumerate(before)]
            want[c, k // 2 + 1] = (k, hashing.canonical_hash(before))
    assert got == want
    nodes = spark.createDataFrame([(k,) for k in range(500)], "image_id long")
    roots = spark.createDataFrame([(k, 7) for k in range(7, 400)] + [(k, 401) for k in (401, 402)], "node long, root long")
    groups = similarity.group_ids(nodes, roots)
    assert "collect_list" not in groups._jdf.queryExecution().optimizedPlan().toString()
    ids = {r["image_id"]: r["visual_group_id"] for r in groups.collect()}
    members = [sorted(map(str, range(7, 400))), ["401", "402"], *([str(k)] for k in [*range(7), 400, *range(403, 500)])]
    assert ids == {int(k): hashing.canonical_hash(g) for g in members for k in g}
    turns = spark.createDataFrame([("x", 3, "REJECTED"), ("x", 1, "COMMITTED"), ("x", 2, "COMMITTED"), ("x", 4, "COMMITTED"), ("y", 1, "ERROR"), ("z", 1, "COMMITTED"), (None, 1, "COMMITTED"), (None, 2, "ABSTAINED")], "conversation_id string, turn_index int, status string")
    prefixes = {r["conversation_id"]: (r["n_turns"], r["committed_turns"], r["stop_status"]) for r in transcript.accepted_prefixes(turns).collect()}
    assert prefixes == {"x": (4, 2, "REJECTED"), "y": (1, 0, "ERROR"), "z": (1, 1, None), None: (2, 1, "ABSTAINED")}


def test_validity_and_stage_input(spark):
    m = spark.createDataFrame([("a", 0, "user"), ("a", 1, "assistant"), ("b", 0, "system"), ("b", 1, "user"), ("c", 1, "user")], "conversation_id string, position int, role string")
    got = {r["conversation_id"]: (r["contiguous"], r["alternating"]) for r in transcript.validity(m).collect()}
    assert got == {"a": (True, True), "b": (True, False), "c": (False, True)}
    df = spark.createDataFrame([("q", "h")], "question string, public_history string")
    assert transcript.stage_input(df, "question_fit").columns == ["public_history", "question"]
    for extra, code in (("gold_answer", "MODEL_INFORMATION_LEAK"), ("candidate_answer", "MODEL_PAYLOAD_FIELD"), ("other", "MODEL_PAYLOAD_FIELD")):
        with pytest.raises(PermissionError, match=code):
            transcript.stage_input(df.withColumn(extra, F.lit(1)), "question_fit")
    with pytest.raises(PermissionError, match="UNKNOWN_MODEL_STAGE"):
        transcript.stage_input(df, "other")
    items = spark.createDataFrame([("C_COVERAGE", "c"), ("R_CORE", "c")], "template_id string, candidate_claim_inventory string")
    assert [r["candidate_claim_inventory"] for r in transcript.stage_input(items, "rubric_item").orderBy("template_id").collect()] == ["c", None]
    assert transcript.scope_projection(df.withColumn("image_views", F.lit(1)), "TEXT_HQ").columns == ["public_history", "question"]


# -- rules and requirements ---------------------------------------------------------------------


@settings(max_examples=20, deadline=None)
@given(st.lists(st.sampled_from("abcd"), max_size=5), st.lists(st.sampled_from("abcd"), max_size=6), st.booleans())
def test_set_compare(spark, expected, reported, explicit):
    df = spark.createDataFrame([(expected, reported, explicit)], "e array<string>, r array<string>, x boolean")
    got = df.select(rules.compare_sets(F.col("e"), F.col("r"), F.col("x")).alias("c")).first()["c"]
    if (not expected and not explicit) or len(set(expected)) != len(expected):
        assert got is None
        return
    want = (sorted(set(expected) - set(reported)), sorted(set(reported) - set(expected)), sorted(k for k, n in Counter(reported).items() if n > 1))
    assert (got["missing"], got["unexpected"], got["duplicates"]) == want and got["verdict"] == ("NOT_MET" if any(want) else "MET")


def test_inventories(spark):
    kind = "key string, coverage string, mode string, counts array<struct<scope: string, expected: int, reported: int>>, expected_members array<string>, reported_members array<string>, empty_scope_is_explicit boolean"
    one = ("MET", "members", [], ["a", "b"], ["b", "a"], False)
    rows = [("k1", *one), ("k1", "MET", "members", [], ["b", "a"], ["a", "b"], False), ("k2", *one), ("k3", *one), ("k3", "MET", "members", [], ["a"], ["a"], False), ("k4", "MET", "count", [("x", 2, 1)], [], [], False), ("k4", "MET", "count", [("x", 2, 1)], [], [], False), ("k5", *one), ("k5", "UNKNOWN", "members", [], [], [], False)]
    got = {r["key"]: r["verdict"] for r in rules.verify_sets(spark.createDataFrame(rows, kind)).collect()}
    assert got == {"k1": "MET", "k2": None, "k3": None, "k4": "NOT_MET", "k5": None}


def test_computations(spark):
    lex = "struct<value: string, decimal_separator: string, group_separator: string, unit: string>"
    n = lambda v, unit=None: (v, ".", ",", unit)
    case = lambda key, op, xs, r: [(key, "MET", op, xs, r)] * 2
    big = "9" * 40
    rows = case("sum", "add", [n("0.1"), n("0.2")], n("0.3")) + case("big", "add", [n(big), n("1")], n("1" + "0" * 40)) + case("unit", "add", [n("1", "m"), n("2", "m")], n("3")) + case("bad", "divide", [n("1"), n("0")], n("0")) + case("third", "divide", [n("1"), n("3")], n("0.333"))
    rows += [("alone", "MET", "add", [n("1"), n("1")], n("2")), ("differ", "MET", "add", [n("1"), n("1")], n("2")), ("differ", "MET", "add", [n("1"), n("1")], n("3"))]
    df = spark.createDataFrame(rows, f"key string, coverage string, operation string, operands array<{lex}>, reported_result {lex}")
    got = {r["key"]: r["verdict"] for r in rules.verify_computations(df).collect()}
    assert got == {"sum": "MET", "big": "MET", "unit": "NOT_MET", "bad": "NOT_MET", "third": "NOT_MET", "alone": "UNKNOWN", "differ": "UNKNOWN"}


def test_requirements(spark):
    messages = spark.createDataFrame([("m1", "user", "Please  list names, in order."), ("m2", "assistant", "list")], "message_id string, role string, content string")
    kind = "key string, judge string, kind string, text string, lifetime string, source_message_id string, start int, end int"
    specs = [("k", "a", "content", "Please  list names, ", "persistent", "m1", 0, 20), ("k", "b", "content", "list names", "persistent", "m1", 3, 13), ("w", "a", "content", "nowhere", "persistent", "m1", 0, 7), ("w", "b", "content", "list", "persistent", "m2", 0, 4)]
    df = spark.createDataFrame(specs, kind)
    got = [(r["text"], r["start"], r["end"]) for r in requirements.canonical_specs(df, messages).orderBy("key", "judge").collect()]
    assert got == [("list names", 8, 18), ("list names", 8, 18), (None, None, None), (None, None, None)]
    inv = spark.createDataFrame([("k", "a", True), ("k", "b", True), ("w", "a", True), ("w", "b", True), ("none", "a", True), ("none", "b", True), ("half", "a", True), ("half", "b", False)], "key string, judge string, extraction_complete boolean")
    found = {r["key"]: r["requirement_ids"] for r in requirements.reconcile(inv, df, messages).collect()}
    assert len(found["k"]) == 1 and found["w"] is None and found["none"] == [] and found["half"] is None


def test_ledger_of_requirements(spark):
    kind = "conversation_id string, turn_index int, seq long, action string, previous_requirement_id string, requirement_id string, lifetime string"
    rows = [
        ("a", 1, 1, "introduce", None, "r1", "persistent"), ("a", 1, 2, "introduce", None, "r2", "current_turn"), ("a", 2, 3, "retain", "r1", None, None), ("a", 2, 4, "override", "r1", "r3", "persistent"), ("a", 3, 5, "revoke", "r2", None, None), ("a", 3, 6, "retain", "r3", None, None),
        ("b", 1, 1, "introduce", None, "r1", "persistent"), ("b", 1, 2, "introduce", None, "r1", "persistent"),
    ]
    got = {(r["conversation_id"], r["seq"]): (r["error"], r["n_active"]) for r in requirements.ledger(spark.createDataFrame(rows, kind)).collect()}
    assert got == {("a", 1): (None, 1), ("a", 2): (None, 2), ("a", 3): (None, 1), ("a", 4): (None, 1), ("a", 5): ("UNKNOWN_REQUIREMENT", 1), ("a", 6): ("STOPPED", 1), ("b", 1): (None, 1), ("b", 2): ("DUPLICATE_REQUIREMENT", 1)}


# -- pool -----------------------------------------------------------------------------------------


def feasible(rows, p):
    for chosen in combinations(rows, p.target_count):
        languages, families = Counter(r["language"] for r in chosen), Counter(r["task_family"] for r in chosen)
        if any(languages[k] != n for k, n in p.language_quotas.items()) or any(families[k] < n for k, n in p.family_minimums.items()):
            continue
        if all(max(Counter(r[c] for r in chosen).values(), default=0) <= cap for c, cap in p.caps.items()):
            return True
    return False


CANDIDATE = ("conversation_id", "language", "task_family", "image_id", "visual_group_id", "semantic_family", "purpose")


def candidates_frame(spark, rows):
    return spark.createDataFrame([tuple(r[c] for c in CANDIDATE) for r in rows], ", ".join(f"{c} string" for c in CANDIDATE))


def agrees(spark, rows, p):
    """Whether the selection says of a pool what trying all subsets says; never UNKNOWN."""
    found = pool.select_candidates(candidates_frame(spark, rows), p)
    if found.status == "OPTIMAL":
        return feasible([r for r in rows if r["conversation_id"] in found.selected_ids], p) and len(found.selected_ids) == p.target_count
    return found == pool.Selection((), "INFEASIBLE") and not feasible(rows, p)


def random_pool(seed):
    """A pool of up to 10 rows and a policy of which about half the pools have a feasible subset that rounds may miss."""
    rng = random.Random(seed)
    rows = [dict(zip(CANDIDATE, (f"c{k}", rng.choice("xy"), rng.choice("fg"), rng.choice("1234567"), rng.choice("abcde"), str(rng.randrange(12)), "training"), strict=True)) for k in range(rng.randint(6, 10))]
    return rows, pool.Policy(rng.randint(2, 4), {"x": rng.randint(1, 2)}, {"f": rng.randint(0, 2)}, 1, rng.randint(1, 2), 1)


@pytest.mark.parametrize("seed", range(12))
def test_selection_agrees_with_exhaustion(spark, seed):
    rows, p = random_pool(seed)
    assert agrees(spark, rows, p)


@pytest.mark.parametrize("ids", ["abc", "zyx", "mln"])
def test_selection_takes_a_row_back_where_another_needs_its_image(spark, ids):
    rows = [dict(zip(CANDIDATE, (i, lang, "f", image, f"g{i}", f"s{i}", "training"), strict=True)) for i, lang, image in zip(ids, ("en", "fr", "en"), "112", strict=True)]
    p = pool.Policy(2, {"en": 1, "fr": 1}, {}, 1, 6, 1)
    found = pool.select_candidates(candidates_frame(spark, rows), p)
    assert found == pool.Selection(tuple(sorted(ids[1:])), "OPTIMAL")
    assert pool.select_candidates(candidates_frame(spark, rows[::-1]).repartition(3), p) == found


def test_exchange_paths_of_several_steps_and_bounds(spark, monkeypatch):
    # a chain of images: each of five rows of x shares one image with the next of y; only one perfect assignment
    rows = [dict(zip(CANDIDATE, (f"c{k:02}", "x" if k % 2 else "y", "f", f"i{(k + 1) // 2}", f"g{k}", f"s{k}", "training"), strict=True)) for k in range(10)]
    p = pool.Policy(6, {"x": 1, "y": 5}, {}, 1, 9, 1)
    assert agrees(spark, rows, p)
    taken = [r for r in candidates_frame(spark, rows).selectExpr("*", "language as seat", "conversation_id as h").collect() if r["seat"] == "x"]
    df = candidates_frame(spark, rows).selectExpr("*", "language as seat", "conversation_id as h")
    done, found, whole = exchange.complete(df, taken[1:], {"x": 1, "y": 5}, {}, p.caps)
    assert (found, whole) == (True, True) and Counter(r["seat"] for r in done) == {"x": 1, "y": 5} or not feasible(rows, p)
    monkeypatch.setattr(exchange, "PER_CLASS", 1)
    infeasible = [{**r, "image_id": "one"} for r in rows]
    held = [r for r in candidates_frame(spark, infeasible).selectExpr("*", "language as seat", "conversation_id as h").collect()][:1]
    assert exchange.complete(candidates_frame(spark, infeasible).selectExpr("*", "language as seat", "conversation_id as h"), held, {"x": 1, "y": 1}, {}, p.caps)[1:] == (False, False)


def test_selection_audit_and_binding(spark):
    rows = [(f"c{k}", "en" if k % 2 else "fr", f"i{k}", f"g{k % 4}", "f1", f"s{k}", "normal", "evaluation" if k == 0 else "training") for k in range(12)]
    df = spark.createDataFrame(rows, ", ".join(f"{c} string" for c in pool.POOL))
    p = pool.Policy(4, {"en": 2, "fr": 2}, {"f1": 2}, 1, 2, 1)
    frozen, found = pool.pool_hash(df), pool.select_candidates(df, p)
    assert found.status == "OPTIMAL" and pool.pool_hash(df.repartition(5)) == frozen
    pick = lambda ids: spark.createDataFrame([(x,) for x in ids], "conversation_id string")
    report = pool.audit(df, pick(found.selected_ids), p)
    assert report["status"] == "MET" and report["selected_count"] == 4
    bound = pool.bind(found, frozen, report, pool.report_hash(report, frozen, list(found.selected_ids), p))
    assert len(bound["audit_hash"]) == 64
    bad = pool.audit(df, pick([found.selected_ids[0]] * 2 + ["zz", "c0"]), p, same_pool=False)
    assert bad["violations"] == sorted(["POOL_HASH_MISMATCH", "DUPLICATE_SELECTED_ID", "SELECTED_ID_OUTSIDE_POOL", "TARGET_COUNT_MISMATCH", "LANGUAGE_QUOTA_MISMATCH", "IMAGE_MAXIMUM_EXCEEDED", "SEMANTIC_FAMILY_MAXIMUM_EXCEEDED", "EVALUATION_SOURCE_SELECTED"])
    zero = pool.Policy(2, {"en": 2, "de": 0}, {}, 1, 2, 1)
    assert "LANGUAGE_QUOTA_MISMATCH" in pool.audit(df, pick(pool.select_candidates(df, zero).selected_ids), zero)["violations"]
    with pytest.raises(ManifestError):
        pool.bind(found, frozen, bad, "x")
    with pytest.raises(ManifestError):
        pool.pool_hash(df.unionByName(df.limit(1)))


# -- ledgers --------------------------------------------------------------------------------------


def test_blobs_and_commits(spark):
    df = spark.createDataFrame([(1, "x"), (2, "x"), (3, None), (4, "y")], "id long, text string")
    rows, table = ledger.extract_blobs(df, "text")
    assert table.count() == 2
    assert sorted((r["id"], r["text"]) for r in ledger.restore_blobs(rows, table).collect()) == [(1, "x"), (2, "x"), (3, None), (4, "y")]
    known = spark.createDataFrame([("k1",)], "k string")
    new = spark.createDataFrame([("k1", 1), ("k2", 2), ("k2", 3)], "k string, v int")
    assert [tuple(r) for r in ledger.append_new(known, new, ["k"]).collect()] == [("k2", 2)]
    for rows_ in (new, new.where("k = 'k1'")):
        with pytest.raises(ManifestError):
            ledger.commit(known, rows_, ["k"])


def test_invalid_first_write_blocks_the_cache(spark):
    calls = spark.createDataFrame([("l", "s", "r1", 1, "INVALID", "h1"), ("l", "s", "r1", 2, "COMPLETE", "h2"), ("l", "s", "r2", 3, "COMPLETE", "h3")], "model_lock_hash string, stage string, request_hash string, seq long, status string, response_hash string")
    asked = spark.createDataFrame([("l", "s", "r1"), ("l", "s", "r2"), ("l", "s", "r3")], "model_lock_hash string, stage string, request_hash string")
    assert {r["request_hash"]: r["response_hash"] for r in ledger.cached(asked, calls).collect()} == {"r1": None, "r2": "h3", "r3": None}


def test_remaining_turns(spark):
    planned = spark.createDataFrame([("a", 3), ("b", 2)], "conversation_id string, planned_turns int")
    done = spark.createDataFrame([("a", 1)], "conversation_id string, turn_index int")
    assert sorted(tuple(r) for r in ledger.remaining_turns(planned, done).collect()) == [("a", 2), ("a", 3), ("b", 1), ("b", 2)]
    with pytest.raises(ManifestError):
        ledger.remaining_turns(planned, spark.createDataFrame([("a", 2)], "conversation_id string, turn_index int"))


def test_references_and_selections(spark):
    m = spark.createDataFrame([("c", 0, "user", "q"), ("c", 1, "assistant", "a"), ("c", 2, "user", "q2")], "conversation_id string, position int, role string, content string")
    specs = spark.createDataFrame([("c", "m2", 1), ("c", "m9", 2)], "conversation_id string, source_message_id string, k int")
    assert {r["k"]: r["source_message_id"] for r in transcript.resolved(specs, m).collect()} == {1: "c:q:2", 2: None}
    offered = spark.createDataFrame([("i", 1, "x", "t1"), ("i", 1, "y", "t2")], "image_id string, turn_index int, candidate_id string, task_id string")
    said = spark.createDataFrame([("i", 1, "y"), ("j", 1, "zz"), ("k", 1, None)], "image_id string, turn_index int, candidate_id string")
    got = {r["image_id"]: (r["candidate_id"], r["task_id"], r["status"]) for r in transcript.chosen(said, offered).collect()}
    assert got == {"i": ("y", "t2", "SELECTED"), "j": (None, None, "SELECTED"), "k": (None, None, "NO_SUITABLE_CANDIDATE")}
    images = spark.createDataFrame([("b",), ("a",), ("c",)], "image_id string")
    assert {r["image_id"]: r["ordinal"] for r in transcript.first_images(images, 2).collect()} == {"a": 0, "b": 1}


def test_runs(spark):
    runs = spark.createDataFrame([("r1", "h", "pilot", "CREATED")], "run_id string, config_hash string, profile string, status string")
    assert ledger.open_run(runs, "r1", "h", "pilot").count() == 0 and ledger.open_run(runs, "r2", "h", "pilot").count() == 1
    with pytest.raises(ManifestError, match="RUN_CONFIG_MISMATCH"):
        ledger.open_run(runs, "r1", "other", "pilot")


def test_manifest_hash_is_streamed(spark):
    import tracemalloc

    from corpusflow.plans.ingest import manifest_hash

    images = spark.range(120_000).selectExpr("cast(id as string) as image_id", "cast(id div 2 as string) as visual_group_id", "'training' as split")
    failures = spark.createDataFrame([("s2", "X"), ("s1", None)], "source_id string, reason string")
    row = lambda **x: hashing.canonical_hash(x)
    want = {
        "images": sorted(row(image_id=str(k), visual_group_id=str(k // 2)) for k in range(120_000)),
        "failures": sorted([row(source_id="s2", reason="X"), row(source_id="s1", reason=None)]),
        "splits": sorted(row(image_id=str(k), split="training") for k in range(120_000)),
    }
    tracemalloc.start()
    got = manifest_hash(images.repartition(8), failures)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert got == hashing.canonical_hash(want) and peak < 20_000_000, peak
    want = {"images": [], "failures": [], "splits": []}
    assert manifest_hash(images.limit(0), failures.limit(0)) == hashing.canonical_hash(want)


def test_running_sums_cross_ranges(spark):
    import random

    from corpusflow.operators.ledger import running_sums

    rng = random.Random(1)
    rows = [(rng.choice(["hot", "hot", "b", None]), k * 3, rng.randint(-5, 5)) for k in range(400)]
    got = {r["o"]: r["v"] for r in running_sums(spark.createDataFrame(rows, "k string, o long, v long"), "k", "o", ["v"], width=50).collect()}
    sums, want = {}, {}
    for k, o, v in rows:
        sums[k] = want[o] = sums.get(k, 0) + v
    assert got == want


def test_planned_turns_decide_in_the_detailed_mode(spark):
    from corpusflow.operators import transcript

    turns = spark.createDataFrame([("a", 1, "COMMITTED"), ("a", 2, "COMMITTED"), ("b", 1, "COMMITTED"), ("b", 2, "COMMITTED"), ("b", 3, "ABSTAINED"), ("c", 1, "ERROR")], "conversation_id string, turn_index int, status string")
    planned = spark.createDataFrame([("a", 2), ("b", 3), ("c", 1)], "conversation_id string, planned_turns int")
    status = lambda df: {r["conversation_id"]: r["status"] for r in df.collect()}
    assert status(transcript.accepted_prefixes(turns)) == {"a": "QUALITY_CANDIDATE", "b": "QUALITY_CANDIDATE", "c": "ERROR"}
    assert status(transcript.accepted_prefixes(turns, planned=planned)) == {"a": "QUALITY_CANDIDATE", "b": "REJECTED", "c": "ERROR"}
    assert status(transcript.accepted_prefixes(turns, planned=planned.limit(0))) == {"a": "REJECTED", "b": "REJECTED", "c": "ERROR"}


def test_union_of_claims(spark):
    from corpusflow.operators import requirements

    claims = spark.createDataFrame([("k", "red", 0, 3), ("k", "red", 5, 8), ("k", "blue", 8, 12), ("m", "a", 1, 2), ("n", "gone", 0, 4)], "key string, text string, start int, end int")
    answers = spark.createDataFrame([("k", "red and blue"), ("m", "a a a"), ("n", "nothing")], "key string, content string")
    got = {r["key"]: r["claims"] and [tuple(c) for c in r["claims"]] for r in requirements.claim_union(claims, answers).collect()}
    assert got == {"k": [(0, 3, "red"), (8, 12, "blue")], "m": None, "n": None}


def test_excluded_ids_of_several_references(spark):
    from corpusflow.operators import eligibility

    pinned = spark.createDataFrame([("p1",), (None,)], "image_id string")
    a = spark.createDataFrame([("oi:x:1", "evaluation"), ("2", "evaluation")], "source_id string, purpose string")
    assert sorted(r[0] for r in eligibility.excluded_ids(pinned, a, a.limit(1)).collect()) == ["1", "2", "p1"]
    with pytest.raises(eligibility.ManifestError, match="REFERENCE_NOT_EVALUATION"):
        eligibility.excluded_ids(pinned, a, spark.createDataFrame([("x", None)], "source_id string, purpose string"))


def test_banded_pairs_find_near_copies(spark):
    import numpy as np

    from corpusflow.operators import similarity

    rng = np.random.default_rng(5)
    base = rng.standard_normal((700, 32))
    near = base[:500] + 0.18 * rng.standard_normal((500, 32))
    rows = [(k, [float(x) for x in v]) for k, v in enumerate(np.concatenate((base, near)))]
    df = spark.createDataFrame(rows, "image_id long, embedding array<double>")
    unit = np.array([r[1] for r in rows])
    unit /= np.linalg.norm(unit, axis=1, keepdims=True)
    cosine = unit @ unit.T
    want = {(i, j) for i, j in zip(*np.nonzero(np.triu(cosine >= 0.95, 1)), strict=True)}
    got = {(r["left_id"], r["right_id"]): r["cosine"] for r in similarity.banded_pairs(df).collect()}
    assert set(got) <= want and len(got) >= 0.9 * len(want) > 300
    assert all(abs(c - cosine[k]) < 1e-9 for k, c in got.items())
    signs, codes = similarity.bands(10**7, 0.95, 0.95)
    assert signs == 24 and codes < 50
    assert similarity.banded_pairs(df.limit(0)).count() == 0


def test_a_pinned_row_is_one_row_when_metadata_repeats_its_id(spark):
    meta = [("a", "l1", "x", "u"), ("a", "l2", "x", "u"), ("a", "l2", "x", "u"), ("b", "l1", " ", "v"), (None, "l1", "x", None)]
    metadata = spark.createDataFrame(meta, "ImageID string, License string, Author string, OriginalLandingURL string")
    pins = [("a", "l1", "x", "u"), ("a", "l2", "x", "u"), ("a", "l3", "x", "u"), ("b", "l1", "v", "v"), ("b", "l1", "w", "v"), ("c", "l1", "x", "u"), (None, "l1", "x", None)]
    pinned = spark.createDataFrame(pins, "image_id string, license_uri string, attribution string, landing_url string")
    got = sorted((r["image_id"], r["reason"]) for r in eligibility.pinned_failures(pinned, metadata).collect())
    assert got == [("a", "OPEN_IMAGES_PIN_PROVENANCE_MISMATCH"), ("b", "OPEN_IMAGES_PIN_PROVENANCE_MISMATCH"), ("c", "OPEN_IMAGES_PIN_MISSING")]


def test_equal_vectors_are_links_to_one_and_pairs_of_strings_keep_their_order(spark):
    rng = random.Random(7)
    own = [[rng.gauss(0, 1) for _ in range(6)] for _ in range(40)]
    rows = [(f"v{k:03}", own[k % 40 if k < 60 else 0]) for k in range(300)] + [(None, own[1])]
    df = spark.createDataFrame(rows, "image_id string, embedding array<double>")
    pairs = [(r[0], r[1]) for r in similarity.similar_pairs(df, 0.8, block=90).select("left_id", "right_id").collect()]
    assert all(a < b for a, b in pairs) and len(set(pairs)) == len(pairs) > 240 * 239 / 2
    links = [(r["u"], r["v"]) for r in similarity.similar_links(df, 0.8).collect()]
    assert groups_of(links) == groups_of(pairs)
    assert len(links) <= 260 + 40 * 39 / 2


def test_the_hash_of_a_pool_passes_in_chunks_and_not_through_the_driver(spark, monkeypatch):
    from pyspark.sql import DataFrame

    def refused(*_, **__):
        raise AssertionError("rows of the pool reach the driver")

    monkeypatch.setattr(pool, "CHUNK", 300)
    monkeypatch.setattr(DataFrame, "toLocalIterator", refused)
    rows = [(f"c{k:04}", "en", f"i{k}", "g", "f", 'quote " and é', "p", "training") for k in range(500)]
    df = spark.createDataFrame(rows, ", ".join(f"{c} string" for c in pool.POOL))
    want = hashing.canonical_hash([dict(zip(pool.POOL, r, strict=True)) for r in rows])
    assert pool.pool_hash(df.repartition(5)) == want
    assert pool.pool_hash(df.limit(0)) == hashing.canonical_hash([])


def test_agreeing_computations_meet_as_numbers_and_not_as_sorted_lexemes(spark):
    lex = "struct<value: string, decimal_separator: string, group_separator: string, unit: string>"
    n = lambda v, unit=None, group=None: (v, ".", group, unit)
    rows = [(k, c, "multiply", [n("2"), x], r) for k, x, r, cs in [
        (1, n("3", "m"), n("6", "m"), ("MET", "MET")), (2, n("3"), n("7"), ("MET", "MET")), (3, n("3"), n("6"), ("MET", None)), (4, n("1,000", None, ","), n("2000"), ("MET", "MET")), (5, n("3"), n("6"), ("MET",)),
    ] for c in cs]
    rows += [(6, "MET", "multiply", [n("2"), n("3")], n("6")), (6, "MET", "multiply", [n("3"), n("2")], n("6"))]
    rows += [(7, "MET", "multiply", [n("2"), n("3")], ("6", ".", None, "x")), (7, "MET", "multiply", [n("2"), n("3")], ("6", ".", "x", None))]
    df = spark.createDataFrame(rows, f"key long, coverage string, operation string, operands array<{lex}>, reported_result {lex}")
    out = rules.verify_computations(df)
    assert {r["key"]: r["verdict"] for r in out.collect()} == {1: "MET", 2: "NOT_MET", 3: "UNKNOWN", 4: "MET", 5: "UNKNOWN", 6: "UNKNOWN", 7: "UNKNOWN"}
    assert "SortAggregate" not in out._jdf.queryExecution().executedPlan().toString()


def test_only_pairs_with_like_sketches_fetch_their_vectors(spark):
    import numpy as np

    near = 1 - np.arccos(0.9) / np.pi
    rng = np.random.default_rng(3)
    differing = rng.binomial(similarity.SKETCH, 1 - near, 1_000_000)
    assert (differing > similarity.sketch_cut(0.9, 1e-3)).mean() < 2e-3
    assert (rng.binomial(similarity.SKETCH, 0.5, 100_000) <= similarity.sketch_cut(0.9, 1e-7 / 2)).mean() < 0.01
    assert similarity.sketch_cut(1.0, 1e-7) == 0 and similarity.sketch_cut(-1.0, 1e-7) == similarity.SKETCH
    signs, codes = similarity.bands(1_200_000 // similarity.CHANCE, 0.9, 1 - 1e-7 / 2)
    assert codes < 0.6 * similarity.bands(1_200_000, 0.9, 1 - 1e-7)[1]
