import random
from collections import Counter
from fractions import Fraction

import pytest

from corpusflow.llm import mixing as M


@pytest.mark.parametrize("seed", range(12))
def test_deviation_stays_under_one_block(seed):
    rng = random.Random(seed)
    parts = {f"s{k}": rng.randint(1, 60) for k in range(rng.randint(1, 12))}
    q, slots = sum(parts.values()), M.period(parts)
    assert sorted(x for v in slots.values() for x in v) == list(range(q))
    for s, a in parts.items():
        had, own = 0, set(slots[s])
        for t in range(q):
            had += t in own
            assert abs(had - Fraction(a * (t + 1), q)) < 1
        for k, slot in enumerate(slots[s]):
            assert k * q // a <= slot < -(-(k + 1) * q // a)


def test_phases_place_every_block_once():
    blocks, parts = {"a": 17, "b": 3, "c": 40, "d": 0}, {"a": 5, "b": 2, "c": 1, "d": 9}
    seen = []
    for ph in M.phases(blocks, parts):
        for s, (a, used, slots) in ph["sources"].items():
            more = [x for x in M.phases(blocks, parts) if x["start"] > ph["start"]]
            until = more[0]["sources"][s][1] if more and s in more[0]["sources"] else blocks[s]
            seen += [(ph["start"] + (k - used) // a * ph["q"] + slots[(k - used) % a], s, k) for k in range(used, until)]
    assert sorted(x[0] for x in seen) == list(range(60))
    assert Counter(x[1] for x in seen) == Counter({k: v for k, v in blocks.items() if v})


def test_mix_keeps_all_rows_and_the_targets(spark):
    rows = [(k, f"t{k}", "en", "big" if k % 3 else f"s{k % 7}", 1) for k in range(3000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    out = M.mix(docs, {"big": 2.0, "s0": 1.0}, block=4).toPandas()
    assert len(out) == 3000 and out["position"].is_unique and list(out.columns) == [*docs.columns, "block_no", "slot", "position"]
    blocks = out.drop_duplicates(["source", "block_no"])
    assert sorted(blocks["slot"]) == list(range(len(blocks)))
    low = 1.0
    target = {s: (2.0 if s == "big" else low) for s in blocks["source"].unique()}
    whole, end = sum(target.values()), blocks.groupby("source")["slot"].max().min()
    for s, w in target.items():
        share = w / whole
        had = 0
        own = set(blocks.loc[blocks["source"] == s, "slot"])
        for t in range(end + 1):
            had += t in own
            assert abs(had - share * (t + 1)) < 1
    again = M.mix(docs.repartition(7), {"big": 2, "s0": "1.0"}, block=4).toPandas()
    assert again.set_index("doc_id")["position"].to_dict() == out.set_index("doc_id")["position"].to_dict()


def test_odd_rows(spark, odd, none):
    out = M.mix(odd).toPandas()
    assert len(out) == odd.count() and out["position"].is_unique
    assert M.mix(none).count() == 0
    assert M.mix(odd.select("doc_id", "source")).count() == odd.count()
    assert M.period({}) == {} and M.phases({}, {}) == []


def test_sql_places_the_same_rows(spark):
    import duckdb
    import pandas as pd

    rng = random.Random(9)
    names = ["hot"] * 6 + ["b", "c", None, "d"]
    rows = [(k % 1500, rng.choice(names)) for k in range(1600)] + [(None, "b")]
    frame = pd.DataFrame({"doc_id": pd.array([r[0] for r in rows], dtype="Int64"), "source": [r[1] for r in rows]})
    con = duckdb.connect()
    con.register("docs", frame)
    want = con.sql(M.oracle_sql("docs")).fetchall()
    got = [tuple(r) for r in M.mix(spark.createDataFrame(rows, "doc_id long, source string")).collect()]
    # repeated rows share their two places
    assert sorted(map(str, want)) == sorted(map(str, got))


def places_of(blocks, plan):
    """Slots of each phase's blocks by source, by the arithmetic that the plan is for."""
    for p, ph in enumerate(plan):
        end = plan[p + 1]["start"] if p + 1 < len(plan) else sum(blocks.values())
        own = {}
        for s, (a, used, slots) in ph["sources"].items():
            until = plan[p + 1]["sources"][s][1] if p + 1 < len(plan) and s in plan[p + 1]["sources"] else blocks[s]
            own[s] = [ph["start"] + k // a * ph["q"] + slots[k % a] for k in range(until - used)]
        yield ph["start"], end, own


def farthest(blocks, targets, plan):
    """The farthest that any source gets from its target's share of a phase's slots, in exact blocks, over all slots."""
    out, exact = Fraction(0), {s: Fraction(str(w)) for s, w in targets.items()}
    for start, end, own in places_of(blocks, plan):
        whole = sum(exact[s] for s in own)
        for s, slots in own.items():
            up, down = exact[s].numerator * whole.denominator, exact[s].denominator * whole.numerator
            # before and after each own block, and at the end
            most = max([abs(k * down - up * (t - start)) for k, t in enumerate(slots)] + [abs((k + 1) * down - up * (t + 1 - start)) for k, t in enumerate(slots)] + [abs(len(slots) * down - up * (end - start))])
            out = max(out, Fraction(most, down))
    return out


CASES = {
    "one to two": ({"a": 200_000, "b": 400_000}, {"a": "1/3", "b": "2/3"}),
    "pi": ({"a": 150_000, "b": 470_000}, {"a": 1, "b": 3.1415926}),
    "roots": ({"a": 300_000, "b": 210_000, "c": 173_205}, {"a": 1.7320508075688772, "b": 1.2345678901234567, "c": 0.9999999999999999}),
    "hot": ({"hot": 125_000} | {f"s{k:02d}": 13_158 for k in range(19)}, None),
    "tiny": ({"a": 200_000, "b": 100_000, "c": 50}, {"a": 2.0, "b": 1.0, "c": 3e-5}),
    "left over": ({"a": 30_000, "b": 2_000, "c": 20_000}, {"a": 1.0, "b": 1e-6, "c": 3.1e-6}),
}


@pytest.mark.parametrize("case", CASES)
def test_real_targets_are_kept_within_one_block_at_many_slots(case):
    blocks, targets = CASES[case]
    targets = targets or M.default_targets(blocks)
    plan = M.phases(blocks, M.whole_parts(targets))
    exact = {s: Fraction(w) if isinstance(w, str) else Fraction(str(w)) for s, w in targets.items()}
    assert farthest(blocks, exact, plan) < 1
    found = [(s, x) for _, _, own in places_of(blocks, plan) for s, slots in own.items() for x in slots]
    assert sorted(x for _, x in found) == list(range(sum(blocks.values()))) and Counter(s for s, _ in found) == Counter(blocks)


def test_default_plan_does_not_grow_with_the_corpus():
    numbers = []
    for scale in (10**6, 10**9):
        blocks = {"hot": 10 * scale} | {f"s{k}": (k + 1) * scale for k in range(9)}
        numbers.append(sum(len(slots) for ph in M.phases(blocks, M.whole_parts(M.default_targets(blocks))) for _, _, slots in ph["sources"].values()))
    assert numbers[0] == numbers[1] <= M.DEFAULT_PARTS * len(blocks) ** 2
    with pytest.raises(ValueError, match="numbers"):
        M.phases({"a": 10**9, "b": 10**9}, M.whole_parts({"a": 1.0000001, "b": 1}), limit=1000)
    with pytest.raises(ValueError, match="positive"):
        M.whole_parts({"a": 0})


def test_columns_of_the_caller_are_kept(spark):
    names = ("h", "s", "r", "i", "__h", "__s", "__r", "__i", "row", "start", "q", "a", "used", "until", "slots", "slot", "position", "block_no", "before", "n")
    docs = spark.createDataFrame([(k, f"t{k}", "x", *names) for k in range(40)], "doc_id long, text string, source string, " + ", ".join(f"{n} string" for n in names))
    out = M.mix(docs)
    assert out.columns == [n + "_" if n in ("slot", "position", "block_no") else n for n in docs.columns] + ["block_no", "slot", "position"]
    assert all(r[n + "_" if n in ("slot", "position", "block_no") else n] == n for r in out.collect() for n in names)
