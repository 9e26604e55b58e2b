from __future__ import annotations

import hashlib
import json
import re
import unicodedata
from fractions import Fraction

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from corpusflow.functions import catalogs, hashing, numbers, text


def one(spark, column, **values):
    df = spark.createDataFrame([tuple(values.values())], list(values)) if values else spark.range(1)
    return df.select(column.alias("x")).first()["x"]


def test_buckets_and_splits(spark):
    rows = [str(k) for k in range(500)]
    got = spark.createDataFrame([(r,) for r in rows], "g string").select("g", hashing.bucket(hashing.sha(hashing.SEED, F.col("g")), 10_000).alias("b"), hashing.split_of(F.col("g")).alias("s"), hashing.planned_turns(F.col("g")).alias("t")).collect()
    for r in got:
        h8 = lambda x: int.from_bytes(hashlib.sha256(x.encode()).digest()[:8], "big")
        b = h8(f"{hashing.SEED}:{r['g']}") % 10_000
        assert r["b"] == b and r["s"] == ("train" if b < 9000 else "development" if b < 9500 else "test")
        assert r["t"] == hashing.TURN_CHOICES[h8(f"{hashing.SEED}:{r['g']}:turn-count") % 11]


def test_canonical_json(spark):
    got = one(spark, hashing.json_column(b=F.col("b"), a=F.col("a"), c=F.lit(None).cast("string")), a='q"é\n🙂', b=3)
    assert got == hashing.canonical_json({"a": 'q"é\n🙂', "b": 3, "c": None})
    assert one(spark, hashing.json_udf(F.lit('{"b": 1e-5, "a": [1.0, 2]}'))) == '{"a":[1.0,2],"b":1e-05}'
    with pytest.raises(ValueError):
        hashing.canonical_json({"a": float("nan")})


def test_hex(spark):
    for value, ok in (("0123456789abcdef", True), ("0123456789ABCDEF", False), ("0123456789abcde", False), ("0123456789abcdef\n", False)):
        assert one(spark, hashing.is_hex(F.col("v"), 16), v=value) is ok


def test_catalogs(spark):
    assert len(catalogs.tasks()) == 24 and len(catalogs.rubric()) == 28 and len(catalogs.capabilities()) == 20
    assert catalogs.tasks()[20][2] == "grounded_calculation" and catalogs.rubric_table(spark, True).count() == 29


STRICT = [('{"a":1}', None), ('{"a":1,"a":2}', "DUPLICATE_JSON_KEY"), ('{"a":{"b":1,"b":1}}', "DUPLICATE_JSON_KEY"), ('{"a":NaN}', "NON_FINITE_JSON_NUMBER"), ("[1]", "JSON_ROOT_NOT_OBJECT"), ('{"a":1e999}', "NON_FINITE_JSON_NUMBER"), ('{"a":[{"b":-1e400}]}', "NON_FINITE_JSON_NUMBER"), ("[1e999]", "JSON_ROOT_NOT_OBJECT"), ('{"a":1} x', "INVALID_JSON"), ("", "INVALID_JSON"), (None, "INVALID_JSON")]


def test_strict_json(spark):
    df = spark.createDataFrame([(k, p) for k, (p, _) in enumerate(STRICT)], "k int, p string")
    got = {r["k"]: r["e"] for r in df.select("k", text.strict_json_error("p").alias("e")).collect()}
    assert got == {k: e for k, (_, e) in enumerate(STRICT)}


def test_close_json():
    assert text.close_json('{"a":[1,2') == '{"a":[1,2]}' and text.close_json('{"a":{"b":"}"') == '{"a":{"b":"}"}}'
    assert text.close_json('{"a":"x') is None and text.close_json('{"a":1]') is None and text.close_json("[1") is None
    assert text.close_json('{"a":' + "[" * 9) is None and text.close_json('{"a":1}  ') == '{"a":1}'


def test_tokens_follow_python(spark):
    texts = ['He said "yes", didn\'t he?', "日本語「括弧」です。", "7", "", "  a\tb_c  ", "É—ñ ½ x²", "a..b"]
    df = spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "k int, t string")
    for r in df.select("k", text.tokens(F.col("t")).alias("x")).collect():
        want = [(n, m.group(), m.start(), m.end()) for n, m in enumerate(re.finditer(r"\w+|[^\w\s]", texts[r["k"]]))]
        assert [tuple(x) for x in r["x"]] == want


def test_spans(spark):
    t = "one two, three"
    found = text.tokens(F.col("t"))
    assert tuple(one(spark, text.bind_span(F.col("t"), found, F.lit(1), F.lit(3)), t=t)) == ("two,", 4, 8)
    for a, b in ((-1, 2), (2, 2), (0, 9)):
        assert one(spark, text.bind_span(F.col("t"), found, F.lit(a), F.lit(b)), t=t) is None
    assert one(spark, text.occurs_once(F.lit("aaaa"), F.lit("aa"))) is None and one(spark, text.occurs_once(F.lit("baa"), F.lit("aa"))) == 1 and one(spark, text.occurs_once(F.lit("a"), F.lit(""))) is None
    fix = lambda whole, part, s: one(spark, text.repaired_span(F.lit(whole), F.lit(part), F.lit(s), F.lit(s + len(part))))
    assert fix("say yes now", "yes", 4) == 4 and fix("say yes now", "yes", 0) == 4 and fix("yes yes", "yes", 1) is None and fix("no", "yes", 0) is None


def test_questions_and_gates(spark):
    assert text.normalize_question("  ＷＨＡＴ  is\tit？ ！") == "what is it" and text.normalize_question("Straße") == "strasse"
    assert one(spark, text.has_letters(F.lit("12 é"))) and not one(spark, text.has_letters(F.lit("12 ½ !")))
    assert not one(spark, text.not_blank(F.lit(" 　\n"))) and one(spark, text.not_blank(F.lit("x")))
    assert one(spark, text.clean_output(F.lit("<|channel|>thought\n<|channel|>yes"))) == "yes" and one(spark, text.clean_output(F.lit("a <|channel>thought b"))) is None
    assert one(spark, text.clean_output(F.lit("plain"))) == "plain"
    assert one(spark, text.media_suffix(F.lit(None).cast("string"), F.lit("https://a/b.PNG?x=1"))) == ".png"
    assert one(spark, text.media_suffix(F.lit("text/html"), F.lit("https://a.png/b?c.png"))) is None
    assert one(spark, text.media_suffix(F.lit("image/webp"), F.lit("https://a/b.png"))) == ".webp"
    assert len(one(spark, text.joined_reason(F.array(F.lit("x" * 200), F.lit("y" * 200))))) == 240


LEXEMES = [("1,234.5", ".", ",", Fraction(12345, 10)), ("1 234", ".", " ", Fraction(1234)), ("１２.５", ".", None, Fraction(125, 10)), ("−3", ".", None, Fraction(-3)), ("1.234,5", ",", ".", Fraction(12345, 10)), (" +7 ", None, ",", Fraction(7))]
BAD = [("1e3", ".", None), ("1,2", ".", None), ("1,23.4", ".", ","), (".5", ".", None), ("5.", ".", None), ("1.2.3", ".", None), ("", ".", None), ("1", ".", "."), ("12,34,567", ".", ","), ("--1", ".", None)]


def test_lexemes():
    for value, d, g, want in LEXEMES:
        assert numbers.parse_lexeme(value, d, g) == want
    for value, d, g in BAD:
        with pytest.raises(numbers.Inexact):
            numbers.parse_lexeme(value, d, g)


@settings(max_examples=200, deadline=None)
@given(st.integers(-(10**40), 10**40), st.integers(0, 12))
def test_lexemes_are_exact(n, places):
    digits = str(abs(n)).rjust(places + 1, "0")
    shown = ("-" if n < 0 else "") + (digits[:-places] + "." + digits[-places:] if places else digits)
    assert numbers.parse_lexeme(shown) == Fraction(n, 10**places)


def test_arithmetic():
    f = Fraction
    assert numbers.calculate("add", [f(1), f(2), f(3)], ["m", "m", "m"]) == (f(6), "m")
    assert numbers.calculate("divide", [f(1), f(3)], ["m", "m"]) == (f(1, 3), None)
    assert numbers.calculate("divide", [f(1), f(3)], ["m", None]) == (f(1, 3), "m")
    assert numbers.calculate("multiply", [f(2), f(3)], [None, "m"]) == (f(6), "m")
    for op, v, u in (("add", [1], ["m"]), ("add", [1, 2], ["m", "s"]), ("subtract", [1, 2, 3], [None] * 3), ("multiply", [1, 2], ["m", "s"]), ("divide", [1, 0], [None, None]), ("divide", [1, 2], [None, "m"]), ("add", [1, 2], ["", ""]), ("power", [1, 2], [None, None])):
        with pytest.raises(numbers.Inexact):
            numbers.calculate(op, list(map(f, v)), u)


def test_every_misuse_has_its_code():
    f = Fraction
    cases = [
        ("add", [1], ["m"], "ADD_REQUIRES_TWO_OR_MORE"), ("add", [1, 2], ["m", "s"], "INCOMPATIBLE_UNITS"), ("subtract", [1, 2, 3], [None] * 3, "SUBTRACT_REQUIRES_TWO"),
        ("multiply", [1, 2], ["m", "s"], "UNSUPPORTED_COMPOUND_UNIT"), ("multiply", [1, 2], ["m", "m"], "UNSUPPORTED_COMPOUND_UNIT"), ("divide", [1, 0], [None, "m"], "INVALID_DIVISION"),
        ("divide", [1, 2], [None, "m"], "UNSUPPORTED_COMPOUND_UNIT"), ("divide", [1, 2], ["m", "s"], "UNSUPPORTED_COMPOUND_UNIT"), ("add", [1, 2], ["", ""], "INVALID_UNIT"), ("add", [1, 2], ["m"], "OPERAND_UNIT_MISMATCH"), ("add", [], [], "OPERAND_UNIT_MISMATCH"),
    ]
    for op, values, units, code in cases:
        with pytest.raises(numbers.Inexact) as e:
            numbers.calculate(op, list(map(f, values)), units)
        assert e.value.code == code, (op, units)
    codes = {"1e3": "NONNUMERIC_OR_UNDECLARED_PUNCTUATION", "": "INVALID_NUMERIC_LEXEME", "-": "INVALID_NUMERIC_LEXEME", ".5": "INVALID_NUMERIC_LEXEME", "1.2.3": "INVALID_NUMERIC_LEXEME", "12,34.5": "INVALID_DIGIT_GROUPING", "1.2,3": "NONNUMERIC_OR_UNDECLARED_PUNCTUATION", "+-1": "NONNUMERIC_OR_UNDECLARED_PUNCTUATION"}
    for lexeme, code in codes.items():
        with pytest.raises(numbers.Inexact) as e:
            numbers.parse_lexeme(lexeme, ".", ",")
        assert e.value.code == code, lexeme
    assert numbers.parse_lexeme("\u0967\u0968", None, ".") == 12


def test_folding_matches_python(spark):
    texts = ["ΑΣ ß x", "İstanbul  A"]
    got = [r[0] for r in spark.createDataFrame([(t,) for t in texts], "t string").select(text.folded("t")).collect()]
    assert got == [" ".join(t.casefold().split()) for t in texts]
    assert unicodedata.normalize("NFKC", "？") == "?" and json.loads("1") == 1


def test_what_the_jvm_proves_is_strict_and_hard_cases_go_to_python(spark):
    import random

    def want(p):
        try:
            text.strict_object("" if p is None else p)
        except text.RejectedJson as e:
            return e.code
        return None

    rng = random.Random(1)
    atoms = ['"a"', "1", "-0", "1e5", "1E999", "NaN", "-Infinity", "true", "tru", '"\\u0061"', '"\\x"', '"un', "{}", "[1,2]", '[{"a":1}]', '{"a":1}', "12345678901234567890", "01", ".5", '"\x01"', '"]}"', '"\\"}"', "'a'"]
    keys, tails = ['"a"', '"b"', '"a"', '"\\u0061"', "a", '"\\""'], ["", "", "", " ", "}", "{}", ' {"a":1}', "]", ",", "],[", "\u00a0"]
    rows = [None, "", "[1]", '{"a":"' + 'x\\"' * 50_000 + '"}']
    for _ in range(1500):
        body = ",".join(f"{rng.choice(keys)}:{rng.choice(atoms)}" for _ in range(rng.randint(0, 3)))
        rows.append(rng.choice(["", "", " ", "["]) + "{" + body + rng.choice(["}", "}", "", ",}"]) + rng.choice(tails))
    df = spark.createDataFrame(list(enumerate(rows)), "i long, p string")
    got = {r["i"]: (r["e"], r["plain"]) for r in df.select("i", text.strict_json_error("p").alias("e"), text.plainly_strict(df["p"]).alias("plain")).collect()}
    assert {i: e for i, (e, _) in got.items()} == {i: want(p) for i, p in enumerate(rows)}
    assert not any(plain for e, plain in got.values() if e is not None) and got[3][1]
    flat = spark.range(500).selectExpr("concat('{\"id\": ', id, ', \"words\": [\"a\", ', id, '], \"s\": \"x, {y}\"}') as p")
    assert flat.where(~text.plainly_strict(flat["p"])).count() == 0


def test_tokens_of_a_batch_are_not_held_as_python_objects():
    import tracemalloc

    import pyarrow as pa

    words = [" ".join(f"w{k}x{i}" for i in range(100)) for k in range(5000)]
    batch = pa.array([*words, None, ""])
    tracemalloc.start()
    out = text.tokens.func(batch)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 20_000_000
    assert len(out) == 5002 and out[5000].as_py() is None and out[5001].as_py() == []
    assert out[7].as_py()[99] == {"index": 99, "text": "w7x99", "start": words[7].index("w7x99"), "end": len(words[7])}
