import itertools
import re

from corpusflow.llm import licenses
from corpusflow.llm.license_rules import rules


def words_of(text):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower)


def brute(text):
    """All rules at all places, then suppression by comparing every pair of intervals."""
    w = words_of(text)
    base = [(i, label) for phrase, label in licenses.BASE for i in range(len(w)) if w[i : i + len(phrase.split())] == phrase.split()]
    joined = f" {' '.join(w)} "
    hits = []
    for n, priority, label, keyword, pattern in rules():
        if keyword in w:
            for m in re.finditer(pattern, joined):
                hits.append((joined[: m.start()].count(" "), joined[: m.end()].count(" "), priority, n, label))
    kept = [h for h in hits if not any(g != h and g[0] <= h[0] and h[1] <= g[1] and g[2] >= h[2] and ((g[0], g[1]) != (h[0], h[1]) or g[2] > h[2] or g[3] < h[3]) for g in hits)]
    names = {label for _, label in base}
    starts = [i for i, _ in base]
    return len(w), len(base), min(starts, default=None), max(starts, default=None), ",".join(sorted(names)), ",".join(sorted(names | {h[4] for h in kept})), sorted((h[0], h[1], h[2], h[3], h[4]) for h in kept)


TEXTS = [
    "Licensed under the Apache License, Version 2.0.",
    "MIT license MIT License mit-license: MIT\nLICENSE apache license",
    "This work is licensed under the GNU General Public License, version 3. Also GNU Lesser General Public License v2.1",
    "SPDX-License-Identifier: GPL-2.0-or-later AND CC-BY-SA-4.0",
    "CC BY-NC 4.0; all rights reserved; dual licensed; public domain",
    "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and so on",
    "mitlicense amit license ÄMIT license İ mit licensé",
    "general public license " * 40,
    "you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 3 of the License, or (at your option) any later version",
    "Neither the name of Foo Bar Inc. nor the names of its contributors may be used to endorse or promote products", "Unauthorized copying of this file, via any medium, is strictly prohibited. Proprietary and confidential",
    "nothing", "", None, "  ..!! ", "licence 漢字 bsd",
]


def test_matches_brute_force(spark):
    df = spark.createDataFrame([(k, t) for k, t in enumerate(TEXTS)], "doc_id long, text string")
    for r in licenses.scan(df).collect():
        got = (r["n_words"], r["n_base"], r["first_word"], r["last_word"], r["base_labels"], r["labels"], sorted(tuple(d) for d in r["detections"]))
        assert got == brute(TEXTS[r["doc_id"]]), TEXTS[r["doc_id"]]
        assert 0 <= r["score"] <= 1 and (r["score"] == 0) == (r["labels"] == "")


def test_whole_table_matches_brute_force(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet").select("doc_id", "text")
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    for r in licenses.scan(docs).collect():
        assert (r["n_words"], r["n_base"], r["first_word"], r["last_word"], r["base_labels"], r["labels"]) == brute(texts[r["doc_id"]])[:6]


def test_sql_finds_the_same(spark):
    import duckdb
    import pandas as pd

    con = duckdb.connect()
    con.register("texts", pd.DataFrame({"doc_id": range(len(TEXTS)), "text": TEXTS}))
    want = con.sql(licenses.oracle_sql("texts")).fetchall()
    df = spark.createDataFrame(list(enumerate(TEXTS)), "doc_id long, text string")
    assert sorted(map(str, want)) == sorted(str(tuple(r)) for r in licenses.scan(df).drop("detections").collect())


def test_rules_are_sound():
    table = rules()
    assert len(table) > 200
    for _, priority, _, keyword, pattern in table:
        re.compile(pattern)
        assert 1 <= priority <= 4 and re.fullmatch(r"[a-z0-9]+", keyword)


def test_odd_rows(spark, odd, none):
    out = licenses.scan(odd).collect()
    assert len(out) == odd.count() and {r["n_words"] for r in out if r["doc_id"] == 5} == {120_000}
    assert licenses.scan(none).count() == 0


def test_plan_has_no_python(spark, small):
    plan = licenses.scan(spark.read.parquet(f"{small}/documents.parquet"))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Exchange" not in plan


def alternatives(pattern):
    """A text for every choice of a pattern's groups, options and listed characters; one digit or word for any."""
    body = re.sub(r"\\d", "7", re.sub(r"\(\?:\[\^ \]\+ \)\{\d+,\d+\}\?", "any ", pattern.removesuffix("(?= )")))
    groups = re.compile(r"\(\?:([^()]*)\)(\?)?")
    out, todo = [], [body]
    while todo:
        x = todo.pop()
        if m := groups.search(x):
            todo += [x[: m.start()] + part + x[m.end() :] for part in [*m[1].split("|"), *([""] if m[2] else [])]]
            continue
        parts = re.findall(r"(\[[^]]*\]|.)(\?)?", x)
        out += ["".join(p) for p in itertools.product(*[[*(c[1:-1] if len(c) > 1 else c), *([""] if q else [])] for c, q in parts])]
    return sorted(set(out))


def test_gate_loses_no_alternative(spark):
    table = rules()
    texts = sorted({t.strip() for r in table for t in alternatives(r[4])})
    assert len(texts) > 900
    hits = {}
    for t in texts:
        joined = f" {t} "
        hits[t] = [(joined[: m.start()].count(" "), joined[: m.end()].count(" "), p, n, label) for n, p, label, _, x in table for m in re.finditer(x, joined)]
    assert all(hits.values())
    for r in table:
        assert all(re.search(r[4], f" {t.strip()} ") and r[3] in t.split() for t in alternatives(r[4])), r
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for r in licenses.scan(df).collect():
        own = hits[texts[r["doc_id"]]]
        kept = [h for h in own if not any(g != h and g[0] <= h[0] and h[1] <= g[1] and g[2] >= h[2] and ((g[0], g[1]) != (h[0], h[1]) or g[2] > h[2] or g[3] < h[3]) for g in own)]
        assert sorted(tuple(d) for d in r["detections"]) == sorted(kept), texts[r["doc_id"]]
    named = {"Q Public License": "qpl-1.0", "for noncommercial use only": "non-commercial", "End-User License Agreement": "proprietary"}
    out = {r["text"]: r["labels"] for r in licenses.scan(spark.createDataFrame([(t, t) for t in named], "doc_id string, text string")).withColumnRenamed("doc_id", "text").collect()}
    assert out == named


def test_many_places_in_one_text(spark):
    """Sums and sweeps over several blocks of places: the same as counted one by one, and near copies of a text many times over."""
    from corpusflow.llm import licenses

    text = "permission is hereby granted free of charge to any person under the apache license version 2 "
    n = 3 * licenses.BLOCK + 5
    one = licenses.scan(spark.createDataFrame([(1, text)], "doc_id long, text string")).first()
    many = licenses.scan(spark.createDataFrame([(1, text * n)], "doc_id long, text string")).first()
    words = one["n_words"]
    assert many["n_words"] == n * words and many["n_base"] == n and many["last_word"] == (n - 1) * words + one["last_word"]
    want = [(d["first"] + k * words, d["end"] + k * words, d["priority"], d["rule"], d["label"]) for k in range(n) for d in one["detections"]]
    assert [tuple(d) for d in many["detections"]] == want
