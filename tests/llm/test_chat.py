import hashlib
import random

import pytest

from corpusflow.llm import chat as C


def plain(template, **values):
    return "".join(t for t, _ in C._writer(C.fold(C.parse(template)), False)(dict(values)))


def test_language():
    assert plain("a{{ x ~ 1 + 2 * 3 }}b", x="q") == "aq7b"
    assert plain("{% if n > 2 and not z %}big{% elif n == 2 %}two{% else %}small{% endif %}", n=2, z=False) == "two"
    assert plain("{% for x in xs %}{{ loop.index }}{{ x }}{% if not loop.last %},{% endif %}{% endfor %}", xs=iter("abc")) == "1a,2b,3c"
    assert plain("{% set y = x | upper -%}  {{ y }}  {#- note -#} z", x="q") == "Qz"
    assert plain("{{ m['k'] | default('none') }}{{ m.j | length }}", m={"j": "four"}) == "none4"
    assert plain("{{ '}}' }}{{ \"a'b\" }}") == "}}a'b"


def test_constants_are_folded():
    assert C.fold(C.parse("a{{ 'b' ~ 'c' | upper }}d{% if 1 > 2 %}no{% else %}yes{% endif %}")) == ("block", [("emit", ("const", "abCdyes"))])
    assert C.fold(C.parse("{% if false %}x{% endif %}")) == ("block", [])


def test_sandbox():
    with pytest.raises(C.TemplateError):
        plain("{{ x.__class__ }}", x=3)
    with pytest.raises(C.TemplateError):
        plain("{{ x.a.b }}", x={"a": object()})
    for bad in ("{{ f() }}", "{{ x", "{% if x %}", "{% endif %}", "{% import os %}", "{{ x | eval }}", "{% for x %}{% endfor %}", "{{ }}", "{{ a b }}", "{{ 'x' * 9 }}"):
        with pytest.raises(C.TemplateError):
            plain(bad, x=1, f=len)


def test_escape_is_reversible_and_hides_marks():
    rng = random.Random(1)
    for _ in range(500):
        t = "".join(rng.choice(["<", "[", "\\", "a", "]", ">", "/", *C.MARKS]) for _ in range(rng.randint(0, 12)))
        e = C.escape(t)
        assert C.unescape(e) == t
        bare = __import__("re").sub(r"\\.", "", e, flags=16)
        assert not any(m in bare for m in C.MARKS)


def digest(turns):
    return hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in turns).encode()).hexdigest()


def test_reads_back_what_was_written():
    rng = random.Random(2)
    for _ in range(200):
        turns = [(rng.choice(["user", "assistant", "system", "tool", "", "<s>"]), "".join(rng.choice(["\\", "x", " ", "\n", *C.MARKS]) for _ in range(rng.randint(0, 6)))) for _ in range(rng.randint(0, 6))]
        reader = C.Reader()
        for piece in C.compile_template(C.TEMPLATE)([{"role": r, "content": t} for r, t in turns]):
            reader.feed(piece)
        text, spans = C.render([{"role": r, "content": t} for r, t in turns])
        said = "".join(t for r, t in turns if r == "assistant")
        assert reader.row() == [len(turns), digest(turns), len(said), hashlib.sha256(said.encode()).hexdigest(), len(text)]
        assert C.unescape("".join(text[a:b] for a, b in spans)) == said


def test_whole_table(spark, small):
    rows = spark.read.parquet(f"{small}/conversations.parquet")
    got = {r["conv_id"]: r for r in C.format_conversations(rows).collect()}
    by = {}
    for r in rows.orderBy("conv_id", "turn").collect():
        by.setdefault(r["conv_id"], []).append((r["role"], r["text"] or ""))
    assert set(got) == set(by)
    for k, turns in by.items():
        said = "".join(t for r, t in turns if r == "assistant")
        assert (got[k]["n_turns"], got[k]["turns_sha256"], got[k]["loss_chars"], got[k]["loss_sha256"]) == (len(turns), digest(turns), len(said), hashlib.sha256(said.encode()).hexdigest())


def test_odd_rows(spark):
    rows = [(1, 0, "user", None), (1, 0, "user", None), (1, 1, None, "x"), (None, 0, "assistant", "y"), (2, None, "assistant", "b"), (2, 0, "assistant", "a"), (3, 0, "assistant", "z" * 300_000)]
    df = spark.createDataFrame([(*r, "q") for r in rows], "conv_id long, turn long, role string, text string, n_turns string")
    got = {r["conv_id"]: r for r in C.format_conversations(df).collect()}
    assert got[1]["n_turns"] == 3 and got[1]["turns_sha256"] == digest([("user", ""), ("user", ""), ("", "x")])
    assert got[None]["loss_chars"] == 1 and got[2]["loss_sha256"] == hashlib.sha256(b"ba").hexdigest() and got[3]["loss_chars"] == 300_000
    assert C.format_conversations(df.limit(0)).count() == 0
