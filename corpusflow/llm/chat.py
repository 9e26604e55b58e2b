"""Chat formatting: a sandboxed template language compiled to Python closures.

The language has text, ``{{ expression }}``, ``{% if %}`` with ``elif`` and ``else``,
``{% for x in xs %}``, ``{% set x = ... %}`` and ``{% generation %}``. Expressions have
literals, names, ``a.b`` and ``a['b']`` on mappings, ``~`` and ``+``, comparisons, ``in``,
``and``, ``or``, ``not``, and the filters ``escape``, ``trim``, ``upper``, ``lower``,
``length`` and ``default(x)``. There is no call, no attribute of a Python object and no
import, so a template reaches nothing but the values it is given.

A template is parsed to a syntax tree, constant parts are folded, and each node becomes a
closure that yields pieces of output; pieces inside ``{% generation %}`` carry the loss
mask. Conversations are streamed: a turn at a time goes through the template and through
the reader that checks it, so memory doesn't depend on a conversation's length.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterable, Iterator
from typing import Any

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Marks of the default template. Texts can't hold one unescaped: see ``escape``.
MARKS = ("<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>", "<<ROLE>>", "<</ROLE>>")
TEMPLATE = """\
{%- for m in messages -%}
{%- if m.role == 'user' -%}<s>[INST]{{ m.content | escape }}[/INST]
{%- elif m.role == 'assistant' -%}{% generation %}{{ m.content | escape }}{% endgeneration %}</s>
{%- elif m.role == 'system' -%}<<SYS>>{{ m.content | escape }}<</SYS>>
{%- else -%}<<ROLE>>{{ m.role | escape }}<</ROLE>>{{ m.content | escape }}<</SYS>>
{%- endif -%}
{%- endfor -%}
"""


class TemplateError(ValueError):
    """A template that can't be parsed, or a value that it may not reach."""


def escape(text: str) -> str:
    """Put a backslash before every backslash, ``<`` and ``[``: no mark is left, and ``unescape`` reverses it."""
    return re.sub(r"([\\<\[])", r"\\\1", text)


def unescape(text: str) -> str:
    return re.sub(r"\\(.)", r"\1", text, flags=re.S)


# -- lexer and parser -------------------------------------------------------------------

_TAG = re.compile(r"\{\{-?|\{%-?|\{#-?")
_TOKEN = re.compile(r"\s*(?:(?P<num>\d+(?:\.\d+)?)|(?P<str>'(?:[^'\\]|\\.)*'|\"(?:[^\"\\]|\\.)*\")|(?P<name>[A-Za-z_]\w*)|(?P<op>==|!=|<=|>=|[-+~|.,()\[\]<>=%*]))")
_ESCAPES = {"n": "\n", "t": "\t", "\\": "\\", "'": "'", '"': '"'}
_CLOSERS = {"for": ("endfor",), "if": ("elif", "else", "endif"), "generation": ("endgeneration",)}
_FILTERS: dict[str, Callable[..., Any]] = {
    "escape": escape,
    "trim": lambda x: x.strip(),
    "upper": lambda x: x.upper(),
    "lower": lambda x: x.lower(),
    "length": len,
    "default": lambda x, y: y if x is None or x == "" else x,
}


def _split(source: str) -> list[tuple[str, str]]:
    """Parts of a template: ("text", s), ("expr", s) and ("tag", s); ``-`` at a delimiter trims white space there."""
    out: list[tuple[str, str]] = []
    at, strip = 0, False
    while at < len(source):
        m = _TAG.search(source, at)
        text = source[at : m.start()] if m else source[at:]
        text = text.lstrip() if strip else text
        if m and m.group().endswith("-"):
            text = text.rstrip()
        if text:
            out.append(("text", text))
        if not m:
            break
        close = {"{{": "}}", "{%": "%}", "{#": "#}"}[m.group()[:2]]
        end = _closing(source, m.end(), close)
        body = source[m.end() : end]
        strip = body.endswith("-")
        body = body[:-1] if strip else body
        if close != "#}":
            out.append(("expr" if close == "}}" else "tag", body.strip()))
        at = end + 2
    return out


def _closing(source: str, at: int, close: str) -> int:
    """Where a delimiter closes, outside of string literals."""
    quote = None
    while at < len(source):
        c = source[at]
        if quote:
            at += c == "\\"
            quote = None if c == quote else quote
        elif close != "#}" and c in "'\"":
            quote = c
        elif source.startswith(close, at):
            return at
        at += 1
    raise TemplateError(f"no {close}")


class _Expressions:
    """Recursive descent over one expression's tokens; nodes are tuples."""

    def __init__(self, source: str) -> None:
        self.tokens: list[tuple[str, str]] = []
        at = 0
        while source[at:].strip():
            m = _TOKEN.match(source, at)
            if not m:
                raise TemplateError(f"unexpected {source[at:].strip()[:10]!r}")
            self.tokens.append((m.lastgroup or "", m.group(m.lastgroup or 0)))
            at = m.end()
        self.at = 0

    def peek(self, *values: str) -> bool:
        return self.at < len(self.tokens) and self.tokens[self.at][0] != "str" and self.tokens[self.at][1] in values

    def take(self, *values: str) -> str:
        if values and not self.peek(*values):
            raise TemplateError(f"expected {' or '.join(values)}")
        if self.at >= len(self.tokens):
            raise TemplateError("the expression ends early")
        self.at += 1
        return self.tokens[self.at - 1][1]

    def whole(self) -> tuple:
        node = self.either()
        if self.at != len(self.tokens):
            raise TemplateError(f"unexpected {self.tokens[self.at][1]!r}")
        return node

    def either(self) -> tuple:
        node = self.both()
        while self.peek("or"):
            self.take()
            node = ("or", node, self.both())
        return node

    def both(self) -> tuple:
        node = self.negated()
        while self.peek("and"):
            self.take()
            node = ("and", node, self.negated())
        return node

    def negated(self) -> tuple:
        if self.peek("not"):
            self.take()
            return ("not", self.negated())
        return self.compared()

    def compared(self) -> tuple:
        node = self.joined()
        while self.peek("==", "!=", "<", ">", "<=", ">=", "in"):
            node = ("compare", self.take(), node, self.joined())
        return node

    def joined(self) -> tuple:
        return self._chain(lambda: self._chain(lambda: self._chain(self.filtered, "*", "%"), "+", "-"), "~")

    def _chain(self, inner: Callable[[], tuple], *operators: str) -> tuple:
        node = inner()
        while self.peek(*operators):
            node = ("binary", self.take(), node, inner())
        return node

    def filtered(self) -> tuple:
        node = self.path()
        while self.peek("|"):
            self.take()
            name, args = self.take(), []
            if name not in _FILTERS:
                raise TemplateError(f"no filter {name!r}")
            if self.peek("("):
                self.take()
                while not self.peek(")"):
                    args.append(self.either())
                    if self.peek(","):
                        self.take()
                self.take(")")
            node = ("filter", name, node, *args)
        return node

    def path(self) -> tuple:
        node = self.atom()
        while self.peek(".", "["):
            if self.take() == ".":
                node = ("item", node, ("const", self.take()))
            else:
                node = ("item", node, self.either())
                self.take("]")
        return node

    def atom(self) -> tuple:
        if self.peek("("):
            self.take()
            node = self.either()
            self.take(")")
            return node
        if self.at >= len(self.tokens):
            raise TemplateError("the expression ends early")
        kind, value = self.tokens[self.at]
        self.at += 1
        if kind == "num":
            return ("const", float(value) if "." in value else int(value))
        if kind == "str":
            return ("const", re.sub(r"\\(.)", lambda m: _ESCAPES.get(m[1], m[0]), value[1:-1]))
        if kind == "name":
            words = {"true": True, "false": False, "none": None, "True": True, "False": False, "None": None}
            return ("const", words[value]) if value in words else ("name", value)
        raise TemplateError(f"unexpected {value!r}")


def parse(source: str) -> tuple:
    """The syntax tree of a template: nested ``("block", nodes)``."""
    parts = _split(source)
    node, at, stop = _block(parts, 0, ())
    if stop:
        raise TemplateError(f"unexpected {stop}")
    return node


def _block(parts: list[tuple[str, str]], at: int, until: tuple[str, ...]) -> tuple[tuple, int, str]:
    nodes: list[tuple] = []
    while at < len(parts):
        kind, body = parts[at]
        at += 1
        if kind == "text":
            nodes.append(("emit", ("const", body)))
            continue
        if kind == "expr":
            nodes.append(("emit", _Expressions(body).whole()))
            continue
        word, _, rest = body.partition(" ")
        if word in until:
            return ("block", nodes), at, body
        if word == "for":
            m = re.fullmatch(r"\s*([A-Za-z_]\w*)\s+in\s+(.+)", rest, re.S)
            if not m:
                raise TemplateError("for needs `x in xs`")
            inner, at, _ = _block(parts, at, _CLOSERS["for"])
            nodes.append(("for", m[1], _Expressions(m[2]).whole(), inner))
        elif word == "if":
            cases, test = [], _Expressions(rest).whole()
            while True:
                inner, at, stop = _block(parts, at, _CLOSERS["if"])
                cases.append((test, inner))
                if stop.split()[0] == "endif":
                    break
                test = ("const", True) if stop.split()[0] == "else" else _Expressions(stop.partition(" ")[2]).whole()
            nodes.append(("if", cases))
        elif word == "generation":
            inner, at, _ = _block(parts, at, _CLOSERS["generation"])
            nodes.append(("generation", inner))
        elif word == "set":
            name, _, value = rest.partition("=")
            if not re.fullmatch(r"[A-Za-z_]\w*", name.strip()):
                raise TemplateError("set needs a name")
            nodes.append(("set", name.strip(), _Expressions(value).whole()))
        else:
            raise TemplateError(f"unknown or unexpected tag {word!r}")
    if until:
        raise TemplateError(f"no {until[-1]}")
    return ("block", nodes), at, ""


# -- folding and code generation --------------------------------------------------------


def fold(node: tuple) -> tuple:
    """The same tree with constant expressions computed, dead branches gone and adjacent texts joined."""
    kind = node[0]
    if kind in ("const", "name"):
        return node
    if kind == "block":
        out: list[tuple] = []
        for x in map(fold, node[1]):
            for y in x[1] if x[0] == "block" else [x]:
                if y[0] == "emit" and y[1][0] == "const" and out and out[-1][0] == "emit" and out[-1][1][0] == "const":
                    out[-1] = ("emit", ("const", _text(out[-1][1][1]) + _text(y[1][1])))
                else:
                    out.append(y)
        return ("block", out)
    if kind == "if":
        cases = []
        for test, inner in node[1]:
            test = fold(test)
            if test[0] != "const":
                cases.append((test, fold(inner)))
            elif test[1]:
                cases.append((test, fold(inner)))
                break
        if cases and cases[0][0][0] == "const":
            return cases[0][1]
        return ("if", cases) if cases else ("block", [])
    done = tuple(fold(x) if isinstance(x, tuple) else x for x in node)
    inputs = [x for x in done[1:] if isinstance(x, tuple)]
    if kind in ("or", "and", "not", "compare", "binary", "filter", "item") and all(x[0] == "const" for x in inputs):
        return ("const", _value(done)({}))
    return done


def _text(x: Any) -> str:
    return "" if x is None else x if isinstance(x, str) else str(x)


_COMPARE: dict[str, Callable[[Any, Any], bool]] = {
    "==": lambda a, b: a == b, "!=": lambda a, b: a != b, "<": lambda a, b: a < b, ">": lambda a, b: a > b,
    "<=": lambda a, b: a <= b, ">=": lambda a, b: a >= b, "in": lambda a, b: a in b,
}


def _binary(op: str, a: Any, b: Any) -> Any:
    if op == "~":
        return _text(a) + _text(b)
    numeric = isinstance(a, int | float) and isinstance(b, int | float)
    if not numeric and not (op == "+" and isinstance(a, str) and isinstance(b, str)):
        raise TemplateError(f"{op} doesn't take these values")
    return {"+": lambda: a + b, "-": lambda: a - b, "*": lambda: a * b, "%": lambda: a % b}[op]()


def _item(holder: Any, key: Any) -> Any:
    """Only mappings, and sequences by number, have items; objects have none."""
    if isinstance(holder, dict):
        return holder.get(key)
    if isinstance(holder, list | tuple | str) and isinstance(key, int):
        return holder[key]
    if holder is None:
        return None
    raise TemplateError(f"{type(holder).__name__} has no items here")


def _value(node: tuple) -> Callable[[dict], Any]:
    """A closure for an expression."""
    kind = node[0]
    if kind == "const":
        return lambda env, x=node[1]: x
    if kind == "name":
        return lambda env, x=node[1]: env.get(x)
    if kind == "not":
        one = _value(node[1])
        return lambda env: not one(env)
    if kind in ("or", "and"):
        a, b = _value(node[1]), _value(node[2])
        return (lambda env: a(env) or b(env)) if kind == "or" else (lambda env: a(env) and b(env))
    if kind == "item":
        a, b = _value(node[1]), _value(node[2])
        return lambda env: _item(a(env), b(env))
    if kind == "filter":
        f, args = _FILTERS[node[1]], [_value(x) for x in node[2:]]
        return lambda env: f(*(x(env) for x in args))
    a, b = _value(node[2]), _value(node[3])
    if kind == "compare":
        return lambda env, f=_COMPARE[node[1]]: f(a(env), b(env))
    return lambda env, op=node[1]: _binary(op, a(env), b(env))


Piece = tuple[str, bool]


def _writer(node: tuple, generated: bool) -> Callable[[dict], Iterator[Piece]]:
    """A closure that yields a node's pieces of output, each with its loss mask."""
    kind = node[0]
    if kind == "emit":
        value = _value(node[1])

        def emit(env: dict) -> Iterator[Piece]:
            yield _text(value(env)), generated

        return emit
    if kind == "set":
        value = _value(node[2])

        def assign(env: dict) -> Iterator[Piece]:
            env[node[1]] = value(env)
            return iter(())

        return assign
    if kind == "block":
        inner = [_writer(x, generated) for x in node[1]]

        def block(env: dict) -> Iterator[Piece]:
            for f in inner:
                yield from f(env)

        return block
    if kind == "generation":
        return _writer(node[1], True)
    if kind == "if":
        cases = [(_value(t), _writer(b, generated)) for t, b in node[1]]

        def choose(env: dict) -> Iterator[Piece]:
            for test, f in cases:
                if test(env):
                    yield from f(env)
                    return

        return choose
    values, inner_ = _value(node[2]), _writer(node[3], generated)

    def loop(env: dict) -> Iterator[Piece]:
        # one item ahead, so that the values may be a stream and `loop.last` still known
        stream, index, absent = iter(values(env) or ()), 0, object()
        item = next(stream, absent)
        while item is not absent:
            after = next(stream, absent)
            own = env | {node[1]: item, "loop": {"index": index + 1, "index0": index, "first": not index, "last": after is absent}}
            yield from inner_(own)
            item, index = after, index + 1

    return loop


def compile_template(source: str) -> Callable[[Iterable[dict]], Iterator[Piece]]:
    """A function from messages (a list or a stream of mappings) to pieces of output with their loss mask."""
    write = _writer(fold(parse(source)), False)
    return lambda messages: write({"messages": messages})


# -- reading back -----------------------------------------------------------------------

_READ = re.compile(r"\\.|" + "|".join(re.escape(m) for m in sorted(MARKS, key=len, reverse=True)), re.S)
_OPENS = {"[INST]": "user", "<<SYS>>": "system"}


class Reader:
    """Reads turns of the default template back from pieces of output, a turn at a time.

    Only marks and escapes are interpreted; the loss mask gives the generated text and the
    template's marks give roles and texts.
    """

    def __init__(self) -> None:
        self.held = ""
        self.role: str | None = None
        self.other: str | None = None
        self.turns = self.chars = self.loss_chars = 0
        self.turn_hash, self.loss_hash = hashlib.sha256(), hashlib.sha256()

    def feed(self, piece: Piece) -> None:
        text, generated = piece
        self.chars += len(text)
        if generated:
            plain = unescape(text)
            self.loss_chars += len(plain)
            self.loss_hash.update(plain.encode("utf-8", "surrogatepass"))
        self.held += text
        if not generated:
            self._read()

    def _turn(self, role: str, text: str) -> None:
        self.turns += 1
        self.turn_hash.update(f"{role}\n{text}\n".encode("utf-8", "surrogatepass"))

    def _read(self) -> None:
        """Take all whole turns from what is held."""
        begin = at = 0
        while m := _READ.search(self.held, at):
            mark, at = m.group(), m.end()
            if mark[0] == "\\":
                continue
            plain = unescape(self.held[begin : m.start()])
            if mark == "<s>":
                pass
            elif mark in _OPENS:
                self.role = _OPENS[mark]
            elif mark == "<<ROLE>>":
                self.role = "role"
            elif mark == "<</ROLE>>":
                self.role, self.other = "other", plain
            elif mark == "</s>":
                self._turn("assistant", plain)
                self.role = None
            else:
                self._turn(self.other or "" if self.role == "other" else self.role or "", plain)
                self.role = self.other = None
            begin = at
        self.held = self.held[begin:]

    def row(self) -> list:
        if self.held:
            raise ValueError("the output ends inside a turn")
        return [self.turns, self.turn_hash.hexdigest(), self.loss_chars, self.loss_hash.hexdigest(), self.chars]


def render(messages: Iterable[dict], template: str = TEMPLATE) -> tuple[str, list[tuple[int, int]]]:
    """The formatted text of a conversation and the spans (start, end, in code points) under the loss mask."""
    out, spans, at = [], [], 0
    for text, generated in compile_template(template)(messages):
        if generated and text:
            spans.append((at, at + len(text)))
        out.append(text)
        at += len(text)
    return "".join(out), spans


_OUT = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"


def _groups(batches: Iterator[pd.DataFrame]) -> Iterator[tuple]:
    """Conversations of a sorted stream as (id, stream of messages); a stream is used up before the next begins."""
    rows = (r for pdf in batches for r in zip(pdf["conv_id"], pdf["role"], pdf["text"], strict=True))
    ahead = next(rows, None)

    def messages(own: Any) -> Iterator[dict]:
        nonlocal ahead
        while ahead is not None and ahead[0] == own:
            now = ahead
            ahead = next(rows, None)
            yield {"role": now[1] or "", "content": now[2] or ""}

    while ahead is not None:
        own = ahead[0]
        yield own, messages(own)


def format_conversations(rows: DataFrame, template: str = TEMPLATE) -> DataFrame:
    """Format each conversation (its rows by turn) and read it back: one row for each conv_id.

    Null texts and roles count as empty; ties of a turn go by role, then text, and repeated
    rows are turns of their own; a null turn comes first; rows without a conv_id are one
    conversation of id null. An empty table gives an empty result; other columns are ignored.
    Rows of a conversation meet in one task, sorted, and are streamed through it, so even a
    conversation that holds a third of all rows needs the memory of two turns.
    """
    write = compile_template(template)

    def run(batches):
        out = []
        for own, messages in _groups(batches):
            reader = Reader()
            for piece in write(messages):
                reader.feed(piece)
            out.append([own or None, *reader.row()])
            if len(out) >= 5000:
                yield pd.DataFrame(out, columns=names)
                out = []
        yield pd.DataFrame(out, columns=names)

    names = ["conv_id", *(x.split()[0] for x in _OUT.split(", ")[1:])]
    own = rows.select(F.coalesce(F.col("conv_id").cast("string"), F.lit("")).alias("conv_id"), F.col("turn").cast("long").alias("turn"), F.col("role").cast("string").alias("role"), F.col("text").cast("string").alias("text"))
    dealt = own.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")
    got = dealt.select("conv_id", "role", "text").mapInPandas(run, _OUT.replace("conv_id long", "conv_id string"))
    return got.withColumn("conv_id", F.col("conv_id").cast("long"))
