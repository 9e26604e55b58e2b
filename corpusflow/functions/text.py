"""Text gates, tokens and spans, strict JSON. Offsets are code points, ends exclusive."""

from __future__ import annotations

import json
import math
import re
import unicodedata
from array import array
from typing import Any

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Fixed values.
TERMINAL = ".!?。！？ "
ECHO_LEAST = 80
REASON_LENGTH = 240
_TOKEN = re.compile(r"\w+|[^\w\s]")
#: Texts whose tokens are Python objects at a time.
_TEXTS = 64
_TOKENS = T.ArrayType(T.StructType([T.StructField("index", T.IntegerType()), T.StructField("text", T.StringType()), T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType())]))


class RejectedJson(ValueError):
    """A payload that isn't one strict JSON object; ``code`` says why."""

    def __init__(self, code: str, message: str) -> None:
        super().__init__(message)
        self.code = code


def strict_object(payload: str | bytes) -> dict[str, Any]:
    """One JSON object without repeated keys, NaN or infinities (numbers too large for a double among them) and without anything after it."""
    beyond: list[str] = []

    def pairs(items: list[tuple[str, Any]]) -> dict[str, Any]:
        out = dict(items)
        if len(out) != len(items):
            raise RejectedJson("DUPLICATE_JSON_KEY", "a key is repeated")
        return out

    def real(lexeme: str) -> float:
        value = float(lexeme)
        if math.isinf(value):
            beyond.append(lexeme)
        return value

    def constant(name: str) -> None:
        raise RejectedJson("NON_FINITE_JSON_NUMBER", name)

    try:
        value = json.loads(payload, object_pairs_hook=pairs, parse_constant=constant, parse_float=real)
    except RejectedJson:
        raise
    except (ValueError, UnicodeDecodeError) as e:
        raise RejectedJson("INVALID_JSON", str(e)) from e
    if not isinstance(value, dict):
        raise RejectedJson("JSON_ROOT_NOT_OBJECT", "the root isn't an object")
    if beyond:
        raise RejectedJson("NON_FINITE_JSON_NUMBER", beyond[0])
    return value


@F.pandas_udf(T.StringType())
def _strict_json_error(payloads: pd.Series) -> pd.Series:
    def code(payload: str | None) -> str | None:
        if payload is None:
            return "INVALID_JSON"
        try:
            strict_object(payload)
        except RejectedJson as e:
            return e.code
        return None

    return payloads.map(code, na_action=None).astype(object)


#: A string of JSON; and, with strings left out, one object of plain values and lists of these; numbers that may be too large.
_STRING = r'"[^"\\]*+(?:\\.[^"\\]*+)*+"'
_FLAT = r"^[ \t\r\n]*\{[^\[\]{}]*+(?:\[[^\[\]{}]*+\][^\[\]{}]*+)*+\}[ \t\r\n]*$"
_LARGE = r"[0-9.]{16}|[0-9][eE]"


def plainly_strict(payload: Column) -> Column:
    """True where built-in functions prove that a payload is a strict JSON object; false says nothing.

    With its strings left out the text is one object without objects inside, so nothing can
    stand after it; it parses, no key is twice, numbers are short and no character is
    written as a code.
    """
    frame = F.regexp_replace(payload, _STRING, "0")
    keys = F.json_object_keys(payload)
    proven = frame.rlike(_FLAT) & ~frame.rlike(_LARGE) & ~F.contains(payload, F.lit("\\u")) & (F.size(keys) == F.size(F.array_distinct(keys))) & F.try_parse_json(payload).isNotNull()
    return F.coalesce(proven, F.lit(False))


def strict_json_error(payload: Column | str) -> Column:
    """Null for a strict JSON object, else the code of what is wrong; null payloads are INVALID_JSON.

    Texts of payloads that are ``plainly_strict`` don't leave the JVM.
    """
    text = F.col(payload) if isinstance(payload, str) else payload
    plain = plainly_strict(text)
    return F.when(~plain, _strict_json_error(F.when(~plain, text)))


def close_json(content: str) -> str | None:
    """A JSON object cut off at its end, closed: up to eight open containers, not inside a string; else null."""
    text = content.rstrip()
    opened: list[str] = []
    bare = re.sub(r'"(?:[^"\\]|\\.)*"', "", text, flags=re.S)
    if '"' in bare:
        return None
    for c in bare:
        if c in "{[":
            opened.append("}" if c == "{" else "]")
        elif c in "}]" and (not opened or opened.pop() != c):
            return None
    if len(opened) > 8:
        return None
    whole = text + "".join(reversed(opened))
    try:
        return whole if isinstance(json.loads(whole), dict) else None
    except ValueError:
        return None


@F.pandas_udf(T.StringType())
def closed_json(contents: pd.Series) -> pd.Series:
    return contents.map(lambda x: None if x is None else close_json(x)).astype(object)


def normalize_question(text: str) -> str:
    """NFKC, casefold, white space to one space, no closing punctuation."""
    return " ".join(unicodedata.normalize("NFKC", text).casefold().split()).rstrip(TERMINAL)


@F.pandas_udf(T.StringType())
def normalized_question(texts: pd.Series) -> pd.Series:
    return texts.map(lambda x: None if x is None else normalize_question(x)).astype(object)


@F.pandas_udf(T.StringType())
def folded(texts: pd.Series) -> pd.Series:
    """Casefold with white space to one space: what prompts are compared in."""
    return texts.map(lambda x: None if x is None else " ".join(x.casefold().split())).astype(object)


def has_letters(text: Column) -> Column:
    """Whether a text has a Unicode letter, so that its language can be judged."""
    return text.rlike(r"\p{L}")


def not_blank(text: Column) -> Column:
    return F.coalesce(text.rlike(r"(?U)\S"), F.lit(False))


def _token_lists(texts: list[str | None]) -> pa.Array:
    """Tokens of a few texts, as one array of lists."""
    index, start, end, words, ends, none = array("i"), array("i"), array("i"), [], array("i", [0]), []
    for t in texts:
        for k, m in enumerate(_TOKEN.finditer(t or "")):
            index.append(k)
            start.append(m.start())
            end.append(m.end())
            words.append(m[0])
        ends.append(len(words))
        none.append(t is None)
    number = lambda a: pa.array(np.frombuffer(a, np.int32) if len(a) else [], pa.int32())
    fields = pa.StructArray.from_arrays([number(index), pa.array(words, pa.string()), number(start), number(end)], ["index", "text", "start", "end"])
    return pa.ListArray.from_arrays(number(ends), fields, mask=pa.array(none, pa.bool_()))


@F.arrow_udf(_TOKENS)
def tokens(texts: pa.Array) -> pa.Array:
    """Tokens with offsets: an array of (index, text, start, end), in one pass over a text; null texts have none (null).

    A batch is worked through in pieces, so that Python holds the tokens of a few texts at a time and Arrow the others.
    """
    lists = [_token_lists(texts.slice(k, _TEXTS).to_pylist()) for k in range(0, len(texts), _TEXTS)]
    return pa.concat_arrays(lists) if lists else _token_lists([])


def bind_span(text: Column, found: Column, first: Column, last: Column) -> Column:
    """Text, start and end of the tokens from ``first`` up to ``last`` (exclusive); null outside of the tokens."""
    begin, end = F.element_at(found, first + 1)["start"], F.element_at(found, last)["end"]
    valid = (first >= 0) & (first < last) & (last <= F.size(found))
    return F.when(valid, F.struct(text.substr(begin + 1, end - begin).alias("text"), begin.alias("start"), end.alias("end")))


def occurs_once(text: Column, part: Column) -> Column:
    """Start of a part that a text holds exactly once, overlaps counted; else null."""
    first = F.position(part, text)
    return F.when((F.length(part) > 0) & (first > 0) & (F.position(part, text, first + 1) == 0), first - 1)


def repaired_span(text: Column, part: Column, start: Column, end: Column) -> Column:
    """Start of a quoted part: as given if it fits there, else its only occurrence, else null."""
    fits = (end <= F.length(text)) & (text.substr(start + 1, end - start) == part)
    return F.when(fits, start).otherwise(occurs_once(text, part))


#: Empty reasoning wrappers of a model family, and what a leak of reasoning holds.
EMPTY_WRAPPERS = ("<|channel|>thought\n<|channel|>", "<|channel>thought\n<channel|>")
LEAKS = ("<|channel|>thought", "<|channel>thought")


def clean_output(text: Column) -> Column:
    """A model's output without an empty reasoning wrapper at its start; null where reasoning leaks."""
    out = F.when(F.lit(False), text)
    for wrapper in EMPTY_WRAPPERS:
        out = out.when(text.startswith(wrapper), text.substr(F.lit(len(wrapper) + 1), F.length(text)))
    leak = F.lit(False)
    for mark in LEAKS:
        leak = leak | text.contains(mark)
    return out.when(~leak, text)


def joined_reason(reasons: Column) -> Column:
    """Reasons joined and cut to the length that a record allows."""
    return F.substring(F.array_join(reasons, " | "), 1, REASON_LENGTH)


def media_suffix(media_type: Column, url: Column) -> Column:
    """A file suffix by media type, else by the URL's path; null for what is no supported image."""
    by_type = F.when(media_type == "image/jpeg", ".jpg").when(media_type == "image/png", ".png").when(media_type == "image/webp", ".webp")
    by_path = F.lower(F.regexp_extract(url, r"^[^?#]*/[^?#/]+(\.(?i:jpe?g|png|webp))(?:[?#]|$)", 1))
    return F.coalesce(by_type, F.nullif(by_path, F.lit("")))


def completion_error(finish_reason: Column, choices: Column, content: Column, tool_calls: Column, prompt_tokens: Column, completion_tokens: Column, max_tokens: int) -> Column:
    """The first thing wrong with a completion, or null. A text cut by length is right if closing its JSON completes it."""
    closed = F.when(finish_reason == "length", closed_json(F.when(finish_reason == "length", content)))
    return (
        F.when(~choices.eqNullSafe(1), "MODEL_CHOICE_COUNT")
        .when(~F.coalesce(finish_reason.isin("stop", "length"), F.lit(False)), "MODEL_FINISH_REASON")
        .when(F.coalesce(tool_calls, F.lit(0)) > 0, "MODEL_MESSAGE_INVALID")
        .when(~not_blank(content), "MODEL_CONTENT_EMPTY")
        .when((finish_reason == "length") & closed.isNull(), "MODEL_FINISH_REASON")
        .when((prompt_tokens < 0) | (completion_tokens < 0) | (completion_tokens > max_tokens), "MODEL_USAGE_INVALID")
    )
