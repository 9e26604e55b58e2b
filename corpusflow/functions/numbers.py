"""Exact numbers: a grammar of lexemes, arithmetic with units as powers, verification."""

from __future__ import annotations

import operator
import re
import unicodedata
from collections import Counter
from collections.abc import Callable
from fractions import Fraction
from functools import cache
from typing import NamedTuple

from pyspark.sql import Column
from pyspark.sql import functions as F


class Inexact(ValueError):
    """A lexeme or expression that isn't allowed; ``code`` says why."""

    def __init__(self, code: str) -> None:
        super().__init__(code)
        self.code = code


# -- lexemes --------------------------------------------------------------------------------


class _Grammar(NamedTuple):
    """Patterns of a lexeme with given separators: its two parts, a grouped whole part, and plain digits."""

    parts: re.Pattern
    grouped: re.Pattern | None
    digits: re.Pattern


@cache
def _grammar(decimal: str | None, group: str | None) -> _Grammar:
    part = f"[^{re.escape(decimal)}]+" if decimal else ".+"
    tail = f"(?:{re.escape(decimal)}(?P<part>{part}))?" if decimal else "(?P<part>(?!))?"
    grouped = re.compile(f"[0-9]{{1,3}}(?:{re.escape(group)}[0-9]{{3}})+") if group else None
    return _Grammar(re.compile(f"(?P<sign>[+-]?+)(?P<whole>{part}){tail}", re.S), grouped, re.compile("[0-9]+"))


def _ascii(text: str) -> str:
    """Decimal digits of any script, and the minus sign, as ASCII."""
    return re.sub(r"\d", lambda m: str(unicodedata.decimal(m[0])), text.strip()).replace("\N{MINUS SIGN}", "-")


def parse_lexeme(text: str, decimal: str | None = ".", group: str | None = None) -> Fraction:
    """An exact number from digits of any script, an optional sign, and the declared separators only."""
    if decimal == group:
        raise Inexact("AMBIGUOUS_SEPARATORS")
    grammar = _grammar(decimal, group)
    found = grammar.parts.fullmatch(_ascii(text))
    if found is None:
        raise Inexact("INVALID_NUMERIC_LEXEME")
    whole, part = found["whole"], found["part"] or "0"
    if grammar.grouped and group in whole:
        if not grammar.grouped.fullmatch(whole):
            raise Inexact("INVALID_DIGIT_GROUPING")
        whole = whole.replace(group, "")
    if not (grammar.digits.fullmatch(whole) and grammar.digits.fullmatch(part)):
        raise Inexact("NONNUMERIC_OR_UNDECLARED_PUNCTUATION")
    return Fraction(f"{found['sign']}{whole}.{part}")


# -- arithmetic -----------------------------------------------------------------------------

Units = list[str | None]


def _shared_unit(units: Units) -> str | None:
    """Terms of a sum have one unit."""
    if len(set(units)) > 1:
        raise Inexact("INCOMPATIBLE_UNITS")
    return units[0]


def _power_unit(*signs: int) -> Callable[[Units], str | None]:
    """Factors multiply their units' powers by their signs; what is left must be one unit or none."""

    def unit(units: Units) -> str | None:
        powers: Counter[str] = Counter()
        for name, sign in zip(units, signs, strict=True):
            if name is not None:
                powers[name] += sign
        left = [(name, power) for name, power in powers.items() if power]
        if len(left) > 1 or any(power != 1 for _, power in left):
            raise Inexact("UNSUPPORTED_COMPOUND_UNIT")
        return left[0][0] if left else None

    return unit


class _Operation(NamedTuple):
    least: int
    most: float
    misuse: str
    apply: Callable[[Fraction, Fraction], Fraction]
    unit: Callable[[Units], str | None]


_OPERATIONS = {
    "add": _Operation(2, float("inf"), "ADD_REQUIRES_TWO_OR_MORE", operator.add, _shared_unit),
    "subtract": _Operation(2, 2, "SUBTRACT_REQUIRES_TWO", operator.sub, _shared_unit),
    "multiply": _Operation(2, 2, "UNSUPPORTED_COMPOUND_UNIT", operator.mul, _power_unit(1, 1)),
    "divide": _Operation(2, 2, "INVALID_DIVISION", operator.truediv, _power_unit(1, -1)),
}
OPERATIONS = tuple(_OPERATIONS)


def calculate(operation: str, values: list[Fraction], units: Units) -> tuple[Fraction, str | None]:
    """Value and unit of an operation, exactly."""
    if operation not in _OPERATIONS:
        raise Inexact("UNKNOWN_OPERATION")
    if not values or len(values) != len(units):
        raise Inexact("OPERAND_UNIT_MISMATCH")
    if "" in units:
        raise Inexact("INVALID_UNIT")
    rule = _OPERATIONS[operation]
    if not rule.least <= len(values) <= rule.most:
        raise Inexact(rule.misuse)
    total = values[0]
    for value in values[1:]:
        try:
            total = rule.apply(total, value)
        except ZeroDivisionError:
            raise Inexact(rule.misuse) from None
    return total, rule.unit(units)


def _read(x: dict) -> Fraction:
    return parse_lexeme(x["value"], x["decimal_separator"], x["group_separator"])


def verdict_of(operation: str, operands: list[dict], reported: dict) -> str:
    """MET if the reported value and unit are exactly the operation's, else NOT_MET (malformed ones too)."""
    try:
        value, unit = calculate(operation, [_read(x) for x in operands], [x["unit"] for x in operands])
        return "MET" if _read(reported) == value and reported["unit"] == unit else "NOT_MET"
    except Inexact:
        return "NOT_MET"


def lexeme_value(text: Column) -> Column:
    """Exact value of a plain ASCII decimal as decimal(38, 6); null for anything else (which goes to ``verdict_of``)."""
    return F.when(text.rlike(r"^[+-]?[0-9]{1,18}(\.[0-9]{1,6})?\z"), text.cast("decimal(38,6)"))


#: Numbers that decimals hold exactly: operands (and quotients), and results of the other operations.
_OPERAND, _RESULT = (12, 6), (24, 12)


def _plain_number(lexeme: Column, size: tuple[int, int]) -> Column:
    """Value of a lexeme of ASCII digits, a full stop and no groups, as a decimal; null for all others."""
    whole, part = size
    plain = (lexeme["decimal_separator"] == ".") & lexeme["group_separator"].isNull() & lexeme["value"].rlike(rf"^[+-]?[0-9]{{1,{whole}}}(\.[0-9]{{1,{part}}})?\z")
    return F.when(plain, lexeme["value"].try_cast(f"decimal({whole + part},{part})"))


def plain_verdict(operation: Column, operands: Column, reported: Column) -> Column:
    """``verdict_of`` in decimals, by built-in functions; null where a lexeme isn't plain or is too long for them.

    Products of two operands have at most 36 digits, so nothing is rounded. A quotient is compared as the
    product of result and divisor. Sums have any number of terms.
    """
    values = F.transform(operands, lambda x: _plain_number(x, _OPERAND))
    a, b, r, q = F.get(values, F.lit(0)), F.get(values, F.lit(1)), _plain_number(reported, _RESULT), _plain_number(reported, _OPERAND)
    u, v, w = F.get(operands, F.lit(0))["unit"], F.get(operands, F.lit(1))["unit"], reported["unit"]
    total = F.aggregate(values, F.lit(0).cast("decimal(38,6)"), lambda s, x: (s + x).cast("decimal(38,6)"))
    one_unit = F.forall(operands, lambda x: x["unit"].eqNullSafe(u)) & w.eqNullSafe(u)
    two = F.size(operands) == 2
    # a factor without a unit leaves the other one's, two units can't be multiplied
    product_unit = (u.isNull() | v.isNull()) & w.eqNullSafe(F.coalesce(u, v))
    quotient_unit = (v.isNull() & w.eqNullSafe(u)) | (u.eqNullSafe(v) & w.isNull())
    met = (
        F.when(operation == "add", (F.size(operands) >= 2) & one_unit & (total == r))
        .when(operation == "subtract", two & one_unit & (a - b == r))
        .when(operation == "multiply", two & product_unit & (a * b == r))
        .when(operation == "divide", two & quotient_unit & (b != 0) & (q * b == a))
        .otherwise(False)
    )
    unnamed = F.exists(operands, lambda x: x["unit"].eqNullSafe(F.lit("")))
    readable = F.forall(values, lambda x: x.isNotNull()) & F.when(operation.eqNullSafe(F.lit("divide")), q.isNotNull()).otherwise(r.isNotNull())
    return F.when(readable, F.when(met & ~unnamed, "MET").otherwise("NOT_MET"))
