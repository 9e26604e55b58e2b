"""Small tables of documents for the operators of this subpackage."""

from __future__ import annotations

import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
#: Null and empty texts, null ids and other columns, repeated rows, ties, and a very long text.
ODD = [
    (1, "The quick brown fox jumps over the lazy dog", "en", "a", 43),
    (1, "The quick brown fox jumps over the lazy dog", "en", "a", 43),
    (2, None, None, None, None),
    (3, "", "", "", 0),
    (None, "The quick brown fox jumps over the lazy dog", "en", None, 1),
    (4, " \t\n ", "de", "a", 4),
    (5, "word " * 120_000, "en", "b", 1),
    (6, "ÄÖÜ ß éèê 漢字 🙂", "de", "b", 1),
]


@pytest.fixture
def odd(spark):
    """Odd rows, with further columns whose names operators use inside."""
    df = spark.createDataFrame(ODD, SCHEMA)
    for name in ("fp", "score", "u", "v", "node", "root", "slot", "item_id", "words", "hits", "m", "p", "flat", "tail", "prints", "gone_id", "gone_text", "leaked", "row", "own", "__id", "__y", "__score", "__p", "__gone"):
        df = df.selectExpr("*", f"'x' as {name}")
    return df


@pytest.fixture
def none(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture
def labels(spark):
    return spark.createDataFrame([], "doc_id long, quality int, toxic int")
