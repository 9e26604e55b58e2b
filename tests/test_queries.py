"""Every registered query against its SQL on the smallest tables."""

from __future__ import annotations

import datetime as dt
import math
import os
from decimal import Decimal

import duckdb
import pytest

import __spark_entry__
from corpusflow import oracles, oracles_records, queries, queries_records

QUERIES, ORACLE_SQL = queries.QUERIES | queries_records.QUERIES, oracles.ORACLE_SQL | oracles_records.ORACLE_SQL


def normal(x):
    if x is None or (isinstance(x, float) and math.isnan(x)):
        return "~"
    if isinstance(x, bool):
        return str(x)
    if isinstance(x, int | float | Decimal):
        return repr(round(float(x), 6))
    return str(x.replace(tzinfo=None)) if isinstance(x, dt.datetime) else str(x)


@pytest.fixture(scope="module")
def con(small):
    c = duckdb.connect()
    for t in os.listdir(small):
        c.execute(f"create view {t.split('.')[0]} as select * from read_parquet('{small}/{t}')")
    return c


@pytest.mark.parametrize("name", [n for n in sorted(ORACLE_SQL) if n not in ("train_metadata_sample", "constrained_selection")])
def test_query_equals_its_sql(spark, small, con, name):
    got = QUERIES[name](spark, small)
    want = con.sql(ORACLE_SQL[name])
    assert sorted(got.columns) == sorted(want.columns)
    pick = sorted(got.columns)
    rows = lambda data, names: sorted(tuple(normal(r[names.index(c)]) for c in pick) for r in data)
    assert rows(got.collect(), got.columns) == rows(want.fetchall(), want.columns)


def test_contract(spark):
    queries, sql = __spark_entry__.queries(), __spark_entry__.oracle_sql()
    assert set(sql) <= set(queries) and set(QUERIES) <= set(queries)
    assert __spark_entry__.entry(spark).count() > 0


def test_nothing_else_imports_the_llm_subpackage():
    from pathlib import Path

    import corpusflow

    root = Path(corpusflow.__file__).parent
    for path in root.rglob("*.py"):
        if "llm" not in path.relative_to(root).parts:
            assert "corpusflow.llm" not in path.read_text(encoding="utf-8"), path
