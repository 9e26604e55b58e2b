"""The corpus pipeline: toxicity, quality, near-duplicates, benchmark leaks, mixing.

Each stage takes ``(spark, docs, sf_dir)`` and works on what the one before kept; all but
the last return the columns of ``docs``. Between stages the rows are written as Parquet and
read again, so that a stage is never run twice and lost executors cost only their tasks.

Every stage takes nulls in any column, empty and very long texts (read whole), repeated
rows and further columns, whatever these are called; an empty table gives an empty result. What becomes of
such rows is said in each stage and in the operator that it calls.
"""

from __future__ import annotations

from functools import partial

from pyspark.sql import DataFrame, SparkSession

from corpusflow.llm import decontaminate, mixing, quality, simhash, toxicity
from corpusflow.llm.common import table
from corpusflow.session import forget, saved_alone, spread


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity classifier doesn't reject; it is fitted on the labelled rows of ``documents``.

    Null and empty texts have the score of a text without words, a null language the general
    threshold; repeated rows stay or go together.
    """
    return toxicity.keep_clean(docs, table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def drop_low_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of good enough tail probability; the regression is fitted on the labelled rows of ``documents``.

    Null and empty texts have the value of an empty text; repeated rows stay or go together.
    """
    return quality.keep_good(docs, table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates, the one of smallest id.

    Null and empty texts are near-duplicates of each other. Rows of one id and text stay or
    go together; a null id counts as larger than any other.
    """
    return simhash.keep_one(docs)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item. Null and empty texts hold none; repeated rows stay or go together."""
    return decontaminate.keep_unleaked(docs, table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents with their places in the mixture: no row goes.

    Null sources are one source; repeated rows have a place each. Columns called like the new ones get ``_`` after their names.
    """
    return mixing.mix(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("quality", drop_low_quality),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", drop_leaks),
    ("mixing", mix_sources),
]

#: The classifiers and string tiling aren't expressible in SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = spread(table(spark, sf_dir, "documents"))
    for name, stage in STAGES[:-1]:
        before, docs = docs, saved_alone(partial(stage, spark, docs, sf_dir), name)
        forget(before)
    return STAGES[-1][1](spark, docs, sf_dir)
