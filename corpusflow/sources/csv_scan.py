"""CSV files read in many tasks, although a quoted field may hold line breaks.

Whether a line begins inside of a quoted field follows from the parity of the quotes before
it. A first pass counts quotes and lines for each split of a file; sums over the splits
before say how each split begins, and how many lines precede it. In the second pass each
line knows its number and its parity, so a line that begins outside of a field and has an
even number of quotes is a record by itself, wherever it stands, and is parsed where it is
read. Only lines of records with line breaks inside are dealt by record and put together.
"""

from __future__ import annotations

import csv
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusflow.operators.eligibility import ManifestError
from corpusflow.operators.ledger import running_sums
from corpusflow.session import saved

#: Splits whose sums are broadcast at most (some 100 bytes each); more meet the lines in a shuffle.
SPLITS = 200_000
#: Columns of a line: its file, the split it begins in, its number in the split, and the quotes before it in the split.
_PLACED = "file string, split long, line long, quotes_before long, quotes long, value string"


def _lines(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.option("lineSep", "\n").text(path).select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("split"), "value")


def _placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Lines of a task, which come in order, with their numbers and the quotes before them in their split."""
    key, line, total = None, 0, 0
    for batch in batches:
        quotes = pc.count_substring(batch.column("value"), '"').to_numpy(zero_copy_only=False).astype(np.int64)
        files, splits = batch.column("file").dictionary_encode(), batch.column("split").to_numpy(zero_copy_only=False)
        codes, names = files.indices.to_numpy(zero_copy_only=False), files.dictionary.to_pylist()
        starts = [0, *(np.flatnonzero((np.diff(codes) != 0) | (np.diff(splits) != 0)) + 1).tolist()]
        numbers, before = np.empty(len(quotes), np.int64), np.empty(len(quotes), np.int64)
        for a, b in zip(starts, [*starts[1:], len(quotes)], strict=True):
            if a == b:
                continue
            if (names[codes[a]], splits[a]) != key:
                key, line, total = (names[codes[a]], splits[a]), 0, 0
            upto = np.cumsum(quotes[a:b])
            numbers[a:b] = line + np.arange(b - a)
            before[a:b] = total + upto - quotes[a:b]
            line, total = line + b - a, total + int(upto[-1])
        yield pa.RecordBatch.from_arrays([batch.column("file"), batch.column("split"), pa.array(numbers), pa.array(before), pa.array(quotes), batch.column("value")], ["file", "split", "line", "quotes_before", "quotes", "value"])


def records(spark: SparkSession, path: str) -> DataFrame:
    """file, line (from 1) and text of each record of the CSV files under a path, line breaks inside included.

    An empty line is no record. A file whose last field is never closed is an error.
    """
    lines = _lines(spark, path)
    n_quotes = F.length("value") - F.length(F.replace("value", F.lit('"'), F.lit("")))
    sums = saved(lines.groupBy("file", "split").agg(F.sum(n_quotes).alias("q"), F.count(F.lit(1)).alias("n")), "splits")
    open_ = sums.groupBy("file").agg(F.sum("q").alias("q")).where("q % 2 = 1").agg(F.min("file")).first()[0]
    if open_ is not None:
        raise ManifestError("METADATA_ROW", f"{open_}: a quoted field is never closed")
    earlier = W.partitionBy("file").orderBy("split").rowsBetween(W.unboundedPreceding, -1)
    first = sums.select("file", "split", F.coalesce(F.sum("q").over(earlier), F.lit(0)).alias("q0"), F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("n0"))
    first = F.broadcast(first) if sums.count() <= SPLITS else first
    own = lines.mapInArrow(_placed, _PLACED).join(first, ["file", "split"])
    inside = (F.col("q0") + F.col("quotes_before")) % 2 == 1
    own = own.select("file", (F.col("n0") + F.col("line") + 1).alias("line"), "value", inside.alias("inside"), (F.col("quotes") % 2 == 1).alias("turns"))
    whole = own.where("not inside and not turns and value not in ('', '\\r')").select("file", "line", F.col("value").alias("text"))
    parts = own.where("inside or turns").withColumn("starts", (~F.col("inside")).cast("long"))
    parts = running_sums(parts.select("file", "line", "value", "starts"), "file", "line", ["starts"])
    joined = parts.groupBy("file", "starts").agg(F.min("line").alias("line"), F.sort_array(F.collect_list(F.struct("line", "value"))).alias("lines"))
    text = F.array_join(F.transform("lines", lambda x: x["value"]), "\n")
    return whole.unionByName(joined.select("file", "line", text.alias("text"))).withColumn("text", F.regexp_replace("text", "\r$", ""))


def read_csv(spark: SparkSession, path: str, columns: list[str]) -> DataFrame:
    """Rows of CSV files with one header (the first record of each file), all columns as text, empty fields as empty strings.

    A header that lacks one of ``columns``, repeats a name or differs between files, and a row
    with more or fewer fields, are errors; that of a row names the first such row's file and line.
    Records in one line come in the order in which a task reads them, those with line breaks inside after them.
    """
    rows = records(spark, path)
    heads = rows.groupBy("file").agg(F.min(F.struct("line", "text")).alias("h")).select("file", F.col("h.line").alias("head"), F.regexp_replace("h.text", "^﻿", "").alias("text"))
    found = heads.groupBy("text").agg(F.count(F.lit(1)).alias("n")).limit(2).collect()
    names = next(csv.reader([found[0]["text"]]), []) if found else []
    if not set(columns) <= set(names):
        raise ManifestError("METADATA_COLUMNS", "a column is missing")
    if len(set(names)) != len(names):
        raise ManifestError("METADATA_COLUMNS", "a column is repeated")
    if len(found) > 1:
        raise ManifestError("METADATA_COLUMNS", "files have different headers")
    schema = T.StructType([T.StructField(n, T.StringType()) for n in names])
    # an empty field is an empty string, not a null
    options = {"quote": '"', "escape": '"', "nullValue": "\0", "emptyValue": "", "mode": "PERMISSIVE", "columnNameOfCorruptRecord": "__bad", "maxCharsPerColumn": "-1"}
    shape = T.StructType([*schema.fields, T.StructField("__bad", T.StringType())])
    # one short row for each file: the records stay where they were read, in their order
    tops = heads.select(F.col("file").alias("__file"), "head")
    tops = F.broadcast(tops) if sum(r["n"] for r in found) <= SPLITS else tops
    parsed = rows.join(tops, (F.col("file") == F.col("__file")) & (F.col("line") == F.col("head")), "left_anti")
    parsed = parsed.withColumn("row", F.from_csv("text", _ddl(shape), options))
    bad = parsed.where("row.__bad is not null").agg(F.min(F.struct("file", "line")).alias("b")).first()["b"]
    if bad is not None:
        raise ManifestError("METADATA_ROW", f"{bad['file']}:{bad['line']}")
    return parsed.select(*[F.coalesce(F.col("row")[n], F.lit("")).alias(n) for n in names])


def _ddl(schema: T.StructType) -> str:
    return ", ".join(f"`{f.name.replace('`', '``')}` string" for f in schema.fields)
