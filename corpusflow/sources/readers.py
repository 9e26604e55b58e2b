"""Sources: strict JSON lines, CSV metadata, YAML, image files, ledgers, fixtures."""

from __future__ import annotations

from pathlib import Path
from typing import Any

import yaml
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusflow.functions.hashing import sha
from corpusflow.functions.text import not_blank, strict_json_error, strict_object
from corpusflow.operators.eligibility import ManifestError, safe_path
from corpusflow.sources import files
from corpusflow.sources.csv_scan import read_csv


class UniqueKeys(yaml.SafeLoader):
    """A YAML loader that rejects repeated keys and keys that aren't strings."""

    def construct_mapping(self, node: yaml.MappingNode, deep: bool = False) -> dict:
        keys = [self.construct_object(k, deep=True) for k, _ in node.value]
        if not all(isinstance(k, str) for k in keys):
            raise ManifestError("YAML_KEY", "keys must be strings")
        if len(set(keys)) != len(keys):
            raise ManifestError("YAML_DUPLICATE_KEY", str(node.start_mark))
        return super().construct_mapping(node, deep)


def load_yaml(path: str | Path) -> Any:
    """A small configuration file, read on the driver."""
    return yaml.load(Path(path).read_text(encoding="utf-8"), UniqueKeys)


def read_json(path: str | Path) -> dict[str, Any]:
    """One strict JSON object from a small file."""
    return strict_object(Path(path).read_bytes())


def read_jsonl(spark: SparkSession, path: str, schema: T.StructType, strict: bool = True) -> DataFrame:
    """JSON lines of a declared schema; blank lines are skipped.

    ``strict``: a line that isn't a strict object, has unknown fields or lacks one that may not
    be null is an error that names the file, the line and its code; one pass over all lines
    looks for the first of them before rows are handed out. Otherwise such lines are dropped.
    """
    place = (F.col("_metadata.file_path").alias("__file"), F.col("_metadata.file_block_start").alias("__at"), F.monotonically_increasing_id().alias("__k"))
    lines = spark.read.text(path).select(F.col("value"), *place)
    parsed = lines.where(not_blank(F.col("value"))).withColumn("__code", strict_json_error("value")).withColumn("__row", F.from_json("value", schema, {"mode": "PERMISSIVE"}))
    keys = F.array_except(F.json_object_keys("value"), F.array(*[F.lit(f.name) for f in schema.fields]))
    code = F.coalesce(F.col("__code"), F.when(F.size(keys) > 0, "UNKNOWN_FIELD"), F.when(F.col("__row").isNull(), "TYPE_MISMATCH"))
    for f in schema.fields:
        if not f.nullable:
            code = F.coalesce(code, F.when(F.col("__row")[f.name].isNull(), f"FIELD_MISSING:{f.name}"))
    if strict:
        bad = parsed.where(code.isNotNull()).agg(F.min(F.struct("__file", "__at", "__k", code.alias("code"))).alias("b")).first()["b"]
        if bad is not None:
            # lines of a split have rising numbers, and splits of a file begin at rising offsets
            before = (F.col("__at") < bad["__at"]) | ((F.col("__at") == bad["__at"]) & (F.col("__k") <= bad["__k"]))
            number = lines.where((F.col("__file") == bad["__file"]) & before).count()
            raise ManifestError(bad["code"], f"{bad['__file']}:{number}")
    return parsed.where(code.isNull()).select("__row.*")


def read_metadata(spark: SparkSession, path: str, columns: list[str]) -> DataFrame:
    """CSV metadata with a header, in as many tasks as the files have splits; missing or repeated columns and malformed rows are errors (``csv_scan``)."""
    return read_csv(spark, path, columns)


def file_digests(spark: SparkSession, path: str) -> DataFrame:
    """path, length and SHA-256 of each file under a path: streamed by the tasks, or, in stores that only Spark opens, as one value of up to 2 GB."""
    found = files.listed(spark, path)
    scheme = spark._jvm.org.apache.hadoop.fs.Path(path).getFileSystem(spark._jsc.hadoopConfiguration()).getScheme()
    if scheme in files.STREAMED or scheme == "s3a":
        return files.digests(found)
    whole = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    return whole.select("path", "length", F.sha2("content", 256).alias("sha256"))


def read_images(spark: SparkSession, root: str, wanted: DataFrame) -> DataFrame:
    """Bytes of the wanted relative paths (column image_path) under a root; unsafe paths are errors of their rows.

    Columns: image_path, content, reason. Files are matched by the path after the root.
    """
    found = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(root)
    base = root.rstrip("/").removeprefix("file:").rsplit("/", 1)[-1]
    found = found.select(F.regexp_extract("path", f".*/{base}/(.*)$", 1).alias("__rel"), "content")
    checked = wanted.withColumn("reason", F.when(~safe_path(F.col("image_path")), "IMAGE_PATH_ESCAPE"))
    joined = checked.join(found, (checked["image_path"] == found["__rel"]) & checked["reason"].isNull(), "left")
    return joined.withColumn("reason", F.coalesce("reason", F.when(F.col("content").isNull(), "IMAGE_NOT_FILE"))).drop("__rel")


def read_ledger(spark: SparkSession, path: str) -> DataFrame:
    """A call ledger; older ones lack ``duration_ms``, which then counts as 0."""
    df = spark.read.parquet(path)
    return df if "duration_ms" in df.columns else df.withColumn("duration_ms", F.lit(0).cast("long"))


#: Strata and splits of answer-keyed fixtures.
STRATA = ("attribute_spatial", "count_set", "text_language", "table_calculation", "format_constraint", "history_transition", "limitation_false_premise", "policy_injection")
FIXTURE_SPLITS = ("development", "confirmation")


def fixtures(spark: SparkSession, languages: list[str], pairs: int, seed: int) -> DataFrame:
    """Answer-keyed cases: for each language, split, stratum and index one to accept and one to reject.

    Columns: fixture_id, image_id, split, stratum, target_language, index, expected_accept.
    Both cases of a pair share an image; pixels are made elsewhere, from the image's id.
    """
    lit = lambda xs: F.explode(F.array(*map(F.lit, xs)))
    rows = spark.range(pairs).select(F.col("id").alias("index"), lit(FIXTURE_SPLITS).alias("split"))
    rows = rows.select("*", lit(STRATA).alias("stratum")).select("*", lit(languages).alias("target_language")).select("*", F.explode(F.array(F.lit(True), F.lit(False))).alias("expected_accept"))
    case = (F.col("target_language"), F.col("split"), F.col("stratum"), F.col("index"))
    answer = F.when(F.col("expected_accept"), "True").otherwise("False")
    return rows.select(sha(seed, *case, answer).alias("fixture_id"), sha(seed, *case).alias("image_id"), "split", "stratum", "target_language", "index", "expected_accept")
