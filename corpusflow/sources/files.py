"""Files seen by tasks: whether they are there, and their digests as streams."""

from __future__ import annotations

import hashlib
import os
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Bytes that a task holds of a file.
CHUNK = 4 << 20
#: Schemes that tasks can open themselves, whatever the size of a file.
STREAMED = ("file", "hdfs", "s3", "gs", "gcs", "abfs", "abfss")


def opened(path: str) -> tuple[fs.FileSystem, str]:
    """File system and path inside of it of a URI or a local path (a URI's local paths may hold spaces)."""
    if path.startswith("file:"):
        return fs.LocalFileSystem(), "/" + path.removeprefix("file:").lstrip("/")
    if path.startswith("/"):
        return fs.LocalFileSystem(), path
    return fs.FileSystem.from_uri(path.replace("s3a://", "s3://", 1))


def digests(files: DataFrame) -> DataFrame:
    """``files`` (path, length) with ``sha256``: each file is read by one task as a stream, so its size doesn't matter.

    A digest depends on all bytes in order, so a file is one task's work by definition.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for path in batch.column("path").to_pylist():
                filesystem, inner = opened(path)
                digest = hashlib.sha256()
                with filesystem.open_input_stream(inner) as f:
                    while part := f.read(CHUNK):
                        digest.update(part)
                found.append(digest.hexdigest())
            yield pa.RecordBatch.from_arrays([batch.column("path"), batch.column("length"), pa.array(found, pa.string())], ["path", "length", "sha256"])

    return files.select("path", "length").mapInArrow(run, "path string, length long, sha256 string")


def listed(spark: SparkSession, path: str) -> DataFrame:
    """path and length of each file under a path that holds anything (Spark leaves empty files out); no content is read."""
    return spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).select("path", "length")


def probe(root: str, relative: str = "image_path") -> Callable[[DataFrame], DataFrame]:
    """A function that adds ``present`` to rows: whether the file at a relative path under ``root`` is a file and no link.

    Links exist on local and mounted file systems only.
    """

    def present(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        filesystem, base = opened(root)
        local = isinstance(filesystem, fs.LocalFileSystem)
        for batch in batches:
            names = batch.column(relative).to_pylist()
            infos = filesystem.get_file_info([f"{base.rstrip('/')}/{n}" for n in names])
            there = [i.type == fs.FileType.File and not (local and os.path.islink(i.path)) for i in infos]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(there, pa.bool_())], [*batch.schema.names, "present"])

    return lambda rows: rows.mapInArrow(present, rows.withColumn("present", F.lit(True)).schema)
