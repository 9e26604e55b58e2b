"""The ingest plan: sources and rights to images with groups, purposes and splits."""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusflow.functions.hashing import SEED, json_column, split_of
from corpusflow.operators import eligibility, similarity


def image_ids(images: DataFrame) -> DataFrame:
    """``images`` with image_id, the identity of source and pixels."""
    return images.withColumn("image_id", F.sha2(json_column(source_id=F.col("source_id"), pixel=F.col("canonical_pixel_sha256")), 256))


def ingest(sources: DataFrame, rights: DataFrame, decoded: DataFrame, at: Column, vectors: DataFrame | None = None, threshold: float = similarity.THRESHOLD, seed: int = SEED) -> tuple[DataFrame, DataFrame]:
    """(images, failures). ``decoded`` has source_id, canonical_pixel_sha256 and what the image gates read.

    Manifest errors (repeated ids, dangling rights) abort all; a source that fails a check is
    a row of failures with its first reason. Groups hold exact, declared and near copies; an
    evaluation member makes its group evaluation, and splits follow the group.
    """
    eligibility.require_unique(sources, "source_id", "DUPLICATE_SOURCE_ID")
    training = F.col("purpose") == "training"
    allowed = eligibility.attach_rights(sources, rights, at, training)
    joined = allowed.join(decoded, "source_id", "left")
    missing = F.when(F.col("canonical_pixel_sha256").isNull(), "IMAGE_NOT_FILE")
    checked = joined.withColumn("reason", F.coalesce("reason", missing, eligibility.image_reason()))
    accepted, failed = eligibility.split_failures(checked)
    images = image_ids(accepted)
    groups = similarity.visual_groups(images, vectors, threshold)
    marked = eligibility.spread_evaluation(images.join(groups, "image_id").withColumn("__e", F.col("purpose") == "evaluation").drop("purpose"), "visual_group_id", "__e").drop("__e")
    split = F.when(F.col("purpose") == "evaluation", "evaluation").otherwise(split_of(F.col("visual_group_id"), seed))
    return marked.withColumn("split", split), failed.select("source_id", "reason")


def manifest_hash(images: DataFrame, failures: DataFrame) -> str:
    """Identity of an ingest's result, over sorted rows in canonical form, hashed by row first.

    The hash is over the canonical JSON of three lists; rows go through the driver as a stream.
    """
    digest = hashlib.sha256()
    for name, df, cols in (("failures", failures, ["source_id", "reason"]), ("images", images, ["image_id", "visual_group_id"]), ("splits", images, ["image_id", "split"])):
        digest.update((b"{" if name == "failures" else b",") + f'"{name}":['.encode())
        rows = df.select(F.sha2(json_column(**{c: F.col(c).cast("string") for c in cols}), 256).alias("h")).orderBy("h")
        for k, r in enumerate(rows.toLocalIterator()):
            digest.update((b"," if k else b"") + f'"{r[0]}"'.encode())
        digest.update(b"]")
    digest.update(b"}")
    return digest.hexdigest()
