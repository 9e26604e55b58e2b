"""Content identities, hash buckets and what is decided by them."""

from __future__ import annotations

import hashlib
import json
from typing import Any

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Fixed values of the data model.
SEED = 20260915
SPLIT_BUCKETS, TRAIN_BELOW, DEVELOPMENT_BELOW = 10_000, 9_000, 9_500
TURN_CHOICES = (2, 2, 2, 2, 3, 3, 3, 3, 4, 5, 6)


def canonical_json(value: Any) -> str:
    """Sorted keys, compact separators, unescaped Unicode; NaN and infinities are errors."""
    return json.dumps(value, sort_keys=True, ensure_ascii=False, allow_nan=False, separators=(",", ":"))


def canonical_hash(value: Any) -> str:
    return hashlib.sha256(canonical_json(value).encode("utf-8")).hexdigest()


def json_column(**fields: Column) -> Column:
    """Canonical JSON of an object with strings, integers, booleans, nulls, and arrays and structs of these.

    Keys are put in order here; nested structs must already have theirs in order. Doubles
    are written differently by Spark: use ``json_udf`` where there are any.
    """
    parts = [fields[k].alias(k) for k in sorted(fields)]
    return F.to_json(F.struct(*parts), {"ignoreNullFields": "false"})


def json_array(items: Column) -> Column:
    """Canonical JSON of an array of strings, integers or structs with keys in order."""
    return F.to_json(items, {"ignoreNullFields": "false"})


@F.pandas_udf(T.StringType())
def json_udf(documents: pd.Series) -> pd.Series:
    """Canonical JSON of JSON texts, whatever is in them (doubles, dynamic keys)."""
    return documents.map(lambda x: None if x is None else canonical_json(json.loads(x)))


def sha(*parts: Column | str | int) -> Column:
    """Lower-case hex SHA-256 of the parts as text, joined by colons."""
    texts = [x.cast("string") if isinstance(x, Column) else F.lit(str(x)) for x in parts]
    return F.sha2(F.concat_ws(":", *texts), 256)


def bucket(digest: Column, modulus: int | Column) -> Column:
    """The first eight bytes of a hex digest as an unsigned number, modulo ``modulus``: a long."""
    number = F.conv(F.substring(digest, 1, 16), 16, 10).cast("decimal(20,0)")
    by = F.lit(modulus) if isinstance(modulus, int) else modulus
    return (number % by.cast("decimal(20,0)")).cast("long")


def split_of(group: Column, seed: int = SEED) -> Column:
    """90/5/5 split of a visual group."""
    b = bucket(sha(seed, group), SPLIT_BUCKETS)
    return F.when(b < TRAIN_BELOW, "train").when(b < DEVELOPMENT_BELOW, "development").otherwise("test")


def planned_turns(image_id: Column, seed: int = SEED) -> Column:
    """Turns planned for an image, 2 to 6."""
    b = bucket(sha(seed, image_id, "turn-count"), len(TURN_CHOICES))
    return F.element_at(F.array(*map(F.lit, TURN_CHOICES)), b.cast("int") + 1)


def is_hex(text: Column, digits: int) -> Column:
    """A lower-case hex identity of exactly so many digits."""
    return text.rlike(f"^[0-9a-f]{{{digits}}}\\z")


def artifact_path(kind: str, digest: Column) -> Column:
    """Where a blob lies: kind, first two digits, digest."""
    return F.concat_ws("/", F.lit(kind), F.substring(digest, 1, 2), digest)
