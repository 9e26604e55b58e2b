"""Digests as streams, and samples that probe files in rounds."""

import hashlib

import pytest
from pyspark.sql import functions as F

from corpusflow.operators import eligibility
from corpusflow.sources import files, readers


def test_digests_of_files_of_any_size(spark, tmp_path):
    (tmp_path / "sub dir").mkdir()
    for name, data in (("a.bin", b"abc"), ("empty", b""), ("sub dir/b #1.bin", bytes(range(256)) * 40_000)):
        (tmp_path / name).write_bytes(data)
    with (tmp_path / "large").open("wb") as f:
        f.truncate((2 << 30) + 12345)  # more than one value can hold
    got = {r["path"].rsplit("/", 1)[1]: (r["length"], r["sha256"]) for r in readers.file_digests(spark, str(tmp_path)).collect()}
    zeros = hashlib.sha256()
    for _ in range(512):
        zeros.update(bytes(4 << 20))
    zeros.update(bytes(12345))
    assert got["large"] == ((2 << 30) + 12345, zeros.hexdigest()) and len(got) == 3
    assert got["a.bin"] == (3, hashlib.sha256(b"abc").hexdigest()) and "empty" not in got
    assert (10_240_000, hashlib.sha256(bytes(range(256)) * 40_000).hexdigest()) in got.values()


@pytest.mark.parametrize(("every", "k"), [(1, 10), (3, 25), (10, 25)])
def test_a_probed_sample_is_that_of_probing_all(spark, every, k):
    rows = spark.range(2000).selectExpr("cast(id as string) as i", "id as n")
    out, probed = eligibility.probed_sample(rows, "i", k, lambda d: d.withColumn("present", F.col("n") % every == 0))
    ranks = sorted((hashlib.sha256(f"{eligibility.SEED}:{n}".encode()).hexdigest(), n) for n in range(2000))
    want = [n for _, n in ranks if n % every == 0][:k]
    assert [r["n"] for r in out.collect()] == want
    needed = next(j for j, (_, n) in enumerate(ranks) if n == want[-1]) + 1
    assert probed <= 2.5 * needed + 3 * k


def test_absent_files_and_links_are_skipped_and_too_few_are_an_error(spark, tmp_path):
    for n in range(0, 60, 2):
        (tmp_path / f"{n:016x}.jpg").write_bytes(b"x")
    (tmp_path / f"{1:016x}.jpg").symlink_to(tmp_path / f"{0:016x}.jpg")
    (tmp_path / f"{3:016x}.jpg").mkdir()
    ids = [f"{n:016x}" for n in range(60)]
    kind = {f.name: "ok" for f in eligibility.METADATA}
    row = {**kind, "Subset": "train", "License": eligibility.LICENSES[0], "Author": "a", "OriginalLandingURL": "https://x", "Rotation": "0"}
    names = [f.name for f in eligibility.METADATA]
    m = spark.createDataFrame([tuple({**row, "ImageID": i}[c] for c in names) for i in ids], ", ".join(f"{c} string" for c in names)).withColumn("image_path", F.concat("ImageID", F.lit(".jpg")))
    none = spark.createDataFrame([], "image_id string")
    probe = files.probe(str(tmp_path))
    got = {r["ImageID"] for r in eligibility.train_sample(m, none, 20, probe=probe).collect()}
    present = {i for n, i in enumerate(ids) if n % 2 == 0}
    ranked = sorted(present, key=lambda i: hashlib.sha256(f"{eligibility.SEED}:{i}".encode()).hexdigest())
    assert got == set(ranked[:20])
    with pytest.raises(eligibility.ManifestError, match="LOCAL_TRAIN_SHORTFALL: asked for 31, found 30"):
        eligibility.train_sample(m, none, 31, probe=probe)


def test_no_rows_to_probe(spark):
    out, probed = eligibility.probed_sample(spark.createDataFrame([], "i string"), "i", 5, lambda d: d.withColumn("present", F.lit(True)))
    assert out.count() == 0 and probed == 0
