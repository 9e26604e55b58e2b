"""CSV read by quote parity against Python's own reader, in many tasks."""

import csv
import io
import random

import pytest

from corpusflow.operators.eligibility import ManifestError
from corpusflow.sources import csv_scan, readers

FIELDS = ["plain", "", "a,b", 'say "hi"', "two\nlines", "\n", "three\n\nlines, \"quoted\"\n", "ünïcode 漢", "x" * 300, " spaced ", "\r\ninside", '"']


@pytest.fixture
def splits(spark):
    """Small splits, so that a file is read in many tasks."""
    spark.conf.set("spark.sql.files.maxPartitionBytes", "3000")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    yield
    spark.conf.unset("spark.sql.files.maxPartitionBytes")
    spark.conf.unset("spark.sql.files.openCostInBytes")


def written(rows, end="\n"):
    out = io.StringIO()
    csv.writer(out, lineterminator=end).writerows(rows)
    return out.getvalue()


@pytest.mark.parametrize("end", ["\n", "\r\n"])
def test_quoted_line_breaks_in_many_tasks(spark, splits, tmp_path, end):
    rng = random.Random(2)
    want = []
    for k in range(3):
        rows = [[f"{k}-{n}", *(rng.choice(FIELDS) for _ in range(3))] for n in range(400)]
        want += rows
        (tmp_path / f"part{k}.csv").write_bytes(written([["ImageID", "A b", "License", "Text"], *rows], end).encode())
    assert spark.read.text(str(tmp_path)).rdd.getNumPartitions() > 20
    got = readers.read_metadata(spark, str(tmp_path), ["ImageID", "License"])
    assert got.columns == ["ImageID", "A b", "License", "Text"]
    assert sorted(tuple(r) for r in got.collect()) == sorted(map(tuple, want))
    lines = {(r["file"].rsplit("/", 1)[1], r["line"]) for r in csv_scan.records(spark, str(tmp_path)).collect()}
    assert len(lines) == 3 * 401 and ("part0.csv", 1) in lines


@pytest.mark.parametrize(("bad", "offset"), [("only,three,fields\n", 0), ("a,b,c,d,e\n", 0), ('"a\nb\nc",d\n', 0)])
def test_the_first_bad_row_is_named(spark, splits, tmp_path, bad, offset):
    good = [[f"{n}", "two\nlines", "y", "z"] for n in range(900)]
    text = written([["ImageID", "A", "License", "T"], *good[:700]])
    line = text.count("\n") + 1 + offset
    path = tmp_path / "m.csv"
    path.write_text(text + bad + written(good[700:800]) + bad + written(good[800:]))
    with pytest.raises(ManifestError, match=f"METADATA_ROW: .*m.csv:{line}$"):
        readers.read_metadata(spark, str(path), ["ImageID"])


def test_headers_open_fields_and_empty_files(spark, tmp_path):
    path = tmp_path / "m.csv"
    path.write_text('ImageID,License\n1,"never closed\n2,x\n')
    with pytest.raises(ManifestError, match="never closed"):
        readers.read_metadata(spark, str(path), ["ImageID"])
    path.write_text("﻿ImageID,License\n\n1,\n")
    assert [tuple(r) for r in readers.read_metadata(spark, str(path), ["ImageID"]).collect()] == [("1", "")]
    path.write_text("")
    with pytest.raises(ManifestError, match="missing"):
        readers.read_metadata(spark, str(path), ["ImageID"])
    path.write_text("ImageID,License\n1,x\n")
    (tmp_path / "other.csv").write_text("ImageID,Licence\n1,x\n")
    with pytest.raises(ManifestError):
        readers.read_metadata(spark, str(tmp_path), ["ImageID"])


def test_many_splits_meet_in_a_shuffle(spark, splits, tmp_path, monkeypatch):
    monkeypatch.setattr(csv_scan, "SPLITS", 0)
    rows = [[str(n), "two\nlines" if n % 3 else "one"] for n in range(900)]
    (tmp_path / "m.csv").write_text(written([["ImageID", "T"], *rows]))
    assert sorted(tuple(r) for r in readers.read_metadata(spark, str(tmp_path), ["ImageID"]).collect()) == sorted(map(tuple, rows))


def test_records_stay_in_the_order_of_their_file(spark, tmp_path):
    rows = [[str(n), f'say "{n}"' if n % 3 else ""] for n in range(300)]
    (tmp_path / "m.csv").write_text(written([["ImageID", "T"], *rows]))
    assert [list(r) for r in readers.read_metadata(spark, str(tmp_path / "m.csv"), ["ImageID", "T"]).collect()] == rows
