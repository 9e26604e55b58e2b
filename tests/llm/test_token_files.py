"""Token files against the tokenizer itself, and the files against their format."""

import glob
import json
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from corpusflow.llm import queries, token_files

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def encoder():
    return token_files.Encoder(PATH)


def ids_of(encoder, text):
    return [*(encoder.tokenizer.encode(text, add_special_tokens=False).ids if text else []), token_files.END_ID]


def plain(encoder, rows):
    """(doc_id, start, n_tokens, crc32) of rows (doc_id, text) in order."""
    out, start = [], 0
    for doc_id, text in rows:
        ids = np.array(ids_of(encoder, text), "<u4")
        out.append((doc_id, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    return out


def test_whole_table(spark, small, encoder):
    rows = sorted(tuple(r) for r in spark.read.parquet(f"{small}/documents.parquet").select("doc_id", "text").collect())
    got = queries.op13_tokens(spark, small)
    assert got.columns == ["doc_id", "start", "n_tokens", "ids_crc32"]
    assert sorted(tuple(r) for r in got.collect()) == plain(encoder, rows)


PIECES = ["a", "b", "'s", " ", "  ", "\n", "\t", "\r", "\x1c", "\x85", " ", "　", "1", "²", "Ⅷ", "!", "é", "é", "漢", "🙂", "\0", "​", "<|endoftext|>", " the", "_", ",", ".", "a,", "b.", "..."]


@settings(max_examples=600, deadline=None)
@given(texts=st.lists(st.lists(st.sampled_from(PIECES), max_size=14).map("".join), max_size=5))
def test_cutting_into_words_changes_no_id(encoder, texts):
    ids, counts = encoder.encode(pa.array([*texts, None], pa.string()))
    want = [encoder.tokenizer.encode(t, add_special_tokens=False).ids for t in texts] + [[]]
    assert ids.tolist() == [i for w in want for i in w] and counts.tolist() == list(map(len, want))


def test_slices_of_an_array(encoder):
    texts = [f"text {k}, more words.\nAnd a last line {k}  odd" if k % 3 else f"plain {k} text." for k in range(40)] + ["", None]
    for begin in range(0, len(texts), 5):
        part = pa.array(texts).slice(begin, 5)
        ids, counts = encoder.encode(part)
        want = [ids_of(encoder, t)[:-1] for t in part.to_pylist()]
        assert ids.tolist() == [i for w in want for i in w] and counts.tolist() == list(map(len, want))


def test_the_cache_may_be_emptied_at_any_time(encoder, monkeypatch):
    monkeypatch.setattr(token_files, "CACHE_WORDS", 3)
    for text in ("one two three four five", "three four\nfive six, seven."):
        assert encoder.encode(pa.array([text]))[0].tolist() == ids_of(encoder, text)[:-1]


@pytest.mark.parametrize("name", ["word_bpe_49k.json"])
def test_tokenizers_of_other_kinds_encode_whole_texts(name):
    other = token_files.Encoder(public_tokenizers.path(name))
    assert not other.splits
    assert other.encode(pa.array(["Some  words, HERE.", ""]))[0].tolist() == other.tokenizer.encode("Some  words, HERE.", add_special_tokens=False).ids


def test_files_and_odd_rows(spark, odd, encoder, tmp_path, monkeypatch):
    path = str(tmp_path / "tokens")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        token_files.write(odd, path, PATH)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    rows = [tuple(r) for r in odd.select("doc_id", "text").collect()]
    rows.sort(key=lambda r: (r[0] is not None, r[0] or 0))
    want = plain(encoder, rows)
    got = token_files.read(spark, path).orderBy("start").collect()
    assert [(r["doc_id"], r["start"], r["n_tokens"], zlib.crc32(r["ids"])) for r in got] == want
    stored = token_files.Stored(path)
    assert len(stored) == len(rows) and [stored.document(k).tolist() for k in range(len(rows))] == [ids_of(encoder, t) for _, t in rows]
    assert stored.document(0).dtype == np.dtype("<u2") and any(isinstance(m, np.memmap) for m in stored.mapped.values())
    with pytest.raises(IndexError):
        stored.document(len(rows))
    parts = stored.manifest["parts"]
    assert len(parts) > 1 and [p["base"] for p in parts] == [sum(q["tokens"] for q in parts[:k]) for k in range(len(parts))]
    flat = np.concatenate([np.fromfile(f"{path}/{p['name']}.bin", "<u2") for p in parts])
    assert flat.tolist() == [i for _, t in rows for i in ids_of(encoder, t)]
    assert all(np.fromfile(f"{path}/{p['name']}.off", "<u8").tolist()[-1] == p["tokens"] for p in parts)


def test_files_that_the_manifest_does_not_name_do_not_count(spark, encoder, tmp_path):
    path = str(tmp_path / "tokens")
    token_files.write(spark.createDataFrame([(1, "a b"), (2, "c")], "doc_id long, text string"), path, PATH)
    before = token_files.read(spark, path).collect()
    for kind in ("bin", "off", "doc"):
        (tmp_path / "tokens" / f"part-000000-lost.{kind}").write_bytes(b"\1" * 16)
    assert token_files.read(spark, path).collect() == before
    assert len(json.loads((tmp_path / "tokens" / token_files.MANIFEST).read_text())["parts"]) <= len(glob.glob(f"{path}/*.bin"))


def test_a_large_part_is_read_by_several_tasks(spark, encoder, tmp_path, monkeypatch):
    path = str(tmp_path / "tokens")
    token_files.write(spark.createDataFrame([(k, f"text {k} " * 50) for k in range(40)], "doc_id long, text string").coalesce(1), path, PATH)
    monkeypatch.setattr(token_files, "PIECE", 500)
    monkeypatch.setattr(token_files, "BATCH", 100)
    pieces = token_files.Reader(path).partitions()
    assert len(pieces) > len(token_files.Stored(path).manifest["parts"])
    rows = [r for p in pieces for b in token_files.Reader(path).read(p) for r in b.to_pylist()]
    assert [(r["doc_id"], r["start"], r["n_tokens"], zlib.crc32(r["ids"])) for r in rows] == plain(encoder, [(k, f"text {k} " * 50) for k in range(40)])


def test_empty(spark, none, tmp_path):
    path = str(tmp_path / "tokens")
    token_files.write(none, path, PATH)
    assert token_files.read(spark, path).count() == 0 and len(token_files.Stored(path)) == 0
