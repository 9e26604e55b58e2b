"""Token ids as flat files: unsigned integers end to end, 64-bit document offsets, memory-mapped.

A folder holds parts and a manifest. A part is three files without headers, little-endian:

    NAME.bin   ids of all its documents, one after the other, as uint16 or uint32
    NAME.off   uint64, one more than documents: where each document starts in NAME.bin, in ids
    NAME.doc   int64, the documents' ids

``manifest.json`` has the width, the end id and the parts in order. The parts are ranges of
doc_id, so together they are the ids of all documents in ascending order of doc_id. A part's
offsets count from zero; its base, the number of ids in all parts before it, is the prefix
sum over the parts' counts and stands in the manifest. So a part is written without knowing
another one, and a document is found by one lookup in the manifest and two in NAME.off.

The folder is written and read as a data source. Tasks write under names of their own and
say how much they wrote; the manifest, made last from what the successful tasks said, names
the files that count. So a task that is run again, or an executor that is lost, leaves at
most files that nothing names.
"""

from __future__ import annotations

import json
import re
import uuid
from bisect import bisect_right
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import accumulate, repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, InputPartition, WriterCommitMessage
from pyspark.sql.types import StructType

from corpusflow.session import importable

MANIFEST = "manifest.json"
END_ID = 2
SCHEMA = "doc_id long, start long, n_tokens long, ids binary"
#: Ids that a reading task takes at least, before a part is read by several tasks.
PIECE = 16_000_000
#: Ids in a batch of the reader; a longer document is a batch of its own.
BATCH = 1_000_000
#: Characters of texts, and of new words, that are encoded at once.
CHARS = 4_000_000
#: A worker's cache of words is emptied beyond so many words or characters.
CACHE_WORDS, CACHE_CHARS = 1_000_000, 16_000_000


#: White space by any account, which may not touch a place where a text is cut.
_SPACE = r"\pZ\x09-\x0d\x1c-\x1f\x{85}"
#: A text in which some space, line feed, comma or full stop is no such place.
_ODD = rf"^[ \n,.]|[{_SPACE}][ \n]|[ \n][{_SPACE}]|[ \n]$|[^\pL\pN][,.]|\x00"
_CUT = re.compile(r"(?<=\S)(?=[ \n]\S)")


class Encoder:
    """Ids of texts by a tokenizer of the ``tokenizers`` library, each different word encoded once while it is cached.

    Byte-level BPE splits a text into words first. A lone space or line feed between two
    other characters begins a word, and so does a comma or full stop after a letter or
    digit. A text is cut before these, and the ids of its words in order are the ids of the
    text. ``splits`` tells by the tokenizer's own account whether its words begin so; where
    they don't, texts are encoded whole. Strings of special tokens in a text are ordinary text.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        told = json.loads(self.tokenizer.to_str())
        before = told.get("pre_tokenizer") or {}
        self.splits = before.get("type") == "ByteLevel" and before.get("use_regex") and not before.get("add_prefix_space") and not told.get("normalizer")
        vocabulary = self.tokenizer.get_vocab()
        #: Bytes of each token: a byte-level token has a character for each byte.
        self.bytes = np.zeros(max(vocabulary.values()) + 1, np.int64)
        self.bytes[list(vocabulary.values())] = list(map(len, vocabulary))
        self._empty()

    def _empty(self) -> None:
        self.number: dict[str, int] = {}
        self.chars = 0
        self.flat, self.starts, self.lengths = np.empty(0, np.uint32), np.empty(0, np.int64), np.empty(0, np.int64)

    def words(self, texts: pa.Array) -> tuple[np.ndarray, pa.Array]:
        """The number of words of each text, and the words of all; a null text has none."""
        if not self.splits:
            return np.ones(len(texts), np.int64), texts.fill_null("")
        cut = texts
        for mark in " \n,.":
            cut = pc.replace_substring(cut, mark, "\0" + mark)
        cut = pc.split_pattern(cut, "\0")
        odd = np.flatnonzero(pc.fill_null(pc.match_substring_regex(texts, _ODD), False).to_numpy(zero_copy_only=False))
        if len(odd):
            where = np.arange(len(texts))
            where[odd] = len(texts) + np.arange(len(odd))
            cut = pa.concat_arrays([cut, pa.array([_CUT.split(texts[int(k)].as_py()) for k in odd], cut.type)]).take(pa.array(where))
        return pc.fill_null(pc.list_value_length(cut), 0).to_numpy(zero_copy_only=False).astype(np.int64), pc.list_flatten(cut)

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts end to end, and the number of ids of each text."""
        if len(self.number) > CACHE_WORDS or self.chars > CACHE_CHARS:
            self._empty()
        counts, flat = self.words(texts)
        coded = flat.dictionary_encode()
        known = coded.dictionary.to_pylist()
        numbers = np.fromiter(map(self.number.get, known, repeat(-1)), np.int64, len(known))
        missing = np.flatnonzero(numbers < 0)
        numbers[missing] = np.arange(len(self.lengths), len(self.lengths) + len(missing))
        self._learn([known[i] for i in missing])
        codes = numbers[coded.indices.to_numpy(zero_copy_only=False)]
        lengths = self.lengths[codes]
        ends = np.cumsum(lengths)
        total = int(ends[-1]) if len(ends) else 0
        ids = self.flat[np.repeat(self.starts[codes] - (ends - lengths), lengths) + np.arange(total)]
        upto = np.concatenate(([0], ends))[np.concatenate(([0], np.cumsum(counts)))]
        return ids, np.diff(upto)

    def _learn(self, words: list[str]) -> None:
        if not words:
            return
        lengths = np.zeros(len(words), np.int64)
        joined = [i for i, w in enumerate(words) if self.splits and len(w) > 1 and w[0] in " \n" and not w[1].isspace() and not w[-1].isspace()]
        alone = sorted(set(range(len(words))).difference(joined))
        got = []
        if joined:
            # such words begin anew wherever they stand, so one text of them has the ids of all; bytes tell where each ends
            ids = np.array(self.tokenizer.encode_batch_fast(["".join(words[i] for i in joined)], add_special_tokens=False)[0].ids, np.uint32)
            ends = np.searchsorted(np.cumsum(self.bytes[ids]), np.cumsum([len(words[i].encode("utf-8", "surrogatepass")) for i in joined])) + 1
            lengths[joined] = np.diff(ends, prepend=0)
            got.append(ids)
        for i, e in zip(alone, self.tokenizer.encode_batch_fast([words[i] for i in alone], add_special_tokens=False), strict=True):
            lengths[i] = len(e.ids)
            got.append(np.array(e.ids, np.uint32))
        order = np.array(joined + alone, np.int64)
        starts = np.empty(len(words), np.int64)
        starts[order] = len(self.flat) + np.cumsum(lengths[order]) - lengths[order]
        self.number.update(zip(words, range(len(self.lengths), len(self.lengths) + len(words)), strict=True))
        self.chars += sum(map(len, words))
        self.starts, self.lengths = np.concatenate((self.starts, starts)), np.concatenate((self.lengths, lengths))
        self.flat = np.concatenate((self.flat, *got))


_ENCODERS: dict[str, Encoder] = {}


def _encoder(path: str) -> Encoder:
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]


def _slices(sizes: list[int], most: int) -> Iterator[tuple[int, int]]:
    """Runs of items whose sizes sum up to ``most`` at most, or single items."""
    begin = total = 0
    for i, n in enumerate(sizes):
        if i > begin and total + n > most:
            yield begin, i
            begin, total = i, 0
        total += n
    if begin < len(sizes):
        yield begin, len(sizes)


def _binary(values: np.ndarray, counts: np.ndarray) -> pa.Array:
    """A binary array over one buffer: item k has the bytes of ``counts[k]`` values."""
    offsets = np.zeros(len(counts) + 1, np.int64)
    np.cumsum(counts * values.itemsize, out=offsets[1:])
    if offsets[-1] >= 1 << 31:
        raise ValueError("a document of over 2 GB of ids can't be one value")
    return pa.Array.from_buffers(pa.binary(), len(counts), [None, pa.py_buffer(offsets.astype(np.int32)), pa.py_buffer(np.ascontiguousarray(values))])


def _place(path: str) -> tuple[fs.FileSystem, str]:
    filesystem, inner = fs.FileSystem.from_uri(path)
    return filesystem, inner.rstrip("/")


@dataclass
class Part(WriterCommitMessage):
    """What a task wrote: documents, those of them without an id (they come first), and ids."""

    order: int
    name: str
    docs: int
    nulls: int
    tokens: int


@dataclass
class Piece(InputPartition):
    """Documents ``first`` to ``last`` of a part, and the number of ids in the parts before it."""

    name: str
    nulls: int
    docs: int
    base: int
    first: int
    last: int


class TokenFiles(DataSource):
    """The data source ``token_files``: writes texts (doc_id, text) in order of doc_id, reads documents back from the files."""

    @classmethod
    def name(cls) -> str:
        return "token_files"

    def schema(self) -> str:
        return SCHEMA

    def writer(self, schema: StructType, overwrite: bool) -> Writer:
        return Writer(self.options["path"], self.options["tokenizer"], int(self.options["end_id"]))

    def reader(self, schema: StructType) -> Reader:
        return Reader(self.options["path"])


class Writer(DataSourceArrowWriter):
    def __init__(self, path: str, tokenizer: str, end_id: int):
        self.path, self.tokenizer, self.end_id = path, tokenizer, end_id
        self.kind = width(tokenizer, end_id)

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Part:
        from pyspark import TaskContext

        encoder, order = _encoder(self.tokenizer), TaskContext.get().partitionId()
        part = Part(order, f"part-{order:06d}-{uuid.uuid4().hex}", 0, 0, 0)
        filesystem, inner = _place(self.path)
        with filesystem.open_output_stream(f"{inner}/{part.name}.bin") as ids_out, filesystem.open_output_stream(f"{inner}/{part.name}.off") as ends_out, filesystem.open_output_stream(f"{inner}/{part.name}.doc") as docs_out:
            ends_out.write(np.zeros(1, "<u8").tobytes())
            for batch in iterator:
                texts, docs = batch.column("text"), batch.column("doc_id")
                part.nulls += docs.null_count
                docs_out.write(docs.fill_null(0).to_numpy(zero_copy_only=False).astype("<i8").tobytes())
                sizes = pc.fill_null(pc.binary_length(texts), 0).to_pylist()
                for begin, end in _slices(sizes, CHARS):
                    ids, counts = encoder.encode(texts.slice(begin, end - begin))
                    ends = np.cumsum(counts)
                    ids_out.write(np.insert(ids, ends, self.end_id).astype(self.kind).tobytes())
                    ends += np.arange(1, len(ends) + 1)
                    ends_out.write((part.tokens + ends).astype("<u8").tobytes())
                    part.docs += len(ends)
                    part.tokens += int(ends[-1])
        return part

    def commit(self, messages: list[Part | None]) -> None:
        parts = sorted((m for m in messages if m is not None), key=lambda m: m.order)
        bases = [0, *accumulate(p.tokens for p in parts)]
        told = {"dtype": self.kind, "end_id": self.end_id, "parts": [{"name": p.name, "docs": p.docs, "nulls": p.nulls, "tokens": p.tokens, "base": base} for p, base in zip(parts, bases, strict=False)]}
        filesystem, inner = _place(self.path)
        with filesystem.open_output_stream(f"{inner}/{MANIFEST}") as out:
            out.write(json.dumps(told).encode())

    def abort(self, messages: list[Part | None]) -> None:
        filesystem, inner = _place(self.path)
        for m in messages:
            if m is not None:
                for kind in ("bin", "off", "doc"):
                    filesystem.delete_file(f"{inner}/{m.name}.{kind}")


class Stored:
    """A written folder: ``manifest``, and arrays over its parts' files, memory-mapped where they are local files."""

    def __init__(self, path: str):
        self.filesystem, self.inner = _place(path)
        with self.filesystem.open_input_stream(f"{self.inner}/{MANIFEST}") as f:
            self.manifest = json.loads(f.read())
        self.kind = np.dtype(self.manifest["dtype"])
        self.firsts = [0, *accumulate(p["docs"] for p in self.manifest["parts"])]
        self.mapped: dict[str, np.ndarray] = {}

    def array(self, file: str, kind: np.dtype, first: int, last: int) -> np.ndarray:
        """Items ``first`` to ``last`` of a file."""
        if last <= first:
            return np.empty(0, kind)
        if isinstance(self.filesystem, fs.LocalFileSystem):
            if file not in self.mapped:
                self.mapped[file] = np.memmap(f"{self.inner}/{file}", dtype=kind, mode="r")
            return self.mapped[file][first:last]
        size = np.dtype(kind).itemsize
        with self.filesystem.open_input_file(f"{self.inner}/{file}") as f:
            return np.frombuffer(f.read_at(size * (last - first), size * first), dtype=kind)

    def __len__(self) -> int:
        return self.firsts[-1]

    def document(self, k: int) -> np.ndarray:
        """Ids of document ``k``, counted from zero in order of doc_id."""
        if not 0 <= k < len(self):
            raise IndexError(k)
        at = bisect_right(self.firsts, k) - 1
        part, own = self.manifest["parts"][at], k - self.firsts[at]
        begin, end = self.array(f"{part['name']}.off", np.dtype("<u8"), own, own + 2).tolist()
        return self.array(f"{part['name']}.bin", self.kind, begin, end)


class Reader(DataSourceReader):
    def __init__(self, path: str):
        self.path = path

    def partitions(self) -> list[Piece]:
        pieces = []
        for p in Stored(self.path).manifest["parts"]:
            n = max(1, min(p["docs"], -(-p["tokens"] // PIECE)))
            edges = [p["docs"] * i // n for i in range(n + 1)]
            pieces += [Piece(p["name"], p["nulls"], p["docs"], p["base"], a, b) for a, b in zip(edges[:-1], edges[1:], strict=True)]
        return pieces or [Piece("", 0, 0, 0, 0, 0)]

    def read(self, partition: Piece) -> Iterator[pa.RecordBatch]:
        if partition.last == partition.first:
            return
        stored = Stored(self.path)
        offsets = np.asarray(stored.array(f"{partition.name}.off", np.dtype("<u8"), partition.first, partition.last + 1)).astype(np.int64)
        docs = np.asarray(stored.array(f"{partition.name}.doc", np.dtype("<i8"), partition.first, partition.last))
        counts = np.diff(offsets)
        for begin, end in _slices(counts.tolist(), BATCH):
            ids = stored.array(f"{partition.name}.bin", stored.kind, int(offsets[begin]), int(offsets[end])).astype("<u4")
            missing = np.arange(partition.first + begin, partition.first + end) < partition.nulls
            columns = [pa.array(docs[begin:end], mask=missing), pa.array(partition.base + offsets[begin:end]), pa.array(counts[begin:end]), _binary(ids, counts[begin:end])]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "start", "n_tokens", "ids"])


def width(tokenizer: str, end_id: int) -> str:
    """The narrowest unsigned type that holds all ids of the tokenizer and the end id."""
    return "<u2" if max(_encoder(tokenizer).tokenizer.get_vocab_size() - 1, end_id) < 1 << 16 else "<u4"


def _registered(spark: SparkSession) -> SparkSession:
    importable(spark).dataSource.register(TokenFiles)
    return spark


def write(docs: DataFrame, path: str, tokenizer: str, end_id: int = END_ID, doc_id: str = "doc_id", text: str = "text") -> None:
    """Encode each whole text, end it with ``end_id``, and write all in ascending order of doc_id to the new folder ``path``.

    Documents are dealt by ranges of doc_id (and of a hash of the text, so that many rows of
    one id are several ranges too) and sorted inside of a range, ties by text. Null and empty
    texts are the end id alone; rows without an id come first; repeated rows are written as
    often as they come; texts of any length are encoded whole. An empty table gives a folder
    of no documents. Other columns are ignored. ``tokenizer`` is a file's path on all machines.
    """
    spark = _registered(docs.sparkSession)
    filesystem, inner = _place(path)
    filesystem.create_dir(inner)
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    ranges = rows.repartitionByRange("doc_id", F.xxhash64("text")).sortWithinPartitions("doc_id", F.xxhash64("text"), "text")
    ranges.write.format(TokenFiles.name()).mode("append").options(path=path, tokenizer=tokenizer, end_id=str(end_id)).save()


def read(spark: SparkSession, path: str) -> DataFrame:
    """Documents as they stand in the files: doc_id, start (ids of all documents before it), n_tokens, ids (little-endian uint32, end id included)."""
    return _registered(spark).read.format(TokenFiles.name()).load(path)
