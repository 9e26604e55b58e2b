"""Benchmark decontamination by greedy string tiling with running Karp-Rabin matching.

A document and a benchmark item become a pair when they share a seed of ``MIN_MATCH``
words. For a pair, the longest match of unmarked words is marked again and again, until
none of ``MIN_TILE`` words is left; tiles never overlap, in either text. The share of the
item's words under tiles is its coverage, whatever the order of the tiles, so a passage
with its sentences moved around is still found, short sentences included.
"""

from __future__ import annotations

import heapq
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusflow.llm.common import saved

MIN_MATCH = 5
#: Tiles of a pair that shares a seed may be shorter than the seed.
MIN_TILE = 3
COVERAGE = 0.8
#: Items are matched in blocks of at most this many characters of text, each block shipped once.
BLOCK_CHARS = 4_000_000
_WORD = re.compile(r"\w+")
_BASE, _MOD = 1_000_003, (1 << 61) - 1


def tokens(text: str | None) -> list[str]:
    """Lower-cased words; null gives none."""
    return _WORD.findall((text or "").lower())


def rolling(ids: list[int], width: int) -> list[int]:
    """Karp-Rabin hashes of all windows of ``width`` ids, each made from the one before."""
    if len(ids) < width:
        return []
    top, h, out = pow(_BASE, width - 1, _MOD), 0, []
    for k, x in enumerate(ids):
        if k >= width:
            h = (h - (ids[k - width] + 1) * top) % _MOD
        h = (h * _BASE + x + 1) % _MOD
        if k >= width - 1:
            out.append(h)
    return out


def places(doc: list[int], item: list[int], width: int) -> list[tuple[int, int]]:
    """Places (in the document, in the item) at which a match of ``width`` ids or more starts, by rolling hashes.

    Places that go on from a match one step before aren't listed, so that the runs of a
    repetitive text count once for each shift, not once for each pair of places.
    """
    where: dict[int, dict[int, list[int]]] = {}
    for j, h in enumerate(rolling(item, width)):
        where.setdefault(h, {}).setdefault(item[j - 1] if j else -1, []).append(j)
    out = []
    for i, h in enumerate(rolling(doc, width)):
        if h in where:
            before = doc[i - 1] if i else -3
            out += [(i, j) for word, starts in where[h].items() if word != before for j in starts]
    return out


def tile(doc: list[int], item: list[int], seeds: list[tuple[int, int]], min_match: int = MIN_TILE) -> list[tuple[int, int, int]]:
    """Tiles (start in the document, start in the item, length), longest first.

    ``seeds`` are the places at which matches of ``min_match`` ids or more start. A match is
    verified word by word. Ties go to the smallest starts. A match that a longer tile has
    partly covered is cut to its free runs, which compete again. It ends early once fewer
    than ``min_match`` words of the item are free.
    """
    heap = []
    for i, j in seeds:
        n = 0
        while i + n < len(doc) and j + n < len(item) and doc[i + n] == item[j + n]:
            n += 1
        if n >= min_match:
            heap.append((-n, i, j))
    heapq.heapify(heap)
    in_doc: set[int] = set()
    in_item, left = bytearray(len(item)), len(item)
    tiles = []
    while heap and left >= min_match:
        n, i, j = heapq.heappop(heap)
        n = -n
        free = [not in_item[j + k] and i + k not in in_doc for k in range(n)]
        if all(free):
            tiles.append((i, j, n))
            in_doc.update(range(i, i + n))
            in_item[j : j + n] = b"\x01" * n
            left -= n
            continue
        start = None
        for k, ok in enumerate([*free, False]):
            if ok and start is None:
                start = k
            elif not ok and start is not None:
                if k - start >= min_match:
                    heapq.heappush(heap, (-(k - start), i + start, j + start))
                start = None
    return tiles


class Index:
    """The seeds of a block of benchmark items.

    A document is first searched for anchors: of each seed the longest word (ties: the
    first), so that most words of most documents cost one lookup and no hash.
    """

    def __init__(self, items: list[tuple[int, str | None]], min_match: int = MIN_MATCH) -> None:
        self.min_match = min_match
        self.vocab: dict[str, int] = {}
        self.items: list[tuple[int, list[int]]] = []
        self.seeds: dict[int, list[tuple[int, int]]] = {}
        self.anchors: dict[str, set[int]] = {}
        for key, text in items:
            words = tokens(text)
            if not words:
                continue
            ids = [self.vocab.setdefault(w, len(self.vocab)) for w in words]
            n = len(self.items)
            self.items.append((key, ids))
            width = min(min_match, len(ids))
            for j, h in enumerate(rolling(ids, width)):
                self.seeds.setdefault(h, []).append((n, j))
                at = max(range(width), key=lambda k: (len(words[j + k]), -k))
                self.anchors.setdefault(words[j + at], set()).add((at, width))

    def search(self, text: str | None, coverage: float = COVERAGE) -> list[tuple[int, float, int, int]]:
        """Items (id, coverage, number of tiles, longest tile) that the text covers."""
        words = tokens(text)
        anchors = self.anchors
        hits = [k for k, w in enumerate(words) if w in anchors]
        if not hits:
            return []
        starts = sorted({(k - at, width) for k in hits for at, width in anchors[words[k]] if 0 <= k - at <= len(words) - width})
        found: set[int] = set()
        for i, width in starts:
            window = [self.vocab.get(w, -2) for w in words[i : i + width]]
            if -2 in window:
                continue
            for n, j in self.seeds.get(rolling(window, width)[0], ()):
                if self.items[n][1][j : j + width] == window and width == min(self.min_match, len(self.items[n][1])):
                    found.add(n)
        if not found:
            return []
        doc = [self.vocab.get(w, -2) for w in words]
        out = []
        for n in sorted(found):
            key, item = self.items[n]
            width = min(MIN_TILE, len(item))
            tiles = tile(doc, item, places(doc, item, width), width)
            share = sum(t[2] for t in tiles) / len(item)
            if share >= coverage:
                out.append((key, share, len(tiles), max(t[2] for t in tiles)))
        return out


def _blocks(benchmark: DataFrame, chars: int) -> Iterator[list[tuple[int, str]]]:
    """The items in blocks of bounded size, in order of id; the driver holds one block at a time."""
    block, held = [], 0
    for r in benchmark.select("item_id", "text").where("text is not null").orderBy("item_id", "text").toLocalIterator():
        if block and held + len(r["text"]) > chars:
            yield block
            block, held = [], 0
        block.append((r["item_id"], r["text"]))
        held += len(r["text"])
    if block:
        yield block


def _found(docs: DataFrame, block: list[tuple[int, str]], coverage: float) -> DataFrame:
    """``docs`` searched for one block of items: doc_id and a hit for each item found."""
    shared = docs.sparkSession.sparkContext.broadcast(Index(block))
    names = ("item_id", "coverage", "n_tiles", "longest_tile")

    @F.pandas_udf("array<struct<item_id: long, coverage: double, n_tiles: int, longest_tile: int>>")
    def search(texts: pd.Series) -> pd.Series:
        return pd.Series([[dict(zip(names, hit, strict=True)) for hit in shared.value.search(t, coverage)] for t in texts], dtype=object)

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), search(docs["text"]).alias("hits")).select("doc_id", F.explode("hits").alias("hit"))


def leaks(docs: DataFrame, benchmark: DataFrame, coverage: float = COVERAGE, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """One row per document and item that it holds: doc_id, item_id, coverage, n_tiles, longest_tile.

    Documents stay where they are; the benchmark, whose size doesn't follow the corpus,
    goes to them in blocks of at most ``block_chars`` characters: its seeds are the side of
    the join that is broadcast. Each block is a pass of its own over the documents, whose result is
    written before the next block goes out, so no worker holds more than one block. Items of
    fewer than five words count if all their words stand together. Null and empty
    texts and items match nothing; repeated rows give repeated pairs; an empty table gives an
    empty result; other columns are ignored. Texts of any length are searched whole.
    """
    columns, out, last = ("doc_id", "hit.item_id", "hit.coverage", "hit.n_tiles", "hit.longest_tile"), None, None
    for block in _blocks(benchmark, block_chars):
        if last is not None:
            part = saved(_found(docs, last, coverage).select(*columns), "leaks")
            out = part if out is None else out.unionByName(part)
        last = block
    part = _found(docs, last or [], coverage).select(*columns)
    return part if out is None else out.unionByName(part)


def keep_unleaked(docs: DataFrame, benchmark: DataFrame, coverage: float = COVERAGE, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """The rows of ``docs`` that hold no item of the benchmark.

    Blocks of the benchmark are passes of their own over what the blocks before have left, as
    in ``leaks``. Null and empty texts hold nothing and stay; repeated rows stay or go
    together; an empty table gives an empty result, an empty benchmark all rows. Columns of ``docs``
    stay as they are, whatever they are called. Texts of any length are searched whole.
    """
    last = None
    for block in _blocks(benchmark, block_chars):
        if last is not None:
            docs = saved(_without(docs, last, coverage), "unleaked")
        last = block
    return docs if last is None else _without(docs, last, coverage)


def _without(docs: DataFrame, block: list[tuple[int, str]], coverage: float) -> DataFrame:
    shared = docs.sparkSession.sparkContext.broadcast(Index(block))

    @F.pandas_udf("boolean")
    def leaked(texts: pd.Series) -> pd.Series:
        return pd.Series(np.fromiter((bool(shared.value.search(t, coverage)) for t in texts), bool, len(texts)))

    return docs.where(~leaked(docs["text"]))
