"""Quality: ordinal cumulative-link regression on graded ratings over hashed text.

Grades are ordered: 0 low quality, 1 good but toxic, 2 good. One weight vector is shared by
all cut points, and ordered thresholds turn a text's value ``s`` into
``P(grade <= k) = sigmoid(theta_k - s)``; from these follow the expected grade and the
probability of the tail ``grade >= k`` that selection uses.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterable
from itertools import islice
from operator import eq
from zlib import crc32

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusflow.llm.common import bounded_sample, free_name, held_out

#: The model is fitted on at most this many labelled rows of each grade, by rank of a hash.
TRAIN_ROWS_PER_GRADE = 2500
#: A document stays if ``P(grade >= TAIL_GRADE)`` is at least ``KEEP``.
TAIL_GRADE, KEEP = 1, 0.5
GRADES = 3
BUCKETS = 1 << 15
STEPS, RATE, PENALTY = 120, 0.15, 2e-6
_CACHE_WORDS = 60_000
_CHUNK = 500
_AGAIN = re.compile(r"(.)\1+", re.S)


def _bucket(kind: str, name: str) -> int:
    return crc32((kind + name).encode("utf-8", "surrogatepass")) % BUCKETS


class _Kinds(dict):
    """A character's kind by code point, found once for each character."""

    def __missing__(self, code: int) -> str:
        c = chr(code)
        self[code] = kind = "A" if c.isupper() else "a" if c.isalpha() else "0" if c.isdecimal() else c
        return kind


def shape_of(token: str) -> str:
    """A token's letter case, digits and signs, with runs of the same kind made one."""
    return _AGAIN.sub(r"\1", token.translate(_KINDS))


_KINDS = _Kinds()


class _Words:
    """Buckets of a token's two features, kept for the tokens met so far (bounded)."""

    def __init__(self) -> None:
        self.known: dict[str, tuple[int, int]] = {}

    def of(self, token: str) -> tuple[int, int]:
        got = self.known.get(token)
        if got is None:
            if len(self.known) > _CACHE_WORDS:
                self.known.clear()
            got = self.known[token] = (_bucket("w", token.lower()), _bucket("s", shape_of(token)))
        return got


_WORDS = _Words()


def features(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """Buckets and values of one text: shares of words and of shapes, and a few graded ratios of the whole text."""
    tokens = (text or "").split()
    n = len(tokens)
    if not n:
        return np.array([_bucket("d", "empty")]), np.array([1.0])
    counts = Counter(tokens)
    pairs = np.array([_WORDS.of(t) for t in counts])
    share = np.fromiter(counts.values(), float, len(counts)) / n
    same = sum(map(eq, tokens, tokens[1:])) / n
    fresh = len(counts) / n
    extra = [_bucket("d", f"same{min(9, int(same * 20))}"), _bucket("d", f"fresh{int(fresh * 10)}.{min(5, n.bit_length() // 3)}"), _bucket("d", f"long{n.bit_length()}")]
    idx = np.concatenate((pairs[:, 0], pairs[:, 1], extra))
    return idx, np.concatenate((share, 4 * share, np.full(len(extra), 0.5)))


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -35, 35)))


class CumulativeLink:
    """Weights and ordered thresholds. Without labels every text gets the middle of the grades."""

    def __init__(self) -> None:
        self.weights = np.zeros(BUCKETS)
        self.theta = np.array([-1.0, 1.0])

    def fit(self, rows: Iterable[tuple[np.ndarray, np.ndarray]], grades: np.ndarray) -> CumulativeLink:
        grades = np.asarray(grades, int)
        if not len(grades):
            return self
        if grades.min() == grades.max():
            self.theta = np.where(np.arange(GRADES - 1) < grades[0], -20.0, 20.0)
            return self
        weight = (len(grades) / len(np.unique(grades)) / np.bincount(grades, minlength=GRADES).clip(1))[grades] / len(grades)
        # rows are gone through in chunks, so that the working arrays stay small
        chunks, left = [], iter(rows)
        for k in range(0, len(grades), _CHUNK):
            part = list(islice(left, _CHUNK))
            own = np.repeat(np.arange(len(part), dtype=np.int32), [len(r[0]) for r in part])
            chunks.append((np.concatenate([r[0] for r in part]).astype(np.int32), np.concatenate([r[1] for r in part]).astype(np.float32), own, grades[k : k + _CHUNK], weight[k : k + _CHUNK]))
        # the second threshold is the first plus a positive gap, so that they stay in order
        first, gap = -0.5, 0.0
        state = {k: [0.0, 0.0] for k in ("w", "a", "b")}
        for t in range(1, STEPS + 1):
            theta = np.array([first, first + np.exp(gap)])
            g_w, g_theta = PENALTY * self.weights, np.zeros(GRADES - 1)
            for idx, val, own, y, share in chunks:
                s = np.bincount(own, self.weights[idx] * val, len(y))
                upper = np.where(y < GRADES - 1, _sigmoid(theta[np.minimum(y, GRADES - 2)] - s), 1.0)
                lower = np.where(y > 0, _sigmoid(theta[np.maximum(y - 1, 0)] - s), 0.0)
                p = (upper - lower).clip(1e-9)
                du, dl = upper * (1 - upper) / p * share, lower * (1 - lower) / p * share
                np.add.at(g_theta, np.minimum(y, GRADES - 2), np.where(y < GRADES - 1, -du, 0))
                np.add.at(g_theta, np.maximum(y - 1, 0), np.where(y > 0, dl, 0))
                g_w += np.bincount(idx, (du - dl)[own] * val, BUCKETS)
            steps = {"w": g_w, "a": g_theta.sum() + 1e-3 * first, "b": g_theta[1] * np.exp(gap) + 1e-2 * gap}
            for k, g in steps.items():
                m, v = state[k]
                state[k] = [0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g]
                steps[k] = RATE * state[k][0] / (1 - 0.9**t) / (np.sqrt(state[k][1] / (1 - 0.999**t)) + 1e-8)
            self.weights -= steps["w"]
            first, gap = first - steps["a"], gap - steps["b"]
        self.theta = np.array([first, first + np.exp(gap)])
        return self

    def values(self, texts: list[str | None]) -> np.ndarray:
        out = np.empty(len(texts))
        for i, t in enumerate(texts):
            idx, val = features(t)
            out[i] = self.weights[idx] @ val
        return out

    def tails(self, texts: list[str | None]) -> np.ndarray:
        """``P(grade >= 1)`` and ``P(grade >= 2)`` of each text, as columns."""
        return 1 - _sigmoid(self.theta[None, :] - self.values(texts)[:, None])


def train(docs: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS_PER_GRADE) -> CumulativeLink:
    """Fit on labelled rows of ``docs`` that aren't held out, at most ``rows`` of each grade."""
    lab = labels.select(F.col("doc_id").alias("__id"), F.col("quality").cast("int").alias("__q"), F.coalesce(F.col("toxic").cast("int"), F.lit(0)).alias("__t"))
    lab = lab.where("__id is not null and __q in (0, 1)").groupBy("__id").agg(F.min("__q").alias("__q"), F.max("__t").alias("__t"))
    lab = lab.where(~held_out(F.col("__id"))).select("__id", F.expr("case when __q = 0 then 0 when __t = 1 then 1 else 2 end").alias("__grade"))
    picked = bounded_sample(lab, "__id", "__grade", rows)
    # of an id with several texts the first counts, so that repeated rows can't swell the sample
    sample = docs.select(F.col("doc_id").alias("__id"), "text").join(F.broadcast(picked), "__id").groupBy("__id", "__grade").agg(F.min("text").alias("text"))

    def made(batches):
        for pdf in batches:
            rows = [features(t) for t in pdf["text"]]
            yield pd.DataFrame({"id": pdf["__id"], "grade": pdf["__grade"], "idx": [r[0].astype(np.int32).tobytes() for r in rows], "val": [r[1].astype(np.float32).tobytes() for r in rows]})

    got = sample.select("__id", "text", "__grade").mapInPandas(made, "id long, grade int, idx binary, val binary").collect()
    got.sort(key=lambda r: (r["id"], bytes(r["idx"])))
    grades = np.array([r["grade"] for r in got], int)
    got.reverse()
    # each row is given up as it goes into a chunk
    given = (got.pop() for _ in range(len(got)))
    return CumulativeLink().fit(((np.frombuffer(r["idx"], np.int32), np.frombuffer(r["val"], np.float32)) for r in given), grades)


def _scored(docs: DataFrame, model: CumulativeLink, name: str) -> DataFrame:
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("at1 double, at2 double")
    def tails(texts: pd.Series) -> pd.DataFrame:
        p = shared.value.tails(texts.tolist())
        return pd.DataFrame({"at1": p[:, 0], "at2": p[:, 1]})

    return docs.withColumn(name, tails(docs["text"]))


def rate(docs: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS_PER_GRADE) -> DataFrame:
    """One row per document: doc_id, held_out, expected_grade, p_tail (``P(grade >= 1)``), p_top, keep.

    Only the text is read for the grade. Null and empty texts get the value of an empty text;
    repeated rows give repeated rows and an empty table an empty result; other columns are
    ignored. Without labels all documents get the middle grade and stay; with ratings of one
    grade all get that grade.
    """
    model = train(docs, labels, rows)
    p = _scored(docs.select("doc_id", "text"), model, "p")
    return p.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), (F.col("p.at1") + F.col("p.at2")).alias("expected_grade"), F.col("p.at1").alias("p_tail"), F.col("p.at2").alias("p_top"), (F.col(f"p.at{TAIL_GRADE}") >= KEEP).alias("keep"))


def keep_good(docs: DataFrame, known: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS_PER_GRADE) -> DataFrame:
    """The rows of ``docs`` whose tail probability, by a model fitted on ``known``, reaches ``KEEP``.

    Null and empty texts have the value of an empty text, and texts of any length are read
    whole. Repeated rows stay or go together, an empty table gives an empty result, and columns
    of ``docs`` stay as they are, whatever they are called. Without labels all rows stay.
    """
    model = train(known, labels, rows)
    tail = free_name(docs, "tail")
    return _scored(docs, model, tail).where(F.col(tail)[f"at{TAIL_GRADE}"] >= KEEP).drop(tail)
