"""Toxicity: a convolutional text classifier over hashed word embeddings, trained in numpy.

A word's vector is the mean of the embeddings of its hashed parts (the word, prefixes and a
suffix), so that an unseen form of a known stem is known too. Filters of several widths run
over the words, each filter's largest response is kept (max pooling over the whole text),
and a linear layer turns these into a log-odds.
"""

from __future__ import annotations

import copy
import re
from collections.abc import Iterable, Iterator
from zlib import crc32

import numpy as np
import pandas as pd
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusflow.llm.common import bounded_sample, free_name, held_out, saved

#: At most this many labelled rows of each class, by rank of a hash, start the model on the driver.
TRAIN_ROWS_PER_CLASS = 2500
#: Passes over all labelled rows where there are more, rows of a shard, rows read at a time, buckets that travel together.
PASSES, SHARD, _READ, _BLOCK = 2, 8192, 1024, 1024
THRESHOLD = 0.7
BUCKETS, DIM, WIDTHS, FILTERS = 1 << 17, 8, (1, 2, 3), 4
EPOCHS, BATCH, RATE = 8, 64, 0.05
_WORD = re.compile(r"[^\W\d_]+")
_CACHE_WORDS = 60_000
_PIECE = 400_000


def words_of(text: str | None) -> list[str]:
    """Lower-cased runs of letters; null gives none."""
    return _WORD.findall((text or "").lower())


def parts_of(word: str) -> tuple[int, ...]:
    """Buckets of a word's six parts."""
    named = ("w" + word, "3" + word[:3], "4" + word[:4], "5" + word[:5], "6" + word[:6], "s" + word[-4:])
    return tuple(crc32(x.encode("utf-8", "surrogatepass")) % BUCKETS for x in named)


def parts_table(words: Iterable[str]) -> np.ndarray:
    """``parts_of`` of each word, as rows."""
    return np.fromiter((b for w in words for b in parts_of(w)), np.int32).reshape(-1, 6)


class ConvText:
    """The classifier. ``score`` reads whole texts and works through them in pieces of bounded size."""

    def __init__(self, seed: int = 7) -> None:
        rng = np.random.default_rng(seed)
        self.emb = (rng.standard_normal((BUCKETS, DIM)) * 0.05).astype(np.float32)
        self.conv = [(rng.standard_normal((w, DIM, FILTERS)) * 0.3).astype(np.float32) for w in WIDTHS]
        self.out = np.full(FILTERS * len(WIDTHS), 0.1, np.float32)
        self.bias = 0.0
        self.scale, self.shift = 1.0, 0.0
        self.constant: float | None = None
        self.thresholds: dict[str, float] = {}

    def __getstate__(self) -> dict:
        return {k: v for k, v in self.__dict__.items() if not k.startswith("_")}

    # -- training ---------------------------------------------------------------------
    def fit(self, texts: list[str | None], labels: np.ndarray, seed: int = 7) -> ConvText:
        labels = np.asarray(labels, np.float32)
        if not len(labels) or labels.min() == labels.max():
            self.constant = float((labels.sum() + 0.0) / len(labels)) if len(labels) else 0.0
            return self
        vocab: dict[str, int] = {}
        docs = [np.fromiter((vocab.setdefault(w, len(vocab)) for w in words_of(t)), np.int32) for t in texts]
        parts = parts_table(vocab)
        del vocab, texts
        self._start(docs, labels, parts)
        rng = np.random.default_rng(seed)
        sums = [np.full(x.shape, 1e-2, np.float32) for x in (self.emb, *self.conv, self.out)]
        weight = np.where(labels == 1, 0.5 / labels.mean(), 0.5 / (1 - labels.mean())).astype(np.float32)
        for _ in range(EPOCHS):
            order = rng.permutation(len(docs))
            for k in range(0, len(order), BATCH):
                take = order[k : k + BATCH]
                self._step([docs[i] for i in take], labels[take], weight[take], parts, sums)
        self._sums = sums
        return self

    def _start(self, docs: list[np.ndarray], labels: np.ndarray, parts: np.ndarray) -> None:
        """Let one dimension of the embeddings begin as the log-odds of a bucket's presence."""
        seen = np.ones((2, BUCKETS))
        for d, y in zip(docs, labels, strict=True):
            seen[int(y), np.unique(parts[np.unique(d)])] += 1
        n = np.array([(labels == 0).sum(), (labels == 1).sum()]) + 2.0
        odds = np.log(seen[1] / n[1]) - np.log(seen[0] / n[0])
        odds[(seen.sum(axis=0) <= 2)] = 0
        self.emb[:, 0] = np.clip(odds, -1, 4)
        for c in self.conv:
            c[:, 0, 0] = 1.0 / len(c)

    def _responses(self, x: np.ndarray, bounds: np.ndarray) -> list[np.ndarray]:
        """Filter responses at each place; places whose window leaves a text have none (-inf)."""
        out = []
        for c in self.conv:
            r = x @ c[0]
            for k in range(1, len(c)):
                r[:-k] += (x @ c[k])[k:] if len(x) > k else 0
            r = np.maximum(r, 0)
            for k in range(1, len(c)):  # windows over the end of a text
                r[np.maximum(bounds[1:] - k, bounds[:-1])] = 0
            out.append(r)
        return out

    def _step(self, docs: list, y: np.ndarray, weight: np.ndarray, parts: np.ndarray, sums: list) -> None:
        full = [d if len(d) else np.zeros(1, np.int32) for d in docs]
        flat = np.concatenate(full)
        bounds = np.concatenate(([0], np.cumsum([len(d) for d in full])))
        uniq, inv = np.unique(flat, return_inverse=True)
        x = self.emb[parts[uniq]].mean(axis=1)[inv]
        seg = np.repeat(np.arange(len(full)), np.diff(bounds))
        resp = self._responses(x, bounds)
        pooled = np.concatenate([np.maximum.reduceat(r, bounds[:-1], axis=0) for r in resp], axis=1)
        empty = np.array([not len(d) for d in docs])
        pooled[empty] = 0
        p = 1 / (1 + np.exp(-np.clip(pooled @ self.out + self.bias, -30, 30)))
        g = ((p - y) * weight / len(docs)).astype(np.float32)
        g_out, g_pool = pooled.T @ g, g[:, None] * self.out[None, :]
        g_conv, places, grads = [np.zeros_like(c) for c in self.conv], [], []
        for n, (c, r) in enumerate(zip(self.conv, resp, strict=True)):
            for f in range(FILTERS):
                top = pooled[:, n * FILTERS + f]
                at = np.flatnonzero((r[:, f] == top[seg]) & (r[:, f] > 0))
                if not len(at):
                    continue
                d, first = np.unique(seg[at], return_index=True)
                at = at[first]
                gd = g_pool[d, n * FILTERS + f]
                for k in range(len(c)):
                    ok = at + k < bounds[d + 1]
                    g_conv[n][k, :, f] += gd[ok] @ x[at[ok] + k]
                    places.append(at[ok] + k)
                    grads.append(gd[ok, None] * c[k, :, f][None, :])
        self._adagrad(self.out, g_out, sums[-1])
        for c, gc, s in zip(self.conv, g_conv, sums[1:-1], strict=True):
            self._adagrad(c, gc, s)
        self.bias -= RATE * float(g.sum())
        if places:
            rows = parts[flat[np.concatenate(places)]]
            grad = np.repeat(np.concatenate(grads) / rows.shape[1], rows.shape[1], axis=0)
            rows, where = np.unique(rows.ravel(), return_inverse=True)
            total = np.zeros((len(rows), DIM), np.float32)
            np.add.at(total, where, grad)
            sums[0][rows] += total**2
            self.emb[rows] -= RATE * total / np.sqrt(sums[0][rows])

    @staticmethod
    def _adagrad(x: np.ndarray, g: np.ndarray, s: np.ndarray) -> None:
        s += g**2
        x -= RATE * g / np.sqrt(s)

    # -- scoring ----------------------------------------------------------------------
    def _table(self) -> np.ndarray:
        """Each filter's responses are linear in a word, so they are made once for a word."""
        return np.concatenate([c[k] for c in self.conv for k in range(len(c))], axis=1)

    def raw(self, texts: list[str | None]) -> np.ndarray:
        """Log-odds of each text, before calibration."""
        if "_ids" not in self.__dict__ or len(self._ids) > _CACHE_WORDS:
            self._ids, self._rows, self._wide = {}, np.zeros((0, self._table().shape[1]), np.float32), self._table()
        ids, out, buf, lens = self._ids, [], [], []
        held, pieces = 0, []

        def flush() -> None:
            nonlocal held
            if not lens:
                return
            new = list(ids)[len(self._rows) :]
            if new:
                vec = self.emb[parts_table(new)].mean(axis=1)
                self._rows = np.concatenate((self._rows, vec @ self._wide))
            out.append(self._pool(np.array(buf, np.int64), np.array(lens)))
            buf.clear()
            lens.clear()
            held = 0

        for t in texts:
            w = words_of(t)
            pieces.append(max(1, -(-len(w) // _PIECE)))
            for a in range(0, max(1, len(w)), _PIECE):
                # a text longer than a piece is pooled piece by piece, with overlaps of the widest filter
                part = w[a : a + _PIECE + max(WIDTHS) - 1]
                buf.extend([ids.setdefault(x, len(ids)) for x in part])
                lens.append(len(part))
                held += len(part)
                if len(w) > _PIECE:
                    flush()
            if held > _PIECE:
                flush()
        flush()
        if not out:
            return np.zeros(0)
        # the pieces of one text are pooled together
        pooled, first = np.concatenate(out), np.concatenate(([0], np.cumsum(pieces[:-1]))).astype(int)
        return np.maximum.reduceat(pooled, first, axis=0) @ self.out + self.bias

    def _pool(self, flat: np.ndarray, lens: np.ndarray) -> np.ndarray:
        pooled = np.zeros((len(lens), FILTERS * len(WIDTHS)), np.float32)
        some = np.flatnonzero(lens)
        if not len(some):
            return pooled
        bounds = np.concatenate(([0], np.cumsum(lens[some])))
        at = 0
        for n, c in enumerate(self.conv):
            r = self._rows[flat, at : at + FILTERS]
            for k in range(1, len(c)):
                more = self._rows[flat, at + k * FILTERS : at + (k + 1) * FILTERS]
                r[:-k] += more[k:]
            for k in range(1, len(c)):
                r[np.maximum(bounds[1:] - k, bounds[:-1])] = 0
            pooled[some, n * FILTERS : (n + 1) * FILTERS] = np.maximum(np.maximum.reduceat(r, bounds[:-1], axis=0), 0)
            at += FILTERS * len(c)
        return pooled

    def score(self, texts: list[str | None]) -> np.ndarray:
        """Probability that each text is toxic."""
        if self.constant is not None:
            return np.full(len(texts), self.constant)
        return 1 / (1 + np.exp(-np.clip(self.raw(texts) * self.scale + self.shift, -30, 30)))

    def calibrate(self, texts: list[str | None], labels: np.ndarray, langs: list[str | None], weights: np.ndarray | None = None) -> ConvText:
        """Scale the log-odds by Platt's method, then move them so that the best cut has the score ``THRESHOLD``.

        The best cut has the largest F1 over rows weighted by how many rows of the corpus
        each stands for. A language where another cut is better gets its own threshold; one
        with fewer than 20 rows or one class keeps the general one.
        """
        labels = np.asarray(labels, float)
        weights = np.ones(len(labels)) if weights is None else np.asarray(weights, float)
        if self.constant is not None or not len(labels) or labels.min() == labels.max():
            return self
        return self.calibrate_values(self.raw(texts).astype(float), labels, langs, weights, np.ones(len(labels)))

    def calibrate_values(self, z: np.ndarray, labels: np.ndarray, langs: list[str | None], weights: np.ndarray, times: np.ndarray) -> ConvText:
        """``calibrate`` by log-odds ``z``, each of which is that of ``times`` rows; labels are of both classes."""
        mean = np.average(z, weights=times)
        spread = np.sqrt(np.average((z - mean) ** 2, weights=times)) + 1e-9
        u, a, b = (z - mean) / spread, 1.0, 0.0
        positive, negative = (labels * times).sum(), ((1 - labels) * times).sum()
        soft = np.where(labels == 1, (positive + 1) / (positive + 2), 1 / (negative + 2))
        for _ in range(60):
            p = 1 / (1 + np.exp(-np.clip(a * u + b, -30, 30)))
            w, off = times * (p * (1 - p) + 1e-9), times * (p - soft)
            h = np.array([[(w * u * u).sum() + 1e-6, (w * u).sum()], [(w * u).sum(), w.sum() + 1e-6]])
            step = np.linalg.solve(h, [(off * u).sum(), off.sum()])
            step *= min(1.0, 2.0 / (np.abs(step).max() + 1e-12))
            a, b = a - step[0], b - step[1]
        self.scale = a / spread if a > 0 else 1.0
        low, high, _ = best_gap(z, labels, weights)
        cut = (low + high) / 2
        self.shift = float(np.log(THRESHOLD / (1 - THRESHOLD)) - self.scale * cut)
        for lang in sorted({x for x in langs if x}):
            own = np.array([x == lang for x in langs])
            if times[own].sum() >= 20 and 0 < labels[own].sum() < own.sum():
                low, high, f1 = best_gap(z[own], labels[own], weights[own])
                general = f1_at(z[own] >= cut, labels[own], weights[own])
                # few rows leave a wide gap: stay at its end that is nearer to the general cut
                better = high - 0.1 * (high - low) if cut > high else low + 0.1 * (high - low)
                self.thresholds[lang] = THRESHOLD if general >= f1 - 1e-9 else float(1 / (1 + np.exp(-(self.scale * better + self.shift))))
        # the words met here are of no use to the driver any more
        self.__dict__ = self.__getstate__()
        return self


def f1_at(said: np.ndarray, label: np.ndarray, weight: np.ndarray) -> float:
    return float(2 * (weight * label * said).sum() / ((weight * said).sum() + (weight * label).sum()))


def best_gap(z: np.ndarray, label: np.ndarray, weight: np.ndarray) -> tuple[float, float, float]:
    """The gap between values in which a cut has the largest weighted F1 (low, high), and that F1; ties go to the highest."""
    order = np.argsort(-z, kind="stable")
    s, y, w = z[order], label[order], weight[order]
    f1 = 2 * np.cumsum(w * y) / (np.cumsum(w) + (w * y).sum())
    f1[:-1][s[:-1] == s[1:]] = -1
    k = int(np.argmax(f1))
    return float(s[k + 1] if k + 1 < len(s) else s[k] - 1.0), float(s[k]), float(f1[k])


def _shard(batches: Iterator[pd.DataFrame], shared: Broadcast, weight: dict[int, float]) -> Iterator[pd.DataFrame]:
    """What a pass over a shard's rows (text, y) changes in the model: rows (block, rows, delta); block -1 is all but the embeddings."""
    start, sums = shared.value
    model, sums, rows = copy.deepcopy(start), [x.copy() for x in sums], 0
    for batch in batches:
        for k in range(0, len(batch), _READ):
            part = batch.iloc[k : k + _READ]
            vocab: dict[str, int] = {}
            docs = [np.fromiter((vocab.setdefault(w, len(vocab)) for w in words_of(t)), np.int32) for t in part["text"]]
            parts, y = parts_table(vocab or [""]), part["y"].to_numpy(np.float32)
            own = np.array([weight[int(v)] for v in y], np.float32)
            for i in range(0, len(docs), BATCH):
                model._step(docs[i : i + BATCH], y[i : i + BATCH], own[i : i + BATCH], parts, sums)
            rows += len(part)
    if rows:
        blocks = np.split(model.emb - start.emb, range(_BLOCK, BUCKETS, _BLOCK))
        yield pd.DataFrame({"block": range(len(blocks)), "rows": rows, "delta": [x.tobytes() for x in blocks]})
        yield pd.DataFrame({"block": [-1], "rows": [rows], "delta": [(_others(model) - _others(start)).tobytes()]})


def _others(model: ConvText) -> np.ndarray:
    return np.concatenate([*(c.ravel() for c in model.conv), model.out, [model.bias]]).astype(np.float32)


def _mean_change(shards: pd.DataFrame) -> pd.DataFrame:
    """The mean change of a block by rows; that of a bucket over the shards that changed it, so that rare words count in full."""
    block, width = int(shards["block"].iloc[0]), DIM if shards["block"].iloc[0] >= 0 else 1
    total = count = 0
    for rows, delta in zip(shards["rows"], shards["delta"], strict=True):
        change = np.frombuffer(delta, np.float32).reshape(-1, width).astype(float)
        met = rows * (change.any(axis=1, keepdims=True) if block >= 0 else np.ones((len(change), 1)))
        total, count = total + met * change, count + met
    return pd.DataFrame({"block": [block], "delta": [(total / np.maximum(count, 1)).astype(np.float32).tobytes()]})


def _pass(model: ConvText, sums: list[np.ndarray], rows: DataFrame, shards: int, weight: dict[int, float]) -> ConvText:
    """The model after one pass over all ``rows`` (id, text, y): each shard goes on from it, and the changes are averaged on Spark."""
    shared = rows.sparkSession.sparkContext.broadcast((model, sums))
    order = F.xxhash64("id", F.lit("order"))
    dealt = rows.withColumn("shard", F.pmod(F.xxhash64("id"), F.lit(shards)).cast("int")).repartitionById(shards, "shard").sortWithinPartitions(order, "id")
    changes = dealt.select("text", "y").mapInPandas(lambda batches: _shard(batches, shared, weight), "block int, rows long, delta binary")
    means = {r["block"]: np.frombuffer(r["delta"], np.float32) for r in changes.groupBy("block").applyInPandas(_mean_change, "block int, delta binary").collect()}
    out = copy.deepcopy(model)
    others = _others(model) + means.pop(-1)
    for b, delta in means.items():
        out.emb[b * _BLOCK : (b + 1) * _BLOCK] += delta.reshape(-1, DIM)
    at = 0
    for x in (*out.conv, out.out):
        x[...] = others[at : at + x.size].reshape(x.shape)
        at += x.size
    out.bias = float(others[at])
    shared.destroy()
    return out


def train(docs: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS_PER_CLASS) -> ConvText:
    """Fit on all labelled rows of ``docs`` that aren't held out.

    At most ``rows`` of each class start the model on the driver; where there are more, ``PASSES`` passes
    over all of them follow on Spark, in shards of about ``SHARD`` rows. A fifth of the rows (by hash)
    calibrates scores and thresholds and isn't trained on: all of that fifth, as counts of log-odds
    rounded to thousandths. Without labels the score is 0 for all; with labels of one class it is that class.
    """
    lab = labels.select(F.col("doc_id").alias("__id"), F.col("toxic").cast("int").alias("__y")).where("__y in (0, 1)").groupBy("__id").agg(F.max("__y").alias("__y"))
    lab = lab.where(~held_out(F.col("__id")))
    whole = {r["__y"]: r["n"] for r in lab.groupBy("__y").agg(F.count(F.lit(1)).alias("n")).collect()}
    picked = bounded_sample(lab, "__id", "__y", rows)
    # of an id with several texts the first counts, so that repeated rows can't swell the sample
    one = F.min(F.struct("text", "lang", "__y")).alias("one")
    named = docs.select(F.col("doc_id").alias("__id"), "text", "lang")
    got = named.join(F.broadcast(picked), "__id").groupBy("__id").agg(one).select("__id", "one.*").orderBy("__id").collect()
    fold = np.array([crc32(b"fold%d" % r["__id"]) % 5 == 0 for r in got], bool)
    y = np.array([r["__y"] for r in got], np.float32)
    stands_for = np.array([whole[r["__y"]] / min(rows, whole[r["__y"]]) for r in got])
    fitted, apart = ([(r["text"], r["lang"]) for r, f in zip(got, fold, strict=True) if f == side] for side in (False, True))
    got.clear()
    model = ConvText().fit([t for t, _ in fitted], y[~fold])
    if model.constant is not None or max(whole.values()) <= rows:
        return model.calibrate([t for t, _ in apart], y[fold], [lang for _, lang in apart], stands_for[fold])

    known = named.join(lab, "__id").groupBy("__id").agg(one).select(F.col("__id").alias("id"), "one.text", "one.lang", F.col("one.__y").alias("y"))
    known = saved(known.withColumn("fold", F.crc32(F.concat(F.lit("fold"), F.col("id").cast("string")).cast("binary")) % 5 == 0), "labelled")
    counts = {r["y"]: r["n"] for r in known.where("not fold").groupBy("y").agg(F.count(F.lit(1)).alias("n")).collect()}
    n, sums = sum(counts.values()), model._sums
    for _ in range(PASSES):
        model = _pass(model, sums, known.where("not fold").select("id", "text", "y"), max(1, -(-n // SHARD)), {k: 0.5 * n / v for k, v in counts.items()})
    z = F.round(raw_scores(known, model), 3)
    apart = known.where("fold").select(z.alias("z"), "y", "lang").groupBy("z", "y", "lang").agg(F.count(F.lit(1)).alias("n")).orderBy("z", "y", "lang").toPandas()
    both, times = apart["y"].to_numpy(float), apart["n"].to_numpy(float)
    if not len(both) or both.min() == both.max():
        return model
    return model.calibrate_values(apart["z"].to_numpy(float), both, apart["lang"].tolist(), times, times)


def raw_scores(docs: DataFrame, model: ConvText, text: str = "text") -> Column:
    """Column expression: the model's log-odds of a text column before calibration."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf(T.DoubleType())
    def raw(texts: pd.Series) -> pd.Series:
        return pd.Series(shared.value.raw(texts.tolist()).astype(float))

    return raw(docs[text])


def scores(docs: DataFrame, model: ConvText, text: str = "text") -> Column:
    """Column expression: the model's score of a text column."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf(T.DoubleType())
    def score(texts: pd.Series) -> pd.Series:
        return pd.Series(shared.value.score(texts.tolist()).astype(float))

    return score(docs[text])


def thresholds(model: ConvText, lang: str = "lang") -> Column:
    """Column expression: the calibrated threshold of a row's language, or the general one."""
    out = F.lit(THRESHOLD)
    for k, v in sorted(model.thresholds.items()):
        out = F.when(F.col(lang) == k, F.lit(v)).otherwise(out)
    return out


def classify(docs: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS_PER_CLASS) -> DataFrame:
    """One row per document: doc_id, held_out, score, predicted, lang_threshold, flagged.

    ``predicted`` is 1 at the general threshold of 0.7, ``flagged`` compares with the
    threshold calibrated for the row's language (null or unknown language: the general one).
    Null and empty texts get the score of a text without words. Repeated rows give repeated
    rows, an empty table an empty result; other columns are ignored.
    """
    model = train(docs, labels, rows)
    scored = docs.select(F.col("doc_id"), held_out(F.col("doc_id")).alias("held_out"), scores(docs, model).alias("score"), thresholds(model).alias("lang_threshold"))
    return scored.select("doc_id", "held_out", "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"), "lang_threshold", (F.col("score") >= F.col("lang_threshold")).alias("flagged"))


def keep_clean(docs: DataFrame, known: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS_PER_CLASS) -> DataFrame:
    """The rows of ``docs`` that the model, fitted on ``known``, doesn't reject.

    A row goes if its score reaches the threshold calibrated for its language (null or
    unknown language: the general one). Null and empty texts have the score of a text without
    words, and texts of any length are read whole. Repeated rows stay or go together, an
    empty table gives an empty result, and columns of ``docs`` stay as they are, whatever
    they are called. Without labels all rows stay; with labels of one class that class decides.
    """
    model = train(known, labels, rows)
    score = free_name(docs, "score")
    return docs.withColumn(score, scores(docs, model)).where(F.col(score) < thresholds(model)).drop(score)
