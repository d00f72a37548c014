"""A factorisation machine for document quality.

Inputs are hashed words (presence, scaled by the root of their number), structure
statistics and the text's own size; labels, language, source and id are never
inputs. The score is sigmoid(w0 + w.x + sum over pairs of <v_i, v_j> x_i x_j); the
pairs cost linear time, as half of (sum of v x)^2 - sum of (v x)^2.

Learning takes a bounded sample, at most TRAIN_ROWS labelled documents of least
hash among those that the table has, from rows outside the held-out fifth. A step of
learning touches only the weights of the words in its batch. The model has BUCKETS
rows of a few numbers and travels with the scoring function. Scoring streams Arrow
batches of whole texts and shuffles nothing.

Defined cases: null texts are scored as empty ones; a null id counts as held out
(crc32 of the empty text is 0). Repeated labels of one id count once, at their
lowest; null labels are ignored. Of several texts of one id the greatest is learnt
from. Without any label the score is 0.5 for all. Very long texts are scored whole;
of equal scores none goes before another. Repeated rows are scored each. Columns beyond
doc_id and text are not looked at, whatever their names. No rows in, no rows out.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parkwright.llm.shared import slices

TRAIN_ROWS, BUCKETS, RANK, EPOCHS, BATCH, CUTOFF = 6_000, 1 << 16, 6, 12, 128, 0.3
UPPER, DIGITS, SYMBOLS = bytes(range(65, 91)), b"0123456789", b"#*$%&|<>"
MARKS = b"!?.,;:"
STATS = 16


def features(text: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Structure statistics, and the distinct hash buckets of the words, of UTF-8 ``text``."""
    words, size = text.split(), len(text)
    n, unique = len(words), set(words)
    lines = [x for x in text.split(b"\n") if x.strip()]
    share = lambda marks: size - len(text.translate(None, marks))
    letters = max(1, size - share(b" \n\t"))
    stats = np.array([
        np.log1p(n), np.log1p(size), len(unique) / max(n, 1), len(set(zip(words, words[1:], strict=False))) / max(n - 1, 1),
        letters / max(n, 1), share(UPPER) / letters, share(DIGITS) / letters, share(SYMBOLS) / max(n, 1),
        share(MARKS) / max(n, 1), share(b"!") / max(n, 1), share(b"|") / max(n, 1), np.log1p(len(lines)),
        len(set(lines)) / max(len(lines), 1), n / max(len(lines), 1) / 50, max(map(len, unique), default=0) / 20, float(n < 3),
    ])
    crc = zlib.crc32
    buckets = np.unique(np.fromiter((crc(w) for w in unique), np.int64, len(unique)) % BUCKETS) if unique else np.zeros(0, np.int64)
    return stats, buckets


class Machine:
    """The learned weights, and scores from them."""

    def __init__(self, mean: np.ndarray, spread: np.ndarray, w0: float, w: np.ndarray, v: np.ndarray):
        self.mean, self.spread, self.w0, self.w, self.v = mean, spread, w0, w, v

    def dense(self, stats: np.ndarray) -> np.ndarray:
        return np.clip((stats - self.mean) / self.spread, -4, 4)

    def score(self, texts: list[bytes]) -> np.ndarray:
        z, sums, squares = np.empty(len(texts)), np.empty((len(texts), RANK)), np.empty((len(texts), RANK))
        stats = np.empty((len(texts), STATS))
        vv = self.v**2
        for i, text in enumerate(texts):
            stats[i], at = features(text)
            x = 1 / np.sqrt(max(len(at), 1))
            at = at + STATS
            z[i], sums[i], squares[i] = self.w[at].sum() * x, self.v[at].sum(0) * x, vv[at].sum(0) * x * x
        d = self.dense(stats)
        sums += d @ self.v[:STATS]
        squares += d**2 @ vv[:STATS]
        z += self.w0 + d @ self.w[:STATS] + 0.5 * (sums**2 - squares).sum(1)
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def fit(found: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray, seed: int = 7) -> Machine | None:
    """Logistic loss by adaptive steps over small batches of ``features``, with L2 weights; None without any."""
    if not found:
        return None
    stats = np.stack([s for s, _ in found])
    m = Machine(stats.mean(0), stats.std(0) + 1e-6, 0.0, np.zeros(0), np.zeros(0))
    dense, rng, y = m.dense(stats), np.random.default_rng(seed), labels.astype(float)
    sizes = np.array([len(at) for _, at in found])
    ends, flat = np.cumsum(sizes), np.concatenate([at for _, at in found])
    # a weight and RANK numbers for each input; the words follow the statistics
    p = np.c_[np.zeros(STATS + BUCKETS), rng.normal(0, 0.02, (STATS + BUCKETS, RANK))]
    seen = np.full(p.shape, 1e-6)
    rate = float(np.clip(y.mean(), 0.01, 0.99))
    w0 = np.log(rate / (1 - rate))
    for epoch in range(EPOCHS):
        order, step = rng.permutation(len(found)), 0.1 / (1 + 0.15 * epoch)
        for s in range(0, len(found), BATCH):
            rows = order[s : s + BATCH]
            n = sizes[rows]
            own = np.concatenate([flat[ends[r] - sizes[r] : ends[r]] for r in rows]) + STATS
            line, x = np.repeat(np.arange(len(rows)), n), np.repeat(1 / np.sqrt(np.maximum(n, 1)), n)
            d, words = dense[rows], p[own] * x[:, None]
            sums = np.stack([np.bincount(line, words[:, k], len(rows)) for k in range(RANK + 1)], 1)
            squares = np.bincount(line, (words[:, 1:] ** 2).sum(1), len(rows)) + (d**2 @ p[:STATS, 1:] ** 2).sum(1)
            vx = sums[:, 1:] + d @ p[:STATS, 1:]
            z = w0 + sums[:, 0] + d @ p[:STATS, 0] + 0.5 * ((vx**2).sum(1) - squares)
            err = (1 / (1 + np.exp(-np.clip(z, -30, 30))) - y[rows]) / len(rows)
            at, place = np.unique(own, return_inverse=True)
            pull = err[line] * x
            by_word = np.c_[pull, pull[:, None] * (vx[line] - words[:, 1:])]
            g = np.r_[np.c_[d.T @ err, d.T @ (err[:, None] * vx) - p[:STATS, 1:] * (d.T**2 @ err)[:, None]], np.stack([np.bincount(place, by_word[:, k], len(at)) for k in range(RANK + 1)], 1)]
            at = np.r_[np.arange(STATS), at]
            g += 1e-5 * p[at]
            seen[at] += g * g
            p[at] -= step * g / np.sqrt(seen[at])
            w0 -= step * err.sum()
    p[(seen <= 1e-6).all(1)] = 0  # words that the sample lacks have no say
    m.w0, m.w, m.v = float(w0), p[:, 0].astype(np.float32), p[:, 1:].astype(np.float32)
    return m


def held_out(doc_id: Column) -> Column:
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 5 == 0


def train(docs: DataFrame, labels: DataFrame) -> Machine | None:
    """Fit on at most TRAIN_ROWS labelled rows of ``docs`` outside the held-out fifth, those of least hash."""
    marks = labels.where(F.col("doc_id").isNotNull() & F.col("quality").isNotNull() & ~held_out(F.col("doc_id")))
    marks = marks.groupBy(F.col("doc_id").cast("long").alias("_id")).agg(F.min("quality").cast("int").alias("_quality"))
    texts = docs.select(F.col("doc_id").cast("long").alias("_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("_text"))
    there = marks.join(texts.select("_id"), "_id", "left_semi")
    chosen = docs.sparkSession.createDataFrame(there.orderBy(F.xxhash64("_id"), "_id").limit(TRAIN_ROWS).collect(), "_id long, _quality int")
    rows = texts.join(F.broadcast(chosen), "_id").groupBy("_id", "_quality").agg(F.max("_text").alias("_text"))
    got = sorted(_featured(rows).collect(), key=lambda r: r["_id"])
    return fit([(np.frombuffer(r["stats"]), np.frombuffer(r["buckets"], np.int32)) for r in got], np.array([float(r["_quality"] > 0) for r in got]))


def _featured(rows: DataFrame) -> DataFrame:
    """The chosen texts as the bytes of their features, at most four for each bucket however long they are."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches):
            found = [features(t.as_py()) for t in b.column(2)]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array([s.tobytes() for s, _ in found], pa.binary()), pa.array([at.astype(np.int32).tobytes() for _, at in found], pa.binary())], names=["_id", "_quality", "stats", "buckets"])

    return rows.select("_id", "_quality", F.col("_text").cast("binary")).mapInArrow(work, "_id long, _quality int, stats binary, buckets binary")


def score_texts(machine: Machine | None, texts: list[bytes | None]) -> np.ndarray:
    return np.full(len(texts), 0.5) if machine is None else machine.score([t or b"" for t in texts])


def score(docs: DataFrame, machine: Machine | None) -> DataFrame:
    """(doc_id, score) for each row of ``docs``."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches):
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(score_texts(machine, b.column(1).to_pylist()), pa.float64())], names=["doc_id", "score"])

    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").cast("binary").alias("text"))
    return own.mapInArrow(work, "doc_id long, score double")


def keep_good(docs: DataFrame, machine: Machine | None) -> DataFrame:
    """The rows of ``docs`` that score at least CUTOFF, with its columns."""
    at = docs.columns.index("text")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches):
            yield b.filter(pa.array(score_texts(machine, b.column(at).cast(pa.binary()).to_pylist()) >= CUTOFF))

    return docs.mapInArrow(work, docs.schema)
