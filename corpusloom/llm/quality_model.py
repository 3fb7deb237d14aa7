"""Supervised subword embeddings for a quality score.

A text is the average of learned vectors: one for each word, one for each
pair of neighbouring words (the pair is hashed by the difference of the two
word hashes, so all immediate repetitions share one vector) and one for each
character n-gram inside a word with its borders; all are hashed into a fixed
number of buckets. A softmax layer over the average gives the classes. Training is
stochastic gradient descent in numpy over a bounded sample of labelled rows;
scoring runs in the tasks. There the product of vectors and output layer is
one number per bucket, so a text's score is an average of table entries.

The hashes of all words and n-grams of a text are taken at once with prefix
sums over its characters (wrapping 64-bit polynomial hashes). Very long texts
are hashed in blocks of whole words that hand their last word on, so the block
size changes no feature.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.llm.common import prepare

BUCKETS = 1 << 16          # per feature family
DIM = 16
GRAMS = (3, 4)             # characters of an n-gram, borders included
EPOCHS = 6
LEAST_STEPS = 12_000      # small samples are gone over more often
RATE = 0.5
SAMPLE_PER_CLASS = 1500    # labelled rows of each class that the model is fitted on, at most
FOLDS = 5
CUTOFF = 0.3
BLOCK = 1 << 18            # characters of a text that are hashed at a time
_BASE = np.uint64(0x9E3779B97F4A7C15)  # odd: powers have inverses modulo 2^64
_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))


@lru_cache(maxsize=1)
def _powers() -> tuple[np.ndarray, np.ndarray]:
    n = BLOCK + 8192
    up, down = np.full(n, _BASE), np.full(n, _INVERSE)
    up[0] = down[0] = 1
    return np.cumprod(up, dtype=np.uint64), np.cumprod(down, dtype=np.uint64)


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(32))


def _spaces(chars: np.ndarray) -> np.ndarray:
    return (chars == 0x20) | ((chars >= 0x09) & (chars <= 0x0D))


def _block_features(chars: np.ndarray, space: np.ndarray, before: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bucket numbers of one block of characters, and the hash of its last word;
    ``before`` holds that of the block before (or nothing)."""
    b = np.concatenate([[32], np.where(space, 32, chars), [32]]).astype(np.uint64)
    gap = np.concatenate([[True], space, [True]])
    start = np.nonzero(gap[:-1] & ~gap[1:])[0] + 1
    end = np.nonzero(~gap[:-1] & gap[1:])[0] + 1
    if not len(start):
        return np.zeros(0, dtype=np.int64), before
    up, down = _powers()
    if len(b) > len(up):
        up, down = (np.cumprod(np.concatenate([np.ones(1, np.uint64), np.full(len(b), x)]), dtype=np.uint64)
                    for x in (_BASE, _INVERSE))
    total = np.concatenate([[np.uint64(0)], np.cumsum((b + np.uint64(1)) * up[:len(b)], dtype=np.uint64)])
    word = _mix((total[end] - total[start]) * down[start])
    chain = np.concatenate([before, word])
    out = [word % np.uint64(BUCKETS), _mix(chain[1:] - chain[:-1]) % np.uint64(BUCKETS) + np.uint64(BUCKETS)]
    inner = np.concatenate([[0], np.cumsum(gap)])  # gaps before each character
    for n in GRAMS:
        if len(b) < n:
            continue
        # no gap strictly inside the n-gram
        ok = np.nonzero(inner[n - 1:len(b)] - inner[1:len(b) - n + 2] == 0)[0]
        g = np.full(len(ok), n, dtype=np.uint64)
        for i in range(n):
            g = g * _BASE + b[ok + i]
        out.append(_mix(g) % np.uint64(BUCKETS) + np.uint64(2 * BUCKETS))
    return np.concatenate(out).astype(np.int64), word[-1:]


def features(text: str | None) -> np.ndarray:
    """Bucket numbers of all features of a whole text, block by block (blocks
    end at white space; a longer unbroken stretch is one block)."""
    chars = np.frombuffer((text or "").encode("utf-32-le"), dtype="<u4")
    space, last = _spaces(chars), np.zeros(0, dtype=np.uint64)
    if len(chars) <= BLOCK:
        return _block_features(chars, space, last)[0]
    out, at = [], 0
    cuts = np.nonzero(space)[0]
    while at < len(chars):
        k = np.searchsorted(cuts, at + BLOCK)
        end = int(cuts[k]) if k < len(cuts) else len(chars)
        found, last = _block_features(chars[at:end], space[at:end], last)
        out.append(found)
        at = end + 1
    return np.concatenate(out)


@dataclass
class Model:
    vectors: np.ndarray  # buckets x DIM
    output: np.ndarray   # 2 x DIM
    bias: np.ndarray     # 2

    def table(self) -> np.ndarray:
        """Difference of the two class scores, per bucket."""
        return (self.vectors @ (self.output[1] - self.output[0])).astype(np.float32)


def step(m: Model, at: np.ndarray, count: np.ndarray, y: int, rate: float) -> None:
    """One step down the gradient of the log loss of one text with class ``y``."""
    w = (count / max(count.sum(), 1)).astype(np.float32)  # share of each bucket in the average
    own = m.vectors[at]
    hidden = w @ own if len(at) else np.zeros(DIM, np.float32)
    z = m.output @ hidden + m.bias
    p = np.exp(z - z.max())
    p /= p.sum()
    p[y] -= 1.0
    back = m.output.T @ p
    m.output -= (rate * np.outer(p, hidden)).astype(np.float32)
    m.bias -= (rate * p).astype(np.float32)
    if len(at):
        m.vectors[at] = own - rate * np.outer(w, back).astype(np.float32)


def train(rows: list[tuple[int, np.ndarray, np.ndarray]], epochs: int = EPOCHS, rate: float = RATE, seed: int = 7) -> Model:
    """Plain SGD over ``(label, buckets, counts)`` with a linearly falling rate.
    Without rows of both classes the scores stay at the prior."""
    rng = np.random.default_rng(seed)
    m = Model(rng.uniform(-1 / DIM, 1 / DIM, (3 * BUCKETS, DIM)).astype(np.float32),
              np.zeros((2, DIM), np.float32), np.zeros(2, np.float32))
    y = np.array([r[0] for r in rows], dtype=np.int64)
    if not len(y) or y.min() == y.max():
        return m
    epochs = max(epochs, -(-LEAST_STEPS // len(rows)))
    done, steps = 0, epochs * len(rows)
    for _ in range(epochs):
        for i in rng.permutation(len(rows)):
            _, at, count = rows[i]
            step(m, at, count, int(y[i]), rate * (1 - done / steps))
            done += 1
    return m


def fold(doc_id: Column) -> Column:
    """crc32 of ``doc_id`` as text, modulo ``FOLDS`` (null id: 0)."""
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(FOLDS)), F.lit(0))


def training_sample(docs: DataFrame, labels: DataFrame, column: str = "text",
                    per_class: int = SAMPLE_PER_CLASS) -> list[tuple[int, np.ndarray, np.ndarray]]:
    """Bucket counts of at most ``per_class`` labelled texts of each class, the
    first by a hash of ``doc_id``, none from fold 0. A row with contradicting
    labels is left out."""
    lab = (labels.where(F.col("quality").isNotNull() & F.col("doc_id").isNotNull() & (fold(F.col("doc_id")) != 0))
           .groupBy("doc_id").agg(F.min(F.col("quality").cast("int")).alias("y"),
                                  F.max(F.col("quality").cast("int")).alias("z")).where("y = z").select("doc_id", "y"))
    picked = [lab.where(F.col("y") == y).orderBy(F.xxhash64("doc_id"), "doc_id").limit(per_class) for y in (0, 1)]
    ids = picked[0].union(picked[1]).collect()  # at most 2 x per_class small rows
    wanted = docs.sparkSession.createDataFrame(ids or [(0, 0)], "doc_id long, y int")
    if not ids:
        wanted = wanted.limit(0)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            got = [np.unique(features(t), return_counts=True) for t in b.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([
                b.column(0), b.column(1), pa.array([g[0].astype(np.int32) for g in got], pa.list_(pa.int32())),
                pa.array([g[1].astype(np.int32) for g in got], pa.list_(pa.int32()))], names=["doc_id", "y", "at", "n"])
    rows = (docs.join(F.broadcast(wanted), "doc_id").select("doc_id", "y", F.col(column).alias("t"))
            .groupBy("doc_id").agg(F.first("y").alias("y"), F.min("t").alias("t"))  # one text per id
            .mapInArrow(run, "doc_id long, y int, at array<int>, n array<int>").toArrow())
    out = [(rows["doc_id"][i].as_py(), rows["y"][i].as_py(), np.asarray(rows["at"][i].values), np.asarray(rows["n"][i].values))
           for i in range(rows.num_rows)]
    return [r[1:] for r in sorted(out, key=lambda r: r[0])]


def score_documents(docs: DataFrame, labels: DataFrame, column: str = "text", cutoff: float = CUTOFF,
                    per_class: int = SAMPLE_PER_CLASS) -> DataFrame:
    """``doc_id``, ``held_out``, ``score``, ``predicted`` for every row.

    The text alone is scored; null and empty texts have no features and get the
    score of the bias; repeated rows get equal scores; a null ``doc_id`` counts
    as held out; an empty label table (or one class only) leaves every score
    at 0.5; other columns are ignored.
    """
    prepare(docs.sparkSession)
    model = train(training_sample(docs, labels, column, per_class))
    table, bias = model.table(), float(model.bias[1] - model.bias[0])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = np.empty(b.num_rows)
            for i, t in enumerate(b.column(2).to_pylist()):
                at = features(t)
                out[i] = bias + (table[at].mean(dtype=np.float64) if len(at) else 0.0)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(1 / (1 + np.exp(-np.clip(out, -60, 60))))],
                                             names=["doc_id", "held_out", "score"])
    return (docs.select("doc_id", (fold(F.col("doc_id")) == 0).alias("held_out"), F.col(column).alias("t"))
            .mapInArrow(run, "doc_id long, held_out boolean, score double")
            .withColumn("predicted", (F.col("score") >= cutoff).cast("int")))
