"""SimHash near-duplicates with Golay-code fuzzy hashing.

A 64-bit fingerprint is cut into three segments of 23, 23 and 18 bits. The
perfect binary Golay code [23, 12] maps every 23-bit word to the one codeword
at distance three or less, so a segment has a 12-bit codeword index. The
*ball keys* of a segment are the indices of the segment and of all words one
bit away (six keys at most): two segments that differ in one bit or none
always have ``index(x) in ball(y)``.

Three differing bits over three segments leave (pigeonhole) either

* one segment without an error and another with at most one: the key is the
  exact segment and a ball key of the other, for each ordered pair (E), or
* one error in each segment: the key is a ball key of each of the first two (F).

Every distinct fingerprint gives its index keys ("points", 7 rows) and its
ball keys ("probes", about 60 rows); the join on the key is verified with the
bit distance and nothing is capped.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.llm.common import checkpoint, fresh, prepare, text_key
from corpusloom.llm.graph import components

# Fixed value: generator polynomial of the binary Golay code, x^11+x^9+x^7+x^6+x^5+x+1.
GOLAY = 0b101011100011
SEGMENTS = ((0, 23), (23, 23), (46, 18))  # (lowest bit, bits)
PAIRS = [(i, j) for i in range(3) for j in range(3) if i != j]
SHINGLE_WORDS = 3
MAX_BITS = 3


def _tables() -> tuple[np.ndarray, np.ndarray]:
    """Syndrome of the upper 12 bits, and the error pattern of each syndrome."""
    def syndrome(x: int) -> int:
        for bit in range(22, 10, -1):
            if x >> bit & 1:
                x ^= GOLAY << (bit - 11)
        return x
    upper = np.array([syndrome(m << 11) for m in range(1 << 12)], dtype=np.int64)
    error = np.zeros(1 << 11, dtype=np.int64)
    for weight in (1, 2, 3):
        for bits in combinations(range(23), weight):
            word = sum(1 << b for b in bits)
            error[upper[word >> 11] ^ (word & 0x7FF)] = word
    return upper, error


_UPPER, _ERROR = _tables()


def codeword_index(x: np.ndarray) -> np.ndarray:
    """12-bit index of the codeword nearest to each 23-bit word."""
    return (x ^ _ERROR[_UPPER[x >> 11] ^ (x & 0x7FF)]) >> 11


def _ball(x: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Ball keys of each word, one row per word, and which of them to keep
    (the others repeat a key)."""
    flips = np.concatenate([[0], 1 << np.arange(bits, dtype=np.int64)])
    keys = np.sort(codeword_index(x[:, None] ^ flips[None, :]), axis=1)
    return keys, np.concatenate([np.ones((len(x), 1), bool), keys[:, 1:] != keys[:, :-1]], axis=1)


def _segments(fp: np.ndarray) -> list[np.ndarray]:
    u = fp.astype(np.uint64)
    return [(u >> np.uint64(low) & np.uint64((1 << n) - 1)).astype(np.int64) for low, n in SEGMENTS]


def point_keys(fp: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row, key): seven keys per fingerprint, built from codeword indices."""
    s = _segments(fp)
    c = [codeword_index(x) for x in s]
    keys = [t << 40 | s[i] << 12 | c[j] for t, (i, j) in enumerate(PAIRS)]
    keys.append(len(PAIRS) << 40 | c[0] << 12 | c[1])
    return np.tile(np.arange(len(fp)), len(keys)), np.concatenate(keys)


def probe_keys(fp: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row, key): every key under which a fingerprint within the distance has a point."""
    s = _segments(fp)
    balls = [_ball(x, n) for x, (_, n) in zip(s, SEGMENTS)]
    rows, keys = [], []
    for t, (i, j) in enumerate(PAIRS):
        r, c = np.nonzero(balls[j][1])
        rows.append(r)
        keys.append(t << 40 | s[i][r] << 12 | balls[j][0][r, c])
    (k0, m0), (k1, m1) = balls[0], balls[1]
    r, c0, c1 = np.nonzero(m0[:, :, None] & m1[:, None, :])
    rows.append(r)
    keys.append(len(PAIRS) << 40 | k0[r, c0] << 12 | k1[r, c1])
    return np.concatenate(rows), np.concatenate(keys)


def fingerprint(text: str | None, shingle: int = SHINGLE_WORDS) -> int:
    """Fingerprint of a whole text; bit sums are taken in blocks, so a very
    long text needs little more memory than its words."""
    words = (text or "").encode("utf-8").lower().split()  # bytes: A-Z only; white space 20, 09-0D
    if not words:
        return 0
    joined = b" ".join(words)
    length = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
    end = np.cumsum(length + 1) - 1
    k = min(shingle, len(words)) - 1
    first, last = (end - length)[:len(words) - k], end[k:]
    ones = np.zeros(64, dtype=np.int64)
    digest = xxhash.xxh64_intdigest
    for at in range(0, len(first), 1 << 16):
        h = np.array([digest(joined[a:b], 42) for a, b in
                      zip(first[at:at + (1 << 16)].tolist(), last[at:at + (1 << 16)].tolist())], dtype="<u8")
        ones += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(sum(1 << b for b in np.nonzero(2 * ones > len(first))[0].tolist()))


def with_fingerprint(docs: DataFrame, column: str, shingle: int = SHINGLE_WORDS) -> DataFrame:
    """``doc_id``, the text's key ``tkey`` and the fingerprint as a long."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fp = np.array([fingerprint(t, shingle) for t in b.column(2).to_pylist()], dtype=np.uint64)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(fp.view(np.int64))],
                                             names=["doc_id", "tkey", "fp"])
    return (docs.select("doc_id", text_key(F.col(column)).alias("tkey"), F.col(column).alias("t"))
            .mapInArrow(run, "doc_id long, tkey long, fp long"))


def _keyed(fps: DataFrame, make, name: str) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fp = np.asarray(b.column(0).to_numpy(zero_copy_only=False), dtype=np.int64)
            if not len(fp):
                continue
            row, key = make(fp.view(np.uint64))
            yield pa.RecordBatch.from_arrays([pa.array(key), pa.array(fp[row])], names=["key", name])
    return fps.mapInArrow(run, f"key long, {name} long")


def fingerprint_links(fps: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """All pairs ``(a, b)`` of distinct fingerprints in ``fps(fp)`` at
    ``max_bits`` or fewer differing bits (three at most: the code's guarantee)."""
    if not 0 <= max_bits <= 3:
        raise ValueError("the segment keys guarantee up to three differing bits")
    probes, points = _keyed(fps, probe_keys, "a"), _keyed(fps, point_keys, "b")
    near = (F.col("a") < F.col("b")) & (F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= max_bits)
    p, q = probes.alias("p"), points.alias("q")
    return p.join(q, (F.col("p.key") == F.col("q.key")) & near).select("a", "b").distinct()


def groups(docs: DataFrame, column: str = "text", shingle: int = SHINGLE_WORDS,
           max_bits: int = MAX_BITS) -> tuple[DataFrame, DataFrame]:
    """``(rows, roots)``: ``rows(doc_id, tkey, fp)`` one per input row, and
    ``roots(node, root)`` the fingerprints whose component has a smaller one."""
    prepare(docs.sparkSession)
    rows = checkpoint(with_fingerprint(docs, column, shingle))
    fps = checkpoint(rows.select("fp").distinct())
    return rows, components(fingerprint_links(fps, max_bits))


def simhash_components(docs: DataFrame, column: str = "text", shingle: int = SHINGLE_WORDS,
                       max_bits: int = MAX_BITS) -> DataFrame:
    """One row per input row: ``doc_id``, ``fingerprint`` (16 hexadecimal
    digits), ``component_id`` (smallest ``doc_id`` reachable).

    Null and empty texts have fingerprint zero and are linked like any other;
    repeated rows all come back; rows without a ``doc_id`` take part in links
    but never name a component (a component of such rows only has a null id);
    other columns are ignored; an empty table gives no rows.
    """
    rows, roots = groups(docs, column, shingle, max_bits)
    ids = rows.groupBy("fp").agg(F.min("doc_id").alias("low"))
    named = (ids.join(roots, ids.fp == roots.node, "left")
             .select("fp", "low", F.coalesce("root", "fp").alias("root")))
    named = checkpoint(named)
    low = named.groupBy("root").agg(F.min("low").alias("component_id"))
    of = named.join(low, "root").select("fp", "component_id")
    return (rows.select("doc_id", "fp").join(of, "fp")
            .select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"))


def keep_one(docs: DataFrame, column: str = "text", shingle: int = SHINGLE_WORDS,
             max_bits: int = MAX_BITS) -> DataFrame:
    """The rows of ``docs`` that stand for their group: the smallest ``doc_id``
    of each component (null ids last, ties by the text's hash), once. All
    columns are kept as they are."""
    rows, roots = groups(docs, column, shingle, max_bits)
    node = rows.join(roots, rows.fp == roots.node, "left").select(
        F.struct(F.col("doc_id").isNull().alias("n"), "doc_id", "tkey").alias("k"), F.coalesce("root", "fp").alias("root"))
    keep = checkpoint(node.groupBy("root").agg(F.min("k").alias("k"))
                      .select(F.col("k.doc_id").alias("doc_id"), F.col("k.tkey").alias("tkey")))
    key = fresh(docs, "_tkey")
    at, cols = docs.withColumn(key, text_key(F.col(column))), docs.columns
    hit = at.join(keep, at["doc_id"].eqNullSafe(keep["doc_id"]) & (at[key] == keep["tkey"]), "left_semi")
    return hit.dropDuplicates(["doc_id", key]).select(*cols)
