"""Which source chunks do existing outputs hold? (R8 without a manifest)

An output is a concatenation of chunks, in any order, of which only the index
is left to go by. Every chunk's length vector is looked for in every output:

1. a chunk gives the hash of its first ``k`` lengths (``k`` = the largest power
   of two up to 64 that it has) and the hash of the whole vector;
2. every output position gives the hashes of the next ``k`` lengths for the
   ``k`` in use; an equi-join with the *distinct* vectors gives candidates;
3. one streaming pass per output, sorted by position, verifies candidates with
   prefix sums of the rolling hash and lays them end to end, longest first;
4. occurrences and chunks are ranked inside equal vectors (``rank_within``) and
   joined on (vector, rank), so the first occurrence takes the first chunk;
5. the joined pairs are compared length by length.

The chunk list never leaves Spark, and there is no limit on its size. What lies
between known chunks (foreign sequences) is skipped; the walk enters again only
at a chunk of ``REENTRY`` sequences or more, since shorter vectors also occur by
accident.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.operators.index import global_rank
from corpusloom.session import checkpoint, prepare_session
from corpusloom.sources.binidx import _index_arrays, read_header

PREFIXES = (1, 2, 4, 8, 16, 32, 64)  # lengths that a lookup key can cover
REENTRY = 8
RANGE = 1 << 20        # positions of an output that one row of work covers
STRIDE = 1024          # positions between kept prefix sums
_BASE = 0x9E3779B97F4A7C15
_BACK = pow(_BASE, -1, 1 << 64)
_WORD = (1 << 64) - 1


def _powers(n: int, first: int = 0) -> np.ndarray:
    out = np.full(n, np.uint64(_BASE))
    if n:
        out[0] = np.uint64(pow(_BASE, first, 1 << 64))
    return np.cumprod(out, dtype=np.uint64)


def _mixed(total: int, n: int) -> int:
    x = (total ^ (n * 0xC2B2AE3D27D4EB4F)) & _WORD
    x = ((x ^ (x >> 30)) * 0xBF58476D1CE4E5B9) & _WORD
    return (x ^ (x >> 31)) - (1 << 63)


def vector_hash(lengths, lo: int, hi: int) -> int:
    """Signed 64-bit hash of ``lengths[lo:hi]``, read in blocks."""
    total = 0
    for a in range(lo, hi, RANGE):
        b = min(hi, a + RANGE)
        total += int(((np.array(lengths[a:b], dtype=np.uint64) + np.uint64(1)) * _powers(b - a, a - lo)).sum(dtype=np.uint64))
    return _mixed(total & _WORD, hi - lo)


class Sums:
    """Rolling hash of any window of an array: prefix sums at every ``STRIDE``."""

    def __init__(self, lengths) -> None:
        self.lengths, self.kept = lengths, [0]
        for a in range(0, len(lengths), RANGE):
            x = (np.array(lengths[a:a + RANGE], dtype=np.uint64) + np.uint64(1)) * _powers(min(RANGE, len(lengths) - a), a)
            steps = np.add.reduceat(x, np.arange(0, len(x), STRIDE), dtype=np.uint64)
            self.kept += ((np.uint64(self.kept[-1]) + np.cumsum(steps, dtype=np.uint64)).tolist())

    def upto(self, p: int) -> int:
        a = p - p % STRIDE
        x = (np.array(self.lengths[a:p], dtype=np.uint64) + np.uint64(1)) * _powers(p - a, a)
        return (self.kept[a // STRIDE] + int(x.sum(dtype=np.uint64))) & _WORD

    def window(self, lo: int, hi: int) -> int:
        total = (self.upto(hi) - self.upto(lo)) * pow(_BACK, lo, 1 << 64)
        return _mixed(total & _WORD, hi - lo)


def prefix_keys(lengths: np.ndarray, k: int) -> np.ndarray:
    """Hash of ``k`` lengths from each position on (as many as fit)."""
    n = len(lengths) - k + 1
    if n <= 0:
        return np.zeros(0, dtype=np.int64)
    x = lengths.astype(np.uint64) + np.uint64(1)
    total = np.zeros(n, dtype=np.uint64)
    for i, p in enumerate(_powers(k).tolist()):
        total += x[i:i + n] * np.uint64(p)
    x = total ^ np.uint64((k * 0xC2B2AE3D27D4EB4F) & _WORD)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    return ((x ^ (x >> np.uint64(31))) + np.uint64(1 << 63)).view(np.int64)


def _lengths(prefix: str):
    return _index_arrays(prefix, read_header(prefix), False)[0]


def chunk_vectors(chunks: DataFrame) -> DataFrame:
    """``(id, src_path, start_doc, n, k, key, vec)`` per chunk, from the source index."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = []
            for cid, prefix, lo, hi in b.itertuples(index=False):
                lengths, n = _lengths(prefix), hi - lo
                k = max(p for p in PREFIXES if p <= n)
                rows.append((cid, prefix, lo, n, k, int(prefix_keys(np.array(lengths[lo:lo + k]), k)[0]), vector_hash(lengths, lo, hi)))
            yield pd.DataFrame(rows, columns=["id", "src_path", "start_doc", "n", "k", "key", "vec"])
    return chunks.where("end_doc > start_doc").select("id", "src_path", "start_doc", "end_doc").mapInPandas(
        run, "id string, src_path string, start_doc long, n long, k int, key long, vec long")


def output_keys(spark: SparkSession, outputs: DataFrame, sizes: list[int]) -> DataFrame:
    """``(output, pos, k, key)`` for every position of every output."""
    def ranges(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = [(p, a) for p in b["output"] for a in range(0, read_header(p).n_seq, RANGE)]
            yield pd.DataFrame(rows, columns=["output", "lo"])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for prefix, lo in b.itertuples(index=False):
                x = np.array(_lengths(prefix)[lo:lo + RANGE + max(sizes) - 1])
                for k in sizes:
                    key = prefix_keys(x, k)[:RANGE]
                    yield pd.DataFrame({"output": prefix, "pos": lo + np.arange(len(key)), "k": np.full(len(key), k, np.int32), "key": key})
    parts = 4 * spark.sparkContext.defaultParallelism
    return (outputs.repartition(parts).mapInPandas(ranges, "output string, lo long").repartition(parts, "output", "lo")
            .mapInPandas(run, "output string, pos long, k int, key long"))


def candidates(spark: SparkSession, outputs: DataFrame, vectors: DataFrame) -> DataFrame:
    """``(output, pos, n, vec)``: places whose next lengths start as a chunk's vector does."""
    sizes = [r[0] for r in vectors.select("k").distinct().collect()]  # at most seven numbers
    different = vectors.select("k", "key", "n", "vec").distinct()
    # Spark takes the few names of the outputs for the size of all their positions
    # and would send those through the driver: the join is a shuffle, whatever it guesses
    return (output_keys(spark, outputs, sizes).hint("merge").join(different, ["k", "key"])
            .select("output", "pos", "n", "vec"))


def _walk(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Candidates sorted by output, position and falling length → the ones that
    hold and lie end to end."""
    now, sums, total, cursor = None, None, 0, 0
    for b in batches:
        rows = []
        for output, pos, n, vec in b.itertuples(index=False):
            if output != now:
                lengths = _lengths(output)
                now, sums, total, cursor = output, Sums(lengths), len(lengths), 0
            if pos < cursor or pos + n > total or (pos > cursor and n < REENTRY):
                continue
            if sums.window(pos, pos + n) == vec:
                rows.append((output, pos, n, vec))
                cursor = pos + n
        yield pd.DataFrame(rows, columns=["output", "pos", "n", "vec"])


def rank_within(df: DataFrame, keys: list[str], order: list[str], name: str) -> DataFrame:
    """0-based rank of a row among those with equal ``keys``, in ``order``, without
    a window over one key: a global rank less the key's first one."""
    ranked = checkpoint(global_rank(df, [*keys, *order], "_rank"))
    first = ranked.groupBy(*keys).agg(F.min("_rank").alias("_first"))
    return ranked.join(first, keys).select(*df.columns, (F.col("_rank") - F.col("_first")).alias(name))


def _same(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for b in batches:
        ok = []
        for output, pos, n, prefix, lo in b[["output", "pos", "n", "src_path", "start_doc"]].itertuples(index=False):
            mine, theirs = _lengths(output), _lengths(prefix)
            ok.append(all(np.array_equal(mine[pos + a:pos + min(n, a + RANGE)], theirs[lo + a:lo + min(n, a + RANGE)])
                          for a in range(0, n, RANGE)))
        yield b[np.array(ok, dtype=bool)]


def held_chunks(spark: SparkSession, chunks: DataFrame, outputs: list[str]) -> DataFrame:
    """``(chunk_id, output, pos, n)``: chunks that the outputs hold, each once."""
    prepare_session(spark)
    vectors = checkpoint(chunk_vectors(chunks))
    names = spark.createDataFrame([(p,) for p in sorted(outputs)], "output string")
    if vectors.isEmpty():
        return spark.createDataFrame([], "chunk_id string, output string, pos long, n long")
    found = (candidates(spark, names, vectors).repartition("output").sortWithinPartitions("output", "pos", F.desc("n"), "vec")
             .mapInPandas(_walk, "output string, pos long, n long, vec long"))
    places = rank_within(checkpoint(found), ["n", "vec"], ["output", "pos"], "rank")
    own = rank_within(vectors.select("n", "vec", "src_path", "start_doc", "id"), ["n", "vec"], ["src_path", "start_doc"], "rank")
    pairs = places.join(own, ["n", "vec", "rank"]).select("id", "output", "pos", "n", "src_path", "start_doc")
    return (pairs.mapInPandas(_same, pairs.schema)
            .select(F.col("id").alias("chunk_id"), "output", "pos", "n"))
