"""Embedding near-duplicates with product quantisation.

The index has coarse inverted lists (k-means) and, for each vector, a residual
code of one byte per subspace, with the length of what the code leaves out.
A query visits every list whose border lies within ``slack`` of it, ranks the
list's codes with a table of subspace distances, and keeps a code when

    table distance <= radius + left-out length

(the triangle inequality: no vector within the radius is lost there). The rest
is reranked with the exact cosine in double precision. Only the choice of
lists is approximate; ``slack`` is at least ``MIN_SLACK`` and at least 1.5 times
what any true pair of the fitting sample needs, and a slack of the radius itself
would be exact.

Lists are cut into blocks of about ``BLOCK`` vectors and joined block by block,
so a list of any size is spread over tasks, and a block pair returns link
counts and a spanning forest, never its pairs.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.llm.common import checkpoint, prepare
from corpusloom.llm.graph import components

COSINE = 0.95
SAMPLE = 16_384     # vectors that the index is fitted on, at most (the first by a hash)
MAX_LISTS = 4_096
SUBSPACES = 16
BLOCK = 512
MIN_SLACK = 0.12
ROUNDS = 8


@dataclass
class Index:
    centres: np.ndarray          # lists x dim
    books: list[np.ndarray]      # per subspace: codewords x its dims
    cuts: list[tuple[int, int]]
    slack: float

    def _distances(self, x: np.ndarray) -> np.ndarray:
        return np.maximum((x * x).sum(1)[:, None] - 2 * x @ self.centres.T + (self.centres ** 2).sum(1)[None], 0)

    def assign(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Own list of each vector, and the mask of the lists that it visits."""
        d = self._distances(x)
        own = d.argmin(1)
        gap = (d - d[np.arange(len(x)), own][:, None]) / (2 * self._between()[own])
        visit = gap <= self.slack
        visit[np.arange(len(x)), own] = True
        return own, visit

    def _between(self) -> np.ndarray:
        c = self.centres
        sq = np.maximum((c * c).sum(1)[:, None] - 2 * c @ c.T + (c * c).sum(1)[None], 0)
        return np.sqrt(np.maximum(sq, 1e-18))

    def encode(self, x: np.ndarray, own: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Code bytes and left-out length of each vector."""
        r = x - self.centres[own]
        codes, left = np.empty((len(x), len(self.books)), np.uint8), np.zeros(len(x))
        for m, ((a, b), book) in enumerate(zip(self.cuts, self.books)):
            d = (book ** 2).sum(1)[None] - 2 * r[:, a:b] @ book.T
            codes[:, m] = d.argmin(1)
            left += ((r[:, a:b] - book[codes[:, m]]) ** 2).sum(1)
        return codes, np.sqrt(left)

    def table_distance(self, x: np.ndarray, at: int, codes: np.ndarray) -> np.ndarray:
        """Asymmetric distances of raw queries to the coded vectors of one list."""
        r = x - self.centres[at]
        out = np.zeros((len(x), len(codes)))
        for m, ((a, b), book) in enumerate(zip(self.cuts, self.books)):
            t = (r[:, a:b] ** 2).sum(1)[:, None] - 2 * r[:, a:b] @ book.T + (book ** 2).sum(1)[None]
            out += t[:, codes[:, m]]
        return np.sqrt(np.maximum(out, 0))


def _kmeans(x: np.ndarray, k: int, rng: np.random.Generator) -> np.ndarray:
    k = max(1, min(k, len(x)))
    c = x[rng.choice(len(x), k, replace=False)].copy()
    for _ in range(ROUNDS):
        own = ((c * c).sum(1)[None] - 2 * x @ c.T).argmin(1)
        n = np.bincount(own, minlength=k)
        total = np.zeros_like(c)
        np.add.at(total, own, x)
        c[n > 0] = total[n > 0] / n[n > 0][:, None]
    return c


def fit(sample: np.ndarray, lists: int, cosine: float = COSINE, seed: int = 11) -> Index:
    """The index of unit vectors ``sample`` (at most ``SAMPLE`` rows)."""
    rng = np.random.default_rng(seed)
    centres = _kmeans(sample, lists, rng)
    dim = sample.shape[1]
    edges = np.linspace(0, dim, min(SUBSPACES, dim) + 1).round().astype(int)
    cuts = list(zip(edges[:-1].tolist(), edges[1:].tolist()))
    index = Index(centres, [], cuts, np.inf)
    d = index._distances(sample)
    own = d.argmin(1)
    rest = sample - centres[own]
    index.books = [_kmeans(rest[:, a:b], 256, rng) for a, b in cuts]
    gap = (d - d[np.arange(len(own)), own][:, None]) / (2 * index._between()[own])
    gap[np.arange(len(own)), own] = 0
    need = 0.0
    for at in range(0, len(sample), 1024):  # what the true pairs of the sample need
        i, j = np.nonzero(sample[at:at + 1024] @ sample.T >= cosine)
        if len(i):
            need = max(need, float(gap[i + at, own[j]].max()))
    index.slack = min(max(MIN_SLACK, 1.5 * need), float(np.sqrt(max(2 - 2 * cosine, 0))) + 1e-9)
    return index


def _units(values: np.ndarray) -> np.ndarray:
    x = values.astype(np.float64)
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(1, keepdims=True))


def _usable(e: Column) -> Column:
    bad = F.exists(e, lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))
    return F.coalesce((F.size(e) > 0) & ~bad & F.exists(e, lambda v: v != 0), F.lit(False))


def _matrix(column: pa.Array, dim: int) -> np.ndarray:
    """Rows of floats, padded with zeros to ``dim``."""
    flat, size = np.asarray(column.flatten(), dtype=np.float64), np.diff(np.asarray(column.offsets))
    if (size == dim).all():
        return flat.reshape(-1, dim)
    out = np.zeros((len(size), dim))
    out[np.repeat(np.arange(len(size)), size), np.concatenate([np.arange(n) for n in size] or [[]]).astype(int)] = flat
    return out


def _coded(classes: DataFrame, index: Index, dim: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not b.num_rows:
                continue
            x = _units(_matrix(b.column(1), dim))
            own, visit = index.assign(x)
            codes, left = index.encode(x, own)
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), b.column(2), pa.array(own.astype(np.int32)),
                 pa.array([np.nonzero(v)[0].astype(np.int32) for v in visit], pa.list_(pa.int32())),
                 pa.array([c.tobytes() for c in codes], pa.binary()), pa.array(left)],
                names=["cid", "e", "mult", "own", "visit", "code", "rest"])
    return classes.select("cid", "e", "mult").mapInArrow(
        run, "cid long, e array<double>, mult long, own int, visit array<int>, code binary, rest double")


def _pairs(index: Index, dim: int, cosine: float):
    radius = float(np.sqrt(max(2 - 2 * cosine, 0)))

    def block(at: int, q: pa.StructArray, p: pa.StructArray):
        qid, pid = np.asarray(q.field("cid")), np.asarray(p.field("cid"))
        qe, pe = q.field("e"), p.field("e")
        qx, px = _units(_matrix(qe, dim)), _units(_matrix(pe, dim))
        codes = np.frombuffer(b"".join(p.field("code").to_pylist()), np.uint8).reshape(len(pid), -1)
        near = index.table_distance(qx, at, codes) <= radius + np.asarray(p.field("rest"))[None] + 1e-7
        i, j = np.nonzero(near & (qid[:, None] != pid[None]))
        same_dim = np.diff(np.asarray(qe.offsets))[i] == np.diff(np.asarray(pe.offsets))[j]
        i, j = i[same_dim], j[same_dim]
        hit = np.concatenate([np.einsum("nd,nd->n", qx[i[k:k + 65536]], px[j[k:k + 65536]]) >= cosine
                              for k in range(0, max(len(i), 1), 65536)])
        i, j = i[hit], j[hit]
        if not len(i):
            return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)
        qm, pm, qown = np.asarray(q.field("mult")), np.asarray(p.field("mult")), np.asarray(q.field("own"))
        links_q, links_p = np.zeros(len(qid), np.int64), np.zeros(len(pid), np.int64)
        np.add.at(links_q, i, pm[j])
        # a point that does not visit the query's own list could not count this link itself
        visits = p.field("visit")
        off, flat = np.asarray(visits.offsets), np.asarray(visits.flatten())
        known = np.repeat(np.arange(len(pid)), np.diff(off)) * (1 << 32) + flat
        lost = ~np.isin(j * (1 << 32) + qown[i], known)
        np.add.at(links_p, j[lost], qm[i[lost]])
        label_q, label_p = qid.copy(), pid.copy()
        while True:  # smallest id of each component inside this block pair
            before = label_q.sum(), label_p.sum()
            np.minimum.at(label_q, i, label_p[j])
            np.minimum.at(label_p, j, label_q[i])
            if before == (label_q.sum(), label_p.sum()):
                break
        return (np.concatenate([qid, pid]), np.concatenate([links_q, links_p]), np.concatenate([label_q, label_p]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for k in range(b.num_rows):
                a, n, low = block(b.column(0)[k].as_py(), b.column(1)[k].values, b.column(2)[k].values)
                keep = (n > 0) | (low != a)
                yield pa.RecordBatch.from_arrays([pa.array(x[keep]) for x in (a, n, low)], names=["a", "n", "b"])
    return run


def near_duplicates(vectors: DataFrame, column: str = "embedding", cosine: float = COSINE) -> DataFrame:
    """One row per input row: ``vec_id``, ``n_links`` (other vectors at
    ``cosine`` or more), ``component_id`` (smallest ``vec_id`` reachable) and
    ``kept`` (``vec_id = component_id``).

    Vectors that are null, empty, zero or hold a null or non-finite component
    have no links and are their own component; equal vectors are indexed once
    and counted each; vectors of different lengths never link; a row without
    ``vec_id`` is linked and counted but never names a component, and is not
    kept; rows that repeat a ``vec_id`` each get a row; other columns are
    ignored; an empty table gives no rows.
    """
    spark = prepare(vectors.sparkSession)
    e = F.col(column).cast("array<double>")
    rows = vectors.select("vec_id", F.when(_usable(e), e).alias("e"))
    rows = checkpoint(rows.withColumn("cid", F.when(F.col("e").isNotNull(), F.xxhash64(F.lit(1), "e"))))
    classes = checkpoint(rows.where(F.col("cid").isNotNull()).groupBy("cid").agg(
        F.first("e").alias("e"), F.count(F.lit(1)).alias("mult"), F.min("vec_id").alias("low")))
    n, dim = classes.agg(F.count(F.lit(1)), F.max(F.size("e"))).first()
    if not n:
        return rows.select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"),
                           F.col("vec_id").isNotNull().alias("kept"))
    sample = classes.select("cid", "e").orderBy("cid").limit(SAMPLE).toArrow()  # a bounded sample, first by hash
    points = sample["e"].combine_chunks()
    index = fit(_units(_matrix(points, dim)), min(MAX_LISTS, max(1, round(n ** 0.5))), cosine)
    coded = checkpoint(_coded(classes, index, dim))
    # blocks: list sizes are at most MAX_LISTS rows
    sizes = [coded.groupBy("own").agg(F.ceil(F.count(F.lit(1)) / BLOCK).alias("pieces")),
             coded.select(F.explode("visit").alias("own")).groupBy("own").agg(F.ceil(F.count(F.lit(1)) / BLOCK).alias("pieces"))]
    piece = F.pmod(F.xxhash64(F.lit(2), "cid"), F.col("pieces"))
    p = (coded.join(F.broadcast(checkpoint(sizes[0])), "own").groupBy("own", piece.alias("piece"))
         .agg(F.collect_list(F.struct("cid", "mult", "e", "code", "rest", "visit")).alias("p")))
    q = (coded.select("cid", "mult", "e", "own", F.explode("visit").alias("at"))
         .join(F.broadcast(checkpoint(sizes[1])).withColumnRenamed("own", "at"), "at")
         .groupBy("at", piece.alias("piece")).agg(F.collect_list(F.struct("cid", "mult", "e", "own")).alias("q")))
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "16")  # a row holds two blocks
    found = checkpoint(q.join(p, q["at"] == p["own"]).select("at", "q", "p")
                       .mapInArrow(_pairs(index, dim, cosine), "a long, n long, b long"))
    prepare(spark)
    links = found.groupBy("a").agg(F.sum("n").alias("n"))
    roots = components(found)
    cls = (classes.select("cid", "mult", "low").join(links, F.col("cid") == F.col("a"), "left").drop("a")
           .join(roots, F.col("cid") == F.col("node"), "left")
           .select("cid", "low", (F.coalesce("n", F.lit(0)) + F.col("mult") - 1).alias("n"), F.coalesce("root", "cid").alias("root")))
    cls = checkpoint(cls)
    low = cls.groupBy("root").agg(F.min("low").alias("component_id"))
    of = cls.join(low, "root").select("cid", "n", "component_id")
    component = F.when(F.col("cid").isNull(), F.col("vec_id")).otherwise(F.col("component_id"))
    return (rows.drop("e").join(of, "cid", "left")
            .select("vec_id", F.coalesce("n", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"),
                    F.coalesce(F.col("vec_id") == component, F.lit(False)).alias("kept")))
