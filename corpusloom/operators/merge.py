"""Concatenation of indexed datasets (SN2, A3, O6).

* Logical: reading several prefixes with ``binidx`` already gives one table
  whose sequence ids, byte pointers and document index are re-based (A3):
  the driver derives each part's offsets from the 34-byte headers only.
* Physical (``merge_binidx``): one output ``.bin``/``.idx`` pair is pre-sized
  by the driver, then Spark tasks copy their ranges of the parts and write
  the re-based index slices at precomputed offsets (``os.pwrite``). Needs a
  POSIX path every executor sees (a shared mount); on object stores keep the
  parts and read them as one dataset instead. Retried tasks rewrite the same
  bytes, so the result does not depend on task attempts.
"""

from __future__ import annotations

import os
import struct
import uuid
from bisect import bisect_right

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.sources.binidx import (HEADER_SIZE, MAGIC, VERSION, _index_arrays, list_prefixes,
                                       read_binidx, read_header)
from corpusloom.operators.index import DTYPE_CODES, DTYPE_SIZES, two_level_prefix
from corpusloom.session import checkpoint


def concat_datasets(spark: SparkSession, prefixes: list[str], **kw) -> DataFrame:
    """Bag union in the given order, offsets re-based."""
    return read_binidx(spark, ",".join(prefixes), **kw)


def merge_binidx(spark: SparkSession, prefixes: list[str], out_prefix: str, multimodal: bool = False,
                 seqs_per_task: int = 1 << 22, delete_parts: bool = False) -> dict:
    """SN2: merge the datasets into ``out_prefix`` (``.bin`` + ``.idx``),
    keeping their document boundaries (re-based). With ``delete_parts`` the data
    of each goes as soon as it is copied, so all of it is never there twice."""
    from corpusloom.sources.catalogue import catalogue
    parts = catalogue(spark, ",".join(prefixes))
    n_parts = parts.count()
    pieces = two_level_prefix(cut_pieces(parts, seqs_per_task), ["ord", "prefix", "lo"],
                              {"seq_base": F.col("n_seq"), "byte_base": F.col("n_bytes"), "doc_base": F.col("n_docs")})
    plan = checkpoint(pieces.select(F.lit(out_prefix).alias("out"), *[c.split()[0] for c in PLAN_SCHEMA.split(", ")[1:]]))
    if not n_parts:
        plan = spark.createDataFrame([(out_prefix, "", "uint16", 0, 0, 0, 0, 0, 0, 0, 0)], PLAN_SCHEMA)
    info = gather_table(spark, plan, documents="keep", multimodal=multimodal, delete_data=delete_parts)[out_prefix]
    if delete_parts:
        remove_parts(parts)
    return info


def cut_pieces(parts: DataFrame, seqs_per_piece: int) -> DataFrame:
    """The catalogue's parts cut into pieces, with the bytes and documents of
    each: found in tasks, by bisecting the mapped index."""
    def cut(batches):
        for b in batches:
            rows = []
            for k, prefix, n in b.itertuples(index=False):
                h = read_header(prefix)
                many = max(1, -(-n // seqs_per_piece))
                for i in range(many):
                    lo, hi = n * i // many, n * (i + 1) // many
                    rows.append((k, prefix, h.dtype, lo, hi, hi - lo, _piece_bytes(prefix, h, lo, hi), _docs_ending_in(prefix, h, lo, hi)))
            yield pd.DataFrame(rows, columns=["ord", "prefix", "dtype", "lo", "hi", "n_seq", "n_bytes", "n_docs"])
    return parts.select("ord", "prefix", "n_seq").mapInPandas(
        cut, "ord long, prefix string, dtype string, lo long, hi long, n_seq long, n_bytes long, n_docs long")


def remove_parts(parts: DataFrame) -> None:
    """Deletes the files of the catalogue's parts, in tasks."""
    def remove(batches):
        for b in batches:
            for prefix in b["prefix"]:
                for ext in (".bin", ".idx"):
                    if os.path.exists(prefix + ext):
                        os.remove(prefix + ext)
            yield pd.DataFrame({"n": [len(b)]})
    parts.select("prefix").mapInPandas(remove, "n long").agg({"n": "sum"}).collect()


def gather_binidx(spark: SparkSession, targets: dict[str, list[tuple[str, int, int]]],
                  documents: str = "keep", multimodal: bool = False, headers: dict | None = None) -> dict:
    """Write every target dataset as the concatenation of its pieces
    ``(source prefix, first sequence, end sequence)``, in the given order
    (a list on the driver; ``gather_table`` takes a table of any length)."""
    from corpusloom.session import prepare_session
    prepare_session(spark)
    headers = dict(headers or {})
    rows = []
    for out, pieces in targets.items():
        seq = byte = doc = 0
        if not pieces:
            rows.append((out, "", "uint16", 0, 0, 0, 0, 0, 0, 0, 0))
        for prefix, lo, hi in pieces:
            h = headers.setdefault(prefix, None) or read_header(prefix)
            headers[prefix] = h
            n_bytes, n_docs = _piece_bytes(prefix, h, lo, hi), _docs_ending_in(prefix, h, lo, hi)
            rows.append((out, prefix, h.dtype, lo, hi, seq, byte, doc, hi - lo, n_bytes, n_docs))
            seq, byte, doc = seq + hi - lo, byte + n_bytes, doc + n_docs
    return gather_table(spark, spark.createDataFrame(rows, PLAN_SCHEMA), documents, multimodal)


# One row per piece: where it comes from, where it goes, and what it adds.
PLAN_SCHEMA = ("out string, prefix string, dtype string, lo long, hi long, seq_base long, byte_base long, doc_base long, "
               "n_seq long, n_bytes long, n_docs long")


def gather_table(spark: SparkSession, plan: DataFrame, documents: str = "keep", multimodal: bool = False,
                 before_names=None, delete_data: bool = False) -> dict:
    """Write the datasets that ``plan`` (``PLAN_SCHEMA``) lays out.

    ``documents="keep"``: pieces are whole datasets (or consecutive ranges
    that together cover whole datasets) and their document boundaries are
    re-based. ``documents="sequence"``: every sequence becomes its own
    document (document index 0..S), as the re-sharder writes.

    The driver sees one row per target: it makes the empty files. Tasks copy
    pieces, several each, and write their slices of data and index at the
    pieces' places with ``os.pwrite``; a retried task writes the same bytes.
    ``before_names`` is called when everything is copied, before the files get
    their final names. With ``delete_data`` the ``.bin`` of a source that is one
    piece is deleted once it is copied, and a retried task takes a missing one as
    copied.
    """
    from corpusloom.session import prepare_session
    prepare_session(spark)
    sums = plan.groupBy("out").agg(F.sum("n_seq").alias("S"), F.sum("n_docs").alias("docs"), F.sum("n_bytes").alias("total"),
                                   F.collect_set(F.when(F.col("prefix") != "", F.col("dtype"))).alias("dtypes"),
                                   F.count(F.lit(1)).alias("pieces"))
    targets = {r["out"]: r for r in sums.collect()}  # one row per target dataset
    dtypes = {d for r in targets.values() for d in r["dtypes"]}
    if len(dtypes) > 1:
        raise ValueError(f"cannot combine datasets of different dtypes: {sorted(dtypes)} (Q18)")
    dtype = dtypes.pop() if dtypes else "uint16"
    tag = uuid.uuid4().hex[:8]
    entries = {}
    for out, r in targets.items():
        S, docs = r["S"], 1 + (r["S"] if documents == "sequence" else r["docs"])
        entries[out] = (S, docs)
        os.makedirs(os.path.dirname(out) or ".", exist_ok=True)
        with open(f"{out}.bin.{tag}", "wb") as f:
            f.truncate(r["total"])
        with open(f"{out}.idx.{tag}", "wb") as f:
            f.truncate(HEADER_SIZE + 12 * S + 8 * docs + (S if multimodal else 0))
            f.write(MAGIC + struct.pack("<Q", VERSION) + struct.pack("<B", DTYPE_CODES[dtype]) + struct.pack("<QQ", S, docs))
            f.seek(HEADER_SIZE + 12 * S)
            f.write(struct.pack("<q", 0))
    n_pieces = sum(r["pieces"] for r in targets.values())
    # enough tasks for every core, not one for each piece
    tasks = max(1, min(n_pieces, 4 * spark.sparkContext.defaultParallelism + n_pieces // 64))
    item = DTYPE_SIZES[dtype]

    def copy(batches):
        from corpusloom.sources.binidx import Header
        for pdf in batches:
            done = []
            for r in pdf.itertuples(index=False):
                S, D = entries[r.out]
                if r.prefix:
                    head = read_header(r.prefix)
                    h = Header(r.prefix, head.dtype, head.n_seq, head.n_doc_idx, -1)
                    gone = delete_data and head.bin_size < 0
                    _copy_piece(r, h, S, D, f"{r.out}.idx.{tag}", f"{r.out}.bin.{tag}", item, documents, multimodal, gone)
                    if delete_data and not gone and (r.lo, r.hi) == (0, head.n_seq):
                        os.remove(r.prefix + ".bin")
                done.append((r.out, int(r.hi - r.lo)))
            yield pd.DataFrame(done, columns=["out", "n"])

    copied = {r[0]: r[1] for r in plan.repartition(tasks).mapInPandas(copy, "out string, n long").groupBy("out")
              .agg({"n": "sum"}).collect()}
    for out, (S, _) in entries.items():
        if copied.get(out, 0) != S:
            raise RuntimeError(f"{out}: copied {copied.get(out, 0)} of {S} sequences")
    if before_names:
        before_names()
    result = {}
    for out, r in targets.items():
        S, D = entries[out]
        os.replace(f"{out}.bin.{tag}", out + ".bin")
        os.replace(f"{out}.idx.{tag}", out + ".idx")
        result[out] = {"sequences": S, "documents": D - 1, "bytes": r["total"], "dtype": dtype}
    return result


COPY_SEQUENCES = 1 << 20  # index entries written at a time


def _copy_piece(r, h, S: int, D: int, idx: str, data: str, item: int, documents: str, multimodal: bool, index_only: bool = False) -> None:
    """One piece, in blocks: memory does not follow its number of sequences."""
    lengths, pointers, doc_idx, modes = _index_arrays(r.prefix, h, multimodal)
    fi, fb = os.open(idx, os.O_WRONLY), os.open(data, os.O_WRONLY)
    try:
        start = int(pointers[r.lo]) if r.hi > r.lo else 0
        for a in range(r.lo, r.hi, COPY_SEQUENCES):
            b, at = min(r.hi, a + COPY_SEQUENCES), r.seq_base + a - r.lo
            os.pwrite(fi, np.array(lengths[a:b], "<i4").tobytes(), HEADER_SIZE + 4 * at)
            os.pwrite(fi, (np.array(pointers[a:b], "<i8") - start + r.byte_base).tobytes(), HEADER_SIZE + 4 * S + 8 * at)
            if multimodal:
                os.pwrite(fi, np.array(modes[a:b], "i1").tobytes(), HEADER_SIZE + 12 * S + 8 * D + at)
            if documents == "sequence":
                os.pwrite(fi, np.arange(at + 1, at + 1 + b - a, dtype="<i8").tobytes(), HEADER_SIZE + 12 * S + 8 * (1 + at))
        if r.hi > r.lo and not index_only:
            end = int(pointers[r.hi - 1]) + int(lengths[r.hi - 1]) * item
            with open(r.prefix + ".bin", "rb") as src:
                src.seek(start)
                pos = start
                while pos < end and (buf := src.read(min(64 << 20, end - pos))):
                    os.pwrite(fb, buf, r.byte_base + pos - start)
                    pos += len(buf)
        if documents != "sequence":
            # documents that end in (lo, hi]; the first piece also has the empty ones at the start
            a, b = 1 if r.lo == 0 else bisect_right(doc_idx, r.lo), bisect_right(doc_idx, r.hi)
            for k in range(a, b, COPY_SEQUENCES):
                ent = np.array(doc_idx[k:min(b, k + COPY_SEQUENCES)], dtype="<i8") - r.lo + r.seq_base
                os.pwrite(fi, ent.astype("<i8").tobytes(), HEADER_SIZE + 12 * S + 8 * (1 + r.doc_base + k - a))
    finally:
        os.close(fi)
        os.close(fb)


def _docs_ending_in(prefix: str, h, lo: int, hi: int) -> int:
    """Document-index entries (after the leading 0) that a piece contributes:
    documents whose end falls in (lo, hi], plus leading empty documents when
    the piece starts the source."""
    _, _, doc_idx, _ = _index_arrays(prefix, h, False)
    return bisect_right(doc_idx, hi) - (1 if lo == 0 else bisect_right(doc_idx, lo))


def _piece_bytes(prefix: str, h, lo: int, hi: int) -> int:
    if hi <= lo:
        return 0
    lengths, pointers, _, _ = _index_arrays(prefix, h, False)
    return int(pointers[hi - 1]) + int(lengths[hi - 1]) * h.itemsize - int(pointers[lo])
