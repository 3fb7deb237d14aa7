"""Random access into a sequence table."""

from __future__ import annotations

import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.sources.binidx import _ARROW_ELEM, _SPARK_ELEM, _index_arrays, read_header
from corpusloom.sources.catalogue import catalogue, interval_lookup


def get_tokens(seqs: DataFrame, requests: DataFrame, tokens_col: str = "tokens") -> DataFrame:
    """``requests(seq_id, offset, length)`` → the token sub-range of each
    requested sequence; a NULL length means "to the end". Out-of-range
    requests raise (the reference does not check). For sequences that come from
    anywhere; ``seek_tokens`` reads them from dataset files."""
    j = requests.join(seqs.select("seq_id", tokens_col), "seq_id")
    size = F.size(tokens_col)
    length = F.coalesce(F.col("length"), size - F.col("offset"))
    bad = (F.col("offset") < 0) | (F.col("offset") > size) | (length < 0) | (F.col("offset") + length > size)
    sliced = F.when(bad, F.raise_error(F.concat(F.lit("request out of range for sequence "),
                                                F.col("seq_id").cast("string"))))
    sliced = sliced.otherwise(F.when(length == 0, F.array().cast(seqs.schema[tokens_col].dataType))
                              .otherwise(F.slice(tokens_col, F.col("offset") + 1, length)))
    return j.select("seq_id", "offset", F.col("length").alias("length"), sliced.alias("tokens"))


def slice_sequences(seqs: DataFrame, start: int, stop: int, step: int | None = None) -> DataFrame:
    """Sequences ``start <= seq_id < stop``; only step 1 is supported.
    On a ``binidx`` scan the range is a plain filter on ``seq_id``."""
    if step not in (None, 1):
        raise ValueError("slices into indexed datasets only support contiguous ranges")
    return seqs.where((F.col("seq_id") >= start) & (F.col("seq_id") < stop))


def sequence_documents(seqs: DataFrame, docs: DataFrame) -> DataFrame:
    """Sequence → document through the boundary table
    ``docs(doc_id, seq_begin, seq_end)``: an interval lookup, with one row per
    document and bin of ids on the document side and none per sequence."""
    found = interval_lookup(seqs, docs.select(F.col("doc_id").alias("_doc"), "seq_begin", "seq_end"), "seq_id", "seq_begin", "seq_end")
    return found.select(*[c for c in seqs.columns if c != "doc_id"], F.col("_doc").alias("doc_id"))


def seek_tokens(spark: SparkSession, path: str, requests: DataFrame) -> DataFrame:
    """J3 as point reads: ``requests(seq_id, offset, length)`` against the parts
    under ``path`` → ``(seq_id, offset, length, tokens)``.

    Requests are matched to parts by an interval lookup over the catalogue, sorted
    by place and dealt in ranges; each task maps the pointer arrays and reads just
    the bytes asked for, so neither the tokens nor the index travel. A NULL length
    means "to the end"; requests outside a sequence, or for an id that no part
    has, raise.
    """
    parts = catalogue(spark, path)
    total = parts.agg((F.max(F.col("seq_base") + F.col("n_seq"))).alias("n"), F.max("dtype").alias("dtype")).first()
    dtype, n = total["dtype"] or "int32", total["n"] or 0
    seq = F.col("seq_id")
    known = requests.select(
        F.when((seq < 0) | (seq >= n), F.raise_error(F.concat(F.lit("no such sequence: "), seq.cast("string"))).cast("long"))
        .otherwise(seq.cast("long")).alias("seq_id"), F.col("offset").cast("long").alias("offset"), F.col("length").cast("long").alias("length"))
    placed = interval_lookup(known, parts.select("prefix", F.col("seq_base").alias("first"), (F.col("seq_base") + F.col("n_seq")).alias("last")),
                             "seq_id", "first", "last")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, part = None, None
        for b in batches:
            tokens = []
            for prefix, seq_id, first, offset, length in zip(*(c.to_pylist() for c in b.columns[:5])):
                if prefix != now:
                    if part:
                        os.close(part[0])
                    h = read_header(prefix)
                    lengths, pointers, _, _ = _index_arrays(prefix, h, False)
                    now, part = prefix, (os.open(prefix + ".bin", os.O_RDONLY), lengths, pointers, np.dtype(h.dtype).newbyteorder("<"))
                file, lengths, pointers, kind = part
                size = int(lengths[seq_id - first])
                many = size - offset if length is None else length
                if offset < 0 or many < 0 or offset + many > size:
                    raise ValueError(f"request out of range for sequence {seq_id}")
                raw = os.pread(file, many * kind.itemsize, int(pointers[seq_id - first]) + offset * kind.itemsize)
                tokens.append(np.frombuffer(raw, dtype=kind))
            sizes = np.cumsum([0, *map(len, tokens)]).astype(np.int32)
            flat = pa.array(np.concatenate(tokens) if tokens else np.zeros(0, np.int32)).cast(_ARROW_ELEM[dtype])
            yield pa.RecordBatch.from_arrays([b.column(1), b.column(3), b.column(4), pa.ListArray.from_arrays(pa.array(sizes), flat)],
                                             names=["seq_id", "offset", "length", "tokens"])
        if part:
            os.close(part[0])
    return (placed.select("prefix", "seq_id", "first", "offset", "length").repartitionByRange("prefix", "seq_id")
            .sortWithinPartitions("prefix", "seq_id", "offset")
            .mapInArrow(run, f"seq_id long, offset long, length long, tokens array<{_SPARK_ELEM[dtype]}>"))
