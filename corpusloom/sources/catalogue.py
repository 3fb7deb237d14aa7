"""Catalogue of indexed datasets as a table.

One row per dataset part: headers are read in tasks, sequence and document
bases are prefix sums over the table, and reads are planned from it. The driver
names folders; it opens no part and holds no list of them.
"""

from __future__ import annotations

import os
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from corpusloom.session import checkpoint, local_path, prepare_session
from corpusloom.sources.binidx import BinIdxReader, _Range, _schema, read_header

CATALOGUE = ("ord long, prefix string, dtype string, n_seq long, n_docs long, bin_size long")
BIN = 1 << 16  # ids of one bin of an interval lookup


def part_names(spark: SparkSession, path: str) -> DataFrame:
    """``(ord, prefix)``: the parts of folders and prefixes (comma-separated), in order."""
    prepare_session(spark)
    out, single = None, []
    for k, p in enumerate(s.strip() for s in path.split(",") if s.strip()):
        if os.path.isdir(local_path(p)):
            found = (spark.read.format("binaryFile").option("pathGlobFilter", "*.idx").load(p)
                     .select(F.lit(k).cast("long").alias("ord"), F.regexp_replace("path", r"^file:/*(?=/)|\.idx$", "").alias("prefix")))
            out = found if out is None else out.unionByName(found)
        else:
            single.append((k, local_path(p[:-4] if p.endswith((".idx", ".bin")) else p)))
    if single or out is None:
        given = spark.createDataFrame(single, "ord long, prefix string")
        out = given if out is None else out.unionByName(given)
    return out


def catalogue(spark: SparkSession, path: str) -> DataFrame:
    """The catalogue of the parts under ``path`` (see ``catalogue_of``)."""
    return catalogue_of(spark, part_names(spark, path))


def catalogue_of(spark: SparkSession, names: DataFrame) -> DataFrame:
    """One row per part with its header and the bases of its ids (``seq_base``,
    ``doc_base``, ``byte_base``) in (given path, name) order. Parts of different
    dtypes are an error."""
    from corpusloom.operators.index import two_level_prefix

    def heads(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = []
            for k, prefix in b.itertuples(index=False):
                h = read_header(prefix)
                rows.append((k, prefix, h.dtype, h.n_seq, max(h.n_doc_idx - 1, 0), h.bin_size))
            yield pd.DataFrame(rows, columns=[c.split()[0] for c in CATALOGUE.split(", ")])
    if "ord" not in names.columns:
        names = names.select(F.lit(0).cast("long").alias("ord"), "prefix")
    parts = names.repartition(4 * spark.sparkContext.defaultParallelism).mapInPandas(heads, CATALOGUE)
    out = checkpoint(two_level_prefix(parts, ["ord", "prefix"], {"seq_base": F.col("n_seq"), "doc_base": F.col("n_docs"),
                                                                 "byte_base": F.greatest("bin_size", F.lit(0))}))
    kinds = out.agg(F.min("dtype"), F.max("dtype")).first()
    if kinds[0] != kinds[1]:
        raise ValueError(f"mixed dtypes {kinds[0]} and {kinds[1]} in one read")
    return out


def read_ranges(parts: DataFrame, bytes_per_range: int = 128 << 20, rows_per_range: int = 1 << 22,
                columns: str = "all") -> DataFrame:
    """The catalogue's parts cut into ranges of about so many bytes and at most so
    many sequences; cuts are bisected in the pointer arrays, in tasks."""
    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = []
            for r in b.itertuples(index=False):
                reader = BinIdxReader({"rowsPerPartition": str(rows_per_range), "columns": columns}, None)
                size = max(r.bin_size, 0) if columns != "index" else 12 * r.n_seq
                n = max(1, -(-size // bytes_per_range), -(-r.n_seq // rows_per_range))
                rows += [(r.prefix, r.dtype, lo, hi, r.seq_base, r.doc_base, r.n_seq, r.n_docs + 1, r.bin_size)
                         for lo, hi in reader._cuts(r.prefix, read_header(r.prefix), r.n_seq, n) if hi > lo]
            yield pd.DataFrame(rows, columns=["prefix", "dtype", "lo", "hi", "seq_base", "doc_base", "n_seq", "n_doc_idx", "bin_size"])
    return (parts.select("prefix", "dtype", "seq_base", "doc_base", "n_seq", "n_docs", "bin_size")
            .mapInPandas(cut, "prefix string, dtype string, lo long, hi long, seq_base long, doc_base long, n_seq long, "
                              "n_doc_idx long, bin_size long"))


def read_sequences(spark: SparkSession, path: str, columns: str = "all", bytes_per_range: int = 128 << 20,
                   seq_lo: int = 0, seq_hi: int | None = None) -> DataFrame:
    """S3/S4 planned in Spark: the ``binidx`` columns of every sequence of every
    part; ``seq_lo`` and ``seq_hi`` bound the ids, other ranges are not read."""
    parts = catalogue(spark, path)
    ranges = read_ranges(parts, bytes_per_range, columns=columns)
    lo = F.greatest(F.col("lo"), F.lit(seq_lo) - F.col("seq_base"))
    hi = F.col("hi") if seq_hi is None else F.least(F.col("hi"), F.lit(seq_hi) - F.col("seq_base"))
    ranges = checkpoint(ranges.withColumns({"lo": lo, "hi": hi}).where("hi > lo"))
    dtype = (parts.agg(F.max("dtype")).first()[0]) or "int32"
    schema = _schema("sequences", columns, dtype)
    tasks = max(1, ranges.count())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = BinIdxReader({"columns": columns}, None)
        for b in batches:
            for r in b.to_pylist():
                yield from reader.read(_Range(**r))
    # one range a task, as a file scan would plan them
    return ranges.repartition(tasks, "prefix", "lo").mapInArrow(run, schema)


def interval_lookup(points: DataFrame, intervals: DataFrame, at: str, begin: str, end: str, bin_size: int = BIN) -> DataFrame:
    """Every point row with the columns of the interval ``begin <= at < end`` that
    holds it (intervals don't overlap; points outside all of them are dropped).

    Ids are cut into bins. An interval gives one row for each bin it reaches
    into, a point one row; each bin is swept once in id order and a point takes
    the last interval that began. No row is made per id, and no side is
    broadcast.
    """
    payload = F.struct(*[F.col(c) for c in intervals.columns])
    starts = (intervals.where(F.col(end) > F.col(begin))
              .select(F.explode(F.sequence(F.expr(f"`{begin}` div {bin_size}"), F.expr(f"(`{end}` - 1) div {bin_size}"))).alias("_bin"),
                      F.col(begin).alias("_from"), payload.alias("_iv"))
              .select("_bin", F.greatest("_from", F.col("_bin") * bin_size).alias("_at"), F.lit(0).alias("_kind"), "_iv"))
    seen = (points.where(F.col(at).isNotNull())
            .select(F.expr(f"`{at}` div {bin_size}").alias("_bin"), F.col(at).cast("long").alias("_at"), F.lit(1).alias("_kind"),
                    F.struct(*[F.col(c) for c in points.columns]).alias("_pt")))
    sweep = (Window.partitionBy("_bin").orderBy("_at", "_kind").rowsBetween(Window.unboundedPreceding, Window.currentRow))
    rows = starts.unionByName(seen, allowMissingColumns=True).withColumn("_iv", F.last("_iv", ignorenulls=True).over(sweep))
    rows = rows.where((F.col("_kind") == 1) & (F.col("_at") < F.col(f"_iv.{end}")))
    return rows.select("_pt.*", *[F.col(f"_iv.{c}").alias(c) for c in intervals.columns if c not in points.columns])
