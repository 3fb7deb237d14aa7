"""Incremental corpus ingestion (ST1).

The reference is batch-only; its closest behaviours are the ordered line
iterator and artifact-based resume. Here new ``.jsonl`` files in the corpus
folder are picked up by a file stream; every micro-batch runs the same
parse (P1-P4) as the batch job inside ``foreachBatch``, and with a tokenizer
the same encoding, reading its own records, and writes immutable parts named after its batch id
(overwrite of the same id makes a replayed batch idempotent). The streaming checkpoint replaces the
reference's resume markers.

A file is read whole inside one micro-batch, so ``line_no`` (position inside
the file) is exact. Running ids go on from batch to batch: every batch records
how many lines, sequences and tokens the stream has had up to its end, and
starts from what the batch before it recorded. A replayed batch looks at earlier
batches only, so it writes the same ids again. With files that arrive in path
order the ids are those of one batch build over all of them.
"""

from __future__ import annotations

import glob
import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.functions.base import Tokenizer, encode_documents
from corpusloom.operators import parse
from corpusloom.operators.index import optimal_dtype
from corpusloom.operators.parallel import target_partitions
from corpusloom.session import prepare_session, release, scratch_dir
from corpusloom.sources.binidx import write_binidx
from corpusloom.sources.catalogue import catalogue, read_sequences
from corpusloom.sources.corpus import JSONL_GLOB, _hadoop_fs, with_line_ids

TASK_BYTES = 32 << 20  # bytes of parsed lines (compressed) in a task of a batch, about


def corpus_stream(spark: SparkSession, src: str, max_files_per_trigger: int | None = None) -> DataFrame:
    r = (spark.readStream.option("recursiveFileLookup", "true").option("pathGlobFilter", JSONL_GLOB))
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return r.text(src).select("value", F.col("_metadata.file_path").alias("file_path"),
                              F.col("_metadata.file_block_start").alias("_block"))


def process_batch(batch: DataFrame, batch_id: int, out: str, keys: list[str],
                  tokenizer: Tokenizer | None = None, dtype: str | None = None) -> None:
    """One micro-batch: parsed once into the scratch folder (nothing is
    cached), then written as records, in line order, and quarantine; the parsed
    lines go then. With a tokenizer the records are read again, without a
    shuffle, into one indexed dataset folder per key. All are named after the
    batch and overwritten when it is replayed."""
    spark = batch.sparkSession
    before = totals_before(spark, out, batch_id, keys)
    raw = batch.select("*", F.monotonically_increasing_id().alias("_mid"))
    staged = scratch_dir(spark, f"batch-{batch_id}")
    rejected = F.when(F.col("reason").isNotNull(), F.col("value"))  # the line itself is for the quarantine only
    parse.classify(with_line_ids(raw), keys).withColumn("value", rejected).write.mode("overwrite").parquet(staged)
    cls = spark.read.parquet(staged)
    ok = cls.where(F.col("reason").isNull())
    sizes = {"lines": cls.count()}
    fs, root = _hadoop_fs(spark, staged)
    tasks = max(target_partitions(ok), fs.getContentSummary(root).getLength() // TASK_BYTES)
    records = ok.select("file_path", "line_no", (F.col("line_id") + before["lines"]).alias("line_id"),
                        *[F.col(k).alias("sentences" if len(keys) == 1 else k) for k in keys])
    folder = os.path.join(out, "records", f"batch={batch_id}")
    records.repartitionByRange(tasks, "line_id").sortWithinPartitions("line_id").write.mode("overwrite").parquet(folder)
    (parse.quarantine(cls).withColumn("line_id", F.col("line_id") + before["lines"]).write.mode("overwrite")
     .parquet(os.path.join(out, "quarantine", f"batch={batch_id}")))
    fs.delete(root, True)
    release(spark)
    # each records file, or range of it that a task reads, is a run of lines: one part, named after its first line
    texts = spark.read.schema(records.schema).parquet(folder).select(
        "*", F.col("_metadata.file_path").alias("_file"), F.col("_metadata.file_block_start").alias("_block"))
    runs = texts.groupBy("_file", "_block").agg(F.min("line_id").alias("part"))
    for key in keys if tokenizer is not None else ():
        enc = encode_documents(texts.join(F.broadcast(runs), ["_file", "_block"]).select("part", F.col("sentences" if len(keys) == 1 else key).alias("sentences")),
                               tokenizer, keep=["part"])
        folder = os.path.join(dataset_dir(out, key), f"batch-{batch_id:09d}")
        write_binidx(enc, folder, dtype=dtype or optimal_dtype(tokenizer.vocab_size))
        _write_index(spark, folder, os.path.join(out, "index", key, f"batch={batch_id}"), before, key, sizes)
    after = {name: before[name] + sizes.get(name, 0) for name in before}
    (spark.createDataFrame([tuple(after.values())], ", ".join(f"`{n}` long" for n in after))
     .coalesce(1).write.mode("overwrite").parquet(os.path.join(out, "totals", f"batch={batch_id}")))


def totals_before(spark: SparkSession, out: str, batch_id: int, keys: list[str]) -> dict[str, int]:
    """What the stream has had before this batch: the record of the last earlier one."""
    names = ["lines", *[f"{what}:{k}" for k in keys for what in ("documents", "sequences", "bytes")]]
    found = []
    fs, root = _hadoop_fs(spark, os.path.join(out, "totals"))
    if fs.exists(root):
        done = [int(f.getPath().getName().split("=")[1]) for f in fs.listStatus(root) if "=" in f.getPath().getName()]  # one name a batch
        found = [b for b in done if b < batch_id]
    if not found:
        return dict.fromkeys(names, 0)
    row = spark.read.parquet(os.path.join(out, "totals", f"batch={max(found)}")).first().asDict()
    return {n: row.get(n) or 0 for n in names}


def _write_index(spark: SparkSession, folder: str, target: str, before: dict, key: str, sizes: dict) -> None:
    """The batch's sequences with their ids and byte pointers in the whole stream."""
    parts = catalogue(spark, folder)
    index = read_sequences(spark, folder, columns="index").join(parts.select("prefix", "byte_base"), "prefix")
    (index.select((F.col("seq_id") + before[f"sequences:{key}"]).alias("seq_id"), (F.col("doc_id") + before[f"documents:{key}"]).alias("doc_id"),
                  "sent_pos", "length", (F.col("ptr") + F.col("byte_base") + before[f"bytes:{key}"]).alias("ptr"))
     .write.mode("overwrite").parquet(target))
    n = parts.agg(F.sum("n_docs"), F.sum("n_seq"), F.sum(F.greatest("bin_size", F.lit(0)))).first()
    sizes |= {f"documents:{key}": n[0] or 0, f"sequences:{key}": n[1] or 0, f"bytes:{key}": n[2] or 0}


def dataset_dir(out: str, key: str) -> str:
    return os.path.join(out, "dataset", key)


def streamed_prefixes(out: str, key: str) -> str:
    """Folders of the key's datasets in batch order, as ``read_binidx`` takes
    them: together they are one dataset with re-based offsets."""
    return ",".join(sorted(glob.glob(os.path.join(dataset_dir(out, key), "batch-*"))))


def ingest_corpus_stream(spark: SparkSession, src: str, out: str, keys=("text",),
                         checkpoint: str | None = None, max_files_per_trigger: int | None = None,
                         tokenizer: Tokenizer | None = None, dtype: str | None = None) -> DataFrame:
    """Run the stream until all files present now are processed
    (``availableNow``) and return the records written so far. Files are taken
    ``max_files_per_trigger`` at a time; without it one batch holds all new files."""
    prepare_session(spark)
    keys = list(keys)
    checkpoint = checkpoint or scratch_dir(spark, "stream-checkpoint")
    q = (corpus_stream(spark, src, max_files_per_trigger).writeStream
         .foreachBatch(lambda df, bid: process_batch(df, bid, out, keys, tokenizer, dtype))
         .option("checkpointLocation", checkpoint)
         .trigger(availableNow=True).start())
    q.awaitTermination()
    return spark.read.parquet(os.path.join(out, "records"))
