"""Index offsets over a token dataset.

Every running quantity (sequence id, byte pointer, document boundary) is a
*two-level* prefix sum, never an un-partitioned window over all rows:

1. rows are range-partitioned by the order: a partition is a block, of about
   equal size whatever the keys are (dense, sparse or clustered);
2. a window partitioned by block gives the in-block running value;
3. the block totals (one row per partition, partial aggregation) get their
   exclusive prefix sum and are joined back.

The lengths-only input is checkpointed (written to the shared checkpoint
folder), so the producing stage runs once and the lineage is cut.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusloom.session import checkpoint

# Fixed values of the binary format: dtype codes and item sizes.
DTYPE_CODES = {"uint8": 1, "int8": 2, "int16": 3, "int32": 4, "int64": 5,
               "float64": 6, "float32": 7, "uint16": 8}
DTYPE_SIZES = {"uint8": 1, "int8": 1, "int16": 2, "int32": 4, "int64": 8,
               "float64": 8, "float32": 4, "uint16": 2}
CODE_DTYPES = {v: k for k, v in DTYPE_CODES.items()}


def optimal_dtype(vocab_size: int | None) -> str:
    """uint16 when the vocabulary has fewer than 65535 ids, else int32."""
    return "uint16" if vocab_size is not None and vocab_size < 65535 else "int32"


def padded_vocab_size(vocab_size: int, divisible_by: int = 128, parallel: int = 1) -> int:
    """Smallest multiple of ``divisible_by * parallel`` not below the size."""
    m = divisible_by * parallel
    return -(-vocab_size // m) * m


def id_range(encoded: DataFrame, ids_col: str = "token_ids") -> DataFrame:
    """Corpus-wide min/max id, to check the storage width before a write."""
    return encoded.agg(F.min(F.array_min(ids_col)).alias("min_id"),
                       F.max(F.array_max(ids_col)).alias("max_id"))


def two_level_prefix(df: DataFrame, order: list[str], values: dict[str, Column], counts: list[str] = ()) -> DataFrame:
    """Exclusive prefix sums of ``values`` (and 0-based row counts named in
    ``counts``) in ``order``.

    The input (lengths only) is checkpointed before the range partitioning
    samples it, so whatever produced it (a tokenizer stage, a file scan) runs
    once, and again after it, so the block totals and the in-block windows
    read the same rows. Equal order keys share a block.
    """
    # reliable checkpoints, not caches: a cache would be reused by any later
    # plan that looks the same, even after the input or the split settings
    # changed
    d = checkpoint(checkpoint(df).repartitionByRange(*order).withColumn("_blk", F.spark_partition_id()))
    names = list(values) + list(counts)
    aggs = [F.sum(v).cast("long").alias(f"_t_{n}") for n, v in values.items()]
    aggs += [F.count(F.lit(1)).cast("long").alias(f"_t_{n}") for n in counts]
    tot = d.groupBy("_blk").agg(*aggs)
    w_b = Window.orderBy("_blk").rowsBetween(Window.unboundedPreceding, -1)
    tot = tot.select("_blk", *[F.coalesce(F.sum(f"_t_{n}").over(w_b), F.lit(0)).cast("long").alias(f"_o_{n}")
                               for n in names])
    w_run = Window.partitionBy("_blk").orderBy(*order)
    w_ex = w_run.rowsBetween(Window.unboundedPreceding, -1)
    run_cols = [F.coalesce(F.sum(v).over(w_ex), F.lit(0)).cast("long").alias(f"_l_{n}") for n, v in values.items()]
    run_cols += [(F.row_number().over(w_run) - 1).cast("long").alias(f"_l_{n}") for n in counts]
    local = d.select("*", *run_cols)
    out = local.join(tot, "_blk")
    return out.select(*df.columns, *[(F.col(f"_o_{n}") + F.col(f"_l_{n}")).alias(n) for n in names])


def sequence_index(encoded: DataFrame, order_col: str = "line_id", itemsize: int = 2,
                   lens_col: str = "sentence_lens", keep: list[str] = ()) -> DataFrame:
    """One row per sequence ``(order, sent_pos, seq_id, length, ptr)``.

    ``ptr`` is the exclusive prefix sum of ``length * itemsize`` in
    (order, sent_pos) order; ``seq_id`` is the running sequence count.
    Only lengths travel through the shuffles, never tokens.
    """
    seqs = encoded.select(order_col, *keep, F.posexplode(lens_col).alias("sent_pos", "length"))
    out = two_level_prefix(seqs, [order_col, "sent_pos"], {"_tok": F.col("length").cast("long")},
                           counts=["seq_id"])
    return out.select(order_col, *keep, F.col("sent_pos").cast("int").alias("sent_pos"),
                      "seq_id", F.col("length").cast("int").alias("length"),
                      (F.col("_tok") * itemsize).alias("ptr"))


def document_index(encoded: DataFrame, order_col: str = "line_id",
                   lens_col: str = "sentence_lens", keep: list[str] = ()) -> DataFrame:
    """``(order, seq_begin, seq_end)``; a document without sequences
    has ``seq_begin == seq_end`` (Q6)."""
    docs = encoded.select(order_col, *keep, F.size(lens_col).cast("long").alias("_n"))
    out = two_level_prefix(docs, [order_col], {"seq_begin": F.col("_n")})
    return out.select(order_col, *keep, "seq_begin", (F.col("seq_begin") + F.col("_n")).alias("seq_end"))


def token_offsets(seqs: DataFrame, doc_col: str = "line_id") -> DataFrame:
    """Token offset of each sequence inside its document (rows of one
    document are a bounded group)."""
    w = (Window.partitionBy(doc_col).orderBy("sent_pos")
         .rowsBetween(Window.unboundedPreceding, -1))
    return seqs.withColumn("tok_offset", F.coalesce(F.sum("length").over(w), F.lit(0)).cast("long"))


def dataset_summary(encoded: DataFrame, itemsize: int = 2, lens_col: str = "sentence_lens") -> DataFrame:
    """A2: documents, sequences, tokens and bytes of a dataset (one pass,
    partial aggregation map-side)."""
    n_seq = F.size(lens_col)
    n_tok = F.aggregate(lens_col, F.lit(0).cast("long"), lambda acc, x: acc + x)
    return encoded.agg(F.count(F.lit(1)).alias("n_documents"),
                       F.sum(n_seq).cast("long").alias("n_sequences"),
                       F.sum(n_tok).cast("long").alias("n_tokens"),
                       (F.sum(n_tok) * itemsize).cast("long").alias("n_bytes"))


def global_rank(df: DataFrame, order: list[str], name: str = "rank") -> DataFrame:
    """Gap-free 0-based rank in ``order`` (which must be a total order)
    without an un-partitioned window: range-partition and sort, number rows
    inside each partition, add the partition's offset (one row per
    partition, broadcast)."""
    n = df.sparkSession.sparkContext.defaultParallelism
    ranged = checkpoint(df.repartitionByRange(n, *order).sortWithinPartitions(*order)
                        .withColumn("_pid", F.spark_partition_id())
                        .withColumn("_mid", F.monotonically_increasing_id()))  # ids fixed once for both uses
    counts = ranged.groupBy("_pid").agg(F.count(F.lit(1)).alias("_n"), F.min("_mid").alias("_m0"))
    w = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offs = counts.select("_pid", "_m0", F.coalesce(F.sum("_n").over(w), F.lit(0)).alias("_off"))
    out = ranged.join(F.broadcast(offs), "_pid")
    return out.select(*df.columns, (F.col("_off") + F.col("_mid") - F.col("_m0")).cast("long").alias(name))
