"""Parallelism guard for CPU-heavy stages.

Python tokenizer stages cost far more per byte than the scan. When the input
arrives in fewer partitions than the cluster has cores (one large row group,
a handful of files), the stage would run on a few cores only. ``balance``
then adds one shuffle of the *input* (text, smaller than its token ids) to
spread it; with enough input splits, as at scale, it adds nothing.
"""

from __future__ import annotations

from pyspark.sql import DataFrame


def target_partitions(df: DataFrame) -> int:
    return df.sparkSession.sparkContext.defaultParallelism


def balance(df: DataFrame, key: str | None = None, n: int | None = None) -> DataFrame:
    """Spread ``df`` over at least ``n`` (default: all cores) partitions.
    With ``key`` the split is by range, so every partition holds a contiguous
    run of ``key`` (and ``spark_partition_id()`` follows the key order)."""
    n = n or target_partitions(df)
    if df.rdd.getNumPartitions() >= n:
        return df
    return df.repartitionByRange(n, key) if key else df.repartition(n)
