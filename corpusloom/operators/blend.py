"""Weighted blend of corpora.

``parse_blend`` reads the list form; ``blend_select`` applies the normalised
weights to rows. Selection is exact and skew-safe: rows are ranked inside a corpus
by a seeded score without a window over the whole corpus. A histogram of the
score's top bits per corpus (map-side combined) locates the bucket where the
quota ends; only that one bucket per corpus is ranked exactly.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def _number(text: str) -> float | None:
    try:
        return float(text)
    except ValueError:
        return None


def parse_blend(blend: list[str] | None) -> tuple[list[str], list[float] | None] | None:
    """A list of ``weight prefix`` pairs gives prefixes and weights; any other
    list (odd length, or a weight that is no number) is prefixes only. Blanks
    around prefixes are dropped."""
    if blend is None:
        return None
    names = [entry.strip() for entry in blend]
    weights = [_number(w) for w in names[::2]]
    if len(names) % 2 or None in weights:
        return names, None
    return names[1::2], weights


def blend_table(spark: SparkSession, blend: list[str]) -> DataFrame:
    """``(prefix, weight, share)`` with ``share = weight / sum(weight)``;
    without weights every prefix gets the same weight."""
    prefixes, weights = parse_blend(blend)
    weights = weights or [1.0] * len(prefixes)
    df = spark.createDataFrame(list(zip(prefixes, weights)), "prefix string, weight double")
    return normalize(df)


def normalize(weights: DataFrame) -> DataFrame:
    return weights.withColumn("share", F.col("weight") / F.sum("weight").over(Window.partitionBy()))


def blend_select(df: DataFrame, corpus_col: str, id_col: str, weights: DataFrame,
                 total: int | None = None, score: Column | None = None, seed: int = 42,
                 bucket_shift: int = 48) -> DataFrame:
    """Rows of each corpus up to ``quota = min(n_c, (w_c * N) div sum(w))``,
    taking the lowest ``(score, id)`` first. ``weights(prefix, weight)`` has
    one row per blend entry; whether a join broadcasts is the planner's choice.

    ``score`` defaults to ``xxhash64(id, seed)``; buckets are its top bits
    (``score >> bucket_shift``), which keeps the score order.
    """
    if score is None:
        score = F.xxhash64(F.col(id_col), F.lit(seed))
    scored = df.withColumn("_score", score).withColumn("_bucket", F.shiftright("_score", bucket_shift))
    w = weights.select(F.col("prefix").alias(corpus_col), F.col("weight").cast("double").alias("_w"))
    counts = scored.groupBy(corpus_col).agg(F.count(F.lit(1)).alias("_n"))
    n_total = F.sum("_n").over(Window.partitionBy()) if total is None else F.lit(int(total))
    quotas = (counts.join(w, corpus_col)
              .withColumn("_total", n_total)
              .withColumn("_wsum", F.sum("_w").over(Window.partitionBy()))
              .withColumn("_q", F.least(F.col("_n"),
                                        F.floor(F.col("_w") * F.col("_total") / F.col("_wsum")).cast("long")))
              .select(corpus_col, "_q"))
    hist = scored.groupBy(corpus_col, "_bucket").agg(F.count(F.lit(1)).alias("_c"))
    wc = Window.partitionBy(corpus_col).orderBy("_bucket")
    hist = (hist.withColumn("_cum", F.sum("_c").over(wc.rowsBetween(Window.unboundedPreceding, 0)))
            .join(quotas, corpus_col)
            .where((F.col("_cum") - F.col("_c") < F.col("_q")) & (F.col("_cum") >= F.col("_q")))
            .select(corpus_col, F.col("_bucket").alias("_edge"), (F.col("_q") - (F.col("_cum") - F.col("_c"))).alias("_need")))
    j = scored.join(hist, corpus_col)
    below = j.where(F.col("_bucket") < F.col("_edge"))
    edge = j.where(F.col("_bucket") == F.col("_edge"))
    we = Window.partitionBy(corpus_col, "_bucket").orderBy("_score", id_col)
    edge = edge.withColumn("_r", F.row_number().over(we)).where(F.col("_r") <= F.col("_need")).drop("_r")
    cols = df.columns
    return below.select(*cols).unionByName(edge.select(*cols))
