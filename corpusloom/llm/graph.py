"""Connected components as DataFrame joins (large-star / small-star rounds)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.llm.common import checkpoint


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """Rows ``(node, root)`` for every node of ``edges`` that is not itself the
    smallest node of its component; ``root`` is that smallest node.

    Each round joins every edge with the smallest neighbour of its end, so no
    adjacency list is ever gathered: a node with a million neighbours is a
    partial minimum plus a join that adaptive execution can split. The state
    is checkpointed once a round; rounds stop when it no longer changes.
    Self-loops and repeated edges are allowed; nulls are dropped.
    """
    v, m = F.greatest(a, b), F.least(a, b)
    e = checkpoint(edges.where(F.col(a) != F.col(b)).select(v.alias("v"), m.alias("m")).distinct())
    last = None
    while True:
        both = e.select(F.col("v").alias("u"), F.col("m").alias("w")).union(
            e.select(F.col("m").alias("u"), F.col("v").alias("w")))
        low = both.groupBy("u").agg(F.min("w").alias("s")).select("u", F.least("u", "s").alias("m"))
        large = (both.join(low, "u").where(F.col("w") > F.col("u"))
                 .select(F.col("w").alias("v"), "m").distinct())
        low = large.groupBy("v").agg(F.min("m").alias("s"))
        small = (large.join(low, "v").where(F.col("m") != F.col("s"))
                 .select(F.col("m").alias("v"), F.col("s").alias("m"))
                 .union(low.select("v", F.col("s").alias("m"))).distinct())
        e = checkpoint(small)
        now = tuple(e.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("v", "m"))).first())
        if now == last:
            return e.select(F.col("v").alias("node"), F.col("m").alias("root"))
        last = now
