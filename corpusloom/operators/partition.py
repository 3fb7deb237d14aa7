"""Line partitioning of a corpus.

The reference deals lines out to P temporary files; here the assignment is a
column computed from the gap-free ``line_id`` (S2), so no temporary files
exist and any later stage can group, write or merge by it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def round_robin(lines: DataFrame, n_parts: int, id_col: str = "line_id") -> DataFrame:
    """Line g → part ``g mod P``, position ``g div P`` in that part."""
    return lines.select("*", F.pmod(F.col(id_col), F.lit(n_parts)).alias("part_id"),
                        F.expr(f"{id_col} div {int(n_parts)}").alias("part_pos"))


def sequential(lines: DataFrame, n_parts: int, id_col: str = "line_id",
               n_lines: int | None = None) -> DataFrame:
    """R2: line g → part ``g div ceil(N/P)``; trailing parts may be empty."""
    if n_lines is None:
        n_lines = lines.count()
    size = max(1, -(-n_lines // n_parts))
    return lines.select("*", F.expr(f"{id_col} div {size}").alias("part_id"),
                        F.expr(f"{id_col} - ({id_col} div {size}) * {size}").alias("part_pos"))


def merged_order(parted: DataFrame, id_col: str = "line_id") -> DataFrame:
    """Order after concatenating the parts in part order:
    ``merged_id = (rows in earlier parts) + part_pos``. The part-size table
    has one row per part (P rows, a parameter), so it is broadcast."""
    sizes = parted.groupBy("part_id").agg(F.count(F.lit(1)).alias("_n"))
    w = Window.orderBy("part_id").rowsBetween(Window.unboundedPreceding, -1)
    offs = sizes.select("part_id", F.coalesce(F.sum("_n").over(w), F.lit(0)).alias("_off"))
    return (parted.join(F.broadcast(offs), "part_id")
            .withColumn("merged_id", F.col("_off") + F.col("part_pos")).drop("_off"))


def file_key(file_path_col: str, root: str) -> F.Column:
    """R4 (Q16 fixed): output key of a file = its path relative to the
    corpus root without the ``.jsonl`` suffix, so equal base names in two
    folders do not collide."""
    root = root.rstrip("/")
    rel = F.regexp_replace(F.col(file_path_col), r"^.*?" + _re_escape(root) + "/", "")
    return F.regexp_replace(rel, r"(?i)\.jsonl$", "")


def _re_escape(s: str) -> str:
    import re
    return re.escape(s)
