"""Corpus scan (S1), ordered line identity (S2) and Parquet input.

A corpus is a ``.jsonl`` file or a folder walked recursively. Files are taken
in sorted path order and lines in file order; every line gets a gap-free
global ``line_id`` without a global sort:

* ``monotonically_increasing_id()`` is taken directly on the scan, so rows of
  one file split carry consecutive ids;
* a small table with one row per split (min id, line count) gives each split
  its exclusive prefix sum in (path, block start) order;
* that table is written to the shared scratch folder and goes with the tasks:
  four numbers per input split under one 64-bit key, so the text itself is never
  exchanged. The number of splits is checked first; only beyond ``MOST_SPLITS``
  (half a petabyte of full splits) it is a shuffle join.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from corpusloom.session import scratch_dir

# Case-insensitive ``.jsonl`` suffix (fixed value of the corpus format).
JSONL_GLOB = "*.[jJ][sS][oO][nN][lL]"
# Input splits whose offsets go with the tasks (some 40 bytes each), at most.
MOST_SPLITS = 4_000_000


def _hadoop_fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    fs = hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return fs, hpath


def check_corpus_path(spark: SparkSession, path: str, check_hidden: bool = True) -> bool:
    """Validate a corpus path the way the reference's file discovery does.

    Raises ``FileNotFoundError`` for a missing path and ``ValueError`` for a
    single file without the ``.jsonl`` suffix (``.jsonl.gz`` included).
    Spark skips names starting with ``_`` or ``.``; the reference reads them,
    so we raise instead of silently dropping data. Returns True for folders.
    """
    fs, hpath = _hadoop_fs(spark, path)
    if not fs.exists(hpath):
        raise FileNotFoundError(f"input path does not exist: {path}")
    if not fs.getFileStatus(hpath).isDirectory():
        if not path.lower().endswith(".jsonl"):
            raise ValueError(f"input file must end with .jsonl: {path}")
        name = hpath.getName()
        if name.startswith((".", "_")):
            raise ValueError(f"hidden file names cannot be scanned by Spark: {path}")
        return False
    if check_hidden:
        # folder by folder would be a call or more per file: the file system is asked for
        # hidden names level by level; a hidden folder hides its files as well
        new = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
        level = _literal(fs.makeQualified(hpath).toString().rstrip("/"))
        while fs.globStatus(new(level + "/*")):
            for found in fs.globStatus(new(level + "/{.,_}*")) or ():
                for p in _file_paths(fs, found):
                    if p.lower().endswith(".jsonl"):
                        raise ValueError(f"hidden file names cannot be scanned by Spark: {p}")
            level += "/*"
    return True


def _literal(path: str) -> str:
    """A path whose characters mean themselves where patterns are read."""
    return re.sub(r"([\\*?\[\]{}^])", r"\\\1", path)


def _file_paths(fs, status) -> Iterator[str]:
    """The file itself, or all files below a folder."""
    if not status.isDirectory():
        yield status.getPath().toString()
        return
    it = fs.listFiles(status.getPath(), True)
    while it.hasNext():
        yield it.next().getPath().toString()


def listed_files(spark: SparkSession, path: str, names: str = "*") -> DataFrame:
    """``path, length, modificationTime`` of the files that Spark reads below a
    folder (or of the one file); nothing of their content is read."""
    return (spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", names)
            .load(_literal(path)).select("path", "length", "modificationTime"))


def _raw_scan(reader, path: str, fmt: str) -> DataFrame:
    df = reader.format(fmt).load(path)
    return df.select(
        "*",
        F.col("_metadata.file_path").alias("file_path"),
        F.col("_metadata.file_block_start").alias("_block"),
        # numbered directly on the scan: consecutive inside a split
        F.monotonically_increasing_id().alias("_mid"),
    )


def with_line_ids(raw: DataFrame) -> DataFrame:
    """Add ``file_rank``, ``line_no`` and a gap-free ``line_id`` to a scan
    that carries ``file_path``, ``_block`` and ``_mid`` (see ``_raw_scan``)."""
    splits = raw.groupBy("file_path", "_block").agg(
        F.min("_mid").alias("_mid0"), F.count(F.lit(1)).alias("_n"))
    # One row per input split; the un-partitioned window runs over that tiny table.
    w_all = Window.orderBy("file_path", "_block").rowsBetween(Window.unboundedPreceding, -1)
    w_file = (Window.partitionBy("file_path").orderBy("_block")
              .rowsBetween(Window.unboundedPreceding, -1))
    splits = splits.select(
        "file_path", "_block", "_mid0",
        F.coalesce(F.sum("_n").over(w_all), F.lit(0)).alias("_line0"),
        F.coalesce(F.sum("_n").over(w_file), F.lit(0)).alias("_fline0"),
        (F.dense_rank().over(Window.orderBy("file_path")) - 1).cast("int").alias("file_rank"),
    )
    # Written, not cached: a cache would be reused by a later identical-looking
    # plan after the files or the split size changed.
    spark = raw.sparkSession
    path = scratch_dir(spark, "splits")
    key = F.xxhash64("file_path", "_block").alias("_split")
    splits = splits.select(key, "file_path", "_block", "_mid0", "_line0", "_fline0", "file_rank")
    splits.write.mode("overwrite").parquet(path)
    splits = spark.read.schema(splits.schema).parquet(path)
    size = splits.agg(F.count(F.lit(1)).alias("n"), F.countDistinct("_split").alias("d")).first()
    if size["n"] == size["d"] and size["n"] <= MOST_SPLITS:
        j = raw.withColumn("_split", key).join(F.broadcast(splits.drop("file_path", "_block")), "_split")
    else:  # two splits share a key, or there are too many
        j = raw.join(splits.drop("_split"), ["file_path", "_block"])
    local = F.col("_mid") - F.col("_mid0")
    return j.select(
        *[c for c in raw.columns if c not in ("file_path", "_block", "_mid")],
        "file_path", "file_rank",
        (F.col("_fline0") + local).alias("line_no"),
        (F.col("_line0") + local).alias("line_id"),
        F.col("_line0").alias("split_line0"),
    )


def read_lines(spark: SparkSession, path: str, check: bool = True) -> DataFrame:
    """S1+S2: ``lines(file_path, file_rank, line_no, line_id, value)``.

    Lines are split on ``\\n``, ``\\r\\n`` and ``\\r`` (Python text mode);
    lines never cross files.
    """
    if check:
        check_corpus_path(spark, path)
    reader = (spark.read.option("recursiveFileLookup", "true")
              .option("pathGlobFilter", JSONL_GLOB))
    raw = _raw_scan(reader, path, "text")
    return with_line_ids(raw).select("file_path", "file_rank", "line_no", "line_id", "split_line0", "value")


def read_parquet_corpus(spark: SparkSession, path: str, columns: list[str] | None = None) -> DataFrame:
    """Parquet input; rows keep file order and get the same ``line_id``."""
    raw = _raw_scan(spark.read, path, "parquet")
    if columns:
        raw = raw.select(*columns, "file_path", "_block", "_mid")
    return with_line_ids(raw)


def line_count(lines: DataFrame) -> DataFrame:
    """A4: number of lines over all files (blank and bad lines count)."""
    return lines.agg(F.count(F.lit(1)).alias("n_lines"))
