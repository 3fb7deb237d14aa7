"""Vocabulary sources (S6-S8) as DataFrames.

A vocabulary is a dimension table (``vocab(id, token, n_bytes)``); the jobs
collect it once on the driver to build the tokenizer object that tasks
receive. Its size is the vocabulary size, checked against ``max_entries``
before it is collected.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.sources.corpus import _raw_scan, with_line_ids

MAX_VOCAB_ENTRIES = 4_000_000


def _text_lines(spark: SparkSession, path: str) -> DataFrame:
    raw = _raw_scan(spark.read, path, "text")
    return with_line_ids(raw).select("line_id", "value")


def load_rwkv_vocab(spark: SparkSession, path: str) -> DataFrame:
    """``id literal n_bytes`` lines → ``(id, token binary, n_bytes, ok)``;
    ``ok`` is false when the literal's byte length differs from ``n_bytes``."""
    from corpusloom.session import prepare_session
    prepare_session(spark)
    lines = _text_lines(spark, path).where(F.length(F.trim("value")) > 0)
    parts = lines.select(
        F.regexp_extract("value", r"^(\d+) ", 1).cast("int").alias("id"),
        F.regexp_extract("value", r"^\d+ (.*) \d+$", 1).alias("literal"),
        F.regexp_extract("value", r" (\d+)$", 1).cast("int").alias("n_bytes"))

    @F.pandas_udf("binary")
    def literal_bytes(lit: pd.Series) -> pd.Series:
        import ast

        def conv(s):
            v = ast.literal_eval(s)
            return v.encode("utf-8") if isinstance(v, str) else bytes(v)
        return lit.map(conv)

    v = parts.select("id", literal_bytes("literal").alias("token"), "n_bytes")
    return v.withColumn("ok", F.octet_length("token") == F.col("n_bytes"))


def vocab_checks(vocab: DataFrame) -> DataFrame:
    """S6 validity counts: entries, bad lengths, ids contiguous from 1."""
    return vocab.agg(F.count(F.lit(1)).alias("entries"),
                     F.count(F.when(~F.col("ok"), 1)).alias("bad_length"),
                     F.min("id").alias("min_id"), F.max("id").alias("max_id"),
                     F.countDistinct("id").alias("distinct_ids"))


def load_wordpiece_vocab(spark: SparkSession, path: str) -> DataFrame:
    """One token per line, id = line number, stripped; a later duplicate
    of a token wins (``max_by`` over the line number)."""
    from corpusloom.operators.text import PY_WS
    lines = _text_lines(spark, path)
    token = F.regexp_replace("value", f"^{PY_WS}+|{PY_WS}+$", "")
    return (lines.select(token.alias("token"), F.col("line_id").cast("int").alias("id"))
            .groupBy("token").agg(F.max("id").alias("id")))


def load_gpt2_vocab(spark: SparkSession, vocab_json: str, merges_txt: str) -> tuple[DataFrame, DataFrame]:
    """``vocab.json`` (one JSON object) → ``vocab(token, id)``;
    ``merges.txt`` → ``merges(left, right, rank)`` without the header line and
    without the empty piece after the final newline."""
    obj = spark.read.option("wholetext", "true").text(vocab_json)
    vocab = obj.select(F.explode(F.from_json("value", "map<string,int>")).alias("token", "id"))
    lines = _text_lines(spark, merges_txt)
    merges = (lines.where(F.col("line_id") > 0).where(F.col("value") != "")
              .select(F.split("value", " ").alias("p"), (F.col("line_id") - 1).cast("int").alias("rank"))
              .select(F.col("p")[0].alias("left"), F.col("p")[1].alias("right"), "rank"))
    return vocab, merges


def collect_bounded(df: DataFrame, max_entries: int = MAX_VOCAB_ENTRIES) -> list:
    """Collect a dimension table after checking its size."""
    rows = df.limit(max_entries + 1).collect()
    if len(rows) > max_entries:
        raise ValueError(f"dimension table has more than {max_entries} rows; not collected")
    return rows
