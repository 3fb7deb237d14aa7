"""Training-data pipeline over ``documents``: five stages in a fixed order.

Each stage is a function ``(spark, docs, sf_dir) -> DataFrame`` that calls one
operator of ``corpusloom.llm``; its result is written as Parquet and read back
as the next stage's ``docs``. All but the last return the columns of
``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.llm import line_dedup, mixing, pieces, quality_rules, simhash
from corpusloom.llm.common import read_table, stored
from corpusloom.llm.queries import piece_model_path

REPEATED_WORDS = 50  # words of a repeated passage that goes whatever its number of lines
# Multiples of each domain's expected tokens that the mixture is to have.
MIX = {"clean": 1.02, "junk": 0.5, "toxic": 0.75}


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that fail the base rules or a certified cutoff go."""
    return quality_rules.keep_good(docs, read_table(spark, sf_dir, "labels"))


def line_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Later repeated runs of lines go; ``n_chars`` follows the text."""
    out = line_dedup.dedup_lines(docs, min_words=REPEATED_WORDS)
    return out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else out


def simhash_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group stays."""
    return simhash.keep_one(docs)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents are repeated or left out by their fitted rate."""
    return mixing.apply_rates(docs, read_table(spark, sf_dir, "labels"), factors=MIX)


def pieces_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Piece ids with their number, digest and the digest of the decoded text."""
    enc = pieces.encode_documents(docs.select("doc_id", "text"), piece_model_path())
    return enc.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), "ids", *pieces.digest_columns())


STAGES = [("quality_rules", quality_stage), ("line_dedup", line_stage), ("simhash", simhash_stage),
          ("mixing", mixing_stage), ("sentencepiece", pieces_stage)]

# Fitted rates and piece ids have no SQL form; the tests compare every stage with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for _, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir))
    return docs
