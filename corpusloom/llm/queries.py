"""Registered queries of the subpackage: ``{name: (function, oracle SQL or None)}``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from corpusloom.llm import (
    html_extract,
    licenses,
    line_dedup,
    merkle,
    mixing,
    pieces,
    pitman_yor,
    pq_dedup,
    quality_model,
    quality_rules,
    simhash,
    suffix_dedup,
    turn_repair,
)
from corpusloom.llm.common import read_table


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.score_quality(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    return line_dedup.dedup_lines(docs, counts=True).select("doc_id", "text", "n_lines", "n_removed_lines")


def piece_model_path() -> str:
    import public_tokenizers
    return public_tokenizers.path("piece_bpe_32k.model")


def op3_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces.digests(read_table(spark, sf_dir, "documents"), piece_model_path())


def op4_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(read_table(spark, sf_dir, "documents"))


def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.document_rates(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


def op6_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.simhash_components(read_table(spark, sf_dir, "documents"))


def op7_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.digests(read_table(spark, sf_dir, "documents"))


def op8_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extract.extract(read_table(spark, sf_dir, "pages"))


def op9_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_model.score_documents(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


def op10_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pq_dedup.near_duplicates(read_table(spark, sf_dir, "embeddings"))


def op11_pitman_yor(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pitman_yor.score_documents(read_table(spark, sf_dir, "documents"))


def op12_turn_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return turn_repair.repair(turn_repair.damaged(read_table(spark, sf_dir, "conversations")))


def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.audited(read_table(spark, sf_dir, "documents"))


QUERIES = {
    "op1_quality_rules": (op1_quality_rules, None),
    "op2_line_dedup": (op2_line_dedup, line_dedup.ORACLE),
    "op3_sentencepiece": (op3_sentencepiece, None),
    "op4_license_scan": (op4_license_scan, licenses.oracle()),
    "op5_mixing": (op5_mixing, None),
    "op6_simhash": (op6_simhash, None),
    "op7_suffix_dedup": (op7_suffix_dedup, None),
    "op8_html_extraction": (op8_html_extraction, None),
    "op9_quality_classifier": (op9_quality_classifier, None),
    "op10_embedding_dedup": (op10_embedding_dedup, None),
    "op11_pitman_yor": (op11_pitman_yor, None),
    "op12_turn_repair": (op12_turn_repair, None),
    "op13_merkle_manifest": (op13_merkle_manifest, None),
}
