"""Vocabularies the registered queries derive from ``documents`` with Spark
(no vocabulary ships with the reference). Each is a top-k report over the
corpus, so only k rows reach the driver, which writes the file in the
format the matching loader reads. Words and pieces are counted first; their
parts are taken once per distinct one, with its count.
"""

from __future__ import annotations

import json
import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.functions.base import encode_column
from corpusloom.functions.bpe import byte_symbols
from corpusloom.functions.byte_level import ByteTokenizer
from corpusloom.functions.dictionary import piece_counts
from corpusloom.functions.trie import format_vocab_line
from corpusloom.functions.wordpiece import SPECIAL_TOKENS
from corpusloom.operators import text
from corpusloom.session import scratch_dir, stored_table


def rwkv_vocab_file(spark: SparkSession, docs: DataFrame, k: int = 300) -> str:
    """256 single bytes (ids 1..256) then the ``k`` most frequent character
    bigrams and trigrams inside words, ordered by count then n-gram."""
    words = (docs.select(F.explode(text.whitespace_tokenize(F.col("text"))).alias("w"))
             .groupBy("w").agg(F.count(F.lit(1)).alias("n")))
    grams = words.select("n", F.explode(F.flatten(F.array(*[
        F.when(F.length("w") >= n, F.transform(F.sequence(F.lit(1), F.length("w") - n + 1),
                                                lambda i: F.substring("w", i, n)))
         .otherwise(F.array().cast("array<string>")) for n in (2, 3)]))).alias("g"))
    top = (grams.groupBy("g").agg(F.sum("n").alias("n"))
           .orderBy(F.desc("n"), "g").limit(k).collect())
    lines = [format_vocab_line(b + 1, bytes([b])) for b in range(256)]
    lines += [format_vocab_line(257 + i, r.g.encode("utf-8")) for i, r in enumerate(top)]
    path = os.path.join(scratch_dir(spark, "rwkv-vocab"), "vocab.txt")
    with open(path, "w", encoding="utf-8") as f:
        f.write("\n".join(lines) + "\n")
    return path


def wordpiece_vocab_file(spark: SparkSession, docs: DataFrame, k: int = 5000) -> str:
    """Specials, the ``k`` most frequent basic tokens, every character that
    occurs and its ``##`` form (so no word maps to ``[UNK]`` unless it is
    longer than the word limit)."""
    from corpusloom.functions.wordpiece import basic_words
    cleaned = docs.select(F.explode(text.whitespace_tokenize(text.clean_text_for_wordpiece(F.col("text")))).alias("w"))
    distinct_words = cleaned.groupBy("w").agg(F.count(F.lit(1)).alias("n"))

    @F.pandas_udf("array<string>")
    def basic(ws):
        return ws.map(lambda w: basic_words(w))

    toks = stored_table(distinct_words.select(F.explode(basic("w")).alias("t"), "n")
                        .groupBy("t").agg(F.sum("n").alias("n")))
    top = [r.t for r in toks.orderBy(F.desc("n"), "t").limit(k).collect()]
    chars = [r.c for r in toks.select(F.explode(F.split("t", "")).alias("c")).where(F.col("c") != "")
             .distinct().orderBy("c").collect()]
    vocab = list(SPECIAL_TOKENS)
    seen = set(vocab)
    for t in top + chars + ["##" + c for c in chars]:
        if t not in seen:
            seen.add(t)
            vocab.append(t)
    path = os.path.join(scratch_dir(spark, "wordpiece-vocab"), "vocab.txt")
    with open(path, "w", encoding="utf-8") as f:
        f.write("\n".join(vocab) + "\n")
    return path


def bpe_files(spark: SparkSession, docs: DataFrame, k: int = 500) -> tuple[str, str]:
    """Byte-level BPE: the 256 byte symbols (ids by byte value), then the
    ``k`` most frequent adjacent byte pairs inside GPT-2 pieces as merges
    (rank = frequency order) with their merged symbols, then
    ``<|endoftext|>``."""
    pieces = piece_counts(docs, "text", text.pretokenize_gpt2)
    ids = encode_column(pieces, ByteTokenizer(eod=None, offset=0), "piece", "b")
    pairs = ids.where(F.size("b") > 1).select("n", F.explode(F.transform(
        F.sequence(F.lit(1), F.size("b") - 1), lambda i: F.struct(F.element_at("b", i).alias("l"),
                                                                  F.element_at("b", i + 1).alias("r")))).alias("p"))
    top = (pairs.groupBy(F.col("p.l").alias("l"), F.col("p.r").alias("r")).agg(F.sum("n").alias("n"))
           .orderBy(F.desc("n"), "l", "r").limit(k).collect())
    sym = byte_symbols()
    encoder = {sym[b]: b for b in range(256)}
    merges = []
    for r in top:
        a, b = sym[r.l], sym[r.r]
        merges.append((a, b))
        encoder.setdefault(a + b, len(encoder))
    encoder["<|endoftext|>"] = len(encoder)
    d = scratch_dir(spark, "bpe-vocab")
    vj, mt = os.path.join(d, "vocab.json"), os.path.join(d, "merges.txt")
    with open(vj, "w", encoding="utf-8") as f:
        json.dump(encoder, f, ensure_ascii=False)
    with open(mt, "w", encoding="utf-8") as f:
        f.write("#version: 0.2\n" + "".join(f"{a} {b}\n" for a, b in merges))
    return vj, mt


def hf_tokenizer_file(spark: SparkSession, vocab_json: str, merges_txt: str) -> str:
    """``tokenizer.json`` for the same byte-level BPE, built with the
    installed ``tokenizers`` package."""
    from tokenizers import Tokenizer, decoders, models, pre_tokenizers
    with open(vocab_json, encoding="utf-8") as f:
        vocab = json.load(f)
    with open(merges_txt, encoding="utf-8") as f:
        merges = [tuple(ln.split()) for ln in f.read().split("\n")[1:-1]]
    tok = Tokenizer(models.BPE(vocab=vocab, merges=merges))
    tok.pre_tokenizer = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=True)
    tok.decoder = decoders.ByteLevel()
    path = os.path.join(scratch_dir(spark, "hf-tokenizer"), "tokenizer.json")
    tok.save(path)
    return path


def sentencepiece_model(spark: SparkSession, docs: DataFrame, k: int = 5000, vocab_size: int = 1000) -> str:
    """A byte-fallback BPE SentencePiece model trained (with the installed
    ``sentencepiece`` package) on the ``k`` most frequent words of the corpus,
    fifty per line so word boundaries are seen."""
    import sentencepiece as spm
    words = docs.select(F.explode(text.whitespace_tokenize(F.col("text"))).alias("w"))
    top = [r.w for r in words.groupBy("w").agg(F.count(F.lit(1)).alias("n"))
           .orderBy(F.desc("n"), "w").limit(k).collect()]
    lines = [" ".join(top[i:i + 50]) for i in range(0, len(top), 50)]
    prefix = os.path.join(scratch_dir(spark, "sentencepiece"), "model")
    spm.SentencePieceTrainer.train(
        sentence_iterator=iter(lines), model_prefix=prefix, vocab_size=vocab_size, model_type="bpe",
        byte_fallback=True, normalization_rule_name="identity", add_dummy_prefix=False,
        remove_extra_whitespaces=False, character_coverage=1.0, hard_vocab_limit=False, minloglevel=2)
    return prefix + ".model"
