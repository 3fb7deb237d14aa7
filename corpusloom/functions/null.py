"""Whitespace-integer tokenizer (T1): the text is ids separated by single
spaces; eod = vocab_size, reported size = vocab_size + 1.

The Spark job uses the native expression form (``null_encode_expr``); the
class serves the Arrow path and tests."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from corpusloom.functions.base import Tokenizer


class NullTokenizer(Tokenizer):
    name = "null"

    def __init__(self, vocab_size: int):
        self._base = int(vocab_size)
        self.eod = self._base
        self.vocab_size = self._base + 1

    def encode_batch(self, texts):
        return [[int(x) for x in t.split(" ")] if t else [] for t in texts]

    def decode_batch(self, ids):
        return [" ".join(str(x) for x in row) for row in ids]


def null_encode_expr(text: Column) -> Column:
    """JVM form: ``transform(split(text, ' '), x -> cast(x as int))``;
    the empty string gives no ids."""
    return F.when(text == "", F.array().cast("array<int>")).otherwise(
        F.transform(F.split(text, " "), lambda x: x.cast("int")))


def null_decode_expr(ids: Column) -> Column:
    return F.array_join(F.transform(ids, lambda x: x.cast("string")), " ")
