"""Any tokenizer as SQL functions.

``register_tokenizer(spark, tok, "bytes")`` registers ``bytes_tokenize(text)``
→ ``array<int>`` and ``bytes_detokenize(ids)`` → ``string`` as Arrow UDFs:
batches of rows cross to Python as Arrow arrays, never row by row.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from corpusloom.functions.base import Tokenizer


def tokenize_udf(tok: Tokenizer):
    id_type = "array<bigint>" if tok.id_type == pa.int64() else "array<int>"

    @F.arrow_udf(id_type)
    def tokenize(texts: pa.Array) -> pa.Array:
        return tok.encode_arrow(texts)

    return tokenize


def detokenize_udf(tok: Tokenizer):
    @F.arrow_udf("string")
    def detokenize(ids: pa.Array) -> pa.Array:
        return tok.decode_arrow(ids)

    return detokenize


def register_tokenizer(spark: SparkSession, tok: Tokenizer, name: str) -> None:
    from corpusloom.session import prepare_session
    prepare_session(spark)
    spark.udf.register(f"{name}_tokenize", tokenize_udf(tok))
    spark.udf.register(f"{name}_detokenize", detokenize_udf(tok))
