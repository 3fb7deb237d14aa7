"""Tokenizer functions (T1-T6, T9) and the Arrow batch helpers that apply them
inside Spark tasks (U1)."""

from corpusloom.functions.base import Tokenizer, encode_documents, decode_column
from corpusloom.functions.byte_level import ByteTokenizer
from corpusloom.functions.null import NullTokenizer

__all__ = ["Tokenizer", "ByteTokenizer", "NullTokenizer", "encode_documents", "decode_column"]
