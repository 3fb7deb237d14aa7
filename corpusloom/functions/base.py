"""Tokenizer protocol and the document encoder.

A tokenizer maps an Arrow array of strings to an Arrow list array of ids.
``encode_documents`` runs it with ``mapInArrow`` over a column of sentence
lists and assembles, per document, the flat ``token_ids`` and the
``sentence_lens``: sentences that encode to nothing are dropped, and the
end-of-document id is appended to non-empty documents only (its length is
added to the last sentence). All per-document assembly is numpy on Arrow
buffers; only the tokenizer itself may loop in Python.
"""

from __future__ import annotations

from array import array
from typing import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from corpusloom.session import prepare_session


def list_offsets(arr: pa.Array) -> np.ndarray:
    """Offsets of a (large) list / string / binary array, re-based to 0."""
    offs = np.asarray(arr.offsets)
    return offs - offs[0] if len(offs) else np.zeros(1, dtype=np.int64)


def strings_to_bytes(arr: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Zero-copy view of a string array as (offsets int64, uint8 data)."""
    if pa.types.is_large_string(arr.type):
        b = arr.cast(pa.large_binary())
        odt = np.int64
    else:
        b = arr.cast(pa.binary())
        odt = np.int32
    if b.null_count:
        b = pc.fill_null(b, b"")
    bufs = b.buffers()
    offs = np.frombuffer(bufs[1], dtype=odt)[b.offset:b.offset + len(b) + 1].astype(np.int64)
    data = (np.frombuffer(bufs[2], dtype=np.uint8) if bufs[2] is not None
            else np.zeros(0, dtype=np.uint8))
    lo = offs[0] if len(offs) else 0
    hi = offs[-1] if len(offs) else 0
    return offs - lo, data[lo:hi]


# Bytes of texts or ids that a worker turns into ids or texts at a time, at most (unless one row is longer).
PIECE_BYTES = 4 << 20


def _row_edges(arr: pa.Array) -> np.ndarray:
    """Bytes of a string, string list or number list column up to each row's start, then all."""
    if pa.types.is_string(arr.type) or pa.types.is_large_string(arr.type):
        return strings_to_bytes(arr)[0]
    offs = np.asarray(arr.offsets, dtype=np.int64)
    if pa.types.is_primitive(arr.type.value_type):
        return offs * (arr.type.value_type.bit_width // 8)
    return strings_to_bytes(arr.values)[0][offs]


def bounded_pieces(b: pa.RecordBatch, column: str, size: int | None = None) -> Iterator[pa.RecordBatch]:
    """The batch's rows in runs of at most ``size`` bytes of ``column``, or one row."""
    size, edges, lo = size or PIECE_BYTES, _row_edges(b.column(column)), 0
    while lo < b.num_rows:
        hi = max(lo + 1, int(np.searchsorted(edges, edges[lo] + size, side="right")) - 1)
        yield b.slice(lo, hi - lo)
        lo = hi


class Memo(dict):
    """Bounded per-task memo ``key -> encode(key)`` in two generations: a full
    young generation becomes the old one, keys met again move back. Frequent
    keys stay and new keys can always be remembered; long keys, which hardly
    recur, are not."""

    def __init__(self, encode, size: int = 500_000, longest: int = 256):
        super().__init__()
        self.encode, self.size, self.longest, self.old = encode, size, longest, {}

    def __missing__(self, key):
        value = self.old[key] if key in self.old else self.encode(key)
        if len(key) > self.longest:
            return value
        if len(self) >= self.size:
            self.old = dict(self)
            self.clear()
        self[key] = value
        return value


def packed(ids: list[int]) -> bytes:
    """Ids as 32-bit numbers, one behind the other."""
    return array("i", ids).tobytes()


def unpacked_rows(rows: list[bytes]) -> pa.Array:
    """A list array from rows of packed ids."""
    offsets = np.concatenate(([0], np.cumsum([len(r) // 4 for r in rows], dtype=np.int64)))
    return pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(np.frombuffer(b"".join(rows), dtype=np.int32)))


def decode_pieces(pieces) -> str:
    """Text of a sequence of token bytes: pieces wait until, together, they are
    valid UTF-8 without U+FFFD; what never becomes valid is dropped, with
    everything after it."""
    import codecs
    whole = b"".join(pieces)
    try:
        text = whole.decode("utf-8")
        if "\ufffd" not in text:
            return text
    except UnicodeDecodeError:
        pass
    step = codecs.getincrementaldecoder("utf-8")("strict")
    out, waiting = [], ""
    for piece in pieces:
        try:
            waiting += step.decode(piece)
        except UnicodeDecodeError:
            break
        if "\ufffd" in waiting:
            break
        if not step.getstate()[0]:
            out.append(waiting)
            waiting = ""
    return "".join(out)


class Tokenizer:
    """Minimal tokenizer protocol used by the Spark jobs.

    Subclasses implement ``encode_batch``/``decode_batch`` on Python lists, or
    override the Arrow forms for vectorised paths.
    """

    name = "tokenizer"
    eod: int | None = None
    vocab_size: int = 0
    id_type = pa.int32()

    def encode_batch(self, texts: list[str]) -> list[list[int]]:
        raise NotImplementedError

    def decode_batch(self, ids: list[list[int]]) -> list[str]:
        raise NotImplementedError

    def encode_arrow(self, texts: pa.Array) -> pa.Array:
        vals = [t if t is not None else "" for t in texts.to_pylist()]
        return pa.array(self.encode_batch(vals), type=pa.list_(self.id_type))

    def decode_arrow(self, ids: pa.Array) -> pa.Array:
        vals = [x if x is not None else [] for x in ids.to_pylist()]
        return pa.array(self.decode_batch(vals), type=pa.string())

    # convenience for tests and drivers of small inputs
    def tokenize(self, text: str) -> list[int]:
        return self.encode_batch([text])[0]

    def detokenize(self, ids: list[int]) -> str:
        return self.decode_batch([list(ids)])[0]


def _assemble(sents: pa.Array, tok: Tokenizer, eod: int | None) -> tuple[pa.Array, pa.Array]:
    if sents.null_count:
        sents = pc.if_else(pc.is_null(sents), pa.scalar([], type=sents.type), sents)
    doc_offs = list_offsets(sents)
    flat = sents.flatten()
    ids = tok.encode_arrow(flat)
    ids_offs = list_offsets(ids)
    vals = np.asarray(ids.flatten(), dtype=np.int64 if tok.id_type == pa.int64() else np.int32)
    if len(vals) + len(sents) > 2 ** 31 - 1:
        raise ValueError("more than 2^31 tokens in one Arrow batch; lower spark.sql.execution.arrow.maxRecordsPerBatch")
    lens = np.diff(ids_offs)
    doc_tok = ids_offs[doc_offs]
    nonzero = lens > 0
    nz_cum = np.concatenate(([0], np.cumsum(nonzero)))
    doc_len_offs = nz_cum[doc_offs]
    lens_nz = lens[nonzero].astype(np.int32)
    if eod is not None and len(doc_offs) > 1:
        has = np.diff(doc_tok) > 0
        vals = np.insert(vals, doc_tok[1:][has], eod)
        doc_tok = doc_tok + np.concatenate(([0], np.cumsum(has)))
        lens_nz[doc_len_offs[1:][has] - 1] += 1
    token_ids = pa.ListArray.from_arrays(pa.array(doc_tok.astype(np.int32)), pa.array(vals))
    sentence_lens = pa.ListArray.from_arrays(pa.array(doc_len_offs.astype(np.int32)), pa.array(lens_nz))
    return token_ids, sentence_lens


def encode_documents(df: DataFrame, tokenizer: Tokenizer, sentences_col: str = "sentences",
                     keep: list[str] | None = None, append_eod: bool = True) -> DataFrame:
    """Encode a column of sentence lists into ``token_ids`` and ``sentence_lens``.

    Narrow (no shuffle): one ``mapInArrow`` stage, the tokenizer object is
    shipped once per task with the closure.
    """
    prepare_session(df.sparkSession)
    keep = [c for c in (keep if keep is not None else df.columns) if c != sentences_col]
    id_t = T.LongType() if tokenizer.id_type == pa.int64() else T.IntegerType()
    fields = [df.schema[c] for c in keep] + [
        T.StructField("token_ids", T.ArrayType(id_t, False), False),
        T.StructField("sentence_lens", T.ArrayType(T.IntegerType(), False), False),
    ]
    schema = T.StructType(fields)
    eod = tokenizer.eod if append_eod else None
    if append_eod and eod is None:
        raise ValueError(f"{tokenizer.name} has no end-of-document id")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in (p for whole in batches for p in bounded_pieces(whole, sentences_col)):
            ids, lens = _assemble(b.column(sentences_col), tokenizer, eod)
            cols = [b.column(c) for c in keep] + [ids, lens]
            yield pa.RecordBatch.from_arrays(cols, schema=_arrow_schema(schema))

    return df.select(*keep, sentences_col).mapInArrow(run, schema)


def _arrow_schema(schema: T.StructType) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema
    return to_arrow_schema(schema)


def decode_column(df: DataFrame, tokenizer: Tokenizer, ids_col: str = "token_ids",
                  out_col: str = "text", keep: list[str] | None = None) -> DataFrame:
    """Ids → text with ``mapInArrow``."""
    prepare_session(df.sparkSession)
    keep = [c for c in (keep if keep is not None else df.columns) if c != ids_col]
    schema = T.StructType([df.schema[c] for c in keep] + [T.StructField(out_col, T.StringType(), True)])

    def run(batches):
        for b in (p for whole in batches for p in bounded_pieces(whole, ids_col)):
            txt = tokenizer.decode_arrow(b.column(ids_col))
            yield pa.RecordBatch.from_arrays([b.column(c) for c in keep] + [txt],
                                             schema=_arrow_schema(schema))

    return df.select(*keep, ids_col).mapInArrow(run, schema)


def encode_column(df: DataFrame, tokenizer: Tokenizer, text_col: str = "text",
                  out_col: str = "token_ids", keep: list[str] | None = None) -> DataFrame:
    """Encode one string column to one id list column (no eod, no sentences)."""
    prepare_session(df.sparkSession)
    keep = [c for c in (keep if keep is not None else df.columns) if c != text_col]
    id_t = T.LongType() if tokenizer.id_type == pa.int64() else T.IntegerType()
    schema = T.StructType([df.schema[c] for c in keep]
                          + [T.StructField(out_col, T.ArrayType(id_t, False), False)])

    def run(batches):
        for b in (p for whole in batches for p in bounded_pieces(whole, text_col)):
            ids = tokenizer.encode_arrow(b.column(text_col))
            yield pa.RecordBatch.from_arrays([b.column(c) for c in keep] + [ids],
                                             schema=_arrow_schema(schema))

    return df.select(*keep, text_col).mapInArrow(run, schema)
