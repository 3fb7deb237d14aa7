"""Dictionary strategies for tokenizers with a word boundary.

``encode_by_dictionary`` keeps one dictionary per batch,
``encode_by_corpus_dictionary`` one for the corpus: every distinct piece is
encoded once, whatever tokenizer it is.

The pieces of a batch of documents arrive from the JVM's pre-tokenizer as one
Arrow list column. Arrow's dictionary encoding finds the distinct ones, each
is encoded once (and remembered by the tokenizer's bounded memo across
batches), and numpy gathers the ids back to the documents by index. The stage
is narrow: no piece crosses a shuffle or the driver, frequent pieces make no
hot key, rows with equal ids stay apart, and it is the same at every size.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusloom.functions.base import Tokenizer, list_offsets


def gather_lists(values: np.ndarray, offsets: np.ndarray, index: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Concatenation of the lists ``index`` of a ragged array, and its offsets."""
    size = np.diff(offsets)[index]
    end = np.concatenate(([0], np.cumsum(size)))
    at = np.arange(end[-1]) - np.repeat(end[:-1], size) + np.repeat(offsets[:-1][index], size)
    return values[at], end


def encode_by_dictionary(df: DataFrame, id_col: str, text_col: str, piece_encoder: Tokenizer,
                         pretokenize, append_eod: bool = False) -> DataFrame:
    """``(id, token_ids)`` for every row of ``df`` (empty text → ``[]``)."""
    from corpusloom.session import prepare_session
    prepare_session(df.sparkSession)
    eod = piece_encoder.eod if append_eod else None
    schema = T.StructType([df.schema[id_col], T.StructField("token_ids", T.ArrayType(T.IntegerType()), False)])

    def run(batches):
        for b in batches:
            pieces = b.column(1)
            doc = list_offsets(pieces).astype(np.int64)  # a null list has no pieces
            coded = pieces.flatten().dictionary_encode()
            ids = piece_encoder.encode_arrow(coded.dictionary)
            values, end = gather_lists(np.asarray(ids.flatten()), list_offsets(ids).astype(np.int64),
                                       np.asarray(coded.indices))
            bounds = end[doc]
            if eod is not None:
                full = np.diff(bounds) > 0
                values = np.insert(values, bounds[1:][full], eod)
                bounds = bounds + np.concatenate(([0], np.cumsum(full)))
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), pa.array(values.astype(np.int32)))],
                names=[id_col, "token_ids"])

    return df.select(id_col, pretokenize(F.col(text_col)).alias("_pieces")).mapInArrow(run, schema)


# Pieces that go with the tasks: a piece with 1 / HEAD of all occurrences is one of HEAD at most,
# and none of more than HEAD_BYTES is taken.
HEAD = 1 << 16
HEAD_BYTES = 64


def encode_by_corpus_dictionary(df: DataFrame, id_col: str, text_col: str, piece_encoder: Tokenizer,
                                pretokenize, append_eod: bool = False, head: int = HEAD) -> DataFrame:
    """``(id, token_ids)`` for every row of ``df``; each distinct piece of the
    corpus is encoded once.

    Pieces are counted (partial counts first) and the distinct ones encoded into
    a dictionary table. Its bounded head goes with the tasks, which replace those
    pieces on the spot and leave holes for the others; the holes of the tail are
    filled by a join on the piece, a row each, and go back to their rows. For
    tokenizers that cost more per piece than a shuffled row does; a cheap one is
    better off with ``encode_by_dictionary``.
    """
    from corpusloom.session import prepare_session, stored_table
    prepare_session(df.sparkSession)
    eod = piece_encoder.eod if append_eod else None

    def encode(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), piece_encoder.encode_arrow(b.column(0)).cast(pa.list_(pa.int32()))],
                                             names=["piece", "n", "ids"])
    known = stored_table(piece_counts(df, text_col, pretokenize).mapInArrow(encode, "piece string, n long, ids array<int>"))
    total = known.agg(F.sum("n")).first()[0] or 0
    often = {r["piece"]: np.array(r["ids"], dtype=np.int32) for r in
             known.where((F.col("n") * head >= total) & (F.octet_length("piece") <= HEAD_BYTES)).select("piece", "ids").collect()}
    shared = df.sparkSession.sparkContext.broadcast(often)

    def replace(batches):
        names = ["_row", id_col, "coded", "tail"]
        for b in batches:
            table = shared.value
            pieces = b.column(2)
            doc = list_offsets(pieces)
            coded = pieces.flatten().dictionary_encode()
            ids = [table.get(p) for p in coded.dictionary.to_pylist()]
            hole = np.array([x is None for x in ids], dtype=bool)
            flat = [x if x is not None else np.zeros(1, np.int32) for x in ids]
            sizes = np.concatenate(([0], np.cumsum([len(x) for x in flat]))).astype(np.int64)
            values = np.concatenate(flat) if flat else np.zeros(0, np.int32)
            index = np.asarray(coded.indices)
            out, end = gather_lists(values, sizes, index)
            at = np.nonzero(hole[index])[0]  # pieces of the tail, in order
            row = np.searchsorted(doc, at, side="right") - 1
            many = np.bincount(row, minlength=b.num_rows)
            first = np.cumsum(many) - many
            out[end[at]] = -1 - (np.arange(len(at)) - first[row])  # the number of the hole in its row
            tail = pc_take(coded, at)
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), pa.ListArray.from_arrays(pa.array(end[doc].astype(np.int32)), pa.array(out.astype(np.int32))),
                 pa.ListArray.from_arrays(pa.array(np.concatenate(([0], np.cumsum(many))).astype(np.int32)), tail)], names=names)
    id_type = df.schema[id_col].dataType
    rows = T.StructType([T.StructField("_row", T.LongType()), T.StructField(id_col, id_type),
                         T.StructField("coded", T.ArrayType(T.IntegerType())), T.StructField("tail", T.ArrayType(T.StringType()))])
    coded = stored_table(df.select(F.monotonically_increasing_id().alias("_row"), id_col, pretokenize(F.col(text_col)).alias("_pieces"))
                         .mapInArrow(replace, rows))
    holes = coded.select("_row", F.posexplode("tail").alias("k", "piece")).join(known.select("piece", "ids"), "piece")
    filled = holes.groupBy("_row").agg(F.sort_array(F.collect_list(F.struct("k", "ids"))).alias("found"))

    def fill(batches):
        for b in batches:
            out = []
            for ids, found in zip(b.column(1).to_pylist(), b.column(2).to_pylist()):
                if found:
                    parts = [f["ids"] for f in found]
                    ids = [x for i in ids for x in (parts[-1 - i] if i < 0 else (i,))]
                out.append(ids + [eod] if eod is not None and ids else ids)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(out, pa.list_(pa.int32()))], names=[id_col, "token_ids"])
    schema = T.StructType([df.schema[id_col], T.StructField("token_ids", T.ArrayType(T.IntegerType()), False)])
    return coded.select("_row", id_col, "coded").join(filled, "_row", "left").select(id_col, "coded", "found").mapInArrow(fill, schema)


def pc_take(coded: pa.DictionaryArray, at: np.ndarray) -> pa.Array:
    """Plain strings of a dictionary array at some places."""
    return coded.dictionary.take(pa.array(np.asarray(coded.indices)[at]))


def piece_counts(df: DataFrame, text_col: str, pretokenize) -> DataFrame:
    """Distinct pre-tokens with their frequency (the dictionary's size)."""
    return (df.select(F.explode(pretokenize(F.col(text_col))).alias("piece"))
            .groupBy("piece").agg(F.count(F.lit(1)).alias("n")))
