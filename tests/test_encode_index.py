"""Encoding (P7-P9, A1, T1, T2-byte, T9) and index offsets."""

import pyarrow as pa
from pyspark.sql import functions as F

from corpusloom.functions.base import Tokenizer, encode_documents
from corpusloom.functions.byte_level import ByteTokenizer
from corpusloom.functions.null import NullTokenizer
from corpusloom.operators import index


class LengthTokenizer(Tokenizer):
    """The reference's toy: a sentence encodes to [len(sentence)]; "" → []."""
    name = "length"
    eod = 7

    def encode_batch(self, texts):
        return [[len(t)] if t else [] for t in texts]


def test_golden_encode_list_value(spark):
    df = spark.createDataFrame([(0, ["ab", "c"]), (1, [""]), (2, []), (3, ["", "abc", ""])],
                               "doc_id long, sentences array<string>")
    got = {r.doc_id: (r.token_ids, r.sentence_lens)
           for r in encode_documents(df, LengthTokenizer(), keep=["doc_id"]).collect()}
    assert got[0] == ([2, 1, 7], [1, 2])
    assert got[1] == ([], [])
    assert got[2] == ([], [])
    assert got[3] == ([3, 7], [2])


def test_byte_tokenizer_roundtrip_and_ids():
    t = ByteTokenizer(eod=65532)
    ids = t.encode_arrow(pa.array(["aé", "", None]))
    assert ids.to_pylist() == [[98, 196, 170], [], []]
    assert t.decode_arrow(ids).to_pylist() == ["aé", "", ""]


def test_null_tokenizer():
    t = NullTokenizer(100)
    assert t.tokenize("1 2 30") == [1, 2, 30]
    assert t.detokenize([1, 2, 30]) == "1 2 30"
    assert (t.eod, t.vocab_size) == (100, 101)


def test_two_level_offsets_match_single_window(spark):
    df = spark.createDataFrame([(i, [1 + (i * 7) % 5 for _ in range(i % 4)]) for i in range(500)],
                               "line_id long, sentence_lens array<int>")
    seq = index.sequence_index(df, itemsize=2).orderBy("seq_id").collect()
    ptr, sid = 0, 0
    for r in seq:
        assert (r.seq_id, r.ptr) == (sid, ptr)
        ptr += r.length * 2
        sid += 1
    docs = index.document_index(df).orderBy("line_id").collect()
    n = 0
    for r in docs:
        assert r.seq_begin == n
        n += len([x for x in df.where(F.col("line_id") == r.line_id).first().sentence_lens])
        assert r.seq_end == n


def test_dtype_rules():
    assert index.optimal_dtype(65534) == "uint16"
    assert index.optimal_dtype(65535) == "int32"
    assert index.padded_vocab_size(50257, 128, 1) == 50304


def test_dictionary_strategy_equals_row_strategy(spark):
    from corpusloom.functions.dictionary import encode_by_dictionary
    from corpusloom.operators.text import whitespace_tokenize
    rows = [(0, "a bb a"), (1, ""), (2, "ccc  bb"), (3, "é a"), (3, "bb"), (4, None), (0, "a bb a")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    for eod in (None, 7):
        tok = ByteTokenizer(eod=eod)
        got = encode_by_dictionary(docs, "doc_id", "text", tok, whitespace_tokenize, append_eod=eod is not None).collect()
        want = []
        for i, t in rows:
            ids = [b + 1 for w in (t or "").split() for b in w.encode()]
            want.append((i, ids + [eod] if ids and eod is not None else ids))
        # rows that share an id stay apart
        assert sorted((r.doc_id, list(r.token_ids)) for r in got) == sorted(want)


def test_index_of_sparse_and_clustered_keys(spark):
    from corpusloom.operators import index
    keys = [i * 10 ** 12 for i in range(60)] + [7, 8, 9] + [10 ** 6 + i for i in range(40)]
    rows = [(k, [1 + (k + j) % 5 for j in range(k % 4)]) for k in keys]
    df = spark.createDataFrame(rows, "line_id long, sentence_lens array<int>")
    seq = index.sequence_index(df).orderBy("seq_id").collect()
    want, ptr = [], 0
    for k, lens in sorted(rows):
        for j, n in enumerate(lens):
            want.append((k, j, len(want), n, ptr))
            ptr += 2 * n
    assert [tuple(r) for r in seq] == want
    got = index.document_index(df).orderBy("line_id").collect()
    assert [r.seq_end - r.seq_begin for r in got] == [len(x) for _, x in sorted(rows)] and got[-1].seq_end == len(want)


class CountingTokenizer(Tokenizer):
    """The id of a text is the number of texts that came with it."""
    name = "counting"
    eod = 0

    def encode_batch(self, texts):
        return [[len(texts)] for _ in texts]


def test_workers_take_bounded_pieces_of_a_batch(spark):
    long = "x" * (1 << 20)
    df = spark.createDataFrame([(i, [long, long] if i % 2 else [long]) for i in range(20)], "doc_id long, sentences array<string>").coalesce(1)
    got = encode_documents(df, CountingTokenizer(), keep=["doc_id"], append_eod=False).collect()
    assert sorted(r.doc_id for r in got) == list(range(20))
    assert max(max(r.token_ids) for r in got) <= 4 and all(len(r.token_ids) == 1 + r.doc_id % 2 for r in got)


def test_pieces_hold_every_row_once():
    from corpusloom.functions.base import bounded_pieces
    cols = {"s": ["aé", None, "", "x" * 50, "y", "z" * 9], "l": [["a", "bb"], None, [], ["x" * 50], ["", None], ["z"]],
            "i": [[1, 2], None, [], list(range(50)), [3], [4]]}
    b = pa.RecordBatch.from_pydict(cols)
    for whole in (b, b.slice(1, 4), b.slice(2, 0)):
        for c in cols:
            parts = list(bounded_pieces(whole, c, 16))
            assert [r for p in parts for r in p.to_pylist()] == whole.to_pylist()
            if whole is b:
                assert len(parts) > 2
