"""Ids against slow definitions, and the cost of long pieces."""

import random
import time

import pytest
from pyspark.sql import functions as F

from corpusloom.functions import dictionary as D
from corpusloom.functions.base import Tokenizer, encode_documents
from corpusloom.functions.bpe import Gpt2BpeTokenizer, PieceEncoder, byte_symbols
from corpusloom.functions.trie import TrieTokenizer
from corpusloom.operators import text


def slow_bpe(symbols, merges):
    word = list(symbols)
    ranks = {m: i for i, m in enumerate(merges)}
    while True:
        have = [ranks[p] for p in zip(word, word[1:]) if p in ranks]
        if not have:
            return word
        a, b = merges[min(have)]
        out, i = [], 0
        while i < len(word):
            if word[i:i + 2] == [a, b]:
                out.append(a + b)
                i += 2
            else:
                out.append(word[i])
                i += 1
        word = out


def merges_of(r, n, shuffled):
    symbols, out = list("abcd"), []
    while len(out) < n:
        m = r.choice(symbols), r.choice(symbols)
        if m not in out:
            out.append(m)
            symbols.append("".join(m))
    if shuffled:
        r.shuffle(out)  # lists in which a merge may come before the ones it is made of
    return out


@pytest.mark.parametrize("shuffled", [False, True])
def test_merges_against_the_definition(shuffled):
    r = random.Random(1 + shuffled)
    for _ in range(250):
        merges = merges_of(r, r.randrange(1, 25), shuffled)
        tok = Gpt2BpeTokenizer({}, merges)
        for _ in range(8):
            piece = "".join(r.choice("aaabcd") for _ in range(r.randrange(0, 60)))
            assert tok.bpe(piece) == slow_bpe(piece, merges), (merges, piece)


def test_a_long_unbroken_piece_takes_seconds():
    r = random.Random(2)
    merges = merges_of(r, 60, False)
    tok = Gpt2BpeTokenizer({}, merges)
    piece = "".join(r.choice("abcd") for _ in range(1_000_000))
    start = time.time()
    got = tok.bpe(piece)
    assert "".join(got) == piece and time.time() - start < 60


def test_automaton_equals_the_walk():
    r = random.Random(3)
    vocab = {bytes([b]): b + 1 for b in range(256)}
    while len(vocab) < 900:
        vocab.setdefault(bytes(r.choice(b"abc\xc3\xa9") for _ in range(r.randrange(2, 9))), len(vocab) + 1)
    tok = TrieTokenizer(vocab, eod=None)
    for _ in range(400):
        data = bytes(r.choice(b"abc\xc3\xa9\x00z") for _ in range(r.randrange(0, 200)))
        assert tok._encode_bytes(data) == tok._walk(data)
    part = TrieTokenizer({b"ab": 5, b"b": 6, b"abc": 7}, eod=None)  # not every byte is an entry
    assert part._encode_bytes(b"abcbab") == [7, 6, 5]
    for bad in (b"ca", b"bca", b"abx"):
        with pytest.raises(ValueError, match="not in the vocabulary"):
            part._encode_bytes(bad)


class Counting(Tokenizer):
    """Marks every piece that it encodes in an accumulator."""

    def __init__(self, inner, seen):
        self.inner, self.seen, self.eod = inner, seen, inner.eod

    def encode_arrow(self, pieces):
        self.seen.add(len(pieces))
        return self.inner.encode_arrow(pieces)


@pytest.mark.parametrize("head", [1 << 16, 3])
def test_each_piece_is_encoded_once_per_corpus(spark, head):
    sym = byte_symbols()
    enc = {sym[b]: b for b in range(256)} | {"th": 256, "the": 257, "<|endoftext|>": 258}
    tok = Gpt2BpeTokenizer(enc, [("t", "h"), ("th", "e")])
    r = random.Random(4)
    rows = [(i, " ".join(r.choice(["the", "then", "other", "été", f"w{r.randrange(300)}", "x" * 90]) for _ in range(r.randrange(60))))
            for i in range(200)] + [(7, "the same id"), (900, ""), (901, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(6)
    docs = docs.withColumn("text", F.coalesce("text", F.lit("")))
    seen = spark.sparkContext.accumulator(0)
    key = lambda x: (x[0], x[1])
    got = D.encode_by_corpus_dictionary(docs, "doc_id", "text", Counting(PieceEncoder(tok), seen), text.pretokenize_gpt2, append_eod=True, head=head)
    got = sorted(((x.doc_id, x.token_ids) for x in got.collect()), key=key)
    want = encode_documents(docs.select("doc_id", F.array("text").alias("sentences")), tok, keep=["doc_id"])
    assert got == sorted(((x.doc_id, x.token_ids) for x in want.collect()), key=key)
    assert seen.value == D.piece_counts(docs, "text", text.pretokenize_gpt2).count()
    none = D.encode_by_corpus_dictionary(docs.limit(0), "doc_id", "text", PieceEncoder(tok), text.pretokenize_gpt2)
    assert none.count() == 0
