"""Vocabulary tokenizers (T2 trie, T3 BPE, T4 WordPiece, T5/T6 adapters),
vocab literal parsing (S6), spec rules (U2)."""

import os

import pytest

from corpusloom.functions.bpe import Gpt2BpeTokenizer, byte_symbols
from corpusloom.functions.trie import TrieTokenizer, byte_vocab_lines, parse_vocab_line
from corpusloom.functions.wordpiece import WordPieceTokenizer
from corpusloom.spec import TokenizerSpec


def test_vocab_literals():
    assert parse_vocab_line("1 b'\\x00' 1") == (1, b"\x00", 1)
    assert parse_vocab_line("2 '<|endoftext|>' 13") == (2, b"<|endoftext|>", 13)
    with pytest.raises(ValueError):
        parse_vocab_line("3 'ab' 3")


def test_trie_longest_match_and_decode():
    lines = byte_vocab_lines() + ["257 'ab' 2", "258 'abc' 3"]
    t = TrieTokenizer.from_lines(lines)
    assert t.tokenize("abcab") == [258, 257]
    assert t.detokenize([258, 257, 0, 98]) == "abcab"
    assert t.detokenize([196]) == ""  # incomplete UTF-8 tail dropped


def test_byte_symbols_reversible():
    m = byte_symbols()
    assert len(set(m.values())) == 256 and m[ord("a")] == "a" and m[32] == chr(288)


def test_bpe_merges_and_unknown():
    sym = byte_symbols()
    enc = {sym[b]: b for b in range(256)}
    enc["ab"] = 256
    t = Gpt2BpeTokenizer(enc, [("a", "b")])
    assert t.tokenize("ab") == [256]
    assert t.detokenize(t.tokenize("ab cd é")) == "ab cd é"


def test_wordpiece_greedy():
    vocab = {w: i for i, w in enumerate(["[PAD]", "[UNK]", "un", "##aff", "##able", "hello", ",", "!"])}
    t = WordPieceTokenizer(vocab)
    assert t.tokenize("unaffable, Héllo!") == [2, 3, 4, 6, 5, 7]
    assert t.tokenize("xyz") == [1]


def test_spec_odd_kwargs_rejected():
    with pytest.raises(ValueError, match="pairs"):
        TokenizerSpec("hf", tokenizer_model="x", tokenizer_kwargs=["use_fast"]).build()


def test_sentencepiece_adapter(tmp_path):
    spm = pytest.importorskip("sentencepiece")
    import pyarrow.parquet as pq
    texts = pq.read_table("/root/testdata/sf0.001/benchmark.parquet").column("text").to_pylist()
    corpus = tmp_path / "c.txt"
    corpus.write_text("\n".join(texts), encoding="utf-8")
    spm.SentencePieceTrainer.train(input=str(corpus), model_prefix=str(tmp_path / "m"), vocab_size=400,
                                   model_type="bpe", byte_fallback=True, minloglevel=2)
    from corpusloom.functions.adapters import SentencePieceTokenizer
    t = SentencePieceTokenizer(str(tmp_path / "m.model"), variant="llama2")
    ids = t.tokenize("hello world")
    assert ids[0] == t.bos and t.detokenize(ids[1:]) == "hello world"
    glm = SentencePieceTokenizer(str(tmp_path / "m.model"), variant="chatglm", special_tokens=["[gMASK]", "sop"])
    assert glm.tokenize("hi")[:2] == [glm.special_ids["[gMASK]"], glm.special_ids["sop"]]


def test_wordpiece_bert_specials(tmp_path):
    v = tmp_path / "vocab.txt"
    v.write_text("\n".join(["[PAD]", "[UNK]", "[CLS]", "[SEP]", "[MASK]", "a", "b", "a"]) + "\n", encoding="utf-8")
    tok = TokenizerSpec("wordpiece", vocab_file=str(v), tokenizer_kwargs=["vocab_extra_ids", "2"]).build()
    assert tok.vocab["a"] == 7  # later duplicate wins
    # specials continue from the number of distinct tokens, as the reference's len(vocab)
    assert (tok.bos, tok.eos) == (7, 8) and tok.vocab["<extra_id_1>"] == 10


def test_trie_unknown_byte_names_it():
    t = TrieTokenizer.from_lines(["1 'a' 1"])
    with pytest.raises(ValueError, match="0x62"):
        t.tokenize("ab")


def test_decode_waits_for_valid_text():
    from corpusloom.functions.base import decode_pieces
    from corpusloom.functions.trie import TrieTokenizer
    assert decode_pieces([b"a", b"\xff", b"bcdefgh"]) == "a"
    assert decode_pieces([b"a", b"\xc3", b"\xa9", b"b"]) == "aéb"
    assert decode_pieces([b"ab", b"\xe2\x82"]) == "ab"
    assert decode_pieces([b"x", "\ufffd".encode(), b"y"]) == "x"
    assert decode_pieces([]) == ""

    def slow(pieces):  # the rule, token by token
        out, start = "", 0
        for i in range(len(pieces)):
            try:
                t = b"".join(pieces[start:i + 1]).decode("utf-8")
            except UnicodeDecodeError:
                continue
            if "\ufffd" not in t:
                out, start = out + t, i + 1
        return out
    import random
    r = random.Random(1)
    parts = [b"a", b"\xff", b"\xc3", b"\xa9", "é€".encode(), b"\xe2\x82", b"\xac", "\ufffd".encode(), b"zz"]
    for _ in range(3000):
        p = [r.choice(parts) for _ in range(r.randrange(0, 8))]
        assert decode_pieces(p) == slow(p)
    tok = TrieTokenizer({bytes([b]): b + 1 for b in range(256)})
    assert tok.decode_batch([[98, 256, 99], [98, 0, 99], []]) == ["a", "a", ""]


def test_memo_keeps_learning():
    from corpusloom.functions.base import Memo
    calls = []
    memo = Memo(lambda k: calls.append(k) or k * 2, size=2)
    assert [memo[k] for k in "abcdaabbcc"] == [k * 2 for k in "abcdaabbcc"]
    assert len(memo) <= 2 and len(memo.old) <= 2


def test_wordpiece_vocabulary_lines_are_stripped_of_all_white_space(spark, tmp):
    import os
    from corpusloom.functions.wordpiece import WordPieceTokenizer
    from corpusloom.sources.vocab import load_wordpiece_vocab
    path = os.path.join(tmp, "v.txt")
    lines = ["[UNK]", "\tab\t", "##c\u3000 ", " \x0bde ", "ab"]
    with open(path, "w", encoding="utf-8") as f:
        f.write("\n".join(lines) + "\n")
    got = {r.token: r.id for r in load_wordpiece_vocab(spark, path).collect()}
    assert got == WordPieceTokenizer.from_lines(lines).vocab == {"[UNK]": 0, "##c": 2, "de": 3, "ab": 4}
    assert WordPieceTokenizer(got).encode_batch(["abc ab-x de"]) == [[4, 2, 4, 0, 0, 3]]


def test_packed_rows_are_the_rows_of_the_plain_form():
    """Arrays of ids come from packed words; the plain form encodes text by text."""
    import pyarrow as pa
    from corpusloom.functions.bpe import Gpt2BpeTokenizer, byte_symbols
    from corpusloom.functions.trie import TrieTokenizer
    from corpusloom.functions.wordpiece import WordPieceTokenizer
    sym = byte_symbols()
    texts = ["", " ", "the  cat's hat\nthe cat ", None, "é漢😀 the", "a" * 300 + " " + "the" * 200, "x\u00a0the\tthe"]
    single = {bytes([b]): b + 1 for b in range(256)}
    toks = [Gpt2BpeTokenizer({**{sym[b]: b for b in range(256)}, "th": 256, "the": 257}, [("t", "h"), ("th", "e")]),
            TrieTokenizer({**single, b"the": 300, b"th": 301, b"\nt": 302}), TrieTokenizer({**single, b"the": 300, b"e c": 301}),
            WordPieceTokenizer({t: i for i, t in enumerate(["[PAD]", "[UNK]", "the", "cat", "##s", "c", "##the", "##a", "a"])})]
    for tok in toks:
        got = tok.encode_arrow(pa.array(texts, pa.string()))
        assert got.type.value_type == pa.int32() and got.to_pylist() == tok.encode_batch([t or "" for t in texts])
    assert [t._by_word for t in toks[1:3]] == [True, False]
    assert all(len(k) <= 256 for t in toks for k in t._packed)


def test_vocabularies_take_parts_of_distinct_words_only(spark, monkeypatch):
    """Byte pairs and n-grams are taken once per distinct piece, with its count."""
    from collections import Counter
    from corpusloom.functions.bpe import GPT2_PATTERN
    from corpusloom.plans import vocab_fixtures as V
    import regex
    rows, encode = [], V.encode_column
    monkeypatch.setattr(V, "encode_column", lambda df, *a, **k: rows.append(df.count()) or encode(df, *a, **k))
    df = spark.createDataFrame([("the cat the hat " * 50,), ("the the",), (None,), ("",)], "text string")
    _, merges = V.bpe_files(spark, df, 7)
    pieces = Counter(p for t in ("the cat the hat " * 50, "the the") for p in regex.findall(GPT2_PATTERN, t))
    pairs = Counter()
    for p, n in pieces.items():
        pairs.update({(a, b): 0 for a, b in zip(p.encode(), p.encode()[1:])})
        for a, b in zip(p.encode(), p.encode()[1:]):
            pairs[a, b] += n
    from corpusloom.functions.bpe import byte_symbols
    sym = byte_symbols()
    want = [f"{sym[a]} {sym[b]}" for (a, b), _ in sorted(pairs.items(), key=lambda x: (-x[1], x[0]))[:7]]
    assert open(merges, encoding="utf-8").read().split("\n")[1:-1] == want
    assert rows == [len(pieces)]  # not one per occurrence
