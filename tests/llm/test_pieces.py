import hashlib
import random

import pytest
import sentencepiece as sp
from helpers import awkward, docs

from corpusloom.llm import pieces as P
from corpusloom.llm.queries import piece_model_path


@pytest.fixture(scope="module")
def both():
    path = piece_model_path()
    with open(path, "rb") as f:
        return P.PieceModel(f.read()), sp.SentencePieceProcessor(model_file=path)


def texts():
    r = random.Random(2)
    alphabet = "ab é漢😀 ▁\n\t́ZÀ 　<s>,.!"
    return ([t or "" for _, t in awkward()] + ["", " ", "   ", "▁", "▁▁ ", "a" * 700, "漢字" * 300, "<s></s><0x41>", "🇩🇪👩‍👩‍👧"]
            + ["".join(r.choice(alphabet) for _ in range(r.randrange(0, 120))) for _ in range(400)])


def test_ids_and_text_equal_the_library(both):
    own, lib = both
    for t in texts():
        ids, begin, end = own.encode_spans(t)
        assert ids.tolist() == lib.encode(t)
        assert own.decode(ids.tolist()) == lib.decode(ids.tolist())
        data = t.encode("utf-8")
        if len(ids):  # spans cover the source without gaps
            assert begin[0] == 0 and end[-1] == len(data)
            assert (begin[1:] == end[:-1]).all() and (begin <= end).all()
        normalized, align = own.normalize(t)
        slow = own._ids(normalized)
        stop = own.width[slow].cumsum()
        assert end.tolist() == align[stop].tolist()


def test_decode_of_any_ids(both):
    own, lib = both
    r = random.Random(4)
    for _ in range(1500):
        ids = [r.choice([r.randrange(0, 300), r.randrange(32000)]) for _ in range(r.randrange(0, 10))]
        assert own.decode(ids) == lib.decode(ids)


@pytest.mark.parametrize("rule", ["nmt_nfkc", "nfkc_cf", "identity"])
def test_compiled_character_map(rule):
    lib = sp.SentencePieceNormalizer(rule_name=rule, add_dummy_prefix=True, remove_extra_whitespaces=True, escape_whitespaces=True)
    spec = dict(P._fields(dict(P._fields(lib.serialized_model_proto()))[3]))
    own = P.PieceModel.__new__(P.PieceModel)
    own.charmap = P.CharacterMap(spec.get(2, b""))
    own.dummy_prefix, own.squeeze, own.escape = bool(spec.get(3, 1)), bool(spec.get(4, 1)), bool(spec.get(5, 1))
    for t in texts() + ["ﬁ ｆｕｌｌ　width ①Ⅷ", "  ＡＢＣ  ", "㍿ ½"]:
        text, align = own.normalize(t)
        assert text == lib.normalize(t)
        assert len(align) == len(text.encode("utf-8")) + 1 and (align[1:] >= align[:-1]).all()


def test_short_and_long_merge_agree(both):
    own, _ = both
    r = random.Random(6)
    for _ in range(300):
        w = "".join(r.choice("abcdeinrst▁é") for _ in range(r.randrange(1, 60)))
        assert P._merge_short(w, own.score) == P._merge_long(w, own.score)


def test_memo_stays_bounded(monkeypatch):
    monkeypatch.setattr(P, "MEMO_WORDS", 3)
    memo = P._Memo(lambda w: (len(w),))
    for w in ["a", "bb", "ccc", "dddd", "a", "eeeee", "bb"] * 3:
        assert memo[w] == (len(w),)
        assert len(memo) <= 3 and len(memo.old) <= 3


def test_query(spark, both):
    _, lib = both
    rows = awkward()
    out = P.digests(docs(spark, rows), piece_model_path()).collect()
    want = []
    for i, t in rows:
        ids = lib.encode(t or "")
        want.append((i is None, i or 0, len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(),
                     hashlib.sha256(lib.decode(ids).encode()).hexdigest()))
    assert sorted((x.doc_id is None, x.doc_id or 0, x.n_tokens, x.ids_sha256, x.decoded_sha256) for x in out) == sorted(want)
    d = docs(spark, rows)
    enc = P.encode_documents(d, piece_model_path())
    assert set(d.columns) - {"text"} < set(enc.columns)
    with pytest.raises(ValueError):
        P.encode_documents(d.withColumnRenamed("h", "IDS"), piece_model_path())
    assert P.digests(d.limit(0), piece_model_path()).count() == 0
