import hashlib
import random
import zlib

import numpy as np
import pytest
from helpers import SF, awkward, docs

from corpusloom.llm import merkle as M
from corpusloom.llm.common import read_table
from corpusloom.llm.queries import op13_merkle_manifest


def sha(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def slow_manifest(rows):
    """The contract over (doc_id, source, lang, n_chars, text), with whole lists in memory."""
    def part(v):
        return "-" if v is None else f"{len(str(v).encode())}:{v}"

    def tree(nodes):
        levels = [nodes]
        while len(levels[-1]) > 1:
            levels.append([sha(*levels[-1][i:i + 8]) for i in range(0, len(levels[-1]), 8)])
        return levels

    def leaf(r, text):
        return sha(*map(part, (*r[:4], text)))
    langs = {}
    for r in rows:
        langs.setdefault(r[2], []).append(r)
    order = sorted(langs, key=lambda x: (x is not None, (x or "").encode()))
    trees = {}
    for lang in order:
        own = sorted(langs[lang], key=lambda r: (r[0] is not None, r[0] or 0, leaf(r, r[4])))
        trees[lang] = own, tree([leaf(r, r[4]) for r in own])
    top = tree([trees[lang][1][-1][0] for lang in order])
    root, out = top[-1][0] if top[-1] else None, []
    for k, lang in enumerate(order):
        own, levels = trees[lang]
        for i, r in enumerate(own):
            text = r[4]
            if text is not None and r[0] is not None and zlib.crc32(str(r[0]).encode()) % 3 == 0:
                text = "".join(c.lower() if "A" <= c <= "Z" else c for c in text)
            now, proof = leaf(r, text), []
            for rising, at in ((levels, i), (top, k)):
                for level in rising[:-1]:
                    lo = at // 8 * 8
                    proof += [x for j, x in enumerate(level[lo:lo + 8], lo) if j != at]
                    now = sha(*[now if j == at else x for j, x in enumerate(level[lo:lo + 8], lo)])
                    at //= 8
            out.append((r[0], levels[0][i], levels[-1][0], root, sha(*proof), now, now == root))
    return out


def ordered(rows):
    return sorted(map(tuple, rows), key=lambda r: tuple((x is None, str(x)) for x in r))


FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def test_states_are_sha256():
    r = np.random.default_rng(0)
    digests = r.integers(0, 1 << 32, (5, 8, 3), dtype=np.uint64).astype(np.uint32)
    state = M.start(3)
    for k in range(5):
        state = M.compress(state, M.hex_block(digests[k]))
    got = M.to_binary(M.finish(state, np.full(3, 5))).to_pylist()
    for i in range(3):
        text = "".join(f"{w:08x}" for k in range(5) for w in digests[k, :, i])
        assert got[i].hex() == hashlib.sha256(text.encode()).hexdigest()
    assert M.to_binary(M.finish(M.start(1), np.zeros(1))).to_pylist()[0].hex() == hashlib.sha256(b"").hexdigest()


def test_fold_resumes_the_kept_state():
    """A fold reads the copy before its slot and what lies to the right: spoiled digests on the left change nothing."""
    r = np.random.default_rng(1)
    nodes = r.integers(0, 1 << 32, (8, 6), dtype=np.uint64).astype(np.uint32)
    top, kept, kids, size = M.raise_run(nodes)
    for slot in range(6):
        spoiled = kids.copy()
        spoiled[:slot] = 7
        one = np.array([slot])
        assert (M.fold(kids[slot], one, size, kept[slot], spoiled) == top).all()
        assert not (M.fold(kids[slot] + np.uint32(1), one, size, kept[slot], kids) == top).all()


def test_paths_survive_packing():
    r = np.random.default_rng(2)
    nodes = r.integers(0, 1 << 32, (8, 70), dtype=np.uint64).astype(np.uint32)
    _, places = M.build(nodes, 3)
    raw = np.frombuffer(b"".join(M.pack_path(places, 70)), dtype=np.uint8).reshape(70, -1)
    for k, place in enumerate(places):
        for a, b in zip(place, M.unpack_place(raw[:, k * M.PLACE:(k + 1) * M.PLACE])):
            assert (np.asarray(a) == b).all()


def test_query_on_the_table(spark):
    rows = [tuple(r) for r in read_table(spark, SF, "documents").select(*FIELDS).collect()]
    assert ordered(op13_merkle_manifest(spark, SF).collect()) == ordered(slow_manifest(rows))


@pytest.mark.parametrize("levels", [1, 2])
def test_awkward_rows_over_many_groups(spark, monkeypatch, levels):
    """Small groups, so that the trees of one language and of the languages take several stages."""
    monkeypatch.setattr(M, "LEVELS", levels)
    monkeypatch.setattr(M, "SPAN", 8 ** levels)
    r = random.Random(3)
    rows = [(i, f"src{i}" if i and i % 5 else None, r.choice(["en"] * 30 + ["de", "", None, "Ünïcode", *map(str, range(30))]),
             None if r.random() < 0.1 else len(t or ""), t) for i, t in awkward() * 4 + [(1000 + k, f"Text {k}") for k in range(700)]]
    table = spark.createDataFrame([(*x, "clash", 0, 1) for x in rows],
                                  "doc_id long, source string, lang string, n_chars long, text string, key string, at int, total int")
    assert ordered(M.audited(table).collect()) == ordered(slow_manifest(rows))


def test_one_row_and_none(spark):
    one = docs(spark, [(9, "Only")])
    got = M.audited(one).collect()
    assert ordered(got) == ordered(slow_manifest([(9, "s", "en", 4, "Only")]))
    assert M.audited(one.limit(0)).count() == 0
    kept = M.manifest(docs(spark, awkward())).collect()
    assert len(kept) == len(awkward()) and all(x.verified for x in kept)
