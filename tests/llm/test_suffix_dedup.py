import random

import numpy as np
import pytest
from helpers import awkward, docs

from corpusloom.llm import suffix_dedup as S
from corpusloom.llm.gsaca import suffix_array


def test_suffix_array():
    r = random.Random(3)
    for _ in range(1500):
        k = r.choice([1, 2, 3, 5, 30])
        t = [r.randrange(1, k + 1) for _ in range(r.randrange(0, 50))]
        if r.random() < 0.2:
            t = t * r.randrange(1, 5)
        assert suffix_array(t) == sorted(range(len(t)), key=lambda i: t[i:])


def test_anchors_are_found_in_every_window_and_across_blocks(monkeypatch):
    r = random.Random(1)
    data = bytes(r.choice(b"abcd ") for _ in range(5000)) * 2
    whole = [x.tolist() for x in S.anchors(data)]
    monkeypatch.setattr(S, "BLOCK", 700)
    assert [x.tolist() for x in S.anchors(data)] == whole
    pos = whole[0]
    assert pos[0] <= S.WINDOW - 1 and all(b - a <= S.WINDOW for a, b in zip(pos, pos[1:]))
    assert all(not len(x) for x in S.anchors(b"a" * (S.LENGTH - 1)))


def corpus(seed):
    r = random.Random(seed)
    piece = lambda n: "".join(r.choice("abcdefgh é") for _ in range(n))
    shared = [piece(r.choice([60, 99, 100, 101, 130, 240])) for _ in range(14)]
    rows = []
    for i in range(120):
        parts = []
        for _ in range(r.randrange(0, 7)):
            s = r.choice(shared)
            if r.random() < 0.3:
                a = r.randrange(len(s))
                s = s[a:a + r.randrange(1, 160)]
            parts += [s, piece(r.randrange(0, 40))]
        rows.append((i, "".join(parts)))
    rows += [(500, "z" * 350), (501, "ab" * 200), (502, rows[3][1]), (503, shared[0] * 3), (504, None), (505, "")]
    return rows


@pytest.mark.parametrize("most", [4096, 3, 1])
def test_against_definition(spark, monkeypatch, most):
    monkeypatch.setattr(S, "GROUP_ROWS", most)  # small: groups are dealt again, down to single windows
    rows = corpus(most)
    want = S.brute_force([(i, (t or "").encode()) for i, t in rows])
    out = S.digests(docs(spark, rows)).collect()
    assert {x.doc_id: (x.n_removed, x.n_spans, x.kept_sha256) for x in out} == want
    assert sum(x.n_removed for x in out) > 5000


def sides(r, n):
    """Rows of a few groups whose sides share prefixes of every length."""
    stems = [bytes(r.choice(b"ab") for _ in range(50)) for _ in range(3)]

    def one():
        x = bytearray(r.choice(stems))
        for _ in range(r.randrange(3)):
            x[r.randrange(50)] = r.choice(b"abc")
        return bytes(x[:r.choice([50, 50, r.randrange(51)])])
    return np.array([r.randrange(3) for _ in range(n)]), [one() for _ in range(n)], [one() for _ in range(n)]


def slow_windows(group, left, right, side):
    seen, out = set(), []
    for i in range(len(left)):
        for k in range(side + 1):
            if len(left[i]) >= k and len(right[i]) >= side - k:
                w = group[i], k, left[i][:k], right[i][:side - k]
                if w in seen:
                    out.append((i, k))
                seen.add(w)
    return out


@pytest.mark.parametrize("side", [50, 25, 12, 1])
def test_windows_of_a_group(side):
    r = random.Random(side)
    for _ in range(60):
        group, left, right = sides(r, r.randrange(1, 40))
        left, right = [x[:side] for x in left], [x[:side] for x in right]
        got = [(i, k) for i, a, b in S.covered_windows(group, left, right, side) for k in range(a, b + 1)]
        assert sorted(got) == slow_windows(group, left, right, side)


def test_the_suffix_array_decides(monkeypatch):
    """With another order of the suffixes the windows are not found."""
    r = random.Random(9)
    group, left, right = sides(r, 40)
    want = S.covered_windows(group, left, right, 50)
    monkeypatch.setattr(S, "suffix_array", lambda t: random.Random(1).sample(range(len(t)), len(t)))
    assert S.covered_windows(group, left, right, 50) != want


def test_deals_hold_every_window():
    """Every window of a row is in one of its deals, at every depth, under the bytes that all rows there share."""
    r = random.Random(4)
    left, right = (bytes(r.choice(b"abcdef") for _ in range(50)) for _ in range(2))
    rows, side = [(1, 0, 0, 5, 6, 200, left, right)], 50
    while side:
        rows = [y for x in rows for y in S._dealt(x, side)]
        side = S.halves(side)[1]
        have = {x[2] + k for x in rows for k in range(side + 1) if len(x[6]) >= k and len(x[7]) >= side - k}
        assert have == set(range(51))


def test_hot_anchor(spark, monkeypatch):
    """Thousands of places with one anchor and different surroundings, many of them alike on one side."""
    monkeypatch.setattr(S, "GROUP_ROWS", 40)
    r = random.Random(11)
    core = "".join(r.choice("klmnopqrst") for _ in range(60))
    ends = ["".join(r.choice("abc") for _ in range(45)) for _ in range(4)]
    rows = [(i, r.choice(ends)[r.randrange(45):] + core + r.choice(ends)[:r.randrange(45)]) for i in range(900)]
    want = S.brute_force([(i, t.encode()) for i, t in rows])
    out = S.digests(docs(spark, rows)).collect()
    assert {x.doc_id: (x.n_removed, x.n_spans, x.kept_sha256) for x in out} == want


def test_awkward_rows(spark):
    rows = awkward()
    d = docs(spark, rows)
    out = S.digests(d).collect()
    assert len(out) == len(rows)
    twice = [x for x in out if x.doc_id == 8]  # repeated rows are one document, a copy of 7
    assert len(twice) == 2 and twice[0] == twice[1] and twice[0].n_removed == twice[0].n_bytes
    none = [x for x in out if x.doc_id is None]
    assert len(none) == 2 and none[0] == none[1] and none[0].n_removed == none[0].n_bytes  # null ids come last
    plain = [(i, t) for i, t in rows if i not in (None, 8, 12)]
    want = S.brute_force([(i, (t or "").encode()) for i, t in plain])
    got = S.digests(docs(spark, plain)).collect()
    assert {x.doc_id: (x.n_removed, x.n_spans, x.kept_sha256) for x in got} == want
    assert S.digests(d.limit(0)).count() == 0
