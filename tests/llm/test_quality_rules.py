import re
from collections import Counter

import pytest
from helpers import awkward, docs

from corpusloom.llm import quality_rules as Q


def brute(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    windows = Counter(tuple(words[i:i + 5]) for i in range(len(words) - 4))
    mark = {j for i in range(len(words) - 4) if windows[tuple(words[i:i + 5])] > 1 for j in range(i, i + 5)}
    seen, dup = set(), 0
    for line in (text or "").split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            dup += line in seen
            seen.add(line)
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), dup, len(mark)


def test_measures_match_definition():
    texts = [t for _, t in awkward()] + ["a b c d e a b c d e", "a b c d e\n" * 3, "x\n\nx\n x\nx", "a\x1cb c # | <", "z " * 9]
    for t in texts:
        assert Q.measures(t)[:5] == brute(t), t


def test_binomial_tail_and_choice():
    assert Q.binomial_tail(0, 100, 0.05) == pytest.approx(0.95 ** 100)
    assert Q.binomial_tail(1, 10, 0.3) == pytest.approx(0.7 ** 10 + 10 * 0.3 * 0.7 ** 9)
    clean = [1000] + [0] * len(Q.GRID)
    bad = [0] * len(Q.GRID) + [50]
    assert Q.choose_cutoff(clean, bad, 0.01, 0.01) == Q.GRID[0]          # most lenient that separates
    assert Q.choose_cutoff([20] + [0] * len(Q.GRID), bad, 0.01, 0.01) is None  # too few labels to certify
    mixed = [900] + [0] * (len(Q.GRID) - 1) + [100]
    assert Q.choose_cutoff(mixed, bad, 0.01, 0.01) is None               # would lose a tenth of the good


def test_false_rejection_is_limited_in_simulation():
    import numpy as np
    rng = np.random.default_rng(1)
    alpha, level, broken = 0.02, 0.05, 0
    rates = np.linspace(0.3, 0.0, len(Q.GRID) + 1)[::-1]  # true share above the k strictest cutoffs
    for _ in range(200):
        values = rng.random(1500)
        bins = np.searchsorted(np.sort(1 - rates), values)
        good = np.bincount(np.minimum(bins, len(Q.GRID)), minlength=len(Q.GRID) + 1)
        bad = [0] * len(Q.GRID) + [100]
        cut = Q.choose_cutoff(good.tolist(), bad, alpha, level)
        if cut is not None:
            first = len(Q.GRID) - Q.GRID.index(cut)
            true = 1 - np.sort(1 - rates)[first - 1]
            broken += true > alpha
    assert broken <= 25


def test_query_rows_and_rules(spark):
    rows = awkward()
    good = [(1000 + i, " ".join(f"g{i} {j} word" for j in range(20))) for i in range(900)]
    junk = [(5000 + i, " ".join(f"j{i}{j}##$$%%" for j in range(20))) for i in range(60)]
    d = docs(spark, rows + good + junk)
    labels = spark.createDataFrame([(i, 1) for i, _ in good[:800]] + [(i, 0) for i, _ in junk[:50]] + [(None, 1), (77777, 0), (1, None)],
                                   "doc_id long, quality int")
    out = Q.score_quality(d, labels).collect()
    assert len(out) == len(rows) + len(good) + len(junk)
    assert all(r.kept for r in out if r.doc_id and 1000 <= r.doc_id < 5000)
    assert not any(r.kept for r in out if r.doc_id and r.doc_id >= 5000)
    for r in out:
        assert r.base_failed == (r.n_words < 10 or 100 * r.n_repeat_words > 20 * r.n_words)
        assert not (r.base_failed and r.kept)
    kept = Q.keep_good(d, labels)
    assert kept.columns == d.columns
    assert kept.count() == sum(r.kept for r in out)


def test_empty_tables(spark):
    none = docs(spark, []).limit(0)
    labels = spark.createDataFrame([], "doc_id long, quality int")
    assert Q.score_quality(none, labels).count() == 0
    d = docs(spark, [(1, "a b c d e f g h i j k #####"), (2, "x")])
    assert {r.doc_id: r.kept for r in Q.score_quality(d, labels).collect()} == {1: True, 2: False}
