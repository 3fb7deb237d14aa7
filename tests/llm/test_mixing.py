import numpy as np
import pytest
from helpers import awkward, docs

from corpusloom.llm import mixing as M


def slow_rates(p, t, targets, rounds=4000):
    """Projected gradient with many small steps."""
    r = np.ones(len(t))
    m = (p * t[:, None]).T @ p
    w = np.linalg.pinv(m, rcond=1e-10, hermitian=True)
    for _ in range(rounds):
        miss = (p * (t * r)[:, None]).sum(0) - targets
        r = np.maximum(0, r - 0.5 * p @ (w @ miss))
    return r


@pytest.mark.parametrize("targets", [[500.0, 200.0, 100.0], [10.0, 900.0, 0.0], [0.0, 0.0, 0.0]])
def test_rates_reach_targets(spark, targets):
    rng = np.random.default_rng(3)
    p = rng.dirichlet([0.4, 0.3, 0.3], 80)
    t = rng.integers(0, 30, 80).astype(float)
    rows = [(i, int(t[i]), p[i].tolist()) for i in range(80)]
    out = M.fit_rates(spark.createDataFrame(rows, "doc_id long, n_tokens long, p array<double>"), np.array(targets), 400).collect()
    r = np.array([x.rate for x in sorted(out, key=lambda x: x.doc_id)])
    assert (r >= 0).all()
    got = (p * (t * r)[:, None]).sum(0)
    slow = slow_rates(p, t, np.array(targets))
    miss = lambda v: ((v - targets) ** 2).sum()
    assert miss(got) <= miss((p * (t * slow)[:, None]).sum(0)) + 1e-3 * max(1, sum(targets))


def labelled(n=60):
    rows, labels = [], []
    for i in range(n):
        kind = i % 3
        words = [f"w{i % 7}", f"v{i}", "common", ["plain", "##$$", "nasty"][kind]] * 5
        rows.append((100 + i, " ".join(words)))
        labels.append((100 + i, 0 if kind == 1 else 1, 1 if kind == 2 else 0))
    return rows, labels


def test_query(spark):
    rows, labels = labelled()
    lab = spark.createDataFrame(labels + [(None, 1, 0), (999, 1, None), (998, 0, 1)], "doc_id long, quality int, toxic int")
    every = awkward() + rows
    out = M.document_rates(docs(spark, every), lab).collect()
    assert len(out) == len(every)
    p = np.array([[x.p_clean, x.p_junk, x.p_toxic] for x in out])
    t = np.array([x.n_tokens for x in out])
    r = np.array([x.rate for x in out])
    assert np.allclose(p.sum(1), 1) and (r >= 0).all()
    share = (p * (t * r)[:, None]).sum(0) / t.sum()
    assert np.allclose(share, [M.SHARES[d] for d in M.DOMAINS], atol=1e-6)
    by = {x.doc_id: x for x in out}
    assert by[100].p_clean > 0.8 and by[101].p_junk > 0.8 and by[102].p_toxic > 0.8
    again = [x for x in out if x.doc_id == 8]
    assert len(again) == 2 and again[0].rate == pytest.approx(again[1].rate)


def test_copies_follow_rates(spark):
    rows, labels = labelled(90)
    lab = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    d = docs(spark, rows)
    out = M.apply_rates(d, lab, factors={"clean": 2.0, "junk": 0.0, "toxic": 1.0})
    assert out.columns == d.columns
    n = {x.doc_id: x["count"] for x in out.groupBy("doc_id").count().collect()}
    assert all(n.get(100 + i, 0) in (1, 2, 3) for i in range(0, 90, 3))
    assert sum(n.get(100 + i, 0) for i in range(1, 90, 3)) <= 3


def test_empty(spark):
    lab = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    d = docs(spark, awkward())
    assert M.document_rates(d.limit(0), lab).count() == 0
    out = M.document_rates(d, lab).collect()
    assert len(out) == len(awkward()) and all(abs(x.p_clean - 1 / 3) < 1e-9 for x in out)
    assert M.apply_rates(d, lab, factors=dict.fromkeys(M.DOMAINS, 1.0)).count() == len(awkward())


def test_labels_of_missing_documents_do_not_count(spark):
    rows, labels = labelled()
    rows = [x for x, y in zip(rows, labels) if y[1]]  # every labelled junk document is gone
    lab = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    out = {x.doc_id: x for x in M.document_rates(docs(spark, rows), lab).collect()}
    assert all(x.p_junk == 0 for x in out.values())
    assert out[100].p_clean > 0.8 and out[102].p_toxic > 0.8
    t = sum(x.n_tokens for x in out.values())
    assert sum(x.rate * x.n_tokens * x.p_clean for x in out.values()) == pytest.approx(0.9 * t, rel=1e-6)


def test_sample_is_taken_from_rows_that_are_there(spark):
    rows, labels = labelled()
    gone = [(10000 + i, 0, 0) for i in range(500)]
    lab = M.label_domain(spark.createDataFrame(labels + gone, "doc_id long, quality int, toxic int"))
    d = docs(spark, rows + rows[:1])
    _, weights = M.fit_classifier(d, lab, per_domain=5)
    _, without = M.fit_classifier(d, lab.where("doc_id < 10000"), per_domain=5)
    assert weights == without
    assert np.allclose(np.exp(weights[""]), [21 / 61, 20 / 61, 20 / 61])


def test_rates_that_have_not_converged_raise(spark):
    rng = np.random.default_rng(3)
    rows = [(i, 1 + i % 30, x.tolist()) for i, x in enumerate(rng.dirichlet([0.4, 0.3, 0.3], 80))]
    members = spark.createDataFrame(rows, "doc_id long, n_tokens long, p array<double>")
    with pytest.raises(RuntimeError, match="not converged"):
        M.fit_rates(members, np.array([10.0, 900.0, 0.0]), 4)


def test_held_out_posteriors(spark):
    """Every domain is told by 300 words of its own, of which a text has six."""
    r = np.random.default_rng(7)
    rows, labels = [], []
    for i in range(900):
        kind = i % 3
        words = [f"{'abc'[kind]}{k}" for k in r.integers(0, 300, 6)] + [f"w{k}" for k in r.integers(0, 40, 14)]
        rows.append((i, " ".join(words)))
        labels.append((i, 0 if kind == 1 else 1, 1 if kind == 2 else 0))
    lab = spark.createDataFrame([x for x in labels if x[0] < 600], "doc_id long, quality int, toxic int")
    out = [x for x in M.document_rates(docs(spark, rows), lab).collect() if x.doc_id >= 600]
    for kind, d in enumerate(M.DOMAINS):
        assert np.mean([x[f"p_{d}"] for x in out if x.doc_id % 3 == kind]) > 0.95, d
