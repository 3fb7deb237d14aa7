import re
import zlib

import numpy as np
from helpers import SF, awkward, docs

from corpusloom.llm import quality_model as M


def slow_features(text):
    """Feature by feature, with Python integers, from the description alone."""
    mask, base = (1 << 64) - 1, 0x9E3779B97F4A7C15
    mix = lambda h: (lambda x: x ^ (x >> 32))(((h ^ (h >> 31)) * 0xD6E8FEB86659FD93) & mask)
    out, before = [], None
    for word in re.findall(r"[^\x20\x09-\x0D]+", text or ""):
        h = mix(sum((ord(c) + 1) * base ** i for i, c in enumerate(word)) & mask)
        out.append(h % M.BUCKETS)
        if before is not None:
            out.append(mix((h - before) & mask) % M.BUCKETS + M.BUCKETS)
        before = h
        bordered = " " + word + " "
        for n in M.GRAMS:
            for i in range(len(bordered) - n + 1):
                g = n
                for c in bordered[i:i + n]:
                    g = (g * base + ord(c)) & mask
                out.append(mix(g) % M.BUCKETS + 2 * M.BUCKETS)
    return sorted(out)


def test_features_against_the_slow_form():
    for text in ("", None, " \n", "a", "ab  cd\tab", "wört 漢字😀 x", "a b c a b", "\u00a0x\u2003y z" * 20):
        assert sorted(M.features(text).tolist()) == slow_features(text)


def test_features_do_not_depend_on_blocks(monkeypatch):
    text = " ".join(f"wört{i} x" for i in range(900)) + "  " + "漢" * 2000 + "\n" * 900 + "end of it"
    whole = np.sort(M.features(text))
    for block in (1, 7, 400):
        monkeypatch.setattr(M, "BLOCK", block)
        M._powers.cache_clear()
        assert (whole == np.sort(M.features(text))).all()
    M._powers.cache_clear()


def test_steps_are_the_gradient():
    """One step against numerical differences of the loss."""
    at, n, y, rate = np.array([3, 70, M.BUCKETS + 5]), np.array([2, 1, 1]), 1, 1e-3
    start = M.train([])
    rng = np.random.default_rng(1)
    start.output[:] = rng.normal(0, 1, start.output.shape)

    def loss(vectors, output, bias):
        z = output @ (vectors.T @ (n / n.sum())) + bias
        return np.log(np.exp(z).sum()) - z[y]
    v, o, b = start.vectors[at].astype(float), start.output.astype(float), start.bias.astype(float)
    M.step(start, at, n, y, rate)
    for got, old, name in ((start.vectors[at], v, 0), (start.output, o, 1)):
        for i in np.ndindex(old.shape):
            parts = [v.copy(), o.copy(), b]
            parts[name][i] += 1e-5
            slope = (loss(*parts) - loss(v, o, b)) / 1e-5
            assert abs((old[i] - got[i]) / rate - slope) < 2e-3


def test_word_hash_is_position_free():
    first = set(M.features("alpha beta").tolist())
    assert set(M.features("alpha").tolist()) <= first | set(M.features("x alpha").tolist())
    a, b = M.features("he he he"), M.features("no no no")
    pair = lambda f: {x for x in f.tolist() if M.BUCKETS <= x < 2 * M.BUCKETS}
    assert pair(a) == pair(b) and len(pair(a)) == 1  # a repetition is one feature, whatever the word


def test_gradient_training_learns():
    rng = np.random.default_rng(0)
    rows = []
    for i in range(300):
        y = i % 2
        at = np.unique(rng.integers(0, 50, 12) + 50 * y * (rng.random(12) < 0.8))
        rows.append((y, at, np.ones(len(at))))
    m = M.train(rows)
    z = np.array([m.table()[r[1]].mean() + m.bias[1] - m.bias[0] for r in rows])
    assert ((z > 0) == np.array([r[0] for r in rows])).mean() > 0.95
    assert M.train([]).table().any() == False  # noqa: E712  without labels every score is the prior


def test_held_out_accuracy(spark):
    d, lab = spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")
    out = M.score_documents(d, lab).toPandas()
    assert ((out.held_out) == [zlib.crc32(str(i).encode()) % 5 == 0 for i in out.doc_id]).all()
    x = out[out.held_out].merge(lab.toPandas(), on="doc_id")
    good, bad = x[x.quality == 1].score.values, x[x.quality == 0].score.values
    assert len(good) and len(bad) and (good[:, None] > bad[None, :]).mean() > 0.8
    assert (out.predicted == (out.score >= 0.3)).all() and out.score.between(0, 1).all()


def test_labels_of_the_held_out_fold_are_never_read(spark):
    d, lab = spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet").toPandas()
    other = lab.copy()
    held = [zlib.crc32(str(i).encode()) % 5 == 0 for i in other.doc_id]
    other.loc[held, "quality"] = 1 - other.loc[held, "quality"]
    a = M.score_documents(d, spark.createDataFrame(lab)).orderBy("doc_id").toPandas()
    b = M.score_documents(d, spark.createDataFrame(other)).orderBy("doc_id").toPandas()
    assert np.allclose(a.score, b.score)


def test_awkward_rows(spark):
    lab = spark.createDataFrame([(i, i % 2) for i in range(30)] + [(None, 1), (7, 0), (99999, None)], "doc_id long, quality int")
    out = M.score_documents(docs(spark, awkward()), lab).collect()
    assert len(out) == len(awkward()) and all(0 <= x.score <= 1 for x in out)
    assert len({x.score for x in out if x.doc_id in (1, 2, 3)}) == 1
    assert len({x.score for x in out if x.doc_id == 8}) == 1
    assert all(x.held_out for x in out if x.doc_id is None)
    none = spark.createDataFrame([], "doc_id long, quality int")
    assert {x.score for x in M.score_documents(docs(spark, awkward()), none).collect()} == {0.5}
    assert M.score_documents(docs(spark, awkward()).limit(0), none).count() == 0
