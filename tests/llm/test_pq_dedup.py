import numpy as np
import pytest

from corpusloom.llm import pq_dedup as Q

SCHEMA = "vec_id long, embedding array<float>, label int, cid string, e int, own int"


def table(spark, rows):
    return spark.createDataFrame([(i, v, 0, "c", 1, 2) for i, v in rows], SCHEMA)


def brute(rows, cosine=0.95):
    ok = [v is not None and len(v) > 0 and all(x is not None and np.isfinite(x) for x in v) and any(x != 0 for x in v) for _, v in rows]
    unit = [np.array(v, dtype=np.float64) / np.linalg.norm(np.array(v, dtype=np.float64)) if o else None for (_, v), o in zip(rows, ok)]
    n, links, group = len(rows), [0] * len(rows), list(range(len(rows)))
    for i in range(n):
        for j in range(i):
            if ok[i] and ok[j] and len(unit[i]) == len(unit[j]) and float(unit[i] @ unit[j]) >= cosine:
                links[i] += 1
                links[j] += 1
                a, b = group[i], group[j]
                group = [b if g == a else g for g in group]
    low = {}
    for g, (i, _) in zip(group, rows):
        if i is not None:
            low[g] = min(low.get(g, i), i)
    return [(i, k, low.get(g) if o else i) for (i, _), k, g, o in zip(rows, links, group, ok)]


def vectors(seed, groups=40, dim=16):
    rng = np.random.default_rng(seed)
    rows = []
    for g in range(groups):
        c = rng.normal(size=dim)
        for k in range(rng.integers(1, 9)):
            v = c + rng.normal(size=dim) * rng.choice([0.0, 0.05, 0.12, 0.3])
            rows.append((len(rows), [float(np.float32(x)) for x in v * rng.choice([1, 1, 7])]))
    return rows


key = lambda r: tuple((x is None, x if x is not None else 0) for x in r)


@pytest.mark.parametrize("block", [512, 5])
def test_against_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(Q, "BLOCK", block)
    rows = vectors(block)
    rows += [(900, None), (901, []), (902, [0.0] * 16), (903, [float("nan")] + [1.0] * 15), (904, [None] + [1.0] * 15),
             (905, [float("inf")] + [1.0] * 15), (None, rows[0][1]), (906, rows[0][1]), (906, rows[0][1]), (907, rows[1][1][:8]),
             (908, rows[1][1][:8]), (None, [0.0] * 16)]
    out = Q.near_duplicates(table(spark, rows)).collect()
    assert sorted(((x.vec_id, x.n_links, x.component_id) for x in out), key=key) == sorted(brute(rows), key=key)
    assert all(x.kept == (x.vec_id is not None and x.vec_id == x.component_id) for x in out)


def test_recall_of_the_index(spark):
    rng = np.random.default_rng(4)
    base = rng.normal(size=(1500, 32))
    near = base[rng.integers(0, 1500, 600)]
    near = near + rng.normal(size=near.shape) * 0.2 * np.linalg.norm(near, axis=1, keepdims=True) / np.sqrt(32)
    x = np.concatenate([base, near]).astype(np.float32)
    out = Q.near_duplicates(table(spark, [(i, v.tolist()) for i, v in enumerate(x)])).toPandas().sort_values("vec_id")
    u = x.astype(np.float64) / np.linalg.norm(x.astype(np.float64), axis=1, keepdims=True)
    true = ((u @ u.T) >= 0.95).sum(1) - 1
    assert (out.n_links.values <= true).all()
    assert out.n_links.sum() >= 0.99 * true.sum() and true.sum() > 500


def test_table_distance_never_exceeds_by_more_than_the_rest():
    rng = np.random.default_rng(2)
    x = Q._units(rng.normal(size=(400, 24)))
    index = Q.fit(x, 12)
    own, _ = index.assign(x)
    codes, rest = index.encode(x, own)
    for at in range(3):
        y = np.nonzero(own == at)[0]
        true = np.linalg.norm(x[:, None] - x[y][None], axis=2)
        assert (index.table_distance(x, at, codes[y]) <= true + rest[y][None] + 1e-9).all()


def test_empty(spark):
    assert Q.near_duplicates(table(spark, [(1, [1.0, 2.0])]).limit(0)).count() == 0
    out = Q.near_duplicates(table(spark, [(1, None), (2, [0.0])])).collect()
    assert sorted((x.vec_id, x.n_links, x.component_id, x.kept) for x in out) == [(1, 0, 1, True), (2, 0, 2, True)]
