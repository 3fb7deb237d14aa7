import random
import re

import numpy as np
import xxhash
from helpers import awkward, docs

from corpusloom.llm import simhash as S


def slow_fingerprint(text):
    t = re.sub(r"[A-Z]", lambda m: m[0].lower(), text or "")
    w = re.findall(r"[^\x20\x09-\x0D]+", t)
    if not w:
        return 0
    sh = [" ".join(w[i:i + 3]) for i in range(len(w) - 2)] if len(w) >= 3 else [" ".join(w)]
    h = [xxhash.xxh64_intdigest(s.encode(), seed=42) for s in sh]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def test_fingerprint():
    for _, t in awkward():
        if t is None or len(t) < 4000:
            assert S.fingerprint(t) == slow_fingerprint(t)


def test_golay_code_is_perfect():
    x = np.random.default_rng(0).integers(0, 1 << 23, 2000)
    index = S.codeword_index(x)
    words = np.array([m << 11 | int(S._UPPER[m]) for m in range(4096)])
    distance = np.bitwise_count(words[index] ^ x)
    assert distance.max() <= 3 and (index < 4096).all()


def test_keys_meet_at_every_distance():
    r = np.random.default_rng(1)
    a = r.integers(0, 1 << 63, 3000, dtype=np.uint64) * np.uint64(2) + r.integers(0, 2, 3000, dtype=np.uint64)
    b = a.copy()
    for _ in range(3):
        b ^= np.uint64(1) << r.integers(0, 64, 3000, dtype=np.uint64)
    pr, pk = S.probe_keys(a)
    qr, qk = S.point_keys(b)
    mine = {}
    for row, key in zip(pr.tolist(), pk.tolist()):
        mine.setdefault(row, set()).add(key)
    met = {row for row, key in zip(qr.tolist(), qk.tolist()) if key in mine[row]}
    assert len(met) == 3000


def test_links_and_components(spark):
    r = random.Random(3)
    fps = [r.getrandbits(64) for _ in range(60)]
    for f in fps[:30]:
        for k in range(4):
            fps.append(f ^ sum(1 << b for b in r.sample(range(64), r.randrange(0, 6))))
    fps = sorted(set(fps))
    table = spark.createDataFrame([(f - (1 << 64) if f >> 63 else f,) for f in fps], "fp long")
    got = {frozenset((x.a % (1 << 64), x.b % (1 << 64))) for x in S.fingerprint_links(table).collect()}
    want = {frozenset((a, b)) for i, a in enumerate(fps) for b in fps[:i] if (a ^ b).bit_count() <= 3}
    assert got == want and want


def brute(rows):
    fp = [S.fingerprint(t) for _, t in rows]
    group = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            if (fp[i] ^ fp[j]).bit_count() <= 3 and group[i] != group[j]:
                a, b = group[i], group[j]
                group = [b if g == a else g for g in group]
    low = {}
    for g, (i, _) in zip(group, rows):
        if i is not None:
            low[g] = min(low.get(g, i), i)
    return fp, [low.get(g) for g in group], group


def test_query_and_stage(spark):
    rows = awkward()
    fp, component, group = brute(rows)
    key = lambda x: tuple((v is None, v if v is not None else 0) for v in x)
    got = sorted(((x.doc_id, x.fingerprint, x.component_id) for x in S.simhash_components(docs(spark, rows)).collect()), key=key)
    assert got == sorted(((i, f"{f:016x}", c) for (i, _), f, c in zip(rows, fp, component)), key=key)
    d = docs(spark, rows)
    kept = S.keep_one(d)
    assert kept.columns == d.columns
    ids = [x.doc_id for x in kept.select("doc_id").collect()]
    # two components may share their smallest id (12 stands for two texts)
    low = dict(zip(group, component))
    key = lambda x: (x is None, x or 0)
    assert sorted(ids, key=key) == sorted(low.values(), key=key)
    assert S.simhash_components(d.limit(0)).count() == 0 and S.keep_one(d.limit(0)).count() == 0
