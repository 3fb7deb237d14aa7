import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
from helpers import SF, awkward, docs

from corpusloom.llm import pitman_yor as P
from corpusloom.llm.queries import op11_pitman_yor


def words(text):
    lower = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return re.findall("[^\x20\x09-\x0D]+", lower)


def is_held_out(i):
    return i is not None and zlib.crc32(str(i).encode()) % 5 == 1


def ordered(rows):
    return sorted((tuple(r) for r in rows), key=lambda r: tuple((x is None, round(x, 6) if isinstance(x, float) else x or 0) for x in r))


def close(got, want):
    got, want = ordered(got), ordered(want)
    assert len(got) == len(want)
    for a, b in zip(got, want):
        assert a[:5] == b[:5]
        assert all(math.isclose(x, y, rel_tol=1e-9, abs_tol=1e-9) for x, y in zip(a[5:], b[5:])), (a, b)


def slow_scores(rows, tables_of=None, samples=1):
    """The contract's base score, and the model's score when a dish of c customers has ``tables_of(c)`` tables."""
    train = [words(t) + ["\0"] for i, t in rows if not is_held_out(i)]
    count = Counter(w for t in train for w in t)
    total, known = sum(count.values()), len(count)
    pairs = Counter(p for t in train for p in zip(["\1", *t], t))
    rooms, opened, root = Counter(), Counter(), Counter()
    for (u, w), c in pairs.items():
        rooms[u] += c
        if tables_of:
            opened[u] += tables_of(c)
            root[w] += tables_of(c)
    first = Counter(w for _, w in pairs)
    d = P.discount_of(sum(c == 1 for c in pairs.values()), sum(c == 2 for c in pairs.values()))
    out = []
    for i, t in rows:
        t = words(t) + ["\0"]
        base = sum(math.log10((count[w] + 0.5) / (total + 0.5 * (known + 1))) for w in t)
        score = 0.0
        if tables_of:
            d0 = P.discount_of(sum(c == 1 for c in root.values()), sum(c == 2 for c in root.values()))
            whole, seats = sum(root.values()), sum(tables_of(c) for c in root.values())
            for u, w in zip(["\1", *t], t):
                above = (max(root[w] - d0 * (tables_of(root[w]) if root[w] else 0), 0) + (1 + d0 * seats) / (known + 1)) / (1 + whole)
                c = pairs[u, w]
                score += math.log10((max(c - d * (tables_of(c) if c else 0), 0) + (1 + d * opened[u]) * above) / (1 + rooms[u]))
        out.append((i, is_held_out(i), len(t), sum(count[w] > 0 for w in t), total, base, score))
    assert first.keys() == count.keys()
    return out


def test_words():
    texts = [t or "" for _, t in awkward()] + ["", "ÀB c", "x" * (P.BLOCK + 9) + " Y y", " ".join(f"w{i}" for i in range(200_000))]
    h, at = P.word_hashes(texts)
    name = {}
    for k, (key, text) in enumerate(zip(h.tolist(), at.tolist())):
        name.setdefault(key, []).append(k)
    flat = [w for t in texts for w in words(t)]
    assert len(flat) == len(h) and at.tolist() == [k for k, t in enumerate(texts) for _ in words(t)]
    assert all(len({flat[k] for k in v}) == 1 for v in name.values()) and len(name) == len(set(flat))


def test_blocks_hold_every_token():
    r = random.Random(1)
    texts = [" ".join(r.choice("abcdefgh") for _ in range(r.randrange(400))) for _ in range(30)] + ["z " * 300]
    held = np.array([k % 4 == 0 for k in range(31)])
    for split in (np.zeros(0, np.uint64), np.array([P.BEGIN])):
        blocks, own = P.pack_pairs(texts, held, split, 5, True)
        n, keys, tokens, stay = P.unframe(own, np.int64, np.uint64, np.uint32, np.uint16)
        got, train, at = Counter(), Counter(), 0
        for key, k in zip(keys.tolist(), tokens.tolist()):
            got.update((key, d) for d in stay[at:at + k].tolist())
            at += k
        for _, body in blocks:
            u, w, c, lists, own_docs = P.unpack_pairs(body)
            lists = P.unsmall(lists, len(w))
            key = P.pair_key(u, w)
            got.update(zip(np.repeat(key, lists).tolist(), own_docs.tolist()))
            train.update(dict(zip(key.tolist(), c.tolist())))
        want, learned = Counter(), Counter()
        u, w, doc, _ = P.sequences(texts)
        for key, d in zip(P.pair_key(u, w).tolist(), doc.tolist()):
            want[key, d] += 1
            learned[key] += not held[d]
        assert got == want and +train == +learned


def test_sampler_is_exact_for_one_dish():
    """Tables of one dish of four customers against the sum over all seatings."""
    discount, base, c = 0.5, 0.3, 4

    def partitions(rest):
        if not rest:
            yield []
            return
        for p in partitions(rest[1:]):
            yield [[rest[0]], *p]
            for k in range(len(p)):
                yield [*p[:k], [rest[0], *p[k]], *p[k + 1:]]
    weight = defaultdict(float)
    for p in partitions(list(range(c))):
        x = 1.0
        for k, table in enumerate(p):
            x *= (P.STRENGTH + discount * k) * base
            for m in range(1, len(table)):
                x *= m - discount
        weight[len(p)] += x
    n = 40_000
    got = P.sample_tables(np.full(n, c), np.arange(n), np.full(n, base), np.ones(n, dtype=np.int64), discount, np.random.default_rng(2), 3)[-1]
    assert (got[0] == got[1]).all()
    for t in range(1, c + 1):
        assert abs((got[0] == t).mean() - weight[t] / sum(weight.values())) < 0.012


def test_log_gamma():
    x = np.concatenate([np.random.default_rng(1).random(500) * 30 + 0.02, [1.0, 2.0, 1e3, 1e6, 3e8]])
    assert np.allclose(P.log_gamma(x), [math.lgamma(v) for v in x], rtol=1e-11, atol=1e-11)


def test_everybody_sits_down_by_the_rule(monkeypatch):
    """Tables that dishes of many customers open when they first sit down: a step up
    to the next new table, however long, has the distribution of single steps."""
    n, c, discount, found = 12_000, 300, 0.6, []
    for one_by_one in (4, c):
        monkeypatch.setattr(P, "ONE_BY_ONE", one_by_one)
        s = P.Seating(np.full(n, c), np.arange(n), np.full(n, 0.2), np.ones(n, dtype=np.int64), discount, np.random.default_rng(5))
        s.first()
        assert (s.sizes.sum(axis=1) == c).all() and (s.tables == s.totals).all()
        found.append((s.tables.mean(), s.tables.std(), s.sizes.max(axis=1).mean(), s.sizes[:, 0].mean()))
    for quick, single in zip(*found):
        assert abs(quick - single) < 0.03 * single, found


def test_next_new_table_has_the_waiting_time_of_single_steps():
    """Dish by dish or side by side, the customer that opens the next table comes
    as late as by the predictive rule, customer after customer."""
    n, discount, base, start, last = 40_000, 0.6, 0.05, 20, 60
    tables, chance, want = 3, 1.0, []
    fresh = (P.STRENGTH + discount * tables) * base
    for k in range(start, last):
        p = fresh / (k - discount * tables + fresh)
        want.append(chance * p)
        chance *= 1 - p
    want.append(chance)
    for together in (n, P.FEW):
        s = P.Seating(np.full(n, last), np.arange(n), np.full(n, base), np.full(n, tables), discount, np.random.default_rng(9))
        s.placed[:], s.opened = start, np.full(n, tables)
        got = np.concatenate([s._next_new(s.rows[lo:lo + together]) for lo in range(0, n, together)])
        assert np.abs(np.bincount(got - start - 1, minlength=len(want)) / n - want).max() < 0.006


def test_thousands_of_tables_cost_no_square():
    """A dish with tens of thousands of tables: its sizes are dealt once, not at each new table."""
    import time
    s = P.Seating(np.full(3, 400_000), np.arange(3), np.full(3, 0.9), np.ones(3, dtype=np.int64), 0.9, np.random.default_rng(4))
    began = time.process_time()
    s.first()
    assert time.process_time() - began < 30 and s.tables.min() > 5_000
    assert (s.sizes.sum(axis=1) == 400_000).all() and (s.tables == s.totals).all()


def test_seating_keeps_its_sums():
    r = np.random.default_rng(3)
    c = np.concatenate([r.integers(0, 6, 3000), r.integers(50, 400, 40), [5000, 100_000]])
    room = r.integers(0, 7, len(c))
    totals = np.bincount(room, weights=np.minimum(c, 1), minlength=7).astype(np.int64)
    for tables, opened in P.sample_tables(c, room, r.random(len(c)) * 0.01, totals, 0.7, r, 2):
        assert ((tables >= np.minimum(c, 1)) & (tables <= c)).all()
        assert (np.bincount(room, weights=tables, minlength=7) == opened).all()


def exact_tables(c, base, discount, others):
    """Distribution of the tables of one dish, ``others`` tables being there: the sum over all seatings, customer by customer."""
    weight = np.zeros(c + 1)
    weight[1] = (P.STRENGTH + discount * others) * base
    t = np.arange(c + 1)
    for n in range(1, c):
        opens = weight * (P.STRENGTH + discount * (others + t)) * base
        weight = weight * np.maximum(n - discount * t, 0)
        weight[1:] += opens[:-1]
        weight /= weight.sum()
    return weight


def test_a_sweep_seats_all_customers_anew(monkeypatch):
    """Dishes of many customers among many tables of others: tables have their distribution
    given the other dishes, drawn at once or by blocks of customers that get up."""
    n, discount = 1500, 0.6
    for c, base, others, direct in ((400, 0.3, 20, 1024), (400, 0.3, 20, 1), (300, 0.05, 2, 1), (6000, 0.2, 30, 1024)):
        monkeypatch.setattr(P, "DIRECT", direct)
        want = exact_tables(c, base, discount, others)
        t = np.arange(c + 1)
        mean = (want * t).sum()
        dev = math.sqrt((want * (t - mean) ** 2).sum())
        m = n if c < 1000 else 300
        got, totals = P.sample_tables(np.full(m, c), np.arange(m), np.full(m, base), np.full(m, others + 1), discount, np.random.default_rng(7), 8)[-1]
        assert (totals == got + others).all()
        assert abs(got.mean() - mean) < 5 * dev / math.sqrt(m) and abs(got.std() / dev - 1) < 0.2, (c, direct, got.mean(), mean, got.std(), dev)


def test_root_counts_the_words_of_all_parts(monkeypatch):
    """A word part's seating of the root starts from one table for each word of all parts, then
    from the other parts' tables of the last round and one for each word of its own."""
    import pyarrow as pa
    seen = []

    def note(customers, room, base, totals, discount, rng, samples):
        seen.append((float(base[0]), int(totals[0])))
        return [(np.minimum(customers, 1), totals)] * samples
    monkeypatch.setattr(P, "sample_tables", note)
    words = np.array([5, 9, 12], dtype=np.uint64)
    asked = P._rows([(P.ASK, 3, 0, P.frame(words, P.small(np.array([4, 1, 2])), P.small(np.array([2, 1, 1]))), None)])
    assert isinstance(asked, pa.Table) and P.count_words(asked)["sums"].to_pylist() == [[3.0]]
    P.seat_root(P.Root(10), 1)(asked)
    P.seat_root(P.Root(10, [50.0], [30.0], 0.5, {3: [8.0]}), 1)(asked)
    assert seen == [(1 / 11, 10), (1 / 11, 25)]


def by_rule(monkeypatch):
    def fixed(customers, room, base, totals, discount, rng, samples):
        import numpy
        tables = numpy.minimum(customers, 1) + (customers >= 4)
        return [(tables, numpy.bincount(room, weights=tables, minlength=len(totals)).astype(numpy.int64))] * samples
    monkeypatch.setattr(P, "sample_tables", fixed)
    return lambda c: min(c, 1) + (c >= 4)


def test_scores_against_brute_force(spark, monkeypatch):
    """All stages with a fixed seating rule instead of the sampler, over several
    buckets and buffers, split contexts and pairs whose documents stay behind."""
    rule = by_rule(monkeypatch)
    monkeypatch.setattr(P, "BUCKET_TOKENS", 900)
    rows = [x for x in awkward() if x[0] is not None] + [(500 + k, "same same " * (150 if k % 7 == 0 else 1)) for k in range(40)]
    table = docs(spark, rows).repartition(5)
    close(P.score_documents(table).collect(), slow_scores(rows, rule))


def test_awkward_rows(spark):
    rows = awkward()
    got = P.score_documents(docs(spark, rows)).collect()
    close([(*x[:6], 0.0) for x in got], slow_scores(rows))
    assert all(x.score < 0 for x in got) and any(x.doc_id is None and not x.held_out for x in got)
    twice = [x.score for x in got if x.doc_id == 8]
    assert len(set(twice)) == 1
    assert P.score_documents(docs(spark, rows).limit(0)).count() == 0
    only = [(i, "Unheard of") for i in range(200) if is_held_out(i)][:3]
    got = P.score_documents(docs(spark, only)).collect()
    assert [x.train_tokens for x in got] == [0] * 3 and all(abs(x.score) < 1e-9 and x.n_known == 0 for x in got)


def test_query_on_the_table(spark):
    rows = [(x.doc_id, x.text) for x in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    got = op11_pitman_yor(spark, SF).collect()
    close([(*x[:6], 0.0) for x in got], slow_scores(rows))
    held = [x for x in got if x.held_out]
    assert sum(x.score for x in held) > sum(x.base_score for x in held)
    again = op11_pitman_yor(spark, SF).collect()
    assert {x.doc_id: x.score for x in got} == {x.doc_id: x.score for x in again}
