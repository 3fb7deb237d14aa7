"""Chunks are found in outputs by their lengths."""

import glob
import os
import random
import shutil

import numpy as np

from corpusloom.operators import occurrence as O
from corpusloom.operators.reshard import chunk_table, reshard
from corpusloom.sources.binidx import write_binidx


def dataset(spark, path, lengths, fill=1):
    df = spark.createDataFrame([(0, [fill] * sum(lengths), lengths)], "part long, token_ids array<int>, sentence_lens array<int>")
    write_binidx(df, path)
    return os.path.join(path, "part-000000000000000")


def as_output(prefix, folder, name="data_00_final"):
    os.makedirs(os.path.join(folder, "shard_00"), exist_ok=True)
    for ext in (".idx", ".bin"):
        shutil.copy(prefix + ext, os.path.join(folder, "shard_00", name + ext))
    return os.path.join(folder, "shard_00", name)


def test_hashes_agree():
    r = random.Random(1)
    x = np.array([r.randrange(9) for _ in range(5000)], dtype=np.int32)
    sums = O.Sums(x)
    for _ in range(300):
        a = r.randrange(5000)
        b = r.randrange(a, 5001)
        assert sums.window(a, b) == O.vector_hash(x, a, b) == O.vector_hash(x[a:b].copy(), 0, b - a)
    for k in O.PREFIXES:
        keys = O.prefix_keys(x, k)
        assert len(keys) == 5000 - k + 1
        same = {}
        for i, key in enumerate(keys.tolist()):
            assert same.setdefault(key, x[i:i + k].tolist()) == x[i:i + k].tolist()


def test_blocks_do_not_matter(monkeypatch):
    x = np.arange(3000, dtype=np.int32) % 11
    whole, h = O.Sums(x), O.vector_hash(x, 5, 2900)
    monkeypatch.setattr(O, "RANGE", 2 * O.STRIDE)
    assert O.Sums(x).window(7, 2990) == whole.window(7, 2990) and O.vector_hash(x, 5, 2900) == h


def test_equal_chunks_and_a_foreign_middle(spark, tmp):
    """Two outputs claim chunks of equal lengths; one has strange sequences in its middle."""
    r = random.Random(2)
    varied = [r.randrange(1, 60) for _ in range(90)]
    src = os.path.join(tmp, "src")
    dataset(spark, src, [4] * 60 + varied)          # chunks of [4] * 10, then different ones
    chunks = chunk_table(spark, [src], 80)
    table = {c.id: (c.start_doc, c.end_doc) for c in chunks.collect()}
    flat = [4] * 60 + varied
    vectors = {i: flat[a:b] for i, (a, b) in table.items()}
    constant = [i for i, v in vectors.items() if v == [4] * 10]
    rest = sorted((i for i in vectors if i not in constant and len(vectors[i]) >= 1), key=lambda i: table[i])
    long = [i for i in rest if len(vectors[i]) >= O.REENTRY]
    foreign = [1000 + k for k in range(30)]
    a = [4] * 10 + vectors[rest[0]] + [4] * 10 + foreign + [4] * 10
    b = [4] * 10 + (vectors[long[0]] if long else [])
    outs = [as_output(dataset(spark, os.path.join(tmp, n), x), os.path.join(tmp, "o" + n)) for n, x in (("a", a), ("b", b))]
    got = O.held_chunks(spark, chunks, outs).collect()
    want = set(sorted(constant, key=lambda i: table[i])[:4]) | {rest[0]} | set(long[:1])
    assert {x.chunk_id for x in got} == want and len(got) == len(want)
    places = {(x.output, x.pos) for x in got}
    assert {(outs[0], 0), (outs[1], 0), (outs[0], 10 + len(vectors[rest[0]]) + 10 + 30)} <= places


def test_more_occurrences_than_chunks(spark, tmp):
    src = os.path.join(tmp, "src")
    dataset(spark, src, [7] * 20)
    chunks = chunk_table(spark, [src], 2 * 7 * 10)
    out = as_output(dataset(spark, os.path.join(tmp, "x"), [7] * 50), os.path.join(tmp, "o"))
    got = O.held_chunks(spark, chunks, [out]).collect()
    assert sorted(x.pos for x in got) == [0, 10] and len({x.chunk_id for x in got}) == 2
    assert O.held_chunks(spark, chunks, []).count() == 0
    assert O.held_chunks(spark, chunks.limit(0), [out]).count() == 0


def shard_files(tmp):
    return sorted(glob.glob(os.path.join(tmp, "o*", "shard_*", "*_final.idx")))


def test_reshard_without_its_manifest_keeps_what_is_done(spark, tmp):
    r = random.Random(3)
    src = os.path.join(tmp, "src")
    dataset(spark, src, [r.randrange(1, 30) for _ in range(400)])
    outs = [os.path.join(tmp, "o1"), os.path.join(tmp, "o2")]
    reshard(spark, [src], outs, 3, target=120)
    first = {p: os.stat(p).st_mtime_ns for p in shard_files(tmp)}
    assert len(first) == 3
    shutil.rmtree(os.path.join(outs[0], "_manifest"))
    assert reshard(spark, [src], outs, 3, target=120).count() == 0
    assert {p: os.stat(p).st_mtime_ns for p in shard_files(tmp)} == first
    # one file gone as well: only its chunks are written again
    shutil.rmtree(os.path.join(outs[0], "_manifest"))
    gone = sorted(first)[0]
    for ext in (".idx", ".bin"):
        os.remove(gone[:-4] + ext)
    again = reshard(spark, [src], outs, 3, target=120)
    from corpusloom.sources.binidx import read_binidx
    rows = read_binidx(spark, ",".join(p[:-4] for p in shard_files(tmp)), columns="index")
    assert 0 < again.count() and rows.count() == 400
    assert all(os.stat(p).st_mtime_ns == t for p, t in first.items() if p != gone)


def test_strange_whole_files_stay(spark, tmp):
    src, out = os.path.join(tmp, "src"), os.path.join(tmp, "o")
    dataset(spark, src, [3, 5, 8, 2] * 20)
    kept = as_output(dataset(spark, os.path.join(tmp, "x"), [900, 901, 902]), out)
    reshard(spark, [src], [out], 2, target=40)
    assert os.path.exists(kept + ".idx") and os.path.exists(kept + ".bin")
    mine = [p for p in shard_files(tmp) if p[:-4] != kept]
    assert mine and all("_r1_" in p for p in mine)


def test_positions_do_not_go_through_the_driver(spark, tmp_path):
    """Few names of outputs stand for many positions: their join is a shuffle."""
    lengths = [1 + i * 7919 % 13 for i in range(3000)]
    prefix = dataset(spark, str(tmp_path / "ds"), lengths)
    chunks = chunk_table(spark, [str(tmp_path / "ds")], 400)
    found = O.candidates(spark, spark.createDataFrame([(prefix,)], "output string"), O.chunk_vectors(chunks).checkpoint())
    rows = {(r.pos, r.n) for r in found.collect()}
    assert {(r.start_doc, r.num_docs) for r in chunks.collect()} <= rows
    plan = found._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    assert "SortMergeJoin" in plan and "Broadcast" not in plan, plan
