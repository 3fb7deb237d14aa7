"""S3/S10 catalogue as a table, J3 point reads, J5 interval lookup."""

import os
import random

import pytest

from corpusloom.operators.lookup import get_tokens, seek_tokens, sequence_documents
from corpusloom.sources.binidx import read_binidx, write_binidx
from corpusloom.sources.catalogue import catalogue, interval_lookup, read_sequences


@pytest.fixture()
def parts(spark, tmp):
    r = random.Random(1)
    rows = [(p, [r.randrange(60000) for _ in range(n + 1)], [n // 2, n - n // 2 + 1] if n > 1 else [n + 1])
            for p in range(7) for n in [r.randrange(9) for _ in range(11 * (p != 3))]]
    df = spark.createDataFrame(rows, "part long, token_ids array<int>, sentence_lens array<int>")
    path = os.path.join(tmp, "ds")
    write_binidx(df.repartition(3, "part").sortWithinPartitions("part"), path)
    return path



def test_catalogue_is_the_readers_table(spark, parts):
    cat = catalogue(spark, parts).orderBy("ord", "prefix").collect()
    assert [c.prefix for c in cat] == sorted(c.prefix for c in cat) and len(cat) == 6
    seq = doc = 0
    for c in cat:
        assert (c.seq_base, c.doc_base) == (seq, doc)
        seq, doc = seq + c.n_seq, doc + c.n_docs
    whole = read_binidx(spark, parts)
    assert whole.count() == seq
    key = ["prefix", "seq_id", "file_seq", "doc_id", "sent_pos", "length", "ptr", "tokens"]
    mine = read_sequences(spark, parts, bytes_per_range=40).select(*key)
    assert sorted(map(tuple, mine.collect())) == sorted(map(tuple, whole.select(*key).collect()))
    two = ",".join([cat[4].prefix, cat[0].prefix + ".idx"])
    assert sorted(map(tuple, read_sequences(spark, two).select(*key).collect())) == sorted(map(tuple, read_binidx(spark, two).select(*key).collect()))
    some = read_sequences(spark, parts, seq_lo=9, seq_hi=31).select("seq_id").collect()
    assert sorted(x.seq_id for x in some) == list(range(9, 31))


def test_empty_folder_and_mixed_types(spark, tmp):
    os.makedirs(os.path.join(tmp, "none"))
    assert catalogue(spark, os.path.join(tmp, "none")).count() == 0
    assert read_sequences(spark, os.path.join(tmp, "none")).count() == 0
    for name, dtype in (("a", "uint16"), ("b", "int32")):
        write_binidx(spark.createDataFrame([(0, [1, 2], [2])], "part long, token_ids array<int>, sentence_lens array<int>"),
                     os.path.join(tmp, name), dtype=dtype)
    with pytest.raises(ValueError, match="mixed dtypes"):
        catalogue(spark, f"{tmp}/a,{tmp}/b")


def test_interval_lookup_against_brute_force(spark):
    r = random.Random(2)
    edges = sorted(r.sample(range(1, 5000), 40))
    intervals = [(k, a, b) for k, (a, b) in enumerate(zip(edges, edges[1:])) if k % 3] + [(900, 7000, 7000), (901, 10_000, 10_400)]
    points = [(r.randrange(-5, 12_000), f"p{i}") for i in range(800)] + [(edges[3], "again")] * 4 + [(None, "none")]
    got = interval_lookup(spark.createDataFrame(points, "at long, name string"), spark.createDataFrame(intervals, "k long, a long, b long"),
                          "at", "a", "b", bin_size=64)
    want = [(at, name, k, a, b) for at, name in points if at is not None for k, a, b in intervals if a <= at < b]
    assert sorted(map(tuple, got.collect())) == sorted(want) and len(want) > 150


def test_sequence_documents_has_no_row_per_sequence(spark):
    docs = spark.createDataFrame([(0, 0, 3), (1, 3, 3), (2, 3, 100_000)], "doc_id long, seq_begin long, seq_end long")
    seqs = spark.range(0, 100_000, 999).selectExpr("id AS seq_id", "id * 2 AS x")
    got = sequence_documents(seqs, docs).collect()
    assert sorted((g.seq_id, g.x, g.doc_id) for g in got) == [(i, 2 * i, 0 if i < 3 else 2) for i in range(0, 100_000, 999)]


def test_seek_equals_get(spark, parts):
    seqs = read_binidx(spark, parts)
    n = seqs.count()
    r = random.Random(3)
    asked = []
    size = {x.seq_id: x.length for x in seqs.collect()}
    for _ in range(60):
        i = r.randrange(n)
        off = r.randrange(size[i] + 1)
        asked.append((i, off, None if r.random() < 0.3 else r.randrange(size[i] - off + 1)))
    asked += asked[:5]
    req = spark.createDataFrame(asked, "seq_id long, offset int, length int")
    key = lambda x: (x[0], x[1], x[2] is None, x[2] or 0, x[3])
    got = seek_tokens(spark, parts, req)
    assert sorted(map(tuple, got.collect()), key=key) == sorted(map(tuple, get_tokens(seqs, req).collect()), key=key)
    plan = got._jdf.queryExecution().executedPlan().toString()
    moved = [line for line in plan.splitlines() if "Exchange" in line]  # requests and the catalogue
    assert moved and all("tokens" not in line for line in moved)
    assert seek_tokens(spark, parts, req.limit(0)).count() == 0


def test_seek_refuses_what_is_not_there(spark, parts):
    for bad in [(0, 0, 99), (0, -1, 1), (10_000, 0, 1), (-1, 0, 1)]:
        with pytest.raises(Exception, match="out of range|no such sequence"):
            seek_tokens(spark, parts, spark.createDataFrame([bad], "seq_id long, offset int, length int")).collect()
