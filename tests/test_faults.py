"""Faults that once lost, doubled or misread data."""

import json
import os

import numpy as np
import pytest

from corpusloom.operators.merge import merge_binidx
from corpusloom.plans.build import build_corpus
from corpusloom.sources.binidx import read_binidx, write_binidx
from corpusloom.spec import CorpusSpec, TokenizerSpec


def dataset(spark, path, docs, part=0, dtype="uint16"):
    rows = [(part, [int(x) for s in d for x in s], [len(s) for s in d]) for d in docs]
    df = spark.createDataFrame(rows, "part long, token_ids array<int>, sentence_lens array<int>").coalesce(1)
    write_binidx(df, path, dtype=dtype)
    return os.path.join(path, f"part-{part:015d}")


def tokens(spark, path):
    return [list(r.tokens) for r in read_binidx(spark, path).orderBy("seq_id").collect()]


def corpus(path, texts):
    os.makedirs(path, exist_ok=True)
    with open(os.path.join(path, "a.jsonl"), "w", encoding="utf-8") as f:
        for t in texts:
            f.write((t if t.startswith("!") else json.dumps({"text": t})) + "\n")


def test_merge_of_one_dataset_twice(spark, tmp):
    a = dataset(spark, os.path.join(tmp, "a"), [[[1, 2], [3]], [], [[4, 5, 6]]])
    info = merge_binidx(spark, [a, a], os.path.join(tmp, "m"), seqs_per_task=2)
    assert info["sequences"] == 6 and info["documents"] == 6
    assert tokens(spark, os.path.join(tmp, "m")) == [[1, 2], [3], [4, 5, 6]] * 2
    docs = read_binidx(spark, os.path.join(tmp, "m"), table="documents").orderBy("doc_id").collect()
    assert [(r.seq_begin, r.seq_end) for r in docs] == [(0, 2), (2, 2), (2, 3), (3, 5), (5, 5), (5, 6)]


def test_partitions_follow_bytes(spark, tmp):
    docs = [[[1] * 4] for _ in range(400)] + [[[2] * 8000] for _ in range(10)]
    a = dataset(spark, os.path.join(tmp, "a"), docs)
    df = read_binidx(spark, a, bytesPerPartition=16384)
    sizes = [sum(len(r.tokens) for r in p) * 2 for p in df.rdd.glom().collect()]
    assert sum(sizes) == 400 * 8 + 10 * 16000 and max(sizes) <= 2 * 16384 + 16000
    assert sorted(map(tuple, tokens(spark, a))) == sorted(tuple(s) for d in docs for s in d)


def test_batches_are_bounded(spark, tmp, monkeypatch):
    import corpusloom.sources.binidx as B
    a = dataset(spark, os.path.join(tmp, "a"), [[list(range(n))] for n in (5, 0, 9, 1, 1, 40, 2, 3)])
    monkeypatch.setattr(B, "BATCH_BYTES", 20)
    reader = B.BinIdxReader({"path": a}, None)
    got = [b for p in reader.partitions() for b in reader.read(p)]
    seqs = [x for b in got for x in b.column("tokens").to_pylist()]
    assert [len(s) for s in seqs] == [5, 9, 1, 1, 40, 2, 3] or [len(s) for s in seqs] == [5, 0, 9, 1, 1, 40, 2, 3]
    assert all(sum(map(len, b.column("tokens").to_pylist())) * 2 <= 20 or b.num_rows <= 1 for b in got)


def test_sequential_parts_count_every_line(spark, tmp):
    corpus(os.path.join(tmp, "in"), ["a", "!bad", "b", "!bad", "!bad", "c", "d", "e", "!bad", "f"])
    out = build_corpus(spark, CorpusSpec(os.path.join(tmp, "in"), os.path.join(tmp, "o"), TokenizerSpec("byte"), partitions=2,
                                         keep_sequential_samples=True, merge_partitions=False))
    sizes = sorted(r["count"] for r in read_binidx(spark, out["text"], table="documents").groupBy("prefix").count().collect())
    assert sizes == [2, 4]  # lines 0-4 and 5-9


def test_parquet_lists_and_types(spark, tmp):
    path = os.path.join(tmp, "in")
    spark.createDataFrame([(["ab", "c"], "x", 1), (None, None, None), (["q", None], "y", None), ([], "z", None)],
                          "l array<string>, s string, n int").coalesce(1).write.parquet(path)
    out = build_corpus(spark, CorpusSpec(path, os.path.join(tmp, "o"), TokenizerSpec("byte"), json_keys=["l", "s"],
                                         input_format="parquet", quarantine_path=os.path.join(tmp, "q")))
    off = TokenizerSpec("byte").build().offset
    assert [[x - off for x in t] for t in tokens(spark, out["l"])][:2] == [[97, 98], [99, 65532 - off]]
    bad = spark.read.parquet(os.path.join(tmp, "q")).collect()
    assert [(r.reason, json.loads(r.value)["s"]) for r in bad] == [("bad_type", "y")]
    with_number = CorpusSpec(path, os.path.join(tmp, "o2"), TokenizerSpec("byte"), json_keys=["n"], input_format="parquet",
                             quarantine_path=os.path.join(tmp, "q2"))
    build_corpus(spark, with_number)
    assert spark.read.parquet(os.path.join(tmp, "q2")).count() == 1


@pytest.mark.parametrize("per_file", [True, False])
def test_rebuild_after_the_input_changed(spark, tmp, per_file):
    src = os.path.join(tmp, "in")
    corpus(src, list("abcdef"))
    spec = CorpusSpec(src, os.path.join(tmp, "o"), TokenizerSpec("byte"), per_file=per_file)
    outs = lambda res: list(res["files"].values()) if per_file else [res["text"]]
    first = outs(build_corpus(spark, spec))
    assert sum(len(tokens(spark, o)) for o in first) == 6
    corpus(src, list("abcdefg"))
    second = outs(build_corpus(spark, spec))
    assert sum(len(tokens(spark, o)) for o in second) == 7
    os.remove(second[0] + ".bin")  # a broken output is built again
    third = outs(build_corpus(spark, spec))
    assert sum(len(tokens(spark, o)) for o in third) == 7


def test_rebuild_after_the_vocabulary_changed(spark, tmp):
    src, vocab = os.path.join(tmp, "in"), os.path.join(tmp, "v.txt")
    corpus(src, ["aab"])

    def write(entries):
        with open(vocab, "w", encoding="utf-8") as f:
            f.write("".join(f"{i} {t!r} {len(t)}\n" for i, t in entries))
    write([(1, "a"), (2, "b")])
    spec = CorpusSpec(src, os.path.join(tmp, "o"), TokenizerSpec("rwkv", vocab_file=vocab))
    assert tokens(spark, build_corpus(spark, spec)["text"]) == [[1, 1, 2, 65532]]
    write([(1, "a"), (2, "b"), (3, "aa")])
    assert tokens(spark, build_corpus(spark, spec)["text"]) == [[3, 2, 65532]]
    assert np.dtype("uint16").itemsize == 2


def shard_tokens(spark, dirs):
    import glob
    files = sorted(p[:-4] for d in dirs for p in glob.glob(os.path.join(d, "shard_*", "*_final.idx")))
    return sorted(tuple(r.tokens) for r in read_binidx(spark, ",".join(files)).collect())


def numbered(n, at=0):
    return [[[i + 1] * (1 + i % 5)] for i in range(at, at + n)]


def test_reshard_runs_keep_finished_shards(spark, tmp):
    from corpusloom.operators.reshard import reshard
    outs = [os.path.join(tmp, "o1"), os.path.join(tmp, "o2")]
    src = os.path.join(tmp, "src")
    dataset(spark, os.path.join(src, "x"), numbered(40))
    os.rename(os.path.join(src, "x"), os.path.join(tmp, "s1"))
    s1, s2 = os.path.join(tmp, "s1"), os.path.join(tmp, "s2")
    reshard(spark, [s1], outs, 2, target=16)
    want = sorted(tuple(s) for d in numbered(40) for s in d)
    assert shard_tokens(spark, outs) == want
    dataset(spark, s2, numbered(10, 100))
    reshard(spark, [s1, s2], outs, 2, target=64)  # a new source, and another chunk size
    want = sorted(want + [tuple(s) for d in numbered(10, 100) for s in d])
    assert shard_tokens(spark, outs) == want
    assert reshard(spark, [s1, s2], outs, 3, target=32).count() == 0
    assert shard_tokens(spark, outs) == want


def test_reshard_resumes_partial_ranges_and_broken_files(spark, tmp):
    import glob
    from corpusloom.operators import reshard as R
    s1, out = os.path.join(tmp, "s1"), os.path.join(tmp, "o")
    prefix = dataset(spark, s1, numbered(40))
    want = sorted(tuple(s) for d in numbered(40) for s in d)
    # only sequences 4-7 are done; the next run uses another target size
    R.reshard(spark, [s1], [out], 2, target=16)
    listed = spark.read.parquet(os.path.join(out, "_manifest")).collect()
    assert sum(r.end_doc - r.start_doc for r in listed) == 40 and all(r.src_path == prefix for r in listed)
    table = R.chunk_table(spark, [s1], 1 << 20, done=spark.createDataFrame(
        [(prefix, R.source_key(prefix), 4, 8)], "src_path string, source_key string, start_doc long, end_doc long"))
    assert sorted((r.start_doc, r.end_doc) for r in table.collect()) == [(0, 4), (8, 40)]
    # a shard file that was cut short is made again, and nothing twice
    broken = sorted(glob.glob(os.path.join(out, "shard_*", "*.idx")))[0]
    with open(broken, "r+b") as f:
        f.truncate(60)
    R.reshard(spark, [s1], [out], 2, target=48)
    assert shard_tokens(spark, [out]) == want
    # a run that died before its manifest append leaves files that the next run removes
    stray = os.path.join(out, "shard_00", "data_00_r9_final")
    for ext in (".idx", ".bin", ".idx.0123abcd"):
        open(stray + ext, "wb").write(b"x")
    R.reshard(spark, [s1], [out], 2, target=48)
    assert not glob.glob(stray + "*") and shard_tokens(spark, [out]) == want


def test_many_tiny_chunks(spark, tmp):
    from corpusloom.operators.reshard import chunk_table, reshard
    n = 20_000
    s1 = os.path.join(tmp, "s1")
    df = spark.range(n).selectExpr("0L AS part", "array(CAST(id % 60000 AS INT)) AS token_ids", "array(1) AS sentence_lens").coalesce(1)
    write_binidx(df, s1)
    assert chunk_table(spark, [s1], 2).count() == n
    reshard(spark, [s1], [os.path.join(tmp, "o")], 5, target=2)
    assert shard_tokens(spark, [os.path.join(tmp, "o")]) == sorted((i % 60000,) for i in range(n))


def test_fingerprints_follow_lengths(spark, tmp):
    from corpusloom.operators.reshard import FINGERPRINT_FACTOR, FINGERPRINT_PRIME, chunk_fingerprints, chunk_table
    s1 = os.path.join(tmp, "s1")
    dataset(spark, s1, numbered(50))
    lengths = [1 + i % 5 for i in range(50)]
    ch = chunk_table(spark, [s1], 20)
    got = {r.id: r for r in chunk_fingerprints(spark, ch).collect()}
    for c in ch.collect():
        mine = lengths[c.start_doc:c.end_doc]
        want = sum((v + 1) * (((i + 1) ** 2 % 2 ** 32) * FINGERPRINT_FACTOR % 2 ** 32) for i, v in enumerate(mine)) % FINGERPRINT_PRIME
        assert (got[c.id].n_seq, got[c.id].first_len, got[c.id].last_len, got[c.id].fingerprint) == (len(mine), mine[0], mine[-1], want)


def test_long_lines_are_read(spark):
    from corpusloom.operators import parse
    # every line takes the long route here; the answers are those of the short one
    good = ['{"text": "a"}', ' {"text": ["a","b"], "z": 1}', '{"text": []}', '{"text": null}', '{"other": 1}', '{"text":"a","text":"b"}',
            '{"text": "3"}', '{"text": "NaN"}', '{"text": "[1]"}', '{"text": ["a\\u00e9\\n\\"", "/"]}', '{"text": "{}"}']
    bad = ['{bad', '{"text":"a"}{"text":"b"}', '{"text":"a"}],[', '{"text":"a"},"z":1', '{"text":"a",}', '{"text": NaN}', '[1]', '5', 'null',
           '"{}"', '{"text": 3}', '{"text": {"k":1}}', '{"text": ["a",1]}', '{"text": ["a", null]}', '{"text": true}', '', '{"text": [["a"]]}', '{"text": {}}']
    df = spark.createDataFrame([(i, v) for i, v in enumerate(good + bad)], "i int, value string")
    want = [(r.i, r.reason, r.text if r.reason is None else None) for r in parse.classify(df).orderBy("i").collect()]
    assert [w[1] is None for w in want] == [True] * len(good) + [False] * len(bad)
    reason, fields = parse._long_route("value", ["text"])
    got = df.select("i", reason.alias("reason"), fields["text"][0].alias("text")).orderBy("i").collect()
    assert [(r.i, r.reason, r.text if r.reason is None else None) for r in got] == want


def test_lines_beyond_the_variant_limit(spark):
    from pyspark.sql import functions as F
    from corpusloom.operators import parse
    x = "repeat('x', 40 * 1024 * 1024)"
    df = spark.sql(f"""SELECT 1 AS i, concat('{{"text": "', {x}, '"}}') AS value UNION ALL
                       SELECT 2, concat('{{"text": "', {x}, '"}} trailing') UNION ALL
                       SELECT 3, concat('{{"text": ["a", "', {x}, '"], "n": 1}}')""")
    out = parse.classify(df).select("i", "reason", F.size("text").alias("n"), F.length(F.element_at("text", -1)).alias("len")).orderBy("i").collect()
    assert [(r.reason, r.n, r.len) for r in out if r.i != 2] == [(None, 1, 40 << 20), (None, 2, 40 << 20)]
    assert out[1].reason == "bad_json"


def test_unmerged_partitions_are_written_by_several_tasks(spark, tmp):
    import glob
    from corpusloom.plans import build as B
    corpus(os.path.join(tmp, "in"), [f"line {i}" for i in range(500)])
    spec = CorpusSpec(os.path.join(tmp, "in"), os.path.join(tmp, "o"), TokenizerSpec("byte"), partitions=2, merge_partitions=False)
    _, recs = B.prepared_records(spark, spec)
    tasks = [{r.part // B.SUB_PARTS for r in p} for p in recs.select("part").rdd.glom().collect() if p]
    assert len(tasks) >= 4 and set.union(*tasks) == {0, 1}
    for _ in range(2):  # built twice: nothing doubles
        out = build_corpus(spark, spec, resume=False)["text"]
    parts = sorted(glob.glob(os.path.join(out, "*.idx")))
    assert len(parts) == 2
    off = TokenizerSpec("byte").build().offset
    for k, p in enumerate(parts):
        got = [bytes(t - off for t in x[:-1]).decode() for x in tokens(spark, p)]
        assert got == [f"line {i}" for i in range(k, 500, 2)]
    assert B.input_splits(spark, os.path.join(tmp, "in")) == 0
