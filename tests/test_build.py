"""End-to-end build job (U2) on a tiny corpus: bad lines quarantined, list
values become sentences, end-of-document appended, counters observed."""

import os

import pytest

from conftest import write_lines
from corpusloom.plans.build import build_corpus, write_split_sentences
from corpusloom.sources.binidx import read_binidx
from corpusloom.spec import CorpusSpec, TokenizerSpec


def test_build_small_corpus(spark, tmp):
    write_lines(f"{tmp}/in/a.jsonl", ['{"text":"ab"}', "{bad", '{"text":["c","d"]}', '{"other":1}'])
    spec = CorpusSpec(f"{tmp}/in", f"{tmp}/out/ds", TokenizerSpec("byte", eod=300),
                      quarantine_path=f"{tmp}/q")
    res = build_corpus(spark, spec)
    assert res["dtype"] == "uint16"
    assert res["documents"] == 3 and res["sequences"] == 3
    rows = read_binidx(spark, res["text"]).orderBy("seq_id").collect()
    assert [r.tokens for r in rows] == [[98, 99, 300], [100], [101, 300]]
    assert [r.doc_id for r in rows] == [0, 1, 1]
    docs = read_binidx(spark, res["text"], table="documents").orderBy("doc_id").collect()
    assert [(d.seq_begin, d.seq_end) for d in docs] == [(0, 1), (1, 3), (3, 3)]  # empty doc kept (Q6)
    assert spark.read.parquet(f"{tmp}/q").count() == 1


def test_build_round_robin_unmerged_parts(spark, tmp):
    write_lines(f"{tmp}/in/a.jsonl", [f'{{"text":"{c}"}}' for c in "abcde"])
    res = build_corpus(spark, CorpusSpec(f"{tmp}/in", f"{tmp}/out/rr", TokenizerSpec("byte", eod=None),
                                         partitions=2, merge_partitions=False, append_eod=False))
    parts = sorted(os.listdir(res["text"]))
    assert len([p for p in parts if p.endswith(".idx")]) == 2
    first = read_binidx(spark, os.path.join(res["text"], parts[0][:-4])).orderBy("seq_id").collect()
    assert [r.tokens for r in first] == [[98], [100], [102]]  # lines 0, 2, 4


def test_split_sentences_output(spark, tmp):
    write_lines(f"{tmp}/in/a.jsonl", ['{"text":"One. Two!","x":"y"}', '{"text":""}'])
    out = f"{tmp}/ss"
    write_split_sentences(spark, CorpusSpec(f"{tmp}/in", ""), out)
    got = [r.value for r in spark.read.text(out).collect()]
    assert sorted(got) == sorted(['{"text":["One.","Two!"]}', '{"text":[]}'])


def test_split_output_of_dots_inside_words(spark, tmp):
    text = "ab." * 60_000
    write_lines(f"{tmp}/in/a.jsonl", [f'{{"text":"{text} End. x"}}', '{"text":"One. Two!"}'])
    write_split_sentences(spark, CorpusSpec(f"{tmp}/in", ""), f"{tmp}/ss")
    got = [r.text for r in spark.read.schema("text array<string>").json(f"{tmp}/ss").collect()]
    assert sorted(got) == sorted([[text, "End.", "x"], ["One.", "Two!"]])


def test_split_output_query_of_texts_without_sentences(spark, tmp):
    from corpusloom.plans.catalog import q_split_output
    rows = [(0, "", "de"), (1, " \n", "en"), (2, "One. Two!", "en"), (3, None, "fr")]
    spark.createDataFrame(rows, "doc_id long, text string, lang string").write.parquet(f"{tmp}/documents.parquet")
    got = [(r.n_sents, r.first) for r in q_split_output(spark, tmp).collect()]
    assert sorted(got, key=str) == [(0, None), (0, None), (0, None), (2, "One.")]


def test_partitions_of_a_corpus_of_many_splits_need_no_shuffle(spark, tmp):
    """Both ways of dealing lines out, merged and not: the order of the parts, and no exchange of text."""
    from corpusloom.plans.build import prepared_records
    lines = [f'{{"text":"doc {i} ' + "word " * (i % 17) + '"}' for i in range(400)]
    write_lines(f"{tmp}/in/x/a.jsonl", lines[:250])
    write_lines(f"{tmp}/in/y/b.jsonl", lines[250:])
    want = {False: [i for p in range(3) for i in range(p, 400, 3)], True: list(range(400))}
    old = {c: spark.conf.get(c) for c in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    try:
        for c, v in zip(old, ("2048", "0")):
            spark.conf.set(c, v)
        for sequential in (False, True):
            for merged in (True, False):
                spec = CorpusSpec(f"{tmp}/in", f"{tmp}/{sequential}{merged}/ds", TokenizerSpec("byte", eod=300), partitions=3,
                                  merge_partitions=merged, keep_sequential_samples=sequential)
                assert "Exchange" not in prepared_records(spark, spec)[1]._jdf.queryExecution().executedPlan().toString().replace("BroadcastExchange", "")
                res = build_corpus(spark, spec)
                assert merged or len([x for x in os.listdir(res["text"]) if x.endswith(".idx")]) == 3
                rows = read_binidx(spark, res["text"]).orderBy("seq_id").collect()
                assert [int(bytes(t - 1 for t in r.tokens[:-1]).split()[1]) for r in rows] == want[sequential]
                assert not os.path.exists(f"{tmp}/{sequential}{merged}/ds__parts/part-000000000000000.bin")
    finally:
        for c, v in old.items():
            spark.conf.set(c, v)


def test_merged_data_goes_as_it_is_copied(spark, tmp):
    """Only the data: a task that is tried again finds the index and writes it anew."""
    from corpusloom.operators.merge import PLAN_SCHEMA, gather_table
    from corpusloom.sources.binidx import write_binidx
    df = spark.createDataFrame([(p, [p + 1, p + 2, 7], [2, 1]) for p in range(4)], "part long, token_ids array<int>, sentence_lens array<int>")
    write_binidx(df.repartition(2, "part").sortWithinPartitions("part"), f"{tmp}/p", dtype="uint16")
    plan = spark.createDataFrame([(f"{tmp}/m", f"{tmp}/p/part-{p:015d}", "uint16", 0, 2, 2 * p, 6 * p, p, 2, 6, 1) for p in range(4)], PLAN_SCHEMA)
    gather_table(spark, plan, delete_data=True)
    assert sorted(x[-4:] for x in os.listdir(f"{tmp}/p") if x.startswith("part-")) == [".idx"] * 4
    rows = read_binidx(spark, f"{tmp}/m").orderBy("seq_id").collect()
    assert [r.tokens for r in rows] == [x for p in range(4) for x in ([p + 1, p + 2], [7])] and [r.doc_id for r in rows] == [p for p in range(4) for _ in range(2)]


def test_glm_system_tools(spark):
    from pyspark.sql import functions as F
    from corpusloom.operators.chat import glm_system_content
    df = spark.createDataFrame([("system", "hi", '[{"name":"f"}]'), ("user", "u", '[1]'), ("system", "s", None)],
                               "role string, text string, tools string")
    got = [r.c for r in df.select(glm_system_content(F.col("role"), F.col("text"), F.col("tools")).alias("c")).collect()]
    assert got == ['hi\n[\n    {\n        "name": "f"\n    }\n]', "u", "s"]


def test_output_bytes_do_not_depend_on_partitioning(spark, tmp):
    """Same .bin/.idx bytes for different shuffle and split settings."""
    lines = [f'{{"text":"doc {i} ' + "word " * (i % 17) + '. end"}' for i in range(400)]
    write_lines(f"{tmp}/in/x/a.jsonl", lines[:250])
    write_lines(f"{tmp}/in/y/b.jsonl", lines[250:])
    outs = []
    old_sp = spark.conf.get("spark.sql.shuffle.partitions")
    old_mp = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        for i, (sp, mp) in enumerate([("8", "134217728"), ("3", "2048")]):
            spark.conf.set("spark.sql.shuffle.partitions", sp)
            spark.conf.set("spark.sql.files.maxPartitionBytes", mp)
            res = build_corpus(spark, CorpusSpec(f"{tmp}/in", f"{tmp}/out{i}/ds", TokenizerSpec("byte"),
                                                 split_sentences=True, partitions=3))
            outs.append(res["text"])
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old_sp)
        spark.conf.set("spark.sql.files.maxPartitionBytes", old_mp)
    for ext in (".bin", ".idx"):
        assert open(outs[0] + ext, "rb").read() == open(outs[1] + ext, "rb").read()


def test_build_resume_by_fingerprint(spark, tmp):
    write_lines(f"{tmp}/in/a.jsonl", ['{"text":"ab"}'])
    spec = CorpusSpec(f"{tmp}/in", f"{tmp}/out/ds", TokenizerSpec("byte"))
    r1 = build_corpus(spark, spec)
    mtime = os.path.getmtime(r1["text"] + ".bin")
    r2 = build_corpus(spark, spec)  # same input: nothing recomputed
    assert r2 == r1 and os.path.getmtime(r1["text"] + ".bin") == mtime
    write_lines(f"{tmp}/in/a.jsonl", ['{"text":"abc"}'])  # input changed: rebuilt
    os.utime(f"{tmp}/in/a.jsonl", (mtime + 10, mtime + 10))
    r3 = build_corpus(spark, spec)
    assert read_binidx(spark, r3["text"]).first().length == 4


def test_datasets_of_many_files_are_one_plan(spark):
    from conftest import SF0001
    from corpusloom.plans.catalog import q_per_file_build
    plan = q_per_file_build(spark, SF0001)._jdf.queryExecution().analyzed().toString()
    assert plan.count("RelationV2") == 1 and "Union" not in plan, plan


def test_listing_asks_no_file_by_file(spark, tmp, monkeypatch):
    """Checks, fingerprints and renames of many files take no file system call per file but the rename."""
    from corpusloom.plans.build import input_fingerprint
    from corpusloom.plans.fixtures import rename_to_jsonl
    from corpusloom.sources import corpus
    from corpusloom.spec import CorpusSpec, TokenizerSpec
    src = os.path.join(tmp, "in [1]")
    spark.range(40).selectExpr("id div 2 AS f", "'{\"text\": \"x\"}' AS value").repartition("f").write.partitionBy("f").text(src)
    rename_to_jsonl(spark, src)
    names = [n for _, _, ns in os.walk(src) for n in ns if not n.endswith(".crc")]
    assert sum(n.endswith(".jsonl") for n in names) == 20 and not any(n.endswith(".txt") for n in names)
    walked = []
    monkeypatch.setattr(corpus, "_file_paths", lambda fs, status, f=corpus._file_paths: [walked.append(p) or p for p in f(fs, status)])
    assert corpus.check_corpus_path(spark, src)
    assert all(os.path.basename(p).startswith(("_", ".")) for p in walked)
    spec = CorpusSpec(src, os.path.join(tmp, "out"), TokenizerSpec("byte"))
    first = input_fingerprint(spark, spec)
    assert first == input_fingerprint(spark, spec)
    with open(os.path.join(src, "f=3", "more.jsonl"), "w") as f:
        f.write("{}")
    assert first != input_fingerprint(spark, spec)
    os.makedirs(os.path.join(src, "f=4", "_aside", "deep"))
    open(os.path.join(src, "f=4", "_aside", "deep", "x.JSONL"), "w").close()
    with pytest.raises(ValueError):
        corpus.check_corpus_path(spark, src)
