"""File discovery (S1), line identity (S2), JSON rules."""

import os

import pytest
from pyspark.sql import functions as F

from conftest import write_lines
from corpusloom.operators import parse
from corpusloom.sources.corpus import check_corpus_path, read_lines


def test_discovery_recursive_sorted_and_suffix(spark, tmp):
    write_lines(f"{tmp}/b.jsonl", ['{"text":"second"}'])
    write_lines(f"{tmp}/nested/a.jsonl", ['{"text":"first"}'])
    write_lines(f"{tmp}/nested/ignore.txt", ['{"text":"no"}'])
    write_lines(f"{tmp}/nested/temperature_data.jsonl", ['{"text":"t"}'])
    write_lines(f"{tmp}/nested/assessment_ss_notes.JSONL", ['{"text":"upper"}'])
    lines = read_lines(spark, tmp).orderBy("line_id").collect()
    names = [os.path.basename(r.file_path) for r in lines]
    assert names == ["b.jsonl", "a.jsonl", "assessment_ss_notes.JSONL", "temperature_data.jsonl"]
    assert [r.line_id for r in lines] == [0, 1, 2, 3]


def test_rejected_inputs(spark, tmp):
    with pytest.raises(FileNotFoundError):
        check_corpus_path(spark, f"{tmp}/missing")
    write_lines(f"{tmp}/sample.txt", ["x"])
    with pytest.raises(ValueError):
        check_corpus_path(spark, f"{tmp}/sample.txt")
    write_lines(f"{tmp}/sample.jsonl.gz", ["x"])
    with pytest.raises(ValueError):
        check_corpus_path(spark, f"{tmp}/sample.jsonl.gz")
    write_lines(f"{tmp}/d/_hidden.jsonl", ["{}"])
    with pytest.raises(ValueError):
        check_corpus_path(spark, f"{tmp}/d")


def test_line_ids_gap_free_across_small_splits(spark, tmp):
    # 4 files in nested folders, one without final newline, one empty,
    # CRLF and lone CR line ends; tiny splits force many splits per file.
    expect = []
    for i, (name, nl, final) in enumerate([("a/x.jsonl", "\n", True), ("a/y.jsonl", "\r\n", False),
                                           ("b/z.jsonl", "\r", True), ("c/e.jsonl", "\n", True)]):
        rows = [] if name == "c/e.jsonl" else [f'{{"text":"{name}-{j}"}}' for j in range(300)]
        write_lines(f"{tmp}/{name}", rows, newline=nl, final_newline=final)
        expect += [(name, j, r) for j, r in enumerate(rows)]
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1024")
    try:
        got = read_lines(spark, tmp).orderBy("line_id").collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert [r.line_id for r in got] == list(range(len(expect)))
    assert [r.value for r in got] == [e[2] for e in expect]
    assert [r.line_no for r in got] == [e[1] for e in expect]


EDGE = [
    ('{"text": "a"}', None, ["a"]),
    ('{"text": ["a","b"]}', None, ["a", "b"]),
    ('{"text": []}', None, []),
    ('{"text": null}', None, [""]),
    ('{"other": 1}', None, [""]),
    ('{bad', "bad_json", None),
    ('', "bad_json", None),
    ('{"text":"a"}{"text":"b"}', "bad_json", None),
    ('{"text":"a"}],[', "bad_json", None),
    ('{"text":"a"},"z":1', "bad_json", None),
    ('{"text":"a",}', "bad_json", None),
    ('{"text": NaN}', "bad_json", None),
    ('[1]', "not_object", None),
    ('5', "not_object", None),
    ('null', "not_object", None),
    ('{"text": 3}', "bad_type", None),
    ('{"text": {"k":1}}', "bad_type", None),
    ('{"text": ["a",1]}', "bad_type", None),
    ('{"text":"a","text":"b"}', None, ["b"]),
]


def test_json_edge_lines(spark):
    df = spark.createDataFrame([(i, v) for i, (v, _, _) in enumerate(EDGE)], "line_id long, value string")
    got = {r.line_id: r for r in parse.classify(df, ["text"]).collect()}
    for i, (line, reason, sents) in enumerate(EDGE):
        assert got[i].reason == reason, line
        if reason is None:
            assert got[i].text == sents, line


def test_dotted_key_and_bad_utf8(spark):
    df = spark.createDataFrame([(0, '{"a.b":"dot"}')], "line_id long, value string")
    assert parse.classify(df, ["a.b"]).first()["a.b"] == ["dot"]
    raw = spark.createDataFrame([(1, bytearray(b'{"text":"a\xff"}'))], "line_id long, value binary")
    r = parse.classify(raw.select("line_id", F.col("value").cast("string").alias("value")), ["text"]).first()
    assert r.reason == "bad_utf8"


def test_bad_line_skipped_and_quarantined(spark, tmp):
    write_lines(f"{tmp}/c.jsonl", ['{"text":"ok"}', "{bad json", '{"text":"ok2"}'])
    cls = parse.classify(read_lines(spark, tmp), ["text"])
    recs = parse.records(cls, ["text"]).orderBy("line_id").collect()
    assert [r.sentences for r in recs] == [["ok"], ["ok2"]]
    q = parse.quarantine(cls).collect()
    assert [(r.line_no, r.reason) for r in q] == [(1, "bad_json")]
    assert parse.first_bad_line(cls).first().line_id == 1


def test_multi_key_fan_out(spark):
    df = spark.createDataFrame([(0, '{"a":"x","b":["y","z"]}')], "line_id long, value string")
    cls = parse.classify(df, ["a", "b", "c"])
    recs = {r.key: r.sentences for r in parse.records(cls, ["a", "b", "c"]).collect()}
    assert recs == {"a": ["x"], "b": ["y", "z"], "c": [""]}


def test_sentence_rule_and_abbreviations(spark):
    from corpusloom.operators.text import split_sentences, split_values
    df = spark.createDataFrame([("Dr. Smith came. Pi is 3.14! Really?  Yes\\nno",)], "t string")
    plain = df.select(split_sentences(F.col("t")).alias("s")).first().s
    assert plain == ["Dr.", "Smith came.", "Pi is 3.14!", "Really?", "Yes\\nno"]
    ab = df.select(split_sentences(F.col("t"), abbreviations=["Dr"]).alias("s")).first().s
    assert ab[0] == "Dr. Smith came."
    kept = df.select(split_sentences(F.col("t"), keep_newlines=True).alias("s")).first().s
    assert "".join(kept) == "Dr. Smith came. Pi is 3.14! Really?  Yes\\nno"
    empty = spark.createDataFrame([([""],)], "v array<string>").select(split_values(F.col("v")).alias("s")).first().s
    assert empty == []


def test_sentences_of_texts_with_dots_inside_words(spark):
    """Long runs of dots, none of which ends a sentence, and random texts: the sentences of the written rule."""
    import random
    import re
    from corpusloom.operators import text as X
    rng = random.Random(3)
    texts = ["ab." * 60_000 + " End.", "1.2" * 60_000, "x" + ".!?" * 50_000 + "y z. a"]
    texts += ["".join(rng.choices(".!? \t\nab\u00e9\U0001F600", k=rng.randrange(40))) for _ in range(400)]
    strip = lambda s: re.sub(f"^{X.WS}+|{X.WS}+\\Z", "", s)
    want = [[s for x in re.findall(X.SENTENCE_PATTERN, t) if (s := strip(x))] for t in texts]
    df = spark.createDataFrame(list(enumerate(texts)), "k int, t string").repartition(4)
    got = {r.k: r.s for r in df.select("k", X.split_values(F.array("t")).alias("s")).collect()}
    assert [got[k] for k in range(len(texts))] == want


def test_split_sentences_query_of_texts_without_sentences(spark, tmp):
    from corpusloom.plans.catalog import q_split_sentences
    rows = [(0, ""), (1, " \n"), (2, "One. Two!"), (3, None)]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp}/documents.parquet")
    got = {r.doc_id: (r.n_sents, r.lens, r.last) for r in q_split_sentences(spark, tmp).collect()}
    assert got[0] == got[1] == (0, "", None) and got[2] == (2, "4,4", "Two!") and got[3][1:] == (None, None)


def test_line_ids_never_exchange_the_text(spark, tmp, monkeypatch):
    """Without automatic broadcasts and over many splits: the same ids, and no exchange of ``value``."""
    from corpusloom.sources import corpus as C
    want = []
    for k in range(3):
        lines = [f"file {k} line {i} " + "x" * (i % 37) for i in range(400)]
        write_lines(os.path.join(tmp, "in", f"d{k}", f"f{k}.jsonl"), lines)
        want += [(k, i, line) for i, line in enumerate(lines)]
    want = [(i, *w) for i, w in enumerate(want)]
    old = {c: spark.conf.get(c) for c in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    try:
        for c, v in zip(old, ("-1", "4000", "0")):
            spark.conf.set(c, v)
        rows = C.read_lines(spark, os.path.join(tmp, "in"))
        assert rows.rdd.getNumPartitions() > 8
        got = rows.select("line_id", "file_rank", "line_no", "value").collect()
        assert sorted(map(tuple, got)) == want
        plan = rows._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" not in plan and not [x for x in plan.splitlines() if "Exchange" in x and "value" in x]
        monkeypatch.setattr(C, "MOST_SPLITS", 2)  # the way beyond
        assert sorted(map(tuple, C.read_lines(spark, os.path.join(tmp, "in")).select("line_id", "file_rank", "line_no", "value").collect())) == want
    finally:
        for c, v in old.items():
            spark.conf.set(c, v)
