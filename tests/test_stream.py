"""ST1: the streamed corpus equals the batch scan on the same files."""

from pyspark.sql import functions as F

from conftest import write_lines
from corpusloom.operators import parse
from corpusloom.sources.corpus import read_lines
from corpusloom.streaming.ingest import ingest_corpus_stream


def test_batch_equals_stream(spark, tmp):
    for i in range(3):
        write_lines(f"{tmp}/in/f{i}.jsonl", [f'{{"text":"t{i}-{j}"}}' for j in range(20)] + ["{bad"])
    batch = parse.records(parse.classify(read_lines(spark, f"{tmp}/in"), ["text"]), ["text"])
    b = sorted(r.sentences[0] for r in batch.collect())
    s = ingest_corpus_stream(spark, f"{tmp}/in", f"{tmp}/out", max_files_per_trigger=1)
    assert sorted(r.sentences[0] for r in s.collect()) == b
    assert spark.read.parquet(f"{tmp}/out/quarantine").count() == 3


def test_stream_writes_a_dataset_that_replays(spark, tmp):
    from corpusloom.functions.byte_level import ByteTokenizer
    from corpusloom.sources.binidx import read_binidx
    from corpusloom.streaming.ingest import process_batch, streamed_prefixes
    for i in range(3):
        write_lines(f"{tmp}/in/f{i}.jsonl", [f'{{"text":"t{i}-{j}"}}' for j in range(20)] + ["{bad"])
    tok = ByteTokenizer(eod=257)
    ingest_corpus_stream(spark, f"{tmp}/in", f"{tmp}/out", max_files_per_trigger=1, tokenizer=tok)
    read = lambda: sorted(bytes(t - tok.offset for t in r.tokens[:-1]).decode()
                          for r in read_binidx(spark, streamed_prefixes(f"{tmp}/out", "text")).collect())
    want = sorted(f"t{i}-{j}" for i in range(3) for j in range(20))
    assert read() == want
    one = read_lines(spark, f"{tmp}/in/f0.jsonl").select("value", "file_path").withColumn("_block", F.lit(0).cast("long"))
    process_batch(one, 77, f"{tmp}/out", ["text"], tok)
    process_batch(one, 77, f"{tmp}/out", ["text"], tok)  # the same batch again
    assert read() == sorted(want + [f"t0-{j}" for j in range(20)])


def test_running_ids_are_those_of_one_build(spark, tmp):
    """Files one by one, a batch replayed in between: line, sequence and byte
    offsets equal those of a batch build over all files."""
    from corpusloom.functions.byte_level import ByteTokenizer
    from corpusloom.plans.build import build_corpus
    from corpusloom.sources.binidx import read_binidx
    from corpusloom.spec import CorpusSpec, TokenizerSpec
    from corpusloom.streaming.ingest import process_batch
    tok = TokenizerSpec("byte").build()
    assert isinstance(tok, ByteTokenizer)
    for i in range(3):
        write_lines(f"{tmp}/in/f{i}.jsonl", [f'{{"text":["t{i}-{j}", "{"x" * (j % 5)}"]}}' for j in range(9 + i)] + ["{bad"] * (i % 2))
    out = f"{tmp}/out"

    def batch(i):
        one = read_lines(spark, f"{tmp}/in/f{i}.jsonl").select("value", "file_path").withColumn("_block", F.lit(0).cast("long"))
        process_batch(one, i, out, ["text"], tok)
    for i in (0, 1, 1, 2, 0):  # replays, a late one too
        batch(i)
    scan = parse.classify(read_lines(spark, f"{tmp}/in"), ["text"])
    want = sorted(map(tuple, scan.select("line_id", "line_no", F.col("reason").isNull()).collect()))
    good = spark.read.parquet(f"{out}/records").select("line_id", "line_no", F.lit(True))
    bad = spark.read.parquet(f"{out}/quarantine").select("line_id", "line_no", F.lit(False))
    assert sorted(map(tuple, good.unionByName(bad.toDF(*good.columns)).collect())) == want
    res = build_corpus(spark, CorpusSpec(f"{tmp}/in", f"{tmp}/built", TokenizerSpec("byte"), merge_partitions=True))
    cols = ["seq_id", "doc_id", "sent_pos", "length", "ptr"]
    built = sorted(map(tuple, read_binidx(spark, res["text"], columns="index").select(*cols).collect()))
    assert sorted(map(tuple, spark.read.parquet(f"{out}/index/text").select(*cols).collect())) == built and len(built) > 25


def test_a_batch_leaves_its_texts_once(spark, tmp, monkeypatch):
    """The parsed lines go when the records are there; records and parts follow the line order."""
    import os

    from corpusloom.functions.byte_level import ByteTokenizer
    from corpusloom.sources.binidx import read_binidx
    from corpusloom.streaming import ingest as I
    texts = [f"t{i}" * (1 + i % 5) for i in range(300)]
    write_lines(f"{tmp}/in/f.jsonl", [f'{{"text":"{t}"}}' for t in texts] + ["{bad"])
    made = []
    monkeypatch.setattr(I, "scratch_dir", lambda s, name: made.append(f"{tmp}/scratch/{name}-{len(made)}") or made[-1])
    one = read_lines(spark, f"{tmp}/in/f.jsonl").select("value", "file_path").withColumn("_block", F.lit(0).cast("long"))
    tok = ByteTokenizer(eod=257)
    I.process_batch(one, 0, f"{tmp}/out", ["text"], tok)
    assert len(made) == 1 and not os.path.exists(made[0])
    rows = [r.line_id for r in spark.read.parquet(f"{tmp}/out/records").collect()]
    assert sorted(rows) == list(range(300)) and sum(b < a for a, b in zip(rows, rows[1:])) < 8
    got = read_binidx(spark, I.streamed_prefixes(f"{tmp}/out", "text")).orderBy("seq_id").collect()
    assert [bytes(t - tok.offset for t in r.tokens[:-1]).decode() for r in got] == texts
    assert spark.read.parquet(f"{tmp}/out/quarantine").first().value == "{bad"
