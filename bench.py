"""Benchmark of the headline jobs.

Runs at ``$BENCH_SF_DIR`` (default /root/testdata/sf0.1) on
``local[$BENCH_CPUS]`` and prints one JSON line. Every timed step forces the
whole plan with the ``noop`` sink (or writes its real output) and is timed
wall-clock; fixtures (the JSONL corpus, vocabularies) are prepared before
the clock starts.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import functions as F  # noqa: E402

from corpusloom.functions.base import encode_documents  # noqa: E402
from corpusloom.functions.byte_level import ByteTokenizer  # noqa: E402
from corpusloom.operators import chat, index, parse  # noqa: E402
from corpusloom.plans import catalog  # noqa: E402
from corpusloom.plans.fixtures import documents_jsonl, table  # noqa: E402
from corpusloom.session import build_session, scratch_dir  # noqa: E402
from corpusloom.sources.binidx import read_binidx, write_binidx  # noqa: E402
from corpusloom.sources.corpus import read_lines  # noqa: E402


def noop(df):
    df.write.format("noop").mode("overwrite").save()


def run_suite(spark, sf_dir):
    from corpusloom.operators.parallel import balance
    docs = balance(table(spark, sf_dir, "documents"), "doc_id")
    n_docs, n_chars, n_bytes = docs.agg(F.count(F.lit(1)), F.sum(F.length("text")),
                                        F.sum(F.octet_length("text"))).first()
    corpus = documents_jsonl(spark, sf_dir)
    bpe_tok, _, _ = catalog._bpe(spark, docs)
    times: dict[str, float] = {}

    def timed(name, fn):
        t0 = time.time()
        fn()
        times[name] = round(time.time() - t0, 3)

    byte = ByteTokenizer()
    sents = docs.select("doc_id", F.split("text", "\n").alias("sentences"))

    timed("scan_parse", lambda: noop(parse.classify(read_lines(spark, corpus), ["text"])))
    timed("byte_encode", lambda: noop(encode_documents(sents, byte, keep=["doc_id"])))
    timed("index_build", lambda: noop(index.sequence_index(
        encode_documents(sents, byte, keep=["doc_id"]), order_col="doc_id")))
    out = scratch_dir(spark, "bench-ds")

    def write():
        enc = encode_documents(sents, byte, keep=["doc_id"])
        # docs are range-partitioned by doc_id: one part per partition, no shuffle
        write_binidx(enc.withColumn("part", F.spark_partition_id().cast("long"))
                     .select("part", "token_ids", "sentence_lens"), out)
    timed("binidx_write", write)
    timed("binidx_read", lambda: noop(read_binidx(spark, out)))
    timed("bpe_row", lambda: noop(encode_documents(docs.select("doc_id", F.array("text").alias("sentences")),
                                                   bpe_tok, keep=["doc_id"])))

    def bpe_dict():
        from corpusloom.functions.bpe import PieceEncoder
        from corpusloom.functions.dictionary import encode_by_dictionary
        from corpusloom.operators.text import pretokenize_gpt2
        noop(encode_by_dictionary(docs, "doc_id", "text", PieceEncoder(bpe_tok), pretokenize_gpt2))
    timed("bpe_dictionary", bpe_dict)

    def build():
        from corpusloom.plans.build import build_corpus
        from corpusloom.spec import CorpusSpec, TokenizerSpec
        build_corpus(spark, CorpusSpec(corpus, os.path.join(scratch_dir(spark, "bench-build"), "c"),
                                       TokenizerSpec("byte"), merge_partitions=True))
    timed("build_corpus", build)

    def reshard():
        from corpusloom.operators.reshard import reshard as rs
        rs(spark, [out], [scratch_dir(spark, "bench-rs-a"), scratch_dir(spark, "bench-rs-b")], 4,
           target=4 << 20)
    timed("reshard", reshard)
    timed("chatml", lambda: noop(chat.collect_turns(table(spark, sf_dir, "conversations"))
                                 .select("conv_id", chat.render_chatml(F.col("msgs")).alias("t"))))
    return times, (n_docs, n_chars, n_bytes)


def main():
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    spark = build_session(master=f"local[{cpus}]", shuffle_partitions=max(8, cpus))
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    warm = os.environ.get("BENCH_WARMUP_DIR", "/root/testdata/sf0.001")
    if warm and os.path.isdir(warm) and os.path.abspath(warm) != os.path.abspath(sf_dir):
        run_suite(spark, warm)  # JVM JIT and Python worker warm-up; not reported
    times, (n_docs, n_chars, n_bytes) = run_suite(spark, sf_dir)
    total = round(sum(times.values()), 3)
    print(json.dumps({
        "metric": "total_sec", "value": total, "unit": "sec", "queries": times, "sf": sf,
        "cpus": cpus, "warmup": warm, "documents": n_docs, "chars": n_chars, "bytes": n_bytes,
        "byte_encode_docs_per_sec": round(n_docs / times["byte_encode"], 1),
        "byte_encode_mb_per_sec": round(n_bytes / 2 ** 20 / times["byte_encode"], 2),
        "build_corpus_mb_per_sec": round(n_bytes / 2 ** 20 / times["build_corpus"], 2),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
