"""Registered queries of builds: many files, list columns, quarantine, order."""

from __future__ import annotations

import glob
import os

from pyspark.sql import Window
from pyspark.sql import functions as F

from corpusloom.operators import parse, text
from corpusloom.operators.reshard import reshard
from corpusloom.plans.build import build_corpus, write_split_sentences
from corpusloom.plans.catalog import _LINE_ORDER, _long
from corpusloom.plans.fixtures import documents_jsonl, events_jsonl, rename_to_jsonl, table
from corpusloom.session import scratch_dir
from corpusloom.sources.binidx import read_binidx, write_binidx
from corpusloom.sources.corpus import _raw_scan, read_lines, with_line_ids
from corpusloom.spec import CorpusSpec, TokenizerSpec

FILE_DOCS = 64  # documents of a file


def q_rebuild_files(spark, sf_dir):
    """One dataset per file over many files, built from the documents with
    even ids, then built again from all of them."""
    src, out = scratch_dir(spark, "files-in"), os.path.join(scratch_dir(spark, "files-out"), "c")
    docs = table(spark, sf_dir, "documents").withColumn("file", F.expr(f"doc_id div {FILE_DOCS}"))
    spec = CorpusSpec(src, out, TokenizerSpec("byte"), per_file=True)
    for half in ("doc_id % 2 = 0", "true"):
        (docs.where(half).select(F.to_json(F.struct("text")).alias("value"), "file", "doc_id").repartition("file")
         .sortWithinPartitions("file", "doc_id").drop("doc_id").write.mode("overwrite").partitionBy("file").text(src))
        rename_to_jsonl(spark, src)
        res = build_corpus(spark, spec)
    r = read_binidx(spark, ",".join(sorted(res["files"].values())), columns="index")
    return r.select(F.regexp_extract("prefix", r"file=(\d+)", 1).cast("long").alias("file"), F.col("file_seq").cast("long").alias("seq"),
                    F.col("length").cast("long").alias("length"))


SQL_REBUILD_FILES = f"""
SELECT doc_id // {FILE_DOCS} AS file, (row_number() OVER (PARTITION BY doc_id // {FILE_DOCS} ORDER BY doc_id) - 1)::BIGINT AS seq,
       (octet_length(encode(text)) + 1)::BIGINT AS length FROM documents WHERE octet_length(encode(text)) > 0
"""


def q_parquet_list_corpus(spark, sf_dir):
    """A list column (the lines of each document) over several Parquet files."""
    src = scratch_dir(spark, "list-corpus")
    (table(spark, sf_dir, "documents").repartitionByRange(6, "doc_id").sortWithinPartitions("doc_id")
     .select(F.split("text", "\n").alias("lines")).write.mode("overwrite").parquet(src))
    res = build_corpus(spark, CorpusSpec(src, os.path.join(scratch_dir(spark, "list-out"), "c"), TokenizerSpec("byte"),
                                         json_keys=["lines"], input_format="parquet"))
    return read_binidx(spark, res["lines"], columns="index").select(*_long("doc_id", "sent_pos", "length"))


SQL_PARQUET_LIST_CORPUS = """
WITH w AS (SELECT (row_number() OVER (ORDER BY doc_id) - 1)::BIGINT AS doc_id, string_split(text, chr(10)) AS l FROM documents),
u AS (SELECT doc_id, unnest(l) AS s, generate_subscripts(l, 1) AS i FROM w),
k AS (SELECT doc_id, i, octet_length(encode(s)) AS n FROM u WHERE s <> '')
SELECT doc_id, (row_number() OVER (PARTITION BY doc_id ORDER BY i) - 1)::BIGINT AS sent_pos,
       (n + CASE WHEN i = max(i) OVER (PARTITION BY doc_id) THEN 1 ELSE 0 END)::BIGINT AS length FROM k
"""


def q_quarantine(spark, sf_dir):
    """SN5: a build sets rejected lines aside, with their reason and place."""
    src, aside = events_jsonl(spark, sf_dir), scratch_dir(spark, "aside")
    build_corpus(spark, CorpusSpec(src, os.path.join(scratch_dir(spark, "aside-out"), "c"), TokenizerSpec("byte"), quarantine_path=aside))
    return spark.read.parquet(aside).select(F.col("line_id").cast("long").alias("line_id"), "reason", F.md5("value").alias("value_md5"))


_BAD = """SELECT *, event_id % 8 AS m, (row_number() OVER (ORDER BY event_id) - 1)::BIGINT AS line_id FROM events"""
SQL_QUARANTINE = f"""
SELECT line_id, CASE m WHEN 5 THEN 'bad_type' WHEN 6 THEN 'not_object' ELSE 'bad_json' END AS reason,
       md5(CASE m WHEN 4 THEN props || props WHEN 5 THEN '{{"text": ' || user_id || '}}' WHEN 6 THEN '[' || props || ']'
           ELSE substr(props, 1, length(props) - 1) END) AS value_md5 FROM ({_BAD}) WHERE m >= 4
"""


def q_interval_stats(spark, sf_dir):
    """A5: lines, accepted lines, characters and bytes of every 1,000 lines."""
    cls = parse.classify(read_lines(spark, events_jsonl(spark, sf_dir)), ["text"])
    return parse.interval_stats(cls, 1000).select(*_long("interval", "lines", "accepted", "chars", "bytes"))


SQL_INTERVAL_STATS = f"""
SELECT line_id // 1000 AS interval, count(*)::BIGINT AS lines, count(*) FILTER (WHERE m < 4)::BIGINT AS accepted,
       sum(length(v))::BIGINT AS chars, sum(octet_length(encode(v)))::BIGINT AS bytes
FROM (SELECT line_id, m, CASE m WHEN 0 THEN '{{"text": "' || event_type || '", "p": ' || props || '}}'
        WHEN 1 THEN '{{"text": ["' || event_type || '", "' || user_id || '"]}}' WHEN 2 THEN '{{"text": null, "v": ' || value || '}}'
        WHEN 3 THEN props WHEN 4 THEN props || props WHEN 5 THEN '{{"text": ' || user_id || '}}' WHEN 6 THEN '[' || props || ']'
        ELSE substr(props, 1, length(props) - 1) END AS v FROM ({_BAD})) GROUP BY 1
"""


def q_split_order(spark, sf_dir):
    """SN3: every sentence of the split corpus, with its line and its place."""
    out = scratch_dir(spark, "split-order")
    write_split_sentences(spark, CorpusSpec(documents_jsonl(spark, sf_dir), ""), out)
    lines = with_line_ids(_raw_scan(spark.read, out, "text"))
    sents = lines.select("line_id", F.posexplode(F.from_json("value", "text array<string>")["text"]).alias("pos", "s"))
    return sents.select(*_long("line_id", "pos"), F.md5("s").alias("sentence_md5"))


SQL_SPLIT_ORDER = f"""
WITH p AS (SELECT (row_number() OVER (ORDER BY {_LINE_ORDER}) - 1)::BIGINT AS line_id,
                  list_filter(list_transform(regexp_extract_all(text, '{text.SENTENCE_PATTERN}'),
                    lambda x: regexp_replace(x, '^{text.WS}+|{text.WS}+$', '', 'g')), lambda x: length(x) > 0) AS s FROM documents)
SELECT line_id, unnest(range(len(s)))::BIGINT AS pos, md5(unnest(s)) AS sentence_md5 FROM p
"""


def q_shard_order(spark, sf_dir):
    """O2: sequences that carry the number of their document, resharded: inside a
    shard they keep the order of the sources."""
    src, out = scratch_dir(spark, "numbered"), scratch_dir(spark, "ordered")
    docs = table(spark, sf_dir, "documents")
    ids = F.array(F.expr("CAST(doc_id % 60000 AS INT)"), F.expr("CAST(doc_id div 60000 AS INT)"))
    rows = docs.select(F.expr("doc_id div 128").alias("part"), "doc_id", F.concat(ids, F.array_repeat(F.lit(1), F.expr("CAST(doc_id % 50 AS INT)"))).alias("token_ids"))
    rows = rows.repartition("part").sortWithinPartitions("part", "doc_id")
    write_binidx(rows.select("part", "token_ids", F.array(F.size("token_ids")).alias("sentence_lens")), src)
    reshard(spark, [src], [out], 3, target=2048)
    files = sorted(p[:-4] for p in glob.glob(os.path.join(out, "*", "*_final.idx")))
    back = read_binidx(spark, ",".join(files)).select("prefix", "file_seq", (F.col("tokens")[0] + F.col("tokens")[1] * 60000).cast("long").alias("doc_id"))
    before = F.lag("doc_id").over(Window.partitionBy("prefix").orderBy("file_seq"))
    return back.select("doc_id", F.coalesce(before < F.col("doc_id"), F.lit(True)).alias("in_order"))


SQL_SHARD_ORDER = "SELECT doc_id, true AS in_order FROM documents"

QUERIES = {
    "rebuild_files": (q_rebuild_files, SQL_REBUILD_FILES),
    "parquet_list_corpus": (q_parquet_list_corpus, SQL_PARQUET_LIST_CORPUS),
    "quarantine": (q_quarantine, SQL_QUARANTINE),
    "interval_stats": (q_interval_stats, SQL_INTERVAL_STATS),
    "split_order": (q_split_order, SQL_SPLIT_ORDER),
    "shard_order": (q_shard_order, SQL_SHARD_ORDER),
}
