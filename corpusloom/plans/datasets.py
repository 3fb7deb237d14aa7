"""Registered queries over written datasets: catalogue, point reads, resume."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from corpusloom.functions.base import encode_documents
from corpusloom.operators import lookup
from corpusloom.operators.index import global_rank
from corpusloom.operators.merge import gather_table
from corpusloom.operators.occurrence import REENTRY, held_chunks
from corpusloom.operators.reshard import chunk_table
from corpusloom.plans.catalog import (BYTES, CHUNK_TARGET, ITEM, PART_DOCS, SQL_CHUNKS, _SEQ_CTE, _chunk_cols, _long, _sum_ids,
                                      _written_dataset, table)
from corpusloom.session import checkpoint, scratch_dir
from corpusloom.sources.binidx import read_binidx, write_binidx
from corpusloom.sources.catalogue import catalogue, read_sequences


def q_dataset_catalogue(spark, sf_dir):
    """S3 + S10: one row per part of the written dataset, bases re-based over all parts."""
    parts = catalogue(spark, _written_dataset(spark, sf_dir))
    part = F.regexp_extract("prefix", r"part-(\d+)$", 1).cast("long").alias("part")
    return parts.select(part, *_long("n_seq", "n_docs", "bin_size", "seq_base", "doc_base"))


SQL_DATASET_CATALOGUE = f"""
WITH {_SEQ_CTE},
d AS (SELECT doc_id // {PART_DOCS} AS part, count(*) AS n_docs FROM documents GROUP BY 1),
z AS (SELECT doc_id // {PART_DOCS} AS part, count(*) AS n_seq, sum(length) * {ITEM} AS bin_size FROM q GROUP BY 1),
p AS (SELECT part, coalesce(n_seq, 0)::BIGINT AS n_seq, n_docs, coalesce(bin_size, 0)::BIGINT AS bin_size FROM d LEFT JOIN z USING (part))
SELECT part::BIGINT AS part, n_seq, n_docs::BIGINT AS n_docs, bin_size,
       coalesce(sum(n_seq) OVER w, 0)::BIGINT AS seq_base, coalesce(sum(n_docs) OVER w, 0)::BIGINT AS doc_base FROM p
WINDOW w AS (ORDER BY part ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
"""


def q_catalogue_scan(spark, sf_dir):
    """Every sequence, read by ranges that the catalogue plans (small ranges, so that parts are cut)."""
    r = read_sequences(spark, _written_dataset(spark, sf_dir), bytes_per_range=1 << 20)
    return r.select(*_long("seq_id", "sent_pos", "length"), _sum_ids(F.col("tokens")).alias("tok_sum"))


SQL_CATALOGUE_SCAN = f"WITH {_SEQ_CTE} SELECT seq_id, sent_pos, length, tok_sum FROM q"


def q_seq_seek(spark, sf_dir):
    """J3 by point reads: up to nine tokens of each document's middle sequence,
    from its second token on (the whole sequence if it has one token)."""
    path = _written_dataset(spark, sf_dir)
    docs = read_binidx(spark, path, table="documents").where("seq_end > seq_begin")
    middle = docs.select(F.expr("(seq_begin + seq_end) div 2").alias("seq_id"))
    sizes = read_binidx(spark, path, columns="index").select("seq_id", "length")
    wanted = sizes.join(middle, "seq_id").select(
        "seq_id", F.when(F.col("length") > 1, 1).otherwise(0).alias("offset"),
        F.when(F.col("length") > 10, 9).alias("length"))
    got = lookup.seek_tokens(spark, path, wanted)
    return got.select("seq_id", "offset", F.array_join("tokens", " ").alias("tokens"))


SQL_SEQ_SEEK = f"""
WITH {_SEQ_CTE},
m AS (SELECT doc_id, (min(seq_id) + max(seq_id) + 1) // 2 AS seq_id FROM q GROUP BY doc_id),
x AS (SELECT doc_id, unnest(sl) AS s, unnest(range(len(sl)))::BIGINT AS sent_pos,
             unnest(list_transform(sl, lambda v, i: i = len(sl))) AS last FROM s),
t AS (SELECT q.seq_id, list_transform(regexp_extract_all(hex(encode(x.s)), '..'), lambda h: ('0x' || h)::BIGINT + 1)
             || CASE WHEN x.last THEN [{BYTES.eod}::BIGINT] ELSE [] END AS toks
      FROM m JOIN q ON q.seq_id = m.seq_id JOIN x ON x.doc_id = q.doc_id AND x.sent_pos = q.sent_pos)
SELECT seq_id, CASE WHEN len(toks) > 1 THEN 1 ELSE 0 END::BIGINT AS offset,
       array_to_string(CASE WHEN len(toks) > 10 THEN toks[2:10] WHEN len(toks) > 1 THEN toks[2:] ELSE toks END, ' ') AS tokens FROM t
"""


def q_resume_foreign(spark, sf_dir):
    """R8 without a manifest: two outputs hold the chunks in turn, both hold the
    first one, and the first output has the benchmark items in its middle. Every
    chunk is found, each once."""
    source, other = _written_dataset(spark, sf_dir), scratch_dir(spark, "foreign")
    items = table(spark, sf_dir, "benchmark").select("item_id", F.split("text", " ").alias("sentences"))
    enc = encode_documents(items, BYTES, keep=["item_id"]).repartition(1).sortWithinPartitions("item_id")
    write_binidx(enc.select(F.lit(0).cast("long").alias("part"), "token_ids", "sentence_lens"), other)
    chunks = checkpoint(chunk_table(spark, [source], CHUNK_TARGET))
    strange = chunk_table(spark, [other], 1 << 62)
    folder = scratch_dir(spark, "claimed")
    # chunks that the walk may enter at again stand behind the foreign sequences
    numbered = global_rank(chunks, ["src_path", "start_doc"], "k")
    pieces = (numbered.select("*", F.when(F.col("k") % 2 == 0, "a").otherwise("b").alias("to"), (F.col("num_docs") >= REENTRY).cast("int").alias("at"))
              .unionByName(numbered.where("k = 0").select("*", F.lit("a").alias("to"), F.lit(2).alias("at")))
              .unionByName(strange.select("*", F.lit(0).cast("long").alias("k"), F.lit("a").alias("to"), F.lit(1).alias("at"))))
    before = Window.partitionBy("out").orderBy("at", "k").rowsBetween(Window.unboundedPreceding, -1)
    base = lambda c: F.coalesce(F.sum(c).over(before), F.lit(0))
    plan = pieces.select(F.concat(F.lit(f"{folder}/data_"), F.col("to"), F.lit("_final")).alias("out"), F.col("src_path").alias("prefix"), "dtype",
                         F.col("start_doc").alias("lo"), F.col("end_doc").alias("hi"), "at", "k", F.col("num_docs").alias("n_seq"),
                         F.col("byte_size").alias("n_bytes"), F.col("index_docs").alias("n_docs"))
    plan = checkpoint(plan.select("*", base("n_seq").alias("seq_base"), base("n_bytes").alias("byte_base"), base("n_docs").alias("doc_base")).drop("at", "k"))
    outputs = gather_table(spark, plan, documents="sequence")
    held = held_chunks(spark, chunks, list(outputs))
    return _chunk_cols(chunks.join(held.withColumnRenamed("chunk_id", "id"), "id"))


QUERIES = {
    "dataset_catalogue": (q_dataset_catalogue, SQL_DATASET_CATALOGUE),
    "catalogue_scan": (q_catalogue_scan, SQL_CATALOGUE_SCAN),
    "seq_seek": (q_seq_seek, SQL_SEQ_SEEK),
    "resume_foreign": (q_resume_foreign, SQL_CHUNKS),
}
