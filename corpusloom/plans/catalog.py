"""Registered queries (one per operator family of the survey) and their
DuckDB oracle SQL.

Every query reads the given tables (or data Spark derives from them) in full
and returns a DataFrame whose column names equal the oracle's. Integer
results are BIGINT on both sides.
"""

from __future__ import annotations

import math
import os

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from corpusloom.functions.base import decode_column, encode_documents
from corpusloom.functions.byte_level import ByteTokenizer
from corpusloom.functions.null import null_decode_expr, null_encode_expr
from corpusloom.operators import chat, index, lookup, parse, partition, text
from corpusloom.operators.parallel import balance
from corpusloom.plans.fixtures import BUCKET_DOCS, documents_jsonl, events_jsonl, rename_to_jsonl, table
from corpusloom.session import checkpoint, scratch_dir
from corpusloom.sources.binidx import read_binidx, write_binidx
from corpusloom.sources.corpus import read_lines

# Fixed parameters of the registered queries.
EOD = 65532          # end-of-document id of the byte vocabulary family
NULL_VOCAB = 1000000  # vocabulary size of the whitespace-integer tokenizer
N_PARTS = 4          # partitions for R1/R2 (the reference's partition count)
ITEM = 2             # uint16 item size
SLICE = 500          # slice length for P5 on pages
PAD_BATCH = 8        # conversations per padding batch
CONV_MAX = 2048      # ids kept per conversation (O5)
GLM_BASE = 257       # GLM special ids follow the 256 byte ids (ids 1..256)
CHUNK_TARGET = 65536  # R5 target bytes in the registered query
PART_DOCS = 256      # documents per part of the written dataset fixture

BYTES = ByteTokenizer(eod=EOD)
NL = "chr(10)"


def _long(*cols):
    return [F.col(c).cast("long").alias(c) for c in cols]


def _sum_ids(c):
    return F.aggregate(c, F.lit(0).cast("long"), lambda a, x: a + x.cast("long"))


def _wsum_ids(c):
    return F.aggregate(F.transform(c, lambda x, i: x.cast("long") * (i + 1)),
                       F.lit(0).cast("long"), lambda a, x: a + x)


# ---------------------------------------------------------------------------
# shared pieces

def _line_sentences(spark, sf_dir) -> DataFrame:
    """documents, sentence mode with newline-separated sentences, byte ids."""
    docs = table(spark, sf_dir, "documents")
    return encode_documents(docs.select("doc_id", F.split("text", "\n").alias("sentences")),
                            BYTES, keep=["doc_id"])


def _parts(df: DataFrame, id_col: str) -> DataFrame:
    """Rows grouped into parts of PART_DOCS consecutive ids, each written by
    one task in id order (bounded groups, many parallel writers)."""
    return (df.withColumn("part", F.expr(f"{id_col} div {PART_DOCS}")).repartition("part")
            .sortWithinPartitions("part", id_col).select("part", "token_ids", "sentence_lens"))


def _written_dataset(spark, sf_dir) -> str:
    """Sentence-level byte dataset written as binidx parts; part p holds the
    documents ``p*PART_DOCS <= doc_id < (p+1)*PART_DOCS`` (bounded groups)."""
    docs = table(spark, sf_dir, "documents")
    enc = encode_documents(docs.select("doc_id", F.split("text", "\n").alias("sentences")),
                           BYTES, keep=["doc_id"])
    parts = (enc.withColumn("part", F.expr(f"doc_id div {PART_DOCS}"))
             .repartition("part").sortWithinPartitions("part", "doc_id"))
    out = scratch_dir(spark, "bytes-ds")
    write_binidx(parts.select("part", "token_ids", "sentence_lens"), out, dtype="uint16")
    return out


# SQL fragments for the byte vocabulary in DuckDB
_SENT_LENS = (f"list_filter(list_transform(string_split(text, {NL}), "
              "lambda x: octet_length(encode(x))::BIGINT), lambda n: n > 0)")
_SENTS = f"list_filter(string_split(text, {NL}), lambda x: octet_length(encode(x)) > 0)"
_BYTE_IDS = "list_transform(regexp_extract_all(hex(encode({x})), '..'), lambda h: ('0x' || h)::BIGINT + 1)"

_SEQ_CTE = f"""
s AS (SELECT doc_id, {_SENTS} AS sl FROM documents),
e AS (SELECT doc_id, sl, list_transform(sl, lambda x, i: octet_length(encode(x))::BIGINT
        + CASE WHEN i = len(sl) THEN 1 ELSE 0 END) AS l,
        list_transform(sl, lambda x, i: list_sum({_BYTE_IDS.format(x='x')})
        + CASE WHEN i = len(sl) THEN {EOD} ELSE 0 END) AS ts FROM s),
u AS (SELECT doc_id, unnest(l) AS length, unnest(ts)::BIGINT AS tok_sum,
        unnest(range(len(l)))::BIGINT AS sent_pos FROM e),
q AS (SELECT doc_id, sent_pos, length, tok_sum,
        (row_number() OVER (ORDER BY doc_id, sent_pos) - 1)::BIGINT AS seq_id,
        (coalesce(sum(length) OVER (ORDER BY doc_id, sent_pos
          ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) * {ITEM})::BIGINT AS ptr FROM u)
"""


# ---------------------------------------------------------------------------
# M1 scan + parse

def q_corpus_scan(spark, sf_dir):
    lines = read_lines(spark, documents_jsonl(spark, sf_dir))
    cls = parse.classify(lines, ["text"])
    return cls.where(F.col("reason").isNull()).select(
        *_long("line_id", "file_rank", "line_no"), F.element_at("text", 1).alias("text"))


# Line order of the documents JSONL fixture: sorted path (lang=xx/bucket=k,
# compared as text), then doc_id.
_FILE = f"lang, CAST(doc_id // {BUCKET_DOCS} AS VARCHAR)"
_LINE_ORDER = f"{_FILE}, doc_id"

SQL_CORPUS_SCAN = f"""
SELECT (row_number() OVER (ORDER BY {_LINE_ORDER}) - 1)::BIGINT AS line_id,
       (dense_rank() OVER (ORDER BY {_FILE}) - 1)::BIGINT AS file_rank,
       (row_number() OVER (PARTITION BY {_FILE} ORDER BY doc_id) - 1)::BIGINT AS line_no,
       text
FROM documents
"""


def q_json_validate(spark, sf_dir):
    cls = parse.classify(read_lines(spark, events_jsonl(spark, sf_dir)), ["text"])
    return cls.select(F.col("line_id").cast("long").alias("line_id"), "reason",
                      F.when(F.col("reason").isNull(), F.array_join("text", "|")).alias("sentences"))


SQL_JSON_VALIDATE = """
SELECT (row_number() OVER (ORDER BY event_id) - 1)::BIGINT AS line_id,
  CASE event_id % 8 WHEN 4 THEN 'bad_json' WHEN 7 THEN 'bad_json' WHEN 5 THEN 'bad_type'
       WHEN 6 THEN 'not_object' ELSE NULL END AS reason,
  CASE event_id % 8 WHEN 0 THEN event_type WHEN 1 THEN event_type || '|' || user_id::VARCHAR
       WHEN 2 THEN '' WHEN 3 THEN '' ELSE NULL END AS sentences
FROM events
"""


def q_first_bad_line(spark, sf_dir):
    cls = parse.classify(read_lines(spark, events_jsonl(spark, sf_dir)), ["text"])
    return parse.first_bad_line(cls).select(F.col("line_id").cast("long").alias("line_id"), "reason")


SQL_FIRST_BAD_LINE = """
SELECT line_id, reason FROM (
  SELECT (row_number() OVER (ORDER BY event_id) - 1)::BIGINT AS line_id,
    CASE event_id % 8 WHEN 4 THEN 'bad_json' WHEN 7 THEN 'bad_json' WHEN 5 THEN 'bad_type'
         WHEN 6 THEN 'not_object' ELSE NULL END AS reason FROM events)
WHERE reason IS NOT NULL ORDER BY line_id LIMIT 1
"""


def q_line_count(spark, sf_dir):
    from corpusloom.sources.corpus import line_count
    return line_count(read_lines(spark, events_jsonl(spark, sf_dir))).select(*_long("n_lines"))


SQL_LINE_COUNT = "SELECT count(*)::BIGINT AS n_lines FROM events"


def q_multi_key(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    long_form = docs.select("doc_id", F.expr(
        "stack(3, 'lang', array(lang), 'source', array(source), 'text', array(text)) as (key, sentences)"))
    enc = encode_documents(long_form, BYTES, keep=["doc_id", "key"])
    return enc.select(F.col("doc_id").cast("long"), "key", F.size("token_ids").cast("long").alias("n_tokens"))


SQL_MULTI_KEY = """
SELECT doc_id, key, (CASE WHEN octet_length(encode(v)) > 0 THEN octet_length(encode(v)) + 1 ELSE 0 END)::BIGINT AS n_tokens
FROM (SELECT doc_id, 'lang' AS key, lang AS v FROM documents
      UNION ALL SELECT doc_id, 'source', source FROM documents
      UNION ALL SELECT doc_id, 'text', text FROM documents)
"""


# ---------------------------------------------------------------------------
# M2 encode

def q_byte_encode(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    enc = encode_documents(docs.select("doc_id", F.array("text").alias("sentences")), BYTES, keep=["doc_id"])
    return enc.select(F.col("doc_id").cast("long"), F.size("token_ids").cast("long").alias("n_tokens"),
                      _sum_ids(F.col("token_ids")).alias("tok_sum"), _wsum_ids(F.col("token_ids")).alias("tok_wsum"))


SQL_BYTE_ENCODE = f"""
WITH b AS (SELECT doc_id, CASE WHEN octet_length(encode(text)) > 0
             THEN {_BYTE_IDS.format(x='text')} || [{EOD}::BIGINT] ELSE [] END AS ids FROM documents)
SELECT doc_id, len(ids)::BIGINT AS n_tokens, coalesce(list_sum(ids), 0)::BIGINT AS tok_sum,
       coalesce(list_sum(list_transform(ids, lambda x, i: x * i)), 0)::BIGINT AS tok_wsum FROM b
"""


def q_detokenize(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    enc = encode_documents(docs.select("doc_id", F.array("text").alias("sentences")), BYTES,
                           keep=["doc_id"], append_eod=False)
    return decode_column(enc.select("doc_id", "token_ids"), BYTES, "token_ids", "text").select(
        F.col("doc_id").cast("long"), "text")


SQL_DETOKENIZE = "SELECT doc_id, text FROM documents"


def q_null_encode(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem")
    txt = F.concat_ws(" ", "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber")
    ids = null_encode_expr(txt)
    ids = F.when(F.size(ids) > 0, F.concat(ids, F.array(F.lit(NULL_VOCAB)))).otherwise(ids)
    return li.select(F.col("l_orderkey").cast("long"), F.col("l_linenumber").cast("long"),
                     F.size(ids).cast("long").alias("n_tokens"), null_decode_expr(ids).alias("ids"))


SQL_NULL_ENCODE = f"""
SELECT l_orderkey::BIGINT AS l_orderkey, l_linenumber::BIGINT AS l_linenumber, 5::BIGINT AS n_tokens,
       concat_ws(' ', l_orderkey, l_partkey, l_suppkey, l_linenumber, {NULL_VOCAB}) AS ids
FROM lineitem
"""


def q_eod_lengths(spark, sf_dir):
    enc = _line_sentences(spark, sf_dir)
    return enc.select(F.col("doc_id").cast("long"), F.size("sentence_lens").cast("long").alias("n_sents"),
                      F.array_join("sentence_lens", ",").alias("lens"),
                      F.size("token_ids").cast("long").alias("n_tokens"))


SQL_EOD_LENGTHS = f"""
WITH s AS (SELECT doc_id, {_SENT_LENS} AS l FROM documents)
SELECT doc_id, len(l)::BIGINT AS n_sents,
  CASE WHEN len(l) = 0 THEN '' ELSE array_to_string(list_transform(l, lambda x, i:
       CASE WHEN i = len(l) THEN x + 1 ELSE x END), ',') END AS lens,
  (coalesce(list_sum(l), 0) + CASE WHEN len(l) > 0 THEN 1 ELSE 0 END)::BIGINT AS n_tokens
FROM s
"""


def q_id_range(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    enc = encode_documents(docs.select("doc_id", F.array("text").alias("sentences")), BYTES, keep=["doc_id"])
    r = index.id_range(enc)
    width = F.when(F.col("max_id") < 65536, F.lit("uint16")).otherwise(F.lit("int32"))
    return r.select(*_long("min_id", "max_id"), width.alias("width"))


SQL_ID_RANGE = f"""
SELECT min(b)::BIGINT AS min_id, {EOD}::BIGINT AS max_id, 'uint16' AS width FROM (
  SELECT unnest({_BYTE_IDS.format(x='text')}) AS b FROM documents)
"""


# ---------------------------------------------------------------------------
# M3 index

def q_index_build(spark, sf_dir):
    seq = index.sequence_index(_line_sentences(spark, sf_dir), order_col="doc_id", itemsize=ITEM)
    return seq.select(*_long("doc_id", "sent_pos", "seq_id", "length", "ptr"))


SQL_INDEX_BUILD = f"WITH {_SEQ_CTE} SELECT doc_id, sent_pos, seq_id, length, ptr FROM q"


def q_doc_bounds(spark, sf_dir):
    d = index.document_index(_line_sentences(spark, sf_dir), order_col="doc_id")
    return d.select(*_long("doc_id", "seq_begin", "seq_end"))


SQL_DOC_BOUNDS = f"""
WITH s AS (SELECT doc_id, len({_SENT_LENS})::BIGINT AS n FROM documents)
SELECT doc_id, coalesce(sum(n) OVER (ORDER BY doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS seq_begin,
       sum(n) OVER (ORDER BY doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)::BIGINT AS seq_end
FROM s
"""


def q_seq_documents(spark, sf_dir):
    enc = _line_sentences(spark, sf_dir)
    seqs = index.sequence_index(enc, order_col="doc_id").select("seq_id")
    docs = index.document_index(enc, order_col="doc_id")
    return lookup.sequence_documents(seqs, docs).select(*_long("seq_id", "doc_id"))


SQL_SEQ_DOCUMENTS = f"WITH {_SEQ_CTE} SELECT seq_id, doc_id FROM q"


def q_dataset_summary(spark, sf_dir):
    return index.dataset_summary(_line_sentences(spark, sf_dir), itemsize=ITEM)


SQL_DATASET_SUMMARY = f"""
WITH {_SEQ_CTE}
SELECT (SELECT count(*) FROM documents)::BIGINT AS n_documents, count(*)::BIGINT AS n_sequences,
       sum(length)::BIGINT AS n_tokens, (sum(length) * {ITEM})::BIGINT AS n_bytes FROM q
"""


def q_token_offsets(spark, sf_dir):
    seq = index.sequence_index(_line_sentences(spark, sf_dir), order_col="doc_id", itemsize=ITEM)
    return index.token_offsets(seq, "doc_id").select(*_long("seq_id", "tok_offset"))


SQL_TOKEN_OFFSETS = f"""
WITH {_SEQ_CTE}
SELECT seq_id, coalesce(sum(length) OVER (PARTITION BY doc_id ORDER BY sent_pos
         ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS tok_offset FROM q
"""


# ---------------------------------------------------------------------------
# M4 files

def q_binidx_roundtrip(spark, sf_dir):
    r = read_binidx(spark, _written_dataset(spark, sf_dir))
    return r.select(*_long("seq_id", "doc_id", "sent_pos", "length"), _sum_ids(F.col("tokens")).alias("tok_sum"))


SQL_BINIDX_ROUNDTRIP = f"WITH {_SEQ_CTE} SELECT seq_id, doc_id, sent_pos, length, tok_sum FROM q"


def q_index_scan(spark, sf_dir):
    r = read_binidx(spark, _written_dataset(spark, sf_dir), columns="index")
    return r.select(*_long("seq_id", "doc_id", "length", "ptr"))


def _sql_part_ptr() -> str:
    return f"""
WITH {_SEQ_CTE}, n AS (SELECT count(*) AS n FROM documents)
SELECT seq_id, doc_id, length,
  (coalesce(sum(length) OVER (PARTITION BY doc_id // {PART_DOCS}
     ORDER BY seq_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) * {ITEM})::BIGINT AS ptr
FROM q
"""


SQL_INDEX_SCAN = _sql_part_ptr()


def q_documents_scan(spark, sf_dir):
    r = read_binidx(spark, _written_dataset(spark, sf_dir), table="documents")
    return r.select(*_long("doc_id", "seq_begin", "seq_end"))


SQL_DOCUMENTS_SCAN = SQL_DOC_BOUNDS


def q_merge_datasets(spark, sf_dir):
    from corpusloom.operators.merge import merge_binidx
    src = _written_dataset(spark, sf_dir)
    out = os.path.join(scratch_dir(spark, "merged"), "merged_text_sentence")
    merge_binidx(spark, [src], out)
    r = read_binidx(spark, out)
    return r.select(*_long("seq_id", "doc_id", "length", "ptr"), _sum_ids(F.col("tokens")).alias("tok_sum"))


SQL_MERGE_DATASETS = f"WITH {_SEQ_CTE} SELECT seq_id, doc_id, length, ptr, tok_sum FROM q"


def q_concat_corpora(spark, sf_dir):
    """Documents then benchmark, document level, read as one dataset."""
    outs = []
    for name, id_col in (("documents", "doc_id"), ("benchmark", "item_id")):
        t = table(spark, sf_dir, name)
        enc = encode_documents(t.select(F.col(id_col).alias("doc_id"), F.array("text").alias("sentences")),
                               BYTES, keep=["doc_id"])
        out = scratch_dir(spark, f"concat-{name}")
        write_binidx(_parts(enc, "doc_id"), out)
        outs.append(out)
    from corpusloom.operators.merge import concat_datasets
    r = concat_datasets(spark, outs, columns="index")
    return r.select(*_long("seq_id", "doc_id", "length"))


SQL_CONCAT_CORPORA = """
WITH a AS (SELECT 0 AS c, doc_id AS id, octet_length(encode(text)) AS n FROM documents
           UNION ALL SELECT 1, item_id, octet_length(encode(text)) FROM benchmark),
d AS (SELECT c, id, n, (row_number() OVER (ORDER BY c, id) - 1)::BIGINT AS doc_id FROM a)
SELECT (row_number() OVER (ORDER BY c, id) - 1)::BIGINT AS seq_id, doc_id, (n + 1)::BIGINT AS length
FROM d WHERE n > 0
"""


def q_embeddings_roundtrip(spark, sf_dir):
    emb = table(spark, sf_dir, "embeddings")
    out = scratch_dir(spark, "embeddings")
    docs = emb.select(F.col("vec_id"), F.col("embedding").alias("token_ids"),
                      F.array(F.size("embedding")).alias("sentence_lens"))
    write_binidx(_parts(docs, "vec_id"), out, dtype="float32")
    r = read_binidx(spark, out)
    micro = F.aggregate("tokens", F.lit(0).cast("long"),
                        lambda a, x: a + F.floor(x.cast("double") * 1000000).cast("long"))
    return r.select(F.col("doc_id").cast("long").alias("vec_id"), F.col("length").cast("long"),
                    micro.alias("val_micro"))


SQL_EMBEDDINGS_ROUNDTRIP = """
SELECT (row_number() OVER (ORDER BY vec_id) - 1)::BIGINT AS vec_id, len(embedding)::BIGINT AS length,
  list_sum(list_transform(embedding, lambda x: floor(x::DOUBLE * 1000000)::BIGINT))::BIGINT AS val_micro
FROM embeddings
"""


# ---------------------------------------------------------------------------
# M5 partition / merge order

def q_round_robin(spark, sf_dir):
    lines = read_lines(spark, documents_jsonl(spark, sf_dir))
    return partition.round_robin(lines, N_PARTS).select(*_long("line_id", "part_id", "part_pos"))


SQL_ROUND_ROBIN = f"""
SELECT line_id, line_id % {N_PARTS} AS part_id, line_id // {N_PARTS} AS part_pos
FROM (SELECT (row_number() OVER (ORDER BY {_LINE_ORDER}) - 1)::BIGINT AS line_id FROM documents)
"""


def q_sequential(spark, sf_dir):
    lines = read_lines(spark, documents_jsonl(spark, sf_dir))
    return partition.sequential(lines, N_PARTS).select(*_long("line_id", "part_id", "part_pos"))


SQL_SEQUENTIAL = f"""
WITH n AS (SELECT ((count(*) + {N_PARTS} - 1) // {N_PARTS})::BIGINT AS size FROM documents)
SELECT line_id, line_id // (SELECT size FROM n) AS part_id, line_id % (SELECT size FROM n) AS part_pos
FROM (SELECT (row_number() OVER (ORDER BY {_LINE_ORDER}) - 1)::BIGINT AS line_id FROM documents)
"""


def q_merge_order(spark, sf_dir):
    lines = read_lines(spark, documents_jsonl(spark, sf_dir))
    m = partition.merged_order(partition.round_robin(lines, N_PARTS))
    return m.select(*_long("line_id", "merged_id"))


SQL_MERGE_ORDER = f"""
SELECT line_id, (row_number() OVER (ORDER BY line_id % {N_PARTS}, line_id) - 1)::BIGINT AS merged_id
FROM (SELECT (row_number() OVER (ORDER BY {_LINE_ORDER}) - 1)::BIGINT AS line_id FROM documents)
"""


def q_per_file_keys(spark, sf_dir):
    root = documents_jsonl(spark, sf_dir)
    lines = read_lines(spark, root)
    return (lines.select(F.regexp_extract(partition.file_key("file_path", root), r"^(lang=[^/]*)", 1).alias("key"))
            .groupBy("key").agg(F.count(F.lit(1)).alias("n_lines")))


SQL_PER_FILE_KEYS = "SELECT 'lang=' || lang AS key, count(*)::BIGINT AS n_lines FROM documents GROUP BY lang"


# ---------------------------------------------------------------------------
# M7 sentences / slices / pre-tokens

def q_slice_text(spark, sf_dir):
    pages = table(spark, sf_dir, "pages")
    sl = text.slice_text(F.col("html"), SLICE)
    return pages.select(F.col("page_id").cast("long"), F.size(sl).cast("long").alias("n_slices"),
                        F.array_join(F.transform(sl, lambda s: F.length(s)), ",").alias("lens"),
                        F.array_join(sl, "").alias("joined"))


SQL_SLICE_TEXT = f"""
SELECT page_id::BIGINT AS page_id, len(sl)::BIGINT AS n_slices,
       array_to_string(list_transform(sl, lambda s: length(s)), ',') AS lens, array_to_string(sl, '') AS joined
FROM (SELECT page_id, CASE WHEN length(html) = 0 THEN [] ELSE
        list_transform(range(0, (length(html) + {SLICE} - 1) // {SLICE}), lambda i: substr(html, i * {SLICE} + 1, {SLICE}))
      END AS sl FROM pages)
"""


def q_split_sentences(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    s = text.split_values(F.array("text"))
    return docs.select(F.col("doc_id").cast("long"), F.size(s).cast("long").alias("n_sents"),
                       F.array_join(F.transform(s, lambda x: F.length(x)), ",").alias("lens"),
                       F.try_element_at(s, F.lit(-1)).alias("last"))


SQL_SPLIT_SENTENCES = f"""
WITH p AS (SELECT doc_id, list_filter(list_transform(regexp_extract_all(text, '{text.SENTENCE_PATTERN}'),
             lambda x: regexp_replace(x, '^{text.WS}+|{text.WS}+$', '', 'g')), lambda x: length(x) > 0) AS s
           FROM documents)
SELECT doc_id, len(s)::BIGINT AS n_sents, array_to_string(list_transform(s, lambda x: length(x)), ',') AS lens,
       s[len(s)] AS last FROM p
"""


def q_pretokens(spark, sf_dir):
    """The pieces themselves, separated by U+001F."""
    docs = table(spark, sf_dir, "documents")
    return docs.select(F.col("doc_id").cast("long"), F.array_join(text.pretokenize_gpt2(F.col("text")), "\x1f").alias("pieces"))


# The pattern's look-ahead in a form without one: a mark before the last of several
# white-space characters that something follows, then the same alternatives.
_PIECES_SQL = (r"list_filter(regexp_extract_all(regexp_replace(text, '(\s)(\s\S)', '\1' || chr(57344) || '\2', 'g'), "
               r"'''s|''t|''re|''ve|''m|''ll|''d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}\x{E000}]+|\s+|\x{E000}'), "
               "lambda x: x <> chr(57344))")
SQL_PRETOKENS = f"SELECT doc_id, coalesce(array_to_string({_PIECES_SQL}, chr(31)), '') AS pieces FROM documents"


def q_whitespace_tokens(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    w = text.whitespace_tokenize(F.col("text"))
    return docs.select(F.col("doc_id").cast("long"), F.size(w).cast("long").alias("n_words"),
                       F.array_join(w, " ").alias("words"))


SQL_WHITESPACE_TOKENS = """
SELECT doc_id, len(w)::BIGINT AS n_words, array_to_string(w, ' ') AS words
FROM (SELECT doc_id, list_filter(regexp_split_to_array(text, '\\s+'), lambda x: x <> '') AS w FROM documents)
"""


# ---------------------------------------------------------------------------
# M8 chat

def _convs(spark, sf_dir):
    return chat.collect_turns(table(spark, sf_dir, "conversations"))


def q_chatml(spark, sf_dir):
    return _convs(spark, sf_dir).select(F.col("conv_id").cast("long"), chat.render_chatml(F.col("msgs")).alias("text"))


SQL_CHATML = f"""
SELECT conv_id::BIGINT AS conv_id,
  CASE WHEN arg_min(role, turn) <> 'system'
       THEN '<|im_start|>system' || {NL} || 'You are a helpful assistant.<|im_end|>' || {NL} ELSE '' END
  || string_agg('<|im_start|>' || role || {NL} || text || '<|im_end|>' || {NL}, '' ORDER BY turn) AS text
FROM conversations GROUP BY conv_id
"""


def q_glm_render(spark, sf_dir):
    return _convs(spark, sf_dir).select(F.col("conv_id").cast("long"),
                                        chat.render_glm(F.col("msgs"), add_generation_prompt=True).alias("text"))


SQL_GLM_RENDER = f"""
SELECT conv_id::BIGINT AS conv_id,
  '[gMASK]sop' || string_agg('<|' || role || '|> ' || {NL} || ' ' || text, '' ORDER BY turn) || '<|assistant|>' AS text
FROM conversations GROUP BY conv_id
"""


def _turn_byte_ids(spark, sf_dir, col="text"):
    conv = table(spark, sf_dir, "conversations")
    from corpusloom.functions.base import encode_column
    return encode_column(conv.select("conv_id", "turn", "role", col), BYTES, col, "ids")


def q_conv_ids(spark, sf_dir):
    """C4: RWKV conversation ids: every turn's ids + eos (0), last CONV_MAX kept."""
    ids = chat.conversation_ids(_turn_byte_ids(spark, sf_dir), suffix=[0], max_len=CONV_MAX)
    return ids.select(F.col("conv_id").cast("long"), F.size("input_ids").cast("long").alias("n_ids"),
                      _sum_ids(F.col("input_ids")).alias("id_sum"), _wsum_ids(F.col("input_ids")).alias("id_wsum"))


SQL_CONV_IDS = f"""
WITH t AS (SELECT conv_id, turn, {_BYTE_IDS.format(x='text')} || [0::BIGINT] AS ids FROM conversations),
c AS (SELECT conv_id, flatten(list(ids ORDER BY turn)) AS l FROM t GROUP BY conv_id),
k AS (SELECT conv_id, CASE WHEN len(l) > {CONV_MAX} THEN l[len(l) - {CONV_MAX} + 1:] ELSE l END AS l FROM c)
SELECT conv_id::BIGINT AS conv_id, len(l)::BIGINT AS n_ids, list_sum(l)::BIGINT AS id_sum,
       list_sum(list_transform(l, lambda x, i: x * i))::BIGINT AS id_wsum FROM k
"""


def q_glm_chat_ids(spark, sf_dir):
    """``[gMASK] sop`` + per turn (role id, ids("\\n"), ids(text)) + ``<|assistant|>``."""
    sp = chat.glm_special_ids(GLM_BASE)
    turns = _turn_byte_ids(spark, sf_dir)
    nl = F.array(F.lit(ord("\n") + 1))
    turns = turns.select("conv_id", "turn", chat.glm_turn_ids(F.col("role"), nl, F.col("ids"), sp).alias("ids"))
    ids = chat.conversation_ids(turns, prefix=[sp["[gMASK]"], sp["sop"]])
    ids = ids.select("conv_id", F.concat("input_ids", F.array(F.lit(sp["<|assistant|>"]))).alias("input_ids"))
    return ids.select(F.col("conv_id").cast("long"), F.size("input_ids").cast("long").alias("n_ids"),
                      _sum_ids(F.col("input_ids")).alias("id_sum"), _wsum_ids(F.col("input_ids")).alias("id_wsum"))


def _sql_glm_chat_ids():
    sp = chat.glm_special_ids(GLM_BASE)
    role = " ".join(f"WHEN '{r}' THEN {sp[f'<|{r}|>']}" for r in chat.GLM_ROLES)
    return f"""
WITH t AS (SELECT conv_id, turn, [(CASE role {role} END)::BIGINT, 11::BIGINT] || {_BYTE_IDS.format(x='text')} AS ids
           FROM conversations),
c AS (SELECT conv_id, [{sp['[gMASK]']}::BIGINT, {sp['sop']}::BIGINT] || flatten(list(ids ORDER BY turn))
        || [{sp['<|assistant|>']}::BIGINT] AS l FROM t GROUP BY conv_id)
SELECT conv_id::BIGINT AS conv_id, len(l)::BIGINT AS n_ids, list_sum(l)::BIGINT AS id_sum,
       list_sum(list_transform(l, lambda x, i: x * i))::BIGINT AS id_wsum FROM c
"""


SQL_GLM_CHAT_IDS = _sql_glm_chat_ids()


def q_pad_batch(spark, sf_dir):
    ids = chat.conversation_ids(_turn_byte_ids(spark, sf_dir), suffix=[0])
    ids = ids.withColumn("batch", F.expr(f"conv_id div {PAD_BATCH}"))
    p = chat.left_pad_batches(ids, "input_ids", "batch", pad_id=0)
    return p.select(F.col("conv_id").cast("long"), F.size("input_ids").cast("long").alias("padded_len"),
                    (F.size("input_ids") - _sum_ids(F.col("attention_mask"))).alias("n_pad"),
                    _wsum_ids(F.col("input_ids")).alias("id_wsum"),
                    F.element_at("position_ids", -1).cast("long").alias("last_pos"))


SQL_PAD_BATCH = f"""
WITH t AS (SELECT conv_id, turn, {_BYTE_IDS.format(x='text')} || [0::BIGINT] AS ids FROM conversations),
c AS (SELECT conv_id, flatten(list(ids ORDER BY turn)) AS l FROM t GROUP BY conv_id),
m AS (SELECT conv_id, l, max(len(l)) OVER (PARTITION BY conv_id // {PAD_BATCH}) AS mx FROM c)
SELECT conv_id::BIGINT AS conv_id, mx::BIGINT AS padded_len, (mx - len(l))::BIGINT AS n_pad,
       list_sum(list_transform(l, lambda x, i: x * (i + mx - len(l))))::BIGINT AS id_wsum,
       (len(l) - 1)::BIGINT AS last_pos FROM m
"""


def q_parse_output(spark, sf_dir):
    conv = table(spark, sf_dir, "conversations")
    meta = F.when(F.pmod(F.col("turn"), F.lit(3)) == 2, F.lit("search")).otherwise(F.lit(""))
    piece = F.concat(F.lit(chat.ASSISTANT_TAG), meta, F.lit("\n"), F.col("text"))
    outs = (conv.groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("turn", piece.alias("p")))).alias("_p"))
            .select("conv_id", F.array_join(F.transform("_p", lambda s: s["p"]), "").alias("output")))
    r = chat.parse_response(outs, "output", keep=["conv_id"])
    return r.select(*_long("conv_id", "pos"), "metadata", "content")


SQL_PARSE_OUTPUT = f"""
WITH o AS (SELECT conv_id, string_agg('<|assistant|>' || CASE WHEN turn % 3 = 2 THEN 'search' ELSE '' END
             || {NL} || text, '' ORDER BY turn) AS output FROM conversations GROUP BY conv_id),
p AS (SELECT conv_id, unnest(string_split(output, '<|assistant|>')) AS r,
             unnest(range(len(string_split(output, '<|assistant|>')))) AS pos FROM o),
m AS (SELECT conv_id, pos, CASE WHEN strpos(r, {NL}) > 0 THEN substr(r, 1, strpos(r, {NL}) - 1) ELSE '' END AS metadata,
             CASE WHEN strpos(r, {NL}) > 0 THEN substr(r, strpos(r, {NL}) + 1) ELSE r END AS content FROM p)
SELECT conv_id::BIGINT AS conv_id, pos::BIGINT AS pos, metadata,
  CASE WHEN regexp_replace(metadata, '^\\s+|\\s+$', '', 'g') = '' THEN regexp_replace(content, '^\\s+|\\s+$', '', 'g')
       ELSE content END AS content FROM m
"""


def q_pair_inputs(spark, sf_dir):
    """GLM pair layout of consecutive turns (user text, assistant text)."""
    conv = _turn_byte_ids(spark, sf_dir)
    sp = chat.glm_special_ids(GLM_BASE)
    a = conv.where(F.col("turn") % 2 == 0).select("conv_id", F.col("turn").alias("t"), F.col("ids").alias("a"))
    b = conv.where(F.col("turn") % 2 == 1).select("conv_id", (F.col("turn") - 1).alias("t"), F.col("ids").alias("b"))
    j = a.join(b, ["conv_id", "t"], "left")
    pre = [sp["[gMASK]"], sp["sop"]]
    ids = F.when(F.col("b").isNull(), chat.build_pair(F.col("a"), None, prefix=pre)).otherwise(
        chat.build_pair(F.col("a"), F.col("b"), prefix=pre, suffix=[EOD]))
    mask = F.when(F.col("b").isNull(), chat.special_tokens_mask(F.col("a"), None, 2)).otherwise(
        chat.special_tokens_mask(F.col("a"), F.col("b"), 2, 0, 1))
    return j.select(F.col("conv_id").cast("long"), F.col("t").cast("long").alias("turn"),
                    F.size(ids).cast("long").alias("n_ids"), _wsum_ids(ids).alias("id_wsum"),
                    _sum_ids(mask).alias("n_special"))


SQL_PAIR_INPUTS = f"""
WITH t AS (SELECT conv_id, turn, {_BYTE_IDS.format(x='text')} AS ids FROM conversations),
j AS (SELECT a.conv_id, a.turn, a.ids AS a, b.ids AS b FROM t a LEFT JOIN t b
        ON a.conv_id = b.conv_id AND b.turn = a.turn + 1 WHERE a.turn % 2 = 0),
l AS (SELECT conv_id, turn, CASE WHEN b IS NULL THEN [{GLM_BASE + 1}::BIGINT, {GLM_BASE + 3}::BIGINT] || a
        ELSE [{GLM_BASE + 1}::BIGINT, {GLM_BASE + 3}::BIGINT] || a || b || [{EOD}::BIGINT] END AS l,
        CASE WHEN b IS NULL THEN 2 ELSE 3 END AS n_special FROM j)
SELECT conv_id::BIGINT AS conv_id, turn::BIGINT AS turn, len(l)::BIGINT AS n_ids,
       list_sum(list_transform(l, lambda x, i: x * i))::BIGINT AS id_wsum, n_special::BIGINT AS n_special FROM l
"""


QUERIES = {
    "corpus_scan": (q_corpus_scan, SQL_CORPUS_SCAN),
    "json_validate": (q_json_validate, SQL_JSON_VALIDATE),
    "first_bad_line": (q_first_bad_line, SQL_FIRST_BAD_LINE),
    "line_count": (q_line_count, SQL_LINE_COUNT),
    "multi_key": (q_multi_key, SQL_MULTI_KEY),
    "byte_encode": (q_byte_encode, SQL_BYTE_ENCODE),
    "detokenize": (q_detokenize, SQL_DETOKENIZE),
    "null_encode": (q_null_encode, SQL_NULL_ENCODE),
    "eod_lengths": (q_eod_lengths, SQL_EOD_LENGTHS),
    "id_range": (q_id_range, SQL_ID_RANGE),
    "index_build": (q_index_build, SQL_INDEX_BUILD),
    "doc_bounds": (q_doc_bounds, SQL_DOC_BOUNDS),
    "seq_documents": (q_seq_documents, SQL_SEQ_DOCUMENTS),
    "dataset_summary": (q_dataset_summary, SQL_DATASET_SUMMARY),
    "token_offsets": (q_token_offsets, SQL_TOKEN_OFFSETS),
    "binidx_roundtrip": (q_binidx_roundtrip, SQL_BINIDX_ROUNDTRIP),
    "index_scan": (q_index_scan, SQL_INDEX_SCAN),
    "documents_scan": (q_documents_scan, SQL_DOCUMENTS_SCAN),
    "merge_datasets": (q_merge_datasets, SQL_MERGE_DATASETS),
    "concat_corpora": (q_concat_corpora, SQL_CONCAT_CORPORA),
    "embeddings_roundtrip": (q_embeddings_roundtrip, SQL_EMBEDDINGS_ROUNDTRIP),
    "round_robin": (q_round_robin, SQL_ROUND_ROBIN),
    "sequential": (q_sequential, SQL_SEQUENTIAL),
    "merge_order": (q_merge_order, SQL_MERGE_ORDER),
    "per_file_keys": (q_per_file_keys, SQL_PER_FILE_KEYS),
    "slice_text": (q_slice_text, SQL_SLICE_TEXT),
    "split_sentences": (q_split_sentences, SQL_SPLIT_SENTENCES),
    "pretokens": (q_pretokens, SQL_PRETOKENS),
    "whitespace_tokens": (q_whitespace_tokens, SQL_WHITESPACE_TOKENS),
    "chatml": (q_chatml, SQL_CHATML),
    "glm_render": (q_glm_render, SQL_GLM_RENDER),
    "conv_ids": (q_conv_ids, SQL_CONV_IDS),
    "glm_chat_ids": (q_glm_chat_ids, SQL_GLM_CHAT_IDS),
    "pad_batch": (q_pad_batch, SQL_PAD_BATCH),
    "parse_output": (q_parse_output, SQL_PARSE_OUTPUT),
    "pair_inputs": (q_pair_inputs, SQL_PAIR_INPUTS),
}


# ---------------------------------------------------------------------------
# M6 vocabulary tokenizers

def _docs(spark, sf_dir):
    return balance(table(spark, sf_dir, "documents"), "doc_id")


def q_trie_roundtrip(spark, sf_dir):
    """S6 + T2 + T9: greedy longest match over a byte + n-gram vocabulary."""
    from corpusloom.functions.trie import TrieTokenizer
    from corpusloom.plans.vocab_fixtures import rwkv_vocab_file
    from corpusloom.sources.vocab import collect_bounded, load_rwkv_vocab
    docs = _docs(spark, sf_dir)
    vocab = load_rwkv_vocab(spark, rwkv_vocab_file(spark, docs))
    tok = TrieTokenizer({bytes(r.token): r.id for r in collect_bounded(vocab.select("id", "token"))}, eod=EOD)
    enc = encode_documents(docs.select("doc_id", F.array("text").alias("sentences")), tok,
                           keep=["doc_id"], append_eod=False)
    return decode_column(enc.select("doc_id", "token_ids"), tok, "token_ids", "text").select(
        F.col("doc_id").cast("long"), "text")


SQL_TRIE_ROUNDTRIP = "SELECT doc_id, text FROM documents"


def q_vocab_checks(spark, sf_dir):
    """S6 validity counts of the derived vocabulary file."""
    from corpusloom.plans.vocab_fixtures import rwkv_vocab_file
    from corpusloom.sources.vocab import load_rwkv_vocab, vocab_checks
    v = load_rwkv_vocab(spark, rwkv_vocab_file(spark, _docs(spark, sf_dir)))
    return vocab_checks(v).select(*_long("entries", "bad_length", "min_id", "max_id", "distinct_ids"))


SQL_VOCAB_CHECKS = r"""
WITH w AS (SELECT unnest(list_filter(regexp_split_to_array(text, '\s+'), lambda x: x <> '')) AS w FROM documents),
g AS (SELECT count(DISTINCT g) AS n FROM (
        SELECT substr(w, i, 2) AS g FROM w, range(1, length(w)) t(i) WHERE length(w) >= 2
        UNION ALL SELECT substr(w, i, 3) FROM w, range(1, length(w) - 1) t(i) WHERE length(w) >= 3)),
e AS (SELECT (256 + least(300, n))::BIGINT AS n FROM g)
SELECT n AS entries, 0::BIGINT AS bad_length, 1::BIGINT AS min_id, n AS max_id, n AS distinct_ids FROM e
"""


def _bpe(spark, docs):
    from corpusloom.functions.bpe import Gpt2BpeTokenizer
    from corpusloom.plans.vocab_fixtures import bpe_files
    from corpusloom.sources.vocab import collect_bounded, load_gpt2_vocab
    vj, mt = bpe_files(spark, docs)
    vocab, merges = load_gpt2_vocab(spark, vj, mt)
    enc = {r.token: r.id for r in collect_bounded(vocab)}
    mer = [(r.left, r.right) for r in collect_bounded(merges.orderBy("rank"))]
    return Gpt2BpeTokenizer(enc, mer), vj, mt


def q_bpe_roundtrip(spark, sf_dir):
    """S8 + T3 (row strategy, per-task memo) + T9."""
    docs = _docs(spark, sf_dir)
    tok, _, _ = _bpe(spark, docs)
    enc = encode_documents(docs.select("doc_id", F.array("text").alias("sentences")), tok,
                           keep=["doc_id"], append_eod=False)
    return decode_column(enc.select("doc_id", "token_ids"), tok, "token_ids", "text").select(
        F.col("doc_id").cast("long"), "text")


SQL_BPE_ROUNDTRIP = "SELECT doc_id, text FROM documents"


def q_bpe_dictionary(spark, sf_dir):
    """T3 dictionary strategy (J2): distinct pieces encoded once, joined back;
    must equal the row strategy id for id."""
    from corpusloom.functions.bpe import PieceEncoder
    from corpusloom.functions.dictionary import encode_by_dictionary
    docs = _docs(spark, sf_dir)
    tok, _, _ = _bpe(spark, docs)
    by_dict = encode_by_dictionary(docs, "doc_id", "text", PieceEncoder(tok), text.pretokenize_gpt2)
    by_row = encode_documents(docs.select("doc_id", F.array("text").alias("sentences")), tok,
                              keep=["doc_id"], append_eod=False)
    j = by_dict.join(by_row.select("doc_id", F.col("token_ids").alias("row_ids")), "doc_id")
    return j.select(F.col("doc_id").cast("long"), (F.col("token_ids") == F.col("row_ids")).alias("same"))


SQL_BPE_DICTIONARY = "SELECT doc_id, true AS same FROM documents"


def q_piece_counts(spark, sf_dir):
    """Distinct pre-token dictionary with counts (the J2 memo's size); every
    piece's text is checked by the roundtrip queries."""
    from corpusloom.functions.dictionary import piece_counts
    pc = piece_counts(_docs(spark, sf_dir), "text", text.pretokenize_gpt2)
    return pc.agg(F.count(F.lit(1)).alias("n_distinct"), F.sum("n").alias("n_pieces"),
                  F.sum(F.col("n") * F.length("piece")).alias("n_chars")).select(
        *_long("n_distinct", "n_pieces", "n_chars"))


SQL_PIECE_COUNTS = f"""
WITH p AS (SELECT unnest({_PIECES_SQL}) AS piece FROM documents)
SELECT count(DISTINCT piece)::BIGINT AS n_distinct, count(*)::BIGINT AS n_pieces, sum(length(piece))::BIGINT AS n_chars FROM p
"""


def q_wordpiece_text(spark, sf_dir):
    """S7 + P11 + T4 + P14: decode(encode(text)) is the basic-tokenized text
    joined by spaces with the English clean-up applied."""
    from corpusloom.functions.wordpiece import WordPieceTokenizer
    from corpusloom.plans.vocab_fixtures import wordpiece_vocab_file
    from corpusloom.sources.vocab import collect_bounded, load_wordpiece_vocab
    docs = _docs(spark, sf_dir)
    v = load_wordpiece_vocab(spark, wordpiece_vocab_file(spark, docs))
    tok = WordPieceTokenizer({r.token: r.id for r in collect_bounded(v)}, cleaned=True)
    cleaned = docs.select("doc_id", F.array(text.clean_text_for_wordpiece(F.col("text"))).alias("sentences"))
    enc = encode_documents(cleaned, tok, keep=["doc_id"], append_eod=False)
    return decode_column(enc.select("doc_id", "token_ids"), tok, "token_ids", "text").select(
        F.col("doc_id").cast("long"), "text")


def _sql_wordpiece_text():
    punct = r"[!-/:-@\[-`{-~\pP]"
    body = f"array_to_string(regexp_extract_all(strip_accents(lower(text)), '{punct}|[^\\s!-/:-@\\[-`{{-~\\pP]+'), ' ')"
    for a, b in text.CLEANUP_REPLACEMENTS:
        body = f"replace({body}, '{a.replace(chr(39), chr(39) * 2)}', '{b.replace(chr(39), chr(39) * 2)}')"
    return f"SELECT doc_id, {body} AS text FROM documents"


SQL_WORDPIECE_TEXT = _sql_wordpiece_text()


QUERIES.update({
    "trie_roundtrip": (q_trie_roundtrip, SQL_TRIE_ROUNDTRIP),
    "vocab_checks": (q_vocab_checks, SQL_VOCAB_CHECKS),
    "bpe_roundtrip": (q_bpe_roundtrip, SQL_BPE_ROUNDTRIP),
    "bpe_dictionary": (q_bpe_dictionary, SQL_BPE_DICTIONARY),
    "piece_counts": (q_piece_counts, SQL_PIECE_COUNTS),
    "wordpiece_text": (q_wordpiece_text, SQL_WORDPIECE_TEXT),
})


# ---------------------------------------------------------------------------
# M9 reshard / resume

def _chunk_cols(df):
    part = F.regexp_extract("src_path", r"part-(\d+)$", 1).cast("long").alias("part")
    return df.select(part, *_long("start_doc", "end_doc", "start_byte", "end_byte", "byte_size", "num_docs",
                                  "first_len", "last_len"))


def q_chunks(spark, sf_dir):
    """S10 + R5: greedy chunks of every part of the written dataset."""
    from corpusloom.operators.reshard import chunk_table
    return _chunk_cols(chunk_table(spark, [_written_dataset(spark, sf_dir)], CHUNK_TARGET))


def _sql_chunks(where: str = "") -> str:
    return f"""
WITH RECURSIVE {_SEQ_CTE},
ps AS (SELECT doc_id // {PART_DOCS} AS part,
         (row_number() OVER (PARTITION BY doc_id // {PART_DOCS} ORDER BY seq_id) - 1)::BIGINT AS i, length,
         (sum(length * {ITEM}) OVER (PARTITION BY doc_id // {PART_DOCS} ORDER BY seq_id
            ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))::BIGINT AS e FROM q),
tot AS (SELECT part, count(*)::BIGINT AS s, max(e)::BIGINT AS total FROM ps GROUP BY part),
c(part, start_doc, end_doc, start_byte, end_byte) AS (
  SELECT t.part, 0::BIGINT, coalesce(x.nxt, t.s), 0::BIGINT, coalesce(x.eb, t.total)
  FROM tot t LEFT JOIN LATERAL (SELECT (min(i) + 1)::BIGINT AS nxt, min(e)::BIGINT AS eb FROM ps
                                WHERE ps.part = t.part AND ps.e >= {CHUNK_TARGET}) x ON true
  UNION ALL
  SELECT c.part, c.end_doc, coalesce(x.nxt, t.s), c.end_byte, coalesce(x.eb, t.total)
  FROM c JOIN tot t ON t.part = c.part
  LEFT JOIN LATERAL (SELECT (min(i) + 1)::BIGINT AS nxt, min(e)::BIGINT AS eb FROM ps
                     WHERE ps.part = c.part AND ps.e >= c.end_byte + {CHUNK_TARGET}) x ON true
  WHERE c.end_doc < t.s)
SELECT c.part::BIGINT AS part, c.start_doc, c.end_doc, c.start_byte, c.end_byte,
       (c.end_byte - c.start_byte)::BIGINT AS byte_size, (c.end_doc - c.start_doc)::BIGINT AS num_docs,
       f.length::BIGINT AS first_len, l.length::BIGINT AS last_len
FROM c JOIN ps f ON f.part = c.part AND f.i = c.start_doc
       JOIN ps l ON l.part = c.part AND l.i = c.end_doc - 1
{where}
"""


SQL_CHUNKS = _sql_chunks()


def q_shards(spark, sf_dir):
    """LPT allocation of the chunks to 3 shards, reported as its
    invariants: every chunk placed once, all bytes placed, three shards used,
    largest load within 4/3 of the lower bound max(largest chunk, total/3)
    (Graham's bound for LPT)."""
    from corpusloom.operators.reshard import allocate, chunk_table
    ch = chunk_table(spark, [_written_dataset(spark, sf_dir)], CHUNK_TARGET)
    a = allocate(ch, 3)
    loads = a.groupBy("shard_id").agg(F.sum("byte_size").alias("load"), F.count(F.lit(1)).alias("n"),
                                      F.max("byte_size").alias("big"))
    r = loads.agg(F.count(F.lit(1)).alias("n_shards"), F.sum("n").alias("n_chunks"), F.sum("load").alias("bytes"),
                  F.max("load").alias("max_load"), F.max("big").alias("big"))
    lower = F.greatest(F.col("big"), F.ceil(F.col("bytes") / 3))
    n_distinct = a.agg(F.countDistinct("chunk_id")).first()[0]  # one scalar
    return r.select(
        *_long("n_shards", "n_chunks", "bytes"),
        (F.lit(n_distinct) == F.col("n_chunks")).alias("each_once"),
        (F.col("max_load") * 3 <= lower * 4).alias("within_bound"))


def q_reshard_roundtrip(spark, sf_dir):
    """R7 + SN4: reshard the written dataset into 3 shards over 2 output
    folders and read every shard back: the multiset of sequences is kept and
    each sequence is its own document."""
    import glob as _glob
    from corpusloom.operators.reshard import reshard
    src = _written_dataset(spark, sf_dir)
    outs = [scratch_dir(spark, "reshard-a"), scratch_dir(spark, "reshard-b")]
    reshard(spark, [src], outs, 3, target=CHUNK_TARGET)
    prefixes = sorted(p[:-4] for d in outs for p in _glob.glob(os.path.join(d, "*", "*_final.idx")))
    r = read_binidx(spark, ",".join(prefixes))
    return r.select(F.col("length").cast("long"), _sum_ids(F.col("tokens")).alias("tok_sum"),
                    F.col("sent_pos").cast("long").alias("sent_pos"))


SQL_RESHARD_ROUNDTRIP = f"WITH {_SEQ_CTE} SELECT length, tok_sum, 0::BIGINT AS sent_pos FROM q"


def q_resume_anti(spark, sf_dir):
    """R8/R9 + J6/O7: chunks already recorded in a shard manifest (here: the
    chunks of part 0) are removed with a left-anti join."""
    from corpusloom.operators.reshard import chunk_table, done_chunks, pending_chunks
    ch = checkpoint(chunk_table(spark, [_written_dataset(spark, sf_dir)], CHUNK_TARGET))
    out = scratch_dir(spark, "resume-out")
    (ch.where(F.col("src_path").endswith("part-000000000000000")).select(F.col("id").alias("chunk_id"))
     .write.mode("overwrite").parquet(os.path.join(out, "_manifest")))
    return _chunk_cols(pending_chunks(ch, done_chunks(spark, [out])))


SQL_RESUME_ANTI = _sql_chunks("WHERE c.part <> 0")

SQL_SHARDS = ("SELECT 3::BIGINT AS n_shards, count(*)::BIGINT AS n_chunks, sum(byte_size)::BIGINT AS bytes, "
              "true AS each_once, true AS within_bound FROM (" + _sql_chunks() + ")")


# ---------------------------------------------------------------------------
# M10 blend, streaming

def q_blend_select(spark, sf_dir):
    """Weights per source (w = n mod 4 + 1 for source ``srcN``),
    normalised, applied to rows: each source keeps its share of half the
    corpus, lowest ``(score, doc_id)`` first."""
    from corpusloom.operators.blend import blend_select
    docs = _docs(spark, sf_dir)
    weights = (docs.select("source").distinct()
               .select(F.col("source").alias("prefix"),
                       (F.regexp_extract("source", r"(\d+)$", 1).cast("long") % 4 + 1).cast("double").alias("weight")))
    total = docs.count() // 2
    score = F.pmod(F.col("doc_id") * 7919, F.lit(10007))
    sel = blend_select(docs, "source", "doc_id", weights, total=total, score=score, bucket_shift=6)
    return sel.select("source", F.col("doc_id").cast("long"))


SQL_BLEND_SELECT = r"""
WITH c AS (SELECT source, count(*) AS n FROM documents GROUP BY source),
w AS (SELECT source, n, (CAST(regexp_extract(source, '(\d+)$', 1) AS BIGINT) % 4 + 1)::DOUBLE AS weight FROM c),
q AS (SELECT source, least(n, floor(weight * ((SELECT sum(n) FROM c) // 2) / (SELECT sum(weight) FROM w)))::BIGINT AS quota FROM w),
r AS (SELECT d.source, d.doc_id, row_number() OVER (PARTITION BY d.source ORDER BY (d.doc_id * 7919) % 10007, d.doc_id) AS rn
      FROM documents d)
SELECT r.source, r.doc_id::BIGINT AS doc_id FROM r JOIN q ON q.source = r.source WHERE r.rn <= q.quota
"""


def q_stream_ingest(spark, sf_dir):
    """ST1: the JSONL corpus ingested incrementally with Structured
    Streaming; each micro-batch commits one immutable part. Same result as
    the batch scan."""
    from corpusloom.streaming.ingest import ingest_corpus_stream
    src = documents_jsonl(spark, sf_dir)
    out = scratch_dir(spark, "stream-out")
    res = ingest_corpus_stream(spark, src, out, keys=["text"])
    return res.select(F.regexp_extract("file_path", r"(lang=[^/]*/bucket=[^/]*)/", 1).alias("dir"),
                      F.col("line_no").cast("long"), F.element_at("sentences", 1).alias("text"))


SQL_STREAM_INGEST = f"""
SELECT 'lang=' || lang || '/bucket=' || CAST(doc_id // {BUCKET_DOCS} AS VARCHAR) AS dir,
       (row_number() OVER (PARTITION BY {_FILE} ORDER BY doc_id) - 1)::BIGINT AS line_no, text
FROM documents
"""


QUERIES.update({
    "chunks": (q_chunks, SQL_CHUNKS),
    "shards": (q_shards, SQL_SHARDS),
    "reshard_roundtrip": (q_reshard_roundtrip, SQL_RESHARD_ROUNDTRIP),
    "resume_anti": (q_resume_anti, SQL_RESUME_ANTI),
    "blend_select": (q_blend_select, SQL_BLEND_SELECT),
    "stream_ingest": (q_stream_ingest, SQL_STREAM_INGEST),
})


# ---------------------------------------------------------------------------
# U2 jobs, J3/J4 access, S5 checks, SN3

def q_build_corpus(spark, sf_dir):
    """JSONL corpus → byte tokens → merged indexed dataset, read back."""
    from corpusloom.plans.build import build_corpus
    from corpusloom.spec import CorpusSpec, TokenizerSpec
    src = documents_jsonl(spark, sf_dir)
    out = os.path.join(scratch_dir(spark, "build"), "corpus")
    res = build_corpus(spark, CorpusSpec(src, out, TokenizerSpec("byte"), merge_partitions=True))
    r = read_binidx(spark, res["text"])
    return r.select(*_long("seq_id", "doc_id", "length", "ptr"), _sum_ids(F.col("tokens")).alias("tok_sum"))


SQL_BUILD_CORPUS = f"""
WITH d AS (SELECT (row_number() OVER (ORDER BY {_LINE_ORDER}) - 1)::BIGINT AS doc_id,
             octet_length(encode(text)) + 1 AS length,
             list_sum({_BYTE_IDS.format(x='text')}) + {EOD} AS tok_sum FROM documents)
SELECT doc_id AS seq_id, doc_id, length::BIGINT AS length,
       (coalesce(sum(length) OVER (ORDER BY doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) * {ITEM})::BIGINT AS ptr,
       tok_sum::BIGINT AS tok_sum FROM d
"""


def q_build_partitioned(spark, sf_dir):
    """U2 with R1 + R3: 4 round-robin partitions, sentence split, merged in
    partition order; one row per document of the merged dataset."""
    from corpusloom.plans.build import build_corpus
    from corpusloom.spec import CorpusSpec, TokenizerSpec
    src = documents_jsonl(spark, sf_dir)
    out = os.path.join(scratch_dir(spark, "build-rr"), "corpus")
    res = build_corpus(spark, CorpusSpec(src, out, TokenizerSpec("byte"), partitions=N_PARTS,
                                         split_sentences=True, merge_partitions=True))
    d = read_binidx(spark, res["text"], table="documents")
    return d.select(*_long("doc_id", "seq_begin", "seq_end"))


SQL_BUILD_PARTITIONED = f"""
WITH l AS (SELECT (row_number() OVER (ORDER BY {_LINE_ORDER}) - 1)::BIGINT AS line_id, text FROM documents),
s AS (SELECT line_id, len(list_filter(list_transform(regexp_extract_all(text, '{text.SENTENCE_PATTERN}'),
             lambda x: regexp_replace(x, '^{text.WS}+|{text.WS}+$', '', 'g')), lambda x: length(x) > 0))::BIGINT AS n
      FROM l),
m AS (SELECT (row_number() OVER (ORDER BY line_id % {N_PARTS}, line_id) - 1)::BIGINT AS doc_id, n FROM s)
SELECT doc_id, coalesce(sum(n) OVER (ORDER BY doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS seq_begin,
       sum(n) OVER (ORDER BY doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)::BIGINT AS seq_end FROM m
"""


def q_seq_get(spark, sf_dir):
    """For every sequence, tokens [seq_id mod 5, +7) (NULL length = rest
    when fewer remain)."""
    seqs = read_binidx(spark, _written_dataset(spark, sf_dir))
    req = seqs.select("seq_id", F.least(F.pmod("seq_id", F.lit(5)), F.col("length")).cast("int").alias("offset"),
                      F.when(F.col("length") - F.pmod("seq_id", F.lit(5)) >= 7, F.lit(7)).cast("int").alias("length"))
    g = lookup.get_tokens(seqs, req)
    return g.select(F.col("seq_id").cast("long"), F.col("offset").cast("long"),
                    F.array_join("tokens", " ").alias("tokens"))


SQL_SEQ_GET = f"""
WITH {_SEQ_CTE},
t AS (SELECT q.seq_id, list_transform(regexp_extract_all(hex(encode(x.s)), '..'), lambda h: ('0x' || h)::BIGINT + 1)
             || CASE WHEN x.last THEN [{EOD}::BIGINT] ELSE [] END AS toks
      FROM q JOIN (SELECT doc_id, unnest(sl) AS s, unnest(range(len(sl)))::BIGINT AS sent_pos,
                          unnest(list_transform(sl, lambda v, i: i = len(sl))) AS last FROM s) x
        ON x.doc_id = q.doc_id AND x.sent_pos = q.sent_pos)
SELECT seq_id, least(seq_id % 5, len(toks))::BIGINT AS offset,
       array_to_string(toks[least(seq_id % 5, len(toks)) + 1 : least(seq_id % 5, len(toks)) + 7], ' ') AS tokens FROM t
"""


def q_seq_slice(spark, sf_dir):
    """The contiguous middle half of the sequences."""
    seqs = read_binidx(spark, _written_dataset(spark, sf_dir), columns="index")
    n = seqs.count()
    return lookup.slice_sequences(seqs, n // 4, 3 * n // 4).select(*_long("seq_id", "doc_id", "length"))


SQL_SEQ_SLICE = f"""
WITH {_SEQ_CTE}
SELECT seq_id, doc_id, length FROM q
WHERE seq_id >= (SELECT count(*) FROM q) // 4 AND seq_id < 3 * (SELECT count(*) FROM q) // 4
"""


def q_dataset_checks(spark, sf_dir):
    """Integrity checks of every part of the written dataset, and of three
    broken copies of part 0: data cut short (part 10^6), no data file
    (10^6 + 1), another magic (10^6 + 2)."""
    import shutil
    from corpusloom.sources.checks import dataset_checks
    path = _written_dataset(spark, sf_dir)
    part = lambda p: os.path.join(path, f"part-{p:015d}")
    for k in range(3):
        for ext in (".idx", ".bin"):
            shutil.copyfile(part(0) + ext, part(10 ** 6 + k) + ext)
    with open(part(10 ** 6) + ".bin", "r+b") as f:
        f.truncate(os.path.getsize(part(0) + ".bin") - 1)
    os.remove(part(10 ** 6 + 1) + ".bin")
    with open(part(10 ** 6 + 2) + ".idx", "r+b") as f:
        f.write(b"NOINDEX")
    return dataset_checks(spark, path).select(
        F.regexp_extract("prefix", r"part-(\d+)$", 1).cast("long").alias("part"), "check", "ok")


SQL_DATASET_CHECKS = f"""
SELECT p AS part, c AS check, true AS ok
FROM range(0, (SELECT (count(*) + {PART_DOCS} - 1) // {PART_DOCS} FROM documents)) r(p), (VALUES ('files'), ('header'), ('doc_index_end'), ('bin_size'), ('pointers')) v(c)
UNION ALL SELECT p, c, ok FROM (VALUES
  (1000000, 'files', true), (1000000, 'header', true), (1000000, 'doc_index_end', true), (1000000, 'bin_size', false), (1000000, 'pointers', true),
  (1000001, 'files', false), (1000001, 'header', true), (1000001, 'doc_index_end', true), (1000001, 'bin_size', false), (1000001, 'pointers', true),
  (1000002, 'files', true), (1000002, 'header', false), (1000002, 'doc_index_end', false), (1000002, 'bin_size', false), (1000002, 'pointers', false)) x(p, c, ok)
"""


def q_split_output(spark, sf_dir):
    """SN3: sentence-split JSONL written and read back."""
    from corpusloom.plans.build import write_split_sentences
    from corpusloom.spec import CorpusSpec
    src = documents_jsonl(spark, sf_dir)
    out = scratch_dir(spark, "split-out")
    write_split_sentences(spark, CorpusSpec(src, ""), out)
    back = spark.read.schema("text array<string>").json(out)
    return back.select(F.size("text").cast("long").alias("n_sents"), F.try_element_at("text", F.lit(1)).alias("first"))


SQL_SPLIT_OUTPUT = f"""
WITH p AS (SELECT list_filter(list_transform(regexp_extract_all(text, '{text.SENTENCE_PATTERN}'),
             lambda x: regexp_replace(x, '^{text.WS}+|{text.WS}+$', '', 'g')), lambda x: length(x) > 0) AS s
           FROM documents)
SELECT len(s)::BIGINT AS n_sents, s[1] AS first FROM p
"""


QUERIES.update({
    "build_corpus": (q_build_corpus, SQL_BUILD_CORPUS),
    "build_partitioned": (q_build_partitioned, SQL_BUILD_PARTITIONED),
    "seq_get": (q_seq_get, SQL_SEQ_GET),
    "seq_slice": (q_seq_slice, SQL_SEQ_SLICE),
    "dataset_checks": (q_dataset_checks, SQL_DATASET_CHECKS),
    "split_output": (q_split_output, SQL_SPLIT_OUTPUT),
})


# ---------------------------------------------------------------------------
# U1 SQL surface, J1 vocabulary join, A7 fingerprints, S9 Parquet input, R4

def q_sql_tokenize(spark, sf_dir):
    """The byte tokenizer registered as SQL functions and used from SQL."""
    from corpusloom.functions.registry import register_tokenizer
    register_tokenizer(spark, BYTES, "bytes")
    _docs(spark, sf_dir).createOrReplaceTempView("cl_documents")
    return spark.sql("""
        SELECT CAST(doc_id AS BIGINT) AS doc_id, CAST(size(ids) AS BIGINT) AS n_tokens,
               aggregate(ids, 0L, (a, x) -> a + x) AS tok_sum, bytes_detokenize(ids) AS text
        FROM (SELECT doc_id, bytes_tokenize(text) AS ids FROM cl_documents)""")


SQL_SQL_TOKENIZE = f"""
SELECT doc_id, octet_length(encode(text))::BIGINT AS n_tokens,
       coalesce(list_sum({_BYTE_IDS.format(x='text')}), 0)::BIGINT AS tok_sum, text FROM documents
"""


def q_vocab_lookup(spark, sf_dir):
    """Pieces → ids through an equi-join with the vocabulary table
    (broadcast when small), unknown pieces → 0 (GPT-2 rule). Vocabulary: the
    500 most frequent lower-cased words, id = rank."""
    docs = _docs(spark, sf_dir)
    words = docs.select("doc_id", F.posexplode(text.whitespace_tokenize(F.lower("text"))).alias("pos", "piece"))
    vocab = (words.groupBy("piece").agg(F.count(F.lit(1)).alias("n"))
             .orderBy(F.desc("n"), "piece").limit(500)
             .select("piece", F.row_number().over(Window.orderBy(F.desc("n"), "piece")).alias("id")))
    ids = words.join(F.broadcast(vocab), "piece", "left").select("doc_id", "pos", F.coalesce("id", F.lit(0)).alias("id"))
    return ids.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n_words"),
                                     F.sum("id").alias("id_sum"),
                                     F.count(F.when(F.col("id") == 0, 1)).alias("n_unknown")).select(
        *_long("doc_id", "n_words", "id_sum", "n_unknown"))


SQL_VOCAB_LOOKUP = r"""
WITH w AS (SELECT doc_id, unnest(list_filter(regexp_split_to_array(lower(text), '\s+'), lambda x: x <> '')) AS piece
           FROM documents),
v AS (SELECT piece, row_number() OVER (ORDER BY n DESC, piece) AS id FROM
        (SELECT piece, count(*) AS n FROM w GROUP BY piece ORDER BY n DESC, piece LIMIT 500))
SELECT w.doc_id::BIGINT AS doc_id, count(*)::BIGINT AS n_words, sum(coalesce(v.id, 0))::BIGINT AS id_sum,
       count(*) FILTER (WHERE v.id IS NULL)::BIGINT AS n_unknown
FROM w LEFT JOIN v ON v.piece = w.piece GROUP BY w.doc_id
"""


def q_chunk_fingerprints(spark, sf_dir):
    """Fingerprint of every chunk, computed from the index only."""
    from corpusloom.operators.reshard import chunk_fingerprints, chunk_table
    ch = chunk_table(spark, [_written_dataset(spark, sf_dir)], CHUNK_TARGET)
    fp = chunk_fingerprints(spark, ch).select("id", "n_seq", F.col("first_len").alias("fp_first"),
                                              F.col("last_len").alias("fp_last"), "fingerprint")
    part = F.regexp_extract("src_path", r"part-(\d+)$", 1).cast("long").alias("part")
    return ch.join(fp, "id").select(part, *_long("start_doc", "n_seq", "fp_first", "fp_last", "fingerprint"))


SQL_CHUNK_FINGERPRINTS = f"""
WITH RECURSIVE ch AS ({_sql_chunks()}), {_SEQ_CTE},
sx AS (SELECT doc_id // {PART_DOCS} AS part, (row_number() OVER (PARTITION BY doc_id // {PART_DOCS} ORDER BY seq_id) - 1)::BIGINT AS i,
              length FROM q),
j AS (SELECT ch.part, ch.start_doc, sx.length, (sx.i - ch.start_doc + 1)::HUGEINT AS k, ch.first_len, ch.last_len
      FROM ch JOIN sx ON sx.part = ch.part AND sx.i >= ch.start_doc AND sx.i < ch.end_doc)
SELECT part, start_doc, count(*)::BIGINT AS n_seq, any_value(first_len) AS fp_first, any_value(last_len) AS fp_last,
       (sum((length + 1)::HUGEINT * ((k * k % 4294967296) * 2654435761 % 4294967296)) % 2305843009213693951)::BIGINT AS fingerprint
FROM j GROUP BY part, start_doc
"""


def q_parquet_corpus(spark, sf_dir):
    """Parquet input with ``text_cols`` → build (document level) with
    line ids taken from the Parquet row order; one row per sequence."""
    from corpusloom.plans.build import build_corpus
    from corpusloom.spec import CorpusSpec, TokenizerSpec
    out = os.path.join(scratch_dir(spark, "build-pq"), "corpus")
    res = build_corpus(spark, CorpusSpec(os.path.join(sf_dir, "benchmark.parquet"), out, TokenizerSpec("byte"),
                                         json_keys=["text"], input_format="parquet"))
    r = read_binidx(spark, res["text"], columns="index")
    return r.select(*_long("seq_id", "length"))


SQL_PARQUET_CORPUS = """
SELECT (row_number() OVER (ORDER BY item_id) - 1)::BIGINT AS seq_id, (octet_length(encode(text)) + 1)::BIGINT AS length
FROM benchmark WHERE octet_length(encode(text)) > 0
"""


def q_per_file_build(spark, sf_dir):
    """One dataset per input file (key = relative path, Q16)."""
    from corpusloom.plans.build import build_corpus
    from corpusloom.spec import CorpusSpec, TokenizerSpec
    src = documents_jsonl(spark, sf_dir)
    out = os.path.join(scratch_dir(spark, "build-files"), "corpus")
    res = build_corpus(spark, CorpusSpec(src, out, TokenizerSpec("byte"), per_file=True))
    # one plan for all files: a plan of its own for each would grow the driver with them
    r = read_binidx(spark, ",".join(prefix for _, prefix in sorted(res["files"].items())), columns="index")
    key = F.expr(f"substring(prefix, {len(out) + 2})")
    return r.select(F.substring_index(key, "/", 2).alias("dir"), *_long("file_seq", "length")).withColumnRenamed("file_seq", "seq_id")


SQL_PER_FILE_BUILD = f"""
SELECT 'lang=' || lang || '/bucket=' || CAST(doc_id // {BUCKET_DOCS} AS VARCHAR) AS dir,
       (row_number() OVER (PARTITION BY {_FILE} ORDER BY doc_id) - 1)::BIGINT AS seq_id,
       (octet_length(encode(text)) + 1)::BIGINT AS length FROM documents
"""


QUERIES.update({
    "sql_tokenize": (q_sql_tokenize, SQL_SQL_TOKENIZE),
    "vocab_lookup": (q_vocab_lookup, SQL_VOCAB_LOOKUP),
    "chunk_fingerprints": (q_chunk_fingerprints, SQL_CHUNK_FINGERPRINTS),
    "parquet_corpus": (q_parquet_corpus, SQL_PARQUET_CORPUS),
    "per_file_build": (q_per_file_build, SQL_PER_FILE_BUILD),
})


def q_resume_by_lengths(spark, sf_dir):
    """R8 fallback: the resharded outputs are matched back to their source
    chunks from lengths alone (manifests ignored): every chunk is found."""
    import glob as _glob
    from corpusloom.operators.reshard import chunk_table, reshard, used_chunks_by_lengths
    src = _written_dataset(spark, sf_dir)
    outs = [scratch_dir(spark, "fallback-a"), scratch_dir(spark, "fallback-b")]
    reshard(spark, [src], outs, 3, target=CHUNK_TARGET)
    prefixes = [p[:-4] for d in outs for p in _glob.glob(os.path.join(d, "*", "*_final.idx"))]
    ch = checkpoint(chunk_table(spark, [src], CHUNK_TARGET))
    used = used_chunks_by_lengths(spark, ch, prefixes)
    return _chunk_cols(ch.join(used.withColumnRenamed("chunk_id", "id"), "id", "left_semi"))


QUERIES["resume_by_lengths"] = (q_resume_by_lengths, SQL_CHUNKS)


# ---------------------------------------------------------------------------
# Runs after the first: what is there stays, what changed is read anew

def _shard_rows(spark, outs):
    import glob as _glob
    prefixes = sorted(p[:-4] for d in outs for p in _glob.glob(os.path.join(d, "*", "*_final.idx")))
    r = read_binidx(spark, ",".join(prefixes))
    return r.select(F.col("length").cast("long"), _sum_ids(F.col("tokens")).alias("tok_sum"))


def q_reshard_two_runs(spark, sf_dir):
    """R8/R9 + SN4: the documents, then the benchmark items as a second source
    with another chunk size: every sequence of both is there once."""
    from corpusloom.operators.reshard import reshard
    first, second = _written_dataset(spark, sf_dir), scratch_dir(spark, "second")
    items = table(spark, sf_dir, "benchmark").select("item_id", F.array("text").alias("sentences"))
    enc = encode_documents(items, ByteTokenizer(eod=EOD), keep=["item_id"])
    write_binidx(enc.coalesce(1).select(F.lit(0).cast("long").alias("part"), "token_ids", "sentence_lens"), second)
    outs = [scratch_dir(spark, "runs-a"), scratch_dir(spark, "runs-b")]
    reshard(spark, [first], outs, 3, target=CHUNK_TARGET)
    reshard(spark, [first, second], outs, 2, target=CHUNK_TARGET // 3)
    reshard(spark, [first, second], outs, 2, target=CHUNK_TARGET)
    return _shard_rows(spark, outs)


SQL_RESHARD_TWO_RUNS = f"""
WITH {_SEQ_CTE},
b AS (SELECT octet_length(encode(text)) AS n, list_sum({_BYTE_IDS.format(x='text')}) AS t FROM benchmark)
SELECT length, tok_sum FROM q UNION ALL
SELECT (n + 1)::BIGINT AS length, (t + {EOD})::BIGINT AS tok_sum FROM b WHERE n > 0
"""


def q_rebuild_per_file(spark, sf_dir):
    """One dataset per file, built, then built again after the corpus
    doubled: each file's sequences once."""
    from corpusloom.plans.build import build_corpus
    from corpusloom.spec import CorpusSpec, TokenizerSpec
    src = scratch_dir(spark, "rebuild-in")
    items = table(spark, sf_dir, "benchmark").select("item_id", F.to_json(F.struct("text")).alias("value"))
    spec = CorpusSpec(src, os.path.join(scratch_dir(spark, "rebuild"), "c"), TokenizerSpec("byte"), per_file=True)
    for half in ("item_id % 2 = 0", "true"):
        (items.where(half).coalesce(1).sortWithinPartitions("item_id").select("value").write.mode("overwrite").text(src))
        rename_to_jsonl(spark, src)
        res = build_corpus(spark, spec)
    return read_binidx(spark, ",".join(sorted(res["files"].values())), columns="index").select(*_long("seq_id", "length"))


def q_decode_broken(spark, sf_dir):
    """Decoding stops where bytes never become valid text (each text with a
    stray byte after its first half)."""
    docs = _docs(spark, sf_dir).select("doc_id", "text")
    half = F.expr("substring(text, 1, length(text) div 2)")
    rest = F.expr("substring(text, length(text) div 2 + 1)")
    tok = ByteTokenizer(eod=None)
    enc = encode_documents(docs.select("doc_id", F.array(half, rest).alias("sentences")), tok, keep=["doc_id"], append_eod=False)
    n = F.element_at("sentence_lens", 1)
    broken = enc.where(F.size("sentence_lens") == 2).select("doc_id", F.concat(
        F.slice("token_ids", F.lit(1), n), F.array(F.lit(255 + BYTES.offset)),
        F.slice("token_ids", n + 1, F.size("token_ids"))).alias("token_ids"))
    from corpusloom.functions.trie import TrieTokenizer
    trie = TrieTokenizer({bytes([b]): b + BYTES.offset for b in range(256)}, eod=None)
    return decode_column(broken, trie, "token_ids", "text", keep=["doc_id"])


SQL_DECODE_BROKEN = """
SELECT doc_id, substr(text, 1, length(text) // 2) AS text FROM documents WHERE length(text) >= 2
"""


def q_parquet_lists(spark, sf_dir):
    """A list column gives one sentence per element, in sentence mode
    without further splitting rules (document level here)."""
    from corpusloom.plans.build import build_corpus
    from corpusloom.spec import CorpusSpec, TokenizerSpec
    src = scratch_dir(spark, "lists")
    (table(spark, sf_dir, "benchmark").coalesce(1).sortWithinPartitions("item_id")
     .select(F.split("text", " ").alias("words")).write.mode("overwrite").parquet(src))
    res = build_corpus(spark, CorpusSpec(src, os.path.join(scratch_dir(spark, "lists-out"), "c"), TokenizerSpec("byte"),
                                         json_keys=["words"], input_format="parquet"))
    return read_binidx(spark, res["words"], columns="index").select(*_long("doc_id", "sent_pos", "length"))


SQL_PARQUET_LISTS = """
WITH w AS (SELECT (row_number() OVER (ORDER BY item_id) - 1)::BIGINT AS doc_id, string_split(text, ' ') AS l FROM benchmark),
u AS (SELECT doc_id, unnest(l) AS s, generate_subscripts(l, 1) AS i FROM w),
k AS (SELECT doc_id, i, octet_length(encode(s)) AS n FROM u WHERE s <> '')
SELECT doc_id, (row_number() OVER (PARTITION BY doc_id ORDER BY i) - 1)::BIGINT AS sent_pos,
       (n + CASE WHEN i = max(i) OVER (PARTITION BY doc_id) THEN 1 ELSE 0 END)::BIGINT AS length FROM k
"""

QUERIES.update({
    "reshard_two_runs": (q_reshard_two_runs, SQL_RESHARD_TWO_RUNS),
    "rebuild_per_file": (q_rebuild_per_file, SQL_PARQUET_CORPUS),
    "decode_broken": (q_decode_broken, SQL_DECODE_BROKEN),
    "parquet_lists": (q_parquet_lists, SQL_PARQUET_LISTS),
})


def q_stream_dataset(spark, sf_dir):
    """ST1 up to a dataset: the corpus streamed into indexed parts, read back as
    one dataset."""
    from corpusloom.streaming.ingest import ingest_corpus_stream, streamed_prefixes
    out = scratch_dir(spark, "stream-dataset")
    ingest_corpus_stream(spark, documents_jsonl(spark, sf_dir), out, keys=["text"], tokenizer=BYTES)
    r = read_binidx(spark, streamed_prefixes(out, "text"))
    return r.select(F.col("length").cast("long"), _sum_ids(F.col("tokens")).alias("tok_sum"))


SQL_STREAM_DATASET = f"""
SELECT (octet_length(encode(text)) + 1)::BIGINT AS length,
       (list_sum({_BYTE_IDS.format(x='text')}) + {EOD})::BIGINT AS tok_sum FROM documents WHERE octet_length(encode(text)) > 0
"""

QUERIES["stream_dataset"] = (q_stream_dataset, SQL_STREAM_DATASET)
