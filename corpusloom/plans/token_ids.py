"""Registered queries that compare token ids themselves (not round trips):
the oracles derive the vocabulary and the ids from ``documents`` in SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from corpusloom.functions.base import encode_documents
from corpusloom.functions.wordpiece import MAX_WORD_CHARS, SPECIAL_TOKENS
from corpusloom.operators import text
from corpusloom.plans.catalog import EOD, _PIECES_SQL, _bpe, _docs
from corpusloom.sources.vocab import collect_bounded, load_rwkv_vocab, load_wordpiece_vocab


def _ids_digest(encoded):
    """Number of ids and a digest of all of them in order."""
    return encoded.select(F.col("doc_id").cast("long").alias("doc_id"), F.size("token_ids").cast("long").alias("n_ids"),
                          F.md5(F.array_join("token_ids", " ")).alias("ids_md5"))


def _whole_texts(docs, column="text"):
    return docs.select("doc_id", F.array(column).alias("sentences"))


# Ids of a document's parts in order → the digest's columns.
_DIGEST = """
SELECT doc_id, coalesce(sum(len(ids)), 0)::BIGINT AS n_ids,
       md5(coalesce(string_agg(array_to_string(ids, ' '), ' ' ORDER BY k) FILTER (WHERE len(ids) > 0), '')) AS ids_md5
FROM parts GROUP BY doc_id
"""
_BYTES_OF = "list_transform(regexp_extract_all(hex(encode({x})), '..'), lambda h: ('0x' || h)::INTEGER{plus})"


def q_trie_ids(spark, sf_dir):
    """S6 + T2: ids of the greedy longest match over bytes and frequent n-grams."""
    from corpusloom.functions.trie import TrieTokenizer
    from corpusloom.plans.vocab_fixtures import rwkv_vocab_file
    docs = _docs(spark, sf_dir)
    vocab = load_rwkv_vocab(spark, rwkv_vocab_file(spark, docs))
    tok = TrieTokenizer({bytes(r.token): r.id for r in collect_bounded(vocab.select("id", "token"))}, eod=EOD)
    return _ids_digest(encode_documents(_whole_texts(docs), tok, keep=["doc_id"], append_eod=False))


# Vocabulary: bytes, then the 300 most frequent bigrams and trigrams inside words. Tokens never hold
# white space, so words are matched on their own; at a character the longest entry that fits is taken.
SQL_TRIE_IDS = rf"""
WITH RECURSIVE p AS (SELECT doc_id, unnest(regexp_extract_all(text, '\s|\S+')) AS w,
                            unnest(range(len(regexp_extract_all(text, '\s|\S+')))) AS k FROM documents),
words AS (SELECT w, count(*) AS many FROM p GROUP BY w),
grams AS (SELECT g, sum(many) AS n FROM (
    SELECT substr(w, i, 2) AS g, many FROM words, range(1, length(w)) t(i) WHERE length(w) >= 2 AND NOT regexp_matches(w, '\s')
    UNION ALL SELECT substr(w, i, 3), many FROM words, range(1, length(w) - 1) t(i) WHERE length(w) >= 3 AND NOT regexp_matches(w, '\s')) GROUP BY g),
vocab AS (SELECT g, (256 + row_number() OVER (ORDER BY n DESC, g))::INTEGER AS id FROM grams ORDER BY n DESC, g LIMIT 300),
m AS (SELECT map_from_entries(list((g, id))) AS v FROM vocab),
walk AS (
    SELECT w, 1::BIGINT AS pos, []::INTEGER[] AS ids FROM words
    UNION ALL
    SELECT w, pos + CASE WHEN pos + 2 <= length(w) AND v[substr(w, pos, 3)] IS NOT NULL THEN 3
                        WHEN pos + 1 <= length(w) AND v[substr(w, pos, 2)] IS NOT NULL THEN 2 ELSE 1 END,
           list_concat(ids, CASE WHEN pos + 2 <= length(w) AND v[substr(w, pos, 3)] IS NOT NULL THEN [v[substr(w, pos, 3)]]
                        WHEN pos + 1 <= length(w) AND v[substr(w, pos, 2)] IS NOT NULL THEN [v[substr(w, pos, 2)]]
                        ELSE {_BYTES_OF.format(x='substr(w, pos, 1)', plus=' + 1')} END)
    FROM walk, m WHERE pos <= length(w)),
parts AS (SELECT doc_id, k, coalesce(ids, []) AS ids FROM documents LEFT JOIN p USING (doc_id)
          LEFT JOIN (SELECT w, ids FROM walk WHERE pos > length(w)) USING (w))
{_DIGEST}
"""


def q_bpe_ids(spark, sf_dir):
    """S8 + T3: ids of byte-level BPE, row by row."""
    docs = _docs(spark, sf_dir)
    tok, _, _ = _bpe(spark, docs)
    return _ids_digest(encode_documents(_whole_texts(docs), tok, keep=["doc_id"], append_eod=False))


def q_bpe_corpus_dictionary(spark, sf_dir):
    """J2 + T3: the same ids with each distinct piece of the corpus encoded once."""
    from corpusloom.functions.bpe import PieceEncoder
    from corpusloom.functions.dictionary import encode_by_corpus_dictionary
    docs = _docs(spark, sf_dir)
    tok, _, _ = _bpe(spark, docs)
    return _ids_digest(encode_by_corpus_dictionary(docs, "doc_id", "text", PieceEncoder(tok), text.pretokenize_gpt2))


# Merges are the 500 most frequent byte pairs inside pieces. In a step the pair of lowest rank that
# a piece still holds is merged everywhere, from left to right; merged symbols are numbered 256 and up.
SQL_BPE_IDS = rf"""
WITH RECURSIVE p AS (SELECT doc_id, unnest({_PIECES_SQL}) AS w, unnest(range(len({_PIECES_SQL}))) AS k FROM documents),
words AS (SELECT w, count(*) AS many, {_BYTES_OF.format(x='w', plus='')} AS b FROM p GROUP BY w),
pairs AS (SELECT b[i] * 256 + b[i + 1] AS pair, sum(many) AS n FROM words, range(1, len(b)) t(i) GROUP BY 1),
ranked AS (SELECT pair, (row_number() OVER (ORDER BY n DESC, pair) - 1)::INTEGER AS rank FROM pairs ORDER BY n DESC, pair LIMIT 500),
m AS (SELECT map_from_entries(list((pair, rank))) AS r, list(pair ORDER BY rank) AS byrank FROM ranked),
walk AS (
    SELECT w, b AS s, list_min(list_transform(range(1, len(b)), lambda i: CASE WHEN b[i] < 256 AND b[i + 1] < 256 THEN r[b[i] * 256 + b[i + 1]] END)) AS low
    FROM words, m
    UNION ALL
    SELECT w, t, list_min(list_transform(range(1, len(t)), lambda i: CASE WHEN t[i] < 256 AND t[i + 1] < 256 THEN r[t[i] * 256 + t[i + 1]] END))
    FROM (SELECT w, list_reduce(list_prepend([]::INTEGER[], list_transform(s, lambda x: [x])), lambda done, x:
                    CASE WHEN len(done) > 0 AND done[-1] < 256 AND x[1] < 256 AND done[-1] * 256 + x[1] = byrank[low + 1]
                         THEN list_append(done[:-2], 256 + low) ELSE list_concat(done, x) END) AS t
          FROM walk, m WHERE low IS NOT NULL), m),
parts AS (SELECT doc_id, k, coalesce(s, []) AS ids FROM documents LEFT JOIN p USING (doc_id)
          LEFT JOIN (SELECT w, s FROM walk WHERE low IS NULL) USING (w))
{_DIGEST}
"""


def q_wordpiece_ids(spark, sf_dir):
    """S7 + P11 + T4: WordPiece ids."""
    from corpusloom.functions.wordpiece import WordPieceTokenizer
    from corpusloom.plans.vocab_fixtures import wordpiece_vocab_file
    docs = _docs(spark, sf_dir)
    v = load_wordpiece_vocab(spark, wordpiece_vocab_file(spark, docs))
    tok = WordPieceTokenizer({r.token: r.id for r in collect_bounded(v)}, cleaned=True)
    cleaned = docs.select("doc_id", text.clean_text_for_wordpiece(F.col("text")).alias("text"))
    return _ids_digest(encode_documents(_whole_texts(cleaned), tok, keep=["doc_id"], append_eod=False))


_PUNCT = r"[!-/:-@\[-`{-~\pP]"
_BASIC = f"regexp_extract_all(strip_accents(lower(text)), '{_PUNCT}|[^\\s!-/:-@\\[-`{{-~\\pP]+')"
_SPECIALS = ", ".join(f"'{t}'" for t in SPECIAL_TOKENS)
# Vocabulary: special tokens, the 5,000 most frequent basic tokens, every character and its ## form. So a
# token is its longest known prefix, then one ## character each; one of more than 200 characters is unknown.
SQL_WORDPIECE_IDS = rf"""
WITH p AS (SELECT doc_id, unnest({_BASIC}) AS w, unnest(range(len({_BASIC}))) AS k FROM documents),
words AS (SELECT w, count(*) AS n FROM p GROUP BY w),
top AS (SELECT w AS t, 1 AS kind, row_number() OVER (ORDER BY n DESC, w) AS i FROM words ORDER BY n DESC, w LIMIT 5000),
chars AS (SELECT DISTINCT unnest(string_split(w, '')) AS c FROM words),
listed AS (SELECT unnest([{_SPECIALS}]) AS t, 0 AS kind, unnest(range({len(SPECIAL_TOKENS)})) AS i UNION ALL SELECT * FROM top
    UNION ALL SELECT c, 2, row_number() OVER (ORDER BY c) FROM chars WHERE c <> ''
    UNION ALL SELECT '##' || c, 3, row_number() OVER (ORDER BY c) FROM chars WHERE c <> ''),
first AS (SELECT t, min((kind, i)) AS place FROM listed GROUP BY t),
vocab AS (SELECT t, (row_number() OVER (ORDER BY place) - 1)::INTEGER AS id FROM first),
heads AS (SELECT w, max(j) AS j FROM words, range(1, least(length(w), {MAX_WORD_CHARS}) + 1) x(j), vocab WHERE substr(w, 1, j) = t GROUP BY w),
rest AS (SELECT w, list(v.id ORDER BY q.i) AS ids FROM (
            SELECT w, j + x.i AS i, '##' || substr(w, (j + x.i)::BIGINT, 1) AS t FROM heads, range(1, length(w) - j + 1) x(i)) q
         JOIN vocab v USING (t) GROUP BY w),
coded AS (SELECT h.w, CASE WHEN length(h.w) > {MAX_WORD_CHARS} THEN [1] ELSE list_prepend(v.id, coalesce(r.ids, [])) END AS ids
          FROM heads h JOIN vocab v ON v.t = substr(h.w, 1, h.j) LEFT JOIN rest r ON r.w = h.w),
parts AS (SELECT doc_id, k, coalesce(ids, []) AS ids FROM documents LEFT JOIN p USING (doc_id) LEFT JOIN coded USING (w))
{_DIGEST}
"""

QUERIES = {
    "trie_ids": (q_trie_ids, SQL_TRIE_IDS),
    "bpe_ids": (q_bpe_ids, SQL_BPE_IDS),
    "bpe_corpus_dictionary": (q_bpe_corpus_dictionary, SQL_BPE_IDS),
    "wordpiece_ids": (q_wordpiece_ids, SQL_WORDPIECE_IDS),
}
