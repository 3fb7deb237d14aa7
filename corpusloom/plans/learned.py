"""Registered queries of the learned sentence boundaries."""

from __future__ import annotations

from pyspark.sql import functions as F

from corpusloom.operators import boundaries as B
from corpusloom.plans.fixtures import table


def q_boundary_statistics(spark, sf_dir):
    """Abbreviations, sentence starters and collocations per language with
    their log-likelihood statistics."""
    learned = B.learn(table(spark, sf_dir, "documents"))
    number = lambda c: F.round(c, 3).alias("value")
    return (learned.types.where("abbreviation").select(F.lit("abbreviation").alias("kind"), "lang", "type", F.lit("").alias("next"),
                                                       F.col("dotted").alias("n"), number("score"))
            .unionByName(learned.starters.select(F.lit("starter").alias("kind"), "lang", "type", F.lit("").alias("next"),
                                                 F.col("after_end").alias("n"), number("ratio")))
            .unionByName(learned.collocations.select(F.lit("collocation").alias("kind"), "lang", "type", "next", "n", number("ratio"))))


def q_learned_sentences(spark, sf_dir):
    """Every document cut at its learned boundaries."""
    docs = table(spark, sf_dir, "documents")
    out = B.split_learned(docs, B.learn(docs), "doc_id")
    return out.select(F.col("doc_id").cast("long").alias("doc_id"), F.size("sentences").cast("long").alias("n_sentences"),
                      F.md5(F.array_join("sentences", chr(30))).alias("sentences_md5"))


_GAP, _WORD, _EDGES = r"[\t\n\f\r ]+", r"[^\t\n\f\r ]+", r"""^["''(\[{]+|["'')\]},;:]+$"""


def _ratio(before, word, both, total):
    def part(n, p):
        return f"CASE WHEN {n} = 0 THEN 0 ELSE {n} * ln({p}) END"
    rest, other, last = f"({before} - {both})", f"({word} - {both})", f"({total} - {before} - {word} + {both})"
    p, p1, p2 = f"({word} / {total})", f"({both} / {before})", f"({other} / ({total} - {before}))"
    same = " + ".join([part(both, p), part(rest, f"1 - {p}"), part(other, p), part(last, f"1 - {p}")])
    apart = " + ".join([part(both, p1), part(rest, f"1 - {p1}"), part(other, p2), part(last, f"1 - {p2}")])
    return f"(-2 * ({same} - ({apart})))"


_RATIO = _ratio("before::DOUBLE", "word::DOUBLE", "joint::DOUBLE", "total::DOUBLE")
_INITIAL = r"(length(type) = 1 AND regexp_matches(type, '\p{L}'))"
_LEARN = rf"""
w0 AS (SELECT doc_id, lang, regexp_extract_all(text, '{_WORD}') AS ws FROM documents),
w1 AS (SELECT doc_id, lang, unnest(ws) AS raw, unnest(range(len(ws)))::BIGINT AS i FROM w0),
w2 AS (SELECT doc_id, lang, i, regexp_replace(raw, '{_EDGES}', '', 'g') AS core FROM w1),
w3 AS (SELECT doc_id, lang, i, regexp_replace(core, '[.!?]+$', '') AS body, regexp_extract(core, '([.!?])$', 1) AS mark FROM w2),
w4 AS (SELECT doc_id, coalesce(lang, '') AS lang, i, mark, substr(body, 1, 1) <> lower(substr(body, 1, 1)) AS upper,
              CASE WHEN regexp_matches(body, '^[0-9.,-]*[0-9][0-9.,-]*$') THEN '##' ELSE lower(body) END AS type FROM w3),
t AS (SELECT *, lead(type) OVER d AS next, lead(upper) OVER d AS next_upper FROM w4 WINDOW d AS (PARTITION BY doc_id ORDER BY i)),
counts AS (SELECT lang, type, count(*) FILTER (WHERE mark = '.') AS dotted, count(*) FILTER (WHERE mark <> '.') AS plain,
                  count(*) FILTER (WHERE NOT upper AND regexp_matches(type, '\p{{L}}')) AS low, count(*) FILTER (WHERE upper AND i > 0) AS up
           FROM t WHERE type <> '' GROUP BY ALL),
totals AS (SELECT lang, sum(dotted + plain)::DOUBLE AS total, sum(dotted)::DOUBLE AS periods FROM counts GROUP BY lang),
lens AS (SELECT *, length(replace(type, '.', '')) AS chars FROM counts JOIN totals USING (lang)),
types AS (SELECT *, CASE WHEN dotted > 0 AND regexp_matches(type, '\p{{L}}') THEN
            -2 * (dotted * ln(periods / total) + CASE WHEN plain = 0 THEN 0 ELSE plain * ln(1 - periods / total) END
                  - dotted * ln({B.PERIOD_GIVEN}) - plain * ln({1 - B.PERIOD_GIVEN}::DOUBLE))
            * exp(-chars) * (length(type) - chars + 1) * pow(chars::DOUBLE, -plain::DOUBLE) ELSE 0 END AS score FROM lens),
ends AS (SELECT e.*, coalesce(score >= {B.ABBREVIATION}, false) AS abbreviation,
                mark <> '.' OR NOT (coalesce(score >= {B.ABBREVIATION}, false) OR type = '##' OR {_INITIAL}) AS first
         FROM (SELECT lang, type, mark, next, next_upper, count(*) AS n FROM t WHERE mark <> '' GROUP BY ALL) e LEFT JOIN types USING (lang, type)),
size AS (SELECT lang, type AS next, dotted + plain AS word, total FROM types),
opening AS (SELECT lang, next, sum(n) AS joint FROM ends WHERE next <> '' AND first GROUP BY ALL),
starters AS (SELECT lang, next AS type, joint AS after_end, ratio FROM (
    SELECT *, {_RATIO} AS ratio FROM opening JOIN (SELECT lang, sum(joint) AS before FROM opening GROUP BY lang) USING (lang) JOIN size USING (lang, next))
    WHERE ratio >= {B.STARTER} AND joint / before > word / total),
pairs AS (SELECT lang, type, next, sum(n) AS joint FROM ends WHERE next <> '' AND mark = '.' AND (abbreviation OR type = '##' OR {_INITIAL}) GROUP BY ALL),
collocations AS (SELECT lang, type, next, joint AS n, ratio FROM (
    SELECT *, {_RATIO} AS ratio FROM pairs JOIN (SELECT lang, type, sum(joint) AS before FROM pairs GROUP BY ALL) USING (lang, type) JOIN size USING (lang, next))
    WHERE ratio >= {B.COLLOCATION} AND joint / before > word / total AND joint >= {B.LEAST_PAIRS}
      AND (lang, next) NOT IN (SELECT (lang, type) FROM starters))
"""

SQL_BOUNDARY_STATISTICS = f"""
WITH {_LEARN}
SELECT 'abbreviation' AS kind, lang, type, '' AS next, dotted::BIGINT AS n, round(score, 3) AS value FROM types WHERE score >= {B.ABBREVIATION}
UNION ALL SELECT 'starter', lang, type, '', after_end::BIGINT, round(ratio, 3) FROM starters
UNION ALL SELECT 'collocation', lang, type, next, n::BIGINT, round(ratio, 3) FROM collocations
"""

SQL_LEARNED_SENTENCES = rf"""
WITH {_LEARN},
written AS (SELECT lang, type AS next, low, up - coalesce(o, 0) AS inside FROM types LEFT JOIN
            (SELECT lang, next AS type, sum(n) AS o FROM ends WHERE first AND next_upper GROUP BY ALL) USING (lang, type)),
decided AS (SELECT e.lang, e.type, e.mark, e.next, e.next_upper,
        CASE WHEN e.mark <> '.' THEN true
             WHEN {_INITIAL.replace('type', 'e.type')} OR e.type = '##'
                 THEN c.n IS NULL AND e.next_upper AND NOT ({_INITIAL.replace('type', 'e.type')} AND coalesce(w.low, 0) = 0)
             WHEN e.abbreviation THEN c.n IS NULL AND e.next_upper AND (s.type IS NOT NULL OR (coalesce(w.low, 0) > 0 AND coalesce(w.inside, 0) = 0))
             ELSE true END AS boundary
    FROM ends e LEFT JOIN written w ON w.lang = e.lang AND w.next = e.next LEFT JOIN starters s ON s.lang = e.lang AND s.type = e.next
    LEFT JOIN collocations c ON c.lang = e.lang AND c.type = e.type AND c.next = e.next WHERE e.next IS NOT NULL),
cuts AS (SELECT doc_id, list(i + 1 ORDER BY i) AS cuts FROM t JOIN decided USING (lang, type, mark, next, next_upper) WHERE boundary GROUP BY doc_id),
k AS (SELECT doc_id, regexp_replace(text, '^{_GAP}|{_GAP}$', '', 'g') AS body, coalesce(cuts, []) AS cuts FROM documents LEFT JOIN cuts USING (doc_id)),
x AS (SELECT doc_id, regexp_extract_all(body, '{_WORD}') AS ws, regexp_extract_all(body, '{_GAP}') AS gs, cuts FROM k),
p AS (SELECT doc_id, list_transform(ws, lambda v, j: v || coalesce(gs[j], '')) AS ps, list_concat([0], cuts) AS starts, list_concat(cuts, [len(ws)]) AS stops FROM x),
s AS (SELECT doc_id, CASE WHEN len(ps) = 0 THEN [] ELSE list_transform(starts, lambda v, j:
        regexp_replace(array_to_string(ps[v + 1 : stops[j]], ''), '{_GAP}$', '')) END AS sentences FROM p)
SELECT doc_id, len(sentences)::BIGINT AS n_sentences, md5(array_to_string(sentences, chr(30))) AS sentences_md5 FROM s
"""

QUERIES = {
    "boundary_statistics": (q_boundary_statistics, SQL_BOUNDARY_STATISTICS),
    "learned_sentences": (q_learned_sentences, SQL_LEARNED_SENTENCES),
}
