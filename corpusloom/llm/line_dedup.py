"""Line dedup by winnowing over line hashes, in DataFrame functions only.

Lines that hold more than blanks are hashed (after trimming). Of every window
of ``min_lines`` consecutive hashes the smallest (leftmost on ties) is chosen;
a chosen position is one *fingerprint* however many windows chose it, so any
repeated run of ``min_lines`` or more lines shares one. A fingerprint carries
the hashes of its neighbours, ``min_lines - 1`` on either side.

Positions are joined on the fingerprint's hash: those that occur once are done.
The others are extended to the left and to the right over their neighbours, to
the windows that chose them, and a window is compared with the first of its
kind: a group is a partial minimum, never a list of pairs. Overlapping matched
windows grow into the maximal repeated runs, which are deleted; the first
occurrence stays. With ``min_words``, shorter runs that reach so many words are
windows too. Windows are equal if two 64-bit hashes of each line are.

Common lines and passages: a hash that holds more than one in ``HOT_SHARE`` of
all rows is one of at most ``HOT_SHARE`` such hashes, so these are broadcast and
their rows stay where they are; only the others are shuffled to a join.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.llm.common import checkpoint, discard, fresh, prepare, stored, text_key

MIN_LINES = 3
HOT_SHARE = 1000  # a hot key has more than a thousandth of the rows: fewer than this many keys are hot


def _lines(text: Column) -> Column:
    return F.split(text, "\n", -1)


def _content(text: Column) -> Column:
    """``array<struct<i, h, g>>``: line number and two hashes of every non-blank line."""
    trimmed = F.transform(_lines(text), lambda x, i: F.struct(i.alias("i"), F.btrim(x, F.lit(" \t\r")).alias("s")))
    return F.transform(F.filter(trimmed, lambda x: x["s"] != ""), lambda x: F.struct(
        x["i"].alias("i"), F.xxhash64(x["s"]).alias("h"), F.xxhash64(F.lit(1), x["s"]).alias("g")))


def _word_counts(text: Column) -> Column:
    """Number of words of every non-blank line."""
    trimmed = F.transform(_lines(text), lambda x: F.btrim(x, F.lit(" \t\r")))
    return F.transform(F.filter(trimmed, lambda x: x != ""), lambda x: F.regexp_count(x, F.lit(r"\S+")))


def fingerprints(docs: DataFrame, column: str = "text", min_lines: int = MIN_LINES,
                 min_words: int | None = None) -> DataFrame:
    """One row per distinct fingerprint of a text: ``(doc_id, tkey, f, p, lo,
    around, check, windows)``. ``p`` is its place among the non-blank lines,
    ``around`` and ``check`` hold both hashes of the lines from ``lo`` on, at most
    ``min_lines - 1`` to either side, and ``windows`` the ``(at, n)`` of the
    windows that chose it. Windows are all runs of ``min_lines`` lines and, with
    ``min_words``, all shorter runs of so many words."""
    content = _content(F.col(column))
    rows = docs.select("doc_id", text_key(F.col(column)).alias("tkey"),
                       F.transform(content, lambda x: x["h"]).alias("h"), F.transform(content, lambda x: x["g"]).alias("g"),
                       *([_word_counts(F.col(column)).alias("words")] if min_words is not None else []))
    sizes = range(1 if min_words is not None else min_lines, min_lines + 1)

    def place(at: Column, n: int) -> Column:
        low = F.array_min(F.transform(F.slice("h", at + 1, n), lambda x, i: F.struct(x.alias("h"), (i + at).alias("p"))))
        return low["p"]

    def starts(first: Column, last: Column, n: int) -> Column:
        """Starts of windows of ``n`` lines from ``first`` to ``last``."""
        out = F.when(first <= last, F.sequence(first, last)).otherwise(F.array().cast("array<int>"))
        return out if n == min_lines else F.filter(
            out, lambda j: F.aggregate(F.slice("words", j + 1, n), F.lit(0), lambda a, x: a + x) >= min_words)

    def windows_of(p: Column, n: int) -> Column:
        near = starts(F.greatest(p - (n - 1), F.lit(0)), F.least(p, F.size("h") - n), n)
        return F.transform(F.filter(near, lambda j: place(j, n) == p), lambda j: F.struct(j.alias("at"), F.lit(n).alias("n")))

    def places(n: int) -> Column:
        return F.transform(starts(F.lit(0), F.size("h") - n, n), lambda j: place(j, n))

    chosen = F.array_distinct(F.concat(*(places(n) for n in sizes)))
    side = min_lines - 1

    def seed(p: Column) -> Column:
        lo = F.greatest(p - side, F.lit(0))
        return F.struct(F.get("h", p).alias("f"), p.alias("p"), lo.alias("lo"),
                        F.slice("h", lo + 1, p - lo + 1 + side).alias("around"),
                        F.slice("g", lo + 1, p - lo + 1 + side).alias("check"), F.concat(*(windows_of(p, n) for n in sizes)).alias("windows"))
    return (rows.where(F.size("h") >= sizes[0])
            .select("doc_id", "tkey", F.explode(F.transform(chosen, seed)).alias("s")).select("doc_id", "tkey", "s.*"))


def _join_keys(rows: DataFrame, keys: DataFrame, on: str, total: int) -> DataFrame:
    """``rows`` joined with ``keys(on, n, ...)``, one row per key, ``n`` its number
    of rows among ``total``. Fewer than ``HOT_SHARE`` keys can hold more than
    that share: their rows meet a broadcast copy in place, the others are shuffled."""
    hot = keys.where(F.col("n") * HOT_SHARE > total)
    cold = keys.where(F.col("n") * HOT_SHARE <= total)
    return (rows.join(F.broadcast(hot), on)
            .unionByName(rows.join(F.broadcast(hot.select(on)), on, "left_anti").join(cold, on)))


def repeated_windows(docs: DataFrame, column: str = "text", min_lines: int = MIN_LINES,
                     min_words: int | None = None) -> DataFrame:
    """``(doc_id, tkey, at, n)``: start and length (in non-blank lines) of every
    window that also occurs earlier (smaller ``doc_id``, nulls last, ties by the
    text's hash; or earlier in the same text)."""
    seeds = stored(fingerprints(docs, column, min_lines, min_words))
    often = checkpoint(seeds.groupBy("f").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1))
    joined = _join_keys(seeds, often, "f", seeds.count())
    # both ways over the neighbours, to the windows that chose the fingerprint
    extended = joined.select("doc_id", "tkey", "lo", "around", "check", F.explode("windows").alias("w"))
    at = F.col("w.at") - F.col("lo") + 1
    matched = stored(extended.select(
        F.concat(F.slice("around", at, F.col("w.n")), F.slice("check", at, F.col("w.n"))).alias("run"),
        F.struct(F.col("doc_id").isNull().alias("n"), "doc_id", "tkey", F.col("w.at").alias("at")).alias("k")))
    discard(seeds)
    first = checkpoint(matched.groupBy("run").agg(F.min("k").alias("first"), F.count(F.lit(1)).alias("n")).where(F.col("n") > 1))
    later = _join_keys(matched, first, "run", matched.count()).where(F.col("k") != F.col("first"))
    return later.select(F.col("k.doc_id").alias("doc_id"), F.col("k.tkey").alias("tkey"), F.col("k.at").alias("at"),
                        (F.size("run") / 2).cast("int").alias("n"))


def dedup_lines(docs: DataFrame, column: str = "text", min_lines: int = MIN_LINES,
                counts: bool = False, min_words: int | None = None) -> DataFrame:
    """``docs`` with the repeated runs of ``min_lines`` lines or, when given, of
    ``min_words`` words deleted from ``column``; ``counts`` adds ``n_lines`` and
    ``n_removed_lines`` (longs).

    Lines are split at ``\\n``. Blank lines are never compared or deleted. A
    null text stays null (no lines), an empty one empty; texts with fewer than
    ``min_lines`` lines (and ``min_words`` words) are unchanged; a text of which every line goes becomes
    empty. Rows with the same ``doc_id`` and text count as one document and
    get the same result; null ids come last; other columns are kept, whatever
    their names. Very long texts are compared whole: a fingerprint carries its
    neighbours only, never its text. An empty table gives no rows.
    """
    prepare(docs.sparkSession)
    key, hits, lines, gone = (fresh(docs, n) for n in ("_tkey", "_hits", "_lines", "_gone"))
    windows = repeated_windows(docs, column, min_lines, min_words)
    d, t = fresh(docs, "_d"), fresh(docs, "_t")
    per_doc = (windows.groupBy("doc_id", "tkey").agg(F.collect_set(F.struct("at", "n")).alias(hits))
               .select(F.col("doc_id").alias(d), F.col("tkey").alias(t), hits))
    at = docs.withColumn(key, text_key(F.col(column)))
    out = at.join(per_doc, F.col("doc_id").eqNullSafe(F.col(d)) & (F.col(key) == F.col(t)), "left")
    covered = F.array_distinct(F.flatten(F.transform(hits, lambda x: F.sequence(x["at"], x["at"] + x["n"] - 1))))
    # positions among the non-blank lines back to line numbers
    numbers = F.transform(_content(F.col(column)), lambda x: x["i"])
    out = out.withColumn(lines, _lines(F.col(column))).withColumn(
        gone, F.when(F.col(hits).isNotNull(), F.transform(covered, lambda p: F.get(numbers, p))))
    left = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), F.col(gone))
    text = F.when(F.col(gone).isNull(), F.col(column)).otherwise(
        F.array_join(F.transform(left, lambda i: F.get(F.col(lines), i)), "\n"))
    cols = [text.alias(c) if c == column else F.col(c) for c in docs.columns]
    if counts:
        cols += [F.when(F.col(column).isNull(), 0).otherwise(F.size(lines)).cast("long").alias("n_lines"),
                 F.when(F.col(gone).isNull(), 0).otherwise(F.size(gone)).cast("long").alias("n_removed_lines")]
    return out.select(*cols)


ORACLE = r"""
WITH split AS (
  SELECT doc_id, unnest(string_split(text, chr(10))) AS s, generate_subscripts(string_split(text, chr(10)), 1) AS i
  FROM documents WHERE text IS NOT NULL),
nb AS (
  SELECT doc_id, i, trim(s, ' ' || chr(9) || chr(13)) AS t, row_number() OVER (PARTITION BY doc_id ORDER BY i) AS p
  FROM split WHERE trim(s, ' ' || chr(9) || chr(13)) <> ''),
win AS (
  SELECT doc_id, p, t AS a, lead(t, 1) OVER w AS b, lead(t, 2) OVER w AS c FROM nb
  WINDOW w AS (PARTITION BY doc_id ORDER BY p)),
later AS (
  SELECT doc_id, p FROM (
    SELECT doc_id, p, row_number() OVER (PARTITION BY a, b, c ORDER BY doc_id, p) AS r FROM win WHERE c IS NOT NULL)
  WHERE r > 1),
gone AS (
  SELECT DISTINCT nb.doc_id, nb.i FROM nb JOIN later ON nb.doc_id = later.doc_id AND nb.p BETWEEN later.p AND later.p + 2),
kept AS (
  SELECT split.doc_id, string_agg(split.s, chr(10) ORDER BY split.i) AS text
  FROM split ANTI JOIN gone ON split.doc_id = gone.doc_id AND split.i = gone.i GROUP BY split.doc_id),
n AS (SELECT doc_id, count(*) AS n_removed_lines FROM gone GROUP BY doc_id)
SELECT d.doc_id, CASE WHEN d.text IS NULL THEN NULL ELSE coalesce(kept.text, '') END AS text,
       CASE WHEN d.text IS NULL THEN 0 ELSE len(string_split(d.text, chr(10))) END AS n_lines,
       coalesce(n.n_removed_lines, 0) AS n_removed_lines
FROM documents d LEFT JOIN kept ON kept.doc_id = d.doc_id LEFT JOIN n ON n.doc_id = d.doc_id
"""
