"""P6, learned form: sentence boundaries from unsupervised statistics.

The method of Kiss and Strunk (2006): log-likelihood ratios tell which types
carry their period as an abbreviation does, which words follow a sentence end
more often than chance, and which pairs around a period belong together;
orthography (is a word ever written in lower case, or in upper case inside a
sentence?) decides the rest. All counts are aggregations per language over the
whole corpus; nothing is trained beforehand.

1. ``count_tokens``: one pass over the texts counts tokens as they are written
   (those with a final mark together with the token behind); the rows that are
   shuffled are one per (task, distinct token). Types, marks and capitals are
   worked out per distinct token, not per occurrence.
2. Abbreviations, starters and collocations are joins of such count tables.
3. Whether a period ends a sentence depends on (type, mark, next type, is the
   next one capitalised) alone. So the decision is made once per distinct
   combination (``decide``), and classification is one join of the tokens
   with a final mark, a narrow row each, with the combinations that are boundaries.
4. ``split_learned`` gathers a document's boundaries and cuts its text in one
   pass over it; sentences keep their inner white space.

Defined cases: a null language is a language of its own; null and empty texts
have no sentences; equal rows get equal sentences; a corpus without periods
learns nothing and ``!`` and ``?`` still end sentences.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusloom.functions.base import bounded_pieces
from corpusloom.session import prepare_session, stored_table

# Fixed values of the published method.
ABBREVIATION = 0.3      # least score of an abbreviation
STARTER = 30.0          # least ratio of a frequent sentence starter
COLLOCATION = 7.88      # least ratio of a collocation
PERIOD_GIVEN = 0.99     # chance of a period after an abbreviation
LEAST_PAIRS = 2         # occurrences of a collocation

GAP = "\t\n\f\r "
WORD = "[^\\t\\n\\f\\r ]+"
EDGES = "^[\"'(\\[{]+|[\"')\\]},;:]+$"
NUMBER = "^[0-9.,-]*[0-9][0-9.,-]*$"
MARKED = "[.!?][\"')\\]},;:]*[\\x85\\u2028\\u2029]?\\z"  # `$` also stands before a last line break


def words(df: DataFrame, text: str, lang: str, *keep: str) -> DataFrame:
    """One row per token as it is written (``raw``), with the token behind it
    (``then``, null at the end of the text)."""
    rows = df.select(*keep, F.coalesce(lang, F.lit("")).alias("lang"),
                     F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(WORD), 0).alias("w"))
    behind = F.slice("w", 2, F.greatest(F.size("w"), F.lit(1)))
    rows = rows.select(*keep, "lang", F.posexplode(F.arrays_zip(F.col("w").alias("raw"), behind.alias("then"))).alias("i", "p"))
    return rows.select(*keep, "lang", "i", "p.raw", "p.then")


def may_end(raw: Column) -> Column:
    """False only for tokens without a final mark."""
    return raw.rlike(MARKED)


def looks(df: DataFrame, raw: str, kind: str, mark: str, upper: str) -> DataFrame:
    """``df`` with the type of a token, its final mark and whether it is capitalised
    in place of ``raw``. Every step is a projection of its own, so nothing is
    worked out twice."""
    rest = [c for c in df.columns if c != raw]
    rows = df.select(*rest, F.regexp_replace(raw, EDGES, "").alias("_core"))
    rows = rows.select(*rest, F.regexp_extract("_core", "([.!?])$", 1).alias(mark), F.regexp_replace("_core", "[.!?]+$", "").alias("_body"))
    first = F.substring("_body", 1, 1)
    return rows.select(*rest, mark, F.when(F.col("_body").rlike(NUMBER), "##").otherwise(F.lower("_body")).alias(kind),
                       (first != F.lower(first)).alias(upper))


def _times_log(n: Column, p: Column) -> Column:
    return F.when(n == 0, 0.0).otherwise(n * F.log(p))


def log_likelihood(before: Column, word: Column, both: Column, total: Column) -> Column:
    """Dunning's ratio: does ``word`` follow this context more (or less) often
    than other tokens? Counts of the context, the word, both, and all tokens."""
    p, p1, p2 = word / total, both / before, (word - both) / (total - before)
    rest, other, last = before - both, word - both, total - before - word + both
    same = _times_log(both, p) + _times_log(rest, 1 - p) + _times_log(other, p) + _times_log(last, 1 - p)
    apart = _times_log(both, p1) + _times_log(rest, 1 - p1) + _times_log(other, p2) + _times_log(last, 1 - p2)
    return -2.0 * (same - apart)


def _is_initial(kind: Column) -> Column:
    return (F.length(kind) == 1) & kind.rlike("\\p{L}")


@dataclass
class Boundaries:
    types: DataFrame         # lang, type, dotted, plain, low, up, score, abbreviation
    starters: DataFrame      # lang, type, after_end, ratio
    collocations: DataFrame  # lang, type, next, n, ratio
    decisions: DataFrame     # lang, type, mark, next, next_upper, n, boundary


def count_tokens(df: DataFrame, text: str, lang: str) -> DataFrame:
    """Distinct written tokens per language (with the token behind, if they may
    end a sentence): occurrences, and those behind another token."""
    rows = words(df, text, lang)
    return (rows.select("lang", "raw", F.when(may_end(F.col("raw")), F.col("then")).alias("then"), "i").groupBy("lang", "raw", "then")
            .agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("i") > 0).alias("later")))


def count_types(seen: DataFrame) -> DataFrame:
    """Per language and type: occurrences with and without a final period, in
    lower case, and capitalised behind another token."""
    dotted = F.col("mark") == "."
    letter = F.col("type").rlike("\\p{L}")
    number = lambda c, n="n": F.sum(F.when(c, F.col(n)).otherwise(0))
    written = seen.groupBy("lang", "raw").agg(F.sum("n").alias("n"), F.sum("later").alias("later"))
    return (looks(written, "raw", "type", "mark", "upper").where("type <> ''").groupBy("lang", "type")
            .agg(number(dotted).alias("dotted"), number(~dotted).alias("plain"),
                 number(letter & ~F.col("upper")).alias("low"), number(F.col("upper"), "later").alias("up")))


def abbreviation_scores(counts: DataFrame) -> DataFrame:
    totals = counts.groupBy("lang").agg(F.sum(F.col("dotted") + F.col("plain")).alias("total"), F.sum("dotted").alias("periods"))
    c1, c0 = F.col("dotted"), F.col("plain")
    p = F.col("periods") / F.col("total")
    length = F.length(F.replace("type", F.lit("."), F.lit("")))
    inner = F.length("type") - length
    ratio = -2.0 * (_times_log(c1, p) + _times_log(c0, 1 - p) - c1 * F.log(F.lit(PERIOD_GIVEN)) - c0 * F.log(F.lit(1 - PERIOD_GIVEN)))
    score = F.when((c1 > 0) & F.col("type").rlike("\\p{L}"), ratio * F.exp(-length) * (inner + 1) * F.pow(length.cast("double"), -c0))
    scored = counts.join(totals, "lang").withColumn("score", F.coalesce(score, F.lit(0.0)))
    return scored.withColumn("abbreviation", F.col("score") >= ABBREVIATION)


def learn(df: DataFrame, text: str = "text", lang: str = "lang") -> Boundaries:
    """The statistics of ``df``, stored as tables."""
    prepare_session(df.sparkSession)
    seen = stored_table(count_tokens(df, text, lang))
    types = stored_table(abbreviation_scores(stored_table(count_types(seen))))
    marked = looks(seen.where(may_end(F.col("raw"))).select("lang", "raw", "then", "n"), "raw", "type", "mark", "upper").where("mark <> ''")
    marked = looks(marked.drop("upper"), "then", "next", "next_mark", "next_upper")
    ends = marked.groupBy("lang", "type", "mark", "next", "next_upper").agg(F.sum("n").alias("n"))
    known = types.where("abbreviation").select("lang", "type", F.lit(True).alias("_abbr"))
    special = (F.col("type") == "##") | _is_initial(F.col("type"))
    ends = stored_table(ends.join(known, ["lang", "type"], "left").withColumn("abbreviation", F.coalesce("_abbr", F.lit(False))).drop("_abbr")
                        .withColumn("first", (F.col("mark") != ".") | ~(F.col("abbreviation") | special)))  # a boundary at first sight
    size = types.select("lang", F.col("type").alias("next"), (F.col("dotted") + F.col("plain")).alias("word"), "total")
    followed = ends.where("next <> ''")  # null: nothing follows
    opening = followed.where("first").groupBy("lang", "next").agg(F.sum("n").alias("both"))
    opened = opening.groupBy("lang").agg(F.sum("both").alias("before"))
    ratio = log_likelihood(F.col("before"), F.col("word"), F.col("both"), F.col("total"))
    likelier = F.col("both") / F.col("before") > F.col("word") / F.col("total")
    starters = stored_table(opening.join(opened, "lang").join(size, ["lang", "next"]).withColumn("ratio", ratio)
                            .where((F.col("ratio") >= STARTER) & likelier)
                            .select("lang", F.col("next").alias("type"), F.col("both").alias("after_end"), "ratio"))
    bound = (F.col("mark") == ".") & (F.col("abbreviation") | special)
    pairs = followed.where(bound).groupBy("lang", "type", "next").agg(F.sum("n").alias("both"))
    heads = pairs.groupBy("lang", "type").agg(F.sum("both").alias("before"))
    together = (pairs.join(heads, ["lang", "type"]).join(size, ["lang", "next"]).withColumn("ratio", ratio)
                .where((F.col("ratio") >= COLLOCATION) & likelier & (F.col("both") >= LEAST_PAIRS)))
    collocations = stored_table(together.join(starters.select("lang", F.col("type").alias("next")), ["lang", "next"], "left_anti")
                                .select("lang", "type", "next", F.col("both").alias("n"), "ratio"))
    return Boundaries(types, starters, collocations, stored_table(decide(ends, types, starters, collocations)))


def decide(ends: DataFrame, types: DataFrame, starters: DataFrame, collocations: DataFrame) -> DataFrame:
    """Whether each combination (type, mark, next type, next one capitalised) is a boundary."""
    shown = ends.where(F.col("first") & F.col("next_upper")).groupBy("lang", F.col("next").alias("type")).agg(F.sum("n").alias("_opening"))
    written = (types.join(shown, ["lang", "type"], "left")
               .select("lang", F.col("type").alias("next"), "low", (F.col("up") - F.coalesce("_opening", F.lit(0))).alias("inside")))
    full = (ends.join(written, ["lang", "next"], "left")
            .join(starters.select("lang", F.col("type").alias("next"), F.lit(True).alias("_start")), ["lang", "next"], "left")
            .join(collocations.select("lang", "type", "next", F.lit(True).alias("_bound")), ["lang", "type", "next"], "left"))
    low, inside = F.coalesce("low", F.lit(0)), F.coalesce("inside", F.lit(0))
    upper, bound = F.coalesce("next_upper", F.lit(False)), F.coalesce("_bound", F.lit(False))
    opens = upper & (F.coalesce("_start", F.lit(False)) | ((low > 0) & (inside == 0)))
    initial = _is_initial(F.col("type"))
    boundary = (F.when(F.col("next").isNull() | (F.col("mark") != "."), True)
                .when(initial | (F.col("type") == "##"), ~bound & upper & ~(initial & (low == 0)))
                .when(F.col("abbreviation"), ~bound & opens)
                .otherwise(True))
    return full.select("lang", "type", "mark", "next", "next_upper", "n", boundary.alias("boundary"))


def split_learned(df: DataFrame, learned: Boundaries, id_col: str, text: str = "text", lang: str = "lang") -> DataFrame:
    """``df`` with ``sentences``: its text cut behind the tokens that are boundaries."""
    key = F.xxhash64(id_col, text)
    toks = words(df.withColumn("_key", key), text, lang, id_col, "_key").where(may_end(F.col("raw")) & F.col("then").isNotNull())
    toks = looks(looks(toks, "raw", "type", "mark", "upper").drop("upper"), "then", "next", "next_mark", "next_upper").where("mark <> ''")
    ends = learned.decisions.where("boundary AND next IS NOT NULL").drop("n", "boundary")
    cuts = (toks.join(ends, ["lang", "type", "mark", "next", "next_upper"])
            .groupBy(F.col(id_col).alias("_id"), F.col("_key").alias("_k")).agg(F.collect_set("i").alias("_cuts")))
    rows = df.withColumn("_key", key)
    rows = rows.join(cuts, rows[id_col].eqNullSafe(F.col("_id")) & (F.col("_key") == F.col("_k")), "left")
    schema = T.StructType([*df.schema.fields, T.StructField("sentences", T.ArrayType(T.StringType()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in (p for whole in batches for p in bounded_pieces(whole, text)):
            out = [cut(t, c) for t, c in zip(b.column(text).to_pylist(), b.column("_cuts").to_pylist())]
            yield pa.RecordBatch.from_arrays([*b.columns[:-1], pa.array(out, pa.list_(pa.string()))], names=schema.names)
    return rows.select(*df.columns, "_cuts").mapInArrow(run, schema)


def cut(text: str | None, cuts) -> list[str]:
    """The text cut behind the tokens with these numbers; inner white space stays."""
    body, out, start = (text or "").strip(GAP), [], 0
    cuts = set(cuts if cuts is not None else ())
    if cuts:
        for i, m in enumerate(re.finditer(WORD, body)):
            if i in cuts:
                out.append(body[start:m.end()].lstrip(GAP))
                start = m.end()
    rest = body[start:].lstrip(GAP)
    return [*out, rest] if rest else out
