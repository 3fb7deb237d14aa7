"""Quality rules with risk-controlled thresholds.

Every rule is a number per text and a cutoff: a text above it is rejected.
Cutoffs come from labelled rows. For a stratum (language) and a rule, each
cutoff of a fixed grid is a hypothesis "more than ``alpha / rules`` of the good
texts would be rejected"; its exact binomial tail is tested at ``delta``
shared among all (stratum, rule) sequences (Bonferroni), and a sequence is
tested from the most lenient cutoff down until the first that cannot be
certified (fixed-sequence testing, no further correction needed). So with
probability ``1 - delta`` no stratum loses more than ``alpha`` of its good
texts, whichever certified cutoff is used; the one that separates the labels
best is (ties: the most lenient). A stratum with too few labels to certify
anything rejects nothing beyond the base rules.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import exp, lgamma, log, log1p

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusloom.llm.common import checkpoint, extend_schema, fresh, prepare, text_key

SYMBOLS = "#*$%&|<>"
SPACES = " \t\n\r\x0b\x0c"
WINDOW = 5                 # words of a repeated window
MIN_WORDS = 10
MAX_REPEAT_PERCENT = 20
ALPHA = 0.05               # share of good texts a stratum may lose, all rules together
DELTA = 0.05               # probability that any stratum loses more
RULES = ("symbols", "upper", "dup_lines", "repeats", "exclaim")
GRID = tuple(round(0.95 - 0.05 * i, 2) for i in range(19))  # most lenient first
MAX_BROADCAST_STRATA = 10_000
FIELDS = (("n_words", T.LongType()), ("word_chars", T.LongType()), ("n_symbols", T.LongType()),
          ("n_dup_lines", T.LongType()), ("n_repeat_words", T.LongType()),
          *((f"r_{r}", T.DoubleType()) for r in RULES))


def repeated_words(words: list[bytes]) -> int:
    """Words that lie in a window of ``WINDOW`` words found twice or more."""
    n = len(words) - WINDOW + 1
    if n < 2:
        return 0
    ids: dict[bytes, int] = {}
    w = np.fromiter((ids.setdefault(x, len(ids)) for x in words), dtype=np.uint64, count=len(words))
    h = np.zeros(n, dtype=np.uint64)
    for i in range(WINDOW):
        h = (h ^ w[i:i + n]) * np.uint64(0x9E3779B97F4A7C15)
        h ^= h >> np.uint64(29)
    order = np.argsort(h, kind="stable")
    same = np.zeros(n, dtype=bool)
    equal = h[order[1:]] == h[order[:-1]]
    same[order[1:][equal]] = True
    same[order[:-1][equal]] = True
    at = np.nonzero(same)[0]
    if not len(at):
        return 0
    runs = np.stack([w[at + i] for i in range(WINDOW)], axis=1)  # equal hashes are compared word by word
    _, back, many = np.unique(runs, axis=0, return_inverse=True, return_counts=True)
    at = at[many[back.reshape(-1)] > 1]
    mark = np.zeros(len(words) + 1, dtype=np.int64)
    np.add.at(mark, at, 1)
    np.add.at(mark, at + WINDOW, -1)
    return int((np.cumsum(mark[:-1]) > 0).sum())


def measures(text: str | None) -> tuple:
    """The values of ``FIELDS`` for one whole text (null: an empty text)."""
    text = text or ""
    words = text.encode("utf-8").split()  # bytes split at 20, 09-0D only
    n = len(words)
    chars = len(text) - sum(map(text.count, SPACES))
    symbols = sum(map(text.count, SYMBOLS))
    seen: set[str] = set()
    lines = dup = 0
    for line in text.split("\n"):
        if line.strip(SPACES):
            lines += 1
            dup += line in seen
            seen.add(line)
    repeats = repeated_words(words)
    upper = sum(map(bytes.isupper, words))
    per = max(n, 1)
    return (n, chars, symbols, dup, repeats, min(symbols / per, 1.0), upper / per, dup / max(lines, 1),
            repeats / per, min(text.count("!") / per, 1.0))


def measured(docs: DataFrame, names: list[str], column: str = "text") -> DataFrame:
    """``docs`` with the ten measures appended as ``names``."""
    at = docs.columns.index(column)
    schema = extend_schema(docs.schema, *((n, t) for n, (_, t) in zip(names, FIELDS)))
    kinds = [pa.int64() if isinstance(t, T.LongType) else pa.float64() for _, t in FIELDS]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            got = list(zip(*map(measures, b.column(at).to_pylist()))) or [()] * len(kinds)
            yield pa.RecordBatch.from_arrays([*b.columns, *(pa.array(v, k) for v, k in zip(got, kinds))],
                                             names=[*b.schema.names, *names])
    return docs.mapInArrow(run, schema)


def binomial_tail(k: int, n: int, p: float) -> float:
    """P(Bin(n, p) <= k), exact: the p-value of "the true rate is at least p"."""
    if n <= 0 or k >= n:
        return 1.0
    if k >= n * p:
        return 1.0  # no evidence against; the exact value is about a half or more
    total = 0.0
    for i in range(k + 1):
        total += exp(lgamma(n + 1) - lgamma(i + 1) - lgamma(n - i + 1) + i * log(p) + (n - i) * log1p(-p))
    return min(total, 1.0)


def choose_cutoff(good: list[int], bad: list[int], alpha: float, level: float) -> float | None:
    """Cutoff from label counts per grid bin (``bin`` b: above the first b
    cutoffs counted from the strictest, see ``_bin``), or None."""
    n_good, n_bad = sum(good), sum(bad)
    best, gain = None, 0.0
    for i, cutoff in enumerate(GRID):  # most lenient first; stop where certification fails
        from_bin = len(GRID) - i
        k, hits = sum(good[from_bin:]), sum(bad[from_bin:])
        if binomial_tail(k, n_good, alpha) > level:
            break
        now = (hits / n_bad if n_bad else 0.0) - k / n_good
        if now > gain + 1e-12:
            best, gain = cutoff, now
    return best


def _bin(value: Column) -> Column:
    """Number of grid cutoffs below the value (0: below all, no rule can reject it)."""
    return sum((F.when(value > c, 1).otherwise(0) for c in GRID), F.lit(0))


def base_failed(n_words: Column, n_repeat: Column) -> Column:
    return (n_words < MIN_WORDS) | (100 * n_repeat > MAX_REPEAT_PERCENT * n_words)


def cutoffs(measured_rows: DataFrame, labels: DataFrame, alpha: float = ALPHA, delta: float = DELTA) -> DataFrame:
    """``(stratum, c_<rule>...)`` from ``measured_rows(doc_id, stratum, tkey, <FIELDS>)``
    and ``labels(doc_id, quality)``. Equal texts of a stratum count once (copies
    are not independent draws); texts that fail the base rules don't count;
    a row with contradicting labels counts as good."""
    lab = (labels.where(F.col("quality").isNotNull() & F.col("doc_id").isNotNull())
           .groupBy("doc_id").agg(F.max(F.col("quality").cast("int")).alias("good")))
    bins = [_bin(F.col(f"r_{r}")).alias(r) for r in RULES]
    rows = (measured_rows.where(~base_failed(F.col("n_words"), F.col("n_repeat_words")))
            .join(lab, "doc_id").groupBy("stratum", "tkey", *(f"r_{r}" for r in RULES))
            .agg(F.max("good").alias("good")))
    hist = (rows.select("stratum", "good", *bins)
            .select("stratum", "good", F.explode(F.array(*(F.struct(F.lit(r).alias("rule"), F.col(r).alias("bin"))
                                                           for r in RULES))).alias("x"))
            .groupBy("stratum", "x.rule", "x.bin")
            .agg(F.sum(F.when(F.col("good") == 1, 1).otherwise(0)).alias("good"),
                 F.sum(F.when(F.col("good") == 1, 0).otherwise(1)).alias("bad")))
    hist = checkpoint(hist)  # at most strata x rules x 20 rows
    strata = hist.select("stratum").distinct().count()
    level, share = delta / max(1, strata * len(RULES)), alpha / len(RULES)

    def per_stratum(pdf):
        import pandas as pd
        out = {"stratum": pdf["stratum"].iloc[0]}
        for r in RULES:
            good, bad = [0] * (len(GRID) + 1), [0] * (len(GRID) + 1)
            for b, g, x in pdf.loc[pdf["rule"] == r, ["bin", "good", "bad"]].itertuples(index=False):
                good[int(b)] += int(g)
                bad[int(b)] += int(x)
            out[f"c_{r}"] = choose_cutoff(good, bad, share, level)
        return pd.DataFrame([out])
    return hist.groupBy("stratum").applyInPandas(
        per_stratum, "stratum string, " + ", ".join(f"c_{r} double" for r in RULES))


def _verdict(rows: DataFrame, cuts: DataFrame, stratum: Column, name: dict[str, str]) -> Column | DataFrame:
    """``rows`` joined with the cutoffs; a small table (its size is checked) is
    broadcast, a larger one joined as it is."""
    cuts = checkpoint(cuts)
    some = cuts.limit(MAX_BROADCAST_STRATA + 1).collect()
    if len(some) <= MAX_BROADCAST_STRATA:
        cuts = F.broadcast(rows.sparkSession.createDataFrame(some, cuts.schema))
    cuts = cuts.select(*(F.col(c).alias(name[c]) for c in cuts.columns))
    return rows.join(cuts, F.col(name["stratum"]) == stratum, "left")


def _run(docs: DataFrame, labels: DataFrame, column: str, stratum: str, alpha: float, delta: float, narrow: bool):
    prepare(docs.sparkSession)
    lang = F.coalesce(F.col(stratum).cast("string"), F.lit("")) if stratum in docs.columns else F.lit("")
    slim = docs.select("doc_id", lang.alias("stratum"), text_key(F.col(column)).alias("tkey"), F.col(column).alias("text"))
    rows = checkpoint(measured(slim, [n for n, _ in FIELDS]).drop("text"))
    cuts = cutoffs(rows, labels, alpha, delta)
    wide, at = (rows, F.col("stratum")) if narrow else (docs, lang)
    cols = docs.columns
    name = {n: n if narrow else fresh(docs, f"_{n}") for n, _ in FIELDS}
    if not narrow:
        wide = measured(docs, [name[n] for n, _ in FIELDS], column)
    name |= {c: fresh(wide, f"_{c}") for c in ("stratum", *(f"c_{r}" for r in RULES))}
    joined = _verdict(wide, cuts, at, name)
    bad = base_failed(F.col(name["n_words"]), F.col(name["n_repeat_words"]))
    above = [F.coalesce(F.col(name[f"r_{r}"]) > F.col(name[f"c_{r}"]), F.lit(False)) for r in RULES]
    any_above = above[0]
    for x in above[1:]:
        any_above = any_above | x
    return joined, bad, ~bad & ~any_above, above, cols


def score_quality(docs: DataFrame, labels: DataFrame, column: str = "text", stratum: str = "lang",
                  alpha: float = ALPHA, delta: float = DELTA) -> DataFrame:
    """One row per input row: ``doc_id``, the five counts, ``base_failed``,
    ``kept`` and ``failed_rules``.

    Null and empty texts have no words and fail the base rules; a null stratum
    is a stratum of its own; repeated rows each get their row; labels without
    a document, and rows without a ``doc_id``, only miss the calibration; an
    empty label table certifies nothing, so only the base rules reject; other
    columns are ignored.
    """
    joined, bad, kept, above, _ = _run(docs, labels, column, stratum, alpha, delta, True)
    failed = F.array_compact(F.array(*(F.when(a, F.lit(r)) for a, r in zip(above, RULES))))
    return joined.select("doc_id", *(n for n, _ in FIELDS[:5]), bad.alias("base_failed"), kept.alias("kept"),
                         failed.alias("failed_rules"))


def keep_good(docs: DataFrame, labels: DataFrame, column: str = "text", stratum: str = "lang",
              alpha: float = ALPHA, delta: float = DELTA) -> DataFrame:
    """The rows of ``docs`` that the rules keep, with all their columns. The
    measures are taken a second time beside the text, so no text is shuffled."""
    joined, _, kept, _, cols = _run(docs, labels, column, stratum, alpha, delta, False)
    return joined.where(kept).select(*cols)
