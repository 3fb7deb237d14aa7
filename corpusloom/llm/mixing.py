"""Mixing to target weights with soft domain membership, in DataFrame functions only.

1. A naive Bayes classifier is fitted on a bounded sample of labelled rows: the
   presence of the most telling words and of binned surface measures. It gives
   every document a posterior ``p`` over the domains.
2. Nonnegative document rates ``r`` are fitted so that the expected domain
   totals ``A r = sum_d r_d * tokens_d * p_d`` match the targets ``T``:
   projected gradient on ``|A r - T|^2``, weighted by the inverse of
   ``M = sum_d tokens_d * p_d p_d'`` and measured in the inner product that
   weighs documents by tokens. There a unit step is at most the inverse
   Lipschitz constant, so it converges, in one step where no rate touches zero;
   where some do, the usual acceleration shortens the way.
   One iteration is one sum over the compact table ``(tokens, p, r)``; only a
   vector with a number per domain passes through the driver.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.llm.common import checkpoint, fresh, prepare, text_key

DOMAINS = ("clean", "junk", "toxic")
SHARES = {"clean": 0.90, "junk": 0.04, "toxic": 0.06}   # of all tokens
SAMPLE_PER_DOMAIN = 1500   # labelled rows of a domain that the classifier is fitted on, at most
WORDS = 2048               # most telling words that the classifier looks at, kept as a table
MAX_ROUNDS = 400
TOLERANCE = 1e-9
SETTLED = 1e-5             # of all targets: totals that move less in each of three rounds have converged
BREAKS = (0.02, 0.05, 0.1, 0.2, 0.35, 0.5, 0.7, 0.9)


def label_domain(labels: DataFrame) -> DataFrame:
    """``(doc_id, domain)`` from quality and toxicity labels; toxic wins, rows
    with a null label or contradicting labels are left out."""
    d = F.when(F.col("toxic") == 1, "toxic").when(F.col("quality") == 0, "junk").otherwise("clean")
    return (labels.where("doc_id IS NOT NULL AND quality IS NOT NULL AND toxic IS NOT NULL")
            .groupBy("doc_id").agg(F.min(d).alias("domain"), F.max(d).alias("other"))
            .where("domain = other").select("doc_id", "domain"))


def _words(text: Column) -> Column:
    """Lower-case words of a text (null: none)."""
    return F.array_remove(F.split(F.lower(F.coalesce(text, F.lit(""))), "[ \\t\\n\\x0B\\f\\r]+"), "")


def _measures(text: str, words: str) -> Column:
    """Binned surface measures as feature names."""
    t, n = F.coalesce(F.col(text), F.lit("")), F.greatest(F.size(words), F.lit(1))
    marks = F.length(t) - F.length(F.replace(t, F.lit("!"), F.lit("")))
    parts = {"symbols": F.regexp_count(t, F.lit("[#*$%&|<>]")) / n, "marks": marks / n,
             "upper": F.regexp_count(t, F.lit("[A-Z]{2}")) / n,
             "variety": F.size(F.array_distinct(words)) / n, "short": F.lit(10.0) / (n + 10)}
    bins = [F.concat(F.lit(f"{name} "), sum((F.when(value > b, 1).otherwise(0) for b in BREAKS), F.lit(0)).cast("string"))
            for name, value in parts.items()]
    return F.array(*bins)


def _first(rows: DataFrame, domain: str, n: int) -> DataFrame:
    return rows.where(F.col("domain") == domain).orderBy(F.xxhash64("doc_id"), "doc_id", "tkey").limit(n)


def fit_classifier(docs: DataFrame, labels: DataFrame, column: str = "text",
                   per_domain: int = SAMPLE_PER_DOMAIN, words: int = WORDS):
    """``(vocabulary, weights)``: the chosen words as a table ``(f, l0, l1, ..)``
    with the log likelihood in each domain (None without labelled rows), and the
    same per surface measure; ``weights[""]`` holds the log priors, minus
    infinity for a domain without labelled rows in ``docs`` (all zero when no
    domain has any). ``labels`` has ``doc_id`` and ``domain``; sample and
    priors are taken from the labelled rows of ``docs`` only."""
    key = text_key(F.col(column))
    here = checkpoint(docs.select("doc_id", key.alias("tkey")).join(labels, "doc_id")
                      .groupBy("doc_id", "tkey", "domain").agg(F.count(F.lit(1)).alias("n")))
    seen = {r["domain"]: r["n"] for r in here.groupBy("domain").agg(F.sum("n").alias("n")).collect()
            if r["domain"] in DOMAINS}
    picked = None
    for d in DOMAINS:
        part = _first(here, d, per_domain)
        picked = part if picked is None else picked.unionByName(part)
    # at most domains x per_domain rows, so the broadcast is bounded
    picked = checkpoint(picked.select(F.col("doc_id").alias("d"), F.col("tkey").alias("k"), "domain"))
    rows = (docs.join(F.broadcast(picked), (F.col("doc_id") == F.col("d")) & (key == F.col("k")))
            .groupBy("d", "k", "domain").agg(F.first(column).alias("t")))  # repeated rows are one document
    rows = rows.withColumn("w", _words(F.col("t")))
    rows = checkpoint(rows.select("domain", F.array_distinct("w").alias("w"), _measures("t", "w").alias("m")))
    size = {r["domain"]: r["n"] for r in rows.groupBy("domain").agg(F.count(F.lit(1)).alias("n")).collect()}
    total = sum(size.values())
    if not total:
        return None, {"": [0.0] * len(DOMAINS)}

    def counted(feature: str) -> DataFrame:
        return rows.select("domain", F.explode(feature).alias("f")).groupBy("f").agg(
            F.count(F.lit(1)).alias("n"), *(F.sum(F.when(F.col("domain") == d, 1).otherwise(0)).alias(d) for d in DOMAINS))
    # how much a word tells for the one domain that it favours most
    gain = F.array_max(F.array(F.lit(0.0), *(
        F.when(F.col(d) > 0, F.col(d) * F.log(F.col(d) * F.lit(total) / (F.col("n") * F.lit(size[d])))).otherwise(0.0)
        for d in DOMAINS if d in size)))
    # one more row that has the feature as often as all rows do: a domain with
    # few rows, or none, gains nothing from what it has not seen
    usual = (F.col("n") + 0.5) / (total + 1.0)
    logs = [F.log((F.col(d) + usual) / (size.get(d, 0) + 1.0)).alias(f"l{k}") for k, d in enumerate(DOMAINS)]
    best = checkpoint(counted("w").orderBy(F.round(gain, 6).desc(), "f").limit(words).select("f", *logs))
    bins = counted("m").select("f", *logs).collect()  # a few dozen
    everyone = sum(seen.values())
    weights = {"": [float(np.log(seen[d] / everyone)) if d in seen else float("-inf") for d in DOMAINS]}
    weights |= {r["f"]: [r[f"l{k}"] for k in range(len(DOMAINS))] for r in bins}
    return best, weights


def _adder(table: Column):
    return lambda total, f: total + F.coalesce(F.element_at(table, f), F.lit(0.0))


def posteriors(docs: DataFrame, vocabulary: DataFrame | None, weights: dict[str, list[float]], column: str = "text") -> DataFrame:
    """``(doc_id, tkey, n_tokens, p)``, ``p`` an array in the order of ``DOMAINS``."""
    df = docs.select("doc_id", text_key(F.col(column)).alias("tkey"), F.col(column).alias("t"))
    df = df.withColumn("w", _words(F.col("t")))
    df = df.select("doc_id", "tkey", F.size("w").cast("long").alias("n_tokens"), "w", _measures("t", "w").alias("f"))
    logit = []
    for k in range(len(DOMAINS)):
        table = F.create_map(*(x for f, v in weights.items() if f for x in (F.lit(f), F.lit(v[k])))) if len(weights) > 1 else None
        start = F.lit(weights[""][k])
        logit.append(start if table is None else F.aggregate("f", start, _adder(table)))
    if vocabulary is not None:
        # a row per distinct word and one for no word, so that every text stays; only known words reach the sum
        mark = [F.lit("").alias("f"), *(F.lit(0.0).alias(f"l{k}") for k in range(len(DOMAINS)))]
        known = vocabulary.unionByName(docs.sparkSession.range(1).select(*mark))  # bounded by the number of words
        df = df.select(F.monotonically_increasing_id().alias("row"), "doc_id", "tkey", "n_tokens",
                       *(x.alias(f"z{k}") for k, x in enumerate(logit)), F.array_append(F.array_distinct("w"), "").alias("w"))
        df = (df.select("row", "doc_id", "tkey", "n_tokens", *(f"z{k}" for k in range(len(DOMAINS))), F.explode("w").alias("f"))
              .join(F.broadcast(known), "f").groupBy("row")
              .agg(*(F.first(c).alias(c) for c in ("doc_id", "tkey", "n_tokens")),
                   *((F.first(f"z{k}") + F.sum(f"l{k}")).alias(f"z{k}") for k in range(len(DOMAINS)))))
        logit = [F.col(f"z{k}") for k in range(len(DOMAINS))]
    df = df.select("doc_id", "tkey", "n_tokens", F.array(*logit).alias("z"))
    e = F.transform("z", lambda x: F.exp(x - F.array_max("z")))
    df = df.withColumn("z", e)
    s = F.aggregate("z", F.lit(0.0), lambda a, x: a + x)
    return df.withColumn("p", F.transform("z", lambda x: x / s)).drop("z")


def _dot(p: Column, v: np.ndarray) -> Column:
    return sum((p[k] * F.lit(float(x)) for k, x in enumerate(v)), F.lit(0.0))


def fit_rates(members: DataFrame, targets: np.ndarray, rounds: int = MAX_ROUNDS) -> DataFrame:
    """``members`` (with ``n_tokens`` and ``p``) plus ``rate``; ``targets`` are
    domain token totals; a domain that no document belongs to has none. Rates
    start at one. Raises when the totals still move after ``rounds``."""
    k = len(targets)
    p, t = F.col("p"), F.col("n_tokens")
    got = members.agg(*(F.coalesce(F.sum(t * p[i] * p[j]), F.lit(0.0)).alias(f"m{i}_{j}") for i in range(k) for j in range(i, k))).first()
    m = np.array([[got[f"m{min(i, j)}_{max(i, j)}"] for j in range(k)] for i in range(k)])
    weight = np.linalg.pinv(m, rcond=1e-10, hermitian=True)
    targets = np.where(np.diag(m) > 0, targets, 0.0)
    scale = max(float(np.abs(targets).sum()), 1.0)
    # accelerated: the gradient is taken at "ahead", a little further along the last move
    state, last, quiet = members.withColumn("rate", F.lit(1.0)).withColumn("ahead", F.lit(1.0)), None, 0
    for i in range(rounds):
        sums = [F.coalesce(F.sum(F.col(c) * t * p[j]), F.lit(0.0)).alias(f"{c}{j}") for c in ("rate", "ahead") for j in range(k)]
        now = state.agg(*sums).first()
        miss, there = (np.array([now[f"{c}{j}"] for j in range(k)]) - targets for c in ("rate", "ahead"))
        quiet = quiet + 1 if last is not None and np.abs(miss - last).max() <= SETTLED * scale else 0
        if np.abs(miss).max() <= TOLERANCE * scale or quiet == 3:
            break
        last = miss
        state = (state.withColumn("new", F.greatest(F.lit(0.0), F.col("ahead") - _dot(p, weight @ there)))
                 .withColumn("ahead", F.col("new") + F.lit(i / (i + 3.0)) * (F.col("new") - F.col("rate")))
                 .withColumn("rate", F.col("new")).drop("new"))
        if i % 6 == 5:
            state = checkpoint(state)
    else:
        raise RuntimeError(f"rates have not converged after {rounds} rounds: totals miss their targets by {miss.tolist()}")
    return state.drop("ahead")


def mixed(docs: DataFrame, labels: DataFrame, column: str = "text", shares: dict[str, float] | None = None,
          factors: dict[str, float] | None = None) -> DataFrame:
    """``(doc_id, tkey, n_tokens, p, rate)`` for every row. ``shares`` are parts
    of the corpus' own token total; ``factors`` (used instead when given)
    multiply each domain's present expected total."""
    prepare(docs.sparkSession)
    vocabulary, weights = fit_classifier(docs, labels, column)
    members = checkpoint(posteriors(docs, vocabulary, weights, column))
    t, p = F.col("n_tokens"), F.col("p")
    sums = members.agg(*(F.coalesce(F.sum(t * p[i]), F.lit(0.0)).alias(f"s{i}") for i in range(len(DOMAINS)))).first()
    have = np.array(list(sums), dtype=float)
    if factors is not None:
        targets = have * np.array([factors[d] for d in DOMAINS])
    else:
        targets = have.sum() * np.array([(shares or SHARES)[d] for d in DOMAINS])
    return fit_rates(members, targets)


def document_rates(docs: DataFrame, labels: DataFrame, column: str = "text", shares: dict[str, float] | None = None) -> DataFrame:
    """One row per input row: ``doc_id``, ``n_tokens``, ``p_<domain>``, ``rate``.

    ``labels`` has ``doc_id``, ``quality``, ``toxic``. Null and empty texts have
    no tokens and never weigh; repeated rows get equal rates and weigh twice;
    without labelled rows every posterior is uniform; a domain without labelled
    rows in ``docs`` has probability 0 and no target; targets that no rates
    reach leave the least-squares rest; other columns are ignored; an empty
    table gives no rows.
    """
    out = mixed(docs, label_domain(labels), column, shares)
    return out.select("doc_id", "n_tokens", *(F.col("p")[i].alias(f"p_{d}") for i, d in enumerate(DOMAINS)), "rate")


def apply_rates(docs: DataFrame, labels: DataFrame, column: str = "text", shares: dict[str, float] | None = None,
                factors: dict[str, float] | None = None) -> DataFrame:
    """``docs`` with every row given ``floor(rate + u)`` times, ``u`` a uniform
    hash of the row, so that the expected number of copies is the rate."""
    rates = mixed(docs, label_domain(labels), column, shares, factors).groupBy("doc_id", "tkey").agg(F.min("rate").alias("rate"))
    key, n, d, t, r = (fresh(docs, c) for c in ("_tkey", "_copies", "_d", "_t", "_rate"))
    rates = rates.select(F.col("doc_id").alias(d), F.col("tkey").alias(t), F.col("rate").alias(r))
    u = F.pmod(F.xxhash64(F.lit(5), d, t), F.lit(1 << 30)) / float(1 << 30)
    copies = F.floor(F.round(F.col(r), 9) + u)
    at = docs.withColumn(key, text_key(F.col(column)))
    out = at.join(rates, F.col("doc_id").eqNullSafe(F.col(d)) & (F.col(key) == F.col(t))).where(copies >= 1)
    return out.withColumn(n, F.explode(F.sequence(F.lit(1).cast("long"), copies))).select(*docs.columns)
