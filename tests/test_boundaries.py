"""P6, learned form: statistics lead to the boundaries that the rules read from them."""

import random
import re

import pytest

from corpusloom.operators import boundaries as B


@pytest.fixture(scope="module")
def corpus():
    r = random.Random(1)
    names = ["Smith", "Jones", "Miller", "Stone"]
    verbs = ["went", "came", "slept", "spoke"]
    rows = []
    for i in range(260):
        text = []
        for _ in range(r.randrange(1, 9)):
            kind = r.randrange(6)
            text.append([f"Prof. {r.choice(names)} {r.choice(verbs)} home.", f"The house was old, cf. page {r.randrange(90)}.", f"We met J. {r.choice(names)} there!",
                         f"However, it {r.choice(verbs)} (at last.) Then they {r.choice(verbs)}.", f"Was it 3.5 or {r.randrange(9)}. Nobody knew?",
                         f"they {r.choice(verbs)} home and {r.choice(verbs)}."][kind])
        rows.append((i, r.choice([" ", "\n", "  "]).join(text), r.choice(["en", None])))
    return rows + [(900, None, "en"), (901, "", "en"), (902, " \n ", "en"), (903, "No stop at all", "fr"), (904, "A. B! c? d", "fr"), (7, rows[7][1], rows[7][2])]


def slow_sentences(text, lang, tables):
    """Rules read one token after another from the learned tables."""
    types, starters, bound, opening = tables
    found = [m for m in re.finditer(B.WORD, text or "")]

    def look(raw):
        core = re.sub(B.EDGES, "", raw)
        body = re.sub(r"[.!?]+$", "", core)
        mark = core[-1:] if core[-1:] in ".!?" else ""
        return "##" if re.search(B.NUMBER, body) else body.lower(), mark, body[:1] != body[:1].lower()
    seen, cuts = [look(m[0]) for m in found], set()
    for i, ((kind, mark, _), (after, _, upper)) in enumerate(zip(seen, seen[1:])):
        row, nxt = types.get((lang, kind)), types.get((lang, after))
        initial = len(kind) == 1 and kind.isalpha()
        low = nxt.low if nxt else 0
        inside = nxt.up - opening.get((lang, after), 0) if nxt else 0
        if mark and mark != ".":
            cuts.add(i)
        elif mark and (initial or kind == "##"):
            if (lang, kind, after) not in bound and upper and not (initial and low == 0):
                cuts.add(i)
        elif mark and row and row.abbreviation:
            if (lang, kind, after) not in bound and upper and ((lang, after) in starters or (low > 0 and inside == 0)):
                cuts.add(i)
        elif mark:
            cuts.add(i)
    return B.cut(text, cuts)


def test_boundaries_are_those_of_the_tables(spark, corpus):
    df = spark.createDataFrame([(*r, "clash", 1) for r in corpus], "doc_id long, text string, lang string, type string, i int")
    learned = B.learn(df)
    types = {(t.lang, t.type): t for t in learned.types.collect()}
    assert types["en", "prof"].abbreviation and types["en", "cf"].abbreviation and not types["en", "home"].abbreviation
    ends = learned.decisions.collect()
    opening = {}
    for e in ends:
        special = e.type == "##" or (len(e.type) == 1 and e.type.isalpha())
        if (e.mark != "." or not (special or types[e.lang, e.type].abbreviation)) and e.next_upper:
            opening[e.lang, e.next] = opening.get((e.lang, e.next), 0) + e.n
    tables = types, {(s.lang, s.type) for s in learned.starters.collect()}, {(c.lang, c.type, c.next) for c in learned.collocations.collect()}, opening
    out = B.split_learned(df, learned, "doc_id").collect()
    assert len(out) == len(corpus) and out[0].__fields__ == [*df.columns, "sentences"]
    for x in out:
        assert x.sentences == slow_sentences(x.text, x.lang or "", tables), x.text
        assert re.sub(r"\s+", "", "".join(x.sentences)) == re.sub(r"\s+", "", x.text or "")
    whole = [s for x in out for s in x.sentences]
    assert not any(s.endswith("Prof.") for s in whole) and any(s.startswith("Prof. ") and s.endswith("home.") for s in whole)


def test_nothing_to_learn(spark):
    df = spark.createDataFrame([(1, "a b! c", "x"), (2, "Plain words", None)], "doc_id long, text string, lang string")
    out = {x.doc_id: x.sentences for x in B.split_learned(df, B.learn(df), "doc_id").collect()}
    assert out == {1: ["a b!", "c"], 2: ["Plain words"]}
    assert B.split_learned(df.limit(0), B.learn(df.limit(0)), "doc_id").count() == 0


def test_tokens_are_looked_at_once_per_distinct_token(spark):
    """Counts are taken over tokens as they are written, so the table that types are
    worked out from has a row per distinct token (and follower of a final mark), not per token."""
    texts = ["Dr. Who came. He left. " * 40, "Dr. Who came.) \"He left.\" It (ended!) Now" * 3, "x.\u0085 Y.\u2028 z", None, ""]
    df = spark.createDataFrame([(i, t, "en") for i, t in enumerate(texts)], "doc_id long, text string, lang string")
    seen = {(x.raw, x.then): (x.n, x.later) for x in B.count_tokens(df, "text", "lang").collect()}
    want = {}
    for t in texts:
        found = [m[0] for m in re.finditer(B.WORD, t or "")]
        for i, w in enumerate(found):
            marked = re.search("[.!?]$", re.sub("^[\"'(\\[{]+|[\"')\\]},;:]+$", "", w.rstrip("\u0085\u2028")))
            key = w, (found[i + 1] if i + 1 < len(found) else None) if marked else None
            n, later = want.get(key, (0, 0))
            want[key] = n + 1, later + (i > 0)
    assert seen == want and len(seen) < 25
