import random

from helpers import awkward, docs

from corpusloom.llm import line_dedup as L


def brute(rows, w=3):
    """Texts after the deletion, by (doc_id, text)."""
    seen, out = set(), {}
    for doc, text in sorted({(d, t) for d, t in rows if t is not None}, key=lambda r: (r[0] is None, r[0] or 0)):
        lines = text.split("\n")
        nb = [(i, x.strip(" \t\r")) for i, x in enumerate(lines) if x.strip(" \t\r")]
        gone = set()
        for j in range(len(nb) - w + 1):
            run = tuple(x for _, x in nb[j:j + w])
            if run in seen:
                gone |= {i for i, _ in nb[j:j + w]}
            seen.add(run)
        out[doc, text] = "\n".join(x for i, x in enumerate(lines) if i not in gone)
    return out


def test_against_brute_force(spark):
    r = random.Random(5)
    shared = [f"shared line {i}" for i in range(8)]
    rows = [(i, "\n".join(r.choice(shared + [f"own {i} {k}", "", "  "]) for k in range(r.randrange(0, 30)))) for i in range(150)]
    rows += [(200, "\n".join(["same"] * 50)), (201, "same\nsame"), (None, "\n".join(shared)), (202, "a\nb\nc\r\n d \ne"), (203, "a\nb\nc\nd\ne")]
    rows += [x for x in awkward() if x[0] != 12]
    out = L.dedup_lines(docs(spark, rows), counts=True)
    expect = brute(rows)
    got = sorted((x.doc_id is None, x.doc_id or 0, x.text or "", x.n_lines) for x in out.collect())
    want = sorted((d is None, d or 0, "" if t is None else expect[d, t], 0 if t is None else len(t.split("\n"))) for d, t in rows)
    assert got == want


def test_columns_and_empty(spark):
    d = docs(spark, [(1, "a\nb\nc"), (2, "a\nb\nc"), (3, None)])
    out = L.dedup_lines(d)
    assert out.columns == d.columns
    assert {x.doc_id: x.text for x in out.collect()} == {1: "a\nb\nc", 2: "", 3: None}
    assert L.dedup_lines(d.limit(0)).count() == 0


def brute_words(rows, min_words, w=3):
    seen, out = set(), {}
    for doc, text in sorted(rows):
        lines = text.split("\n")
        nb = [(i, x.strip(" \t\r")) for i, x in enumerate(lines) if x.strip(" \t\r")]
        gone = set()
        for n in range(1, w + 1):
            for j in range(len(nb) - n + 1):
                run = tuple(x for _, x in nb[j:j + n])
                if n == w or len(" ".join(run).split()) >= min_words:
                    gone |= {i for i, _ in nb[j:j + n]} if run in seen else set()
                    seen.add(run)
        out[doc] = "\n".join(x for i, x in enumerate(lines) if i not in gone)
    return out


def test_long_lines_by_words(spark):
    r = random.Random(6)
    shared = [" ".join(f"s{i}w{k}" for k in range(n)) for i, n in enumerate((60, 50, 49, 30, 25, 20, 3, 1))]
    rows = [(i, "\n".join(r.choice(shared + [f"own {i} {k}", f"own  {i}\t{k} " * 20, "", " "]) for k in range(r.randrange(0, 9)))) for i in range(120)]
    rows += [(500, shared[0]), (501, shared[2]), (502, shared[3] + "\n\n" + shared[4])]
    d = docs(spark, rows)
    out = {x.doc_id: x.text for x in L.dedup_lines(d, min_words=50).collect()}
    assert out == brute_words(rows, 50)
    assert out[500] == "" and out[501] == shared[2] and out[502].strip() == ""


def test_pipeline_deletes_long_lines(spark):
    import corpus_pipeline
    line = " ".join(f"w{k}" for k in range(60))
    out = corpus_pipeline.line_stage(spark, docs(spark, [(1, line), (2, "own\n" + line), (3, "short\nown"), (4, "short")]), "")
    assert {x.doc_id: x.text for x in out.collect()} == {1: line, 2: "own", 3: "short\nown", 4: "short"}
