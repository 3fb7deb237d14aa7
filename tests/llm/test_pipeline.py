import hashlib

import sentencepiece as sp
from helpers import SF, awkward, docs

import corpus_pipeline as P
from corpusloom.llm import quality_rules, simhash
from corpusloom.llm.common import read_table
from corpusloom.llm.queries import piece_model_path


def test_stages_in_order(spark):
    assert [n for n, _ in P.STAGES] == ["quality_rules", "line_dedup", "simhash", "mixing", "sentencepiece"]
    lib = sp.SentencePieceProcessor(model_file=piece_model_path())
    cur = read_table(spark, SF, "documents")
    cols = cur.columns
    for name, stage in P.STAGES:
        before, cur = cur, P.stored(stage(spark, cur, SF))
        if name != "sentencepiece":
            assert cur.columns == cols and cur.dtypes == before.dtypes
        ids = {r.doc_id for r in before.select("doc_id").collect()}
        assert {r.doc_id for r in cur.select("doc_id").collect()} <= ids
        if name == "quality_rules":
            kept = {r.doc_id for r in quality_rules.score_quality(before, read_table(spark, SF, "labels")).where("kept").collect()}
            assert {r.doc_id for r in cur.select("doc_id").collect()} == kept
        if name == "line_dedup":
            assert cur.where("n_chars <> length(text)").count() == 0 and cur.count() == before.count()
        if name == "simhash":
            comp = simhash.simhash_components(before).collect()
            assert {r.doc_id for r in cur.select("doc_id").collect()} == {r.component_id for r in comp}
            assert cur.count() == len({r.component_id for r in comp})
        if name == "sentencepiece":
            text = {r.doc_id: r.text for r in before.collect()}
            for r in cur.collect():
                want = lib.encode(text[r.doc_id] or "")
                assert list(r.ids) == want and r.n_tokens == len(want)
                assert r.ids_sha256 == hashlib.sha256(",".join(map(str, want)).encode()).hexdigest()


def test_run_and_awkward_input(spark):
    assert P.run(spark, SF).count() > 0
    cur = docs(spark, awkward())
    for name, stage in P.STAGES:
        cur = P.stored(stage(spark, cur, SF))
    none = docs(spark, []).limit(0)
    for name, stage in P.STAGES:
        none = P.stored(stage(spark, none, SF))
        assert none.count() == 0
