import os

import pytest

import __spark_entry__
import corpus_pipeline
from cladeframe.llm import packing
from cladeframe.session import read_table

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")


def test_stages_one_by_one(spark):
    docs = read_table(spark, SF, "documents")
    steps = {}
    for name, f in corpus_pipeline.STAGES[:-1]:
        before, docs = docs, f(spark, docs, SF).cache()
        steps[name] = (before, docs)
        assert docs.columns == corpus_pipeline.COLUMNS
    rows = lambda df: {(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()}
    for name in ("toxicity", "near-dedup"):
        before, after = steps[name]
        assert rows(after) <= rows(before) and after.count() >= 0.7 * before.count()
    before, after = steps["pii"]
    assert after.count() == before.count() and {r.doc_id for r in after.collect()} == {r.doc_id for r in before.collect()}
    assert not [r for r in after.collect() if "@mail" in r.text]
    before, after = steps["mixing"]
    assert rows(after) <= rows(before)
    import public_tokenizers

    want = packing.pack(after, public_tokenizers.path("word_bpe_49k.json"))
    run = corpus_pipeline.run(spark, SF)
    key = lambda df: sorted((r.doc_id, r.piece, r.length, r.ids_crc32) for r in df.collect())
    assert key(run) == key(want)


def test_names():
    found = __spark_entry__.queries()
    assert [n for n in range(1, 11) if sum(q.startswith(f"op{n}_") for q in found) == 1] == list(range(1, 11)) and "pipeline" in found
