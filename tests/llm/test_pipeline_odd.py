import os
from collections import Counter

import pytest

import corpus_pipeline

SF = "/root/testdata/sf0.001"
ids = lambda df: Counter(r.doc_id for r in df.select("doc_id").collect())


def test_near_dedup_keeps_null_ids_and_one_of_repeated_rows(spark, odd, docs):
    out = corpus_pipeline.deduplicate(spark, odd, SF)
    assert out.columns == corpus_pipeline.COLUMNS
    assert ids(out) == Counter([0, 1, 2, None, 3, 4, 5, 6])
    same = " ".join(f"w{i}" for i in range(40))
    rows = docs((None, same), (None, "other"), (8, same), (8, same), (9, same), (9, "a text of its own in a row that repeats an id"), (10, None), (10, None))
    got = Counter((r.doc_id, r.text) for r in corpus_pipeline.deduplicate(spark, rows, SF).collect())
    assert got == Counter([(None, same), (None, "other"), (8, same), (9, "a text of its own in a row that repeats an id"), (10, None)])


@pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")
def test_every_stage_on_odd_rows(spark, odd):
    steps = dict(corpus_pipeline.STAGES)
    assert ids(steps["toxicity"](spark, odd, SF)) == ids(odd) == ids(steps["pii"](spark, odd, SF))
    assert set(ids(steps["mixing"](spark, odd, SF))) <= set(ids(odd))
    assert None in ids(steps["packing"](spark, odd, SF))


@pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")
@pytest.mark.parametrize("name, step", corpus_pipeline.STAGES)
def test_empty_tables_and_clashing_names(spark, docs, odd, name, step):
    extra = {c: odd.lang for c in ("score", "_id", "_row", "mix_copy", "mix_rate", "source_", "piece", "spans", "component_id", "cdf")}
    out = step(spark, docs().limit(0), SF)
    assert out.count() == 0
    more = step(spark, odd.withColumns(extra), SF)
    assert more.columns == out.columns == (corpus_pipeline.COLUMNS if name != "packing" else more.columns)
    cols = corpus_pipeline.COLUMNS[:3] if name != "packing" else ["doc_id", "piece", "length", "ids_crc32"]
    key = lambda df: Counter(map(str, df.select(*cols).collect()))
    assert key(more) == key(step(spark, odd, SF))
    texts = {r.text for r in odd.collect()}
    if name in ("toxicity", "near-dedup", "pii"):
        assert {r.text for r in more.collect()} == texts
