"""Rows of every kind with further columns by the names that operators use themselves."""

import pytest
from pyspark.sql import functions as F

import public_tokenizers
from cladeframe.llm import licenses, media, packing, pii, quality, toxicity

NAMES = "h n_words llr kept trusted_id bucket matches score predicted x key base spans media n_bytes feature piece part length rank place ids z"
OPERATORS = {
    "quality": lambda d: quality.judge(d, quality.log_ratios(d, d.select("doc_id").limit(2), 64)),
    "licenses": licenses.scan,
    "toxicity": lambda d: toxicity.score(d, toxicity.Scorer(toxicity.character_counts(d), {}, toxicity.BoostedTrees())),
    "pii": lambda d: pii.digest(pii.find(d, pii.Model(None, {}))),
    "media": lambda d: media.describe(media.store(d)),
    "packing": lambda d: packing.pack(d, public_tokenizers.path("word_bpe_49k.json")).select("doc_id", "piece", "length", "ids_crc32"),
}


@pytest.mark.parametrize("name", OPERATORS)
def test_other_columns_are_ignored(name, odd, docs):
    apply = OPERATORS[name]
    rows = lambda df: sorted(map(str, df.collect()))
    more = odd.withColumns({c: F.lit("clash") for c in NAMES.split()})
    plain = rows(apply(odd))
    assert rows(apply(more)) == plain and len(plain) >= odd.count()
    assert apply(docs().limit(0).withColumns({c: F.lit(1) for c in NAMES.split()})).count() == 0
    # One row per row, repeated rows and null ids too.
    assert sum("doc_id=3," in r for r in plain) == 2 and sum("doc_id=None" in r for r in plain) == 1


def test_redacting_and_cleaning_keep_other_columns(odd):
    more = odd.withColumns({"spans": F.lit("a"), "score": F.lit(2), "base": F.lit(None).cast("string")})
    kept = toxicity.keep_clean(more, toxicity.Scorer(toxicity.character_counts(odd), {}, toxicity.BoostedTrees(base=-5.0)))
    for out in (pii.redact(more, pii.Model(None, {})), kept):
        assert out.columns == more.columns and sorted(map(str, out.collect())) == sorted(map(str, more.collect()))
