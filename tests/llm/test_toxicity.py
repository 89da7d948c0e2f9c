import random

import numpy as np
import pytest

from cladeframe.llm import toxicity

BAD = ["idiot", "moron", "worthless", "stupid"]


@pytest.fixture(scope="module")
def trained(spark, docs):
    r = random.Random(2)
    word = lambda: "".join(r.choice(["an", "er", "th", "on", "re", "ti", "es"]) for _ in range(r.randrange(1, 4)))
    rows, labels = [], []
    for i in range(400):
        t = [word() for _ in range(50)]
        if i % 5 == 0:
            for b in r.sample(BAD, 2):
                t.insert(r.randrange(50), b)
        rows.append((i, " ".join(t)))
        labels.append((i, 1, int(i % 5 == 0)))
    return toxicity.train(docs(*rows), spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))


@pytest.mark.parametrize(
    "text, word",
    [("1d10t", "idiot"), ("m0r0n!!", "moron"), ("w0rthl3ss", "worthless"), ("$tup1d", "stupid"), ("s.t.u.p.i.d", "stupid"), ("iiidiooot", "idiot"), ("m o r o n", "moron"), ("STUPID,", "stupid"), ("i-d-i-o-t", "idiot")],
)
def test_restores(trained, text, word):
    (words, runs), = trained.restorer().restore([text])
    assert word in words or word in runs
    assert trained.score([text], trained.restorer())[0] >= 0.7


def test_scores(trained, odd, docs):
    restorer = trained.restorer()
    low = trained.score(["an er th on reti", "", "4 5 6 $$$ %", "there is 1 thing"], restorer)
    assert (low < 0.5).all() and (low >= 0).all()
    assert set(BAD) <= {x[2:] for x in trained.lexicon if x[0] == "w"}
    out = toxicity.score(odd, trained).collect()
    assert len(out) == odd.count() and all(0 <= r.score <= 1 for r in out)
    df = docs((1, "an er th"), (2, "you 1d10t m0ron"), (3, None))
    assert sorted(r.doc_id for r in toxicity.keep_clean(df, trained).collect()) == [1, 3]
    assert toxicity.score(docs().limit(0), trained).count() == 0


def test_viterbi_is_the_best_path(trained):
    """Against all readings of short words."""
    import itertools

    ch = trained.restorer().channel
    drop, lp = {}, ch.log_p
    for word in ["1a0", "a1s$", "t.t4", "b@1", "a*", "0o0"]:
        options = []
        for i, c in enumerate(word):
            to = c if c.isalpha() else toxicity.IMITATES.get(c, "")
            own = [(x, 0.0 if c.isalpha() else -toxicity.COST_IMITATE) for x in to]
            cost = np.inf if c.isalpha() else toxicity.COST_DROP_SIGN if to else toxicity.COST_DROP_MARK
            if i and word[i - 1] == c:
                cost = min(cost, toxicity.COST_DROP_REPEAT)
            options.append(own + ([("", -cost)] if np.isfinite(cost) else []))
        best = {}
        for path in itertools.product(*options):
            text = "".join(x for x, _ in path)
            ends = [0, *(ord(x) - 96 for x in text), 0]
            value = sum(s for _, s in path) + sum(lp[a, b] for a, b in zip(ends, ends[1:]))
            best[text] = max(best.get(text, -np.inf), value)
        assert ch.decode([word])[0] == max(best, key=best.get), (word, drop)


def test_pieces_decode_as_one_pass(trained, monkeypatch):
    """Words of any length, against one pass over the whole word."""
    channel, r = trained.restorer().channel, random.Random(8)
    signs = "abcdeiostu" + "0134$@!|.-" * 2
    words = ["".join(r.choice(signs) for _ in range(n)) for n in (10, 240, 241, 300, 500, 5000)]
    words += ["".join(r.choice("0134$@!|.-") for _ in range(700)) + "idiot", "s" * 500, "ab" * 400, "a1b2" * 200 + "".join(r.choice("$10!") for _ in range(600)) + "xyz" * 100]
    got = channel.decode(words)
    monkeypatch.setattr(toxicity, "PIECE", 10**9)
    assert got == channel.decode(words) and len(list(toxicity._pieces(words[5]))) == 1
    monkeypatch.setattr(toxicity, "PIECE", 7)
    assert got == channel.decode(words)
    assert "".join(p for p, _, _ in toxicity._pieces(words[5])) == words[5] and len(list(toxicity._pieces(words[5]))) > 100


def test_long_words(trained):
    """In time that follows the length, whatever the letters."""
    import time

    began = time.time()
    long = ["x1" * 300_000, "0" * 500_000 + "a", "i" * 90_000 + "d1o" + "t" * 50, " ".join("m0r0n" * 40_000)]
    words = [w for w, _ in trained.restorer().restore(long)]
    assert "idiot" in words[2] and time.time() - began < 30


def test_without_labels(spark, docs):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    scorer = toxicity.train(docs((1, "a b c"), (2, None)), none)
    assert [r.score for r in toxicity.score(docs((1, "a b c")), scorer).collect()][0] < 0.01
    same = spark.createDataFrame([(i, 1, 0) for i in range(9)], "doc_id long, quality int, toxic int")
    assert toxicity.score(docs((1, "x")), toxicity.train(docs(*((i, "a b") for i in range(9))), same)).first().score < 0.01


def test_held_out_accuracy(spark):
    import os

    sf = "/root/testdata/sf0.01"
    if not os.path.isdir(sf):
        pytest.skip("no test tables")
    got = toxicity.op4_noisy_channel_toxicity(spark, sf).join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id").where("held_out").collect()
    clean = [r for r in got if not r.toxic]
    assert sum(r.predicted for r in clean) <= 0.02 * len(clean)
    assert sum(r.predicted for r in got if r.toxic) >= 0.75 * sum(r.toxic for r in got)
