import math
import random
import re
from collections import Counter

from cladeframe.llm import quality

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def base(text):
    w = WORD.findall(text or "")
    grams = [tuple(w[i : i + 5]) for i in range(len(w) - 4)]
    count = Counter(grams)
    covered = {j for i, g in enumerate(grams) if count[g] > 1 for j in range(i, i + 5)}
    lines = [x for x in (text or "").split("\n") if WORD.search(x)]
    return len(w), sum(map(len, w)), sum((text or "").count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)), len(covered)


def test_base_counts(docs, odd):
    r = random.Random(3)
    texts = [" ".join(r.choice("ab cd ef\n # $x é".split(" ")) for _ in range(r.randrange(60))) for _ in range(60)]
    texts += ["a b c d e a b c d e f", "x x x x x x x", "l\nl\n\nl\n \n", "\x1ca b", None, ""]
    rows = list(enumerate(texts))
    df = docs(*rows)
    cols = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    got = {x.doc_id: x for x in quality.judge(df, [0.0] * 64).collect()}
    for i, t in rows:
        assert tuple(got[i][c] for c in cols) == base(t), t
        n, rep = got[i].n_words, got[i].n_repeat_words
        assert got[i].base_failed == (n < 10 or 100 * rep > 20 * n)
    assert quality.judge(odd, [0.0] * 64).count() == odd.count()
    assert quality.judge(docs().limit(0), [0.0] * 64).count() == 0


def test_score_parts_clean_from_junk(spark, docs):
    r = random.Random(1)
    word = lambda: r.choice("of the and to in is that for it with as was on be by are from this at or".split())
    clean = [(i, " ".join(word() for _ in range(80))) for i in range(60)]
    junk = [(100 + i, " ".join(word() + "$%&#"[r.randrange(4)] * 3 for _ in range(80))) for i in range(12)]
    df = docs(*clean, *junk)
    labels = spark.createDataFrame([(i, 1, 0) for i, _ in clean[::2]] + [(i, 0, 0) for i, _ in junk[::2]], "doc_id long, quality int, toxic int")
    model = quality.log_ratios(df, quality.trusted_sample(labels), 1024)
    assert len(model) == 1024 and math.isfinite(sum(model))
    kept = {x.doc_id for x in quality.judge(df, model).where("kept").collect()}
    assert kept == {i for i, _ in clean}
    again = quality.log_ratios(df, quality.trusted_sample(labels), 1024)
    assert again == model
    assert quality.log_ratios(docs().limit(0), quality.trusted_sample(labels.limit(0)), 16) == [0.0] * 16


def test_whole_result_against_brute_force(spark, docs):
    """llr and kept too, from hashes that a library beside Spark computes."""
    import struct

    import xxhash

    number = lambda h: h - (1 << 64) if h >> 63 else h
    one = lambda w: number(xxhash.xxh64_intdigest(w.encode(), 42))
    step = lambda x, seed: xxhash.xxh64_intdigest(struct.pack("<q", x), seed)

    def grams(text, n):
        h = [one(w) for w in WORD.findall(text or "")]
        return [x % n for x in h] + [number(step(b, step(a, 42))) % n for a, b in zip(h, h[1:])]

    r = random.Random(11)
    rows = [(i, " ".join(r.choice(["ab", "cd", "ef", "é", "#", f"w{r.randrange(40)}"]) for _ in range(r.randrange(50)))) for i in range(50)] + [(60, None), (61, ""), (None, "ab cd " * 9), (62, rows_62 := "x y " * 30), (62, rows_62)]
    trusted = [i for i in range(0, 50, 3)]
    n = 128
    raw, target = [1.0] * n, [1.0] * n
    for i, t in rows:
        for b in grams(t, n):
            raw[b] += 1
            target[b] += i in trusted
    table = [math.log(a / sum(target)) - math.log(b / sum(raw)) for a, b in zip(target, raw)]
    df, labels = docs(*rows), spark.createDataFrame([(i, 1, 0) for i in trusted] + [(7, 0, 0), (None, 1, 0)], "doc_id long, quality int, toxic int")
    got = quality.judge(df, quality.log_ratios(df, quality.trusted_sample(labels), n), threshold=-0.02).collect()
    want = []
    for i, t in rows:
        b, own = base(t), grams(t, n)
        llr = sum(table[x] for x in own) / len(own) if own else 0.0
        failed = b[0] < 10 or 100 * b[4] > 20 * b[0]
        assert abs(llr + 0.02) > 1e-6
        want.append((str(i), *b, failed, round(llr, 7), not failed and llr >= -0.02))
    cols = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]
    assert sorted(want) == sorted((str(x.doc_id), *(x[c] for c in cols), round(x.llr, 7), x.kept) for x in got)
    assert len({x.kept for x in got}) == 2
