import math
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from cladeframe.llm import packing

PATH = pytest.importorskip("public_tokenizers").path("word_bpe_49k.json")


def test_ids_are_the_tokenizers():
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(PATH)
    texts = ["", "Hello, world.", "don't I'M it's", "Ünïcödé straße ﬁ ①", "a\x1cb c", "<|endoftext|> it's", "Σίγμα ΌΣ", "é́ é İstanbul ª²", "…“q” ,. ..", "日本 語", "x" * 500, "a b c"]
    r = random.Random(0)
    texts += ["".join(r.choice("ab .,'!1é\n\t") for _ in range(40)) for _ in range(200)]
    assert packing.token_ids(texts, PATH) == [np.asarray(t.encode(x, add_special_tokens=False).ids, "<u4").tobytes() for x in texts]


def test_ids_of_every_plain_letter_and_of_added_tokens_in_any_case():
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(PATH)
    texts = [f"{c}a{c}B{c} {c}, x{c}. A{c * 3}***" for c in map(chr, range(0x260))]
    texts += ["<|ENDOFTEXT|>", "a<|EndOfText|>B", "<|endoftext|>", "<|", "don't, abc' s it's'", "x_y, a__ 12.5. 3,"]
    assert packing.token_ids(texts, PATH) == [np.asarray(t.encode(x, add_special_tokens=False).ids, "<u4").tobytes() for x in texts]
    assert packing.token_ids([], PATH) == [] and packing.token_ids(["", " "], PATH) == [b"", b""]


def test_words_in_use_are_spelled_once_however_many_rare_ones_come(monkeypatch):
    loaded, asked = packing._load(PATH), Counter()
    loaded.update(words={}, before={})
    monkeypatch.setattr(packing, "_CACHE_WORDS", 100)
    merge = packing._merge
    monkeypatch.setattr(packing, "_merge", lambda runs, loaded: asked.update(runs) or merge(runs, loaded))
    name = lambda n: "".join(chr(97 + int(c)) for c in str(n))
    for k in range(30):
        packing.token_ids([" ".join(["often", "seen,", *(name(40 * k + i) + "qz" for i in range(40)), "y" * 100])], PATH)
    assert asked["often"] == asked["seen"] == 1 and len(asked) == 2 + 30 * 40 + 1
    assert max(map(len, packing._load(PATH)["words"])) < 100  # long words aren't kept


def test_small_batches_are_joined_and_long_texts_come_alone(monkeypatch):
    import pyarrow as pa

    monkeypatch.setattr(packing, "_SLICE_BYTES", 100)
    sizes = [10, 80, 5, 6, 300, 0, 99, 1, 2, 101]
    batches = [pa.RecordBatch.from_arrays([pa.array([i]), pa.array(["x" * n if n else None], pa.string())], ["doc_id", "text"]) for i, n in enumerate(sizes)]
    assert [t.column(0).to_pylist() for t in packing._gathered(iter(batches))] == [[0, 1, 2], [3], [4], [5, 6, 7], [8], [9]]
    assert list(packing._gathered(iter([]))) == []


def check(slots, counts, capacity):
    fill, where = defaultdict(int), Counter()
    for n, a, b, c, first, offset in slots:
        where[n] += b - a
        for i in range(a, b):
            fill[first + (i - a) // c] += n
    assert where == Counter(counts) and all(x <= capacity for x in fill.values())
    return len(fill)


@pytest.mark.parametrize("seed", range(6))
def test_plan(seed):
    r = random.Random(seed)
    cap = r.choice([16, 100, 512])
    counts = Counter(r.choice([r.randrange(1, cap + 1), r.randrange(1, cap // 4)]) for _ in range(r.choice([5, 300, 3000])))
    n = check(packing.plan(counts, cap), counts, cap)
    bound = max(math.ceil(sum(k * c for k, c in counts.items()) / cap), sum(c for k, c in counts.items() if 2 * k > cap))
    assert n <= bound + max(2, 0.02 * bound)


def test_plan_finds_exact_fills():
    assert check(packing.plan({7: 10, 3: 10}, 10), {7: 10, 3: 10}, 10) == 10
    assert check(packing.plan({5: 4, 3: 4, 2: 4}, 10), {5: 4, 3: 4, 2: 4}, 10) == 4
    assert packing.plan({}, 10) == []
    many = packing.plan({7: 10**9, 2: 10**9, 1: 10**9}, 10)
    assert len(many) == 3 and many[0][2] == 10**9  # a plan is as long for any counts


def test_pack(docs, odd):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(PATH)
    r = random.Random(1)
    rows = [(i, " ".join(r.choice(["the", "Of", "x,", "zq"]) for _ in range(r.randrange(90)))) for i in range(80)] + [(200, None), (201, "")]
    out = packing.pack(docs(*rows), PATH, capacity=64, with_ids=True).collect()
    by = defaultdict(list)
    for x in out:
        by[x.doc_id].append(x)
        assert len(x.ids) == 4 * x.length and zlib.crc32(bytes(x.ids)) == x.ids_crc32
    for i, text in rows:
        own = sorted(by[i], key=lambda x: x.piece)
        ids = np.asarray([*t.encode(text or "", add_special_tokens=False).ids, 1], "<u4").tobytes()
        assert b"".join(bytes(x.ids) for x in own) == ids
        assert [x.start for x in own] == [64 * k for k in range(len(own))] and all(x.length == 64 for x in own[:-1])
    sequences = defaultdict(list)
    for x in out:
        sequences[x.sequence_id].append((x.offset, x.length))
    for s in sequences.values():
        at = 0
        for offset, n in sorted(s):
            assert offset == at
            at += n
        assert at <= 64
    assert {x.doc_id for x in packing.pack(odd, PATH).collect()} == {x.doc_id for x in odd.collect()}
    assert packing.pack(docs().limit(0), PATH).count() == 0
