import random

import numpy as np
import pyarrow as pa
import pytest
import zstandard

from cladeframe.llm import substrings, textops


def brute(rows, window):
    seen, out = {}, {}
    for i, t in sorted(rows):
        w = (t or "").encode().split()
        gone = [False] * len(w)
        for s in range(len(w) - window + 1):
            key = tuple(w[s : s + window])
            if seen.setdefault(key, (i, s)) != (i, s):
                gone[s : s + window] = [True] * window
        out[i] = (len(w), sum(gone), b" ".join(x for x, g in zip(w, gone) if not g).decode())
    return out


@pytest.mark.parametrize("hot, slice_bytes, shard_bytes", [(1000, 2 << 20, 4 << 20), (3, 300, 900), (20, 2 << 20, 900)])
def test_against_brute_force(docs, monkeypatch, hot, slice_bytes, shard_bytes):
    monkeypatch.setattr(substrings, "HOT", hot)
    monkeypatch.setattr(substrings, "SHARD_BYTES", shard_bytes)
    monkeypatch.setattr(substrings.textops, "SLICE_BYTES", slice_bytes)
    r = random.Random(6)
    words = [f"w{i}" for i in range(300)]
    passages = [[r.choice(words) for _ in range(r.choice([19, 20, 21, 55]))] for _ in range(8)]
    rows = []
    for i in range(60):
        t = []
        for _ in range(r.randrange(5)):
            t += [r.choice(words) for _ in range(r.randrange(30))] + (r.choice(passages) if r.random() < 0.7 else [])
        rows.append((i * 7 % 61, " ".join(t)))
    rows += [(100, "a " * 70), (101, rows[0][1]), (102, rows[0][1].upper()), (103, None), (104, "")]
    got = {x.doc_id: (x.n_words, x.n_removed, x.kept) for x in substrings.remove_repeats(docs(*rows)).collect()}
    assert got == brute(rows, 20)
    assert sum(x[1] for x in got.values()) > 500


def test_odd_rows(docs, odd):
    out = substrings.remove_repeats(odd.withColumns({"z": odd.lang, "shard": odd.lang, "phrase": odd.lang}))
    assert out.count() == odd.count()
    got = {x.doc_id: x for x in out.collect()}
    assert got[5].n_removed == 55_000 and got[4].n_removed == 0 and got[None].n_removed == 0 and got[0].n_words == 0
    assert substrings.remove_repeats(docs().limit(0)).count() == 0


def test_repeated_rows(docs):
    text = " ".join(f"v{i}" for i in range(40))
    assert [x.n_removed for x in substrings.remove_repeats(docs((1, text), (1, text))).collect()] == [0, 0]


def _words(*texts):
    raw = [t.encode() for t in texts]
    return textops.Words(np.frombuffer(b"".join(raw), np.uint8), np.concatenate([[0], np.cumsum([len(x) for x in raw])]), False)


def test_automaton_finds_every_occurrence():
    """Equal to a search of each phrase at each word; none across texts."""
    r = random.Random(2)
    texts = [" ".join(r.choice("abcd") for _ in range(n)) for n in (0, 3, 400, 7, 90, 2)]
    words = _words(*texts)
    automaton, split = substrings.Automaton(6), [t.split() for t in texts]
    wanted = [("a", "b", "a", "c", "d", "a"), tuple(split[2][50:56]), tuple(split[2][51:57]), tuple(split[4][84:90])]
    for i, w in enumerate(wanted):
        packed, _ = substrings.phrases(_words(" ".join(w)), 6)
        automaton.add(packed[:1], np.array([i == 1]))
    located, hot = automaton.locate(words)
    flat = [(tuple(w[i : i + 6]) in wanted, tuple(w[i : i + 6]) == wanted[1]) for w in split for i in range(len(w))]
    assert located.tolist() == [x for x, _ in flat] and hot.tolist() == [x for _, x in flat] and located.sum() > 2


def test_places_come_from_the_automaton_alone():
    """The same texts with fewer confirmed phrases give fewer windows, with none no window."""
    text = " ".join(f"v{i}" for i in range(60))
    words = _words(text)
    packed, whole = substrings.phrases(words, 6)
    starts, anchor = substrings._anchors(words, packed, whole, 20, 6)
    known = list(dict.fromkeys(packed[anchor].tolist()))

    def windows(some):
        rows = [(0, x, False, None, None) for x in some] + [(0, None, None, 1, zstandard.compress(text.encode()))]
        schema = pa.schema([("shard", pa.int32()), ("phrase", pa.int64()), ("hot", pa.bool_()), ("doc_id", pa.int64()), ("z", pa.binary())])
        batch = pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)
        return sorted((b["start"][i].as_py(), b["n"][i].as_py()) for b in substrings._locate(20, 6)([batch]) for i in range(b.num_rows))

    assert sum(n for _, n in windows(known)) == len(starts) == 41
    for gone in range(len(known)):
        left = sum(n for _, n in windows(known[:gone] + known[gone + 1 :]))
        assert left == sum(packed[anchor] != known[gone])
    assert windows([]) == []


def test_least_of_neighbours():
    v = np.array([5, 3, 3, 9, 1, 1, 7, 0, 4], np.uint64)
    for width in range(1, 9):
        assert substrings._least(v, width).tolist() == [i + int(np.argmin(v[i : i + width])) for i in range(len(v) - width + 1)]
