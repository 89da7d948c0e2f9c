import random
import re

import pytest

from cladeframe.llm import dedup


def exact(rows, num=85, den=100):
    sets = {}
    for i, t in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in t or ""))
        sets[i] = frozenset(tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))) if w else frozenset()
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(sets)
    for a in ids:
        for b in ids:
            if a < b and sets[a] and sets[b] and den * len(sets[a] & sets[b]) >= num * len(sets[a] | sets[b]):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {i: (len(sets[i]), find(i)) for i in ids}


def corpus():
    r = random.Random(7)
    word = lambda: "".join(r.choice("abcdefgh") for _ in range(4))
    rows = []
    for _ in range(12):
        base = [word() for _ in range(r.choice([6, 40, 150]))]
        for _ in range(r.choice([1, 2, 9])):
            copy = list(base)
            for _ in range(r.choice([0, 0, 1, 2, 6])):
                copy[r.randrange(len(copy))] = word()
            rows.append(" ".join(copy))
    rows += [rows[0], rows[0].upper(), "a b", "A  b", "a b c", "", None]
    r.shuffle(rows)
    return [(i * 3, t) for i, t in enumerate(rows)]


@pytest.mark.parametrize("leaf", [4096, 3])
def test_is_exact(docs, monkeypatch, leaf):
    monkeypatch.setattr(dedup, "LEAF_ROWS", leaf)
    rows = corpus()
    got = {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in dedup.near_duplicates(docs(*rows)).collect()}
    want = exact(rows)
    assert {i: x[:2] for i, x in got.items()} == want
    assert all(k == (i == c) for i, (_, c, k) in got.items())


def test_odd_rows(docs, odd, spark):
    got = sorted((r.doc_id, r.n_shingles, r.component_id, r.kept) for r in dedup.near_duplicates(odd.withColumns({"rep": odd.lang, "sig": odd.lang, "unit": odd.lang})).where("doc_id is not null").collect())
    assert [x[:3] for x in got] == [(0, 0, 0), (1, 0, 1), (2, 0, 2), (3, 1, 3), (3, 1, 3), (4, 1, 4), (5, 5000, 5), (6, 1, 6), (7, 1, 3)]
    null = dedup.near_duplicates(odd).where("doc_id is null").first()
    assert null.component_id is None and null.kept
    assert dedup.near_duplicates(docs().limit(0)).count() == 0


@pytest.mark.parametrize("leaf", [4096, 6, 3])
def test_nodes_that_stay_large(docs, monkeypatch, leaf):
    """Most words in common to all documents, so that nodes hold many groups down to the last depth; one group is large."""
    monkeypatch.setattr(dedup, "LEAF_ROWS", leaf)
    r = random.Random(4)
    word = lambda: "".join(r.choice("abcdefgh") for _ in range(4))
    shared, rows = [word() for _ in range(120)], []
    for group in range(10):
        own = [word() for _ in range(45)]
        for _ in range(40 if group == 3 else r.choice([1, 2, 5])):
            text = shared + own
            for _ in range(r.randrange(4)):
                text[r.randrange(len(text))] = word()
            rows.append(" ".join(text))
    r.shuffle(rows)
    rows = [(i * 2 + 1, t) for i, t in enumerate(rows)]
    got = {x.doc_id: (x.n_shingles, x.component_id) for x in dedup.near_duplicates(docs(*rows)).collect()}
    want = exact(rows)
    assert got == want and len({c for _, c in want.values()}) > 8


def test_trees_for_a_target_recall():
    assert dedup.trees_for(0.85) == 6 and dedup.trees_for(1.0) == 1
    for s in (0.8, 0.85, 0.95):
        n = dedup.trees_for(s)
        assert 1 - (1 - dedup.meeting(s)) ** n >= dedup.TARGET_RECALL > 1 - (1 - dedup.meeting(s)) ** (n - 1)
    with pytest.raises(ValueError):
        dedup.trees_for(0.3)


def test_recall_where_all_nodes_branch(docs, monkeypatch):
    """Pairs just at the limit, without other links, among texts that have most words in common:
    their nodes are large at all depths, and what meets there is compared."""
    monkeypatch.setattr(dedup, "LEAF_ROWS", 8)
    r = random.Random(9)
    some = lambda n: ["".join(r.choice("abcdefghijkl") for _ in range(5)) for _ in range(n)]
    shared, rows = some(60), []
    for _ in range(400):
        own = some(36)
        rows += [" ".join(shared + own + some(8)) for _ in range(2)]  # 92 of 108 shingles
    got = {x.doc_id: (x.n_shingles, x.component_id) for x in dedup.near_duplicates(docs(*enumerate(rows))).collect()}
    assert all(n == 100 for n, _ in got.values())
    assert all(c in (i, i - i % 2) for i, (_, c) in got.items())
    found = sum(got[i][1] == i - 1 for i in range(1, 800, 2))
    print("pairs found of 400:", found)
    assert found >= 396
