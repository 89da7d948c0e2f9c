import random
import re

from pyspark.sql import functions as F

from cladeframe.llm import licenses


def words(t):
    return re.findall(r"[a-z0-9\x80-\U0010ffff]+", "".join(c.lower() if c < "\x80" else c for c in t or ""))


def shingles(w):
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)}


def test_against_all_templates(docs, odd):
    r = random.Random(5)
    templates = [(n, t) for n, ts in licenses.TEMPLATES.items() for t in ts]
    rows = []
    for i in range(120):
        parts = [" ".join("".join(r.choice("abcde") for _ in range(4)) for _ in range(r.randrange(60))) for _ in range(3)]
        for k in range(r.randrange(3)):
            own = r.choice(templates)[1].split()
            if len(own) > 30 and r.random() < 0.5:  # a changed word or a lost end
                own[r.randrange(len(own))] = "zzz" if r.random() < 0.5 else ""
            parts.insert(k + 1, " ".join(own))
        rows.append((i, "\n".join(parts)))
    sets = [(n, shingles(words(t))) for n, t in templates]
    got = {x.doc_id: x.matches for x in licenses.scan(docs(*rows)).collect()}
    for i, t in rows:
        own = shingles(words(t))
        want = {n for n, s in sets if s and 100 * len(s & own) >= 80 * len(s)}
        assert {m["license"] for m in got[i]} == want
        for m in got[i]:
            assert any(shingles(words(t)[m["start"] : m["end"]]) & s for n, s in sets if n == m["license"])
    assert sum(len(x) for x in got.values()) > 60
    out = licenses.scan(odd)
    assert out.count() == odd.count() and out.where("size(matches) > 0").count() == 0
    assert licenses.scan(docs().limit(0)).count() == 0


def test_spans(docs):
    text = "Intro words here. Released under the MIT License. And then some. Licensed under CC BY-NC 4.0. End"
    (row,) = licenses.scan(docs((1, text))).collect()
    assert [(m["license"], words(text)[m["start"] : m["end"]]) for m in row.matches] == [("MIT", words("Released under the MIT License")), ("CC-BY-NC-4.0", words("Licensed under CC BY-NC 4.0"))]


def test_whole_licenses(docs, odd):
    """Whole licenses in wrapped and commented lines, the notices beside them, and other columns by the operator's names."""
    found = {"MIT": licenses._MIT, "BSD-3-Clause": licenses.TEMPLATES["BSD-3-Clause"][2], "ISC": licenses.TEMPLATES["ISC"][0], "Unlicense": licenses.TEMPLATES["Unlicense"][0]}
    wrap = lambda t: "/* Copyright (c) 2020 A. Uthor\n" + "\n".join(" * " + " ".join(t.split()[i : i + 9]) for i in range(0, len(t.split()), 9)) + "\n */\nint main"
    rows = docs(*((i, wrap(t)) for i, t in enumerate(found.values()))).withColumns({"matches": F.lit(1), "licenses": F.lit("x")})
    got = {r.doc_id: {m["license"] for m in r.matches} for r in licenses.scan(rows).collect()}
    assert got == {0: {"MIT"}, 1: {"BSD-3-Clause", "BSD-2-Clause"}, 2: {"ISC"}, 3: {"Unlicense"}}
