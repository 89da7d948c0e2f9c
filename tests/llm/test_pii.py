import hashlib
import random
import re

import numpy as np
import pytest

from cladeframe.llm import pii
from cladeframe.llm.boosting import BoostedTrees

PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def plain(text):
    def good(kind, s):
        d = re.sub("[^0-9]", "", s)
        if kind == "ip":
            return all(int(x) <= 255 for x in s.split("."))
        return {"email": True, "card": 13 <= len(d) <= 19 and pii.luhn(d), "phone": 9 <= len(d) <= 15}[kind]

    return [(k, m.start(), m.end()) for k in pii.KINDS for m in re.finditer(PATTERNS[k], text) if good(k, m[0])]


def test_base_is_the_plain_patterns():
    r = random.Random(4)
    bits = ["a@b.co", "@", "x.y+z@mail-1.example.com", "1.2.3.4", "1.2.3.4.5.6.7.8", "256.1.1.1", "0000001.2.3.4", "4111 1111 1111 1111", "4111-1111-1111-1112", "+1 (243) 555-5526", "+1", " ", ".", "é", "12", "--", "a@b@c.d", "..@x.y", "+49 30 1234567 ."]
    for _ in range(3000):
        text = "".join(r.choice(bits) for _ in range(r.randrange(9)))
        assert sorted(pii.base_spans(text)) == sorted(plain(text)), text
    for text in ("a" * 300_000, "1" * 300_000, "1." * 100_000, "@" * 100_000, "+1" * 100_000):  # no quadratic scans
        pii.base_spans(text)
        pii.wider_spans(text)


@pytest.fixture(scope="module")
def model(docs):
    r = random.Random(9)
    card = lambda: next(c for _ in iter(int, 1) if pii.luhn(c := "".join(r.choice("0123456789") for _ in range(16))))
    rows = []
    for i in range(300):
        own = r.choice([f"user{i}@mail{i % 7}.example.com", ".".join(str(r.randrange(256)) for _ in range(4)), card(), f"+1 ({r.randrange(100, 999)}) 555-{r.randrange(1000, 9999)}"])
        rows.append((i, f"the thing of {own} and that is at the dot of it. On"))
    return pii.train(docs(*rows))


def test_adds_other_spellings(model):
    text = "write to john.doe[at]example[dot]com or card 4111.1111.1111.1111 or 10[.]1[.]2[.]3 now"
    base, spans = pii.spans_of(text, model)
    assert base == [] and [text[s:e] for _, s, e in spans] == ["john.doe[at]example[dot]com", "10[.]1[.]2[.]3", "4111.1111.1111.1111"]
    assert pii.redact_text(text, model) == "write to [EMAIL] or card [CARD] or [IP] now"
    assert pii.spans_of("look at the dot over there at noon. Then 4111.1111.1111.1112", model)[1] == []


def test_table(model, docs, odd):
    text = "é me@x.org, 1.2.3.4"
    row = pii.digest(pii.find(docs((1, text)), model)).first()
    assert (row.n_email, row.n_ip, row.n_card, row.n_phone, row.spans) == (1, 1, 0, 0, "email:2:10,ip:12:19")
    assert row.base_sha256 == hashlib.sha256(b"email:2:10,ip:12:19").hexdigest()
    out = pii.digest(pii.find(odd, model))
    assert out.count() == odd.count() and out.where("spans <> ''").count() == 0
    assert sorted(map(str, pii.redact(odd, model).collect())) == sorted(map(str, odd.collect()))
    none = pii.train(docs().limit(0))
    assert pii.digest(pii.find(docs((1, text)), none)).first().spans == row.spans
    assert pii.find(docs().limit(0), none).count() == 0


def test_boosting_learns_an_interaction():
    r = np.random.default_rng(0)
    x = r.random((800, 3))
    y = ((x[:, 0] > 0.5) & (x[:, 1] > 0.5)).astype(float)
    m = BoostedTrees().fit(x[:600], y[:600]).calibrate(x[600:700], y[600:700])
    assert ((m.probability(x[700:]) > 0.5) == y[700:]).mean() > 0.93
