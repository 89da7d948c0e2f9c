import random

import pytest

from cladeframe.llm import pii


def spellings(r, i):
    return r.choice([f"({r.randrange(200, 999)}) 555-{r.randrange(1000, 9999)}", f"jo{i} [at] host{i % 5} [dot] com", f"10[.]{i % 256}[.]2[.]3"])


@pytest.fixture(scope="module")
def full(docs):
    """Trained where most personal data is spelt in the wider formats."""
    r = random.Random(3)
    rows = [(i, f"the thing of {spellings(r, i)} and that is at the dot of it. On") for i in range(400)]
    rows += [(1000 + i, f"the thing of user{i}@mail.example.com and +1 (243) 555-{1000 + i} and 10.0.{i}.7 is here") for i in range(30)]
    return pii.train(docs(*rows))


@pytest.mark.parametrize("own", ["(415) 555-0132", "(415)555-0132", "1-415-555-0132", "john [at] x [dot] com", "10[.]1[.]2[.]3", "4111–1111–1111–1111", "4111 - 1111 - 1111 - 1111"])
def test_wider_spellings_in_the_corpus_are_no_negatives(full, own):
    text = f"the thing of {own} and that is at"
    assert [text[s:e] for _, s, e in pii.spans_of(text, full)[1]] == [own]


def test_broken_forms_stay_out(full):
    for text in ("look at the dot over there at noon. Then", "see 4111 - 1111 - 1111 - 1112 there", "the 300[.]1[.]2[.]3 of it", "on 2024-01-02 at 12.30, 0.123 4567"):
        assert pii.spans_of(text, full)[1] == [], text


def test_a_corpus_with_rare_or_no_personal_data(docs):
    model = pii.train(docs(*((i, "nothing to see here") for i in range(50)), (None, "one john@x.com only")))
    text = "write to john [at] x [dot] com or (415) 555-0132"
    assert pii.redact_text(text, model) == "write to [EMAIL] or [PHONE]"
