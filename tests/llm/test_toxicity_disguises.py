import pytest

from test_toxicity import trained  # noqa: F401

from cladeframe.llm import toxicity


@pytest.mark.parametrize("text", ["stuupid", "iddiot", "mooron", "woorthlless", "(1d10t", "(stupid)", "i d i o t", "sttuuppiidd", "wwoorrtthhlleessss"])
def test_doubled_disguises(trained, text):  # noqa: F811
    assert trained.score([text], trained.restorer())[0] >= 0.7


def test_words_without_any_letter():
    import numpy as np

    counts = np.zeros((27, 27))
    r = toxicity.Restorer(counts.ravel(), ("ass", "shit", "slut", "cunt"))
    tokens = ["@$$", "4$$", "$|!+", "51|_|+", "(unt", "(see", "$100", "2020-01-01", "+1-555", "50%", "ass,"]
    r.prepare(set(tokens))
    assert [r.words[t] for t in (*tokens[:2], tokens[3])] == ["ass", "ass", "slut"] and r.words["(unt"] == "cunt" and r.words["ass,"] == "ass"
    assert [r.words[t] for t in tokens[5:10]] == ["see", "$100", "2020-01-01", "+1-555", "50%"]


def test_readings_of_doubled_letters():
    assert toxicity.reduced("asshoole") == ["asshole", "ashoole", "ashole"] and toxicity.reduced("heel") == ["hel"] and toxicity.reduced("plain") == []
    assert toxicity.reduced("aabbccddee") == ["abcde"]


@pytest.mark.parametrize("text", ["st|_|pid", "$+|_|p1|)", "()idiot", "m()r()n", "\\/\\/orthless", "1|)1()t", "(st|_|pid),", "|\\/|oron", "woRT|-|less"])
def test_letters_of_several_signs(trained, text):  # noqa: F811
    assert trained.score([text], trained.restorer())[0] >= 0.7


@pytest.mark.parametrize("text", ["|---|---|", "a/b", "f()", "/usr/an/er", "<br/>", "||", "\\/\\/\\/", "/\\" * 3000])
def test_signs_that_are_no_word(trained, text):  # noqa: F811
    assert trained.score([text], trained.restorer())[0] < 0.5


def test_glyphs_on_the_best_path(trained):  # noqa: F811
    """Against all ways to cut short words into characters and glyphs."""
    import numpy as np

    channel = trained.restorer().channel

    def paths(word, i):
        if i == len(word):
            yield "", 0.0
            return
        c = word[i]
        to = c if c.isalpha() else toxicity.IMITATES.get(c, "")
        cost = np.inf if c.isalpha() else toxicity.COST_DROP_SIGN if to else toxicity.COST_DROP_MARK
        if i and word[i - 1] == c:
            cost = min(cost, toxicity.COST_DROP_REPEAT)
        steps = [(x, 0.0 if c.isalpha() else toxicity.COST_IMITATE, 1) for x in to] + [("", cost, 1)]
        steps += [(x, toxicity.COST_IMITATE, len(g)) for g, x in toxicity.GLYPHS.items() if word.startswith(g, i)]
        for x, price, n in steps:
            if np.isfinite(price):
                for rest, value in paths(word, i + n):
                    yield x + rest, value - price

    def value_of(text, value):
        ends = [0, *(ord(x) - 96 for x in text), 0]
        return value + sum(channel.log_p[a, b] for a, b in zip(ends, ends[1:]))

    words = ["s|_|t", "|-|a", "\\/\\/e", "/\\/\\", "|\\/|o", "|\\|()", "t/-\\n", "1|)|_|", "plain", "><|<", "()()"]
    assert channel.decode(words) == [max(paths(w, 0), key=lambda p: value_of(*p))[0] for w in words]


SPLIT = ["mo ron", "m oron", "mor on", "st up id", "wor thl ess", "m\no\nr\no\nn", "id\niot", "m\u00a0o\u00a0r\u00a0o\u00a0n", "stu\u2003pid", "an er mo ron, th", "sstu ppid", "st. up. id", "1di ot", "w 0 r t h l 3 s s"]
OTHER = ["\uff4d\uff4f\uff52\uff4f\uff4e", "\uff29\uff24\uff29\uff2f\uff34", "m\u043er\u043en", "m\u00f6r\u00f6n", "st\u00fap\u00efd!", "w\u043erthl\u0435ss", "i\u200bdiot", "\u0455tupid", "st\u00fc pid"]


@pytest.mark.parametrize("text", SPLIT + OTHER)
def test_blanks_anywhere_and_other_letters(trained, text):  # noqa: F811
    assert trained.score([text], trained.restorer())[0] >= 0.7


@pytest.mark.parametrize("text", ["m oronan", "anmo ron", "mo an ron", "mo\u00e9 ron", "wo rth", "mor an on", "id io", "mor", "st ap id", "an er th \u00e9reti"])
def test_what_is_no_word_of_the_lexicon(trained, text):  # noqa: F811
    assert trained.score([text], trained.restorer())[0] < 0.5


def test_windows_are_all_places(trained):  # noqa: F811
    """Against a search token by token, in texts of short pieces."""
    import random

    r, words = random.Random(6), ["moron", "idiot", "stupid"]
    across = toxicity.Across(words)
    texts = [" ".join(r.choice(["mo", "ron", "m", "o", "r", "n", "id", "iot", "i", "d", "t", "stu", "pid", "an", "x"]) for _ in range(r.randrange(0, 60))) for _ in range(200)]
    for text, got in zip(texts, across.windows(texts)):
        tokens = text.split()
        once = lambda x: toxicity._once(x)
        want = set()
        for a in range(len(tokens)):
            for z in range(a + 1, len(tokens)):
                whole = "".join(tokens[a : z + 1])
                # No repeat at an edge could be left out: then a shorter window is the word.
                if once(whole) in words and once("".join(tokens[a + 1 : z + 1])) != once(whole) and once("".join(tokens[a:z])) != once(whole):
                    want.add(" ".join(tokens[a : z + 1]))
        assert want == set(got), text
