import re

import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from cladeframe.llm import textops

WORD = re.compile(r"[^\x20\x09-\x0D]+")


@settings(max_examples=60, deadline=None)
@given(st.lists(st.one_of(st.none(), st.text(alphabet=" ab\n\té\x1cB", max_size=30)), max_size=8), st.integers(1, 40))
def test_words_and_windows(texts, slice_bytes):
    seen = {}
    for i, j, buf, offs in textops.slices(pa.array(texts, pa.string()), slice_bytes):
        words = textops.Words(buf, offs, False)
        h, first = textops.windows(words, 2, short=True)
        for r, text in enumerate(texts[i:j]):
            want = WORD.findall(text or "")
            s, e = words.first[r], words.first[r + 1]
            assert [bytes(buf[a:b]).decode() for a, b in zip(words.start[s:e], words.end[s:e])] == want
            grams = [tuple(want[k : k + 2]) for k in range(max(1, len(want) - 1))] if want else []
            own = h[first[r] : first[r + 1]].tolist()
            assert len(own) == len(grams)
            for g, x in zip(grams, own):
                assert seen.setdefault(g, x) == x
    assert len(set(seen.values())) == len(seen)


def test_per_row():
    got = textops.per_row(np.add, np.array([1, 2, 3]), np.array([0, 2, 2, 3]), -1)
    assert got.tolist() == [3, -1, 3]
