"""Toxicity by noisy-channel deobfuscation (operator 4).

A word that may be disguised is a lattice: each character stands for itself, for the
letters it imitates, or for nothing (separators, repeats), and some signs together for
one letter (GLYPHS). Viterbi decoding under a
character bigram model, counted over the whole corpus, restores the likeliest letters;
numpy decodes all words of a batch at once. Words of letters only need no lattice: where
letters are doubled, their readings with single ones are looked up too. A lexicon and its weights are learned from
restored words of labelled documents, and documents are scored on restored text.
Everything over documents is a map or a pre-aggregated count; texts are not shuffled.
"""

from __future__ import annotations

import math
import re
import unicodedata
from collections import Counter, deque
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cladeframe.llm import textops
from cladeframe.llm.boosting import BoostedTrees
from cladeframe.session import read_table, stage

TRAIN_ROWS = 8_000  # labelled documents that train the lexicon and the score, at most
STEMS = range(4, 9)  # lengths of the stems of words
MANY = 3  # different words of one stem that make a mark of their own
REJECT = 0.7
PIECE = 240  # characters that are decoded in one go, if a letter can end them
_CACHE_WORDS = 80_000

# The letters that a character may stand for; '' lets it stand for nothing.
IMITATES = {
    "0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "gb", "7": "t", "8": "b", "9": "g",
    "@": "a", "$": "s", "!": "i", "|": "il", "+": "t", "*": "aeiou", "#": "aeiou", "(": "c", "€": "e", "£": "l",
    ".": "", "-": "", "_": "", " ": "", "~": "", "^": "", "'": "", "/": "", "\\": "", ",": "", ":": "", ";": "",
}
# Letters drawn with several signs.
GLYPHS = {
    "/\\": "a", "/-\\": "a", "|)": "d", "|-|": "h", "|<": "k", "|\\/|": "m", "|\\|": "n", "()": "o",
    "|_|": "u", "\\/": "v", "\\/\\/": "w", "><": "x",
}
COST_IMITATE, COST_DROP_SIGN, COST_DROP_MARK, COST_DROP_REPEAT = 0.5, 3.0, 0.1, 1.0

# Letters of other alphabets that look like those of this one.
LOOKALIKES = {
    "\u0430": "a", "\u0432": "b", "\u0435": "e", "\u0456": "i", "\u0458": "j", "\u043a": "k", "\u043c": "m", "\u043d": "h", "\u043e": "o", "\u0440": "p",
    "\u0441": "c", "\u0442": "t", "\u0443": "y", "\u0445": "x", "\u0455": "s", "\u0501": "d", "\u04bb": "h", "\u051b": "q", "\u051d": "w",
    "\u03b1": "a", "\u03b5": "e", "\u03b9": "i", "\u03ba": "k", "\u03bd": "v", "\u03bf": "o", "\u03c1": "p", "\u03c4": "t", "\u03c5": "u", "\u03c7": "x",
    "\u0131": "i", "\u0142": "l", "\u00f8": "o", "\u0111": "d", "\u0261": "g", "\u00df": "ss",
}
#: Single characters apart by blanks of any kind: a word spaced out.
_SPACED = re.compile(r"(?<!\S)\S(?:\s+\S){2,}(?!\S)")
_COMBINING = re.compile("[\u0300-\u036f\u200b-\u200d\u2060\ufeff\u00ad]+")
_LOOK = re.compile("|".join(LOOKALIKES))
_EDGE = "".join(c for c, to in IMITATES.items() if not to) + "\"?()[]{}<>«»“”…"
_MARKS = _EDGE.replace("(", "")  # those that imitate no letter
_POINTS = ".,:;\"?!"  # those that no glyph has
_GLYPH = re.compile("|".join(re.escape(g) for g in sorted(GLYPHS, key=len, reverse=True)))
#: A number as it is written: nothing to decode.
_NUMBER = re.compile(r"[+$€£#~-]*[0-9][0-9.,:/-]*[%+]?")
_TRIPLE = re.compile(r"(.)\1\1")
_DOUBLE = re.compile(r"(.)\1")
_RUN = re.compile(r"(.)\1*")
_LONG_RUN = re.compile(r"(.)\1{3,}")


def fold(text: str) -> str:
    """Lower-cased text with wide and other compatible forms, accents and look-alikes as plain
    letters, and without characters of no width."""
    if text.isascii():
        return text
    return _LOOK.sub(lambda m: LOOKALIKES[m[0]], _COMBINING.sub("", unicodedata.normalize("NFKD", text)).lower())


def _code(c: str) -> int:
    return ord(c) - 96 if "a" <= c <= "z" else 0


def _pieces(word: str) -> Iterator[tuple[str, int, bool]]:
    """(characters, state before them, whether the word ends with them) of pieces of a word. A
    letter that repeats neither neighbour can be nothing else and isn't dropped: a place to cut."""
    at, state = 0, 0
    while len(word) - at > PIECE:
        sure = (i for r in (range(at + PIECE - 1, at, -1), range(at + PIECE, len(word) - 1)) for i in r if _code(word[i]) and word[i - 1] != word[i] != word[i + 1])
        cut = next(sure, None)
        if cut is None:
            break
        yield word[at : cut + 1], state, False
        at, state = cut + 1, _code(word[cut])
    yield word[at:], state, True


class Channel:
    """Viterbi decoder over states 0 (a border) and 1 to 26 (the last letter)."""

    def __init__(self, counts: np.ndarray, lexicon: tuple[str, ...] = ()):
        counts = counts.reshape(27, 27).astype(float) + 0.5
        p = counts / counts.sum(1, keepdims=True)
        if lexicon:  # words to look for weigh more than the corpus
            own = np.full((27, 27), 0.01)
            for w in lexicon:
                ends = [0, *map(_code, w), 0]
                np.add.at(own, (ends[:-1], ends[1:]), 1.0)
            p = (p + 3 * own / own.sum(1, keepdims=True)) / 4
        self.log_p = np.log(p)

    def decode(self, words: list[str]) -> list[str]:
        """The likeliest letters of each word; characters that imitate nothing are dropped.

        Runs of one character count as three. A word of more than PIECE characters is cut after
        letters that leave the decoder in one state only, so that its pieces are decoded side
        by side to the letters of one pass over the whole word; stretches without such a letter
        stay whole. Time and memory follow the length."""
        pieces, parts = [], []
        for w in words:
            own = list(_pieces(_LONG_RUN.sub(r"\1\1\1", w)))
            parts.append(len(own))
            pieces += own
        read = iter(self._decode_all(pieces))
        return ["".join(next(read) for _ in range(n)) for n in parts]

    def _decode_all(self, pieces: list[tuple[str, int, bool]]) -> list[str]:
        out = [""] * len(pieces)
        order = sorted(range(len(pieces)), key=lambda i: len(pieces[i][0]))
        at = 0
        while at < len(order):
            end, width = at, 1
            while end < len(order) and (end == at or (end - at + 1) * len(pieces[order[end]][0]) <= 400_000):
                width = max(width, len(pieces[order[end]][0]))
                end += 1
            for i, w in zip(order[at:end], self._decode([pieces[i] for i in order[at:end]], width)):
                out[i] = w
            at = end
        return out

    def _decode(self, pieces: list[tuple[str, int, bool]], width: int) -> Iterator[str]:
        words, begin, last = zip(*pieces)
        alphabet = sorted(set("".join(words)))
        index = {c: i + 1 for i, c in enumerate(alphabet)}
        ways = max((len(IMITATES.get(c, "")) for c in alphabet), default=1) or 1
        letter, price = np.zeros((len(alphabet) + 1, ways), int), np.full((len(alphabet) + 1, ways), np.inf)
        drop = np.full(len(alphabet) + 1, COST_DROP_SIGN)
        drop[0] = 0.0
        for c, i in index.items():
            to = c if _code(c) else IMITATES.get(c, "")
            letter[i, : len(to)] = [_code(x) for x in to]
            price[i, : len(to)] = 0.0 if _code(c) else COST_IMITATE
            drop[i] = np.inf if _code(c) else COST_DROP_SIGN if to else COST_DROP_MARK
        n = len(words)
        text = np.zeros((n, width), np.int32)
        for r, w in enumerate(words):
            text[r, : len(w)] = [index[c] for c in w]
        best = np.full((n, 27), -np.inf)
        best[np.arange(n), begin] = 0.0
        back = np.zeros((width, n, 27), np.int8)
        rows = np.arange(n)
        drawn = _drawn(words)
        span = np.ones((width, n, 27), np.int8) if drawn else None  # characters that a letter takes
        past: deque[np.ndarray] = deque(maxlen=max(map(len, GLYPHS)))
        for t in range(width):
            past.append(best)
            c = text[:, t]
            cost = drop[c].copy()
            if t:
                again = (c == text[:, t - 1]) & (c > 0)
                cost[again] = np.minimum(cost[again], COST_DROP_REPEAT)
            new = best - cost[:, None]
            back[t] = -1  # dropped: the state stays
            for k in range(ways):
                some = rows[np.isfinite(price[c, k])]
                if len(some):
                    to = letter[c[some], k]
                    from_ = best[some] + self.log_p.T[to]
                    prev = from_.argmax(1)
                    value = from_[np.arange(len(some)), prev] - price[c[some], k]
                    better = value > new[some, to]
                    new[some[better], to[better]] = value[better]
                    back[t, some[better], to[better]] = prev[better]
            for size, (r, to) in drawn.get(t, {}).items():
                from_ = past[-size][r] + self.log_p.T[to]
                prev = from_.argmax(1)
                value = from_[np.arange(len(r)), prev] - COST_IMITATE
                better = value > new[r, to]
                r, to = r[better], to[better]
                new[r, to], back[t, r, to], span[t, r, to] = value[better], prev[better], size
            best = new
        state = (best + np.where(np.array(last)[:, None], self.log_p[:, 0], 0.0)).argmax(1)
        made = np.zeros((width, n), np.uint8)
        ahead = np.full(n, width)  # where the part that is read begins
        for t in range(width - 1, -1, -1):
            prev = back[t, rows, state]
            put = (prev >= 0) & (t < ahead)
            made[t, put] = state[put] + 96
            if span is not None:
                ahead = np.where(put, t + 1 - span[t, rows, state].astype(int), ahead)
            state = np.where(put, prev, state)
        for col in np.ascontiguousarray(made.T):
            yield col[col > 0].tobytes().decode()


def _drawn(words: tuple[str, ...]) -> dict[int, dict[int, tuple[np.ndarray, np.ndarray]]]:
    """Position of its last character -> its characters -> (words, letters) of all glyphs. No two
    of one size end at one place."""
    found: dict[int, dict[int, tuple[list, list]]] = {}
    for r, w in enumerate(words):
        if _GLYPH.search(w):
            for g, to in GLYPHS.items():
                at = w.find(g)
                while at >= 0:
                    own = found.setdefault(at + len(g) - 1, {}).setdefault(len(g), ([], []))
                    own[0].append(r)
                    own[1].append(_code(to))
                    at = w.find(g, at + 1)
    return {t: {size: (np.array(r), np.array(to)) for size, (r, to) in own.items()} for t, own in found.items()}


#: The one letter by which a character is looked for across blanks: letters that one character may stand for are alike.
_ALIKE = np.zeros(256, np.uint8)
for _c in map(chr, range(97, 123)):
    _ALIKE[ord(_c)] = ord({"l": "i", "b": "g"}.get(_c, _c))
for _c, _to in IMITATES.items():
    if _to and _c.isascii() and len(_to) < 3:
        _ALIKE[ord(_c)] = _ALIKE[ord(_to[0])]
_ALIKE[0] = 1  # between texts
_BLANK = np.zeros(256, bool)
_BLANK[[0, 9, 10, 11, 12, 13, 28, 29, 30, 31, 32]] = True


class Across:
    """Where words of the lexicon may stand with blanks in them: in the letters of all texts without
    blanks, marks and repeats, from the start of one token to the end of a later one; in texts
    with other than ASCII characters, also of the same one. Words of four letters or more
    (repeats once) are looked for; not those in whose place a sign for any vowel stands."""

    def __init__(self, words: list[str]):
        self.automaton, own = ahocorasick.Automaton(), {}
        for w in words:
            key, at, run = self._letters(np.frombuffer(w.encode("ascii", "replace"), np.uint8))
            if w.isascii() and len(key) >= 4:
                size = np.diff(np.append(run, len(at)))
                own[key] = np.minimum(own.get(key, size), size)  # repeats that a word has itself must be there
        for key, size in own.items():
            self.automaton.add_word(key, (len(key), size))
        if len(self.automaton):
            self.automaton.make_automaton()

    @staticmethod
    def _letters(buf: np.ndarray) -> tuple[str, np.ndarray, np.ndarray]:
        """(letters, without repeats; places of all; where each run of repeats begins)."""
        kind = _ALIKE[buf]
        at = np.flatnonzero(kind)
        own = kind[at]
        run = np.flatnonzero(np.concatenate([[True], own[1:] != own[:-1]])) if len(own) else np.zeros(0, int)
        return own[run].tobytes().decode("latin-1"), at, run

    def windows(self, texts: list[str]) -> list[list[str]]:
        """Per text, its folded parts that may be a word of the lexicon with blanks in it, or in other letters."""
        plain = [t.isascii() for t in texts]
        texts = [fold(t) for t in texts]
        out: list[list[str]] = [[] for _ in texts]
        if not len(self.automaton):
            return out
        whole = "\0".join(texts).encode("ascii", "replace").decode()
        buf = np.frombuffer(whole.encode(), np.uint8)
        letters, at, run = self._letters(buf)
        if not len(run):
            return out
        token = np.cumsum(_BLANK[buf])[at]
        new = np.concatenate([[True], (token[1:] != token[:-1]) | (buf[at[:-1]] == 0)])
        ends = np.concatenate([new[1:], [True]])
        begins, stops = np.logical_or.reduceat(new, run), np.logical_or.reduceat(ends, run)
        last = np.append(run[1:], len(at))
        first_text = np.cumsum([0, *(len(t) + 1 for t in texts)])
        for e, (size, repeats) in self.automaton.iter(letters):
            b = e - size + 1
            if begins[b] and stops[e] and (last[b : e + 1] - run[b : e + 1] >= repeats).all():
                a = run[b] + int(np.flatnonzero(new[run[b] : last[b]])[-1])
                z = run[e] + int(np.flatnonzero(ends[run[e] : last[e]])[0])
                t = int(np.searchsorted(first_text, at[a], "right")) - 1
                if token[a] < token[z] or not plain[t]:
                    out[t].append(whole[at[a] : at[z] + 1])
        return out


def _core(token: str) -> str:
    """A token without the marks at its edges."""
    return token.strip(_EDGE)


def _once(word: str) -> str:
    return re.sub(r"(.)\1+", r"\1", word)


def reduced(word: str, most: int = 4) -> list[str]:
    """The other readings of a word with doubled letters: any of its runs as a single letter;
    beyond `most` runs, all of them."""
    if not _DOUBLE.search(word):
        return []
    runs = [m[0] for m in _RUN.finditer(word)]
    if sum(len(x) > 1 for x in runs) > most:
        return [_once(word)]
    made = [""]
    for x in runs:
        made = [m + y for m in made for y in ((x, x[0]) if len(x) > 1 else (x,))]
    return made[1:]


class Restorer:
    """Tokens to restored words, with a cache that saves time only."""

    def __init__(self, counts: np.ndarray, lexicon: tuple[str, ...] = ()):
        self.channel, self.words = Channel(counts, lexicon), {}
        self.marks: dict[str, tuple[str, ...]] = {}
        self.single = {_once(w): w for w in lexicon}  # decoding may drop one of two equal letters
        self.lexicon = frozenset(lexicon)
        self.across = Across(list(lexicon))
        self.windows: dict[str, str | None] = {}

    def readings(self, word: str) -> list[str]:
        """The word as it is; where letters are doubled and it is no word of the lexicon, also
        with single ones, and the word of the lexicon that differs in doubled letters only."""
        if word in self.lexicon or not _DOUBLE.search(word):
            return [word]
        found = self.single.get(_once(word))
        return [word, *reduced(word), *([found] if found else [])]

    def prepare(self, tokens: set[str]) -> None:
        if len(self.words) > _CACHE_WORDS:
            self.words.clear()
        odd, edged = [], []  # edged: tokens with another core
        for token in tokens.difference(self.words):
            if token.isascii() and token.isalpha() and not _TRIPLE.search(token):
                self.words[token] = token
                continue
            core = _core(token)
            if core.isalpha() and not _TRIPLE.search(core):
                self.words[token] = core  # doubled letters: Scorer.inputs reads them both ways
            elif any("a" <= c <= "z" for c in core) or (any(IMITATES.get(c) for c in core) and not _NUMBER.fullmatch(core)):
                odd.append(token)
            else:
                self.words[token] = core
            edged += [(token, x) for x in {token.strip(_MARKS), *([token.strip(_POINTS)] if _GLYPH.search(token) else [])} if x != core and ("(" in token or _GLYPH.search(x))]
        for token, word in zip(odd, self.channel.decode([_core(fold(x)) for x in odd])):
            self.words[token] = self.single.get(_once(word), word)
        # A bracket or glyph at an edge is a letter where that makes a word of the lexicon, and a mark otherwise.
        for (token, _), word in zip(edged, self.channel.decode([x for _, x in edged])):
            word = self.single.get(_once(word), word)
            if word in self.lexicon:
                self.words[token] = word

    def restore(self, texts: list[str]) -> list[tuple[set[str], list[str]]]:
        """Per text: its restored words, and the spaced-out runs and words across blanks put together."""
        lower = [t.lower() for t in texts]
        split = [set(t.split()) for t in lower]
        runs = [[m[0] for m in _SPACED.finditer(t)] for t in lower]
        self.prepare(set().union(*split))
        joined = list({r for x in runs for r in x if sum("a" <= c <= "z" or c in IMITATES or not c.isascii() for c in r) > 2})
        back = dict(zip(joined, self.channel.decode(["".join(fold(r).split()) for r in joined])))
        broken = self.across.windows(lower)
        self._read({w for x in broken for w in x})
        found = [[y for w in x if (y := self.windows[w])] for x in broken]
        return [({self.words[t] for t in s}, [back[r] for r in x if r in back] + y) for s, x, y in zip(split, runs, found)]

    def _read(self, windows: set[str]) -> None:
        """Decode windows of several tokens, a blank being a mark that drops: the word of the
        lexicon that one is, or None."""
        if len(self.windows) > _CACHE_WORDS:
            self.windows.clear()
        new = sorted(windows.difference(self.windows))
        for w, word in zip(new, self.channel.decode([" ".join(w.split()) for w in new])):
            self.windows[w] = self.single.get(_once(word))


def character_counts(docs: DataFrame) -> np.ndarray:
    """Bigrams of a-z and borders over the lower-cased texts of all documents, 27 x 27.

    Each task sums its own; what is shuffled grows with the tasks, the result does not."""
    table = np.zeros(256, np.int32)
    table[97:123] = np.arange(1, 27)
    table[65:91] = np.arange(1, 27)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(729, np.int64)
        for b in batches:
            for _, _, buf, _ in textops.slices(b.column(0)):
                if len(buf):
                    code = np.concatenate([[0], table[buf], [0]])
                    total += np.bincount(code[:-1] * 27 + code[1:], minlength=729)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(729)), pa.array(total)], names=["pair", "n"])

    counts = np.zeros(729, np.int64)
    sums = docs.select(F.col("text").cast("string")).mapInArrow(run, "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n"))
    for r in sums.collect():  # 729 rows
        counts[r["pair"]] = r["n"]
    counts[0] = 0
    return counts


def held_out(doc_id: Column) -> Column:
    """Whether crc32 of the id as text leaves 1 when divided by 3; null ids: never."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def clusters(sample: DataFrame, keys: int = 8) -> dict[int, int]:
    """doc_id -> cluster of a bounded sample (TRAIN_ROWS): documents that share any of
    `keys` least shingle hashes. Eight numbers a document come to the driver."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seeds = np.random.default_rng(5).integers(1, 2**62, keys, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
        for b in batches:
            for i, j, buf, offs in textops.slices(b.column(0)):
                shingles, first = textops.windows(textops.Words(buf, offs, True), 5, short=True)
                least = np.stack([textops.per_row(np.minimum, (shingles * k) >> np.uint64(1), first, 0) for k in seeds], 1).astype(np.int64)
                yield pa.RecordBatch.from_arrays([b.column(1).slice(i, j - i), pa.array(least.tolist(), pa.list_(pa.int64()))], names=["doc_id", "least"])

    root: dict = {}

    def find(x):
        while root.setdefault(x, x) != x:
            root[x] = x = root[root[x]]
        return x

    ids = []
    for r in sample.select("text", "doc_id").mapInArrow(run, "doc_id long, least array<long>").collect():
        ids.append(r["doc_id"])
        for k, h in enumerate(r["least"]):
            if h:
                root[find((k, h))] = find(r["doc_id"])
    names = {}
    return {d: names.setdefault(find(d), len(names)) for d in ids}


def marks(words: set[str], runs: list[str]) -> list[str]:
    """What the lexicon is chosen from: words of three letters or more ("w:"), stems ("s:"), and
    stems of many words ("m:")."""
    words = {w for w in (*words, *runs) if len(w) >= 3}
    stems = Counter(w[:k] for w in words for k in STEMS if len(w) > k)
    return [*(f"w:{w}" for w in words), *(f"s:{x}" for x in stems), *(f"m:{x}" for x, n in stems.items() if n >= MANY)]


class Scorer:
    """Boosted trees over what the marks of a document weigh: the largest weight, their sum,
    how many words and stems of many words there are, and the number of words. A spaced-out
    run counts as a word, and as the lexicon's words of four letters or more in it; a word of
    four letters or more that blanks or line breaks cut at any place counts as itself."""

    def __init__(self, counts: np.ndarray, lexicon: dict[str, float], trees: BoostedTrees):
        self.counts, self.lexicon, self.trees = counts, lexicon, trees
        self.stems: dict[str, list[str]] = {}
        for x in lexicon:
            if x[0] != "w":
                self.stems.setdefault(x[2:], []).append(x)
        # Beginnings that words with a mark have, as they are and with single letters.
        self.heads = {x[2:][: STEMS[0]] for x in lexicon}
        self.single_heads = {_once(x[2:])[:k] for x in lexicon for k in range(1, 4) if k == 3 or len(_once(x[2:])) == k}

    def restorer(self) -> Restorer:
        return Restorer(self.counts, tuple(x[2:] for x in self.lexicon if x[0] == "w"))

    def marks_of(self, readings: list[str]) -> tuple[str, ...]:
        """The marks of the lexicon that a word has in any of its readings."""
        found: list[str] = []
        for w in readings:
            if w[: STEMS[0]] not in self.heads:
                continue
            if f"w:{w}" in self.lexicon:
                found.append(f"w:{w}")
            for k in STEMS[: max(0, len(w) - STEMS[0])]:
                found += self.stems.get(w[:k], ())
        return tuple(dict.fromkeys(found))

    def may_have(self, word: str) -> bool:
        """Whether a reading of the word may begin like a mark."""
        if word[: STEMS[0]] in self.heads:
            return True
        if not _DOUBLE.search(word):
            return False
        own = _once(word)
        return own[:3] in self.single_heads or own[:2] in self.single_heads or own[:1] in self.single_heads

    def inputs(self, texts: list[str], restorer: Restorer) -> np.ndarray:
        long = [x[2:] for x in self.lexicon if x[0] == "w" and len(x) >= 6]
        known, out = restorer.marks, []
        for words, runs in restorer.restore(texts):
            hits: list[str] = []
            for word in words.union(runs, (w for run in runs for w in long if w in run)):
                found = known.get(word)
                if found is None:
                    found = known[word] = self.marks_of(restorer.readings(word) if self.may_have(word) else [])
                hits += found
            many = Counter(x for x in hits if x[0] == "m")
            weights = [self.lexicon[x] for x in {x for x in hits if x[0] != "m" or many[x] >= MANY}]
            n_words, n_many = len({x for x in hits if x[0] == "w"}), sum(n >= MANY for n in many.values())
            out.append((max(weights, default=0.0), sum(weights), n_words, n_many, math.log1p(len(words))))
        if len(known) > _CACHE_WORDS:
            known.clear()
        return np.array(out, float).reshape(-1, 5)

    def score(self, texts: list[str], restorer: Restorer) -> np.ndarray:
        return self.trees.probability(self.inputs(texts, restorer))


def train(docs: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS) -> Scorer:
    """A scorer from at most `rows` labelled documents, the first by hash, that are not held out.

    Rows without a label or id train nothing; without toxic ones, or without words that
    tell them apart, the score is the share of toxic labels (0 without labels).
    """
    counts = character_counts(docs)
    ids = F.col("doc_id")
    chosen = labels.where(ids.isNotNull() & F.col("toxic").isNotNull() & ~held_out(ids)).select("doc_id", F.col("toxic").cast("int").alias("toxic"))
    chosen = F.broadcast(chosen.orderBy(F.xxhash64("doc_id"), "doc_id", "toxic").limit(rows).dropDuplicates(["doc_id"]))  # `rows` rows at most
    sample = stage(docs.select(ids.cast("long").alias("doc_id"), F.col("text").cast("string")).join(chosen, "doc_id").select("toxic", "text", "doc_id"), "toxicity-train")
    cluster = clusters(sample)

    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        restorer = Restorer(counts)
        for b in batches:
            for i, j, _, _ in textops.slices(b.column(1), 1 << 20):
                each = [marks(w, r) for w, r in restorer.restore([t or "" for t in b.column(1).slice(i, j - i).to_pylist()])]
                size = [len(x) for x in each]
                toxic = np.repeat(b.column(0).slice(i, j - i).to_numpy(), size)
                key = np.repeat(np.array([cluster[d] for d in b.column(2).slice(i, j - i).to_pylist()], np.int64), size)
                yield pa.RecordBatch.from_arrays([pa.array([w for x in each for w in x], pa.string()), pa.array(toxic, pa.int32()), pa.array(key)], names=["mark", "toxic", "key"])

    totals = {r["toxic"]: r["n"] for r in sample.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    n1, n0 = totals.get(1, 0), totals.get(0, 0)
    share = n1 / (n1 + n0) if n1 + n0 else 0.0
    flat = Scorer(counts, {}, BoostedTrees(base=math.log((share + 1e-6) / (1 - share + 1e-6))))
    if not n1 or not n0:
        return flat
    # Copies and near copies of a document count once.
    found = sample.mapInArrow(mark, "mark string, toxic int, key long").distinct().groupBy("mark").agg(F.sum("toxic").alias("a"), F.sum(1 - F.col("toxic")).alias("b"))
    found = stage(found, "toxicity-marks")
    # Marks whose documents are toxic beyond chance: a likelihood ratio, held to 5 % over all marks.
    a, b = F.col("a"), F.col("b")
    n = a + b
    llr = 2 * (a * F.ln(a / (n * share)) + F.when(b > 0, b * F.ln(b / (n * (1 - share)))).otherwise(0.0))
    least = 2 * math.log(max(found.count(), 1) / 0.05)
    best = found.where((a > 0) & (a > 2 * b)).withColumn("llr", llr).where(F.col("llr") > least)
    picked = best.collect()  # of TRAIN_ROWS documents
    if not picked:
        return flat
    weigh = lambda r: math.log((r["a"] + 0.5) / (n1 + 1)) - math.log((r["b"] + 0.5) / (n0 + 1))
    scorer = Scorer(counts, {r["mark"]: weigh(r) for r in sorted(picked, key=lambda r: r["mark"])}, flat.trees)

    def inputs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        restorer = scorer.restorer()
        for b in batches:
            for i, j, _, _ in textops.slices(b.column(1), 1 << 20):
                x = scorer.inputs([t or "" for t in b.column(1).slice(i, j - i).to_pylist()], restorer)
                key = [cluster[d] for d in b.column(2).slice(i, j - i).to_pylist()]
                yield pa.RecordBatch.from_arrays([b.column(0).slice(i, j - i), pa.array(key, pa.int64()), pa.array(x.tolist(), pa.list_(pa.float64()))], names=["toxic", "key", "x"])

    seen = sorted(map(tuple, sample.mapInArrow(inputs, "toxic int, key long, x array<double>").collect()))  # TRAIN_ROWS at most
    y, key, x = np.array([r[0] for r in seen], float), np.array([r[1] for r in seen]), np.array([r[2] for r in seen])
    later = key % 4 == 0
    if y[~later].min() == y[~later].max() or not later.any():
        later = np.zeros(len(y), bool)
    scorer.trees = BoostedTrees(rounds=60).fit(x[~later], y[~later])
    if later.any() and y[later].min() < y[later].max():
        scorer.trees.calibrate(x[later], y[later])
    return scorer


def score(docs: DataFrame, scorer: Scorer) -> DataFrame:
    """doc_id, score: of every row of docs, repeated and null ids too; null texts as empty ones.
    No rows give no rows. Other columns are ignored."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        restorer = scorer.restorer()
        for b in batches:
            for i, j, _, _ in textops.slices(b.column(1), 1 << 20):
                got = scorer.score([t or "" for t in b.column(1).slice(i, j - i).to_pylist()], restorer)
                yield pa.RecordBatch.from_arrays([b.column(0).slice(i, j - i), pa.array(got, pa.float64())], names=["doc_id", "score"])

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, "doc_id long, score double")


def keep_clean(docs: DataFrame, scorer: Scorer, reject: float = REJECT) -> DataFrame:
    """The rows of docs, all columns, that score below `reject`: repeated rows, null ids and null
    texts (as empty ones) by their own score."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        restorer = scorer.restorer()
        for b in batches:
            text = b.column("text")
            for i, j, _, _ in textops.slices(text, 1 << 20):
                got = scorer.score([t or "" for t in text.slice(i, j - i).to_pylist()], restorer)
                yield b.slice(i, j - i).filter(pa.array(got < reject))

    return docs.mapInArrow(run, docs.schema)


def op4_noisy_channel_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    textops.small_batches(spark)
    docs = read_table(spark, sf_dir, "documents")
    scored = score(docs, train(docs, read_table(spark, sf_dir, "labels")))
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= REJECT).cast("int").alias("predicted"))


QUERIES = {"op4_noisy_channel_toxicity": op4_noisy_channel_toxicity}
ORACLES: dict[str, str] = {}
