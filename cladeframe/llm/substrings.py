"""Substring dedup by repeated-phrase automata (operator 9).

Every window of W words has an anchor, the least-hashed phrase of K words in it, which
depends on the window's words alone. So phrases that recur as anchors are confirmed by a
count, and only windows on them can repeat. The documents are dealt into shards by id, some
MB of text each; a shard gets the confirmed phrases that any of its documents has as an
anchor, without places, compiles them into one Aho-Corasick automaton and streams all of
its documents through it. What the automaton matches, and nothing else, are the places
whose windows are compared with equal windows of the corpus by their hashes (64 bits
beside the phrase's 60); each window that starts earlier elsewhere is removed.

Letters of the automaton are codes of words (BITS bits), so that a phrase is one number; a
match of other words with the same codes costs a comparison, as windows decide. An
automaton is bounded by its shard and not by the corpus.
Equal windows of a shard go on as their first one, and windows on phrases found HOT times
or more travel by their own hash: the rows of one window are at most as many as the shards,
and are read one by one. Texts are shuffled twice, compressed; phrases as numbers.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cladeframe.llm import textops
from cladeframe.llm.dedup import whole_groups
from cladeframe.session import read_table, stage

WINDOW, PHRASE = 20, 6
BITS = 10
SHARD_BYTES = 4 << 20  # of text in a shard, on average
HOT = 1_000

_U = np.uint64
_NONE = np.iinfo(np.uint64).max
_FOUND = "key long, doc_id long, start int, n int, kind byte, hashes binary"
_GONE, _COLD, _HOT = 0, 1, 2


def _bits(phrase: int) -> int:
    return min(BITS, 60 // phrase)


def word_codes(words: textops.Words, phrase: int) -> np.ndarray:
    return (words.hash >> _U(64 - _bits(phrase))).astype(np.int64)


def phrases(words: textops.Words, phrase: int) -> tuple[np.ndarray, np.ndarray]:
    """(the phrase that begins at each word as one number, whether its row is long enough)."""
    n, bits = len(words.hash), _bits(phrase)
    code, packed = np.append(word_codes(words, phrase), np.zeros(phrase, np.int64)), np.zeros(n, np.int64)
    for k in range(phrase):
        packed = (packed << bits) | code[k : k + n]
    return packed, np.arange(n) + phrase <= words.first[1:][words.row]


def letters(packed: np.ndarray, phrase: int) -> str:
    """The letters of phrases, one after the other."""
    bits = _bits(phrase)
    shifts = np.arange(phrase - 1, -1, -1) * bits
    return ((packed[:, None] >> shifts) & ((1 << bits) - 1)).astype("<u2").tobytes().decode("utf-16-le")


def _least(values: np.ndarray, width: int) -> np.ndarray:
    """Where the first least of every `width` neighbours is."""
    at, span = np.arange(len(values)), 1
    while span < width:
        step = min(span, width - span)
        a, b = at[:-step], at[step:]
        at = np.where(values[b] < values[a], b, a)
        span += step
    return at


def _anchors(words: textops.Words, packed: np.ndarray, whole: np.ndarray, window: int, phrase: int) -> tuple[np.ndarray, np.ndarray]:
    """(window starts, anchor of each); positions count the slice's words."""
    n = len(packed)
    starts = np.flatnonzero(np.arange(n) + window <= words.first[1:][words.row]) if n >= window else np.zeros(0, int)
    if not len(starts):
        return starts, starts
    order = np.where(whole, textops.mix(packed.view(np.uint64).copy()), _NONE)
    return starts, _least(order, window - phrase + 1)[starts]


def _changes(*columns: np.ndarray) -> np.ndarray:
    """Where a row differs from the one before it; the first always does."""
    n = len(columns[0])
    new = np.zeros(n, bool)
    new[:1] = True
    for c in columns:
        new[1:] |= c[1:] != c[:-1]
    return np.flatnonzero(new)


def anchors(docs: DataFrame, window: int, phrase: int) -> DataFrame:
    """(phrase, shard): every anchor of docs (shard, text), windows on the same place once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            shard = b.column(0).to_numpy()
            for i, j, buf, offs in textops.slices(b.column(1)):
                words = textops.Words(buf, offs, False)
                packed, whole = phrases(words, phrase)
                starts, anchor = _anchors(words, packed, whole, window, phrase)
                at = anchor[_changes(anchor)]
                yield pa.RecordBatch.from_arrays([pa.array(packed[at]), pa.array(shard[i:j][words.row[at]])], names=["phrase", "shard"])

    return docs.select("shard", "text").mapInArrow(run, "phrase long, shard int")


def _squeezed(docs: DataFrame, *columns: str) -> DataFrame:
    """The columns of docs, and z: its texts compressed one by one; nulls as empty."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        z = zstandard.ZstdCompressor(level=3)
        for b in batches:
            for i in range(0, b.num_rows, 1000):
                part = b.slice(i, 1000)
                texts = pa.array([z.compress((t or "").encode()) for t in part.column(0).to_pylist()], pa.binary())
                yield pa.RecordBatch.from_arrays([*part.columns[1:], texts], names=[*columns, "z"])

    some = docs.select("text", *columns)
    return some.mapInArrow(run, ", ".join([*(f"{c} {t}" for c, t in some.dtypes[1:]), "z binary"]))


def _slices_of(b: pa.RecordBatch, most: int | None = None) -> Iterator[tuple[int, int, list[bytes]]]:
    """Rows of a batch with their texts' bytes, some MB at a time."""
    import zstandard

    most = textops.SLICE_BYTES if most is None else most
    z, raw, first, size = zstandard.ZstdDecompressor(), [], 0, 0
    for i, x in enumerate(b.column("z")):
        raw.append(z.decompress(x.as_py()))
        size += len(raw[-1])
        if size >= most or i + 1 == b.num_rows:
            yield first, i + 1, raw
            raw, first, size = [], i + 1, 0


class Automaton:
    """The confirmed phrases of a shard."""

    def __init__(self, phrase: int):
        import ahocorasick

        self.phrase, self.found = phrase, ahocorasick.Automaton(ahocorasick.STORE_INTS)

    def add(self, packed: np.ndarray, hot: np.ndarray) -> None:
        text, k = letters(packed, self.phrase), self.phrase
        for i, h in enumerate(hot.tolist()):
            self.found.add_word(text[i * k : i * k + k], int(h))

    def locate(self, words: textops.Words) -> tuple[np.ndarray, np.ndarray]:
        """For each word, whether a phrase begins there and whether that is a hot one."""
        import ahocorasick

        n = len(words.hash)
        located, hot = np.zeros(n, bool), np.zeros(n, bool)
        if not len(self.found) or not n:
            return located, hot
        if self.found.kind != ahocorasick.AHOCORASICK:
            self.found.make_automaton()
        # A letter that no phrase has stands between rows.
        text = np.full(n + len(words.count), 1 << BITS, "<u2")
        text[np.arange(n) + words.row] = word_codes(words, self.phrase)
        got = np.fromiter((2 * end + h for end, h in self.found.iter(text.tobytes().decode("utf-16-le"))), np.int64)
        begin = (got >> 1) - self.phrase + 1
        begin -= np.repeat(np.arange(len(words.count)), words.count + 1)[begin]
        located[begin] = True
        hot[begin] = (got & 1) > 0
        return located, hot


def _locate(window: int, phrase: int):
    """Stream shards: the phrases of a shard come first and make its automaton, through which
    its documents go by doc_id. Windows on what it matches go out by key: runs of windows that
    have an equal one before them in the shard (kind _GONE), runs on one phrase with their
    hashes, and single windows on hot phrases by their hash."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current = automaton = lead = None
        for b in batches:
            shards = b.column("shard").to_numpy()
            cuts = np.append(_changes(shards), b.num_rows) if b.num_rows else [0]
            for s, e in zip(cuts[:-1], cuts[1:]):
                part = b.slice(s, e - s)
                if shards[s] != current:
                    current, automaton = shards[s], Automaton(phrase)
                    lead = (np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64))
                n = part.num_rows - part.column("phrase").null_count
                automaton.add(part.column("phrase").slice(0, n).to_numpy(), part.column("hot").slice(0, n).to_numpy(zero_copy_only=False))
                rest = part.slice(n)
                ids_of = rest.column("doc_id").to_numpy(zero_copy_only=False)
                for i, j, raw in _slices_of(rest):
                    ids = ids_of[i:j].astype(np.int64)
                    offs = np.concatenate([[0], np.cumsum([len(x) for x in raw])])
                    words = textops.Words(np.frombuffer(b"".join(raw), np.uint8), offs, False)
                    located, hot = automaton.locate(words)
                    packed, whole = phrases(words, phrase)
                    starts, anchor = _anchors(words, packed, whole, window, phrase)
                    keep = located[anchor]
                    starts, anchor = starts[keep], anchor[keep]
                    if not len(starts):
                        continue
                    acc = np.zeros(len(words.hash) + 1, np.uint64)
                    np.cumsum(words.hash * textops.powers(textops._M2, len(words.hash)), out=acc[1:])
                    h = textops.mix((acc[starts + window] - acc[starts]) * textops.powers(textops._M2, len(words.hash) + 1, True)[starts])
                    row = words.row[starts]
                    doc, own = ids[row], starts - words.first[row]
                    lead, later = _later(lead, (h, doc, own))
                    kind = np.where(later, _GONE, np.where(hot[anchor], _HOT, _COLD)).astype(np.int8)
                    cut = _changes(row, kind, np.where(kind == _GONE, 0, anchor), np.where(kind == _HOT, own, 0), own - np.arange(len(own)))
                    n_of = np.diff(np.append(cut, len(h)))
                    kind, bytes_of = kind[cut], h.tobytes()
                    key = np.where(kind == _HOT, h[cut].view(np.int64), np.where(kind == _COLD, packed[anchor[cut]], doc[cut] * 31 + own[cut]))
                    hashes = [bytes_of[8 * s : 8 * (s + m)] if k == _COLD else None for s, m, k in zip(cut.tolist(), n_of.tolist(), kind.tolist())]
                    cols = [pa.array(key), pa.array(doc[cut]), pa.array(own[cut].astype(np.int32)), pa.array(n_of.astype(np.int32)), pa.array(kind), pa.array(hashes, pa.binary())]
                    yield pa.RecordBatch.from_arrays(cols, names=["key", "doc_id", "start", "n", "kind", "hashes"])

    return run


def _later(lead: tuple, new: tuple) -> tuple[tuple, np.ndarray]:
    """The first of each window (hash, doc_id, start) of lead and new, and which of the new
    ones have an equal window before them. Of rows that repeat a document, equal starts
    precede nothing."""
    h, d, s = (np.concatenate(x) for x in zip(lead, new))
    order = np.lexsort((s, d, h))
    h, d, s = h[order], d[order], s[order]
    first = _changes(h)
    of = np.repeat(first, np.diff(np.append(first, len(h))))
    later = np.zeros(len(h), bool)
    later[order] = (d != d[of]) | (s != s[of])
    return (h[first], d[first], s[first]), later[len(lead[0]) :]


def _judge(window: int):
    """(doc_id, start, end) of runs of words to remove, from all windows that share a key,
    sorted by key, doc_id and start. A cold phrase has under HOT places and is held whole;
    of a hot window, only its first place is."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        done: list[pa.RecordBatch] = []
        lead = None

        def cold() -> Iterator[pa.RecordBatch]:
            nonlocal lead
            for b in batches:
                kind = b.column("kind").to_numpy()
                key, doc, start, n = (b.column(c).to_numpy() for c in ("key", "doc_id", "start", "n"))
                x = np.flatnonzero(kind == _HOT)
                if len(x):
                    k, d, s = key[x], doc[x], start[x]
                    first = _changes(k)
                    of = np.repeat(first, np.diff(np.append(first, len(k))))
                    ld, ls = d[of], s[of]
                    if lead is not None and lead[0] == k[0]:  # the window goes on from the last batch
                        ld[of == 0], ls[of == 0] = lead[1], lead[2]
                    gone = x[(d != ld) | (s != ls)]
                    lead = (k[-1], ld[-1], ls[-1])
                    done.append(_runs(doc[gone], start[gone].astype(np.int64), start[gone].astype(np.int64) + window))
                x = np.flatnonzero(kind == _GONE)
                done.append(_runs(doc[x], start[x].astype(np.int64), start[x].astype(np.int64) + n[x] - 1 + window))
                yield b.filter(pa.array(kind == _COLD))

        for t, _ in whole_groups(cold(), "key"):
            yield from done
            done.clear()
            doc, start, n = (t.column(c).to_numpy() for c in ("doc_id", "start", "n"))
            h = np.frombuffer(b"".join(t.column("hashes").to_pylist()), np.uint64)
            s = np.repeat(start - (np.cumsum(n) - n), n) + np.arange(len(h))
            d = np.repeat(doc, n)
            gone = _later((h[:0], d[:0], s[:0]), (h, d, s))[1]
            yield _runs(d[gone], s[gone], s[gone] + window)
        yield from done

    return run


def _runs(docs: np.ndarray, a: np.ndarray, e: np.ndarray) -> pa.RecordBatch:
    """Runs of words of documents, neighbours as one."""
    by = np.lexsort((a, docs))
    docs, a, e = docs[by], a[by], e[by]
    if len(docs):
        cut = np.flatnonzero(np.concatenate([[True], (docs[1:] != docs[:-1]) | (a[1:] > e[:-1])]))
        docs, a, e = docs[cut], a[cut], np.maximum.reduceat(e, cut)
    return pa.RecordBatch.from_arrays([pa.array(docs), pa.array(a.astype(np.int32)), pa.array(e.astype(np.int32))], names=["doc_id", "start", "end"])


def _shard(n: int) -> Column:
    return F.pmod(F.xxhash64("doc_id"), F.lit(n)).cast("int").alias("shard")


def repeats(docs: DataFrame, window: int = WINDOW, phrase: int = PHRASE) -> DataFrame:
    """(doc_id, start, end): runs of words to remove, which may overlap. Rows without a
    doc_id take no part."""
    docs = docs.where("doc_id is not null").select(F.col("doc_id").cast("long"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    docs = docs.withColumn("shard", _shard(max(1, math.ceil(size / SHARD_BYTES))))
    counts = anchors(docs, window, phrase).groupBy("phrase").agg(F.count("*").alias("n")).where("n > 1")
    confirmed = stage(counts.select("phrase", (F.col("n") >= HOT).alias("hot")), "phrases")
    parts = anchors(docs, window, phrase).join(confirmed, "phrase").select("shard", "phrase", "hot", F.lit(None).cast("long").alias("doc_id"), F.lit(None).cast("binary").alias("z"))
    texts = _squeezed(docs, "shard", "doc_id").select("shard", F.lit(None).cast("long").alias("phrase"), F.lit(None).cast("boolean").alias("hot"), "doc_id", "z")
    shards = parts.unionByName(texts).repartition("shard").sortWithinPartitions("shard", F.col("phrase").asc_nulls_last(), "doc_id")
    found = shards.mapInArrow(_locate(window, phrase), _FOUND)
    return found.repartition("key").sortWithinPartitions("key", "doc_id", "start").mapInArrow(_judge(window), "doc_id long, start int, end int")


def _cut(words: list[bytes], runs: list[dict] | None) -> list[bytes]:
    kept, done = [], 0
    for r in sorted(runs or (), key=lambda r: r["start"]):
        kept += words[done : max(done, r["start"])]
        done = max(done, r["end"])
    return kept + words[done:]


def remove_repeats(docs: DataFrame, window: int = WINDOW, phrase: int = PHRASE) -> DataFrame:
    """doc_id, n_words, n_removed, kept (the words left, one space between).

    Words are runs of characters other than space and \\t to \\r. A word goes if it is in
    a window of `window` words whose sequence also starts earlier: in a smaller doc_id, or
    before it in the same document. One row per row of docs; null texts have no words.
    Rows without a doc_id, and texts shorter than a window, stay whole; rows that repeat
    a doc_id and its text don't precede each other. Other columns are ignored.
    """
    if not 1 <= phrase <= min(window, 60):
        raise ValueError("a phrase has 1 to 60 words, and no more than a window")
    runs = repeats(docs, window, phrase).groupBy("doc_id").agg(F.collect_list(F.struct("start", "end")).alias("runs"))
    texts = _squeezed(docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")), "doc_id")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i, j, raw in _slices_of(b):
                split = [x.split() for x in raw]
                kept = [_cut(w, r) for w, r in zip(split, b.column("runs").slice(i, j - i).to_pylist())]
                n = np.array([len(w) for w in split], np.int64)
                yield pa.RecordBatch.from_arrays(
                    [b.column("doc_id").slice(i, j - i), pa.array(n), pa.array(n - [len(k) for k in kept]), pa.array([b" ".join(k).decode() for k in kept])],
                    names=["doc_id", "n_words", "n_removed", "kept"],
                )

    return texts.join(runs, "doc_id", "left").mapInArrow(run, "doc_id long, n_words long, n_removed long, kept string")


def op9_phrase_automata(spark: SparkSession, sf_dir: str) -> DataFrame:
    left = remove_repeats(read_table(spark, sf_dir, "documents"))
    return left.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


QUERIES = {"op9_phrase_automata": op9_phrase_automata}
ORACLES: dict[str, str] = {}
