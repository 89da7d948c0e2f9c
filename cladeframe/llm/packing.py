"""Best-fit packing of tokenised documents by exact-complement hashing (operator 10).

Only piece lengths decide a packing, so the plan is made from the histogram of
lengths: at most `capacity` numbers, however many documents there are. Single,
pair and triple length sums that close a gap exactly are looked up and consumed as
often as the counts allow; what has no exact complement is placed by best fit. Each
step of the plan uses up a length, so the plan is bounded by the capacity too. Spark
tokenises, counts, ranks the pieces of each length by partition offsets (no window
over a hot length) and every task looks its pieces up in the plan.
"""

from __future__ import annotations

import codecs
import re
import string
import struct
import zlib
from collections import ChainMap
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cladeframe.llm import textops
from cladeframe.session import read_table, stage

#: Beyond these letters, normal forms and case are left to the tokenizer, text by text.
#: Within them Arrow lowers letters as tokenizers do, but for the dotted capital I.
_NOT_PLAIN = r"[^\x00-\x1b\x20-\x{12f}\x{131}-\x{24f}]"
#: Words kept in each of two generations, and the longest word that is kept.
_CACHE_WORDS, _CACHE_LETTERS = 400_000, 64
#: Texts looked up and runs of letters merged at a time.
_SLICE_BYTES, _RUNS = 12 << 20, 10_000
_PROBE = "Ab, cd  Éf's g1\n(h)"
_state: dict = {}


def _load(path: str) -> dict:
    """The tokenizer and the id bytes of words that this Python worker has met.

    Tokenizers that drop white space and never join across it (found by a probe) give
    a text's ids as its words' ids in a row. Of these, some keep a run of letters
    whole and mark its end, so that many runs' merges can be asked for alone. Texts with an
    added token in any case go to the tokenizer as they are: it looks for these before it
    lowers letters."""
    if _state.get("path") != path:
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer, pre_tokenizers

        t = Tokenizer.from_file(path)
        ids = lambda x: t.encode(x, add_special_tokens=False).ids
        by_word = ids(_PROBE) == [i for w in _PROBE.lower().split() for i in ids(w)]
        added = [f"(?i:{re.escape(x.content)})" for x in t.get_added_tokens_decoder().values()]
        whole = "|".join([_NOT_PLAIN, *added]) if by_word else ""  # all texts match ""
        _state.clear()
        _state.update(path=path, tokenizer=t, words={}, before={}, whole=whole, merges=None)
        end = getattr(t.model, "end_of_word_suffix", None)
        if by_word and end and ids("abc,") == ids("abc") + ids(","):
            letters = [*map(chr, range(256))]
            bytes_of = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False).pre_tokenize_str
            for c in map(chr, range(0x80, 0x250)):
                for byte, letter in zip(c.encode(), bytes_of(c)[0][0]):
                    letters[byte] = letter
            last = np.zeros(t.get_vocab_size(), bool)
            last[[i for x, i in t.get_vocab().items() if x.endswith(end)]] = True
            merges = Tokenizer(t.model)
            merges.pre_tokenizer = pre_tokenizers.WhitespaceSplit()
            _state.update(merges=merges, letters="".join(letters), last=last)
            if _merge(probe := ["abc", "déf", "x"], _state) != [_id_bytes(ids(w)) for w in probe]:
                _state.update(merges=None)
    return _state


def _id_bytes(ids: list[int]) -> bytes:
    return struct.pack(f"<{len(ids)}I", *ids)


def _merge(runs: list[str], loaded: dict) -> list[bytes]:
    """The id bytes of each of some runs of letters, which are merged as one text and cut where words end."""
    out = []
    for i in range(0, len(runs), _RUNS):
        some = runs[i : i + _RUNS]
        text = codecs.charmap_decode(" ".join(some).encode(), "strict", loaded["letters"])[0]
        ids = np.asarray(loaded["merges"].encode_batch_fast([text], add_special_tokens=False)[0].ids, "<u4")
        at = [0, *(4 * np.flatnonzero(loaded["last"][ids]) + 4).tolist()]
        if len(at) == len(some) + 1:
            raw = ids.tobytes()
            out += [raw[a:b] for a, b in zip(at, at[1:])]
        else:  # the model has no token for some last letter
            out += [_id_bytes(x.ids) for x in loaded["tokenizer"].encode_batch_fast(some, add_special_tokens=False)]
    return out


def _spell(words: list[str], loaded: dict) -> list[bytes]:
    """The id bytes of each of some words. A run of letters and the marks behind it are spelled apart.

    Words are kept in two generations: when the younger one is full, it becomes the older
    one, from which words in use come back, so that only rare ones are spelled again."""
    if len(loaded["words"]) > _CACHE_WORDS:
        loaded.update(before=loaded["words"], words={})
    known, before = loaded["words"], loaded["before"]
    out, new, odd, marked = list(map(known.get, words)), {}, {}, []
    for i, ids in enumerate(out):
        if ids is None:
            word = words[i]
            ids = before.get(word)
            if ids is not None:
                out[i] = known[word] = ids
                continue
            run = word.rstrip(string.punctuation)
            if loaded["merges"] and run.isalpha():
                mark = word[len(run) :]
                if run not in known and run not in before:
                    new[run] = None
                if mark and mark not in known and mark not in before:
                    odd[mark] = None
                marked.append((i, run, mark))
            else:
                odd[word] = None
                marked.append((i, word, ""))
    new.update(zip(new, _merge([*new], loaded)) if new else ())
    odd.update((w, _id_bytes(x.ids)) for w, x in zip(odd, loaded["tokenizer"].encode_batch_fast([*odd], add_special_tokens=False)))
    for fresh in (new, odd):
        known.update(fresh if max(map(len, fresh), default=0) <= _CACHE_LETTERS else {w: x for w, x in fresh.items() if len(w) <= _CACHE_LETTERS})
    of = ChainMap(known, before, new, odd)
    for i, run, mark in marked:
        out[i] = of[run]
        if mark:
            out[i] += of[mark]
            if len(words[i]) <= _CACHE_LETTERS:
                known[words[i]] = out[i]
    return out


def token_ids(texts: list[str] | pa.Array, path: str) -> list[bytes]:
    """Each text's ids as little-endian unsigned 32-bit numbers; null counts as empty.

    Arrow splits all texts and numbers their different words, so that Python meets each
    of these once; their ids are then put in the words' places by one take."""
    loaded = _load(path)
    text = pc.fill_null(pa.array(texts, pa.large_string()) if isinstance(texts, list) else texts.cast(pa.large_string()), "")
    whole = pc.match_substring_regex(text, loaded["whole"])
    plain = pc.utf8_lower(pc.if_else(whole, "", text))
    for blank in "\x85\xa0":
        plain = pc.replace_substring(plain, blank, " ")
    lists = pc.ascii_split_whitespace(plain)
    words = lists.flatten().dictionary_encode()
    spelled = pa.array(_spell(words.dictionary.to_numpy(zero_copy_only=False).tolist(), loaded), pa.large_binary())
    ids = spelled.take(words.indices)
    data = memoryview(ids.buffers()[2] or b"")
    ends = np.frombuffer(ids.buffers()[1], np.int64, len(ids) + 1, ids.offset * 8) if len(ids) else np.zeros(1, np.int64)
    at = ends[lists.offsets.to_numpy()].tolist()
    out = [data[a:b].tobytes() for a, b in zip(at, at[1:])]
    for i in np.flatnonzero(whole.to_numpy(zero_copy_only=False)).tolist():
        out[i] = _id_bytes(loaded["tokenizer"].encode_batch_fast([text[i].as_py()], add_special_tokens=False)[0].ids)
    return out


def _gathered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """The rows of all batches, up to _SLICE_BYTES of texts at a time; a longer text comes alone."""
    held, size = [], 0
    for batch in batches:
        for i, j, buf, _ in textops.slices(batch.column(1), _SLICE_BYTES):
            if held and size + len(buf) > _SLICE_BYTES:
                yield pa.Table.from_batches(held).combine_chunks()
                held, size = [], 0
            held.append(batch.slice(i, j - i))
            size += len(buf)
    if held:
        yield pa.Table.from_batches(held).combine_chunks()


def tokenise(docs: DataFrame, tokenizer_path: str, capacity: int = 4096, end_id: int = 1, with_ids: bool = False) -> DataFrame:
    """Pieces of at most `capacity` ids: doc_id, piece, start, length, ids_crc32
    (, ids), with the partition and the place among its pieces of the same length."""
    schema = "doc_id long, piece int, start long, length long, ids_crc32 long, part int, place long" + ", ids binary" * with_ids
    end = _id_bytes([end_id])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, seen = TaskContext.get().partitionId(), [0] * (capacity + 1)
        for table in _gathered(batches):
            ids, texts = (table.column(c).chunk(0) for c in (0, 1))
            rows = []
            for doc, raw in zip(ids.to_pylist(), token_ids(texts, tokenizer_path)):
                raw += end
                for k, at in enumerate(range(0, len(raw), 4 * capacity)):
                    cut = raw[at : at + 4 * capacity]
                    n = len(cut) // 4
                    rows.append((doc, k, at // 4, n, zlib.crc32(cut), part, seen[n], cut)[: 7 + with_ids])
                    seen[n] += 1
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*rows), [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.binary()])],
                names=[x.split()[0] for x in schema.split(", ")],
            )

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, schema)


class Complements:
    """Index of the single, pair and triple sums of the lengths left.

    Counts only go down, so what can't be summed now never can again, and the largest
    length that a sum can begin with only falls: each sum keeps it as a place to go on from."""

    def __init__(self, left: np.ndarray):
        self.left = left
        self.pair_from, self.triple_from = list(range(-1, len(left) - 1)), list(range(-2, len(left) - 2))

    def pair(self, total: int) -> list[int] | None:
        left, a = self.left, self.pair_from[total]
        if 2 * a >= total and left[a] and left[total - a] and (2 * a > total or left[a] > 1):
            return [a, total - a]
        low = -(-total // 2)
        if a > low:
            both = (left[low:a] > 0) & (left[total - low : total - a : -1] > 0)
            if 2 * low == total and left[low] < 2:
                both[0] = False
            i = int(both[::-1].argmax())
            if both[len(both) - 1 - i]:
                a = self.pair_from[total] = a - 1 - i
                return [a, total - a]
        self.pair_from[total] = -1
        return None

    def exact(self, gap: int) -> list[int] | None:
        """One, two or three lengths left that sum to gap, large ones first."""
        if self.left[gap]:
            return [gap]
        if found := self.pair(gap):
            return found
        for a in range(self.triple_from[gap], 0, -1):
            self.triple_from[gap] = a
            if self.left[a] and self.pair_from[gap - a] > 0 and (found := self.pair(gap - a)) and self.left[a] > found.count(a):
                return [a, *found]
        self.triple_from[gap] = 0
        return None


def plan(counts: dict[int, int], capacity: int) -> list[tuple[int, int, int, int, int, int]]:
    """Slots (length, first rank, end rank, pieces a sequence, first sequence, offset):
    the pieces of a length with ranks in that range go, so many a sequence, to the
    sequences from the first on, side by side from the offset on."""
    left = np.zeros(capacity + 1, np.int64)
    for n, c in counts.items():
        left[n] = c
    used, slots, sequence, index = np.zeros(capacity + 1, np.int64), [], 0, Complements(left)
    while (some := np.flatnonzero(left)).size:
        lengths = {int(some[-1]): 1}
        left[some[-1]] -= 1
        gap = capacity - int(some[-1])
        while gap:
            more = index.exact(gap)
            if more is None:
                fit = np.flatnonzero(left[: gap + 1])
                if not fit.size:
                    break
                more = [int(fit[-1])]
            for n in more:
                lengths[n] = lengths.get(n, 0) + 1
                left[n] -= 1
                gap -= n
        times = 1 + min(int(left[n]) // c for n, c in lengths.items())
        offset = 0
        for n, c in lengths.items():
            left[n] -= c * (times - 1)
            slots.append((n, int(used[n]), int(used[n]) + c * times, c, sequence, offset))
            used[n] += c * times
            offset += n * c
        sequence += times
    return slots


def pack(docs: DataFrame, tokenizer_path: str, capacity: int = 4096, end_id: int = 1, with_ids: bool = False) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset (, ids).

    A document is its ids and then end_id; only longer ones than `capacity` are cut.
    Null texts count as empty: one piece of the end id. Null or repeated doc_ids are
    packed like others, one set of pieces a row. No rows give no rows. Other columns
    are ignored. Ties among equal lengths go by partition and place, so a sequence's
    number and make-up may differ between runs, but not how many there are.
    """
    pieces = stage(tokenise(docs, tokenizer_path, capacity, end_id, with_ids), "pieces")
    groups = pieces.groupBy("part", "length").agg(F.count("*").alias("n"))
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = groups.select("part", "length", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    counts = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count("*").alias("n")).collect()}  # capacity rows at most
    slots = np.array(sorted(plan(counts, capacity)) or np.zeros((0, 6)), np.int64).reshape(-1, 6)
    schema = "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long" + ", ids binary" * with_ids

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # Slots are sorted by length and first rank; one number orders both.
        wide = int(slots[:, 2].max()) + 1 if len(slots) else 1
        starts = slots[:, 0] * wide + slots[:, 1]
        for b in batches:
            length, rank = b.column("length").to_numpy(), b.column("rank").to_numpy()
            s = slots[np.searchsorted(starts, length * wide + rank, "right") - 1]
            nth = rank - s[:, 1]
            cols = [b.column(c) for c in ("doc_id", "piece", "start", "length", "ids_crc32")]
            cols += [pa.array(s[:, 4] + nth // s[:, 3]), pa.array(s[:, 5] + nth % s[:, 3] * length)]
            yield pa.RecordBatch.from_arrays(cols + ([b.column("ids")] if with_ids else []), names=[x.split()[0] for x in schema.split(", ")])

    ranked = pieces.join(bases, ["part", "length"]).withColumn("rank", F.col("base") + F.col("place"))
    return ranked.mapInArrow(place, schema)


def op10_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    textops.small_batches(spark)
    import public_tokenizers

    return pack(read_table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


QUERIES = {"op10_best_fit_packing": op10_best_fit_packing}
ORACLES: dict[str, str] = {}
