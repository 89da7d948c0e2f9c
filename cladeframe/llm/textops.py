"""Vectorised word and window hashing over Arrow string columns.

A batch's text is already one contiguous byte buffer, so words, shingles and
windows of thousands of documents are hashed by a few numpy passes. Slices keep
the working arrays small, whatever the batch or document sizes; one document is
never cut.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import SparkSession

SLICE_BYTES = 2 << 20

_SEP = np.zeros(256, bool)
_SEP[[9, 10, 11, 12, 13, 32]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_R = np.random.default_rng(20240229).integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_M1, _M2 = 0x9E3779B97F4A7C15, 0xD1342543DE82EF95
_powers: dict[tuple[int, bool], np.ndarray] = {}


def powers(base: int, n: int, inverse: bool = False) -> np.ndarray:
    """base**0 .. base**(n-1) modulo 2**64 (base odd), or of its inverse."""
    had = _powers.get((base, inverse))
    if had is None or len(had) < n:
        b = pow(base, -1, 1 << 64) if inverse else base
        x = np.full(max(n, 1 << 20), b, np.uint64)
        x[0] = 1
        had = _powers[base, inverse] = np.cumprod(x, dtype=np.uint64)
    return had[:n]


def mix(h: np.ndarray) -> np.ndarray:
    """A bijective finaliser, so that every bit depends on all bits."""
    h = h ^ (h >> np.uint64(30))
    h *= np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(27)
    h *= np.uint64(0x94D049BB133111EB)
    h ^= h >> np.uint64(31)
    return h


def slices(text: pa.Array, most: int = SLICE_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, row offsets in them); null counts as empty."""
    text = text.cast(pa.large_string())
    if text.null_count:
        text = text.fill_null("")
    _, offs, data = text.buffers()
    offs = np.frombuffer(offs, np.int64, len(text) + 1, text.offset * 8) if len(text) else np.zeros(1, np.int64)
    data = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    i = 0
    while i < len(text):
        j = max(i + 1, int(np.searchsorted(offs, offs[i] + most, "right")) - 1)
        yield i, j, data[offs[i] : offs[j]], offs[i : j + 1] - offs[i]
        i = j


def small_batches(spark: SparkSession, rows: int = 1_000) -> None:
    """Hand texts to Python workers a thousand rows at a time: at kilobytes a row, the default
    of ten thousand holds too much on both sides. Smaller settings are left alone. The
    session keeps the setting, as plans read it only when they run."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    now = int(spark.conf.get(key, "10000"))
    if now <= 0 or now > rows:
        spark.conf.set(key, str(rows))


class Words:
    """The words of the rows of one slice: start and end bytes, row, 64-bit hash,
    and first[r]:first[r + 1] the words of row r."""

    def __init__(self, buf: np.ndarray, offs: np.ndarray, lower: bool):
        n = len(buf)
        if lower:
            buf = _LOWER[buf]
        word = ~_SEP[buf]
        inner = offs[(offs > 0) & (offs < n)]
        before = np.zeros(n, bool)
        before[1:] = word[:-1]
        before[inner] = False
        after = np.zeros(n, bool)
        after[:-1] = word[1:]
        after[inner - 1] = False
        self.start = np.flatnonzero(word & ~before)
        self.end = np.flatnonzero(word & ~after) + 1
        acc = np.zeros(n + 1, np.uint64)
        np.cumsum(_R[buf] * powers(_M1, n), out=acc[1:])
        h = (acc[self.end] - acc[self.start]) * powers(_M1, n + 1, True)[self.start]
        self.hash = mix(h + (self.end - self.start).astype(np.uint64) * np.uint64(_M2))
        self.first = np.searchsorted(self.start, offs)
        self.count = np.diff(self.first)
        self.row = np.repeat(np.arange(len(self.count)), self.count)


def windows(words: Words, k: int, short: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of k words within a row, and first[r]:first[r + 1] those of
    row r. short: a row of 1 to k - 1 words gives one, of its whole sequence."""
    n = len(words.hash)
    acc = np.zeros(n + 1, np.uint64)
    np.cumsum(words.hash * powers(_M2, n), out=acc[1:])
    per = np.maximum(words.count - k + 1, 0)
    length = np.full(len(per), k)
    if short:
        few = (words.count > 0) & (words.count < k)
        per, length = np.where(few, 1, per), np.where(few, words.count, k)
    first = np.concatenate([[0], np.cumsum(per)])
    at = np.arange(first[-1]) + np.repeat(words.first[:-1] - first[:-1], per)
    long = np.repeat(length, per)
    h = (acc[at + long] - acc[at]) * powers(_M2, n + 1, True)[at]
    return mix(h + long.astype(np.uint64) * np.uint64(_M1)), first


def per_row(op: np.ufunc, values: np.ndarray, first: np.ndarray, empty: int) -> np.ndarray:
    """op.reduce over values[first[r]:first[r + 1]] of every row r."""
    out = np.full(len(first) - 1, empty, values.dtype)
    full = np.flatnonzero(np.diff(first))
    if len(full):
        out[full] = op.reduceat(values, first[full])
    return out
