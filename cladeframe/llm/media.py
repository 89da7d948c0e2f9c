"""Telephony audio columns: mu-law, A-law and IMA ADPCM to resampled PCM (operator 8).

Companded bytes expand by 256-entry lookup tables. ADPCM is sequential within a block
only, so numpy decodes one nibble of all blocks of a slice at a time. Everything is a
map over rows: no shuffle, and memory is bounded by a slice or the longest row.
"""

from __future__ import annotations

import hashlib
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cladeframe.llm import textops
from cladeframe.session import read_table

ULAW, ALAW, ADPCM = "ulaw", "alaw", "adpcm"
FORMAT_TAG = {ULAW: 7, ALAW: 6, ADPCM: 17}
BLOCK = 192  # bytes of an ADPCM block: 4 of header, 188 of nibbles


def _ulaw_table() -> np.ndarray:
    code = ~np.arange(256) & 0xFF
    size = (((code & 0x0F) << 3) + 0x84 << ((code >> 4) & 7)) - 0x84
    return np.where(code & 0x80, -size, size).astype(np.int16)


def _alaw_table() -> np.ndarray:
    code = np.arange(256) ^ 0x55
    seg, low = (code >> 4) & 7, (code & 0x0F) << 4
    size = np.where(seg == 0, low + 8, (low + 0x108) << np.maximum(seg - 1, 0))
    return np.where(code & 0x80, size, -size).astype(np.int16)


def _adpcm_steps() -> np.ndarray:
    # The 89 step sizes of the IMA ADPCM format.
    return np.array(
        [7, 8, 9, 10, 11, 12, 13, 14, 16, 17, 19, 21, 23, 25, 28, 31, 34, 37, 41, 45, 50, 55, 60, 66, 73, 80, 88, 97, 107, 118,
         130, 143, 157, 173, 190, 209, 230, 253, 279, 307, 337, 371, 408, 449, 494, 544, 598, 658, 724, 796, 876, 963, 1060,
         1166, 1282, 1411, 1552, 1707, 1878, 2066, 2272, 2499, 2749, 3024, 3327, 3660, 4026, 4428, 4871, 5358, 5894, 6484,
         7132, 7845, 8630, 9493, 10442, 11487, 12635, 13899, 15289, 16818, 18500, 20350, 22385, 24623, 27086, 29794, 32767],
        np.int32,
    )


TABLES = {ULAW: _ulaw_table(), ALAW: _alaw_table()}
_STEPS = _adpcm_steps()
#: Per (step index, nibble): what the sample changes by, and the next step index.
_nib = np.arange(16)
_DIFF = (_STEPS[:, None] >> 3) + (_STEPS[:, None] >> 2) * (_nib & 1) + (_STEPS[:, None] >> 1) * (_nib >> 1 & 1) + _STEPS[:, None] * (_nib >> 2 & 1)
_DIFF = np.where(_nib & 8, -_DIFF, _DIFF).astype(np.int32).ravel()
_NEXT = np.clip(np.arange(89)[:, None] + np.where(_nib & 4, 2 * (_nib & 3) + 2, -1), 0, 88).astype(np.int32).ravel()


def decode_adpcm(data: np.ndarray, block: int = BLOCK) -> np.ndarray:
    """PCM of whole blocks, 2 * block - 7 samples each; step indexes over 88 count as 88."""
    blocks = data.reshape(-1, block)
    out = np.empty((2 * block - 7, len(blocks)), np.int16)
    value = blocks[:, :2].copy().view("<i2")[:, 0].astype(np.int32)
    index = np.minimum(blocks[:, 2], 88).astype(np.int32)
    out[0] = value
    codes = np.ascontiguousarray(blocks[:, 4:].T)
    for i, byte in enumerate(codes):
        for j, nibble in ((1, byte & 15), (2, byte >> 4)):
            at = (index << 4) + nibble
            value += _DIFF[at]
            np.clip(value, -32768, 32767, out=value)
            index = _NEXT[at]
            out[2 * i + j] = value
    return np.ascontiguousarray(out.T).ravel()


def resample(pcm: np.ndarray, rate: int, to: int) -> np.ndarray:
    """Linear interpolation in whole numbers, so that every machine gives the same."""
    if rate == to or not len(pcm):
        return pcm
    at = np.arange(len(pcm) * to // rate, dtype=np.int64) * rate
    i, part = at // to, at % to
    x = pcm.astype(np.int64)
    return ((x[i] * (to - part) + x[np.minimum(i + 1, len(x) - 1)] * part) // to).astype(np.int16)


def double_rate(pcm: np.ndarray, first: np.ndarray) -> np.ndarray:
    """resample() by two of many runs pcm[first[r]:first[r + 1]] at once."""
    out = np.empty(2 * len(pcm), np.int16)
    out[::2] = pcm
    if len(pcm):
        nxt = np.empty_like(pcm)
        nxt[:-1] = pcm[1:]
        last = first[1:][np.diff(first) > 0] - 1
        nxt[last] = pcm[last]
        out[1::2] = (pcm.astype(np.int32) + nxt) >> 1
    return out


def wav(codec: str, rate: int, payload: bytes) -> bytes:
    """A RIFF file of one channel that holds the payload's bytes as they are."""
    bits = 4 if codec == ADPCM else 8
    align = BLOCK if codec == ADPCM else 1
    per_s = rate * BLOCK // (2 * BLOCK - 7) if codec == ADPCM else rate
    fmt = struct.pack("<HHIIHHH", FORMAT_TAG[codec], 1, rate, per_s, align, bits, 2 if codec == ADPCM else 0) + (struct.pack("<H", 2 * BLOCK - 7) if codec == ADPCM else b"")
    samples = len(payload) // BLOCK * (2 * BLOCK - 7) if codec == ADPCM else len(payload)
    body = b"".join((b"fmt ", struct.pack("<I", len(fmt)), fmt, b"fact", struct.pack("<II", 4, samples), b"data", struct.pack("<I", len(payload)), payload, b"\0" * (len(payload) % 2)))
    return b"RIFF" + struct.pack("<I", 4 + len(body)) + b"WAVE" + body


def read_wav(media: bytes) -> tuple[str, int, bytes]:
    """(codec, rate, payload) of what wav() wrote; other files raise ValueError."""
    if media[:4] != b"RIFF" or media[8:12] != b"WAVE":
        raise ValueError("not a RIFF WAVE file")
    at, codec, rate = 12, None, 0
    while at + 8 <= len(media):
        name, n = media[at : at + 4], struct.unpack_from("<I", media, at + 4)[0]
        if name == b"fmt ":
            tag, _, rate = struct.unpack_from("<HHI", media, at + 8)
            codec = {v: k for k, v in FORMAT_TAG.items()}.get(tag)
        elif name == b"data":
            if codec is None or at + 8 + n > len(media):
                raise ValueError("unknown format or cut data")
            return codec, rate, media[at + 8 : at + 8 + n]
        at += 8 + n + n % 2
    raise ValueError("no data chunk")


def to_pcm(media: DataFrame, column: str = "media", to_rate: int = 16000) -> DataFrame:
    """Add pcm (binary, 16-bit little-endian at to_rate) and media_error to a table of WAV files.

    Nulls give null pcm and no error; files that can't be read give null pcm and the
    reason. ADPCM bytes after the last whole block are ignored. Columns named pcm or
    media_error are replaced.
    """

    def decode(x: bytes | None) -> tuple[bytes | None, str | None]:
        if x is None:
            return None, None
        try:
            codec, rate, payload = read_wav(x)
        except ValueError as e:
            return None, str(e)
        data = np.frombuffer(payload, np.uint8)
        pcm = TABLES[codec][data] if codec in TABLES else decode_adpcm(data[: len(data) // BLOCK * BLOCK])
        return resample(pcm, rate, to_rate).astype("<i2").tobytes(), None

    rest = media.drop("pcm", "media_error")
    schema = rest.withColumns({"pcm": F.lit(None).cast("binary"), "media_error": F.lit(None).cast("string")}).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i in range(0, b.num_rows, 64):
                part = b.slice(i, 64)
                got = [decode(x) for x in part.column(column).to_pylist()]
                cols = [*part.columns, pa.array([p for p, _ in got], pa.binary()), pa.array([e for _, e in got], pa.string())]
                yield pa.RecordBatch.from_arrays(cols, names=[*part.schema.names, "pcm", "media_error"])

    return rest.mapInArrow(run, schema)


def store(texts: DataFrame, codec: str = ULAW, rate: int = 8000) -> DataFrame:
    """(doc_id, n_bytes, media): UTF-8 bytes padded by spaces to a positive multiple of
    192 and stored as the codec's units: a lossless carrier.

    One row per row of texts, repeated and null ids too; null texts count as empty. No rows
    give no rows. Other columns are ignored."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i in range(0, b.num_rows, 256):
                part = b.slice(i, 256)
                raw = [(t or "").encode() for t in part.column(1).to_pylist()]
                media = [wav(codec, rate, x + b" " * (-len(x) % BLOCK or BLOCK * (not x))) for x in raw]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array([len(x) for x in raw], pa.int64()), pa.array(media, pa.binary())], names=["doc_id", "n_bytes", "media"])

    return texts.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, "doc_id long, n_bytes long, media binary")


def describe(media: DataFrame, to_rate_factor: int = 2) -> DataFrame:
    """Digests and features of stored media: payload_bytes, payload_sha256, tail_crc32,
    media_bytes, media_sha256 and feature. The feature reads the payload as each codec,
    decodes and doubles its rate: per codec the sample count, root mean square, zero
    crossings, and the CRC of the resampled PCM.

    One row per row of store(), repeated and null ids too, equal ones for equal media; no
    rows give no rows. Null media, or files that wav() didn't write, raise an error."""
    if to_rate_factor != 2:
        raise ValueError("features are taken at twice the rate")
    schema = "doc_id long, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string"

    def features(codec: str, data: np.ndarray, first: np.ndarray) -> list[str]:
        pcm = TABLES[codec][data] if codec in TABLES else decode_adpcm(data)
        if codec == ADPCM:
            first = first // BLOCK * (2 * BLOCK - 7)
        x = pcm.astype(np.int64)
        power = np.add.reduceat(x * x, first[:-1])
        flips = np.concatenate([[False], (pcm[1:] < 0) != (pcm[:-1] < 0)])
        flips[first[:-1]] = False
        crossings = np.add.reduceat(flips, first[:-1], dtype=np.int64)
        twice = memoryview(double_rate(pcm, first).astype("<i2", copy=False)).cast("B")
        n = np.diff(first)
        rms = np.sqrt(power / n).astype(np.int64)
        return [f"{codec}:{c}:{r}:{z}:{zlib.crc32(twice[4 * a : 4 * e]):08x}" for c, r, z, a, e in zip(n.tolist(), rms.tolist(), crossings.tolist(), first[:-1].tolist(), first[1:].tolist())]

    def some(rows: list[tuple[int | None, int, bytes]]) -> pa.RecordBatch:
        back = [read_wav(m)[2] for _, _, m in rows]
        first = np.concatenate([[0], np.cumsum([len(p) for p in back])])
        data = np.frombuffer(b"".join(back), np.uint8)
        each = zip(*(features(c, data, first) for c in (ULAW, ALAW, ADPCM)))
        out = [(d, n, len(p), hashlib.sha256(p).hexdigest(), zlib.crc32(p[-16:]), len(m), hashlib.sha256(m).hexdigest(), ";".join(f)) for (d, n, m), p, f in zip(rows, back, each)]
        kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string()]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), kinds)], names=[x.split()[0] for x in schema.split(", ")])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, held = [], 0
        for b in batches:
            for d, n, m in zip(b.column("doc_id").to_pylist(), b.column("n_bytes").to_pylist(), b.column("media")):
                rows.append((d, n, m.as_py()))
                held += len(rows[-1][2])
                if held >= textops.SLICE_BYTES:
                    yield some(rows)
                    rows, held = [], 0
        if rows:
            yield some(rows)

    return media.mapInArrow(run, schema)


def op8_telephony_audio(spark: SparkSession, sf_dir: str) -> DataFrame:
    return describe(store(read_table(spark, sf_dir, "documents")))


QUERIES = {"op8_telephony_audio": op8_telephony_audio}
ORACLES: dict[str, str] = {}
