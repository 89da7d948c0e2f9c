import hashlib
import struct
import zlib

import numpy as np
import pytest

from cladeframe.llm import media


def ulaw_slow(code):
    code = ~code & 255
    x = ((((code & 15) << 3) + 132) << (code >> 4 & 7)) - 132
    return -x if code & 128 else x


def adpcm_slow(block):
    value, index = struct.unpack("<h", block[:2])[0], min(block[2], 88)
    out = [value]
    for byte in block[4:]:
        for n in (byte & 15, byte >> 4):
            step = int(media._STEPS[index])
            d = (step >> 3) + (step >> 2 if n & 1 else 0) + (step >> 1 if n & 2 else 0) + (step if n & 4 else 0)
            value = max(-32768, min(32767, value + (-d if n & 8 else d)))
            index = max(0, min(88, index + (2 * (n & 3) + 2 if n & 4 else -1)))
            out.append(value)
    return out


def test_tables():
    assert [int(media.TABLES["ulaw"][c]) for c in range(256)] == [ulaw_slow(c) for c in range(256)]
    a = media.TABLES["alaw"]
    assert (a[0xD5], a[0x55], a[0xAA], a[0x2A]) == (8, -8, 32256, -32256)
    assert len(set(a.tolist())) == 256


def test_adpcm_blocks():
    data = np.random.default_rng(1).integers(0, 256, 5 * media.BLOCK, dtype=np.uint8)
    want = [x for i in range(5) for x in adpcm_slow(data[i * media.BLOCK : (i + 1) * media.BLOCK].tobytes())]
    assert media.decode_adpcm(data).tolist() == want


def test_resample():
    x = np.array([0, 100, -100, 50], np.int16)
    assert media.resample(x, 8000, 16000).tolist() == [0, 50, 100, 0, -100, -25, 50, 50]
    assert media.double_rate(np.concatenate([x, x]), np.array([0, 4, 8])).tolist() == 2 * media.resample(x, 8000, 16000).tolist()
    assert media.resample(x, 16000, 8000).tolist() == [0, -100]


@pytest.mark.parametrize("codec", ["ulaw", "alaw", "adpcm"])
def test_wav_round_trip(codec):
    for payload in (b" " * 192, bytes(range(192)) * 3):
        m = media.wav(codec, 8000, payload)
        assert media.read_wav(m) == (codec, 8000, payload) and struct.unpack("<I", m[4:8])[0] == len(m) - 8
    with pytest.raises(ValueError):
        media.read_wav(m[:100])


def test_documents(docs, odd):
    stored = media.store(docs((1, "héllo"), (2, None), (3, "x" * 192), (4, "héllo")))
    got = {r.doc_id: r for r in media.describe(stored).collect()}
    payload = "héllo".encode().ljust(192)
    assert (got[1].n_bytes, got[1].payload_bytes, got[1].payload_sha256) == (6, 192, hashlib.sha256(payload).hexdigest())
    assert got[1].tail_crc32 == zlib.crc32(payload[-16:]) and got[2].payload_bytes == 192 and got[3].payload_bytes == 192
    assert got[1].feature == got[4].feature and got[1].media_sha256 == got[4].media_sha256
    assert media.describe(media.store(odd)).count() == odd.count()
    assert media.describe(media.store(docs().limit(0))).count() == 0


def test_to_pcm(spark):
    rows = [(1, media.wav("ulaw", 8000, b"\xff\x00")), (2, None), (3, b"junk"), (4, media.wav("adpcm", 8000, bytes(192)))]
    got = {r.id: r for r in media.to_pcm(spark.createDataFrame(rows, "id long, media binary")).collect()}
    assert np.frombuffer(got[1].pcm, "<i2").tolist() == [0, -16062, -32124, -32124] and got[1].media_error is None
    assert got[2].pcm is None and got[2].media_error is None and got[3].media_error and len(got[4].pcm) == 4 * 377
