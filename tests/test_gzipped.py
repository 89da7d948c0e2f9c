"""Gzip files by their members, against Python's own reading of the whole file."""

import gzip
import random
import zlib

import pytest
from pyspark.sql import functions as F

from cladeframe.sources import gzipped, readers


def texts(seed, n):
    rng = random.Random(seed)
    return ["".join(rng.choice("abc\n/>é") for _ in range(rng.choice((0, 1, 5, 80, 3000)))) + str(i) for i in range(n)]


def members(data, sizes, seed):
    """Data as members cut at any byte, in records and separators too."""
    rng, out, at = random.Random(seed), b"", 0
    while at < len(data):
        step = rng.choice(sizes)
        out, at = out + gzip.compress(data[at : at + step], rng.choice((0, 1, 9))), at + step
    return out


def split(data, sep):
    parts = data.split(sep)
    return parts if parts[-1] else parts[:-1]


@pytest.mark.parametrize("sep", ["\n", "\n//\n", "\n>"])
@pytest.mark.parametrize("ending", [True, False])
def test_ranges_give_each_record_once(tmp_path, sep, ending):
    data = sep.join(texts(1, 150)).encode() + (sep.encode() if ending else b"")
    packed = members(data, (1, 2, 3, 700, 20000), 2)
    p = tmp_path / "a.gz"
    p.write_bytes(packed)
    reader = lambda size: gzipped._Reader({"paths": f'["{p}"]', "sep": __import__("json").dumps(sep), "range": str(size)})
    for size in (50, 333, 5000, len(packed), 1 << 30):
        r = reader(size)
        rows = [row for part in r.partitions() for b in r.read(part) for row in b.to_pylist()]
        assert [x["value"].encode() for x in rows] == split(data, sep.encode())
        assert [x["first"] for x in rows] == [True] + [False] * (len(rows) - 1)


def test_rows_of_several_tasks(spark, tmp_path):
    rows = spark.range(20000).select(F.concat(F.lit("record "), F.col("id").cast("string"), F.sha2(F.col("id").cast("string"), 256)).alias("value")).coalesce(1)
    gzipped.write_gzip_records(rows, str(tmp_path / "out"), member_bytes=50_000)
    (part,) = [x for x in (tmp_path / "out").iterdir() if x.name.endswith(".gz")]
    found = gzipped.read_gzip_records(spark, str(tmp_path / "out"), range_bytes=100_000)
    per_task = found.groupBy(F.spark_partition_id()).count().collect()
    assert len(per_task) > 5 and max(x["count"] for x in per_task) < 5000
    want = sorted(x["value"] for x in rows.collect())
    assert sorted(x["value"] for x in found.collect()) == want
    assert sorted(gzip.decompress(part.read_bytes()).decode().splitlines()) == want
    assert sorted(x["value"] for x in spark.read.text(str(tmp_path / "out")).collect()) == want


def test_written_again(spark, tmp_path):
    out = str(tmp_path / "out")
    two = spark.createDataFrame([("a",), (None,), ("b",)], "value string")
    gzipped.write_gzip_records(two, out)
    gzipped.write_gzip_records(two, out)
    assert sorted(x["value"] for x in gzipped.read_gzip_records(spark, out).collect()) == ["a", "a", "b", "b"]
    (tmp_path / "out" / "_part-left.gz").write_bytes(b"what a lost task left")
    gzipped.write_gzip_records(two, out, overwrite=True)
    assert sorted(x["value"] for x in gzipped.read_gzip_records(spark, out).collect()) == ["a", "b"]


def test_odd_files(spark, tmp_path):
    (tmp_path / "none").mkdir()
    (tmp_path / "none" / "a.gz").write_bytes(b"")
    (tmp_path / "none" / "b.gz").write_bytes(gzip.compress(b""))
    assert gzipped.read_gzip_records(spark, str(tmp_path / "none")).isEmpty()
    (tmp_path / "padded.gz").write_bytes(gzip.compress(b"a\nb") + bytes(600) + gzip.compress(b"c\n\nd") + bytes(512))
    assert [x["value"] for x in gzipped.read_gzip_records(spark, str(tmp_path / "padded.gz"), range_bytes=100).collect()] == ["a", "bc", "", "d"]
    with pytest.raises(FileNotFoundError):
        gzipped._files(str(tmp_path / "absent.gz"))


@pytest.mark.parametrize("size", [100, 1 << 20])
def test_broken_files_raise(tmp_path, size):
    good = b"".join(gzip.compress(t.encode()) for t in texts(3, 40))
    wrong = bytearray(good + gzip.compress(b"a longer record at the end\n" * 9))
    wrong[-6] ^= 255
    for bad in (good + gzip.compress(random.Random(4).randbytes(5000))[:-900], bytes(wrong), gzip.compress(b"a\n") + b"something else"):
        p = tmp_path / "bad.gz"
        p.write_bytes(bad)
        r = gzipped._Reader({"paths": f'["{p}"]', "sep": '"\\n"', "range": str(size)})
        with pytest.raises((EOFError, ValueError, zlib.error)):
            [b for part in r.partitions() for b in r.read(part)]


def test_readers_of_gzip_files(spark, tmp_path):
    fasta = ">ns|1|x name\nMK\nV\n>ns|2|y\nAA\n"
    (tmp_path / "a.gz").write_bytes(gzip.compress(fasta.encode()[:20]) + gzip.compress(fasta.encode()[20:]))
    (tmp_path / "a.fasta").write_text(">ns|3|z\nCC\n")
    (tmp_path / "b.gz").write_bytes(gzip.compress(b"lost\n" + fasta.encode()))
    got = readers.read_fasta(spark, [str(tmp_path / "a.gz"), str(tmp_path / "a.fasta")])
    assert sorted((r["id"], r["seq"]) for r in got.collect()) == [("1", "MKV"), ("2", "AA"), ("3", "CC")]
    assert sorted(r["status"] for r in readers.read_fasta(spark, str(tmp_path / "b.gz"), "keep").collect()) == ["no_nameline", "ok", "ok"]
    orth = b"PA\t1\t2\t0.2\t1e-20\nOR\ta\tb\t1.5\n//\nPA\t3\t4\t0.2\t1e-20\n//\n"
    (tmp_path / "o.gz").write_bytes(gzip.compress(orth[:34]) + gzip.compress(orth[34:]))
    assert {r["qdb"]: len(r["orthologs"]) for r in readers.read_orthdata(spark, str(tmp_path / "o.gz")).collect()} == {"1": 1, "3": 0}
