"""Runs that are killed and run again: results, exports, jobs, tables."""

import glob
import os
from collections import Counter

import pytest
from pyspark.sql import functions as F

from cladeframe import session
from cladeframe.operators import tables
from cladeframe.plans import query as Q
from cladeframe.sources import sinks
from cladeframe.streaming import batches
from cladeframe.streaming import load
from cladeframe.streaming.load import stream_load_orthologs


def times(path):
    return {f: os.stat(f).st_mtime_ns for f in glob.glob(f"{path}/**/part-*", recursive=True)}


def test_publish(spark, tmp_path):
    path = f"{tmp_path}/a"
    write = lambda n: lambda folder: spark.range(n).write.parquet(folder)
    assert session.publish(spark, path, write(3)) and not session.publish(spark, path, write(9))
    assert spark.read.parquet(path).count() == 3
    os.remove(f"{path}/_SUCCESS")  # not whole, with rows in it
    assert session.publish(spark, path, write(5)) and spark.read.parquet(path).count() == 5

    def other_writer(folder):  # wins while this one writes
        write(2)(folder)
        session.publish(spark, f"{tmp_path}/b", write(7))

    assert not session.publish(spark, f"{tmp_path}/b", other_writer)
    assert spark.read.parquet(f"{tmp_path}/b").count() == 7

    def killed(folder):
        write(4)(folder)
        raise KeyboardInterrupt

    with pytest.raises(KeyboardInterrupt):
        session.publish(spark, f"{tmp_path}/c", killed)
    assert not session.is_published(spark, f"{tmp_path}/c") and session.folders(spark, str(tmp_path)) == ["a", "b"]
    assert session.publish(spark, f"{tmp_path}/c", write(1)) and session.folders(spark, f"{tmp_path}/none") == []


def test_what_a_killed_writer_left_blocks_nothing(spark, tmp_path):
    place = f"{session.shared_dir(spark)}/results/{Q.query_fingerprint(test=str(tmp_path))}"
    os.makedirs(f"{place.removeprefix('file://')}/_temporary/0")
    assert Q.reuse(spark, lambda: spark.range(4), test=str(tmp_path)).count() == 4
    assert Q.reuse(spark, lambda: spark.range(0), test=str(tmp_path)).count() == 4
    os.makedirs(f"{tmp_path}/out/_temporary/0")
    lines = spark.createDataFrame([("b",), ("a",)], "value string")
    assert sinks.write_text(lines, f"{tmp_path}/out", ["value"]) and not sinks.write_text(lines, f"{tmp_path}/out", ["value"])
    assert [r.value for r in spark.read.text(f"{tmp_path}/out").collect()] == ["a", "b"]


@pytest.mark.parametrize("when", ["before its result is written", "before it is marked"])
def test_jobs_go_on_where_a_run_ended(spark, tmp_path, monkeypatch, when):
    pair = [(f"g{i}", f"h{j}") for i in range(4) for j in range(5)]
    pairs = spark.createDataFrame(pair, "qdb string, sdb string")
    ran = []

    def compute(own):
        ran.append(sorted(map(tuple, own.collect())))
        return own.select("*", F.concat("qdb", "sdb").alias("both"))

    path, real, seen = str(tmp_path), session.publish, []

    def stopping(spark, at, write):
        if "/results/" in at:
            seen.append(at)
            if len(seen) == 3:
                if when == "before it is marked":
                    write(f"{at}/_temporary")
                raise KeyboardInterrupt
        return real(spark, at, write)

    monkeypatch.setattr(batches, "publish", stopping)
    some = pairs.where("qdb <> 'g3'")
    with pytest.raises(KeyboardInterrupt):
        batches.work_off(some, path, compute, jobs=4)
    monkeypatch.setattr(batches, "publish", real)
    assert len(batches.pending_jobs(spark, path)) == 2
    done = times(f"{path}/results/deal=0/job=1")
    ran.clear()
    out = batches.work_off(pairs, path, compute, jobs=4)
    assert Counter(r.both for r in out.collect()) == Counter(a + b for a, b in pair)
    assert [len(x) for x in ran if x] == [4, 3, 2, 1, 1, 1] or sum(map(len, ran)) == 12  # two jobs of the first deal, new pairs
    assert times(f"{path}/results/deal=0/job=1") == done
    assert {(r.deal, r.job) for r in out.select("deal", "job").distinct().collect()} == {(0, 1), (0, 2), (0, 3), (0, 4), (1, 1), (1, 2), (1, 3), (1, 4)}
    ran.clear()
    assert batches.work_off(pairs, path, compute).count() == 20 and not any(ran)
    assert batches.work_off(pairs.limit(0), f"{path}/none", compute).count() == 0


def made(spark, path):
    genomes = spark.createDataFrame([(i, f"acc{i}") for i in range(1, 5)], "id int, acc string")
    sequences = spark.createDataFrame([(10 * g + k, g) for g in range(1, 5) for k in range(3)], "id int, genome_id int")
    bridge = spark.createDataFrame([(i, s, "t") for i, s in enumerate([10, 11, 20, 30, 41, 42])], "id int, sequence_id int, term string")
    results = spark.createDataFrame([(a, b, float(a * b)) for a in range(1, 5) for b in range(a + 1, 5)], "query_db int, subject_db int, dist double")
    tables.save_tables(path, genomes, sequences, bridge, results)
    return genomes, sequences, bridge, results


def rows(spark, path, like):
    return [Counter(map(tuple, df.select(x.columns).collect())) for df, x in zip(tables.read_tables(spark, path), like)]


@pytest.mark.parametrize("fails_at", [None, 0, 1, 2, 3, 4])
def test_a_genome_is_deleted_by_its_partitions(spark, tmp_path, monkeypatch, fails_at):
    path = str(tmp_path)
    like = made(spark, path)
    before, calls = times(path), []

    def failing(spark, at):
        calls.append(at)
        if len(calls) - 1 == fails_at:
            raise KeyboardInterrupt
        session.remove(spark, at)

    monkeypatch.setattr(tables, "remove", failing)
    if fails_at is None:
        assert tables.delete_genome(spark, path, "acc2")
    else:
        with pytest.raises(KeyboardInterrupt):
            tables.delete_genome(spark, path, "acc2")
        assert tables.delete_genome(spark, path, "acc2")
    genomes, sequences, bridge, results = like
    want = genomes.where("id <> 2"), sequences.where("genome_id <> 2"), bridge.where("sequence_id not between 20 and 29"), results.where("query_db <> 2 and subject_db <> 2")
    assert rows(spark, path, like) == [Counter(map(tuple, df.collect())) for df in want]
    after = times(path)
    assert after.items() <= before.items()  # no file is new or changed
    assert not tables.delete_genome(spark, path, "acc2") and times(path) == after


def test_a_genome_is_replaced_by_its_partitions(spark, tmp_path):
    path = str(tmp_path)
    like = made(spark, path)
    before = times(path)
    genome = like[0].where("id = 2")
    sequences = spark.createDataFrame([(90, 2), (91, 2)], "id int, genome_id int")
    none = like[2].limit(0)
    results = spark.createDataFrame([(1, 2, 9.0), (2, 5, 8.0)], "query_db int, subject_db int, dist double")
    for bad in ((genome.withColumn("id", F.lit(7)), sequences), (genome, like[1])):
        with pytest.raises(ValueError):
            tables.replace_genome(spark, path, *bad, none, results)
    assert times(path) == before
    for _ in range(2):  # once more changes nothing
        tables.replace_genome(spark, path, genome, sequences, none, results)
        want = like[0], like[1].where("genome_id <> 2").union(sequences), like[2].where("sequence_id <> 20"), like[3].where("query_db <> 2 and subject_db <> 2").union(results)
        assert rows(spark, path, like) == [Counter(map(tuple, df.collect())) for df in want]
    same = {f: t for f, t in times(path).items() if "=2/" not in f}
    assert same.items() <= before.items() and len(same) >= 4
    new = spark.createDataFrame([(6, "acc6")], "id int, acc string")
    tables.replace_genome(spark, path, new, sequences.withColumn("genome_id", F.lit(6)), none, results.limit(0))
    assert tables.genome_id(spark, path, "acc6") == 6 and tables.genome_id(spark, path, "other") is None


def block(a, b, *genes):
    return f"PA\t{a}\t{b}\t0.2\t1e-20\n" + "".join(f"OR\t{g}\ty\t1.0\n" for g in genes) + "//\n"


def loaded(spark, table):
    return {(r.qdb, r.sdb): sorted(o.qid for o in r.orthologs) for r in spark.read.parquet(table).collect()}


def test_a_stream_keeps_what_it_has_seen(spark, tmp_path):
    """Its own state, not the table, tells what is new; a batch that is run again replaces itself."""
    src, table, check = tmp_path / "in", str(tmp_path / "t"), str(tmp_path / "c")
    src.mkdir()
    (src / "a.txt").write_text(block(1, 2, "a") + block(1, 2, "b", "c") + block(1, 3))
    assert stream_load_orthologs(spark, str(src), table, check) >= 1
    assert loaded(spark, table) == {("1", "2"): ["b", "c"], ("1", "3"): []}
    # The last batch is done but not committed: the stream runs it once more.
    commits = sorted(os.listdir(f"{check}/commits"), key=lambda x: (len(x), x))
    last = [x for x in commits if x.isdigit()][-1]
    for x in (last, f".{last}.crc"):
        if os.path.exists(f"{check}/commits/{x}"):
            os.remove(f"{check}/commits/{x}")
    (src / "b.txt").write_text(block(1, 2, "x", "y", "z") + block(2, 3, "x"))
    stream_load_orthologs(spark, str(src), table, check)
    assert loaded(spark, table) == {("1", "2"): ["b", "c"], ("1", "3"): [], ("2", "3"): ["x"]}
    assert spark.read.parquet(table).count() == 3
    # Another checkpoint on the same table adds what neither has.
    (src / "c.txt").write_text(block(1, 3, "late") + block(7, 8, "new"))
    stream_load_orthologs(spark, str(src), table, str(tmp_path / "c2"))
    assert loaded(spark, table) == {("1", "2"): ["b", "c"], ("1", "3"): [], ("2", "3"): ["x"], ("7", "8"): ["new"]}


def test_a_stream_keeps_its_state_on_disk_without_python(spark, tmp_path):
    """Sets seen aren't held in the executors' heap, and no row of a batch goes through Python; the session's setting stays."""
    src, table, check = tmp_path / "in", str(tmp_path / "t"), str(tmp_path / "c")
    src.mkdir()
    (src / "a.txt").write_text("".join(block(1, n % 50, *"ab"[: n % 3]) for n in range(100)))
    had = spark.conf.get(load.STORE)
    stream_load_orthologs(spark, str(src), table, check)
    assert spark.conf.get(load.STORE) == had
    assert len(loaded(spark, table)) == spark.read.parquet(table).count() == 50
    assert loaded(spark, table)[("1", "2")] == ["a", "b"]  # of none and two orthologs
    state = [x for _, _, names in os.walk(f"{check}/state") for x in names]
    assert any(x.endswith(".zip") for x in state) and not any(x.endswith(".delta") for x in state)
    with open(load.__file__) as f:
        assert "Pandas" not in f.read()
