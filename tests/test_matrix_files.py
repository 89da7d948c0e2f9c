"""Results written in pieces against the same ones line by line."""

import gzip
import os

import pytest
from pyspark.sql import functions as F

from cladeframe.operators import profiles
from cladeframe.plans.query import Result, export_matrix
from cladeframe.sources import sinks

GENOMES = ["Homo_sapiens_x", "b.aa", "c", "none"]
CELLS = [(cid, g, f"{g}{cid}") for cid in range(3, 40, 3) for i, g in enumerate(GENOMES[:3]) if cid % (i + 2) or i == 2]


def _result(spark, cells):
    members = spark.createDataFrame(cells, "cid long, genome string, gene string")
    return Result(members, members.select("cid").distinct(), None, GENOMES)  # matrices need no edges


def _joined(path):
    """The files joined by name, as one gzip file."""
    parts = sorted(x for x in os.listdir(path) if x.startswith("part-"))
    return gzip.decompress(b"".join(open(f"{path}/{x}", "rb").read() for x in parts)).decode() if parts else ""


def _wanted(kind, cells):
    cids = sorted({c for c, _, _ in cells})
    rows = [(g.removesuffix(".aa"), [str(int(any(x[:2] == (c, g) for x in cells))) for c in cids]) for g in GENOMES]
    if kind == "phylip":
        return "".join(f"{x}\n" for x in [f"4 {len(cids)}", *(f"{g[:10]:10}{' '.join(row)}" for g, row in rows)])
    head = ["#Nexus", "Begin data;", f"Dimensions ntax=4 nchar={len(cids)};", 'Format datatype=standard symbols="01";', "Matrix"]
    return "".join(f"{x}\n" for x in [*head, *(f"{g} {''.join(row)}" for g, row in rows), ";", "End;"])


@pytest.mark.parametrize("size", [1, 3, 13, 1000])
@pytest.mark.parametrize("kind", ["nexus", "phylip"])
def test_files_are_the_matrix(spark, tmp_path, kind, size):
    path = str(tmp_path / "m")
    assert export_matrix(_result(spark, CELLS), kind, path, size)
    assert _joined(path) == _wanted(kind, CELLS)
    assert not export_matrix(_result(spark, CELLS[:3]), kind, path, size)  # a whole folder stays
    assert _joined(path) == _wanted(kind, CELLS)


@pytest.mark.parametrize("kind", ["nexus", "phylip"])
def test_without_clusters(spark, tmp_path, kind):
    path = str(tmp_path / "m")
    export_matrix(_result(spark, []), kind, path)
    assert _joined(path) == _wanted(kind, [])


def test_lines_go_on_in_other_files(spark, tmp_path):
    path = str(tmp_path / "m")
    kept = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        export_matrix(_result(spark, CELLS), "nexus", path, 1)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", kept)
    files = [gzip.open(f"{path}/{x}").read() for x in sorted(os.listdir(path)) if x.startswith("part-")]
    assert len(files) > 1 and any(not x.endswith(b"\n") for x in files[:-1])
    assert _joined(path) == _wanted("nexus", CELLS)


def test_what_a_killed_run_left_is_made_anew(spark, tmp_path):
    path = tmp_path / "m"
    path.mkdir()
    (path / "part-00000-left.gz").write_bytes(gzip.compress(b"left"))
    assert export_matrix(_result(spark, CELLS), "nexus", str(path), 2)
    assert _joined(path) == _wanted("nexus", CELLS)


def test_no_value_grows_with_clusters(spark):
    cells = [(c, g, f"{g}{c}") for c in range(500) for g in GENOMES[:2]]
    r = _result(spark, cells)
    pieces = sinks.matrix_pieces(profiles.genome_blocks(r.members, r.stats, GENOMES, 50), GENOMES, "phylip")
    assert pieces.agg(F.max(F.length("value"))).first()[0] == 100
    assert pieces.groupBy("line").agg(F.sum(F.length("value")).alias("n")).where("line = 1").first().n == 10 + 999 + 1
    with pytest.raises(ValueError):
        sinks.matrix_pieces(pieces, GENOMES, "text")


def test_cells_of_a_large_cluster_are_many_rows(spark):
    cells = [(1, "a", f"g{i:03}") for i in range(250)] + [(1, None, "x"), (2, "a", "y"), (2, "a", "y")]
    members = spark.createDataFrame(cells, "cid long, genome string, gene string")
    rows = profiles.cluster_cells(members, 20).orderBy("cid", "genome", "part").collect()
    assert max(len(r.genes) for r in rows) == 20 and len(rows) >= 250 // 20 + 2
    assert sorted((r.cid, str(r.genome), g) for r in rows for g in r.genes) == sorted((c, str(g), x) for c, g, x in cells)
    assert [g for r in rows if r.genome == "a" and r.cid == 1 for g in r.genes] == [f"g{i:03}" for i in range(250)]
    assert profiles.cluster_cells(members.limit(0)).count() == 0
    with pytest.raises(ValueError):
        profiles.cluster_cells(members, 0)


def test_xml_by_genes_is_the_same_document(spark, tmp_path):
    cells = [(1, g, f"{g}<{i}") for i in range(30) for g in ("h&s", "b")] + [(12, "b", "lone"), (12, "h&s", "other"), (13, "c", "no average")]
    members = spark.createDataFrame(cells, "cid long, genome string, gene string")
    averages = spark.createDataFrame([(1, 0.25), (12, 1.0)], "cid long, avg_dist double")
    genes = spark.createDataFrame([(x, g, n) for n, (_, g, x) in enumerate(sorted(cells, key=lambda t: t[1:]), 1)], "gene string, genome string, num int")
    whole = "".join(r.value for r in sinks.orthoxml_groups(members.select("cid", "gene"), averages, genes).orderBy("section", "ord").collect())
    pieces = sinks.orthoxml_group_pieces(members, averages, genes)
    sinks.write_text(pieces, str(tmp_path / "x"), ["section", "ord", "piece"])
    lines = [x for f in sorted(os.listdir(tmp_path / "x")) if f.startswith("part-") for x in open(tmp_path / "x" / f).read().splitlines()]
    assert "".join(lines) == whole
    assert max(map(len, lines)) < 80
