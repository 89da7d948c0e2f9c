from collections import Counter

import pytest
from pyspark.sql import functions as F

from cladeframe import model
from cladeframe.sources import readers, sinks

ORTH = "PA\t377629\t553174\t0.2\t1e-20\nOR\tC5BPU7\tD9RR02\t1.4127\nOR\tC5BKE0\tD9RR03\t2.1041\n//\nPA\t502025\t521010\t0.2\t1e-20\n//\n"


def write(tmp_path, name, text):
    p = tmp_path / name
    p.write_text(text)
    return str(p)


def test_orthdata_round_trip(spark, tmp_path):
    rows = readers.read_orthdata(spark, write(tmp_path, "a.txt", ORTH))
    got = {r["qdb"]: [tuple(o) for o in r["orthologs"]] for r in rows.collect()}
    assert got == {"377629": [("C5BPU7", "D9RR02", 1.4127), ("C5BKE0", "D9RR03", 2.1041)], "502025": []}
    sinks.write_orthdata(rows.coalesce(1), str(tmp_path / "out"))
    again = readers.read_orthdata(spark, str(tmp_path / "out"))
    assert sorted(map(str, again.collect())) == sorted(map(str, rows.collect()))
    assert model.flatten(rows).count() == 2
    assert model.flatten(rows, keep_empty=True).count() == 3
    assert {r["num_orthologs"] for r in model.num_orthologs(rows).collect()} == {0, 2}
    sinks.collate_orthologs(rows, str(tmp_path / "by"), compression="gzip")
    assert readers.read_orthdata(spark, str(tmp_path / "by" / "div=0.2" / "evalue=1e-20")).count() == 2


@pytest.mark.parametrize(
    "text, status",
    [
        (">a\nMV\nLL\n", ["ok"]), (">a\nMV\n>b\nLL\n", ["ok", "ok"]), (">a\nMV\n\nLL\n", ["blank_line"]), (">a\n>b\nMV\n", ["no_sequence", "ok"]),
        (">a\nMV\n>b\n", ["ok", "no_sequence"]), ("MV\n>b\nLL\n", ["no_nameline", "ok"]),
    ],
)
def test_fasta_shapes(spark, tmp_path, text, status):
    path = write(tmp_path, "x.fasta", text)
    got = [r["status"] for r in readers.read_fasta(spark, path, "keep").collect()]
    assert got == status
    assert readers.read_fasta(spark, path).count() == status.count("ok")
    if set(status) != {"ok"}:
        with pytest.raises(Exception, match="malformed"):
            readers.read_fasta(spark, path, "strict").select("seq").collect()


def test_malformed_records_of_many_files(spark, tmp_path):
    """Files that share a partition, and blocks of one file."""
    for i in range(60):
        write(tmp_path, f"{i}.fasta", f"MV\nLL\n>n|{i}\nAA\nCC\n>n|{i}b\n" if i % 2 else f">n|{i}\nAA\n>\nGG\n>n|x\n\nTT\n")
    found = readers.read_fasta(spark, str(tmp_path), "keep")
    assert found.rdd.getNumPartitions() < 60
    got = Counter((r.nameline, r.seq, r.status) for r in found.collect())
    assert sum(n for (_, _, s), n in got.items() if s == "no_nameline") == 30 == got["", "MVLL", "no_nameline"]
    assert all(got[f">n|{i}", "AACC" if i % 2 else "AA", "ok"] == 1 for i in range(60))
    assert got[">", "GG", "ok"] == got[">n|x", "TT", "blank_line"] == 30 and sum(s == "no_sequence" for _, _, s in got) == 30
    assert readers.read_genome_dir(spark, str(tmp_path)).count() == 90
    write(tmp_path, "big", "JUNK\n" + "".join(f">n|{i}\n{'MVLK' * 10}\n" for i in range(4000)))
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    try:
        big = readers.read_fasta(spark, str(tmp_path / "big"), "keep")
        assert big.rdd.getNumPartitions() > 5 and Counter(r.status for r in big.collect()) == {"ok": 4000, "no_nameline": 1}
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


def test_genome_dir_round_trip(spark, tmp_path):
    rows = [(g, f">n|{g}{i}", "MVL" * 30) for g in ("7", "Brand#1", "a b/c") for i in range(40)]
    genes = spark.createDataFrame(rows, "genome string, nameline string, sequence string")
    sinks.write_genome_fasta(genes, str(tmp_path / "out"))
    assert sorted(map(tuple, readers.read_genome_dir(spark, str(tmp_path / "out")).select("genome", "nameline", "seq").collect())) == sorted(rows)


def test_text_is_written_once(spark, tmp_path):
    lines = spark.range(5).select(F.col("id").cast("string").alias("value"))
    path = str(tmp_path / "t")
    assert sinks.write_text(lines, path, ["value"], "gzip") and not sinks.write_text(lines, path, ["value"], "gzip")
    assert spark.read.text(path).count() == 5


def test_genome_dir(spark, tmp_path):
    write(tmp_path, "9606.fasta", ">ns|a x\nMV\n>ns|b\nLL\n")
    write(tmp_path, "readme.fasta", ">c\nMV\n")
    rows = readers.read_genome_dir(spark, str(tmp_path)).collect()
    assert sorted((r["genome"], r["id"], r["seq"]) for r in rows) == [("9606", "a", "MV"), ("9606", "b", "LL")]


def test_dat(spark, tmp_path):
    text = (
        "ID   1A01_HUMAN              Reviewed;         365 AA.\nAC   Q16653; O00713; O00714;\nDT   01-DEC-2001, integrated.\nDT   01-DEC-2001, sequence version 1.\n"
        "DE   RecName: Full=Uncharacterized protein 002R;\nGN   Name=GRF7; OrderedLocusNames=At3g02520; ORFNames=F16B3.15;\nOS   Frog virus 3\nOS   (isolate Goorha) (FV-3).\n"
        "OX   NCBI_TaxID=9606;\nPE   2: Evidence at transcript level;\nKW   Complete proteome; Reference proteome.\nDR   GO; GO:0006351; P:transcription.\nDR   GeneID; 2947774; -.\n"
        "SQ   SEQUENCE   8 AA;\n     MVLL AAGG\n     KK\n//\n"
        "ID   A1XWB5_9EURY            Unreviewed;       133 AA.\nAC   A1XWB5;\nOX   NCBI_TaxID=1;\nOX   NCBI_TaxID=2;\nGN   ORFNames=x;\n     MM\n//\n"
    )
    a, b = readers.read_dat(spark, write(tmp_path, "x.dat", text)).collect()
    assert (a.ns, a.acc, a.org_code, a.taxon, a.gene_name, a.evidence, a.seq_version) == ("sp", "Q16653", "HUMAN", "9606", "GRF7", "2", "1")
    assert a.org_name == "Frog virus 3 (isolate Goorha)" and a.gene_desc == "Uncharacterized protein 002R"
    assert a.complete and a.reference and a.go_terms == ["GO:0006351"] and a.gene_ids == ["2947774"] and a.sequence == "MVLLAAGGKK" and a.anomalies == []
    assert (b.ns, b.org_code, b.gene_name, b.complete, b.anomalies, b.sequence) == ("tr", "9EURY", "", False, ["many_ox"], "MM")


def test_small_readers(spark, tmp_path):
    cats = write(tmp_path, "categories.dmp", "E 9606 9606\nB 562 83333\n")
    names = write(tmp_path, "names.dmp", "9606\t|\tHomo sapiens\t|\t\t|\tscientific name\t|\n9606\t|\tman\t|\t\t|\tcommon name\t|\n7\t|\tX\t|\t\t|\tscientific name\t|\n")
    got = {r.taxon: (r.cat_code, r.cat_name, r.name) for r in readers.read_taxa(spark, cats, names).collect()}
    assert got == {"9606": ("E", "Eukaryota", "Homo sapiens"), "83333": ("B", "Bacteria", None), "7": (None, None, "X")}
    terms = write(tmp_path, "term.txt", "1\tgrowth\tbiological_process\tGO:1\t0\n2\told\tbiological_process\tGO:2\t1\n3\tf\tmolecular_function\tGO:3\t0\n")
    assert [r.acc for r in readers.read_terms(spark, terms).collect()] == ["GO:1"]
    mapping = write(tmp_path, "map.tab", "\t".join(["P1", "x", "1; 2", *[""] * 3, "GO:1; GO:2", *[""] * 16]) + "\n" + "\t".join(["P2", *[""] * 22]) + "\n")
    got = {r.acc: (r.gene_ids, r.go_terms) for r in readers.read_idmapping(spark, mapping).collect()}
    assert got == {"P1": (["1", "2"], ["GO:1", "GO:2"]), "P2": ([], [])}
    edges = readers.read_edges(spark, write(tmp_path, "e.txt", "a b 0.5\nc  d\t1\n")).collect()
    assert [tuple(r) for r in edges] == [("a", "b", 0.5), ("c", "d", 1.0)]
    with pytest.raises(ValueError):
        readers.read_ortholog_tsv(spark, edges, 3)


def test_xml(spark):
    genes = spark.createDataFrame([("a<b", "g1", 1), ("c", "g2", 2)], "gene string, genome string, num int")
    pairs = spark.createDataFrame([("a<b", "c", "0.2", "1e-20", 0.5)], "qid string, sid string, div string, evalue string, dist double")
    text = "".join(r["value"] for r in sinks.orthoxml_pairs(pairs, genes).orderBy("section", "ord").collect())
    import xml.dom.minidom

    doc = xml.dom.minidom.parseString(text)
    assert [g.getAttribute("protId") for g in doc.getElementsByTagName("gene")] == ["a<b", "c"]
    assert [g.getAttribute("id") for g in doc.getElementsByTagName("geneRef")] == ["1", "2"]
    members = spark.createDataFrame([(1, "a<b"), (1, "c")], "cid long, gene string")
    text = "".join(r["value"] for r in sinks.orthoxml_groups(members, spark.createDataFrame([(1, 0.5)], "cid long, avg_dist double"), genes).orderBy("section", "ord").collect())
    assert len(xml.dom.minidom.parseString(text).getElementsByTagName("orthologGroup")) == 1


def test_wide_text(spark):
    rows = spark.createDataFrame([("Homo_sapiens_x", [1, 0]), ("B", [1, 1])], "genome string, profile array<int>")
    assert [r["value"] for r in sinks.phylip_matrix(rows).orderBy("line_no", F.desc("value")).collect()] == ["2 2", "Homo_sapie1 0", "B         1 1"]
    assert sinks.nexus_matrix(rows).orderBy("line_no").collect()[2]["value"] == "Dimensions ntax=2 nchar=2;"
