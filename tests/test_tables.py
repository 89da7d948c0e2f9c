import pytest
from pyspark.sql import functions as F

from cladeframe import model
from cladeframe.operators import census, changes, dims, pairs, ranking, rsd
from cladeframe.plans import query, release
from cladeframe.streaming.load import stream_load_orthologs


def test_split_and_batches(spark):
    sizes = lambda n, k: sorted((r["count"] for r in ranking.split_into_n(spark.range(n), k, "id").groupBy("group_no").count().collect()), reverse=True)
    assert sizes(10, 3) == [4, 3, 3] and sizes(11, 3) == [4, 4, 3] and sizes(2, 3) == [1, 1] and sizes(0, 3) == []
    rows = ranking.groups_of_n(spark.range(7), 3, "id").orderBy("id").collect()
    assert [r.group_no for r in rows] == [0, 0, 0, 1, 1, 1, 2]
    assert [r.id for r in ranking.every_nth(spark.range(1, 8), 3, "id").orderBy("id").collect()] == [3, 6]
    assert [r.n for r in ranking.dense_ids(spark.range(50).repartition(5), "id", name="n").orderBy("id").collect()] == list(range(1, 51))


def test_pairs_sort_as_text(spark):
    df = spark.createDataFrame([("9606", "10090"), ("10090", "9606")], "a string, b string")
    assert [tuple(r) for r in model.normalize_pairs(df).collect()] == [("10090", "9606")]
    got = {tuple(r) for r in pairs.pairs_for(spark, "a", ["b", "c"]).collect()}
    assert got == {("a", "b"), ("a", "c")}
    assert pairs.genome_pairs(spark.createDataFrame([(x,) for x in "abcd"], "genome string")).count() == 6
    items = spark.createDataFrame([(x,) for x in "abc"], "item string")
    assert pairs.combinations(items, 2).count() == 3 and pairs.permutations(items, 3).count() == 6


def test_selection(spark):
    c = spark.createDataFrame([("1", 300), ("2", 100), ("3", 300), ("4", 300)], "genome string, complete long")
    taxa = spark.createDataFrame([("1", "E"), ("2", "E"), ("4", "V")], "taxon string, cat_code string")
    got = {r.genome: r.reason for r in census.select_genomes(c, taxa).collect()}
    assert got == {"1": None, "2": "too_few", "3": "missing_taxon", "4": "filtered_taxon_cat_code"}
    assert {r.reason: r.n for r in census.funnel(census.select_genomes(c, taxa)).collect()}["selected"] == 1


def test_changes(spark):
    g = spark.createDataFrame([("r1", "1", "Homo sapiens a", "E"), ("r1", "2", "Homo sapiens b", "E"), ("r2", "1", "Homo sapiens a", "E")], "release string, taxon string, name string, category string")
    items = changes.change_items(g)
    got = {(r.release_a, r.kind, r.item) for r in changes.change_log_diff(items).collect()}
    assert got == {("r1", "taxons", "2"), ("r1", "euks", "2"), ("r1", "multiTaxonSpecies", "Homo sapiens"), ("r1", "multiEukSpecies", "Homo sapiens")}


def test_rsd(spark):
    hits = [("a1", "A", "b1", "B", 1.0), ("a1", "A", "b2", "B", 2.0), ("a2", "A", "b1", "B", 0.5), ("a2", "A", "b2", "B", 3.0)]
    df = spark.createDataFrame(hits, "qid string, qdb string, sid string, sdb string, dist double")
    assert [(r.qid, r.sid) for r in rsd.reciprocal_smallest_distance(df).collect()] == [("a2", "b1")]
    grid = spark.createDataFrame([("0.2", "1e-5", 0.7), ("0.8", "1e-5", 0.1)], "div string, evalue string, `limit` double")
    assert [(r.div, r.qid) for r in rsd.rsd_grid(df, grid).collect()] == [("0.2", "a2")]
    genes = spark.createDataFrame([("x", "MVLLAAGGKK"), ("y", "TTTTTTTTTT")], "gene string, seq string")
    queries = spark.createDataFrame([("same", "MVLLAAGGKK"), ("near", "MVLLAAGGTT"), ("none", "CCCCCCCC")], "query string, seq string")
    assert {r.query: r.gene for r in rsd.lookup_sequence(queries, genes).collect()} == {"same": "x", "near": "x"}


def test_search_and_names(spark):
    s = spark.createDataFrame([("a", "1", "Data"), ("b", "1", "beta"), ("c", "2", "ataxin")], "external_sequence_id string, genome_id string, gene_name string")
    assert {r.gene_name for r in dims.gene_names_like(s, "ata").collect()} == {"Data", "ataxin"}
    assert {r.gene_name for r in dims.gene_names_like(s, "ata", "starts_with").collect()} == {"ataxin"}
    with pytest.raises(ValueError):
        dims.gene_names_like(s, "x", "sounds_like")
    g = spark.createDataFrame([("1", "Homo"), ("2", "Mus")], "genome string, name string")
    assert dims.resolve_names(g, ["Mus", "Homo", "Mus"]) == ["1", "2"]
    with pytest.raises(ValueError, match="Canis"):
        dims.resolve_names(g, ["Canis"])
    with pytest.raises(ValueError):
        dims.resolve_names(g, ["Homo"], 2)


EDGES = [("a1", "b1", "A", "B", 1.0), ("b1", "c1", "B", "C", 1.0), ("a1", "c1", "A", "C", 1.0), ("a2", "b2", "A", "B", 2.0), ("b2", "c2", "B", "C", 9.0)]


def test_queries(spark):
    e = spark.createDataFrame(EDGES, "q string, s string, qdb string, sdb string, dist double")
    r = query.orthology_query(e, tc_only=True)
    assert r.genomes == ["A", "B", "C"] and [x.cid for x in r.stats.collect()] == ["a1"] and r.edges.count() == 3
    some = spark.createDataFrame([("c2",)], "gene string")
    r = query.orthology_query(e, seq_ids=some)
    assert r.genomes == ["A", "B", "C"] and {x.gene for x in r.members.collect()} == {"b2", "c2"}
    r = query.orthology_query(e, genome="B", limit_genomes=["A"], upper=1.5)
    assert r.genomes == ["B", "A"] and {x.gene for x in r.members.collect()} == {"a1", "b1"}
    g = spark.createDataFrame([("A", "a"), ("B", "b")], "genome string, name string")
    seqs = spark.createDataFrame([("a1", "A", "x")], "gene string, genome string, gene_name string")
    assert {m.gene for m in query.browse(e, g, seqs, "a", ["b"], "x", "gene_name").members.collect()} == {"a1", "b1"}
    with pytest.raises(ValueError, match="no gene named"):
        query.browse(e, g, seqs, "a", ["b"], "y", "gene_name")
    with pytest.raises(ValueError):
        query.browse(e, g, seqs, "a", ["a"])
    assert query.query_fingerprint(a=1, b=2) == query.query_fingerprint(b=2, a=1)
    calls = []
    make = lambda: calls.append(1) or spark.range(3)
    key = {"x": str(id(calls))}
    assert query.reuse(spark, make, **key).count() == query.reuse(spark, make, **key).count() == 3 and calls == [1]


def test_release(spark):
    recs = [("1", f"p{i}", "sp", True, False, "one", "1", "ORG") for i in range(3)] + [("2", f"q{i}", "tr", True, True, "two", "2", "ORH") for i in range(3)]
    records = spark.createDataFrame(recs, "genome string, acc string, ns string, complete boolean, reference boolean, org_name string, taxon string, org_code string")
    taxa = spark.createDataFrame([("1", "E", "one"), ("2", "B", "two")], "taxon string, cat_code string, name string")
    hits = spark.createDataFrame([("p0", "1", "q0", "2", 1.0)], "qid string, qdb string, sid string, sdb string, dist double")
    grid = spark.createDataFrame([("0.2", "1e-5", 2.0)], "div string, evalue string, `limit` double")
    r = release.build_release(records, taxa, hits, grid, least=2)
    assert r.genes.count() == 6 and r.orthologs.count() == 1 and tuple(r.stats.first()) == (2, 1, 1)


def test_stream_adds_once(spark, tmp_path):
    src = tmp_path / "in"
    src.mkdir()
    (src / "a.txt").write_text("PA\t1\t2\t0.2\t1e-20\nOR\ta\tb\t1.0\n//\nPA\t1\t3\t0.2\t1e-20\n//\n")
    args = (spark, str(src), str(tmp_path / "t"), str(tmp_path / "c"))
    stream_load_orthologs(*args)
    stream_load_orthologs(*args)
    (src / "b.txt").write_text("PA\t1\t2\t0.2\t1e-20\nOR\tx\ty\t1.0\n//\nPA\t2\t3\t0.2\t1e-20\nOR\tx\ty\t1.0\n//\n")
    stream_load_orthologs(*args)
    rows = spark.read.parquet(str(tmp_path / "t"))
    assert {(r.qdb, r.sdb): r.num_orthologs for r in rows.collect()} == {("1", "2"): 1, ("1", "3"): 0, ("2", "3"): 1}
    assert rows.where(F.exists("orthologs", lambda o: o["qid"] == "x") & (F.col("qdb") == "1")).count() == 0


def test_release_tables(spark, tmp_path):
    genes = spark.createDataFrame([("p1", "1", "one", ["7", "8"], ["GO:1", "GO:9"]), ("p2", "2", "", [], [])], "acc string, genome string, gene_name string, gene_ids array<string>, go_terms array<string>")
    names = spark.createDataFrame([("1", "n1"), ("2", "n2")], "genome string, name string")
    taxa = spark.createDataFrame([("1", "E", "Eukaryota", "t1")], "taxon string, cat_code string, cat_name string, taxon_name string")
    terms = spark.createDataFrame([("GO:1", "growth", "biological_process")], "acc string, name string, type string")
    tables = release.release_dimensions(genes, names, taxa, terms)
    assert [(r.id, r.acc, r.taxon_category_code, r.num_seqs) for r in tables["genomes"].orderBy("id").collect()] == [(1, "1", "E", 1), (2, "2", None, 1)]
    assert [tuple(r) for r in tables["sequence"].orderBy("id").collect()] == [(1, "p1", 1, "one", 7), (2, "p2", 2, "", None)]
    assert [tuple(r) for r in tables["sequence_to_go_term"].collect()] == [(1, 1, "GO:1", "growth", "biological_process")]
    ids = tables["sequence"].select(F.col("id").alias("sequence_id"))
    assert {r.sequence_id: r.term_accs for r in dims.sequence_terms(ids, tables["sequence_to_go_term"]).collect()} == {1: ["GO:1"], 2: []}
    spark.sql(f"CREATE DATABASE IF NOT EXISTS rel_test LOCATION '{tmp_path}/db'")
    release.load_release(tables, "rel_test", "r5")
    release.load_release(tables, "rel_test", "r5")
    assert spark.table("rel_test.r5_sequence").count() == 2
    spark.sql("DROP DATABASE rel_test CASCADE")


def test_reference_set_and_uploads(spark, tmp_path):
    from cladeframe.sources import readers, sinks

    genes = spark.createDataFrame([("1", ">a", "MV" * 40), ("2", ">b", "LL")], "genome string, nameline string, sequence string")
    sinks.write_genome_fasta(genes, str(tmp_path / "fa"))
    back = readers.read_fasta(spark, str(tmp_path / "fa" / "genome=1")).first()
    assert back.id == "a" and back.seq == "MV" * 40
    taxa = spark.createDataFrame([("1", "one"), ("2", "two")], "taxon string, name string")
    hits = spark.createDataFrame([("a", "1", "b", "2", 1.0)], "qid string, qdb string, sid string, sdb string, dist double")
    genomes, orthologs = release.build_reference_set(genes, taxa, hits, 2.0)
    assert genomes.count() == 2 and [r.value for r in sinks.pairs_for_upload(orthologs).collect()] == ["a\tb"]
    with pytest.raises(ValueError, match="unique"):
        release.genome_names(genes.select("genome"), taxa.withColumn("name", F.lit("same")))


def test_raw_download(spark):
    rows = spark.createDataFrame([("10090", "9606", "0.2", "1e-20", "x", "y", 0.5)], model.ORTHOLOGS)
    assert [r.value for r in query.raw_pair_download(rows, "9606", "10090", "0.2", "1e-20").collect()] == ["PA\t10090\t9606\t0.2\t1e-20\nOR\tx\ty\t0.5"]
    assert query.raw_pair_download(rows, "9606", "1", "0.2", "1e-20").count() == 0
    with pytest.raises(ValueError):
        query.raw_pair_download(rows, "1", "1", "0.2", "1e-20")
    genes = spark.createDataFrame([("x", "10090", 1), ("y", "9606", 2), ("z", "9606", 3)], "gene string, genome string, num int")
    xml = "".join(r.value for r in query.raw_pair_download(rows, "9606", "10090", "0.2", "1e-20", "orthoxml", genes).orderBy("section", "ord").collect())
    assert xml.count("<gene ") == 2 and xml.count("<orthologGroup>") == 1
    assert query.release_stats(spark.createDataFrame([("a",), ("b",)], "genome string"), rows, "5", "2013-06-01").first().num_pairs == 1


@pytest.mark.parametrize("kind", ["text", "matrix", "nexus", "phylip", "orthoxml"])
def test_renders(spark, kind):
    e = spark.createDataFrame(EDGES, "q string, s string, qdb string, sdb string, dist double")
    names = spark.createDataFrame([("a1", "n")], "gene string, gene_name string")
    terms = spark.createDataFrame([("a1", "t")], "gene string, term string")
    rows = query.render(query.orthology_query(e, upper=1.5), kind, names, terms)
    if kind == "text":  # with its empty lines, as one document
        lines = [r.value for r in rows.orderBy(F.asc_nulls_first("cid"), "part", "genome", "gene").collect()]
        clusters = sum(x.startswith("Gene Cluster #") for x in lines)
        assert lines[:4] == ["Orthology Search Results", "", f"{clusters} results found for your search." if clusters > 1 else "1 result found for your search.", ""]
        assert lines[5] == "Id\tGenome\tGene Name\tGO Terms" and lines[-1] == "" and lines.count("") == 2 + clusters
        assert any(x.startswith("a1\t") and x.endswith("\tn\tt") for x in lines)
    else:
        assert all(r.value for r in rows.collect())
