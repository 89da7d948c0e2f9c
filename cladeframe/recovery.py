"""Queries of what a failed run leaves: saved results, exports, jobs and tables, begun, broken off
and begun again."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from cladeframe import queries
from cladeframe.operators import census, dims, pairs, profiles, tables
from cladeframe.plans import query as Q
from cladeframe.plans import release
from cladeframe.queries import E_SQL, _scratch
from cladeframe.session import read_table, remove, shared_dir, stage
from cladeframe.sources import adapters as A
from cladeframe.sources import sinks
from cladeframe.streaming import batches

QUERIES: dict = {}
ORACLES: dict[str, str] = {}


def query(sql: str):
    def add(f):
        QUERIES[f.__name__], ORACLES[f.__name__] = f, sql
        return f

    return add


class Killed(Exception):
    """Stands for the end of a run."""


@query(f"WITH {E_SQL} SELECT qdb, sdb, count(*) AS n, CAST(round(min(dist) * 1000000) AS BIGINT) AS least FROM edges GROUP BY ALL")
def resumed_genome_pairs(spark, sf):
    """Pairs of half of the genomes are worked off until the fourth job, whose run is killed; then
    those of all genomes."""
    edges = stage(A.edges(spark, sf), "edges")
    path, begun = _scratch(spark, "pairs"), []

    def compute(own, last=10**9):
        begun.append(1)
        if len(begun) > last:
            raise Killed
        return edges.join(own, ["qdb", "sdb"], "left_semi").groupBy("qdb", "sdb").agg(F.count("*").alias("n"), F.round(F.min("dist") * 1000000).cast("long").alias("least"))

    genomes = A.genomes(spark, sf)
    try:
        batches.work_off(pairs.genome_pairs(genomes.where("substr(genome, 7) < '2'")), path, lambda own: compute(own, 3), jobs=5)
    except Killed:
        spark.range(3).write.parquet(f"{path}/results/deal=0/job=4/_temporary/0")  # what a writer leaves
    return batches.work_off(pairs.genome_pairs(genomes), path, compute, jobs=5).select("qdb", "sdb", "n", "least")


def _release_tables(spark, sf):
    coded, genomes, sequences = queries._encoded(spark, sf)
    bridge = dims.gene_term_bridge(queries._gene_rows(spark, sf), sequences, queries._known_terms(spark, sf))
    return genomes, sequences, stage(bridge, "bridge"), stage(coded, "results")


def _rows(spark, path, like):
    out = None
    for name, df, first in zip(("genomes", "sequence", "bridge", "results"), tables.read_tables(spark, path), like):
        text = queries._texts(name, df.select(first.columns))
        out = text if out is None else out.unionByName(text)
    return out


_KEPT_SQL = queries.ORACLES["delete_genome"]


@query(_KEPT_SQL)
def delete_genome_from_tables(spark, sf):
    """On stored tables, in a second go after one that ended with some of its results gone."""
    saved, path = _release_tables(spark, sf), _scratch(spark, "tables")
    tables.save_tables(path, *saved)
    gone = tables.genome_id(spark, path, "Brand#7")
    remove(spark, f"{path}/results/{tables._result_folders(spark, path, gone)[0]}")
    assert tables.delete_genome(spark, path, "Brand#7") and not tables.delete_genome(spark, path, "Brand#7")
    return _rows(spark, path, saved)


_ALL_SQL = _KEPT_SQL.replace("WHERE gd.acc <> 'Brand#7'", "").replace(" WHERE genome_id NOT IN (FROM gone)", "").replace("WHERE query_db NOT IN (FROM gone) AND subject_db NOT IN (FROM gone)", "")


@query(_ALL_SQL)
def replace_genome_in_tables(spark, sf):
    """A genome of stored tables gets its rows anew, after a go that failed between tables."""
    saved, path = _release_tables(spark, sf), _scratch(spark, "tables")
    genomes, sequences, bridge, results = saved
    own = genomes.where("acc = 'Brand#7'")
    number = own.first()["id"]
    mine, of = f"genome_id = {number}", f"query_db = {number} or subject_db = {number}"
    # What is there first: older sequences and results, under another name.
    older = genomes.withColumn("name", F.when(F.col("id") == number, "older").otherwise(F.col("name")))
    tables.save_tables(path, older, sequences.where(f"not ({mine}) or id % 3 = 0"), bridge, results.withColumn("dist", F.when(F.expr(of), F.col("dist") + 1).otherwise(F.col("dist"))))
    new = own, sequences.where(mine), bridge.join(sequences.where(mine).select(F.col("id").alias("sequence_id")), "sequence_id", "left_semi"), results.where(of)
    broken = new[2].withColumn("go_term_name", F.when(F.col("id") >= 0, F.raise_error(F.lit("killed"))).otherwise(F.col("go_term_name")))
    try:
        tables.replace_genome(spark, path, new[0], new[1], broken, new[3])
    except Exception as e:
        if "killed" not in str(e):
            raise
    tables.replace_genome(spark, path, *new)
    return _rows(spark, path, saved)


@query(f"WITH {E_SQL} SELECT 'result' AS kind, qdb || ' ' || sdb || ' ' || count(*) AS value FROM edges WHERE dist <= 0.05 GROUP BY qdb, sdb UNION ALL SELECT 'export', l_partkey || chr(9) || l_suppkey FROM lineitem UNION ALL SELECT 'wrote', 'truefalse'")
def results_after_a_crash(spark, sf):
    """A saved result and an export, of which a killed run left a part, are made whole, once."""
    run = uuid.uuid4().hex
    made = lambda: A.edges(spark, sf, upper=0.05).groupBy("qdb", "sdb").agg(F.count("*").alias("n"))
    place, path = f"{shared_dir(spark)}/results/{Q.query_fingerprint(run=run)}", _scratch(spark, "upload")
    for left in (place, path):
        spark.range(3).write.parquet(f"{left}/_temporary/0")
    Q.reuse(spark, made, run=run)
    result = Q.reuse(spark, lambda: made().limit(0), run=run)
    lines = read_table(spark, sf, "lineitem").select(F.col("l_partkey").cast("string").alias("qid"), F.col("l_suppkey").cast("string").alias("sid"))
    wrote = "".join(str(sinks.write_text(sinks.pairs_for_upload(lines), path, ["value"], "gzip")).lower() for _ in range(2))
    rows = lambda kind, df, value: df.select(F.lit(kind).alias("kind"), value.alias("value"))
    out = rows("result", result, F.concat_ws(" ", "qdb", "sdb", "n")).unionByName(rows("export", spark.read.text(path), F.col("value")))
    return out.unionByName(rows("wrote", spark.range(1), F.lit(wrote)))


@query(f"WITH {queries._SEQ_SQL} SELECT '2' AS release, acc, count(*) AS sequences FROM gd JOIN sd ON sd.genome_id = gd.id GROUP BY acc")
def current_release_views(spark, sf):
    """Two releases saved as tables of the catalog, read through the views of the current one."""
    genomes, sequences = queries._dimensions(spark, sf)  # orthologs are in none of these tables
    database, path = f"db_{uuid.uuid4().hex}", _scratch(spark, "catalog")
    for number, kept in (("1", "id % 2 = 0"), ("2", "true")):
        own = {"genomes": genomes.where(kept), "sequence": sequences.where(kept), "release": spark.range(1).select(F.lit(number).alias("release"))}
        release.load_release(own, database, number, path)
    view = lambda name: spark.table(f"{database}.current_{name}")
    counted = view("sequence").groupBy(F.col("genome_id").alias("id")).agg(F.count("*").alias("sequences"))
    return view("genomes").join(counted, "id").join(F.broadcast(view("release"))).select("release", "acc", "sequences")  # one row




@query("""SELECT p_brand AS genome, count(*) + count(*) FILTER (p_brand = 'Brand#7') AS num_seqs FROM part WHERE p_brand <> 'Brand#9' GROUP BY 1
UNION ALL SELECT 'read again', 1""")
def refreshed_counts(spark, sf):
    """Counts of sequences, after a file came to one genome and another genome went: one file is read."""
    path = _scratch(spark, "fasta")
    genes = A.genes(spark, sf).select("genome", F.concat_ws("|", F.lit(">lcl"), F.col("gene").cast("string"), "gene_name").alias("nameline"), F.lit("ACDE").alias("sequence"))
    sinks.write_genome_fasta(genes, f"{path}/in")
    census.refresh_counts(spark, f"{path}/in", f"{path}/counts")
    own = genes.where("genome = 'Brand#7'").select(F.concat_ws("\n", "nameline", "sequence").alias("value"))
    own.coalesce(1).write.mode("append").text(f"{path}/in/genome=Brand%237")
    remove(spark, f"{path}/in/genome=Brand%239")
    counts, opened = census.refresh_counts(spark, f"{path}/in", f"{path}/counts")
    counts = counts.select(F.regexp_replace("genome", "%23", "#").alias("genome"), "num_seqs")
    return counts.unionByName(spark.createDataFrame([("read again", opened)], "genome string, num_seqs long"))


@query("SELECT o_orderkey, o_custkey FROM orders ORDER BY o_orderkey LIMIT 100 OFFSET 100 * ((SELECT count(*) FROM orders) // 100 - 2)")
def deep_page_of_orders(spark, sf):
    """The last full page but one of all orders, from the range that it lies in."""
    pages = profiles.Pages(read_table(spark, sf, "orders").select("o_orderkey", "o_custkey"), "o_orderkey")
    return pages.page(pages.total // 100 - 1, 100)
